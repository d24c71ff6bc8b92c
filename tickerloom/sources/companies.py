"""The company dimension: symbol, company id, sector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Symbol, company id, sector.
COMPANIES = """
NMB,1,commercial banks
SBL,2,commercial banks
NCCB,3,commercial banks
KBL,5,commercial banks
LBL,6,commercial banks
MBL,7,commercial banks
EBL,10,commercial banks
NBB,11,commercial banks
SBI,12,commercial banks
HBL,13,commercial banks
SCB,14,commercial banks
NIB,15,commercial banks
NABIL,16,commercial banks
CZBIL,18,commercial banks
PCBL,22,commercial banks
SRBL,23,commercial banks
ADBL,24,commercial banks
SANIMA,166,commercial banks
MEGA,301,commercial banks
CBL,325,commercial banks
CCBL,335,commercial banks
NBL,341,commercial banks
GBIME,404,commercial banks
NICA,446,commercial banks
PRVU,509,commercial banks
BOKL,634,commercial banks
CORBL,309,development banks
EDBL,182,development banks
GBBL,150,development banks
GRDBL,487,development banks
JBBL,151,development banks
KRBL,155,development banks
KSBBL,657,development banks
LBBL,668,development banks
MDB,149,development banks
MLBL,637,development banks
MNBBL,306,development banks
NABBC,167,development banks
SADBL,298,development banks
SAPDBL,999,development banks
SHBL,343,development banks
SHINE,440,development banks
SINDU,313,development banks
BFC,40,finance
CFCL,54,finance
CFL,88,finance
CMB,66,finance
GFCL,43,finance
GMFIL,71,finance
GUFL,603,finance
ICFC,77,finance
JFL,59,finance
MFIL,337,finance
MPFL,318,finance
NFS,25,finance
PFL,47,finance
PROFL,323,finance
RLFL,491,finance
SFCL,64,finance
SIFC,53,finance
CGH,872,tourism
OHL,97,tourism
SHL,95,tourism
TRH,96,tourism
AHPC,121,hydro
AKJCL,590,hydro
AKPL,514,hydro
API,527,hydro
BARUN,493,hydro
BNHC,782,hydro
BPCL,119,hydro
CHCL,120,hydro
CHL,628,hydro
DHPL,542,hydro
GHL,579,hydro
GLH,755,hydro
HDHPC,722,hydro
HPPL,618,hydro
HURJA,584,hydro
JOSHI,665,hydro
KKHC,578,hydro
KPCL,701,hydro
LEC,874,hydro
MBJC,505,hydro
MEN,844,hydro
MHNL,678,hydro
MKJC,535,hydro
NGPL,570,hydro
NHDL,612,hydro
NHPC,118,hydro
NYADI,544,hydro
PMHPL,681,hydro
PPCL,720,hydro
RADHI,574,hydro
RHPC,468,hydro
RHPL,474,hydro
RRHP,654,hydro
RURU,742,hydro
SAHAS,656,hydro
SHEL,832,hydro
SHPC,432,hydro
SJCL,380,hydro
SPC,1008,hydro
SPDL,617,hydro
SSHL,740,hydro
TPC,968,hydro
UMHL,585,hydro
UMRH,956,hydro
UNHPL,683,hydro
UPCL,610,hydro
UPPER,498,hydro
CHDC,518,investment
CIT,33,investment
HIDCL,513,investment
NIFRA,896,investment
NRN,972,investment
ALICL,143,life insurance
GLICL,305,life insurance
JLI,741,life insurance
LICN,138,life insurance
NLIC,137,life insurance
NLICL,128,life insurance
PLI,758,life insurance
PLIC,144,life insurance
RLI,764,life insurance
SLI,736,life insurance
SLICL,145,life insurance
ULI,717,life insurance
"""


def companies(spark: SparkSession) -> DataFrame:
    """One row per company. Fixed at 128 rows, so joins may broadcast it."""
    rows = [line.split(",") for line in COMPANIES.strip().splitlines()]
    return spark.createDataFrame(
        [(symbol, int(number), sector) for symbol, number, sector in rows],
        "symbol string, company_id int, sector string",
    )
