"""The whole flow as one Spark job: merge, ingest, preprocess, train, evaluate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import is_missing
from ..operators import clean, features, joins, metrics, model, ordering, split
from ..schema import DATE, RAW_SCHEMA, SYMBOL, TARGET
from ..session import delete_folder, materialise, store
from ..sources.companies import companies
from ..sources.company_files import FILE_STEM, refresh_company_files, scan_company_files
from ..sources.tables import (
    load_dataset,
    read_jdbc,
    read_table,
    save_dataset,
    write_csv,
    write_jdbc,
    write_table,
)
from ..streaming import company_load, daily_append, page_load


@dataclass(frozen=True)
class HandOver:
    """Where one stage leaves its table for the next: ``dataset`` (parquet below ``base``),
    ``table`` (catalog) or ``jdbc`` (``url`` and ``options``). A database is read in parallel, so
    it needs ``partition``: a column all its tables have, its bounds and the number of tasks."""

    base: str
    kind: str = "dataset"
    url: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    partition: tuple[str, str, str, int] | None = None

    def __post_init__(self) -> None:
        if self.kind == "jdbc" and (self.url is None or self.partition is None):
            raise ValueError("a jdbc hand-over needs url and partition (column, lower, upper, tasks)")

    def save(self, df: DataFrame, name: str) -> None:
        if self.kind == "table":
            write_table(df, name, f"{self.base}/{name}")
        elif self.kind == "jdbc":
            write_jdbc(df, self.url, name, self.options)
        else:
            save_dataset(df, self.base, name)

    def load(self, spark: SparkSession, name: str) -> DataFrame:
        if self.kind == "table":
            return read_table(spark, name)
        if self.kind == "jdbc":
            return read_jdbc(spark, self.url, name, self.options, self.partition)
        return load_dataset(spark, self.base, name)


@dataclass(frozen=True)
class Settings:
    folder: str
    hand_over: HandOver
    model_path: str
    report_path: str
    merged_csv: str | None = None  # also write the merged, sorted panel as CSV
    first_rows: int | None = None  # the small flow takes the first 10,000 rows of the panel
    symbol_pattern: str = FILE_STEM
    nested: bool = False
    date_formats: Sequence[str] = ()
    trees: int = model.TREES
    depth: int | None = model.DEPTH  # of the trees; None grows them until their leaves are pure
    seed: int = model.SEED
    test_percent: int = 20
    cutoff: str | None = None  # split by date instead of by class
    title: str = "Model Evaluation Report"
    landing: str | None = None  # landed pages, for the load stage
    pages: str | None = None  # where the load stage publishes their rows, for the merge
    by_company: bool = False  # landed files belong to one company each: progress by company
    kept: str | None = None  # scan new and changed company files only, and keep the others' rows here
    incoming: str | None = None  # parquet files of daily rows, for the append stage
    history: str | None = None  # where that stage appends them, for the merge


RAW, PROCESSED, TEST, REPORT = "prices_raw", "prices_processed", "prices_test", "report"


def _observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows and gaps while the rows pass, instead of in a job of their own."""
    watch = Observation(name)
    gaps = [
        F.count_if(is_missing(F.col(f.name), f.dataType)).alias(f.name) for f in df.schema.fields
    ]
    return df.observe(watch, F.count(F.lit(1)).alias("row_count"), *gaps), watch


def load(spark: SparkSession, settings: Settings) -> DataFrame:
    """Load and publish the pages that landed since the last run. Returns the companies of which
    nothing is published yet."""
    staged, progress = f"{settings.pages}_staged", f"{settings.pages}_progress"
    if settings.by_company:
        company_load.load_company_pages(spark, settings.landing, staged, f"{progress}_by_company")
    else:
        page_load.load_pages(spark, settings.landing, staged, progress)
    published = page_load.finalise(spark, staged, settings.pages)
    return joins.pending_companies(companies(spark), published)


def append(spark: SparkSession, settings: Settings) -> list[int]:
    """Append the daily rows that arrived since the last run, each (symbol, day) once. Returns the
    numbers of all batches in the history."""
    arrived = spark.readStream.schema(RAW_SCHEMA).parquet(settings.incoming)
    dated = clean.parse_dates(arrived, settings.date_formats)
    daily_append.stream_daily_append(spark, dated, settings.history, f"{settings.history}_progress")
    return daily_append.committed_batches(spark, settings.history, "daily")


@dataclass(frozen=True)
class Merged:
    """The merged rows, stored once for all their readers."""

    rows: DataFrame
    path: str


def merge(spark: SparkSession, settings: Settings) -> Merged | None:
    """Unique rows of all company files, published pages and appended days with parsed dates; None
    when there is no row. ``ingest`` deletes what is stored here."""
    if settings.kept is not None:
        scan = refresh_company_files(
            spark, settings.folder, settings.kept, settings.symbol_pattern, settings.nested
        )
    else:
        scan = scan_company_files(spark, settings.folder, settings.symbol_pattern, settings.nested)
    rows = scan.rows()
    if settings.history is not None:
        days = daily_append.history_rows(spark, settings.history)
        rows = joins.union_by_name([rows, days.withColumn(DATE, F.col(DATE).cast("string"))])
    if settings.pages is not None:
        published = page_load.published_rows(spark, settings.pages)
        rows = joins.union_by_name([rows, published])
    merged = rows.transform(clean.dedupe_rows).transform(
        clean.parse_dates, settings.date_formats
    )
    path = store(merged, "merged")
    stored = spark.read.schema(merged.schema).parquet(path)
    if stored.isEmpty():
        delete_folder(spark, path)
        return None
    if settings.merged_csv is not None:
        write_csv(ordering.sorted_panel(stored), settings.merged_csv)
    return Merged(stored, path)


def ingest(merged: Merged, settings: Settings) -> dict[str, int]:
    """Store the merged rows without non-finite values; returns row and gap counts."""
    rows = merged.rows.transform(clean.nonfinite_to_null)
    if settings.first_rows is not None:
        rows = ordering.first_n(rows, settings.first_rows)
    rows, watch = _observed(rows, "ingested")
    settings.hand_over.save(rows, RAW)
    delete_folder(rows.sparkSession, merged.path)
    return watch.get


def preprocess(spark: SparkSession, settings: Settings) -> dict[str, int]:
    """Clean rows, add features and label, store; returns row and gap counts."""
    rows = settings.hand_over.load(spark, RAW)
    labelled = (
        rows.transform(clean.clean_panel)
        .transform(features.price_features)
        .transform(features.label_next_up)
    )
    labelled, watch = _observed(labelled, "processed")
    settings.hand_over.save(labelled, PROCESSED)
    return watch.get


def train(spark: SparkSession, settings: Settings) -> None:
    """Split, store the test rows, fit and store the forest."""
    matrix = features.feature_matrix(
        settings.hand_over.load(spark, PROCESSED), keep=(SYMBOL, DATE)
    )
    # The key of the split is the whole row: symbol and date can repeat.
    divided = (
        split.split_by_date(matrix, settings.cutoff)
        if settings.cutoff
        else split.stratified_split(
            matrix, test_percent=settings.test_percent, seed=settings.seed
        )
    )
    # The forest reads its input several times; written by side, each side is a plain scan.
    path = store(divided, "split", partition_by="is_test")
    try:
        stored = spark.read.schema(divided.schema).parquet(path)
        settings.hand_over.save(stored.where("is_test").drop("is_test"), TEST)
        rows = stored.where(~F.col("is_test")).drop("is_test", SYMBOL, DATE)
        fitted = model.train_forest(rows, settings.trees, settings.depth, settings.seed)
        model.save_model(fitted, settings.model_path)
    finally:
        delete_folder(spark, path)


def evaluate(spark: SparkSession, settings: Settings) -> str:
    """Score the stored test rows with the stored model; store and return the report."""
    fitted = model.load_model(settings.model_path)
    scored = model.predict(fitted, settings.hand_over.load(spark, TEST))
    # Both tables need the counts per (truth, prediction) only; score the rows once.
    counts = materialise(metrics.confusion(scored, TARGET, "prediction"), "confusion")
    report = metrics.report_from_counts(counts)
    text = metrics.render_report(metrics.binary_from_counts(counts), report, settings.title)
    report.write.mode("overwrite").parquet(settings.report_path)
    lines = spark.createDataFrame([(line,) for line in text.splitlines()], "value string")
    lines.coalesce(1).write.mode("overwrite").text(f"{settings.report_path}_text")
    return text


def run(spark: SparkSession, settings: Settings) -> str | None:
    """All stages in order, load and append only where something arrives. Returns the report, or None, with nothing written, when the folder has
    no rows."""
    if settings.landing is not None:
        load(spark, settings)
    if settings.incoming is not None:
        append(spark, settings)
    merged = merge(spark, settings)
    if merged is None:
        return None
    ingest(merged, settings)
    preprocess(spark, settings)
    train(spark, settings)
    return evaluate(spark, settings)
