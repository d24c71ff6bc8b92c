"""Every registered query: ``(spark, folder of parquet tables) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..folders import write_folders
from ..functions import flatten_once
from ..operators import (
    clean,
    date_vote,
    distinct_sketches,
    features,
    joins,
    metrics,
    model,
    ordering,
    profile,
    split,
)
from ..schema import DATE, SYMBOL, TARGET
from ..session import create_empty_file, fresh_path, materialise, store
from ..sources import pages, tables
from ..sources.company_files import refresh_company_files, scan_company_files
from ..streaming import company_load, daily_append, page_load
from . import event_panel, pipeline

Query = Callable[[SparkSession, str], DataFrame]

HISTORY_ENDS = "2024-01-15"
PAGE_ROWS = 50


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# -- cleaning -----------------------------------------------------------------------------------


def dedupe_rows(spark, folder):
    return event_panel.unique(spark, folder).transform(clean.nonfinite_to_null)


def nonfinite_to_null(spark, folder):
    return event_panel.raw(spark, folder).transform(clean.nonfinite_to_null)


def parse_dates(spark, folder):
    return nonfinite_to_null(spark, folder).transform(clean.parse_dates)


def fill_change(spark, folder):
    return event_panel.finite(spark, folder).transform(clean.fill_change)


def drop_incomplete(spark, folder):
    return event_panel.finite(spark, folder).transform(clean.drop_incomplete)


def positive_prices(spark, folder):
    return event_panel.finite(spark, folder).transform(clean.positive_prices)


def normalize_columns(spark, folder):
    written = _table(spark, folder, "supplier").toDF(
        " S_SuppKey ", "S Name", "S.NationKey", "S_AcctBal.\t"
    )
    return written.transform(clean.normalize_columns)


# -- features -----------------------------------------------------------------------------------


def price_features(spark, folder):
    return event_panel.cleaned(spark, folder).transform(features.price_features)


def label_next_up(spark, folder):
    return event_panel.cleaned(spark, folder).transform(features.label_next_up)


def processed(spark, folder):
    return price_features(spark, folder).transform(features.label_next_up)


def label_skewed(spark, folder):
    """All bars under one symbol, each on a day of its own."""
    number = F.substring(SYMBOL, 2, 10).cast("int")
    one = event_panel.cleaned(spark, folder).withColumn(DATE, F.date_add(DATE, number * 400))
    return one.withColumn(SYMBOL, F.lit("ALL")).transform(features.label_next_up)


def movement_label(spark, folder):
    return event_panel.finite(spark, folder).transform(features.movement_label)


def feature_matrix(spark, folder):
    return processed(spark, folder).transform(features.feature_matrix)


def flatten_lists(spark, folder):
    """Vectors cut into lists of four, then joined again one level."""
    vector = F.col("embedding")
    nested = F.transform(
        F.filter(F.sequence(F.lit(0), F.size(vector)), lambda i: i * 4 < F.size(vector)),
        lambda i: F.slice(vector, i * 4 + 1, 4),
    )
    return (
        _table(spark, folder, "embeddings")
        .select("vec_id", F.posexplode(flatten_once(nested)).alias("position", "item"))
        .select("vec_id", "position", F.col("item").cast("double").alias("item"))
    )


# -- order --------------------------------------------------------------------------------------


def sorted_panel(spark, folder):
    return event_panel.cleaned(spark, folder).transform(ordering.with_position)


def first_n(spark, folder):
    return event_panel.cleaned(spark, folder).transform(ordering.first_n, 100)


def first_n_wide(spark, folder):
    """More rows than a task may gather, cut from the sorted ranges."""
    return ordering.first_n(event_panel.cleaned(spark, folder), 3_000, one_task=500)


def first_per_symbol(spark, folder):
    return event_panel.cleaned(spark, folder).transform(ordering.first_per_symbol)


# -- joins and unions ---------------------------------------------------------------------------


def union_by_name(spark, folder):
    rows = event_panel.events(spark, folder)
    return joins.union_by_name(
        [
            rows.select("event_id", "user_id", "value"),
            rows.select("event_type", "value", "event_id"),
        ]
    )


def sector_join(spark, folder):
    nations = _table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), "n_name", "n_regionkey"
    )
    return joins.attach_dimension(_table(spark, folder, "supplier"), nations, "s_nationkey")


def pending_companies(spark, folder):
    companies = _table(spark, folder, "customer").select(
        F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias(SYMBOL),
        F.col("c_custkey").alias("company_id"),
    )
    return joins.pending_companies(companies, event_panel.raw(spark, folder))


def _history_and_new(spark, folder):
    """Stored rows up to a day, and a delivery of all days with other closes."""
    rows = event_panel.panel(spark, folder).select(
        SYMBOL, F.col("d").alias(DATE), "open", "close", "traded_quantity"
    )
    return rows.where(F.col(DATE) < HISTORY_ENDS), rows.withColumn("close", F.col("close") + 1)


def append_new_rows(spark, folder):
    return joins.append_new_rows(*_history_and_new(spark, folder))


def stream_daily_append(spark, folder):
    history, new = _history_and_new(spark, folder)
    stored, arriving = fresh_path(spark, "history"), fresh_path(spark, "arriving")
    daily_append.write_history(history, stored)
    new.write.parquet(arriving)
    stream = (
        spark.readStream.schema(new.schema).option("maxFilesPerTrigger", 4).parquet(arriving)
    )
    daily_append.stream_daily_append(spark, stream, stored, fresh_path(spark, "progress"))
    return daily_append.read_history(spark, stored).drop(daily_append.YEAR)


def replayed_append(spark, folder):
    """Days appended in two batches. The first is killed before its commit and comes again; the
    second comes again after its commit, with other rows."""
    history, new = _history_and_new(spark, folder)
    path = fresh_path(spark, "history")
    daily_append.write_history(history, path)
    early, late = (new.where(F.col(DATE) < "2024-01-20"), new.where(F.col(DATE) >= "2024-01-20"))
    daily_append.append_batch(spark, path, early, 0)
    daily_append.commit_batch(spark, path, "daily", early, 0)
    daily_append.commit_batch(spark, path, "daily", late, 1)
    changed = late.withColumn(SYMBOL, F.concat(SYMBOL, F.lit("x")))
    daily_append.commit_batch(spark, path, "daily", changed, 1)
    return daily_append.read_history(spark, path).drop(daily_append.YEAR)


def bounded_append(spark, folder):
    """A stream of the panel's days, each row delivered twice within two days, without repeats; the
    state holds a week."""
    rows = event_panel.panel(spark, folder).select(
        SYMBOL, F.col("d").alias(DATE), F.col("d").cast("timestamp_ntz").alias("ts"), "close"
    )
    arriving, kept = fresh_path(spark, "arriving"), fresh_path(spark, "kept")
    again = rows.withColumn("ts", F.expr("ts + interval 2 days"))
    rows.unionByName(again).write.parquet(arriving)
    stream = spark.readStream.schema(rows.schema).parquet(arriving)
    daily_append.stream_recent(stream, "ts", kept, fresh_path(spark, "progress"))
    return spark.read.parquet(kept).select(SYMBOL, DATE, "close")


# -- profiling ----------------------------------------------------------------------------------


def distinct_by_sketch(spark, folder):
    """Companies of each week, from sketches of the days that were stored in two deliveries which
    share a week: whether the estimate is within 5 % of the count."""
    rows = event_panel.finite(spark, folder)
    path = fresh_path(spark, "sketches")
    for part in (rows.where(F.col(DATE) < "2024-01-17"), rows.where(F.col(DATE) >= "2024-01-10")):
        distinct_sketches.add_sketches(part, path)
    week = F.trunc(DATE, "week")
    estimates = distinct_sketches.distinct_counts(distinct_sketches.stored_sketches(spark, path), week)
    exact = rows.where(F.col(DATE).isNotNull()).groupBy(week.alias("span")).agg(
        F.count_distinct(SYMBOL).alias("companies")
    )
    close = F.abs(F.col("estimate") - F.col("companies")) <= 0.05 * F.col("companies")
    return exact.join(estimates, "span").select("span", "companies", close.alias("within_bound"))


# Spellings by the number of the symbol modulo their count.
_SPELLINGS = ("yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "dd.MM.yyyy", "MMM d, yyyy")


def vote_dates(spark, folder):
    """Unique rows of the panel, each company's dates in a spelling of its own, parsed by vote."""
    day = F.col(DATE).try_cast("date")
    number = F.substring(SYMBOL, 2, 20).cast("bigint") % len(_SPELLINGS)
    spelled = F.coalesce(
        *[F.when(number == i, F.date_format(day, spelling)) for i, spelling in enumerate(_SPELLINGS)], DATE
    )
    rows = event_panel.unique(spark, folder).transform(clean.nonfinite_to_null).withColumn(DATE, spelled)
    return date_vote.parse_by_vote(materialise(rows, "spelled"))


def profile_table(spark, folder):
    return event_panel.raw(spark, folder).transform(profile.profile)


def column_summary(spark, folder):
    return event_panel.raw(spark, folder).transform(profile.column_summary)


def merge_audit(spark, folder):
    return event_panel.raw(spark, folder).transform(profile.merge_audit)


def rows_per_symbol(spark, folder):
    return event_panel.raw(spark, folder).transform(profile.rows_per_symbol)


def file_audit(spark, folder):
    """Files found, files with a usable row, and their lines; one file is without a byte."""
    path = _write_company_files(spark, folder)
    create_empty_file(spark, f"{path}/symbol=NONE/empty.csv")
    files = scan_company_files(spark, path, symbol_pattern=_SYMBOL_FOLDER, nested=True).audit()
    return files.agg(
        F.count(F.lit(1)).alias("files_found"),
        F.count_if(F.col("row_count") > 0).alias("files_valid"),
        F.sum("row_count").alias("lines_used"),
        F.sum("quarantined").alias("lines_set_aside"),
    )


# -- metrics, split, model ----------------------------------------------------------------------


def confusion(spark, folder):
    return metrics.confusion(_table(spark, folder, "labels"), "quality", "toxic")


def binary_metrics(spark, folder):
    return metrics.binary_metrics(_table(spark, folder, "labels"), "quality", "toxic")


def classification_report(spark, folder):
    return metrics.classification_report(_table(spark, folder, "labels"), "quality", "toxic")


def report_text(spark, folder):
    """The lines of the report on the labels, as the flow writes them."""
    rows = materialise(metrics.confusion(_table(spark, folder, "labels"), "quality", "toxic"), "confusion")
    text = metrics.render_report(
        metrics.binary_from_counts(rows), metrics.report_from_counts(rows), pipeline.Settings.title
    )
    return spark.createDataFrame(list(enumerate(text.splitlines())), "line_no int, line string")


def guarded_run(spark, folder):
    """What an earlier run stored, after a run on a folder without a usable row: it stops and leaves
    everything as it was."""
    base, companies_folder = fresh_path(spark, "base"), fresh_path(spark, "companies")
    hand_over = pipeline.HandOver(f"{base}/tables")
    hand_over.save(event_panel.raw(spark, folder).transform(clean.nonfinite_to_null), pipeline.RAW)
    create_empty_file(spark, f"{companies_folder}/EMPTY.csv")
    chosen = pipeline.Settings(companies_folder, hand_over, f"{base}/model", f"{base}/report")
    if pipeline.run(spark, chosen) is not None:
        raise ValueError("a folder without rows gave a report")
    return hand_over.load(spark, pipeline.RAW)


def stratified_split(spark, folder):
    rows = materialise(processed(spark, folder), "processed")
    return split.stratified_split(
        rows.select(SYMBOL, DATE, "close", TARGET), key=[SYMBOL, DATE]
    )


def split_by_date(spark, folder):
    rows = processed(spark, folder).select(SYMBOL, DATE, "close", TARGET)
    return split.split_by_date(rows, "2024-01-24")


def _forest(spark, folder) -> tuple[DataFrame, DataFrame]:
    """The divided rows, and the test rows with predictions: split, fit, save, load, predict, at
    the depth of the flow."""
    stored = materialise(processed(spark, folder), "processed")
    matrix = features.feature_matrix(stored, keep=(SYMBOL, DATE))
    divided = split.stratified_split(matrix, key=[SYMBOL, DATE])
    divided = spark.read.schema(divided.schema).parquet(store(divided, "split", "is_test"))
    path = fresh_path(spark, "model")
    train = divided.where(~F.col("is_test")).drop("is_test")
    model.save_model(model.train_forest(train), path)
    return divided, model.predict(model.load_model(path), divided.where("is_test"))


def forest_report(spark, folder):
    return metrics.classification_report(_forest(spark, folder)[1], TARGET, "prediction")


def forest_checks(spark, folder):
    """What is exact about the forest: the sides of the split per class, every test row scored with
    a class, and an accuracy no worse than a tenth below the larger class's share."""
    divided, scored = _forest(spark, folder)
    sides = divided.groupBy(F.col(TARGET).alias("label")).agg(
        F.count_if(~F.col("is_test")).alias("train_rows"), F.count_if("is_test").alias("test_rows")
    )
    hit = F.col("prediction") == F.col(TARGET)
    known = F.col("prediction").isin(0, 1)
    totals = scored.agg(
        F.count_if(known).alias("scored"),
        (F.count_if(hit) / F.count(F.lit(1))).alias("_accuracy"),
        (F.greatest(F.mean(TARGET), 1 - F.mean(TARGET)) - 0.1).alias("_least"),
    ).select("scored", (F.col("_accuracy") >= F.col("_least")).alias("accurate"))
    return sides.join(F.broadcast(totals))  # one row


# -- sources and sinks --------------------------------------------------------------------------


def table_scan(spark, folder):
    """A catalog table, written twice: the second write replaces the first."""
    orders = _table(spark, folder, "orders")
    path = fresh_path(spark, "table")
    name = "t" + path.rsplit("-", 1)[1]
    tables.write_table(orders.select("o_orderkey"), name, path)
    tables.write_table(orders, name, path)
    return tables.read_table(spark, name)


def named_dataset_roundtrip(spark, folder):
    base = fresh_path(spark, "datasets")
    tables.save_dataset(_table(spark, folder, "orders"), base, "orders")
    return tables.load_dataset(spark, base, "orders")


def merged_csv_roundtrip(spark, folder):
    rows = dedupe_rows(spark, folder)
    path = fresh_path(spark, "merged")
    tables.write_csv(ordering.sorted_panel(rows), path)
    return tables.read_csv(spark, path, rows.schema)


def _write_company_files(spark, folder, path: str | None = None, part: Column | None = None) -> str:
    """The dirty panel, or the ``part`` of it, as one folder per symbol, in two header forms: half of
    the symbols have other column names and another column order."""
    path = path or fresh_path(spark, "companies")
    rows = event_panel.raw(spark, folder)
    rows = rows if part is None else rows.where(part)
    second_form = F.pmod(F.xxhash64(SYMBOL), F.lit(2)) == 1
    titled = {name: name.replace("_", " ").title() for name in rows.columns if name != SYMBOL}
    turned = [SYMBOL, *[F.col(name).alias(f" {titled[name]}.") for name in reversed(titled)]]
    for part in (rows.where(~second_form), rows.where(second_form).select(*turned)):
        # One file per symbol; a symbol has at most two rows a day.
        write_folders(part, SYMBOL, path, "csv")
    return path


_SYMBOL_FOLDER = r"symbol=([^/]+)/[^/]+\.csv$"


def _usable_rows(scan) -> DataFrame:
    return scan.rows().drop("status").transform(clean.nonfinite_to_null)


def scan_files(spark, folder):
    path = _write_company_files(spark, folder)
    return _usable_rows(scan_company_files(spark, path, symbol_pattern=_SYMBOL_FOLDER, nested=True))


def scan_undated_files(spark, folder):
    """Company files of which every third has no date column, with places in the panel: by symbol
    and date, rows without a date after the others."""
    path = fresh_path(spark, "companies")
    rows = event_panel.raw(spark, folder)
    undated = F.substring(SYMBOL, 2, 20).cast("bigint") % 3 == 1
    for part in (rows.where(~undated), rows.where(undated).drop(DATE)):
        write_folders(part, SYMBOL, path, "csv")
    found = _usable_rows(scan_company_files(spark, path, symbol_pattern=_SYMBOL_FOLDER, nested=True))
    return found.transform(ordering.with_position)


def incremental_scan(spark, folder):
    """Company files that come in three deliveries, scanned after each; the last one replaces files
    of the first by longer ones."""
    kept, path = fresh_path(spark, "kept"), fresh_path(spark, "companies")
    number = F.substring(SYMBOL, 2, 20).cast("bigint")
    early = F.col(DATE) < "2024-01-10"
    replaced = number % 4 == 0
    scan = lambda: refresh_company_files(
        spark, path, kept, symbol_pattern=_SYMBOL_FOLDER, nested=True
    )
    _write_company_files(spark, folder, path, replaced & early)
    scan()
    _write_company_files(spark, folder, path, ~replaced)
    scan()
    rows = event_panel.raw(spark, folder).where(replaced)
    write_folders(rows, SYMBOL, path, "csv", replace=True)
    return _usable_rows(scan())


def _answers(spark, folder, gaps: bool = False) -> DataFrame:
    """The dirty panel as answers of 50 rows. The window holds a symbol's days (each at most
    twice), so the calendar bounds it, as 50 or 60 bound a page's list. First pages come twice.
    With ``gaps`` some symbols' first pages come without data, some without a total, and each page
    begins with the last ten rows of the one before."""
    rows = event_panel.raw(spark, folder)
    cells = [name for name in rows.columns if name != SYMBOL]
    by_date = Window.partitionBy(SYMBOL).orderBy(*cells)
    number = F.substring(SYMBOL, 2, 20).cast("bigint")
    first_page = F.col("_page") == 0
    index = F.col("DT_Row_Index") - 1
    page = F.floor(index / PAGE_ROWS)
    overlap = F.lit(gaps) & (index % PAGE_ROWS >= PAGE_ROWS - 10)
    answers = (
        rows.withColumn("DT_Row_Index", F.row_number().over(by_date))
        .withColumn("recordsTotal", F.count(F.lit(1)).over(Window.partitionBy(SYMBOL)))
        .withColumn(
            "_page", F.explode(F.when(overlap, F.array(page, page + 1)).otherwise(F.array(page)))
        )
        .groupBy(SYMBOL, "recordsTotal", "_page")
        .agg(F.collect_list(F.struct("DT_Row_Index", *cells)).alias("data"))
        .withColumn(
            "_time",
            F.explode(
                F.when(first_page, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
            ),
        )
    )
    if gaps:
        answers = answers.withColumns(
            {
                "data": F.when(~(first_page & (number % 7 == 3)), F.col("data")),
                "recordsTotal": F.when(number % 11 != 5, F.col("recordsTotal")),
            }
        )
    return answers.select(SYMBOL, "recordsTotal", "data")


def _land_pages(spark, folder, gaps: bool = False) -> str:
    path = fresh_path(spark, "landing")
    _answers(spark, folder, gaps).write.json(path)
    return path


def page_explode(spark, folder):
    landed = pages.read_pages(spark, _land_pages(spark, folder))
    rows = pages.explode_pages(landed.dropDuplicates([SYMBOL, "recordsTotal", "data"]))
    return rows.drop("status").transform(clean.nonfinite_to_null)


def page_completeness(spark, folder):
    landing = _land_pages(spark, folder, gaps=True)
    return pages.page_completeness(pages.read_pages(spark, landing))


def page_quarantine(spark, folder):
    """Lines set aside, per reason, of pages of which some are cut short and some hold a close
    that is not a number."""
    number = F.substring(SYMBOL, 2, 20).cast("bigint")
    spoilt = F.transform(
        "data",
        lambda row: row.withField(
            "close",
            F.when(
                (number % 20 == 8) & row["published_date"].endswith("-18"), F.lit("12.5x")
            ).otherwise(row["close"].cast("string")),
        ),
    )
    text = F.to_json(F.struct(SYMBOL, "recordsTotal", "data"))
    lines = _answers(spark, folder).withColumn("data", spoilt).select(SYMBOL, text.alias("json"))
    cut = F.expr("left(json, length(json) - 2)")
    path = fresh_path(spark, "landing")
    whole = F.when(number % 13 == 4, cut).otherwise(F.col("json"))
    lines.select(whole.alias("value")).write.text(path)
    lost = pages.quarantine(pages.parse_pages(pages.read_pages(spark, path)))
    return lost.distinct().groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


def stream_page_load(spark, folder):
    staged, progress = fresh_path(spark, "staged"), fresh_path(spark, "progress")
    page_load.load_pages(spark, _land_pages(spark, folder), staged, progress)
    rows = page_load.finalise(spark, staged, fresh_path(spark, "final"))
    return rows.drop("status").transform(clean.nonfinite_to_null)


def two_page_cycles(spark, folder):
    """Two landings, each loaded and published; the second brings some pages again."""
    names = ("landing", "staged", "progress", "final")
    landing, staged, progress, final = (fresh_path(spark, name) for name in names)
    number = F.substring(SYMBOL, 2, 20).cast("bigint")
    for part in (number % 2 == 0, (number % 2 == 1) | (number % 3 == 0)):
        _answers(spark, folder).where(part).write.mode("append").json(landing)
        page_load.load_pages(spark, landing, staged, progress)
        rows = page_load.finalise(spark, staged, final)
    return rows.drop("status").transform(clean.nonfinite_to_null)


def restart_one_company(spark, folder):
    """Pages by company, loaded twice. Between the runs some companies' progress is spoilt and others
    get new pages: rows staged per company, and whether it was started again."""
    landing, staged, progress = (fresh_path(spark, name) for name in ("landing", "staged", "progress"))
    pattern = r"symbol=([^/]+)/[^/]+\.json$"
    number = F.substring(SYMBOL, 2, 20).cast("bigint")
    answers = materialise(_answers(spark, folder), "answers")
    deliveries = (answers, answers.where(number % 5 == 2))
    restarted: list[str] = []
    for delivery in deliveries:
        write_folders(delivery, SYMBOL, landing, "json")
        restarted = company_load.load_company_pages(spark, landing, staged, progress, pattern)
        spoilt = answers.where(number % 10 == 3).select(SYMBOL, F.lit('{"path": "cut sho').alias("value"))
        write_folders(spoilt.distinct(), SYMBOL, progress, "text")
    again = spark.createDataFrame([(symbol, True) for symbol in restarted], "symbol string, restarted boolean")
    counts = company_load.staged_rows(spark, staged).groupBy(SYMBOL).agg(F.count(F.lit(1)).alias("staged"))
    return counts.join(again, SYMBOL, "left").withColumn("restarted", F.coalesce("restarted", F.lit(False)))


QUERIES: dict[str, Query] = {
    "processed": processed,
    "dedupe_rows": dedupe_rows,
    "nonfinite_to_null": nonfinite_to_null,
    "parse_dates": parse_dates,
    "fill_change": fill_change,
    "drop_incomplete": drop_incomplete,
    "positive_prices": positive_prices,
    "normalize_columns": normalize_columns,
    "features": price_features,
    "label_next_up": label_next_up,
    "label_skewed": label_skewed,
    "movement_label": movement_label,
    "feature_matrix": feature_matrix,
    "flatten_lists": flatten_lists,
    "sorted_panel": sorted_panel,
    "first_n": first_n,
    "first_n_wide": first_n_wide,
    "first_per_symbol": first_per_symbol,
    "union_by_name": union_by_name,
    "sector_join": sector_join,
    "pending_companies": pending_companies,
    "append_new_rows": append_new_rows,
    "stream_daily_append": stream_daily_append,
    "replayed_append": replayed_append,
    "bounded_append": bounded_append,
    "distinct_by_sketch": distinct_by_sketch,
    "vote_dates": vote_dates,
    "profile": profile_table,
    "column_summary": column_summary,
    "merge_audit": merge_audit,
    "rows_per_symbol": rows_per_symbol,
    "confusion": confusion,
    "binary_metrics": binary_metrics,
    "classification_report": classification_report,
    "report_text": report_text,
    "guarded_run": guarded_run,
    "stratified_split": stratified_split,
    "split_by_date": split_by_date,
    "forest_report": forest_report,
    "forest_checks": forest_checks,
    "table_scan": table_scan,
    "named_dataset_roundtrip": named_dataset_roundtrip,
    "merged_csv_roundtrip": merged_csv_roundtrip,
    "scan_company_files": scan_files,
    "scan_undated_files": scan_undated_files,
    "incremental_scan": incremental_scan,
    "page_explode": page_explode,
    "file_audit": file_audit,
    "page_completeness": page_completeness,
    "page_quarantine": page_quarantine,
    "two_page_cycles": two_page_cycles,
    "restart_one_company": restart_one_company,
    "stream_page_load": stream_page_load,
}
