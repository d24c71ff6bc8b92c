"""Run the flow, or one stage of it: ``python -m tickerloom [stage] --folder ... --base ...``.

A scheduler can call the stages one after another; each finds its input where the one before
left it.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .operators import model
from .plans import pipeline
from .sources.company_files import FILE_STEM

STAGES = ("all", "load", "append", "ingest", "preprocess", "train", "evaluate")


def _partition(text: str) -> tuple[str, str, str, int]:
    column, lower, upper, tasks = text.split(",")
    return column, lower, upper, int(tasks)


def parser() -> argparse.ArgumentParser:
    options = argparse.ArgumentParser(prog="tickerloom", description=__doc__)
    options.add_argument("stage", choices=STAGES, nargs="?", default="all")
    options.add_argument("--folder", required=True, help="company CSV files")
    options.add_argument("--base", required=True, help="folder for tables, model and report")
    options.add_argument("--hand-over", choices=("dataset", "table", "jdbc"), default="dataset")
    options.add_argument("--url", help="database, for --hand-over jdbc")
    options.add_argument(
        "--option", action="append", default=[], metavar="NAME=VALUE", help="database option"
    )
    options.add_argument(
        "--partition",
        type=_partition,
        metavar="COLUMN,LOWER,UPPER,TASKS",
        help="how a database is read in parallel, for --hand-over jdbc",
    )
    options.add_argument("--landing", help="landed JSON pages to load first")
    options.add_argument("--by-company", action="store_true", help="landed files are of one company each")
    options.add_argument("--kept", help="folder for the rows of files that were read; only new files are read")
    options.add_argument("--incoming", help="parquet files of daily rows to append first")
    options.add_argument("--symbol-pattern", default=FILE_STEM, help="symbol in a file's path")
    options.add_argument("--nested", action="store_true", help="look for files in subfolders too")
    options.add_argument("--date-format", action="append", default=[], help="besides ISO dates")
    options.add_argument("--seed", type=int, default=model.SEED)
    options.add_argument("--test-percent", type=int, default=20)
    options.add_argument("--title", default=pipeline.Settings.title, help="of the report")
    options.add_argument("--first-rows", type=int, help="use only the first rows of the panel")
    options.add_argument("--merged-csv", help="also write the merged panel as CSV")
    options.add_argument("--cutoff", help="test on days from this one on")
    options.add_argument("--trees", type=int, default=model.TREES)
    options.add_argument("--depth", type=int, default=model.DEPTH, help="without it, trees grow in full")
    return options


def settings(arguments: argparse.Namespace) -> pipeline.Settings:
    base = arguments.base.rstrip("/")
    return pipeline.Settings(
        folder=arguments.folder,
        hand_over=pipeline.HandOver(
            f"{base}/tables",
            arguments.hand_over,
            arguments.url,
            dict(option.split("=", 1) for option in arguments.option),
            arguments.partition,
        ),
        model_path=f"{base}/model",
        report_path=f"{base}/report",
        merged_csv=arguments.merged_csv,
        first_rows=arguments.first_rows,
        trees=arguments.trees,
        depth=arguments.depth,
        cutoff=arguments.cutoff,
        symbol_pattern=arguments.symbol_pattern,
        nested=arguments.nested,
        date_formats=arguments.date_format,
        seed=arguments.seed,
        test_percent=arguments.test_percent,
        title=arguments.title,
        landing=arguments.landing,
        pages=f"{base}/pages",
        by_company=arguments.by_company,
        kept=arguments.kept,
        incoming=arguments.incoming,
        history=f"{base}/history",
    )


def main(words: list[str] | None = None) -> str | None:
    arguments = parser().parse_args(words)
    chosen = settings(arguments)
    spark = SparkSession.builder.appName("tickerloom").getOrCreate()
    if arguments.stage == "load":
        return f"{pipeline.load(spark, chosen).count()} companies without a row"
    if arguments.stage == "append":
        return f"batches {pipeline.append(spark, chosen)}"
    if arguments.stage == "ingest":
        merged = pipeline.merge(spark, chosen)
        return None if merged is None else str(pipeline.ingest(merged, chosen))
    if arguments.stage == "preprocess":
        return str(pipeline.preprocess(spark, chosen))
    if arguments.stage == "train":
        return pipeline.train(spark, chosen)
    if arguments.stage == "evaluate":
        return pipeline.evaluate(spark, chosen)
    return pipeline.run(spark, chosen)


if __name__ == "__main__":
    print(main() or "")
