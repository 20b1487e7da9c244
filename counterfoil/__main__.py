"""Batch scoring as a Spark job: ``spark-submit`` this module or run it with ``python -m``."""

from __future__ import annotations

import argparse

from counterfoil.operators import reports
from counterfoil.operators.learners import StratifiedTLearner, TreeTLearner
from counterfoil.plans import pipeline
from counterfoil.session import build_session
from counterfoil.sources import catalog
from counterfoil.sources.storage import scratch

LEARNERS = {
    "boosted": TreeTLearner("boosted"),
    "forest": TreeTLearner("forest"),
    "stratified": StratifiedTLearner(),
}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="counterfoil", description=__doc__)
    parser.add_argument("tables", help="folder of the six tables")
    parser.add_argument("output", help="folder for the targeting list")
    parser.add_argument("--reference", required=True, help="history ends before this date")
    parser.add_argument("--promotion", required=True, nargs="+", help="promotions to score")
    parser.add_argument(
        "--as-of",
        choices=["reference", "start"],
        default="reference",
        help="what the rows of the campaign log know: history before the reference date, or "
        "before their own promotion's start",
    )
    parser.add_argument("--learner", choices=LEARNERS, default="boosted")
    parser.add_argument("--campaign-cost", type=float, default=0.50)
    parser.add_argument("--table-format", choices=["csv", "parquet"], default="csv")
    parser.add_argument("--output-format", choices=["csv", "parquet"], default="csv")
    parser.add_argument("--file", action="append", default=[], metavar="TABLE=NAME")
    parser.add_argument("--master")
    given = parser.parse_args(arguments)

    spark = build_session(master=given.master)
    files = dict(pair.split("=", 1) for pair in given.file)
    tables = catalog.load_catalog(spark, given.tables, files, given.table_format)
    with scratch(spark):
        scoring = pipeline.run_scoring(
            tables,
            given.output,
            given.reference,
            given.promotion,
            LEARNERS[given.learner],
            given.campaign_cost,
            given.output_format,
            given.as_of,
        )
        reports.value_counts(scoring.rows, "recommended_action").show(truncate=False)
        reports.segment_means(scoring.rows).show(truncate=False)


if __name__ == "__main__":
    main()
