"""Command line: ``python -m sheafline list`` or ``python -m sheafline run QUERY DATA OUT``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from sheafline import reference_queries  # noqa: F401 - registers its queries
from sheafline.queries import QUERIES


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="sheafline")
    sub = p.add_subparsers(dest="what", required=True)
    sub.add_parser("list")
    run = sub.add_parser("run")
    for name in ("query", "data", "out"):
        run.add_argument(name)
    args = p.parse_args(argv)
    if args.what == "list":
        print("\n".join(sorted(QUERIES)))
        return
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    QUERIES[args.query](spark, args.data).write.mode("overwrite").parquet(args.out)


if __name__ == "__main__":
    main()
