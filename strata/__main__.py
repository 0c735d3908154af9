"""Run the catalogue jobs from the command line (e.g. with spark-submit).

    python -m strata films --pages PATH [--bad-pages fail|quarantine]
    python -m strata dictionary --pages PATH
    python -m strata silver
    python -m strata gold
    python -m strata all --pages PATH --dictionary-pages PATH

Pages are JSON Lines files (one page per line), or one page per file with
``--whole-files``. The session comes from the environment (cluster
settings, ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from strata import catalogue as C
from strata.plans import dictionary_job, films_job, gold_job, run_layers, silver_job
from strata.sources import ensure_database, read_landed_pages


def main(argv: list[str] | None = None) -> dict:
    parser = argparse.ArgumentParser(prog="strata")
    parser.add_argument("job", choices=["films", "dictionary", "silver", "gold", "all"])
    parser.add_argument("--pages", help="landed result pages (films, all) or dictionary pages")
    parser.add_argument("--dictionary-pages", help="landed dictionary pages (all)")
    parser.add_argument("--database", default=C.DATABASE)
    parser.add_argument("--location", default=None, help="database location, if it is created")
    parser.add_argument("--format", default="parquet")
    parser.add_argument("--bad-pages", default="fail", choices=["fail", "quarantine"])
    parser.add_argument("--unique-rows", action="store_true",
                        help="resolve codes row by row: film rows are not regrouped")
    parser.add_argument("--whole-files", action="store_true",
                        help="one page per file (saved responses) instead of JSON Lines")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"strata-{args.job}").getOrCreate()

    def landed(path: str):
        return read_landed_pages(spark, path, whole_files=args.whole_files)

    ensure_database(spark, args.database, args.location)
    if args.job == "films":
        report = films_job(spark, landed(args.pages), args.database,
                           args.format, args.bad_pages)
    elif args.job == "dictionary":
        report = dictionary_job(spark, landed(args.pages), args.database,
                                args.format)
    elif args.job == "silver":
        report = silver_job(spark, args.database, args.format, args.unique_rows)
    elif args.job == "gold":
        report = gold_job(spark, args.database, args.format)
    else:
        report = run_layers(spark, landed(args.pages), landed(args.dictionary_pages), args.database,
                            args.location, args.format, args.bad_pages, args.unique_rows)
    summary = {"database": report.database, "rows": report.rows,
               "quarantined": report.quarantined}
    print(json.dumps(summary))
    return summary


if __name__ == "__main__":
    main()
