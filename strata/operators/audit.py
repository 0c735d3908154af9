"""Row counts and range profiles."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def profile_range(df: DataFrame, col: str) -> DataFrame:
    """``SELECT COUNT(*), MIN(col), MAX(col)`` as one row with named columns
    (partial aggregates per task, one row each to the final step)."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(col).alias(f"min_{col}"),
        F.max(col).alias(f"max_{col}"),
    )


def profile_table(spark: SparkSession, table: str, col: str) -> DataFrame:
    """The same profile as SQL text over a catalogue table."""
    return spark.sql(
        f"SELECT COUNT(*) AS row_count, MIN(`{col}`) AS `min_{col}`, "
        f"MAX(`{col}`) AS `max_{col}` FROM {table}")


#: Lets the file source answer counts, minima and maxima from file footers.
FOOTER_SETTINGS = {
    "spark.sql.sources.useV1SourceList": "",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.orc.aggregatePushdown": "true",
}


@contextmanager
def _settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def footer_plan(spark: SparkSession, path: str, col: str, fmt: str = "parquet") -> str:
    """The physical plan that :func:`profile_files` runs."""
    with _settings(spark, FOOTER_SETTINGS):
        plan = profile_range(spark.read.format(fmt).load(path), col)
        return plan._jdf.queryExecution().executedPlan().toString()


def profile_files(spark: SparkSession, path: str, col: str, fmt: str = "parquet") -> DataFrame:
    """:func:`profile_range` over stored Parquet or ORC files from the statistics
    in their footers: one small read per file, however many rows it holds. Where
    the format keeps no exact statistics (texts, nested values) Spark plans the
    scan instead, and where a file lacks them the profile is run again as a scan;
    the result is the same. Runs the job; the result is one row.
    """
    profile = profile_range(spark.read.format(fmt).load(path), col)
    try:
        with _settings(spark, FOOTER_SETTINGS):
            rows = profile_range(spark.read.format(fmt).load(path), col).collect()
    except (PySparkException, Py4JJavaError) as failure:
        # a file without the statistics (written without, or nulls only) fails its task
        if "aggregatePushdown" not in str(failure):
            raise
        rows = []
    if not rows or rows[0]["row_count"] is None:        # or no file has any rows
        rows = profile.collect()
    return spark.createDataFrame(rows, profile.schema)


def observed_counts(spark: SparkSession, rows: Mapping[str, int]) -> DataFrame:
    """One row ``(stage, rows)`` per stage from counts that the writes observed."""
    return spark.createDataFrame(list(rows.items()), "stage string, rows long")


def stage_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """One row ``(stage, rows)`` per named stage, as one Spark plan (a union
    of global counts; each branch prunes its input to no columns where the
    plan allows). Give it stored stages: it computes what they are made of."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("stage"), "rows")
             for name, df in stages.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
