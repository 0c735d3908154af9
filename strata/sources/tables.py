"""Catalogue tables: read, create the database, overwrite a table.

An overwrite writes a new version folder and publishes it as the next release
of the database (``sources.releases``), so a write that fails leaves the old
table as it was. Row counts are observed inside the writing job
(``DataFrame.observe``), so a write costs one Spark job and no extra counting
pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.sources.releases import Draft


def qualified(database: str | None, table: str) -> str:
    return f"{database}.{table}" if database else table


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the database if absent (optionally at a given shared location)."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_parquet_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def write_table(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
) -> int:
    """Overwrite table ``name`` with ``df`` (the stored schema is replaced) and
    return the number of rows written, observed in the same job.

    The files go to a new version folder through Spark's file commit protocol
    (a lost executor only re-runs its tasks); readers see them only once they
    are complete, so ``df`` may even read the table itself. ``fmt="delta"``
    needs the Delta package on the classpath; it keeps versions of its own, so
    the table is overwritten in place with ``overwriteSchema``.
    """
    if fmt == "delta":
        observation = Observation()
        writer = df.observe(observation, F.count(F.lit(1)).alias("rows")).write.format(fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)
        return int(observation.get["rows"])
    database, _, table = name.rpartition(".")
    with Draft(df.sparkSession, database or None) as draft:
        rows = draft.write(df, table, fmt, partition_by)
        draft.publish()
    return rows
