"""Incremental ingest of landed result pages with Structured Streaming.

The same ``ingest_films`` projection as the batch ingest, applied to page
files as they land. The file sink with a checkpoint gives exactly-once
output: a restarted query (or a lost executor) neither drops nor repeats
pages. A page or element that cannot be read fails the query, as in the batch
ingest, unless the ingest is lenient; then :func:`start_bad_page_capture`, a
second query over the same files with its own checkpoint, keeps the pages that
hold such in a quarantine table (each query exactly-once on its own).
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from strata.sources.pages import faulty_pages, ingest_films


def _landed(spark: SparkSession, landing_path: str, max_files_per_trigger: int | None):
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(landing_path).withColumnRenamed("value", "body")


def _start(df, table: str, checkpoint_location: str, fmt: str, available_now: bool):
    writer = (df.writeStream.format(fmt).outputMode("append")
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now \
        else writer.trigger(processingTime="30 seconds")
    return writer.toTable(table)


def start_page_ingest(
    spark: SparkSession,
    landing_path: str,
    table: str,
    checkpoint_location: str,
    fmt: str = "parquet",
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    lenient: bool = False,
) -> StreamingQuery:
    """Start a stream from JSON Lines page files under ``landing_path``
    (one page per line) into table ``table``, appending raw film rows.

    ``available_now=True`` processes every file present at start and stops
    (a scheduled incremental run); ``False`` keeps the query running.
    ``lenient=True``: a page or element that cannot be read gives no row instead
    of failing the query (pair it with :func:`start_bad_page_capture`).
    """
    pages = _landed(spark, landing_path, max_files_per_trigger)
    return _start(ingest_films(pages, lenient=lenient), table, checkpoint_location, fmt,
                  available_now)


def start_bad_page_capture(
    spark: SparkSession,
    landing_path: str,
    table: str,
    checkpoint_location: str,
    fmt: str = "parquet",
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start a stream that appends the landed pages with anything that cannot
    be read to ``table``, each once, with the place and reason of each fault (the
    quarantine of a lenient :func:`start_page_ingest`)."""
    pages = _landed(spark, landing_path, max_files_per_trigger)
    return _start(faulty_pages(pages), table, checkpoint_location, fmt, available_now)
