"""Join-side sizing: broadcast a side only behind a check of its size."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from strata.session import scratch_path

# Default bounds for a broadcast side: a few hundred thousand narrow rows,
# at most 64 MB of column data, per executor.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
FIXED_WIDTH_BYTES = 8   # estimate for a non-text column value
TAKE_ROWS = 250_000     # row bounds up to here are checked with an early-stopping take


def _value_bytes(name: str, dtype) -> Column:
    if isinstance(dtype, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(F.col(name)), F.lit(0))
    if isinstance(dtype, (ArrayType, MapType, StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.col(name))), F.lit(0))
    return F.lit(FIXED_WIDTH_BYTES)


def _row_bytes(df: DataFrame) -> Column:
    sizes = [_value_bytes(f.name, f.dataType) for f in df.schema.fields]
    total = sizes[0]
    for size in sizes[1:]:
        total = total + size
    return total


def fits(df: DataFrame, max_rows: int, max_bytes: int | None = None) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (and, if given, at most
    ``max_bytes`` of column data: text by its length, nested values by the
    length of their JSON text, other values 8 bytes).

    Up to ``TAKE_ROWS`` the row check is an incremental take of column-less
    rows (``limit(n).collect()``): Spark scans one partition, then more, and
    stops once ``max_rows + 1`` rows exist, so a large input costs a few
    partitions and at most ``max_rows + 1`` empty rows reach the driver.
    Larger bounds use ``count()``: a full pass, but each task sends one
    partial count. (``limit(n).count()`` is avoided: every partition would
    ship up to n rows into one task.) The byte sum runs only once the row
    bound holds, over at most ``max_rows`` rows.
    """
    if max_rows <= TAKE_ROWS:
        small = len(df.select().limit(max_rows + 1).collect()) <= max_rows
    else:
        small = df.count() <= max_rows
    if not small or max_bytes is None or not df.columns:
        return small
    size = df.agg(F.sum(_row_bytes(df)).alias("bytes")).first()["bytes"]
    return (size or 0) <= max_bytes


def sized_broadcast(
    df: DataFrame,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``broadcast(df)`` when its size is within both bounds; otherwise ``df``
    unchanged, so the join is planned as a shuffle join, where AQE splits
    skewed partitions at run time."""
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df


class Stored(NamedTuple):
    """A written intermediate result with its size, counted by the write."""

    df: DataFrame
    rows: int
    bytes: int

    def broadcast(self, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
        """:func:`sized_broadcast` without a job of its own."""
        return F.broadcast(self.df) if self.rows <= max_rows and self.bytes <= max_bytes else self.df


def stored(df: DataFrame, name: str) -> Stored:
    """Write ``df`` to a new folder below the shared checkpoint folder and read
    it back, measured in the same job. So a side whose size decides a plan is
    computed once, and not again for each check and for the join."""
    seen, path = Observation(), scratch_path(df.sparkSession, name)
    df.observe(seen, F.count(F.lit(1)).alias("rows"),
               F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("bytes")).write.parquet(path)
    return Stored(df.sparkSession.read.schema(df.schema).parquet(path),
                  int(seen.get["rows"]), int(seen.get["bytes"]))
