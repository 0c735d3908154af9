"""Shared helpers of the training-data operators: table access, lineage cuts
through the shared checkpoint folder, and distributed prefix positions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.sources.files import Folder

# A word: a maximal run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table, read through Spark (the folder may be in any store)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder below ``spark.checkpoint.dir`` and read it
    back: later jobs (and retries after a lost executor) start from the files.
    Runs a job."""
    path = scratch_path(spark, f"llm-{name}")
    for held in _HELD[-1:]:
        held.append(path)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


#: Folders that :func:`stage` made inside each open :func:`spent`.
_HELD: list[list[str]] = []


@contextmanager
def spent(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Removes, at its end, the folders that :func:`stage` made inside it, but for
    those of the stages that were passed through the given function, which hands
    them back. Nothing else made inside may be read afterwards."""
    held: list[str] = []
    kept: set[str] = set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df.staged_at)
        return df

    _HELD.append(held)
    try:
        yield keep
    finally:
        _HELD.pop()
        for outer in _HELD[-1:]:
            outer.extend(kept)
        for path in held:
            if path not in kept:
                Folder(spark, path).delete()


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row. An expression named
    inside a lambda is computed anew for each element that the lambda sees."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fresh(df: DataFrame, name: str) -> str:
    """A helper column name that ``df`` does not use."""
    while name in df.columns:
        name = f"_{name}"
    return name


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, ASCII_UPPER, ASCII_LOWER)


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))
