"""Clean step: quality filters, trimming, rounding and tolerant date parsing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import catalogue as C
from strata.functions import lenient_date


def clean(
    df: DataFrame,
    required_cols: Sequence[str] = (C.RELEASE_YEAR, C.TITLE),
    threshold_col: str = C.VOTES,
    min_value: int = C.MIN_VOTES,
    trim_cols: Sequence[str] = (C.TITLE, C.ORIGINAL_TITLE),
    round_cols: Sequence[str] = (C.POPULARITY, C.RATING),
    digits: int = C.ROUND_DIGITS,
    date_col: str | None = C.RELEASE_DATE,
    date_format: str = C.DATE_FORMAT,
) -> DataFrame:
    """Keep rows that have every ``required_cols`` value and at least
    ``min_value`` in ``threshold_col``; then trim text, round numbers (half
    up) and parse the date text.

    Filters run on the raw values, before trimming: a blank title passes the
    null check and comes out as ''. A malformed date becomes null rather than
    failing the job. Catalyst folds the filters into one predicate that
    reaches the parquet scan, and the column rewrites into one projection.
    """
    keep = F.col(threshold_col) >= F.lit(min_value)
    for name in required_cols:
        keep = keep & F.col(name).isNotNull()
    rewrites = {name: F.trim(F.col(name)) for name in trim_cols}
    rewrites.update({name: F.round(F.col(name), digits) for name in round_cols})
    if date_col is not None:
        rewrites[date_col] = lenient_date(date_col, date_format)
    return df.filter(keep).withColumns(rewrites)
