"""Per-group summary: count and rounded means (yearly trend)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import catalogue as C

# (column, alias, output digits, decimals carried by the values)
TREND_MEANS = (
    (C.RATING, C.RATING, C.ROUND_DIGITS, C.ROUND_DIGITS),
    (C.POPULARITY, C.MEAN_POPULARITY, C.ROUND_DIGITS, C.ROUND_DIGITS),
    (C.VOTES, C.MEAN_VOTES, C.VOTES_DIGITS, 0),
)


def exact_mean(col: str, digits: int, value_digits: int) -> Column:
    """``round(avg(col), digits)``, without the summation order where it matters.

    Where all values of a group carry at most ``value_digits`` decimals, they
    are summed exactly as integer units in a decimal(38, 0), and the mean is
    rounded half up (away from zero) by the exact remainder. A double ``avg``
    instead depends on the order of summation, i.e. on partitioning: a mean
    that sits exactly on a rounding tie (4.925) then comes out as 4.92 on one
    layout and 4.93 on another. A group with any other value (NaN, infinite,
    more decimals, too large for the decimal) gets the plain ``round(avg)``.
    """
    if digits > value_digits:
        raise ValueError("digits must not exceed value_digits")
    unit, step = 10 ** value_digits, 10 ** (value_digits - digits)
    plain = f"round(avg(`{col}`), {digits})"
    units = f"try_cast(round(`{col}` * {unit}) AS DECIMAL(38, 0))"
    carried = f"(round(cast(`{col}` AS DOUBLE), {value_digits}) = `{col}` AND {units} IS NOT NULL)"
    total, n = f"try_sum({units})", f"count(`{col}`)"
    part = f"(CAST({step} AS DECIMAL(10, 0)) * CAST({n} AS DECIMAL(20, 0)))"
    rest = f"(abs({total}) % {part})"
    whole = f"((abs({total}) - {rest}) / {part} + CASE WHEN 2 * {rest} >= {part} THEN 1 ELSE 0 END)"
    exact = f"CAST(sign({total}) AS DOUBLE) * CAST({whole} AS DOUBLE) / {10 ** digits}"
    return F.expr(f"CASE WHEN {n} = 0 THEN NULL "
                  f"WHEN count_if({carried}) = {n} AND {total} IS NOT NULL THEN {exact} "
                  f"ELSE {plain} END")


def yearly_trend(
    df: DataFrame,
    group_col: str = C.RELEASE_YEAR,
    count_col: str = C.FILM_ID,
    means=TREND_MEANS,
    count_alias: str = C.FILM_COUNT,
) -> DataFrame:
    """One row per ``group_col`` value: non-null count of ``count_col`` and,
    for each ``(column, alias, digits, value_digits)``, the mean rounded to
    ``digits`` (see :func:`exact_mean`; ``value_digits=None``: always the plain
    ``round(avg(column), digits)``).

    Planned as partial + final hash aggregation: each task pre-aggregates, so a
    group holding a third of all rows still moves one row per task.
    """
    aggs = [F.count(F.col(count_col)).alias(count_alias)]
    for name, alias, digits, value_digits in means:
        mean = (F.round(F.avg(F.col(name)), digits) if value_digits is None
                else exact_mean(name, digits, value_digits))
        aggs.append(mean.alias(alias))
    return df.groupBy(group_col).agg(*aggs)
