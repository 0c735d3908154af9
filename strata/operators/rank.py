"""Global competition rank (ties share a rank, gaps follow) and top-n.

``rank() OVER (ORDER BY v DESC)`` without a partition key runs in a single
task. :func:`global_rank` computes the same numbers without that limit:

    rank(v) = 1 + number of rows whose value sorts before v

1. count rows per distinct value (a map-side combine, so a value shared by a
   third of all rows becomes one row), range-partition the counts by value,
   descending, and write them with their partition number to the shared
   checkpoint folder, measured by the same job;
2. a running sum inside each range gives the rows before a value there, and
   the range totals (one row per range) the rows in earlier ranges;
3. the ranked values go back to the rows on the value (null-safe). When all
   distinct values are within the broadcast bounds (rows and bytes) they go by
   broadcast; else values with more than half an even partition share do (at most
   twice as many as there are partitions, and only within the byte bound), the
   others by a shuffle join that no hot value takes part in.

Any orderable type ranks. Order follows Spark's ``desc``: NaN first, nulls
last; NaN equals NaN. Ranks are ``bigint``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata import catalogue as C
from strata.operators.joins import BROADCAST_BYTES, fits, stored

VALUE_BROADCAST_ROWS = 1_000_000   # ranked values (one value and one rank each)


def rank_window(df: DataFrame, order_col: str, out_col: str = C.RANK) -> DataFrame:
    """The plain form: one window over the whole table, in one task. It is the
    yardstick of the tests and of ``tools/rank_crossover.py``, not a plan for
    tables that grow."""
    return df.withColumn(out_col, F.rank().over(Window.orderBy(F.col(order_col).desc()))
                         .cast("long"))


def _default_ranges(df: DataFrame) -> int:
    setting = df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")
    return max(2, int(setting) if str(setting).isdigit() else 200)


def global_rank(
    df: DataFrame,
    order_col: str = C.POPULARITY,
    out_col: str = C.RANK,
    ranges: int | None = None,
    broadcast_rows: int = VALUE_BROADCAST_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``df`` with the competition rank of ``order_col`` descending.

    Runs a job (it writes the counts) and reads ``df`` again for the join back,
    twice when there are more distinct values than ``broadcast_rows`` or more
    bytes of them than ``broadcast_bytes``: give it a stored table where
    computing it is dear. ``ranges`` (default: the shuffle partitions) only
    shapes the work.
    """
    value = F.col(order_col)
    k = max(2, ranges or _default_ranges(df))
    counted = (df.groupBy(order_col).agg(F.count(F.lit(1)).alias("_n"))
               .repartitionByRange(k, value.desc()).withColumn("_p", F.spark_partition_id()))
    counts, distinct_values, value_bytes = stored(counted, "rank-counts")

    before = (Window.partitionBy("_p").orderBy(value.desc())
              .rowsBetween(Window.unboundedPreceding, -1))
    earlier = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.groupBy("_p").agg(F.sum("_n").alias("_t"))         # one row per range
               .select("_p", F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_off")))
    ranked = (counts.withColumn("_w", F.coalesce(F.sum("_n").over(before), F.lit(0)))
              .join(F.broadcast(offsets), "_p")
              .select(value.alias("_v"), (F.col("_off") + F.col("_w") + 1).alias(out_col), "_n"))

    def back(rows: DataFrame, ranks: DataFrame, how: str = "inner") -> DataFrame:
        return rows.join(ranks, rows[order_col].eqNullSafe(ranks["_v"]), how)

    if distinct_values <= broadcast_rows and value_bytes <= broadcast_bytes:
        return back(df, F.broadcast(ranked.drop("_n"))).drop("_v")
    rows = counts.agg(F.sum("_n")).first()[0]
    hot_limit = max(1, rows // (2 * k))                     # at most 2k values exceed it
    hot = ranked.where(F.col("_n") > hot_limit).drop("_n")
    if not fits(hot.select("_v"), 2 * k, broadcast_bytes):
        return back(df, ranked.drop("_n")).drop("_v")       # large values: AQE splits hot partitions
    cold = ranked.where(F.col("_n") <= hot_limit).drop("_n")
    rest = back(df, F.broadcast(hot.select("_v")), "left_anti")
    return back(df, F.broadcast(hot)).drop("_v").union(back(rest, cold).drop("_v"))


def top_ranked(
    df: DataFrame,
    n: int,
    order_col: str,
    tie_order: Sequence[Column] = (),
    out_col: str = C.RANK,
) -> DataFrame:
    """The first ``n`` rows of the ranking of ``order_col`` (descending),
    ordered by rank and then ``tie_order``, with their global ranks.

    No global rank is needed: every row that ranks before a row of the top
    ``n`` sorts before it, so it is among the top ``n`` too, and ranking the
    ``n`` rows gives the global ranks. Planned as one TakeOrderedAndProject
    (top ``n`` per task) and a rank over at most ``n`` rows.
    """
    value = F.col(order_col).desc()
    top = df.orderBy(value, *tie_order).limit(n)
    return top.withColumn(out_col, F.rank().over(Window.orderBy(value)).cast("long"))


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """First ``n`` rows by ``order`` (planned as one TakeOrderedAndProject:
    each task keeps its own top n; one final step merges n rows per task)."""
    return df.orderBy(*order).limit(n)
