"""Catalogue selection: one language, no flagged titles, most popular first,
cut into numbered pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata import catalogue as C
from strata.operators.joins import sized_broadcast


def discover(
    df: DataFrame,
    language_col: str,
    language: str,
    popularity_col: str,
    key_col: str,
    num_pages: int = C.NUM_PAGES,
    page_size: int = C.PAGE_SIZE,
    exclude: DataFrame | None = None,
    page_col: str = "page",
    position_col: str = "position",
) -> DataFrame:
    """The first ``num_pages`` pages of ``page_size`` rows in ``language``,
    ordered by popularity (descending, nulls last) and then by key.

    ``exclude`` holds keys to leave out (e.g. titles flagged adult); it is
    applied as an anti join before the cut, so excluded rows are replaced by
    the next ones (broadcast when its size check passes, else a shuffle
    join). The cut is a TakeOrderedAndProject: every task keeps its own top
    rows, so no exchange moves the whole input to one partition; the
    position and page numbers are computed after the cut, on at most
    ``num_pages * page_size`` rows.
    """
    order = [F.col(popularity_col).desc_nulls_last(), F.col(key_col).asc_nulls_last()]
    chosen = df.filter(F.col(language_col) == F.lit(language))
    if exclude is not None:
        keys = sized_broadcast(exclude.select(key_col))
        chosen = chosen.join(keys, on=key_col, how="left_anti")
    top = chosen.orderBy(*order).limit(num_pages * page_size)
    position = F.row_number().over(Window.orderBy(*order))
    return top.withColumn(position_col, position).withColumn(
        page_col, (F.floor((F.col(position_col) - 1) / page_size) + 1).cast("int"))
