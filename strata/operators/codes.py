"""Resolve a delimited code list (``"37,18"``) to readable names.

Both forms resolve each *distinct* code text once and bring the names back by
an equi-join on the text, whatever the length of a list and the size of the
dictionary. Rows are never multiplied by their number of codes.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import catalogue as C
from strata.operators.joins import BROADCAST_ROWS, sized_broadcast, stored


def resolved_texts(
    texts: DataFrame,
    dictionary: DataFrame,
    codes_col: str = C.CODES,
    code_col: str = C.CODE_ID,
    name_col: str = C.CODE_NAME,
    code_separator: str = C.CODE_SEPARATOR,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``codes_col, _parts`` per distinct non-null code text: its names as
    ``(pos, name)`` in order. A text without any known code has no row.

    The dictionary is broadcast behind its size check (which runs jobs on the
    dictionary), else joined by shuffle. One text's codes meet in one group,
    bounded by the text itself.
    """
    parts = F.split(F.col(codes_col), re.escape(code_separator))
    codes = (texts.select(codes_col).where(F.col(codes_col).isNotNull()).distinct()
             .select(codes_col, F.posexplode(parts).alias("_pos", "_code"))
             .select(codes_col, "_pos", F.trim("_code").alias(code_col)))
    names = sized_broadcast(dictionary.select(code_col, name_col), broadcast_rows)
    found = codes.join(names, on=code_col).where(F.col(name_col).isNotNull())
    return found.groupBy(codes_col).agg(F.sort_array(F.collect_list(
        F.struct(F.col("_pos").alias("pos"), F.col(name_col).alias("name")))).alias("_parts"))


def resolve_codes(
    rows: DataFrame,
    dictionary: DataFrame,
    codes_col: str = C.CODES,
    key_cols: Sequence[str] = C.SILVER_KEY,
    code_col: str = C.CODE_ID,
    name_col: str = C.CODE_NAME,
    out_col: str = C.NAMES,
    separator: str = C.NAME_SEPARATOR,
    code_separator: str = C.CODE_SEPARATOR,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Replace ``codes_col`` by the names of its codes, joined by ``separator``.

    Semantics, one by one:

    * codes are split on ``code_separator`` and trimmed; each is looked up in
      the dictionary with a left join, so an unknown code adds no name and a
      code listed twice in the dictionary adds both names;
    * an empty code list gives ``''``; a null code list drops the row;
    * rows are regrouped on ``key_cols``: rows equal on all of them merge and
      their names add up (two identical rows ``"18,35"`` give
      ``"Drama, Drama, Comedia, Comedia"``); nothing is de-duplicated;
    * names come out in code-list order (position, then name), so the text
      does not depend on how the shuffle ordered the rows.

    Plan, built so that copies of one row never pile up in one task:

    1. identical rows (key columns and code list) are counted with a map-side
       combine, so a group of copies holding a third of all rows leaves each
       task as one row;
    2. the distinct code texts are resolved once (:func:`resolved_texts`), written
       and measured in one job;
    3. their names join back on the text: broadcast when few, else a shuffle
       join that Spark can split at a hot text;
    4. the regroup on ``key_cols`` gathers one entry per distinct code list of
       a key; names are repeated ``copies`` times only in the last projection.
    """
    distinct = (rows.filter(F.col(codes_col).isNotNull())
                .groupBy(*key_cols, codes_col).agg(F.count(F.lit(1)).alias("_copies")))
    names = stored(resolved_texts(rows, dictionary, codes_col, code_col, name_col, code_separator,
                                  broadcast_rows), "resolved-texts")
    joined = distinct.join(names.broadcast(broadcast_rows), on=codes_col, how="left")
    entry = F.struct(F.col("_parts").alias("parts"), F.col("_copies").alias("copies"))
    grouped = joined.groupBy(*key_cols).agg(F.collect_list(entry).alias("_entries"))
    parts = F.flatten(F.transform("_entries", lambda e: F.transform(
        F.coalesce(e["parts"], F.array().cast("array<struct<pos:int,name:string>>")),
        lambda p: F.struct(p["pos"].alias("pos"), p["name"].alias("name"),
                           e["copies"].alias("copies")))))
    repeated = F.flatten(F.transform(
        F.sort_array(parts), lambda p: F.array_repeat(p["name"], p["copies"].cast("int"))))
    return grouped.select(*key_cols, F.concat_ws(separator, repeated).alias(out_col))


def resolve_codes_by_position(
    rows: DataFrame,
    dictionary: DataFrame,
    codes_col: str = C.CODES,
    keep_cols: Sequence[str] = C.SILVER_KEY,
    code_col: str = C.CODE_ID,
    name_col: str = C.CODE_NAME,
    out_col: str = C.NAMES,
    separator: str = C.NAME_SEPARATOR,
    code_separator: str = C.CODE_SEPARATOR,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """:func:`resolve_codes` row by row: every row with a non-null code list
    gives one row, equal rows stay apart. On rows that are unique on
    ``keep_cols`` both forms agree.

    The rows themselves are not regrouped: only the distinct code texts are
    shuffled, and their names join back on the text (broadcast when few, else
    a shuffle join). The same at every list length and dictionary size.
    """
    names = stored(resolved_texts(rows, dictionary, codes_col, code_col, name_col, code_separator,
                                  broadcast_rows), "resolved-texts")
    joined = rows.filter(F.col(codes_col).isNotNull()).select(*keep_cols, codes_col).join(
        names.broadcast(broadcast_rows), on=codes_col, how="left")
    text = F.concat_ws(separator, F.transform("_parts", lambda p: p["name"]))
    return joined.select(*keep_cols, text.alias(out_col))
