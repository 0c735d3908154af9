"""Declared schemas of the ingest tables, which the ingest is checked against
(the later layers are derived)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from strata import catalogue as C

RAW_FILMS = StructType([
    StructField(C.FILM_ID, StringType(), False),
    StructField(C.TITLE, StringType(), True),
    StructField(C.ORIGINAL_TITLE, StringType(), True),
    StructField(C.RELEASE_DATE, StringType(), True),
    StructField(C.RELEASE_YEAR, IntegerType(), True),
    StructField(C.POPULARITY, DoubleType(), True),
    StructField(C.RATING, DoubleType(), True),
    StructField(C.VOTES, IntegerType(), True),
    StructField(C.LANGUAGE, StringType(), True),
    StructField(C.OVERVIEW, StringType(), True),
    StructField(C.CODES, StringType(), True),
])

RAW_CODES = StructType([
    StructField(C.CODE_ID, StringType(), False),
    StructField(C.CODE_NAME, StringType(), False),
])


def conforming(df: DataFrame, schema: StructType) -> DataFrame:
    """``df``, once its column names and types are those of ``schema``.
    (Mandatory values are checked row by row where they are read.)"""
    found = [(f.name, f.dataType) for f in df.schema]
    wanted = [(f.name, f.dataType) for f in schema]
    if found != wanted:
        raise TypeError(f"ingest gives {found}, the raw table has {wanted}")
    return df
