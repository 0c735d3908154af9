"""Catalogue-shaped inputs derived from the driver's tables.

Every derivation reads a whole driver table and keeps every row; the modulo
expressions only shape values (blanks, nulls, unknown codes), never select
rows. Each has a twin in SQL (see ``__spark_entry__.py``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import catalogue as C
from strata.sources.tables import read_parquet_table


def _key(orders: DataFrame):
    return F.col("o_orderkey")


def _day_text(ts):
    """yyyy-MM-dd of a timestamp_ntz without going through the session time zone."""
    return ts.cast("date").cast("string")


def raw_catalog(orders: DataFrame) -> DataFrame:
    """One raw film row per order."""
    k = _key(orders)
    missing_date = (k % 13) == 0
    return orders.select(
        k.cast("string").alias(C.FILM_ID),
        F.concat(F.lit("  Order "), (k % 500).cast("string"), F.lit(" ")).alias(C.TITLE),
        F.when((k % 11) == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit(" "), F.col("o_orderstatus"))).alias(C.ORIGINAL_TITLE),
        F.when(missing_date, F.lit(""))
         .otherwise(_day_text(F.col("o_orderdate"))).alias(C.RELEASE_DATE),
        F.when(missing_date, F.lit(None).cast("int"))
         .otherwise(F.year(F.col("o_orderdate").cast("date"))).alias(C.RELEASE_YEAR),
        (F.col("o_totalprice") / 7).alias(C.POPULARITY),
        ((k % 701) / 70).alias(C.RATING),
        (k % 100).cast("int").alias(C.VOTES),
        F.col("o_orderstatus").alias(C.LANGUAGE),
        F.col("o_orderpriority").alias(C.OVERVIEW),
        F.concat_ws(",", (F.col("o_custkey") % 25).cast("string"), (k % 30).cast("string"),
                    ((k * 7) % 25).cast("string")).alias(C.CODES),
    )


def code_dictionary(nation: DataFrame) -> DataFrame:
    """Code dictionary: nation key as code, nation name as its name."""
    return nation.select(
        F.col("n_nationkey").cast("string").alias(C.CODE_ID),
        F.col("n_name").alias(C.CODE_NAME),
    )


def film_pages(orders: DataFrame, page_size: int = C.PAGE_SIZE) -> DataFrame:
    """Orders as landed result pages of ``page_size`` elements, one JSON text
    per page. Some elements lack a field, others carry an explicit JSON null.

    Grouping is by ``o_orderkey div page_size``: every group has at most
    ``page_size`` rows, whatever the data size.
    """
    k = _key(orders)
    explicit_nulls = ((k % 19) == 0) & ((k % 17) != 0)
    element = F.struct(
        k.alias("id"),
        F.when(((k % 17) == 0) | ((k % 19) == 0), F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("  Order "), (k % 500).cast("string"), F.lit(" ")))
         .alias("title"),
        F.concat(F.lit(" "), F.col("o_orderstatus")).alias("original_title"),
        F.when((k % 13) == 0, F.lit(""))
         .otherwise(_day_text(F.col("o_orderdate"))).alias("release_date"),
        F.when((k % 23) == 0, F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice") / 7).alias("popularity"),
        ((k % 701) / 70).alias("vote_average"),
        (k % 100).cast("int").alias("vote_count"),
        F.col("o_orderstatus").alias("original_language"),
        F.col("o_orderpriority").alias("overview"),
        F.when((k % 31) == 0, F.lit(None).cast("array<int>"))
         .when((k % 29) == 0, F.array().cast("array<int>"))
         .otherwise(F.array((F.col("o_custkey") % 25).cast("int"), (k % 30).cast("int"),
                            ((k * 7) % 25).cast("int")))
         .alias("genre_ids"),
    )
    # By default to_json leaves out null fields: those elements lack the field.
    text = F.when(explicit_nulls, F.to_json(element, {"ignoreNullFields": "false"})) \
            .otherwise(F.to_json(element))
    page = F.expr(f"o_orderkey div {int(page_size)}") + 1
    grouped = orders.groupBy(page.alias("page")).agg(F.collect_list(text).alias("items"))
    return grouped.select(
        F.concat(F.lit('{"page":'), F.col("page").cast("string"),
                 F.lit(f',"{C.RESULTS_FIELD}":['), F.array_join("items", ","), F.lit("]}"))
        .alias("body"))


def dictionary_pages(nation: DataFrame, page_size: int = C.PAGE_SIZE) -> DataFrame:
    """Nations as landed dictionary pages of at most ``page_size`` entries."""
    entry = F.struct(F.col("n_nationkey").alias(C.DICTIONARY_ID_FIELD),
                     F.col("n_name").alias(C.DICTIONARY_NAME_FIELD))
    return nation.groupBy(F.expr(f"n_nationkey div {int(page_size)}")).agg(
        F.to_json(F.struct(F.collect_list(entry).alias(C.DICTIONARY_FIELD))).alias("body")
    ).select("body")


def employees(orders: DataFrame) -> DataFrame:
    """Orders as an employee table: hire date, salary and department."""
    return orders.select(
        F.col("o_orderkey").cast("string").alias(C.EMPLOYEE_ID),
        F.col("o_orderpriority").alias(C.DEPARTMENT),
        F.col("o_orderdate").cast("date").alias(C.HIRE_DATE),
        F.col("o_totalprice").alias(C.SALARY),
    )


class DriverTables:
    """Lazy access to the driver's parquet tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return read_parquet_table(self.spark, self.sf_dir, name)

    @property
    def orders(self) -> DataFrame:
        return self.table("orders")

    @property
    def nation(self) -> DataFrame:
        return self.table("nation")

    @property
    def documents(self) -> DataFrame:
        return self.table("documents")

    @property
    def labels(self) -> DataFrame:
        return self.table("labels")

    def raw_catalog(self) -> DataFrame:
        return raw_catalog(self.orders)

    def code_dictionary(self) -> DataFrame:
        return code_dictionary(self.nation)

    def film_pages(self) -> DataFrame:
        return film_pages(self.orders)

    def dictionary_pages(self) -> DataFrame:
        return dictionary_pages(self.nation)

    def employees(self) -> DataFrame:
        return employees(self.orders)
