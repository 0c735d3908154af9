from pyspark.sql import functions as F

from strata.functions import (
    lenient_date,
    list_to_text,
    read_list,
    read_number,
    read_text,
    year_prefix,
)


def test_year_prefix(spark):
    df = spark.createDataFrame([("2020-05-01",), ("",), (None,), ("20x0-01-01",), ("99",)], "s string")
    got = [r[0] for r in df.select(year_prefix("s")).collect()]
    assert got == [2020, None, None, None, 99]


def test_lenient_date_keeps_malformed_as_null(spark):
    df = spark.createDataFrame([("2020-13-45",), ("2020-1-5",), ("",), ("2020-01-05",)], "s string")
    got = [r[0] for r in df.select(lenient_date("s", "yyyy-MM-dd")).collect()]
    assert [str(x) if x else None for x in got] == [None, None, None, "2020-01-05"]


def test_list_to_text(spark):
    df = spark.createDataFrame([([37, 18],), ([],), (None,)], "a array<int>")
    assert [r[0] for r in df.select(list_to_text("a")).collect()] == ["37,18", "", ""]


def test_variant_fields_missing_versus_null(spark):
    df = spark.createDataFrame(
        [('{"id":8}',), ('{"id":7,"title":null,"popularity":null,"genre_ids":null}',),
         ('{"id":6,"title":"x","popularity":1.5,"genre_ids":[3,4]}',)], "b string")
    v = F.parse_json("b")
    rows = df.select(read_text(v, "title", "").value.alias("t"),
                     read_number(v, "popularity", "double", 0.0).value.alias("p"),
                     read_list(v, "genre_ids", ",").value.alias("g")).collect()
    assert [tuple(r) for r in rows] == [("", 0.0, ""), (None, 0.0, ""), ("x", 1.5, "3,4")]
