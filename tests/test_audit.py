"""Profiles from file footers equal those from a scan."""

import datetime

import pytest

from strata.operators import footer_plan, profile_files, profile_range


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("profiled"))
    df = spark.range(1000).selectExpr(
        "cast(id % 37 as int) as n", "id * 3 as big", "id / 7 as x", "date_add(date'2001-01-01', cast(id as int)) as day",
        "concat('t', id % 91) as t", "if(id % 2 = 0, null, cast(id as int)) as half", "cast(null as int) as none")
    for fmt in ("parquet", "orc"):
        df.repartition(5).write.format(fmt).save(f"{base}/{fmt}")
    return base, df


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
@pytest.mark.parametrize("col", ["n", "big", "x", "day", "t", "half", "none"])
def test_footers_equal_the_scan(spark, files, fmt, col):
    base, df = files
    got = profile_files(spark, f"{base}/{fmt}", col, fmt)
    want = profile_range(df, col)
    assert got.schema == want.schema and got.collect() == want.collect()


def test_the_plan_pushes_the_aggregate_and_settings_are_put_back(spark, files):
    base, _ = files
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    plan = footer_plan(spark, f"{base}/parquet", "n")
    assert "PushedAggregation: [COUNT(*), MIN(n), MAX(n)]" in plan
    assert "PushedAggregation: []" in footer_plan(spark, f"{base}/parquet", "t")
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    assert profile_files(spark, f"{base}/parquet", "day").first()["max_day"] == datetime.date(2003, 9, 27)


def test_empty_files(spark, tmp_path):
    spark.range(0).write.parquet(f"{tmp_path}/none")
    assert tuple(profile_files(spark, f"{tmp_path}/none", "id").first()) == (0, None, None)
