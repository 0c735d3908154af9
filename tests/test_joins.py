from strata.operators.joins import fits, sized_broadcast


def test_fits_checks_rows_and_bytes(spark):
    df = spark.createDataFrame([(i, "x" * 100) for i in range(50)], "k int, name string")
    assert fits(df, 50) and not fits(df, 49)
    assert fits(df, 50, max_bytes=50 * 108) and not fits(df, 50, max_bytes=50 * 108 - 1)


def test_sized_broadcast_hint_only_within_bounds(spark):
    small = spark.createDataFrame([(1, "a")], "k int, v string")
    big = spark.range(1000).selectExpr("id as k", "repeat('x', 1000) as v")
    rows = spark.range(10).selectExpr("id as k")
    hinted = rows.join(sized_broadcast(small), "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in hinted.lower()
    plain = rows.join(sized_broadcast(big, max_bytes=1024), "k")._jdf.queryExecution().optimizedPlan()
    assert "strategy=broadcast" not in plain.toString().lower()


def test_nested_values_count_by_their_json_length(spark):
    df = spark.createDataFrame([(1, ["Drama", "Dramma"])], "k int, names array<string>")
    assert fits(df, 1, max_bytes=8 + len('["Drama","Dramma"]'))
    assert not fits(df, 1, max_bytes=8 + len('["Drama","Dramma"]') - 1)
