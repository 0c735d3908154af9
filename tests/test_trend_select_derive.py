import datetime as dt

from helpers import raw_rows
from pyspark.sql import functions as F

from strata import catalogue as C
from strata.operators import discover, tenure_columns, yearly_trend


def test_yearly_trend_counts_non_null_and_rounds_means(spark):
    df = raw_rows(spark, [
        {"pelicula_id": "a", "anio_estreno": 2020, "valoracion_media": 1.0, "popularidad": 1.0, "num_votos": 10},
        {"pelicula_id": "b", "anio_estreno": 2020, "valoracion_media": 2.0, "popularidad": 2.333, "num_votos": 11},
        {"pelicula_id": "c", "anio_estreno": 2021, "valoracion_media": 3.0, "popularidad": 3.0, "num_votos": 30},
    ])
    got = {r[C.RELEASE_YEAR]: tuple(r) for r in yearly_trend(df).collect()}
    assert got[2020] == (2020, 2, 1.5, 1.67, 11.0)   # mean votes 10.5 rounds half up
    assert got[2021] == (2021, 1, 3.0, 3.0, 30.0)
    assert yearly_trend(df).columns == [C.RELEASE_YEAR, C.FILM_COUNT, C.RATING,
                                        C.MEAN_POPULARITY, C.MEAN_VOTES]


def test_discover_pages_exclusion_and_order(spark):
    rows = [(i, "it" if i % 2 else "fr", float(100 - i)) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, lang string, pop double")
    flagged = spark.createDataFrame([(1,), (3,)], "id int")
    out = discover(df, "lang", "it", "pop", "id", num_pages=2, page_size=5, exclude=flagged)
    got = [(r.id, r.position, r.page) for r in out.orderBy("position").collect()]
    ids = [i for i in range(60) if i % 2 and i not in (1, 3)][:10]
    assert [g[0] for g in got] == ids
    assert [g[1] for g in got] == list(range(1, 11))
    assert [g[2] for g in got] == [1] * 5 + [2] * 5


def test_discover_ties_break_on_key_and_nulls_last(spark):
    df = spark.createDataFrame([(3, "it", 1.0), (1, "it", 1.0), (2, "it", None), (4, "it", 2.0)],
                               "id int, lang string, pop double")
    out = discover(df, "lang", "it", "pop", "id", num_pages=1, page_size=20)
    assert [r.id for r in out.orderBy("position").collect()] == [4, 1, 3, 2]
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()


STAFF = [
    ("s-1", "Küche", dt.date(2018, 2, 28), 31250.0),
    ("s-2", None, dt.date(2024, 12, 31), 60000.5),
    ("s-3", "entrepôt", dt.date(2018, 2, 28), 0.0),
]
STAFF_SCHEMA = (f"{C.EMPLOYEE_ID} string, {C.DEPARTMENT} string, {C.HIRE_DATE} date, "
                f"{C.SALARY} double")


def test_tenure_golden_rows(spark):
    df = spark.createDataFrame(STAFF, STAFF_SCHEMA).withColumn("desk", F.lit(4))
    out = {r[C.EMPLOYEE_ID]: r for r in tenure_columns(df, as_of="2025-03-01").collect()}
    one, two, three = out["s-1"], out["s-2"], out["s-3"]
    assert (one[C.HIRE_YEAR], one[C.HIRE_MONTH]) == (2018, 2)
    assert (one[C.DAYS_EMPLOYED], one[C.YEARS_EMPLOYED]) == (2558, 7.0)
    assert one[C.ANNUAL_SALARY] == 375000.0 and one[C.DEPARTMENT] == "KÜCHE"
    assert two[C.DEPARTMENT] is None and two[C.DAYS_EMPLOYED] == 60 and two[C.YEARS_EMPLOYED] == 0.2
    assert three[C.DEPARTMENT] == "ENTREPÔT" and three[C.ANNUAL_SALARY] == 0.0
    assert tenure_columns(df, as_of="2025-03-01").columns == [
        C.EMPLOYEE_ID, C.DEPARTMENT, C.HIRE_DATE, C.SALARY, "desk",
        C.HIRE_YEAR, C.HIRE_MONTH, C.DAYS_EMPLOYED, C.YEARS_EMPLOYED, C.ANNUAL_SALARY]


def test_tenure_defaults_to_today(spark):
    df = spark.createDataFrame(STAFF[:1], STAFF_SCHEMA)
    days = tenure_columns(df).collect()[0][C.DAYS_EMPLOYED]
    assert days == (dt.date.today() - dt.date(2018, 2, 28)).days or days > 2500


def test_exact_mean_ties_round_half_away_from_zero(spark):
    from strata.operators.trend import exact_mean
    rows = [("a", 4.92), ("a", 4.93), ("b", -4.92), ("b", -4.93), ("c", 2.0), ("c", 3.0),
            ("d", -1.0), ("d", 0.0), ("e", None), ("f", 0.1), ("f", 0.2), ("f", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    got = {r.g: (r.m2, r.m0) for r in df.groupBy("g").agg(
        exact_mean("x", 2, 2).alias("m2"), exact_mean("x", 0, 2).alias("m0")).collect()}
    assert got == {"a": (4.93, 5.0), "b": (-4.93, -5.0), "c": (2.5, 3.0), "d": (-0.5, -1.0),
                   "e": (None, None), "f": (0.15, 0.0)}


def test_exact_mean_does_not_depend_on_partitioning(spark):
    from strata.operators.trend import exact_mean
    values = [round(0.01 * i, 2) for i in range(1, 400)] + [4.925 * 2 - 0.01]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    results = {df.repartition(n).agg(exact_mean("x", 2, 2).alias("m")).first().m for n in (1, 3, 7, 16)}
    assert len(results) == 1


def test_means_equal_rounded_averages_on_any_values(spark):
    """Special, large and unrounded values: the same as round(avg)."""
    nan, inf = float("nan"), float("inf")
    groups = [[nan, 1.0], [inf, 1.0], [1e18, 1e18], [1e40, 1.0], [1.004, 1.004, 1.009], [-inf, inf],
              [0.1, 0.2, None], [None, None], [1e300, 1e300], [-2.5, -2.5], [123456.78, 0.01]]
    rows = [{"pelicula_id": f"{g}-{i}", "anio_estreno": 1900 + g, "valoracion_media": v,
             "popularidad": v, "num_votos": None if v is None else 3} for g, vs in enumerate(groups)
            for i, v in enumerate(vs)]
    df = raw_rows(spark, rows).repartition(5)
    got = {r[C.RELEASE_YEAR]: r for r in yearly_trend(df).collect()}
    for r in df.groupBy(C.RELEASE_YEAR).agg(F.round(F.avg(C.RATING), 2).alias("m"),
                                            F.round(F.avg(C.VOTES), 0).alias("v")).collect():
        found = got[r[C.RELEASE_YEAR]]
        assert str(found[C.RATING]) == str(found[C.MEAN_POPULARITY]) == str(r.m)
        assert found[C.MEAN_VOTES] == r.v
