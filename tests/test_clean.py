from helpers import raw_rows

from strata import catalogue as C
from strata.operators import clean


def test_filters_on_raw_values(spark):
    df = raw_rows(spark, [
        {"pelicula_id": "keep"},
        {"pelicula_id": "no_year", "anio_estreno": None},
        {"pelicula_id": "no_title", "titulo": None},
        {"pelicula_id": "few_votes", "num_votos": 9},
        {"pelicula_id": "null_votes", "num_votos": None},
        {"pelicula_id": "ten_votes", "num_votos": 10},
        {"pelicula_id": "blank", "titulo": "   "},
    ])
    got = {r[C.FILM_ID]: r[C.TITLE] for r in clean(df).collect()}
    assert got == {"keep": "t", "ten_votes": "t", "blank": ""}


def test_trim_round_and_date(spark):
    df = raw_rows(spark, [
        {"pelicula_id": "a", "titulo": "  x  ", "titulo_original": None, "popularidad": 1.005,
         "valoracion_media": 2.675, "fecha_estreno": "2020-13-45"},
        {"pelicula_id": "b", "titulo": "\tx ", "popularidad": 0.125, "fecha_estreno": "2021-02-03"},
    ])
    rows = {r[C.FILM_ID]: r for r in clean(df).collect()}
    a, b = rows["a"], rows["b"]
    assert (a[C.TITLE], a[C.ORIGINAL_TITLE]) == ("x", None)
    assert b[C.TITLE] == "\tx"          # only spaces are trimmed
    assert (a[C.POPULARITY], a[C.RATING], b[C.POPULARITY]) == (1.01, 2.68, 0.13)
    assert a[C.RELEASE_DATE] is None and str(b[C.RELEASE_DATE]) == "2021-02-03"


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw_rows(spark, [{"pelicula_id": "a"}]).write.parquet(path)
    plan = clean(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters:"):].split("]")[0]
    for predicate in ("GreaterThanOrEqual(num_votos,10)", "IsNotNull(anio_estreno)",
                      "IsNotNull(titulo)"):
        assert predicate in pushed
