import random

from helpers import raw_rows

from strata import catalogue as C
from strata.operators import resolve_codes


def dictionary(spark, pairs=(("18", "Drama"), ("35", "Comedia"), ("28", "Azione"))):
    return spark.createDataFrame(list(pairs), "genero_id string, genero_nombre string")


def names(df):
    return sorted((r[C.FILM_ID], r[C.NAMES]) for r in df.collect())


def test_resolves_in_list_order(spark):
    films = raw_rows(spark, [{"pelicula_id": "a", "genero_ids": "35,18"},
                             {"pelicula_id": "b", "genero_ids": "18, 35"},
                             {"pelicula_id": "c", "genero_ids": "28,35,18"}])
    assert names(resolve_codes(films, dictionary(spark))) == [
        ("a", "Comedia, Drama"), ("b", "Drama, Comedia"), ("c", "Azione, Comedia, Drama")]


def test_empty_null_and_unknown_codes(spark):
    films = raw_rows(spark, [{"pelicula_id": "empty", "genero_ids": ""},
                             {"pelicula_id": "null", "genero_ids": None},
                             {"pelicula_id": "unknown", "genero_ids": "18,99"},
                             {"pelicula_id": "none_known", "genero_ids": "98,99"}])
    assert names(resolve_codes(films, dictionary(spark))) == [
        ("empty", ""), ("none_known", ""), ("unknown", "Drama")]


def test_identical_rows_merge_and_names_add_up(spark):
    films = raw_rows(spark, [{"pelicula_id": "t", "genero_ids": "18,35"}] * 2)
    assert names(resolve_codes(films, dictionary(spark))) == [
        ("t", "Drama, Drama, Comedia, Comedia")]


def test_rows_differing_in_a_key_column_stay_apart(spark):
    films = raw_rows(spark, [{"pelicula_id": "t", "popularidad": 1.0},
                             {"pelicula_id": "t", "popularidad": 2.0}])
    assert len(resolve_codes(films, dictionary(spark)).collect()) == 2


def test_duplicate_dictionary_id_fans_out(spark):
    films = raw_rows(spark, [{"pelicula_id": "a", "genero_ids": "18"}])
    d = dictionary(spark, (("18", "Drama"), ("18", "Dramma")))
    assert names(resolve_codes(films, d)) == [("a", "Drama, Dramma")]


def test_order_does_not_depend_on_input_order(spark):
    rng = random.Random(7)
    rows = [{"pelicula_id": str(i % 5), "genero_ids": ",".join(rng.choice(["18", "35", "28", "99"])
                                                         for _ in range(rng.randint(0, 4)))}
            for i in range(40)]
    expected = names(resolve_codes(raw_rows(spark, rows), dictionary(spark)))
    for _ in range(3):
        rng.shuffle(rows)
        shuffled = raw_rows(spark, rows).repartition(7)
        assert names(resolve_codes(shuffled, dictionary(spark))) == expected


def test_shuffle_join_path_equals_broadcast_path(spark):
    films = raw_rows(spark, [{"pelicula_id": str(i), "genero_ids": "28,18,35"[: 1 + i % 8]}
                             for i in range(30)])
    assert names(resolve_codes(films, dictionary(spark), broadcast_rows=0)) == \
        names(resolve_codes(films, dictionary(spark)))


def test_rows_are_not_multiplied_by_their_codes(spark):
    from strata.operators.codes import resolved_texts
    films = raw_rows(spark, [{"pelicula_id": "a"}])
    plan = resolved_texts(films, dictionary(spark))._jdf.queryExecution().optimizedPlan().toString()
    # only the distinct code texts are exploded
    exploded = plan[plan.index("Generate"):].splitlines()
    assert plan.count("Generate") == 1 and "Aggregate [genero_ids" in exploded[1]
    text = resolve_codes(films, dictionary(spark))._jdf.queryExecution().executedPlan().toString()
    # the resolved texts are stored: the rows' plan only joins them
    assert "Generate" not in text
    assert "BroadcastHashJoin" in text and "partial_count" in text and "partial_collect_list" in text


def test_many_copies_of_one_row(spark):
    rows = [{"pelicula_id": "hot", "genero_ids": "35,18"}] * 3000 + \
           [{"pelicula_id": "hot", "genero_ids": "28"}] * 2 + \
           [{"pelicula_id": str(i), "genero_ids": "18"} for i in range(1000)]
    got = dict(names(resolve_codes(raw_rows(spark, rows).repartition(8), dictionary(spark))))
    assert got["hot"] == ", ".join(["Azione"] * 2 + ["Comedia"] * 3000 + ["Drama"] * 3000)
    assert got["7"] == "Drama" and len(got) == 1001


def test_by_position_equals_grouped_form_on_unique_rows(spark):
    from strata.operators import resolve_codes_by_position
    films = raw_rows(spark, [{"pelicula_id": "a", "genero_ids": "35,18"},
                             {"pelicula_id": "b", "genero_ids": ""},
                             {"pelicula_id": "c", "genero_ids": None},
                             {"pelicula_id": "d", "genero_ids": "18, 99,28,18"},
                             {"pelicula_id": "e", "genero_ids": "99"}])
    d = dictionary(spark, (("18", "Drama"), ("18", "Dramma"), ("35", "Comedia"), ("28", "Azione")))
    fast = resolve_codes_by_position(films, d)
    assert names(fast) == names(resolve_codes(films, d))
    assert fast.columns == resolve_codes(films, d).columns
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(pelicula_id" not in plan     # film rows are not shuffled


def test_equal_rows_behave_the_same_at_any_list_length_and_dictionary_size(spark):
    from strata.operators import resolve_codes_by_position
    for codes in (2, 16, 17, 40):
        films = raw_rows(spark, [{"pelicula_id": "t", "genero_ids": "18,35"}] * 2
                         + [{"pelicula_id": "u", "genero_ids": ",".join(["18"] * codes)}])
        for entries in (2, 3, 4):
            d = dictionary(spark, (("18", "Drama"), ("35", "Comedia"), ("1", "x"), ("2", "y"))[:entries])
            by_row = names(resolve_codes_by_position(films, d, broadcast_rows=3))
            assert by_row == [("t", "Drama, Comedia")] * 2 + [("u", ", ".join(["Drama"] * codes))]
            assert names(resolve_codes(films, d, broadcast_rows=3)) == [
                ("t", "Drama, Drama, Comedia, Comedia"), ("u", ", ".join(["Drama"] * codes))]
