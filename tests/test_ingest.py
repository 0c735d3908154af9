import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from strata import catalogue as C
from strata.sources import ingest_dictionary, ingest_films, split_bad_pages

FAILURES = (PySparkException, Py4JJavaError)


def pages(spark, *bodies):
    return spark.createDataFrame([(b,) for b in bodies], "body string")


def test_missing_title_is_empty_null_title_stays_null(spark):
    df = ingest_films(pages(spark, '{"page":1,"results":[{"id":8},{"id":7,"title":null}]}'))
    rows = {r[C.FILM_ID]: r for r in df.collect()}
    assert rows["8"][C.TITLE] == "" and rows["7"][C.TITLE] is None
    # defaults of the other fields when missing
    r = rows["8"]
    assert (r[C.POPULARITY], r[C.RATING], r[C.VOTES], r[C.CODES]) == (0.0, 0.0, 0, "")
    assert r[C.RELEASE_DATE] == "" and r[C.RELEASE_YEAR] is None


def test_full_element_is_typed_and_flattened(spark):
    body = ('{"page":1,"results":[{"id":11,"title":"Roma","original_title":"Roma ",'
            '"release_date":"2018-08-30","popularity":12.5,"vote_average":7.7,'
            '"vote_count":3000,"original_language":"it","overview":"o","genre_ids":[18,35]}]}')
    row = ingest_films(pages(spark, body)).collect()[0]
    assert row.asDict() == {
        C.FILM_ID: "11", C.TITLE: "Roma", C.ORIGINAL_TITLE: "Roma ",
        C.RELEASE_DATE: "2018-08-30", C.RELEASE_YEAR: 2018, C.POPULARITY: 12.5,
        C.RATING: 7.7, C.VOTES: 3000, C.LANGUAGE: "it", C.OVERVIEW: "o", C.CODES: "18,35"}
    assert ingest_films(pages(spark, body)).columns == [
        C.FILM_ID, C.TITLE, C.ORIGINAL_TITLE, C.RELEASE_DATE, C.RELEASE_YEAR, C.POPULARITY,
        C.RATING, C.VOTES, C.LANGUAGE, C.OVERVIEW, C.CODES]


def test_page_without_results_gives_no_rows(spark):
    assert ingest_films(pages(spark, '{"status_code":7}', '{"page":3,"results":[]}')).count() == 0


def test_malformed_page_fails_the_job(spark):
    with pytest.raises(FAILURES):
        ingest_films(pages(spark, '{bad', '{"results":[{"id":1}]}')).collect()


def test_quarantine_separates_bad_pages(spark):
    split = split_bad_pages(pages(spark, '{bad', '{"results":[{"id":1}]}', '{"status_code":7}'))
    assert [r.body for r in split.bad.collect()] == ['{bad']
    assert [r[C.FILM_ID] for r in ingest_films(split.good).collect()] == ["1"]


def test_null_id_fails(spark):
    with pytest.raises(FAILURES):
        ingest_films(pages(spark, '{"results":[{"id":null,"title":"x"}]}')).collect()


def test_dictionary_ingest(spark):
    df = ingest_dictionary(pages(spark, '{"genres":[{"id":18,"name":"Drama"},{"id":35,"name":"Commedia"}]}'))
    assert sorted(tuple(r) for r in df.collect()) == [("18", "Drama"), ("35", "Commedia")]


def test_dictionary_entry_without_name_fails(spark):
    with pytest.raises(FAILURES):
        ingest_dictionary(pages(spark, '{"genres":[{"id":1}]}')).collect()


def test_lenient_ingest_skips_malformed_pages(spark):
    df = ingest_films(pages(spark, '{bad', '{"results":[{"id":1}]}'), lenient=True)
    assert [r[C.FILM_ID] for r in df.collect()] == ["1"]


def test_read_landed_pages(spark, tmp_path):
    from strata.sources import read_landed_pages
    path = tmp_path / "landing"
    path.mkdir()
    (path / "p1.jsonl").write_text('{"results":[{"id":1}]}\n{"results":[{"id":2},{"id":3}]}\n')
    got = sorted(r[C.FILM_ID] for r in ingest_films(read_landed_pages(spark, str(path))).collect())
    assert got == ["1", "2", "3"]


def test_read_landed_pages_one_per_file(spark, tmp_path):
    from strata.sources import read_landed_pages
    path = tmp_path / "responses"
    path.mkdir()
    (path / "page1.json").write_text('{\n  "page": 1,\n  "results": [\n    {"id": 1},\n    {"id": 2}\n  ]\n}\n')
    (path / "page2.json").write_text('{"page": 2, "results": [{"id": 3, "title": null}]}')
    got = sorted(r[C.FILM_ID] for r in ingest_films(read_landed_pages(spark, str(path), whole_files=True)).collect())
    assert got == ["1", "2", "3"]
