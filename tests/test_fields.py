"""Pages and elements that cannot be read, in every mode."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strata import catalogue as C
from strata.functions import read_field
from strata.sources import faulty_pages, ingest_dictionary, ingest_films, sort_films, split_bad_pages

FAILURES = (PySparkException, Py4JJavaError)

# body -> (reason of the page, faults of its elements, ids that load)
PAGES = {
    '{"results":[{"id":1,"genre_ids":"abc"},{"id":2,"genre_ids":[18]}]}':
        (None, [(0, "genre_ids", "element with an unreadable list")], ["2"]),
    '{"results":[{"id":3,"genre_ids":[18,{"id":1}]},{"id":4,"genre_ids":[[1]]},{"id":5,"genre_ids":[1,null]}]}':
        (None, [(0, "genre_ids", "element with an unreadable list"),
                (1, "genre_ids", "element with an unreadable list")], ["5"]),
    '{"results":{"a":1}}': ("results field is not a list", [], []),
    '{"results":"no"}': ("results field is not a list", [], []),
    '{"results":null}': ("results field is not a list", [], []),
    '[1,2]': ("page is not a JSON object", [], []),
    '7': ("page is not a JSON object", [], []),
    '{cut': ("page is not valid JSON", [], []),
    '': ("page is not valid JSON", [], []),
    '{"results":[null,5,"x",[1],{"id":6}]}':
        (None, [(i, None, "element is not an object") for i in range(4)], ["6"]),
    '{"results":[{"id":{"a":1}},{"id":[1]},{"id":7,"title":{"x":"y"}},{"id":8,"title":true}]}':
        (None, [(0, "id", "element with an unreadable text"), (1, "id", "element with an unreadable text"),
                (2, "title", "element with an unreadable text")], ["8"]),
    '{"results":[{"id":null,"vote_count":"n/a"},{"id":9,"vote_count":"12"},{"id":10,"vote_count":99999999999}]}':
        (None, [(0, "id", "element with a null id"), (2, "vote_count", "element with an unreadable number")], ["9"]),
    '{"results":[{"id":11,"popularity":{}},{"id":12,"popularity":null}]}':
        (None, [(0, "popularity", "element with an unreadable number")], ["12"]),
}
GOOD = ['{"results":[{"id":21},{"id":22}]}', '{"results":[]}', '{"status_code":7}', "{}", None]


def frame(spark, bodies):
    return spark.createDataFrame([(b,) for b in bodies], "body string")


def reports(rows):
    return {r.body: (r.reason, [tuple(f) for f in r.faults]) for r in rows}


def test_quarantine_keeps_every_bad_page_once_and_loads_the_rest(spark):
    rows = sort_films(frame(spark, [*PAGES, *GOOD])).collect()
    bad = [r for r in rows if r.bad]
    assert len(bad) == len(PAGES)
    assert reports(bad) == {b: (reason, faults) for b, (reason, faults, _) in PAGES.items()}
    loaded = sorted(r[C.FILM_ID] for r in rows if not r.bad)
    assert loaded == sorted([i for _, _, ids in PAGES.values() for i in ids] + ["21", "22"])
    assert all(r[C.FILM_ID] is None and r[C.TITLE] is None for r in bad)
    assert all(r.reason is None and r.body is None and r.faults is None for r in rows if not r.bad)


def test_faulty_pages_and_lenient_ingest_share_the_pages_out(spark):
    pages = frame(spark, [*PAGES, *GOOD])
    assert reports(faulty_pages(pages).collect()) == {b: v[:2] for b, v in PAGES.items()}
    lenient = sorted(map(tuple, ingest_films(pages, lenient=True).collect()))
    sorted_good = sorted(tuple(r)[:len(r) - 4] for r in sort_films(pages).where("not bad").collect())
    assert lenient == sorted_good
    assert {r.body for r in split_bad_pages(pages).bad.collect()} == {b for b, v in PAGES.items() if v[0]}


@pytest.mark.parametrize("body", list(PAGES))
def test_fail_mode_fails_with_the_reason(spark, body):
    reason, faults, _ = PAGES[body]
    with pytest.raises(FAILURES) as failure:
        ingest_films(frame(spark, [GOOD[0], body])).collect()
    assert (reason or faults[0][2]) in str(failure.value)


def test_fail_mode_takes_good_pages(spark):
    assert sorted(r[C.FILM_ID] for r in ingest_films(frame(spark, GOOD)).collect()) == ["21", "22"]


@pytest.mark.parametrize("body", ['{"genres":{"id":1}}', '{"genres":[5]}', '{"genres":[{"id":1,"name":{"a":1}}]}',
                                  '{"genres":[{"id":1,"name":null}]}', "[]", "{cut"])
def test_dictionary_fails_on_anything_unreadable(spark, body):
    with pytest.raises(FAILURES):
        ingest_dictionary(frame(spark, [body])).collect()


def test_a_bad_page_is_stored_once_however_many_elements_are_bad(spark):
    body = json.dumps({"results": [{"id": None, "title": "x" * 100} for _ in range(500)]})
    rows = sort_films(frame(spark, [body])).collect()
    assert len(rows) == 1 and len(rows[0].faults) == 500 and rows[0].faults[499]["index"] == 499


anything = st.recursive(st.one_of(st.none(), st.booleans(), st.integers(-10**12, 10**12), st.text(max_size=4),
                                  st.floats(allow_nan=False, allow_infinity=False)),
                        lambda inner: st.one_of(st.lists(inner, max_size=3),
                                                st.dictionaries(st.sampled_from("ab"), inner, max_size=2)),
                        max_leaves=5)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(anything, min_size=1, max_size=30))
def test_readers_never_fail_and_flag_nested_values(spark, values):
    rows = frame(spark, [json.dumps({"x": v}) for v in values]).select(F.parse_json("body").alias("e"))
    readings = {kind: read_field(F.col("e"), "x", kind, default)
                for kind, default in (("text", ""), ("int", 0), ("double", 0.0), ("list", ""))}
    out = rows.select(*[c.alias(f"{kind}_{part}") for kind, r in readings.items()
                        for part, c in zip(("value", "fault"), r)]).collect()
    for value, row in zip(values, out):
        nested = isinstance(value, (list, dict))
        assert (row.text_fault is not None) == nested
        assert (row.double_fault is not None) or not nested
        assert (row.list_fault is None) == (value is None or (
            isinstance(value, list) and not any(isinstance(x, (list, dict)) for x in value)))
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            assert row.double_fault is None and row.double_value == pytest.approx(float(value))
        if value is None:
            assert (row.text_value, row.int_value, row.double_value, row.list_value) == (None, 0, 0.0, "")
