"""ingest_films against a Python model of the reference's field defaults:
a missing field takes the default; an explicit null keeps a text field null
and gives numbers and lists their default (a deliberate deviation from a crash)."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata import catalogue as C
from strata.sources import ingest_films

MISSING = object()


def model(element):
    row = {}
    for field, column, kind, default in C.PAGE_FIELDS:
        value = element.get(field, MISSING)
        if value is MISSING:
            value = default
        elif value is None:
            value = None if kind == "text" else default
        elif kind == "list":
            value = ",".join(str(v) for v in value)
        elif kind == "text":
            value = str(value)
        row[column] = value
    date = row[C.RELEASE_DATE]
    row[C.RELEASE_YEAR] = int(date[:4]) if date and date[:4].isdigit() else None
    return row


def maybe(strategy):
    return st.one_of(st.just(MISSING), st.none(), strategy)


element = st.fixed_dictionaries({
    "id": st.integers(0, 10**6),
    "title": maybe(st.text(max_size=5)),
    "original_title": maybe(st.sampled_from(["x", " y "])),
    "release_date": maybe(st.sampled_from(["", "2020-05-01", "1999-12-31", "abcd"])),
    "popularity": maybe(st.floats(-1e6, 1e6)),
    "vote_average": maybe(st.floats(0, 10)),
    "vote_count": maybe(st.integers(0, 10**6)),
    "original_language": maybe(st.sampled_from(["it", "en"])),
    "overview": maybe(st.text(max_size=8)),
    "genre_ids": maybe(st.lists(st.integers(0, 99), max_size=4)),
}).map(lambda d: {k: v for k, v in d.items() if v is not MISSING})


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(element, max_size=4), min_size=1, max_size=4))
def test_ingest_matches_model(spark, pages):
    bodies = [(json.dumps({"page": i, "results": p}),) for i, p in enumerate(pages)]
    got = [r.asDict() for r in ingest_films(spark.createDataFrame(bodies, "body string")).collect()]
    expected = [model(e) for p in pages for e in p]
    key = lambda r: json.dumps(r, sort_keys=True, default=str)
    assert sorted(got, key=key) == sorted(expected, key=key)
