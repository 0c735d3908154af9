"""discover() against a plain-Python model: language filter, exclusions,
popularity descending with nulls last, key ascending, cut into pages."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators import discover


def model(rows, excluded, language, pages, size):
    kept = [r for r in rows if r[1] == language and r[0] not in excluded]
    kept.sort(key=lambda r: (r[2] is None, -(r[2] or 0.0), r[0]))
    top = kept[: pages * size]
    return [(r[0], i + 1, i // size + 1) for i, r in enumerate(top)]


doc = st.tuples(st.integers(0, 10**6), st.sampled_from(["es", "it", "fr"]),
                st.one_of(st.none(), st.sampled_from([1.0, 2.0, 3.0]), st.floats(0, 100)))


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(doc, max_size=60, unique_by=lambda r: r[0]), st.data())
def test_discover_matches_model(spark, rows, data):
    ids = [r[0] for r in rows]
    excluded = set(data.draw(st.lists(st.sampled_from(ids), max_size=10))) if ids else set()
    pages, size = data.draw(st.integers(1, 3)), data.draw(st.integers(1, 7))
    df = spark.createDataFrame(rows, "id long, lang string, pop double")
    flagged = spark.createDataFrame([(i,) for i in excluded], "id long")
    out = discover(df, "lang", "es", "pop", "id", num_pages=pages, page_size=size, exclude=flagged)
    got = sorted((r.id, r.position, r.page) for r in out.collect())
    assert got == sorted(model(rows, excluded, "es", pages, size))
