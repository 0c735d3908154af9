import re
from collections import Counter

import corpus_pipeline as P
import pytest
from frames import EDGE, docs
from test_line_dedup import brute as brute_lines
from test_mixing import brute_targets
from test_simhash import brute_components, brute_print

NAMES = ["toxicity", "line dedup", "SimHash near-dedup", "mixing sources to target weights",
         "byte-level BPE encoding and decoding"]


@pytest.fixture(scope="module")
def steps(spark, small_sf):
    """The input and every stage's output on the small tables."""
    out = [P.table(spark, small_sf, "documents")]
    for name, step in P.STAGES:
        out.append(P.stage(spark, step(spark, out[-1], small_sf), "test"))
    return out


def test_stages_and_columns(steps):
    assert [n for n, _ in P.STAGES] == NAMES
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(s.columns == columns for s in steps[:-1])


def test_every_stage_against_brute_force(steps):
    rows = [{r.doc_id: r for r in s.collect()} for s in steps[:4]]
    assert set(rows[1]) < set(rows[0]) and all(rows[1][d] == rows[0][d] for d in rows[1])
    lines = brute_lines({d: r.text for d, r in rows[1].items()})
    assert {d: r.text for d, r in rows[2].items()} == lines
    parts = brute_components({d: brute_print(r.text) for d, r in rows[2].items()})
    assert set(rows[3]) == set(parts.values()) and all(rows[3][d] == rows[2][d] for d in rows[3])

    sizes, taken = Counter(), Counter()
    for r in rows[3].values():
        sizes[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    for r in steps[4].collect():
        taken[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    for source, target in brute_targets(sizes).items():
        assert abs(taken[source] - target) <= 0.05 * target + 200
    coded = steps[5].collect()
    assert len(coded) == steps[4].count() and all(r.round_trip for r in coded)
    assert all(len(r.token_ids) == 4 * r.n_tokens for r in coded)


def test_run_equals_the_stages(spark, small_sf, steps):
    key = lambda s: sorted((r.doc_id, r.decoded_sha256) for r in s.collect())
    assert key(P.run(spark, small_sf)) == key(steps[5])


def test_edge_rows_and_an_empty_table(spark, small_sf):
    for df in (docs(spark, EDGE), docs(spark, EDGE).limit(0)):
        for name, step in P.STAGES:
            df = P.stage(spark, step(spark, df, small_sf), "edge")
        assert "token_ids" in df.columns
