import random
import re

import numpy as np
import pytest
import xxhash
from frames import EDGE, clashing, docs

from strata.llm import simhash as S


def brute_print(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """doc -> smallest doc reachable over at most 4 bits."""
    ids = sorted(prints)
    label = {d: d for d in ids}

    def top(d):
        while label[d] != d:
            d = label[d]
        return d

    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((top(a), top(b)))
                label[y] = x
    return {d: top(d) for d in ids}


def test_every_pair_within_the_radius_agrees_on_a_mask():
    rng = random.Random(5)
    for radius in (2, 4):
        masks = S.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(4000):
            flip = sum(1 << b for b in rng.sample(range(64), rng.randint(0, radius)))
            assert any(flip & m & (1 << 64) - 1 == 0 for m in masks)


def test_fingerprint_against_brute_force():
    rng = random.Random(1)
    texts = [t for _, t, _, _ in EDGE] + ["A b C", "a b c d", "a\x0bb\x0cc d\x1ce f", "  x y"] + [
        " ".join(rng.choice(["Ab", "c", "éd", "F,"]) for _ in range(rng.randint(1, 60))) for _ in range(40)]
    for t in texts:
        assert S.fingerprint(t or "") == brute_print(t), repr(t)


def near_prints(rng, n):
    """Fingerprints in chains and clusters around a few centres, and lone ones."""
    out = []
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            out.append(x)
            x ^= sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6)))
    return out[:n]


def test_components_against_brute_force_with_and_without_large_buckets(spark):
    rng = random.Random(8)
    prints = dict(enumerate(near_prints(rng, 500)))
    want = brute_components(prints)
    signed = [(d, x - (1 << 64) if x >> 63 else x) for d, x in prints.items()]
    fps = spark.createDataFrame(signed, "doc_id long, fp long").repartition(5)
    got = dict(fps.join(S.groups(spark, fps), "fp").select("doc_id", "component_id").collect())
    assert got == want
    distinct = fps.select("fp").distinct()
    for rows in (1, 3):                        # all or many buckets are dealt out by near values
        edges = S.links(spark, distinct, bucket_rows=rows)
        nodes = dict(S.connected(spark, edges).collect())
        part = {}
        for d, x in signed:
            part.setdefault(nodes.get(x, x), []).append(d)
        assert {min(p): sorted(p) for p in part.values()} == {
            c: sorted(d for d in want if want[d] == c) for c in set(want.values())}


def test_bucket_edges_span_the_links():
    fps = np.array([0, 1, 3, 255, 254, 7 << 40], np.uint64)
    fps.sort()
    assert S.bucket_edges(fps, 1) == [(1, 0), (3, 0), (255, 254)]


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_odd_and_even_radius_in_large_buckets(spark, radius):
    """Above and below the bucket bound the same components, as all pairs give."""
    rng = random.Random(radius)
    fps = {rng.getrandbits(64) for _ in range(8)} | {1 << 63, 0, (1 << 64) - 1}
    for _ in range(4):
        fps |= {f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for f in rng.sample(sorted(fps), 8)}
    signed = {f - (1 << 64) if f >> 63 else f: f for f in fps}
    want = {k: {k} for k in signed}
    for x in signed:
        for y in signed:
            if (signed[x] ^ signed[y]).bit_count() <= radius and want[x] is not want[y]:
                want[x] |= want[y]
                for z in want[y]:
                    want[z] = want[x]
    frame = spark.createDataFrame([(k,) for k in signed], "fp long")
    for bucket_rows in (8192, 1):
        nodes = dict(S.connected(spark, S.links(spark, frame, radius, bucket_rows)).collect())
        got = {}
        for k in signed:
            got.setdefault(nodes.get(k, k), set()).add(k)
        assert {frozenset(p) for p in got.values()} == {frozenset(p) for p in want.values()}


def test_given_documents(spark, small_sf):
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{small_sf}/documents.parquet").collect()}
    rows = S.op2_simhash(spark, small_sf).collect()
    prints = {d: brute_print(t) for d, t in given.items()}
    want = brute_components(prints)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        d: (f"{prints[d]:016x}", want[d]) for d in given}


def test_edge_rows(spark):
    df = clashing(docs(spark, EDGE))
    out = S.near_duplicates(spark, df).collect()
    assert len(out) == len(EDGE)
    zero = [r for r in out if r.fingerprint == "0" * 16]
    assert {r.doc_id for r in zero} == {3, 5, 7} and {r.component_id for r in zero} == {3}
    assert {r.component_id for r in out if r.doc_id in (2, 4)} == {2}
    kept = S.keep_one(spark, df)
    assert kept.columns == df.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == sorted(map(str, [None, 2, 3, 6, 9, 11]))
    assert S.near_duplicates(spark, df.limit(0)).count() == 0
    assert S.keep_one(spark, df.limit(0)).count() == 0
