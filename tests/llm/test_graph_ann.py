import math

import numpy as np
from pyspark.sql import functions as F

from strata.llm import graph_ann as G


def brute(rows, stride, k=5):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(
        x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, a in ok:
        if q % stride:
            continue
        near = sorted((-float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))), i)
                      for i, b in ok if i != q and len(a) == len(b))
        out[q] = [(i, -s) for s, i in near[:k]]
    return out


def result(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) / max(1, len(w))
                    for q, w in want.items()])


def test_recall_on_the_given_vectors_in_several_shards(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = brute(rows, 10)
    for shard_rows in (100, 4096):
        usable = G.usable(df)
        index = G.stage(spark, G.build_index(usable, shard_rows=shard_rows), "index")
        got = result(G.search(index, usable.where("vec_id % 10 = 0")))
        assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
        assert recall(got, want) >= 0.9
        exact = dict(rows)
        for q, near in list(got.items())[:20]:
            a = np.array(exact[q], float)
            for i, score in near:
                b = np.array(exact[i], float)
                assert abs(score - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12


def test_graph_recall_is_measured():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 48))
    x = centres[rng.integers(0, 30, 2500)] + 0.3 * rng.normal(size=(2500, 48))
    _, x = G.unit(list(x))
    graph = G.build(x)
    ids, _ = graph.search(x[::10])
    true = np.argsort(-(x[::10] @ x.T), axis=1)[:, :6]
    assert np.mean([len(set(a[:6]) & set(b)) / 6 for a, b in zip(ids, true)]) >= 0.95
    assert (graph.to >= 0).sum(axis=1).max() <= G.DEGREE


def test_one_common_vector_ties_and_bad_rows(spark):
    rng = np.random.default_rng(5)
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in range(400)] + [(1000 + i, rng.normal(size=3).tolist()) for i in range(60)]
    rows += [(2000, None), (2050, []), (2100, [0.0, 0.0, 0.0]), (2150, [1.0, None, 2.0]),
             (2200, [float("nan"), 1.0, 1.0]), (2250, [float("inf"), 1.0, 1.0]), (None, same),
             (50, same), (2300, [2.0, 4.0, 6.0]), (2350, [1.0, 0.0]), (2400, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(9))
    got = result(G.nearest(spark, df))
    want = brute([r for r in dict.fromkeys((i, None if v is None else tuple(v)) for i, v in rows)], 50)
    assert set(got) == set(want)
    for q in (0, 50, 100):
        assert [i for i, _ in got[q]] == [i for i in range(6) if i != q][:5]
    assert recall(got, want) >= 0.9
    assert [i for i, _ in got[2350]] == [2400]                 # vectors of the same length only
    assert G.nearest(spark, df.limit(0)).count() == 0


def test_fewer_candidates_than_k(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])],
                               "vec_id long, embedding array<float>")
    assert {q: [i for i, _ in near] for q, near in result(G.nearest(spark, df)).items()} == {0: [2, 1]}


def test_recall_on_parallel_vectors_of_different_lengths(spark):
    """3,000 vectors on 40 directions, and 1,000 parallel ones among others:
    what comes back is as near as what brute force finds."""
    rng = np.random.default_rng(8)
    few = rng.normal(size=(40, 16))
    rows = [(i, (few[i % 40] * float(rng.uniform(0.01, 50))).tolist()) for i in range(3000)]
    rows += [(3000 + i, (few[0] * float(rng.uniform(0.1, 9)) if i < 1000 else rng.normal(size=16)).tolist())
             for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = result(G.nearest(spark, df, stride=100))
    x = np.array([v for _, v in rows])
    unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    hits = total = 0
    for q in range(0, 4500, 100):
        best = np.sort(np.delete(unit @ unit[q], q))[::-1][:5]
        scores = [s for _, s in got[q]]
        assert len(scores) == 5 and len({i for i, _ in got[q]}) == 5 and q not in {i for i, _ in got[q]}
        hits += sum(s >= b - 1e-9 for s, b in zip(scores, best))
        total += 5
    assert hits / total >= 0.95


def test_extreme_components(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 8))
    sizes = [1e200, 1e-200, 1.0, 1e300, 1e-300]
    rows = [(i, (v * sizes[i % 5]).tolist()) for i, v in enumerate(base)] + [(60, [5e-324] + [0.0] * 7)]
    got = result(G.nearest(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>"), stride=10))
    plain = brute([(i, base[i].tolist() if i < 60 else [1.0] + [0.0] * 7) for i in range(61)], 10)
    for q, near in plain.items():
        assert [i for i, _ in got[q]] == [i for i, _ in near]
        assert np.allclose([s for _, s in got[q]], [s for _, s in near], atol=1e-12)


def test_shards_grow_in_number_first_and_then_in_size():
    assert [G.shard_count(n) for n in (0, 1, 4096, 4097, 64 * 4096, 64 << 17, 1 + (64 << 17), 10**9)] == \
        [1, 1, 1, 2, 64, 64, 65, 7630]
