import random

from strata.llm.components import connected


def brute(edges):
    label = {}

    def top(x):
        label.setdefault(x, x)
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        label[y] = x
    return {x: top(x) for x in label}


def test_random_graphs_paths_and_stars(spark):
    rng = random.Random(4)
    shuffled = rng.sample(range(400), 400)
    path = list(zip(shuffled, shuffled[1:]))
    star = [(1000, 1001 + i) for i in range(300)] + [(2000 - i, 2001) for i in range(200)]
    loose = [(rng.randint(3000, 3300), rng.randint(3000, 3300)) for _ in range(200)]
    loops = [(a, b) for a, b in loose if a == b]
    edges = path + star + loose + star[:5]
    got = dict(connected(spark, spark.createDataFrame(edges, "a long, b long")).collect())
    want = brute([e for e in edges if e not in loops])
    assert got == want


def test_no_edges_null_ends_and_loops(spark):
    none = spark.createDataFrame([(1, None), (None, 2), (3, 3)], "a long, b long")
    assert connected(spark, none).count() == 0
    assert connected(spark, none.limit(0)).columns == ["node", "component"]
