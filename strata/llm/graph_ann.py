"""Approximate nearest neighbours by cosine on robust-pruned directed graphs
(operator 4).

Directions are dealt by hash into shards of ``SHARD_ROWS`` to ``SHARD_LIMIT``, so
a shard always fits a task. In a shard points are inserted in random order
in batches that double in size: a greedy beam search from the entry point
proposes ``BEAM`` candidates, robust pruning keeps up to ``DEGREE`` of them
(nearest first; a candidate q is left out when ``RELAX`` x d(p, q) <= d(own, q)
for a kept p), and each kept one gets the reverse edge, pruned again when it is
full. A second pass repeats this over the whole graph. The graphs are written
as a table. Every query searches every shard by beam search; the shard's
candidates are scored exactly in double precision on the original vectors, and
the best of all shards stay.

Vectors of one direction (unit vectors equal to ``DIGITS`` decimals: their
cosines with anything differ by rounding only) are one graph point with its k +
1 smallest ids and their own vectors: no other member can be among the k nearest
(ties go to smaller ids, the query's own is left out). So a direction that a
third of all rows share neither fills a shard nor breaks the graph, in which one
neighbour at distance zero would stand for all others. Vectors are scaled by a
power of two before they are multiplied, which changes no result and keeps very
large and very small components finite.

The number of shards grows to ``SHARDS`` first and their size after that, up to
``SHARD_LIMIT``: beyond, a query still meets every shard, so searches grow with
queries times rows / ``SHARD_LIMIT``. A shard's points and its queries stream
through its task, points first; the queries are never held together, and the
index is read once per ``QUERY_BLOCK`` queries.

Rows: vectors that are null, empty, zero, or hold null or non-finite components
take no part, neither do rows without id. Vectors are compared within their
length. Rows that repeat an id are one candidate per direction; a query
never finds its own id. With no more than k candidates all are returned. An
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import stage, table
from strata.operators.joins import sized_broadcast

SHARD_ROWS, SHARDS, SHARD_LIMIT = 4_096, 64, 1 << 17
QUERY_BLOCK = 1_000_000
DIGITS = 10
DEGREE, BEAM, RELAX = 32, 64, 1.2
BATCH, STEP = 256, 4
QUERY_STRIDE = 50
NEAREST = 5
SEED = 4


# ---------------------------------------------------------------------------
# Graph of one shard
# ---------------------------------------------------------------------------

class Graph:
    """Unit vectors ``x`` (n, d), neighbours ``to`` (n, DEGREE; -1: none)."""

    def __init__(self, x: np.ndarray, to: np.ndarray | None = None, entry: int | None = None):
        self.x = x
        self.to = np.full((len(x), DEGREE), -1, np.int32) if to is None else to
        self.entry = int(np.argmax(x @ x.mean(axis=0))) if entry is None else entry

    def search(self, q: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances (1 - cosine) of the nearest points that beam search
        meets, nearest first; id -1 where there are fewer."""
        rows = np.arange(len(q))[:, None]
        ids = np.full((len(q), beam), -1, np.int64)
        far = np.full((len(q), beam), np.inf, np.float32)
        open_ = np.zeros((len(q), beam), bool)
        seen = np.zeros((len(q), len(self.x)), bool)
        ids[:, 0], open_[:, 0], seen[:, self.entry] = self.entry, True, True
        far[:, 0] = 1 - q @ self.x[self.entry]
        while open_.any():
            pick = np.argsort(~open_, axis=1, kind="stable")[:, :STEP]   # nearest open ones
            chosen = np.where(open_[rows, pick], ids[rows, pick], -1)
            open_[rows, pick] = False
            near = np.where((chosen >= 0)[:, :, None], self.to[chosen], -1).reshape(len(q), -1)
            fresh = near >= 0
            fresh &= ~seen[rows, np.maximum(near, 0)]
            # a point met twice in this step counts once
            order = np.argsort(np.where(fresh, near, -1), axis=1, kind="stable")
            near, fresh = near[rows, order], fresh[rows, order]
            fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
            at, col = np.nonzero(fresh)
            seen[at, near[at, col]] = True
            found = np.full(near.shape, np.inf, np.float32)
            found[at, col] = 1 - np.einsum("ij,ij->i", q[at], self.x[near[at, col]])
            ids = np.concatenate((ids, np.where(fresh, near, -1)), axis=1)
            far = np.concatenate((far, found), axis=1)
            open_ = np.concatenate((open_, fresh), axis=1)
            best = np.argsort(far, axis=1, kind="stable")[:, :beam]
            ids, far, open_ = ids[rows, best], far[rows, best], open_[rows, best]
        return ids, far

    def pruned(self, points: np.ndarray, ids: np.ndarray, far: np.ndarray) -> np.ndarray:
        """Robust pruning of candidates (ids -1: none) for each of ``points``."""
        far = np.where((ids < 0) | (ids == points[:, None]), np.inf, far)
        order = np.argsort(far, axis=1, kind="stable")
        rows = np.arange(len(points))
        ids, far = ids[rows[:, None], order], far[rows[:, None], order]
        alive = np.isfinite(far)
        alive[:, 1:] &= ids[:, 1:] != ids[:, :-1]
        v = self.x[np.maximum(ids, 0)]
        between = 1 - v @ v.transpose(0, 2, 1)
        kept = np.full((len(points), DEGREE), -1, np.int32)
        for slot in range(DEGREE):
            if not alive.any():
                break
            first = alive.argmax(axis=1)
            some = alive[rows, first]
            kept[some, slot] = ids[rows, first][some]
            # 1 - cosine is half the squared distance, hence RELAX squared
            covered = RELAX**2 * between[rows, first] <= far
            alive &= ~(covered & some[:, None])
            alive[rows, first] = False
        return kept

    def insert(self, points: np.ndarray) -> None:
        ids, far = self.search(self.x[points])
        old = self.to[points]
        known = 1 - np.einsum("id,ijd->ij", self.x[points], self.x[np.maximum(old, 0)])
        self.to[points] = self.pruned(points, np.concatenate((ids, old), axis=1),
                                      np.concatenate((far, known), axis=1))
        # reverse edges, by the point that gets them
        back = self.to[points]
        source = np.repeat(points, DEGREE)[back.ravel() >= 0]
        target = back.ravel()[back.ravel() >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        ends, starts, counts = np.unique(target, return_index=True, return_counts=True)
        for part in range(0, len(ends), BATCH):
            own = slice(part, part + BATCH)
            most = int(counts[own].max())
            new = np.full((len(ends[own]), most), -1, np.int64)
            for i, (a, n) in enumerate(zip(starts[own], counts[own])):
                new[i, :n] = source[a:a + n]
            both = np.concatenate((self.to[ends[own]], new), axis=1)
            away = 1 - np.einsum("id,ijd->ij", self.x[ends[own]], self.x[np.maximum(both, 0)])
            self.to[ends[own]] = self._merged(ends[own], both, away.astype(np.float32))

    def _merged(self, points: np.ndarray, ids: np.ndarray, far: np.ndarray) -> np.ndarray:
        """All of ``ids`` where they fit, else what robust pruning keeps."""
        out = np.full((len(points), DEGREE), -1, np.int32)
        crowded = []
        for i, row in enumerate(ids):
            own = np.unique(row[(row >= 0) & (row != points[i])])
            if len(own) <= DEGREE:
                out[i, :len(own)] = own
            else:
                crowded.append(i)
        if crowded:
            out[crowded] = self.pruned(points[crowded], ids[crowded], far[crowded])
        return out


def build(x: np.ndarray, seed: int = SEED) -> Graph:
    graph = Graph(x)
    order = np.random.default_rng(seed).permutation(len(x))
    order = np.r_[graph.entry, order[order != graph.entry]]
    at, size = 1, 1
    while at < len(order):
        graph.insert(order[at:at + size])
        at, size = at + size, min(2 * size, BATCH)
    for at in range(0, len(order) if len(order) > DEGREE else 0, BATCH):
        graph.insert(order[at:at + BATCH])
    return graph


def unit(vectors) -> tuple[np.ndarray, np.ndarray]:
    """Double vectors, each scaled exactly by a power of two, and
    single-precision unit vectors."""
    raw = np.array([np.asarray(v, np.float64) for v in vectors])
    raw = np.ldexp(raw, -np.frexp(np.abs(raw).max(axis=1, keepdims=True))[1])
    return raw, (raw / np.sqrt((raw**2).sum(axis=1, keepdims=True))).astype(np.float32)


# ---------------------------------------------------------------------------
# Spark
# ---------------------------------------------------------------------------

MEMBER = "struct<vec_id:long, vector:array<double>>"
ARROW_MEMBERS = pa.list_(pa.struct([("vec_id", pa.int64()), ("vector", pa.list_(pa.float64()))]))
INDEX = f"dim int, shard int, point int, members array<{MEMBER}>, neighbours array<int>, entry boolean"
FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, dim, vector`` of the rows that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v)
                      & (F.abs(v) != F.lit(float("inf"))))
    return (rows.where(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda v: v != 0))
            .select("vec_id", F.size("vector").alias("dim"), "vector"))


def with_direction(vectors: DataFrame) -> DataFrame:
    """``usable`` vectors with ``direction``: the unit vector to ``DIGITS``
    decimals, as the bytes of whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for vector in batch.column(2):
                raw = np.array(vector.as_py())
                raw = raw / np.abs(raw).max()
                keys.append((np.round(raw / np.sqrt((raw * raw).sum()) * 10.0**DIGITS) + 0.0)
                            .astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())],
                                             ["vec_id", "dim", "vector", "direction"])

    return vectors.select("vec_id", "dim", "vector").mapInArrow(
        run, "vec_id long, dim int, vector array<double>, direction binary")


def shard_count(points: int, shard_rows: int = SHARD_ROWS, shards: int = SHARDS,
                limit: int = SHARD_LIMIT) -> int:
    return max(1, min(math.ceil(points / shard_rows), max(shards, math.ceil(points / limit))))


def build_index(vectors: DataFrame, k: int = NEAREST, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The graph of every shard, a row per point. ``vectors`` is ``usable``.
    Runs a job (the number of directions)."""
    rows = (with_direction(vectors).groupBy("dim", "direction", "vec_id")
            .agg(F.min("vector").alias("vector")))
    # the k + 1 smallest ids per direction, kept apart in two steps: a hot one is cut per task first
    place = Window.partitionBy("dim", "direction", "salt").orderBy("vec_id")
    few = (rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
           .withColumn("place", F.row_number().over(place)).where(F.col("place") <= k + 1))
    members = F.array_sort(F.collect_list(F.struct("vec_id", "vector").cast(MEMBER)))
    points = few.groupBy("dim", "direction").agg(F.slice(members, 1, k + 1).alias("members"))
    points = points.withColumn("hash", F.xxhash64("direction"))
    shards = shard_count(rows.select("dim", "direction").distinct().count(), shard_rows)
    points = points.select("dim", F.pmod("hash", F.lit(shards)).cast("int").alias("shard"), "members")

    def run(rows: pa.Table) -> pa.Table:
        members = sorted(rows.column("members").to_pylist(), key=lambda m: m[0]["vec_id"])
        graph = build(unit([m[0]["vector"] for m in members])[1])
        return pa.table({
            "dim": rows.column("dim"), "shard": rows.column("shard"),
            "point": pa.array(np.arange(len(rows)), pa.int32()), "members": pa.array(members, ARROW_MEMBERS),
            "neighbours": pa.array([row[row >= 0] for row in graph.to], pa.list_(pa.int32())),
            "entry": pa.array(np.arange(len(rows)) == graph.entry)})

    return points.groupBy("dim", "shard").applyInArrow(run, INDEX)


class _Shard:
    """A shard's graph and members, from its index rows."""

    def __init__(self, rows: list[dict]):
        rows.sort(key=lambda r: r["point"])
        self.ids = [[m["vec_id"] for m in r["members"]] for r in rows]
        self.raw = [unit([m["vector"] for m in r["members"]])[0] for r in rows]
        self.norm = [np.sqrt((raw * raw).sum(axis=1)) for raw in self.raw]
        x = unit([r["members"][0]["vector"] for r in rows])[1]
        to = np.full((len(rows), DEGREE), -1, np.int32)
        for i, r in enumerate(rows):
            to[i, :len(r["neighbours"])] = r["neighbours"]
        self.graph = Graph(x, to, next(i for i, r in enumerate(rows) if r["entry"]))

    def nearest(self, query_ids: list[int], vectors: list, k: int, beam: int) -> Iterator[tuple]:
        ask, q = unit(vectors)
        found, _ = self.graph.search(q, max(beam, k + 1))
        for row, (me, own) in enumerate(zip(query_ids, ask)):
            size, best = np.sqrt((own * own).sum()), []
            for p in found[row][found[row] >= 0]:
                scores = (self.raw[p] * own).sum(axis=1) / (self.norm[p] * size)
                best += [(-s, v) for s, v in zip(scores.tolist(), self.ids[p]) if v != me]
            for less, v in sorted(best)[:k]:
                yield me, v, -less


def search(index: DataFrame, queries: DataFrame, k: int = NEAREST, beam: int = BEAM) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k nearest of each query over all
    shards of a stored index. ``queries`` is ``usable``. Runs a job (the number
    of queries)."""
    blocks = max(1, math.ceil(queries.count() / QUERY_BLOCK))
    shards = index.select("dim", "shard").distinct().toDF("of_dim", "shard")
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    none = F.lit(None)
    asked = (queries.distinct().join(sized_broadcast(shards), F.col("dim") == F.col("of_dim"))
             .select("dim", "shard", block.alias("block"), F.lit(1).alias("kind"), "vec_id", "vector",
                     none.cast("int").alias("point"), none.cast(f"array<{MEMBER}>").alias("members"),
                     none.cast("array<int>").alias("neighbours"), none.cast("boolean").alias("entry")))
    points = index.select(
        "dim", "shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.lit(0).alias("kind"), none.cast("long").alias("vec_id"), none.cast("array<double>").alias("vector"),
        "point", "members", "neighbours", "entry")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, points_, shard, ids, vectors = None, [], None, [], []

        def answers() -> pa.RecordBatch:
            rows = list(shard.nearest(ids, vectors, k, beam))
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in
                 enumerate((pa.int64(), pa.int64(), pa.float64()))], ["query_id", "vec_id", "score"])

        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                for row in batch.slice(at, BATCH).to_pylist():
                    place = row["dim"], row["shard"], row["block"]
                    if place != key:
                        if ids:
                            yield answers()
                        key, points_, shard, ids, vectors = place, [], None, [], []
                    if row["kind"] == 0:
                        points_.append(row)
                        continue
                    if shard is None:
                        shard, points_ = _Shard(points_), []
                    ids.append(row["vec_id"])
                    vectors.append(row["vector"])
                    if len(ids) == BATCH:
                        yield answers()
                        ids, vectors = [], []
        if ids:
            yield answers()

    found = (points.union(asked).repartition("dim", "shard", "block")
             .sortWithinPartitions("dim", "shard", "block", "kind", "vec_id").mapInArrow(run, FOUND))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def nearest(spark: SparkSession, vectors: DataFrame, stride: int = QUERY_STRIDE,
            k: int = NEAREST) -> DataFrame:
    """Search for every row whose id is divisible by ``stride`` among all rows."""
    rows = usable(vectors)
    index = stage(spark, build_index(rows, k), "graph-index")
    return search(index, rows.where(F.col("vec_id") % stride == 0), k)


def op4_graph_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark, table(spark, sf_dir, "embeddings"))
