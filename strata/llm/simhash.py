"""SimHash near-duplicates by covering locality-sensitive hashing (operator 2).

Fingerprint: lower-case A-Z, words between ASCII white space, shingles of
``SHINGLE_WORDS`` words joined by a space, repeats included (fewer words: the
whole sequence; none: fingerprint zero). A bit is 1 if it is set in over half
the shingles' XXH64 values (seed 42).

Search: bit position i gets the vector phi(i) in {1 .. 2^(r+1) - 1}, read as
r + 1 bits. For each nonzero v of r + 1 bits there is one table; its mask holds
the positions whose phi(i) has an odd number of bits in common with v. For any
r differing positions some v is orthogonal to all their vectors (r equations,
r + 1 unknowns), so every pair within r bits agrees on that table's mask and
meets in one bucket: no link can be missed. phi deals the positions evenly, so
each mask holds about half the bits.

Only distinct fingerprints enter the tables; copies of a text are one of them.
A bucket's fingerprints stream through one task, which grows clusters from its
smallest fingerprint with the exact bit distance and returns one edge per
member instead of all pairs. A bucket with more than ``BUCKET_ROWS``
fingerprints is not searched that way: its fingerprints are dealt out by all
values within r/2 bits of them. Two fingerprints share such a value exactly
when they are within r bits, so grouping by it (a star per value) finds the
same components with work linear in the bucket, spread over all tasks.

Rows: a null text counts as empty; all texts without words share fingerprint
zero and link like any others. Repeated rows share a fingerprint. A null
``doc_id`` is never a component's id unless it has no other. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import fresh, stage, table
from strata.llm.components import connected

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Fingerprints of one bucket that a single task compares; more are dealt out.
BUCKET_ROWS = 8_192
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


# ---------------------------------------------------------------------------
# Fingerprints
# ---------------------------------------------------------------------------

def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    words = text.encode().translate(_LOWER).split()      # splits at \\x20, \\x09-\\x0D
    if not words:
        return 0
    line = b" ".join(words)
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends)]
    k = min(shingle_words, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], seed) for a, b in zip(starts, ends[k - 1:])),
                         "<u8", len(words) - k + 1)
    total = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 4096):
        block = hashes[part:part + 4096]
        total += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
                               ).sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(df: DataFrame, text_col: str = "text", name: str = "fp",
                     shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """``df`` with the fingerprint of ``text_col`` as a long (its 64 bits)."""
    keep = [f for f in df.schema.fields if f.name != name]
    schema = T.StructType([*keep, T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.array([fingerprint(v.as_py() or "", shingle_words, seed)
                             for v in batch.column(text_col)], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in keep), pa.array(bits, pa.int64())],
                [f.name for f in schema.fields])

    return df.mapInArrow(run, schema)


# ---------------------------------------------------------------------------
# Covering tables
# ---------------------------------------------------------------------------

def covering_masks(radius: int, bits: int = 64) -> list[int]:
    """Signed masks, one per table: every pair within ``radius`` bits agrees on
    at least one of them."""
    span = (1 << (radius + 1)) - 1
    vectors = [1 + i % span for i in range(bits)]
    masks = []
    for v in range(1, span + 1):
        mask = sum(1 << i for i, p in enumerate(vectors) if (p & v).bit_count() & 1)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def bucket_edges(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within one bucket: (member, the smallest
    fingerprint of its cluster). Sorted distinct unsigned fingerprints in."""
    edges, rest = [], fps
    while len(rest) > 1:
        seed, rest = rest[0], rest[1:]
        front = np.array([seed], fps.dtype)
        while len(front) and len(rest):
            hit = np.zeros(len(rest), bool)
            for at in range(0, len(front), 64):
                near = np.bitwise_count(front[at:at + 64, None] ^ rest[None, :]) <= radius
                hit |= near.any(axis=0)
            front, rest = rest[hit], rest[~hit]
            edges += [(int(x), int(seed)) for x in front]
    return edges


def _searched(keyed: DataFrame, radius: int) -> DataFrame:
    """Edges ``a, b`` of all buckets: rows meet by ``key``, sorted, and a task
    holds one bucket at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = np.empty(0, "<i8"), np.empty(0, "<u8")

        def found(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            cut = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
            size = np.diff(cut)
            two = cut[:-1][size == 2]
            near = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= radius]
            pairs = [np.stack([fps[near + 1], fps[near]], axis=1)]
            for a in cut[:-1][size > 2]:
                b = cut[np.searchsorted(cut, a, side="right")]
                if edges := bucket_edges(np.unique(fps[a:b]), radius):
                    pairs.append(np.array(edges, "<u8"))
            ab = np.concatenate(pairs).view("<i8")
            return pa.RecordBatch.from_arrays(
                [pa.array(ab[:, 0].copy()), pa.array(ab[:, 1].copy())], ["a", "b"])

        for batch in batches:
            keys = np.concatenate((held_key, batch.column(0).to_numpy()))
            fps = np.concatenate((held, batch.column(1).to_numpy().view("<u8")))
            last = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if last:
                yield found(keys[:last], fps[:last])
            held_key, held = keys[last:], fps[last:]
        if len(held):
            yield found(held_key, held)

    return (keyed.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp")
            .mapInArrow(run, "a long, b long"))


def _dealt(fps: DataFrame, radius: int) -> DataFrame:
    """Edges among ``fps`` by shared places of the hypercube: for an even radius
    the values within radius/2 bits, for an odd one the edges (a value and one
    free bit) with an end within (radius - 1)/2 bits. All that share a place are
    within the radius of each other, so its smallest stands for it; two within
    the radius share the middle of the way between them."""
    half = radius // 2
    flips = [sum(1 << i for i in at) for n in range(half + 1) for at in combinations(range(64), n)]
    flips = [f - (1 << 64) if f >> 63 else f for f in flips]
    near = fps.select("fp", F.explode(F.transform(
        F.lit(np.array(flips, "<i8")), lambda f: F.col("fp").bitwiseXOR(f))).alias("z"))
    place = ["z"]
    if radius % 2:
        bits = [1 << i if i < 63 else -(1 << 63) for i in range(64)]
        near = near.select("fp", "z", F.explode(F.lit(np.array(bits, "<i8"))).alias("free")).select(
            "fp", F.col("z").bitwiseAND(F.bitwise_not("free")).alias("z"), "free")
        place = ["z", "free"]
    first = near.groupBy(*place).agg(F.min("fp").alias("b"), F.max("fp").alias("top")).where("b < top")
    return near.join(first.select(*place, "b"), place).where("fp <> b").select(
        F.col("fp").alias("a"), "b").distinct()


def links(spark: SparkSession, fps: DataFrame, radius: int = MAX_BITS,
          bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints (column ``fp``) that connect
    exactly the fingerprints linked through steps of at most ``radius`` bits.
    Runs jobs (bucket sizes) unless all fingerprints would fit one bucket."""
    masks = covering_masks(radius)
    tables = F.array(*[F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(F.lit(m)))
                       for t, m in enumerate(masks)])
    keyed = fps.select("fp", F.explode(tables).alias("key"))
    if fps.count() <= bucket_rows:
        return _searched(keyed, radius)
    large = stage(spark, keyed.groupBy("key").count().where(F.col("count") > bucket_rows)
                  .select("key"), "large-buckets")
    if large.isEmpty():
        return _searched(keyed, radius)
    dense = keyed.join(large, "key", "left_semi").select("fp").distinct()
    return (_searched(keyed.join(large, "key", "left_anti"), radius)
            .union(_dealt(dense, radius)))


# ---------------------------------------------------------------------------
# Documents
# ---------------------------------------------------------------------------

def _order_key(doc_id: str = "doc_id") -> Column:
    return F.struct(F.col(doc_id).isNull().alias("gone"), F.col(doc_id).alias("doc_id"))


def groups(spark: SparkSession, prints: DataFrame, radius: int = MAX_BITS) -> DataFrame:
    """``fp, component, component_id`` per distinct fingerprint of a stored table
    with ``doc_id, fp``: the component's smallest fingerprint and its smallest
    ``doc_id``. Runs jobs."""
    first = stage(spark, prints.groupBy("fp").agg(F.min(_order_key()).alias("least")), "prints")
    nodes = connected(spark, links(spark, first.select("fp"), radius))
    joined = first.join(nodes.select(F.col("node").alias("fp"), "component"), "fp", "left")
    joined = joined.select("fp", "least", F.coalesce("component", "fp").alias("component"))
    tops = joined.groupBy("component").agg(F.min("least").alias("least"))
    return (joined.select("fp", "component").join(tops, "component")
            .select("fp", "component", F.col("least.doc_id").alias("component_id")))


def near_duplicates(spark: SparkSession, docs: DataFrame, radius: int = MAX_BITS,
                    shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Per document its fingerprint (16 hex digits) and component."""
    prints = stage(spark, with_fingerprint(docs.select("doc_id", "text"),
                                           shingle_words=shingle_words).drop("text"), "simhash")
    return prints.join(groups(spark, prints, radius), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(spark: SparkSession, docs: DataFrame, radius: int = MAX_BITS,
             shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """The documents without near duplicates: of each component the row with
    the smallest ``doc_id`` stays (of repeated rows one)."""
    row, fp = fresh(docs, "row"), fresh(docs, "fp")
    rows = stage(spark, with_fingerprint(
        docs.withColumn(row, F.monotonically_increasing_id()), name=fp,
        shingle_words=shingle_words), "simhash")
    keys = rows.select("doc_id", F.col(fp).alias("fp"), F.col(row).alias("row"))
    stay = (keys.join(groups(spark, keys, radius), "fp").groupBy("component")
            .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("one"))
            .select(F.col("one.row").alias(row)))
    return rows.join(stay, row, "left_semi").select(*docs.columns)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "documents"))
