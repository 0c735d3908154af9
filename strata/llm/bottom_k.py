"""Document fingerprints: bottom-k sketches of shingle hashes (operator 8), in
DataFrame operations only.

Words stand between ASCII white space; a shingle is ``SHINGLE_WORDS``
consecutive words (fewer words: the whole sequence), hashed by XXH64 over its
words' XXH64 values. A sketch holds the ``K`` smallest distinct hashes in
ascending order. The sketch of a union is the K smallest of both sketches, so
sketches merge across parts of a document, documents and partitions.

* resemblance: share of the union's K smallest hashes that both sketches hold;
* distinct shingles: exact below K, else (K - 1) / (the K-th smallest hash as a
  fraction of the hash range);
* containment of A in B: resemblance x |A u B| / |A|.

Rows: a null or empty text (or one of white space) has an empty sketch and the
fingerprint ``''``; two empty sketches have resemblance 1, an empty and another
0. Equal texts have equal sketches. Only ``doc_id`` and the text are read.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, table, text_or_empty

K = 128
SHINGLE_WORDS = 5
#: Documents per ordered chunk at least, and the most chunks (one id each on the driver).
CHUNK_ROWS, MAX_CHUNKS = 1_500, 100_000


# ---------------------------------------------------------------------------
# Sketches
# ---------------------------------------------------------------------------

def word_hashes(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), 0), lambda w: F.xxhash64(w))


def sketch(words: str, k: int = K, shingle_words: int = SHINGLE_WORDS) -> Column:
    """The sketch of a column of word hashes (project it first: it is read often)."""
    n = F.size(words)
    shingles = F.transform(
        F.slice(words, 1, F.greatest(n - (shingle_words - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *[F.get(F.col(words), i + j) for j in range(1, shingle_words)]))
    whole = F.when(n > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<long>"))
    return F.slice(F.sort_array(F.array_distinct(
        F.when(n >= shingle_words, shingles).otherwise(whole))), 1, k)


def with_sketch(df: DataFrame, text: Column, name: str, k: int = K,
                shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``df`` with the sketch of ``text`` as ``name``."""
    words = f"{name}__words"
    return (df.withColumn(words, word_hashes(text))
            .withColumn(name, sketch(words, k, shingle_words)).drop(words))


def fingerprint(values: Column | str) -> Column:
    """A sketch as text: its hashes as 16 hex digits each."""
    return F.array_join(F.transform(values, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def merged(a: str, b: str, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: str, b: str, k: int = K) -> Column:
    union = merged(a, b, k)
    both = F.array_intersect(union, F.array_intersect(F.col(a), F.col(b)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(F.size(both) / F.size(union))


def distinct_shingles(values: str | Column, k: int = K) -> Column:
    values = F.col(values) if isinstance(values, str) else values
    top = F.element_at(values, -1).cast("double")
    estimate = (k - 1) / ((top + 2.0**63) / 2.0**64)
    return F.when(F.size(values) < k, F.size(values).cast("double")).otherwise(estimate)


def containment(a: str, b: str, k: int = K) -> Column:
    """Share of A's shingles that B holds."""
    share = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k) / distinct_shingles(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(share, F.lit(1.0)))


def merge_sketches(df: DataFrame, keys: list[str], name: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per key from the sketches of its parts. Each task passes on at
    most ``k`` hashes per key (a group limit before the shuffle)."""
    hashes = df.select(*keys, F.explode_outer(name).alias("hash")).distinct()
    order = Window.partitionBy(*keys).orderBy(F.col("hash").asc_nulls_last())
    least = hashes.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    return least.groupBy(*keys).agg(F.sort_array(F.collect_list("hash")).alias(name))


# ---------------------------------------------------------------------------
# The next document
# ---------------------------------------------------------------------------

def with_chunk(docs: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``docs`` with ``chunk``: ascending ranges of ``doc_id`` of about equal
    size (null ids: -1). The bounds are the first ids of Spark's own range
    partitions over the ids alone. Runs a count and a range shuffle of the ids."""
    ids = docs.select("doc_id").where("doc_id is not null")
    rows = ids.count()
    chunks = max(1, math.ceil(rows / max(chunk_rows, rows // MAX_CHUNKS)))
    starts = [] if chunks == 1 else [r["start"] for r in (
        ids.repartitionByRange(chunks, "doc_id").withColumn("part", F.spark_partition_id())
        .groupBy("part").agg(F.min("doc_id").alias("start")).collect())]
    splits = sorted({float(s) for s in starts})[1:]
    if not splits:
        return docs.withColumn("chunk", F.when(F.col("doc_id").isNull(), -1).otherwise(0))
    cut = Bucketizer(splits=[-math.inf, *splits, math.inf], inputCol="__id", outputCol="__chunk",
                     handleInvalid="keep")
    return (cut.transform(docs.withColumn("__id", F.col("doc_id").cast("double")))
            .withColumn("chunk", F.when(F.col("doc_id").isNull(), -1)
                        .otherwise(F.col("__chunk").cast("int"))).drop("__id", "__chunk"))


def with_next(docs: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``doc_id, text, sketch`` with ``next_text`` and ``next_sketch`` of the
    next document by (doc_id, text), the first after the last. The texts are
    shuffled once, into chunks; only each chunk's first document also travels
    to the chunk before it."""
    rows = with_chunk(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                  text_or_empty().alias("text")), chunk_rows)
    order = Window.partitionBy("chunk").orderBy(F.col("doc_id").asc_nulls_first(), "text")
    inner = with_sketch(rows.withColumn("next_text", F.lead("text").over(order)),
                        F.col("text"), "sketch")
    inner = inner.withColumn("next_sketch", F.lead("sketch").over(order))

    first_id = rows.groupBy("chunk").agg(F.min("doc_id").alias("first_id"))  # one row per chunk
    firsts = (rows.join(F.broadcast(first_id.withColumnRenamed("chunk", "c")),
                        (F.col("chunk") == F.col("c"))
                        & F.col("doc_id").eqNullSafe(F.col("first_id")))
              .groupBy("chunk").agg(F.min("text").alias("head_text")))
    place = Window.orderBy("chunk")                                          # one row per chunk
    every = Window.partitionBy()
    before = first_id.select(
        F.col("chunk").alias("head_chunk"),
        F.coalesce(F.lag("chunk").over(place), F.max("chunk").over(every)).alias("chunk"))
    heads = with_sketch(
        firsts.withColumnRenamed("chunk", "head_chunk").join(F.broadcast(before), "head_chunk")
        .drop("head_chunk"), F.col("head_text"), "head_sketch")
    return inner.join(heads, "chunk", "left").select(
        "doc_id", "text", "sketch", F.coalesce("next_text", "head_text").alias("next_text"),
        F.coalesce("next_sketch", "head_sketch").alias("next_sketch"))


def edited_likeness(docs: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Fingerprint of each text and of its edited text (the second half replaced
    by the start of the next document), and how alike they and the next are."""
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = with_next(docs, chunk_rows).withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("edited", F.concat(
        F.left("text", F.col("n_chars").cast("int") - half), F.left("next_text", half)))
    rows = with_sketch(rows, F.col("edited"), "edited_sketch")
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint("sketch").alias("fingerprint"),
        fingerprint("edited_sketch").alias("edited_fingerprint"),
        resemblance("sketch", "edited_sketch").alias("near_edited"),
        resemblance("sketch", "next_sketch").alias("near_next"),
        distinct_shingles("sketch").alias("distinct_shingles"),
        containment("sketch", "edited_sketch").alias("contained_in_edited"))


def op8_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(table(spark, sf_dir, "documents"))
