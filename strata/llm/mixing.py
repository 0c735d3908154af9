"""Mixing sources to target weights (operator 3), in DataFrame operations only.

* Size of a document: its words between ASCII white space. A source's words lie
  end to end and are cut into blocks of ``BLOCK_WORDS`` words, so a block may
  span documents and a document many blocks. Places come from per-chunk sums
  and a running sum inside hash chunks of each source, so a source that holds a
  third of all rows is spread over many tasks.
* Targets: sources in code point order (null last) weigh 1, 2, 3, repeating,
  and share all words; a target stops at ``MAX_REPEATS`` times its source, the
  excess goes to the others by weight. With sources in order of cap per weight,
  the level is the highest of (words left) / (weight left).
* Draws: the output has shards of about ``SHARD_SLOTS`` block slots. A shard's
  source counts are a multinomial draw by residuals: the whole part of each
  expected count is fixed, the remaining slots are drawn with the fractional
  parts as probabilities. Expected counts are those of the plain draw, with
  far less variance, so taken words stay near the targets.
* Slot i of a source takes block pi(i mod blocks) of pass i div blocks; pi is a
  swap-or-not permutation per source and pass (each round maps x to k - x or
  not, by a hash of the larger of the two), exact for any number of blocks.
  Slots beyond ``MAX_REPEATS`` passes stay empty, so no document exceeds that
  many times its size. Slots and blocks meet by an equi-join on the index.

All draws are hashes of ``SEED`` and stable keys: reruns agree.

Rows: a null or empty text has size 0 and is never taken. Repeated rows are
separate documents. A null ``source`` is a source of its own; a null ``doc_id``
sorts first. Sources without words have target 0. An empty table gives an empty
result. Runs jobs: the sizes are written once to the shared folder.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, fresh, let, stage, table, text_or_empty
from strata.operators.joins import sized_broadcast

BLOCK_WORDS = 64
SHARD_SLOTS = 16_384
MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
SEED = 20_011
#: Rows per hash chunk of all sources at least, and the most chunks (sums of a source).
CHUNK_ROWS, MAX_CHUNKS = 1_000, 100_000
ROUNDS = 16
#: Slots that one task expands, about.
TASK_SLOTS = 100_000
#: A word with the white space after it (the first one also with that before it).
_WORD_AND_SPACE = r"(?:^[\x20\x09-\x0D]+)?[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"


def sized(spark: SparkSession, docs: DataFrame, row: str, size: str, th: str,
          texts: bool) -> DataFrame:
    """``docs`` (without ``text``, unless ``texts``) with a row id, the size in
    words and the text's hash, as a stored table."""
    rows = docs.select("*", F.monotonically_increasing_id().alias(row),
                       F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias(size),
                       F.xxhash64("text").alias(th))
    return stage(spark, rows if texts else rows.drop("text"), "sized")


def source_targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: ``sid, source, source_size, target, blocks, demand``
    (blocks to take). ``rows`` has ``source, size``."""
    place = Window.orderBy(F.col("source").asc_nulls_last())                 # one row per source
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    earlier = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    later = by_cap.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    sizes = (rows.groupBy("source").agg(F.sum("size").alias("source_size"))
             .withColumn("sid", (F.row_number().over(place) - 1).cast("int")))
    sizes = (sizes.withColumn("weight", F.get(F.array(*map(F.lit, weights)),
                                              F.col("sid") % len(weights)).cast("double"))
             .withColumn("cap", F.col("source_size") * F.lit(float(max_repeats))))
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))
    levels = sizes.withColumn("level", left / F.sum("weight").over(later))
    return (levels.withColumn("target", F.least(
                "cap", F.max("level").over(every) * F.col("weight")))
            .withColumn("blocks", F.ceil(F.col("source_size") / BLOCK_WORDS).cast("long"))
            .withColumn("demand", F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks")
                                         / F.col("source_size")).otherwise(0.0))
            .select("sid", "source", "source_size", "target", "blocks", "demand"))


def layout(rows: DataFrame, sources: DataFrame, chunks: int) -> DataFrame:
    """``row, doc_id, sid, size, start``: the place of each document's first
    word among its source's words. ``rows`` has ``row, doc_id, source, size, th``."""
    known = rows.join(sized_broadcast(sources.select("sid", F.col("source").alias("s"))),
                      F.col("source").eqNullSafe(F.col("s"))).drop("s", "source")
    known = known.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).cast("int"))
    sums = known.groupBy("sid", "chunk").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("sid", "chunk", F.coalesce(F.sum("words").over(before), F.lit(0))
                          .alias("offset"))
    inside = (Window.partitionBy("sid", "chunk").orderBy("doc_id", "size", "th", "row")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = known.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return placed.join(offsets, ["sid", "chunk"]).select(
        "row", "doc_id", "sid", "size", (F.col("offset") + F.col("inside")).alias("start"))


def pieces(placed: DataFrame) -> DataFrame:
    """The part of each document in each block: ``at`` is its first word in the
    document, ``words`` how many."""
    first = F.floor(F.col("start") / BLOCK_WORDS)
    last = F.floor((F.col("start") + F.col("size") - 1) / BLOCK_WORDS)
    cut = placed.where("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("start"), F.col("block") * BLOCK_WORDS)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * BLOCK_WORDS)
    return cut.select("row", "doc_id", "sid", "size", "block",
                      (begin - F.col("start")).alias("at"), (end - begin).alias("words"))


def _uniform(*key: Column) -> Column:
    """In [0, 1), from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*key), 11) / F.lit(float(1 << 53))


def permuted(index: Column, n: Column, *key: Column) -> Column:
    """``index`` in [0, n) under a pseudorandom permutation named by ``key``."""

    def turn(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, r), n) - x, n)
        return F.when(F.xxhash64(F.greatest(x, other), r, *key) < 0, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index.cast("long"), turn)


def shard_counts(sources: DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """``shard, sid, blocks, n``: slots of each source in each output shard."""
    every = Window.partitionBy()
    total = sources.withColumn("slots", F.ceil(F.sum("demand").over(every)).cast("long"))
    total = (total.where("demand > 0").withColumn("part", F.col("demand") / F.sum("demand").over(every))
             .withColumn("shards", F.ceil(F.col("slots") / shard_slots).cast("long")))
    cell = total.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    edge = lambda k: F.floor(k * F.col("slots") / F.col("shards"))
    cell = cell.withColumn("size", edge(F.col("shard") + 1) - edge(F.col("shard")))
    cell = cell.withColumn("whole", F.floor(F.col("size") * F.col("part")))
    cell = cell.withColumn("rest", F.col("size") * F.col("part") - F.col("whole"))
    upto = (Window.partitionBy("shard").orderBy("sid")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cell = cell.withColumn("upto", F.sum("rest").over(upto))
    # the remaining slots of a shard, each drawn by the fractional parts
    drawn = cell.groupBy("shard", "size").agg(
        F.sum("whole").alias("fixed"), F.array_sort(F.collect_list(F.struct("upto", "sid")))
        .alias("ends"))
    left = F.col("size") - F.col("fixed")
    drawn = (drawn.where(left > 0)
             .withColumn("draw", F.explode(F.sequence(F.lit(1).cast("long"), left)))
             .withColumn("u", _uniform(F.lit(seed), F.lit(1), F.col("shard"), F.col("draw"))
                         * F.element_at("ends", -1)["upto"])
             .select("shard", F.get(F.filter("ends", lambda e: e["upto"] > F.col("u")), F.lit(0))["sid"]
                     .alias("sid")))
    counts = (cell.select("shard", "sid", F.col("whole").alias("n"))
              .union(drawn.where("sid is not null").select("shard", "sid", F.lit(1).cast("long")))
              .groupBy("shard", "sid").agg(F.sum("n").alias("n")))
    return counts.join(sized_broadcast(sources.select("sid", "blocks")), "sid")


def slots(sources: DataFrame, shard_slots: int = SHARD_SLOTS, max_repeats: int = MAX_REPEATS,
          seed: int = SEED) -> DataFrame:
    """Every filled slot of the mix: ``shard, sid, i, turn, block`` (``turn``:
    the pass over the source). The few rows of counts are dealt out before they
    are expanded. Runs a job (the number of slots)."""
    total = sources.agg(F.sum("demand")).first()[0] or 0
    shuffle = sources.sparkSession.conf.get("spark.sql.shuffle.partitions")
    tasks = max(int(shuffle), math.ceil(total / TASK_SLOTS))
    before = (Window.partitionBy("sid").orderBy("shard")
              .rowsBetween(Window.unboundedPreceding, -1))
    counts = shard_counts(sources, shard_slots, seed).where("n > 0")
    counts = counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    i = counts.repartition(tasks, "shard", "sid").select("shard", "sid", "blocks", F.explode(
        F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("i"))
    i = i.where(F.col("i") < F.col("blocks") * max_repeats)
    i = i.withColumn("turn", F.floor(F.col("i") / F.col("blocks")))
    return i.select("shard", "sid", "i", "turn", permuted(
        F.col("i") % F.col("blocks"), F.col("blocks"), F.lit(seed), F.col("sid"), F.col("turn"))
        .alias("block"))


class Mix:
    """A mix of ``docs``; its parts are DataFrames. ``texts=False`` stores no
    texts; then ``documents`` is not available."""

    def __init__(self, spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                 shard_slots: int = SHARD_SLOTS, max_repeats: int = MAX_REPEATS, seed: int = SEED,
                 texts: bool = True):
        self.columns = docs.columns
        self.row, self.size, th = fresh(docs, "row"), fresh(docs, "size"), fresh(docs, "th")
        self.stored = sized(spark, docs, self.row, self.size, th, texts)
        self.rows = self.stored.select(F.col(self.row).alias("row"), "doc_id", "source",
                                       F.col(self.size).alias("size"), F.col(th).alias("th"))
        self.sources = stage(spark, source_targets(self.rows, weights, max_repeats), "targets")
        chunks = min(MAX_CHUNKS, max(1, math.ceil(self.stored.count() / CHUNK_ROWS)))
        self.pieces = pieces(layout(self.rows, self.sources, chunks))
        self.slots = slots(self.sources, shard_slots, max_repeats, seed)

    def blocks(self) -> DataFrame:
        """The mix itself: per output shard and slot the pieces of its block."""
        slot = F.row_number().over(Window.partitionBy("shard").orderBy(
            F.xxhash64(F.lit(SEED), "sid", "i"), "sid", "i"))
        return (self.slots.withColumn("slot", slot).join(self.pieces.hint("merge"), ["sid", "block"])
                .join(sized_broadcast(self.sources.select("sid", "source")), "sid")
                .select("shard", "slot", "source", "turn", "block", "doc_id", "row", "at", "words"))

    def taken(self) -> DataFrame:
        """Per document how many of its words the mix takes, repeats counted."""
        times = self.slots.groupBy("sid", "block").agg(F.count(F.lit(1)).alias("times"))
        # both sides grow with the documents: neither is broadcast
        used = self.pieces.join(times.hint("merge"), ["sid", "block"]).groupBy("row").agg(
            F.sum(F.col("words") * F.col("times")).alias("taken"))
        sources = self.sources.select(F.col("source").alias("s"), "source_size", "target")
        return (self.rows.join(used.hint("merge"), "row", "left")
                .join(sized_broadcast(sources), F.col("source").eqNullSafe(F.col("s")))
                .select("doc_id", "source", "size", "source_size", "target",
                        F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))

    def documents(self) -> DataFrame:
        """The mix as documents: a row per document and pass with the words
        taken in that pass, in their order and with their white space (the whole
        text where all are). ``n_chars``, if there is one, is counted anew."""
        spans = (self.slots.join(self.pieces.hint("merge"), ["sid", "block"]).groupBy("row", "turn").agg(
            F.array_sort(F.collect_list(F.struct("at", "words"))).alias("spans"),
            F.sum("words").alias("kept")))
        spans = spans.select(F.col("row").alias("__row"), "spans", "kept")
        parts = F.regexp_extract_all("text", F.lit(_WORD_AND_SPACE), 0)
        cut = let(parts, lambda own: F.array_join(F.transform("__spans", lambda s: F.array_join(F.slice(
            own, (s["at"] + 1).cast("int"), s["words"].cast("int")), "")), ""))
        joined = self.stored.join(
            spans.withColumnsRenamed({"spans": "__spans", "kept": "__kept"}),
            F.col(self.row) == F.col("__row"))
        text = F.when(F.col("__kept") == F.col(self.size), F.col("text")).otherwise(
            F.regexp_replace(cut, r"[\x20\x09-\x0D]+$", ""))
        out = joined.withColumn("text", text)
        if "n_chars" in self.columns:
            out = out.withColumn("n_chars", F.length("text").cast(
                self.stored.schema["n_chars"].dataType))
        return out.select(*self.columns)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return Mix(spark, docs, texts=False).taken()
