"""Spelling variant grouping over a frequency-vector trie (operator 11).

Words are runs of Latin letters, lower-cased in A-Z. Two words are near when
one inserted, deleted or replaced code point leads from one to the other. A
word's form is its most frequent near word, where that is ``RATIO`` times as
frequent; its root is the last word on the way from form to form.

* Vector: how many letters of a word lie in each letter group. One edit adds at
  most one to one group (surplus) and takes at most one from one (deficit).
* Trie: level g branches by the count of group g, so a leaf holds words of one
  vector, and so of one length. Depth-first search walks two tries side by
  side and spends a budget of one surplus and one deficit; where it meets two
  leaves, words that share their first or last half are verified (one edit
  leaves one half of the shorter word alone).
* Spark: the upper part of the trie is laid out as shards. A node with more
  than ``shard_words`` words is split one level further, so the shards are as
  deep as the words are dense. Every word goes to its own shard and, by the
  same search over the upper trie, to each later shard that its budget reaches;
  so every near pair meets in exactly one shard. Words that are still too many
  on one whole vector (spelled from the same letters) are dealt on by their
  halves. The upper trie holds at most some ten thousand shards, whatever the
  number of words: it is the only thing sent to every task.
* A shard's pairs become one row per word (near words, the most frequent one)
  before they are shuffled.

Rows: a null text has no words; a null ``doc_id`` reads as nothing before the
colon of the hashed key; equal rows count twice. An empty table gives an empty
result. Other columns are not read. Long texts are read whole; a word of any
length takes part. Ties of forms go to the smallest word in code-point order.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import ASCII_LOWER, ASCII_UPPER, stage, table

MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
#: Of so many hashed runs one loses a letter (the planted misspellings).
DAMAGE = 31
#: Words a node of the upper trie may hold before it is split, and the number of
#: shards beyond which shards get larger instead of more.
SHARD_WORDS, MAX_SHARDS = 20_000, 10_000
#: Distinct words a task counts before it passes its counts on.
COUNTED_WORDS = 500_000

# Letter groups: common letters of European texts first, each group closed with
# rarer ones; every other code point is in the last group.
_BY_FREQUENCY = "etaoinsrhldcumfpgwybvkxjqz"
GROUPS = ["".join(_BY_FREQUENCY[g::13]) for g in range(13)]
_MARKS = [chr(0xE000 + g) for g in range(len(GROUPS))]       # one private code point per group
_TO_MARK = {ord(c): mark for mark, group in zip(_MARKS, GROUPS) for c in group}
LEVELS = len(GROUPS) + 1
_LOWER = str.maketrans(ASCII_UPPER, ASCII_LOWER)


def vector(word: str) -> tuple[int, ...]:
    """Letters of ``word`` per group; their sum is its length."""
    marked = word.translate(_TO_MARK)
    counts = [marked.count(mark) for mark in _MARKS]
    return (*counts, len(word) - sum(counts))


def one_edit(a: str, b: str) -> bool:
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    skip = 1 if len(a) == len(b) else 0
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return a[i + skip:] == b[i + 1:]
    return skip == 0


# ---------------------------------------------------------------------------
# The trie of one shard
# ---------------------------------------------------------------------------

class Leaf:
    """Words of one vector, listed by their first and last ``half`` letters."""

    def __init__(self, length: int):
        self.length, self.words, self._by = length, [], {}

    def halves(self, half: int) -> tuple[dict, dict]:
        if half not in self._by:
            heads, tails = {}, {}
            for word in self.words:
                heads.setdefault(word[:half], []).append(word)
                tails.setdefault(word[len(word) - half:], []).append(word)
            self._by[half] = heads, tails
        return self._by[half]


def build(words) -> dict:
    """The trie of ``words``: dicts by count, leaves at the last level."""
    root: dict = {}
    for word in words:
        counts, node = vector(word), root
        for count in counts[:-1]:
            node = node.setdefault(count, {})
        leaf = node.get(counts[-1])
        if leaf is None:
            leaf = node[counts[-1]] = Leaf(len(word))
        leaf.words.append(word)
    return root


def search(a: dict, b: dict, found: Callable[[str, str], None], within: bool,
           by_head: bool = True, by_tail: bool = True) -> None:
    """``found(x, y)`` for each near pair of a word of ``a`` and one of ``b``,
    once; ``within`` takes each pair of one trie with itself once. Without
    ``by_head`` (``by_tail``) pairs with an equal first half (only an equal last
    half) are left to another shard."""

    def leaves(x: Leaf, y: Leaf) -> None:
        half = min(x.length, y.length) // 2
        heads, tails = x.halves(half)
        other_heads, other_tails = y.halves(half)
        for mine, other, head in ((heads, other_heads, True), (tails, other_tails, False)):
            if not (by_head if head else by_tail):
                continue
            for key, words in mine.items():
                others = other.get(key)
                if others:
                    for v in words:
                        start = v[:half]
                        for w in others:
                            if (not within or v < w) and (head or w[:half] != start) and one_edit(v, w):
                                found(v, w)

    def down(x, y, surplus: int, deficit: int, level: int) -> None:
        if level == LEVELS:
            return leaves(x, y)
        for count, child in x.items():
            other = y.get(count)
            if other is not None:
                down(child, other, surplus, deficit, level + 1)
            if surplus:
                other = y.get(count + 1)
                if other is not None:
                    down(child, other, 0, deficit, level + 1)
            if deficit:
                other = y.get(count - 1)
                if other is not None:
                    down(child, other, surplus, 0, level + 1)
        return None

    down(a, b, 1, 1, 0)


# ---------------------------------------------------------------------------
# The upper trie: which shards there are, and which a word goes to
# ---------------------------------------------------------------------------

def _group_counts() -> list[Column]:
    """The levels of :func:`vector` as columns of ``word``."""
    counts = [F.length("word") - F.length(F.translate("word", group, "")) for group in GROUPS]
    total = counts[0]
    for count in counts[1:]:
        total = total + count
    return [*counts, F.length("word") - total]


def _node(depth: int) -> Column:
    return F.concat_ws(".", *[c.cast("string") for c in _group_counts()[:depth]])


def upper_trie(spark: SparkSession, words: DataFrame, shard_words: int) -> dict[str, bool]:
    """Nodes of the upper trie by their counts (``"2.0.1"``): True where the
    node is split further. One count per level, over the words below the split
    nodes; at most one row per child of a split node reaches the driver."""
    nodes, split, depth = {"": True}, [""], 0
    while split and depth < LEVELS:
        depth += 1
        rows = words.select("word").withColumn("node", _node(depth))
        if depth > 1:
            above = F.broadcast(spark.createDataFrame([(s,) for s in split], "above string"))
            rows = rows.withColumn("above", _node(depth - 1)).join(above, "above")
        split = []
        for row in rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).collect():
            nodes[row["node"]] = row["n"] > shard_words
            if nodes[row["node"]]:
                split.append(row["node"])
    return nodes


def shards_of(word: str, nodes: dict[str, bool]) -> Iterator[tuple[str, bool]]:
    """The shards that ``word`` goes to, and whether it is at home there."""
    counts = vector(word)
    home = ""
    for count in counts:
        if not nodes.get(home, False):
            break
        home = f"{home}.{count}" if home else str(count)

    def visit(node: str, level: int, surplus: int, deficit: int) -> Iterator[str]:
        split = nodes.get(node)
        if split is None:
            return
        if not split or level == LEVELS:
            yield node
            return
        for step in (0, 1, -1):
            left = (surplus - (step > 0), deficit - (step < 0))
            if min(left) >= 0 and counts[level] + step >= 0:
                yield from visit(f"{node}.{counts[level] + step}" if node else str(counts[level] + step),
                                 level + 1, *left)

    for shard in {home, *visit("", 0, 1, 1)}:
        if shard < home:
            continue                                  # that shard's words come here instead
        at_home = shard == home
        if not (nodes.get(shard, False) and shard.count(".") == LEVELS - 1):
            yield shard, at_home
            continue
        # too many words on one vector: by their halves, for partners of each length
        length = sum(map(int, shard.split(".")))
        if at_home:
            halves = {length // 2, (length - 1) // 2}
        else:
            halves = {min(length, len(word)) // 2}
        for half in halves:
            yield f"{shard}/{half}h{word[:half]}", at_home
            yield f"{shard}/{half}t{word[len(word) - half:]}", at_home


NEAR_SCHEMA = "word string, n_near long, form_n long, form string"


def _near_in_shard(key: tuple, rows: pa.Table) -> pa.Table:
    shard = key[0].as_py()
    words, counts, at_home = (rows.column(c).to_pylist() for c in ("word", "n", "home"))
    n = dict(zip(words, counts))
    home = build(w for w, here in zip(words, at_home) if here)
    visitors = build(w for w, here in zip(words, at_home) if not here)
    best: dict[str, list] = {}

    def note(word: str, other: str) -> None:
        seen, mine = best.get(word), (-n[other], other)
        if seen is None:
            best[word] = [1, mine]
        else:
            seen[0] += 1
            if mine < seen[1]:
                seen[1] = mine

    def found(a: str, b: str) -> None:
        note(a, b)
        note(b, a)

    kinds, inside = {}, True
    _, dealt, rest = shard.partition("/")
    if dealt:
        half = int(re.match(r"\d+", rest).group())
        head = rest[len(str(half))] == "h"
        kinds = {"by_head": head, "by_tail": not head}
        # partners of equal length meet where their own half is the key
        inside = not words or half == sum(map(int, shard.split("/")[0].split("."))) // 2
    if inside:
        search(home, home, found, True, **kinds)
    search(visitors, home, found, False, **kinds)
    return pa.table({"word": pa.array(list(best), pa.string()),
                     "n_near": pa.array([v[0] for v in best.values()], pa.int64()),
                     "form_n": pa.array([-v[1][0] for v in best.values()], pa.int64()),
                     "form": pa.array([v[1][1] for v in best.values()], pa.string())})


def near_words(spark: SparkSession, words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``word, n_near, form_n, form`` of each word of ``words`` (``word, n``,
    distinct) that has near words: their number and the most frequent one.
    Runs jobs."""
    limit = max(shard_words, words.count() // MAX_SHARDS)
    nodes = spark.sparkContext.broadcast(upper_trie(spark, words, limit))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(shard, word, n, home) for word, n in zip(*(c.to_pylist() for c in batch.columns))
                   for shard, home in shards_of(word, nodes.value)]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("shard", "word", "n", "home"), row)) for row in out],
                schema=pa.schema([("shard", pa.string()), ("word", pa.string()),
                                  ("n", pa.int64()), ("home", pa.bool_())]))

    dealt = words.select("word", "n").mapInArrow(deal, "shard string, word string, n long, home boolean")
    per_shard = dealt.groupBy("shard").applyInArrow(_near_in_shard, NEAR_SCHEMA)
    top = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return per_shard.groupBy("word").agg(F.sum("n_near").alias("n_near"), top.alias("top")).select(
        "word", "n_near", (-F.col("top.less")).alias("form_n"), F.col("top.form").alias("form"))


# ---------------------------------------------------------------------------
# Words, forms and roots
# ---------------------------------------------------------------------------

def count_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                damage: int = DAMAGE) -> DataFrame:
    """``word, n`` of the runs of letters in ``text``. Of the runs whose hash
    with their ``doc_id`` ``damage`` divides, one letter is taken out first (0:
    of none). Counted per task, then summed."""
    runs = re.compile(rf"[A-Za-zÀ-ÿ]{{{min_length},}}").findall

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()),
                                               pa.array(list(seen.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                for key, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    if not text:
                        continue
                    start = zlib.crc32(f"{key or ''}:".encode())
                    for word, n in Counter(runs(text)).items():
                        word = word.lower() if word.isascii() else word.translate(_LOWER)
                        if damage:
                            h = zlib.crc32(word.encode(), start)
                            if h % damage == 0:
                                cut = h % len(word)
                                word = word[:cut] + word[cut + 1:]
                                if len(word) < min_length:
                                    continue
                        seen[word] += n
                if len(seen) >= COUNTED_WORDS:
                    yield rows()
                    seen.clear()
        yield rows()

    counted = docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """``word, root`` of the words that have a form: the pointers are doubled
    until no root has a form. A form is ``RATIO`` times as frequent, so a chain
    is as long as the logarithm of the largest count. Runs jobs."""
    at = stage(spark, forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        if at.join(further, "root", "left_semi").isEmpty():
            return at
        at = stage(spark, at.join(further, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root")), "spelling-roots")


def variants(spark: SparkSession, words: DataFrame, ratio: int = RATIO,
             shard_words: int = SHARD_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` per word of ``words`` (``word,
    n``, distinct; stored, as it is read several times). Runs jobs."""
    near = stage(spark, near_words(spark, words, shard_words), "spelling-near")
    formed = F.col("form_n") >= ratio * F.col("n")
    known = (words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("form")).alias("form"), F.when(formed, F.col("form_n")).alias("form_n")))
    known = stage(spark, known, "spelling-forms")
    last = roots(spark, known.where("form is not null"))
    return known.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = stage(spark, count_words(table(spark, sf_dir, "documents")), "spelling-words")
    return variants(spark, words)
