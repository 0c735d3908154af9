"""Token ids in wavelet-matrix shards (operator 1).

A shard holds the ids of a run of documents in ascending ``doc_id`` order. Its
file is one byte string:

* magic ``WVM1`` and eight little-endian u64: ids, bit planes, documents, block
  bits, bytes of the three compressed parts below, 0;
* document ids (i64) and a null mask (u8), zstd;
* ids per document (u64), zstd;
* block table, zstd: for each plane and block the compressed length (u32), the
  set bits of the plane before the block (u64); then per plane its zero count;
* the blocks: each plane is cut into blocks of ``BLOCK_BITS`` bits, packed and
  compressed one by one, so reading a token opens one block per plane.

Plane 0 holds the top bit of every id in text order. Each next plane holds the
next bit after a stable partition by the plane above (zeros first). Rank adds
the block's count and a count inside the block; select searches the block
counts and then one block. On these rest ``access`` (the id at a place),
``count`` and ``locate`` (the places of an id) without opening other blocks.

Shards are kept as rows of a Parquet table, so Spark's commit protocol writes
them to any store and a lost task writes its shards again. Every file stands
alone: ``WaveletShard(blob)`` needs nothing else.

Rows: a null text counts as empty; a null ``doc_id`` sorts first; rows that
share a ``doc_id`` stand next to each other, ordered by text. An empty table
gives no shards. A document is never cut: one longer than ``shard_ids`` makes a
longer shard of its own.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import table
from strata.session import scratch_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: Ids after which a shard is closed.
SHARD_IDS = 1 << 21
BLOCK_BITS = 1 << 17
MAGIC = b"WVM1"
#: Words remembered per Python worker; the memory is emptied when full.
WORD_MEMORY = 1_000_000


# ---------------------------------------------------------------------------
# Wavelet matrix
# ---------------------------------------------------------------------------

def build_shard(ids: np.ndarray, planes: int, doc_ids: list, lengths: list[int]) -> bytes:
    """The shard file of ``ids`` (documents laid end to end)."""
    x = np.ascontiguousarray(ids, np.uint16 if planes <= 16 else np.uint32)
    n, pack = len(x), zstandard.ZstdCompressor(level=1).compress
    sizes, before, zeros, blocks = [], [], [], []
    for level in range(planes - 1, -1, -1):
        ones = (x & x.dtype.type(1 << level)) != 0
        seen = 0
        for at in range(0, n, BLOCK_BITS):
            block = ones[at:at + BLOCK_BITS]
            blocks.append(pack(np.packbits(block).tobytes()))
            sizes.append(len(blocks[-1]))
            before.append(seen)
            seen += int(np.count_nonzero(block))
        zeros.append(n - seen)
        x = np.concatenate((x[~ones], x[ones]))
    keys = np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes() + bytes(
        d is None for d in doc_ids)
    parts = [pack(keys), pack(np.array(lengths, "<u8").tobytes()),
             pack(np.array(sizes, "<u4").tobytes() + np.array(before, "<u8").tobytes()
                  + np.array(zeros, "<u8").tobytes())]
    head = struct.pack("<8Q", n, planes, len(doc_ids), BLOCK_BITS, *map(len, parts), 0)
    return b"".join([MAGIC, head, *parts, *blocks])


class WaveletShard:
    """Reader of one shard file; blocks are opened when they are needed."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("not a wavelet shard")
        self.n, self.planes, docs, self.block, *sizes, _ = struct.unpack_from("<8Q", blob, 4)
        at, parts, self._open = 4 + 64, [], zstandard.ZstdDecompressor().decompress
        for size in sizes:
            parts.append(self._open(blob[at:at + size]))
            at += size
        keys = np.frombuffer(parts[0], "<i8", docs)
        self.doc_ids = [None if gone else int(k) for k, gone in zip(keys, parts[0][8 * docs:])]
        self.lengths = np.frombuffer(parts[1], "<u8").astype(np.int64)
        per = -(-self.n // self.block)
        shape = (self.planes, per)
        lengths = np.frombuffer(parts[2], "<u4", self.planes * per)
        self.before = np.frombuffer(parts[2], "<u8", self.planes * per, 4 * len(lengths)
                                    ).astype(np.int64).reshape(shape)
        self.zeros = np.frombuffer(parts[2], "<u8", self.planes, 12 * len(lengths)).astype(np.int64)
        ends = at + np.cumsum(lengths, dtype=np.int64)
        self._ends, self._starts = ends.reshape(shape), (ends - lengths).reshape(shape)
        self._blob, self._cache = blob, {}

    def bits(self, plane: int, block: int) -> np.ndarray:
        """One opened block as 0/1 bytes."""
        key = (plane, block)
        if key not in self._cache:
            if len(self._cache) >= 4 * self.planes:
                self._cache.clear()
            raw = self._open(self._blob[self._starts[key]:self._ends[key]])
            count = min(self.block, self.n - block * self.block)
            self._cache[key] = np.unpackbits(np.frombuffer(raw, np.uint8), count=count)
        return self._cache[key]

    def rank1(self, plane: int, place: int) -> int:
        """Set bits of a plane before ``place``."""
        block, rest = divmod(place, self.block)
        if place >= self.n:
            return self.n - int(self.zeros[plane])
        return int(self.before[plane, block]) + int(np.count_nonzero(self.bits(plane, block)[:rest]))

    def select(self, plane: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) ``bit`` of a plane."""
        starts = np.arange(self.before.shape[1]) * self.block
        counts = self.before[plane] if bit else starts - self.before[plane]
        block = int(np.searchsorted(counts, k, side="right")) - 1
        inside = np.flatnonzero(self.bits(plane, block) == bit)
        return block * self.block + int(inside[k - int(counts[block])])

    def _down(self, plane: int, bit: int, place: int) -> int:
        ones = self.rank1(plane, place)
        return int(self.zeros[plane]) + ones if bit else place - ones

    def access(self, place: int) -> int:
        """The id at ``place``."""
        if not 0 <= place < self.n:
            raise IndexError(place)
        out = 0
        for plane in range(self.planes):
            bit = int(self.bits(plane, place // self.block)[place % self.block])
            out = out << 1 | bit
            place = self._down(plane, bit, place)
        return out

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        for plane in range(self.planes):
            bit = token >> (self.planes - 1 - plane) & 1
            lo, hi = self._down(plane, bit, lo), self._down(plane, bit, hi)
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of an id in places [lo, hi)."""
        if token >> self.planes:
            return 0
        a, b = self._range(token, lo, self.n if hi is None else hi)
        return b - a

    def locate(self, token: int, lo: int = 0, hi: int | None = None) -> Iterator[int]:
        """Places of an id in [lo, hi), ascending."""
        if token >> self.planes:
            return
        a, b = self._range(token, lo, self.n if hi is None else hi)
        for place in range(a, b):
            for plane in range(self.planes - 1, -1, -1):
                bit = token >> (self.planes - 1 - plane) & 1
                place = self.select(plane, bit, place - int(self.zeros[plane]) * bit)
            yield place

    def ids(self) -> np.ndarray:
        """All ids in text order, by undoing the partitions from the last plane up."""
        out = np.zeros(self.n, np.uint16 if self.planes <= 16 else np.uint32)
        for plane in range(self.planes - 1, -1, -1):
            if not self.n:
                break
            ones = np.concatenate([self._plain(plane, b) for b in range(self.before.shape[1])])
            zeros, above = int(self.zeros[plane]), np.empty_like(out)
            above[~ones] = out[:zeros]
            above[ones] = out[zeros:] | out.dtype.type(1 << (self.planes - 1 - plane))
            out = above
        return out

    def _plain(self, plane: int, block: int) -> np.ndarray:
        raw = self._open(self._blob[self._starts[plane, block]:self._ends[plane, block]])
        count = min(self.block, self.n - block * self.block)
        return np.unpackbits(np.frombuffer(raw, np.uint8), count=count).view(bool)


# ---------------------------------------------------------------------------
# Tokenizer
# ---------------------------------------------------------------------------

class WordCoder(dict):
    """Ids of white-space separated words by the tokenizers library, remembered.

    The tokenizer drops white space and never merges across it, so a text's ids
    are those of its words in turn. It also splits letters from marks and
    lower-cases, so ``The``, ``the`` and ``the,`` share their work. A word of
    plain Latin letters is one piece of its pattern; its byte-level form goes
    straight to the library's merges. Everything else is left to the whole
    tokenizer, and a text is cut at ASCII white space only.
    """

    MARKS = ".,;:!?*#$%&)\""
    #: Latin letters up to here are unchanged by NFC and lower-case one by one
    #: (but for the dotted capital I).
    LATIN, DOTTED = "\u0250", "\u0130"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.planes = max(1, (self.tokenizer.get_vocab_size() - 1).bit_length())
        self.kind = "<u2" if self.planes <= 16 else "<u4"
        self.model = self.tokenizer.model
        # the library's byte-level alphabet: bytes that do not print move up, in order
        prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
        moved = [b for b in range(256) if b not in prints]
        self.visible = {b: 256 + i for i, b in enumerate(moved)}

    def _plain(self, word: str) -> bool:
        return word.isalpha() and (word.isascii() or (max(word) < self.LATIN
                                                      and self.DOTTED not in word))

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.planes <= 16 else 'I'}", *ids)

    def __missing__(self, word: str) -> bytes:
        if len(self) >= WORD_MEMORY:
            self.clear()
        stem = word.rstrip(self.MARKS)
        if stem and stem != word and self._plain(stem[-1]):
            ids = self[stem] + self[word[len(stem):]]
        elif self._plain(word):
            low = word.lower()
            if low != word:
                ids = self[low]
            else:
                piece = low if low.isascii() else low.encode().decode("latin-1").translate(self.visible)
                ids = self._packed([t.id for t in self.model.tokenize(piece)])
        else:
            ids = self._packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        if len(word) <= 64:
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if text.isascii() and not any(c in text for c in "\x0b\x0c\x1c\x1d\x1e\x1f"):
            words = text.split()
        else:
            words = [w for w in text.replace("\t", " ").replace("\n", " ").replace("\r", " ")
                     .split(" ") if w]
        return b"".join(map(self.__getitem__, words))


_CODERS: dict[str, WordCoder] = {}


def word_coder(path: str) -> WordCoder:
    if path not in _CODERS:
        _CODERS[path] = WordCoder(path)
    return _CODERS[path]


# ---------------------------------------------------------------------------
# Spark
# ---------------------------------------------------------------------------

SHARD_SCHEMA = ("part int, seq int, start_in_part long, n_docs long, n_ids long, "
                "first_doc_id long, shard binary")
DOC_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def shard_rows(docs: DataFrame, tokenizer_path: str | None = None, end_id: int = END_ID,
               shard_ids: int = SHARD_IDS) -> DataFrame:
    """One row per shard. One shuffle deals the documents into ascending ranges
    of ``doc_id``; every range is encoded and cut into shards by its task. A
    task holds the ids of one shard at a time."""
    path = tokenizer_path or public_tokenizers.path(TOKENIZER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_coder(path)
        end = np.array([end_id], coder.kind).tobytes()
        width = len(end)
        part, seq, start = TaskContext.get().partitionId(), 0, 0
        keys, lengths, held, size = [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal seq, start, keys, lengths, held, size
            ids = np.frombuffer(b"".join(held), coder.kind)
            blob = build_shard(ids, coder.planes, keys, lengths)
            row = [part, seq, start, len(keys), size, keys[0], blob]
            out = pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(),
                                                        pa.int64(), pa.int64(), pa.int64(),
                                                        pa.binary()))],
                [c.split()[0] for c in SHARD_SCHEMA.split(", ")])
            seq, start, keys, lengths, held, size = seq + 1, start + size, [], [], [], 0
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                piece = batch.slice(at, 1024)
                for key, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    ids = coder.encode(text or "") + end
                    if keys and size + len(ids) // width > shard_ids:
                        yield close()
                    keys.append(key)
                    lengths.append(len(ids) // width)
                    held.append(ids)
                    size += lengths[-1]
        if keys:
            yield close()

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    return ordered.mapInArrow(run, SHARD_SCHEMA)


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Write the shard files of ``docs`` as a table below ``path``. Runs a job."""
    shard_rows(docs, **options).write.parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shard table with ``start``: the ids of all shards before each one.
    Only one total per range (at most the write job's task count) is summed in
    order and broadcast; the shards themselves are not shuffled."""
    shards = spark.read.parquet(path)
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = totals.select("part", F.coalesce(
        F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("part_start"))
    return (shards.join(F.broadcast(before), "part")
            .withColumn("start", F.col("part_start") + F.col("start_in_part")).drop("part_start"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the shard files: place, length and checksum of its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, blob in zip(batch.column(0), batch.column(1)):
                shard = WaveletShard(blob.as_py())
                ids = shard.ids().astype("<u4")
                ends = np.cumsum(shard.lengths)
                begins = ends - shard.lengths
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids, pa.int64()),
                     pa.array(begins + start.as_py(), pa.int64()),
                     pa.array(shard.lengths, pa.int64()),
                     pa.array([zlib.crc32(ids[a:b]) for a, b in zip(begins, ends)], pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    return read_shards(spark, path).select("start", "shard").mapInArrow(run, DOC_SCHEMA)


def find_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """Every occurrence of one id, by ``locate`` on each shard: ``doc_id`` and
    ``place`` (ids of the whole collection before it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, blob in zip(batch.column(0), batch.column(1)):
                shard = WaveletShard(blob.as_py())
                places = np.fromiter(shard.locate(token), np.int64)
                at = np.searchsorted(np.cumsum(shard.lengths), places, side="right")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard.doc_ids[i] for i in at], pa.int64()),
                     pa.array(places + start.as_py(), pa.int64())], ["doc_id", "place"])

    return read_shards(spark, path).select("start", "shard").mapInArrow(
        run, "doc_id long, place long")


def op1_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm-wavelet")
    write_shards(table(spark, sf_dir, "documents"), path)
    return read_documents(spark, path)
