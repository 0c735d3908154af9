"""Packing documents into fixed windows by sum of squares (operator 13).

Documents become token ids and are packed, in the order in which a task reads
them, into windows of ``WINDOW`` ids.

* A document's full windows are cut off first; its rest is placed whole.
* Sum of squares: the level array holds, for each fill level, how many windows
  stand at it. The rest goes to the level (an open window, or a new one at level
  zero) after which the sum of the squared counts is least; ties go to the
  fullest. So levels that already hold many windows are drained and no level
  piles up, which leaves little unfilled for any mix of lengths, online.
* A window that reaches ``WINDOW`` is closed and leaves. At most ``OPEN`` windows
  stay open: beyond that, and at the end of the task, windows are poured
  together, the emptiest into the gaps of the fullest, cutting documents there.
* One window is left in each task: it is cut into windows of powers of two, which
  need no padding. So there is no padding at all, and few documents are cut.

Each task packs what it reads: nothing is shuffled, grouped or sorted, a hot
source is like any other, and a task that runs again packs the same rows the same
way. A task holds at most ``OPEN`` windows and one document.

Rows: a null or empty text is a document of its end id alone; equal rows and a
shared or null ``doc_id`` are documents of their own; an empty table gives no
windows; a document of any length is cut into as many windows as it fills.
Columns but ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import table
from strata.llm.wavelet import END_ID, TOKENIZER, word_coder

WINDOW = 4096
#: Open windows a task holds (the ids of at most ``OPEN * WINDOW`` tokens).
OPEN = 2048


class Piece(NamedTuple):
    """A run of one document's ids: ``ids`` are its bytes."""

    doc: object
    start: int
    ids: bytes
    doc_tokens: int


class Packer:
    """Places documents online; closed windows are lists of pieces."""

    def __init__(self, window: int = WINDOW, width: int = 2, most_open: int = OPEN):
        self.window, self.width, self.most_open = window, width, most_open
        self.levels = np.zeros(window + 1, np.int64)         # windows at each fill level
        self.standing: list[list[list[Piece]]] = [[] for _ in range(window + 1)]
        self.n_open = 0
        self.closed: list[list[Piece]] = []

    def _length(self, piece: Piece) -> int:
        return len(piece.ids) // self.width

    def level_for(self, size: int) -> int:
        """The fill level at which a piece of ``size`` ids lands with the least
        sum of squares; the change is 2 (after - before) + 2, new windows have
        no level to leave, full ones none to reach."""
        last = self.window - size
        before, after = self.levels[:last + 1], self.levels[size:]
        change = 2 * (after - before) + 2
        change[last] = 1 - 2 * before[last]                  # fills the window
        change[before == 0] = np.iinfo(np.int64).max
        change[0] = 2 * after[0] + 1 if last else 0          # a new window
        return last - int(np.argmin(change[::-1]))           # ties: the fullest

    def _put(self, level: int, windows: list[Piece]) -> None:
        if level == self.window:
            self.closed.append(windows)
            return
        self.standing[level].append(windows)
        self.levels[level] += 1
        self.n_open += 1

    def _take(self, level: int) -> list[Piece]:
        self.levels[level] -= 1
        self.n_open -= 1
        return self.standing[level].pop()

    def add(self, doc, ids: bytes) -> None:
        total, step = len(ids) // self.width, self.window * self.width
        for at in range(0, len(ids), step):
            piece = Piece(doc, at // self.width, ids[at:at + step], total)
            size = self._length(piece)
            if size == self.window:
                self.closed.append([piece])
                continue
            level = self.level_for(size)
            self._put(level + size, (self._take(level) if level else []) + [piece])
        if self.n_open > self.most_open:
            self.pour(self.most_open // 2)

    def pour(self, keep: int) -> None:
        """Pour the emptiest windows into the gaps of the fullest until at most
        ``keep`` are open."""
        while self.n_open > keep:
            filled = np.flatnonzero(self.levels)
            low, high = int(filled[0]), int(filled[-1])
            source = self._take(low)
            if low == high and not self.levels[high]:        # one window only
                self._put(low, source)
                return
            target, level = self._take(high), high
            while source and level < self.window:
                piece = source.pop(0)
                cut = (self.window - level) * self.width
                target.append(piece._replace(ids=piece.ids[:cut]))
                level += self._length(target[-1])
                if len(piece.ids) > cut:
                    source.insert(0, piece._replace(start=piece.start + cut // self.width,
                                                    ids=piece.ids[cut:]))
            self._put(level, target)
            if source:
                self._put(sum(map(self._length, source)), source)

    def finish(self) -> None:
        """Close every window, without padding."""
        self.pour(1)
        for level in np.flatnonzero(self.levels):
            rest, bit = self._take(int(level)), self.window
            while rest:
                bit >>= 1
                size = sum(map(self._length, rest))
                if not size & bit:
                    continue
                part, need = [], bit
                while need:
                    piece = rest.pop(0)
                    cut = need * self.width
                    part.append(piece._replace(ids=piece.ids[:cut]))
                    need -= self._length(part[-1])
                    if len(piece.ids) > cut:
                        rest.insert(0, piece._replace(start=piece.start + cut // self.width,
                                                      ids=piece.ids[cut:]))
                self.closed.append(part)

    def drain(self) -> list[list[Piece]]:
        out, self.closed = self.closed, []
        return out


WINDOWS = pa.schema([
    ("sequence_id", pa.int64()), ("ids", pa.binary()),
    ("pieces", pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                                   ("offset", pa.int64()), ("doc_tokens", pa.int64())])))])
WINDOW_SCHEMA = ("sequence_id long, ids binary, pieces array<struct<doc_id:long, start:long, "
                 "length:long, offset:long, doc_tokens:long>>")


def pack(docs: DataFrame, window: int = WINDOW, tokenizer_path: str | None = None,
         end_id: int = END_ID, most_open: int = OPEN) -> DataFrame:
    """``sequence_id, ids, pieces`` per window of ``docs`` (``doc_id, text``):
    ``ids`` are its ids as little-endian unsigned 32-bit integers, without
    padding, ``pieces`` the documents in it, in order. ``window`` is a power of
    two. The numbers of a task's windows start at its number times 2^40."""
    if window < 2 or window & (window - 1):
        raise ValueError(f"window must be a power of two, not {window}")
    path = tokenizer_path or public_tokenizers.path(TOKENIZER)

    def rows(packer: Packer, kind: str, at: int) -> pa.RecordBatch:
        out = []
        for number, pieces in enumerate(packer.drain(), at):
            offset, parts = 0, []
            for p in pieces:
                length = len(p.ids) // packer.width
                parts.append({"doc_id": p.doc, "start": p.start, "length": length,
                              "offset": offset, "doc_tokens": p.doc_tokens})
                offset += length
            ids = np.frombuffer(b"".join(p.ids for p in pieces), kind).astype("<u4").tobytes()
            out.append({"sequence_id": number, "ids": ids, "pieces": parts})
        return pa.RecordBatch.from_pylist(out, schema=WINDOWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_coder(path)
        end = np.array([end_id], coder.kind).tobytes()
        packer = Packer(window, len(end), most_open)
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            for place in range(0, batch.num_rows, 256):
                part = batch.slice(place, 256)
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    packer.add(doc, coder.encode(text or "") + end)
                    if len(packer.closed) >= 256:
                        out = rows(packer, coder.kind, at)
                        at += out.num_rows
                        yield out
        packer.finish()
        if packer.closed:
            yield rows(packer, coder.kind, at)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, WINDOW_SCHEMA)


def pieces_of(windows: DataFrame) -> DataFrame:
    """The pieces of packed windows, one row each, with the checksum of their ids."""
    piece = F.col("piece")
    ids = F.substring("ids", (4 * piece["offset"] + 1).cast("int"), (4 * piece["length"]).cast("int"))
    return (windows.select("sequence_id", "ids", F.explode("pieces").alias("piece"))
            .select(piece["doc_id"].alias("doc_id"), piece["start"].alias("start"),
                    piece["length"].alias("length"), F.crc32(ids).alias("ids_crc32"),
                    piece["doc_tokens"].alias("doc_tokens"), "sequence_id",
                    piece["offset"].alias("offset")))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces_of(pack(table(spark, sf_dir, "documents")))
