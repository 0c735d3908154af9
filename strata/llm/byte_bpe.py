"""Byte-level BPE encoding and decoding (operator 10).

Ranks come from a tiktoken-style file (``base64(token) rank`` per line). Bytes
are mapped to Latin-1 characters so that ``pyahocorasick`` can hold the token
strings; one pass of the automaton gives, for every byte position of a piece,
the longest token that starts there. The encoder takes the longest token and
backtracks to the next shorter prefix token whenever the token does not fit
its left neighbour. Two neighbours fit when undoing their merges, latest first,
meets no earlier merge across their border; that answer is memoised per pair.
A position that was given up is never entered again, so a piece takes linear
time, and the result equals merging by rank.

Rows: a null text counts as empty (no ids, decodes to no bytes). Repeated rows
are encoded independently. Other columns of the input pass through unless they
carry the name of an output column, which is then replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import table

RANKS = "byte_bpe_50k.tiktoken"
#: Pieces remembered per task; the memory is emptied when full.
PIECE_MEMORY = 400_000


class BytePairCoder:
    """Encoder and decoder over one rank file."""

    def __init__(self, ranks_path: str, pattern: str = public_tokenizers.PATTERN):
        with open(ranks_path, "rb") as lines:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.token = {r: t for t, r in self.rank.items()}
        self.pieces = regex.compile(pattern).findall
        self.words = ahocorasick.Automaton()
        for token, rank in self.rank.items():
            self.words.add_word(token.decode("latin-1"), (len(token), rank))
        self.words.make_automaton()
        self._halves: dict[int, tuple[int, int]] = {}
        self._fits: dict[tuple[int, int], bool] = {}
        self._shorter: dict[int, int] = {}
        self._memory = _PieceMemory(self)

    # -- tables, filled on demand -------------------------------------------

    def halves(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge makes ``token``."""
        found = self._halves.get(token)
        if found is None:
            parts = [bytes([b]) for b in self.token[token]]
            while len(parts) > 2:
                _, at = min((self.rank.get(parts[i] + parts[i + 1], len(self.rank) * 2), i)
                            for i in range(len(parts) - 1))
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            found = self._halves[token] = (self.rank[parts[0]], self.rank[parts[1]])
        return found

    def shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of ``token``; -1: none."""
        found = self._shorter.get(token)
        if found is None:
            text = self.token[token]
            found = next((self.rank[text[:n]] for n in range(len(text) - 1, 0, -1)
                          if text[:n] in self.rank), -1)
            self._shorter[token] = found
        return found

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens can stand side by side in an encoding."""
        key = (left, right)
        found = self._fits.get(key)
        if found is None:
            if len(self._fits) > 4 * PIECE_MEMORY:
                self._fits.clear()
            found = self._fits[key] = self._neighbours(left, right)
        return found

    def _neighbours(self, left: int, right: int) -> bool:
        token, never = self.token, len(self.rank) * 2
        limit = never
        while True:
            a, b = token[left], token[right]
            if self.rank.get(a + b, never) < limit:
                return False            # an earlier merge would have crossed the border
            if len(a) == 1 and len(b) == 1:
                return True
            if len(b) == 1 or (len(a) > 1 and left > right):
                limit, left = left, self.halves(left)[1]
            else:                       # of equal merges the left one comes first
                limit, right = right + 1, self.halves(right)[0]

    # -- pieces --------------------------------------------------------------

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.rank.get(piece)
        if whole is not None:
            return [whole]
        longest = [-1] * len(piece)
        for end, (n, token) in self.words.iter(piece.decode("latin-1")):
            longest[end + 1 - n] = token          # ends ascend, so the longest stays
        token_bytes = self.token
        open_ends = bytearray(b"\x01") * (len(piece) + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < len(piece):
            last = out[-1] if out else -1
            while token >= 0:
                end = at + len(token_bytes[token])
                if open_ends[end] and (last < 0 or self.fits(last, token)):
                    break
                token = self.shorter(token)
            if token >= 0:
                out.append(token)
                at = end
                token = longest[at] if at < len(piece) else -1
            else:
                if not out:
                    raise ValueError("the ranks lack a byte of the text")
                open_ends[at] = 0
                token = out.pop()
                at -= len(token_bytes[token])
        return out

    # -- texts ---------------------------------------------------------------

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self._memory.__getitem__, self.pieces(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def forget(self) -> None:
        """Empties the memories: a worker that waits for its next task, perhaps of
        another operator, holds the ranks only."""
        for held in (self._memory, self._fits, self._halves, self._shorter):
            held.clear()


class _PieceMemory(dict):
    def __init__(self, coder: BytePairCoder):
        super().__init__()
        self.coder = coder

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= PIECE_MEMORY:
            self.clear()
        ids = np.array(self.coder.encode_piece(piece.encode()), "<u4").tobytes()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


_CODERS: dict[tuple[str, str], BytePairCoder] = {}


def coder(ranks_path: str, pattern: str = public_tokenizers.PATTERN) -> BytePairCoder:
    """One coder per Python process, rank file and pattern."""
    key = (ranks_path, pattern)
    if key not in _CODERS:
        _CODERS[key] = BytePairCoder(ranks_path, pattern)
    return _CODERS[key]


def _with_binary(df: DataFrame, name: str) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != name]
                        + [T.StructField(name, T.BinaryType())])


def _mapped(df: DataFrame, source: str, name: str, make) -> DataFrame:
    """``df`` with binary column ``name`` made from column ``source`` by
    ``make()`` (called once per task: the function and one to call at the task's
    end) a value at a time, in Arrow batches."""
    schema = _with_binary(df, name)
    rest = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, end = make()
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    part = batch.slice(at, 1024)
                    made = [one(v) for v in part.column(source).to_pylist()]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(c) for c in rest] + [pa.array(made, pa.binary())], [*rest, name])
        finally:
            end()

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, text_col: str = "text", ids_col: str = "token_ids",
           ranks_path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Add ``ids_col``: the ids of the whole text as little-endian unsigned
    32-bit integers. No shuffle; each row is encoded in the task that reads it."""
    path = ranks_path or public_tokenizers.path(RANKS)

    def make():
        encoder = coder(path, pattern)
        return lambda text: encoder.encode(text or ""), encoder.forget

    return _mapped(df, text_col, ids_col, make)


def decode(df: DataFrame, ids_col: str = "token_ids", bytes_col: str = "decoded",
           ranks_path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Add ``bytes_col``: the bytes that the ids in ``ids_col`` stand for."""
    path = ranks_path or public_tokenizers.path(RANKS)

    def make():
        decoder = coder(path, pattern)
        return lambda ids: decoder.decode(ids or b""), decoder.forget

    return _mapped(df, ids_col, bytes_col, make)


def token_digests(docs: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """Encode every document, decode the ids, and keep length and digests."""
    coded = decode(encode(docs.select("doc_id", "text"), ranks_path=ranks_path).drop("text"),
                   ranks_path=ranks_path)
    return coded.select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))
