"""Toxicity by a convolutional text classifier (operator 9).

A word (white-space run, lower-cased, outer marks stripped) is the sum of the
hashed embeddings of its whole form, its beginnings and its endings. Filters of
widths 1, 2 and 3 slide over the whole text; each keeps its largest response
(max pooling) and a logistic layer weighs them. Training is plain numpy on the
driver over a bounded sample: at most ``SAMPLE_ROWS`` labelled documents per
class of at most ``SAMPLE_CHARS`` characters, taken in hash order among rows
whose crc32(doc_id) mod 5 is not 0. One threshold per language (F1 at the classes'
true rates) is calibrated on all labelled documents that are neither held out
nor trained on, scored in Spark and counted per language and logit bin. The
language is guessed from the text's function words, never read from ``lang``;
the logit is shifted by the threshold, so 0.5 is the border everywhere.

Scoring reads whole texts in the task that holds them: no shuffle. Since the
filters are linear before pooling, a word's share of each filter position is
computed once per worker and looked up afterwards.

Rows: a null or empty text, or one of white space, has no words and scores 0.
Repeated rows score alike. Labels that are null, of unknown documents or (for
one document) in conflict: null and unknown ones are ignored, of a conflict
toxic counts. Without labels of both classes every score is 0. Only ``doc_id``
and ``text`` are read for a score; other columns pass through ``reject``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import fresh, table
from strata.operators.joins import sized_broadcast

SAMPLE_ROWS = 1_000
SAMPLE_CHARS = 200_000
BUCKETS = 1 << 16
DIM, FILTERS, WIDTHS = 12, 8, (1, 2, 3)
EPOCHS, BATCH, RATE = 6, 32, 0.15
LEAST_STEPS = 150             # a small sample is passed over more often
KEEP = 0.6                    # share of a text's words in one training step
MIN_DOCS = 3                  # documents of the sample a feature must occur in
CALIBRATION = 4               # every 4th document of the sample is not trained on
BINS, MOST = 64, 40           # calibration bins per unit of logit; logits beyond +-MOST share a bin
#: Words remembered per Python worker; the memory is emptied when full.
WORD_MEMORY = 120_000
#: Rows that leave a Python worker at once: whole texts of a batch would stand in both processes again.
PART_ROWS = 1_000
SEED = 9
MARKS = "".join(map(chr, (*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)))) + "«»“”„’…"
#: Function words by language.
LANGUAGES = (
    ("en", "the of and to in is that for it was on are as with be this by from or at an not"),
    ("de", "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch"),
    ("fr", "le la les de des et un une du en que qui dans pour par sur est pas avec au"),
    ("es", "el la los las de y que en un una por con se para del no su al lo como"),
)


_WHOLE, _BEGINNING = zlib.crc32(b"="), zlib.crc32(b"^")


def features(word: str) -> list[int]:
    """Hashed features of a normalised word: whole form, beginnings of 3 to 8
    characters and endings of 3 and 4, where the word is longer."""
    size, crc, raw = len(word), zlib.crc32, word.encode()
    found = [crc(raw, _WHOLE) % BUCKETS]
    if size < 4:
        return found
    if len(raw) == size:                        # a byte per character
        chars = [raw[k:k + 1] for k in range(3, min(8, size - 1))]
        first, ends = raw[:3], (raw[-3:], raw[-4:])
    else:
        chars = [char.encode() for char in word[3:min(8, size - 1)]]
        first, ends = word[:3].encode(), (word[-3:].encode(), word[-4:].encode())
    running = crc(first, _BEGINNING)
    found.append(running % BUCKETS)
    for char in chars:
        running = crc(char, running)
        found.append(running % BUCKETS)
    found.append(crc(ends[0] + b"$") % BUCKETS)
    if size > 4:
        found.append(crc(ends[1] + b"$") % BUCKETS)
    return found


def normal(raw: str) -> str:
    return raw.lower().strip(MARKS)


@dataclass
class Model:
    """Weights; ``shift`` is the logit threshold per language (last: unknown)."""

    embed: np.ndarray
    kernels: list[np.ndarray]       # per width: (width, DIM, FILTERS)
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    shift: np.ndarray


class Scorer:
    """Scores texts with a model; remembers the words it has met."""

    def __init__(self, model: Model):
        self.model = model
        # all filter positions side by side: (DIM, sum(widths) * FILTERS)
        self.flat = np.concatenate([k for kernel in model.kernels for k in kernel], axis=1)
        self.family = {}
        for at, (_, words) in enumerate(LANGUAGES):
            for word in words.split():
                self.family.setdefault(word, []).append(at)
        self._start()

    def _start(self) -> None:
        self.ids: dict[str, int] = {}           # word as written -> row
        self.forms: dict[str, int] = {}         # normalised word -> row
        self.shares = np.empty((4096, self.flat.shape[1]), np.float32)
        self.votes = np.empty((4096, len(LANGUAGES)), np.float32)

    def _learn(self, words: list[str]) -> None:
        """Rows for words not met before; spellings of one form share a row."""
        some = {w: normal(w) for w in words}
        new = list({f for f in some.values() if f not in self.forms})
        need = len(self.forms) + len(new)
        if need > len(self.shares):
            size = max(need, 2 * len(self.shares))
            for name in ("shares", "votes"):
                old = getattr(self, name)
                grown = np.empty((size, old.shape[1]), np.float32)
                grown[:len(self.forms)] = old[:len(self.forms)]
                setattr(self, name, grown)
        for part in range(0, len(new), 4096):
            block = new[part:part + 4096]
            rows = [features(f) for f in block]
            starts = np.cumsum([0, *map(len, rows[:-1])])
            at = len(self.forms)
            self.shares[at:at + len(block)] = np.add.reduceat(
                self.model.embed[[i for r in rows for i in r]], starts, axis=0) @ self.flat
            self.votes[at:at + len(block)] = 0
            for i, form in enumerate(block):
                if form in self.family:
                    self.votes[at + i, self.family[form]] = 1
            self.forms.update(zip(block, range(at, at + len(block))))
        self.ids.update((w, self.forms[f]) for w, f in some.items())

    def pooled(self, text: str) -> tuple[np.ndarray, int]:
        """Pooled filter values and the guessed language of one text."""
        words = text.split()
        best = np.zeros(len(WIDTHS) * FILTERS, np.float32) - np.inf
        votes = np.zeros(len(LANGUAGES))
        step = 20_000                           # windows overlap, so any cut gives the same
        for at in range(0, len(words), step):
            part = words[at:at + step + max(WIDTHS) - 1]
            known = self.ids
            if missing := [w for w in part if w not in known]:
                if len(known) > WORD_MEMORY:
                    self._start()
                    missing = part
                self._learn(missing)
            ids = np.fromiter(map(self.ids.__getitem__, part), np.int64, len(part))
            rows = self.shares[ids]
            votes += self.votes[ids[:step]].sum(axis=0)
            column = 0
            for i, width in enumerate(WIDTHS):
                own = slice(i * FILTERS, (i + 1) * FILTERS)
                total = None
                for j in range(width):
                    # beyond the end a position adds nothing, as padding would
                    share = rows[j:, column:column + FILTERS]
                    if total is None:
                        total = share.copy()
                    else:
                        total[:len(share)] += share
                    column += FILTERS
                best[own] = np.maximum(best[own], total.max(axis=0))
        language = int(votes.argmax()) if votes.max() > 0 else len(LANGUAGES)
        if not words:
            best[:] = 0
        return np.maximum(best + self.model.bias, 0), language

    def logit(self, text: str) -> tuple[float, int]:
        values, language = self.pooled(text)
        return float(values @ self.model.out + self.model.out_bias), language

    def score(self, text: str) -> float:
        if not text.split():
            return 0.0
        logit, language = self.logit(text)
        return float(1 / (1 + np.exp(-np.clip(logit - self.model.shift[language], -30, 30))))


# ---------------------------------------------------------------------------
# Training
# ---------------------------------------------------------------------------

def trained_on(n: int) -> np.ndarray:
    """Which of ``n`` sampled documents the training uses."""
    return np.arange(n) % CALIBRATION != 0


def train(texts: list[str], labels: np.ndarray) -> Model:
    """A model from the sample, not calibrated yet."""
    rng = np.random.default_rng(SEED)
    vocabulary: dict[str, int] = {}
    docs = []
    for text in texts:
        docs.append(np.array([vocabulary.setdefault(normal(w), len(vocabulary))
                              for w in text.split()] or [vocabulary.setdefault("", len(vocabulary))]))
    rows = [features(w) for w in vocabulary]
    width = max(map(len, rows))
    table_ = np.full((len(rows), width), BUCKETS)
    for i, r in enumerate(rows):
        table_[i, :len(r)] = r
    fit = trained_on(len(texts))
    seen = np.zeros(BUCKETS + 1, np.int32)
    for i in np.flatnonzero(fit):
        seen[np.unique(table_[np.unique(docs[i])])] += 1
    known = seen >= MIN_DOCS
    known[BUCKETS] = False
    table_[~known[table_]] = BUCKETS              # the last row stays zero

    embed = np.zeros((BUCKETS + 1, DIM), np.float32)
    kernels = [rng.normal(0, 0.5, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    bias = np.full(len(WIDTHS) * FILTERS, 0.1, np.float32)
    out = rng.normal(0, 0.5, len(bias)).astype(np.float32)
    out_bias = np.zeros(1, np.float32)
    params = [embed, *kernels, bias, out, out_bias]
    squares = [np.full_like(p, 1e-3) for p in params]

    for _ in range(max(EPOCHS, -(-LEAST_STEPS * BATCH // max(1, int(fit.sum()))))):
        order = rng.permutation(np.flatnonzero(fit))
        for at in range(0, len(order), BATCH):
            batch = order[at:at + BATCH]
            words, inverse = np.unique(np.concatenate([docs[i] for i in batch]),
                                       return_inverse=True)
            vectors = embed[table_[words]].sum(axis=1)
            grads = [np.zeros_like(p) for p in params[1:]]
            touched, pulls, start = [], [], 0
            for i in batch:
                own = inverse[start:start + len(docs[i])]
                start += len(docs[i])
                own = own[rng.random(len(own)) < KEEP] if len(own) > 1 else own
                if not (n := len(own)):
                    continue
                x = np.concatenate((vectors[own], np.zeros((max(WIDTHS) - 1, DIM), np.float32)))
                tops, places = [], []
                for kernel in kernels:
                    r = sum(x[j:j + n] @ kernel[j] for j in range(len(kernel)))
                    places.append(r.argmax(axis=0))
                    tops.append(r[places[-1], np.arange(FILTERS)])
                raw = np.concatenate(tops) + bias
                value = np.maximum(raw, 0)
                logit = float(value @ out + out_bias[0])
                pull = (1 / (1 + np.exp(-logit)) - labels[i]) / len(batch)
                grads[-1][0] += pull
                grads[-2] += pull * value
                back = pull * out * (raw > 0)
                grads[-3] += back
                for k, kernel in enumerate(kernels):
                    for f in np.flatnonzero(back[k * FILTERS:(k + 1) * FILTERS]):
                        g, place = back[k * FILTERS + f], places[k][f]
                        for j in range(len(kernel)):
                            grads[k][j, :, f] += g * x[place + j]
                            if place + j < n:
                                touched.append(words[own[place + j]])
                                pulls.append(g * kernel[j, :, f])
            if touched:
                at_rows = table_[np.array(touched)]
                flat = at_rows.ravel()
                spread = np.repeat(np.array(pulls), at_rows.shape[1], axis=0)
                where, back = np.unique(flat, return_inverse=True)
                total = np.zeros((len(where), DIM), np.float32)
                np.add.at(total, back, spread)
                total[where == BUCKETS] = 0
                squares[0][where] += total ** 2
                embed[where] -= RATE * total / np.sqrt(squares[0][where])
            for p, s, g in zip(params[1:], squares[1:], grads):
                s += g ** 2
                p -= RATE * 0.3 * g / np.sqrt(s)

    return Model(embed, kernels, bias, out, float(out_bias[0]), np.zeros(len(LANGUAGES) + 1))


def shifts(counts: list[tuple[int, int, int, int]], sizes: dict[int, int]) -> np.ndarray:
    """The threshold of each language from rows of (language, bin, toxic, n);
    ``sizes`` are the labelled documents of class 0 and 1."""
    rows = np.array(counts, np.int64).reshape(-1, 4)
    seen = [rows[rows[:, 2] == y, 3].sum() for y in (0, 1)]
    rates = [sizes[y] / max(1, seen[y]) for y in (0, 1)]
    everywhere = _threshold(rows, rates, 0.0)
    return np.array([_threshold(rows[rows[:, 0] == k], rates, everywhere)
                     for k in range(len(LANGUAGES) + 1)])


def _threshold(rows: np.ndarray, rates: list[float], otherwise: float, least: int = 5) -> float:
    """The cut of best F1, in the middle of the widest gap among equals."""
    toxic = rows[:, 2] == 1
    if rows[toxic, 3].sum() < least or rows[~toxic, 3].sum() < least:
        return otherwise
    bins, place = np.unique(-rows[:, 1], return_inverse=True)      # highest logits first
    hit = np.bincount(place, np.where(toxic, rows[:, 3] * rates[1], 0.0))
    all_ = np.bincount(place, rows[:, 3] * np.where(toxic, rates[1], rates[0]))
    f1 = 2 * np.cumsum(hit) / (hit.sum() + np.cumsum(all_))
    value = (0.5 - bins) / BINS
    gap = np.r_[value[:-1] - value[1:], 1 / BINS]
    best = max(range(len(f1)), key=lambda i: (round(f1[i], 6), gap[i]))
    return float(value[best] - gap[best] / 2)


# ---------------------------------------------------------------------------
# Spark
# ---------------------------------------------------------------------------

def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def calibration_counts(labelled: DataFrame, model: Model) -> DataFrame:
    """``language, bin, toxic, n`` of the documents in ``labelled`` (``text, toxic``)
    that have words: at most 2 * MOST * BINS bins per language and class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            rows = []
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                if (text := text.as_py() or "").split():
                    logit, language = scorer.logit(text)
                    rows.append((language, int(np.floor(np.clip(logit, -MOST, MOST) * BINS)), toxic))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], pa.int32()) for i in range(3)], ["language", "bin", "toxic"])

    return (labelled.select("text", F.col("toxic").cast("int").alias("toxic"))
            .mapInArrow(run, "language int, bin int, toxic int")
            .groupBy("language", "bin", "toxic").agg(F.count(F.lit(1)).alias("n")))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Train on a bounded sample of the labelled documents (collected), calibrate
    on all others that are not held out. Runs jobs."""
    known = (labels.where("toxic is not null and doc_id is not null")
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~held_out(F.col("doc_id"))))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n"))
             .where("toxic in (0, 1)").collect()}
    if len(sizes) < 2:
        return None
    picks = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id")
             .limit(sample_rows) for y in (0, 1)]
    sample = (docs.where(F.length("text") <= SAMPLE_CHARS).select("doc_id", "text")
              .join(F.broadcast(picks[0].union(picks[1])), "doc_id")     # 2 x sample_rows at most
              .orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(2 * sample_rows).collect())
    y = np.array([r["toxic"] for r in sample])
    if (y == 1).sum() < 4 or (y == 0).sum() < 4:
        return None
    model = train([r["text"] for r in sample], y)
    used = {(r["doc_id"],) for r, own in zip(sample, trained_on(len(sample))) if own}
    used = docs.sparkSession.createDataFrame(list(used), docs.select("doc_id").schema)
    rest = known.where("toxic in (0, 1)").join(F.broadcast(used), "doc_id", "left_anti")
    labelled = docs.select("doc_id", "text").join(sized_broadcast(rest), "doc_id")
    model.shift = shifts([tuple(r) for r in calibration_counts(labelled, model).collect()], sizes)
    return model


_SCORERS: dict[bytes, Scorer] = {}


def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in order, ``PART_ROWS`` at a time, not copied."""
    for at in range(0, batch.num_rows, PART_ROWS):
        yield batch.slice(at, PART_ROWS)


def with_score(df: DataFrame, model: Model | None, name: str = "score",
               text_col: str = "text") -> DataFrame:
    """``df`` with the score of ``text_col`` as ``name``."""
    if model is None:
        return df.withColumn(name, F.lit(0.0))
    keep = [f for f in df.schema.fields if f.name != name]
    schema = T.StructType([*keep, T.StructField(name, T.DoubleType())])
    key = str((model.out.tolist(), model.shift.tolist())).encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[key] = Scorer(model)
        scorer = _SCORERS[key]
        for batch in chain.from_iterable(map(parts, batches)):
            scores = [scorer.score(v.as_py() or "") for v in batch.column(text_col)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in keep), pa.array(scores, pa.float64())],
                [f.name for f in schema.fields])

    return df.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document its score and decision; ``held_out`` rows took no part in
    the training."""
    scored = with_score(docs.select("doc_id", "text"), fit(docs, labels)).drop("text")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that the classifier finds toxic."""
    name = fresh(docs, "score")
    return with_score(docs, fit(docs, labels), name).where(F.col(name) < 0.5).select(*docs.columns)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
