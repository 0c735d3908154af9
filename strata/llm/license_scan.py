"""License scan by ordered signature rules (operator 6).

Each whole text is lower-cased (A-Z) and cut into words of ASCII letters,
digits and non-ASCII characters. One Aho-Corasick pass finds which keywords
occur; only rules whose keyword occurs are matched, on the words joined by one
space. Detections are word intervals. They are taken by rule order (then the
longer, then the earlier one), and a detection whose interval lies within one
already taken is suppressed, as is one that holds a taken base phrase or text
of the same label. Base phrases are never suppressed.

Rows: a null or empty text has no words and no detections (labels ``''``,
score 0, first and last word null). Repeated rows are scanned independently.
Only ``doc_id`` and the text are read, so other columns cannot clash. There is
no shuffle; a task holds one Arrow batch.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import table
from strata.llm.license_rules import Rule, rules

# A-Z to a-z, the other ASCII characters outside letters and digits to a space.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
             for c in range(256))


class Scanner:
    def __init__(self, table_of_rules: tuple[Rule, ...]):
        self.rules = [(r, re.compile(rf"(?<![^ ]){r.pattern}(?![^ ])")) for r in table_of_rules]
        self.gate = ahocorasick.Automaton()
        by_keyword: dict[str, list] = {}
        for rule in self.rules:
            by_keyword.setdefault(rule[0].keyword, []).append(rule)
        for keyword, own in by_keyword.items():
            self.gate.add_word(keyword, (keyword, own))
        self.gate.make_automaton()

    def words(self, text: str) -> list[bytes]:
        return text.encode().translate(FOLD).split()

    def detections(self, words: list[bytes]) -> list[tuple[int, int, Rule]]:
        """All matches before suppression, as word intervals."""
        joined = b" ".join(words).decode("latin-1")
        open_rules = {k: own for _, (k, own) in self.gate.iter(joined)}
        if not open_rules:
            return []
        starts, at = [], 0
        for word in words:
            starts.append(at)
            at += len(word) + 1
        found = []
        for own in open_rules.values():
            for rule, pattern in own:
                at = 0
                while match := pattern.search(joined, at):
                    first = bisect_right(starts, match.start()) - 1
                    found.append((first, bisect_right(starts, match.end() - 1), rule))
                    at = match.start() + 1      # places may overlap
        return found

    @staticmethod
    def resolve(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
        """Detections left after suppression by priority and containment."""
        kept: list[tuple[int, int, Rule]] = []
        over: dict[int, list[tuple[int, int, Rule]]] = {}      # by word that it covers
        for a, b, rule in sorted(found, key=lambda d: (d[2].order, d[0] - d[1], d[0])):
            inside = any(x <= a and b <= y for x, y, _ in over.get(a, ()))
            around = any(a <= x and y <= b and other.label == rule.label
                         for word in range(a, b) for x, y, other in over.get(word, ()))
            if rule.base or not (inside or around):
                kept.append((a, b, rule))
                for word in range(a, b):
                    over.setdefault(word, []).append(kept[-1])
        return sorted(kept, key=lambda d: (d[0], d[1], d[2].order))


@lru_cache(maxsize=1)
def _standard() -> Scanner:
    return Scanner(rules())


SCHEMA = ("doc_id long, n_words long, spans array<struct<first_word:long,end_word:long,"
          "label:string,rule:int,weight:double,base:boolean>>")


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Per document its number of words and the detections that remain, in
    place order: word interval, label, rule, weight and whether it is a base
    phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _standard()
        kind = pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()),
                                   ("label", pa.string()), ("rule", pa.int32()),
                                   ("weight", pa.float64()), ("base", pa.bool_())]))
        for batch in batches:
            sizes, spans = [], []
            for text in batch.column(1):
                words = scanner.words(text.as_py() or "")
                sizes.append(len(words))
                spans.append([{"first_word": a, "end_word": b, "label": r.label, "rule": r.order,
                               "weight": r.weight, "base": r.base}
                              for a, b, r in scanner.resolve(scanner.detections(words))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, kind)],
                ["doc_id", "n_words", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col(text_col).alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def summary(scanned: DataFrame) -> DataFrame:
    """One line per document from its detections."""
    base = F.filter("spans", lambda s: s["base"])

    def labels(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))),
                            ",")

    starts = F.transform(base, lambda s: s["first_word"])
    return scanned.select(
        "doc_id", "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["weight"])), F.lit(0.0))
        .alias("score"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(scan(table(spark, sf_dir, "documents")))
