"""Packing against the library's ids, a plain sum of squares, and awkward rows."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from strata.llm import packing as P
from frames import EDGE, clashing, docs


TOKENIZER = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [2]


def check_pieces(rows, texts, window):
    """Every id once, windows gapless, no padding; ``texts`` by distinct id."""
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_window[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids, at = ids_of(texts[doc]), 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            at += p.length
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start:at], "<u4").tobytes())
        assert at == len(ids)
    for pieces in by_window.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window and at & (at - 1) == 0       # full, or a power of two


def test_given_documents(spark, small_sf):
    given = spark.read.parquet(f"{small_sf}/documents.parquet").repartition(3)
    got = P.pieces_of(P.pack(given)).collect()
    check_pieces(got, {r.doc_id: r.text for r in given.collect()}, P.WINDOW)


@pytest.mark.parametrize("most_open", [1, 3, 2048])
def test_few_open_windows(spark, small_sf, most_open):
    given = spark.read.parquet(f"{small_sf}/documents.parquet").select("doc_id", "text")
    got = P.pieces_of(P.pack(given, window=256, most_open=most_open)).collect()
    check_pieces(got, {r.doc_id: r.text for r in given.collect()}, 256)


def test_odd_rows(spark):
    rows = [r for r in EDGE if r[0] != 6]                # 6 stands twice
    got = P.pieces_of(P.pack(clashing(docs(spark, rows)).coalesce(1))).collect()
    check_pieces(got, {r[0]: r[1] for r in rows}, P.WINDOW)
    twice = P.pieces_of(P.pack(docs(spark, [(6, "one two", None, None)] * 2).coalesce(1))).collect()
    assert sum(r.length for r in twice) == 2 * len(ids_of("one two"))


def test_empty_table(spark):
    assert P.pieces_of(P.pack(docs(spark, []))).collect() == []
    with pytest.raises(ValueError):
        P.pack(docs(spark, []), window=100)


def squares(levels):
    return sum(n * n for h, n in levels.items() if n)


def test_each_piece_lands_with_the_least_sum_of_squares():
    rng, packer, window = random.Random(5), P.Packer(64, 1), 64
    for k in range(600):
        size = rng.choice([rng.randint(1, 63), 30, 34, 7])
        levels = {h: int(n) for h, n in enumerate(packer.levels) if n}
        outcomes = {}
        for h in [0, *levels]:
            if h + size <= window:
                after = dict(levels)
                if h:
                    after[h] -= 1
                if h + size < window:
                    after[h + size] = after.get(h + size, 0) + 1
                outcomes[h] = squares(after)
        chosen = packer.level_for(size)
        assert outcomes[chosen] == min(outcomes.values())
        assert chosen == max(h for h, v in outcomes.items() if v == outcomes[chosen])
        packer.add(k, bytes(size))
    packer.finish()
    assert not packer.levels.any() and not packer.n_open


def test_whole_documents_stay_whole_while_windows_are_open():
    """Cuts come only from the last pour."""
    rng, packer = random.Random(7), P.Packer(4096, 1)
    for k in range(3000):
        packer.add(k, bytes(rng.randint(1, 4095)))
    assert all(p.doc_tokens == len(p.ids) for w in packer.closed for p in w)
    before = len(packer.closed)
    packer.finish()
    cut = {p.doc for w in packer.closed for p in w if p.doc_tokens != len(p.ids)}
    assert before > 0 and len(cut) < 300
