import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from frames import EDGE, clashing, docs

from strata.llm import byte_bpe as B


@pytest.fixture(scope="module")
def coder():
    return B.coder(public_tokenizers.path(B.RANKS))


@pytest.fixture(scope="module")
def reference(coder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.rank,
                             special_tokens={})


def test_equals_merging_by_rank_on_random_texts(coder, reference):
    rng = random.Random(3)
    parts = ["a", "b", "the", "ing", " ", "\n", "é", "ß", "日本", "🙂", "0", "\t", "'s", "zz", "  ",
             "́", "ation", "____", "=====", "\x00", " "]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 90)))
        ids = coder.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text), text
        assert coder.decode(ids) == text.encode()


def test_long_runs_without_spaces(coder, reference):
    for text in ("ab" * 20_000, "x" * 7_000, "aaaabaab" * 900, "=" * 5_000, "é" * 3_000):
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == reference.encode_ordinary(text)


def test_given_documents(spark, small_sf, reference):
    rows = {r.doc_id: r for r in B.op10_byte_bpe(spark, small_sf).collect()}
    given = spark.read.parquet(f"{small_sf}/documents.parquet").collect()
    assert len(rows) == len(given)
    for r in given:
        ids = np.array(reference.encode_ordinary(r.text or ""), "<u4").tobytes()
        got = rows[r.doc_id]
        assert got.n_tokens == len(ids) // 4
        assert got.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert got.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_edge_rows_empty_table_and_clashing_columns(spark):
    df = clashing(docs(spark, EDGE))
    out = B.token_digests(df).collect()
    assert len(out) == len(EDGE)
    empty = hashlib.sha256(b"").hexdigest()
    assert [r.n_tokens for r in out if r.doc_id in (3, 7)] == [0, 0]
    assert all(r.ids_sha256 == empty for r in out if r.doc_id in (3, 7))
    assert len({(r.ids_sha256) for r in out if r.doc_id == 6}) == 1
    assert B.token_digests(df.limit(0)).count() == 0
    coded = B.encode(df)                       # the clashing column is replaced, others stay
    assert dict(coded.dtypes)["token_ids"] == "binary" and "score" in coded.columns
