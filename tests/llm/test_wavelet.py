import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from frames import EDGE, clashing, docs
from tokenizers import Tokenizer

from strata.llm import wavelet as W


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(W.TOKENIZER))


def test_matrix_access_count_locate():
    rng = np.random.default_rng(1)
    x = (rng.zipf(1.3, 300_000) % 49_408).astype(np.uint16)
    shard = W.WaveletShard(W.build_shard(x, 16, [None, 5, 7], [100_000, 0, 200_000]))
    assert (shard.ids() == x).all()
    assert shard.doc_ids == [None, 5, 7] and shard.lengths.tolist() == [100_000, 0, 200_000]
    for at in (0, 1, 131_071, 131_072, 299_999):
        assert shard.access(at) == x[at]
    for token in (1, 2, 77, 49_407, 60_000, 99_999):
        assert shard.count(token) == (x == token).sum()
        assert shard.count(token, 999, 200_001) == (x[999:200_001] == token).sum()
    assert list(shard.locate(500, 7, 250_000)) == (np.flatnonzero(x[7:250_000] == 500) + 7).tolist()
    with pytest.raises(IndexError):
        shard.access(300_000)
    assert W.WaveletShard(W.build_shard(x[:0], 16, [], [])).ids().size == 0


def test_word_memory_equals_the_tokenizer(tokenizer):
    coder = W.word_coder(public_tokenizers.path(W.TOKENIZER))
    rng = random.Random(2)
    parts = ["a", "B", "The", "ing", " ", "\n", "é", "É", "ß", "日本", "🙂", "0", "\t", "'s", "'S",
             "Don't", "it's,", " ", " ", "́", "ation", "____", "\x1c", "\x0b", "\x85",
             "İ", "Σ", ".,;", "<|endoftext|>", "ﬁ", "...", "?!", "café.", "Größe", "ÑANDÚ", "œuvre", "Ÿ", "ǅ", "ʼn", "ſ", "ª", "µ", "Å", "ẞ", "Ǆ", "***", "#$%", "x)", "y\"", "'", "'.", "\"'s"]
    for _ in range(2500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 50)))
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(coder.encode(text), "<u2").tolist() == want, repr(text)


def brute(rows, tokenizer):
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1])):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, W.END_ID]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def check(spark, df, tokenizer, path, **options):
    W.write_shards(df, path, **options)
    got = [tuple(r) for r in W.read_documents(spark, path).orderBy("start").collect()]
    assert got == brute([(r.doc_id, r.text) for r in df.collect()], tokenizer)


def test_shards_of_edge_rows(spark, tokenizer, tmp_path):
    df = clashing(docs(spark, EDGE))
    check(spark, df, tokenizer, f"{tmp_path}/one", shard_ids=40)
    assert W.read_shards(spark, f"{tmp_path}/one").count() > 3
    W.write_shards(df.limit(0), f"{tmp_path}/none")
    assert W.read_documents(spark, f"{tmp_path}/none").count() == 0


def test_given_documents_and_occurrences(spark, small_sf, tokenizer, tmp_path):
    df = spark.read.parquet(f"{small_sf}/documents.parquet").select("doc_id", "text")
    check(spark, df.repartition(5), tokenizer, f"{tmp_path}/docs", shard_ids=3000)
    token = tokenizer.encode("and", add_special_tokens=False).ids[0]
    found = W.find_token(spark, f"{tmp_path}/docs", token)
    want = sum(tokenizer.encode(r.text or "", add_special_tokens=False).ids.count(token)
               for r in df.collect())
    assert found.count() == want and found.select("place").distinct().count() == want
    rows = W.op1_wavelet_tokens(spark, small_sf)
    assert rows.count() == df.count() and rows.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
