"""Spelling variants against all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from strata.llm import spelling as S

def brute_words(docs, min_length=7, min_count=2):
    seen = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 31 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            if len(word) >= min_length:
                seen[word] += 1
    return {w: n for w, n in seen.items() if n >= min_count}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_variants(n):
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and distance(v, w) == 1] for w in n}
    form = {}
    for w, others in near.items():
        top = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = top if top is not None and n[top] >= 10 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def rows_of(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def made_up(seed, size, letters="abcdé"):
    rng = random.Random(seed)
    words = {}
    while len(words) < size:
        word = "".join(rng.choice(letters) for _ in range(rng.randint(7, 9)))
        words[word] = 2
        for _ in range(3):                     # its neighbours, of other frequencies
            i = rng.randrange(len(word))
            other = rng.choice([word[:i] + word[i + 1:], word[:i] + rng.choice(letters) + word[i:],
                                word[:i] + rng.choice(letters) + word[i + 1:]])
            if len(other) >= 7:
                words[other] = rng.choice([2, 5, 30, 60, 700, 9000])
    return words


@pytest.mark.parametrize("letters", ["abcdé", "ab"])
@pytest.mark.parametrize("shard_words", [100_000, 20, 1])
def test_all_pairs_at_any_depth(spark, shard_words, letters):
    """At one word a shard every node is split, whole vectors too."""
    n = made_up(3, 250, letters)
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    assert rows_of(S.variants(spark, words, shard_words=shard_words)) == brute_variants(n)


def test_given_documents(spark, small_sf):
    docs = spark.read.parquet(f"{small_sf}/documents.parquet")
    n = brute_words([(r.doc_id, r.text) for r in docs.collect()])
    words = {r.word: r.n for r in S.count_words(docs).collect()}
    assert words == n
    some = dict(sorted(n.items())[:1500])
    frame = spark.createDataFrame(list(some.items()), "word string, n long")
    assert rows_of(S.variants(spark, frame, shard_words=100)) == brute_variants(some)


def test_words_of_odd_rows(spark):
    rows = [(1, "Éclairs éclairs ÉCLAIRS abcdefg"), (1, "Éclairs éclairs ÉCLAIRS abcdefg"), (2, None),
            (None, "abcdefg ABCDEFG"), (3, ""), (4, "straße×straße÷ façade_façades"), (5, "x" * 3000)]
    docs = spark.createDataFrame([(d, t, "n", "w") for d, t in rows], "doc_id long, text string, n string, word string")
    assert {r.word: r.n for r in S.count_words(docs).collect()} == brute_words(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.count_words(docs).collect() == []
    words = spark.createDataFrame([], "word string, n long")
    assert S.variants(spark, words).collect() == []


def test_chain_of_forms_and_ties(spark):
    n = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2000, "abcdefx": 20,
         "zzzzzzz": 3, "yzzzzzz": 30, "xzzzzzz": 30}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    got = rows_of(S.variants(spark, words))
    assert got == brute_variants(n)
    assert got["abcdefg"][:2] == ("abcdefgh", "abcdefghij") and got["zzzzzzz"][0] == "xzzzzzz"


def test_vector_and_columns_agree(spark):
    words = ["etaoin", "éclair", "abcdefghijklmnopqrstuvwxyz", "zzzzÀ"]
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    got = {r.word: r.node for r in frame.withColumn("node", S._node(S.LEVELS)).collect()}
    assert got == {w: ".".join(map(str, S.vector(w))) for w in words}
