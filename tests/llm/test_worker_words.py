import sys

import pytest
from test_toxicity_forward import made_up

from strata.llm import toxicity as X


def test_the_memory_of_words_stays_small():
    """A worker scores any number of words within 100 MB beside the model."""
    scorer = X.Scorer(made_up(1))
    most = 0
    for d in range(40):
        scorer.score(" ".join(f"word{d}x{k}" for k in range(10_000)))
        texts = {id(w): sys.getsizeof(w) for held in (scorer.ids, scorer.forms) for w in held}
        most = max(most, scorer.shares.nbytes + scorer.votes.nbytes + sys.getsizeof(scorer.ids)
                   + sys.getsizeof(scorer.forms) + sum(texts.values()))
    assert most < 100e6


@pytest.mark.parametrize("word", ["", "a", "abc", "abcd", "abcde", "a" * 12, "über", "日本語のと", "naïveté", "éabcdefghi"])
def test_features_of_a_word(word):
    crc, size = X.zlib.crc32, len(word)
    want = [f"={word}", *(f"^{word[:k]}" for k in range(3, min(8, size - 1) + 1)),
            *(f"{word[-k:]}$" for k in (3, 4) if size > k)]
    assert X.features(word) == [crc(w.encode()) % X.BUCKETS for w in want]
