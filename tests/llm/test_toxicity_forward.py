"""The scorer against a plain forward pass, word by word and filter by filter."""

import numpy as np
import pytest

from strata.llm import toxicity as T


def made_up(seed):
    rng = np.random.default_rng(seed)
    embed = rng.normal(size=(T.BUCKETS + 1, T.DIM)).astype(np.float32)
    kernels = [rng.normal(size=(w, T.DIM, T.FILTERS)).astype(np.float32) for w in T.WIDTHS]
    size = len(T.WIDTHS) * T.FILTERS
    return T.Model(embed, kernels, rng.normal(size=size).astype(np.float32), rng.normal(size=size).astype(np.float32),
                   0.3, rng.normal(size=len(T.LANGUAGES) + 1))


def plain(model, text):
    """Score as the docstring has it: embeddings summed over features, every
    window of every width with zeros beyond the end, maximum, rectifier."""
    words = [T.normal(w) for w in text.split()]
    if not words:
        return 0.0
    vectors = [sum(model.embed[f].astype(float) for f in T.features(w)) for w in words]
    values = []
    for kernel in model.kernels:
        for f in range(T.FILTERS):
            windows = []
            for at in range(len(words)):
                windows.append(sum(float(vectors[at + j] @ kernel[j, :, f]) for j in range(len(kernel))
                                   if at + j < len(words)))
            values.append(max(windows))
    values = np.maximum(np.array(values) + model.bias, 0)
    votes = [sum(w in known.split() for w in words) for _, known in T.LANGUAGES]
    language = votes.index(max(votes)) if max(votes) else len(T.LANGUAGES)
    logit = float(values @ model.out + model.out_bias) - model.shift[language]
    return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


TEXTS = ["", "  \n", "one", "The cat and the dog, the END!", "der Hund und die Katze sind nicht da",
         "le chien et la souris", "zzz qqq", "über alles «wichtig» …", "a " * 300 + "b", "x" * 5000]


@pytest.mark.parametrize("seed", [1, 2])
def test_scores_equal_the_plain_forward_pass(seed):
    model = made_up(seed)
    scorer = T.Scorer(model)
    for text in [*TEXTS, *reversed(TEXTS)]:             # words met before and not
        assert scorer.score(text) == pytest.approx(plain(model, text), abs=2e-4)


def test_long_texts_in_steps_and_a_full_memory(monkeypatch):
    model = made_up(3)
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in rng.integers(0, 400, 500)]
    text = " ".join(words * 45)                          # over 20,000 words
    want = T.Scorer(model).score(text)
    assert T.Scorer(model).score(" ".join(words * 2 + words[:2])) == pytest.approx(want, abs=1e-4)
    monkeypatch.setattr(T, "WORD_MEMORY", 50)
    small = T.Scorer(model)
    for own in ("one two three", " ".join(words), text, "one two three"):
        assert small.score(own) == pytest.approx(T.Scorer(model).score(own), abs=1e-6)
