"""Every written sentence against a sample of its own and a near miss; suppression
against a plain reading of its rule."""

import random
import re

import pytest

from strata.llm.license_rules import literal, rules
from strata.llm.license_scan import Scanner
from strata.llm.license_texts import SENTENCES

SCANNER = Scanner(rules())


def sample(pattern):
    """A text that the pattern describes: first alternatives, optional parts left out."""
    text = re.sub(r"\.\{\d+,\d+\}\??", "some one", pattern)
    while True:
        shorter = re.sub(r"\(\?:[^()]*\)\?", "", text)
        shorter = re.sub(r"\(\?:([^()|]*)[^()]*\)", r"\1", shorter)
        if shorter == text:
            break
        text = shorter
    return re.sub(r"\[(.)[^\]]*\]", r"\1", re.sub(r" \?", " ", text))


def labels(text):
    words = SCANNER.words(text)
    return {rule.pattern for _, _, rule in SCANNER.detections(words)}


@pytest.mark.parametrize("label, weight, sentence", SENTENCES)
def test_sample_and_near_miss(label, weight, sentence):
    text = sample(sentence)
    assert sentence in labels(f"Of this work: {text.upper()}, and so on.")
    assert literal(sentence) in text and 0 < weight <= 1
    words = text.split()
    for gone in (0, len(words) // 2, len(words) - 1):
        if words[gone] != "some":
            near = " ".join(words[:gone] + ["otherwise"] + words[gone + 1:])
            assert sentence not in labels(near)


def test_there_are_hundreds_of_rules_and_each_has_its_place():
    made = rules()
    assert [r.order for r in made] == list(range(len(made))) and len(SENTENCES) > 100
    assert len({(r.label, r.pattern) for r in made}) == len(made)


def plain_resolve(found):
    """Priority and containment, read off the docstring, over all pairs."""
    taken = []
    for a, b, rule in sorted(found, key=lambda d: (d[2].order, d[0] - d[1], d[0])):
        within = any(x <= a and b <= y for x, y, _ in taken)
        holds = any(a <= x and y <= b and other.label == rule.label for x, y, other in taken)
        if rule.base or not (within or holds):
            taken.append((a, b, rule))
    return sorted(taken, key=lambda d: (d[0], d[1], d[2].order))


@pytest.mark.parametrize("seed", range(20))
def test_suppression_against_all_pairs(seed):
    rng, made = random.Random(seed), rules()
    found = []
    for _ in range(rng.randint(0, 40)):
        a = rng.randrange(30)
        found.append((a, a + rng.randint(1, 12), rng.choice(made[:3] if rng.random() < 0.2 else made[3:200])))
    assert Scanner.resolve(found) == plain_resolve(found)
