import random
import zlib

import pytest
from frames import EDGE, clashing, docs

from strata.llm import toxicity as X


def corpus(n=500):
    rng = random.Random(6)
    plain = "the of and to in is that house river green walks table morning letter".split()
    fremd = "der die und das nicht haus fluss wandern tisch morgen brief".split()
    rows, labels = [], []
    for d in range(n):
        pool = plain if d % 3 else fremd
        words = [rng.choice(pool) for _ in range(rng.randint(5, 80))]
        toxic = int(rng.random() < 0.3)
        for _ in range(3 * toxic):
            words[rng.randrange(len(words))] = rng.choice(
                ("grubnik", "Snarf!") if d % 3 else ("pflaumig", "pflaumend", "pflaumt"))
        rows.append((d, " ".join(words), "xx", f"s{toxic}"))
        labels.append((d, toxic))
    return rows, labels


@pytest.fixture(scope="module")
def frames(spark):
    rows, labels = corpus()
    extra = [(1, None), (None, 1), (10_000, 1)]
    return docs(spark, rows), spark.createDataFrame(labels + extra, "doc_id long, toxic int"), dict(labels)


def test_held_out_accuracy_and_split(frames):
    df, labels, truth = frames
    out = X.classify(df, labels).collect()
    assert len(out) == len(truth)
    hits = total = 0
    for r in out:
        held = zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        assert r.held_out == held and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if held:
            total += 1
            hits += r.predicted == truth[r.doc_id]
    assert hits / total > 0.93


def test_only_the_text_counts(frames, spark):
    df, labels, truth = frames
    model = X.fit(df, labels)
    scorer = X.Scorer(model)
    assert scorer.score("the green house and a grubnik letter") > 0.5 > scorer.score("the green house")
    # held-out labels change nothing
    flipped = labels.selectExpr(
        "doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - toxic else toxic end as toxic")
    same = X.fit(df.withColumn("lang", df.source), flipped)
    assert (same.embed == model.embed).all() and (same.shift == model.shift).all()
    text = " ".join(["the house"] * 30_000) + " grubnik snarf grubnik"
    assert scorer.score(text) == pytest.approx(scorer.score("grubnik snarf grubnik " + text), abs=0.2)
    assert scorer.score("") == 0.0 and scorer.score(" \n") == 0.0


def test_reject_keeps_the_columns(frames):
    df, labels, truth = frames
    wide = clashing(df)
    out = X.reject(wide, labels)
    assert out.columns == wide.columns
    left = {r.doc_id for r in out.collect()}
    toxic = {d for d, y in truth.items() if y}
    assert len(left & toxic) < 0.1 * len(toxic) and len(set(truth) - toxic - left) < 0.05 * len(truth)


def test_edge_rows_and_missing_labels(frames, spark):
    df, labels, _ = frames
    edge = clashing(docs(spark, EDGE))
    one_class = labels.where("toxic = 0")
    out = X.classify(edge, one_class).collect()
    assert len(out) == len(EDGE) and {(r.score, r.predicted) for r in out} == {(0.0, 0)}
    model = X.fit(df, labels)
    scored = X.with_score(edge, model)
    assert {r.score for r in scored.where("doc_id in (3, 5, 7)").collect()} == {0.0}
    assert X.classify(df.limit(0), labels).count() == 0
    assert X.classify(df, labels.limit(0)).count() == df.count()


def test_given_documents(spark, small_sf):
    rows = X.op9_toxicity(spark, small_sf)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    assert rows.count() == spark.read.parquet(f"{small_sf}/documents.parquet").count()
