import zlib

from frames import docs
from test_toxicity import corpus

from strata.llm import toxicity as X


def f1(found, cut):
    true = sum(y for v, y in found if v >= cut)
    return 2 * true / (sum(y for _, y in found) + sum(v >= cut for v, _ in found))


def test_thresholds_cover_all_labelled_rows(spark, monkeypatch):
    """With a small training sample each language's cut is the best one on all
    other rows, German included (too few toxic rows in the sample)."""
    rows, labels = corpus(900)
    train, texts = X.train, []
    monkeypatch.setattr(X, "train", lambda t, *more: texts.extend(t) or train(t, *more))
    model = X.fit(docs(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"), 30)
    trained = {t for i, t in enumerate(texts) if i % X.CALIBRATION}
    scorer, truth, found = X.Scorer(model), dict(labels), {}
    for d, text, *_ in rows:
        if zlib.crc32(str(d).encode()) % 5 and text not in trained:
            logit, language = scorer.logit(text)
            found.setdefault(language, []).append((logit, truth[d]))
    assert len(texts) == 60 and len(found[0]) > 300 and len(found[1]) > 150
    for language in (0, 1):
        best = max(f1(found[language], v) for v, _ in found[language])
        assert f1(found[language], model.shift[language]) > best - 0.02


def test_a_language_with_few_labels_takes_the_cut_of_all():
    rows = [(0, 10, 1, 6), (0, -10, 0, 6), (1, 30, 1, 4), (1, 20, 0, 9)]
    cut = X.shifts(rows, {0: 15, 1: 10})
    assert cut[1] == cut[4] and -10 / X.BINS < cut[0] <= 10 / X.BINS
