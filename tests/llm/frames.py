"""Small document frames with the awkward cases every operator must take."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} tail{i % 13}," for i in range(9000))


def docs(spark, rows, schema=DOCS):
    """Rows of (doc_id, text, lang, source); n_chars is added."""
    full = [(d, t, l, s, None if t is None else len(t)) for d, t, l, s in rows]
    return spark.createDataFrame(full, schema)


EDGE = [
    (7, None, "en", "a"),
    (3, "", "en", "a"),
    (None, "a text without an id stands here", None, "b"),
    (5, "  \t\n ", "de", None),
    (11, LONG, "en", "b"),
    (2, "The same words stand here twice, under the MIT License.", "en", "a"),
    (4, "The same words stand here twice, under the MIT License.", "en", "a"),
    (6, "ünïcödé — 日本語のテキスト 🙂 x", "fr", "c"),
    (6, "ünïcödé — 日本語のテキスト 🙂 x", "fr", "c"),
    (9, "one", None, None),
]


def clashing(df):
    """The frame with extra columns named like helper and output columns."""
    from pyspark.sql import functions as F

    for name in ("row", "size", "th", "fp", "score", "removed", "token_ids", "chunk", "sid", "key"):
        df = df.withColumn(name, F.lit(f"own {name}"))
    return df
