"""Small documents with everything that may go wrong."""

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, row int"


def documents(spark, texts, ids=None, langs=None):
    """A table of texts, with columns whose names operators use inside."""
    ids = range(len(texts)) if ids is None else ids
    langs = ["en"] * len(texts) if langs is None else langs
    rows = [
        (i, t, lang, "s", None if t is None else len(t), "k", 7)
        for i, t, lang in zip(ids, texts, langs, strict=True)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def by_id(df, *names):
    return {row["doc_id"]: tuple(row[n] for n in names) for row in df.collect()}
