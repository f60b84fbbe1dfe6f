"""Small documents tables with the awkward cases every operator must bear."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 60_000


def docs(spark, texts, source="s"):
    """Documents with the texts; extra columns clash with names that operators use."""
    rows = [(i, t, "en", source if isinstance(source, str) or source is None else source[i], None if t is None else len(t)) for i, t in enumerate(texts)]
    return with_clashes(spark.createDataFrame(rows, DOCS))


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("clash") for c in ("key", "size", "score", "lines", "u", "v", "host", "bucket", "n_words", "_id", "_key", "rank", "kept")})


def awkward(spark):
    """Null and empty texts, a very long one, ties, repeated rows, null columns."""
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, LONG, "en", "s", len(LONG)), (4, "same text here", "en", "s", 14), (4, "same text here", "en", "s", 14), (None, "no id", "en", None, 5), (5, " \n\t\n ", "en", "s", 5), (6, "ünï çødé 漢字 words", None, "t", None)]
    return with_clashes(spark.createDataFrame(rows, DOCS))


def empty(spark):
    return with_clashes(spark.createDataFrame([], DOCS))
