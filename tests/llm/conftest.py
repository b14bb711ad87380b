import pytest

#: Names that operators use inside or return: extra columns of the input may have them too.
CLASHING = ["fp", "check", "run", "row", "size", "hash", "score", "id", "kept", "digest", "component_id", "n_words",
            "t", "target", "lang_pred", "h", "of", "source_size", "kinds"]

EDGE_ROWS = [
    (1, None, "en", "b"), (2, "", "en", "a"), (3, "", None, None), (4, "one", "de", "a"), (4, "one", "de", "a"),
    (4, "other text of the same id", "de", "a"), (None, "one", "fr", None), (None, None, None, None),
    (5, "word " * 60_000, "en", "b"), (6, "x" * 200_000, "en", "b"), (7, "a b c\nd e f\ng h i\nj k l", "en", "a"),
    (8, "a b c\nd e f\ng h i\nj k l", "en", "a"), (9, "  \t\n ", "en", "c"), (10, "Ünïcödé ßtraße 漢字 \u200b!", "de", "c"),
]


def with_clashes(df):
    from pyspark.sql import functions as F
    return df.select("*", *[F.lit(7).alias(c) for c in CLASHING if c not in df.columns])


@pytest.fixture(scope="session")
def edge_docs(spark):
    df = spark.createDataFrame(EDGE_ROWS, "doc_id long, text string, lang string, source string")
    return with_clashes(df)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, extra string")
