import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns whose names clash with inner ones."""
    long_text = "\n".join(f"line {i} of a rather long text with many words number {i * i}" for i in range(3000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog today.", "en", "a", 50),
        (2, "The quick brown fox jumps over the lazy dog today.", "en", "b", 50),
        (2, "The quick brown fox jumps over the lazy dog today.", "en", "b", 50),
        (3, None, None, None, None),
        (None, "", "en", None, 0),
        (None, "words without an id stand here in a row", None, "a", 3),
        (5, "", "en", "a", 0),
        (6, long_text, "en", "c", len(long_text)),
        (7, "  \n\n  ", "en", "a", 6),
        (7, "one id with another text and more words", "en", "a", 6),
        (8, "Grüße aus Köln, <|endoftext|> don't  stop\t now 12,345 你好", "de", "ü", 9),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("i", "t", "th", "fp", "__t", "score", "size", "component_id", "removed_lines", "passes", "__stats", "__lines"):
        df = df.selectExpr("*", f"'clash' AS `{name}`")
    return df


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
