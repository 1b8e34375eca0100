import pytest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties and repeated rows, clashing column names."""
    base = " ".join(f"word{i}" for i in range(120))
    near = base.replace("word7 ", "other ")
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    rows = [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (2, base, "en", "a", 1), (3, near, "fr", "b", 2),
        (4, None, None, None, None), (5, "", "en", "", 0), (6, " \t\n ", "de", "c", 4), (7, "ONE two", "en", "a", 7),
        (8, "one TWO", "en", None, 7), (9, long, "de", "c", 9), (10, base.upper(), "en", "a", 1),
        (11, "a " * 50, "en", "b", 100), (12, "Line one here.\nLine one here.\n\nLast #tag *", "en", "b", 3),
    ]
    df = spark.createDataFrame(rows, DOC)
    return df.selectExpr("*", "'x' AS block", "1 AS node", "2 AS `key`", "'y' AS row", "0 AS order_key", "3 AS _group")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC)
