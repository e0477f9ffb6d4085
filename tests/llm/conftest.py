import pytest

LONG = " ".join(f"w{i % 997} x{i % 13}" for i in range(30_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog\nA shared line of text\nown line one", "en", "a", 10),
    (2, "the quick brown fox jumps over the lazy dog\n  A SHARED line of text \nown line two", "en", "a", 11),
    (3, "", "en", "b", 0),
    (4, None, None, None, None),
    (None, "A shared line of text\nno id here at all", "de", "b", None),
    (5, "   \t\n\x0b ", "de", None, 3),
    (6, LONG, "en", "a", len(LONG)),
    (7, LONG + " tail", None, "c", 1),
    (8, "Die Straße der Größe ist weit und breit\nA shared line of text", "de", "c", 2),
    (8, "Die Straße der Größe ist weit und breit\nA shared line of text", "de", "c", 2),
    (9, "one", "fr", "c", 1),
    (10, "日本語 のテキスト\n12345 67890\r\nA B", "ja", "d", 5),
    (11, "one", "fr", "c", 1),
    (-12, "The quick brown fox jumps over the lazy dog\nA shared line of text\nown line one", "en", "a", 10),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use themselves.
CLASHING = "size target copies score predicted id label key runs c0 n kept component_id rank list v".split()


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty, blank and long texts, ties, repeated rows, clashing names."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    return df.withColumns({name: F.lit("x") for name in CLASHING})


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
