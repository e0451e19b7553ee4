import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, spans string, k string"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with columns whose names clash with outputs of the operators."""

    def make(rows):
        return spark.createDataFrame([(i, t, None, "s", None, 0.5, "x", "y") for i, t in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, short, white and long texts, repeated rows and a missing id."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(40_000))
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three"), (6, long), (7, long + " end"), (8, "x" * 100_000), (9, "Grüße, 日本 😀  a@b.co"), (9, "Grüße, 日本 😀  a@b.co"), (None, "no id here but some words to read"), (10, "\x00\x01 odd   space \r\n\r\n  two")]
