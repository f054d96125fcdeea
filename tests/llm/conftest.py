import pytest

ODD = [
    (None, "no id " * 30, "en", "a"), (1, None, "en", "a"), (2, "", None, None), (3, " \n\t ", "de", "b"),
    (4, "12 34 !!", "xx", "b"), (5, "word " * 40_000, "en", "a"), (6, "same text here", "en", "c"),
    (6, "same text here", "en", "c"), (7, "same text here", "fr", None), (8, "é" * 5000 + " 漢字 ü", "fr", "é"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns named like the operators' own."""
    extra = "t string, d string, doc string, size string, row string, ranges string, fp string, `_id` string"
    rows = [(i, t, l, s, 0, *["x"] * 8) for i, t, l, s in ODD]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {extra}")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
