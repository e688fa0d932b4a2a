import pytest

TEXT = "the quick brown fox jumps over the lazy dog while five wizards box and all of the others look on in silence "


@pytest.fixture
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like outputs."""
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, TEXT * 3), (4, TEXT * 3), (4, TEXT * 3), (None, "a"), (6, "x" * 50_000), (7, "é ü\x00 日本 " * 400), (8, "one"), (9, "1 2 3"), (10, TEXT * 400), (None, TEXT)]
    return spark.createDataFrame([(i, t, "en" if t else None, "s", 1, "n", b"z") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, row string, ids binary")
