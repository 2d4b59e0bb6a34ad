import pytest


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empties, ties, repeated rows, special tokens, long texts, and columns with clashing names."""
    base = "the cat sat on the mat and then it went home to sleep for a very long time again"
    rows = [
        (1, base, "x", 0), (2, base + " indeed", "y", 1), (3, None, None, None), (4, "", "z", 2), (5, "  \n\t ", "z", 2),
        (6, "one", None, 3), (7, "word " * 5000, "long", 4), (8, "A<|endoftext|>b Straße ÉTÉ don't 123 \x85x　y", "odd", 5),
        (9, base.upper(), "x", 6), (2, base + " indeed", "y", 1), (None, base, "none", 7), (11, "Zoë " + base + " extra words " + base, "x", 8),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, n_words int")
