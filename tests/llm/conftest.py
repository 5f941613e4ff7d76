import pytest

#: Names that the operators use inside, as extra columns of the input.
CLASHING = ["h", "n", "norm", "sha", "node", "label", "size", "target", "source_size", "keep_id", "component", "sig", "f", "base", "cls", "key"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def long_text(words: int) -> str:
    return " ".join(f"word{i * 7919 % 100003}" for i in range(words))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls in every column, empty, blank, repeated, tied and very long texts, and clashing columns."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog again and again", "en", "a", 1), (2, "the quick  brown fox\tjumps over the lazy dog again and again", "en", None, 1),
        (3, None, "en", "a", None), (4, "", None, "b", 0), (5, " \t\r\n\x0b\x0c", None, "b", 6), (6, "one two", "en", "b", 7), (6, "one two", "en", "b", 7), (7, "One Two", "fr", "c", 7),
        (8, long_text(60_000), "de", "a", 0), (9, long_text(59_990), "de", "c", 0), (None, "no id here at all", None, "a", 1), (None, "one two", None, None, 1),
        (10, "\u00e9t\u00e9 \u4e2d\u6587 \U0001f600 42", "fr", "c", 1), (11, "1234 5678 !!", None, "c", 1),
    ]
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(c) for c in CLASHING})


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
