import pytest

LONG = "lorem ipsum dolor sit amet " * 4000

#: The rows every operator has to take: nulls in any column, empty and very long texts, ties and repeated rows.
EDGE = [
    (1, "the quick brown fox jumps over the lazy dog.", "en", "a"),
    (1, "the quick brown fox jumps over the lazy dog.", "en", "a"),
    (2, "the quick brown fox jumps over the lazy dog.", "en", None),
    (3, None, "de", "b"),
    (4, "", None, None),
    (None, "no id at all", "en", "a"),
    (5, LONG, "fr", "c"),
    (6, " \t\n\x0b\x0c\r ", None, "c"),
    (7, "été 漢字 😀 é x <|endoftext|> Σς", "fr", "c"),
    (8, "x" * 60_000, None, "d"),
]

#: Names that clash with columns the operators compute.
CLASHING = ("score", "predicted", "n_words", "kept", "fp", "component", "shard", "slot", "size", "ids", "rank", "y", "f",
            "found", "hash", "start", "words", "n_chars", "_text", "_row", "held_out", "low", "value", "u", "v")


@pytest.fixture(scope="session")
def edge(spark):
    """The edge rows with clashing extra columns."""
    from pyspark.sql import functions as F
    docs = spark.createDataFrame(EDGE, "doc_id long, text string, lang string, source string")
    return docs.withColumns({c: F.lit(f"extra {c}") for c in CLASHING})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
