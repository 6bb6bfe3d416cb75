import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: NULLs, empty and blank texts, repeated ids and rows, an own name for every result column.
ODD = [
    (7, "a b c d e f g h", "en", "s", 15),
    (7, "a b c d e f g h", "en", "s", 15),
    (3, None, None, None, None),
    (3, "", "en", "s", 0),
    (None, "one two three", "en", "s", 13),
    (None, None, None, None, None),
    (9, " \n\t ", "en", "s", 4),
    (1, "Ünïcode \U0001f600 Straße, Ελλάς <|endoftext|> it's 12345\n\n  end.", "de", "s", 50),
    (12, "word " * 5000, "en", "s", 25000),
]
CLASHES = {
    name: "x"
    for name in ("ids", "bucket", "score", "kept", "set_key", "component_id", "split", "rank", "length", "held_out",
                 "text_hash", "block", "word", "quality", "toxic", "label_id", "first", "n_tokens", "sequence_id",
                 "judged_id", "judged_hash", "stays", "rows", "row_hash", "shingles", "lang_pred", "place")
}


@pytest.fixture
def odd(spark):
    """A table of awkward rows with columns that clash with what the operators make."""
    from pyspark.sql import functions as F

    return spark.createDataFrame(ODD, SCHEMA).withColumns({name: F.lit(value) for name, value in CLASHES.items()})


@pytest.fixture
def docs(spark):
    """docs(text, ...) as documents numbered from 0, or docs({id: text, ...})."""

    def make(*texts):
        pairs = list(texts[0].items()) if texts and isinstance(texts[0], dict) else list(enumerate(texts))
        return spark.createDataFrame([(i, text, "en", "s", len(text or "")) for i, text in pairs], SCHEMA)

    return make


@pytest.fixture
def vocabulary():
    return pytest.importorskip("public_tokenizers").path
