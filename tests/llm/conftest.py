import random

import pytest
from pyspark.sql import functions as F

from .words import sentence

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators give to their own columns.
CLASHES = ["n_words", "kept", "score", "held_out", "own", "key", "part", "place", "component_id", "_label", "label", "at", "rule", "host", "_number", "_id", "bucket", "_chosen_id", "_chosen_key"]


@pytest.fixture(scope="session")
def make(spark):
    """A table of documents with extra columns whose names clash with those of the operators."""

    def build(rows):
        df = spark.createDataFrame([(*r, *[None] * (5 - len(r))) for r in rows], SCHEMA)
        return df.withColumns({c: F.lit("x") for c in CLASHES})

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, repeated rows, odd letters."""
    rng = random.Random(4)
    long_text = sentence(rng, 30_000)
    return [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "   \n\t ", "en", None, None), (4, "one", None, "a", 3), (5, long_text, "en", "b", len(long_text)),
        (6, "same words here again and again", "en", "a", 5), (6, "same words here again and again", "en", "a", 5), (7, "same words here again and again", "en", "a", 5),
        (None, "no id for this text at all", "fr", "a", 1), (8, "日本語 テキスト 漢字 \u0000 é́ 𝒳", None, None, None), (9, "x" * 200_000, "en", "b", 9), (10, "!!! ??? ... 123", "en", "b", 2)]
