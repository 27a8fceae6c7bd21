"""Fixtures of these tests; a plain module, so that it does not shadow the ``conftest`` of the folder above."""

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns of input tables that have the names of the operators' own columns.
CLASHING = ("row", "host", "words", "lines", "chunks", "kept", "n_words", "n", "h", "p", "k", "key", "text_key", "drops", "rank", "length",
            "start", "piece", "score", "list", "pattern", "shared", "top", "comp", "toxic", "block", "bucket")


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) or (doc_id, text, source)."""
    def build(rows, clash=False):
        rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) for r in rows]
        df = spark.createDataFrame(rows, SCHEMA)
        return df.withColumns({c: F.lit(7) for c in CLASHING}) if clash else df
    return build


@pytest.fixture(scope="session")
def awkward():
    """Nulls, empty and blank texts, repeated rows, ties, a null id and a very long text."""
    long = " ".join(f"w{i}" for i in range(30_000))
    same = "one two three four five six seven eight nine ten eleven twelve\nand a second line of the same text here"
    return [(1, None), (2, ""), (3, " \t\n\r "), (4, "short"), (5, same, "a"), (5, same, "a"), (6, same, None), (None, same, None), (None, None),
            (7, long, "b"), (8, "\n".join([same] * 50), "b"), (9, same + " more", "a")]
