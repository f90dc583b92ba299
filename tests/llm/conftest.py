from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, block long, shard long, key long, rank int, model int, kept int"


@pytest.fixture
def documents(spark):
    """Documents with further columns, whose names clash with the operators' own ones."""

    def build(*rows: tuple):
        padded = [(i, t, lang, "s", len(t or ""), 1, 2, 3, 4, 5, 6) for i, t, lang in rows]
        return spark.createDataFrame(padded, DOCS)

    return build


@pytest.fixture
def odd_documents(documents):
    """Nulls, empty, blank, one-word and very long texts, ties and repeated rows."""
    long = " ".join(f"word{k % 977} and{k % 31}" for k in range(20_000))
    passage = " ".join(f"p{k}" for k in range(40))
    return documents(
        (1, passage, "en"), (1, passage, "en"), (2, None, "en"), (3, "", None), (4, " \n\t ", "de"), (5, "one", None),
        (6, long, "en"), (7, long + " tail", "fr"), (8, f"x y z {passage} q", None), (9, "a b c \x1c d", "es"),
        (None, passage, None), (10, "same words " * 30, "en"), (11, "same words " * 30, "en"), (12, passage.upper(), "en"),
    )


@pytest.fixture
def no_documents(documents):
    return documents()
