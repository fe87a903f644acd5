"""Small tables with every awkward case, and checks that all operators share."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977}" for i in range(30_000))


def awkward(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    rows = [
        (1, "the cat sat on the mat and the dog ran to the park today", "en", "a", 10),
        (1, "the cat sat on the mat and the dog ran to the park today", "en", "a", 10),
        (2, "the cat sat on the mat and the dog ran to the park today", "en", "b", 10),
        (3, None, "en", "a", None),
        (4, "", None, None, 0),
        (5, " \t\n", "fr", "a", 3),
        (6, LONG, "en", None, len(LONG)),
        (7, "le chat est sur la table et le chien dans la rue avec moi", "fr", "b", 50),
        (None, "a row without an id but with words", "en", "a", 5),
        (None, "a row without an id but with words", "en", "a", 5),
        (8, "123 456", None, "c", 7),
        (9, "word", "de", "c", 4),
    ]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)
