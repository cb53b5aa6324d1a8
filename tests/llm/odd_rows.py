"""Rows that every operator must take: nulls, empty and long texts, repeats, clashing names."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, text_hash string, id string, fp string, size int"
ODD_TEXTS = [None, "", " \t\n", "a", "two words", "x " * 30000, "é😀漢字 mail me at a.b@c.de now", "same text here again " * 9,
             "same text here again " * 9, "Released under the MIT License.", "4111 1111 1111 1111 or +1 (555) 123-4567"]


@pytest.fixture()
def odd_docs(spark):
    """Odd texts, null ids and sources, repeated rows, and columns whose names the operators use inside."""
    rows = [(i if i != 3 else None, t, None, None if i == 4 else f"s{i % 3}", 0, "clash", "clash", None, 1)
            for i, t in enumerate(ODD_TEXTS)]
    return spark.createDataFrame(rows + rows[:2], DOCS)


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
