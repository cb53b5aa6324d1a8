"""Unicode-aware string helpers.

Java regexes only treat ``\\w \\b \\s`` as Unicode classes under the ``(?U)``
flag; without it ``\\W+`` would erase Chinese characters.  Every pattern that
runs on free text goes through :func:`upat`.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def upat(pattern: str, ignore_case: bool = False) -> str:
    """Prefix a pattern with the Unicode (and optionally case-insensitive) flag."""
    return ("(?iU)" if ignore_case else "(?U)") + pattern


def strip_ws(col: Column) -> Column:
    """Remove leading and trailing white space of any kind (not only ' ')."""
    return F.regexp_replace(col, upat(r"^\s+|\s+$"), "")


def blank_to_null(col: Column) -> Column:
    """'' -> NULL, so ``coalesce`` can express ``a or b`` on strings."""
    return F.nullif(col, F.lit(""))


def word_haystack(col: Column) -> Column:
    """' ' + lower(text) + ' ' with every run of non-word characters made one space."""
    padded = F.concat(F.lit(" "), F.lower(F.coalesce(col, F.lit(""))), F.lit(" "))
    return F.regexp_replace(padded, upat(r"\W+"), " ")


def word_haystack_py(text: str) -> str:
    """Same normalisation for a fixed Python string (used on taxonomy surfaces)."""
    return re.sub(r"\W+", " ", " " + text.lower() + " ")
