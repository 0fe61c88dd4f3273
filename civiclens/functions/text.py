"""Text expressions (Catalyst only, no Python per row)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.split()`` treats as
# whitespace, as one Java regex class.  Java's own ``\s`` covers only
# [ \t\n\x0B\f\r].
PY_WHITESPACE_CLASS = (
    "[\\s\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a"
    "\\u2028\\u2029\\u202f\\u205f\\u3000]"
)

# Fixed value: ``string.punctuation`` is exactly the POSIX ASCII class
# !"#$%&'()*+,-./:;<=>?@[\]^_`{|}~ which Java names \p{Punct}.
EDGE_PUNCT = "^\\p{Punct}+|\\p{Punct}+$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def whitespace_tokens(col: Column | str) -> Column:
    """``text.split()``: split on runs of whitespace, no empty tokens."""
    parts = F.split(_c(col), PY_WHITESPACE_CLASS + "+")
    return F.filter(parts, lambda t: t != "")


def strip_edge_punct(col: Column | str) -> Column:
    """``word.strip(string.punctuation)``."""
    return F.regexp_replace(_c(col), EDGE_PUNCT, "")


def remove_substrings(col: Column | str, words: Sequence[str]) -> Column:
    """Remove every occurrence of each word, case-sensitive, inside other
    words too, applied in list order (``str.replace`` chained)."""
    out = _c(col)
    for w in words:
        out = F.replace(out, F.lit(w), F.lit(""))
    return out


def path_part(col: Column | str, index: int) -> Column:
    """``path.split('/')[index]`` with Python's negative indexing."""
    return F.element_at(F.split(_c(col), "/"), index if index < 0 else index + 1)


def word_tokens(col: Column | str) -> Column:
    """Tokens separated by ``\\W+`` (Unicode word characters), case kept,
    as ``RegexTokenizer(pattern='\\W+', toLowercase=False)`` yields them."""
    parts = F.split(_c(col), "(?U)\\W+")
    return F.filter(parts, lambda t: t != "")
