"""Per-cell type inference as Catalyst expressions.

Order matters and follows the reference: empty → int → real → date → text.

* int:  what Python ``int(s)`` accepts — optional blanks, sign, digits with
  single underscores between them.  ``try_cast`` alone rejects ``1_000``
  and 20-digit values, so the grammar is a regex and the value a
  ``DECIMAL(38,0)``; :func:`int_digits` keeps integers of any length.
* real: contains a dot and ``float(s)`` accepts it (``.5``, ``5.``,
  ``1.e3``).  ``1e5`` and ``nan`` have no dot and are not real.
  ``try_cast`` alone accepts ``1.5f``/``1.5d``, so again a regex first.
* date: absolute dates in free order (:mod:`civiclens.functions.dates`), or a
  declared list of formats.  The reference used a natural-language
  parser whose answers depend on today's date (``Mon`` and ``10:30`` became
  today); partial dates therefore stay text here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from civiclens.functions.dates import parse_date

EMPTY, INT, REAL, DATE, TEXT = "empty", "int", "real", "date", "text"

# Labels used in the profile documents (fixed values of the output format).
TYPE_LABELS = {INT: "INTEGER (LONG)", REAL: "REAL", DATE: "DATE/TIME", TEXT: "TEXT"}

_DIGITS = r"\d+(?:_\d+)*"
INT_PATTERN = rf"(?U)^\s*[+-]?{_DIGITS}\s*$"
REAL_PATTERN = (rf"(?U)^\s*[+-]?(?:{_DIGITS}\.(?:{_DIGITS})?|\.{_DIGITS})"
                rf"(?:[eE][+-]?{_DIGITS})?\s*$")

# In place of a list of formats: any absolute date.
DATE_FORMATS = None


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_empty(v: Column | str) -> Column:
    v = _c(v)
    return v.isNull() | (v == "")


def _number_text(v: Column) -> Column:
    return F.regexp_replace(v, r"(?U)\s|_", "")


def int_value(v: Column | str) -> Column:
    """DECIMAL(38,0) of an int cell (NULL for other cells)."""
    v = _c(v)
    return F.when(v.rlike(INT_PATTERN), _number_text(v).try_cast("decimal(38,0)"))


def int_digits(v: Column | str) -> tuple[Column, Column]:
    """``(is negative, digits without leading zeros)`` of an int cell of any
    length; zero is ``0`` and never negative."""
    t = _number_text(_c(v))
    digits = F.regexp_replace(t, r"^[+-]?0*(?=.)", "")
    return t.startswith("-") & (digits != "0"), digits


def int_as_double(v: Column | str) -> Column:
    """An int cell of any length as a double."""
    v = _c(v)
    return F.when(v.rlike(INT_PATTERN), _number_text(v).try_cast("double"))


def real_value(v: Column | str) -> Column:
    v = _c(v)
    return F.when(v.rlike(REAL_PATTERN), _number_text(v).try_cast("double"))


def date_value(v: Column | str, formats: Sequence[str] | None = DATE_FORMATS) -> Column:
    """The instant of a date cell; ``formats`` (Java patterns) restricts dates
    to these."""
    v = _c(v)
    if formats is None:
        return parse_date(v)
    t = F.trim(v)
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in formats])


def cell_type(v: Column | str, formats: Sequence[str] | None = DATE_FORMATS,
              date_by_name: Column | None = None) -> Column:
    """The type tag of a cell.  ``date_by_name`` (a boolean column, e.g. from
    :func:`name_like_date`) marks all non-empty cells of date-like columns as
    dates, numbers too, as the drafts of the reference did."""
    v = _c(v)
    expr = F.when(is_empty(v), F.lit(EMPTY))
    if date_by_name is not None:
        expr = expr.when(date_by_name, F.lit(DATE))
    expr = expr.when(v.rlike(INT_PATTERN), F.lit(INT)).when(v.rlike(REAL_PATTERN), F.lit(REAL))
    return (expr.when(date_value(v, formats).isNotNull(), F.lit(DATE))
                .otherwise(F.lit(TEXT)))


# Name fragments of the draft "date by column name" rule.
DATE_NAME_WORDS = ("date", "year", "time", "month", "day", "period")


def name_like_date(name: Column | str) -> Column:
    n = F.lower(_c(name))
    cond = None
    for w in DATE_NAME_WORDS:
        c = n.contains(w)
        cond = c if cond is None else cond | c
    return cond
