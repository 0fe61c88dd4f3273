"""Absolute dates in free order, as one Catalyst expression.

A cell is split into token classes instead of being tried against one pattern
after another: the time of day (with AM/PM and zone) is taken out, weekday names
and filler go, and what is left must be three tokens, each a number or a month
name.  Their order then follows from the classes:

* month name first: day, year (``Jan 5 2019``), or year, day if the second number
  is over 31;
* month name in the middle: day, year (``5 Jan 2019``), or year, day if the first
  number is over 31;
* month name last: year, day, or day, year if the second number is over 31;
* numbers only: year, month, day if the first has more than two digits or is over
  31; else day, month, year if the first is over 12; else month, day, year.

Eight digits are ``yyyyMMdd``, 12 and 14 with hour, minute and second; so is
``yyyyMMddTHHmm[ss]``.  Two-digit years are 2000-2099, and among numbers only they
need ``/`` or ``-`` between them.  A date needs day, month and year: what depends on
today's date (``Mon``, ``10:30``, ``Jan 2019``) is none.  Zones: ``Z``, ``UTC``, ``GMT``
and offsets move the instant; other names are read over.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# English names, of which the first three letters stand alone too.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august",
          "september", "october", "november", "december")
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
FILLER = ("of", "on", "at", "and", "ad")

_NAMES = "|".join(sorted({w for n in (*MONTHS, *WEEKDAYS) for w in (n, n[:3])} | {"sept"}, key=len, reverse=True))
_DAYS = "|".join(sorted({w for n in WEEKDAYS for w in (n, n[:3])}, key=len, reverse=True))
_ZONE = (rf"(Z|(?:UTC|GMT)?[+-]\d{{2}}(?::?\d{{2}})?|(?!(?i:{_NAMES})\b)[A-Z]{{3,5}})")
# hour, minute, second, fraction, half of the day (with or without minutes), zone
_CLOCK = (r"(\d{1,2})(?::(\d{1,2})(?::(\d{1,2})(?:[.,](\d+))?)?(?:\s*([AaPp][Mm]))?|\s*([AaPp][Mm]))"
          rf"(?:\s*{_ZONE})?")
TIME = rf"(?:(?<=\d)[Tt]|(?<![\d:.\p{{L}}])){_CLOCK}(?![\d:\p{{L}}])"
TIME_ALONE = rf"^[Tt]?{_CLOCK}$"
COMPACT = r"^(\d{4})(\d{2})(\d{2})(?:[Tt]?(\d{2})(\d{2})(\d{2})?)?$"
# The most common form, which Spark's own cast reads; the grammar would say the same.
ISO = r"^(?!0000)\d{4}-\d{2}-\d{2}(?: \d{2}:\d{2}:\d{2}(?:\.\d{1,6})?)?$"
# What any form above has; other values skip the work.
_SHORT = "|".join(m[:3] for m in MONTHS)
GUARD = (rf"(?i)^(?=.*(?:\d{{3}}|\d[/-]\d{{1,2}}[/-]\d|(?:{_SHORT})\p{{L}}*[\s,.;/'-]*\d|\d[\s,.;/'-]*(?:{_SHORT})))"
         r"[\p{L}\d:/.,;'+\s-]{6,60}$")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _int(text: Column) -> Column:
    return F.when(text.rlike(r"^\d{1,4}$"), text.try_cast("int"))


def _year(text: Column) -> Column:
    n = _int(text)
    return F.when(F.length(text) > 2, n).otherwise(n + 2000)


def _month_number(token: Column) -> Column:
    pairs = [x for i, m in enumerate(MONTHS) for w in {m, m[:3]} for x in (F.lit(w), F.lit(i + 1))]
    table = F.create_map(*pairs, F.lit("sept"), F.lit(9))
    return F.try_element_at(table, F.lower(token))


def _date(year: Column, month: Column, day: Column) -> Column:
    return F.struct(year.alias("y"), month.alias("m"), day.alias("d"))


def _three(tokens: Column, slashes: Column) -> Column:
    """``struct(y, m, d)`` of three tokens, NULL parts where they are no date."""
    a, b, c = (F.get(tokens, i) for i in range(3))
    classes = F.struct(
        *[_int(x).alias(n) for n, x in zip("abc", (a, b, c))],
        *[_month_number(x).alias(n) for n, x in zip(("ma", "mb", "mc"), (a, b, c))])

    def order(k: Column) -> Column:
        na, nb, nc, ma, mb, mc = (k[n] for n in ("a", "b", "c", "ma", "mb", "mc"))
        long_a = (na > 31) | (F.length(a) > 2)
        four = F.greatest(F.length(a), F.length(b), F.length(c)) > 2
        return (F.when(ma.isNotNull() & (nb > 31), _date(_year(b), ma, nc))
                 .when(ma.isNotNull(), _date(_year(c), ma, nb))
                 .when(mb.isNotNull() & (na > 31), _date(_year(a), mb, nc))
                 .when(mb.isNotNull(), _date(_year(c), mb, na))
                 .when(mc.isNotNull() & (nb > 31), _date(_year(b), mc, na))
                 .when(mc.isNotNull(), _date(_year(a), mc, nb))
                 .when(~(four | slashes), F.lit(None))
                 .when(long_a, _date(_year(a), nb, nc))
                 .when(na > 12, _date(_year(c), nb, na))
                 .otherwise(_date(_year(c), na, nb)))
    return _let(classes, order)


def _groups(text: Column, pattern: str, n: int) -> Column:
    """All groups of a pattern that covers the text, by one match."""
    return F.split(F.regexp_replace(text, pattern, "|".join(f"${i + 1}" for i in range(n))), r"\|")


def _instant(date: Column, time: Column) -> Column:
    """The timestamp of ``struct(y, m, d)`` and the groups of ``TIME``."""
    g = [F.get(time, i) for i in range(7)]
    half = F.lower(F.concat(g[4], g[5]))
    hour, minute = F.coalesce(_int(g[0]), F.lit(0)), F.coalesce(_int(g[1]), F.lit(0))
    second = F.coalesce(_int(g[2]), F.lit(0))
    fraction = F.rpad(F.substring(g[3], 1, 6), 6, "0")
    seconds = F.concat_ws(".", second.cast("string"), fraction).cast("decimal(16,6)")
    hour24 = (F.when((half != "") & (hour > 12), None)
               .when(half == "pm", hour % 12 + 12).when(half == "am", hour % 12).otherwise(hour))
    sign, offset = F.regexp_extract(g[6], r"[+-]", 0), F.regexp_replace(g[6], r"\D", "")
    # "GMT+3" names a place three hours behind, as in POSIX
    behind = (sign == "-") != g[6].rlike(r"^(UTC|GMT)[+-]")
    zone = (F.when(g[6].isin("Z", "UTC", "GMT"), F.lit("UTC"))
             .when(sign != "", F.concat(F.when(behind, F.lit("-")).otherwise(F.lit("+")),
                                        F.substring(offset, 1, 2), F.lit(":"),
                                        F.rpad(F.substring(offset, 3, 2), 2, "0"))))
    parts = (date["y"], date["m"], date["d"], hour24, minute, seconds)
    valid = (date["y"] >= 1) & (minute < 60) & (second < 60) & F.coalesce(
        F.substring(zone, 2, 2).try_cast("int") <= 14, F.lit(True))
    here = F.try_make_timestamp(*parts)
    there = F.try_make_timestamp(*parts, zone)
    return F.when(valid, F.when(zone.isNull(), here).otherwise(there))


def parse_date(v: Column) -> Column:
    """The instant of an absolute date, NULL for anything else."""
    text = F.regexp_replace(v, r"^\s+|\s+$", "")

    def words(rest: Column) -> Column:
        """The tokens of a text without its time."""
        rest = F.regexp_replace(rest, rf"(?i)(?<!\p{{L}})(?:{_DAYS})(?!\p{{L}})", " ")
        rest = F.regexp_replace(rest, rf"(?i)(?<=\d)(?:st|nd|rd|th)(?!\p{{L}})|(?<!\p{{L}})(?:{'|'.join(FILLER)})(?!\p{{L}})",
                                " ")
        rest = F.regexp_replace(rest, r"(?<=\d)(?=\p{L})|(?<=\p{L})(?=\d)|[\s,.;'/-]+", " ")
        return F.split(F.trim(rest), r" +")

    def parts(date: Column, time: Column) -> Column:
        return F.struct(date.alias("date"), time.alias("time"))

    def compact(t: Column) -> Column:
        """Date and time of eight, twelve or fourteen digits."""
        return _let(_groups(t, COMPACT, 6), lambda g: parts(
            _date(_int(F.get(g, 0)), _int(F.get(g, 1)), _int(F.get(g, 2))),
            F.array(F.get(g, 3), F.get(g, 4), F.get(g, 5), *[F.lit("")] * 4)))

    def plain(t: Column) -> Column:
        """Date and time of any other text; NULL parts if it has two times."""
        def split(times: Column) -> Column:
            none, one = F.size(times) == 0, F.size(times) == 1
            time = F.get(times, 0)
            return F.struct(
                F.when(none, t).when(one, F.replace(t, time, F.lit(" "))).alias("rest"),
                F.when(none, F.array(*[F.lit("")] * 7)).when(one, _groups(time, TIME_ALONE, 7)).alias("time"))

        def of(k: Column) -> Column:
            slashes = k["rest"].rlike(r"^[^/.]*-[^/.]*$|^[^.-]*/[^.-]*$")
            return _let(words(k["rest"]), lambda w: parts(
                F.when(F.size(w) == 3, _three(w, slashes))
                 .when((F.size(w) == 1) & F.get(w, 0).rlike(r"^\d{8}$"), compact(F.get(w, 0))["date"]), k["time"]))
        return _let(F.regexp_extract_all(t, F.lit(TIME), F.lit(0)), lambda times: _let(split(times), of))

    found = _let(text, lambda t: F.when(t.rlike(COMPACT), compact(t)).otherwise(plain(t)))
    value = _let(found, lambda x: _instant(x["date"], x["time"]))
    return F.when(v.rlike(ISO), v.try_cast("timestamp")).when(v.rlike(GUARD), value)

