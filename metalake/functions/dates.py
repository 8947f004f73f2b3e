"""Date text normalisation.

``norm_date`` gives the calendar day of an ISO 8601 date text, as written
(no time-zone shift), or else the text's first ten characters:

* falsy (NULL, ``""``) -> NULL;
* extended dates ``YYYY-MM-DD...`` -> the date as written (no time-zone
  shift); an invalid extended date also yields its first ten characters, so
  both cases are ``substring(s, 1, 10)``;
* basic ``YYYYMMDD[Thhmmss...]`` -> ``YYYY-MM-DD`` when the date is valid;
* ISO week dates ``YYYY-Www[-D]`` / ``YYYYWww[D]`` -> the calendar date;
* anything else -> first ten characters.
Partial dates (``2024``, ``2024-05``) stay text; never cast them to DATE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .json import col_

# Shapes Python's fromisoformat accepts after a basic or week date: any one
# separator character, then HH[:MM[:SS[.f]]] or HH[MM[SS[.f]]] (consistent
# separators, hour 00-23, minute/second 00-59), then an optional offset of
# the same form. Anything else makes Python fall back to the first ten
# characters, and so do we.
_FRAC = r"(?:[.,]\d+)?"
_H = r"(?:[01]\d|2[0-3])"
_M = r"[0-5]\d"
_HMS = rf"(?:{_H}(?::{_M}(?::{_M}{_FRAC})?)?|{_H}(?:{_M}(?:{_M}{_FRAC})?)?)"
_TIME = rf"(?:.{_HMS}(?:Z|[+-]{_HMS})?)?$"
_BASIC = r"^(\d{4})(\d{2})(\d{2})" + _TIME
_WEEK = r"^(\d{4})(?:-W(\d{2})(?:-([1-7]))?|W(\d{2})([1-7])?)" + _TIME


def _group(s: Column, rx: str, i: int) -> Column:
    return F.nullif(F.regexp_extract(s, rx, i), F.lit(""))


def _iso_week_date(s: Column) -> Column:
    y = _group(s, _WEEK, 1).cast("int")
    w = F.coalesce(_group(s, _WEEK, 2), _group(s, _WEEK, 4)).cast("int")
    d = F.coalesce(_group(s, _WEEK, 3), _group(s, _WEEK, 5), F.lit("1")).cast("int")
    # Monday of ISO week 1 is the Monday of the week holding January 4th.
    week1 = F.date_trunc("week", F.make_date(y, F.lit(1), F.lit(4))).cast("date")
    day = F.date_add(week1, (w - 1) * 7 + d - 1)
    # Week 53 exists only in long years; otherwise Python raises and the
    # first ten characters are returned.
    long_year = F.weekofyear(F.make_date(y, F.lit(12), F.lit(28))) == 53
    valid = (y >= 1) & (w >= 1) & ((w <= 52) | ((w == 53) & long_year))
    return F.when(valid, F.date_format(day, "yyyy-MM-dd"))


def norm_date(c) -> Column:
    s = col_(c)
    head = F.substring(s, 1, 10)
    ymd = F.try_to_date(F.substring(s, 1, 8), "yyyyMMdd")
    basic = F.when(F.substring(s, 1, 4) != "0000", F.date_format(ymd, "yyyy-MM-dd"))
    return (F.when(s.isNull() | (s == ""), F.lit(None).cast("string"))
            .when(s.rlike(_BASIC), F.coalesce(basic, head))
            .when(s.rlike(_WEEK), F.coalesce(_iso_week_date(s), head))
            .otherwise(head))

