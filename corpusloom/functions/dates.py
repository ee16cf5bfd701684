"""Dates in free text, as column expressions.

Readings are tried in a fixed order, and the first that is a real date wins:

1.  ISO: 2024-03-05, 2024/3/5, 20240305T101530
2.  a month's name: 5 March 2024, 5. März 2024, 5th of March 2024, March 5th, 2024, Mar 2024 (its first)
3.  figures: 3/5/2024 and 3.5.2024, month first unless it can't be one or ``day_first``; a year
    of two figures is the one nearest to the year of ``as_of``
4.  relative to ``as_of``: today, yesterday, tomorrow, 3 days ago, an hour ago, 2 weeks ago

A time of day (10:15, 10:15:30.5, 3 pm, 3:30 PM) and an offset (Z, UTC, GMT, +02:00, -0500) may
stand anywhere else in the text; without an offset times are UTC. Text around all that is ignored.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

#: Month names and their abbreviations in the four languages of the corpora, by month.
MONTHS = (
    ("january", "janvier", "januar", "enero", "jan", "janv", "ene"),
    ("february", "février", "februar", "febrero", "feb", "févr", "fév"),
    ("march", "mars", "märz", "marzo", "mar", "mär"),
    ("april", "avril", "abril", "apr", "avr", "abr"),
    ("may", "mai", "mayo"),
    ("june", "juin", "juni", "junio", "jun"),
    ("july", "juillet", "juli", "julio", "jul", "juil"),
    ("august", "août", "agosto", "aug", "ago"),
    ("september", "septembre", "septiembre", "sept", "sep"),
    ("october", "octobre", "oktober", "octubre", "oct", "okt"),
    ("november", "novembre", "noviembre", "nov"),
    ("december", "décembre", "dezember", "diciembre", "dec", "déc", "dez", "dic"),
)
UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}

_NAMES = "|".join(sorted((n for names in MONTHS for n in names), key=len, reverse=True))
_EDGE = r"(?<![\p{L}\d])"
_ISO = r"(?<!\d)(\d{4})([-/.])(\d{1,2})\2(\d{1,2})(?!\d)"
_BASIC = r"(?<!\d)(\d{4})(\d{2})(\d{2})(?:[tT](\d{2})(\d{2})(\d{2})?)?(?!\d)"
_DAY_MONTH = rf"{_EDGE}(\d{{1,2}})(?:st|nd|rd|th|er|\.)?\s+(?:of\s+|de\s+)?({_NAMES})\.?(?:\s+de)?,?\s+(\d{{4}})(?!\d)"
_MONTH_DAY = rf"{_EDGE}({_NAMES})\.?\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})(?!\d)"
_MONTH = rf"{_EDGE}({_NAMES})\.?,?\s+(?:de\s+)?(\d{{4}})(?!\d)"
_FIGURES = r"(?<![\d/.-])(\d{1,2})([/.-])(\d{1,2})\2(\d{4}|\d{2})(?!\d)"
_TIME = r"(?<![\d:+-])(\d{1,2}):(\d{2})(?::(\d{2})(\.\d{1,6})?)?\s*([ap])?\.?(?:m\b)?"
_HOUR = r"(?<![\d:])(\d{1,2})\s*([ap])\.?m\b"
_OFFSET = r"(?:\d|\s)([+-])(\d{2}):?(\d{2})(?!\d)"
_AGO = rf"{_EDGE}(\d+|an?)\s+({'|'.join(UNITS)})s?\s+ago\b"


#: Every group that is read, by a name of its own.
_GROUPS = {
    f"{name}{group}": (pattern, group)
    for name, pattern, groups in (
        ("iso", _ISO, (1, 3, 4)), ("basic", _BASIC, (1, 2, 3, 4, 5, 6)), ("dm", _DAY_MONTH, (1, 2, 3)), ("md", _MONTH_DAY, (1, 2, 3)), ("m", _MONTH, (1, 2)), ("fig", _FIGURES, (1, 3, 4)),
        ("time", _TIME, (1, 2, 3, 4, 5)), ("hour", _HOUR, (1, 2)), ("off", _OFFSET, (1, 2, 3)), ("ago", _AGO, (1, 2)), ("word", rf"{_EDGE}(today|yesterday|tomorrow)\b", (1,)),
    )
    for group in groups
}


def _month(name: Column) -> Column:
    out = F.lit(None).cast("int")
    for number, names in reversed(list(enumerate(MONTHS, 1))):
        out = F.when(name.isin(*names), number).otherwise(out)
    return out


def read(text: Column, as_of: Column | None = None, day_first: bool = False) -> Column:
    """The time that a text names (timestamp), or null."""
    as_of = F.current_timestamp() if as_of is None else as_of

    def found(low: Column) -> Column:
        return F.struct(*(F.regexp_extract(low, pattern, group).alias(name) for name, (pattern, group) in _GROUPS.items()))

    return let(F.lower(text), lambda low: let(found(low), lambda m: let(_parts(m, as_of, day_first), lambda p: _time(p, as_of))))


def _parts(m: Column, as_of: Column, day_first: bool) -> Column:
    """What the groups ``m`` say: the date, the shift from its midnight, a named day, an age."""

    def n(name: str) -> Column:
        return F.nullif(m[name], F.lit("")).try_cast("int")

    near = F.year(as_of)
    first, second, year = n("fig1"), n("fig3"), n("fig4")
    short = year + F.round((near - year) / 100).cast("int") * 100
    year = F.when(F.length(m["fig4"]) == 2, short).otherwise(year)
    swapped = (first > 12) if not day_first else (second <= 12)
    month, day = F.when(swapped, second).otherwise(first), F.when(swapped, first).otherwise(second)
    iso = _day(n("iso1"), n("iso3"), n("iso4"))
    date = F.coalesce(
        iso, _day(n("basic1"), n("basic2"), n("basic3")), _day(n("dm3"), _month(m["dm2"]), n("dm1")), _day(n("md3"), _month(m["md1"]), n("md2")),
        _day(n("m2"), _month(m["m1"]), F.lit(1)), _day(year, month, day),
    )

    def half(hour: Column, sign: Column) -> Column:
        return F.when(sign == "", hour).when(hour.between(1, 12), hour % 12 + F.when(sign == "p", 12).otherwise(0))

    basic, clock = n("basic4").isNotNull() & iso.isNull(), n("time1").isNotNull()
    word = m["word1"]
    many = F.when(m["ago1"].isin("a", "an"), 1).otherwise(F.nullif(m["ago1"], F.lit("")).try_cast("long"))
    unit = F.lit(None).cast("long")
    for name, seconds in UNITS.items():
        unit = F.when(m["ago2"] == name, seconds).otherwise(unit)
    return F.struct(
        date.alias("date"), F.when(basic, n("basic4")).when(clock, half(n("time1"), m["time5"])).otherwise(half(n("hour1"), m["hour2"])).alias("hour"),
        F.when(basic, n("basic5")).when(clock, n("time2")).alias("minute"), F.when(basic, n("basic6")).when(clock, n("time3")).alias("second"),
        F.when(clock & ~basic, F.round(F.nullif(m["time4"], F.lit("")).try_cast("double") * 1000000)).cast("long").alias("micros"),
        ((n("off2") * 3600 + n("off3") * 60) * F.when(m["off1"] == "-", -1).otherwise(1)).alias("offset"),
        F.when(word == "today", 0).when(word == "yesterday", -1).when(word == "tomorrow", 1).alias("days"), (many * unit).alias("age"),
    )


def _time(p: Column, as_of: Column) -> Column:
    million = F.lit(1000000).cast("long")
    zero = F.lit(0)
    hour, minute, second = (F.coalesce(p[k], zero) for k in ("hour", "minute", "second"))
    # A time that can't be one is taken for none.
    real = (hour < 24) & (minute < 60) & (second < 60)
    of_day = hour * 3600 + minute * 60 + second - F.when(p["hour"].isNotNull(), F.coalesce(p["offset"], zero)).otherwise(0)
    shift = F.when(real, of_day * million + F.coalesce(p["micros"], zero)).otherwise(0)

    def on(date: Column) -> Column:
        return F.timestamp_micros(F.unix_date(date).cast("long") * 86400 * million + shift)

    ago = F.timestamp_micros(F.unix_micros(as_of.cast("timestamp")) - p["age"] * million)
    return F.coalesce(on(p["date"]), on(F.date_add(F.to_date(as_of), p["days"])), ago)


def _day(year: Column, month: Column, day: Column) -> Column:
    """The date, or null where there is no such day."""
    ok = year.between(1, 9999) & month.between(1, 12) & (day >= 1)
    first = F.make_date(F.when(ok, year), F.when(ok, month), F.lit(1))
    last = F.day(F.last_day(first))
    return F.when(day <= last, F.date_add(first, day - 1))
