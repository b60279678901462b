"""Holiday phrases -> dates as native column expressions (used by A12).

A phrase is ``[<n> day|week|month[s] before|after] <anchor>`` where the
anchor is a named holiday or a ``<Month> <day>`` date; the year is supplied
separately. Phrases are configuration, so they are parsed once on the driver
(unknown phrases raise, all listed); the dates are computed by Spark.
"""

from __future__ import annotations

import calendar
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_PHRASE = re.compile(r"^\s*(?:(\d+)\s+(day|week|month)s?\s+(before|after)\s+)?(.+?)\s*$", re.IGNORECASE)
_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september",
           "october", "november", "december")
_DATE = re.compile(r"^(" + "|".join(m[:3] for m in _MONTHS) + r")[a-z]*\.?\s+(\d{1,2})(?:st|nd|rd|th)?$")

# Named holidays.
# ("fixed", month, day) | ("nth", month, weekday, n) with n = -1 for the last one
# | ("easter", offset_days) | ("after_nth", month, weekday, n, offset_days)
HOLIDAYS: dict[str, tuple] = {
    "new year's day": ("fixed", 1, 1),
    "martin luther king day": ("nth", 1, "MON", 3),
    "groundhog day": ("fixed", 2, 2),
    "valentine's day": ("fixed", 2, 14),
    "presidents day": ("nth", 2, "MON", 3),
    "st patrick's day": ("fixed", 3, 17),
    "april fools day": ("fixed", 4, 1),
    "good friday": ("easter", -2),
    "easter": ("easter", 0),
    "tax day": ("fixed", 4, 15),
    "earth day": ("fixed", 4, 22),
    "mother's day": ("nth", 5, "SUN", 2),
    "memorial day": ("nth", 5, "MON", -1),
    "flag day": ("fixed", 6, 14),
    "father's day": ("nth", 6, "SUN", 3),
    "independence day": ("fixed", 7, 4),
    "labor day": ("nth", 9, "MON", 1),
    "patriot day": ("fixed", 9, 11),
    "columbus day": ("nth", 10, "MON", 2),
    "halloween": ("fixed", 10, 31),
    "election day": ("after_nth", 11, "MON", 1, 1),
    "veterans day": ("fixed", 11, 11),
    "thanksgiving": ("nth", 11, "THU", 4),
    "black friday": ("after_nth", 11, "THU", 4, 1),
    "christmas eve": ("fixed", 12, 24),
    "christmas": ("fixed", 12, 25),
    "kwanzaa": ("fixed", 12, 26),
    "new year's eve": ("fixed", 12, 31),
}


def _norm(name: str) -> str:
    s = name.strip().lower().replace("’", "'")
    s = re.sub(r"\s+", " ", s)
    s = re.sub(r"^(the )", "", s)
    aliases = {"new years day": "new year's day", "new year": "new year's day", "new years eve": "new year's eve",
               "valentines day": "valentine's day", "valentine day": "valentine's day",
               "st. patrick's day": "st patrick's day", "saint patrick's day": "st patrick's day",
               "st patricks day": "st patrick's day", "mothers day": "mother's day", "fathers day": "father's day",
               "president's day": "presidents day", "presidents' day": "presidents day",
               "mlk day": "martin luther king day", "martin luther king jr day": "martin luther king day",
               "martin luther king jr. day": "martin luther king day", "veteran's day": "veterans day",
               "veterans' day": "veterans day", "labour day": "labor day", "thanksgiving day": "thanksgiving",
               "christmas day": "christmas", "xmas": "christmas", "easter sunday": "easter",
               "fourth of july": "independence day", "4th of july": "independence day",
               "april fool's day": "april fools day"}
    return aliases.get(s, s)


@dataclass(frozen=True)
class Phrase:
    """A parsed phrase: anchor rule plus a signed offset."""

    anchor: tuple
    n: int = 0
    unit: str = "day"

    @property
    def max_offset_days(self) -> int:
        return abs(self.n) * {"day": 1, "week": 7, "month": 31}[self.unit]


def parse_phrase(text: str) -> Phrase | None:
    m = _PHRASE.match(text or "")
    if not m:
        return None
    n, unit, direction, anchor = m.groups()
    key = _norm(anchor)
    if key in HOLIDAYS:
        rule = HOLIDAYS[key]
    else:
        d = _DATE.match(key)
        if not d:
            return None
        month = [x[:3] for x in _MONTHS].index(d.group(1)) + 1
        day = int(d.group(2))
        if not 1 <= day <= calendar.monthrange(2000, month)[1]:  # a leap year: 29 February exists in some
            return None
        rule = ("fixed", month, day)
    if n is None:
        return Phrase(rule)
    sign = -1 if direction.lower() == "before" else 1
    return Phrase(rule, sign * int(n), unit.lower())


def parse_phrases(texts) -> dict[str, Phrase]:
    """Parse every phrase; raise once, listing all that do not parse."""
    out, bad = {}, []
    for t in sorted(set(texts)):
        p = parse_phrase(t)
        if p is None:
            bad.append(t)
        else:
            out[t] = p
    if bad:
        raise ValueError(f"unparseable holiday phrase(s): {bad}")
    return out


def _nth_weekday(year: Column, month: int, dow: str, n: int) -> Column:
    first = F.make_date(year, F.lit(month), F.lit(1))
    if n > 0:
        return F.date_add(F.next_day(F.date_sub(first, 1), dow), 7 * (n - 1))
    return F.next_day(F.date_sub(F.last_day(first), 7), dow)


def _easter(year: Column) -> Column:
    """Gregorian Easter Sunday (anonymous Gregorian computus)."""
    def idiv(a, b):
        return F.floor(a / b)
    y = year
    a = y % 19
    b = idiv(y, 100)
    c = y % 100
    d = idiv(b, 4)
    e = b % 4
    f = idiv(b + 8, 25)
    g = idiv(b - f + 1, 3)
    h = (19 * a + b - d - g + 15) % 30
    i = idiv(c, 4)
    k = c % 4
    l_ = (32 + 2 * e + 2 * i - h - k) % 7
    m = idiv(a + 11 * h + 22 * l_, 451)
    month = idiv(h + l_ - 7 * m + 114, 31)
    day = (h + l_ - 7 * m + 114) % 31 + 1
    return F.make_date(y, month.cast("int"), day.cast("int"))


def anchor_date(rule: tuple, year: Column) -> Column:
    kind = rule[0]
    if kind == "fixed":
        if rule[1:3] == (2, 29):  # null in a year without it
            return F.when(F.dayofyear(F.make_date(year, F.lit(12), F.lit(31))) == 366, F.date_add(
                F.make_date(year, F.lit(2), F.lit(28)), 1))
        return F.make_date(year, F.lit(rule[1]), F.lit(rule[2]))
    if kind == "nth":
        return _nth_weekday(year, rule[1], rule[2], rule[3])
    if kind == "after_nth":
        return F.date_add(_nth_weekday(year, rule[1], rule[2], rule[3]), rule[4])
    if kind == "easter":
        return F.date_add(_easter(year), rule[1])
    raise ValueError(f"unknown anchor rule {rule!r}")


def phrase_date(p: Phrase, year: Column) -> Column:
    d = anchor_date(p.anchor, year)
    if p.n == 0:
        return d
    if p.unit == "month":
        return F.add_months(d, p.n)
    return F.date_add(d, p.n * (7 if p.unit == "week" else 1))
