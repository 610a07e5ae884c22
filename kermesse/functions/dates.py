"""Spanish dates, hours and weekly cadence as column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from kermesse.functions.text import fold_text, let, str_array, str_map
from kermesse.vocab import calendar as cal

MONTH_WORDS = "|".join(sorted(cal.MONTHS, key=len, reverse=True))
_OPEN, _CLOSE, _GROUP = "\u0001", "\u0002", "\u0003"

# Date formats of the sources, in the order they are tried.
COMPACT = r"(?<!\d)(20[2-9]\d)(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])(?!\d)"
DASHED = r"(\d{4})-(\d{2})-(\d{2})(?:[Tt ](\d{1,2}):(\d{2}))?"
SLASHED = r"\b(\d{1,2})[/-](\d{1,2})(?:[/-](\d{2,4}))?\b"
CROSS_MONTH = (rf"\b(?:del?\s+|desde\s+el\s+)?(\d{{1,2}})\s*(?:de\s+)?({MONTH_WORDS})"
               rf"\s+al?\s+(\d{{1,2}})\s*(?:de\s+)?({MONTH_WORDS})\b"
               r"(?:\s*,?\s*(?:de|del)?\s*(\d{4}))?")
SAME_MONTH = (rf"\b(?:del\s+|desde\s+el\s+)?(\d{{1,2}})\s+al\s+\d{{1,2}}\s*(?:de\s+)?"
              rf"({MONTH_WORDS})\b(?:\s*,?\s*(?:de|del)?\s*(\d{{4}}))?")
LONG = (rf"\b(\d{{1,2}})\s*(?:de\s+)?({MONTH_WORDS})\b"
        r"(?:\s*,?\s*(?:de|del)?\s*(\d{4}))?")
HOUR_MINUTE = r"\b(?:a\s+las\s+)?([01]?\d|2[0-3])[:.h](\d{2})\b"
HOUR_ONLY = r"\b(?:a\s+las\s+)([01]?\d|2[0-3])\s*(?:hrs?|horas)?\b"
PLAIN_HOUR = r"\b([01]?\d|2[0-3])[:.h](\d{2})\b"


def month_number(word: Column) -> Column:
    return F.try_element_at(str_map(cal.MONTHS), word)


def _int(text: Column) -> Column:
    return text.try_cast("int")


def _stamp(y: Column, m: Column, d: Column, hh: Column | None = None,
           mm: Column | None = None) -> Column:
    zero = F.lit(0)
    return F.try_make_timestamp_ntz(y, m, d, F.coalesce(hh, zero) if hh is not None else zero,
                                    F.coalesce(mm, zero) if mm is not None else zero,
                                    F.lit(0).cast("decimal(16,6)"))


def _hits(s: Column, pattern: str, read: Callable[[Callable[[int], Column]], dict],
          only_first: bool = False, sign: Column | None = None) -> Column:
    """First valid date of a pattern: ``struct(ts, range_end, has_year, pos)`` or NULL.

    The text is cut at each match, so the position of the chosen match is exact even when
    the same characters occur earlier in another context. One pass marks every match and
    writes its groups behind it: no group costs another search. ``sign`` is a cheap test
    that every text with a match passes.
    """
    groups = re.compile(pattern).groups
    marks = "".join(f"{_GROUP}${k + 1}" for k in range(1, groups + 1))
    marked = F.regexp_replace(s, f"({pattern})", f"{_OPEN}$1{marks}{_CLOSE}")

    def scan(parts: Column) -> Column:
        tail = F.slice(parts, 2, 1 if only_first else F.greatest(F.size(parts), F.lit(1)))

        def told(m: Column) -> Column:
            got = read(lambda k: F.get(m, F.lit(k)))
            return F.struct(
                got["ts"].alias("ts"),
                got.get("range_end", F.lit(None).cast("timestamp_ntz")).alias("range_end"),
                got["has_year"].alias("has_year"), F.length(F.get(m, F.lit(0))).alias("long"))

        def one(part: Column, i: Column) -> Column:
            return F.struct(let(F.split(F.substring_index(part, _CLOSE, 1), _GROUP), told).alias("m"), i.alias("i"))

        def placed(h: Column) -> Column:
            before = F.regexp_replace(F.array_join(F.slice(parts, 1, h["i"] + 1), ""), f"{_GROUP}[^{_CLOSE}]*{_CLOSE}", "")
            return F.when(h.isNotNull(), F.struct(
                h["m"]["ts"].alias("ts"), h["m"]["range_end"].alias("range_end"), h["m"]["has_year"].alias("has_year"),
                (F.length(before) + h["m"]["long"]).alias("pos")))

        return let(F.get(F.filter(F.transform(tail, one), lambda h: h["m"]["ts"].isNotNull()), F.lit(0)), placed)

    there = s.rlike(pattern) if sign is None else sign & s.rlike(pattern)
    return F.when(there, let(F.split(marked, _OPEN), scan))


def parse_date_es(text: Column, as_of: Column, published: Column | None = None) -> Column:
    """First recognisable date of a Spanish free text, as TIMESTAMP_NTZ.

    Formats are tried in the order of the fixed values above (a dashed date overrides a
    compact one). A date without year belongs to the reference year, or to the next one
    when it is over 30 days old and its range is not running. The hour is looked for in
    the 120 characters after the date.
    """
    as_of = as_of.cast("date")
    ref = as_of if published is None else F.coalesce(published.cast("date"), as_of)
    default_year = F.year(ref)

    def year_of(text_year: Column) -> Column:
        y = _int(text_year)
        return F.coalesce(F.when(y < 100, y + 2000).otherwise(y), default_year)

    def parse(s: Column) -> Column:
        has = lambda sign: F.contains(s, F.lit(sign))
        compact = _hits(s, COMPACT, lambda g: {
            "ts": _stamp(_int(g(1)), _int(g(2)), _int(g(3))), "has_year": F.lit(True)}, sign=has("20"))
        dashed = _hits(s, DASHED, lambda g: {
            "ts": _stamp(_int(g(1)), _int(g(2)), _int(g(3)), _int(g(4)), _int(g(5))),
            "has_year": F.lit(True)}, sign=has("-"))
        slashed = _hits(s, SLASHED, lambda g: {
            "ts": _stamp(year_of(g(3)), _int(g(2)), _int(g(1))), "has_year": g(3) != ""}, sign=has("/") | has("-"))

        def cross(g):
            y = year_of(g(5))
            start = _stamp(y, month_number(g(2)), _int(g(1)))
            end = _stamp(y, month_number(g(4)), _int(g(3)))
            end = F.when(end >= start, end).otherwise(
                _stamp(y + 1, month_number(g(4)), _int(g(3))))
            return {"ts": F.when(end.isNotNull(), start), "range_end": end,
                    "has_year": g(5) != ""}

        crossing = _hits(s, CROSS_MONTH, cross, only_first=True, sign=s.rlike(r"\sal?\s"))
        same = _hits(s, SAME_MONTH, lambda g: {
            "ts": _stamp(year_of(g(3)), month_number(g(2)), _int(g(1))),
            "has_year": g(3) != ""}, only_first=True, sign=has("al"))
        long = _hits(s, LONG, lambda g: {
            "ts": _stamp(year_of(g(3)), month_number(g(2)), _int(g(1))), "has_year": g(3) != ""})
        hit = F.coalesce(dashed, compact, slashed, crossing, same, long)

        def settle(h: Column) -> Column:
            dated = h["has_year"] | F.substring(s, F.lit(1), h["pos"]).rlike(r"\b(19|20)\d{2}\b")
            running = F.coalesce(h["range_end"].cast("date") >= as_of, F.lit(False))
            stale = h["ts"].cast("date") < F.date_sub(ref, 30)
            day = F.when(~dated & ~running & stale,
                         _stamp(F.year(h["ts"]) + 1, F.month(h["ts"]), F.dayofmonth(h["ts"]))
                         ).otherwise(h["ts"])
            return let(F.struct(day.alias("d"), F.substring(s, h["pos"] + 1, F.length(s)).alias("w")),
                       lambda p: with_hour_after(p["d"], p["w"]))

        return let(hit, settle)

    return let(fold_text(text), parse)


def with_hour_after(day: Column, window: Column) -> Column:
    """Give a midnight date the hour written in the text that follows it."""
    at = lambda h, m: _stamp(F.year(day), F.month(day), F.dayofmonth(day), h, m)
    hour = let(_int(F.regexp_extract(window, HOUR_ONLY, 1)), lambda h: F.when(h.isNotNull(), at(h, F.lit(0))))
    timed = let(_int(F.regexp_extract(window, HOUR_MINUTE, 1)), lambda h: F.when(
        h.isNotNull(), at(h, _int(F.regexp_extract(window, HOUR_MINUTE, 2)))).otherwise(hour))
    midnight = (F.hour(day) == 0) & (F.minute(day) == 0)
    return F.when(midnight, F.coalesce(timed, day)).otherwise(day)


def parse_time(text: Column) -> Column:
    """First ``19:30`` / ``19.30`` / ``19h30`` of a text as ``HH:mm``, or NULL."""
    hh, mm = F.regexp_extract(text, PLAIN_HOUR, 1), F.regexp_extract(text, PLAIN_HOUR, 2)
    ok = (hh != "") & (_int(mm) < 60)
    return F.when(ok, F.concat_ws(":", F.lpad(hh, 2, "0"), mm))


def iso_date(text: Column) -> Column:
    """Date part of an ISO stamp with or without zone, or NULL."""
    return F.to_date(F.try_to_timestamp(F.substring(F.coalesce(text, F.lit("")), 1, 10),
                                        F.lit("yyyy-MM-dd")))


def parse_published(mark: Column, as_of: Column) -> Column:
    """Publication stamp of a feed entry: RFC-822 first, else the Spanish/ISO reader."""
    bare = F.regexp_replace(F.trim(F.coalesce(mark, F.lit(""))), r"^[A-Za-z]{3},\s*", "")
    rfc = F.regexp_extract(
        bare, r"^(\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2})", 1)
    return F.coalesce(
        F.to_timestamp_ntz(F.try_to_timestamp(
            F.when(rfc != "", rfc), F.lit("d MMM yyyy HH:mm:ss")).cast("string")),
        parse_date_es(mark, as_of))


def weekday0(day: Column) -> Column:
    """0 = Monday .. 6 = Sunday."""
    return F.weekday(day)


def _days_where(folded: Column, pattern_of: Callable[[str], str], names) -> list[Column]:
    return [F.when(folded.rlike(pattern_of(n)), F.lit(i)) for n, i in names]


def _sorted_days(flags: list[Column]) -> Column:
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*flags))))


def parse_weekdays(text: Column) -> Column:
    """Sorted distinct weekdays (0 = Monday); abbreviations only when no full name occurs."""
    def read(s: Column) -> Column:
        edge = lambda w: rf"(?<![a-z]){w}(?![a-z])"
        full = _sorted_days(_days_where(s, edge, [(n, i) for i, n in enumerate(cal.WEEKDAYS)]))
        short = _sorted_days(_days_where(s, edge, list(cal.WEEKDAY_ABBREVIATIONS.items())))
        return F.when(F.size(full) > 0, full).otherwise(short)
    return let(fold_text(text), read)


def weekdays_from_title(title: Column) -> Column:
    """Weekdays a municipal title declares, with ``lu a vi`` ranges (no wrap)."""
    codes = "|".join(cal.TITLE_DAY_CODES)

    def read(s: Column) -> Column:
        index = str_map({c: i for i, c in enumerate(cal.TITLE_DAY_CODES)})
        span = rf"\b({codes})\s+a\s+({codes})\b"
        lo = F.try_element_at(index, F.regexp_extract(s, span, 1))
        hi = F.try_element_at(index, F.regexp_extract(s, span, 2))
        ranged = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))
        token = lambda n: rf"\b{n}\b"
        names = [(n + ("s?" if i >= 5 else ""), i) for i, n in enumerate(cal.WEEKDAYS)]
        names += [(c, i) for i, c in enumerate(cal.TITLE_DAY_CODES)]
        named = _sorted_days(_days_where(s, token, names))
        return F.array_sort(F.array_union(F.coalesce(ranged, F.array().cast("array<int>")), named))
    return let(fold_text(title, "trim"), read)


def occurrences(days: Column, start: Column, end: Column) -> Column:
    """Dates from ``start`` to ``end`` on the given weekdays."""
    start, end = start.cast("date"), end.cast("date")
    every = F.when(end >= start, F.sequence(start, end))
    picked = F.filter(every, lambda d: F.array_contains(days, F.weekday(d)))
    return F.coalesce(picked, F.array().cast("array<date>"))


def at_time(day: Column, hhmm: Column) -> Column:
    """A date at ``HH:mm`` (midnight when NULL) as TIMESTAMP_NTZ."""
    return F.to_timestamp_ntz(F.concat_ws(
        " ", day.cast("date").cast("string"),
        F.concat(F.coalesce(hhmm, F.lit("00:00")), F.lit(":00"))))


def session_range(days: Column, start: Column, end: Column, hhmm: Column) -> Column:
    """``struct(first, last)`` real session of a cycle, or NULL when it has none.

    The first lies within a week of the start and the last within a week of the end.
    """
    start, end = start.cast("date"), end.cast("date")
    fits = lambda d: F.array_contains(days, F.weekday(d)) & (d >= start) & (d <= end)
    week = F.sequence(F.lit(0), F.lit(6))
    first = F.get(F.filter(F.transform(week, lambda i: F.date_add(start, i)), fits), F.lit(0))
    last = F.get(F.filter(F.transform(week, lambda i: F.date_sub(end, i)), fits), F.lit(0))
    return let(F.struct(first.alias("first"), last.alias("last")), lambda s: F.when(
        s["first"].isNotNull(), F.struct(at_time(s["first"], hhmm).alias("first"), at_time(s["last"], hhmm).alias("last"))))


def future_sessions(days: Column, hhmm: Column, start: Column, end: Column, as_of: Column,
                    horizon: Column | int = 30) -> Column:
    """Sessions from the later of start and today to the nearer of horizon and end."""
    horizon = F.lit(horizon) if isinstance(horizon, int) else horizon
    as_of = as_of.cast("date")
    first = F.greatest(as_of, F.coalesce(start.cast("date"), as_of))
    last = F.least(F.date_add(as_of, horizon),
                   F.coalesce(end.cast("date"), F.date_add(as_of, horizon)))
    return F.transform(occurrences(days, first, last), lambda d: at_time(d, hhmm))


def cadence_phrase(days: Column, start: Column | None = None, end: Column | None = None) -> Column:
    """``todos los lunes, miércoles y viernes de 19:00 a 20:30``."""
    names = str_array(cal.WEEKDAY_DISPLAY)
    listed = F.transform(days, lambda d: F.get(names, d))
    joined = F.when(F.size(days) == 1, F.get(listed, F.lit(0))).otherwise(F.concat(
        F.array_join(F.slice(listed, 1, F.greatest(F.size(listed) - 1, F.lit(0))), ", "),
        F.lit(" y "), F.element_at(listed, -1)))
    begin = parse_time(start) if start is not None else F.lit(None).cast("string")
    finish = parse_time(end) if end is not None else F.lit(None).cast("string")
    hours = (F.when(begin.isNotNull() & finish.isNotNull(),
                    F.concat(F.lit(" de "), begin, F.lit(" a "), finish))
             .when(begin.isNotNull(), F.concat(F.lit(" a las "), begin))
             .otherwise(F.lit("")))
    return F.when(F.size(days) > 0, F.concat(F.lit("todos los "), joined, hours)).otherwise("")


def next_session(days: Column, start: Column, end: Column, as_of: Column) -> Column:
    """Next session of a weekly series within eight days, or NULL when it is over."""
    hhmm = F.date_format(start, "HH:mm")
    last = F.coalesce(end, start)
    week = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: at_time(
        F.date_add(as_of.cast("date"), i), hhmm))
    fits = F.filter(week, lambda t: (t >= start) & (t <= last)
                    & F.array_contains(days, F.weekday(t.cast("date"))))
    return F.get(fits, F.lit(0))


def date_from_weekday_and_day(weekday: Column, day_number: Column, as_of: Column,
                              window: int = 12) -> Column:
    """Earliest date within ``window`` days that has this weekday and day of month."""
    as_of = as_of.cast("date")
    near = F.sequence(F.date_sub(as_of, window), F.date_add(as_of, window))
    return F.get(F.filter(near, lambda d: (F.weekday(d) == weekday)
                          & (F.dayofmonth(d) == day_number)), F.lit(0))


def window_bounds(name: str, as_of: Column) -> tuple[Column, Column]:
    """First and last day of ``hoy``, ``manana``, ``semana`` or ``finde``."""
    day = as_of.cast("date")
    if name == "hoy":
        return day, day
    if name == "manana":
        return F.date_add(day, 1), F.date_add(day, 1)
    if name == "semana":
        return day, F.date_add(day, 7)
    if name == "finde":
        wd = F.weekday(day)
        start = F.when(wd < 4, F.date_add(day, F.lit(4) - wd)).otherwise(day)
        return start, F.date_add(start, F.lit(6) - F.weekday(start))
    raise ValueError(f"unknown window {name!r}")
