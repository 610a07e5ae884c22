"""Texts and slots shown for a published row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kermesse.functions.money import pesos
from kermesse.functions.text import is_public_url
from kermesse.vocab.calendar import WEEKDAY_DISPLAY

_SHORT = ["ene", "feb", "mar", "abr", "may", "jun", "jul", "ago", "sep", "oct", "nov", "dic"]
_MONTH_NAMES = ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto",
                "septiembre", "octubre", "noviembre", "diciembre"]


def _name(names: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), index)


def price_text(free: Column, price: Column) -> Column:
    return (F.when(F.coalesce(free, F.lit(False)), F.lit("Gratis"))
            .when(F.coalesce(price, F.lit(0)) > 0, pesos(price)).otherwise(F.lit("—")))


def day_label(start: Column, as_of: Column) -> Column:
    """``HOY``, ``MAÑANA`` or ``15 mar``."""
    day, ref = start.cast("date"), as_of.cast("date")
    return (F.when(day == ref, "HOY").when(day == F.date_add(ref, 1), "MAÑANA")
            .otherwise(F.concat(F.dayofmonth(day).cast("string"), F.lit(" "),
                                _name(_SHORT, F.month(day) - 1))))


def long_day(day: Column) -> Column:
    """``27 de septiembre``."""
    return F.concat(F.dayofmonth(day).cast("string"), F.lit(" de "),
                    _name(_MONTH_NAMES, F.month(day) - 1))


def ends_label(end: Column) -> Column:
    return F.coalesce(F.concat(F.lit("En cartelera hasta el "), long_day(end)), F.lit(""))


def has_hour(ts: Column) -> Column:
    """Midnight means the hour is unknown."""
    return (F.hour(ts) != 0) | (F.minute(ts) != 0)


def season_running(start: Column, end: Column, weekdays: Column, as_of: Column) -> Column:
    """Opened before today, closes today or later, and is not a weekly series."""
    ref = as_of.cast("date")
    series = F.coalesce(F.size(weekdays), F.lit(0)) > 0
    return F.coalesce((start.cast("date") < ref) & (end.cast("date") >= ref), F.lit(False)) & ~series


def calendar_slot(start: Column, end: Column, weekdays: Column, as_of: Column) -> Column:
    """``struct(begin, finish, all_day)`` of the calendar entry for one visit."""
    running = season_running(start, end, weekdays, as_of)
    begin = F.when(running, as_of.cast("date").cast("timestamp_ntz")).otherwise(start)
    all_day = running | ~has_hour(start)
    series = F.coalesce(F.size(weekdays), F.lit(0)) > 0
    same_day = F.coalesce((end > start) & (end.cast("date") == start.cast("date")), F.lit(False)) & ~series
    finish = (F.when(all_day, F.date_add(begin.cast("date"), 1).cast("timestamp_ntz"))
              .when(same_day, end)
              .otherwise(start + F.expr("INTERVAL 2 HOURS")))
    return F.struct(begin.alias("begin"), finish.alias("finish"), all_day.alias("all_day"))


def calendar_link(title: Column, slot: Column, details: Column, location: Column) -> Column:
    stamp = lambda t: F.when(slot["all_day"], F.date_format(t, "yyyyMMdd")).otherwise(
        F.date_format(t, "yyyyMMdd'T'HHmmss"))
    return F.concat(F.lit("https://calendar.google.com/calendar/render?action=TEMPLATE&text="),
                    F.url_encode(title), F.lit("&dates="), stamp(slot["begin"]), F.lit("%2F"),
                    stamp(slot["finish"]), F.lit("&details="), F.url_encode(details),
                    F.lit("&location="), F.url_encode(location))


def share_text(title: Column, start: Column, place: Column, free: Column, price: Column) -> Column:
    """Two lines: the title, then when, where and how much."""
    day = F.concat(_name(list(WEEKDAY_DISPLAY), F.weekday(start.cast("date"))), F.lit(", "),
                   long_day(start))
    hour = F.when(has_hour(start), F.concat(F.lit(" a las "), F.date_format(start, "HH:mm"))).otherwise("")
    cost = (F.when(F.coalesce(free, F.lit(False)), F.lit(" · Gratis"))
            .when(F.coalesce(price, F.lit(0)) > 0, F.concat(F.lit(" · "), pesos(price))).otherwise(""))
    return F.concat(title, F.lit("\n"), day, hour, F.lit(" · "), place, cost)


def share_card(title: Column, start: Column, end: Column, place: Column, address: Column,
               area: Column, free: Column, price: Column, url: Column, image: Column) -> Column:
    """``struct(summary, json)``: a summary of at most 180 characters and the schema.org text."""
    public = lambda u: F.when(is_public_url(u), u).otherwise(F.lit(""))
    summary = F.substring(F.regexp_replace(share_text(title, start, place, free, price), "\n", " · "),
                          1, 180)
    iso = lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    node = F.struct(
        F.lit("https://schema.org").alias("@context"), F.lit("Event").alias("@type"),
        title.alias("name"), iso(start).alias("startDate"), iso(end).alias("endDate"),
        F.struct(F.lit("Place").alias("@type"), place.alias("name"),
                 F.concat_ws(", ", F.when(address != "", address), F.when(area != "", area))
                 .alias("address")).alias("location"),
        F.struct(F.lit("Offer").alias("@type"),
                 F.when(F.coalesce(free, F.lit(False)), F.lit(0)).otherwise(price).alias("price"),
                 F.lit("CLP").alias("priceCurrency")).alias("offers"),
        public(url).alias("url"), public(image).alias("image"))
    return F.struct(summary.alias("summary"), F.to_json(node).alias("json"))
