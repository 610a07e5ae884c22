"""Offer text: days, labels, expiry, channel, merchant names, cuisine."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from kermesse.functions.dates import month_number
from kermesse.functions.money import joined
from kermesse.functions.rules import Rule, first_match, layer
from kermesse.functions.text import fold_text, let, str_array, str_map
from kermesse.vocab import calendar as cal
from kermesse.vocab import offers as v
from kermesse.vocab.places import REGION_AREAS


def weekdays_in_offer(*texts: Column) -> Column:
    """Day names an offer runs on, Monday first; ranges wrap the week; [] = no restriction."""
    names = "|".join(cal.WEEKDAYS)
    span = rf"((?:{names})s?\s+a\s+(?:{names})s?)"
    all_names = str_array(cal.WEEKDAYS)

    def read(s: Column) -> Column:
        spans = F.regexp_extract_all(s, F.lit(span), 1)

        def covered(r: Column) -> Column:
            lo = F.array_position(all_names, F.regexp_extract(r, rf"^({names})s?\s", 1)) - 1
            hi = F.array_position(all_names, F.regexp_extract(r, rf"\s({names})s?$", 1)) - 1
            steps = F.sequence(F.lit(0), F.pmod(hi - lo, F.lit(7)).cast("int"))
            return F.transform(steps, lambda k: F.pmod(lo.cast("int") + k, F.lit(7)))

        ranged = F.flatten(F.transform(spans, covered))
        named = F.array_compact(F.array(*[F.when(
            s.rlike(rf"(?<![a-z0-9]){n}s?(?![a-z0-9])"), F.lit(i))
            for i, n in enumerate(cal.WEEKDAYS)]))
        weekend = F.when(s.rlike(v.WEEKEND), F.array(F.lit(5), F.lit(6))).otherwise(
            F.array().cast("array<int>"))
        days = F.array_sort(F.array_distinct(F.concat(ranged, named, weekend)))
        return F.when(s.rlike(v.EVERY_DAY), all_names).otherwise(
            F.transform(days, lambda d: F.get(all_names, d)))

    return let(joined(*texts), read)


def offer_label(*texts: Column) -> Column:
    """Short label of an offer that is not a percentage: ``2x1``, gift, combo or blank."""
    def read(s: Column) -> Column:
        n, m = (F.regexp_extract(s, r"\b(\d)\s*x\s*(\d)\b", k) for k in (1, 2))
        return (F.when(n > m, F.concat(n, F.lit("x"), m))
                .when(s.rlike(v.GIFT), F.lit("Con regalo"))
                .when(s.rlike(v.COMBO), F.lit("Combo")).otherwise(F.lit("")))
    return let(joined(*texts), read)


def expiry_in(*texts: Column) -> Column:
    """Last valid day: a long Spanish date, else d/m/yyyy."""
    def read(s: Column) -> Column:
        long = r"(\d{1,2})\s+de\s+([a-z]+)\s+(?:de\s+|del\s+)?(\d{4})"
        short = r"(\d{1,2})[/-](\d{1,2})[/-](\d{4})"
        g = lambda p, k: F.regexp_extract(s, p, k)
        num = lambda c: F.when(c != "", c.try_cast("int"))
        full_names = [m for m in cal.MONTHS if len(m) > 4 or m == "mayo"]
        known = g(long, 2).isin(*full_names)
        day = lambda y, m, d: F.try_make_timestamp_ntz(
            y, m, d, F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)")).cast("date")
        return F.when(known, day(num(g(long, 3)), month_number(g(long, 2)), num(g(long, 1)))).otherwise(
            day(num(g(short, 3)), num(g(short, 2)), num(g(short, 1))))
    return let(joined(*texts), read)


def channel_in(*texts: Column) -> Column:
    """``presencial``, ``online``, ``ambas`` or blank."""
    def read(s: Column) -> Column:
        here, there = s.rlike(v.IN_PERSON), s.rlike(v.ONLINE)
        return (F.when(here & there, "ambas").when(here, "presencial")
                .when(there, "online").otherwise(""))
    return let(joined(*texts), read)


def is_food_offer(*texts: Column) -> Column:
    return joined(*texts).rlike(v.FOOD)


def in_region(area: Column, region: Column) -> Column:
    """The area decides when declared, then the region; undeclared passes."""
    flat = fold_text(region)
    by_region = (flat == "") | flat.rlike("metropolitana|todo chile|santiago")
    return F.when(F.coalesce(area, F.lit("")) != "", area.isin(*REGION_AREAS)).otherwise(by_region)


def homologate_rubric(raw: Column) -> Column:
    """Rubric in the single vocabulary; unknown ones stay visible as they are."""
    slug = F.replace(fold_text(raw, "squeeze"), F.lit(" "), F.lit("-"))
    last = F.element_at(F.split(slug, "/"), -1)
    return F.when(slug == "", F.lit("restaurantes")).otherwise(
        F.coalesce(F.try_element_at(str_map(v.RUBRICS), last), last))


def cuisine_rule(merchant: Column, rubric: Column, rules: tuple[Rule, ...] | None = None) -> Column:
    """``struct(label, rule)``: cuisine from the merchant name; the rubric decides only when the name is silent."""
    told = lambda label, rule: F.struct(F.lit(label).alias("label"), F.lit(rule).alias("rule"))

    def read(s: Column) -> Column:
        hom = homologate_rubric(rubric)
        named = let(first_match(s, layer(rules, "cocina", "nombre")), lambda m: F.when(m.isNotNull(), F.struct(m["label"].alias("label"), m["rule"].alias("rule"))))
        return F.coalesce(F.when(s != "", named), F.when(s == "", told("", "cocina.sin_nombre")),
                          F.when(hom == "cafeterias", told("cafe", "cocina.rubro_cafeterias")),
                          F.when(hom == "comida_rapida", told("comida_rapida", "cocina.rubro_comida_rapida")), told("", "cocina.defecto"))
    return let(fold_text(merchant, "squeeze"), read)


def cuisine_of(merchant: Column, rubric: Column, rules: tuple[Rule, ...] | None = None) -> Column:
    return cuisine_rule(merchant, rubric, rules)["label"]


def rubric_of(rubric: Column, cuisine: Column) -> Column:
    """Homologated rubric, moved by the cuisine when it is the generic one."""
    hom = homologate_rubric(rubric)
    return F.when(hom == "restaurantes", F.coalesce(
        F.try_element_at(str_map(v.RUBRIC_OF_CUISINE), cuisine), hom)).otherwise(hom)


def merchant_from_title(title: Column) -> Column:
    """``40% dcto. en Burger King`` -> ``Burger King``."""
    after = F.regexp_replace(title, r"^.*?\s+en\s+", "")
    return F.regexp_replace(F.regexp_replace(after, r"(?s)\s+todos los\s+.*$", ""),
                            r"^[ .,]+|[ .,]+$", "")


def trim_dangling_title(title: Column) -> Column:
    """Drop the truncated headline a source leaves after the merchant name."""
    tail = "|".join(re.escape(t) for t in v.DANGLING_TITLE)
    out = F.regexp_replace(F.trim(title), f"(?:{tail})$", "")
    return F.regexp_replace(out, r"^[ \-–]+|[ \-–]+$", "")


def valid_on_day(days: Column, day: Column) -> Column:
    """No listed day means every day."""
    names = str_array(cal.WEEKDAYS)
    return (F.size(days) <= 0) | F.array_contains(days, F.get(names, F.weekday(day.cast("date"))))


def offer_amount(percent: Column, label: Column) -> Column:
    return F.when(F.coalesce(percent, F.lit(0)) > 0, F.concat(percent.cast("string"), F.lit("%"))
                  ).otherwise(F.coalesce(label, F.lit("")))


def day_ribbon(days: Column) -> Column:
    """``TODOS``, ``n DÍAS`` or the day names."""
    return (F.when(F.size(days) <= 0, F.lit("TODOS"))
            .when(F.size(days) > 2, F.concat(F.size(days).cast("string"), F.lit(" DÍAS")))
            .otherwise(F.array_join(F.transform(days, lambda d: F.upper(F.substring(d, 1, 3))), " ")))
