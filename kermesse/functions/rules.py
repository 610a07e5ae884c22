"""Label rules as rows: what each says, in what order, and under what name.

The shipped rules are the fixed values of ``vocab``; a curator's table replaces or adds to them. A table is read when a
plan is built (it is a short list by nature, and its length is checked) and compiled to one CASE for each layer.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import astuple, dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kermesse.functions.text import WORD_START, words_regex
from kermesse.vocab import labels as v
from kermesse.vocab import offers as ov

RULES = ("regla string, eje string, capa string, ambito string, prioridad int, etiqueta string, patron string, salvo string, "
         "palabra string")
#: Rules that a plan takes at most; a longer table is not a rule table.
MOST = 5_000
#: What many patterns begin with; tried once for all of them.
LEADS = (WORD_START, r"\b")


@dataclass(frozen=True)
class Rule:
    """``patron`` on the folded text of its layer gives ``etiqueta``, unless ``salvo`` matches too; ``ambito`` limits a
    rule to one category; ``palabra`` is the word it looks for, where it is one."""

    regla: str
    eje: str
    capa: str
    ambito: str
    prioridad: int
    etiqueta: str
    patron: str
    salvo: str = ""
    palabra: str = ""


def _listed(axis: str, layer: str, rows: Iterable[tuple], scope: str = "") -> list[Rule]:
    """Rules of one layer, numbered in their order. ``rows``: label, pattern, [unless, [word]]."""
    stem = ".".join(x for x in (axis, layer, scope) if x).replace(" ", "_")
    return [Rule(f"{stem}.{n:02d}", axis, layer, scope, n, *row) for n, row in enumerate(rows, 1)]


def _words(label: str, words: Iterable[str]) -> list[tuple]:
    return [(label, words_regex([w]), "", w) for w in words]


@lru_cache(maxsize=1)
def shipped() -> tuple[Rule, ...]:
    """The rules of the fixed values."""
    guards = {"fiesta": v.READING_CLUB, "arte": v.TAUGHT, "musica": v.TAUGHT}
    also = {"deporte": v.MATCH_BETWEEN_TEAMS}
    either = lambda label, p: f"(?:{p})|(?:{also[label]})" if label in also else p
    out = _listed("categoria", "texto", [(lab, either(lab, p), guards.get(lab, "")) for lab, p in v.CATEGORY_PATTERNS])
    out += _listed("categoria", "recinto", [(lab, p) for p, lab in v.VENUE_PRIORS])
    for cat, rows in v.SUBCATEGORIES.items():
        out += _listed("subcategoria", "texto", [(lab, words_regex(ws)) for lab, ws in rows], cat)
    for cat in dict.fromkeys(c for _, c, _ in v.VENUE_SUBCATEGORIES):
        out += _listed("subcategoria", "recinto", [(lab, p) for p, c, lab in v.VENUE_SUBCATEGORIES if c == cat], cat)
    out += _listed("escala", "fuente de barrio", [("under", v.NEIGHBOURHOOD_SOURCES)])
    out += _listed("escala", "recinto masivo", _words("masivo", v.BIG_VENUES))
    out += _listed("escala", "recinto chico", _words("under", v.SMALL_VENUES))
    out += _listed("escala", "lugar de barrio", _words("under", v.NEIGHBOURHOOD_WORDS))
    out += _listed("escala", "titulo", [("masivo", v.BIG_TITLE)])
    out += _listed("publico", "nombre propio", _words("todos", v.FALSE_CHILDREN))
    out += _listed("publico", "palabra +18", _words("adultos", v.ADULT_WORDS))
    out += _listed("publico", "recinto nocturno", _words("adultos", v.NIGHT_VENUES))
    out += _listed("publico", "palabra infantil", _words("ninos", v.CHILD_WORDS))
    out += _listed("publico", "palabra juvenil", _words("adolescentes", v.TEEN_WORDS))
    out += _listed("taller", "evento puntual", [("no", v.ONE_OFF)])
    out += _listed("taller", "fuente de talleres", [("si", v.WORKSHOP_SOURCES)])
    out += _listed("taller", "deporte que se ensena", [("si", v.TAUGHT)])
    out += _listed("cocina", "nombre", [(name, p, ov.CUISINE_EXCEPTIONS.get(name, "")) for name, p in ov.CUISINES])
    return tuple(out)


def rule_table(spark: SparkSession, rules: Iterable[Rule] | None = None) -> DataFrame:
    return spark.createDataFrame([astuple(r) for r in (shipped() if rules is None else rules)], RULES)


def read_rules(table: DataFrame) -> tuple[Rule, ...]:
    """The rules of a table in their order; ids must be unique and priorities of a layer distinct."""
    rows = table.select(*[p.strip().split(" ")[0] for p in RULES.split(", ")]).limit(MOST + 1).collect()
    if len(rows) > MOST:
        raise ValueError(f"a rule table holds {MOST} rules at most")
    rules = [Rule(*(x if x is not None else "" for x in r)) for r in rows]
    places = [(r.eje, r.capa, r.ambito, r.prioridad) for r in rules]
    if len({r.regla for r in rules}) < len(rules) or len(set(places)) < len(rules):
        raise ValueError("two rules share an id or a place")
    return tuple(sorted(rules, key=lambda r: (r.eje, r.capa, r.ambito, r.prioridad)))


def layer(rules: tuple[Rule, ...] | None, axis: str, name: str, scope: str = "") -> list[Rule]:
    own = [r for r in (shipped() if rules is None else rules) if (r.eje, r.capa, r.ambito) == (axis, name, scope)]
    return sorted(own, key=lambda r: r.prioridad)


def scopes(rules: tuple[Rule, ...] | None, axis: str, name: str) -> list[str]:
    return list(dict.fromkeys(r.ambito for r in (shipped() if rules is None else rules) if (r.eje, r.capa) == (axis, name)))


def _single(pattern: str) -> bool:
    """Whether no ``|`` stands outside groups and classes; False where that is not plain to see."""
    bare = re.sub(r"\\.", "", pattern)
    if r"\Q" in pattern or re.search(r"\[[^\]]*\[|\[\^?\]", bare):
        return False
    bare, last = re.sub(r"\[[^\]]*\]", "", bare), None
    while bare != last:
        last, bare = bare, re.sub(r"\([^()]*\)", "", bare)
    return not set(bare) & set("|()[]")


def any_of(patterns: Iterable[str]) -> str:
    """One pattern that matches where any of them does. A shared beginning is written once: tried for each of many words at
    each character, it is what a long text takes its time for."""
    rest, led = [], {lead: [] for lead in LEADS}
    for p in patterns:
        lead = next((x for x in LEADS if p.startswith(x) and _single(p)), None)
        if lead is None:
            rest.append(f"(?:{p})")
        else:
            led[lead].append(p[len(lead):])
    return "|".join([f"{lead}(?:{'|'.join(ps)})" for lead, ps in led.items() if ps] + rest)


def first_match(text: Column, rules: list[Rule]) -> Column:
    """``struct(label, rule, word)`` of the first rule that matches the folded text, NULL when none does."""
    out = F.lit(None).cast("struct<label: string, rule: string, word: string>")
    for r in reversed(rules):
        hit = text.rlike(r.patron) & ~text.rlike(r.salvo) if r.salvo else text.rlike(r.patron)
        out = F.when(hit, F.struct(F.lit(r.etiqueta).alias("label"), F.lit(r.regla).alias("rule"), F.lit(r.palabra).alias("word"))).otherwise(out)
    if len(rules) > 1:
        out = F.when(text.rlike(any_of(r.patron for r in rules)), out)
    return out
