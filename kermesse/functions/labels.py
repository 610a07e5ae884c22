"""Ordered-rule classification of events, one CASE per layer over text folded once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kermesse.functions.rules import Rule, first_match, layer, scopes
from kermesse.functions.text import fold_py, fold_text, let, mentions_any, str_array
from kermesse.vocab import discovery as d
from kermesse.vocab import labels as v


def _norm(*parts: Column) -> Column:
    return fold_text(F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts]), "collapse")


def _result(label: Column | str, reason: Column | str, rule: Column | str) -> Column:
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.struct(lit(label).alias("label"), lit(reason).alias("reason"), lit(rule).alias("rule"))


def _by_rule(text: Column, rules: list[Rule], reason: str | None = None) -> Column:
    """What the first matching rule says; its reason is the layer, with the word where the rule is one."""
    def told(m: Column) -> Column:
        why = F.lit(reason) if reason else F.concat(F.lit(rules[0].capa + ": "), m["word"])
        return F.when(m.isNotNull(), _result(m["label"], why, m["rule"]))
    if not rules:
        return F.lit(None).cast("struct<label: string, reason: string, rule: string>")
    return let(let(text, lambda t: first_match(t, rules)), told)


def classify_category(title: Column, source_category: Column, description: Column,
                      place: Column, source: Column, rules: tuple[Rule, ...] | None = None) -> Column:
    """``struct(label, reason, rule)``; reason is titulo, descripcion, prior or defecto."""
    context = _norm(place, source)
    head = _norm(source_category, title)
    head = F.when(mentions_any(head, v.FALSE_CHILDREN), F.lit(" ")).otherwise(head)
    head = F.when(context.rlike(v.ART_MUSEUMS), F.regexp_replace(head, v.WORK_WORD, " ")).otherwise(head)
    texts = layer(rules, "categoria", "texto")

    def layers(h: Column) -> Column:
        body = _norm(h, description)
        for name in v.FALSE_CHILDREN:
            body = F.replace(body, F.lit(fold_py(name)), F.lit(" "))
        return F.coalesce(_by_rule(h, texts, "titulo"), _by_rule(body, texts, "descripcion"),
                          _by_rule(context, layer(rules, "categoria", "recinto"), "prior"),
                          _result(v.DEFAULT_CATEGORY, "defecto", "categoria.defecto"))
    return let(head, layers)


def classify_subcategory(category: Column, title: Column, source_category: Column,
                         description: Column, place: Column, source: Column,
                         rules: tuple[Rule, ...] | None = None) -> Column:
    """Second level inside the category; blank is a legitimate answer."""
    def of(name: str, text: Column, reason: str) -> Column:
        def read(t: Column) -> Column:
            out = F.lit(None).cast("struct<label: string, reason: string, rule: string>")
            for cat in scopes(rules, "subcategoria", name):
                out = F.when(category == cat, _by_rule(t, layer(rules, "subcategoria", name, cat), reason)).otherwise(out)
            return out
        return let(text, read)

    found = F.coalesce(of("texto", _norm(source_category, title), "titulo"), of("texto", _norm(description), "descripcion"),
                       of("recinto", _norm(place, source), "lugar"))
    return F.coalesce(F.when(category.isin(*scopes(rules, "subcategoria", "texto")), found), _result("", "defecto", "subcategoria.defecto"))


def classify_scale(title: Column, place: Column, source: Column, price: Column,
                   description: Column, rules: tuple[Rule, ...] | None = None) -> Column:
    """``masivo``, ``under`` or blank, with the rule that fired."""
    of = lambda name, text, reason=None: _by_rule(text, layer(rules, "escala", name), reason)
    ttl = _norm(title)
    word = F.concat(F.lit("titulo: "), F.regexp_extract(ttl, v.BIG_TITLE, 1))
    pricey = F.coalesce(price > v.BIG_PRICE_CLP, F.lit(False)) & ~ttl.rlike(v.TAUGHT)
    return F.coalesce(
        of("fuente de barrio", _norm(source), "fuente de barrio"), of("recinto masivo", _norm(place, title, description)),
        of("recinto chico", _norm(place, source)), of("lugar de barrio", _norm(place)),
        let(of("titulo", ttl, "titulo"), lambda r: F.when(r.isNotNull(), _result(r["label"], word, r["rule"]))),
        F.when(pricey, _result("masivo", "precio", "escala.precio")), _result("", "sin senal", "escala.defecto"))


def classify_audience(title: Column, description: Column, category: Column, place: Column,
                      source: Column, hour: Column | None = None, rules: tuple[Rule, ...] | None = None) -> Column:
    """``ninos``, ``adolescentes``, ``adultos`` or ``todos``; ``hour=None`` ignores lateness."""
    late = F.lit(False) if hour is None else F.coalesce(hour >= v.NIGHT_HOUR, F.lit(False))
    party = category == "fiesta"
    night_source = F.contains(_norm(source), F.lit(v.NIGHT_SOURCE))
    of = lambda name, text, reason=None: _by_rule(text, layer(rules, "publico", name), reason)

    def layers(t: Column) -> Column:
        age = F.regexp_extract(t, v.EXPLICIT_AGE, 1).try_cast("int")
        age_label = F.when(age >= 18, "adultos").when(age >= 13, "adolescentes").otherwise("ninos")
        return F.coalesce(
            of("nombre propio", t, "nombre propio"),
            F.when(age.isNotNull(), _result(age_label, F.concat(F.lit("edad: "), age.cast("string"), F.lit("+")), "publico.edad")),
            of("palabra +18", t),
            F.when((party | late | night_source) & ~t.rlike(v.READING_CLUB), of("recinto nocturno", _norm(place), "recinto nocturno")),
            F.when(party & (late | night_source), _result("adultos", "fiesta nocturna", "publico.fiesta_nocturna")),
            of("palabra infantil", t), of("palabra juvenil", t), _result("todos", "sin senal", "publico.defecto"))
    return let(_norm(title, description), layers)


def is_workshop(title: Column, category: Column, source: Column, weekdays: Column, rules: tuple[Rule, ...] | None = None) -> Column:
    """Something taken every week rather than attended once; ``struct(label, reason, rule)`` with a boolean label."""
    of = lambda name, text: _by_rule(text, layer(rules, "taller", name), name)
    ttl, sport = _norm(title), category == "deporte"
    found = F.coalesce(
        of("evento puntual", ttl), F.when(F.coalesce(F.size(weekdays), F.lit(0)) > 0, _result("si", "serie semanal", "taller.serie_semanal")),
        F.when(category.isin("clases", "idiomas"), _result("si", "categoria de clases", "taller.categoria_de_clases")),
        F.when(sport, F.coalesce(of("fuente de talleres", _norm(source)), of("deporte que se ensena", ttl))),
        _result("no", "", "taller.defecto"))
    return let(found, lambda r: F.struct((r["label"] == "si").alias("label"), r["reason"].alias("reason"), r["rule"].alias("rule")))


def _any_word(words) -> str:
    return "(?iu)" + "|".join(rf"\b{w}\b" for w in words)


ADULT_SIGNAL = _any_word(d.ADULT_SIGNAL_WORDS)
SPORT_SIGNAL = _any_word(d.SPORT_SIGNAL_WORDS)


def kid_adult_flags(title: Column, description: Column, audience: Column) -> Column:
    """``struct(for_kids, adult)``; an adult signal vetoes the children's one."""
    def read(t: Column) -> Column:
        return let(t.rlike(ADULT_SIGNAL), lambda grown: F.struct(
            F.coalesce(~grown & ((audience == "ninos") | t.rlike(d.CHILD_SIGNAL)), F.lit(False)).alias("for_kids"),
            F.coalesce(grown | (audience == "adultos"), F.lit(False)).alias("adult")))
    return let(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(description, F.lit(""))), read)


def drop_reason(title: Column, description: Column) -> Column:
    """Why a row is not an event (test entry or administrative notice), or NULL."""
    test = F.regexp_extract(F.coalesce(title, F.lit("")), v.TEST_TITLE, 0)
    body = F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(description, F.lit(""))))
    phrases = str_array(v.ADMIN_PHRASES)
    return F.when(test != "", F.concat(F.lit("evento de prueba: "), test)).otherwise(
        let(body, lambda b: F.get(F.filter(phrases, lambda p: F.contains(b, p)), F.lit(0))))
