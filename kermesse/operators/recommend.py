"""Ranking of events for profiles: hard discards, additive score, greedy diversity."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kermesse.functions import labels
from kermesse.functions.cards import has_hour
from kermesse.functions.places import sector_of
from kermesse.functions.text import title_base
from kermesse.operators.collapse import mark_recurrent
from kermesse.operators.columns import compute_once
from kermesse.operators.skew import lookup, top_k
from kermesse.session import stage
from kermesse.vocab import discovery as v


@dataclass(frozen=True)
class Profile:
    """One person's question: who goes, which situation, which follow-up answer, limits."""

    name: str
    company: str
    situation: str
    answer: str = ""
    free_only: bool = False
    budget: int | None = None
    sector: str = "todo"


#: The questions that profiles ask, one row each.
QUESTION = "perfil string, compania string, situacion string, respuesta string, solo_gratis boolean, tope int, sector string"
#: What a company, a situation and an answer add up to.
RULES = ("compania string, situacion string, respuesta string, pesos map<string, double>, base double, variedad boolean, exige_ninos boolean, "
         "evita_ninos boolean, solo_adultos boolean, evita array<string>, categoria_segura string, sin_charlas boolean, sin_recurrentes boolean, "
         "puntos_recurrente double, puntos_gratis double, techo int, senal string, puntos_senal double, puntos_ninos double, desde int, hasta int")


def _rule(company: str, situation: str, answer: str) -> tuple:
    """Category weights and points of one combination. A company only moves categories the situation knows."""
    sit, comp = v.SITUATIONS[situation], v.COMPANIES.get(company, {})
    ans = sit.get("answers", {}).get(answer, {})
    base, weights = sit.get("base"), dict(sit["weights"])
    for table, opens in ((comp.get("weights", {}), False), (ans.get("weights", {}), True)):
        for cat, w in table.items():
            if cat in weights or opens or base is not None:
                weights[cat] = weights.get(cat, base or 0) + w
    lo, hi = ans.get("hours") or comp.get("hours") or sit.get("hours") or (None, None)
    number = lambda x: None if x is None else float(x)
    return (company, situation, answer, {k: float(w) for k, w in weights.items()}, number(base), bool(sit.get("variety")),
            bool(comp.get("require_kids")), bool(comp.get("avoid_kids")), bool(sit.get("adults_only")), list(sit.get("avoid", ())),
            sit["safe_category"] if sit.get("sport_signal") else None, bool(sit.get("no_talks")),
            bool(sit.get("one_off")) and not ans.get("recurrent", 0) > 0,
            float(ans.get("recurrent", comp.get("recurrent", -9 if sit.get("one_off") else -2))), float(sit.get("free_bonus", 2)),
            comp.get("price_ceiling"), comp.get("signal"), number(comp.get("signal_bonus")),
            0.0 if company in ("ninos", "solo") else -3.0, lo, hi)


def profile_table(questions: DataFrame) -> DataFrame:
    """``questions`` (see QUESTION) with the weights and points that answer them.

    The combinations of company, situation and answer are a fixed table; an unknown company or answer adds nothing, a
    question about an unknown situation has no row.
    """
    companies, rules = [*v.COMPANIES, ""], []
    for name, sit in v.SITUATIONS.items():
        rules += [_rule(c, name, a) for c in companies for a in (*sit.get("answers", {}), "")]
    known = F.map_from_arrays(F.array(*map(F.lit, v.SITUATIONS)), F.array(*[
        F.array(F.lit(""), *map(F.lit, s.get("answers", {}))) for s in v.SITUATIONS.values()]))
    table = questions.sparkSession.createDataFrame(rules, RULES)
    own = lambda c, choices: F.when(choices, F.col(c)).otherwise("")
    return (questions.withColumns({
        "_c": own("compania", F.col("compania").isin(*v.COMPANIES)),
        "_r": own("respuesta", F.coalesce(F.array_contains(F.try_element_at(known, F.col("situacion")), F.col("respuesta")), F.lit(False)))})
        # A company without rules still counts as company of some kind: only children and nobody leave the points of children alone.
        .join(table.withColumnsRenamed({"compania": "_c", "respuesta": "_r"}), ["_c", "situacion", "_r"]).drop("_c", "_r"))


def profiles_of(spark: SparkSession, profiles: list[Profile]) -> DataFrame:
    rows = [(p.name, p.company, p.situation, p.answer, p.free_only, p.budget or None, p.sector) for p in profiles]
    return profile_table(spark.createDataFrame(rows, QUESTION))


def prepare(published: DataFrame) -> DataFrame:
    """Adds recurrente, para_ninos, adulto and the base title."""
    flags = labels.kid_adult_flags(F.col("titulo"), F.col("descripcion"), F.col("publico"))
    # Each search runs once a row, however many discards and points ask for its outcome.
    rows = mark_recurrent(published)
    read = compute_once(rows, recurrente=F.col("recurrente"), _f=flags, titulo_base=title_base(F.col("titulo")))
    return read.select(*rows.columns, F.col("_f.for_kids").alias("para_ninos"), F.col("_f.adult").alias("adulto"), "titulo_base")


def _signs(prepared: DataFrame) -> DataFrame:
    """What any profile may ask of a row's text and place, read once a row."""
    text = F.concat_ws(" ", F.coalesce("titulo", F.lit("")), F.coalesce("descripcion", F.lit("")))
    return compute_once(prepared, _s=F.struct(
        text.rlike(labels.SPORT_SIGNAL).alias("sport"), text.rlike(v.COUPLE_SIGNAL).alias("couple"), text.rlike(v.GROUP_SIGNAL).alias("group"),
        F.coalesce("titulo", F.lit("")).rlike(v.TALK_FORMAT).alias("talk"), sector_of(F.col("comuna")).alias("sector"),
        F.coalesce("gratis", F.lit(False)).alias("free")))


#: The key of profiles that take categories they do not name.
OTHERS = "*"


def matched(prepared: DataFrame, profiles: DataFrame) -> DataFrame:
    """Rows beside the profiles that may take them, with ``_p`` (the profile) and ``_w`` (its weight for the category).

    An inverted index leads from a category to the profiles that weigh it above zero; profiles with a base weight are
    also found under one key for the categories they do not name. A row meets those of its category and of that key.
    """
    named = profiles.select(F.struct(*profiles.columns).alias("_p"), F.explode("pesos").alias("_k", "_w")).filter("_w > 0")
    rest = profiles.filter("base > 0").select(F.struct(*profiles.columns).alias("_p"), F.lit(OTHERS).alias("_k"), F.col("base").alias("_w"))
    rows = _signs(prepared).withColumn("_k", F.explode(F.array(F.concat(F.lit("="), F.coalesce("categoria", F.lit(""))), F.lit(OTHERS))))
    index = named.withColumn("_k", F.concat(F.lit("="), "_k")).unionByName(rest)
    listed = F.coalesce(F.map_contains_key("_p.pesos", F.coalesce("categoria", F.lit(""))), F.lit(False))
    return rows.join(index, "_k").filter((F.col("_k") != OTHERS) | ~listed)


def eligible() -> Column:
    """Hard discards of a row's profile."""
    p, s = (lambda c: F.col(f"_p.{c}")), (lambda c: F.col(f"_s.{c}"))
    kids = F.col("para_ninos")
    return ((~p("exige_ninos") | kids) & (~p("evita_ninos") | ~kids | F.col("adulto")) & (~p("solo_adultos") | ~kids)
            & (~p("solo_gratis") | s("free")) & (p("tope").isNull() | s("free") | F.coalesce(F.col("precio") <= p("tope"), F.lit(True)))
            & ~F.coalesce(F.array_contains(p("evita"), F.col("categoria")), F.lit(False))
            & ((p("sector") == "todo") | F.coalesce(p("sector") == s("sector"), F.lit(False)))
            & (p("categoria_segura").isNull() | F.coalesce(F.col("categoria") == p("categoria_segura"), F.lit(False)) | s("sport"))
            & (~p("sin_charlas") | ~s("talk")) & (~p("sin_recurrentes") | ~F.col("recurrente")))


def score(now: Column) -> Column:
    """Additive score of an eligible row for its profile."""
    p, s = (lambda c: F.col(f"_p.{c}")), (lambda c: F.col(f"_s.{c}"))
    add = lambda cond, points: F.when(F.coalesce(cond, F.lit(False)), points).otherwise(0.0)
    hour, lo, hi = F.hour("inicio"), p("desde"), p("hasta")
    inside = F.when(lo <= hi, (hour >= lo) & (hour <= hi)).otherwise((hour >= lo) | (hour <= hi))
    signal = F.when(p("senal") == "couple", s("couple")).when(p("senal") == "group", s("group"))
    days = (F.unix_micros(F.col("inicio").cast("timestamp")) - F.unix_micros(now.cast("timestamp"))) / F.lit(86400e6)
    return (F.col("_w") + add(F.col("recurrente"), p("puntos_recurrente")) + add(F.col("gratis"), p("puntos_gratis"))
            + add(F.col("precio") > p("techo"), F.lit(-6.0)) + add(signal, p("puntos_senal")) + add(F.col("para_ninos"), p("puntos_ninos"))
            + add(lo.isNotNull() & has_hour(F.col("inicio")), F.when(inside, 3.0).otherwise(-2.0))
            + add(F.coalesce("imagen", F.lit("")) != "", F.lit(2.0)) + add(F.length(F.coalesce("descripcion", F.lit(""))) > 60, F.lit(1.0))
            + F.when(F.col("precision") == "sin_ubicar", -2.0).when(F.col("precision") == "recinto", 1.0).otherwise(0.0)
            + F.greatest(F.lit(0.0), F.lit(3.0) - days * F.lit(0.12)))


def score_pairs(prepared: DataFrame, profiles: DataFrame, now: Column) -> DataFrame:
    """(perfil, puntaje, variedad, ...) for eligible pairs of a row and a profile with a positive score."""
    pairs = matched(prepared, profiles).filter(eligible()).withColumn("puntaje", score(now)).filter("puntaje > 0")
    return pairs.select("_p.perfil", "puntaje", "_p.variedad", *prepared.columns)


def eligible_pairs(prepared: DataFrame, profiles: DataFrame) -> DataFrame:
    return matched(prepared, profiles).filter(eligible()).select("_p.perfil", *prepared.columns)


def situations_for_company(company: str) -> list[str]:
    banned = v.SITUATION_VETOES.get(company, ())
    return [s for s in v.SITUATIONS if s not in banned]


def allowed_pairs(pairs: DataFrame) -> DataFrame:
    """Company and situation pairs without the vetoed ones."""
    vetoed = F.lit(False)
    for company, banned in v.SITUATION_VETOES.items():
        vetoed = vetoed | ((F.col("compania") == company) & F.col("situacion").isin(*banned))
    return pairs.filter(~vetoed)


def rank_diverse(scored: DataFrame) -> DataFrame:
    """Adds ``elegido``: kept by the greedy pass that demotes a repeated source, title or category.

    A row is kept when no better *kept* row of its profile shares one of its keys. Rows with
    the same keys share their fate with the best of them, so only the distinct key sets take
    part. Each round keeps every set that is the best open one under all its keys and drops
    the open sets that meet a kept one under some key; rounds go on until none is open, which
    gives exactly the sequential result. Order the output by
    ``perfil, elegido desc, puntaje desc, seq``.
    """
    scored = stage(scored)
    source = F.coalesce(*[F.when(F.coalesce(c, F.lit("")) != "", F.col(c).cast("string"))
                          for c in ("fuente", "lugar")], F.col("id").cast("string"))
    label = lambda tag, c: F.concat(F.lit(tag), c)
    keys = F.array_compact(F.array(
        label("s:", source), label("t:", F.coalesce("titulo_base", F.lit(""))),
        F.when(F.col("variedad"), label("c:", F.coalesce("categoria", F.lit(""))))))
    rank = F.struct((-F.col("puntaje")).alias("p"), F.col("seq"))
    state = stage(scored.groupBy("perfil", keys.alias("keys")).agg(F.min(rank).alias("r")))
    chosen = None
    while not state.isEmpty():
        open_keys = state.select("perfil", "r", F.explode("keys").alias("key"))
        leads = open_keys.groupBy("perfil", "key").agg(F.min("r").alias("lead"))
        met = stage(lookup(open_keys, leads, ["perfil", "key"]))
        kept = met.groupBy("perfil", "r").agg(F.bool_and(F.col("r") == F.col("lead")).alias("k")
                                              ).filter("k").select("perfil", "r")
        chosen = kept if chosen is None else chosen.unionByName(kept)
        beaten = kept.select("perfil", F.col("r").alias("lead"), F.lit(True).alias("_beaten"))
        state = stage(lookup(met, beaten, ["perfil", "lead"]).groupBy("perfil", "r").agg(
            F.collect_set("key").alias("keys"), F.bool_or(F.col("_beaten").isNotNull()).alias("gone")
        ).filter("not gone").select("perfil", "keys", "r"))
    if chosen is None:
        return scored.withColumn("elegido", F.lit(False))
    winners = chosen.select("perfil", F.col("r.seq").alias("seq"), F.lit(True).alias("_win"))
    return scored.join(winners, ["perfil", "seq"], "left").withColumn(
        "elegido", F.coalesce("_win", F.lit(False))).drop("_win")


def diverse_order() -> list[Column]:
    return [F.col("elegido").desc(), F.col("puntaje").desc(), F.col("seq").asc()]


def profile_report(ranked: DataFrame, profiles: list[Profile], forbidden: dict[str, dict[str, Column]],
                   k: int = 5) -> DataFrame:
    """Violations of each profile's forbidden predicates within its first ``k`` rows."""
    top = top_k(ranked, ["perfil"], diverse_order(), k)
    breaches = F.array_compact(F.array(*[
        F.when((F.col("perfil") == name) & F.coalesce(cond, F.lit(False)), F.lit(why))
        for name, rules in forbidden.items() for why, cond in rules.items()]))
    counted = top.groupBy("perfil").agg(F.count(F.lit(1)).alias("vistos"),
                                        F.sum(F.size(breaches)).alias("alarmas"))
    # The profile list is a plan-time parameter, so absent profiles still show up as empty.
    everyone = ranked.sparkSession.createDataFrame([(p.name,) for p in profiles], "perfil string")
    return everyone.join(counted, "perfil", "left").select(
        "perfil", F.coalesce("vistos", F.lit(0)).alias("vistos"), F.coalesce("alarmas", F.lit(0)).alias("alarmas"),
        F.col("vistos").isNull().alias("vacio"))
