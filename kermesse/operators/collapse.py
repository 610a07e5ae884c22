"""Collapsing repeated sessions: seasons, weekly series, shared pins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kermesse.functions import text
from kermesse.operators.skew import lookup
from kermesse.vocab.calendar import MAX_SEASON_GAP_DAYS
from kermesse.vocab.discovery import DAY_PATTERN


def series_key():
    """Identity of a series: title and place without the day."""
    place = F.when(F.coalesce(F.col("lugar_nombre"), F.lit("")) != "", F.col("lugar_nombre")
                   ).otherwise(F.col("comuna"))
    return text.event_key(F.col("titulo"), None, place)


def event_hash():
    """Identity of a candidate row: title, day and place (area when the place is blank)."""
    place = F.when(F.coalesce(F.col("lugar_nombre"), F.lit("")) != "", F.col("lugar_nombre")
                   ).otherwise(F.col("comuna"))
    return text.event_key(F.col("titulo"), F.col("inicio"), place)


def gap_islands(days: DataFrame, keys: list[str], day: str, gap: int, name: str = "bloque") -> DataFrame:
    """Number the runs of days whose gap is at most ``gap``.

    ``days`` must hold one row per key and day, so a key never exceeds the calendar.
    """
    w = Window.partitionBy(*keys).orderBy(day)
    opens = F.when(F.datediff(F.col(day), F.lag(day).over(w)) > gap, 1).otherwise(0)
    return (days.withColumn("_opens", opens)
            .withColumn(name, F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .drop("_opens"))


def season_parts(cols: list[str]) -> dict[str, Column]:
    """The season of one dated row (``cols``, among them ``inicio`` and ``seq``), in parts that ``MERGE`` puts together."""
    at = [F.col("inicio").alias("t"), F.col("seq").alias("s")]
    filled = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    day = F.unix_date(F.col("inicio").cast("date")).cast("bigint")
    return {
        "desde": day, "hasta": day, "n": F.lit(1).cast("bigint"),
        "midnight": (F.hour("inicio") == 0) & (F.minute("inicio") == 0),
        "first": F.struct(*at, F.struct(*cols).alias("row")),
        "last": F.struct(*at, F.coalesce("fin", "inicio").alias("end")),
        "max_end": F.coalesce("fin", "inicio"),
        "ptext": F.when(filled("precio_texto"), F.struct(*at, F.col("precio_texto").alias("v"))),
        "price": F.when(F.col("precio_clp").isNotNull(), F.struct(*at, F.col("precio_clp").alias("p"), F.col("es_gratis").alias("g"))),
        "image": F.when(filled("imagen_url"), F.struct(*at, F.col("imagen_url").alias("v"))),
    }


#: How parts of the same season merge, in any order.
MERGE = {"desde": F.min, "hasta": F.max, "n": F.sum, "midnight": F.bool_and, "first": F.min, "last": F.max, "max_end": F.max,
         "ptext": F.min, "price": F.min, "image": F.min}


def partial_seasons(dated: DataFrame, gap: int = MAX_SEASON_GAP_DAYS) -> DataFrame:
    """``_serie`` and the merged parts of each season of these dated rows.

    Rows are first folded to one row per series and day (map-side combined), so only the
    calendar days of a series meet in the gap window.
    """
    parts = season_parts(dated.columns)
    daily = (dated.withColumn("_serie", series_key()).groupBy("_serie", F.col("inicio").cast("date").alias("_dia"))
             .agg(*[merge(parts[c]).alias(c) for c, merge in MERGE.items()]))
    return (gap_islands(daily, ["_serie"], "_dia", gap).groupBy("_serie", "bloque")
            .agg(*[merge(c).alias(c) for c, merge in MERGE.items()]).drop("bloque"))


def collapse_multiday(events: DataFrame, gap: int = MAX_SEASON_GAP_DAYS, end_rule: str = "last") -> DataFrame:
    """One row per season of the same title and place; undated rows pass through.

    ``end_rule``: the end of the last-starting row (``last``) or the latest end (``max``).
    """
    blocks = partial_seasons(events.filter(F.col("inicio").isNotNull()), gap)
    return season_rows(blocks, events.columns, end_rule).unionByName(events.filter(F.col("inicio").isNull()))


def season_rows(seasons: DataFrame, cols: list[str], end_rule: str = "last") -> DataFrame:
    """The row that stands for each season, from its merged parts (``first``, ``last``, ``n``, ...)."""
    row = lambda c: F.col(f"first.row.{c}")
    many = F.col("n") > 1
    end = F.col("last.end") if end_rule == "last" else F.col("max_end")
    no_price = row("precio_clp").isNull() & F.col("price").isNotNull()
    changed = {
        "fin": F.when(many, end).otherwise(row("fin")),
        "todo_el_dia": F.when(many & F.col("midnight"), F.lit(True)).otherwise(row("todo_el_dia")),
        "precio_texto": F.coalesce(F.col("ptext.v"), row("precio_texto")),
        "precio_clp": F.when(no_price, F.col("price.p")).otherwise(row("precio_clp")),
        "es_gratis": F.when(no_price, F.col("price.g")).otherwise(row("es_gratis")),
        "imagen_url": F.coalesce(F.col("image.v"), row("imagen_url")),
    }
    return seasons.select(*[changed.get(c, row(c)).alias(c) for c in cols])


def first_filled(events: DataFrame, keys: list[str], order: list, column: str) -> DataFrame:
    """First non-blank value of a column per key, in order; an aggregate, not a wide window."""
    value = F.when(F.coalesce(F.col(column).cast("string"), F.lit("")) != "",
                   F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.col(column).alias("v")))
    return events.groupBy(*keys).agg(F.min(value)["v"].alias(column))


def collapse_weekly_series(published: DataFrame, minimum: int = 3) -> DataFrame:
    """Three or more same-hour sessions without an end become one card with its weekdays.

    Adds ``dias_semana`` and ``sesiones``. Groups with any declared end stay untouched.
    """
    keys = ["_t", "_l", "_h"]
    rows = published.withColumns({
        "_t": F.lower(F.trim(text.clean_title_schedule(F.col("titulo")))),
        "_l": F.coalesce(F.col("lugar"), F.lit("")),
        "_h": F.coalesce(F.date_format("inicio", "HH:mm"), F.lit("")),
    })
    dated = rows.filter(F.col("inicio").isNotNull())
    groups = dated.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.max("inicio").alias("_last"),
        F.bool_or(F.col("fin").isNotNull()).alias("_ended"),
        F.array_sort(F.collect_set(F.weekday(F.col("inicio").cast("date")))).alias("_days"),
        F.min(F.struct("inicio", "seq"))["seq"].alias("_first"))
    marked = lookup(dated, groups, keys)
    series = (F.col("_n") >= minimum) & ~F.col("_ended")
    card = marked.filter(~series | (F.col("seq") == F.col("_first")))
    out = card.select(*[
        F.when(series, text.clean_title_schedule(F.col("titulo"))).otherwise(F.col("titulo")).alias(c)
        if c == "titulo" else
        F.when(series, F.col("_last")).otherwise(F.col("fin")).alias(c) if c == "fin" else F.col(c)
        for c in published.columns],
        F.when(series, F.col("_days")).alias("dias_semana"),
        F.when(series, F.col("_n")).cast("int").alias("sesiones"))
    undated = published.filter(F.col("inicio").isNull()).withColumns({
        "dias_semana": F.lit(None).cast("array<int>"), "sesiones": F.lit(None).cast("int")})
    return out.unionByName(undated)


def degrade_shared_pins(published: DataFrame) -> DataFrame:
    """Source pins shared by more than one place count as approximate."""
    pin = (F.col("precision") == "fuente") & F.col("lat").isNotNull()
    rows = published.withColumns({"_la": F.bround("lat", 4), "_lo": F.bround("lon", 4)})
    shared = (rows.filter(pin).groupBy("_la", "_lo")
              .agg(F.min("lugar").alias("a"), F.max("lugar").alias("b"))
              .filter(F.col("a") != F.col("b")).select("_la", "_lo", F.lit(True).alias("_shared")))
    out = lookup(rows, shared, ["_la", "_lo"])
    return out.withColumn("precision", F.when(pin & F.col("_shared"), F.lit("comuna"))
                          .otherwise(F.col("precision"))).select(*published.columns)


def mark_recurrent(published: DataFrame, more_than: int = 3) -> DataFrame:
    """Adds ``recurrente``: the base title repeats, or the title carries a day pattern."""
    rows = published.withColumn("_base", text.title_base(F.col("titulo")))
    counts = rows.groupBy("_base").agg((F.count(F.lit(1)) > more_than).alias("_many"))
    out = lookup(rows, counts, ["_base"])
    return out.withColumn("recurrente", F.coalesce(F.col("_many"), F.lit(False))
                          | F.coalesce(F.col("titulo"), F.lit("")).rlike(DAY_PATTERN)).drop("_base", "_many")
