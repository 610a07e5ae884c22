"""The daily events run and the question it serves: what is on, and where."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kermesse.operators.collapse import collapse_multiday
from kermesse.operators.filters import gate, in_date_window, is_current
from kermesse.operators.skew import lookup_settings
from kermesse.operators.review import source_run_counts
from kermesse.operators.store import expire_past, reconcile_dated, revive_current, upsert_events
from kermesse.schemas import STORE, names
from kermesse.session import stage


def daily_run(store: DataFrame, candidates: DataFrame, config: DataFrame, as_of: Column, now: Column,
              materialise: bool = True) -> dict[str, DataFrame]:
    """Collapse, gate, upsert, revive, expire.

    ``config``: fuente_nombre, colapsar, requiere_comuna, filtro_palabras, descartar_palabras.
    Returns the new snapshot, the rejected rows and the run counts. ``materialise`` writes
    the two steps all of them read; leave it off when only one of them is wanted.
    """
    config = stage(config)
    flagged = lookup_settings(candidates, config.select("fuente_nombre", F.coalesce("colapsar", F.lit(True)).alias("_junta")),
                              ["fuente_nombre"])
    joins = F.coalesce("_junta", F.lit(True))
    kept_apart = flagged.filter(~joins).drop("_junta")
    collapsed = collapse_multiday(flagged.filter(joins).drop("_junta"))
    keep = stage if materialise else (lambda df: df)
    gated = keep(gate(collapsed.unionByName(kept_apart), config, as_of))
    accepted = gated.filter("motivo is null").drop("motivo")
    snapshot = keep(upsert_events(store, accepted, now))
    revived = expire_past(revive_current(reconcile_dated(snapshot), as_of), as_of)
    outcome = snapshot.filter("resultado is not null").select("fuente_nombre", "resultado", F.lit(None).cast("string").alias("motivo"))
    rejected = gated.filter("motivo is not null")
    counts = source_run_counts(outcome.unionByName(rejected.select(
        "fuente_nombre", F.lit(None).cast("string").alias("resultado"), "motivo")))
    return {"store": revived, "rejected": rejected, "counts": counts}


def whats_on(store: DataFrame, window: str, as_of: Column) -> DataFrame:
    """Current rows whose point or season touches the window, in agenda order."""
    none = F.array().cast("array<int>")
    return (store.filter(is_current(F.col("inicio"), F.col("fin"), as_of)
                         & in_date_window(window, F.col("inicio"), F.col("fin"), none, as_of))
            .select(*[c for c in names(STORE) if c in store.columns])
            .orderBy(F.col("inicio").asc_nulls_last(), "hash_dedup"))
