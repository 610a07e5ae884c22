"""Conversations written as one marked-up text, and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The template: <|turn|>role<|text|>body<|end|>. A bar inside a text is preceded by a backslash, so no text holds "<|".
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Tokens an attachment stands for where its part names none.
EXPANDED = {"image": 576, "audio": 750, "document": 1024}
PART = "struct<kind:string,text:string,ref:string,tokens:int>"


def escaped(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))


def unescaped(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def text_parts(text: Column) -> Column:
    """A plain text as typed parts."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("tokens")))


def visit(parts: Column, on_text, on_attachment) -> Column:
    """What the visitor makes of each part, in order: `on_text(part, at)` or `on_attachment(part, at)`."""
    return F.transform(parts, lambda p, at: F.when(F.coalesce(p["kind"], F.lit("text")) == "text", on_text(p, at))
                       .otherwise(on_attachment(p, at)))


def placeholder(kind: Column, turn: Column, at: Column) -> Column:
    return F.concat(F.lit("<|"), F.regexp_replace(kind, "[^a-z]", ""), F.lit(":"), turn.cast("string"), F.lit("."),
                    at.cast("string"), F.lit("|>"))


def format_chat(turns: DataFrame, parts: str | None = None, trained_role: str = "assistant",
                expanded: dict[str, int] | None = None) -> DataFrame:
    """One row a conversation: `conv_id`, `formatted`, `loss_spans`, `attachments`, `n_tokens_expanded`.

    `turns` has `conv_id`, `turn`, `role` and `text`, or typed content in the array column named by `parts`
    (`kind`, `text`, `ref`, `tokens`). A visitor writes text parts escaped and every other part as an ordered
    placeholder `<|kind:turn.part|>`; `attachments` lists placeholder, kind, ref and the tokens it expands to, in
    order, and `n_tokens_expanded` sums words of text and those. `loss_spans` are the (start, chars) of the
    bodies of `trained_role` in `formatted`, in code points.

    Turns go by `turn`; ties by role and text; repeated rows are repeated turns. Null roles and texts are empty,
    an empty or null parts array is an empty body, turns of a null `conv_id` form one conversation, no rows give
    no rows. Other columns are ignored. The only shuffle is the one by conversation, whose text is the result.
    """
    sizes = EXPANDED | (expanded or {})
    own = F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>")) if parts else text_parts(F.col("text"))
    base = turns.select("conv_id", F.col("turn"), F.coalesce("role", F.lit("")).alias("_role"), own.alias("_parts"),
                        F.to_json(own).alias("_tie"))
    order = Window.partitionBy("conv_id").orderBy("turn", "_role", "_tie")
    at = base.withColumn("_n", F.row_number().over(order) - 1)
    pieces = visit(F.col("_parts"), lambda p, i: escaped(F.coalesce(p["text"], F.lit(""))),
                   lambda p, i: placeholder(p["kind"], F.col("_n"), i))
    files = F.filter(F.transform(F.col("_parts"), lambda p, i: F.struct(
        placeholder(p["kind"], F.col("_n"), i).alias("placeholder"), p["kind"].alias("kind"), p["ref"].alias("ref"),
        F.coalesce(p["tokens"], _default_tokens(p["kind"], sizes)).alias("tokens"))),
        lambda a: F.coalesce(a["kind"], F.lit("text")) != "text")
    count = F.aggregate(visit(F.col("_parts"), lambda p, i: F.size(F.filter(F.split(F.coalesce(p["text"], F.lit("")), "\\s+"),
                                                                            lambda w: w != "")),
                              lambda p, i: F.coalesce(p["tokens"], _default_tokens(p["kind"], sizes))),
                        F.lit(0).cast("long"), lambda a, b: a + b)
    told = at.select("conv_id", "_n", "turn", "_role", F.array_join(pieces, "").alias("_body"), files.alias("_files"),
                     count.alias("_tokens"))
    head = F.concat(F.lit(TURN), escaped(F.col("_role")), F.lit(TEXT))
    told = told.withColumns({"_head": head, "_said": F.concat(head, F.col("_body"), F.lit(END))})
    before = Window.partitionBy("conv_id").orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)
    told = told.withColumn("_start", F.coalesce(F.sum(F.length("_said").cast("long")).over(before), F.lit(0))
                           + F.length("_head"))
    span = F.when(F.col("_role") == trained_role, F.struct(F.col("_start").alias("start"),
                                                           F.length("_body").cast("long").alias("chars")))
    rows = F.array_sort(F.collect_list(F.struct("_n", "_said", span.alias("_span"), "_files", "_tokens")))
    return told.groupBy("conv_id").agg(rows.alias("_rows")).select(
        "conv_id", F.array_join(F.col("_rows._said"), "").alias("formatted"),
        F.filter(F.col("_rows._span"), lambda s: s.isNotNull()).alias("loss_spans"),
        F.flatten(F.col("_rows._files")).alias("attachments"),
        F.aggregate(F.col("_rows._tokens"), F.lit(0).cast("long"), lambda a, b: a + b).alias("n_tokens_expanded"))


def _default_tokens(kind: Column, sizes: dict[str, int]) -> Column:
    out = F.lit(0)
    for name, tokens in sizes.items():
        out = F.when(kind == name, tokens).otherwise(out)
    return out


def read_chat(formatted: Column) -> Column:
    """The turns of a formatted text: array of (role, text); placeholders are left out of the text."""
    marked = F.slice(F.split(formatted, r"<\|turn\|>"), 2, 1_000_000_000)
    halves = F.transform(marked, lambda t: F.split(F.substring_index(t, END, 1), r"<\|text\|>", 2))
    return F.transform(halves, lambda h: F.struct(
        unescaped(h[0]).alias("role"), unescaped(F.regexp_replace(h[1], r"<\|[a-z]*:\d+\.\d+\|>", "")).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substr(formatted, (s["start"] + 1).cast("int"),
                                                                       s["chars"].cast("int")))), "")
