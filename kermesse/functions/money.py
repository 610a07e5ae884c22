"""Prices in Chilean pesos and offer amounts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from kermesse.functions.text import WORD_END, WORD_START, fold_text, let, squeeze
from kermesse.vocab.labels import FREE_WORDS, MAX_PRICE_CLP

# The two price formats.
WITH_SIGN = r"\$\s*(\d{1,3}(?:[.\s]\d{3})+|\d{3,6})"
WITH_UNIT = r"\b(\d{1,3}(?:[.\s]\d{3})+|\d{4,6})\s*(?:pesos|clp)\b"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"[.\s]", "").try_cast("long")


def parse_price_clp(text: Column, word_bounds: bool = True) -> Column:
    """``struct(price INT, free BOOLEAN, note STRING)``; all unknown when nothing is said.

    A free word wins over an amount. ``word_bounds=False`` keeps plain containment, which
    reads "freestyle" as free.
    """
    def note_at(pos: Column) -> Column:
        return squeeze(F.substring(text, F.greatest(pos - 20, F.lit(1)), F.lit(60)))

    def free_word(word: str) -> str:
        esc = re.escape(word).replace(r"\ ", " ")
        return f"{WORD_START}{esc}{WORD_END}" if word_bounds else esc

    def read(s: Column) -> Column:
        free = F.lit(None).cast("int")
        for word in reversed(FREE_WORDS):
            pat = free_word(word)
            # Plain containment is far cheaper than a search and rules most texts out.
            free = F.when(F.contains(s, F.lit(word)) & s.rlike(pat), F.regexp_instr(s, F.lit(pat))).otherwise(free)
        signed = F.when(F.contains(s, F.lit("$")), F.regexp_extract(s, WITH_SIGN, 1)).otherwise("")
        unit = F.when(F.contains(s, F.lit("pesos")) | F.contains(s, F.lit("clp")), F.regexp_extract(s, WITH_UNIT, 1)).otherwise("")

        def out(price: Column, is_free: Column, note: Column) -> Column:
            return F.struct(price.cast("int").alias("price"), is_free.alias("free"),
                            note.alias("note"))

        unknown = out(F.lit(None), F.lit(None).cast("boolean"), F.lit(""))

        def priced(amount: Column, pattern: str) -> Column:
            return let(amount, lambda a: F.when((a > 0) & (a <= MAX_PRICE_CLP), out(
                a, F.lit(False), note_at(F.regexp_instr(s, F.lit(pattern))))).otherwise(unknown))

        paid = let(signed, lambda g: F.when(g != "", priced(_digits(g), WITH_SIGN)).otherwise(
            priced(_digits(unit), WITH_UNIT)))
        return let(free, lambda f: F.when(
            f.isNotNull(), out(F.lit(0), F.lit(True), note_at(f))).otherwise(paid))

    return let(fold_text(text), read)


def pesos(amount: Column) -> Column:
    """``$12.345``."""
    return F.concat(F.lit("$"), F.translate(F.format_number(amount, 0), ",", "."))


def joined(*texts: Column) -> Column:
    """Folded texts joined by a middle dot, blanks left out."""
    return fold_text(F.concat_ws(" · ", *[F.when(t != "", t) for t in texts]))


def percent_in(*texts: Column) -> Column:
    """Largest announced percentage from 5 to 90, or NULL."""
    found = F.regexp_extract_all(joined(*texts), F.lit(r"(\d{1,2})\s*(?:%|dcto|dto\b)"), 1)
    return F.array_max(F.filter(F.transform(found, lambda n: n.cast("int")),
                                lambda n: n.between(5, 90)))


def cap_amount(*texts: Column) -> Column:
    """Ceiling of a discount in pesos, or NULL."""
    raw = F.regexp_extract(joined(*texts), r"tope[^$]{0,60}\$\s*([\d.]{3,12})", 1)
    return F.replace(raw, F.lit("."), F.lit("")).try_cast("int")
