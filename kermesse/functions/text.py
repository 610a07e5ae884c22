"""Text expressions: folding, cleaning, keys, word tests. Column in, Column out."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable, Iterable
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from kermesse.session import ship_package
from kermesse.vocab.labels import MACHINE_URL

WORD_START = "(?<![a-z0-9])"
WORD_END = "(?![a-z0-9])"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def str_array(values: Iterable[str]) -> Column:
    """A literal array of strings, as one expression."""
    return F.expr("array(" + ", ".join(sql_text(v) for v in values) + ")")


def str_map(pairs: dict) -> Column:
    """A literal map from strings to strings or whole numbers, as one expression."""
    lit = lambda x: sql_text(x) if isinstance(x, str) else str(x)
    return F.expr("map(" + ", ".join(f"{lit(k)}, {lit(v)}" for k, v in pairs.items()) + ")")


@lru_cache(maxsize=1)
def _fold_map() -> tuple[str, str]:
    """Accented lower-case letters and their base letter; combining marks map to nothing."""
    src, dst = [], []
    for code in [*range(0x00E0, 0x0250), *range(0x1E00, 0x1F00)]:
        ch = chr(code)
        base = unicodedata.normalize("NFD", ch)
        if len(base) > 1 and ch == ch.lower() and base[0].isascii():
            src.append(ch)
            dst.append(base[0])
    marks = [chr(c) for c in range(0x0300, 0x0370) if unicodedata.category(chr(c)) == "Mn"]
    return "".join(src) + "".join(marks), "".join(dst)


def fold_py(text: str) -> str:
    """Plan-time twin of :func:`fold_text` for literals."""
    flat = unicodedata.normalize("NFD", text or "")
    return "".join(c for c in flat if unicodedata.category(c) != "Mn").lower()


def fold_text(col: Column, ws: str = "keep") -> Column:
    """Lower case without accents. ``ws``: ``keep``, ``trim``, ``collapse`` or ``squeeze``.

    ``collapse`` turns each run of spaces into one; ``squeeze`` also trims the ends.
    """
    src, dst = _fold_map()
    out = F.translate(F.lower(F.coalesce(col, F.lit(""))), src, dst)
    if ws == "trim":
        return F.trim(out)
    if ws == "collapse":
        return F.regexp_replace(out, r"\s+", " ")
    if ws == "squeeze":
        return F.trim(F.regexp_replace(out, r"\s+", " "))
    return out


def squeeze(col: Column) -> Column:
    """One space between words, none at the ends."""
    return F.trim(F.regexp_replace(col, r"[\s\u00a0]+", " "))


def key_part(col: Column, length: int | None = None) -> Column:
    """Folded text with only letters, digits and single spaces, cut to ``length``."""
    out = squeeze(F.regexp_replace(fold_text(col), "[^a-z0-9 ]", " "))
    return F.substring(out, 1, length) if length else out


def event_key(title: Column, start: Column | None, place: Column) -> Column:
    """16-hex identity of an event; ``start=None`` gives the series identity."""
    day = F.lit("") if start is None else F.coalesce(F.date_format(start, "yyyy-MM-dd"), F.lit(""))
    return F.substring(
        F.sha1(F.concat_ws("|", key_part(title, 60), day, key_part(place, 40))), 1, 16)


def offer_key(bank_id: Column, merchant: Column, area: Column,
              address: Column | None = None) -> Column:
    """12-hex identity of an offer; pass ``address`` to keep branches of one area apart."""
    parts = [bank_id, F.lower(F.trim(F.coalesce(merchant, F.lit("")))),
             F.lower(F.coalesce(area, F.lit("")))]
    if address is not None:
        parts.append(F.lower(F.trim(F.coalesce(address, F.lit("")))))
    return F.substring(F.sha1(F.concat_ws("|", *parts)), 1, 12)


# Entities handled without leaving the JVM.
ENTITIES = {"&nbsp;": " ", "&#038;": "&", "&#38;": "&", "&#039;": "'", "&#39;": "'",
            "&apos;": "'", "&quot;": '"', "&#34;": '"', "&lt;": "<", "&gt;": ">",
            "&#8211;": "–", "&#8212;": "—", "&#8216;": "‘", "&#8217;": "’",
            "&#8220;": "“", "&#8221;": "”", "&#8230;": "…", "&hellip;": "…",
            "&ndash;": "–", "&mdash;": "—", "&iexcl;": "¡", "&iquest;": "¿",
            "&aacute;": "á", "&eacute;": "é", "&iacute;": "í", "&oacute;": "ó",
            "&uacute;": "ú", "&ntilde;": "ñ", "&Aacute;": "Á", "&Eacute;": "É",
            "&Iacute;": "Í", "&Oacute;": "Ó", "&Uacute;": "Ú", "&Ntilde;": "Ñ",
            "&uuml;": "ü", "&deg;": "°", "&middot;": "·", "&copy;": "©", "&ordm;": "º", "&ordf;": "ª"}


@F.pandas_udf(StringType())
def _unescape_all(texts):
    return texts.map(lambda t: html.unescape(t) if t is not None else None)


def _unescape_closed_py(text: str) -> str:
    return re.sub(r"&(?:#\d+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);", lambda m: html.unescape(m[0]) if m[0][1] == "#" or m[0][1:] in html5 else m[0], text)


@F.pandas_udf(StringType())
def _unescape_closed(texts):
    return texts.map(lambda t: _unescape_closed_py(t) if t is not None else None)


def unescape(col: Column, every_entity: bool = False, closed: bool = False) -> Column:
    """Decode character entities; ``every_entity`` uses an Arrow batch for rare ones, and reads the old names without their
    semicolon too unless ``closed``."""
    if every_entity:
        ship_package(SparkSession.active())
        decode = _unescape_closed if closed else _unescape_all
        return F.when(F.contains(col, F.lit("&")), decode(col)).otherwise(col)

    def decode_known(out: Column) -> Column:
        for entity, char in ENTITIES.items():
            out = F.replace(out, F.lit(entity), F.lit(char))
        return F.replace(out, F.lit("&amp;"), F.lit("&"))

    # Bound once: both the test and its outcome would work the text out again.
    return let(col, lambda c: F.when(F.contains(c, F.lit("&")), decode_known(c)).otherwise(c))


def strip_html(col: Column, every_entity: bool = False, closed: bool = False) -> Column:
    """Text without tags, layout shortcodes and entities, squeezed."""
    bare = F.regexp_replace(F.coalesce(col, F.lit("")), "<[^>]+>", " ")
    bare = F.regexp_replace(bare, r"\[/?[a-z][a-z0-9_]*(?=[\s\]/])[^\]]*\]", " ")
    return squeeze(unescape(bare, every_entity, closed))


def summarise(col: Column, length: int = 200, is_html: bool = True) -> Column:
    """Cut at the last space within ``length`` characters and add an ellipsis."""
    clean = strip_html(col) if is_html else col
    return let(clean, lambda c: F.when(F.length(c) <= length, c).otherwise(
        F.concat(F.regexp_replace(F.substring(c, 1, length), r" [^ ]*$", ""), F.lit("…"))))


def words_regex(words: Iterable[str]) -> str:
    """One alternation for whole words, folded and escaped."""
    body = "|".join(re.escape(fold_py(w)).replace(r"\ ", " ") for w in words)
    return f"{WORD_START}(?:{body}){WORD_END}"


def mentions_any(folded: Column, words: Iterable[str]) -> Column:
    """True when the folded text holds any of the words as a whole word."""
    return folded.rlike(words_regex(words))


def first_listed(folded: Column, words: Iterable[str]) -> Column:
    """The first word of the list, in list order, that the folded text holds."""
    words = tuple(words)
    listed = str_array(words)
    each = F.get(F.filter(listed, lambda w: F.rlike(folded, F.concat(
        F.lit(WORD_START + r"\Q"), w, F.lit(r"\E" + WORD_END)))), F.lit(0))
    return F.when(mentions_any(folded, words), each)


def mentioned_word(folded: Column, words: Column) -> Column:
    """Like :func:`first_listed` for a per-row array of words."""
    return F.get(F.filter(words, lambda w: F.rlike(folded, F.concat(
        F.lit(WORD_START + r"\Q"), fold_text(w), F.lit(r"\E" + WORD_END)))), F.lit(0))


def is_machine_url(url: Column) -> Column:
    return F.coalesce(url, F.lit("")).rlike(MACHINE_URL)


def is_public_url(url: Column) -> Column:
    """Only absolute http(s) addresses, control characters ignored."""
    bare = F.lower(F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20]", ""))
    return bare.rlike("^https?:")


def normalise_url(raw: Column) -> Column:
    """Add the scheme a source left out; blank when it is not an address."""
    clean = F.regexp_replace(F.trim(F.coalesce(raw, F.lit(""))), "^[\"']+|[\"']+$", "")
    return let(clean, lambda c: (
        F.when((c == "") | F.lower(c).isin("vacio", "n/a", "-"), F.lit(""))
        .when(c.startswith("http://") | c.startswith("https://"), c)
        .when(c.startswith("//"), F.concat(F.lit("https:"), c))
        .when(~F.contains(F.substring_index(c, "/", 1), F.lit(".")), F.lit(""))
        .otherwise(F.concat(F.lit("https://"), c))))


def absolute_url(href: Column, base: Column) -> Column:
    """Resolve ``//host`` and ``/path`` links against the base of the source."""
    root = F.regexp_replace(base, "/+$", "")
    return (F.when(href.startswith("//"), F.concat(F.lit("https:"), href))
            .when(href.startswith("/"), F.concat(root, href))
            .otherwise(href))


def url_host(url: Column) -> Column:
    """Lower-case host without ``www.``."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z]+://([^/?#]+)", 1))
    return F.regexp_replace(host, r"^www\.", "")


def html_escape(col: Column) -> Column:
    """Escape the five characters that matter inside markup."""
    out = F.replace(F.coalesce(col, F.lit("")), F.lit("&"), F.lit("&amp;"))
    for raw, safe in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def script_safe_json(col: Column) -> Column:
    """JSON text that cannot close the script element it is placed in."""
    out = col
    for raw, safe in (("<", "\\u003c"), (">", "\\u003e"), ("&", "\\u0026"),
                      ("\u2028", "\\u2028"), ("\u2029", "\\u2029")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


# Day codes followed by an hour, as municipal titles carry them.
_CODES = "lu|ma|mi|ju|vi|sa|do"
SCHEDULE_CODE = (rf"(?i)\s*[/·-]?\s*\b(?:{_CODES})\b(?:\s*[-y/]\s*\b(?:{_CODES})\b)*"
                 r"\.?\s*\d{1,2}[:.]\d{2}\s*(?:h|hrs?)?\.?")


def clean_title_schedule(title: Column) -> Column:
    """Title without its day-and-hour code; unchanged when too little would remain."""
    bare = squeeze(F.regexp_replace(title, SCHEDULE_CODE, " "))
    bare = F.regexp_replace(F.regexp_replace(bare, r"\s*[/·]\s*$", ""), r"^[ .\-/·]+|[ .\-/·]+$", "")
    return let(bare, lambda b: F.when(F.length(b) >= 3, b).otherwise(title))


def title_base(title: Column) -> Column:
    """Title without days, hours and dashes: what makes two sessions the same activity."""
    from kermesse.vocab.discovery import DAY_PATTERN
    out = squeeze(F.lower(F.coalesce(title, F.lit(""))))
    out = F.regexp_replace(out, f"^(.*?){DAY_PATTERN}".replace("(?i)", ""), "$1")
    out = F.regexp_replace(out, r"\d{1,2}[:.]\d{2}\s*(h|hrs?|horas?)?\.?", "")
    out = F.regexp_replace(out, r"[\s\-–—]+", " ")
    return F.regexp_replace(out, r"^[\s.\-]+|[\s.\-]+$", "")


def venue_from_title(title: Column, place: Column) -> Column:
    """The venue after the last `` / `` when the place field only names a programme."""
    from kermesse.vocab.places import PROGRAMME_NAMES
    tail = F.regexp_replace(F.trim(F.element_at(F.split(title, " / "), -1)), r"[. ]+$", "")
    usable = (fold_text(place, "trim").isin(*PROGRAMME_NAMES)
              & F.contains(title, F.lit(" / ")) & (F.length(tail) >= 4)
              & ~tail.rlike(r"^[LMXJVSD][auiaeo]?[- ]"))
    return F.when(usable, tail).otherwise(F.lit(""))


def classify_error(message: Column) -> Column:
    """Short cause of a fetch failure, or the message itself."""
    from kermesse.vocab.offers import FAILURE_CAUSES
    out = message
    for mark, cause in reversed(FAILURE_CAUSES):
        out = F.when(F.contains(message, F.lit(mark)), F.lit(cause)).otherwise(out)
    return out
