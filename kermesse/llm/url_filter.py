"""Web addresses judged by path rules and by a weighted vocabulary."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kermesse.llm.common import ascii_lower, python_ready

#: One strict term rejects an address; soft terms reject it when the weights of the distinct ones reach SOFT_LIMIT. Each
#: weighs less than the limit, so one alone never rejects; words that tracking parameters use weigh least.
STRICT = {"porn": 1, "xxx": 1, "casino": 1, "viagra": 1, "escort": 1, "hentai": 1, "malware": 1, "warez": 1}
SOFT = {"adult": 1.5, "sex": 1.5, "nude": 1.5, "betting": 1.5, "bets": 1.5, "poker": 1.5, "slots": 1.5, "pills": 1.5, "pharmacy": 1.5,
        "torrent": 1.5, "crack": 1.5, "spam": 1.5, "dating": 1.0, "loans": 1.0, "cheap": 1.0, "free": 1.0, "farm": 1.0, "win": 1.0,
        "bonus": 1.0, "ads": 0.5, "click": 0.5, "track": 0.5, "tracker": 0.5}
SOFT_LIMIT = 2
#: (verdict, host, path): a rule fits its host and all subdomains where the path starts with its own.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))


def after_scheme(url: Column) -> Column:
    """All that follows the first `://`; empty for other addresses."""
    return F.coalesce(F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))), F.lit(""))


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) after the first `://` and the path up to `?` or `#`; both empty for other addresses."""
    rest = after_scheme(url)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return ascii_lower(host), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text and its verdict, or nulls. Equal lengths: a blocking rule wins."""
    text = verdict = F.lit(None).cast("string")
    for kind, own, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block")):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        text = F.when(fits, F.lit(own + start)).otherwise(text)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def term_hits(strict: dict[str, int], soft: dict[str, int]):
    """Count distinct strict terms and weigh distinct soft terms of lower-cased addresses in one automaton pass.

    A hit counts only between boundaries: the characters beside it are not letters or digits.
    """
    @F.pandas_udf("struct<strict_hits int, soft_weight double, terms array<string>>")
    def hits(urls: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        found = ahocorasick.Automaton()
        for term, weight in soft.items():
            found.add_word(term, (term, False, weight))
        for term, weight in strict.items():
            found.add_word(term, (term, True, weight))
        if found:
            found.make_automaton()
        for part in urls:
            out = []
            for url in part:
                seen = {}
                for end, (term, is_strict, weight) in found.iter(url) if url and found else ():
                    left, right = end - len(term), end + 1
                    if (left < 0 or not url[left].isalnum()) and (right == len(url) or not url[right].isalnum()):
                        seen[term] = (is_strict, weight)
                out.append((sum(s for s, _ in seen.values()), float(sum(w for s, w in seen.values() if not s)),
                            sorted(seen)))
            yield pd.DataFrame(out, columns=["strict_hits", "soft_weight", "terms"])
    return hits


def vocabulary(table: DataFrame, most: int = 100_000) -> tuple[dict[str, float], dict[str, float]]:
    """Strict and soft terms of a table (term, strict, weight), which is read when the plan is built; `most` rows at most."""
    rows = table.select("term", "strict", F.col("weight").cast("double")).where("term <> ''").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a vocabulary holds {most} terms at most")
    return {r.term: r.weight for r in rows if r.strict}, {r.term: r.weight for r in rows if not r.strict}


def url_filter(pages: DataFrame, rules=RULES, strict=STRICT, soft=SOFT, soft_limit: float = SOFT_LIMIT) -> DataFrame:
    """`pages` with `host`, `path`, `rule`, `verdict` (allow or block), `strict_hits`, `soft_weight`, `terms`.

    The longest fitting rule decides; without one, an address is blocked by one strict term or by distinct soft
    terms whose weights sum to `soft_limit`. Terms are sought in all that follows `://`: host, path, query and fragment.
    `vocabulary` reads terms from a table. Each row is judged on its own: no shuffle.

    A null address or one without `://` has an empty host and path, no rule, and is allowed.
    Repeated rows get equal results, no rows give no rows, columns named like the results are replaced.
    """
    python_ready(pages.sparkSession)
    host, path = host_path(F.col("url"))
    out = pages.withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit("")),
                             "_hits": term_hits(strict, soft)(ascii_lower(after_scheme(F.col("url"))))})
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    own = F.when((F.col("_hits.strict_hits") > 0) | (F.col("_hits.soft_weight") >= soft_limit), "block").otherwise("allow")
    return out.withColumns({"rule": rule, "verdict": F.coalesce(verdict, own), "strict_hits": F.col("_hits.strict_hits"),
                            "soft_weight": F.col("_hits.soft_weight"), "terms": F.col("_hits.terms")}).drop("_hits")
