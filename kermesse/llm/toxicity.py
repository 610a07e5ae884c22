"""Toxicity: texts restored through a noisy channel, then scored."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kermesse.llm.common import Remembered, python_ready, slices, staged

#: Labelled rows of each class that the classifier is fitted on, by the least hash of their ids.
FIT_ROWS = 10_000
#: Least toxic texts and log-odds of a feature, and the most features a model keeps (its size, not the data's).
SUPPORT, LEAST_ODDS, MAX_FEATURES = 0.004, 2.0, 50_000
#: Letters that a sign may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a",
        "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou", "#": "h",
        "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i"}
#: Log-probabilities of the channel: a letter written as a sign, a sign meant as itself, a letter written twice,
#: a letter stretched further, a gap put inside a word.
SIGN, ITSELF, DOUBLED, STRETCHED, GAP = -2.0, -3.0, -3.0, -1.0, -1.0
#: Classes of characters: 0 is the edge of a word, 1-26 a-z, 27-60 Latin letters from U+00DE, 61 any other letter.
CLASSES = 64
EDGE = "\n"

_SIGNS = re.compile("[" + re.escape("".join(LEET)) + r"]|([^\W\d_])\1\1")
_LETTER = re.compile(r"[^\W\d_]")
_ENDS = ".,;:?\"'()[]{}<>-_/\\`~%&=^"
_STREAMERS = re.compile(r"([^\w\s])\1\1+")  # three equal signs and more stand for no letter
_GAPS = r"[ \t.\-_*·~]"
_SPACED = re.compile(rf"(?<![\w@$!])(?:[\w@$!]{_GAPS}{{1,2}}){{2,}}[\w@$!](?![\w@$!])")
_HIDDEN = dict.fromkeys(map(ord, "­​‌‍⁠﻿"))


def char_class(c: str) -> int:
    if "a" <= c <= "z":
        return ord(c) - 96
    if 0xDE <= ord(c) <= 0xFF:
        return ord(c) - 0xDE + 27
    return 61 if c.isalpha() else 0


def class_table() -> np.ndarray:
    """Class of each character of the basic plane."""
    return np.array([char_class(chr(i)) for i in range(0x10000)], np.int64)


def char_counts(docs: DataFrame) -> np.ndarray:
    """Counts of three successive classes over every text: CLASSES cubed at most, whatever the corpus."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = class_table(), np.zeros(CLASSES ** 3, np.int64)
        for b in slices(batches, 2):
            text = EDGE.join(t.lower() for t in b.column("text").to_pylist() if t)
            codes = np.frombuffer(f"\n{text}\n".encode("utf-32-le", "surrogatepass"), np.uint32)
            codes = table[np.minimum(codes, 0xFFFF)]
            total += np.bincount((codes[:-2] * CLASSES + codes[1:-1]) * CLASSES + codes[2:], minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["at", "n"])

    out = np.zeros(CLASSES ** 3)
    grams = docs.select(F.col("text").cast("string")).mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    for at, n in grams.collect():  # at most CLASSES cubed rows
        out[at] = n
    return out.reshape(CLASSES, CLASSES, CLASSES)


class CharModel:
    """Character trigrams, each smoothed by the bigram and that by the single class."""

    def __init__(self, counts: np.ndarray, smoothing: float = 5.0):
        one = counts.sum((0, 1)) + 1e-3
        two = counts.sum(0)
        p1 = one / one.sum()
        p2 = (two + smoothing * p1) / (two.sum(1, keepdims=True) + smoothing)
        p3 = (counts + smoothing * p2[None]) / (counts.sum(2, keepdims=True) + smoothing)
        self.log = np.log(p3).astype(np.float32)

    def of(self, a: int, b: int, c: int) -> float:
        return float(self.log[a, b, c])


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each run of equal characters, what it may stand for, with the channel's log-probability."""
    out: list[list[tuple[str, float]]] = []
    at = 0
    while at < len(token):
        c, end = token[at], at + 1
        while end < len(token) and token[end] == c:
            end += 1
        n, at = end - at, end
        if c in LEET:
            arcs = [(letter, SIGN) for letter in LEET[c]] + [("" if c in "*|" else " ", ITSELF)]
            if n > 1:
                arcs += [(letter * 2, SIGN + DOUBLED) for letter in LEET[c]]
        elif c.isalpha():
            arcs = [(c, 0.0)] if n == 1 else [(c * 2, 0.0), (c, DOUBLED)] if n == 2 else [(c, STRETCHED), (c * 2, STRETCHED)]
        elif c in " .-_*·~\t":
            arcs = [("", GAP), (" ", ITSELF)]
        else:
            arcs = [(" ", 0.0)]
        out.append(arcs)
    return out


def restored(token: str, model: CharModel) -> str:
    """The likeliest clean text of a token: best path through its lattice under channel and character model."""
    states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    for arcs in lattice(token):
        after: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (score, text) in states.items():
            for letters, cost in arcs:
                x, y, s = a, b, score + cost
                for letter in letters:
                    z = char_class(letter)
                    s += model.of(x, y, z)
                    x, y = y, z
                if (x, y) not in after or after[x, y][0] < s:
                    after[x, y] = (s, text + letters)
        states = after
    return max((score + model.of(a, b, 0), text) for (a, b), (score, text) in states.items())[1].strip()


def pieces_of(text: str) -> set[str]:
    """Distinct tokens of a whole text in lower case, and its runs of single characters with gaps."""
    text = text.lower()
    if not text.isascii():
        text = text.translate(_HIDDEN)
    pieces = set(text.split())
    pieces.update(m.group() for m in _SPACED.finditer(text))
    return pieces


def tokens(text: str, model: CharModel, known: Remembered) -> set[str]:
    """Distinct restored words of a whole text."""
    found = set()
    for piece in pieces_of(text):
        if (words := known.get(piece)) is None:
            words = known.keep(piece, tuple(_words(piece, model)))
        found.update(words)
    return found


def _words(piece: str, model: CharModel) -> list[str]:
    core = _STREAMERS.sub(" ", piece).strip(_ENDS + " \t")
    if _SPACED.fullmatch(core) or _SIGNS.search(core.rstrip("!*")) and _LETTER.search(core):
        core = restored(core if _SPACED.fullmatch(core) else core.rstrip("!*"), model)
    return re.findall(r"[^\W\d_]+", core)


def grams(word: str) -> list[str]:
    """Features of a word: itself, and its runs of four and five characters with its edges."""
    edged = f"^{word}$"
    return [f"={word}", *(edged[i:i + n] for n in (4, 5) for i in range(len(edged) - n + 1))]


#: Columns of counts: toxic and clean texts of the first half, and of the rest.
COUNTS = ("t1", "c1", "t0", "c0")


def feature_counts(texts: DataFrame, model: CharModel) -> DataFrame:
    """`feature`, and in how many toxic and clean texts of either half it occurs, summed in tasks before the shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Remembered()
        seen = {(label, first): Counter() for first in (True, False) for label in (1, 0)}  # in the order of COUNTS

        def told():
            every = sorted(set().union(*seen.values()))
            columns = [pa.array(every, pa.string()), *(pa.array([c[f] for f in every], pa.int64()) for c in seen.values())]
            for c in seen.values():
                c.clear()
            return pa.RecordBatch.from_arrays(columns, ["feature", *COUNTS])

        for b in slices(batches, 1):
            for text, label, first in zip(*(b.column(c).to_pylist() for c in ("text", "label", "first"))):
                seen[label, first].update({g for w in tokens(text or "", model, known) for g in grams(w)})
                if sum(map(len, seen.values())) > 400_000:
                    yield told()
        yield told()

    return texts.select("text", "label", "first").mapInArrow(count, "feature string, " + ", ".join(f"{c} long" for c in COUNTS)).groupBy(
        "feature").agg(*(F.sum(c).alias(c) for c in COUNTS))


def word_weights(counts: DataFrame, toxic: list[str], clean: list[str], n: dict[str, int], max_features: int) -> dict[str, float]:
    """Log-odds of the features that are likelier in toxic texts, from the counts and text numbers of these columns."""
    n_toxic, n_clean = sum(n[c] for c in toxic), sum(n[c] for c in clean)
    if not n_toxic or not n_clean:
        return {}
    total = lambda columns: sum((F.col(c) for c in columns), F.lit(0))
    odds = F.log((total(toxic) + 0.5) / (n_toxic + 1)) - F.log((total(clean) + 0.5) / (n_clean + 1))
    best = (counts.withColumns({"toxic": total(toxic), "odds": odds})
            .where((F.col("toxic") >= max(3, SUPPORT * n_toxic)) & (F.col("odds") >= LEAST_ODDS))
            .orderBy(F.col("odds").desc(), F.col("toxic").desc(), "feature").limit(max_features))
    return {r.feature: r.odds for r in best.select("feature", "odds").collect()}


class ToxicModel:
    """Weights of features and of three numbers of a text: its worst word, how many are bad, and their sum."""

    def __init__(self, chars: CharModel, weights: dict[str, float]):
        self.chars, self.weights = chars, weights
        self.known, self.scored = Remembered(), Remembered()
        self.final = np.array([-4.0, 0.0, 0.0, 0.0])

    def __getstate__(self):
        return self.__dict__ | {"known": Remembered(), "scored": Remembered()}

    def bad_words(self, piece: str) -> tuple[tuple[str, float], ...]:
        """The restored words of a piece that weigh anything."""
        out = []
        for word in _words(piece, self.chars):
            if (score := self.scored.get(word)) is None:
                score = self.scored.keep(word, max((self.weights.get(g, 0.0) for g in grams(word)), default=0.0))
            if score:
                out.append((word, score))
        return tuple(out)

    def numbers(self, text: str | None) -> tuple[float, float, float]:
        found: dict[str, float] = {}
        for piece in pieces_of(text or ""):
            if (words := self.known.get(piece)) is None:
                words = self.known.keep(piece, self.bad_words(piece))
            if words:
                found.update(words)
        bad = found.values()
        return (max(bad) / 5, math.log1p(sum(s >= 4 for s in bad)), math.log1p(sum(s for s in bad if s >= 3)) / 2) if bad else (0.0,) * 3

    def score(self, numbers: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.final[0] + numbers @ self.final[1:])))


def numbered(texts: DataFrame, model: ToxicModel, keep: list[str]) -> DataFrame:
    schema = ", ".join([*(f"{c} {dict(texts.dtypes)[c]}" for c in keep), "z1 double", "z2 double", "z3 double", "score double"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 4):
            z = np.array([model.numbers(t) for t in b.column("text").to_pylist()], float).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *(pa.array(z[:, i]) for i in range(3)),
                                              pa.array(model.score(z))], [*keep, "z1", "z2", "z3", "score"])

    return texts.select(*keep, F.col("text").cast("string")).mapInArrow(score, schema)


def logistic(z: np.ndarray, y: np.ndarray, ridge: float = 0.02, steps: int = 30) -> np.ndarray:
    x, w = np.column_stack([np.ones(len(z)), z]), np.zeros(z.shape[1] + 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ w)))
        penalty = np.append(0.0, np.full(z.shape[1], ridge))
        gradient = x.T @ (p - y) / len(y) + penalty * w / len(y) * 10
        hess = (x * (p * (1 - p))[:, None]).T @ x / len(y) + np.diag(penalty / len(y) * 10 + 1e-9)
        w = w - np.clip(np.linalg.solve(hess, gradient), -3, 3)
    return w


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, max_features: int = MAX_FEATURES) -> ToxicModel:
    """Character model from all of `docs`; word weights and their combination from a bounded sample of `labels`.

    `labels` has `doc_id` and `label` (1 toxic, 0 clean). `fit_rows` rows of each class are taken, those whose ids
    hash lowest; equal texts count once. The combination is fitted on one half with weights from the other half;
    the weights then come from both.
    """
    chars = CharModel(char_counts(docs))
    rows = labels.select(F.col("doc_id").cast("long"), F.col("label").cast("int")).dropna().groupBy("doc_id").agg(F.max("label").alias("label"))
    order = F.xxhash64("doc_id")
    chosen = [rows.where(F.col("label") == k).orderBy(order, "doc_id").limit(fit_rows) for k in (0, 1)]
    sample = F.broadcast(chosen[0].unionByName(chosen[1]))  # 2 * fit_rows pairs of numbers
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(sample, "doc_id").dropDuplicates(["text", "label"])
    texts = staged(texts.select("doc_id", "text", "label", (F.pmod(order, F.lit(2)) == 0).alias("first")))
    counts = staged(feature_counts(texts, chars))
    held = {("t" if r.label else "c") + ("1" if r.first else "0"): r["count"] for r in texts.groupBy("label", "first").count().collect()}
    n = {c: held.get(c, 0) for c in COUNTS}
    rest = texts.where("not first")
    model = ToxicModel(chars, word_weights(counts, ["t1"], ["c1"], n, max_features))
    z = numbered(rest, model, ["label"]).select("label", "z1", "z2", "z3").orderBy("label", "z1", "z2", "z3").collect()
    y = np.array([r[0] for r in z], float)
    if 0 < y.sum() < len(y):
        model.final = logistic(np.array([r[1:] for r in z], float), y)
    model.weights = word_weights(counts, ["t1", "t0"], ["c1", "c0"], n, max_features)
    return model


def toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row a document: `doc_id`, `score` (0 to 1, higher: toxic likelier) and the three numbers `z1`, `z2`, `z3`.

    Each token is read as a character lattice (signs for letters, gaps, repetition) and decoded by Viterbi's
    algorithm under a character model counted over all of `docs`; a token without such signs has one path and is
    taken as it is. The restored words of the whole text are then scored. Scoring is one pass without a shuffle.

    Null and empty texts score as texts without words. Repeated rows get a row each. Labels without a text, null
    labels and null ids teach nothing; repeated labels count once (any 1 wins); with one class only, every score is
    low. No rows give no rows; other columns are ignored.
    """
    python_ready(docs.sparkSession)
    model = fit(docs, labels, fit_rows)
    return numbered(docs.select(F.col("doc_id").cast("long"), F.col("text")), model, ["doc_id"])
