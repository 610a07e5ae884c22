"""Sampled segmentations over the piece lattice of a SentencePiece model, and their lossless decoding."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kermesse.llm.common import python_ready, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Exponent of a piece's probability: 0 samples all segmentations alike, large values the likeliest one.
ALPHA, SEED = 1.0, 17
#: Edges of the lattices that a task remembers (20 bytes each), and parts that it filters at a time.
REMEMBERED, LEARNT = 2_500_000, 4_000
#: Fixed values of the model's format: the mark of a blank, and the name of a byte piece.
BLANK, BYTE = "▁", re.compile(r"<0x([0-9A-F]{2})>")

#: No piece crosses the start of a run of blanks or a line feed, so a text's lattice is a chain of these parts.
_PARTS = re.compile(r" *(?:\n|[^ \n]+)| +")


_BASE = np.uint64(0x9E3779B97F4A7C15)


def _extended(h: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """Hash of strings grown by one byte."""
    return _mixed(h * _BASE + byte.astype(np.uint64) + np.uint64(1))


class Pieces:
    """The pieces of a model as bytes, blanks as blanks, with log-probabilities by their rank (Zipf's law)."""

    def __init__(self, table: list[tuple[str, bool]]):
        self.bytes = np.zeros(256, np.int32)
        self.written: list[bytes] = []
        ranked, names, ids = 0, [], []
        self.logs = np.full(len(table), -12.0)  # of byte pieces
        total = sum(1 / (r + 10) for r in range(len(table)))
        for at, (name, special) in enumerate(table):
            if special:
                self.written.append(b"")
            elif byte := BYTE.fullmatch(name):
                self.bytes[int(byte[1], 16)] = at
                self.written.append(bytes([int(byte[1], 16)]))
            else:
                self.written.append(name.replace(BLANK, " ").encode())
                names.append(self.written[-1])
                ids.append(at)
                self.logs[at] = -math.log((ranked + 10) * total)
                ranked += 1
        # For each length: the sorted hashes of all pieces and prefixes of pieces, with the piece's id or -1.
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []
        whole = dict(zip(names, ids))
        with np.errstate(over="ignore"):
            for n in range(1, max(map(len, names)) + 1):
                own = list({name[:n] for name in names if len(name) >= n})
                h = np.zeros(len(own), np.uint64)
                for i in range(n):
                    h = _extended(h, np.array([w[i] for w in own], np.uint8))
                at = np.argsort(h)
                self.tables.append((h[at], np.array([whole.get(w, -1) for w in own], np.int32)[at]))

    @staticmethod
    def load(path: str = MODEL) -> Pieces:
        """Read on the driver; tasks get the table, so executors need no file."""
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return Pieces([(model.id_to_piece(i), model.is_control(i) or model.is_unknown(i)) for i in range(model.get_piece_size())])

    def edges(self, data: np.ndarray, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pieces found in `data`: where each starts, its bytes and its id. None passes `upto` of its start.

        A character that is no piece itself is a chain of byte pieces.
        """
        width = np.array([1] * 0xC0 + [2] * 0x20 + [3] * 0x10 + [4] * 0x10)[data]
        alone = np.zeros(len(data), bool)
        live, h, found = np.arange(len(data)), np.zeros(len(data), np.uint64), []
        with np.errstate(over="ignore"):
            for n, (hashes, ids) in enumerate(self.tables, 1):
                inside = live + n <= upto[live]
                live, h = live[inside], h[inside]
                h = _extended(h, data[live + n - 1])
                at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                known = hashes[at] == h
                live, h, at = live[known], h[known], ids[at[known]]
                if not len(live):
                    break
                piece = at >= 0
                found.append((live[piece], np.full(int(piece.sum()), n), at[piece]))
                alone[live[piece][width[live[piece]] == n]] = True
        lead = ((data & 0xC0) != 0x80) & ~alone
        missing = np.repeat(np.flatnonzero(lead), width[lead])
        if len(missing):
            first = np.flatnonzero(np.concatenate([[True], missing[1:] != missing[:-1]]))
            missing = missing + np.arange(len(missing)) - np.repeat(first, np.diff(np.append(first, len(missing))))
            found.append((missing, np.ones(len(missing), np.int64), self.bytes[data[missing]]))
        return tuple(np.concatenate([f[i] for f in found]) for i in range(3))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Sampler:
    """Forward filtering of distinct parts, and backward sampling of all their occurrences at once.

    The positions of all remembered lattices are numbered through; `key` holds position + cumulated probability of
    each arriving piece, so one binary search draws a piece for a position and a uniform number.
    """

    def __init__(self, pieces: Pieces, alpha: float, seed: int):
        self.pieces, self.alpha, self.seed = pieces, alpha, seed
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.first = self.last = np.zeros(0, np.int64)
        self.key, self.id, self.start = np.zeros(1 << 16), np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int64)
        self.edges = self.nodes = 0

    def learn(self, parts: list[str]) -> None:
        """Forward filtering: for each position of each part, the chance of each piece by which a path arrives."""
        written = [p.encode() for p in parts]
        sizes = np.array([len(w) for w in written])
        data = np.frombuffer(b"".join(written), np.uint8)
        ends = np.cumsum(sizes)
        part = np.repeat(np.arange(len(parts)), sizes)
        start, length, piece = self.pieces.edges(data, ends[part])
        first = ends - sizes + np.arange(len(parts))  # a part of n bytes has n + 1 positions
        start_node = start + part[start]
        end_node = start_node + length
        depth = end_node - first[part[start]]
        order = np.lexsort((start_node, end_node, depth))
        start_node, end_node, piece, depth = start_node[order], end_node[order], piece[order], depth[order]
        log = self.alpha * self.pieces.logs[piece]
        mass = np.full(int(ends[-1]) + len(parts), -np.inf)
        mass[first] = 0.0
        chance = np.zeros(len(log))
        steps = np.flatnonzero(np.concatenate([[True], depth[1:] != depth[:-1]]))
        for low, high in zip(steps, np.append(steps[1:], len(depth))):
            x, node = mass[start_node[low:high]] + log[low:high], end_node[low:high]
            head = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            times = np.diff(np.append(head, len(node)))
            top = np.maximum(np.maximum.reduceat(x, head), -1e300)
            weight = np.exp(x - np.repeat(top, times))
            total = np.add.reduceat(weight, head)
            mass[node[head]] = np.where(total > 0, top + np.log(np.maximum(total, 1e-300)), -np.inf)
            chance[low:high] = weight / np.repeat(np.maximum(total, 1e-300), times)
        order = np.argsort(end_node, kind="stable")
        node, chance = end_node[order], chance[order]
        head = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        times = np.diff(np.append(head, len(node)))
        upto = np.cumsum(chance)
        upto = np.minimum(upto - np.repeat(upto[head] - chance[head], times), 1.0)
        upto[head + times - 1] = 1.0
        self.known.update(zip(parts, range(len(self.known), len(self.known) + len(parts))))
        upon = self.edges + len(node)
        while len(self.key) < upon:  # doubled, so that all growth together copies each edge about once
            self.key, self.id, self.start = (np.concatenate([x, np.zeros_like(x)]) for x in (self.key, self.id, self.start))
        self.key[self.edges:upon] = self.nodes + node + upto
        self.id[self.edges:upon] = piece[order]
        self.start[self.edges:upon] = self.nodes + start_node[order]
        self.edges = upon
        self.first = np.concatenate([self.first, self.nodes + first])
        self.last = np.concatenate([self.last, self.nodes + first + sizes])
        self.nodes += len(mass)

    def sample(self, texts: list[str | None], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts in a row, and how many each text has."""
        if self.edges > REMEMBERED:
            self.clear()
        split = [_PARTS.findall(f" {text}") if text else () for text in texts]
        counts = np.array([len(own) for own in split], np.int64)
        flat = [p for own in split for p in own]
        if not flat:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        new = [p for p in dict.fromkeys(flat) if p not in self.known]
        for at in range(0, len(new), LEARNT):
            self.learn(new[at:at + LEARNT])
        part = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        first, last, key, ids, start = self.first, self.last, self.key[:self.edges], self.id, self.start
        ordinal = np.arange(len(part)) - np.repeat(np.cumsum(counts) - counts, counts)
        with np.errstate(over="ignore"):
            row = _mixed(keys.astype(np.int64).view(np.uint64) + np.uint64(self.seed) * np.uint64(0x9E3779B97F4A7C15))
            own = _mixed(np.repeat(row, counts) + ordinal.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
            at, goal, live = last[part], first[part], np.arange(len(part))
            lengths, drawn, step = np.zeros(len(part), np.int64), [], 0
            while len(live):
                chance = (_mixed(own + np.uint64(step)) >> np.uint64(40)).astype(np.float64) / (1 << 24)
                edge = np.searchsorted(key, at + chance, side="right")
                drawn.append((live, ids[edge]))
                lengths[live] += 1
                at = start[edge]
                more = at != goal
                at, goal, live, own, step = at[more], goal[more], live[more], own[more], step + 1
        ends = np.cumsum(lengths)
        out = np.zeros(ends[-1], np.int32)
        for step, (which, piece) in enumerate(drawn):
            out[ends[which] - 1 - step] = piece
        edges = np.concatenate([[0], ends])
        upto = edges[np.cumsum(counts)]
        return out, np.diff(np.concatenate([[0], upto]))


def encode(docs: DataFrame, pieces: Pieces | None = None, alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """`docs` with `ids` (array<int>): one segmentation of the whole text, drawn with probability in proportion to
    the product of its pieces' probabilities to the power `alpha`.

    The forward pass runs once for each distinct part of the lattice in a task; the backward draw of a part depends
    only on `seed`, `doc_id` and the part's place, so results do not depend on partitions or repeated runs. Texts
    are taken as they are: no normalising, characters outside the model (and its blank mark) become byte pieces,
    so decoding returns every text exactly. No shuffle.

    A null text has null ids, an empty one none. A null `doc_id` counts as 0; repeated rows get equal ids; no rows give
    no rows. Other columns pass through; an `ids` column is replaced.
    """
    python_ready(docs.sparkSession)
    pieces = pieces or Pieces.load()
    rest = [c for c in docs.columns if c != "ids"]
    schema = T.StructType([docs.schema[c] for c in rest] + [T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(pieces, alpha, seed)
        for b in slices(batches, 0.5):
            texts = b.column("text").to_pylist()
            keys = np.array([k or 0 for k in b.column("doc_id").to_pylist()], np.int64)
            ids, counts = sampler.sample(texts, keys)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            # A null offset makes a null list.
            null = np.array([t is None for t in texts] + [False])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32(), mask=null), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), lists], [*rest, "ids"])

    return docs.select(*rest).mapInArrow(run, schema)


def decode(ids: Column, pieces: Pieces | None = None) -> Column:
    """The text of an array of ids; null for null."""
    written = (pieces or Pieces.load()).written

    @F.pandas_udf("string")
    def text(rows: pd.Series) -> pd.Series:
        return pd.Series([None if r is None else b"".join(map(written.__getitem__, r.tolist())).decode()[1:] for r in rows], dtype=object)

    return text(ids)
