"""Operator 4: sampled SentencePiece segmentations, and decoding.

A text gets the model's opening space and is cut before every run of spaces
into units, which no piece crosses, so its piece lattice is the product of its
units' lattices.  Forward filtering sums, for each distinct unit, the weights
of all segmentations up to every character; backward sampling then draws, for
each occurrence, the last piece, the one before it, and so on, each in
proportion to the segmentations that end with it.  Each segmentation so has the
probability ``exp(alpha * weight) / Z``.

The draws are hashes of the row key, the unit's number in its text and the
character's in its unit: they depend on nothing else, so partitions, retries
and lost executors change no result.

Characters that no piece matches alone, the piece character for a space among
them, are spelled in byte pieces: decoding gives back every text exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricefold.llm.lattice import Lattice, Pieces, PieceTable, looked_up, pieces
from pricefold.llm.shared import fresh, prepare, read_model, tidy
from pricefold.llm.tokens import BYTES, Chunk, chunks, combine, lists, mix

CHUNK = 1 << 19  # bytes of text whose lattice a task holds; a longer text is on its own
ALPHA = 1.0
_SPACE = BYTES == 32
_U = np.uint64


class Sampler:
    def __init__(self, vocab: Pieces, alpha: float = ALPHA):
        self.vocab, self.alpha, self.table = vocab, alpha, PieceTable(vocab)
        self.size = np.array([len(b) for b in vocab.bytes])
        self.start = np.cumsum(self.size) - self.size
        self.spelling = np.frombuffer(b"".join(vocab.bytes), np.uint8)

    def forward(self, g: Lattice) -> np.ndarray:
        """For each arc, the probability that a segmentation of all up to its
        end has it or an arc listed before it last."""
        total = np.zeros(g.n)  # log of the summed weights up to each character
        share = np.zeros(len(g.first))
        for groups, arcs in g.steps():
            x = g.before(total, arcs) + self.alpha * g.weight[arcs]
            heads = g.heads[groups] - arcs.start
            own = g.group[arcs] - groups.start
            top = np.maximum.reduceat(x, heads)
            part = np.exp(x - top[own])
            run = np.cumsum(part)
            run -= (run[heads] - part[heads])[own]
            whole = np.add.reduceat(part, heads)
            share[arcs] = run / whole[own]
            total[g.last[arcs][heads]] = top + np.log(whole)
        return share

    def draw(self, g: Lattice, unit: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Arcs of one segmentation per occurrence: all arcs in text order,
        and where each occurrence's begin.  ``unit``: the occurrence's unit;
        ``key``: what seeds its draws."""
        share = self.forward(g)
        last_arc = np.append(g.heads[1:], len(g.first)) - 1
        live, at = np.arange(len(unit)), g.ends[unit]
        drawn, steps = [], np.zeros(len(unit), np.int64)
        while len(live):
            group = g.group_of[at]
            u = (combine(key[live], (at - g.start[unit[live]]).astype(np.uint64)) >> _U(11)).astype(np.float64) / 2.0**53
            arc, end = g.heads[group], last_arc[group]
            beyond = np.flatnonzero((share[arc] <= u) & (arc < end))
            while len(beyond):  # a character ends a few arcs
                arc[beyond] += 1
                on = arc[beyond]
                beyond = beyond[(share[on] <= u[beyond]) & (on < end[beyond])]
            drawn.append((live, arc))
            steps[live] += 1
            more = ~g.root[g.first[arc]]
            live, at = live[more], g.first[arc][more] - 1
        bound = np.cumsum(np.append(0, steps))
        out = np.empty(bound[-1], np.int64)
        for k, (who, arc) in enumerate(drawn):
            out[bound[who + 1] - 1 - k] = arc
        return out, bound

    def spelled(self, g: Lattice, data: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of every arc, joined, and where each arc's begin."""
        bound = np.cumsum(np.append(0, g.cost))
        ids = np.repeat(g.piece, g.cost).astype(np.int32)
        lost = np.flatnonzero(ids < 0)
        arc = np.searchsorted(bound, lost, "right") - 1
        ids[lost] = self.vocab.byte_id[data[heads[g.last[arc]] + lost - bound[arc]]]
        return ids, bound

    def encode(self, c: Chunk, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts of a chunk, and where each text's begin."""
        s, e, first = units(c)
        text = np.repeat(np.arange(len(c)), np.diff(first))
        opens = np.zeros(len(s), np.int64)
        opens[first[:-1][np.diff(first) > 0]] = 1  # a text's first unit has one more space
        name = combine(c.hashes(s, e), opens.astype(np.uint64))
        _, at, back = np.unique(name, return_index=True, return_inverse=True)
        # the distinct units, joined
        size = (e - s + opens)[at]
        off = np.cumsum(np.append(0, size))
        data = c.data[np.maximum(np.arange(off[-1]) + np.repeat(s[at] - opens[at] - off[:-1], size), 0)]
        data[off[:-1][opens[at] == 1]] = 32
        g, heads = looked_up(Chunk(0, len(at), data, off), self.vocab, self.table)
        number = np.arange(len(s)) - first[:-1][text]
        arcs, bound = self.draw(g, back.reshape(-1), combine(key[text], number.astype(np.uint64)))
        ids, where = self.spelled(g, data, heads)
        cost = g.cost[arcs]
        ends = np.cumsum(np.append(0, cost))
        out = ids[np.arange(ends[-1]) + np.repeat(where[arcs] - ends[:-1], cost)]
        return out, ends[bound[first]]

    def decode(self, ids: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes that the ids spell, less each text's opening space, and where
        each text's begin."""
        ends = np.cumsum(np.append(0, self.size[ids]))
        raw = self.spelling[np.arange(ends[-1]) + np.repeat(self.start[ids] - ends[:-1], self.size[ids])]
        first = ends[bound]
        some = np.diff(first) > 0
        drop = first[:-1][some]
        drop = drop[raw[drop] == 32]
        keep = np.ones(len(raw), bool)
        keep[drop] = False
        return raw[keep], first - np.searchsorted(drop, first)


def units(c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of units (a run of spaces and what follows it), and
    each text's first unit; an empty text has none."""
    space = _SPACE[c.data]
    cut = space.copy()
    cut[1:] &= ~space[:-1]
    cut[c.off[:-1][np.diff(c.off) > 0]] = True
    s = np.flatnonzero(cut)
    return s, np.append(s[1:], len(c.data)), np.searchsorted(s, c.off)


def _encoded(held, column: str, key: str, seed: int, alpha: float, names: list[str], check: bool):
    def run(batches):
        sampler = Sampler(pieces(held.value), alpha)
        for batch in batches:
            null = batch.column(column).is_null().to_numpy(zero_copy_only=False)
            seeds = mix(batch.column(key).to_numpy(zero_copy_only=False).view(np.uint64) + _U(seed))
            for c in chunks(batch.column(column), CHUNK):
                ids, bound = sampler.encode(c, seeds[c.start : c.stop])
                part = batch.slice(c.start, len(c)).drop_columns([key])
                got = lists(ids, bound, pa.int32())
                if null[c.start : c.stop].any():
                    got = pa.ListArray.from_arrays(got.offsets, got.values, mask=pa.array(null[c.start : c.stop]))
                columns = [*part.columns, got]
                if check:
                    raw, off = sampler.decode(ids, bound)
                    columns.append(pa.array([bool(np.array_equal(raw[off[i] : off[i + 1]], c.data[c.off[i] : c.off[i + 1]]))
                                             for i in range(len(c))]))
                yield pa.RecordBatch.from_arrays(columns, names)

    return tidy(run)


def encode(docs: DataFrame, model_file: str, text: str = "text", row_key: str = "doc_id", seed: int = 0, alpha: float = ALPHA,
           ids: str = "ids", lossless: str | None = None) -> DataFrame:
    """``docs`` with ``ids``, a sampled segmentation of the whole text.

    ``row_key`` and ``seed`` alone decide the draws: repeated rows get the same
    segmentation, another seed another one; null keys share one key.  ``alpha``
    flattens (0: all segmentations alike) or sharpens the distribution.  Null
    texts get null ids, empty ones no ids; an empty table gives no rows.
    ``lossless`` names a column for whether decoding gives the text back.
    """
    prepare(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(read_model(model_file))
    key = fresh([*docs.columns, ids], "row_key")
    rows = docs.withColumn(key, F.xxhash64(F.col(row_key).cast("string")))
    names = [*docs.columns, ids, *([lossless] if lossless else [])]
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema)
    return rows.mapInArrow(_encoded(held, text, key, seed, alpha, names, bool(lossless)),
                           kept + f"`{ids}` array<int>" + (f", `{lossless}` boolean" if lossless else ""))


def _decoded(held, column: str, names: list[str]):
    def run(batches):
        sampler = Sampler(pieces(held.value))
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                got = part.column(column)
                n = np.array([0 if x is None else x for x in got.value_lengths().to_pylist()], np.int64)
                raw, off = sampler.decode(got.flatten().to_numpy().astype(np.int64), np.cumsum(np.append(0, n)))
                raw = raw.tobytes()
                text = [None if null else raw[off[i] : off[i + 1]].decode("utf-8", "replace")
                        for i, null in enumerate(got.is_null().to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(text, pa.string())], names)

    return tidy(run)


def decode(rows: DataFrame, model_file: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with ``text``, what the piece ids spell, less the opening
    space.  Null ids give null, no ids an empty text."""
    prepare(rows.sparkSession)
    held = rows.sparkSession.sparkContext.broadcast(read_model(model_file))
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema)
    return rows.mapInArrow(_decoded(held, ids, [*rows.columns, text]), kept + f"`{text}` string")
