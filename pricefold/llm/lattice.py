"""Piece lattices of many short texts at once.

``Pieces`` holds a SentencePiece vocabulary.  A unit is a stretch of text
that no piece crosses; a lattice has an arc for every vocabulary piece found in
a unit (by Aho-Corasick or by hash) and one for each character that no piece matches alone,
spelled in bytes.  Arcs are arrays over the concatenated units, grouped by the
character that they end at and ordered by how far into its unit that is, so
dynamic programs run over all units in step.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import sentencepiece

from pricefold.llm.tokens import Chunk

SPACE = "▁"  # how pieces spell a space
LEAST = 10.0  # an unknown character scores this much below the least piece


class Pieces:
    """Pieces with their log weights.

    A unigram model's scores are log probabilities.  A BPE model's are merge
    ranks; by Zipf's law the piece of rank r is given the weight 1 / (r + 1).
    Pieces marked unused, and their like far below all others, get the least.
    """

    def __init__(self, model: bytes, scores: list[float] | None = None):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.vocab_size()
        self.names = [sp.id_to_piece(i) for i in range(n)]
        raw = np.array([sp.get_score(i) for i in range(n)])
        self.byte = np.array([sp.is_byte(i) for i in range(n)])
        self.plain = np.array([not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) for i in range(n)])
        self.byte_id = np.zeros(256, np.int32)
        for i in np.flatnonzero(self.byte):
            self.byte_id[int(self.names[i][1:-1], 16)] = i
        if scores is not None:
            self.weight = np.array(scores, float)
        else:
            ranks = self.plain & (raw <= 0) & (raw > -1e8)
            whole = np.allclose(raw[ranks], np.round(raw[ranks]))  # merge ranks
            self.weight = np.where(ranks, -np.log1p(-raw) if whole else raw, 0.0)
            if ranks.any():
                self.weight[self.plain & ~ranks] = self.weight[ranks].min()
        self.unknown = float(self.weight.min()) - LEAST
        self.bytes = [bytes([int(p[1:-1], 16)]) if b else p.replace(SPACE, " ").encode() if k else b""
                      for p, b, k in zip(self.names, self.byte, self.plain)]

    def automaton(self, ids: np.ndarray) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i in ids:
            if self.names[i]:
                found.add_word(self.names[i].replace(SPACE, " "), int(i))
        found.make_automaton()
        return found


@lru_cache(maxsize=2)
def pieces(model: bytes) -> Pieces:
    """The vocabulary of a model file's content, made once per worker."""
    return Pieces(model)


class PieceTable:
    """Pieces by hash, for looking up many spans of bytes at once: open
    addressing, whole 64-bit hashes compared."""

    def __init__(self, vocab: Pieces, bits: int = 17):
        ids = np.flatnonzero(vocab.plain & np.array([len(b) > 0 for b in vocab.bytes]))
        raw = [vocab.bytes[i] for i in ids]
        ends = np.cumsum([len(b) for b in raw])
        h = Chunk(0, 1, np.frombuffer(b"".join(raw), np.uint8), np.array([0, ends[-1]])).hashes(np.append(0, ends[:-1]), ends)
        while 4 * len(ids) > 1 << bits:
            bits += 1
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.ids = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
        for key, i in zip(h, ids):
            at = int(key >> self.shift)
            while self.ids[at] >= 0:
                at = (at + 1) & self.mask
            self.keys[at], self.ids[at] = key, i
        self.sizes = np.unique([len(b.decode()) for b in raw])  # characters

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece ids of span hashes, -1 where there is none."""
        at = (h >> self.shift).astype(np.int64)
        out = self.ids[at]
        same = self.keys[at] == h
        open_ = np.flatnonzero((out >= 0) & ~same)
        out = np.where(same, out, -1)
        at = at[open_]
        while len(open_):
            at = (at + 1) & self.mask
            got = self.ids[at]
            hit = (got >= 0) & (self.keys[at] == h[open_])
            out[open_[hit]] = got[hit]
            more = (got >= 0) & ~hit
            open_, at = open_[more], at[more]
        return out


class Lattice:
    """Arcs of units, over the characters of the joined units.

    Arc k spans characters ``first[k]`` to ``last[k]``, is piece ``piece[k]``
    (-1: an unknown character of ``cost[k]`` bytes) and weighs ``weight[k]``.
    ``root[c]``: character c opens its unit.  ``ends[u]``: last character of
    unit u.  ``size``: characters of each unit (none is empty), ``width``:
    bytes of each character.  The arcs given are those of pieces.
    """

    def __init__(self, size: np.ndarray, width: np.ndarray, first: np.ndarray, last: np.ndarray, piece: np.ndarray, vocab: Pieces):
        n = len(width)
        self.n, self.size = n, size
        self.start = np.cumsum(size) - size
        unit = np.repeat(np.arange(len(size)), size)
        self.root = np.zeros(n, bool)
        self.root[self.start] = True
        self.ends = self.start + size - 1
        if n:
            inside = unit[np.maximum(first, 0)] == unit[last]
            if not inside.all():
                first, last, piece = first[inside], last[inside], piece[inside]
        alone = np.zeros(n, bool)
        alone[first[first == last]] = True
        lost = np.flatnonzero(~alone)
        first, last = np.concatenate([first, lost]), np.concatenate([last, lost])
        piece = np.concatenate([piece, np.full(len(lost), -1, piece.dtype)])
        level = last - self.start[unit[last]] if n else last
        longest = int((last - first).max()) + 1 if n else 1
        if n and int(level.max() + 1).bit_length() + n.bit_length() + longest.bit_length() < 63:
            order = np.argsort((level * (n + 1) + last) * (longest + 1) + (longest - (last - first)))
        else:
            order = np.lexsort((first, last, level))
        self.first, self.last, self.piece = first[order], last[order], piece[order]
        known = self.piece >= 0
        self.weight = np.where(known, vocab.weight[self.piece], vocab.unknown)
        self.cost = np.where(known, 1, width[self.last])
        # groups of arcs with one end, and the groups of each level
        new = np.ones(len(order), bool)
        new[1:] = self.last[1:] != self.last[:-1]
        self.heads = np.flatnonzero(new)
        self.group = np.cumsum(new) - 1
        level = level[order][self.heads]
        self.levels = np.searchsorted(level, np.arange(level[-1] + 2)) if len(level) else np.zeros(1, np.int64)
        self.group_of = np.zeros(n, np.int64)
        self.group_of[self.last[self.heads]] = np.arange(len(self.heads))

    def steps(self):
        """Slices of groups and of arcs, level by level."""
        bounds = np.append(self.heads, len(self.first))
        for a, b in zip(self.levels[:-1], self.levels[1:]):
            if a < b:
                yield slice(a, b), slice(bounds[a], bounds[b])

    def before(self, value: np.ndarray, arcs: slice) -> np.ndarray:
        """``value`` of what stands before each arc; 0 at a unit's start."""
        at = self.first[arcs]
        return np.where(self.root[at], 0, value[at - 1])


def searched(units: list[str], vocab: Pieces, automaton, lengths: np.ndarray) -> Lattice:
    """Lattice of units whose pieces Aho-Corasick finds; no piece may cross
    from one unit into the next."""
    text = "".join(units)
    hits = np.fromiter(chain.from_iterable(automaton.iter(text)), np.int64) if len(automaton) else np.zeros(0, np.int64)
    last, piece = hits[::2], hits[1::2]
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    width = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000).astype(np.int64)
    return Lattice(np.array([len(u) for u in units], np.int64), width, last - lengths[piece] + 1, last, piece, vocab)


def looked_up(c: Chunk, vocab: Pieces, table: PieceTable) -> tuple[Lattice, np.ndarray]:
    """Lattice of a chunk's texts as units, every span of a piece's length
    looked up by hash; and the byte at which each character begins."""
    heads = np.flatnonzero((c.data & 0xC0) != 0x80)
    ends = np.append(heads, len(c.data))
    bound = np.searchsorted(heads, c.off)
    size = np.diff(bound)
    stop = np.repeat(bound[1:], size)
    first, last, piece = [], [], []
    for n in table.sizes:
        i = np.flatnonzero(np.arange(len(heads)) + n <= stop)
        found = table.find(c.hashes(ends[i], ends[i + n]))
        hit = found >= 0
        first.append(i[hit])
        last.append(i[hit] + n - 1)
        piece.append(found[hit])
    return Lattice(size, np.diff(ends), np.concatenate(first), np.concatenate(last), np.concatenate(piece), vocab), heads
