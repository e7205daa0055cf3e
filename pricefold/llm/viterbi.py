"""Operator 10: token counts by count-only Viterbi.

A text is cut before every run of spaces into units, which no piece crosses
(a vocabulary whose pieces have a space after another character cuts nothing,
so every listed piece can match).  For each distinct unit, Aho-Corasick finds
all vocabulary pieces, and a dynamic program carries the best score and the
number of pieces to every character; no path is kept.

Tie rules are those of unigram tokenizers: ends are reached from starts in
ascending order and only a greater score replaces one, so of equal scores the
earliest start (the longest last piece) stands.  A character that no piece
matches alone may also be unknown, at 10 below the least score, and then counts
its bytes.  A text that does not open with a space is given one.  Pieces are
those of the vocabulary as listed, including control and byte spellings.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricefold.llm.lattice import SPACE, Pieces, pieces, searched
from pricefold.llm.shared import fresh, prepare, read_model, tidy
from pricefold.llm.tokens import BYTES, Chunk, chunks, combine, sums

CACHE = 1 << 19  # distinct units whose counts a task keeps
_SPACE = BYTES == 32


class Counter:
    """Counts and scores of units, kept by hash while a task runs."""

    def __init__(self, vocab: Pieces):
        self.vocab = vocab
        self.whole = any(SPACE in p.lstrip(SPACE) for p in vocab.names)  # pieces that would cross units
        self.automaton = vocab.automaton(np.arange(len(vocab.names)))
        self.lengths = np.array([len(p) for p in vocab.names])
        self.keys = np.zeros(0, np.uint64)
        self.counts = np.zeros(0, np.int64)
        self.scores = np.zeros(0)

    def solve(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces and score of the best path of each unit."""
        g = searched(units, self.vocab, self.automaton, self.lengths)
        best, count = np.zeros(g.n), np.zeros(g.n, np.int64)
        for groups, arcs in g.steps():
            cand = g.before(best, arcs) + g.weight[arcs]
            heads = g.heads[groups] - arcs.start
            top = np.maximum.reduceat(cand, heads)
            own = g.group[arcs] - groups.start
            first = np.minimum.reduceat(np.where(cand == top[own], np.arange(len(cand)), len(cand)), heads)
            ends = g.last[arcs][first]
            best[ends] = top
            count[ends] = g.before(count, arcs)[first] + g.cost[arcs][first]
        return count[g.ends], best[g.ends]

    def units(self, c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of units, whether each is given an opening space, and
        each text's first unit."""
        space = _SPACE[c.data]
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        if self.whole:
            cut[:] = False
        begins = c.off[:-1][np.diff(c.off) > 0]
        cut[begins] = True
        s = np.flatnonzero(cut)
        opens = np.zeros(len(c.data), bool)
        opens[begins] = ~space[begins]
        return s, np.append(s[1:], len(c.data)), opens[s], np.searchsorted(s, c.off)

    def count(self, c: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and best score of each text."""
        s, e, opens, first = self.units(c)
        key, at, back = np.unique(combine(c.hashes(s, e), opens.astype(np.uint64)), return_index=True, return_inverse=True)
        slot = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        known = self.keys[slot] == key if len(self.keys) else np.zeros(len(key), bool)
        new = np.flatnonzero(~known)
        raw = c.data.tobytes()
        counts, scores = self.solve([" " * int(opens[i]) + raw[s[i] : e[i]].decode("utf-8", "replace") for i in at[new]])
        n, x = np.zeros(len(key), np.int64), np.zeros(len(key))
        n[new], x[new] = counts, scores
        if known.any():
            n[known], x[known] = self.counts[slot[known]], self.scores[slot[known]]
        if len(self.keys) + len(new) > CACHE:
            self.keys, self.counts, self.scores = key, n, x
        else:
            keys = np.concatenate([self.keys, key[new]])
            order = np.argsort(keys)
            self.keys = keys[order]
            self.counts = np.concatenate([self.counts, counts])[order]
            self.scores = np.concatenate([self.scores, scores])[order]
        back = back.reshape(-1)
        return sums(n[back], first), sums(x[back], first)


def _counted(held, column: str, names: list[str]):
    def run(batches):
        counter = Counter(pieces(held.value))
        for batch in batches:
            texts = pc.replace_substring(batch.column(column), SPACE, " ")
            for c in chunks(texts):
                n, x = counter.count(c)
                part = batch.slice(c.start, len(c)).drop_columns([column])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n, pa.int64()), pa.array(x, pa.float64())], names)

    return tidy(run)


def token_counts(docs: DataFrame, model_file: str, text: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every row with ``n_tokens`` of its whole text and
    ``best_score``, the sum of its units' best scores.  Null and empty texts
    have no tokens; an empty table gives no rows; repeated rows are rows of
    their own; columns that are not kept do not matter, whatever their names; a
    very long text is counted whole."""
    prepare(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(read_model(model_file))
    column, names = fresh([*keep, "n_tokens", "best_score"], "text"), [*keep, "n_tokens", "best_score"]
    rows = docs.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias(column))
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name != column)
    return rows.mapInArrow(_counted(held, column, names), kept + "n_tokens long, best_score double")
