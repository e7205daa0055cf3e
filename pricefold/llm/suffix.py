"""Operator 3: benchmark decontamination by suffix arrays of the training texts.

Each task's texts are laid out word by word, in shards of at most ``SHARD``
words.  A shard has a suffix array over its words: positions in the order of the
word sequences that begin there, as far as any test item is long.  Every suffix
of every test item is binary-searched in it; the neighbours of the place where it
would stand hold its longest verbatim match in the shard.  Where that reaches a
window, the range of all suffixes that open with the window gives all its
occurrences, and runs of occurrences along an item are the maximal verbatim
matches of item and text, with their places.

Test items are written once as blocks of bounded size in the shared folder,
which tasks map into memory one after the other: neither the items nor the
matches pass through the driver, and texts are never shuffled.

Words: A-Z lower-cased, then ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.  A window
is ``width`` consecutive words of an item; an item of fewer words, but not
none, is one window.
"""

from __future__ import annotations

import io
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricefold.llm.shared import mapped_path, scratch, tidy, write_atomic
from pricefold.llm.tokens import ALNUM, Chunk, chunks, lists, owner, sums

SHARD = 1 << 20
LAYOUT = 4 << 20  # bytes of text laid out together; a longer text is on its own
BLOCK_WORDS = 1 << 18  # item words per test block
BLOCKS = 4  # blocks that a worker keeps loaded
PAIRS = 1 << 22  # occurrences of windows times items that share them, followed at a time
CODE_BITS = 21  # bits of a word's hash in the order; full hashes decide matches
_U = np.uint64


# ------------------------------------------------------------- test items --

def _write_blocks(folder: str):
    """Items -> block files of words; a row per file written."""

    def write(items: list, words: list[np.ndarray], k: int) -> str:
        path = f"{folder}/{TaskContext.get().partitionId():05d}-{k:05d}.npz"
        out = io.BytesIO()
        np.savez(out, names=np.array([i or "" for i in items], dtype=np.str_), null=np.array([i is None for i in items]),
                 size=np.array([len(w) for w in words]), words=np.maximum(np.concatenate(words), _U(1)))
        write_atomic(path, lambda f: f.write(out.getbuffer()))
        return path

    def run(batches):
        items, words, held, k = [], [], 0, 0
        for batch in batches:
            ids = batch.column("item_id").to_pylist()
            for c in chunks(batch.column("text"), fold=True):
                s, e, first = c.spans(ALNUM)
                h = c.hashes(s, e)
                for i in range(len(c)):
                    w = h[first[i] : first[i + 1]]
                    if len(w):
                        items.append(ids[c.start + i])
                        words.append(w)
                        held += len(w)
                        if held >= BLOCK_WORDS:
                            yield pa.RecordBatch.from_arrays([pa.array([write(items, words, k)])], ["path"])
                            items, words, held, k = [], [], 0, k + 1
        if items:
            yield pa.RecordBatch.from_arrays([pa.array([write(items, words, k)])], ["path"])

    return tidy(run)


class Block:
    """Some items' words one after the other, a 0 after each item, as a text is
    laid out; for each place its item and its word's number there."""

    def __init__(self, path: str):
        with np.load(path) as z:
            self.names = [None if no else str(n) for n, no in zip(z["names"], z["null"])]
            self.size, words = z["size"], z["words"]
        self.fill(words)

    def fill(self, words: np.ndarray) -> None:
        self.item = np.repeat(np.arange(len(self.size)), self.size + 1)
        start = np.cumsum(self.size + 1) - self.size - 1
        self.offset = np.arange(len(self.item)) - start[self.item]
        self.words = np.zeros(len(self.item), np.uint64)
        self.words[self.offset < self.size[self.item]] = words
        self.key = _threes(_codes(self.words))


_blocks: OrderedDict[str, Block] = OrderedDict()


def _load(path: str) -> Block:
    """A block; the few used last stay loaded in the worker (each is bounded)."""
    if path not in _blocks:
        if len(_blocks) >= BLOCKS:
            _blocks.popitem(last=False)
        _blocks[path] = Block(path)
    _blocks.move_to_end(path)
    return _blocks[path]


# ------------------------------------------------------------ the shards --

def _codes(words: np.ndarray) -> np.ndarray:
    return np.where(words == 0, _U(0), np.maximum(words >> _U(64 - CODE_BITS), _U(1)))  # 0 parts texts


def _threes(code: np.ndarray) -> np.ndarray:
    """Codes of each position and its next two, packed in one number."""
    pad = np.concatenate([code, np.zeros(2, np.uint64)])
    return (pad[:-2] << _U(2 * CODE_BITS)) | (pad[1:-1] << _U(CODE_BITS)) | pad[2:]


def _at(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Values at places, 0 beyond the end."""
    return np.where(places < len(values), values[np.minimum(places, len(values) - 1)], _U(0))


class Shard:
    """Suffix array of a run of words, 0 where a text ends; ``depth``: words by
    which positions are ordered at least."""

    def __init__(self, words: np.ndarray, depth: int):
        self.words = words
        self.key = _threes(_codes(words))
        order = np.argsort(self.key)
        lead = self.key[order]
        new = np.ones(len(order), bool)
        new[1:] = lead[1:] != lead[:-1]
        n = len(order)
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        done = 3
        while done < depth:
            alone = new & np.append(new[1:], True)
            slots = np.flatnonzero(~alone)  # positions whose place is still open
            if not len(slots):
                break
            at = order[slots]
            after = np.where(at + done < n, rank[np.minimum(at + done, n - 1)], 0)
            full = (rank[at].astype(np.uint64) << _U(32)) | after.astype(np.uint64)
            by = np.argsort(full, kind="stable")
            order[slots] = at[by]
            full = full[by]
            grown = np.ones(len(slots), bool)
            grown[1:] = full[1:] != full[:-1]
            new[slots] |= grown
            # a group's number is the slot of its first member: stays in order, and fits 32 bits
            rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0)) + 1
            done *= 2
        self.order, self.lead = order, lead

    def places(self, block: Block) -> np.ndarray:
        """Where in the suffix array each suffix of the block would stand."""
        lo = np.searchsorted(self.lead, block.key, "left")
        hi = np.searchsorted(self.lead, block.key, "right")
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) >> 1
            less = self._before(self.order[mid], block, open_)
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)

    def _before(self, at: np.ndarray, block: Block, suffix: np.ndarray) -> np.ndarray:
        """Whether the shard's suffix at ``at`` is below the block's; both open
        with the same three codes."""
        out = np.zeros(len(at), bool)
        live, step = np.arange(len(at)), 0
        while len(live):
            open_ = _at(block.key, suffix[live] + step)
            # a suffix of the block ends with its item: what follows need not be compared
            live = live[(open_ & _U((1 << CODE_BITS) - 1)) > 0]
            step += 3
            x, y = _at(self.key, at[live] + step), _at(block.key, suffix[live] + step)
            out[live[x < y]] = True
            live = live[x == y]
        return out

    def longest(self, block: Block) -> np.ndarray:
        """Words of the longest match of each suffix of the block: its neighbours
        in the suffix array hold it."""
        place = self.places(block)
        best = np.zeros(len(place), np.int64)
        for near in (place - 1, place):
            live = np.flatnonzero((near >= 0) & (near < len(self.order)) & (block.words > 0))
            at, n = self.order[near[live]], 0
            while len(live):
                same = (_at(self.words, at + n) == _at(block.words, live + n)) & (_at(block.words, live + n) > 0)
                live, at, n = live[same], at[same], n + 1
                best[live] = np.maximum(best[live], n)
        return best

    def ranges(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Half-open ranges of the suffix array that open with each row of codes."""
        n = q.shape[1]
        pad = np.concatenate([q, np.zeros((len(q), -n % 3), np.uint64)], axis=1)
        low = [(pad[:, k] << _U(2 * CODE_BITS)) | (pad[:, k + 1] << _U(CODE_BITS)) | pad[:, k + 2]
               for k in range(0, pad.shape[1], 3)]
        free = _U((1 << (CODE_BITS * (-n % 3))) - 1)  # codes that the window does not fix
        lo = np.searchsorted(self.lead, low[0], "left")
        hi = np.searchsorted(self.lead, low[0] | (free if n <= 3 else _U(0)), "right")
        if n <= 3:
            return lo, hi
        live = np.flatnonzero(lo < hi)
        tail = [x[live] for x in low[1:]]
        ends = [*tail[:-1], tail[-1] | free]
        a = self._bound(lo[live], hi[live], tail, False)
        b = self._bound(a, hi[live], ends, True)
        lo[live], hi[live] = a, b
        return lo, hi

    def _bound(self, lo, hi, tail, after: bool):
        """First slot of [lo, hi) whose words from the fourth on are not below
        ``tail`` (``after``: are above it)."""
        lo, hi = lo.copy(), hi.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) >> 1
            at = self.order[mid]
            below = np.full(len(open_), after)
            tied = np.ones(len(open_), bool)
            for k, t in enumerate(tail):
                pos = at + 3 * (k + 1)
                x = np.where(pos < len(self.key), self.key[np.minimum(pos, len(self.key) - 1)], _U(0))
                want = t[open_]
                below = np.where(tied & (x != want), x < want, below)
                tied &= x == want
            lo[open_] = np.where(below, mid + 1, lo[open_])
            hi[open_] = np.where(below, hi[open_], mid)

    def occurrences(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, position) of every occurrence, by whole word hashes."""
        lo, hi = self.ranges(_codes(windows))
        count = np.maximum(hi - lo, 0)
        which = np.repeat(np.arange(len(windows)), count)
        slot = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + lo[which]
        at = self.order[slot]
        n = windows.shape[1]
        ok = at + n <= len(self.words)
        which, at = which[ok], at[ok]
        for k in range(n):
            ok = self.words[at + k] == windows[which, k]
            which, at = which[ok], at[ok]
        return which, at


def _found(chunk: Chunk, paths: list[str], width: int):
    """The chunk's words by text, and all window occurrences: for each block its
    items, the items' words and the chunk's words where windows begin, and the
    windows' sizes."""
    s, e, first = chunk.spans(ALNUM)
    h = chunk.hashes(s, e)
    text = owner(first)
    # one 0 after each text parts it from the next
    spot = np.arange(len(h)) + text
    flat = np.zeros(len(h) + len(chunk), np.uint64)
    flat[spot] = np.maximum(h, _U(1))
    back = np.cumsum(flat != 0) - 1

    def search():
        for a in range(0, len(flat), SHARD):
            words, shard = flat[a : a + SHARD + width - 1], None
            for path in paths:
                block = _load(path)
                if shard is None or shard.reach < block.size.max():
                    shard = Shard(words, max(width, int(block.size.max())))
                    shard.reach = block.size.max()
                size = np.minimum(block.size, width)[block.item]
                # suffixes that reach a window; a short item is one window, from its first word
                whole = (block.size[block.item] - block.offset >= size) & (block.words > 0)
                live = np.flatnonzero((shard.longest(block) >= size) & whole)
                for n in np.unique(size[live]).tolist():
                    of = live[size[live] == n]
                    windows, which = np.unique(np.stack([block.words[of + k] for k in range(n)], axis=1), axis=0, return_inverse=True)
                    by = np.argsort(which.reshape(-1), kind="stable")
                    bounds = np.searchsorted(which.reshape(-1)[by], np.arange(len(windows) + 1))
                    w, at = shard.occurrences(windows)
                    keep = at < SHARD  # the rest belongs to the next shard
                    w, at = w[keep], at[keep]
                    times = bounds[w + 1] - bounds[w]
                    upto = np.cumsum(times)
                    cuts = np.searchsorted(upto, np.arange(PAIRS, int(upto[-1]) + PAIRS, PAIRS), "left") + 1 if len(upto) else []
                    for i, j in zip([0, *cuts], cuts):  # an occurrence's items in one piece
                        j = min(j, len(w))
                        if i < j:
                            t = times[i:j]
                            slot = np.arange(t.sum()) - np.repeat(np.cumsum(t) - t, t) + np.repeat(bounds[w[i:j]], t)
                            place = of[by[slot]]
                            yield path, n, block.item[place], block.offset[place], np.repeat(back[at[i:j] + a], t)

    return first, text, search()


def _runs(parts: list[tuple[np.ndarray, ...]], text: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """Maximal runs of window occurrences along item and text: item, its word,
    the chunk's word and the number of words."""
    it, off, at = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((off, at - off, it))
    it, off, at = it[order], off[order], at[order]
    new = np.ones(len(it), bool)
    new[1:] = (it[1:] != it[:-1]) | (at[1:] != at[:-1] + 1) | (off[1:] != off[:-1] + 1)
    new[1:] |= text[at[1:]] != text[at[:-1]]
    head = np.flatnonzero(new)
    return it[head], off[head], at[head], np.diff(np.append(head, len(it))) + n - 1


def _matched(chunk: Chunk, paths: list[str], width: int):
    """The chunk's words by text, and its maximal matches with every block: name
    or None of each item, then arrays as of ``_runs``."""
    first, text, search = _found(chunk, paths, width)
    held: dict[tuple, list] = {}
    for path, n, *pairs in search:
        held.setdefault((path, n), []).append(pairs)
        if sum(len(p[0]) for p in held[path, n]) > PAIRS:  # runs are far fewer than occurrences
            held[path, n] = _folded(held[path, n], text, n)
    return first, text, [(_load(path).names, *_runs(_unfolded(parts, n), text, n)) for (path, n), parts in held.items()]


def _folded(parts: list, text: np.ndarray, n: int) -> list:
    """Occurrences so far as runs (five arrays: item, words, length), to be unfolded later."""
    return [[*_runs(_unfolded(parts, n), text, n)]]


def _unfolded(parts: list, n: int) -> list:
    """Occurrences again: a run of m words is one of m - n + 1 windows."""
    out = []
    for p in parts:
        if len(p) == 4:
            it, off, at, length = p
            times = length - n + 1
            step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            p = [np.repeat(it, times), np.repeat(off, times) + step, np.repeat(at, times) + step]
        out.append(p)
    return out


# ------------------------------------------------------------- operators --

def _paths(bench: DataFrame, text: str, item_id: str) -> list[str]:
    folder = mapped_path(scratch(bench.sparkSession, "suffix")) + "/items"
    rows = (bench.select(F.col(item_id).cast("string").alias("item_id"), F.col(text).cast("string").alias("text"))
            .mapInArrow(_write_blocks(folder), "path string").collect())  # one row a block
    return sorted(r["path"] for r in rows)


def _covered(starts: list[np.ndarray], lengths: list[np.ndarray], n: int) -> np.ndarray:
    """Which of n words lie in any of the runs."""
    step = np.zeros(n + 1, np.int64)
    if starts:
        s, length = np.concatenate(starts), np.concatenate(lengths)
        np.add.at(step, s, 1)
        np.add.at(step, s + length, -1)
    return np.cumsum(step[:-1]) > 0


LONGEST = "longest_words long, longest_item string, longest_item_word long, longest_doc_word long"


def _screen(paths: list[str], width: int):
    def run(batches):
        for batch in batches:
            for c in chunks(batch.column("text"), LAYOUT, fold=True):
                first, text, matches = _matched(c, paths, width)
                items: list[set] = [set() for _ in range(len(c))]
                best: list[tuple] = [(0, False, "", None, None)] * len(c)
                for names, it, off, at, length in matches:
                    d = text[at]
                    for i, k in np.unique(np.stack([d, it]), axis=1).T.tolist():
                        if names[k] is not None:
                            items[i].add(names[k])
                    # the longest of each text: then by item (unnamed last), item word, text word
                    name = [(n is None, n or "") for n in names]
                    rank = np.argsort(sorted(range(len(names)), key=name.__getitem__))
                    order = np.lexsort((at, off, rank[it], -length, d))
                    order = order[np.append(True, np.diff(d[order]) > 0)] if len(order) else order
                    for k in order.tolist():
                        i = int(d[k])
                        new = (-int(length[k]), *name[it[k]], int(off[k]), int(at[k] - first[i]))
                        if not best[i][0] or new < best[i]:
                            best[i] = new
                hit = _covered([m[3] for m in matches], [m[4] for m in matches], first[-1])
                found = [sorted(x) for x in items]
                ends = np.cumsum([0, *map(len, found)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(c.start, len(c)), pa.array(np.diff(first), pa.int64()),
                     pa.array(sums(hit, first), pa.int64()),
                     lists(np.array([y for x in found for y in x], dtype=object), ends, pa.string()),
                     pa.array([-b[0] for b in best], pa.int64()), pa.array([None if b[1] or not b[0] else b[2] for b in best], pa.string()),
                     pa.array([b[3] for b in best], pa.int64()), pa.array([b[4] for b in best], pa.int64())],
                    ["doc_id", "n_words", "n_hit", "items", *(x.split()[0] for x in LONGEST.split(", "))])

    return tidy(run)


def contamination(docs: DataFrame, bench: DataFrame, width: int = 10, text: str = "text", doc_id: str = "doc_id",
                  item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``n_hit`` (its words inside an
    occurrence of any window), ``items`` (sorted ids, as strings, of the items with
    occurring windows) and its longest verbatim match of a window or more:
    ``longest_words`` (0: none), ``longest_item``, ``longest_item_word`` and
    ``longest_doc_word`` (words counted from 0; of equally long ones the first by
    item id, item word, text word).

    Null and empty texts have no words; a null item_id hits words and can be the
    longest match, but is not listed; an empty one is an id; repeated rows are
    rows of their own, repeated items are listed once; empty tables give empty
    results or no hits; other columns are not looked at; a text longer than a
    shard is searched shard by shard, matches across their edges whole.
    """
    paths = _paths(bench, item_text, item_id)
    return (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
            .mapInArrow(_screen(paths, width), f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n_words long, "
                        f"n_hit long, items array<string>, {LONGEST}"))


def _listed(paths: list[str], width: int, least: int):
    def run(batches):
        for batch in batches:
            for c in chunks(batch.column("text"), LAYOUT, fold=True):
                first, text, matches = _matched(c, paths, width)
                for names, it, off, at, length in matches:
                    keep = length >= least
                    it, off, at, length = it[keep], off[keep], at[keep], length[keep]
                    d = text[at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([names[k] for k in it.tolist()], pa.string()), pa.array(off, pa.int64()),
                         batch.column("doc_id").take(pa.array(d + c.start)), pa.array(at - first[d], pa.int64()),
                         pa.array(length, pa.int64())], ["item_id", "item_word", "doc_id", "doc_word", "n_words"])

    return tidy(run)


def longest_matches(docs: DataFrame, bench: DataFrame, width: int = 10, least: int = 1, text: str = "text",
                    doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """Maximal verbatim matches of a window or more between items and texts:
    ``(item_id, item_word, doc_id, doc_word, n_words)``, words counted from 0.
    Item ids are strings or null.  Nulls, repeats, long texts and empty tables
    as in ``contamination``."""
    paths = _paths(bench, item_text, item_id)
    return (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
            .mapInArrow(_listed(paths, width, least), "item_id string, item_word long, "
                        f"doc_id {docs.schema[doc_id].dataType.simpleString()}, doc_word long, n_words long"))


def _clean(paths: list[str], width: int, column: str):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for c in chunks(batch.column(column).cast(pa.string()), LAYOUT, fold=True):
                _, text, matches = _matched(c, paths, width)
                bad = np.zeros(len(c), bool)
                for _, _, _, at, _ in matches:
                    bad[text[at]] = True
                keep.append(~bad)
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return tidy(run)


def decontaminate(docs: DataFrame, bench: DataFrame, width: int = 10, text: str = "text", item_text: str = "text",
                  item_id: str = "item_id") -> DataFrame:
    """The rows of ``docs`` without a verbatim match of a window or more with any
    item, all columns as they are, whatever their names.  Rows of null or empty
    text stay; repeated rows stay or go together; empty tables: no rows, or all."""
    paths = _paths(bench, item_text, item_id)
    return docs.mapInArrow(_clean(paths, width, text), docs.schema)
