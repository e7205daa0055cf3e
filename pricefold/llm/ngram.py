"""Operator 1: interpolated modified Kneser-Ney language model.

Counting, in Spark:

- words are counted by 64-bit hash; the sorted hashes are the vocabulary, and
  ids are dealt by falling count, so frequent words have small ones;
- each task counts its n-grams of ids and sends them, as sorted and compressed
  blocks, to shards by the hash of the n-gram's first n - 1 words, so a frequent
  word's n-grams spread over all shards, and a shard holds all n-grams of a context;
- a shard sums its blocks, writes its entries and sends on, for the next lower
  order, each suffix with what is counted there (distinct words to its left;
  raw counts after the start of a text), and each prefix with the sums of that
  context.  All orders are one chain of shuffles.

A shard's entries are a part of a file of the shared folder: sorted hashes, cut
to 40 bits beyond the leading ones that an index of buckets holds, and a code
for each entry's count and context sums, which few distinct tuples make up.  (An
unseen n-gram passes for a seen one with probability 1.5e-11.)  Files hold the
more shards the more there are, so that their number grows as the square root
of the text's size.  Scoring tasks map them into memory and look up the
distinct n-grams of several chunks at a time in hash order, a file at a time.

Single words are fewer and have fewer shards.

With a(.) the count of its order, S the sum over a context and n_k the number
of its n-grams counted k times (3: three or more)::

    p(w | ctx) = (max(a - D(a), 0) + (D1 n1 + D2 n2 + D3 n3) p(w | shorter ctx)) / S(ctx)

ending in the uniform 1 / (V + 1), so the probabilities of the V words and of
one unknown word sum to 1.
"""

from __future__ import annotations

import json
import mmap
import os
import uuid
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricefold.llm.shared import fresh, mapped_path, scratch, text_bytes, tidy, write_atomic
from pricefold.llm.tokens import NON_SPACE, Chunk, chunks, combine, mix, sums

_U = np.uint64
END = mix(np.array([0xE0F], np.uint64))  # hash of the token that ends a text
SHARD_BYTES = 16 << 20  # text per shard
FLUSH = 1 << 20  # n-grams that a task holds before it sends them
LOOKUP = 1 << 18  # tokens that are looked up together
OPEN_FILES = 4096  # mapped at a time by a worker, for each set of arrays

BLOCK = "shard int, kind int, data binary"
GRAM, CONTEXT, COUNTS = 0, 1, 2


# ------------------------------------------------------------ hash arrays --

def _bits(n_bytes: int) -> int:
    return max(1, int(np.ceil(np.log2(max(n_bytes / SHARD_BYTES, 1)))))


def _order_bits(n: int, bits: int) -> int:
    """Shards of order n: single words are few beside their text."""
    return bits if n > 1 else max(1, bits - 3)


def _file_bits(bits: int) -> int:
    """Files that hold an order's shards: one each up to 128, then as the square root."""
    return min(bits, (bits + 7) // 2)


def _shard(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> _U(64 - bits)).astype(np.int64)


def _save(path: str, **arrays: np.ndarray) -> None:
    """Arrays in one file: a JSON line that tells their places, then their bytes, 8-aligned."""
    places, at = {}, 0
    for name, a in arrays.items():
        places[name] = [at, str(a.dtype), list(a.shape)]
        at += -(-a.nbytes // 8) * 8
    line = json.dumps(places).encode()
    line += b" " * (-(len(line) + 1) % 8) + b"\n"

    def write(f):
        f.write(line)
        for a in arrays.values():
            f.write(np.ascontiguousarray(a).tobytes() + bytes(-a.nbytes % 8))

    write_atomic(path, write)


def _mapped(path: str) -> np.ndarray:
    """The bytes of a file, mapped into memory; no file stays open where that can be helped."""
    with open(path, "rb") as f:
        try:
            return np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ, trackfd=False), np.uint8)
        except TypeError:  # before Python 3.13
            return np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), np.uint8)


def _arrays(path: str) -> dict[str, np.ndarray]:
    """What ``_save`` wrote."""
    raw = _mapped(path)
    with open(path, "rb") as f:
        line = f.readline()
    got = {}
    for name, (at, kind, shape) in json.loads(line).items():
        size = int(np.prod(shape)) * np.dtype(kind).itemsize
        got[name] = raw[len(line) + at : len(line) + at + size].view(kind).reshape(shape)
    return got


class ShardFiles:
    """Files by the leading bits of hashes, read by mapping them into memory; the
    ``OPEN_FILES`` used last stay open."""

    def __init__(self, folder: str, bits: int, read=_arrays):
        self.folder, self.bits, self.read, self.open = folder, bits, read, OrderedDict()

    def path(self, number: int) -> str:
        return f"{self.folder}/{number:07d}.arrays"

    def __getitem__(self, number: int):
        if number in self.open:
            self.open.move_to_end(number)
            return self.open[number]
        got = self.read(self.path(number)) if os.path.exists(self.path(number)) else None
        self.open[number] = got
        if len(self.open) > OPEN_FILES:
            self.open.popitem(last=False)
        return got

    def parts(self, number: np.ndarray) -> Iterator[tuple]:
        """For sorted file numbers: the slice of each file that is there, and what it holds."""
        cut = np.flatnonzero(np.diff(number)) + 1
        for a, b in zip(np.append(0, cut), np.append(cut, len(number))):
            if a < b and (have := self[int(number[a])]) is not None:
                yield slice(a, b), have


def _sorting(keys: np.ndarray, alike: int = 0) -> np.ndarray:
    """The order that sorts hashes with ``alike`` leading bits in common.  Their
    next bits are sorted as one number with their places, much faster than
    places alone; the few that agree there are put right after."""
    keys = keys << _U(alike)
    low = _U((1 << len(keys).bit_length()) - 1)
    both = keys & ~low
    both |= np.arange(len(keys), dtype=np.uint64)
    both.sort()
    both &= low
    order = both.view(np.int64)
    keys = keys[order]
    return order[np.argsort(keys, kind="stable")] if (keys[1:] < keys[:-1]).any() else order


REST = 40  # bits of a hash that are stored beyond those its bucket tells
ENTRY = 5  # count; sum over the entry as a context; its n-grams counted once, twice, more often


# of a shard in its file: leading bits that tell the bucket; where the index, the entries' high
# and low bits, their codes and the table of codes lie, in items; bytes of a code
DEPTH, INDEX, HIGH, LOW, CODE, TABLE, WIDTH, PLACES = range(8)


class EntryFile:
    """Writes a file of shards one after another, under a name of its own until
    it is whole: a retried or speculative task replaces it by the same bytes."""

    def __init__(self, path: str, shards: int):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        self.path, self.part = path, f"{path}.{uuid.uuid4().hex}"
        self.file, self.at = open(self.part, "wb"), 0
        self.places = np.zeros((shards, PLACES), np.int64)  # of a shard without entries: a bucket of none
        self.places[:, WIDTH] = 1
        self._put(np.zeros(2, np.uint32))

    def _put(self, a: np.ndarray) -> int:
        """Append an array, 8-aligned; its place in items."""
        at = self.at
        self.file.write(np.ascontiguousarray(a).data)
        self.file.write(bytes(-a.nbytes % 8))
        self.at += -(-a.nbytes // 8) * 8
        return at // a.dtype.itemsize

    def add(self, shard: int, keys: np.ndarray, values: np.ndarray) -> None:
        """Entries of a shard: sorted distinct hashes without the shard's bits, and
        ``ENTRY`` numbers each, of which the last ones may be left out where all are 0."""
        if not len(keys):
            return
        bits = max(0, int(np.ceil(np.log2(len(keys) / 16)))) if len(keys) > 16 else 0
        bucket = (keys >> _U(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
        rest = (keys << _U(bits)) >> _U(64 - REST)
        table, code = _coded(values)
        width = 1 if len(table) <= 1 << 8 else 2 if len(table) <= 1 << 16 else 4
        row = self.places[shard]
        row[DEPTH], row[WIDTH] = bits, width
        row[INDEX] = self._put(np.append(0, np.cumsum(np.bincount(bucket, minlength=1 << bits))).astype(np.uint32))
        row[HIGH] = self._put((rest >> _U(8)).astype(np.uint32))
        row[LOW] = self._put((rest & _U(255)).astype(np.uint8))
        row[CODE] = self._put(code.astype(f"u{width}"))
        row[TABLE] = self._put(np.pad(table, ((0, 0), (0, ENTRY - values.shape[1]))).astype(np.int64))

    def close(self) -> None:
        self._put(self.places)
        self.file.close()
        os.replace(self.part, self.path)


SMALL = (3, 4, 4, 3, 2)  # bits of numbers that most entries are made of


def _coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and each row's number among them."""
    columns = list(values.T)
    widths = [int(c.max(initial=0)).bit_length() for c in columns]
    if sum(widths) > 20:  # too many to be counted off, but for the small ones
        small = np.logical_and.reduce([c < 1 << w for c, w in zip(columns, SMALL)])
        large = np.flatnonzero(~small)
        code = np.empty(len(values), np.int64)
        table, code[small] = _coded(values[small])
        more, number = np.unique(values[large], axis=0, return_inverse=True) if sum(widths) > 62 else _sorted_rows(values[large], widths)
        code[large] = number.reshape(-1) + len(table)
        return np.concatenate([table, more]), code
    key = _row_keys(columns, widths)
    seen = np.zeros(1 << sum(widths), bool)
    seen[key] = True
    return _key_rows(np.flatnonzero(seen), widths), (np.cumsum(seen) - 1)[key]


def _row_keys(columns: list[np.ndarray], widths: list[int]) -> np.ndarray:
    key = np.zeros(len(columns[0]), np.int64)
    for c, w in zip(columns, widths):
        key = (key << w) | c
    return key


def _key_rows(keys: np.ndarray, widths: list[int]) -> np.ndarray:
    columns = []
    for w in reversed(widths):
        columns.append(keys & ((1 << w) - 1))
        keys = keys >> w
    return np.stack(columns[::-1], axis=1)


def _sorted_rows(values: np.ndarray, widths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    found, code = np.unique(_row_keys(list(values.T), widths), return_inverse=True)
    return _key_rows(found, widths), code


class Entries:
    """Entries of n-grams over all shards."""

    def __init__(self, folder: str, bits: int):
        self.files, self.bits = ShardFiles(folder, _file_bits(bits), _mapped), bits

    def values(self, keys: np.ndarray, weigh, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``n`` values that ``weigh`` makes of the ``ENTRY`` numbers of each distinct
        key, zeros where there is none; and for each key its place there.  ``weigh``
        is given a function that reads one of the numbers for all keys found."""
        order = _sorting(keys)  # by shard, then hash
        found = keys[order]
        new = np.append(len(found) > 0, found[1:] != found[:-1])
        uniq = found[new]
        place = np.empty(len(keys), np.int32)
        place[order] = np.cumsum(new, dtype=np.int32) - 1
        del order, found, new
        got = np.zeros((n, len(uniq)))
        for part, raw in self.files.parts(_shard(uniq, self.files.bits)):
            self._find(uniq[part] << _U(self.files.bits), raw, weigh, got[:, part])
        return got, place

    def _find(self, keys: np.ndarray, raw: np.ndarray, weigh, out: np.ndarray) -> None:
        more = self.bits - self.files.bits  # bits that tell the shard in the file
        places = raw[-8 * PLACES << more :].view(np.int64).reshape(1 << more, PLACES)
        raw = raw[: len(raw) // 8 * 8]
        words = raw.view(np.uint32)
        shard = (keys >> _U(64 - more)).astype(np.int64) if more else np.zeros(1, np.int64)
        keys = keys << _U(more)
        depth = places[shard, DEPTH].astype(np.uint64)
        at = ((keys >> _U(1)) >> (_U(63) - depth)).astype(np.int64) + places[shard, INDEX]
        rest = (keys << depth) >> _U(64 - REST)
        want = (rest >> _U(8)).astype(np.uint32)
        base = places[shard, HIGH]
        lo, end = words[at] + base, words[at + 1] + base
        # hashes are spread evenly: begin where each would lie and go on to the first that is not less
        here = lo + ((rest >> _U(8)).astype(np.int64) * (end - lo) >> (REST - 8))
        live = np.flatnonzero((here < end) & (words[here] < want))
        while len(live):
            here[live] += 1
            live = live[here[live] < end[live]]
            live = live[words[here[live]] < want[live]]
        live = np.flatnonzero((here > lo) & (words[here - 1] >= want))
        while len(live):
            here[live] -= 1
            live = live[here[live] > lo[live]]
            live = live[words[here[live] - 1] >= want[live]]
        live = np.flatnonzero((here < end) & (words[here] == want))
        last = (rest & _U(255)).astype(np.uint8)
        of = (lambda c, i: places[shard[i], c]) if more else lambda c, i: places[0, c]
        in_shard = here - base
        hits = []
        while len(live):  # nearly always the first
            hit = raw[in_shard[live] + of(LOW, live)] == last[live]
            hits.append(live[hit])
            live = live[~hit]
            here[live] += 1
            in_shard[live] += 1
            live = live[here[live] < end[live]]
            live = live[words[here[live]] == want[live]]
        hits = np.concatenate(hits) if hits else live
        numbers = raw.view(np.int64)
        for size in set(places[:, WIDTH].tolist()):
            some = hits[of(WIDTH, hits) == size] if more else hits
            code = raw.view(f"u{size}")[in_shard[some] + of(CODE, some)].astype(np.int64)
            at = of(TABLE, some) + code * ENTRY
            for row, numbers_of in zip(out, weigh(lambda k, at=at: numbers[at + k])):
                row[some] = numbers_of


# --------------------------------------------------------------- counting --

def _word_counts(bits: int):
    """Sorted blocks (shard, hashes, counts) of words and ends, summed over what a task holds."""

    def rows(k, n):
        shard = _shard(k, bits)
        cut = np.append(np.append(0, np.flatnonzero(np.diff(shard)) + 1), len(shard))
        return pa.RecordBatch.from_arrays(
            [pa.array(shard[cut[:-1]], pa.int32()), pa.array(np.zeros(len(cut) - 1), pa.int32()),
             pa.array([_packed(k[a:b, None], n[a:b, None]) for a, b in zip(cut[:-1], cut[1:])], pa.binary())], ["shard", "kind", "data"])

    def run(batches):
        keys, counts, pending = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
        for batch in batches:
            for c in chunks(batch.column("text"), fold=True):
                s, e, _ = c.spans(NON_SPACE)
                u, n = np.unique(c.hashes(s, e), return_counts=True)
                keys += [u, END]
                counts += [n, np.array([len(c)])]
                pending += len(u)
                if pending > FLUSH // 4:
                    k, n = _summed(np.concatenate(keys), np.concatenate(counts))
                    if len(k) > FLUSH:
                        yield rows(k, n)
                        k, n = k[:0], n[:0]
                    keys, counts, pending = [k], [n], 0
        k, n = _summed(np.concatenate(keys), np.concatenate(counts))
        if len(k):
            yield rows(k, n)

    return tidy(run)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = _sorting(keys)
    keys, counts = keys[order], counts[order]
    head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[head], np.add.reduceat(counts, head) if len(head) else counts[:0]


def _write_vocab(folder: str):
    """Blocks of words, shard by shard -> files; a row (shard, words, tokens) each."""

    def flush(shard, parts):
        keys, counts = _summed(np.concatenate([k[:, 0] for k, _ in parts]), np.concatenate([c[:, 0] for _, c in parts]))
        rank = np.empty(len(keys), np.int64)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(keys))
        _save(f"{folder}/{shard:07d}.arrays", keys=keys, counts=counts, rank=rank)
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([len(keys)]), pa.array([int(counts.sum())])],
                                          ["shard", "words", "tokens"])

    def run(batches):
        now, parts = None, []
        for batch in batches:
            for shard, data in zip(batch.column("shard").to_pylist(), batch.column("data")):
                if shard != now and parts:
                    yield flush(now, parts)
                    parts = []
                now = shard
                parts.append(_unpacked(data.as_buffer()))
        if parts:
            yield flush(now, parts)

    return tidy(run)


class Vocabulary:
    """Ids of word hashes: rank by count within a shard, dealt over the shards in
    turn.  ``unknown`` is an unknown word's id, ``start`` what pads the start of a text."""

    def __init__(self, folder: str):
        with open(f"{folder}/sizes.json") as f:
            sizes = json.load(f)
        self.files, self.bits, self.size, self.unknown = ShardFiles(folder, sizes["bits"]), sizes["bits"], sizes["size"], sizes["unknown"]
        self.start = self.unknown + 1
        self.kind = _kind(self.start)

    def ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id and training count of every word."""
        order = _sorting(hashes)
        found = hashes[order]
        new = np.append(len(found) > 0, found[1:] != found[:-1])
        uniq, back = found[new], np.empty(len(found), np.int64)
        back[order] = np.cumsum(new) - 1
        ids = np.full(len(uniq), self.unknown, self.kind)
        counts = np.zeros(len(uniq), np.int64)
        shard = _shard(uniq, self.bits)
        for part, have in self.files.parts(shard):
            at = np.minimum(np.searchsorted(have["keys"], uniq[part]), len(have["keys"]) - 1)
            there = have["keys"][at] == uniq[part]
            ids[part] = np.where(there, (have["rank"][at] << self.bits) + shard[part.start], self.unknown)
            counts[part] = np.where(there, have["counts"][at], 0)
        return ids[back], counts[back]


def _kind(largest: int):
    return np.uint32 if largest < 1 << 32 else np.uint64


def _sequence(c: Chunk, vocab: Vocabulary, order: int):
    """The chunk's ids with ``order - 1`` starts before each text and an end
    after it; where its tokens lie; each token's count; tokens before each text."""
    s, e, first = c.spans(NON_SPACE)
    ids, counts = vocab.ids(np.append(c.hashes(s, e), END))
    n = np.diff(first) + 1
    bound = np.cumsum(np.append(0, n))
    text = np.repeat(np.arange(len(c)), n)
    token = np.empty(bound[-1], vocab.kind)
    count = np.empty(bound[-1], np.int64)
    last = np.zeros(bound[-1], bool)
    last[bound[1:] - 1] = True
    token[~last], count[~last] = ids[:-1], counts[:-1]
    token[last], count[last] = ids[-1], counts[-1]
    at = np.arange(bound[-1]) + (text + 1) * (order - 1)
    flat = np.full(bound[-1] + len(c) * (order - 1), vocab.start, vocab.kind)
    flat[at] = token
    return flat, at, count, bound


def _gram_keys(columns: list[np.ndarray], bits: int) -> np.ndarray:
    """Keys of n-grams given as columns of ids, first word first: the shard, by
    the hash of the context (a single word's own), then bits of the n-gram's hash."""
    h = mix(columns[0].astype(np.uint64) + _U(1))
    owner = h
    for c in columns[1:]:
        owner, h = h, combine(h, c.astype(np.uint64))
    return (owner >> _U(64 - bits) << _U(64 - bits)) | (h >> _U(bits))


def _places(key: np.ndarray) -> np.ndarray:
    """The order that sorts numbers; those that come as a few sorted runs are merged."""
    few = np.count_nonzero(key[1:] < key[:-1]) < 64
    return np.argsort(key, kind="stable" if few else None)


def _in_order(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """An order of rows in which equal rows follow one another and all columns but
    the last are sorted, and where each run of equal rows begins."""
    widths = [int(c.max(initial=0)).bit_length() for c in columns]
    if sum(widths[:-1]) > 56:
        order = np.lexsort(columns[::-1])
        new = np.logical_or.reduce([c[order][1:] != c[order][:-1] for c in columns])
        return order, np.flatnonzero(np.append(len(order) > 0, new))
    key = np.zeros(len(columns[0]), np.uint64)
    for c, w in zip(columns[:-1], widths):
        key <<= _U(w)
        key |= c
    last, w, room = columns[-1].astype(np.uint64), widths[-1], 64 - sum(widths[:-1])
    fits = w <= room
    if not fits:  # the leading bits of a product that differs for different last words
        last *= _U(0x9E3779B97F4A7C15)
        last &= _U((1 << w) - 1)
        last >>= _U(w - room)
    key <<= _U(min(w, room))
    key |= last
    del last
    order = _places(key)
    key = key[order]
    new = key[1:] != key[:-1]
    if not fits:
        last = columns[-1][order]
        other = last[1:] != last[:-1]
        mixed = np.flatnonzero(other & ~new)
        if len(mixed):  # few words agree there: sort them on
            run = np.cumsum(np.append(False, new))
            part = np.zeros(run[-1] + 1, bool)
            part[run[mixed]] = True
            some = np.flatnonzero(part[run])
            order[some] = order[some[np.lexsort((last[some], run[some]))]]
            last = columns[-1][order]
            other = last[1:] != last[:-1]
        new |= other
    return order, np.flatnonzero(np.append(len(order) > 0, new))


def _rows(a: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of a table that is held by columns."""
    return np.stack([c.take(at) for c in a.T]).T


def _joined(tables: list[np.ndarray]) -> np.ndarray:
    """Tables one below the other, held by columns."""
    return np.concatenate([t.T for t in tables], axis=1).T


def _grouped(grams: np.ndarray, vals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams (rows), ``_in_order``, and their summed values."""
    if not len(grams):
        return grams, vals
    order, head = _in_order(list(grams.T))
    return _rows(grams, order[head]), _summed_runs(_rows(vals, order), head)


def _counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams (rows), ``_in_order``, and how often each is there."""
    widths = [int(c.max(initial=0)).bit_length() for c in grams.T]
    if not len(grams) or sum(widths) > 64:
        order, head = _in_order(list(grams.T))
        return _rows(grams, order[head]), np.diff(np.append(head, len(order)))[:, None]
    key = grams[:, 0].astype(np.uint64)
    for c, w in zip(grams.T[1:], widths[1:]):
        key = (key << _U(w)) | c
    key.sort()
    head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    count = np.diff(np.append(head, len(key)))
    key, out = key[head], np.empty((grams.shape[1], len(head)), grams.dtype).T
    for k in range(grams.shape[1] - 1, -1, -1):
        out[:, k] = key & _U((1 << widths[k]) - 1)
        if k:
            key = key >> _U(widths[k])
    return out, count[:, None]


def _summed_runs(vals: np.ndarray, head: np.ndarray) -> np.ndarray:
    if len(head) == len(vals):
        return vals
    return np.stack([np.add.reduceat(v, head) for v in vals.T]).T


def _planes(a: np.ndarray) -> tuple[int, bytes]:
    """Columns of numbers as planes of bytes of one weight, as many as the largest needs."""
    n = max(1, -(-int(a.max(initial=0)).bit_length() // 8))
    columns = np.ascontiguousarray(a.T)
    return n, columns.view(np.uint8).reshape(*columns.shape, -1).transpose(2, 0, 1)[:n].tobytes()


def _from_planes(raw: np.ndarray, planes: int, rows: int, columns: int, kind) -> np.ndarray:
    out = np.zeros((columns, rows, np.dtype(kind).itemsize), np.uint8)
    out[:, :, :planes] = raw.reshape(planes, columns, rows).transpose(1, 2, 0)
    return out.view(kind)[:, :, 0].T


def _packed(grams: np.ndarray, vals: np.ndarray) -> bytes:
    """A sorted block, compressed: the first words as differences, all columns
    as planes of bytes."""
    ids = grams.copy()
    ids[1:, 0] -= grams[:-1, 0]
    wide, first = _planes(ids)
    deep, second = _planes(vals)
    shape = np.array([*grams.shape, vals.shape[1], grams.dtype.itemsize, wide, deep], "<i8")
    return shape.tobytes() + pa.compress(first + second, "zstd", asbytes=True)


def _unpacked(data) -> tuple[np.ndarray, np.ndarray]:
    n, k, m, width, wide, deep = np.frombuffer(data, "<i8", 6).tolist()
    cut = n * k * wide
    raw = np.frombuffer(pa.decompress(memoryview(data)[48:], cut + n * m * deep, "zstd", asbytes=True), np.uint8)
    ids = _from_planes(raw[:cut], wide, n, k, np.uint32 if width == 4 else np.uint64)
    ids[:, 0] = np.cumsum(ids[:, 0], dtype=ids.dtype)
    return ids, _from_planes(raw[cut:], deep, n, m, np.int64)


def _blocks(grams: np.ndarray, vals: np.ndarray, bits: int, kind: int):
    """One row per shard of sorted n-grams (n x order) and their values."""
    if not len(grams):
        return
    shard = _shard(_gram_keys([grams[:, k] for k in range(grams.shape[1])], bits), bits)
    order = np.argsort(shard.astype(np.uint16) if bits <= 16 else shard, kind="stable")
    shard, grams, vals = shard[order], _rows(grams, order), _rows(vals, order)
    cut = np.append(np.append(0, np.flatnonzero(np.diff(shard)) + 1), len(shard))
    yield pa.RecordBatch.from_arrays(
        [pa.array(shard[cut[:-1]], pa.int32()), pa.array(np.full(len(cut) - 1, kind), pa.int32()),
         pa.array([_packed(grams[a:b], vals[a:b]) for a, b in zip(cut[:-1], cut[1:])], pa.binary())], ["shard", "kind", "data"])


def _count_grams(folder: str, order: int, bits: int):
    def run(batches):
        vocab = Vocabulary(folder)
        held, vals = np.zeros((0, order), vocab.kind), np.zeros((0, 1), np.int64)
        grams, size = [held], 0

        def all_held():
            g, v = _counted(_joined(grams))
            return _grouped(_joined([held, g]), _joined([vals, v])) if len(held) else (g, v)

        for batch in batches:
            for c in chunks(batch.column("text"), fold=True):
                flat, at, _, _ = _sequence(c, vocab, order)
                grams.append(np.stack([flat[at - order + 1 + k] for k in range(order)]).T)
                size += len(at)
                if size > FLUSH:
                    held, vals = all_held()
                    if 2 * len(held) > FLUSH:
                        yield from _blocks(held, vals, bits, GRAM)
                        held, vals = held[:0], vals[:0]
                    grams, size = [held[:0]], len(held)
        yield from _blocks(*all_held(), bits, GRAM)

    return tidy(run)


def _shards(batches, order: int, kind):
    """Whole shards of sorted block rows: the n-grams and the ``ENTRY`` numbers
    that their rows add up to, the count alone where none is a context.  Rows of
    counts come through as they are."""
    now, held = None, []

    def done():
        grams = _joined([g for _, g, _ in held])
        parts = [(what, v) for what, _, v in held]
        held.clear()  # before sorting
        places, head = _in_order(list(grams.T))
        grams = _rows(grams, places[head])
        sums = []
        for k in range(1 if all(what == GRAM for what, _ in parts) else ENTRY):  # one at a time, as they are many
            own = [v[:, k] if what == GRAM and not k else v[:, k - 1] if what == CONTEXT and k else np.zeros(len(v), np.int64) for what, v in parts]
            sums.append(np.add.reduceat(np.concatenate(own).take(places), head))
        return grams, np.stack(sums).T

    for batch in batches:
        for shard, what, data in zip(batch.column("shard").to_pylist(), batch.column("kind").to_pylist(), batch.column("data")):
            if what == COUNTS:
                yield shard, None, data.as_py()
                continue
            if shard != now and held:
                yield now, *done()
            now = shard
            held.append((what, *_unpacked(data.as_buffer())))
    if held:
        yield now, *done()


def _counts_row(shard: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([COUNTS], pa.int32()), pa.array([data], pa.binary())],
                                      ["shard", "kind", "data"])


def _merge_order(folder: str, order: int, bits: int, lower: int, start: int):
    """Sum one order's blocks, write its entries, and send what the next lower
    order (of 2 ** ``lower`` shards) and the contexts need, and how many n-grams
    are counted 1 to 4 times."""
    kind = _kind(start)
    more = bits - _file_bits(bits)

    def merged(file, shard, grams, values):
        key = _gram_keys(list(grams.T), bits)
        by_key = _sorting(key, bits)
        file.add(shard & ((1 << more) - 1), key[by_key] << _U(bits), _rows(values, by_key))
        del key, by_key
        seen = values[:, 0] > 0  # others are contexts only
        grams, a = (grams, values[:, 0]) if seen.all() else (_rows(grams, np.flatnonzero(seen)), values[seen, 0])
        del values
        once = [a, a == 1, a == 2, a >= 3]
        if order > 1 and len(grams):
            opens = grams[:, 1] == start  # the greatest id, so these follow the others
            inner, outer = np.flatnonzero(~opens), np.flatnonzero(opens)
            count = _counted(_rows(grams[:, 1:], inner)), _grouped(_rows(grams[:, 1:], outer), a[outer, None])
            del inner, outer
            yield from _blocks(*map(_joined, zip(*count)), lower, GRAM)
            del count
            head = grams[:, :-1]  # in order already
            first = np.flatnonzero(np.append(True, np.logical_or.reduce([c[1:] != c[:-1] for c in head.T])))
            yield from _blocks(_rows(head, first), np.stack([np.add.reduceat(x, first, dtype=np.int64) for x in once]).T, lower, CONTEXT)
        total = np.array([order, *((a == k).sum() for k in (1, 2, 3, 4)), *(x.sum() for x in once)])
        yield _counts_row(shard, total.astype("<i8").tobytes())

    def run(batches):
        number, file = None, None
        for shard, grams, values in _shards(batches, order, kind):
            if grams is None:
                yield _counts_row(shard, values)
                continue
            if shard >> more != number:
                if file:
                    file.close()
                number = shard >> more
                file = EntryFile(f"{folder}/{number:07d}.arrays", 1 << more)
            work = merged(file, shard, grams, values)
            del grams, values  # not to be held beside the next shard's
            yield from work
        if file:
            file.close()

    return tidy(run)


def _by_shard(blocks: DataFrame, bits: int, files: int) -> DataFrame:
    """Blocks dealt to one task per file of shards, a shard's blocks one after another."""
    return blocks.repartitionById(1 << files, F.shiftright("shard", bits - files)).sortWithinPartitions("shard")


@tidy
def _totals(batches):
    for batch in batches:
        rows = [np.frombuffer(d.as_buffer(), "<i8") for d in batch.column("data")]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([int(r[i]) for r in rows]) for i in range(9)], _TOTAL)


_TOTAL = ["n", *(f"c{i}" for i in range(8))]


def discounts(n: np.ndarray) -> np.ndarray:
    """D1, D2, D3+ from the numbers of n-grams counted 1, 2, 3 and 4 times."""
    if (n[:4] <= 0).any():
        return np.array([0.5, 1.0, 1.5])
    y = n[0] / (n[0] + 2 * n[1])
    d = np.array([1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]])
    return np.clip(d, 0.05, [1, 2, 3])


class KneserNey:
    """A trained model: where its files lie and the few numbers beside them."""

    def __init__(self, folder, order, bits, tokens, counts):
        self.folder, self.order, self.bits, self.tokens, self.counts = folder, order, bits, tokens, counts

    def save(self) -> None:
        """Write the numbers beside the files, as JSON."""
        state = {k: v for k, v in vars(self).items() if k not in ("folder", "counts")}
        state["counts"] = [list(map(float, c)) for c in self.counts]
        write_atomic(f"{self.folder}/model.json", lambda f: f.write(json.dumps(state).encode()))

    @staticmethod
    def load(folder: str) -> KneserNey:
        with open(f"{folder}/model.json") as f:
            s = json.load(f)
        return KneserNey(folder, s["order"], s["bits"], s["tokens"], [np.array(c) for c in s["counts"]])

    def vocabulary(self) -> Vocabulary:
        return Vocabulary(f"{self.folder}/vocab")

    def log10(self, flat: np.ndarray, at: np.ndarray, vocab: Vocabulary, entries: list[Entries]) -> np.ndarray:
        """log10 p of the tokens at ``at`` given what stands before them."""
        p = np.full(len(at), 1.0 / (vocab.size + 1))
        cut = [discounts(c) for c in self.counts]
        # the sums of the empty context; then, for each place, those of the (n - 1)-gram that ends before it
        s, back = self.counts[0][4], self.counts[0][5:8] @ cut[0]
        for n in range(1, self.order + 1):
            d, rest = cut[n - 1], cut[n] if n < self.order else None
            # count; as a context of the next order: sum, and what its discounts leave over
            weigh = lambda of, rest=rest: [of(0)] if rest is None else [of(0), of(1), sum(of(2 + k) * rest[k] for k in range(3))]
            bits = _order_bits(n, self.bits)
            keys = _gram_keys([flat[k : len(flat) - n + 1 + k] for k in range(n)], bits) if len(flat) >= n else np.zeros(0, np.uint64)
            found, place = entries[n - 1].values(keys, weigh, 1 if rest is None else 3)
            a = found[0][place[at - n + 1]]
            off = np.concatenate([[0.0], d])[np.minimum(a, 3).astype(np.int8)]
            with np.errstate(divide="ignore", invalid="ignore"):
                q = (np.maximum(a - off, 0) + back * p) / s
            p = np.where(s > 0, q, p)
            if rest is not None:
                s, back = found[1:, place[at - n]]
        return np.log10(p)


def train(docs: DataFrame, order: int = 3, text: str = "text") -> KneserNey:
    """Count a model of the texts of all rows.  Null texts count as empty: an
    end only.  Repeated rows count each time; other columns, whatever their
    names, are ignored.  An empty table gives a model of no words (all scores
    uniform).  Where a corpus has no n-gram counted 1, 2, 3 or 4 times, the
    usual discounts are undefined and 0.5, 1 and 1.5 stand for that order; others
    are kept between 0.05 and their count."""
    spark = docs.sparkSession
    folder = mapped_path(scratch(spark, "kneser-ney"))
    docs = docs.select(F.col(text).cast("string").alias("text"))
    bits = _bits(text_bytes(docs))
    word_bits = _order_bits(1, bits)
    words = _by_shard(docs.mapInArrow(_word_counts(word_bits), BLOCK), word_bits, word_bits)
    done = words.mapInArrow(_write_vocab(f"{folder}/vocab"), "shard int, words long, tokens long")
    most, size, tokens = done.agg(F.max("words"), F.sum("words"), F.sum("tokens")).first()
    unknown = (most or 0) << word_bits
    write_atomic(f"{folder}/vocab/sizes.json", lambda f: f.write(json.dumps({"bits": word_bits, "size": size or 0, "unknown": unknown}).encode()))
    start = unknown + 1
    rows = docs.mapInArrow(_count_grams(f"{folder}/vocab", order, _order_bits(order, bits)), BLOCK)
    for n in range(order, 0, -1):
        own, lower = _order_bits(n, bits), _order_bits(max(n - 1, 1), bits)
        rows = _by_shard(rows, own, _file_bits(own)).mapInArrow(_merge_order(f"{folder}/order{n}", n, own, lower, start), BLOCK)
    found = {n: np.zeros(8) for n in range(1, order + 1)}
    totals = rows.mapInArrow(_totals, ", ".join(f"{c} long" for c in _TOTAL)).groupBy("n").agg(*[F.sum(c) for c in _TOTAL[1:]])
    for r in totals.collect():  # one row an order
        found[r[0]] = np.array(r[1:], float)
    model = KneserNey(folder, order, bits, tokens or 0, [found[n] for n in range(1, order + 1)])
    model.save()
    return model


_loaded: dict[str, tuple] = {}


def _opened(folder: str):
    """The model's mapped files, opened once per worker."""
    if folder not in _loaded:
        _loaded.clear()
        m = KneserNey.load(folder)
        _loaded[folder] = (m, m.vocabulary(), [Entries(f"{folder}/order{n}", _order_bits(n, m.bits)) for n in range(1, m.order + 1)])
    return _loaded[folder]


SCORES = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]


def _score(folder: str, column: str):
    def run(batches):
        model, vocab, entries = _opened(folder)

        def scored(held, names):
            """Rows of chunks, their tokens looked up together."""
            ends = np.cumsum([0, *(len(flat) for _, flat, _, _ in held)])
            score = model.log10(np.concatenate([flat for _, flat, _, _ in held]),
                                np.concatenate([at + end for (_, _, at, _), end in zip(held, ends)]), vocab, entries)
            for columns, _, at, bound in held:
                own, score = score[: len(at)], score[len(at) :]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(sums(own, bound), pa.float64())], names)

        held, size = [], 0
        for batch in batches:
            others = batch.drop_columns([column])
            names = [*others.schema.names, *SCORES]
            for c in chunks(batch.column(column), fold=True):
                flat, at, count, bound = _sequence(c, vocab, model.order)
                base = np.log10((count + 1.0) / (model.tokens + vocab.size + 1.0))
                columns = [*others.slice(c.start, len(c)).columns, pa.array(np.diff(bound), pa.int64()), pa.array(sums(count > 0, bound), pa.int64()),
                           pa.array(np.full(len(c), model.tokens), pa.int64()), pa.array(sums(base, bound), pa.float64())]
                held.append((columns, flat, at, bound))
                size += len(at)
                if size > LOOKUP:
                    yield from scored(held, names)
                    held, size = [], 0
        if held:
            yield from scored(held, names)

    return tidy(run)


def score(docs: DataFrame, model: KneserNey, text: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every row with its tokens (the end is one), those
    seen in training, the training tokens, the add-one unigram score and the
    model's score, both log10 probabilities of the text.  A null text is an
    empty one: its end alone.  Perplexity: ``10 ** (-score / n_tokens)``.
    Repeated rows score alike, an empty table gives no rows, columns of ``docs``
    that are not kept do not matter, whatever their names."""
    column = fresh(keep, "text")
    rows = docs.select(*keep, F.col(text).cast("string").alias(column))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != column)
    return rows.mapInArrow(_score(model.folder, column), f"{kept}, n_tokens long, n_known long, train_tokens long, "
                           "base_score double, score double")
