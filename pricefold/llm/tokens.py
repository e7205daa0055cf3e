"""Words of Arrow text columns as numpy arrays.

A batch's texts are cut into chunks of about ``CHUNK`` bytes of whole texts;
a longer text is a chunk of its own, so memory follows the longest text, not
the batch.  Words are found on the UTF-8 bytes: every separator is ASCII, and
ASCII bytes stand for nothing else in UTF-8.

Any span of a chunk has a 64-bit hash in constant time: prefix sums of
``TABLE[byte] * P**position`` modulo 2**64, divided by ``P**start`` and mixed.
Equal spans have equal hashes; unequal ones collide as random 64-bit numbers
do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20

_P = 0x9E3779B97F4A7C15
_PINV = pow(_P, -1, 1 << 64)
_U = np.uint64

BYTES = np.arange(256)
LOWER = np.where((BYTES >= 65) & (BYTES <= 90), BYTES + 32, BYTES).astype(np.uint8)
# [^\x20\x09-\x0D]+
NON_SPACE = ~((BYTES == 32) | ((BYTES >= 9) & (BYTES <= 13)))
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
ALNUM = ((BYTES >= 48) & (BYTES <= 57)) | ((BYTES >= 97) & (BYTES <= 122)) | (BYTES >= 128)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on all bits."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> _U(30)
        x *= _U(0xBF58476D1CE4E5B9)
        x ^= x >> _U(27)
        x *= _U(0x94D049BB133111EB)
        x ^= x >> _U(31)
    return x


def combine(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of a sequence from the hash of its head and of its next item."""
    with np.errstate(over="ignore"):
        return mix(first * _U(0xD6E8FEB86659FD93) + second + _U(0x2545F4914F6CDD1D))


_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x632BE59BD9B4E019 & (2**63 - 1))) | _U(1)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, CHUNK + 1), _U(base))
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= 4 * CHUNK:  # a very long text's table is not kept
            _powers[base] = have
    return have[:n]


class Chunk:
    """Whole texts of rows ``start`` to ``stop`` of a batch: ``data`` holds
    their bytes, text i is ``data[off[i]:off[i + 1]]``."""

    def __init__(self, start: int, stop: int, data: np.ndarray, off: np.ndarray, fold: bool = False):
        self.start, self.stop, self.off = start, stop, off
        self.data = LOWER[data] if fold else data
        self._sums = None

    def __len__(self) -> int:
        return self.stop - self.start

    def spans(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the longest runs of ``member`` bytes within each
        text, and for every text the index of its first run (n + 1 values)."""
        inside = member[self.data]
        begin, end = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        edge = self.off[:-1][np.diff(self.off) > 0]
        begin[edge] = inside[edge]
        last = self.off[1:][np.diff(self.off) > 0] - 1
        end[last] = inside[last]
        s, e = np.flatnonzero(begin), np.flatnonzero(end) + 1
        return s, e, np.searchsorted(s, self.off)

    def residues(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Hash of each span ``data[s:e]`` before mixing: its high bits are
        the better ones."""
        n = len(self.data)
        with np.errstate(over="ignore"):
            if self._sums is None:
                self._sums = np.zeros(n + 1, np.uint64)
                np.cumsum(_TABLE[self.data] * _power(_P, n), out=self._sums[1:])
            return (self._sums[e] - self._sums[s]) * _power(_PINV, n + 1)[s]

    def hashes(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """64-bit hash of each span ``data[s:e]``."""
        return mix(self.residues(s, e))


def chunks(texts: pa.Array, limit: int = CHUNK, fold: bool = False) -> Iterator[Chunk]:
    """Cut a string array into chunks; a null text counts as an empty one."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_string())
    n = len(texts)
    if not n:
        return
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        b = min(b, n)
        yield Chunk(a, b, data[off[a] : off[b]], off[a : b + 1] - off[a], fold)
        a = b


def owner(first: np.ndarray) -> np.ndarray:
    """For each span the index of its text, from ``Chunk.spans``' third value."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def windows(values: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``width`` consecutive values within each text, and the
    position of each window's first value."""
    total = len(values)
    if total < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = values[: total - width + 1]
    for k in range(1, width):
        h = combine(h, values[k : total - width + 1 + k])
    text = owner(first)
    ok = np.flatnonzero(text[: total - width + 1] == text[width - 1 :])
    return h[ok], ok


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of each text's values; 0 for a text without any."""
    run = np.zeros(len(values) + 1, np.result_type(values.dtype, np.int64))
    np.cumsum(values, out=run[1:])
    return run[first[1:]] - run[first[:-1]]


def binaries(blobs: list[bytes]) -> pa.Array:
    return pa.array(blobs, pa.binary())


def lists(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    """List column: row i holds ``values[first[i]:first[i + 1]]``."""
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values, kind))
