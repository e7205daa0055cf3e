"""Operator 11: document fingerprints by one-permutation MinHash.

A text's set holds the 64-bit hashes of its word shingles (words
``[^\\x20\\x09-\\x0D]+`` in lower-case A-Z; a text with fewer words than a
shingle: all of them as one).  Each hash goes once into one of ``bins`` bins by
its high bits, and the bin keeps the least of the rest.  An empty bin takes the
value of a full one by optimal densification: a hash of (bin, attempt), the same
for all texts, names bins until one is full.  Of each bin the low ``bits`` bits
are packed into the fingerprint.  Bits of a filled bin come from its source's
value mixed with the bin's own number: two texts agree there whenever source
and value agree, and otherwise by chance in each bin on its own, so a text of a
single shingle does not pass for another by one lucky draw.

Two bins of unlike values agree by chance with probability ``2**-bits``; the
likeness of two fingerprints is the share of agreeing bins with that bias
taken out: ``(share - chance) / (1 - chance)``, not below 0.

Minima of parts of a text merge, so a text above ``PIECE`` bytes is read piece by
piece, each beginning with the last words of the piece before.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricefold.llm.shared import fresh, scratch, stage, text_bytes, tidy
from pricefold.llm.tokens import NON_SPACE, Chunk, chunks, combine, mix, owner, windows

BINS, BITS, WIDTH = 512, 4, 5
PIECE = 1 << 20
#: Bytes of text of a range of ids; one task sorts and fingerprints it.
RANGE_BYTES = 16 << 20
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _shingles(c: Chunk, width: int, short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all shingles of a chunk, the text of each, and the texts' word
    counts; ``short``: a text of fewer words gives one shingle of them all."""
    s, e, first = c.spans(NON_SPACE)
    words = c.hashes(s, e)
    hashes, at = windows(words, first, width)
    text = owner(first)[at]
    n = np.diff(first)
    if short:
        for w in range(1, width):
            few = np.flatnonzero(n == w)
            if len(few):
                h = words[first[few]]
                for k in range(1, w):
                    h = combine(h, words[first[few] + k])
                hashes, text = np.concatenate([hashes, h]), np.concatenate([text, few])
    return hashes, text, n


def _minima(hashes: np.ndarray, text: np.ndarray, n: int, bins: int) -> np.ndarray:
    """The least remaining hash of each text's bins (n x bins); ``_NONE``: empty."""
    least = np.full(n * bins, _NONE)
    shift = np.uint64(64 - (bins.bit_length() - 1))
    np.minimum.at(least, text * bins + (hashes >> shift).astype(np.int64), hashes & ((np.uint64(1) << shift) - np.uint64(1)))
    return least.reshape(n, bins)


#: Attempts beyond which a bin takes the first full one, and those made for all bins at once.
_ATTEMPTS, _TOGETHER = 16, 24
_orders: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _order(bins: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin that every bin asks at each attempt, and for each pair of bins
    the attempt at which the first one asks the second."""
    if bins not in _orders:
        keys = np.arange(_ATTEMPTS * bins * bins, dtype=np.uint64).reshape(-1, bins)
        asks = (mix(keys + np.uint64(1)) % np.uint64(bins)).astype(np.int32)
        first = np.tile(np.arange(bins, dtype=np.int32) + len(asks), (bins, 1))
        for attempt in range(len(asks) - 1, -1, -1):
            first[np.arange(bins), asks[attempt]] = attempt
        _orders[bins] = asks[:_TOGETHER].copy(), first
    return _orders[bins]


def densify(least: np.ndarray) -> np.ndarray:
    """Values of all bins: empty ones take those of full ones, the first that
    their attempts name.  Rows without any full bin are left alone."""
    bins = least.shape[1]
    asks, first = _order(bins)
    empty = least == _NONE
    salt = mix(np.arange(1, bins + 1, dtype=np.uint64))
    out = least.copy()
    rows, cols = np.nonzero(empty & ~empty.all(axis=1)[:, None])
    for attempt in range(_TOGETHER):
        got = least[rows, asks[attempt][cols]]
        full = got != _NONE
        out[rows[full], cols[full]] = mix(got[full] ^ salt[cols[full]])
        rows, cols = rows[~full], cols[~full]
    edges = np.flatnonzero(np.diff(rows, prepend=-1))
    for a, b in zip(edges, [*edges[1:], len(rows)]):  # sparse rows: few full bins to choose from
        row, mine = rows[a], cols[a:b]
        held = np.flatnonzero(~empty[row])
        source = held[first[np.ix_(mine, held)].argmin(axis=1)]
        out[row, mine] = mix(least[row, source] ^ salt[mine])
    return out


def pack(values: np.ndarray, bits: int) -> list[bytes]:
    """The low ``bits`` bits of each value, in order, packed per row; empty for
    a text without words."""
    planes = ((values[:, :, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    rows = np.packbits(planes.reshape(len(values), -1), axis=1)
    none = (values == _NONE).all(axis=1)
    return [b"" if no else r.tobytes() for r, no in zip(rows, none)]


def _unpacked(blobs: list[bytes], bins: int, bits: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(blobs), np.uint8).reshape(len(blobs), -1)
    return np.unpackbits(raw, axis=1).reshape(len(blobs), bins, bits)


def likeness(a: list[bytes], b: list[bytes], bins: int = BINS, bits: int = BITS) -> np.ndarray:
    """Estimated Jaccard similarity of the sets behind pairs of fingerprints,
    0 to 1.  Two texts without words are alike (1), one of them is not (0)."""
    out = np.array([float(x == y) for x, y in zip(a, b)])
    both = [i for i, (x, y) in enumerate(zip(a, b)) if x and y]
    if both:
        agree = (_unpacked([a[i] for i in both], bins, bits) == _unpacked([b[i] for i in both], bins, bits)).all(axis=2)
        chance = 2.0 ** -bits
        out[both] = np.clip((agree.mean(axis=1) - chance) / (1 - chance), 0.0, 1.0)
    return out


_SPACE = re.compile(rb"[\x09-\x0D\x20]")


def _pieces(raw: bytes, width: int) -> Iterator[tuple[bytes, int]]:
    """Parts of a long text cut at separators, each after the last ``width - 1``
    words of what came before, and the number of those words."""
    carry, at, keep = [], 0, width - 1
    while at < len(raw):
        cut = _SPACE.search(raw, at + PIECE)
        end = cut.start() if cut else len(raw)
        part = raw[at:end]
        yield b" ".join([*carry, part]), len(carry)
        carry = (carry + part.rsplit(None, keep)[-keep:])[-keep:] if keep else []
        at = end


def _long_minima(raw: bytes, bins: int, width: int) -> np.ndarray:
    least, seen = np.full((1, bins), _NONE), 0
    for part, carried in _pieces(raw, width):
        for c in chunks(pa.array([part.decode("utf-8")], pa.large_string()), fold=True):
            hashes, text, n = _shingles(c, width, short=False)
            seen += int(n[0]) - carried
            least = np.minimum(least, _minima(hashes, text, 1, bins))
    if seen < width:  # few and very long words
        for c in chunks(pa.array([raw.decode("utf-8")], pa.large_string()), fold=True):
            hashes, text, _ = _shingles(c, width)
            least = _minima(hashes, text, 1, bins)
    return least


def _sketch_chunk(c: Chunk, raw: bytes | None, bins: int, bits: int, width: int) -> list[bytes]:
    if raw is not None:
        least = _long_minima(raw, bins, width)
    else:
        hashes, text, _ = _shingles(c, width)
        least = _minima(hashes, text, len(c), bins)
    return pack(densify(least), bits)


def sketches(texts: list[str], bins: int = BINS, bits: int = BITS, width: int = WIDTH) -> list[bytes]:
    """Packed fingerprints of texts, in order."""
    out: list[bytes] = []
    for c in chunks(pa.array(texts, pa.large_string()), limit=PIECE // 4, fold=True):
        one = len(c) == 1 and len(c.data) > PIECE
        out += _sketch_chunk(c, texts[c.start].encode("utf-8") if one else None, bins, bits, width)
    return out


def _check(bins: int, bits: int) -> None:
    if bins & (bins - 1) or not 8 <= bins <= 1 << 16 or not 1 <= bits <= 32 or bins * bits % 8:
        raise ValueError("bins: a power of two from 8 to 65536; bits: 1 to 32; whole bytes together")


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint", bins: int = BINS, bits: int = BITS,
                 width: int = WIDTH) -> DataFrame:
    """``docs`` with the packed fingerprint (binary) of each whole text in a new
    column ``out`` (or a variant that clashes with no column).  One pass, no shuffle.

    A null, empty or wordless text has an empty fingerprint; repeated rows have
    equal ones; all columns stay; texts above 1 MB are read piece by piece; an
    empty table gives no rows.
    """
    _check(bins, bits)
    scratch(docs.sparkSession, "fingerprints")
    schema = T.StructType([*docs.schema.fields, T.StructField(fresh(docs.columns, out), T.BinaryType())])

    @tidy
    def run(batches):
        for batch in batches:
            blobs = sketches([t or "" for t in batch.column(text).to_pylist()], bins, bits, width)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(blobs, pa.binary())], schema.names)

    return docs.mapInArrow(run, schema)


def edited(text: str, following: str) -> str:
    """``text`` with its last third (rounded down, in code points) replaced by as
    many first ones of ``following``, or all it has."""
    n = len(text)
    return text[: n - n // 3] + following[: n // 3]


_ROW = [("n_chars", T.LongType()), ("edited_sha256", T.StringType()), ("fingerprint", T.BinaryType()),
        ("edited_fingerprint", T.BinaryType()), ("near_edited", T.DoubleType()), ("near_next", T.DoubleType())]


def _result(ids: pa.Array, texts: list[str], follow: list[str], own: list[bytes], after: list[bytes], how) -> list[pa.Array]:
    changed = [edited(a, b) for a, b in zip(texts, follow)]
    other = sketches(changed, *how)
    return [ids, pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in changed], pa.string()),
            pa.array(own, pa.binary()), pa.array(other, pa.binary()),
            pa.array(likeness(own, other, *how[:2]), pa.float64()), pa.array(likeness(own, after, *how[:2]), pa.float64())]


def neighbours(docs: DataFrame, bins: int = BINS, bits: int = BITS, width: int = WIDTH, id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """Per document: ``id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint`` (binary), ``near_edited``, ``near_next``: likeness to its
    edited text and to the next document, ids descending (after the last: the first).

    One shuffle: rows are dealt to ranges of ids and sorted, and a task sees each
    row's successor but for its last row.  The first and the last row of every
    range are set aside and joined, two texts a range.

    Null ids come last; equal ids follow by text hash, so a hot id is split over
    ranges; equal rows may stand for one another.  Null text: empty.  A single
    document follows itself; an empty table gives no rows.  Texts above 1 MB are
    read piece by piece.  Other columns, whatever their names, are ignored.
    """
    _check(bins, bits)
    how = (bins, bits, width)
    spark = docs.sparkSession
    folder = scratch(spark, "neighbours")
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ranges = max(spark.sparkContext.defaultParallelism, -(-text_bytes(docs, text) // RANGE_BYTES))
    order = [F.col("id").desc_nulls_last(), F.col("tie"), F.col("text")]
    dealt = rows.repartitionByRange(ranges, *order[:2]).sortWithinPartitions(*order).select("id", "text")
    id_type = docs.schema[id].dataType
    schema = T.StructType([T.StructField("id", id_type), *(T.StructField(n, t) for n, t in _ROW),
                           T.StructField("range", T.IntegerType()), T.StructField("first", T.BooleanType()),
                           T.StructField("text", T.StringType())])

    @tidy
    def run(batches):
        part = TaskContext.get().partitionId()
        held = None  # the last row so far: its id, text and fingerprint

        def edge(ids, texts, own, first):
            n = len(texts)
            return pa.RecordBatch.from_arrays(
                [ids, pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), pa.array(own, pa.binary()), pa.nulls(n, pa.binary()),
                 pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64()), pa.array([part] * n, pa.int32()),
                 pa.array([first] * n, pa.bool_()), pa.array(texts, pa.string())], schema.names)

        for batch in batches:
            if not batch.num_rows:
                continue
            ids, texts = batch.column("id"), batch.column("text").to_pylist()
            own = sketches(texts, *how)
            if held is None:
                yield edge(ids.slice(0, 1), texts[:1], own[:1], True)
            else:
                ids, texts, own = pa.concat_arrays([held[0], ids]), [held[1], *texts], [held[2], *own]
            last = len(texts) - 1
            if last:
                done = _result(ids.slice(0, last), texts[:-1], texts[1:], own[:-1], own[1:], how)
                yield pa.RecordBatch.from_arrays(
                    [*done, pa.nulls(last, pa.int32()), pa.nulls(last, pa.bool_()), pa.nulls(last, pa.string())], schema.names)
            held = (ids.slice(last, 1), texts[-1], own[-1])
        if held is not None:
            yield edge(held[0], [held[1]], [held[2]], False)

    found = stage(dealt.mapInArrow(run, schema), folder, "found")
    done = found.where(F.col("range").isNull()).select("id", *(n for n, _ in _ROW))
    edges = found.where(F.col("range").isNotNull())
    used = sorted(r.range for r in edges.where("first").select("range").collect())  # one number a range
    if not used:
        return done.withColumnRenamed("id", id)
    links = spark.createDataFrame(list(zip(used, used[1:] + used[:1])), "range int, next int")
    tails = edges.where(~F.col("first")).select("id", "text", "fingerprint", "range").join(links, "range")
    heads = edges.where("first").select(F.col("range").alias("next"), F.col("text").alias("follow"),
                                        F.col("fingerprint").alias("after"))
    rest_schema = T.StructType(schema.fields[: 1 + len(_ROW)])

    @tidy
    def close(batches):
        for batch in batches:
            if batch.num_rows:
                get = lambda c: batch.column(c).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    _result(batch.column("id"), get("text"), get("follow"), get("fingerprint"), get("after"), how),
                    rest_schema.names)

    joined = tails.join(heads, "next").select("id", "text", "fingerprint", "follow", "after")
    return done.unionByName(joined.mapInArrow(close, rest_schema)).withColumnRenamed("id", id)


def as_text(fingerprint: str | Column) -> Column:
    """A packed fingerprint as base64 without line breaks."""
    return F.replace(F.replace(F.base64(fingerprint), F.lit("\r"), F.lit("")), F.lit("\n"), F.lit(""))


def from_text(fingerprint: str) -> bytes:
    return base64.b64decode(fingerprint)
