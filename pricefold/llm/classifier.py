"""Operator 7: quality classifier of learned subword embeddings.

A text is the average of the vectors of its words and of its 2 to 4 character
n-grams, each hashed to one of ``2**BITS`` vectors; a softmax over the average
gives the label.  Vectors and output weights are learned together by plain
stochastic gradient descent in numpy, one text per step.

The model is fitted on a bounded sample of labelled rows: at most ``MAX_ROWS``
of them and ``MAX_BYTES`` of text, drawn by a hash of doc_id.  Texts of more
than ``LONG`` bytes share a quarter of these bytes first, then take what the
others leave, shortest first, so none keeps the rest of the sample out; a text
longer than ``MAX_BYTES`` itself is not learned from.  Tasks turn the
sample into sparse counts; only those reach the driver.  Scoring reads every
text whole: since output follows average, each vector enters by one number, so
a text costs one table lookup per word and n-gram.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pricefold.llm.shared import drawn, fresh, scratch, stage, tidy
from pricefold.llm.tokens import BYTES, NON_SPACE, Chunk, chunks, mix, sums

BITS, DIM, GRAMS = 17, 8, (2, 3, 4)
MAX_ROWS, MAX_BYTES, LONG = 4000, 12 << 20, 12 << 14
EPOCHS, RATE = 12, 2.0
THRESHOLD = 0.3

_FACTOR = mix(np.arange(11, 21, dtype=np.uint64)) | np.uint64(1)
_HEAD = (BYTES & 0xC0) != 0x80  # first byte of a code point


def _bucket(residue: np.ndarray, size: int) -> np.ndarray:
    """Multiply-shift with a factor for each kind of feature."""
    with np.errstate(over="ignore"):
        return ((residue * _FACTOR[size]) >> np.uint64(64 - BITS)).astype(np.int32)


def buckets(c: Chunk) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For words and each n-gram size: bucket of every feature, and the index
    of each text's first one (n + 1 values)."""
    s, e, first = c.spans(NON_SPACE)
    found, firsts = [_bucket(c.residues(s, e), 1)], [first]
    heads = np.flatnonzero(_HEAD[c.data])
    bound = np.searchsorted(heads, c.off)  # code points before each text
    ends = np.append(heads, len(c.data))
    for n in GRAMS:
        count = np.maximum(np.diff(bound) - n + 1, 0)
        at = np.cumsum(np.append(0, count))
        g = np.arange(at[-1]) + np.repeat(bound[:-1] - at[:-1], count)
        found.append(_bucket(c.residues(ends[g], ends[g + n]), n))
        firsts.append(at)
    return found, firsts


@tidy
def _sparse(batches):
    """Sample texts -> distinct buckets and counts, as bytes."""
    for batch in batches:
        for c in chunks(batch.column("text")):
            found, firsts = buckets(c)
            idx, cnt = [], []
            for i in range(len(c)):
                u, n = np.unique(np.concatenate([f[a[i] : a[i + 1]] for f, a in zip(found, firsts)]), return_counts=True)
                idx.append(u.astype(np.int32).tobytes())
                cnt.append(n.astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").slice(c.start, len(c)), batch.column("rank").slice(c.start, len(c)),
                 pa.array(idx, pa.binary()), pa.array(cnt, pa.binary())], ["label", "rank", "idx", "cnt"])


class SubwordModel:
    """``weight`` of each bucket (its vector times the output weights) and bias:
    the log odds of label 1 are the average weight plus the bias."""

    def __init__(self, weight: np.ndarray, bias: float):
        self.weight, self.bias = weight, bias

    @staticmethod
    def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = RATE,
            seed: int = 1) -> SubwordModel:
        """``rows``: label 0 or 1, buckets and their counts, of each text."""
        rng = np.random.default_rng(seed)
        vectors = rng.uniform(-1.0 / DIM, 1.0 / DIM, (1 << BITS, DIM)).astype(np.float32)
        out = np.zeros((2, DIM), np.float32)
        bias = np.zeros(2, np.float32)
        share = [n.astype(np.float32) / max(n.sum(), 1) for _, _, n in rows]
        steps, done = epochs * max(len(rows), 1), 0
        for _ in range(epochs):
            for i in rng.permutation(len(rows)):
                label, idx, _ = rows[i]
                lr = rate * (1 - done / steps)
                done += 1
                mean = share[i] @ vectors[idx]
                logit = out @ mean + bias
                p = np.exp(logit - logit.max())
                p /= p.sum()
                p[label] -= 1
                back = p @ out
                out -= lr * p[:, None] * mean
                bias -= 0.1 * lr * p
                # a text's buckets are distinct; the common factor of an average is left to the rate
                vectors[idx] -= (lr * len(idx) ** 0.5) * share[i][:, None] * back
        return SubwordModel((vectors @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0]))

    def score(self, c: Chunk) -> np.ndarray:
        """Probability of label 1 for each text of a chunk."""
        total, count = np.zeros(len(c)), np.zeros(len(c), np.int64)
        for f, a in zip(*buckets(c)):
            total += sums(self.weight[f].astype(np.float64), a)
            count += np.diff(a)
        logit = total / np.maximum(count, 1) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(logit, -50, 50)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", doc_id: str = "doc_id") -> SubwordModel:
    """Learn ``label`` (0 or 1) from the labelled rows of ``docs``.

    Rows with a null doc_id, label or text are not learned from; a doc_id with
    both labels counts for both, one with several texts for each, and one that
    repeats a text for one; without any row all scores are 1/2.  Texts of more
    than ``MAX_BYTES`` are passed over.  Other columns are not looked at.
    """
    folder = scratch(docs.sparkSession, "classifier")
    marks = (labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
             .where("id is not null and label in (0, 1)").distinct())
    body = F.col(text).cast("string")
    sizes = docs.select(F.col(doc_id).alias("id"), F.xxhash64(body).alias("text_hash"), F.octet_length(body).cast("long").alias("size"))
    # a text that an id holds many times is one candidate
    known = (sizes.where("size is not null").groupBy("id", "text_hash").agg(F.max("size").alias("size")).join(marks, "id")
             .select("id", "text_hash", "label", "size", F.xxhash64("id", "text_hash", "label").alias("h")))
    sample = drawn(stage(known.where(F.col("size") <= MAX_BYTES), folder, "known"), "h", MAX_ROWS)
    # over MAX_ROWS rows at most: long texts up to a quarter of the bytes, the others, the remaining long ones
    long = F.when(F.col("size") > LONG, F.col("size"))
    quarter = F.sum(long).over(W.orderBy(long.asc_nulls_last(), "h").rowsBetween(W.unboundedPreceding, 0)) <= MAX_BYTES // 4
    turn = F.when(long.isNull(), 1).when(quarter, 0).otherwise(2)
    order = W.orderBy("turn", long.asc_nulls_last(), "h").rowsBetween(W.unboundedPreceding, 0)
    sample = sample.withColumn("turn", turn).withColumn("bytes", F.sum("size").over(order)).where(F.col("bytes") <= MAX_BYTES)
    sample = stage(sample.withColumn("rank", F.row_number().over(W.orderBy("h"))).select("id", "text_hash", "label", "rank"), folder, "sample")
    held = docs.select(F.col(doc_id).alias("id"), F.xxhash64(body).alias("text_hash"), body.alias("text"))
    # at most MAX_ROWS sampled rows; of repeated ones the map side passes on one
    rows = (held.join(F.broadcast(sample), ["id", "text_hash"]).groupBy("rank").agg(F.first("label").alias("label"), F.first("text").alias("text"))
            .mapInArrow(_sparse, "label int, rank int, idx binary, cnt binary").collect())
    rows.sort(key=lambda r: (r["rank"], r["idx"]))
    return SubwordModel.fit([(r["label"], np.frombuffer(r["idx"], np.int32), np.frombuffer(r["cnt"], np.int32)) for r in rows])


def _scored(held, column: str, names: list[str]):
    def run(batches):
        model = held.value
        for batch in batches:
            for c in chunks(batch.column(column)):
                part = batch.slice(c.start, len(c)).drop_columns([column])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.score(c), pa.float64())], names)

    return tidy(run)


def score(docs: DataFrame, model: SubwordModel, text: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every row and ``score``, the probability of label 1.
    Null texts count as empty ones, which get the bias alone.  Repeated rows
    score alike, an empty table gives no rows, columns that are not kept do not
    matter, whatever their names, and a long text is scored whole."""
    column, names = fresh(keep, "text"), [*keep, "score"]
    rows = docs.select(*keep, F.col(text).cast("string").alias(column))
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name != column)
    held = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS numbers
    return rows.mapInArrow(_scored(held, column, names), kept + "score double")


def _accepted(held, column: str, threshold: float):
    def run(batches):
        model = held.value
        for batch in batches:
            keep = [model.score(c) >= threshold for c in chunks(batch.column(column).cast(pa.string()))]
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return tidy(run)


def accept(docs: DataFrame, model: SubwordModel, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of ``threshold`` or more, all columns
    as they are, whatever their names.  Null and empty texts have the bias's
    score; repeated rows stay or go together; an empty table gives no rows."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_accepted(held, text, threshold), docs.schema)
