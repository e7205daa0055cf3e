"""Operator 8: quality rules, judged by an isolation forest.

Rule statistics are counted exactly per text.  The forest isolates points of
their log-scaled ratios by random splits: an anomalous text is alone after few
splits.  Its threshold comes from the labelled rows: the score above which no
more than ``MAX_LOSS`` of the rows labelled good are rejected.

The forest is fitted on a bounded sample of ``FIT_ROWS`` rows drawn by a hash,
of which each tree takes ``SAMPLE``; statistics, labels and verdicts cover all
rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricefold.llm.shared import drawn, scratch, stage, tidy
from pricefold.llm.tokens import BYTES, NON_SPACE, Chunk, chunks, owner, sums, windows

TREES, SAMPLE, FIT_ROWS = 100, 256, 6400
#: Share of the rows labelled good that the threshold may reject.
MAX_LOSS = 0.02
#: Scores of 0 to 1 are counted in so many equal steps to find the threshold.
STEPS = 1000

# The characters that count as symbols
SYMBOLS = "#*$%&|<>"

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: What the forest sees beside them: extents that its ratios need.
EXTRA = ["n_lines", "n_upper", "n_distinct"]

_SYMBOL = np.isin(BYTES, [ord(c) for c in SYMBOLS])
_HEAD = (BYTES & 0xC0) != 0x80  # first byte of a code point
_LINE = BYTES != 10
_UPPER = (BYTES >= 65) & (BYTES <= 90)


def _firsts(text: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (text, value, position) and where a new (text, value) begins."""
    order = np.lexsort((value, text))
    t, v = text[order], value[order]
    new = np.ones(len(order), bool)
    new[1:] = (t[1:] != t[:-1]) | (v[1:] != v[:-1])
    return order, new


def statistics(c: Chunk) -> dict[str, np.ndarray]:
    """Each text's counts; see ``rule_statistics``."""
    s, e, first = c.spans(NON_SPACE)
    text, h = owner(first), c.hashes(s, e)
    heads = np.zeros(len(c.data) + 1, np.int64)
    np.cumsum(_HEAD[c.data], out=heads[1:])
    per_text = lambda member: sums(member[c.data], c.off)

    repeated = np.zeros(len(h) + 1, np.int64)
    w, at = windows(h, first, 3)
    order, new = _firsts(text[at], w)
    group = np.cumsum(new) - 1
    often = at[order][np.bincount(group, minlength=1)[group] > 1] if len(at) else at
    np.add.at(repeated, often, 1)
    np.add.at(repeated, often + 3, -1)
    repeated = np.cumsum(repeated[:-1]) > 0

    order, new = _firsts(text, h)
    distinct = np.zeros(len(h), bool)
    distinct[order[new]] = True

    # lines with a word: equal ones of a text, but for the first
    a, b, lines = c.spans(_LINE)
    worded = np.searchsorted(s, b) > np.searchsorted(s, a)
    a, b, of = a[worded], b[worded], owner(lines)[worded]
    order, new = _firsts(of, c.hashes(a, b))
    n = len(c)
    return {"n_words": np.diff(first), "word_chars": sums(heads[e] - heads[s], first), "n_symbols": per_text(_SYMBOL),
            "n_dup_lines": np.bincount(of[order[~new]], minlength=n), "n_repeat_words": sums(repeated, first),
            "n_lines": np.bincount(of, minlength=n), "n_upper": per_text(_UPPER), "n_distinct": sums(distinct, first)}


@tidy
def _statistics(batches):
    for batch in batches:
        for c in chunks(batch.column("text")):
            got = statistics(c)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(c.start, len(c)), *(pa.array(got[k], pa.int64()) for k in BASE + EXTRA)],
                ["doc_id", *BASE, *EXTRA])


def rule_statistics(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id`` and counts of every row.  Words are runs of other than ASCII
    white space; a null or empty text counts 0 throughout.

    - word_chars: code points in words;  n_symbols: ``#*$%&|<>``
    - n_dup_lines: lines (cut at ``\\n``) with a word that equal an earlier line
    - n_repeat_words: words in 3-word windows found twice or more in the text
    - n_lines with a word, n_upper letters A-Z, n_distinct words
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_statistics, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, "
                           + ", ".join(f"{k} long" for k in BASE + EXTRA))


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """What the forest splits: ratios of the counts, free of a text's length."""
    words = np.maximum(s["n_words"], 1).astype(float)
    chars = np.maximum(s["word_chars"], 1).astype(float)
    return np.stack([s["word_chars"] / words, s["n_symbols"] / chars, s["n_dup_lines"] / np.maximum(s["n_lines"], 1),
                     s["n_repeat_words"] / words, s["n_upper"] / chars, s["n_distinct"] / words * np.log1p(words)], axis=1)


def _usual_path(n: float) -> float:
    """Average path length of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    return 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n if n > 2 else 1.0


class IsolationForest:
    """Trees as flat arrays: split feature (-1: leaf), split value, left child
    (the right one follows it), and a leaf's path length."""

    def __init__(self, points: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = 7):
        self.trees = []
        self.size = min(sample, max(len(points), 1))
        limit = int(np.ceil(np.log2(max(self.size, 2))))
        for t in range(trees):
            rng = np.random.default_rng([seed, t])
            part = points[rng.permutation(len(points))[: self.size]]
            self.trees.append(self._grow(part, limit, rng))

    @staticmethod
    def _grow(points: np.ndarray, limit: int, rng) -> tuple[np.ndarray, ...]:
        feature, value, left, path = [-1], [0.0], [0], [0.0]
        open_ = [(0, points, 0)]
        while open_:
            node, x, depth = open_.pop()
            spread = np.ptp(x, axis=0) if len(x) else np.zeros(points.shape[1])
            if depth >= limit or len(x) <= 1 or not spread.any():
                path[node] = depth + _usual_path(len(x))
                continue
            f = int(rng.choice(np.flatnonzero(spread)))
            cut = float(rng.uniform(x[:, f].min(), x[:, f].max()))
            feature[node], value[node], left[node] = f, cut, len(feature)
            for side in (x[x[:, f] <= cut], x[x[:, f] > cut]):
                open_.append((len(feature), side, depth + 1))
                feature.append(-1)
                value.append(0.0)
                left.append(0)
                path.append(0.0)
        return np.array(feature), np.array(value), np.array(left), np.array(path)

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / usual path): near 1 for points soon alone."""
        total = np.zeros(len(x))
        for feature, value, left, path in self.trees:
            node = np.zeros(len(x), np.int64)
            go = np.flatnonzero(feature[node] >= 0)
            while len(go):
                f = feature[node[go]]
                node[go] = left[node[go]] + (x[go, f] > value[node[go]])
                go = go[feature[node[go]] >= 0]
            total += path[node]
        return np.exp2(-total / len(self.trees) / max(_usual_path(self.size), 1e-9))


def _base_failed():
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _scored(held, names: list[str]):
    def run(batches):
        forest = held.value
        for batch in batches:
            if batch.num_rows:
                x = features({k: batch.column(k).to_numpy() for k in BASE + EXTRA})
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(forest.score(x))], [*names, "anomaly"])

    return tidy(run)


def quality_verdicts(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
                     label: str = "quality") -> DataFrame:
    """``doc_id``, the base counts, base_failed, the anomaly score and kept.

    base_failed: fewer than 50 words, or over half of them repeated.  Of the
    others the forest rejects those above the threshold.  The labelled rows
    that pass the base rules calibrate it; without both labels, all are kept.
    Null doc_ids have no label; repeated rows are judged alike; an empty table
    gives no rows.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "rules")
    stats = stage(rule_statistics(docs, text, doc_id), folder, "statistics").withColumn("base_failed", _base_failed())
    # the base rules have judged the failed ones; the forest is of the rest
    passed = stats.where(~F.col("base_failed"))
    rows = drawn(passed.withColumn("h", F.xxhash64("doc_id", *BASE)), "h", FIT_ROWS).select("h", *BASE, *EXTRA)
    seen = stage(rows, folder, "seen").toPandas().sort_values(["h", *BASE, *EXTRA])
    forest = IsolationForest(features({k: seen[k].to_numpy() for k in BASE + EXTRA}))
    held = spark.sparkContext.broadcast(forest)
    scored = stage(stats.mapInArrow(_scored(held, stats.columns), ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in stats.schema) + ", anomaly double"), folder, "scored")
    marks = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label")).where("label in (0, 1)")
    steps = (marks.distinct().join(scored.where(~F.col("base_failed")), "doc_id")
             .groupBy("label", F.floor(F.col("anomaly") * STEPS).alias("step")).agg(F.count(F.lit(1)).alias("n")).collect())
    limit = threshold([{r["step"]: r["n"] for r in steps if r["label"] == k} for k in (0, 1)])
    return scored.select("doc_id", *BASE, "base_failed", "anomaly", F.lit(limit).alias("threshold"),
                         (~F.col("base_failed") & (F.col("anomaly") < limit)).alias("kept"))


def threshold(counts: list[dict[int, int]]) -> float:
    """The threshold, from rows labelled 0 and 1 counted by score step; 2.0
    (nothing is rejected) if either label is missing."""
    bad, good = (np.array([c.get(k, 0) for k in range(STEPS + 1)], float) for c in counts)
    if not bad.sum() or not good.sum():
        return 2.0
    caught, lost = (np.cumsum(x[::-1])[::-1] / x.sum() for x in (bad, good))
    gain = np.where(lost <= MAX_LOSS, caught - lost, -1.0)
    best = int(np.argmax(gain))
    return best / STEPS if gain[best] > 0 else 2.0
