"""Operator 13: centroid clustering by a bisector tournament.

A vector component ``x`` becomes the integer ``floor(scale * x)`` and all
arithmetic from there on is exact.  For two centroids ``a < b`` the vector
``v`` is nearer to ``b`` iff ``2 (b - a) . v > |b|^2 - |a|^2``: the pair's normal
and threshold are integers that are computed once a round.  A vector passes
``k - 1`` of these sign tests; the loser of each is out, and a zero favours the
smaller number.  Only the winner's distance is computed.

The sums of a test are exact whatever their order: in doubles as long as no
partial sum can reach 2**53, in 64-bit integers below 2**62, and in Python
integers above.

A round is one pass over the vectors.  Tasks add up their vectors per cluster
(k rows each), Spark adds those up, and the driver sees k rows a round,
whatever the number of vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricefold.llm.shared import fresh, scratch, stage, tidy

#: Integers of a staged vector: little-endian 64-bit.  Larger ones do not fit a ``long`` distance either.
_INT = np.dtype("<i8")
_LARGE = 1 << 62
_LONG = (1 << 63) - 1


def kept_vectors(vectors: DataFrame, dims: int = 64, scale: int = 1024, vec: str = "embedding", id: str = "vec_id") -> DataFrame:
    """``id`` and ``v`` (packed 64-bit integers ``floor(scale * x)``) of the rows
    whose vector has exactly ``dims`` components, none null, NaN or infinite;
    other rows are dropped.  Null ids stay.  An integer beyond 2**62 in size
    is set to that bound (a squared distance of half that many bits overflows
    a long already)."""
    schema = T.StructType([vectors.schema[id], T.StructField("v", T.BinaryType())])

    @tidy
    def pack(batches):
        for batch in batches:
            lists = batch.column("v")
            ok = pc.fill_null(pc.equal(pc.list_value_length(lists), dims), False)
            lists, ids = lists.filter(ok), batch.column("id").filter(ok)
            flat = lists.flatten()
            x = pc.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False).reshape(-1, dims)
            fine = np.isfinite(x).all(axis=1)
            with np.errstate(over="ignore"):
                y = np.floor(x[fine] * float(scale))
            ints = np.clip(y, -float(_LARGE), float(_LARGE)).astype(_INT)
            yield pa.RecordBatch.from_arrays(
                [ids.filter(pa.array(fine)), pa.array([r.tobytes() for r in ints], pa.binary())], [id, "v"])

    return vectors.select(F.col(id).alias("id"), F.col(vec).cast("array<double>").alias("v")).mapInArrow(pack, schema)


def first_centroids(kept: DataFrame, k: int, seed: int = 3, id: str = "vec_id") -> list[list[int]]:
    """The ``k`` kept vectors least by the hex SHA-256 of ``seed:<id>`` (a null
    id: as empty text), equal hashes by their components' bytes: k rows."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit(""))), 256)
    rows = kept.select(key.alias("key"), "v").orderBy("key", "v").limit(k).collect()
    return [np.frombuffer(r.v, _INT).tolist() for r in rows]


def _exact(values: np.ndarray, largest: int) -> np.ndarray:
    """``values`` (Python integers) as the narrowest type in which a sum of
    products that is at most ``largest`` in size stays exact."""
    return values.astype(np.float64 if largest < 1 << 53 else np.int64 if largest < _LARGE else object)


def _dot(rows: np.ndarray, normals: np.ndarray) -> np.ndarray:
    return (rows * normals).sum(axis=1) if rows.dtype == object else np.einsum("rd,rd->r", rows, normals)


class Tournament:
    """Bisectors of all centroid pairs; ``assign`` finds each vector's nearest."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = np.array(centroids, dtype=object)
        c = self.centroids
        self.normals = 2 * (c[None, :, :] - c[:, None, :])
        norms = (c * c).sum(axis=1)
        self.thresholds = norms[None, :] - norms[:, None]
        self.reach = max((abs(int(x)) for x in c.ravel()), default=0)

    def assign(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and the squared distance (Python
        integers if they may exceed 64 bits) of each row of ``v``."""
        k, dims = self.centroids.shape
        top = max(int(np.abs(v).max()) if v.size else 0, self.reach)
        # |normal| <= 4 top, |threshold| <= dims top^2, a distance <= dims (2 top)^2
        bound = 4 * dims * top * top
        rows, normals, thresholds = _exact(v, bound), _exact(self.normals, bound), _exact(self.thresholds, bound)
        winner = np.zeros(len(v), np.int64)
        for j in range(1, k):
            side = _dot(rows, normals[winner, j]) - thresholds[winner, j]
            winner[side > 0] = j
        gap = rows - _exact(self.centroids, bound)[winner]
        far = _dot(gap, gap)
        return winner, far if far.dtype == object else far.astype(np.int64)


def _vectors(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    column = batch.column("v").cast(pa.large_binary())
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], _INT, (off[-1] - off[0]) // 8, off[0]).reshape(-1, dims)


def _moved(kept: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: centroids replaced by the exact floored means of their vectors."""
    dims = len(centroids[0])

    @tidy
    def add_up(batches):
        game = Tournament(centroids)
        count = [0] * len(centroids)
        total = np.zeros((len(centroids), dims), object)
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _vectors(batch, dims)
            winner, _ = game.assign(v)
            safe = int(np.abs(v).max()) * len(v) < _LARGE
            for j in np.unique(winner).tolist():
                mine = v[winner == j]
                count[j] += len(mine)
                total[j] += (mine if safe else mine.astype(object)).sum(axis=0).astype(object)
        out = [(j, count[j], d, str(total[j, d])) for j in range(len(count)) if count[j] for d in range(dims)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int32(), pa.string()))],
            ["cluster", "n", "dim", "total"])

    parts = kept.select("v").mapInArrow(add_up, "cluster int, n long, dim int, total string")
    sums = parts.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("s"))
    moved = [list(c) for c in centroids]
    for r in sums.collect():  # at most k * dims rows
        moved[r.cluster][r.dim] = int(r.s) // r.n
    return moved


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3,
            vec: str = "embedding", id: str = "vec_id") -> DataFrame:
    """Per kept vector: ``id``, ``cluster``, ``distance`` (squared, to its final
    centroid), ``cluster_inertia``, ``inertia`` and ``centroid`` (its components).

    ``rounds`` times every vector goes to its nearest centroid and non-empty
    centroids move to the exact floored mean; then vectors are assigned once more.

    Rows with a null vector, a null or non-finite component or another length
    are dropped; null ids stay; repeated rows count each time and may be
    several first centroids; equal centroids leave the larger number empty;
    equally near ones: the smaller number.  With fewer than ``k`` kept rows
    there are as many centroids; an empty table gives no rows.  A distance or
    sum that exceeds a long is null.  Other columns, whatever their names, are ignored.
    """
    spark = vectors.sparkSession
    folder = scratch(spark, "centroids")
    kept = stage(kept_vectors(vectors, dims, scale, vec, id), folder, "vectors")
    centroids = first_centroids(kept, k, seed, id)
    id_type = kept.schema[id]
    found = T.StructType([id_type, T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    if not centroids:
        empty = spark.createDataFrame([], found)
        return empty.select(id, "cluster", "distance", F.lit(None).cast("long").alias("cluster_inertia"),
                            F.lit(None).cast("long").alias("inertia"), F.lit(None).cast("array<long>").alias("centroid"))
    for _ in range(rounds):
        centroids = _moved(kept, centroids)

    @tidy
    def place(batches):
        game = Tournament(centroids)
        for batch in batches:
            if batch.num_rows:
                winner, far = game.assign(_vectors(batch, dims))
                far = [x if x <= _LONG else None for x in far.tolist()]
                yield pa.RecordBatch.from_arrays([batch.column(id), pa.array(winner, pa.int32()), pa.array(far, pa.int64())],
                                                 [id, "cluster", "distance"])

    placed = stage(kept.mapInArrow(place, found), folder, "placed")
    # a null distance makes its sums null: they exceed a long, too
    total = F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)")))
    per = {r.cluster: r.s for r in placed.groupBy("cluster").agg(total.alias("s")).collect()}  # at most k rows
    fits = lambda s: int(s) if s is not None and s <= _LONG else None
    whole = fits(None if None in per.values() else sum(per.values()))
    rows = [(j, fits(s), whole, [int(x) for x in centroids[j]]) for j, s in per.items()]
    one = fresh([id], "cluster_")
    final = spark.createDataFrame(rows, f"`{one}` int, cluster_inertia long, inertia long, centroid array<long>")
    return placed.join(F.broadcast(final), F.col("cluster") == F.col(one)).drop(one)  # k rows


def centroid_hash(centroid: str = "centroid") -> Column:
    """Lower-case hex SHA-256 of the components as decimals joined by commas."""
    return F.sha2(F.array_join(F.transform(centroid, lambda x: x.cast("string")), ","), 256)
