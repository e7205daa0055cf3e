"""Writers for opportunities, metrics, summaries and tagged run results.

All writes are distributed DataFrame writes; streaming outputs use the file
sink, whose commit log makes a retried trigger idempotent (exactly once).
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_opps(opps: DataFrame, path: str, fmt: str = "json", mode: str = "append") -> None:
    opps.write.mode(mode).format(fmt).save(path)


def write_metrics(metrics: DataFrame, path: str, mode: str = "append") -> None:
    metrics.write.mode(mode).json(path)


def write_summary(summary: DataFrame, path: str, partition_by: str | None = "tag") -> None:
    """Summary rows as JSON; undefined values stay NULL (never the text NaN).
    Only the partitions of the tags written are replaced."""
    num = [f.name for f in summary.schema.fields if f.dataType.typeName() == "double"]
    clean = summary.select(*[F.when(F.isnan(c), F.lit(None)).otherwise(F.col(c)).alias(c) if c in num else c
                             for c in summary.columns])
    w = clean.write.mode("overwrite")
    if partition_by and partition_by in summary.columns:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(partition_by)
    w.json(path)


def write_summary_document(summary: DataFrame, path: str) -> None:
    """A run's summary as one JSON array of its rows (one a method), as
    ``files.read_summary`` reads it; undefined values are null."""
    rows = F.sort_array(F.collect_list(F.struct(*summary.columns)))
    summary.agg(F.to_json(rows, {"ignoreNullFields": "false"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_comparison(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").option("header", True).csv(path)


def tag_results(frames: dict[str, DataFrame], tag: str, root: str) -> None:
    """Copy a run's result sets under ``root/<name>/tag=<tag>``; reading the
    root later prunes partitions by tag."""
    for name, df in frames.items():
        (df.withColumn("tag", F.lit(tag)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("tag").parquet(f"{root}/{name}"))


def write_run_config(spark: SparkSession, config: dict, tag: str, path: str) -> None:
    """One row: tag, epoch-ms timestamp and all run arguments as JSON."""
    row = [(tag, int(time.time() * 1000), json.dumps(config, sort_keys=True, default=str))]
    spark.createDataFrame(row, "tag string, saved_at_ms bigint, config string").write.mode("append").json(path)


_MANIFESTS = "_manifests"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """One small file, under a name of its own first and then renamed, so a
    reader finds it whole or not at all."""
    tmp, fs = _fs(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if not fs.rename(tmp, _fs(spark, path)[0]):
        raise OSError(f"cannot rename to {path}")


def write_run(frames: dict[str, DataFrame], tag: str, root: str) -> str:
    """Write a run's result sets so that they appear together: each into a folder
    of this write, ``root/<name>/tag=<tag>/write=<id>``, and last a manifest that
    names them.  Until the manifest is there, readers resolve the tag's former
    write, whole; an interrupted write is never seen.  Returns the write's id.

    Nothing is deleted: folders that no manifest of a tag's newest write names
    are free for whatever retention applies.
    """
    spark = next(iter(frames.values())).sparkSession
    write = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    for name, df in frames.items():
        df.write.parquet(f"{root}/{name}/tag={tag}/write={write}")
    held = json.dumps({"tag": tag, "write": write, "names": sorted(frames)})
    write_file(spark, f"{root}/{_MANIFESTS}/tag={tag}/{write}.json", held)
    return write


def runs(spark: SparkSession, root: str) -> dict[str, dict]:
    """The newest manifest of every tag: one small file a tag."""
    pattern, fs = _fs(spark, f"{root}/{_MANIFESTS}/tag=*/*.json")
    newest: dict[str, str] = {}
    for status in fs.globStatus(pattern) or []:
        path = status.getPath()
        folder = path.getParent().toString()
        newest[folder] = max(newest.get(folder, ""), path.toString())
    if not newest:
        return {}
    rows = spark.read.schema("tag string, write string, names array<string>").json(list(newest.values())).collect()
    return {r.tag: r.asDict() for r in rows}


def read_runs(spark: SparkSession, root: str, name: str, tags: list[str] | None = None) -> DataFrame:
    """Result set ``name`` of every tag (or of ``tags``), with a ``tag`` column, as of
    each tag's newest complete write."""
    held = {t: m for t, m in runs(spark, root).items() if name in m["names"] and (tags is None or t in tags)}
    if not held:
        raise FileNotFoundError(f"no complete write of {name} under {root}")
    paths = [f"{root}/{name}/tag={t}/write={m['write']}" for t, m in sorted(held.items())]
    return spark.read.option("basePath", f"{root}/{name}").parquet(*paths).drop("write").withColumn("tag", F.col("tag").cast("string"))


def write_bucketed(odds: DataFrame, table: str, path: str, buckets: int, key: str = "match_id", sort: tuple[str, ...] = ()) -> DataFrame:
    """``odds`` as a table bucketed (and sorted) by ``key``, at ``path``; returns it.
    Detection on it (``detect_snapshot(strategy="colocated")``) shuffles nothing:
    rows of a match lie in one bucket already."""
    spark = odds.sparkSession
    (odds.repartition(buckets, key).write.mode("errorifexists").format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(key, *sort).saveAsTable(table))
    return spark.table(table)
