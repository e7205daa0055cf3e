"""File sources: historical match CSVs, JSON-lines results, summaries.

Paths go through the Hadoop file system that their scheme names (or the
default one), the same as Spark's readers use, so local, ``hdfs://`` and object
store paths behave alike.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricefold.functions.text import file_stem_parts
from pricefold.sources.records import csv_records

_BOM = "﻿"


def _found(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(path, bytes) of everything that a path or glob pattern names: metadata
    only, bounded by the file count."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted((s.getPath().toString(), s.getLen() if s.isFile() else -1) for s in fs.globStatus(path) or [])


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of one CSV: its first record that is not a blank line,
    parsed as CSV (quoted names may hold commas and line ends), byte-order mark
    removed."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = ((line.lstrip(_BOM) if k == 0 else line) + "\n" for k, line in enumerate(iter(reader.readLine, None)))
        first = next((r for r in csv.reader(lines) if len(r) > 1 or any(c.strip() for c in r)), [])
    finally:
        stream.close()
    return tuple(name.strip() for name in first)


def column_names(header: Sequence[str]) -> list[str]:
    """Distinct column names: an empty one becomes ``_c<position>``, a repeated
    one (names are case-insensitive here) gets ``.1``, ``.2``, ..."""
    out, taken = [], set()
    for i, name in enumerate(header):
        base = name or f"_c{i}"
        name, k = base, 0
        while name.lower() in taken:
            k += 1
            name = f"{base}.{k}"
        taken.add(name.lower())
        out.append(name)
    return out


def _grouped(spark: SparkSession, raw_dir: str, pattern: str) -> dict[tuple[str, ...], list[str]]:
    """Files by header; headers are opened several at a time."""
    paths = [p for p, _ in _found(spark, f"{raw_dir.rstrip('/')}/{pattern}")]
    if not paths:
        raise FileNotFoundError(f"{raw_dir} holds no {pattern} file")
    with ThreadPoolExecutor(16) as pool:
        headers = list(pool.map(lambda p: _header(spark, p), paths))
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for p, header in zip(paths, headers):
        groups[header].append(p)
    return groups


def _file_name(file: str = "file") -> Column:
    return F.url_decode(F.element_at(F.split(file, "/"), -1))


def read_odds_csv(spark: SparkSession, raw_dir: str, pattern: str = "*.csv") -> DataFrame:
    """All match CSVs of a folder as one all-string DataFrame.

    * files are grouped by header; each group is one distributed read, and the
      groups are unioned by column name (a single multi-path read with
      different headers would shift values silently); headers are the files'
      first records, a repeated name gets a number (``column_names``);
    * files are read in splits, quoted cells may hold commas, doubled quotes
      and line ends (``sources.records``); a UTF-8 byte-order mark is removed;
    * records with more cells than the header are dropped, those with fewer
      padded with NULL; an empty cell is NULL; ``rejected_records`` tells what
      was dropped;
    * ``league`` and ``season`` come from the file name ``<league>_<season>.csv``
      (columns of these names in the file give way), ``source_file`` keeps the name.

    Raises FileNotFoundError when the folder has no matching file.
    """
    frames = []
    for header, files in _grouped(spark, raw_dir, pattern).items():
        names = column_names(header)
        rows = csv_records(spark, files).where(
            ~F.col("header") & F.col("reason").isNull() & (F.size("cells") <= len(names)))
        fn = _file_name()
        league, season = file_stem_parts(fn)
        added = {"league": league, "season": season, "source_file": fn}
        cells = [F.nullif(F.get("cells", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names) if n.lower() not in added]
        frames.append(rows.select(*cells, *[c.alias(n) for n, c in added.items()]))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def rejected_records(spark: SparkSession, raw_dir: str, pattern: str = "*.csv") -> DataFrame:
    """What ``read_odds_csv`` drops: ``source_file``, ``reason`` (``too_many_cells``,
    ``unclosed_quote``, ``too_long``) and the record's ``cells``."""
    frames = []
    for header, files in _grouped(spark, raw_dir, pattern).items():
        reason = F.coalesce("reason", F.when(F.size("cells") > len(header), F.lit("too_many_cells")))
        frames.append(csv_records(spark, files).where(~F.col("header")).select(_file_name().alias("source_file"), reason.alias("reason"), "cells"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.where(F.col("reason").isNotNull())


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with a fixed schema; a missing or empty path gives an
    empty typed frame; blank lines are skipped."""
    if all(size == 0 for _, size in _found(spark, path)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def read_summary(spark: SparkSession, path: str, tag: str, schema: T.StructType | None = None) -> DataFrame:
    """A summary document (JSON array of rows) with a ``tag`` column; fails
    when the file is missing."""
    if not _found(spark, path):
        raise FileNotFoundError(f"summary missing for tag {tag!r}: {path}")
    r = spark.read.option("multiLine", True)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path).withColumn("tag", F.lit(tag))
