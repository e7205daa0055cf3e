"""A message log as files, addressed by (partition, offset): a PySpark data
source with a bounded batch reader and a stream reader.

Layout: ``<path>/partition=<p>/base=<first offset>/<part>.parquet`` with columns
``offset, key, value, timestamp``, sorted by offset.  Offsets of a partition are
consecutive; a folder's last offset follows from the next folder's name, and only
each partition's last segment is opened to plan a read.  Old segments may be
deleted (retention); a read that asks for them fails unless ``failOnDataLoss`` is
false.

``spark.read.format("offset_log")`` options, as of the usual message log source:
``path``; ``startingOffsets`` (``earliest``, ``latest`` or JSON ``{"0": 17}``: a
partition not named starts at its earliest offset); ``endingOffsets`` (``latest`` or
JSON, exclusive; batch only); ``failOnDataLoss`` (default true).  A stream's
consumed offsets live in the query's checkpoint, so a restart goes on where it
stopped, whatever ``startingOffsets`` says.

A read has one task per segment, whose rows outside the range are skipped by
row-group statistics.  Segments are read through pyarrow, so their folder must
be on a file system that pyarrow opens (a mounted path, or a URI it knows).
"""

from __future__ import annotations

import json
import posixpath
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from pricefold.session import ship_package

SEGMENT_ROWS = 1_000_000
SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType()), T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType())])


class DataLoss(ValueError):
    """Offsets were asked for that the log no longer holds."""


@dataclass
class Segment(InputPartition):
    """Rows ``[start, end)`` of one file of partition ``number``."""

    file: str
    number: int
    start: int
    end: int


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def _rows_in(filesystem, file: str) -> int:
    import pyarrow.parquet as pq

    with filesystem.open_input_file(file) as f:
        return pq.ParquetFile(f).metadata.num_rows


def segments(path: str) -> dict[int, list[Segment]]:
    """Segments per partition in offset order, up to the first gap (a segment
    whose predecessor has not been committed yet is not there yet)."""
    from pyarrow import fs

    filesystem, root = _open(path)
    found: dict[int, list[tuple[int, str]]] = {}
    for info in filesystem.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
        parts = info.path.split("/")
        if info.type == fs.FileType.File and len(parts) >= 3 and not parts[-1].startswith((".", "_")) and "_temporary" not in parts \
                and parts[-3].startswith("partition=") and parts[-2].startswith("base="):
            found.setdefault(int(parts[-3][10:]), []).append((int(parts[-2][5:]), info.path))
    out = {}
    for number, held in found.items():
        held.sort()
        row: list[Segment] = []
        for (base, file), after in zip(held, [b for b, _ in held[1:]] + [None]):
            if row and row[-1].end != base:
                break
            n = _rows_in(filesystem, file)
            row.append(Segment(file, number, base, base + n))
            if after is not None and base + n != after:
                break
        out[number] = row
    return out


def _bounds(path: str) -> tuple[dict[int, list[Segment]], dict[int, int], dict[int, int]]:
    held = segments(path)
    return held, {p: s[0].start for p, s in held.items()}, {p: s[-1].end for p, s in held.items()}


def _asked(text: str, first: dict[int, int], last: dict[int, int]) -> dict[int, int]:
    if text == "earliest":
        return dict(first)
    if text == "latest":
        return dict(last)
    named = {int(p): int(o) for p, o in json.loads(text).items()}
    return {**first, **named}


class _Reads:
    """What both readers share: planning and reading of offset ranges."""

    def __init__(self, options):
        self.path = options["path"]
        self.topic = posixpath.basename(self.path.rstrip("/"))
        self.start = options.get("startingOffsets", "earliest")
        self.strict = str(options.get("failOnDataLoss", "true")).lower() != "false"

    def plan(self, start: dict[int, int], end: dict[int, int]) -> list[Segment]:
        held, first, last = _bounds(self.path)
        out = []
        for p in sorted(end):
            a, b = start.get(p, first.get(p, 0)), end[p]
            if a >= b:
                continue
            if (a < first.get(p, 0) or b > last.get(p, 0)) and self.strict:
                raise DataLoss(f"partition {p}: offsets {a} to {b} asked for, {first.get(p, 0)} to {last.get(p, 0)} held")
            out += [Segment(s.file, p, max(a, s.start), min(b, s.end)) for s in held.get(p, []) if a < s.end and s.start < b]
        return out

    def read(self, part: Segment) -> Iterator:
        import pyarrow as pa
        import pyarrow.dataset as ds

        filesystem, _ = _open(self.path)
        offset = ds.field("offset")
        rows = ds.dataset(part.file, format="parquet", filesystem=filesystem, schema=None)
        for b in rows.to_batches(columns=["key", "value", "offset", "timestamp"], filter=(offset >= part.start) & (offset < part.end)):
            n = b.num_rows
            if n:
                yield pa.RecordBatch.from_arrays(
                    [b.column("key").cast(pa.binary()), b.column("value").cast(pa.binary()), pa.array([self.topic] * n, pa.string()),
                     pa.array([part.number] * n, pa.int32()), b.column("offset"),
                     b.column("timestamp").cast(pa.timestamp("us", tz="UTC"))], SCHEMA.names)


class LogReader(_Reads, DataSourceReader):
    def __init__(self, options):
        super().__init__(options)
        self.end = options.get("endingOffsets", "latest")

    def partitions(self):
        _, first, last = _bounds(self.path)
        return self.plan(_asked(self.start, first, last), _asked(self.end, last, last)) or [Segment("", 0, 0, 0)]

    def read(self, partition):
        return super().read(partition) if partition.file else iter(())


class LogStream(_Reads, DataSourceStreamReader):
    """Offsets are ``{partition: next offset}`` with text keys, as JSON has them."""

    def initialOffset(self) -> dict:
        _, first, last = _bounds(self.path)
        return {str(p): o for p, o in _asked(self.start, first, last).items()}

    def latestOffset(self) -> dict:
        return {str(p): o for p, o in _bounds(self.path)[2].items()}

    def partitions(self, start: dict, end: dict):
        return self.plan({int(p): o for p, o in start.items()}, {int(p): o for p, o in end.items()})

    def commit(self, end: dict) -> None:
        pass  # the checkpoint holds what was consumed


class OffsetLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "offset_log"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return LogReader(self.options)

    def streamReader(self, schema):
        return LogStream(self.options)


def register(spark: SparkSession) -> None:
    ship_package(spark)
    spark.dataSource.register(OffsetLog)


def _offsets(value: dict[int, int] | str) -> str:
    return value if isinstance(value, str) else json.dumps({str(p): int(o) for p, o in sorted(value.items())})


def log_batch(spark: SparkSession, path: str, start: dict[int, int] | str = "earliest", end: dict[int, int] | str = "latest",
              fail_on_data_loss: bool = True) -> DataFrame:
    """Messages ``[start, end)`` per partition; a partition without a named start
    is read from its earliest offset, one without a named end to its latest."""
    register(spark)
    return (spark.read.format("offset_log").option("startingOffsets", _offsets(start)).option("endingOffsets", _offsets(end))
            .option("failOnDataLoss", str(fail_on_data_loss).lower()).option("path", path).load())


def log_stream(spark: SparkSession, path: str, starting: dict[int, int] | str = "earliest",
               fail_on_data_loss: bool = True) -> DataFrame:
    """The log as a stream; every trigger reads up to the offsets it finds."""
    register(spark)
    return (spark.readStream.format("offset_log").option("startingOffsets", _offsets(starting))
            .option("failOnDataLoss", str(fail_on_data_loss).lower()).option("path", path).load())


def log_ends(path: str) -> dict[int, int]:
    """The next offset of every partition: what a bounded read takes as its end,
    and the next one as its start."""
    return _bounds(path)[2]


def append_log(messages: DataFrame, path: str, partition: str = "partition", order: str = "timestamp",
               segment_rows: int = SEGMENT_ROWS) -> None:
    """Append ``messages`` (``key``, ``value``, ``timestamp`` and their partition) after
    the last offsets, in the order of column ``order`` within each partition: a
    log's order is sequential, so numbering is one sort per log partition;
    segments are then written in parallel."""
    held = log_ends(path)
    base = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in held.items() for x in pair]), F.col("partition")), F.lit(0)) \
        if held else F.lit(0)
    w = Window.partitionBy("partition").orderBy("_order", "key", "value")
    rows = messages.select(F.col(partition).cast("int").alias("partition"), F.col(order).alias("_order"), "key", "value", "timestamp")
    rows = rows.withColumn("_n", F.row_number().over(w) - 1)
    rows = rows.withColumn("offset", (base + F.col("_n")).cast("bigint")).withColumn(
        "base", (base + F.floor(F.col("_n") / F.lit(segment_rows)) * F.lit(segment_rows)).cast("bigint"))
    (rows.drop("_order", "_n").repartition("partition", "base").sortWithinPartitions("partition", "base", "offset")
     .write.mode("append").partitionBy("partition", "base").parquet(path))
