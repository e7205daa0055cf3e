"""Folders, staging and column helpers for the operators of this subpackage."""

from __future__ import annotations

import math
import os
from collections.abc import Iterable
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricefold.session import run_dir, ship_package


#: Rows of an Arrow batch: Spark's default of 10,000 whole texts is a lot for a worker.
BATCH_ROWS, _BATCH_KEY = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepare(spark: SparkSession) -> None:
    """Ship the package to the executors and, unless the session has its own
    setting, make Arrow batches small."""
    ship_package(spark)
    if spark.conf.get(_BATCH_KEY) == "10000":
        spark.conf.set(_BATCH_KEY, str(BATCH_ROWS))


def tidy(run):
    """A task function that gives unused memory back when its input ends: an
    idle worker is kept for the next task and would hold it meanwhile."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            _release()

    return wrapped


def _release() -> None:
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared folder of ``spark.checkpoint.dir``."""
    prepare(spark)
    return run_dir(spark, name)


def stage(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` as a table of the shared folder and read it back: the
    lineage is cut and a lost executor costs no recomputation."""
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mapped_path(uri: str) -> str:
    """The path that every worker can map into memory.

    Model arrays are memory-mapped, so the shared folder must be a mounted
    one (``file:`` or a plain path).
    """
    u = urlparse(uri)
    if u.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped model files need a mounted shared folder, not {uri}")
    return unquote(u.path) if u.scheme else uri


def write_atomic(path: str, write) -> None:
    """Write a file of the shared folder under a name of its own, then move it
    into place: a retried or speculative task replaces it by the same bytes."""
    import uuid

    os.makedirs(os.path.dirname(path), exist_ok=True)
    tmp = f"{path}.{uuid.uuid4().hex}"
    with open(tmp, "wb") as f:
        write(f)
    os.replace(tmp, path)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts: the size from which shard counts are derived."""
    return docs.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0


def fresh(names: Iterable[str], name: str) -> str:
    """``name``, or a variant of it that clashes with none of ``names``."""
    taken = {n.lower() for n in names}
    while name.lower() in taken:
        name += "_"
    return name


def drawn(rows: DataFrame, by: str, most: int) -> DataFrame:
    """A sample of at most ``most`` rows, those least by the hash column ``by``.
    A share of the hash range that holds about four times as many is cut out
    first, so no task ranks more than a few rows for each row of the sample."""
    share = min(1.0, 4 * most / max(rows.count(), 1))
    few = rows.where(F.pmod(by, F.lit(1 << 20)) < math.ceil(share * (1 << 20)))
    return few.orderBy(F.pmod(by, F.lit(1 << 20)), by).limit(most)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_model(path: str, most: int = 64 << 20) -> bytes:
    """A tokenizer's vocabulary file, to be broadcast: of at most ``most`` bytes."""
    size = os.path.getsize(path)
    if size > most:
        raise ValueError(f"{path} has {size} bytes; at most {most} are broadcast")
    with open(path, "rb") as f:
        return f.read()


def public_model(name: str = "piece_bpe_32k.model") -> str:
    """Default place of the public vocabularies: $TOKENIZER_DIR or /opt/tokenizers."""
    return os.path.join(os.environ.get("TOKENIZER_DIR", "/opt/tokenizers"), name)
