"""Message-log sources: JSON-encoded odds updates keyed by match.

The Kafka connector jar is not bundled here, so ``kafka_batch`` and
``kafka_stream`` only build the reader; everything after the raw source
columns (``key value topic partition offset timestamp``) is plain DataFrame
code that tests drive with files carrying the same columns.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricefold.schema import ODDS_FIELDS, ODDS_SCHEMA


def decode_events(raw: DataFrame, keep_source_cols: bool = False) -> DataFrame:
    """Message value bytes → typed odds columns.

    Undecodable values and values without a ``match_id`` are dropped (the
    only check the consumers make after decoding).  ``keep_source_cols``
    keeps ``partition``/``offset`` for arrival ordering.
    """
    value = F.col("value").cast("string")
    extra = [c for c in ("partition", "offset", "timestamp") if keep_source_cols and c in raw.columns]
    return (raw.select(F.from_json(value, ODDS_SCHEMA).alias("e"), *extra)
            .select("e.*", *extra)
            .where(F.col("match_id").isNotNull()))


def encode_events(odds: DataFrame) -> DataFrame:
    """Odds rows → (key, value) message records: key = match id, value = JSON."""
    return odds.select(
        F.col("match_id").cast("binary").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in ODDS_FIELDS])).cast("binary").alias("value"),
    )


def offsets_json(topic: str, offsets: dict[int, int]) -> str:
    """``{"topic": {"0": 10, ...}}`` for ``startingOffsets``/``endingOffsets``."""
    return json.dumps({topic: {str(p): int(o) for p, o in sorted(offsets.items())}})


def kafka_batch(spark: SparkSession, servers: str, topic: str,
                start: dict[int, int] | str = "earliest", end: dict[int, int] | str = "latest",
                fail_on_data_loss: bool = True) -> DataFrame:
    """Bounded read of ``[start, end)`` per partition (needs the Kafka connector)."""
    s = start if isinstance(start, str) else offsets_json(topic, start)
    e = end if isinstance(end, str) else offsets_json(topic, end)
    return (spark.read.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", s).option("endingOffsets", e)
            .option("failOnDataLoss", str(fail_on_data_loss).lower()).load())


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
                 max_offsets_per_trigger: int | None = None, fail_on_data_loss: bool = True) -> DataFrame:
    """Subscribe to ``topic`` (needs the Kafka connector).  The consumed
    position lives in the query checkpoint, so a restart resumes."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load()


def to_kafka(records: DataFrame, servers: str, topic: str, linger_ms: int = 5, acks: str = "1") -> None:
    """Keyed write of ``encode_events`` output (needs the Kafka connector)."""
    (records.write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).option("kafka.linger.ms", str(linger_ms)).option("kafka.acks", acks).save())
