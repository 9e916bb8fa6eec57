"""Kafka sources and the raw passthrough view.

The connector is an external package; every operator downstream takes the
envelope DataFrame (``schemas.ENVELOPE``) and never sees the connector, so
tests drive the same operators from a file stream with that schema
(``sources.files.envelope_stream``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def kafka_options(servers: str, topic: str | None = None, pattern: str | None = None,
                  starting: str = "earliest", headers: bool = True,
                  max_offsets_per_trigger: int | None = None, **extra) -> dict:
    """Options for ``format("kafka")``: one topic (S1) or a topic regex (S2),
    start position (S3), headers for the passthrough view (S4)."""
    if (topic is None) == (pattern is None):
        raise ValueError("give exactly one of topic or pattern")
    opts = {"kafka.bootstrap.servers": servers, "startingOffsets": starting,
            "includeHeaders": str(bool(headers)).lower()}
    if topic is not None:
        opts["subscribe"] = topic
    else:
        opts["subscribePattern"] = pattern
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def kafka_stream(spark: SparkSession, servers: str, topic: str | None = None,
                 pattern: str | None = None, starting: str = "earliest", **extra) -> DataFrame:
    """Streaming envelope of a topic (or topic pattern)."""
    opts = kafka_options(servers, topic, pattern, starting, **extra)
    return spark.readStream.format("kafka").options(**opts).load()


def kafka_batch(spark: SparkSession, servers: str, topic: str | None = None,
                pattern: str | None = None, starting: str = "earliest", **extra) -> DataFrame:
    """Batch read of the same envelope (bounded offsets)."""
    opts = kafka_options(servers, topic, pattern, starting, **extra)
    return spark.read.format("kafka").options(**opts).load()


def subscribe_pattern(env: DataFrame, pattern: str) -> DataFrame:
    """S2 over an envelope that carries several topics (a file stand-in, or a
    wider subscription): keep the topics whose whole name matches the regex, as
    the Kafka consumer does. Pushed into the scan as a filter on ``topic``."""
    return env.where(F.col("topic").rlike(f"\\A(?:{pattern})\\z"))


def raw_messages(env: DataFrame) -> DataFrame:
    """Topic, partition, key and value as text, headers as (key, text) pairs.
    A null key stays null (no failure)."""
    headers = F.transform(F.coalesce(F.col("headers"), F.array()),
                          lambda h: F.struct(h["key"].alias("key"), h["value"].cast("string").alias("value")))
    return env.select("topic", "partition", "offset",
                      F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("value"),
                      headers.alias("headers"))


def kafka_available(spark: SparkSession) -> bool:
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:
        return False
