"""Q10: raw passthrough of a topic (topic, partition, offset, key, value, headers as text)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.kafka import raw_messages


def passthrough(env: DataFrame, headers_as_json: bool = True) -> DataFrame:
    out = raw_messages(env)
    if headers_as_json:
        out = out.withColumn("headers", F.to_json("headers"))
    return out
