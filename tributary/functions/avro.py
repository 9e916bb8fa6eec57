"""Avro message bodies (D9) by Spark's own ``from_avro`` / ``to_avro``.

They live in the external spark-avro package, which must be on the classpath;
without it the functions raise. Decoding is PERMISSIVE: a bad message is a row
of nulls. Registry-framed messages carry a magic byte 0 and a 4-byte big-endian
schema id before the body.
"""

from __future__ import annotations

import struct

from pyspark.sql import Column, SparkSession, functions as F

REGISTRY_PREFIX_BYTES = 5  # magic byte + 4-byte schema id ahead of the Avro body


def avro_available(spark: SparkSession | None = None) -> bool:
    """True when the external spark-avro package is on the classpath."""
    spark = spark or SparkSession.getActiveSession()
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.avro.AvroDataToCatalyst")
        return True
    except Exception:  # noqa: BLE001 - no JVM access (Connect) or class missing
        return False


def _needed() -> None:
    if not avro_available():
        raise RuntimeError("Avro needs the spark-avro package on the classpath (--packages org.apache.spark:spark-avro_2.13)")


def from_avro_column(body: Column, schema_json: str) -> Column:
    """Avro body -> struct, for the writer schema."""
    from pyspark.sql.avro.functions import from_avro

    _needed()
    return from_avro(body, schema_json, {"mode": "PERMISSIVE"})


def to_avro_column(row: Column, schema_json: str, schema_id: int | None = None) -> Column:
    """Struct -> Avro body, registry-framed when a schema id is given."""
    from pyspark.sql.avro.functions import to_avro

    _needed()
    body = to_avro(row, schema_json)
    if schema_id is None:
        return body
    return F.concat(F.lit(b"\x00" + struct.pack(">i", schema_id)).cast("binary"), body)
