"""Avro is Spark's own, from an external package that the image lacks."""

import pytest
from helpers import env_rows
from pyspark.sql import functions as F

from tributary import schemas as S
from tributary.functions.avro import avro_available, to_avro_column
from tributary.functions.decode import decode_avro, decode_message


def test_without_the_package_avro_is_an_error(spark):
    if avro_available(spark):
        pytest.skip("spark-avro is on the classpath")
    env = env_rows(spark, ["x"])
    with pytest.raises(RuntimeError, match="spark-avro"):
        decode_message(env, S.ARRIVAL, "avro", S.AVRO_ARRIVAL)


def test_registry_framed_round_trip(spark):
    if not avro_available(spark):
        pytest.skip("spark-avro isn't on the classpath")
    src = spark.createDataFrame([(7, "S7", "red")], "station_id int, station_name string, line string")
    env = src.select(to_avro_column(F.struct(*src.columns), S.AVRO_TURNSTILE, 42).alias("value"))
    assert decode_avro(env, S.AVRO_TURNSTILE).collect() == src.collect()
