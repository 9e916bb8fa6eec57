"""Shared helpers of the corpus operators: tables, written intermediates, skew-safe prefix sums."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.session import configure, scratch_path

# Rows of an Arrow batch handed to Python. Whole texts travel in one row, so the
# batch is kept small; Spark also cuts batches by bytes.
ARROW_ROWS = 256
ARROW_BYTES = 4 << 20
NARROW_ROWS = 1 << 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession) -> SparkSession:
    """Session defaults, Arrow batches small enough for whole documents, and this package on the executors."""
    configure(spark)
    context = spark.sparkContext
    if not hasattr(context, "_tributary_shipped"):
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "tributary"), "zip",
                                      os.path.dirname(package), os.path.basename(package))
        context.addPyFile(archive)  # Spark serves it to every executor
        context._tributary_shipped = True
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back, in folders by a column if one is named.

    Cuts the lineage: an executor lost later costs no recomputation, and every
    executor can read every file."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if by is None:
        df.write.parquet(path)
    else:
        # a writer for each of a few folders, so that rows needn't be sorted by folder first
        spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "16")
        try:
            df.write.partitionBy(by).parquet(path)
        finally:
            spark.conf.unset("spark.sql.maxConcurrentOutputFileWriters")
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def narrow_batches(spark: SparkSession) -> Iterator[None]:
    """Longer Arrow batches for what is run inside, on tables of a few short columns."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(NARROW_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


PREFIX_BUCKETS = 1024


def bucket_of(order: Column) -> Column:
    """The top ten bits of a 64-bit hash, so that buckets follow the hash's unsigned order."""
    return F.shiftrightunsigned(order, 54).cast("int")


def prefix_sums(df: DataFrame, group: list[str], order: str, weights: list[str],
                group_columns: DataFrame | None = None) -> DataFrame:
    """Adds ``before_<w>`` for each weight: its sum over the earlier rows of the group.

    ``order`` is a column of 64-bit hashes; ``group`` columns hold no nulls. A
    group may hold a third of all rows, so it is never gathered: rows are
    summed by (group, hash bucket), the bucket sums are accumulated (at most
    ``PREFIX_BUCKETS`` rows a group), and each bucket is then accumulated on its
    own. ``group_columns`` (one row a group) ride along on the bucket sums, so
    that the large side is joined once."""
    keyed = df.withColumn("_bucket", bucket_of(F.col(order)))
    sums = keyed.groupBy(*group, "_bucket").agg(*[F.sum(w).alias(f"_sum_{w}") for w in weights])
    earlier = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(*group, "_bucket", *[
        F.coalesce(F.sum(f"_sum_{w}").over(earlier), F.lit(0)).alias(f"_base_{w}") for w in weights])
    if group_columns is not None:
        bases = bases.join(group_columns, group)
    within = Window.partitionBy(*group, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = keyed.join(bases, [*group, "_bucket"])
    for w in weights:
        out = out.withColumn(f"before_{w}", F.col(f"_base_{w}") + F.coalesce(F.sum(w).over(within), F.lit(0)))
    return out.drop("_bucket", *[f"_base_{w}" for w in weights])


MEMBER_BITS = 27
BITMAP_BYTES = 4096  # of one row of Spark's bitmap functions


def member_bits(hashes: DataFrame, column: str, bits: int = MEMBER_BITS) -> np.ndarray:
    """A bitmap of ``2**bits`` bits (16 MB by default, whatever the input) of the 64-bit hashes in ``column``.

    The top bits of a hash are its place. The bitmap is built by Spark's bitmap aggregation in rows of
    4 KB. A hash whose bit isn't set isn't among them; one whose bit is set may not be
    either, so it serves only to leave rows out early, before an exact join."""
    place = F.shiftrightunsigned(F.col(column), 64 - bits) + 1
    rows = (hashes.select(F.bitmap_bucket_number(place).alias("b"), F.bitmap_bit_position(place).alias("at"))
            .groupBy("b").agg(F.bitmap_construct_agg("at").alias("bits")).collect())
    whole = np.zeros((1 << bits) // 8, np.uint8)
    for r in rows:
        part = np.frombuffer(bytes(r.bits), np.uint8)
        whole[(r.b - 1) * BITMAP_BYTES:][:len(part)] = part
    return whole


def membership(hashes: DataFrame, column: str, bits: int = MEMBER_BITS) -> Broadcast:
    """``member_bits``, broadcast."""
    return hashes.sparkSession.sparkContext.broadcast(member_bits(hashes, column, bits))


def is_member(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """False where a hash (uint64) is surely not in the bitmap."""
    place = hashes >> np.uint64(65 - int(len(bitmap) * 8).bit_length())
    return (bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def maybe_member(members: Broadcast, column: Column) -> Column:
    """``is_member`` of a column of hashes."""

    @F.pandas_udf("boolean")
    def test(hashes: pd.Series) -> pd.Series:
        return pd.Series(is_member(members.value, hashes.to_numpy().view(np.uint64)))

    return test(column)


LEAST_LONG = -(1 << 63)


def row_keys(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """The rows of ``docs`` as a struct column ``row``, whatever their columns are called, with key columns
    (no nulls among them): the id and the hash of the text."""
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.coalesce(doc_id, F.lit(LEAST_LONG)).alias("row_id"), F.xxhash64(text).alias("row_hash"))
    return rows, ["row_id", "row_hash"]


def keyed(listed: DataFrame) -> DataFrame:
    """Columns doc_id and text_hash of an operator's result as the keys of ``row_keys``."""
    return listed.withColumns({"row_id": F.coalesce("doc_id", F.lit(LEAST_LONG)), "row_hash": F.col("text_hash")})


def without(docs: DataFrame, listed: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id and text_hash are in ``listed``.

    Rows that a bitmap of the listed hashes tells apart are never shuffled; only the others are joined."""
    rows, keys = row_keys(docs)
    gone = written(keyed(listed).select(*keys).distinct(), "listed")
    test = maybe_member(membership(gone, "row_hash"), F.col("row_hash"))
    stay = rows.where(~test).select("row.*")
    return stay.union(rows.where(test).join(gone, keys, "left_anti").select("row.*"))
