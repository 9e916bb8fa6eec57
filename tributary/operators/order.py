"""Sorts and unions (O1, O2, U1). Sorting is only for presentation of a final
snapshot; Spark range-partitions the sort, no single task sees all rows. Nor does one
when the sorted rows are numbered: ``numbered`` counts the rows of each range and adds
up the counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.columns import line_rank
from ..session import scratch_path

#: ``monotonically_increasing_id`` holds the row's number in its partition in so many low bits, the partition above.
_ROW_BITS = 33


def order_board(board: DataFrame) -> DataFrame:
    """O1: lines in the fixed order blue, green, red; stations by ``order`` (ties by id)."""
    rank = F.col("line_rank") if "line_rank" in board.columns else line_rank("line")
    return board.orderBy(rank, F.col("order").asc_nulls_last(), F.col("station_id"))


def order_stops(stops: DataFrame) -> DataFrame:
    """O2: by ``order`` with ``stop_id`` as the tie-break that makes it stable."""
    return stops.orderBy(F.col("order").asc_nulls_last(), "stop_id")


def numbered(ordered: DataFrame, position: str = "position") -> DataFrame:
    """Adds the place, from 1, of every row of a sorted DataFrame (``order_board``, ``order_stops``, any ``orderBy``).

    A sort leaves ranges of the order in its partitions, one after the other. First pass: the sorted rows are written
    to the shared checkpoint folder with their partition and their number in it. Second pass: the rows of each
    partition are counted, the counts of the partitions before are added up (a window over one row a partition, so over
    as many rows as the sort has partitions), and each row adds its partition's offset to its own number. Rows are
    shuffled by the sort only. The rows come back in the order they were given in, as far as Spark keeps it; the
    position says it for sure."""
    spark = ordered.sparkSession
    path = scratch_path(spark, "numbered")
    at = ordered.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("at"))
    at.write.parquet(path)
    rows = spark.read.schema(at.schema).parquet(path).withColumn("part", F.shiftright("at", _ROW_BITS))
    counts = rows.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.col("offset") + F.col("at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    return rows.join(F.broadcast(offsets), "part").select("row.*", place.alias(position))


def union_lines(*tables: DataFrame) -> DataFrame:
    """Concatenate per-line tables by column name."""
    return reduce(lambda a, b: a.unionByName(b), tables)
