"""Ordered-neighbour operators (W1) without one task per partition key.

``lag``/``lead`` over ``Window.partitionBy(k)`` sends every row of a key to one
task; with a key holding a third of the data that task is the whole job. Here a
partition is cut into *blocks* of consecutive rows, and neighbours are found
inside each block by an ordinary window. Only the edge rows of each block (its
first and last row, at most two per block) lack a neighbour; they take it from
the adjacent edge row in a second window over the edge rows alone. Interior and
edge rows are then put back together with a union: one shuffle of the full data.

Blocks are ranges of (key, order): Spark's range partitioning cuts the rows of all keys together into
ranges of about equal size, so a hot key spans as many of them as its share asks for, however many keys there are. The
rows are written with their range to the shared checkpoint folder, as ranges are sampled anew whenever they are made.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..session import scratch_path
from .state import first_by_name

#: Ranges of ``ordered_neighbours``: 0 stands for as many as the session has shuffle partitions.
BLOCKS = 0


def _ranges(d: DataFrame, order_by: Sequence[str], blocks: int) -> DataFrame:
    """Adds ``__blk``, the range of (``__k``, order) that a row is in; of ``blocks`` ranges."""
    spark = d.sparkSession
    blocks = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = d.repartitionByRange(blocks, "__k", *order_by).withColumn("__blk", F.spark_partition_id())
    path = scratch_path(spark, "ranges")
    d.write.parquet(path)
    return spark.read.schema(d.schema).parquet(path)


def ordered_neighbours(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str],
                       carry: Sequence[str], prefixes: tuple[str | None, str | None] = ("prev_", "next_"),
                       blocks: int | None = BLOCKS, block_width: int | None = None) -> DataFrame:
    """Add ``prev_<c>`` / ``next_<c>`` for each ``carry`` column: the values of
    the row before / after in ``order_by`` within ``partition_by``. A prefix of
    None leaves that side out.

    ``order_by`` must be unique within a partition; nulls come first. ``blocks`` ranges
    of (partition, order) are cut, see above. ``block_width`` cuts a single dense whole-number
    column (an offset) into ranges of that width instead, which needs no look at the
    data and no table on the way. ``blocks=None`` without a width uses one plain window (fine for
    small, bounded tables).
    """
    partition_by, order_by, carry = list(partition_by), list(order_by), list(carry)
    p, n = prefixes
    payload = F.struct(*[F.col(c) for c in carry])
    sides = {"__p": F.lag, "__n": F.lead}
    sides = {k: f for (k, f), prefix in zip(sides.items(), prefixes) if prefix is not None}

    def near(d: DataFrame, w) -> DataFrame:
        return d.withColumns({k: F.coalesce(k, f(payload).over(w)) if k in d.columns else f(payload).over(w)
                              for k, f in sides.items()})

    if blocks is None and block_width is None:
        return _unpack(near(df, Window.partitionBy(*partition_by).orderBy(*order_by)), carry, p, n)

    # Key as one non-null struct: null key values still group together.
    d = df.withColumn("__k", F.struct(*[F.col(c) for c in partition_by]))
    if block_width is not None:
        if len(order_by) != 1:
            raise ValueError("block_width needs a single order column")
        d = d.withColumn("__blk", F.floor(F.col(order_by[0]) / F.lit(block_width)))
    else:
        d = _ranges(d, order_by, blocks)
    w = Window.partitionBy("__k", "__blk").orderBy(*order_by)
    # Of one side only the rows at that side lack a neighbour, but the rows at the other side provide it.
    d = near(d, w).withColumns({"__first": F.lag(F.lit(1)).over(w).isNull(), "__last": F.lead(F.lit(1)).over(w).isNull()})
    edge = F.col("__first") | F.col("__last")
    # The edge row before a block's first row is the previous block's last row,
    # and the one after a block's last row is the next block's first row.
    edges = near(d.where(edge), Window.partitionBy("__k").orderBy(*order_by))
    out = d.where(~edge).unionByName(edges).drop("__k", "__blk", "__first", "__last")
    return _unpack(out, carry, p, n)


def _unpack(df: DataFrame, carry: Sequence[str], p: str | None, n: str | None) -> DataFrame:
    cols = [c for c in df.columns if c not in ("__p", "__n")]
    sides = [(s, prefix) for s, prefix in (("__p", p), ("__n", n)) if prefix is not None]
    return df.select(*cols, *[F.col(f"{s}.{c}").alias(prefix + c) for s, prefix in sides for c in carry])


def line_topology(stops: DataFrame, line: str = "line", name: str = "station_name",
                  station_id: str = "station_id", order_by: Sequence[str] = ("order", "stop_id"),
                  blocks: int | None = BLOCKS) -> DataFrame:
    """Per line, stations de-duplicated by name in first-seen order (A7), the
    first station id of each name, linked to the previous (direction a) and the
    next (direction b) station.

    Output: line, station_name, station_id, order, stop_id (first-seen position),
    prev_station_id, prev_station_name, next_station_id, next_station_name.
    """
    order_by = list(order_by)
    firsts = first_by_name(stops, [line], name, order_by, [station_id])
    firsts = firsts.select(line, name, station_id,
                           *[F.col(f"first_seen.{c}").alias(c) for c in order_by])
    linked = ordered_neighbours(firsts.withColumnRenamed(name, "station_name")
                                      .withColumnRenamed(station_id, "station_id"),
                                [line], order_by, ["station_id", "station_name"],
                                blocks=blocks)
    return linked
