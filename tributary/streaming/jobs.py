"""Streaming forms of the queries.

Stateless and join queries (Q1-Q3, Q10) run as append-mode streams straight
into a sink. Keyed tables (A1, A3, A4, A5, Q5) run as stateful aggregations in
update mode; each micro-batch of changed keys is appended to the table's
changelog (``sinks.changelog_writer``), and the table is read as the latest row
per key. The board (Q6) is a batch join over those tables: several stateful
operators in update mode do not chain inside one streaming query. A2 would be two
chained aggregations; its first is a keyed state that hands on retractions, and its second
the sum of them that the count table keeps. T6 parses a topic once for both its rows and its
dead letters.

All state lives in the query checkpoint under ``spark.checkpoint.dir``, so a
restarted query resumes from the last committed offsets; replayed batches
overwrite their own changelog folder, giving neither loss nor duplicates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas as S
from ..functions.decode import POSITION, check_messages
from . import sinks
from .retract import retractions
from .run import run_stream


def run_append(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, wait: bool = True):
    """Append-mode stream into parquet files (stateless queries and stream-stream joins)."""
    return run_stream(df, sink="parquet", path=path, mode="append", checkpoint=checkpoint, trigger=trigger, wait=wait)


def run_table(agg: DataFrame, keys: Sequence[str], path: str, checkpoint: str,
              trigger: dict | None = None, compact_every: int | None = 50, wait: bool = True):
    """Update-mode stateful aggregation; each micro-batch of changed keys is
    appended to the table's changelog (see ``sinks.changelog_writer``)."""
    return run_stream(agg, sink="foreach", mode="update", checkpoint=checkpoint, trigger=trigger, wait=wait,
                      foreach_batch=sinks.changelog_writer(path, keys, None, compact_every))


def read_table(spark: SparkSession, path: str, keys: Sequence[str], ord_cols=None) -> DataFrame | None:
    """Current snapshot of a table kept by ``run_table``."""
    return sinks.read_changelog_table(spark, path, keys, ord_cols)


def run_upsert_count(messages: DataFrame, msg_keys: Sequence[str], key: str, ord_cols: str | Sequence[str],
                     path: str, checkpoint: str, trigger: dict | None = None, compact_every: int | None = 50,
                     wait: bool = True, partitions: int | None = None):
    """A2 as a live table: the source is read as a table, and its counts by ``key`` are kept up to date.

    The state holds the newest ``key`` of each message key. A newer message takes one from the count of the old key
    and adds one to the count of the new (``retract.retractions``); the changes of a micro-batch are summed by key and
    appended to the count table's changelog. Neither a batch nor a read looks at the messages before."""
    changes = retractions(messages, msg_keys, key, ord_cols)
    write = sinks.changelog_writer(path, [key], None, compact_every, merge="sum")

    def _write(batch: DataFrame, batch_id: int) -> None:
        write(batch.groupBy(key).agg(F.sum("delta").alias("count")).where("count != 0"), batch_id)

    return run_stream(changes, sink="foreach", mode="update", checkpoint=checkpoint, trigger=trigger, wait=wait,
                      foreach_batch=_write, partitions=partitions)


def read_upsert_count(spark: SparkSession, path: str, key: str, alias: str = "count") -> DataFrame | None:
    """The count table of ``run_upsert_count`` now; keys that no message stands for any more have no row."""
    table = sinks.read_changelog_table(spark, path, [key], merge="sum")
    return None if table is None else table.where("count > 0").withColumnRenamed("count", alias)


def run_checked(env: DataFrame, schema, path: str, checkpoint: str, trigger: dict | None = None, wait: bool = True,
                fmt: str = "json", avro_schema: str | None = None):
    """T6 as a stream: a topic's rows and its dead letters, from one parse, as two tables that move together."""
    return run_stream(check_messages(env, schema, fmt, avro_schema), sink="foreach", mode="append", checkpoint=checkpoint,
                      trigger=trigger, wait=wait, foreach_batch=sinks.checked_writer(path))


def _checked(spark: SparkSession, path: str, schema, dead: bool) -> DataFrame:
    shape = check_messages(spark.createDataFrame([], S.ENVELOPE), schema).schema
    return sinks.read_checked(spark, path, shape, dead)


def read_checked_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    """The well-formed messages of ``run_checked``: position and fields."""
    return _checked(spark, path, schema, False).select(POSITION, "body.*")


def read_dead_letters(spark: SparkSession, path: str, schema) -> DataFrame:
    """The malformed messages of ``run_checked`` as they came: position and raw value."""
    return _checked(spark, path, schema, True).select(f"{POSITION}.*", F.col("letter").alias("value"))
