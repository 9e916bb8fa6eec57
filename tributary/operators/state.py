"""Keyed aggregations and table operators.

All are ordinary ``groupBy().agg()`` plans: Spark runs a partial (map-side)
aggregate before the shuffle, so a key holding a third of all rows costs one
row per input partition on the wire. On a streaming DataFrame the same plans
run as stateful aggregations (update / complete mode) with state partitioned by
key; A2 is two chained aggregations, as a stream a keyed state and a table of sums
(``streaming.jobs.run_upsert_count``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas as S
from ..functions.columns import slot_direction, slot_status


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _order(ord_) -> Column:
    if isinstance(ord_, (list, tuple)):
        return F.struct(*[_c(o) for o in ord_])
    return _c(ord_)


# A1 ----------------------------------------------------------------------------
def running_count(df: DataFrame, key: str, alias: str = "count") -> DataFrame:
    """``COUNT(key) GROUP BY key``; rows with a null key are not counted."""
    return (df.where(F.col(key).isNotNull())
              .groupBy(key).agg(F.count(key).alias(alias)))


# A3 / A4 -----------------------------------------------------------------------
def latest_by_key(df: DataFrame, keys: Sequence[str], ord_, cols: Sequence[str] | None = None) -> DataFrame:
    """Last-value-wins table: for each key the row with the greatest ``ord``.

    ``ord`` is a column or a list of columns compared left to right (e.g. topic
    offset, or (timestamp, id)). ``cols`` defaults to every non-key column.
    """
    keys = list(keys)
    cols = [c for c in (cols or df.columns) if c not in keys]
    latest = F.max_by(F.struct(*cols), _order(ord_)).alias("__latest")
    return df.groupBy(*keys).agg(latest).select(*keys, *[F.col(f"__latest.{c}").alias(c) for c in cols])


# A2 ----------------------------------------------------------------------------
def upsert_count(df: DataFrame, msg_key: str | Sequence[str], key: str, ord_,
                 alias: str = "count") -> DataFrame:
    """Count over a *table* source: messages sharing ``msg_key`` replace each
    other (last by ``ord`` wins) before ``COUNT(key) GROUP BY key``."""
    msg_keys = [msg_key] if isinstance(msg_key, str) else list(msg_key)
    current = latest_by_key(df.select(*msg_keys, key, *_ord_cols(ord_)), msg_keys, ord_, [key])
    return running_count(current, key, alias)


def _ord_cols(ord_) -> list[str]:
    if isinstance(ord_, (list, tuple)):
        return [o for o in ord_ if isinstance(o, str)]
    return [ord_] if isinstance(ord_, str) else []


# A5 ----------------------------------------------------------------------------
def slot_events(arrivals: DataFrame, seq: str = "offset") -> DataFrame:
    """Each arrival becomes up to two slot writes, applied in (seq, phase) order:
    phase 0 clears (line, prev_station_id, prev_direction) when both prev fields
    are present, phase 1 sets (line, station_id, direction) to the train."""
    occupant = F.struct(F.col("train_id").alias("train_id"),
                        slot_status("train_status").alias("train_status"))
    null_occupant = F.when(F.lit(False), occupant)  # typed null struct
    clear = F.when(F.col("prev_station_id").isNotNull() & F.col("prev_direction").isNotNull(),
                   F.struct(F.col("prev_station_id").alias("station_id"),
                            slot_direction("prev_direction").alias("direction"),
                            F.lit(0).alias("phase"), null_occupant.alias("occupant")))
    put = F.struct(F.col("station_id").alias("station_id"),
                   slot_direction("direction").alias("direction"),
                   F.lit(1).alias("phase"), occupant.alias("occupant"))
    return (arrivals.select("line", F.col(seq).alias("seq"),
                            F.explode(F.array_compact(F.array(clear, put))).alias("w"))
                    .select("line", "seq", "w.*"))


def slot_occupancy(arrivals: DataFrame, seq: str = "offset") -> DataFrame:
    """Train slot per (line, station_id, direction): the last write wins, where a
    clear writes a null occupant. Cleared slots stay as rows with null train."""
    w = slot_events(arrivals, seq)
    last = F.max_by(F.col("occupant"), F.struct("seq", "phase")).alias("occupant")
    return (w.groupBy("line", "station_id", "direction").agg(last)
             .select("line", "station_id", "direction",
                     F.col("occupant.train_id").alias("train_id"),
                     F.col("occupant.train_status").alias("train_status")))


# A6 ----------------------------------------------------------------------------
def current_weather(weather: DataFrame, ord_="offset") -> DataFrame:
    """One row: the latest (temperature, status), defaults before any event."""
    latest = F.max_by(F.struct("temperature", "status"), _order(ord_))
    return (weather.agg(latest.alias("w"))
                   .select(F.coalesce(F.col("w.temperature").cast("double"),
                                      F.lit(S.DEFAULT_TEMPERATURE)).alias("temperature"),
                           F.coalesce(F.col("w.status"), F.lit(S.DEFAULT_WEATHER_STATUS)).alias("status")))


# A7 ----------------------------------------------------------------------------
def first_by_name(df: DataFrame, group: Sequence[str], name: str, ord_,
                  cols: Sequence[str]) -> DataFrame:
    """Distinct names in first-seen order: per (group, name) the values of the
    first row by ``ord`` plus that ``ord`` (as ``first_seen``) for ordering."""
    first = F.min_by(F.struct(*cols), _order(ord_)).alias("__first")
    seen = F.min(_order(ord_)).alias("first_seen")
    return (df.groupBy(*group, name).agg(first, seen)
              .select(*group, name, *[F.col(f"__first.{c}").alias(c) for c in cols], "first_seen"))
