"""Joins (J1-J6).

Physical strategy is left to Catalyst and AQE: equi-joins on growing tables
are shuffle joins (AQE splits a skewed key's partitions at run time and turns
a side into a broadcast only after measuring it). We hint ``broadcast`` only
for sides whose size is bounded by construction (an aggregate keyed by hour
of day), and attach one-row tables as scalar subqueries instead of joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import (colour_code, display_status, display_temperature,
                                 display_train, day_kind, line_rank, step_entries, whole_rides)


# J1 ----------------------------------------------------------------------------
SALT = "__salt"


def join_risk(risk: DataFrame, customers: DataFrame, bound: dict | None = None,
              salt: int = 1, salt_by: tuple[str, ...] = ("partition", "offset")) -> DataFrame:
    """Inner equi-join ``customer = email``; every matching pair, duplicates kept,
    nulls never match.

    ``bound`` (off by default, as in the original job whose join state is
    unbounded) limits stream-stream state: ``{"risk_time": col, "customer_time":
    col, "delay": "10 minutes", "range": "1 hour"}`` adds watermarks on both
    sides and a time-range condition so old state can be dropped.

    ``salt`` spreads a hot customer over that many join partitions: each risk
    row gets a salt from a hash of its message position (``salt_by`` columns,
    so a replayed message keeps its salt) and each customer row is repeated
    once per salt, so every pair is still produced exactly once. Off by default:
    batch plans leave skew to AQE's skew-join split, and a stream would keep each
    customer ``salt`` times in its state, which only a hot customer is worth.
    """
    missing = [c for c in salt_by if c not in risk.columns]
    if salt > 1 and missing:
        raise ValueError(f"salting needs the columns {missing}")
    if salt > 1:
        risk = risk.withColumn(SALT, F.pmod(F.xxhash64(*salt_by), F.lit(salt)).cast("int"))
        customers = customers.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        cond = (risk["customer"] == customers["email"]) & (risk[SALT] == customers[SALT])
    else:
        cond = risk["customer"] == customers["email"]
    if bound:
        rt, ct = bound["risk_time"], bound["customer_time"]
        risk = risk.withWatermark(rt, bound.get("delay", "10 minutes"))
        customers = customers.withWatermark(ct, bound.get("delay", "10 minutes"))
        rng = bound.get("range", "1 hour")
        cond = cond & F.expr(f"{rt} BETWEEN {ct} - INTERVAL {rng} AND {ct} + INTERVAL {rng}")
    joined = risk.join(customers, cond, "inner")
    return joined.select("customer", "score", "email", "birthYear")


# J2, J3, J6, P9-P11, O1, U1 -----------------------------------------------------
def pivot_slots(slots: DataFrame) -> DataFrame:
    """(line, station_id, direction, train_id) -> one row per (line, station_id)
    with the a and b occupants side by side (at most one row per slot)."""
    return (slots.groupBy("line", "station_id")
                 .agg(F.max(F.when(F.col("direction") == "a", F.col("train_id"))).alias("train_a"),
                      F.max(F.when(F.col("direction") == "b", F.col("train_id"))).alias("train_b")))


def status_board(stations: DataFrame, slots: DataFrame, counts: DataFrame,
                 weather: DataFrame | None = None) -> DataFrame:
    """Per-line status board.

    stations: (line, station_id, station_name, order) - the board's rows.
    slots:    A5 output; arrivals at stations not on the line never show.
    counts:   (station_id, count) - applies to the station on every line, 0 if absent.
    weather:  optional one-row (temperature, status), attached as scalar subqueries.
    """
    board = (stations.join(pivot_slots(slots), ["line", "station_id"], "left")
                     .join(counts.select("station_id", F.col("count").alias("entries")),
                           ["station_id"], "left"))
    board = board.select(
        "line", line_rank("line").alias("line_rank"), colour_code("line").alias("colour_code"),
        "station_id", "station_name", "order",
        display_train("train_a").alias("train_a"), display_train("train_b").alias("train_b"),
        F.coalesce(F.col("entries"), F.lit(0).cast("long")).alias("entries"))
    if weather is not None:
        board = attach_weather(board, weather)
    return board


def attach_weather(board: DataFrame, weather: DataFrame) -> DataFrame:
    """The current-weather row on every board row. The weather table is one
    row by construction (a global aggregate), so it goes in as one scalar
    subquery evaluated once - no join, no shuffle."""
    w = weather.select(F.struct(display_temperature("temperature").alias("t"),
                                display_status("status").alias("s"))).scalar()
    return board.withColumns({"temperature": w.getField("t"), "weather": w.getField("s")})


# J4, J5, P16, P17 -------------------------------------------------------------
def hourly_curve(curve: DataFrame) -> DataFrame:
    """One ratio per hour of day 0-23: the first row (in read order) for each hour.
    At most 24 rows by construction."""
    return (curve.withColumn("__pos", F.monotonically_increasing_id())
                 .where(F.col("hour").between(0, 23))
                 .groupBy(F.col("hour").cast("int").alias("hour"))
                 .agg(F.min_by("ridership_ratio", "__pos").alias("ridership_ratio")))

def expected_entries(ticks: DataFrame, seed: DataFrame, curve: DataFrame,
                     step_seconds_divisor: int | None = None, calendar: str = "reference",
                     variants: dict[str, tuple[str, int]] | None = None,
                     seed_cols: tuple[str, ...] = ()) -> DataFrame:
    """Deterministic turnstile entries for each simulation tick.

    ticks: (station_id, ts, ...) one row per station and step.
    seed:  ridership seed (station_id, avg_weekday_rides, avg_saturday_rides,
           avg_sunday-holiday_rides); J4 inner equi-join on station_id.
    curve: (hour, ridership_ratio); J5 equi-join on hour(ts). The first row per
           hour of day 0-23 is used (as the original takes the first match), so
           the broadcast side is at most 24 rows whatever the input.
    variants: output column -> (calendar, divisor); all computed in the same
           pass. Default: ``{"entries": (calendar, step_seconds_divisor)}``.
    seed_cols: further seed columns carried through the same join (e.g. the
           station name), so no second join with the seed is needed.
    """
    if variants is None:
        variants = {"entries": (calendar, step_seconds_divisor)}
    riders = seed.select(
        "station_id", *[F.col(f"`{c}`") for c in seed_cols],
        whole_rides("avg_weekday_rides").alias("__weekday"),
        whole_rides("avg_saturday_rides").alias("__saturday"),
        whole_rides("`avg_sunday-holiday_rides`").alias("__sunday"))
    hourly = hourly_curve(curve)
    if ticks.isStreaming and not curve.isStreaming:
        # Position functions are not allowed anywhere in a streaming plan, so the
        # reduced static curve (<= 24 rows) is checkpointed to the shared
        # checkpoint folder, which cuts its lineage; batch plans are unchanged.
        hourly = hourly.checkpoint()
    out = (ticks.join(riders, "station_id", "inner")
                .withColumn("hour", F.hour("ts"))
                .join(F.broadcast(hourly), "hour", "inner"))
    for name, (cal, divisor) in variants.items():
        kind = day_kind("ts", cal)
        rides = (F.when(kind == "weekday", F.col("__weekday")).when(kind == "saturday", F.col("__saturday"))
                  .otherwise(F.col("__sunday")))
        out = out.withColumn(name, step_entries(rides, F.col("ridership_ratio"), F.lit(divisor)))
    return out.drop("__weekday", "__saturday", "__sunday")
