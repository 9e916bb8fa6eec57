"""Transit queries (Q4-Q9): station table, turnstile summary, train slots,
weather, the per-line status board, expected entries and line topology.

Each function takes decoded or envelope DataFrames and is a plain Spark plan;
``board_inputs`` and ``plans.catalog`` wire them to the driver tables through
the encoders in ``plans.encode``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas as S
from ..functions.columns import display_status, display_temperature, known_lines, total_steps, transform_station
from ..functions.decode import POSITION, decode_message, decode_summary, positioned, well_formed
from ..operators.joins import expected_entries as _expected_entries, status_board
from ..operators.state import current_weather as _current_weather
from ..operators.state import latest_by_key, running_count, slot_occupancy as _slot_occupancy, upsert_count
from ..operators.window import BLOCKS, line_topology as _line_topology
from ..streaming.sinks import to_changelog
from . import encode as E


def _decoded(env: DataFrame, schema, fmt: str = "json", avro_schema: str | None = None, keep=(POSITION,)) -> DataFrame:
    """A topic's well-formed messages with their position (T6: bad ones are skipped, see ``dead_letters``)."""
    decoded = decode_message(positioned(env), schema, fmt, avro_schema, keep=keep)
    return well_formed(decoded, [f.name for f in schema.fields])


# Q4 ----------------------------------------------------------------------------
def station_changelog(station_env: DataFrame) -> DataFrame:
    """Every station message becomes a transformed-station update, with its position
    (the keyed table's changelog): (position, station_id, station_name, order, line)."""
    return transform_station(_decoded(station_env, S.STATION), keep=(POSITION,))


def stations_table(station_env: DataFrame) -> DataFrame:
    """Q4: last-value-wins table keyed by station_id only (A3): a station on two
    lines keeps the colour of its last stop."""
    return latest_by_key(station_changelog(station_env), ["station_id"], POSITION,
                         ["station_name", "order", "line"])


def line_stations(station_env: DataFrame) -> DataFrame:
    """A4: the board's view of the changelog - keyed by (line, station_id), lines
    blue / green / red only, stations never removed."""
    return latest_by_key(known_lines(station_changelog(station_env)), ["line", "station_id"],
                         POSITION, ["station_name", "order"])


# Q5 ----------------------------------------------------------------------------
def turnstile_counts(turnstile_env: DataFrame, mode: str = "count", fmt: str = "json") -> DataFrame:
    """(station_id, count) over turnstile entries; ``fmt="avro"`` reads the
    registry-framed Avro values the producers write (D9).

    ``count`` (default, A1): every entry counts - the intended result of
    ``COUNT(station_id) GROUP BY station_id``.
    ``upsert`` (A2): the source is read as a *table*, so entries sharing a
    message key replace each other (the last by position) before counting.
    """
    if mode == "count":
        return running_count(_decoded(turnstile_env, S.TURNSTILE, fmt, S.AVRO_TURNSTILE, keep=()), "station_id")
    if mode == "upsert":
        entries = _decoded(turnstile_env, S.TURNSTILE, fmt, S.AVRO_TURNSTILE, keep=("key", POSITION))
        return upsert_count(entries.withColumn("key", F.col("key").cast("string")), "key", "station_id", POSITION)
    raise ValueError(mode)


def turnstile_summary(turnstile_env: DataFrame, mode: str = "count", fmt: str = "json") -> DataFrame:
    """Q5: summary table messages, key = station id, value = {STATION_ID, COUNT}."""
    counts = turnstile_counts(turnstile_env, mode, fmt).select(F.col("station_id").alias("STATION_ID"),
                                                          F.col("count").alias("COUNT"))
    return to_changelog(counts, ["STATION_ID"])


def summary_counts(summary_env: DataFrame) -> DataFrame:
    """Summary messages back to (station_id, count); the last message per
    station wins (the summary topic is itself a table)."""
    decoded = well_formed(decode_summary(positioned(summary_env), keep=(POSITION,)), ["station_id", "count"])
    return latest_by_key(decoded, ["station_id"], POSITION, ["count"])


# A5 ----------------------------------------------------------------------------
def slot_occupancy(arrival_env: DataFrame, fmt: str = "json") -> DataFrame:
    """Arrival messages (JSON, or registry-framed Avro with ``fmt="avro"``) -> A5."""
    return _slot_occupancy(_decoded(arrival_env, S.ARRIVAL, fmt, S.AVRO_ARRIVAL), POSITION)


# Q7 ----------------------------------------------------------------------------
def current_weather(weather_env: DataFrame, fmt: str = "json") -> DataFrame:
    """Latest (temperature, status), defaults 70.0 / sunny before any event.
    Weather is published as plain JSON; ``fmt="avro"`` reads registry-framed Avro."""
    return _current_weather(_decoded(weather_env, S.WEATHER, fmt, S.AVRO_WEATHER), POSITION)


def weather_display(weather_env: DataFrame, fmt: str = "json") -> DataFrame:
    """Q7: the weather line of the board: whole degrees and a title-case status."""
    w = current_weather(weather_env, fmt)
    return w.select(display_temperature("temperature").alias("temperature"),
                    display_status("status").alias("status"))


# Q6 ----------------------------------------------------------------------------
def line_status_board(station_env: DataFrame, arrival_env: DataFrame, turnstile_env: DataFrame,
                      weather_env: DataFrame | None = None) -> DataFrame:
    """Q6: A4 stations, left-joined with A5 slots (J3) and A1 counts (J2), with
    display columns (P9-P11) and the weather (J6)."""
    weather = current_weather(weather_env) if weather_env is not None else None
    return status_board(line_stations(station_env), slot_occupancy(arrival_env),
                        turnstile_counts(turnstile_env), weather)


# Q8 ----------------------------------------------------------------------------
def expected_entries(ticks: DataFrame, seed: DataFrame, curve: DataFrame, step_seconds: int = 300,
                     calendar: str = "reference", steps_mode: str = "reference",
                     variants: dict[str, tuple[str, str]] | None = None,
                     seed_cols: tuple[str, ...] = ()) -> DataFrame:
    """Q8: deterministic part of the turnstile simulator for each (station, ts) tick.

    ``variants`` maps output columns to (calendar, steps_mode) pairs computed in
    one pass, e.g. the reference behaviour next to the corrected one."""
    if variants is None:
        variants = {"entries": (calendar, steps_mode)}
    resolved = {k: (cal, total_steps(step_seconds, mode)) for k, (cal, mode) in variants.items()}
    return _expected_entries(ticks, seed, curve, variants=resolved, seed_cols=seed_cols)


# Q9 ----------------------------------------------------------------------------
def stops_by_line(stops: DataFrame) -> DataFrame:
    """P12 for all three colours at once: one row per (line, stop) whose flag is true."""
    lines = F.array_compact(F.array(*[F.when(F.col(c) == F.lit(True), F.lit(c)) for c in S.LINES]))
    return stops.select(F.explode(lines).alias("line"), "stop_id", "station_name", "station_id", "order")


def line_topology(stops: DataFrame, blocks: int | None = BLOCKS) -> DataFrame:
    """Q9: per line, stations by first-seen order with their neighbours (A7 + W1)."""
    return _line_topology(stops_by_line(stops), blocks=blocks)


# Q6 from streams -------------------------------------------------------------------
BOARD_TABLES = {  # table -> key columns
    "stations": ["line", "station_id"],
    "slots": ["line", "station_id", "direction"],
    "counts": ["station_id"],
    "weather": [],
}


def run_board_tables(station_env: DataFrame, arrival_env: DataFrame, turnstile_env: DataFrame,
                     weather_env: DataFrame, root: str, trigger: dict | None = None, wait: bool = True,
                     formats: dict[str, str] | None = None):
    """Start the four keyed tables behind the board as update-mode streams, each
    with its own checkpoint, appending changed keys to its changelog under ``root``.
    All four are started first; ``wait`` then awaits them (a ``processingTime``
    trigger never ends, so pass ``wait=False`` there).

    ``formats`` picks the value format of the arrival, turnstile and weather
    topics (``"json"`` by default; the original producers write arrivals and
    turnstile entries as registry-framed Avro)."""
    from ..streaming.jobs import run_table
    from ..streaming.run import finished

    fmt = {"arrivals": "json", "turnstile": "json", "weather": "json", **(formats or {})}
    plans = {"stations": line_stations(station_env),
             "slots": slot_occupancy(arrival_env, fmt["arrivals"]),
             "counts": turnstile_counts(turnstile_env, fmt=fmt["turnstile"]),
             "weather": current_weather(weather_env, fmt["weather"])}
    queries = []
    for name, plan in plans.items():
        queries.append(run_table(plan, BOARD_TABLES[name], f"{root}/{name}", f"{root}/_checkpoints/{name}", trigger,
                                 wait=False))
    if wait:
        for q in queries:
            finished(q)
    return queries


def board_from_tables(spark, root: str) -> DataFrame:
    """Q6 over the current snapshots of the streamed tables (a batch join)."""
    from ..streaming.jobs import read_table

    t = {name: read_table(spark, f"{root}/{name}", keys) for name, keys in BOARD_TABLES.items()}
    if t["weather"] is None:
        t["weather"] = spark.createDataFrame([(S.DEFAULT_TEMPERATURE, S.DEFAULT_WEATHER_STATUS)],
                                             "temperature double, status string")
    empty = {"slots": "line string, station_id int, direction string, train_id string, train_status string",
             "counts": "station_id int, count long"}
    for name, ddl in empty.items():
        if t[name] is None:
            t[name] = spark.createDataFrame([], ddl)
    if t["stations"] is None:
        return spark.createDataFrame([], "line string, station_id int, station_name string, order int")
    return status_board(t["stations"], t["slots"], t["counts"], t["weather"])


# driver-table wiring -------------------------------------------------------------
def board_inputs(part: DataFrame, events: DataFrame):
    return (E.station_messages(part), E.arrival_messages(events),
            E.turnstile_messages(events), E.weather_messages(events))
