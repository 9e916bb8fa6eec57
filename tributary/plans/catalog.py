"""Registered queries over the driver tables and their independent SQL oracles.

Keys carry the operator id from the survey inventory. Every query reads whole
tables; the oracle computes the same answer directly in SQL (DuckDB dialect)
from the raw tables, while the Spark side goes through the wire encoding and
the engine's decoders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas as S
from ..functions.columns import slug
from ..functions.decode import POSITION, check_constraints, clashes, dead_letters, decode_json, value_text
from ..operators.order import numbered, order_board, order_stops, union_lines
from ..operators.state import first_by_name, latest_by_key, running_count, upsert_count
from ..operators.window import line_topology as _line_topology
from ..session import scratch_path
from ..sources.files import envelope_stream, read_csv_checked, split_corrupt, write_envelope
from ..sources.jdbc import high_water, incremental_slice, load_next, read_loads
from ..sources.tables import table
from ..streaming import jobs
from ..streaming.sinks import to_changelog
from . import encode as E
from . import passthrough as P
from . import risk as R
from . import transit as T


def _t(spark, sf_dir, name):
    return table(spark, sf_dir, name)


# ---- risk scoring ----------------------------------------------------------------
def q1_risk_graph(spark, sf_dir):
    return R.risk_graph(E.risk_event_messages(_t(spark, sf_dir, "events")),
                        E.customer_sorted_set_messages(_t(spark, sf_dir, "customer")))


def q2_customer_birth_year(spark, sf_dir):
    return R.customer_birth_year(E.customer_sorted_set_messages(_t(spark, sf_dir, "customer")))


def q3_risk_events(spark, sf_dir):
    return R.risk_events(E.risk_event_messages(_t(spark, sf_dir, "events")))


def d2_json_field(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return decode_json(ev, S._s(("k", S.IntegerType())), "props", keep=("event_id",))


# ---- transit -----------------------------------------------------------------
def q4_stations_table(spark, sf_dir):
    return T.stations_table(E.station_messages(_t(spark, sf_dir, "part")))


def s11_station_changelog(spark, sf_dir):
    """Every station record as a changelog message of the station table:
    key = station_id, value = {station_id, station_name, order, line}."""
    log = T.station_changelog(E.station_messages(_t(spark, sf_dir, "part")))
    return to_changelog(log.drop(POSITION), ["station_id"])


def a4_line_stations(spark, sf_dir):
    return T.line_stations(E.station_messages(_t(spark, sf_dir, "part")))


def q5_turnstile_summary(spark, sf_dir):
    return T.turnstile_summary(E.turnstile_messages(_t(spark, sf_dir, "events")))


def d12_summary_counts(spark, sf_dir):
    """The summary topic read back (D12): Q5's messages as a topic, decoded from
    their upper-case keys, last message per station."""
    summary = T.turnstile_summary(E.turnstile_messages(_t(spark, sf_dir, "events")))
    env = E.envelope(summary, F.col("value"), S.TOPICS["turnstile_summary"],
                     F.col("key").cast("long"), key=F.col("key"))
    return T.summary_counts(env)


def s10_turnstile_records(spark, sf_dir):
    """Producer records (S10): key JSON {timestamp: epoch ms}, value JSON {station_id,
    station_name, line}, one per turnstile entry."""
    return E.turnstile_records(_t(spark, sf_dir, "events")).select("event_id", "key", "value")


def a1_running_count(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return running_count(li.select(F.col("l_partkey").alias("station_id")), "station_id")


def a2_upsert_count(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select(F.date_trunc("minute", "ts").alias("msg_key"),
                                             "user_id", "event_id")
    return upsert_count(ev, "msg_key", "user_id", "event_id")


def a3_latest_by_key(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return latest_by_key(ev, ["user_id"], ["ts", "event_id"], ["event_type", "event_id"])


def a5_slot_occupancy(spark, sf_dir):
    return T.slot_occupancy(E.arrival_messages(_t(spark, sf_dir, "events")))


def q6_line_status_board(spark, sf_dir):
    part, events = _t(spark, sf_dir, "part"), _t(spark, sf_dir, "events")
    return T.line_status_board(*T.board_inputs(part, events))


def q7_current_weather(spark, sf_dir):
    return T.weather_display(E.weather_messages(_t(spark, sf_dir, "events")))


def q8_expected_entries(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    ticks = events.select("event_id", F.col("user_id").cast("int").alias("station_id"), "ts")
    seed = E.ridership_seed_from_suppliers(_t(spark, sf_dir, "supplier"))
    curve = E.curve_from_events(events)
    out = T.expected_entries(ticks, seed, curve, 300, variants={
        "entries": ("reference", "reference"), "entries_corrected": ("corrected", "corrected")})
    return out.select("event_id", "station_id", "hour", "entries", "entries_corrected")


def s10_turnstile_entries(spark, sf_dir):
    """Expected entries per station over all ticks (corrected calendar and steps)."""
    events = _t(spark, sf_dir, "events")
    seed = E.ridership_seed_from_suppliers(_t(spark, sf_dir, "supplier"))
    ticks = events.select(F.col("user_id").cast("int").alias("station_id"), "ts")
    expected = T.expected_entries(ticks, seed, E.curve_from_events(events), 300, calendar="corrected",
                                  steps_mode="corrected")
    return (expected.groupBy("station_id").agg(F.sum("entries").alias("count")).where("count > 0"))


def q9_line_topology(spark, sf_dir):
    return T.line_topology(E.stops_from_parts(_t(spark, sf_dir, "part")))


def a7_first_by_name(spark, sf_dir):
    """Distinct stop names in first-seen order (by order, stop_id) with the first station id."""
    stops = E.stops_from_parts(_t(spark, sf_dir, "part"))
    firsts = first_by_name(stops, [], "station_name", ["order", "stop_id"], ["station_id"])
    return firsts.select("station_name", "station_id", F.col("first_seen.order").alias("order"),
                         F.col("first_seen.stop_id").alias("stop_id"))


def w1_line_topology(spark, sf_dir):
    cust = _t(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("line"), F.col("c_name").alias("station_name"),
        F.col("c_custkey").alias("station_id"), F.col("c_nationkey").alias("order"),
        F.col("c_custkey").alias("stop_id"))
    return _line_topology(cust)


def q10_raw_messages(spark, sf_dir):
    return P.passthrough(E.passthrough_messages(_t(spark, sf_dir, "events")))


# ---- checks and loads ----------------------------------------------------------
def d10_constraints(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    return check_constraints(part, ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"], ["p_name"])


def p14_slug(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_partkey", slug("p_name").alias("slug"))


def s6_incremental_load(spark, sf_dir):
    """Two loads with a stored mark. The first takes the table as it was when half of the keys were in it,
    from no mark at all; the second takes what has come since, up to the mark read before it. The marks are
    scalar subqueries, so no job runs while the query is built."""
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_name")
    then = part.where(F.col("p_partkey") <= part.agg(F.floor(F.max("p_partkey") / 2)).scalar())
    first_mark = high_water(then, "p_partkey").scalar()
    first = incremental_slice(then, "p_partkey", None, first_mark)
    second_mark = high_water(part, "p_partkey", first_mark).scalar()
    second = incremental_slice(part, "p_partkey", first_mark, second_mark)
    loads = [df.withColumns({"load": F.lit(k), "high_water": mark})
             for k, (df, mark) in enumerate(((first, first_mark), (second, second_mark)), 1)]
    return union_lines(*loads)


def s6_resumed_loads(spark, sf_dir):
    """S6 with marks kept by the table: the first load takes the table as it was when half of the keys were in it, the
    second what has come since. Between them lies a load that was broken off (files, but no commit); its rows don't
    count, and the second load takes its place."""
    root = scratch_path(spark, "s6-loads")
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_name")
    then = part.where(F.col("p_partkey") <= part.agg(F.floor(F.max("p_partkey") / 2)).scalar())
    load_next(root, "p_partkey", lambda last: then)
    part.where("p_partkey % 3 = 0").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{root}/load=2/high_water=0")
    load_next(root, "p_partkey", lambda last: part)
    return read_loads(spark, root).select("p_partkey", "p_name", F.col("load").cast("int").alias("load"),
                                          F.col("high_water").cast("long").alias("high_water"))


def s5_checked_csv(spark, sf_dir):
    """A station file with bad lines, read as rows and quarantine in one scan (S5): after every 97th stop follow a line
    whose id isn't a number, one with too few values and one with too many."""
    path = scratch_path(spark, "s5-stations")
    stops = E.stops_from_parts(_t(spark, sf_dir, "part"))
    quoted = F.concat(F.lit('"'), F.regexp_replace("station_name", '"', '""'), F.lit('"'))
    line = F.concat_ws(",", "stop_id", quoted, "station_id", "order")
    n = F.col("stop_id").cast("string")
    bad = F.array(line, F.concat(F.lit("x"), line), F.concat(n, F.lit(",short")), F.concat(line, F.lit(",1,2")))
    lines = F.when(F.col("stop_id") % E.GARBAGE_EVERY == 0, bad).otherwise(F.array(line))
    stops.select(F.explode(lines).alias("value")).write.text(path)
    schema = S._s(("stop_id", S.IntegerType()), ("station_name", S.StringType()), ("station_id", S.IntegerType()),
                  ("order", S.IntegerType()))
    good, bad = split_corrupt(read_csv_checked(spark, path, schema, header=False))
    empty = {"stop_id": "int", "station_name": "string", "station_id": "int", "order": "int"}
    return union_lines(
        good.select(F.lit("row").alias("output"), *empty, F.lit(None).cast("string").alias("line")),
        bad.select(F.lit("bad").alias("output"), *[F.lit(None).cast(t).alias(c) for c, t in empty.items()], "line"))


def d10_across_loads(spark, sf_dir):
    """Uniqueness across two loads (D10): the rows of the second half of the parts whose name and brand a row of the first
    half has already."""
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    half = part.agg(F.floor(F.max("p_partkey") / 2)).scalar()
    stored, new = part.where(F.col("p_partkey") <= half), part.where(F.col("p_partkey") > half)
    return clashes(new, stored, ["p_name", "p_brand"])


def t6_dead_letters(spark, sf_dir):
    """The malformed messages of the four transit topics, as they came."""
    envs = T.board_inputs(_t(spark, sf_dir, "part"), _t(spark, sf_dir, "events"))
    kinds = (S.STATION, S.ARRIVAL, S.TURNSTILE, S.WEATHER)
    letters = union_lines(*[dead_letters(env, kind) for env, kind in zip(envs, kinds)])
    return letters.select("topic", "partition", "offset", value_text("value").alias("value"))


# ---- ordered results -------------------------------------------------------------
def o1_ordered_board(spark, sf_dir):
    """Q6 as it is shown: lines blue, green, red; stations by order (O1). The position of a row is its place in the
    operator's output."""
    board = order_board(q6_line_status_board(spark, sf_dir))
    return numbered(board.select("line", "line_rank", "station_id", "order"))


def o2_ordered_stops(spark, sf_dir):
    """Stops by order, ties by stop id (O2), with their place in the operator's output."""
    return numbered(order_stops(E.stops_from_parts(_t(spark, sf_dir, "part"))).select("stop_id", "order"))


def u1_union_lines(spark, sf_dir):
    """The three lines' stops, filtered one by one and put together."""
    stops = E.stops_from_parts(_t(spark, sf_dir, "part"))
    return union_lines(*[stops.where(F.col(line)).select(F.lit(line).alias("line"), "stop_id") for line in S.LINES])


# ---- streaming forms (same answer as batch; state crosses a restart) ---------------
def _halves(env: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The part of a topic present at the first start and the part that arrives
    before the restart (by the parity of the second, so both halves span all keys)."""
    late = F.unix_timestamp("timestamp") % 2 == 1
    return env.where(~late), env.where(late)


def t1_stream_risk_graph(spark, sf_dir):
    """Q1 as a stream-stream join (append mode): run, restart after more events
    arrive, read back from the sink."""
    root = scratch_path(spark, "t1-risk-graph")
    first, rest = _halves(E.risk_event_messages(_t(spark, sf_dir, "events")))
    write_envelope(first, f"{root}/events")
    write_envelope(E.customer_sorted_set_messages(_t(spark, sf_dir, "customer")), f"{root}/customers")

    def run():
        q = R.risk_graph(envelope_stream(spark, f"{root}/events"), envelope_stream(spark, f"{root}/customers"))
        jobs.run_append(q, f"{root}/out", f"{root}/ckpt")

    run()
    write_envelope(rest, f"{root}/events")
    run()
    return spark.read.parquet(f"{root}/out")


def t2_stream_slot_occupancy(spark, sf_dir):
    """A5 as an update-mode stateful aggregation merged into a keyed table: run,
    restart after more arrivals, read back the current snapshot."""
    root = scratch_path(spark, "t2-slots")
    first, rest = _halves(E.arrival_messages(_t(spark, sf_dir, "events")))
    write_envelope(first, f"{root}/arrivals")

    def run():
        jobs.run_table(T.slot_occupancy(envelope_stream(spark, f"{root}/arrivals")),
                       ["line", "station_id", "direction"], f"{root}/table", f"{root}/ckpt")

    run()
    write_envelope(rest, f"{root}/arrivals")
    run()
    return jobs.read_table(spark, f"{root}/table", ["line", "station_id", "direction"])


def t3_stream_status_board(spark, sf_dir):
    """Q6 from four update-mode streams (stations, slots, counts, weather), each
    kept as a changelog table; the board is the batch join of their snapshots."""
    root = scratch_path(spark, "t3-board")
    envs = T.board_inputs(_t(spark, sf_dir, "part"), _t(spark, sf_dir, "events"))
    names = ("stations", "arrivals", "turnstile", "weather")
    for env, name in zip(envs, names):
        write_envelope(env, f"{root}/topics/{name}")
    T.run_board_tables(*[envelope_stream(spark, f"{root}/topics/{n}") for n in names], f"{root}/tables")
    return T.board_from_tables(spark, f"{root}/tables")


def t4_stream_upsert_count(spark, sf_dir):
    """A2 as a live count: the state of a message key hands on a retraction when a newer message replaces it; run,
    restart after the rest of the messages arrive, read the count table."""
    root = scratch_path(spark, "t4-upsert-count")
    msgs = _t(spark, sf_dir, "events").select(F.date_trunc("minute", "ts").alias("msg_key"),
                                              "user_id", "event_id")
    msgs.where(F.col("event_id") % 2 == 0).write.parquet(f"{root}/messages")

    def run():
        stream = spark.readStream.schema(msgs.schema).parquet(f"{root}/messages")
        jobs.run_upsert_count(stream, ["msg_key"], "user_id", "event_id", f"{root}/table", f"{root}/ckpt")

    run()
    msgs.where(F.col("event_id") % 2 == 1).write.mode("append").parquet(f"{root}/messages")
    run()
    return jobs.read_upsert_count(spark, f"{root}/table", "user_id")


def t5_stream_turnstile_counts(spark, sf_dir):
    """A1 over the turnstile topic as an update-mode stream: run, restart after more entries arrive,
    read back the counts table."""
    root = scratch_path(spark, "t5-counts")
    first, rest = _halves(E.turnstile_messages(_t(spark, sf_dir, "events")))
    write_envelope(first, f"{root}/turnstile")

    def run():
        counts = T.turnstile_counts(envelope_stream(spark, f"{root}/turnstile"))
        jobs.run_table(counts, ["station_id"], f"{root}/table", f"{root}/ckpt")

    run()
    write_envelope(rest, f"{root}/turnstile")
    run()
    return jobs.read_table(spark, f"{root}/table", ["station_id"])


def t7_stream_stations_table(spark, sf_dir):
    """Q4 as an update-mode stream: run, restart after more stops arrive, read back the table."""
    root = scratch_path(spark, "t7-stations")
    first, rest = _halves(E.station_messages(_t(spark, sf_dir, "part")))
    write_envelope(first, f"{root}/stations")

    def run():
        jobs.run_table(T.stations_table(envelope_stream(spark, f"{root}/stations")), ["station_id"],
                       f"{root}/table", f"{root}/ckpt")

    run()
    write_envelope(rest, f"{root}/stations")
    run()
    return jobs.read_table(spark, f"{root}/table", ["station_id"])


def t8_stream_raw_messages(spark, sf_dir):
    """Q10 as an append stream: run, restart after more messages arrive, read back the sink."""
    root = scratch_path(spark, "t8-raw")
    first, rest = _halves(E.passthrough_messages(_t(spark, sf_dir, "events")))
    write_envelope(first, f"{root}/topic")

    def run():
        jobs.run_append(P.passthrough(envelope_stream(spark, f"{root}/topic")), f"{root}/out", f"{root}/ckpt")

    run()
    write_envelope(rest, f"{root}/topic")
    run()
    return spark.read.parquet(f"{root}/out")


def t6_stream_checked_topic(spark, sf_dir):
    """The turnstile topic as a stream with both outputs (T6): its rows and its dead letters, parsed once; run, restart
    after more messages arrive, read both tables."""
    root = scratch_path(spark, "t6-checked")
    first, rest = _halves(E.turnstile_messages(_t(spark, sf_dir, "events")))
    write_envelope(first, f"{root}/turnstile")

    def run():
        jobs.run_checked(envelope_stream(spark, f"{root}/turnstile"), S.TURNSTILE, f"{root}/out", f"{root}/ckpt")

    run()
    write_envelope(rest, f"{root}/turnstile")
    run()
    none = F.lit(None).cast("string")
    good = jobs.read_checked_rows(spark, f"{root}/out", S.TURNSTILE)
    dead = jobs.read_dead_letters(spark, f"{root}/out", S.TURNSTILE)
    return union_lines(
        good.select(F.lit("row").alias("output"), f"{POSITION}.partition", f"{POSITION}.offset", "station_id", "line",
                    none.alias("letter")),
        dead.select(F.lit("dead").alias("output"), "partition", "offset", F.lit(None).cast("int").alias("station_id"),
                    none.alias("line"), value_text("value").alias("letter")))


SLICES, SLICE_DAYS, RANGE_DAYS, DELAY_DAYS = 4, 8, 6, 10


def expiring_join_runs(spark, sf_dir, root):
    """Runs of ``t9_stream_expiring_join``, one for each slice of the topics; yields the ended queries."""
    events = E.risk_event_messages(_t(spark, sf_dir, "events"))
    customers = E.customer_sorted_set_messages(_t(spark, sf_dir, "customer"), spread_days=SLICES * SLICE_DAYS)
    days = F.floor((F.unix_timestamp("timestamp") - E.EPOCH) / (86400 * SLICE_DAYS))
    late = F.when(F.col("offset") % 10 == 0, 1).otherwise(0)
    bound = {"delay": f"{DELAY_DAYS} days", "range": f"{RANGE_DAYS} days"}
    for part in range(SLICES):
        write_envelope(events.where(F.least(days + late, F.lit(SLICES - 1)) == part), f"{root}/events")
        write_envelope(customers.where(days == part), f"{root}/customers")
        q = R.risk_graph(envelope_stream(spark, f"{root}/events"), envelope_stream(spark, f"{root}/customers"), bound=bound)
        yield jobs.run_append(q, f"{root}/out", f"{root}/ckpt")


def t9_stream_expiring_join(spark, sf_dir):
    """Q1 with state that expires (J1, T2): a score meets customer records sent within six days of it. Both topics
    come in four slices of eight days, with a restart after each; every tenth score comes a slice late, which the
    watermark's delay of ten days allows for. What can't meet anything any more leaves the state."""
    root = scratch_path(spark, "t9-expiring")
    for _ in expiring_join_runs(spark, sf_dir, root):
        pass
    return spark.read.parquet(f"{root}/out")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q1_risk_graph": q1_risk_graph,
    "q2_customer_birth_year": q2_customer_birth_year,
    "q3_risk_events": q3_risk_events,
    "d2_json_field": d2_json_field,
    "q4_stations_table": q4_stations_table,
    "s11_station_changelog": s11_station_changelog,
    "a4_line_stations": a4_line_stations,
    "q5_turnstile_summary": q5_turnstile_summary,
    "s10_turnstile_records": s10_turnstile_records,
    "d12_summary_counts": d12_summary_counts,
    "a1_running_count": a1_running_count,
    "a2_upsert_count": a2_upsert_count,
    "a3_latest_by_key": a3_latest_by_key,
    "a5_slot_occupancy": a5_slot_occupancy,
    "q6_line_status_board": q6_line_status_board,
    "q7_current_weather": q7_current_weather,
    "q8_expected_entries": q8_expected_entries,
    "s10_turnstile_entries": s10_turnstile_entries,
    "q9_line_topology": q9_line_topology,
    "a7_first_by_name": a7_first_by_name,
    "w1_line_topology": w1_line_topology,
    "q10_raw_messages": q10_raw_messages,
    "d10_constraints": d10_constraints,
    "p14_slug": p14_slug,
    "s6_incremental_load": s6_incremental_load,
    "t6_dead_letters": t6_dead_letters,
    "o1_ordered_board": o1_ordered_board,
    "o2_ordered_stops": o2_ordered_stops,
    "u1_union_lines": u1_union_lines,
    "t1_stream_risk_graph": t1_stream_risk_graph,
    "t2_stream_slot_occupancy": t2_stream_slot_occupancy,
    "t3_stream_status_board": t3_stream_status_board,
    "t4_stream_upsert_count": t4_stream_upsert_count,
    "t5_stream_turnstile_counts": t5_stream_turnstile_counts,
    "t7_stream_stations_table": t7_stream_stations_table,
    "t8_stream_raw_messages": t8_stream_raw_messages,
    "s5_checked_csv": s5_checked_csv,
    "s6_resumed_loads": s6_resumed_loads,
    "d10_across_loads": d10_across_loads,
    "t6_stream_checked_topic": t6_stream_checked_topic,
    "t9_stream_expiring_join": t9_stream_expiring_join,
}


# ---- oracles (DuckDB SQL over the raw tables) -----------------------------------
_EMAIL = "'u' || {k} || '@test.com'"
_LINE = "['blue','green','red'][CAST({k} % 3 AS INTEGER) + 1]"

_STOPS = """
SELECT CAST(p_partkey AS INTEGER) AS stop_id, p_name AS station_name,
       CAST(p_partkey % 40 AS INTEGER) AS station_id, CAST(p_size AS INTEGER) AS "order",
       p_partkey % 2 = 0 AS red, p_partkey % 5 = 0 AS blue, p_partkey % 3 = 0 AS green
FROM part
"""

_CHANGELOG = f"""
SELECT stop_id AS ord, station_id, station_name, "order",
       CASE WHEN blue THEN 'blue' WHEN green THEN 'green' WHEN red THEN 'red' END AS line
FROM ({_STOPS})
"""

_ARRIVALS = f"""
SELECT event_id AS seq, user_id, {_LINE.format(k='user_id')} AS line, 'T' || user_id AS train_id,
       CAST(event_id % 40 AS INTEGER) AS station_id,
       CASE WHEN (event_id // 40) % 2 = 0 THEN 'a' ELSE 'b' END AS direction,
       CASE event_type WHEN 'error' THEN 'broken down' WHEN 'signup' THEN 'out of service'
                       ELSE 'in service' END AS train_status
FROM events
"""

_SLOTS = f"""
WITH a AS (
  SELECT *, lag(station_id) OVER w AS prev_station_id, lag(direction) OVER w AS prev_direction
  FROM ({_ARRIVALS}) WINDOW w AS (PARTITION BY user_id ORDER BY seq)),
wr AS (
  SELECT line, station_id, direction, seq, 1 AS phase, train_id, train_status FROM a
  UNION ALL
  SELECT line, prev_station_id, CASE WHEN prev_direction = 'a' THEN 'a' ELSE 'b' END, seq, 0,
         NULL, NULL
  FROM a WHERE prev_station_id IS NOT NULL AND prev_direction IS NOT NULL)
SELECT line, station_id, direction, train_id, train_status FROM (
  SELECT *, row_number() OVER (PARTITION BY line, station_id, direction
                               ORDER BY seq DESC, phase DESC) AS rn FROM wr)
WHERE rn = 1
"""

_LINE_STATIONS = f"""
SELECT line, station_id, station_name, "order" FROM (
  SELECT *, row_number() OVER (PARTITION BY line, station_id ORDER BY ord DESC) AS rn
  FROM ({_CHANGELOG}) WHERE line IN ('blue', 'green', 'red'))
WHERE rn = 1
"""

_WEATHER = """
SELECT CAST(trunc(value) AS INTEGER) AS temperature,
       CASE event_type WHEN 'view' THEN 'Sunny' WHEN 'click' THEN 'Partly Cloudy'
                       WHEN 'purchase' THEN 'Cloudy' WHEN 'error' THEN 'Windy'
                       WHEN 'signup' THEN 'Precipitation' END AS status
FROM events ORDER BY event_id DESC LIMIT 1
"""

_TOPOLOGY = """
SELECT line, station_name, station_id, "order", stop_id,
       lag(station_id) OVER w AS prev_station_id, lag(station_name) OVER w AS prev_station_name,
       lead(station_id) OVER w AS next_station_id, lead(station_name) OVER w AS next_station_name
FROM (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY line, station_name ORDER BY "order", stop_id) AS rn
    FROM ({stops}))
  WHERE rn = 1)
WINDOW w AS (PARTITION BY line ORDER BY "order", stop_id)
"""

ORACLE: dict[str, str] = {
    "q1_risk_graph": f"""
SELECT {_EMAIL.format(k='e.user_id')} AS key,
       CAST(to_json({{'customer': {_EMAIL.format(k='e.user_id')},
                     'score': CAST(CAST(e.value AS DECIMAL(18,2)) AS VARCHAR),
                     'email': {_EMAIL.format(k='c.c_custkey')},
                     'birthYear': CAST(year(DATE '1930-01-01' + CAST(c.c_custkey % 25000 AS INTEGER)) AS VARCHAR)}})
            AS VARCHAR) AS value
FROM events e JOIN customer c ON e.user_id = c.c_custkey
""",
    "q2_customer_birth_year": f"""
SELECT {_EMAIL.format(k='c_custkey')} AS email,
       CAST(year(DATE '1930-01-01' + CAST(c_custkey % 25000 AS INTEGER)) AS VARCHAR) AS birthYear
FROM customer
""",
    "q3_risk_events": f"""
SELECT {_EMAIL.format(k='user_id')} AS customer, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS score,
       CAST(ts AS DATE) AS riskDate
FROM events
""",
    "d2_json_field": """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
""",
    "q4_stations_table": f"""
SELECT station_id, station_name, "order", line FROM (
  SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY ord DESC) AS rn FROM ({_CHANGELOG}))
WHERE rn = 1
""",
    "s11_station_changelog": f"""
SELECT CAST(station_id AS VARCHAR) AS key,
       CAST(to_json({{'station_id': station_id, 'station_name': station_name, 'order': "order",
                     'line': line}}) AS VARCHAR) AS value
FROM ({_CHANGELOG})
""",
    "a4_line_stations": _LINE_STATIONS,
    "q5_turnstile_summary": """
SELECT CAST(station_id AS VARCHAR) AS key,
       CAST(to_json({'STATION_ID': station_id, 'COUNT': n}) AS VARCHAR) AS value
FROM (SELECT CAST(event_id % 37 AS INTEGER) AS station_id, count(*) AS n FROM events GROUP BY 1)
""",
    "s10_turnstile_records": f"""
SELECT event_id,
       CAST(to_json({{'timestamp': epoch_us(ts) // 1000}}) AS VARCHAR) AS key,
       CAST(to_json({{'station_id': CAST(event_id % 37 AS INTEGER),
                     'station_name': 'S' || CAST(event_id % 37 AS INTEGER),
                     'line': {_LINE.format(k='user_id')}}}) AS VARCHAR) AS value
FROM events
""",
    "d12_summary_counts": """
SELECT CAST(event_id % 37 AS INTEGER) AS station_id, count(*) AS count FROM events GROUP BY 1
""",
    "a1_running_count": """
SELECT l_partkey AS station_id, count(l_partkey) AS count FROM lineitem
WHERE l_partkey IS NOT NULL GROUP BY l_partkey
""",
    "a2_upsert_count": """
SELECT user_id, count(user_id) AS count FROM (
  SELECT arg_max(user_id, event_id) AS user_id FROM events GROUP BY date_trunc('minute', ts))
WHERE user_id IS NOT NULL GROUP BY user_id
""",
    "a3_latest_by_key": """
SELECT user_id, event_type, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1
""",
    "a5_slot_occupancy": _SLOTS,
    "q6_line_status_board": f"""
WITH st AS ({_LINE_STATIONS}),
sl AS ({_SLOTS}),
pv AS (SELECT line, station_id, max(CASE WHEN direction = 'a' THEN train_id END) AS train_a,
              max(CASE WHEN direction = 'b' THEN train_id END) AS train_b
       FROM sl GROUP BY line, station_id),
ct AS (SELECT CAST(event_id % 37 AS INTEGER) AS station_id, count(*) AS n FROM events GROUP BY 1),
wx AS ({_WEATHER})
SELECT st.line,
       CAST(CASE st.line WHEN 'blue' THEN 0 WHEN 'green' THEN 1 WHEN 'red' THEN 2 END AS INTEGER) AS line_rank,
       CASE st.line WHEN 'blue' THEN '#1E90FF' WHEN 'red' THEN '#DC143C' WHEN 'green' THEN '#32CD32'
                    ELSE '0xFFFFFF' END AS colour_code,
       st.station_id, st.station_name, st."order",
       coalesce(pv.train_a, '---') AS train_a, coalesce(pv.train_b, '---') AS train_b,
       coalesce(ct.n, 0) AS entries,
       (SELECT temperature FROM wx) AS temperature, (SELECT status FROM wx) AS weather
FROM st LEFT JOIN pv ON st.line = pv.line AND st.station_id = pv.station_id
        LEFT JOIN ct ON st.station_id = ct.station_id
""",
    "q7_current_weather": _WEATHER,
    "q8_expected_entries": """
WITH curve AS (SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) / (SELECT count(*) FROM events) AS ratio
               FROM events GROUP BY 1),
seed AS (SELECT CAST(s_suppkey AS INTEGER) AS station_id,
                CAST(round_even(s_acctbal, 0) AS INTEGER) AS wd,
                CAST(round_even(s_acctbal - 100, 0) AS INTEGER) AS sa,
                CAST(round_even(s_acctbal - 200, 0) AS INTEGER) AS su
         FROM supplier)
SELECT e.event_id, CAST(e.user_id AS INTEGER) AS station_id, c.hour,
       CAST(greatest(floor(s.wd * c.ratio / 300), 0) AS INTEGER) AS entries,
       CAST(greatest(floor(CASE WHEN isodow(e.ts) <= 5 THEN s.wd WHEN isodow(e.ts) = 6 THEN s.sa
                                ELSE s.su END * c.ratio / 12), 0) AS INTEGER) AS entries_corrected
FROM events e JOIN seed s ON CAST(e.user_id AS INTEGER) = s.station_id
              JOIN curve c ON CAST(hour(e.ts) AS INTEGER) = c.hour
""",
    "q9_line_topology": _TOPOLOGY.format(stops=f"""
SELECT 'blue' AS line, stop_id, station_name, station_id, "order" FROM ({_STOPS}) WHERE blue
UNION ALL SELECT 'green', stop_id, station_name, station_id, "order" FROM ({_STOPS}) WHERE green
UNION ALL SELECT 'red', stop_id, station_name, station_id, "order" FROM ({_STOPS}) WHERE red
"""),
    "w1_line_topology": _TOPOLOGY.format(stops="""
SELECT c_mktsegment AS line, c_name AS station_name, c_custkey AS station_id,
       c_nationkey AS "order", c_custkey AS stop_id FROM customer
"""),
    "a7_first_by_name": f"""
SELECT station_name, station_id, "order", stop_id FROM (
  SELECT *, row_number() OVER (PARTITION BY station_name ORDER BY "order", stop_id) AS rn FROM ({_STOPS}))
WHERE rn = 1
""",
    "q10_raw_messages": f"""
SELECT '{S.TOPICS["passthrough"]}' AS topic, CAST(user_id % 2 AS INTEGER) AS partition, event_id AS "offset",
       CASE WHEN event_type <> 'view' THEN CAST(user_id AS VARCHAR) END AS key,
       props AS value,
       CAST(to_json([{{'key': 'event_type', 'value': event_type}}]) AS VARCHAR) AS headers
FROM events
""",
    "d10_constraints": """
SELECT 'not_null:p_name' AS "check", CAST(count(*) FILTER (WHERE p_name IS NULL) AS BIGINT) AS violations FROM part
UNION ALL SELECT 'not_null:p_brand', count(*) FILTER (WHERE p_brand IS NULL) FROM part
UNION ALL SELECT 'not_null:p_type', count(*) FILTER (WHERE p_type IS NULL) FROM part
UNION ALL SELECT 'not_null:p_size', count(*) FILTER (WHERE p_size IS NULL) FROM part
UNION ALL SELECT 'not_null:p_retailprice', count(*) FILTER (WHERE p_retailprice IS NULL) FROM part
UNION ALL SELECT 'unique:p_name', CAST(coalesce(sum(n), 0) AS BIGINT) FROM (
  SELECT count(*) AS n FROM part GROUP BY p_name HAVING count(*) > 1)
""",
    "p14_slug": """
SELECT p_partkey, replace(replace(replace(replace(lower(p_name), '/', '_and_'), ' ', '_'), '-', '_'), '''', '') AS slug
FROM part
""",
    "s6_incremental_load": """
WITH m AS (SELECT CAST(floor(max(p_partkey) / 2) AS BIGINT) AS half, max(p_partkey) AS last FROM part),
     f AS (SELECT max(p_partkey) AS mark FROM part, m WHERE p_partkey <= half)
SELECT p_partkey, p_name, CAST(CASE WHEN p_partkey <= mark THEN 1 ELSE 2 END AS INTEGER) AS load,
       CASE WHEN p_partkey <= mark THEN mark ELSE last END AS high_water
FROM part, m, f
""",
    "t6_dead_letters": " UNION ALL ".join(f"""
SELECT '{S.TOPICS[topic]}' AS topic, CAST({k} % 3 AS INTEGER) AS partition, CAST(2 * ({k} // 3) + 1 AS BIGINT) AS "offset",
       'not a message' AS value FROM {source} WHERE {k} % 97 = 0
""" for topic, source, k in (("stations", "part", "p_partkey"), ("arrivals", "events", "event_id"),
                             ("turnstile", "events", "event_id"), ("weather", "events", "event_id"))),
    "o1_ordered_board": f"""
WITH st AS ({_LINE_STATIONS}),
b AS (SELECT line, CAST(CASE line WHEN 'blue' THEN 0 WHEN 'green' THEN 1 WHEN 'red' THEN 2 END AS INTEGER) AS line_rank,
             station_id, "order" FROM st)
SELECT *, row_number() OVER (ORDER BY line_rank, "order" NULLS LAST, station_id) AS position FROM b
""",
    "o2_ordered_stops": f"""
SELECT stop_id, "order", row_number() OVER (ORDER BY "order" NULLS LAST, stop_id) AS position
FROM ({_STOPS})
""",
    "u1_union_lines": f"""
SELECT 'blue' AS line, stop_id FROM ({_STOPS}) WHERE blue
UNION ALL SELECT 'green', stop_id FROM ({_STOPS}) WHERE green
UNION ALL SELECT 'red', stop_id FROM ({_STOPS}) WHERE red
""",
}
ORACLE["s10_turnstile_entries"] = """
WITH curve AS (SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) / (SELECT count(*) FROM events) AS ratio
               FROM events GROUP BY 1),
seed AS (SELECT CAST(s_suppkey AS INTEGER) AS station_id,
                CAST(round_even(s_acctbal, 0) AS INTEGER) AS wd,
                CAST(round_even(s_acctbal - 100, 0) AS INTEGER) AS sa,
                CAST(round_even(s_acctbal - 200, 0) AS INTEGER) AS su
         FROM supplier),
expected AS (
  SELECT s.station_id,
         CAST(greatest(floor(CASE WHEN isodow(e.ts) <= 5 THEN s.wd WHEN isodow(e.ts) = 6 THEN s.sa
                                  ELSE s.su END * c.ratio / 12), 0) AS INTEGER) AS n
  FROM events e JOIN seed s ON CAST(e.user_id AS INTEGER) = s.station_id
                JOIN curve c ON CAST(hour(e.ts) AS INTEGER) = c.hour)
SELECT station_id, CAST(sum(n) AS BIGINT) AS count FROM expected WHERE n > 0 GROUP BY station_id
"""
ORACLE["t1_stream_risk_graph"] = ORACLE["q1_risk_graph"]
ORACLE["t2_stream_slot_occupancy"] = ORACLE["a5_slot_occupancy"]
ORACLE["t3_stream_status_board"] = ORACLE["q6_line_status_board"]
ORACLE["t4_stream_upsert_count"] = ORACLE["a2_upsert_count"]
ORACLE["t5_stream_turnstile_counts"] = ORACLE["d12_summary_counts"]
ORACLE["t7_stream_stations_table"] = ORACLE["q4_stations_table"]
ORACLE["t8_stream_raw_messages"] = ORACLE["q10_raw_messages"]
ORACLE["t6_stream_checked_topic"] = f"""
SELECT 'row' AS output, CAST(event_id % 3 AS INTEGER) AS partition, CAST(2 * (event_id // 3) AS BIGINT) AS "offset",
       CAST(event_id % 37 AS INTEGER) AS station_id, {_LINE.format(k='user_id')} AS line, CAST(NULL AS VARCHAR) AS letter
FROM events
UNION ALL
SELECT 'dead', CAST(event_id % 3 AS INTEGER), CAST(2 * (event_id // 3) + 1 AS BIGINT), NULL, NULL, 'not a message'
FROM events WHERE event_id % 97 = 0
"""
ORACLE["t9_stream_expiring_join"] = ORACLE["q1_risk_graph"].rstrip() + f"""
WHERE e.ts BETWEEN TIMESTAMP '2024-01-01' + to_seconds(CAST(c.c_custkey * {E.SPREAD_SECONDS} % {86400 * SLICES * SLICE_DAYS} AS INTEGER)) - INTERVAL {RANGE_DAYS} DAY
               AND TIMESTAMP '2024-01-01' + to_seconds(CAST(c.c_custkey * {E.SPREAD_SECONDS} % {86400 * SLICES * SLICE_DAYS} AS INTEGER)) + INTERVAL {RANGE_DAYS} DAY
"""
ORACLE["s6_resumed_loads"] = ORACLE["s6_incremental_load"]
ORACLE["s5_checked_csv"] = f"""
SELECT 'row' AS output, stop_id, station_name, station_id, "order", CAST(NULL AS VARCHAR) AS line FROM ({_STOPS})
UNION ALL
SELECT 'bad', NULL, NULL, NULL, NULL, unnest([
  'x' || stop_id || ',"' || station_name || '",' || station_id || ',' || "order",
  stop_id || ',short',
  stop_id || ',"' || station_name || '",' || station_id || ',' || "order" || ',1,2'])
FROM ({_STOPS}) WHERE stop_id % 97 = 0
"""
ORACLE["d10_across_loads"] = """
WITH m AS (SELECT floor(max(p_partkey) / 2) AS half FROM part)
SELECT p_partkey, p_name, p_brand FROM part, m
WHERE p_partkey > half AND (p_name, p_brand) IN (SELECT (p_name, p_brand) FROM part, m WHERE p_partkey <= half)
"""
