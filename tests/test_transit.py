"""Transit: station table (A3/A4, P7/P8), topology (A7/W1), expected entries
(J4/J5/P16/P17), slots (A5), counts (A1/A2), weather (A6), board (J2/J3/J6)."""

import datetime as dt
import json
import random
from collections import Counter

import pytest
from helpers import env_rows, rows
from pyspark.sql import Window, functions as F

from tributary import schemas as S
from tributary.functions.columns import day_kind, line_colour, slug, step_entries, whole_rides
from tributary.functions.decode import check_constraints
from tributary.operators.joins import status_board
from tributary.operators.state import (current_weather, first_by_name, latest_by_key, running_count,
                                       slot_occupancy, upsert_count)
from tributary.operators.window import ordered_neighbours
from tributary.plans import encode as E
from tributary.plans import transit as T
from tributary.sources.files import read_curve, read_ridership, read_stations


@pytest.fixture(scope="module")
def stations(spark, fixture_path):
    return read_stations(spark, fixture_path("stations.csv")).cache()


@pytest.fixture(scope="module")
def station_env(stations):
    return E.envelope(stations, F.to_json(F.struct(*stations.columns)), S.TOPICS["stations"],
                      F.col("stop_id"))


def test_station_csv_invariants(stations):
    assert stations.count() == 230
    assert stations.select("station_id").distinct().count() == 111
    colours = Counter(r["line"] for r in stations.select(line_colour().alias("line")).collect())
    assert colours == {"red": 66, "blue": 66, "green": 56, None: 42}
    two = stations.where(F.col("red").cast("int") + F.col("blue").cast("int") + F.col("green").cast("int") > 1)
    assert two.count() == 0
    quoted = stations.where(F.col("station_descriptive_name").contains(",")).count()
    assert quoted > 0  # quoted commas survive the CSV read


def test_station_constraints(stations):
    rep = {r["check"]: r["violations"] for r in check_constraints(stations, S.STATION_NOT_NULL, S.STATION_KEY).collect()}
    assert set(rep.values()) == {0}
    dup = stations.unionByName(stations.limit(1))
    rep = {r["check"]: r["violations"] for r in check_constraints(dup, ["stop_name"], ["stop_id"]).collect()}
    assert rep["unique:stop_id"] == 2


def test_q4_last_value_table_keyed_by_station_only(station_env):
    out = T.stations_table(station_env)
    assert out.count() == 111
    assert Counter(r["line"] for r in out.collect()) == {"blue": 33, "red": 31, "green": 26, None: 21}
    assert out.columns == ["station_id", "station_name", "order", "line"]


def test_a4_changelog_keeps_line_membership(station_env):
    log = T.station_changelog(station_env)
    full = latest_by_key(log, ["line", "station_id"], "position", ["station_name", "order"])
    assert Counter(r["line"] for r in full.collect()) == {"blue": 33, "red": 33, "green": 28, None: 21}
    board_rows = T.line_stations(station_env)
    assert board_rows.count() == 94


def test_q9_topology_sizes_and_harlem(stations):
    topo = T.line_topology(stations, blocks=None)
    assert Counter(r["line"] for r in topo.collect()) == {"blue": 32, "green": 28, "red": 34}
    harlem = topo.where((F.col("line") == "blue") & (F.col("station_name") == "Harlem")).collect()
    assert len(harlem) == 1
    h = harlem[0]
    assert (h["station_id"], h["prev_station_name"], h["next_station_name"]) == (40750, "Cumberland", "Jefferson Park")
    # the blocked (skew-safe) plan gives the same answer
    blocked = T.line_topology(stations, blocks=9)
    assert rows(blocked) == rows(topo)


def test_ordered_neighbours_blocked_equals_plain_window(spark):
    rnd = random.Random(7)
    data = [(rnd.choice([None, 1, 2, 2, 2, 3]), i * 3 + rnd.randint(0, 2), f"v{i}") for i in range(400)]
    df = spark.createDataFrame(data, "k int, o long, v string")
    w = Window.partitionBy("k").orderBy("o")
    want = rows(df.select("k", "o", "v", F.lag("v").over(w).alias("prev_v"), F.lead("v").over(w).alias("next_v")))
    for cut in ({"block_width": 1}, {"block_width": 64}, {"blocks": 1}, {"blocks": 5}, {"blocks": 64}, {"blocks": None}):
        got = ordered_neighbours(df, ["k"], ["o"], ["v"], **cut)
        assert rows(got.select("k", "o", "v", "prev_v", "next_v")) == want, cut
        left = ordered_neighbours(df, ["k"], ["o"], ["v"], prefixes=("prev_", None), **cut)
        assert left.columns == ["k", "o", "v", "prev_v"] or set(left.columns) == {"k", "o", "v", "prev_v"}
        assert rows(left.select("k", "o", "v", "prev_v")) == [r[:4] for r in want]


def test_no_task_gets_a_hot_line(spark):
    """One line with every stop at its own order: blocks are bounded, and so are the edge rows."""
    from tributary.operators import window

    n, blocks = 20_000, 16
    df = spark.range(n).select(F.lit("red").alias("line"), F.col("id").alias("order"), F.col("id").alias("stop_id"))
    d = window._ranges(df.withColumn("__k", F.struct("line")), ["order", "stop_id"], blocks)
    sizes = [r["count"] for r in d.groupBy("__blk").count().collect()]
    assert len(sizes) == blocks and max(sizes) < 2 * n / blocks and sum(sizes) == n
    got = ordered_neighbours(df, ["line"], ["order", "stop_id"], ["stop_id"], blocks=blocks)
    assert got.where("coalesce(prev_stop_id, stop_id - 1) <> stop_id - 1 or coalesce(next_stop_id, stop_id + 1) <> stop_id + 1"
                     " or (prev_stop_id is null) <> (stop_id = 0)").count() == 0
    # ties in the first column are cut by the second
    tied = df.withColumn("order", F.lit(3).cast("long"))
    assert rows(ordered_neighbours(tied, ["line"], ["order", "stop_id"], ["stop_id"], blocks=blocks),
                "stop_id", "prev_stop_id", "next_stop_id") == rows(got, "stop_id", "prev_stop_id", "next_stop_id")


def test_ranges_of_a_hot_line_among_many(spark):
    """One line has a third of all rows, thousands of lines share the rest: no range holds more than its share."""
    from tributary.operators import window

    n, blocks = 30_000, 16
    line = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("l"), (F.col("id") % 4001).cast("string")))
    df = spark.range(n).select(line.alias("line"), F.col("id").alias("order"), (F.col("id") * 7 % n).alias("stop_id"))
    d = window._ranges(df.withColumn("__k", F.struct("line")), ["order", "stop_id"], blocks)
    sizes = {r["__blk"]: r["count"] for r in d.groupBy("__blk").count().collect()}
    assert max(sizes.values()) < 2 * n / blocks and sum(sizes.values()) == n
    assert d.where("line = 'hot'").select("__blk").distinct().count() >= blocks // 4
    w = Window.partitionBy("line").orderBy("order", "stop_id")
    want = df.select("line", "stop_id", F.lag("stop_id").over(w).alias("prev_stop_id"), F.lead("stop_id").over(w).alias("next_stop_id"))
    got = ordered_neighbours(df, ["line"], ["order", "stop_id"], ["stop_id"], blocks=blocks)
    assert rows(got, *want.columns) == rows(want)


def test_numbered_is_the_place_in_the_order(spark):
    from tributary.operators.order import numbered, order_stops

    df = spark.createDataFrame([(None if i % 11 == 0 else i * 37 % 50, i) for i in range(500)], "order int, stop_id int")
    want = df.withColumn("position", F.row_number().over(Window.orderBy(F.col("order").asc_nulls_last(), "stop_id")))
    got = numbered(order_stops(df.repartition(7)))
    assert rows(got, "order", "stop_id", "position") == rows(want)
    # the position is that of the given order, whatever it is
    down = numbered(df.repartition(5).orderBy(F.col("stop_id").desc()), "place")
    assert rows(down, "stop_id", "place") == sorted(((i, 500 - i) for i in range(500)), key=repr)
    assert numbered(order_stops(df.where("false"))).count() == 0
    # no window sees more rows than the sort has partitions
    assert "rangepartitioning" not in got._jdf.queryExecution().executedPlan().toString()


def test_clashes_with_a_stored_table(spark):
    from tributary.functions.decode import clashes, maybe_among

    stored = spark.range(50_000).select((F.col("id") * 2).alias("a"), F.lit("x").alias("b"), F.lit(1).alias("other"))
    stored = stored.unionByName(spark.createDataFrame([(None, "x", 1), (4, "x", 2)], "a long, b string, other int"))
    new = spark.createDataFrame([(1, "x", "n1"), (4, "x", "n2"), (4, "x", "n3"), (4, "y", "n4"), (None, "x", "n5"), (99_998, "x", "n6")],
                                "a long, b string, name string")
    assert rows(clashes(new, stored, ["a", "b"]), "name") == [("n2",), ("n3",), ("n6",)]
    # the bitmap leaves out nearly all of the stored rows, and none that matters
    left = maybe_among(stored, new, ["a", "b"])
    assert left.count() < 50 and left.where("a in (4, 99998)").count() == 3
    # a tiny bitmap lets more through, the result stays
    assert maybe_among(stored, new, ["a", "b"], bits=15).count() >= left.count()
    assert clashes(new.where("false"), stored, ["a", "b"]).count() == 0
    assert clashes(new, stored.where("false"), ["a", "b"]).count() == 0


def test_first_by_name(spark):
    df = spark.createDataFrame([("a", 1, 10), ("b", 2, 20), ("a", 3, 30), ("b", 0, 40)], "name string, o int, id int")
    got = rows(first_by_name(df, [], "name", "o", ["id"]), "name", "id", "first_seen")
    assert got == [("a", 10, 1), ("b", 40, 0)]


def test_expected_entries_golden(spark, fixture_path):
    seed = read_ridership(spark, fixture_path("ridership_seed.csv"))
    curve = read_curve(spark, fixture_path("ridership_curve.csv"))
    assert curve.count() == 25
    ticks = spark.createDataFrame([(40380, dt.datetime(2024, 1, 3, h, 0)) for h in (7, 8, 9, 23)],
                                  "station_id int, ts timestamp")
    ticks = ticks.unionByName(spark.createDataFrame([(40380, dt.datetime(2024, 1, 3, 0, 0))], ticks.schema))
    out = T.expected_entries(ticks, seed, curve, 300)
    got = {r["hour"]: r["entries"] for r in out.collect()}
    assert (got[7], got[8], got[9]) == (5, 9, 5)
    assert 24 not in got


def test_rounding_calendar_and_slug(spark):
    df = spark.createDataFrame([(2.5, 3.5, dt.datetime(2024, 1, 6), "Harlem/Lake"),
                                (-0.5, 1.49, dt.datetime(2024, 1, 7), "O'Hare Airport-Terminal")],
                               "a double, b double, ts timestamp, name string")
    got = df.select(whole_rides("a").alias("a"), whole_rides("b").alias("b"),
                    day_kind("ts", "reference").alias("ref"), day_kind("ts", "corrected").alias("fix"),
                    slug("name").alias("slug"), step_entries(F.lit(10), F.lit(0.5), F.lit(3)).alias("e")).collect()
    assert [tuple(r) for r in got] == [(2, 4, "weekday", "saturday", "harlem_and_lake", 1),
                                      (0, 1, "weekday", "sunday", "ohare_airport_terminal", 1)]


def _arrivals(spark, items):
    """items: (seq, line, station, direction, train, status, prev_station, prev_direction)"""
    return spark.createDataFrame(items, "offset long, line string, station_id int, direction string, "
                                        "train_id string, train_status string, prev_station_id int, "
                                        "prev_direction string")


def test_slot_occupancy_semantics(spark):
    arr = _arrivals(spark, [
        (1, "blue", 1, "a", "BL1", "in_service", None, None),
        (2, "blue", 2, "a", "BL1", "in_service", 1, "a"),          # clears 1/a, sets 2/a
        (3, "blue", 5, "x", "BL2", "broken_down", None, None),     # 'x' is the b slot
        (4, "blue", 5, "b", "BL3", "in_service", 2, "a"),          # clears 2/a (other train), sets 5/b
        (5, "blue", 7, "a", "BL4", "in_service", 7, "a"),          # clear then set in one event
        (6, "red", 1, "a", "RL1", "out_of_service", None, "a"),    # prev station null: no clear
        (7, "blue", 9, "b", "BL5", "in_service", 9, None),         # prev direction null: no clear
    ])
    got = {(r["line"], r["station_id"], r["direction"]): (r["train_id"], r["train_status"])
           for r in slot_occupancy(arr).collect()}
    assert got[("blue", 1, "a")] == (None, None)
    assert got[("blue", 2, "a")] == (None, None)
    assert got[("blue", 5, "b")] == ("BL3", "in service")
    assert got[("blue", 7, "a")] == ("BL4", "in service")
    assert got[("red", 1, "a")] == ("RL1", "out of service")
    assert got[("blue", 9, "b")] == ("BL5", "in service")


def test_counts_and_upserts(spark):
    df = spark.createDataFrame([(1, "k1", 1), (1, "k2", 2), (None, "k3", 3), (2, "k1", 4)],
                               "station_id int, msg string, o int")
    assert rows(running_count(df, "station_id")) == [(1, 2), (2, 1)]
    # table semantics: k1's later message (station 2) replaces its earlier one (station 1)
    assert rows(upsert_count(df, "msg", "station_id", "o")) == [(1, 1), (2, 1)]


def test_weather_defaults_and_latest(spark):
    empty = spark.createDataFrame([], "offset long, temperature float, status string")
    assert [tuple(r) for r in current_weather(empty).collect()] == [(70.0, "sunny")]
    env = env_rows(spark, [{"temperature": 61.7, "status": "partly_cloudy"},
                           {"temperature": -3.9, "status": "windy"}])
    got = T.weather_display(env).collect()
    assert [tuple(r) for r in got] == [(-3, "Windy")]


def test_board_defaults_unknown_stations_and_weather(spark):
    st = spark.createDataFrame([("blue", 1, "A", 0), ("blue", 2, "B", 1), ("red", 2, "B", 5)],
                               "line string, station_id int, station_name string, order int")
    slots = spark.createDataFrame([("blue", 1, "a", "BL1"), ("blue", 99, "a", "BL9"), ("red", 2, "b", None)],
                                  "line string, station_id int, direction string, train_id string")
    counts = spark.createDataFrame([(2, 7)], "station_id int, count long")
    weather = spark.createDataFrame([(71.9, "sunny")], "temperature double, status string")
    b = {(r["line"], r["station_id"]): r for r in status_board(st, slots, counts, weather).collect()}
    assert len(b) == 3  # the arrival at unknown station 99 never shows
    assert (b[("blue", 1)]["train_a"], b[("blue", 1)]["train_b"], b[("blue", 1)]["entries"]) == ("BL1", "---", 0)
    assert b[("blue", 2)]["entries"] == 7 and b[("red", 2)]["entries"] == 7  # count on every line
    assert b[("red", 2)]["train_b"] == "---"
    assert b[("red", 2)]["colour_code"] == "#DC143C" and b[("blue", 1)]["line_rank"] == 0
    assert (b[("blue", 1)]["temperature"], b[("blue", 1)]["weather"]) == (71, "Sunny")


def test_summary_roundtrip(spark):
    env = env_rows(spark, [{"station_id": 5, "station_name": "x", "line": "red"}] * 3
                   + [{"station_id": 6, "station_name": "y", "line": "red"}])
    summary = T.turnstile_summary(env)
    msgs = {r["key"]: json.loads(r["value"]) for r in summary.collect()}
    assert msgs == {"5": {"STATION_ID": 5, "COUNT": 3}, "6": {"STATION_ID": 6, "COUNT": 1}}
    back = T.summary_counts(env_rows(spark, [m for m in msgs.values()]))
    assert rows(back) == [(5, 3), (6, 1)]


def _slot_model(arrivals):
    """Message-by-message replay of the board's slot rules (brute force)."""
    slots = {}
    for seq, line, st, d, train, status, pst, pd in sorted(arrivals):
        if pst is not None and pd is not None:
            slots[(line, pst, "a" if pd == "a" else "b")] = (None, None)
        slots[(line, st, "a" if d == "a" else "b")] = (train, status.replace("_", " "))
    return slots


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_slot_occupancy_matches_replay(spark, seed):
    rnd = random.Random(seed)
    items = []
    for seq in rnd.sample(range(10_000), 300):
        prev = rnd.random() < 0.8
        items.append((seq, rnd.choice(["blue", "red"]), rnd.randint(0, 6), rnd.choice(["a", "b", "c"]),
                      f"T{rnd.randint(0, 9)}", rnd.choice(S.TRAIN_STATUSES),
                      rnd.randint(0, 6) if prev else None, rnd.choice(["a", "b", None]) if prev else None))
    got = {(r["line"], r["station_id"], r["direction"]): (r["train_id"], r["train_status"])
           for r in slot_occupancy(_arrivals(spark, items)).collect()}
    assert got == _slot_model(items)


def test_arrival_prev_fields_match_replay(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    got = {r["offset"]: (r["prev_station_id"], r["prev_direction"])
           for r in E.arrivals_from_events(ev, block_width=16).collect()}
    last = {}
    want = {}
    for r in sorted(ev.select("event_id", "user_id").collect()):
        want[r["event_id"]] = last.get(r["user_id"], (None, None))
        last[r["user_id"]] = (r["event_id"] % 40, "a" if (r["event_id"] // 40) % 2 == 0 else "b")
    assert got == want


def test_board_order_and_union(spark):
    from tributary.operators.order import order_board, order_stops, union_lines
    red = spark.createDataFrame([("red", 5, "R5", 1), ("red", 4, "R4", 0)],
                                "line string, station_id int, station_name string, order int")
    blue = spark.createDataFrame([("blue", 9, "B9", 2), ("blue", 8, "B8", None)], red.schema)
    green = spark.createDataFrame([("green", 7, "G7", 0)], red.schema)
    board = order_board(union_lines(red, blue, green))
    assert [r["station_name"] for r in board.collect()] == ["B9", "B8", "G7", "R4", "R5"]
    stops = spark.createDataFrame([(3, 1), (1, 1), (2, 0)], "stop_id int, order int")
    assert [r["stop_id"] for r in order_stops(stops).collect()] == [2, 1, 3]


def test_turnstile_count_modes(spark):
    # three entries; two share a message key (same producer millisecond), so as a
    # table the later one replaces the earlier
    env = env_rows(spark, [{"station_id": 5, "station_name": "x", "line": "red"},
                           {"station_id": 6, "station_name": "y", "line": "red"},
                           {"station_id": 5, "station_name": "x", "line": "red"}],
                   keys=['{"timestamp":1}', '{"timestamp":1}', '{"timestamp":2}'])
    assert rows(T.turnstile_counts(env)) == [(5, 2), (6, 1)]
    assert rows(T.turnstile_counts(env, mode="upsert")) == [(5, 1), (6, 1)]


def test_steps_of_any_length():
    from tributary.functions.columns import total_steps

    assert total_steps(300) == 300 and total_steps(300, "corrected") == 12
    assert total_steps(7200, "corrected") == 0.5 and total_steps(7, "corrected") == pytest.approx(3600 / 7)


def _env(spark, messages):
    """(value, topic, partition, offset, second) rows as an envelope."""
    import json

    from tributary import schemas as S

    return spark.createDataFrame(
        [(None, (v if isinstance(v, str) else json.dumps(v)).encode(), topic, p, o,
          dt.datetime(2024, 1, 1) + dt.timedelta(seconds=t), None) for v, topic, p, o, t in messages], S.ENVELOPE)


def _arrival(train, line="blue", station=1):
    return {"station_id": station, "direction": "a", "line": line, "train_id": train, "train_status": "in_service",
            "prev_station_id": None, "prev_direction": None}


def test_order_across_partitions_and_topics(spark):
    """A later message wins whatever its partition's offsets are; ties go by topic, partition, offset."""
    slots = T.slot_occupancy(_env(spark, [(_arrival("OLD"), "t", 0, 100, 1), (_arrival("NEW"), "t", 1, 3, 2)]))
    assert [r["train_id"] for r in slots.collect()] == ["NEW"]
    ties = [(_arrival("A"), "t", 1, 9, 1), (_arrival("B"), "u", 0, 0, 1), (_arrival("C"), "t", 0, 50, 1)]
    assert [r["train_id"] for r in T.slot_occupancy(_env(spark, ties)).collect()] == ["B"]
    stop = lambda name: {"stop_id": 1, "stop_name": name, "station_id": 5, "order": 1, "red": True}
    stations = _env(spark, [(stop("old"), "s", 0, 70, 1), (stop("new"), "s", 2, 1, 9)])
    assert [r["station_name"] for r in T.stations_table(stations).collect()] == ["new"]
    assert [r["station_name"] for r in T.line_stations(stations).collect()] == ["new"]


def test_bad_messages_are_skipped_and_kept_as_dead_letters(spark):
    from tributary import schemas as S
    from tributary.functions.decode import dead_letters

    bad = ("garbage", "t", 0, 99, 50)
    weather = _env(spark, [({"temperature": 33.0, "status": "windy"}, "t", 0, 1, 1), bad, ("{}", "t", 0, 100, 51)])
    assert rows(T.weather_display(weather)) == [(33, "Windy")]
    assert T.stations_table(_env(spark, [bad])).count() == 0
    slots = _env(spark, [(_arrival("T1"), "t", 0, 1, 1), bad])
    assert rows(T.slot_occupancy(slots), "station_id", "train_id") == [(1, "T1")]
    assert T.turnstile_counts(_env(spark, [bad]), mode="upsert").count() == 0
    letters = dead_letters(weather, S.WEATHER)
    assert rows(letters.select("offset", F.col("value").cast("string"))) == sorted([(99, "garbage"), (100, "{}")], key=repr)
