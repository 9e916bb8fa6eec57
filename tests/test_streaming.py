"""Batch-vs-stream equivalence and restart from checkpoint.

Each topic is written as several parquet files in the envelope shape and read
back as a file stream one file per trigger, so state crosses micro-batches.
"""

import os
import uuid

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tributary.plans import encode as E
from tributary.plans import risk as R
from tributary.plans import transit as T
from tributary.session import checkpoint_root
from tributary.sources.files import envelope_stream, write_envelope
from tributary.sources.tables import table
from tributary.streaming import jobs

SF = "/root/testdata/sf0.001"


def _dir(spark, name):
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:8]}")


def _topic(spark, env, files, name):
    path = _dir(spark, name)
    write_envelope(env, path, files)
    return path


@pytest.fixture(scope="module")
def events(spark):
    return table(spark, SF, "events")


def test_q1_stream_join_equals_batch_and_restart_adds_nothing(spark, events):
    cust = table(spark, SF, "customer")
    ev_env, cu_env = E.risk_event_messages(events), E.customer_sorted_set_messages(cust)
    want = rows(R.risk_graph(ev_env, cu_env))
    # first half of the events, then the rest arrives after a restart
    ev_path = _topic(spark, ev_env.where(F.col("offset") % 2 == 0), 3, "events")
    cu_path = _topic(spark, cu_env, 2, "customers")
    out, ckpt = _dir(spark, "q1-out"), _dir(spark, "q1-ckpt")

    def run():
        q = R.risk_graph(envelope_stream(spark, ev_path, 1), envelope_stream(spark, cu_path, 1))
        jobs.run_append(q, out, ckpt)

    run()
    half = rows(spark.read.parquet(out))
    assert half == rows(R.risk_graph(ev_env.where(F.col("offset") % 2 == 0), cu_env))
    write_envelope(ev_env.where(F.col("offset") % 2 == 1), ev_path, 2)
    run()
    run()  # nothing new: no duplicates
    assert rows(spark.read.parquet(out)) == want


def test_q3_stateless_stream(spark, events):
    env = E.risk_event_messages(events)
    path, out = _topic(spark, env, 4, "risk"), _dir(spark, "q3-out")
    jobs.run_append(R.risk_events(envelope_stream(spark, path, 1)), out, _dir(spark, "ckpt"))
    assert rows(spark.read.parquet(out)) == rows(R.risk_events(env))


def test_a5_slots_update_mode_equals_batch(spark, events):
    env = E.arrival_messages(events)
    path, out = _topic(spark, env, 5, "arrivals"), _dir(spark, "slots")
    jobs.run_table(T.slot_occupancy(envelope_stream(spark, path, 1)),
                   ["line", "station_id", "direction"], out, _dir(spark, "ckpt"))
    assert rows(jobs.read_table(spark, out, ["line", "station_id", "direction"])) == rows(T.slot_occupancy(env))


def test_q4_station_table_update_mode_equals_batch(spark):
    env = E.station_messages(table(spark, SF, "part"))
    path, out = _topic(spark, env, 4, "stations"), _dir(spark, "stations")
    jobs.run_table(T.stations_table(envelope_stream(spark, path, 1)), ["station_id"], out, _dir(spark, "ckpt"))
    got = jobs.read_table(spark, out, ["station_id"]).select("station_id", "station_name", "order", "line")
    assert rows(got) == rows(T.stations_table(env))


def test_q5_counts_update_mode_equals_batch(spark, events):
    env = E.turnstile_messages(events)
    path, out = _topic(spark, env, 3, "turnstile"), _dir(spark, "counts")
    jobs.run_table(T.turnstile_counts(envelope_stream(spark, path, 1)), ["station_id"], out, _dir(spark, "ckpt"), compact_every=2)
    assert rows(jobs.read_table(spark, out, ["station_id"])) == rows(T.turnstile_counts(env))


def test_a2_upsert_count_stream_equals_batch(spark, events):
    from tributary.operators.state import upsert_count
    msgs = events.select(F.date_trunc("minute", "ts").alias("msg_key"), "user_id", "event_id")
    path = _dir(spark, "a2-src")
    msgs.repartition(4).write.parquet(path)
    stream = spark.readStream.schema(msgs.schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = _dir(spark, "a2")
    jobs.run_upsert_count(stream, ["msg_key"], "user_id", "event_id", out, _dir(spark, "ckpt"), compact_every=3)
    got = jobs.read_upsert_count(spark, out, "user_id")
    assert rows(got) == rows(upsert_count(msgs, "msg_key", "user_id", "event_id"))


def test_a_newer_message_takes_back_what_the_older_counted(spark):
    """Messages out of order, with nulls, moves between keys, repeats and a hot message key, over several batches."""
    import random

    from tributary.operators.state import upsert_count

    rnd = random.Random(5)
    data = [(rnd.choice(["a", "b", "c", "hot", "hot", "hot", None]), rnd.choice([1, 2, 3, None]), n if n % 50 else None)
            for n in rnd.sample(range(600), 600)]
    schema = "msg string, k int, at int"
    src, out, ckpt = _dir(spark, "retract-src"), _dir(spark, "retract"), _dir(spark, "ckpt")
    seen = []
    for part in (data[:200], data[200:210], data[210:]):
        spark.createDataFrame(part, schema).repartition(3).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        jobs.run_upsert_count(stream, ["msg"], "k", "at", out, ckpt, compact_every=2)
        seen += part
        want = upsert_count(spark.createDataFrame([r for r in seen if r[2] is not None], schema), "msg", "k", "at")
        assert rows(jobs.read_upsert_count(spark, out, "k")) == rows(want)
    # a message that takes its key out of all counts
    spark.createDataFrame([("hot", None, 10_000)], schema).write.mode("append").parquet(src)
    jobs.run_upsert_count(spark.readStream.schema(schema).parquet(src), ["msg"], "k", "at", out, ckpt, compact_every=2)
    want = upsert_count(spark.createDataFrame([r for r in seen if r[2] is not None] + [("hot", None, 10_000)], schema), "msg", "k", "at")
    assert rows(jobs.read_upsert_count(spark, out, "k")) == rows(want)
    # the log holds changes of counts, not messages
    log = [f"{out}/log/__version={v}" for v in sinks_versions(spark, out)]
    assert spark.read.option("basePath", f"{out}/log").parquet(*log).columns[:2] == ["k", "count"]


def sinks_versions(spark, path):
    from tributary.streaming import sinks

    return [v for v in sinks._versions(spark, f"{path}/log") if sinks._buckets(spark, f"{path}/log/__version={v}")]


def test_checked_topic_rows_and_dead_letters(spark):
    """Both outputs of every batch, once each, across a restart and a repeated batch."""
    from helpers import env_rows
    from tributary import schemas as S
    from tributary.functions.decode import check_messages
    from tributary.streaming import sinks

    path, out, ckpt = _dir(spark, "checked-src"), _dir(spark, "checked"), _dir(spark, "ckpt")
    write_envelope(env_rows(spark, ['{"STATION_ID": 1, "COUNT": 2}', "junk", None]), path)

    def run():
        jobs.run_checked(envelope_stream(spark, path), S.TURNSTILE_SUMMARY, out, ckpt)
        return (rows(jobs.read_checked_rows(spark, out, S.TURNSTILE_SUMMARY), "STATION_ID", "COUNT"),
                rows(jobs.read_dead_letters(spark, out, S.TURNSTILE_SUMMARY).select("offset", F.col("value").cast("string").alias("v")), "offset", "v"))

    assert jobs.read_checked_rows(spark, out, S.TURNSTILE_SUMMARY).count() == 0
    assert run() == ([(1, 2)], [(1, "junk"), (2, None)])
    more = env_rows(spark, ['{"STATION_ID": 3, "COUNT": 4}', "{", '{"COUNT": 9}'], start_offset=10)
    write_envelope(more, path)
    want = ([(1, 2), (3, 4), (None, 9)], [(1, "junk"), (11, "{"), (2, None)])
    assert run() == want
    assert run() == want  # nothing new
    # a batch that is repeated replaces both outputs; one that wasn't committed counts in neither
    write = sinks.checked_writer(out)
    write(check_messages(more, S.TURNSTILE_SUMMARY), 1)
    assert run() == want
    write(check_messages(env_rows(spark, ["x", '{"COUNT": 1}']), S.TURNSTILE_SUMMARY), 7)
    os.unlink(f"{out}/__version=7/_SUCCESS")
    assert run() == want


def test_expiring_join_drops_state(spark):
    """State rows fall while the topics go on; every pair within the range is found, late scores included."""
    from tributary.plans import catalog

    root = _dir(spark, "expiring")
    held = []
    for q in catalog.expiring_join_runs(spark, SF, root):
        progress = [p for p in q.recentProgress if p["stateOperators"]]
        held += [p["stateOperators"][0]["numRowsTotal"] for p in progress]
        assert all(p["stateOperators"][0]["numRowsDroppedByWatermark"] == 0 for p in progress)
    total = table(spark, SF, "events").count() + table(spark, SF, "customer").count()
    assert max(held) < 0.8 * total and held[-1] < max(held)
    ev = E.risk_event_messages(table(spark, SF, "events"))
    cu = E.customer_sorted_set_messages(table(spark, SF, "customer"), spread_days=catalog.SLICES * catalog.SLICE_DAYS)
    bound = {"delay": "10 days", "range": f"{catalog.RANGE_DAYS} days"}
    assert rows(spark.read.parquet(f"{root}/out")) == rows(R.risk_graph(ev, cu, bound=bound))



def test_join_partition_keeps_one_state_store(spark):
    """A join's state is one store a partition (four before); a query goes on in the format that it started with, and
    other state stores keep Spark's format."""
    from tributary import session

    key, provider = "spark.sql.streaming.join.stateFormatVersion", "spark.sql.streaming.stateStore.providerClass"
    ev, cu = E.risk_event_messages(table(spark, SF, "events")), E.customer_sorted_set_messages(table(spark, SF, "customer"))
    ev_path, cu_path = _topic(spark, ev.where("offset % 2 = 0"), 1, "sev"), _topic(spark, cu, 1, "scu")
    runs = {"2": (_dir(spark, "sout"), _dir(spark, "sckpt")), "3": (_dir(spark, "sout"), _dir(spark, "sckpt"))}

    def run(out, checkpoint):
        q = jobs.run_append(R.risk_graph(envelope_stream(spark, ev_path), envelope_stream(spark, cu_path)), out, checkpoint)
        state = [s for p in q.recentProgress for s in p["stateOperators"]]
        return {s["numStateStoreInstances"] // s["numShufflePartitions"] for s in state}

    kept, stores = spark.conf.get(key), spark.conf.get(provider)
    try:
        spark.conf.set(key, "2")
        assert run(*runs["2"]) == {4}
        session.configure(spark)
        assert spark.conf.get(key) == "3" and run(*runs["3"]) == {1}
        write_envelope(ev.where("offset % 2 = 1"), ev_path)
        assert run(*runs["2"]) == {4} and run(*runs["3"]) == {1}
        spark.conf.set(key, "2")
        spark.conf.set(provider, "org.example.AnotherProvider")
        session.configure(spark)
        assert spark.conf.get(key) == "2"
    finally:
        spark.conf.set(key, kept)
        spark.conf.set(provider, stores)
    want = rows(R.risk_graph(ev, cu))
    assert all(rows(spark.read.parquet(out)) == want for out, _ in runs.values())


def test_bounded_join_keeps_close_pairs_only(spark):
    import datetime as dt
    import json

    from helpers import sorted_set
    from tributary import schemas as S

    def env(values, times, topic):
        return spark.createDataFrame(
            [(None, json.dumps(v).encode(), topic, 0, i, t, None) for i, (v, t) in enumerate(zip(values, times))],
            S.ENVELOPE)

    t0 = dt.datetime(2024, 1, 1)
    cu = env([sorted_set({"email": "a@x", "birthDay": "1960-01-01"}),
              sorted_set({"email": "b@x", "birthDay": "1961-01-01"})], [t0, t0], S.TOPICS["customers"])
    ev = env([{"customer": "a@x", "score": "1.0"}, {"customer": "b@x", "score": "2.0"}],
             [t0 + dt.timedelta(hours=2), t0 + dt.timedelta(days=3)], S.TOPICS["risk_events"])
    ev_path, cu_path, out = _topic(spark, ev, 1, "bev"), _topic(spark, cu, 1, "bcu"), _dir(spark, "bout")
    bound = {"delay": "1 hour", "range": "1 day"}
    q = R.risk_graph(envelope_stream(spark, ev_path), envelope_stream(spark, cu_path), bound=bound)
    jobs.run_append(q, out, _dir(spark, "ckpt"))
    assert [r["key"] for r in spark.read.parquet(out).collect()] == ["a@x"]
    # unbounded (the default) keeps every pair regardless of time
    assert sorted(r["key"] for r in R.risk_graph(ev, cu).collect()) == ["a@x", "b@x"]


def test_q6_board_from_streamed_tables_equals_batch(spark, events):
    part = table(spark, SF, "part")
    envs = T.board_inputs(part, events)
    paths = [_topic(spark, e, 3, n) for e, n in zip(envs, ["st", "arr", "turn", "wx"])]
    root = _dir(spark, "board")
    T.run_board_tables(*[envelope_stream(spark, p, 1) for p in paths], root)
    got = T.board_from_tables(spark, root)
    want = T.line_status_board(*envs)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.select(*want.columns)) == rows(want)


def test_console_sink_and_processing_time_trigger(spark, events):
    from tributary.streaming.run import run_stream
    from tributary.streaming.sinks import to_console

    env = E.risk_event_messages(events.limit(50))
    path = _topic(spark, env, 2, "console")
    q = to_console(R.risk_events(envelope_stream(spark, path)), trigger={"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None
    q2 = run_stream(R.risk_events(envelope_stream(spark, path, 1)), sink="memory", query_name="cadence",
                    trigger={"processingTime": "1 second"}, wait=False)
    try:
        q2.processAllAvailable()
        assert spark.table("cadence").count() == 50
    finally:
        q2.stop()


def test_customer_arriving_after_the_score_still_joins(spark):
    import json

    from helpers import sorted_set
    from tributary import schemas as S

    def env(values, topic, start=0):
        return spark.createDataFrame(
            [(None, json.dumps(v).encode(), topic, 0, start + i, None, None) for i, v in enumerate(values)],
            S.ENVELOPE)

    ev_path = _topic(spark, env([{"customer": "late@x", "score": "3.5"}], S.TOPICS["risk_events"]), 1, "late-ev")
    cu_path = _topic(spark, env([sorted_set({"email": "early@x", "birthDay": "1970-01-01"})],
                                S.TOPICS["customers"]), 1, "late-cu")
    out, ckpt = _dir(spark, "late-out"), _dir(spark, "late-ckpt")

    def run():
        q = R.risk_graph(envelope_stream(spark, ev_path), envelope_stream(spark, cu_path))
        jobs.run_append(q, out, ckpt)

    run()  # the score is in state, no customer yet
    assert spark.read.parquet(out).count() == 0
    write_envelope(env([sorted_set({"email": "late@x", "birthDay": "1971-01-01"})], S.TOPICS["customers"], 1),
                   cu_path, 1)
    run()  # the customer arrives in a later batch and meets the stored score
    got = [json.loads(r["value"]) for r in spark.read.parquet(out).collect()]
    assert got == [{"customer": "late@x", "score": "3.5", "email": "late@x", "birthYear": "1971"}]


def test_sinks_that_outlive_the_query_need_a_checkpoint(spark, events):
    from tributary.streaming.run import run_stream

    path = _topic(spark, E.risk_event_messages(events.limit(5)), 1, "needs")
    with pytest.raises(ValueError, match="checkpoint"):
        run_stream(R.risk_events(envelope_stream(spark, path)), sink="parquet", path=_dir(spark, "out"))


def test_changelog_reads_only_complete_versions(spark):
    from tributary.streaming import sinks

    path = _dir(spark, "log")
    assert sinks.read_changelog_table(spark, path, ["k"]) is None
    write = sinks.changelog_writer(path, ["k"], None, compact_every=2)
    frame = lambda rows_: spark.createDataFrame(rows_, "k int, v string")
    for batch in range(7):
        write(frame([(batch % 3, f"v{batch}"), (9, f"w{batch}")]), batch)
    want = [(0, "v6"), (1, "v4"), (2, "v5"), (9, "w6")]
    assert rows(sinks.read_changelog_table(spark, path, ["k"])) == want
    # log below the snapshot before the last is gone
    assert sinks._versions(spark, f"{path}/snap")[-2:] == [3, 5] and sinks._versions(spark, f"{path}/log") == [4, 5, 6]
    # a half-written snapshot and a half-written batch don't count
    frame([(0, "half")]).write.parquet(f"{path}/snap/__version=6/__bucket=0")
    frame([(0, "half")]).write.parquet(f"{path}/log/__version=7/__bucket=0")
    assert rows(sinks.read_changelog_table(spark, path, ["k"])) == want
    write(frame([(0, "v7")]), 7)  # the replay of the lost batch overwrites it
    write(frame([(0, "v7")]), 7)
    assert rows(sinks.read_changelog_table(spark, path, ["k"])) == [(0, "v7"), *want[1:]]


def test_compaction_rewrites_only_the_buckets_that_changed(spark):
    from tributary.streaming import sinks

    path = _dir(spark, "buckets")
    write = sinks.changelog_writer(path, ["k"], None, compact_every=1, buckets=8)
    frame = lambda rows_: spark.createDataFrame(rows_, "k int, v string")
    table_ = {k: "v0" for k in range(200)}
    write(frame(list(table_.items())), 0)
    held = lambda v: sinks._buckets(spark, f"{path}/snap/__version={v}")
    assert held(0) == list(range(8))
    for batch in range(1, 6):
        change = {7: f"v{batch}", 200 + batch: "new"}
        write(frame(list(change.items())), batch)
        table_ |= change
        assert rows(sinks.read_changelog_table(spark, path, ["k"])) == sorted(table_.items(), key=repr)
        assert len(held(batch)) <= 2  # the buckets of two keys, whatever the table holds
    layout = sinks._Layout(spark, path)
    assert layout.floor == 5 and sorted(layout.newest(5)) == list(range(8))
    # of each bucket at most what the last and the one before it read is left
    assert sum(len(held(v)) for v in layout.snaps) <= 8 + 2
    # a batch without rows changes nothing
    write(frame([]), 6)
    assert rows(sinks.read_changelog_table(spark, path, ["k"])) == sorted(table_.items(), key=repr)
    # batch 5 is repeated with its compaction, as after a crash between the two
    write(frame([(7, "v5"), (205, "new")]), 5)
    assert rows(sinks.read_changelog_table(spark, path, ["k"])) == sorted(table_.items(), key=repr)


def test_sums_are_kept_through_compaction(spark):
    from tributary.streaming import sinks

    path = _dir(spark, "sums")
    write = sinks.changelog_writer(path, ["k"], None, compact_every=3, merge="sum", buckets=4)
    frame = lambda rows_: spark.createDataFrame(rows_, "k int, count long")
    for batch in range(8):
        write(frame([(batch % 4, 1), (9, 2), (batch % 2, -1)]), batch)
    write(frame([(3, 1), (9, 2), (1, -1)]), 7)  # repeated
    assert rows(sinks.read_changelog_table(spark, path, ["k"], merge="sum")) == [(0, -2), (1, -2), (2, 2), (3, 2), (9, 16)]
    with pytest.raises(ValueError, match="merge"):
        sinks.read_changelog_table(spark, path, ["k"], merge="product")


def test_a_failed_listing_is_raised(spark):
    from tributary.streaming import sinks

    with pytest.raises(Exception):
        sinks.read_changelog_table(spark, "nosuchscheme://x/y", ["k"])


def test_live_board(spark, events):
    """The four tables run side by side on a processing-time trigger; new input changes the board."""
    part = table(spark, SF, "part")
    envs = T.board_inputs(part, events)
    halves = [(e.where("unix_timestamp(timestamp) % 2 = 0"), e.where("unix_timestamp(timestamp) % 2 = 1")) for e in envs]
    paths = [_topic(spark, first, 1, n) for (first, _), n in zip(halves, ["lst", "larr", "lturn", "lwx"])]
    root = _dir(spark, "live")
    queries = T.run_board_tables(*[envelope_stream(spark, p, 1) for p in paths], root,
                                 trigger={"processingTime": "200 milliseconds"}, wait=False)
    try:
        assert len(queries) == 4 and all(q.isActive for q in queries)
        for q in queries:
            q.processAllAvailable()
        before = T.board_from_tables(spark, root)
        want = T.line_status_board(*[first for first, _ in halves])
        assert rows(before.select(*want.columns)) == rows(want)
        for (_, rest), p in zip(halves, paths):
            write_envelope(rest, p, 1)
        for q in queries:
            q.processAllAvailable()
        want = T.line_status_board(*envs)
        assert rows(T.board_from_tables(spark, root).select(*want.columns)) == rows(want)
    finally:
        for q in queries:
            q.stop()
