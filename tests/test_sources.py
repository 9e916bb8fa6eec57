"""Sources and sinks: Kafka option builders (S1-S3), passthrough (S4), CSV (S5),
incremental load (S6), encoders and changelog (S10, S11), views (S12)."""

import datetime as dt
import json

import pytest
from helpers import env_rows, rows
from pyspark.sql import functions as F

from tributary import schemas as S
from tributary.functions.decode import avro_available, decode_summary, encode_record, split_malformed
from tributary.functions.decode import decode_json
from tributary.sources.jdbc import (cuts_query, high_water, incremental_slice, load_next, quantile_cuts, range_predicates,
                                   read_loads, stored_loads)
from tributary.sources.kafka import kafka_available, kafka_options, raw_messages, subscribe_pattern
from tributary.streaming.sinks import register, to_changelog


def test_kafka_options():
    o = kafka_options("b:9092", topic=S.TOPICS["risk_events"])
    assert o == {"kafka.bootstrap.servers": "b:9092", "startingOffsets": "earliest",
                 "includeHeaders": "true", "subscribe": S.TOPICS["risk_events"]}
    p = kafka_options("b:9092", pattern=S.TOPICS["arrivals_pattern"], starting="latest",
                      max_offsets_per_trigger=500)
    assert p["subscribePattern"].startswith("org") and p["startingOffsets"] == "latest"
    assert p["maxOffsetsPerTrigger"] == "500"
    with pytest.raises(ValueError):
        kafka_options("b", topic="a", pattern="b")


def test_raw_messages_null_key(spark):
    env = env_rows(spark, ["0abcs", "1abcs"], topic=S.TOPICS["passthrough"], keys=[None, "k"])
    got = rows(raw_messages(env), "key", "value", "topic")
    assert got == sorted([(None, "0abcs", S.TOPICS["passthrough"]), ("k", "1abcs", S.TOPICS["passthrough"])], key=repr)


def test_incremental_loads_lose_and_repeat_nothing(spark):
    df = spark.createDataFrame([(i, f"s{i}") for i in (3, 1, 7, 5)], "stop_id int, name string")
    mark = high_water(df, "stop_id").first()["high_water"]  # first load: no mark yet
    assert mark == 7
    more = df.unionByName(spark.createDataFrame([(9, "s9")], df.schema))  # comes in between mark and slice
    first = incremental_slice(more, "stop_id", None, mark, ordered=True)
    assert [r["stop_id"] for r in first.collect()] == [1, 3, 5, 7]
    second_mark = high_water(more, "stop_id", mark).first()["high_water"]
    assert second_mark == 9
    assert [r["stop_id"] for r in incremental_slice(more, "stop_id", mark, second_mark).collect()] == [9]
    # nothing new: no row, and the mark stays, also where an update has lowered the largest value
    assert high_water(df, "stop_id", 9).first()["high_water"] == 9
    assert incremental_slice(df, "stop_id", 9, 9).count() == 0
    assert high_water(df.where("false"), "stop_id").first()["high_water"] is None


def test_incremental_marks_of_other_types(spark):
    times = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    df = spark.createDataFrame([(t, t.isoformat()) for t in times], "at timestamp, name string")
    assert incremental_slice(df, "at", times[0], times[2]).count() == 2
    assert [r["name"] for r in incremental_slice(df, "name", times[0].isoformat(), times[1].isoformat()).collect()] == [
        times[1].isoformat()]


def test_connections_get_equal_shares_of_sparse_ids(spark):
    """A thousand ids under a thousand, and as many spread over a billion: equal widths would put half of the rows, and a
    quarter of them again, into single connections."""
    ids = [*range(1000), *range(10 ** 9, 10 ** 9 + 1000 * 10 ** 6, 10 ** 6)]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    cuts = quantile_cuts(df, "id", 8)
    predicates = range_predicates("id", None, ids[-1], cuts)
    sizes = [df.where(p.replace('"', "`")).count() for p in predicates]
    assert len(sizes) == 8 and sum(sizes) == len(ids) and max(sizes) <= 2 * len(ids) / 8
    # of a slice only the cuts inside it matter, and every row of it meets one predicate
    predicates = range_predicates("id", 400, 10 ** 9 + 5, cuts)
    assert predicates[0].startswith('"id" > 400') and predicates[-1].endswith(f'"id" <= {10 ** 9 + 5}')
    assert sum(df.where(p.replace('"', "`")).count() for p in predicates) == 599 + 1
    assert range_predicates("id", 3, 3, [3]) == ['"id" > 3 AND "id" <= 3']


def test_ranges_of_other_types():
    days = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    assert range_predicates("at", days[0], days[2], [days[1]]) == [
        "\"at\" > TIMESTAMP '2024-01-01 00:00:00' AND \"at\" <= TIMESTAMP '2024-01-02 00:00:00'",
        "\"at\" > TIMESTAMP '2024-01-02 00:00:00' AND \"at\" <= TIMESTAMP '2024-01-03 00:00:00'"]
    assert range_predicates("name", None, "o'x", ["b"]) == ["\"name\" <= 'b'", "\"name\" > 'b' AND \"name\" <= 'o''x'"]
    asked = cuts_query("stations", "stop_id", 40000, 50000, 16)
    assert 'ntile(16) OVER (ORDER BY "stop_id")' in asked and '"stop_id" > 40000 AND "stop_id" <= 50000' in asked


def test_the_cuts_query_in_a_database():
    """The SQL text that a database gets, run by DuckDB over a table in memory."""
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT range * range AS id FROM range(1000)")
    cuts = [r[0] for r in con.execute("SELECT * FROM " + cuts_query("t", "id", 99, 810_000, 10)).fetchall()]
    sizes = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in range_predicates("id", 99, 810_000, cuts)]
    assert len(sizes) == 10 and sum(sizes) == 891 and max(sizes) - min(sizes) <= 1


def test_a_mark_lives_and_dies_with_its_load(spark, tmp_path):
    path = str(tmp_path / "stations")
    at = lambda n: dt.datetime(2024, 1, n)
    source = lambda ids: spark.createDataFrame([(i, at(i)) for i in ids], "id long, at timestamp")

    def state():
        return {n: m for n, m in stored_loads(spark, path).items()}

    load_next(path, "at", lambda last: source([]))
    assert state() == {}
    load_next(path, "at", lambda last: source([1, 3]))
    assert rows(read_loads(spark, path), "id", "load") == [(1, 1), (3, 1)]
    # broken off after files were written, before the commit: neither its rows nor its mark count
    load_next(path, "at", lambda last: source([1, 3, 5, 7]))
    (tmp_path / "stations" / "load=2" / "_SUCCESS").unlink()
    assert list(state()) == [1] and read_loads(spark, path).count() == 2

    # broken off in the middle of the job
    def failing(last):
        rows_ = source([1, 3, 5, 7])
        if last is None:
            return rows_
        bad = F.udf(lambda i: 1 // 0 if i == 7 else i, "long")
        return rows_.withColumn("id", bad("id"))

    with pytest.raises(Exception):
        load_next(path, "at", failing)
    assert list(state()) == [1] and read_loads(spark, path).count() == 2
    # repeated from the mark before it, with what has come in between
    load_next(path, "at", lambda last: source([1, 3, 5, 7, 8]))
    assert rows(read_loads(spark, path), "id", "load") == [(1, 1), (3, 1), (5, 2), (7, 2), (8, 2)]
    load_next(path, "at", lambda last: source([1, 3, 5, 7, 8]))  # nothing new
    assert list(state()) == [1, 2]
    assert [r["high_water"] for r in read_loads(spark, path).select(F.col("high_water").cast("timestamp").alias("high_water"))
            .distinct().orderBy("high_water").collect()] == [at(3), at(8)]


def test_bad_lines_go_to_quarantine(spark, tmp_path):
    from tributary.sources.files import CORRUPT, read_csv, read_csv_checked, split_corrupt

    schema = S._s(("id", S.IntegerType()), ("name", S.StringType()), ("order", S.IntegerType()))
    lines = ["id,name,order", '1,"a, b",10', "x,c,20", "2,d", "3,e,30,40", "4,,", '5,"q""uote",50', "6,f,1.5"]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    checked = read_csv_checked(spark, str(tmp_path / "a.csv"), schema)
    good, bad = split_corrupt(checked)
    assert rows(good) == [(1, "a, b", 10), (4, None, None), (5, 'q"uote', 50)]
    assert sorted(r["line"] for r in bad.collect()) == ["2,d", "3,e,30,40", "6,f,1.5", "x,c,20"]
    # the verdict on a line doesn't depend on the columns that are asked for
    assert good.select("id").count() == 3 and bad.count() == 4 and checked.count() == 7
    assert rows(checked.where(F.col(CORRUPT).isNull()).select("id")) == [(1,), (4,), (5,)]
    assert rows(checked.select(CORRUPT).where(F.col(CORRUPT).isNotNull()).select(F.length(CORRUPT))) == [(3,), (6,), (7,), (9,)]
    # without the check bad values become nulls in silence
    assert read_csv(spark, str(tmp_path / "a.csv"), schema).where("id is null").count() == 1


def test_records_and_changelog(spark):
    df = spark.createDataFrame([(1700000000000, 55.5, "sunny")], "timestamp long, temperature double, status string")
    r = encode_record(df, ["timestamp"], ["temperature", "status"]).first()
    assert json.loads(r["key"]) == {"timestamp": 1700000000000}
    assert json.loads(r["value"]) == {"temperature": 55.5, "status": "sunny"}
    st = spark.createDataFrame([(40020, "Harlem", 0, "green")], S.TRANSFORMED_STATION)
    c = to_changelog(st, ["station_id"]).first()
    assert c["key"] == "40020" and json.loads(c["value"])["line"] == "green"


def test_dead_letter_split(spark):
    env = env_rows(spark, ['{"STATION_ID": 1, "COUNT": 2}', "garbage", '{"station_id": 3}'])
    good, bad = split_malformed(decode_summary(env, lower=False), ["STATION_ID", "COUNT"])
    assert rows(good) == [(1, 2)] and bad.count() == 2


def test_register_view(spark):
    env = env_rows(spark, [{"customer": "a@x", "score": "1.0", "riskDate": "2022-01-07"}])
    register(decode_json(env, S.RISK_EVENT), "CustomerRisk")
    r = spark.sql("select * from CustomerRisk").first()
    assert (r["customer"], r["riskDate"]) == ("a@x", dt.date(2022, 1, 7))


def test_connector_packages_are_optional(spark):
    # Neither external package ships with the image; both checks must answer, not fail.
    assert kafka_available(spark) in (True, False)
    assert avro_available(spark) in (True, False)


def test_subscribe_pattern(spark):
    a = env_rows(spark, ["x"], topic=S.TOPICS["arrivals"])
    b = env_rows(spark, ["y"], topic=S.TOPICS["stations"])
    got = subscribe_pattern(a.unionByName(b), S.TOPICS["arrivals_pattern"])
    assert [r["topic"] for r in got.collect()] == [S.TOPICS["arrivals"]]


def test_subscribe_pattern_matches_whole_names(spark):
    env = env_rows(spark, ["x"], topic="a.arrivals.v1").unionByName(env_rows(spark, ["y"], topic="b.a.arrivals.v1"))
    assert subscribe_pattern(env, r"a\.arrivals").count() == 0
    assert [r["topic"] for r in subscribe_pattern(env, r"a\.arrivals\..*").collect()] == ["a.arrivals.v1"]


def test_salting_needs_its_columns(spark):
    from tributary.operators.joins import join_risk

    risk = spark.createDataFrame([("a", "1")], "customer string, score string")
    customers = spark.createDataFrame([("a", "1960")], "email string, birthYear string")
    assert join_risk(risk, customers).count() == 1
    with pytest.raises(ValueError, match="salting"):
        join_risk(risk, customers, salt=4)


def test_no_machine_local_checkpoints_on_a_cluster():
    from tributary.session import checkpoint_root

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://m:7077"
        getConf = lambda self: Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_kafka_writers_reach_the_connector(spark, tmp_path):
    """S8 and S9 hand their rows to Spark's Kafka writer; where its package is absent, that is what they fail of."""
    from tributary.sources.files import envelope_stream, write_envelope
    from tributary.streaming.sinks import publish, to_kafka

    if kafka_available(spark):
        pytest.skip("the connector is present, and there is no broker to write to")
    env = env_rows(spark, ["x"], keys=["k"])
    with pytest.raises(Exception, match="(?i)kafka"):
        publish(env.select("key", "value", "partition", "topic"), "localhost:9", "t")
    path = write_envelope(env, str(tmp_path / "topic"))
    with pytest.raises(Exception, match="(?i)kafka"):
        to_kafka(envelope_stream(spark, path).select("key", "value"), "localhost:9", "t", str(tmp_path / "ckpt"))
