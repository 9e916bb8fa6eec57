"""Driver tables -> wire messages (the topics the operators consume).

The named queries first encode driver rows into the envelope / JSON / base64
format of the original topics and then run the engine's own decoders, so the
decode path is under test while an independent SQL oracle computes the answer
straight from the tables. Everything here is a single projection (no shuffle)
except ``arrival_messages``, whose ``prev_*`` fields need each train's previous
event (a skew-safe ordered-neighbour pass).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas as S
from ..functions.decode import encode_record
from ..operators.window import ordered_neighbours

EPOCH = 1704067200  # 2024-01-01T00:00:00Z, base of synthetic message timestamps
BIRTH_BASE = "1930-01-01"
BIRTH_SPAN_DAYS = 25000
STATION_IDS = 40    # stops map onto p_partkey % 40 stations
TURNSTILE_IDS = 37  # turnstile entries map onto event_id % 37 (ids 37-39 never counted)
SPREAD_SECONDS = 293_003  # step of customer messages that are spread over days
DIRECTION_RUN = 40  # arrivals alternate direction every 40 event ids

# Synthetic topics behind keyed tables: messages go round TOPIC_PARTITIONS partitions, so offsets clash
# between them and only the timestamp orders the topic; every GARBAGE_EVERY-th message is followed by a
# malformed one, which the tables must skip.
TOPIC_PARTITIONS = 3
GARBAGE_EVERY = 97
GARBAGE = "not a message"

# event_type -> train status / weather status (fixed mapping of the synthetic data)
TRAIN_STATUS_OF = {"error": "broken_down", "signup": "out_of_service"}  # others: in_service
WEATHER_OF = {"view": "sunny", "click": "partly_cloudy", "purchase": "cloudy",
              "error": "windy", "signup": "precipitation"}


def envelope(df: DataFrame, value: Column, topic: str, offset: Column,
             key: Column | None = None, partition: Column | None = None,
             timestamp: Column | None = None, headers: Column | None = None) -> DataFrame:
    """Rows in the Kafka source shape."""
    hdr_type = S.ENVELOPE["headers"].dataType
    return df.select(
        (key if key is not None else F.lit(None)).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        (partition if partition is not None else F.lit(0)).cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        (timestamp if timestamp is not None else F.lit(None)).cast("timestamp").alias("timestamp"),
        (headers if headers is not None else F.lit(None)).cast(hdr_type).alias("headers"),
    )


def topic(df: DataFrame, value: Column, name: str, id_col: str, key: Column | None = None) -> DataFrame:
    """A topic of several partitions with malformed messages in it: one message per row, ordered by ``id_col``
    through the timestamp (one second per id), and garbage half a second after some of them."""
    n = F.col(id_col)
    after = F.when(n % GARBAGE_EVERY == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = df.withColumn("__body", value).withColumn("__key", key if key is not None else F.lit(None).cast("string"))
    rows = rows.withColumn("__after", F.explode(after))
    body = F.when(F.col("__after") == 0, F.col("__body")).otherwise(F.lit(GARBAGE))
    time = F.timestamp_millis((F.lit(EPOCH) + n).cast("long") * 1000 + F.col("__after") * 500)
    return envelope(rows, body, name, 2 * F.floor(n / TOPIC_PARTITIONS) + F.col("__after"), key=F.col("__key"),
                    partition=n % TOPIC_PARTITIONS, timestamp=time)


def email_of(id_col) -> Column:
    return F.concat(F.lit("u"), F.col(id_col).cast("string"), F.lit("@test.com"))


def _ts_seconds(id_col: str) -> Column:
    return F.timestamp_seconds(F.lit(EPOCH) + F.col(id_col))


# -- risk scoring --------------------------------------------------------------
def customer_sorted_set_messages(customer: DataFrame, spread_days: int | None = None) -> DataFrame:
    """One sorted-set message per customer; the customer JSON is base64 inside
    ``zSetEntries[0].element``. The messages are a second apart by key or, with ``spread_days``, spread over so
    many days (``SPREAD_SECONDS`` apart by key, round and round)."""
    birth = F.date_add(F.lit(BIRTH_BASE).cast("date"),
                       (F.col("c_custkey") % BIRTH_SPAN_DAYS).cast("int"))
    cust = F.to_json(F.struct(
        F.col("c_name").alias("customerName"),
        email_of("c_custkey").alias("email"),
        F.concat(F.lit("555-"), F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0")).alias("phone"),
        birth.alias("birthDay")))
    entry = F.struct(F.base64(cust).alias("element"), F.lit("0.0").alias("score"))
    value = F.to_json(F.struct(
        F.lit("__Customer__").alias("key"), F.lit("NotExists").alias("existType"),
        F.lit("false").alias("Ch"), F.lit(False).alias("Incr"),
        F.array(entry).alias("zSetEntries")))
    time = _ts_seconds("c_custkey") if spread_days is None else F.timestamp_seconds(
        F.lit(EPOCH) + F.col("c_custkey") * SPREAD_SECONDS % (86400 * spread_days))
    return envelope(customer, value, S.TOPICS["customers"], F.col("c_custkey"), timestamp=time)


def risk_event_messages(events: DataFrame) -> DataFrame:
    value = F.to_json(F.struct(
        email_of("user_id").alias("customer"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("score"),
        F.col("ts").cast("date").alias("riskDate")))
    return envelope(events, value, S.TOPICS["risk_events"], F.col("event_id"),
                    timestamp=F.col("ts").cast("timestamp"))


# -- transit -------------------------------------------------------------------
def stops_from_parts(part: DataFrame) -> DataFrame:
    """Station-table rows (``schemas.STATION``) from parts."""
    k = F.col("p_partkey")
    return part.select(
        k.cast("int").alias("stop_id"),
        F.when(k % 2 == 0, F.lit("E")).otherwise(F.lit("W")).alias("direction_id"),
        F.col("p_name").alias("stop_name"),
        F.col("p_name").alias("station_name"),
        F.concat(F.col("p_name"), F.lit(" ("), F.col("p_brand"), F.lit(")")).alias("station_descriptive_name"),
        (k % STATION_IDS).cast("int").alias("station_id"),
        F.col("p_size").cast("int").alias("order"),
        (k % 2 == 0).alias("red"),
        (k % 5 == 0).alias("blue"),
        (k % 3 == 0).alias("green"))


def station_messages(part: DataFrame) -> DataFrame:
    """The incremental connector emits stops by increasing stop_id."""
    stops = stops_from_parts(part)
    return topic(stops, F.to_json(F.struct(*stops.columns)), S.TOPICS["stations"], "stop_id")


def line_of(id_col: str) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in S.LINES]),
                        (F.col(id_col) % len(S.LINES)).cast("int") + 1)


def epoch_millis(ts="ts") -> Column:
    """Epoch milliseconds of a wall-clock timestamp, independent of the session time zone."""
    return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', "
                  f"cast({ts} as timestamp_ntz))")


def _event_key(ts="ts") -> Column:
    return F.to_json(F.struct(epoch_millis(ts).alias("timestamp")))


ARRIVAL_BLOCK = 1 << 20  # event ids of one block of a train's arrivals


def arrivals_from_events(events: DataFrame, block_width: int = ARRIVAL_BLOCK) -> DataFrame:
    """Arrival rows (``schemas.ARRIVAL`` + offset): each user is a train on line
    user_id % 3; the event picks station event_id % 40 and a direction that
    flips every 40 ids; prev_* is the same train's previous arrival."""
    train_status = F.coalesce(
        *[F.when(F.col("event_type") == k, F.lit(v)) for k, v in TRAIN_STATUS_OF.items()],
        F.lit("in_service"))
    base = events.select(
        F.col("event_id").alias("offset"), "user_id", "ts",
        (F.col("event_id") % STATION_IDS).cast("int").alias("station_id"),
        F.when(F.floor(F.col("event_id") / DIRECTION_RUN) % 2 == 0, F.lit("a"))
         .otherwise(F.lit("b")).alias("direction"),
        line_of("user_id").alias("line"),
        F.concat(F.lit("T"), F.col("user_id").cast("string")).alias("train_id"),
        train_status.alias("train_status"))
    linked = ordered_neighbours(base, ["user_id"], ["offset"], ["station_id", "direction"],
                                prefixes=("prev_", None), block_width=block_width)
    return linked.select("offset", "ts", *[f.name for f in S.ARRIVAL.fields])


def arrival_messages(events: DataFrame, block_width: int = ARRIVAL_BLOCK) -> DataFrame:
    arr = arrivals_from_events(events, block_width)
    value = F.to_json(F.struct(*[f.name for f in S.ARRIVAL.fields]))
    return topic(arr, value, S.TOPICS["arrivals"], "offset", key=_event_key())


def turnstile_rows(events: DataFrame) -> DataFrame:
    """One turnstile entry per event: event_id, ts, timestamp (epoch ms), station_id,
    station_name, line."""
    sid = (F.col("event_id") % TURNSTILE_IDS).cast("int")
    return events.select("event_id", "ts", epoch_millis().alias("timestamp"), sid.alias("station_id"),
                         F.concat(F.lit("S"), sid.cast("string")).alias("station_name"),
                         line_of("user_id").alias("line"))


def turnstile_records(events: DataFrame) -> DataFrame:
    """One turnstile entry per event as (key JSON {timestamp}, value JSON
    {station_id, station_name, line}), plus the event id and time for the envelope."""
    return encode_record(turnstile_rows(events), ["timestamp"], ["station_id", "station_name", "line"],
                         keep=("event_id", "ts"))


def turnstile_messages(events: DataFrame) -> DataFrame:
    recs = turnstile_records(events)
    return topic(recs, F.col("value"), S.TOPICS["turnstile"], "event_id", key=F.col("key"))


def weather_messages(events: DataFrame) -> DataFrame:
    status = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in WEATHER_OF.items()])
    value = F.to_json(F.struct(F.col("value").cast("float").alias("temperature"), status.alias("status")))
    return topic(events, value, S.TOPICS["weather"], "event_id", key=_event_key())


def ridership_seed_from_suppliers(supplier: DataFrame) -> DataFrame:
    """Seed rows (``schemas.RIDERSHIP_SEED``): one per supplier-as-station."""
    bal = F.col("s_acctbal")
    return supplier.select(
        F.col("s_suppkey").cast("int").alias("station_id"),
        F.col("s_name").alias("stationame"),
        F.lit("10/01/2018").alias("month_beginning"),
        bal.alias("avg_weekday_rides"),
        (bal - 100).alias("avg_saturday_rides"),
        (bal - 200).alias("avg_sunday-holiday_rides"),
        F.lit(0).alias("monthtotal"))


def curve_from_events(events: DataFrame) -> DataFrame:
    """Hourly ridership curve: share of all events in each hour of day (<= 24 rows)."""
    by_hour = events.groupBy(F.hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    total = by_hour.agg(F.sum("n")).scalar()  # over <= 24 rows; shares the shuffle above
    return by_hour.select(F.col("hour").cast("int").alias("hour"),
                          (F.col("n") / total).alias("ridership_ratio"))


# -- passthrough ---------------------------------------------------------------
def passthrough_messages(events: DataFrame) -> DataFrame:
    """Topic with two partitions; the key is null for 'view' events."""
    key = F.when(F.col("event_type") != "view", F.col("user_id").cast("string"))
    headers = F.array(F.struct(F.lit("event_type").alias("key"),
                               F.col("event_type").cast("binary").alias("value")))
    return envelope(events, F.col("props"), S.TOPICS["passthrough"], F.col("event_id"), key=key,
                    partition=F.col("user_id") % 2, timestamp=F.col("ts").cast("timestamp"),
                    headers=headers)
