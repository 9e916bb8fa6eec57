"""Wire and table schemas. Everything is declared up front; nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DateType, DoubleType,
                               FloatType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampType)


def _s(*fields: tuple) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# Kafka source row. Every stream operator takes this shape as input.
ENVELOPE = _s(
    ("key", BinaryType()),
    ("value", BinaryType()),
    ("topic", StringType()),
    ("partition", IntegerType()),
    ("offset", LongType()),
    ("timestamp", TimestampType()),
    ("headers", ArrayType(_s(("key", StringType()), ("value", BinaryType())))),
)

# --- risk scoring -------------------------------------------------------------
RISK_EVENT = _s(("customer", StringType()), ("score", StringType()), ("riskDate", DateType()))

SORTED_SET = _s(
    ("key", StringType()),
    ("existType", StringType()),
    ("Ch", StringType()),
    ("Incr", BooleanType()),
    ("zSetEntries", ArrayType(_s(("element", StringType()), ("score", StringType())))),
)

CUSTOMER = _s(("customerName", StringType()), ("email", StringType()),
              ("phone", StringType()), ("birthDay", DateType()))

# --- transit ------------------------------------------------------------------
STATION = _s(
    ("stop_id", IntegerType()),
    ("direction_id", StringType()),
    ("stop_name", StringType()),
    ("station_name", StringType()),
    ("station_descriptive_name", StringType()),
    ("station_id", IntegerType()),
    ("order", IntegerType()),
    ("red", BooleanType()),
    ("blue", BooleanType()),
    ("green", BooleanType()),
)
# Columns the relational station table declares NOT NULL, and its primary key.
STATION_NOT_NULL = ("direction_id", "stop_name", "station_name", "station_descriptive_name",
                    "station_id", "red", "blue", "green")
STATION_KEY = ("stop_id",)

TRANSFORMED_STATION = _s(("station_id", IntegerType()), ("station_name", StringType()),
                         ("order", IntegerType()), ("line", StringType()))

ARRIVAL = _s(
    ("station_id", IntegerType()),
    ("direction", StringType()),
    ("line", StringType()),
    ("train_id", StringType()),
    ("train_status", StringType()),
    ("prev_station_id", IntegerType()),
    ("prev_direction", StringType()),
)

TURNSTILE = _s(("station_id", IntegerType()), ("station_name", StringType()), ("line", StringType()))

EVENT_KEY = _s(("timestamp", LongType()))

WEATHER = _s(("temperature", FloatType()), ("status", StringType()))

# Summary table messages carry upper-case keys.
TURNSTILE_SUMMARY = _s(("STATION_ID", IntegerType()), ("COUNT", LongType()))

RIDERSHIP_SEED = _s(
    ("station_id", IntegerType()),
    ("stationame", StringType()),
    ("month_beginning", StringType()),
    ("avg_weekday_rides", DoubleType()),
    ("avg_saturday_rides", DoubleType()),
    ("avg_sunday-holiday_rides", DoubleType()),
    ("monthtotal", IntegerType()),
)

RIDERSHIP_CURVE = _s(("hour", IntegerType()), ("ridership_ratio", DoubleType()))

PASSTHROUGH = _s(("key", StringType()), ("value", StringType()))

# Fixed values that must equal the reference's for right results.
LINES = ("blue", "green", "red")  # board order; also the colour priority blue > green > red
LINE_COLOUR_CODES = {"blue": "#1E90FF", "red": "#DC143C", "green": "#32CD32"}
DEFAULT_COLOUR_CODE = "0xFFFFFF"
TRAIN_STATUSES = ("out_of_service", "in_service", "broken_down")
WEATHER_STATUSES = ("sunny", "partly_cloudy", "cloudy", "windy", "precipitation")
DEFAULT_TEMPERATURE = 70.0
DEFAULT_WEATHER_STATUS = "sunny"
EMPTY_SLOT = "---"
# Topic names of the deployment this engine replaces (the wire contract; every
# reader and writer also takes a topic argument).
TOPICS = {
    "risk_events": "stedi-events",
    "customers": "redis-server",
    "risk_out": "stedi-risk-topic",
    "stations": "org.chicago.cta.stations",
    "stations_table": "org.chicago.cta.stations.table.v1",
    "arrivals": "org.chicago.cta.station.arrivals.v1",
    "arrivals_pattern": r"org\.chicago\.cta\.station\.arrivals\..*",
    "turnstile": "org.chicago.cta.turnstile.v1",
    "turnstile_summary": "TURNSTILE_SUMMARY",
    "weather": "org.chicago.cta.weather.v1",
    "passthrough": "Testzao",
}

# Avro writer schemas of the transit topics (fixed values of the wire contract:
# field order and union branch order decide the bytes). Weather is published as
# JSON; its Avro schema serves the ``fmt="avro"`` reading.
AVRO_EVENT_KEY = ('{"type": "record", "name": "key", "fields": ['
                  '{"name": "timestamp", "type": "long"}]}')
AVRO_ARRIVAL = ('{"type": "record", "name": "arrival_value", "fields": ['
                '{"name": "station_id", "type": "int"}, {"name": "direction", "type": "string"}, '
                '{"name": "line", "type": "string"}, {"name": "train_id", "type": "string"}, '
                '{"name": "train_status", "type": "string"}, '
                '{"name": "prev_station_id", "type": ["int", "null"]}, '
                '{"name": "prev_direction", "type": ["string", "null"]}]}')
AVRO_TURNSTILE = ('{"type": "record", "name": "turnstile_value", "fields": ['
                  '{"name": "station_id", "type": "int"}, {"name": "station_name", "type": "string"}, '
                  '{"name": "line", "type": "string"}]}')
AVRO_WEATHER = ('{"type": "record", "name": "weather_value", "fields": ['
                '{"name": "temperature", "type": "float"}, {"name": "status", "type": "string"}]}')
