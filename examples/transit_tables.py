"""Station table (Q4) and turnstile summary (Q5) published as keyed changelogs.

Stations: every station record becomes a transformed-station update keyed by
station_id (append: the changelog of the last-value-wins table). Summary: the
running count per station in update mode, one message per changed station.

    spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version>,\
        org.apache.spark:spark-avro_2.13:<spark version> examples/transit_tables.py --checkpoint-root <shared folder>

Turnstile values are registry-framed Avro by default (``--value-format``), which needs the
spark-avro package.
"""

import argparse

from tributary.plans import transit as T
from tributary.schemas import TOPICS
from tributary.session import get_session
from tributary.sources.kafka import kafka_stream
from tributary.streaming.sinks import to_changelog, to_kafka

p = argparse.ArgumentParser()
p.add_argument("--servers", default="localhost:9092")
p.add_argument("--checkpoint-root", required=True)
p.add_argument("--value-format", default="avro", choices=("avro", "json"),
               help="turnstile values (the producers write registry-framed Avro)")
args = p.parse_args()

spark = get_session(app="transit-tables")
stations = kafka_stream(spark, args.servers, topic=TOPICS["stations"])
changelog = T.station_changelog(stations).drop("position")
q1 = to_kafka(to_changelog(changelog, ["station_id"]), args.servers, TOPICS["stations_table"],
              f"{args.checkpoint_root}/stations")

turnstile = kafka_stream(spark, args.servers, topic=TOPICS["turnstile"])
# The count mode (A1) is one stateful aggregation. The table-semantics mode (A2)
# chains two; tributary.streaming.jobs.run_upsert_count keeps it as a live table.
summary = T.turnstile_summary(turnstile, fmt=args.value_format)
q2 = to_kafka(summary, args.servers, TOPICS["turnstile_summary"], f"{args.checkpoint_root}/summary", mode="update")
for q in (q1, q2):
    q.awaitTermination()
