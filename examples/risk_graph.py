"""Risk scores joined with customer birth years, Kafka in and Kafka out (Q1).

    spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version> \
        examples/risk_graph.py --servers localhost:9092 --checkpoint <shared folder>
"""

import argparse

from tributary.plans.risk import risk_graph
from tributary.schemas import TOPICS
from tributary.session import get_session
from tributary.sources.kafka import kafka_stream
from tributary.streaming.sinks import to_kafka

p = argparse.ArgumentParser()
p.add_argument("--servers", default="localhost:9092")
p.add_argument("--events-topic", default=TOPICS["risk_events"])
p.add_argument("--customers-topic", default=TOPICS["customers"])
p.add_argument("--out-topic", default=TOPICS["risk_out"])
p.add_argument("--checkpoint", default=None, help="defaults to a folder under spark.checkpoint.dir")
args = p.parse_args()

spark = get_session(app="risk-graph")
events = kafka_stream(spark, args.servers, topic=args.events_topic)
customers = kafka_stream(spark, args.servers, topic=args.customers_topic)
query = to_kafka(risk_graph(events, customers), args.servers, args.out_topic, args.checkpoint)
query.awaitTermination()
