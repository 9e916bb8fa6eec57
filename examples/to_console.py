"""Risk events (Q3) or customer birth years (Q2) from Kafka to the console.

    spark-submit --packages ... examples/to_console.py --what risk-events|birth-years
"""

import argparse

from tributary.plans.risk import customer_birth_year, risk_events
from tributary.schemas import TOPICS
from tributary.session import get_session
from tributary.sources.kafka import kafka_stream
from tributary.streaming.sinks import to_console

p = argparse.ArgumentParser()
p.add_argument("--servers", default="localhost:9092")
p.add_argument("--what", choices=["risk-events", "birth-years"], default="risk-events")
args = p.parse_args()

spark = get_session(app=f"{args.what}-to-console")
if args.what == "risk-events":
    out = risk_events(kafka_stream(spark, args.servers, topic=TOPICS["risk_events"]))
else:
    out = customer_birth_year(kafka_stream(spark, args.servers, topic=TOPICS["customers"]))
to_console(out).awaitTermination()
