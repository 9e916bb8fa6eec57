"""Transit status board (Q6): the four keyed tables as streams, then the board
as a batch join of their current snapshots (run the last step as often as the
board should refresh).

    spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version>,\
        org.apache.spark:spark-avro_2.13:<spark version> examples/status_board.py --root <shared folder>

Arrival and turnstile values are registry-framed Avro by default (``--value-format``),
decoded by Spark's own from_avro, which needs the spark-avro package.
"""

import argparse

from tributary.plans import transit as T
from tributary.schemas import TOPICS
from tributary.session import get_session
from tributary.sources.kafka import kafka_stream
from tributary.operators.order import order_board

p = argparse.ArgumentParser()
p.add_argument("--servers", default="localhost:9092")
p.add_argument("--root", required=True, help="shared folder for the tables and checkpoints")
p.add_argument("--refresh", default="10 seconds")
p.add_argument("--value-format", default="avro", choices=("avro", "json"),
               help="arrival and turnstile values (the producers write registry-framed Avro)")
p.add_argument("--weather-format", default="json", choices=("avro", "json"),
               help="weather values (published as JSON through the REST proxy)")
p.add_argument("--show-every", type=int, default=30, help="seconds between two looks at the board")
args = p.parse_args()

spark = get_session(app="status-board")
topics = {
    # the connector's raw station topic: A4 applies the colour transform itself,
    # which is what the transformed-station changelog carries
    "stations": dict(topic=TOPICS["stations"]),
    "arrivals": dict(pattern=TOPICS["arrivals_pattern"]),
    "turnstile": dict(topic=TOPICS["turnstile"]),
    "weather": dict(topic=TOPICS["weather"]),
}
envs = [kafka_stream(spark, args.servers, **kw) for kw in topics.values()]
formats = {"arrivals": args.value_format, "turnstile": args.value_format, "weather": args.weather_format}
queries = T.run_board_tables(*envs, args.root, trigger={"processingTime": args.refresh}, wait=False,
                             formats=formats)
while all(q.isActive for q in queries):
    spark.streams.awaitAnyTermination(args.show_every)
    order_board(T.board_from_tables(spark, args.root)).show(200, truncate=False)
