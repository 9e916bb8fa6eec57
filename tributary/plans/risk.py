"""Risk scoring queries (Q1-Q3): decode the customer sorted-set topic and the
risk-event topic, keep customers with an address and a birth day, and join the
scores with the birth years. Each function takes envelope DataFrames, so the
same plan runs in batch and as a Structured Streaming query."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas as S
from ..functions.columns import birth_year, valid_customers
from ..functions.decode import decode_base64_json, decode_json, encode_json, first_element
from ..operators.joins import join_risk


def customer_records(sorted_set_env: DataFrame, keep=()) -> DataFrame:
    """Sorted-set envelope; D5: first entry's element; D6, D7: base64 JSON."""
    sets = decode_json(sorted_set_env, S.SORTED_SET, "value", keep=keep)
    encoded = sets.select(*keep, first_element("zSetEntries", "element").alias("encodedCustomer"))
    return decode_base64_json(encoded, "encodedCustomer", S.CUSTOMER, keep=keep)


def customer_birth_year(sorted_set_env: DataFrame, keep=()) -> DataFrame:
    """Q2: (email, birthYear) of customers with both an address and a birth day."""
    return (valid_customers(customer_records(sorted_set_env, keep))
            .select(*keep, "email", birth_year("birthDay").alias("birthYear")))


def risk_events(events_env: DataFrame, keep=()) -> DataFrame:
    """Q3: (customer, score, riskDate) of every risk event; ``select *``."""
    return decode_json(events_env, S.RISK_EVENT, "value", keep=keep)


def risk_graph_rows(events_env: DataFrame, sorted_set_env: DataFrame, bound: dict | None = None,
                    salt: int = 1) -> DataFrame:
    """Q1 before encoding: (customer, score, email, birthYear).

    ``bound`` (optional, off by default) = ``{"delay": "10 minutes", "range":
    "1 day"}``: both sides are watermarked on their message timestamps and a
    score only meets customer records within ``range`` of it, so the join
    state can expire instead of growing forever."""
    risk = risk_events(events_env, keep=("partition", "offset", "timestamp"))
    risk = risk.select("partition", "offset", F.col("timestamp").alias("risk_time"), "customer", "score")
    customers = customer_birth_year(sorted_set_env, keep=("timestamp",))
    customers = customers.select(F.col("timestamp").alias("customer_time"), "email", "birthYear")
    if bound:
        bound = {"risk_time": "risk_time", "customer_time": "customer_time", **bound}
    return join_risk(risk, customers, bound, salt)


def risk_graph(events_env: DataFrame, sorted_set_env: DataFrame, bound: dict | None = None,
               salt: int = 1) -> DataFrame:
    """Q1 (flagship): scores joined with birth years on customer = email, as
    (key = customer, value = JSON {customer, score, email, birthYear})."""
    return encode_json(risk_graph_rows(events_env, sorted_set_env, bound, salt), "customer")

