"""Retractions: what changes in a count when one message replaces another (A2)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import IntegralType, TimestampType

CHANGES = "value string, delta long"


def _ordered(df: DataFrame, name: str):
    """An order column as a whole number or text, with its type; both compare in Python as in Spark."""
    kind = df.schema[name].dataType
    if isinstance(kind, TimestampType):
        return F.unix_micros(name), "long"
    if isinstance(kind, IntegralType):
        return F.col(name).cast("long"), "long"
    if kind.typeName() == "string":
        return F.col(name), "string"
    raise TypeError(f"order column {name}: {kind.simpleString()} isn't a whole number, a timestamp or text")


def _newest(ords: list[str]):
    """Of each message key the newest row of an Arrow batch: what a hot key sends to its state is one row a batch."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.sort_values(ords, kind="stable").drop_duplicates("message", keep="last")
    return run


def _change(ords: list[str]):
    """Keeps (order, value) of a message key; a newer one gives -1 for the value before and +1 for its own."""
    def run(_key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        old = tuple(state.get) if state.exists else None
        best = old
        for frame in frames:
            top = frame.sort_values(ords, kind="stable").iloc[-1]
            at = tuple(top[o] if isinstance(top[o], str) else int(top[o]) for o in ords)
            if best is None or at > best[:-1]:
                best = (*at, None if pd.isna(top["value"]) else top["value"])
        changes = []
        if best is not None and best != old:
            state.update(best)
            before = None if old is None else old[-1]
            if before != best[-1]:
                changes = [(v, d) for v, d in ((before, -1), (best[-1], 1)) if v is not None]
        yield pd.DataFrame(changes, columns=["value", "delta"]).astype({"value": object, "delta": "int64"})
    return run


def retractions(messages: DataFrame, msg_keys: Sequence[str] | str, key: str, ord_cols: Sequence[str] | str) -> DataFrame:
    """(key, delta) of a stream of messages in which the newest (by ``ord_cols``, compared left to right) of each message
    key stands for it: summed by key they are the counts of ``operators.state.upsert_count``.

    The state of a message key is its newest order and value, so work follows the micro-batch. A message older
    than the state changes nothing, nor does one without an order; a null ``key`` takes its message key out of all
    counts. Of two messages of the same order the first to come stays."""
    msg_keys = [msg_keys] if isinstance(msg_keys, str) else list(msg_keys)
    ord_cols = [ord_cols] if isinstance(ord_cols, str) else list(ord_cols)
    ords = {f"o{i}": _ordered(messages, c) for i, c in enumerate(ord_cols)}
    rows = messages.select(F.to_json(F.struct(*msg_keys)).alias("message"), F.col(key).cast("string").alias("value"),
                           *[c.alias(o) for o, (c, _) in ords.items()]).dropna(subset=list(ords))
    rows = rows.mapInPandas(_newest(list(ords)), rows.schema)
    state = ", ".join([f"{o} {kind}" for o, (_, kind) in ords.items()] + ["value string"])
    changes = rows.groupBy("message").applyInPandasWithState(
        _change(list(ords)), CHANGES, state, "update", GroupStateTimeout.NoTimeout)
    return changes.select(F.col("value").cast(messages.schema[key].dataType).alias(key), "delta")
