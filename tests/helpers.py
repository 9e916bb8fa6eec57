"""Test helpers: build envelope rows from Python values."""

import base64
import datetime as dt
import json

from tributary import schemas as S


def env_rows(spark, values, topic="t", keys=None, start_offset=0, partition=0):
    """Envelope DataFrame from a list of message values (str / dict / None)."""
    rows = []
    for i, v in enumerate(values):
        if isinstance(v, (dict, list)):
            v = json.dumps(v)
        k = None if keys is None else keys[i]
        rows.append((None if k is None else k.encode(), None if v is None else v.encode(), topic,
                     partition, start_offset + i, dt.datetime(2024, 1, 1), None))
    return spark.createDataFrame(rows, S.ENVELOPE)


def b64(obj) -> str:
    return base64.b64encode(json.dumps(obj).encode()).decode()


def sorted_set(customer) -> dict:
    """Sorted-set envelope with the customer (dict or raw text) in the first entry."""
    element = b64(customer) if isinstance(customer, dict) else customer
    return {"key": "__Customer__", "existType": "NotExists", "Ch": False, "Incr": False,
            "zSetEntries": [{"element": element, "score": "0.0"}]}


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
