"""Running a streaming query (T1-T5): output mode, checkpoint, trigger, wait."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..session import scratch_path


def run_stream(df: DataFrame, sink: str = "parquet", path: str | None = None,
               mode: str = "append", checkpoint: str | None = None,
               trigger: dict | None = None, foreach_batch: Callable | None = None,
               query_name: str | None = None, wait: bool = True, partitions: int | None = None):
    """Start ``df`` on a sink and (by default) wait until the available input is done.

    sink: ``parquet`` (needs ``path``), ``memory`` (needs ``query_name``),
    ``console``, or ``foreach`` (needs ``foreach_batch``).
    trigger: e.g. ``{"availableNow": True}`` (default) or ``{"processingTime": "10 seconds"}``.
    partitions: state / shuffle partitions of a new query; by default those of the
    session (``spark.sql.shuffle.partitions``, Spark's own 200 if never set). The
    number is kept in the checkpoint for the life of the query, so give a large one
    (thousands) for a state that will grow; it doesn't follow the size of the
    cluster that happens to start the query.
    checkpoint: needed for every sink that outlives the query; only ``memory`` and
    ``console`` may do without, and get a fresh folder.
    """
    spark = df.sparkSession
    if checkpoint is None and sink not in ("memory", "console"):
        raise ValueError(f"the {sink} sink needs a checkpoint: without it a restart writes everything again")
    checkpoint = checkpoint or scratch_path(spark, f"ckpt-{sink}")
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if sink == "foreach":
        w = w.foreachBatch(foreach_batch)
    elif sink == "memory":
        w = w.format("memory").queryName(query_name or "tributary_out")
    elif sink == "parquet":
        if path is None:
            raise ValueError("parquet sink needs a path")
        w = w.format("parquet").option("path", path)
    else:
        w = w.format(sink)
    if query_name and sink != "memory":
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    # The stream plans on a clone of the session taken at start(), so the
    # setting is applied only around start() and the caller's session is unchanged.
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(partitions or before))
    try:
        q = w.start()
    finally:
        spark.conf.set(key, before)
    return finished(q) if wait else q


def finished(q):
    """Waits for a query to end by itself, and raises what ended it otherwise."""
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q
