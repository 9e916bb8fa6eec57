"""Sinks (S7-S13). Writers whose output outlives the query need a checkpoint
folder on shared storage: a fresh one would write everything again after a
restart. Only the console may do without."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from ..functions.avro import to_avro_column
from ..functions.decode import encode_record
from ..operators.state import latest_by_key
from ..session import scratch_path


def _checkpoint(df: DataFrame, checkpoint: str | None, name: str) -> str:
    return checkpoint or scratch_path(df.sparkSession, f"ckpt-{name}")


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**trigger) if trigger else writer


# S12 ---------------------------------------------------------------------------
def register(df: DataFrame, name: str) -> DataFrame:
    """Named temp view over a batch or streaming DataFrame."""
    df.createOrReplaceTempView(name)
    return df


# S7 ----------------------------------------------------------------------------
def to_console(df: DataFrame, mode: str = "append", checkpoint: str | None = None,
               trigger: dict | None = None, rows: int = 20):
    w = (df.writeStream.format("console").outputMode(mode).option("numRows", rows)
           .option("truncate", True).option("checkpointLocation", _checkpoint(df, checkpoint, "console")))
    return _trigger(w, trigger).start()


# S8 ----------------------------------------------------------------------------
def to_kafka(df: DataFrame, servers: str, topic: str, checkpoint: str,
             mode: str = "append", trigger: dict | None = None):
    """Streaming write of (key, value[, partition, headers]) rows to a topic."""
    w = (df.writeStream.format("kafka").outputMode(mode)
           .option("kafka.bootstrap.servers", servers).option("topic", topic)
           .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


# S9 ----------------------------------------------------------------------------
def publish(df: DataFrame, servers: str, topic: str) -> None:
    """Batch publish; a ``partition`` column, when present, picks the partition."""
    cols = [c for c in ("key", "value", "partition", "headers") if c in df.columns]
    (df.select(*cols).write.format("kafka").option("kafka.bootstrap.servers", servers)
       .option("topic", topic).save())


# S10 ---------------------------------------------------------------------------
def to_records(df: DataFrame, key_cols: Sequence[str] | None, value_cols: Sequence[str],
               fmt: str = "json", key_schema: str | None = None, value_schema: str | None = None,
               schema_ids: tuple[int, int] | None = None) -> DataFrame:
    """Key struct + value struct ready for S8 / S9: JSON (as the REST proxy
    publishes weather), or registry-framed Avro with the given writer schemas
    (as the station and turnstile producers publish)."""
    if fmt == "json":
        return encode_record(df, key_cols, value_cols)
    if fmt != "avro":
        raise ValueError(f"unknown format {fmt!r}")
    if value_schema is None or (key_cols and key_schema is None):
        raise ValueError("avro records need the key and value writer schemas")
    key_id, value_id = schema_ids or (None, None)
    key = (to_avro_column(F.struct(*key_cols), key_schema, key_id) if key_cols
           else F.lit(None).cast("binary"))
    return df.select(key.alias("key"), to_avro_column(F.struct(*value_cols), value_schema, value_id).alias("value"))


# S11 ---------------------------------------------------------------------------
def to_changelog(df: DataFrame, key_cols: Sequence[str], keep_nulls: bool = True) -> DataFrame:
    """Keyed upsert messages: key = the key column(s) as text, value = row JSON.
    A changelog record spells out null fields (``"line": null``) unless
    ``keep_nulls`` is off."""
    key_cols = list(key_cols)
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    key = (F.col(key_cols[0]).cast("string") if len(key_cols) == 1
           else F.to_json(F.struct(*key_cols)))
    return df.select(key.alias("key"), F.to_json(F.struct(*df.columns), opts).alias("value"))


VERSION, BUCKET = "__version", "__bucket"
BUCKETS = 16


def _folders(spark, path: str, prefix: str) -> list[tuple[int, bool]]:
    """Numbers N of the folders ``prefix=N`` under ``path``, ascending, each with whether it holds ``_SUCCESS``.

    Lists folder names, not files, and they are few: old versions are deleted. A folder that doesn't
    exist (yet) has none; any other failure to read it is raised."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    found = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith(prefix + "="):
            whole = fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))
            found.append((int(name.split("=", 1)[1]), whole))
    return sorted(found)


def _versions(spark, path: str) -> list[int]:
    """Complete versions under ``path``."""
    return [n for n, whole in _folders(spark, path, VERSION) if whole]


def _buckets(spark, path: str) -> list[int]:
    """Key buckets that a version has rows of."""
    return [n for n, _ in _folders(spark, path, BUCKET)]


def _delete(spark, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _write_version(rows: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """``rows`` as a version folder, one sub-folder for each bucket of keys that has some; a folder left there by an
    attempt before is replaced."""
    number = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int") if keys else F.lit(0)
    (rows.withColumn(BUCKET, number).repartition(buckets, BUCKET).write.mode("overwrite")
         .option("partitionOverwriteMode", "static").partitionBy(BUCKET).parquet(path))


def changelog_writer(path: str, keys: Sequence[str] | None = None,
                     ord_cols: str | Sequence[str] | None = None, compact_every: int | None = None,
                     merge: str = "latest", buckets: int = BUCKETS):
    """``foreachBatch`` function appending a micro-batch of keyed rows to a table's
    changelog (``path/log/__version=<batch_id>/__bucket=<hash of the key>``).

    Work per batch is proportional to the batch, not to the table. Writing the
    folder of the batch id with overwrite makes a replayed batch (after a lost
    executor or a restart) replace its own output: no loss, no duplicates.
    Every ``compact_every`` batches the buckets that changed since are written anew
    as a snapshot (``path/snap/__version=<batch_id>/__bucket=...``); the others stay where they
    are, so that the work follows the changed keys' buckets and not the table. ``buckets`` is
    fixed for the life of a table; give thousands for a large one.

    ``merge``: rows of one key replace each other (``latest``, by ``ord_cols``, then batch) or their
    other columns are added up (``sum``)."""
    keys = list(keys or [])

    def _write(batch: DataFrame, batch_id: int) -> None:
        _write_version(batch, f"{path}/log/{VERSION}={batch_id}", keys, buckets)
        if compact_every and keys and batch_id % compact_every == compact_every - 1:
            compact(batch.sparkSession, path, keys, ord_cols, batch_id, merge, buckets)

    return _write


def _merged(rows: DataFrame, keys: Sequence[str], ord_cols: str | Sequence[str] | None, merge: str) -> DataFrame:
    keys = list(keys)
    if merge == "sum":
        return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in rows.columns if c not in (*keys, VERSION, BUCKET)])
    if merge != "latest":
        raise ValueError(f"unknown merge {merge!r}")
    ords = [ord_cols] if isinstance(ord_cols, str) else list(ord_cols or [])
    return latest_by_key(rows.drop(BUCKET), keys, [*ords, VERSION]).drop(VERSION)


class _Layout:
    """What a changelog's folders hold below a version: the last snapshot, where each bucket's newest rows are in
    it, and the log versions after it that have rows, with their buckets."""

    def __init__(self, spark, path: str, below: int | None = None):
        def known(v):
            return below is None or v < below

        self.spark, self.path = spark, path
        self.snaps = [v for v in _versions(spark, f"{path}/snap") if known(v)]
        self.floor = self.snaps[-1] if self.snaps else -1
        self.log = {v: _buckets(spark, f"{path}/log/{VERSION}={v}")
                    for v in _versions(spark, f"{path}/log") if known(v) and v > self.floor}
        self.log = {v: b for v, b in self.log.items() if b}
        self.held = {v: _buckets(spark, f"{path}/snap/{VERSION}={v}") for v in self.snaps}

    def newest(self, upto: int) -> dict[int, int]:
        """Of each bucket the newest snapshot up to a version that has it."""
        return {b: v for v in self.snaps if v <= upto for b in self.held[v]}

    def rows(self, buckets: set[int] | None = None) -> DataFrame | None:
        """Snapshot and log rows, with their version; of the given buckets only, if any are."""
        def wanted(b):
            return buckets is None or b in buckets

        snap = [f"{self.path}/snap/{VERSION}={v}/{BUCKET}={b}" for b, v in self.newest(self.floor).items() if wanted(b)]
        log = [f"{self.path}/log/{VERSION}={v}/{BUCKET}={b}" for v, own in self.log.items() for b in own if wanted(b)]
        parts = [self.spark.read.option("basePath", f"{self.path}/{kind}").parquet(*paths)
                 for kind, paths in (("snap", snap), ("log", log)) if paths]
        return reduce(lambda a, b: a.unionByName(b), parts) if parts else None


def read_changelog_table(spark, path: str, keys: Sequence[str], ord_cols: str | Sequence[str] | None = None,
                         below: int | None = None, merge: str = "latest") -> DataFrame | None:
    """Current table of a changelog: the rows of each key in the newest snapshot and the log after it, merged. A
    partial aggregate per key, so a hot key costs one row per input partition. None as long as no row was
    written."""
    rows = _Layout(spark, path, below).rows()
    return None if rows is None else _merged(rows, keys, ord_cols, merge)


def compact(spark, path: str, keys: Sequence[str], ord_cols=None, upto: int | None = None, merge: str = "latest",
            buckets: int = BUCKETS) -> None:
    """Write the buckets that changed since the last snapshot as they are at batch ``upto``; later reads skip older
    log. What a reader of the snapshot before it needs stays, older rows of a bucket and older log go."""
    layout = _Layout(spark, path, None if upto is None else upto + 1)
    if upto is not None and layout.floor == upto:  # the batch is repeated, and so is its snapshot
        layout = _Layout(spark, path, upto)
        own = _versions(spark, f"{path}/log")
        layout.log.update({v: b for v in own if v == upto and (b := _buckets(spark, f"{path}/log/{VERSION}={v}"))})
    touched = {b for own in layout.log.values() for b in own}
    if not touched:
        return
    version = upto if upto is not None else max(layout.log)
    _write_version(_merged(layout.rows(touched), keys, ord_cols, merge), f"{path}/snap/{VERSION}={version}", keys, buckets)
    stays = layout.newest(layout.floor)
    for v in layout.snaps:
        gone = [b for b in layout.held[v] if stays[b] != v]
        if len(gone) == len(layout.held[v]) and v != layout.floor:
            _delete(spark, f"{path}/snap/{VERSION}={v}")
        else:
            for b in gone:
                _delete(spark, f"{path}/snap/{VERSION}={v}/{BUCKET}={b}")
    for v in _versions(spark, f"{path}/log"):
        if v <= layout.floor:
            _delete(spark, f"{path}/log/{VERSION}={v}")


# T6 ----------------------------------------------------------------------------
DEAD = "__dead"


def checked_writer(path: str):
    """``foreachBatch`` function for ``functions.decode.check_messages``: the well-formed rows and the dead letters of
    a micro-batch, parsed once, go to two folders (``path/__version=<batch_id>/__dead=false|true``) in one job. Both
    count from the moment the job is committed, and a repeated batch replaces both."""

    def _write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumnRenamed("dead", DEAD).write.mode("overwrite").option("partitionOverwriteMode", "static")
              .partitionBy(DEAD).parquet(f"{path}/{VERSION}={batch_id}"))

    return _write


def read_checked(spark, path: str, schema: StructType, dead: bool) -> DataFrame:
    """One of the two outputs of ``checked_writer`` (its batches' ``schema``), complete batches only."""
    whole = [f"{path}/{VERSION}={v}" for v in _versions(spark, path)]
    kept = StructType([f for f in schema.fields if f.name != "dead"])
    if not whole:
        return spark.createDataFrame([], kept)
    rows = spark.read.schema(StructType([*kept.fields, StructField(DEAD, BooleanType())])).option("basePath", path).parquet(*whole)
    return rows.where(F.col(DEAD) == dead).select(*kept.names)
