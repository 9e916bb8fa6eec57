"""Driver tables (parquet) by name."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table.

    A table is opened once (file listing and parquet footer schema) and the lazy DataFrame is reused by the
    queries of the session, as long as its path has the same modification time and size; no rows are cached."""
    opened = spark.__dict__.setdefault("_tributary_tables", {})
    path = os.path.join(sf_dir, f"{name}.parquet")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    status = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(folder)
    now = status.getModificationTime(), status.getLen()
    if opened.get(path, (None,))[0] != now:
        opened[path] = now, spark.read.parquet(path)
    return opened[path][1]
