"""Incremental relational load (S6): rows whose incrementing column exceeds the
last value seen; inserts only, updates to old rows are never re-read. The new
high-water mark is read first and the slice is bounded by it (``last < column <=
mark``), so a row inserted between the two reads is left to the next load, not
lost. A first load (``last`` is None) takes everything up to its mark.

The predicate is pushed to the database (JDBC filter pushdown) and the read is
split into parallel ranges of the same column, so a large table is
not pulled through one connection. The ranges hold equal numbers of rows (quantiles), not
equal widths: ids may be sparse, and any ordered type will do.

``load_next`` keeps the mark with the rows it stands for: both become visible by one commit,
so a load that fails at any point is repeated from the mark before it.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType


def high_water(df: DataFrame, column: str, last=None) -> DataFrame:
    """One row, the mark to load up to: the largest value, or ``last`` where nothing is newer."""
    mark = F.max(column) if last is None else F.coalesce(F.greatest(F.max(column), _value(last)), _value(last))
    return df.agg(mark.alias("high_water"))


def _value(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def incremental_slice(df: DataFrame, column: str, last, mark, ordered: bool = False) -> DataFrame:
    """Rows after ``last`` (all for None) up to ``mark``; values or Columns of any ordered type.

    Downstream operators take their order from ``column`` itself (it is the message offset), so the rows
    are only sorted - a range-partitioned global sort - when ``ordered`` is set."""
    new = df.where(F.col(column) <= _value(mark))
    if last is not None:
        new = new.where(F.col(column) > _value(last))
    return new.orderBy(column) if ordered else new


def sql_literal(x) -> str:
    """A value as the database's SQL text: numbers, dates, timestamps, strings."""
    if isinstance(x, bool) or x is None:
        raise TypeError(f"no mark: {x!r}")
    if isinstance(x, (int, float)):
        return repr(x)
    if isinstance(x, datetime):
        return f"TIMESTAMP '{x.isoformat(sep=' ')}'"
    if isinstance(x, date):
        return f"DATE '{x.isoformat()}'"
    return "'" + str(x).replace("'", "''") + "'"


def quantile_cuts(df: DataFrame, column: str, parts: int) -> list:
    """Up to ``parts`` - 1 values that cut the rows of ``df`` into parts of about equal size by a numeric column."""
    found = df.agg(F.percentile_approx(column, [k / parts for k in range(1, parts)]).alias("cuts")).first()["cuts"]
    return sorted(set(found or []))


def cuts_query(table: str, column: str, last, mark, parts: int) -> str:
    """SQL by which the database itself finds the cuts, of any ordered type: the greatest value of each of ``parts`` equal
    shares of the slice's rows."""
    return (f'(SELECT max("{column}") AS cut FROM (SELECT "{column}", ntile({parts}) OVER (ORDER BY "{column}") AS part '
            f"FROM {table} WHERE {_between(column, last, mark)}) s GROUP BY part) t")


def _between(column: str, low, high) -> str:
    """``low < column <= high`` as SQL; None leaves a side open."""
    sides = ([f'"{column}" > {sql_literal(low)}'] if low is not None else []) + (
        [f'"{column}" <= {sql_literal(high)}'] if high is not None else [])
    return " AND ".join(sides) or "1 = 1"


def range_predicates(column: str, last, mark, cuts: list) -> list[str]:
    """One predicate a connection: the slice ``last < column <= mark`` cut at the values of ``cuts`` inside it. Every row of
    the slice meets exactly one; without cuts there is one predicate."""
    inner = sorted({c for c in cuts if (last is None or c > last) and c < mark})
    bounds = [last, *inner, mark]
    return [_between(column, a, b) for a, b in zip(bounds, bounds[1:])]


def jdbc_incremental(spark: SparkSession, url: str, table: str, column: str, last=None, partitions: int = 16,
                     **options) -> tuple[DataFrame, object]:
    """(new rows, mark to store for the next load). Reads of the database: the largest value, the cuts, then the slice
    through one connection a range; all stay inside the mark, so nothing is lost or read twice. Nothing to load:
    no row, and the old mark."""
    def ask(query: str) -> DataFrame:
        return spark.read.format("jdbc").option("url", url).options(**options).option("dbtable", query).load()

    mark = ask(f'(SELECT max("{column}") AS high FROM {table} WHERE {_between(column, last, None)}) t').first()["high"]
    if mark is None:
        return ask(f"(SELECT * FROM {table} WHERE 1 = 0) t"), last
    cuts = [r["cut"] for r in ask(cuts_query(table, column, last, mark, partitions)).collect()]
    df = spark.read.jdbc(url, table, predicates=range_predicates(column, last, mark, cuts),
                         properties={k: str(v) for k, v in options.items()})
    return incremental_slice(df, column, last, mark), mark


# loads that keep their mark --------------------------------------------------------
LOAD, MARK = "load", "high_water"


def _folder_names(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def stored_loads(spark: SparkSession, path: str) -> dict[int, str]:
    """Committed loads of a table and the mark of each, as text. A load's folder is ``path/load=N/high_water=MARK``: the
    mark is part of what is written, and counts once the job has left its ``_SUCCESS``."""
    loads = {}
    for name in _folder_names(spark, path):
        inside = _folder_names(spark, f"{path}/{name}") if name.startswith(f"{LOAD}=") else []
        marks = [unquote(n.split("=", 1)[1]) for n in inside if n.startswith(f"{MARK}=")]
        if "_SUCCESS" in inside and marks:
            loads[int(name.split("=", 1)[1])] = marks[0]
    return dict(sorted(loads.items()))


def last_mark(spark: SparkSession, path: str, kind: DataType) -> Column | None:
    """The mark that the next load starts from, None before the first."""
    loads = stored_loads(spark, path)
    return F.lit(loads[max(loads)]).cast(kind) if loads else None


def load_next(path: str, column: str, source: Callable[[Column | None], DataFrame]) -> None:
    """Appends what is new in ``source`` to the table at ``path`` as its next load.

    ``source`` is called with the last mark, and gives the source's rows (all of them, or only those after the mark). The
    new mark is read first and bounds the slice; rows and mark are written by one job into the next load's
    folder. A load that fails leaves no ``_SUCCESS``: it isn't read, its mark isn't known, and the next call
    repeats it in its place. A load without rows writes nothing."""
    rows = source(None)
    spark, kind = rows.sparkSession, rows.schema[column].dataType
    last = last_mark(spark, path, kind)
    if last is not None:
        rows = source(last)
    mark = rows.where(F.col(column) > last if last is not None else F.lit(True)).agg(F.max(column)).first()[0]
    if mark is None:
        return
    number = max(stored_loads(spark, path), default=0) + 1
    (incremental_slice(rows, column, last, F.lit(mark)).withColumn(MARK, F.lit(mark)).write.mode("overwrite")
        .option("partitionOverwriteMode", "static").partitionBy(MARK).parquet(f"{path}/{LOAD}={number}"))


def read_loads(spark: SparkSession, path: str) -> DataFrame:
    """The table: rows of all committed loads, with the load and its mark."""
    whole = [f"{path}/{LOAD}={n}" for n in stored_loads(spark, path)]
    return spark.read.option("basePath", path).parquet(*whole)
