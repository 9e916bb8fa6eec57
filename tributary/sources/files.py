"""File sources: CSV seed tables (S5) and the envelope file stream used as the
stand-in for a Kafka topic in tests and offline runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas as S


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Header, comma separated, quoted fields may hold commas; schema is explicit."""
    return (spark.read.schema(schema).option("header", True).option("quote", '"')
                 .option("escape", '"').option("mode", "PERMISSIVE").csv(path))


CORRUPT = "corrupt_line"


def read_csv_checked(spark: SparkSession, path: str, schema, header: bool = True) -> DataFrame:
    """Like ``read_csv``, with the text of each line that doesn't fit the schema in ``corrupt_line`` (null for good
    lines): a value of another type, too few values, or too many. Both outputs of ``split_corrupt`` come from it."""
    fields = [f.name for f in schema.fields]
    raw = (spark.read.schema(StructType([*schema.fields, StructField(CORRUPT, StringType())]))
                .option("header", header).option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    # a line is judged by all its values: a reader of some columns must not have the others left out
    whole = raw.select(F.struct(*[F.col(f"`{f}`") for f in fields]).alias("row"), CORRUPT)
    return whole.select(F.inline(F.array(F.struct("row", CORRUPT)))).select("row.*", CORRUPT)


def split_corrupt(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of ``read_csv_checked``: the good lines as rows, and the bad lines as they stand in the file."""
    good = checked.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, checked.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line"))


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, S.STATION)


def read_ridership(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, S.RIDERSHIP_SEED)


def read_curve(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, S.RIDERSHIP_CURVE)


def envelope_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming envelope read from parquet files with the Kafka source shape."""
    r = spark.readStream.schema(S.ENVELOPE)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.parquet(path)


def write_envelope(env: DataFrame, path: str, files: int | None = None) -> str:
    """Write envelope rows as parquet (a topic snapshot) for ``envelope_stream``."""
    out = env.repartition(files) if files else env
    out.write.mode("append").parquet(path)
    return path
