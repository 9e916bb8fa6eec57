"""Decoders and encoders (D1-D12). All are set-wise column expressions.

Every function works unchanged on a batch DataFrame and on a streaming one.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from .. import schemas as S
from .avro import REGISTRY_PREFIX_BYTES, avro_available, from_avro_column  # noqa: F401


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# D1 ----------------------------------------------------------------------------
def value_text(col="value") -> Column:
    """Binary message value as UTF-8 text."""
    return _c(col).cast("string")


# D2, D3, D4 --------------------------------------------------------------------
def decode_json(df: DataFrame, schema: StructType, col="value",
                keep: Sequence[str] = ()) -> DataFrame:
    """Parse a JSON text (or binary) column with ``schema`` and flatten it (``value.*``).

    Malformed text gives a row of nulls (PERMISSIVE), never a failure.
    ``keep`` carries envelope columns such as ``offset`` through.

    The parsed struct is unpacked through a one-element ``inline`` rather than
    a projection: filters on the decoded fields (user filters, and the
    ``isnotnull`` that Catalyst infers from a join key) then stay above the
    parse instead of being pushed below it with a copy of the whole
    ``from_json`` each, so every message is parsed exactly once.
    """
    # Binary values become text; on a string column the cast is a no-op that
    # Catalyst removes (and no schema lookup is needed to decide).
    src = _c(col).cast("string")
    return df.select(*keep, F.inline(F.array(F.from_json(src, schema))))


# D5 ----------------------------------------------------------------------------
def first_element(array_col, field: str) -> Column:
    """``arr[0].field`` that yields null (not an error) on a null or empty array."""
    return F.get(_c(array_col), 0).getField(field)


# D6, D7 ------------------------------------------------------------------------
def unbase64_text(col) -> Column:
    """Base64 text -> UTF-8 text. Garbage decodes to garbage that later fails to parse."""
    return F.unbase64(_c(col)).cast("string")


def decode_base64_json(df: DataFrame, col: str, schema: StructType,
                       keep: Sequence[str] = ()) -> DataFrame:
    """Base64-wrapped JSON -> flat struct columns."""
    return decode_json(df.select(*keep, unbase64_text(col).alias(col)), schema, col, keep)


# D8 ----------------------------------------------------------------------------
def encode_json(df: DataFrame, key: str | None, cols: Sequence[str] | None = None) -> DataFrame:
    """Row -> (key string, value JSON) with fields in column order (``to_json(struct(*))``)."""
    cols = list(cols or df.columns)
    key_col = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(key_col.alias("key"), F.to_json(F.struct(*cols)).alias("value"))


def encode_record(df: DataFrame, key_cols: Sequence[str] | None,
                  value_cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """S10 helper: JSON key struct + JSON value struct (key null when no key columns);
    ``keep`` columns pass through next to them."""
    key = F.to_json(F.struct(*key_cols)) if key_cols else F.lit(None).cast("string")
    return df.select(*keep, key.alias("key"), F.to_json(F.struct(*value_cols)).alias("value"))


# D9 ----------------------------------------------------------------------------
def decode_avro(env: DataFrame, schema_json: str, keep: Sequence[str] = (),
                registry_framed: bool = True, col: str = "value") -> DataFrame:
    """Avro value -> flat columns. Registry-framed messages carry a 5-byte prefix.
    Spark's own ``from_avro``; needs the spark-avro package."""
    body = F.col(col)
    if registry_framed:
        body = F.expr(f"substring(`{col}`, {REGISTRY_PREFIX_BYTES + 1})")
    return env.select(*keep, F.inline(F.array(from_avro_column(body, schema_json))))


def decode_message(env: DataFrame, schema: StructType, fmt: str = "json",
                   avro_schema: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Decode a topic whose format is chosen by the caller (weather: json by default)."""
    if fmt == "json":
        return decode_json(env, schema, "value", keep)
    if fmt == "avro":
        if avro_schema is None:
            raise ValueError("avro decoding needs the writer schema")
        return decode_avro(env, avro_schema, keep)
    raise ValueError(f"unknown format {fmt!r}")


# D10 ---------------------------------------------------------------------------
def check_constraints(df: DataFrame, not_null: Iterable[str], unique: Iterable[str]) -> DataFrame:
    """Data-quality report: one row per check with the number of violating rows.

    NOT NULL checks are one pass of ``count_if`` (partial aggregation, one row
    out). The uniqueness check groups by the key and counts the rows of
    duplicated keys; map-side combine keeps a hot key cheap.
    """
    not_null, unique = list(not_null), list(unique)
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in not_null])
    stack = ", ".join(f"'not_null:{c}', `{c}`" for c in not_null)
    null_rows = nulls.selectExpr(f"stack({len(not_null)}, {stack}) as (`check`, violations)")
    dup_rows = (df.groupBy(*unique).agg(F.count(F.lit(1)).alias("n"))
                  .where(F.col("n") > 1)
                  .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("violations"))
                  .select(F.lit("unique:" + ",".join(unique)).alias("check"), "violations"))
    return null_rows.unionByName(dup_rows)


MEMBER_BITS = 26
_ROW_BITS = 32768  # of one row of Spark's bitmap functions


def _place(keys: Sequence[str], bits: int) -> Column:
    """Where a key's bit is in a bitmap of ``2**bits`` bits, from 1."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - bits) + 1


def maybe_among(rows: DataFrame, others: DataFrame, keys: Sequence[str], bits: int = MEMBER_BITS) -> DataFrame:
    """``rows`` without those whose key is surely not among ``others``: a bitmap of their hashes, of 8 MB at most by
    default, is made by Spark's bitmap aggregation and broadcast, so ``rows`` aren't shuffled. It lets some
    through that aren't among them; an exact join has to follow."""
    at = others.select(F.bitmap_bucket_number(_place(keys, bits)).alias("__row"),
                       F.bitmap_bit_position(_place(keys, bits)).alias("__bit"))
    bitmap = at.groupBy("__row").agg(F.bitmap_construct_agg("__bit").alias("__bits"))
    bit = F.bitmap_bit_position(_place(keys, bits))
    byte = F.conv(F.hex(F.substring("__bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = rows.withColumn("__row", F.bitmap_bucket_number(_place(keys, bits))).join(F.broadcast(bitmap), "__row")
    return found.where(F.getbit(byte, (bit % 8).cast("int")) == 1).select(*[f"`{c}`" for c in rows.columns])


def clashes(new: DataFrame, stored: DataFrame, unique: Sequence[str]) -> DataFrame:
    """D10 across loads: the rows of a new slice whose ``unique`` columns a stored row has already, each once. Nulls
    never clash.

    The stored table may be far larger than the slice: its rows are first cut down by a bitmap of the slice's keys, and
    only what is left of them (one row a key) is joined exactly."""
    unique = list(unique)
    keyed = new.dropna(subset=unique)
    known = maybe_among(stored.select(*unique).dropna(), keyed, unique).distinct()
    return keyed.join(known, unique, "left_semi").select(*new.columns)


# D11, D12 ----------------------------------------------------------------------
def decode_station(env: DataFrame, keep: Sequence[str] = ("offset",)) -> DataFrame:
    return decode_json(env, S.STATION, "value", keep)


def decode_summary(env: DataFrame, keep: Sequence[str] = (), lower: bool = True) -> DataFrame:
    """Summary messages use upper-case keys; optionally rename to station_id, count."""
    out = decode_json(env, S.TURNSTILE_SUMMARY, "value", keep)
    if lower:
        out = out.withColumnsRenamed({"STATION_ID": "station_id", "COUNT": "count"})
    return out


# T6 ----------------------------------------------------------------------------
def malformed(fields: Sequence[str]) -> Column:
    """A message is malformed when all its fields decode to null (garbage, a tombstone, or another type)."""
    return F.forall(F.array(*[F.col(f"`{f}`").isNull() for f in fields]), lambda missing: missing)


def well_formed(decoded: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Bad messages skipped: what every keyed table reads."""
    return decoded.where(~malformed(fields))


def split_malformed(decoded: DataFrame, fields: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(good, dead letters) of a decoded topic."""
    return well_formed(decoded, fields), decoded.where(malformed(fields))


def dead_letters(env: DataFrame, schema: StructType, fmt: str = "json", avro_schema: str | None = None) -> DataFrame:
    """The messages of a topic that decode to nothing, as they came: position and raw value."""
    keep = ("topic", "partition", "offset", "timestamp", "value")
    decoded = decode_message(env.withColumn("raw", F.col("value")), schema, fmt, avro_schema, keep=(*keep[:-1], "raw"))
    return decoded.where(malformed([f.name for f in schema.fields])).withColumnRenamed("raw", "value").select(*keep)


def check_messages(env: DataFrame, schema: StructType, fmt: str = "json", avro_schema: str | None = None) -> DataFrame:
    """Every message of a topic, parsed once: position, body (the decoded fields), dead (nothing could be decoded)
    and letter (the raw value of a dead one). Both outputs of a checked topic come from these rows."""
    fields = [f.name for f in schema.fields]
    keep = F.struct("topic", "partition", "offset", "timestamp", "value").alias("__message")
    decoded = decode_message(env.select(keep, "value"), schema, fmt, avro_schema, keep=("__message",))
    dead = malformed(fields)
    at = F.struct(*[F.col(f"__message.{c}").alias(c) for c in ("topic", "partition", "offset", "timestamp")])
    return decoded.select(at.alias(POSITION), F.struct(*[F.col(f"`{f}`") for f in fields]).alias("body"),
                          dead.alias("dead"), F.when(dead, F.col("__message.value")).alias("letter"))


# Position of a message -------------------------------------------------------------
POSITION = "position"


def positioned(env: DataFrame) -> DataFrame:
    """Adds the order of a message among all partitions of all its topics: (timestamp, topic, partition,
    offset). An offset alone only orders one partition of one topic."""
    return env.withColumn(POSITION, F.struct("timestamp", "topic", "partition", "offset"))
