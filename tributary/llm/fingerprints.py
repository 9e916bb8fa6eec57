"""Document fingerprints by a homomorphic multiset hash.

A document is the multiset of its paragraphs (the pieces between ``\\n``; empty
ones count). Each paragraph is hashed to a wide vector, and the fingerprint is
the sum of the vectors, lane by lane: eight 64-bit lanes modulo 2**64 (BLAKE2b
of the paragraph) and 128 16-bit lanes modulo 2**16. The sum doesn't depend on
the order, and a paragraph is inserted or deleted by adding or subtracting its
vector, so an edit costs only the paragraphs it touches. The 64-bit lanes tell
equal multisets from others. In the 16-bit lanes each 24-byte gram of the
paragraph adds +1 or -1 to one lane, as does the paragraph as a whole (eight
times), so the cosine of two sums estimates how much of the texts agrees.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import shuffle_partitions

WIDE, LANES, GRAM, WHOLE = 8, 128, 24, 8
_U = np.uint64
_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], _U)
#: A text is hashed in pieces of so many bytes, so that memory doesn't follow its length.
PIECE = 1 << 20

Vector = tuple[np.ndarray, np.ndarray]


def _grams(b: np.ndarray, out: np.ndarray) -> None:
    n = len(b) - GRAM + 1
    if n <= 0:
        return
    at = lambda k: np.ndarray(n, "<u8", b, k, (1,))
    h = at(0) * _K[0] + at(8) * _K[1] + at(16) * _K[2]
    h ^= h >> _U(29)
    h *= _K[0]
    code = (h >> _U(56)).astype(np.int64)  # seven bits of lane, one of sign
    breaks = np.cumsum(b == 10, dtype=np.int32)
    clean = breaks[GRAM - 1:] == np.concatenate(([0], breaks[:n - 1]))
    code = code[clean]
    counts = np.bincount(code, minlength=2 * LANES)
    out += counts[0::2] - counts[1::2]


def vector(text: bytes | None) -> Vector:
    """Sum of the vectors of the paragraphs of ``text``; None stands for no paragraph at all."""
    sketch = np.zeros(LANES, np.int64)
    if text is None:
        return np.zeros(WIDE, _U), sketch.astype(np.uint16)
    digests = b"".join(hashlib.blake2b(p, digest_size=8 * WIDE).digest() for p in text.split(b"\n"))
    wide = np.frombuffer(digests, "<u8").reshape(-1, WIDE)
    b = np.frombuffer(text, np.uint8)
    for lo in range(0, max(1, len(b)), PIECE):
        _grams(np.ascontiguousarray(b[lo:lo + PIECE + GRAM - 1]), sketch)
    code = (wide[:, 0] >> _U(56)).astype(np.int64)
    counts = np.bincount(code, minlength=2 * LANES)
    sketch += WHOLE * (counts[0::2] - counts[1::2])
    return wide.sum(axis=0, dtype=_U), (sketch & 0xFFFF).astype(np.uint16)


def insert(a: Vector, b: Vector) -> Vector:
    return a[0] + b[0], a[1] + b[1]


def delete(a: Vector, b: Vector) -> Vector:
    return a[0] - b[0], a[1] - b[1]


def encode(v: Vector) -> str:
    return v[0].astype("<u8").tobytes().hex() + v[1].astype("<u2").tobytes().hex()


def decode(fingerprint: str) -> Vector:
    raw = bytes.fromhex(fingerprint)
    return np.frombuffer(raw[:8 * WIDE], "<u8").astype(_U), np.frombuffer(raw[8 * WIDE:], "<u2").astype(np.uint16)


def likeness(a: Vector, b: Vector) -> float:
    """0 to 1 from two fingerprints alone: 1 for equal ones, else the cosine of their 16-bit lanes."""
    if (a[0] == b[0]).all() and (a[1] == b[1]).all():
        return 1.0
    x, y = a[1].astype(np.int16).astype(float), b[1].astype(np.int16).astype(float)
    norm = float(np.sqrt((x @ x) * (y @ y)))
    return min(1.0, max(0.0, float(x @ y) / norm)) if norm else 0.0


def edited(text: str, following: str) -> str:
    """The last floor(n/2) code points replaced by the first as many (or all) of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _compare(text: str, following: str) -> tuple[str, str, str, float, Vector]:
    """sha256 of the edited text, both fingerprints, their likeness, the text's vector.

    The edited text's fingerprint comes from the text's own: the paragraphs from the cut on are
    deleted, those of the new ending inserted."""
    new = edited(text, following).encode()
    old = text.encode()
    cut = len(text[:len(text) - len(text) // 2].encode())
    keep = old.rfind(b"\n", 0, cut)  # paragraphs before this break stay
    head = vector(old[:keep] if keep >= 0 else None)
    tail = vector(old[keep + 1:])
    whole = insert(head, tail)
    changed = insert(delete(whole, tail), vector(new[keep + 1:]))
    return hashlib.sha256(new).hexdigest(), encode(whole), encode(changed), likeness(whole, changed), whole


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
       " near_edited double, near_next double")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted within a range; the last of a range is the next range's first document."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                        ("near_edited", pa.float64()), ("near_next", pa.float64())])
    held = None
    for batch in batches:
        out = []
        for rng, doc_id, text, guest in zip(*(batch.column(c).to_pylist() for c in ("rng", "doc_id", "text", "guest"))):
            if held is not None and held[0] == rng:
                _, own_id, own = held
                sha, whole, changed, near, v = _compare(own, text)
                follower = vector(text.encode())
                out.append((own_id, len(own), sha, whole, changed, near, likeness(v, follower)))
            held = None if guest else (rng, doc_id, text)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)


LEAST = -(1 << 63)
RANGES_PER_PARTITION = 4


def fingerprint_documents(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited text (see ``edited``), with their likenesses.

    ``docs`` has doc_id and text; other columns are ignored. The next document is the next one by
    ascending doc_id, after the last the first; null ids come first, and rows of one id go by a hash
    of their text and then the text. A null text is the empty text, whose fingerprint is that of one
    empty paragraph. A single document is its own next one. An empty table gives an empty result.

    Texts are shuffled once: rows are cut into ranges of (doc_id, hash of the text) at approximate quantiles (as
    many as ``RANGES_PER_PARTITION`` a partition; a bounded list on the driver), so that an id that many rows
    share spans several ranges. The first document of each
    range is sent along to the range before it, so no document lacks its neighbour; each range is
    sorted and walked in a stream that holds two documents."""
    spark = docs.sparkSession
    partitions = partitions or shuffle_partitions(spark)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumns({
        "key": F.coalesce("doc_id", F.lit(LEAST)), "tie": F.xxhash64("text")})
    bounds = _bounds(rows, RANGES_PER_PARTITION * partitions)
    if not bounds:
        return spark.createDataFrame([], OUT)
    # bounds[i] is the least (key, tie) of range i, and that of some row
    rng = _range_of(bounds)
    own = rows.withColumn("rng", rng("key", "tie")).withColumn("guest", F.lit(False))
    # two longs for each range; the least tie of a key stands for the first of its rows, whatever theirs is
    starts = F.broadcast(spark.createDataFrame(
        [(i, k, None if t == LEAST else t) for i, (k, t) in enumerate(bounds)], "start int, key long, from long"))
    firsts = (rows.join(starts, "key").where(F.col("from").isNull() | (F.col("tie") == F.col("from"))).groupBy("start", "key")
              .agg(F.min(F.struct("tie", "text", "doc_id")).alias("first")))
    guests = firsts.select("first.doc_id", "first.text", "key", "first.tie",
                           F.pmod(F.col("start") - 1, F.lit(len(bounds))).cast("int").alias("rng"),
                           F.lit(True).alias("guest"))
    dealt = own.unionByName(guests).repartition(partitions, "rng")
    return (dealt.sortWithinPartitions("rng", "guest", "key", "tie", "text")
            .select("rng", "doc_id", "text", "guest").mapInArrow(_walk, OUT))


def _bounds(rows: DataFrame, ranges: int) -> list[tuple[int, int]]:
    """The least (key, tie) of each of ``ranges`` ranges at most, ascending. Keys at which several ranges would begin have
    more rows than a range; those are cut at quantiles of their ties."""
    shares = [i / ranges for i in range(1, ranges)]
    found = rows.agg(F.min("key").alias("least"), F.percentile_approx("key", shares, 100_000).alias("bounds")).first()
    if found.least is None:
        return []
    times = Counter([found.least, *found.bounds])
    bounds = {(k, LEAST) for k in times}
    hot = {k: n for k, n in times.items() if n > 1}
    if hot:
        most = max(hot.values())
        ties = rows.where(F.col("key").isin(list(hot))).groupBy("key").agg(
            F.percentile_approx("tie", [i / most for i in range(1, most)], 100_000).alias("cuts"))
        # the quantiles are rounded to doubles: a range begins at the least tie from its cut on
        at = F.size(F.filter("cuts", lambda cut: cut <= F.col("tie")))
        starts = rows.join(F.broadcast(ties), "key").groupBy("key", at.alias("at")).agg(F.min("tie").alias("tie"))
        bounds |= {(r.key, r.tie) for r in starts.where("at > 0").collect()}
    return sorted(bounds)


def _range_of(bounds: list[tuple[int, int]]):
    keys, ties = np.array(bounds, np.int64).reshape(-1, 2).T

    @F.pandas_udf("int")
    def range_of(key: pd.Series, tie: pd.Series) -> pd.Series:
        key, tie = key.to_numpy(), tie.to_numpy()
        low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
        out = high - 1
        several = np.flatnonzero(high - low > 1)
        for k in np.unique(key[several]):  # few: keys with more rows than a range
            at = several[key[several] == k]
            a, b = low[at[0]], high[at[0]]
            out[at] = a + np.searchsorted(ties[a:b], tie[at], "right") - 1
        return pd.Series(out.astype(np.int32))

    return range_of
