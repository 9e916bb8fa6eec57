"""Benchmark decontamination by template canonicalisation.

Texts become templates: words in small letters, with numbers, units after a
number and names (words with one capital inside a sentence) replaced by typed placeholders. Windows of a benchmark item's
template are hash-joined with those of the documents, so a question asked again
with other numbers or names still matches. The replaced words are the slots; a
match counts only if they are consistent, that is, if one and the same value of
the item is always replaced by one and the same value in the document and the
other way round. A copy without any change is consistent as well. Beside that,
a run of consecutive words of an item, as they are but for capitals, is a leak
on its own, whatever numbers and names it has and whatever else was changed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import words as W
from tributary.llm.common import without, written

WINDOW = 8
#: Of a window's tokens, so many at least are words, not placeholders (half of a shorter item's).
LITERALS = 4
#: An item is leaked if consistent matches cover this share of its windows.
COVERAGE = 0.3
#: So many consecutive words of an item, or all of a shorter one, are a leak whatever they cover.
RUN = 13
#: Item windows are looked up in blocks of so many at most: a bounded broadcast however large the benchmark.
BLOCK_WINDOWS = 1 << 20

# Words that count as units where they follow a number.
UNITS = (
    "mm cm m km inch inches foot feet ft yard yards mile miles g kg mg gram grams kilogram kilograms ton tons ounce"
    " ounces oz pound pounds lb lbs l ml liter liters litre litres gallon gallons second seconds sec s minute minutes"
    " min hour hours h day days week weeks month months year years dollar dollars usd euro euros eur cent cents percent"
    " degree degrees mph kmh hz khz mhz ghz w kw v a k c f bytes byte kb mb gb tb"
).split()

_U = np.uint64
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOPS = np.zeros(256, bool)
_STOPS[[ord(c) for c in ".!?:;\"\n"]] = True
NUMBER, UNIT, NAME = (W.mix(np.array([k], _U))[0] for k in (101, 102, 103))


def _unit_hashes() -> np.ndarray:
    text = pa.array([" ".join(UNITS)])
    return np.sort(W.split(*W.utf8(text), W.NOT_WORD).hash)


_UNITS = _unit_hashes()


class Templates:
    """Template tokens of a batch: hash (placeholders included), slot type (0: a word), words as written."""

    def __init__(self, column: pa.Array):
        data, offsets = W.utf8(column)
        self.data = W.lower(data)
        self.words = W.split(self.data, offsets, W.NOT_WORD)
        start, end, row = self.words.start, self.words.end, self.words.row
        digits = np.concatenate(([0], np.cumsum(_DIGIT[data], dtype=np.int64)))
        number = digits[end] > digits[start] if len(start) else np.zeros(0, bool)
        number &= _DIGIT[data[start]] if len(start) else number
        follows = np.zeros(len(start), bool)  # the word before is in the same row and on the same line
        follows[1:] = row[1:] == row[:-1]
        unit = np.zeros(len(start), bool)
        unit[1:] = number[:-1] & follows[1:] & np.isin(self.words.hash[1:], _UNITS)
        capital = data[start] != self.data[start] if len(start) else np.zeros(0, bool)
        if len(start):
            second = np.minimum(start + 1, len(data) - 1)
            wide = (data[start] == 0xC3) & (data[second] != self.data[second])
            # a small letter must follow: words all in capitals aren't names
            after = start + 1 + wide
            c, d = (data[np.minimum(after + k, len(data) - 1)] for k in (0, 1))
            small = (c >= 97) & (c <= 122) | (c == 0xC3) & (d >= 0xA0) | (c >= 0x80) & (c != 0xC3)
            capital = (capital | wide) & small & (after < end)
        stops = np.concatenate(([0], np.cumsum(_STOPS[data], dtype=np.int64)))
        inner = np.zeros(len(start), bool)  # no full stop, quote or line break since the word before
        inner[1:] = follows[1:] & (stops[start[1:]] == stops[end[:-1]])
        name = capital & inner & ~number & ~unit
        self.kind = np.select([number, unit, name], [1, 2, 3], 0).astype(np.int8)
        self.literal = self.words.hash
        self.words.hash = np.select([number, unit, name], [NUMBER, UNIT, NAME], self.words.hash).astype(_U)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the windows with enough words, and their first tokens."""
        h, at = W.windows(self.words, n)
        plain = np.concatenate(([0], np.cumsum(self.kind == 0)))
        enough = plain[at + n] - plain[at] >= min(LITERALS, -(-n // 2))
        return h[enough] + _U(n), at[enough]

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of the words themselves, and their first tokens."""
        h, at = W.windows(replace(self.words, hash=self.literal), n)
        return W.mix(h + _U(n)), at

    def slots(self, i: int, n: int) -> list[str]:
        """Type and value of each slot of a window."""
        w = self.words
        return [f"{self.kind[k]}:{bytes(self.data[w.start[k]:w.end[k]]).decode(errors='replace')}"
                for k in range(i, i + n) if self.kind[k]]


#: n is below 0 for a run of words as they are, which has no slots.
ITEM_WINDOWS = "item_id long, n int, window long, place int, windows int, slots array<string>"


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        t = Templates(batch.column("text"))
        first = t.words.per_row()
        out = []
        for r, item in enumerate(batch.column("item_id").to_pylist()):
            length = int(first[r + 1] - first[r])
            if not length:
                continue
            n = min(WINDOW, length)
            part = Templates(batch.column("text").slice(r, 1))
            h, at = part.windows(n)
            out += [(item, n, int(x), int(a), len(at), part.slots(int(a), n)) for x, a in zip(h.view(np.int64), at)]
            n, windows = min(RUN, length), len(at)
            h, at = part.runs(n)
            out += [(item, -n, int(x), int(a), windows, []) for x, a in zip(h.view(np.int64), at)]
        columns = list(zip(*out)) if out else [[]] * 6
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                         names=["item_id", "n", "window", "place", "windows", "slots"])


DOC_WINDOWS = "doc_id long, text_hash long, window long, at int, slots array<string>"


def _doc_windows(wanted, lengths: list[int]):
    """Windows of the documents whose hashes are in the sorted array ``wanted`` (a broadcast)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = wanted.value
        for batch in batches:
            t = Templates(batch.column("text"))
            first = t.words.per_row()
            keys = batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist()
            out = []
            for n in lengths:
                h, at = t.windows(n) if n > 0 else t.runs(-n)
                hit = np.flatnonzero(hashes[np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)] == h)
                for k in hit:
                    r = t.words.row[at[k]]
                    out.append((keys[0][r], keys[1][r], int(h[k].view(np.int64)), int(at[k] - first[r]),
                                t.slots(int(at[k]), n) if n > 0 else []))
            if out:
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 names=["doc_id", "text_hash", "window", "at", "slots"])
    return run


LEAKS = "doc_id long, text_hash long, item_id long, windows int, matched long, coverage double, exact boolean"


def find_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Benchmark items found in documents, asked as they are or with other values.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns are ignored. Returns one
    row for each document and item of which consistent matches (a value that conflicts costs the windows it is in) cover ``coverage`` or more of the item's
    windows, or of which RUN consecutive words (all, if it has fewer) are in the document: doc_id, text_hash (of the text; names the row with doc_id), item_id, windows of the item,
    matched windows, coverage (0 without windows), exact (a match with the item's own values throughout). An item shorter than a
    window is one window. Null or empty texts have no window; repeated rows are reported once; rows
    of a null id keep it. An empty table on either side gives an empty result."""
    spark: SparkSession = docs.sparkSession
    items = written(benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                                     F.coalesce("text", F.lit("")).alias("text")).distinct()
                    .mapInArrow(_item_windows, ITEM_WINDOWS), "item-windows")
    about = items.agg(F.count_distinct("window").alias("n"), F.collect_set("n").alias("lengths")).first()
    if not about.n:
        return spark.createDataFrame([], LEAKS)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       text.alias("text"))
    blocks = -(-about.n // BLOCK_WINDOWS)
    found = None
    for b in range(blocks):
        block = items.where(F.pmod(F.col("window"), F.lit(blocks)) == b).select("window").distinct()
        hashes = np.sort(block.toArrow().column("window").to_numpy().view(_U))
        if not len(hashes):
            continue
        part = rows.mapInArrow(_doc_windows(spark.sparkContext.broadcast(hashes), sorted(about.lengths)), DOC_WINDOWS)
        found = part if found is None else found.union(part)
    met = found.join(items.withColumnRenamed("slots", "item_slots"), "window")
    # a match of an item goes along one diagonal; slots are compared along it
    pairs = F.zip_with("item_slots", "slots", lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    runs = met.groupBy("doc_id", "text_hash", "item_id", "windows", (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.collect_set(F.when(F.col("n") > 0, F.struct("place", pairs.alias("pairs")))).alias("met"), F.max(F.col("n") < 0).alias("run"))
    runs = runs.withColumn("values", _values("met")).withColumn("met", F.filter(
        "met", lambda w: F.forall(w["pairs"], lambda p: F.array_contains("values", p))))
    runs = runs.where((F.size("met") > 0) | F.col("run")).select(
        "doc_id", "text_hash", "item_id", "windows", "run", F.transform("met", lambda w: w["place"]).alias("places"),
        F.forall("met", lambda w: F.forall(w["pairs"], lambda p: p["a"] == p["b"])).alias("same"))
    return runs.groupBy("doc_id", "text_hash", "item_id", "windows").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("places")))).cast("long").alias("matched"),
        F.max("same").alias("exact"), F.max("run").alias("run")).withColumn(
        "coverage", F.when(F.col("windows") > 0, F.col("matched") / F.col("windows")).otherwise(0.0)).where(
        (F.col("coverage") >= coverage) & (F.col("windows") > 0) | F.col("run")).select(
        "doc_id", "text_hash", "item_id", "windows", "matched", "coverage", "exact")


def _values(met: str) -> Column:
    """Which value of the document stands for which of the item along a diagonal, one for one: of pairs that exclude each
    other, the one in more windows, equal values before others, then the lesser. Windows with other pairs are in
    conflict with it; what they hold beside is not."""
    pair = "array<struct<a:string,b:string>>"

    def ranked(all_pairs: Column) -> Column:
        counted = F.transform(F.array_distinct(all_pairs), lambda p: F.struct(
            (-F.size(F.filter(all_pairs, lambda q: q == p))).alias("n"), (p["a"] != p["b"]).alias("other"), p.alias("p")))
        return F.aggregate(F.array_sort(counted), F.array().cast(pair), lambda kept, c: F.when(
            F.exists(kept, lambda k: (k["a"] == c["p"]["a"]) | (k["b"] == c["p"]["b"])), kept).otherwise(
            F.concat(kept, F.array(c["p"]))))

    flat = F.flatten(F.transform(met, lambda w: w["pairs"]))
    return F.get(F.transform(F.array(flat), ranked), 0)


def keep_unleaked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, in which no item is leaked."""
    return without(docs, find_leaks(docs, benchmark))
