"""Substring dedup: an FM-index per shard, searched backwards by streamed documents.

Every run of ``window`` words has a minimizer: the least hash among its grams of
eight words. Runs that are equal have equal minimizers, so a document is cut into
segments, each the words of the neighbouring runs that share one minimizer, and
segments are dealt to shards by the minimizer's hash: whatever a run equals is in
its own shard. Segments whose minimizer occurs once in the corpus are left out
early; equal segments are counted as one before anything is shuffled.

A shard indexes its segments: their suffix array gives the Burrows-Wheeler
transform, which is held as a wavelet matrix of packed bits. Segments are then
streamed through it. A backward search extends each end position to the left,
word by word, while the string still occurs twice; the length it reaches is the
matching statistic, and ends that reach ``window`` close a repeated run. Runs are
mapped back to the documents, where the words they cover go.

A minimizer with very many different segments is no shard's alone: its runs are
counted one by one, by hash, with partial sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm import words as W
from tributary.llm.common import is_member, maybe_member, membership, shuffle_partitions, written

WINDOW, GRAM = 35, 8
#: An index holds so many words, and more only where one minimizer has them.
INDEX_WORDS = 1 << 18
#: Minimizers with more different segments than this are counted run by run.
SPLIT_SEGMENTS = 4000

_U = np.uint64
_LOW = _U(0xFFFF)
_I64 = pa.int64()


# --- segments ---------------------------------------------------------------------------------------------


class Segments:
    """Segments of a batch: minimizer hash (48 bits), first word, words, row; and the word hashes."""

    def __init__(self, column: pa.Array, window: int = WINDOW):
        data, offsets = W.utf8(column)
        self.words = W.split(data, offsets)
        h, row = self.words.hash, self.words.row
        runs = len(h) - window + 1
        empty = np.zeros(0, np.int64)
        self.value, self.start, self.length, self.row = empty.view(_U), empty, empty, empty
        if runs <= 0:
            return
        grams = len(h) - GRAM + 1
        g = np.zeros(grams, _U)
        for k in range(GRAM):
            g = g * _U(0x9E3779B97F4A7C15) + h[k:k + grams]
        # the place rides in the low bits: ties go to the leftmost gram, and the place is known
        key = (W.mix(g) & ~_LOW) | (np.arange(grams, dtype=_U) & _LOW)
        span = window - GRAM + 1
        width = 1
        while 2 * width <= span:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        key = np.minimum(key[:runs], key[span - width:span - width + runs])
        inside = row[:runs] == row[window - 1:]
        at = np.flatnonzero(inside)
        if not len(at):
            return
        m = key[at]
        first = np.ones(len(at), bool)
        first[1:] = (m[1:] != m[:-1]) | (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]])
        begin = np.flatnonzero(first)
        count = np.diff(np.append(begin, len(at)))
        self.value, self.start = m[begin] >> _U(16), at[begin]
        self.length, self.row = count + window - 1, row[at[begin]]


def _minimizers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array((Segments(batch.column("text")).value << _U(16)).view(np.int64))],
                                         names=["value"])


FOUND = "id long, text_hash long, value long, at int, content binary"


def _candidates(repeated):
    """Segments whose minimizer may be repeated, with their words as 32-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = Segments(batch.column("text"))
            value = s.value << _U(16)
            some = np.flatnonzero(is_member(repeated.value, value))
            if not len(some):
                continue
            row, start, length = s.row[some], s.start[some], s.length[some]
            small = (s.words.hash >> _U(32)).astype(np.uint32)
            bounds = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
            take = np.repeat(start - bounds[:-1], length) + np.arange(bounds[-1])
            content = pa.Array.from_buffers(pa.binary(), len(some), [
                None, pa.py_buffer((bounds * 4).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(small[take]))])
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(pa.array(row)), batch.column("text_hash").take(pa.array(row)),
                pa.array(value[some].view(np.int64)),
                pa.array((start - s.words.per_row()[row]).astype(np.int32)), content],
                names=["id", "text_hash", "value", "at", "content"])
    return run


# --- FM-index ---------------------------------------------------------------------------------------------


class WaveletMatrix:
    """Ranks of symbols in a sequence: one packed bit vector a level, with counts per 64-bit word."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels = max(1, int(size - 1).bit_length())
        self.bits, self.counts, self.zeros = [], [], []
        n = len(symbols)
        current = symbols
        for level in range(self.levels - 1, -1, -1):
            bit = ((current >> level) & 1).astype(bool)
            padded = np.zeros((n // 64 + 1) * 64, np.uint8)
            padded[:n] = bit
            packed = np.packbits(padded, bitorder="little").view(_U)
            self.bits.append(packed)
            self.counts.append(np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64))))
            self.zeros.append(n - int(bit.sum()))
            current = np.concatenate((current[~bit], current[bit]))
        # at the bottom, equal symbols lie together
        self.first = np.zeros(size, np.int64)
        starts = np.flatnonzero(np.concatenate(([True], current[1:] != current[:-1]))) if n else np.zeros(0, int)
        self.first[current[starts]] = starts

    def down(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """first[symbol] + the number of that symbol before ``place``."""
        for k in range(self.levels):
            word = place >> 6
            ones = self.counts[k][word] + np.bitwise_count(
                self.bits[k][word] & ((_U(1) << (place & 63).astype(_U)) - _U(1))).astype(np.int64)
            up = ((symbol >> (self.levels - 1 - k)) & 1).astype(bool)
            place = np.where(up, self.zeros[k] + ones, place - ones)
        return place


class FMIndex:
    """Counts strings of up to 63 symbols in a text of symbols from 1 on (0 separates what must not match)."""

    DEPTH = 64

    def __init__(self, text: np.ndarray, size: int):
        n = len(text)
        rank, width = text.astype(np.int64), 1
        order = np.argsort(rank, kind="stable")
        while width < self.DEPTH:
            second = np.zeros(n, np.int64)
            second[:n - width] = rank[width:] + 1
            key = rank * (n + size + 2) + second
            order = np.argsort(key, kind="stable")
            key = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate(([0], key[1:] != key[:-1])))
            width *= 2
            if n and rank[order[-1]] == n - 1:
                break
        bwt = text[order - 1] if n else text
        self.wavelet = WaveletMatrix(bwt.astype(np.int64), size)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=size))))
        self.shift = self.before[:size] - self.wavelet.first

    def matching_statistics(self, text: np.ndarray, ends: np.ndarray, most: int, least_count: int = 2) -> np.ndarray:
        """For each end position (exclusive) of ``text``, the length of the longest string that ends there and
        occurs ``least_count`` times in the index, up to ``most``."""
        out = np.zeros(len(ends), np.int64)
        active = np.arange(len(ends))
        low = high = None
        for step in range(most):
            symbol = text[ends[active] - 1 - step]
            if low is None:
                low, high = self.before[symbol], self.before[symbol + 1]
            else:
                low = self.wavelet.down(symbol, low) + self.shift[symbol]
                high = self.wavelet.down(symbol, high) + self.shift[symbol]
            alive = (high - low >= least_count) & (symbol > 0)
            active, low, high = active[alive], low[alive], high[alive]
            if not len(active):
                break
            out[active] = step + 1
        return out


def repeated_runs(contents: list[bytes], counts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Of each segment, a mask of the runs that occur twice or more among all (bit k: the run from word k)."""
    hashes = [np.frombuffer(c, np.uint32) for c in contents]
    length = np.array([len(h) for h in hashes])
    _, symbol = np.unique(np.concatenate(hashes), return_inverse=True)
    size = int(symbol.max()) + 2
    start = np.concatenate(([0], np.cumsum(length + 1)))[:-1]
    text = np.zeros(int((length + 1).sum()), np.int64)
    text[np.repeat(start, length) + _places(length)] = symbol + 1
    index = FMIndex(text, size)
    runs = length - window + 1
    mask = np.where(counts > 1, (1 << runs) - 1, 0)
    single = np.flatnonzero(counts == 1)
    place = _places(runs[single])
    ends = np.repeat(start[single], runs[single]) + place + window
    hit = index.matching_statistics(text, ends, window) >= window
    np.bitwise_or.at(mask, np.repeat(single, runs[single])[hit], 1 << place[hit])
    return mask


def _places(length: np.ndarray) -> np.ndarray:
    """0 .. n-1 for each n, one after the other."""
    total = int(length.sum())
    return np.arange(total) - np.repeat(np.cumsum(length) - length, length)


MASKED = "value long, segment long, mask long"


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by value: a stretch of whole values makes an index."""
    held: list[tuple[int, int, int, bytes]] = []
    size = 0

    def flush(rows: list) -> pa.RecordBatch:
        value, segment, count, content = zip(*rows)
        mask = repeated_runs(list(content), np.array(count))
        some = np.flatnonzero(mask)
        return pa.RecordBatch.from_arrays([pa.array(np.array(value)[some], _I64), pa.array(np.array(segment)[some], _I64),
                                           pa.array(mask[some], _I64)], names=["value", "segment", "mask"])

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("value", "segment", "n", "content"))):
            if size >= INDEX_WORDS and row[0] != held[-1][0]:
                yield flush(held)
                held, size = [], 0
            held.append(row)
            size += len(row[3]) // 4
    if held:
        yield flush(held)


def _run_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of segments, one by one, by hash."""
    for batch in batches:
        contents = [np.frombuffer(c, np.uint32) for c in batch.column("content").to_pylist()]
        if not contents:
            continue
        length = np.array([len(c) for c in contents])
        all_words = W.mix(np.concatenate(contents).astype(_U) + _U(1))
        start = np.cumsum(length) - length
        runs = length - WINDOW + 1
        place = _places(runs)
        at = np.repeat(start, runs) + place
        h = np.zeros(len(at), _U)
        for k in range(WINDOW):
            h = h * _U(0x9E3779B97F4A7C15) + all_words[at + k]
        row = pa.array(np.repeat(np.arange(len(contents)), runs))
        yield pa.RecordBatch.from_arrays([
            *(batch.column(c).take(row) for c in ("value", "segment", "n")), pa.array(place.astype(np.int32)),
            pa.array(W.mix(h).view(np.int64))], names=["value", "segment", "n", "place", "run"])


def _split_masks(hot: DataFrame) -> DataFrame:
    """Masks of segments of minimizers with very many: their runs are counted by hash."""
    runs = hot.mapInArrow(_run_hashes, "value long, segment long, n long, place int, run long")
    counted = runs.groupBy("value", "run").agg(F.sum("n").alias("times")).where("times > 1").select("value", "run")
    return runs.join(counted, ["value", "run"]).groupBy("value", "segment").agg(
        F.bit_or(F.expr("shiftleft(1L, place)")).alias("mask"))


# --- documents --------------------------------------------------------------------------------------------


OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string, removed array<struct<start:int,end:int>>"


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        words, removed, kept, intervals = [], [], [], []
        for text, marks in zip(batch.column("text").to_pylist(), batch.column("marks").to_pylist()):
            tokens = text.encode().split()
            words.append(len(tokens))
            gone = 0
            spans: list[dict] = []
            if marks:
                delta = np.zeros(len(tokens) + 1, np.int64)
                at = np.array([m["at"] for m in marks])
                mask = np.array([m["mask"] for m in marks])
                for k in range(int(mask.max()).bit_length()):
                    first = at[(mask >> k) & 1 > 0] + k
                    np.add.at(delta, first, 1)
                    np.add.at(delta, first + WINDOW, -1)
                covered = np.cumsum(delta[:-1]) > 0
                gone = int(covered.sum())
                edge = np.flatnonzero(np.diff(np.concatenate(([0], covered, [0])).astype(int)))
                spans = [{"start": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)]
                tokens = [t for t, c in zip(tokens, covered) if not c]
            removed.append(gone)
            kept.append(hashlib.sha256(b" ".join(tokens)).hexdigest())
            intervals.append(spans)
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(words, _I64), pa.array(removed, _I64), pa.array(kept, pa.string()),
            pa.array(intervals, kind)], names=["doc_id", "n_words", "n_removed", "kept_sha256", "removed"])


def _untouched(marked):
    """``_remove`` of the rows that have no marks, by the bitmap of those that may have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.filter(pa.array(~is_member(marked.value, batch.column("text_hash").to_numpy().view(_U))))
            none = pa.nulls(rest.num_rows)
            yield from _remove([pa.RecordBatch.from_arrays([rest.column("doc_id"), rest.column("text"), none],
                                                           names=["doc_id", "text", "marks"])])
    return run


LEAST = -(1 << 63)


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """Removes from every text of ``docs`` (doc_id, text; other columns are ignored) the words of each run of
    ``WINDOW`` consecutive words that also starts anywhere else, in the same document or another.

    Returns doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by spaces) and removed (the
    removed stretches, as word numbers). All runs are judged on the input, so of a repeated passage no copy
    stays. A null or empty text has no word; a text shorter than a run loses none; repeated rows are each
    other's copies. An empty table gives an empty result."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)).alias("id"),
                       F.coalesce("text", F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    values = rows.select("text").mapInArrow(_minimizers, "value long")
    repeated = values.groupBy("value").agg(F.count("*").alias("n")).where("n > 1")
    early = membership(repeated, "value")
    found = rows.select("id", "text_hash", "text").mapInArrow(_candidates(early), FOUND)
    found = written(found.withColumn("segment", F.xxhash64("value", "content")), "segments")
    distinct = found.groupBy("value", "segment").agg(F.count("*").alias("n"), F.first("content").alias("content"))
    distinct = written(distinct, "distinct-segments")
    shape = distinct.groupBy("value").agg(F.count("*").alias("kinds"), F.sum("n").alias("times")).where("times > 1")
    sized = written(shape, "minimizers")
    # alone in its kind: every run of it is repeated if it occurs twice, and none otherwise
    cold = distinct.join(sized.where(F.col("kinds") <= SPLIT_SEGMENTS).select("value"), "value")
    shards = cold.repartition(shuffle_partitions(spark), "value").sortWithinPartitions("value")
    masks = shards.select("value", "segment", "n", "content").mapInArrow(_search, MASKED)
    hot = distinct.join(sized.where(F.col("kinds") > SPLIT_SEGMENTS).select("value"), "value")
    masks = masks.unionByName(_split_masks(hot.select("value", "segment", "n", "content")))
    marked = found.select("id", "text_hash", "value", "segment", "at").join(masks, ["value", "segment"])
    # a set: rows of one id and text bring the same marks, and a list must not grow with their number
    marks = written(marked.groupBy("id", "text_hash").agg(
        F.collect_set(F.struct("at", "mask")).alias("marks")), "marks")
    # texts that surely have no mark aren't shuffled
    some = membership(marks, "text_hash")
    touched = rows.where(maybe_member(some, F.col("text_hash"))).join(marks, ["id", "text_hash"], "left")
    whole = rows.select("doc_id", "text", "text_hash").mapInArrow(_untouched(some), OUT)
    return touched.select("doc_id", "text", "marks").mapInArrow(_remove, OUT).union(whole)
