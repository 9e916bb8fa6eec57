"""Phrases that keep together, mined by dynamic itemset counting.

Single words are counted first. The corpus, in which rare words are left out as ends of pieces are, is then dealt to a
few shards, which are scanned one after the other, round and
round. A longer phrase is activated as
soon as both its subphrases (without its last, without its first word) have been counted
often enough, be it in the middle of a round, and is counted until it has seen each
shard once: so lengths are counted side by side, and a phrase's count is exact after
one full cycle. No list of possible phrases is made: what stands in a shard is counted
if its subphrases are active.

Up to a bounded number of active words and phrases each has a number, and a scan has their table: it counts exactly
what is active, by the numbers of both subphrases. Beyond that phrases are hashes; a scan leaves most of them out by a
bitmap of fixed size, and what the bitmap lets
through is joined with the table of subphrases once it could reach the threshold.
Counts of the last cycle are then kept by phrase, one number for each shard, so that a phrase
counted too early by the bitmap loses those scans again.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm import words as W
from tributary.llm.common import is_member, maybe_member, member_bits, membership, narrow_batches, written

LEAST, LONGEST, TOP = 100, 5, 2000
SHARDS = 3
#: Bits (a power of two) of the bitmaps of active phrases; fewer let more through that is left out later.
BITS = 25
#: Up to so many active words and phrases (28 bytes each) are broadcast as a table; more as a bitmap, and joined.
BROADCAST_PHRASES = 1 << 19
#: A numbered phrase is known by a long: its words, the scan that activated it, the numbers of both subphrases.
NUMBER_BITS, SCAN_BITS = 20, 12
#: A task sums its phrases when it holds so many, and hands them on if so many are different.
HELD, DIFFERENT = 1 << 20, 1 << 19
#: Salts of joins and rankings by language, as one language may have nearly all phrases.
SALTS = 32

_U = np.uint64
_I64 = pa.int64()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_APART = _BREAK.copy()
_APART[[0x20, 0x09]] = True


# --- tokens -----------------------------------------------------------------------------------------------


def pieces(column: pa.Array) -> tuple[W.Words, np.ndarray]:
    """Words of the texts, A-Z in small letters, and which of them begin a piece."""
    data, offsets = W.utf8(column)
    found = W.split(_LOWER[data], offsets, _APART)
    breaks = np.concatenate(([0], np.cumsum(_BREAK[data])))
    begins = np.ones(len(found.start), bool)
    begins[1:] = (breaks[found.start[1:]] != breaks[found.end[:-1]]) | (found.row[1:] != found.row[:-1])
    return found, begins


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of the phrase with these subphrases (of a word: language and word); 0 is no phrase."""
    return np.maximum(W.mix(left * _U(0x9E3779B97F4A7C15) + right), _U(1))


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Byte ranges of UTF-8 as strings."""
    length = end - start
    bounds = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
    take = np.repeat(start - bounds[:-1], length) + np.arange(bounds[-1])
    return pa.Array.from_buffers(pa.string(), len(start), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data[take]))])


class Vocabulary:
    """Words that a task has met, each with its language, spelling and number."""

    def __init__(self):
        self.phrase, self.root, self.text = [], [], []
        self.seen, self.held, self.size = np.zeros(0, _U), [], 0

    def add(self, phrase: np.ndarray, root: np.ndarray, found: W.Words) -> None:
        one, where, n = np.unique(phrase, return_index=True, return_counts=True)
        self.held.append((one, n))
        self.size += len(one)
        at = np.minimum(np.searchsorted(self.seen, one), max(0, len(self.seen) - 1))
        fresh = self.seen[at] != one if len(self.seen) else np.ones(len(one), bool)
        where = where[fresh]
        self.phrase.append(one[fresh])
        self.root.append(root[where])
        self.text.append(_strings(found.data, found.start[where], found.end[where]))
        if self.size > HELD:
            self.merge()

    def merge(self) -> None:
        phrase, n = (np.concatenate(x) for x in zip(*self.held))
        order = np.argsort(phrase, kind="stable")
        phrase, n = phrase[order], n[order]
        first = np.flatnonzero(np.append(True, phrase[1:] != phrase[:-1]))
        self.seen = phrase[first]
        self.held, self.size = [(self.seen, np.add.reduceat(n, first))], len(first)

    def rows(self) -> Iterator[pa.RecordBatch]:
        """Each word once; the words are forgotten."""
        if self.held:
            self.merge()
            phrase, root = np.concatenate(self.phrase), np.concatenate(self.root)
            # a word that was fresh in several batches before a merge is there several times
            _, where = np.unique(phrase, return_index=True)
            text = pa.concat_arrays(self.text).take(pa.array(where))
            yield pa.RecordBatch.from_arrays([
                pa.array(self.seen.view(np.int64)), pa.array(root[where].view(np.int64)), text,
                pa.array(self.held[0][1].astype(np.int64))], names=["phrase", "root", "word", "n"])
        self.__init__()


#: Words that a task met, each with its number of occurrences.
MET = "phrase long, root long, word string, n long"


def _words(batch: pa.RecordBatch) -> tuple[W.Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a batch (root, text), which begin a piece, language and phrase hash of each."""
    found, begins = pieces(batch.column("text"))
    root = batch.column("root").to_numpy().view(_U)[found.row]
    return found, begins, root, combine(root, found.hash)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    vocabulary = Vocabulary()
    for batch in batches:
        found, _, root, phrase = _words(batch)
        if len(phrase):
            vocabulary.add(phrase, root, found)
            if len(vocabulary.seen) > DIFFERENT:
                yield from vocabulary.rows()
    yield from vocabulary.rows()


def _tokenise(frequent, numbered: bool):
    """Texts as numbers (4 bytes) or hashes (8 bytes) of their frequent words, with 0 wherever one is followed by another
    piece or a rare word. ``frequent`` holds the hashes of the numbered words, ascending, or a bitmap of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frequent.value
        for batch in batches:
            found, begins, _, phrase = _words(batch)
            if numbered:
                at = np.minimum(np.searchsorted(known, phrase), max(0, len(known) - 1))
                code = np.where(known[at] == phrase, at + 1, 0).astype(np.uint32) if len(known) else np.zeros(len(phrase), np.uint32)
            else:
                code = np.where(is_member(known, phrase), phrase, _U(0))
            # a 0 before each piece, but one only of several in a row
            place = np.arange(len(code)) + np.cumsum(begins)
            stream = np.zeros(len(code) + int(begins.sum()), code.dtype)
            stream[place] = code
            keep = stream > 0
            keep[1:] |= stream[:-1] > 0
            bounds = np.concatenate(([0], np.cumsum(begins)))
            first = found.per_row()
            first = np.append(0, np.cumsum(keep))[bounds[first] + first]
            stream = stream[keep]
            some = np.flatnonzero(np.diff(first))
            yield pa.RecordBatch.from_arrays([
                batch.column("shard").take(pa.array(some)),
                pa.array([stream[first[i]:first[i + 1]].tobytes() for i in some], pa.binary())], names=["shard", "tokens"])
    return run


def _joined(batch: pa.RecordBatch, kind) -> np.ndarray:
    """The tokens of a batch, with 0 after each text."""
    end = bytes(np.dtype(kind).itemsize)
    return np.frombuffer(end.join([*batch.column("tokens").to_pylist(), end]), kind)


# --- one scan, phrases by number --------------------------------------------------------------------------


class Numbers:
    """Numbered phrases: of each (0: none) its hash, words and the scan in which it was counted often enough; and
    the numbers of those of two words and more by the numbers of their subphrases."""

    def __init__(self, words: np.ndarray):
        size = len(words) + 1
        self.hash = np.append(_U(0), words)
        self.k, self.reached = np.ones(size, np.int64), np.zeros(size, np.int64)
        self.pairs, self.number = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray, step: int) -> None:
        k, _, left, right = taken_apart(keys)
        number = np.arange(len(keys)) + len(self.hash)
        self.hash = np.append(self.hash, combine(self.hash[left], self.hash[right]))
        self.k, self.reached = np.append(self.k, k), np.append(self.reached, np.full(len(keys), step))
        pairs, number = np.append(self.pairs, left << NUMBER_BITS | right), np.append(self.number, number)
        order = np.argsort(pairs)
        self.pairs, self.number = pairs[order], number[order]

    def look_up(self, pair: np.ndarray) -> np.ndarray:
        """The number of each pair of numbers, 0 if it has none."""
        if not len(self.pairs):
            return np.zeros(len(pair), np.int64)
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.number[at], 0)


def taken_apart(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, activating scan and both subphrases of the keys of numbered phrases."""
    low = (1 << NUMBER_BITS) - 1
    since = keys >> 2 * NUMBER_BITS
    return since >> SCAN_BITS, since & (1 << SCAN_BITS) - 1, keys >> NUMBER_BITS & low, keys & low


class Tally:
    """Sums of keys."""

    def __init__(self):
        self.held, self.size = [], 0
        self.keys, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray) -> None:
        self.held.append(keys)
        self.size += len(keys)

    def merge(self) -> None:
        fresh = np.sort(np.concatenate([*self.held, np.zeros(0, np.int64)]))
        first = np.flatnonzero(np.append(True, fresh[1:] != fresh[:-1])[:len(fresh)])
        keys, n = np.append(self.keys, fresh[first]), np.append(self.n, np.diff(np.append(first, len(fresh))))
        if len(self.keys):
            order = np.argsort(keys, kind="stable")
            keys, n = keys[order], n[order]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            keys, n = keys[first], np.add.reduceat(n, first)
        self.keys, self.n, self.held, self.size = keys, n, [], 0

    def rows(self) -> pa.RecordBatch:
        """All sums, which are forgotten."""
        self.merge()
        out = pa.RecordBatch.from_arrays([pa.array(self.keys), pa.array(self.n)], names=["key", "n"])
        self.__init__()
        return out


def _scan_numbers(active, step: int, shards: int, longest: int):
    """Numbered phrases of two words and more of a shard that are active in scan ``step``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, tally = active.value, Tally()
        for batch in batches:
            # of each place the number of the phrase of k - 1 words that begins there
            now = _joined(batch, np.uint32).astype(np.int64)
            at = np.flatnonzero(now)
            for k in range(2, longest + 1):
                at = at[now[at + 1] > 0]
                if not len(at):
                    break
                left, right = now[at], now[at + 1]
                since = np.maximum(numbers.reached[left], numbers.reached[right])
                pair = left << NUMBER_BITS | right
                # a phrase both of whose subphrases were known before the last cycle is done
                going = since >= step - shards
                tally.add(((k << SCAN_BITS | since[going]) << 2 * NUMBER_BITS) | pair[going])
                number = numbers.look_up(pair)
                now = np.zeros(len(now), np.int64)
                now[at] = number
                at = at[number > 0]
            if tally.size > HELD:
                tally.merge()
                if len(tally.keys) > DIFFERENT:
                    yield tally.rows()
        yield tally.rows()
    return run


NAMED = "k int, phrase long, left long, right long, active int, n long"


def _named(numbers):
    """Rows (key, n) of numbered phrases with their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = numbers.value.hash
        for batch in batches:
            k, active, left, right = taken_apart(batch.column("key").to_numpy())
            left, right = of[left], of[right]
            yield pa.RecordBatch.from_arrays([
                pa.array(k.astype(np.int32)), *[pa.array(x.view(np.int64)) for x in (combine(left, right), left, right)],
                pa.array(active.astype(np.int32)), batch.column("n")],
                names=["k", "phrase", "left", "right", "active", "n"])
    return run


# --- one scan, phrases by hash ----------------------------------------------------------------------------


class Counts:
    """Sums of phrases: length, hash, hashes of both subphrases, occurrences."""

    def __init__(self):
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, k: int, phrase: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
        if not len(phrase):
            return
        same = np.argsort(phrase, kind="stable")
        phrase = phrase[same]
        first = np.flatnonzero(np.append(True, phrase[1:] != phrase[:-1]))
        at = same[first]
        self.held.append(np.stack((np.full(len(first), k, np.int64), phrase[first].view(np.int64),
                                   left[at].view(np.int64), right[at].view(np.int64),
                                   np.diff(np.append(first, len(phrase))))))
        self.size += len(first)

    def summed(self) -> np.ndarray:
        if not self.held:
            return np.zeros((5, 0), np.int64)
        rows = np.concatenate(self.held, axis=1)
        order = np.argsort(rows[1], kind="stable")
        rows = rows[:, order]
        first = np.flatnonzero(np.append(True, rows[1, 1:] != rows[1, :-1]))
        out = rows[:, first]
        out[4] = np.add.reduceat(rows[4], first)
        self.held, self.size = [out], out.shape[1]
        return out


COUNTED = "k int, phrase long, left long, right long, n long"


def _scan(bitmaps, vocabulary, longest: int):
    """Phrases of two words and more of a shard that may be active: ``bitmaps`` has those counted often enough, and
    those of the last cycle among them. ``vocabulary`` has the hashes of words that the shard has by number."""

    def batch_of(rows: np.ndarray) -> pa.RecordBatch:
        k, phrase, left, right, n = rows
        return pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), *map(pa.array, (phrase, left, right, n))],
                                          names=["k", "phrase", "left", "right", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, (every, lately) = Counts(), bitmaps.value
        for batch in batches:
            # of each place the hash of the phrase of k - 1 words that begins there
            now = _joined(batch, _U) if vocabulary is None else np.append(_U(0), vocabulary.value)[_joined(batch, np.uint32)]
            at = np.flatnonzero(now)
            for k in range(2, longest + 1):
                known = np.zeros(len(now), bool)
                known[at] = is_member(every, now[at])
                at = at[known[at] & known[at + 1]]
                if not len(at):
                    break
                left, right = now[at], now[at + 1]
                new = combine(left, right)
                # a phrase both of whose subphrases were known before the last cycle is done
                some = is_member(lately, left) | is_member(lately, right)
                counts.add(k, new[some], left[some], right[some])
                now = np.zeros(len(now), _U)
                now[at] = new
            if counts.size > HELD:
                rows = counts.summed()
                if counts.size > DIFFERENT:
                    yield batch_of(rows)
                    counts = Counts()
        yield batch_of(counts.summed())
    return run


# --- cycles -----------------------------------------------------------------------------------------------


PHRASES = ["k", "phrase", "left", "right", "a"]


def mine(shards_of: list[DataFrame], words: DataFrame, vocabulary: np.ndarray | None, least: int = LEAST,
         longest: int = LONGEST) -> DataFrame:
    """Counts of all phrases of 2 to ``longest`` words that occur ``least`` times: k, phrase, left, right (hashes of
    the phrase and its subphrases) and a, exact.

    ``shards_of`` has the shards (tokens), ``words`` the words (phrase) that occur so often, known before the first
    scan, ``vocabulary`` the same, ascending, if the shards have them by number. Scans go round the shards until each
    phrase has seen all of them."""
    known = words.select("phrase", F.lit(0).alias("reached"))
    done, rest = [], (0, None, known)
    if vocabulary is not None:
        done, rest = _by_number(shards_of, known, vocabulary, least, longest)
    if rest is not None:
        done += _by_hash(shards_of, *rest, vocabulary, least, longest)
    return written(functools.reduce(DataFrame.union, done), "phrases")


def _by_number(shards_of: list[DataFrame], known: DataFrame, vocabulary: np.ndarray, least: int, longest: int):
    """Scans as long as the active phrases can be numbered: the whole counts so far, and what ``_by_hash`` goes on with
    (None if there is nothing left)."""
    spark, shards = shards_of[0].sparkSession, len(shards_of)
    numbers = Numbers(vocabulary)
    k = F.shiftright("key", 2 * NUMBER_BITS + SCAN_BITS)
    active = F.shiftright("key", 2 * NUMBER_BITS).bitwiseAND(F.lit((1 << SCAN_BITS) - 1))
    state, whole, news, fresh_in, step = None, [], [], [len(vocabulary) > 0], 0
    while True:
        table = spark.sparkContext.broadcast(numbers)
        many = news and news[-1] is None
        if many or not any(fresh_in[-shards:]):
            break
        step += 1
        rows = shards_of[(step - 1) % shards].mapInArrow(_scan_numbers(table, step, shards, longest), "key long, n long")
        rows = rows.withColumn("before", F.lit(0).cast("long"))
        if state is not None:
            rows = rows.unionByName(state.withColumn("before", F.col("n")))
        sums = rows.groupBy("key").agg(F.sum("n").alias("n"), F.sum("before").alias("before"))
        going, often = active > step - shards, F.col("n") >= least
        sums = written(sums.where(going | often), "phrase-counts")
        table.destroy()
        state = sums.where(going).select("key", "n")
        # a full cycle after it was activated, a phrase has its whole count
        whole.append(sums.where(often & (active == step - shards)).select("key", "n"))
        fresh = sums.where(often & (F.col("before") < least) & (k < longest)).select("key", F.lit(step).cast("long").alias("n"))
        room = BROADCAST_PHRASES - len(numbers.hash) + 1
        new = fresh.select("key").limit(room + 1).toArrow().column("key").to_numpy()
        fresh_in.append(len(new) > 0)
        news.append(fresh)
        if len(new) > room:
            news.append(None)
        else:
            numbers.add(new, step)
    done = [x.mapInArrow(_named(table), NAMED).select("k", "phrase", "left", "right", F.col("n").alias("a")) for x in whole]
    if not done:
        done = [spark.createDataFrame([], "k int, phrase long, left long, right long, a long")]
    if not many:
        return done, None
    for fresh in news[:-1]:
        known = known.union(fresh.mapInArrow(_named(table), NAMED).select("phrase", F.col("n").cast("int")))
    # all of a phrase was counted since it was active: the slot of the first scan after holds it as long as it is needed
    state = state.mapInArrow(_named(table), NAMED).select("k", "phrase", "left", "right", *[
        F.when((F.col("active") + 1) % shards == i, F.col("n")).otherwise(0).alias(f"n{i}") for i in range(shards)])
    return done, (step, written(state, "phrase-counts"), written(known, "phrase-known"))


def _by_hash(shards_of: list[DataFrame], step: int, state: DataFrame | None, known: DataFrame,
             vocabulary: np.ndarray | None, least: int, longest: int) -> list[DataFrame]:
    """Scans from ``step`` on, given the counts of phrases not seen by all shards and the active phrases with the scan in
    which each was counted often enough: the whole counts."""
    spark, shards = shards_of[0].sparkSession, len(shards_of)
    slots = [f"n{i}" for i in range(shards)]
    total = functools.reduce(Column.__add__, [F.col(s) for s in slots])
    last = [member_bits(known.where(F.col("reached") == t), "phrase", BITS) for t in range(step + 1)]
    every = functools.reduce(np.bitwise_or, last)
    words = None if vocabulary is None else spark.sparkContext.broadcast(vocabulary)
    done = []
    while any(x.any() for x in last[-shards:]):
        step += 1
        now = f"n{step % shards}"
        bitmaps = spark.sparkContext.broadcast((every, functools.reduce(np.bitwise_or, last[-shards:])))
        rows = shards_of[(step - 1) % shards].mapInArrow(_scan(bitmaps, words, longest), COUNTED).select(
            "k", "phrase", "left", "right", *[(F.col("n") if s == now else F.lit(0).cast("long")).alias(s) for s in slots])
        if state is not None:
            # the slot of this scan has its count of the last cycle still
            rows = rows.unionByName(state.withColumn(now, F.lit(0).cast("long")).where(total > 0))
        state = written(rows.groupBy("phrase").agg(F.first("k").alias("k"), F.first("left").alias("left"),
                                                   F.first("right").alias("right"), *[F.sum(s).alias(s) for s in slots]),
                        "phrase-counts")
        found = _activated(state.where(total >= least), known, step, slots, least)
        # a full cycle after it was activated, a phrase has its whole count
        done.append(found.where(F.col("active") == step - shards).select(*PHRASES))
        fresh = found.where((F.col("reached") == step) & (F.col("k") < longest)).select("phrase", "reached")
        known = known.union(fresh)
        last.append(member_bits(fresh, "phrase", BITS))
        every = every | last[-1]
        bitmaps.destroy()
    return done or [spark.createDataFrame([], "k int, phrase long, left long, right long, a long")]


def _activated(many: DataFrame, known: DataFrame, step: int, slots: list[str], least: int) -> DataFrame:
    """Of phrases counted by bitmaps, those of which both subphrases had been counted often enough, with the scan after
    which they had (``active``), the count since then, ``a``, if it is ``least``, and the
    scan in which it first was (``reached``). Written."""
    def met(column: str, into: str) -> DataFrame:
        return known.select(F.col("phrase").alias(column), F.col("reached").alias(into))

    shards = len(slots)
    both = many.join(met("left", "one"), "left").join(met("right", "two"), "right")
    both = both.withColumn("active", F.greatest("one", "two")).drop("one", "two")
    # what was counted before the phrase was active doesn't count
    counted = sum((F.when(F.col("active") < t, F.col(slots[t % shards])).otherwise(0)
                   for t in range(max(1, step - shards + 1), step + 1)), F.lit(0))
    found = both.withColumn("a", counted.cast("long")).where(
        (F.col("a") >= least) & (F.col("active") >= step - shards))
    found = found.join(met("phrase", "reached"), "phrase", "left").withColumn("reached", F.coalesce("reached", F.lit(step)))
    return written(found, "phrases-active")


# --- scores -----------------------------------------------------------------------------------------------


def _big(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def _spelled(mined: DataFrame, words: DataFrame, longest: int) -> list[DataFrame]:
    """The words and the mined phrases by length: phrase, root, a, text, last word, counts of their proper beginnings
    and ends by length (``heads``, ``tails``), and both subphrases with whether they occur as often as the phrase."""
    none = F.array().cast("array<long>")
    out = [words.select("phrase", "root", F.col("n").alias("a"), F.col("word").alias("text"), F.col("word").alias("last"),
                        none.alias("heads"), none.alias("tails"))]
    for k in range(2, longest + 1):
        a, b = out[-1].alias("l"), out[-1].alias("r")
        here = mined.where(F.col("k") == k).alias("m")
        level = here.join(a, F.col("m.left") == F.col("l.phrase")).join(b, F.col("m.right") == F.col("r.phrase")).select(
            F.col("m.phrase").alias("phrase"), F.col("l.root").alias("root"), F.col("m.a").alias("a"),
            F.concat(F.col("l.text"), F.lit(" "), F.col("r.last")).alias("text"), F.col("r.last").alias("last"),
            F.concat("l.heads", F.array("l.a")).alias("heads"), F.concat("r.tails", F.array("r.a")).alias("tails"),
            F.array_compact(F.array(F.when(F.col("l.a") == F.col("m.a"), F.col("m.left")),
                                    F.when(F.col("r.a") == F.col("m.a"), F.col("m.right")))).alias("covers"))
        out.append(written(level, "phrases-spelled"))
    return out


def _frequent_words(met: DataFrame, least: int) -> DataFrame:
    """The words that occur ``least`` times, with language, number and spelling, of rows of ``Vocabulary``. Written. Only
    hashes and numbers of all words are shuffled, spellings of those that a bitmap lets through."""
    often = written(met.groupBy("phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "phrase-words")
    some = met.where(maybe_member(membership(often, "phrase", BITS), F.col("phrase")))
    spelt = some.groupBy("phrase").agg(F.first("root").alias("root"), F.first("word").alias("word"))
    with narrow_batches(met.sparkSession):
        return written(often.join(spelt, "phrase"), "phrase-words")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP,
                 shards: int = SHARDS) -> DataFrame:
    """The phrases of each language of ``docs`` (text, lang; others are ignored) whose words keep together most.

    Texts, A-Z in small letters, are split at ``.,;:!?`` and line ends into pieces, and those at spaces and tabs into
    words. Phrases are of 2 to ``longest`` words inside a piece that occur ``least`` times. A cut gives l and r, the
    counts of both parts, and the score floor(1000 a n / (l r)), n being the words of the language; the cut with the
    least score counts, the first of these if several do. A phrase inside a longer one that occurs as often is left
    out. Of each language the ``top`` by score, a, then phrase (byte order) are returned: lang, rank, phrase, a, l, r, n,
    score. A null lang is ``und``; a null or empty text has no word; repeated rows count each; an empty table gives
    an empty result. Counts are exact; phrases are told apart by a 64-bit hash."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    rows = docs.select(F.xxhash64(F.lit("root"), lang).alias("root"), lang.alias("lang"),
                       F.coalesce("text", F.lit("")).alias("text"))
    met = written(rows.select("root", "text").mapInArrow(_count_words, MET), "phrase-met")
    words = _frequent_words(met, least)
    totals = met.groupBy("root").agg(F.sum("n").alias("n"))
    few = words.select("phrase").limit(BROADCAST_PHRASES + 1).toArrow().column("phrase").to_numpy().view(np.uint64)
    vocabulary = np.sort(few) if len(few) <= BROADCAST_PHRASES else None
    frequent = docs.sparkSession.sparkContext.broadcast(
        member_bits(words, "phrase", BITS) if vocabulary is None else vocabulary)
    dealt = rows.select((F.monotonically_increasing_id() % shards).cast("int").alias("shard"), "root", "text")
    tokens = written(dealt.mapInArrow(_tokenise(frequent, vocabulary is not None), "shard int, tokens binary"),
                     "phrase-tokens", by="shard")
    mined = mine([tokens.where(F.col("shard") == i).select("tokens") for i in range(shards)], words, vocabulary, least, longest)
    levels = _spelled(mined, words, longest)
    names = ["phrase", "root", "a", "text", "heads", "tails"]
    phrases, covered = levels[1].select(*names), []
    for level in levels[2:]:
        phrases = phrases.union(level.select(*names))
        covered.append(level.select(F.explode("covers").alias("phrase")))
    if covered:
        gone = covered[0]
        for x in covered[1:]:
            gone = gone.union(x)
        phrases = phrases.join(gone.distinct(), "phrase", "left_anti")
    totals = totals.join(rows.groupBy("root").agg(F.first("lang").alias("lang")), "root")
    totals = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    both = phrases.withColumn("salt", F.pmod("phrase", F.lit(SALTS)).cast("int")).join(totals, ["root", "salt"])
    whole = F.size("heads") + 1
    both = both.withColumn("over", _big(F.lit(1000)) * _big(F.col("a")) * _big(F.col("n")))

    def cut(j: Column) -> Column:
        left, right = F.get("heads", j - 1), F.get("tails", whole - j - 1)
        return F.struct(F.call_function("div", F.col("over"), _big(left) * _big(right)).alias("score"),
                        j.alias("at"), left.alias("l"), right.alias("r"))

    scored = both.withColumn("cut", F.array_min(F.transform(F.sequence(F.lit(1), whole - 1), cut))).select(
        "lang", "salt", F.col("text").alias("phrase"), "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
        "n", F.col("cut.score").alias("score"))
    # a language may have nearly all phrases: first the best of each salt, then of those
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    some = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    best = some.where(F.col("rank") <= top).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return best.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
