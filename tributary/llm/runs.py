"""Periodic runs of words, by branching tandem repeats in an enhanced suffix array.

A run is a stretch of words that repeats with a period, three times or more, and can't be
made longer. The square that ends where a run ends is *branching*: its two halves
start with the same word sequence, the period long, and go on differently. So both starts
lie in one LCP interval of the suffix array whose depth is the period, in different
children of it. For every interval, the suffixes i of all children but the largest
are taken, and the inverse suffix array tells whether i + depth or i - depth lies in the
interval too; the smaller children of all intervals together have n log n suffixes at most.
A branching square is then rotated to the left, word by word, as long as it stays a square,
which gives the run that all these squares belong to. No tree is built: intervals
are ranges given by the nearest smaller LCP values on both sides.

Texts of a batch share one suffix array, with words told apart by text. Words that can't
lie in a run stay out of it: every nine words inside a run of 24 words and three periods
occur in it again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm import words as W

LEAST_LENGTH, LEAST_PERIODS = 24, 3
#: Texts of a batch are taken together up to so many words.
STRETCH_WORDS = 1 << 20
#: Suffixes of smaller children that are looked at together.
PIECE = 1 << 22

_I64 = pa.int64()


# --- enhanced suffix array ----------------------------------------------------------------------------------


def _groups(first: np.ndarray) -> np.ndarray:
    """Of sorted rows, the place of the first of each group, given where groups begin."""
    return np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array, its inverse, and the LCP of each suffix with the one before it, of symbols from 0 on.

    Prefix doubling: in each round only suffixes that share their rank with others are sorted again. The
    ranks of the rounds give the LCPs, from the longest step to the shortest."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    new = np.ones(n, bool)
    new[1:] = text[order[1:]] != text[order[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = _groups(new)
    rounds, width = [], 1
    while True:
        padded = np.append(rank, -1).astype(np.int32)
        rounds.append(padded)
        tied = np.bincount(rank, minlength=n)[rank[order]] > 1
        places = np.flatnonzero(tied)
        if not len(places):
            break
        some = order[places]
        second = np.where(some + width < n, padded[np.minimum(some + width, n)], -1)
        # groups keep their places; inside a group the second halves decide
        by = np.lexsort((second, rank[some]))
        some, second = some[by], second[by]
        order[places] = some
        group = rank[some]
        new = np.ones(len(some), bool)
        new[1:] = (group[1:] != group[:-1]) | (second[1:] != second[:-1])
        rank = rank.copy()
        rank[some] = places[_groups(new)] if len(some) else places
        width *= 2
    lcp = np.zeros(n, np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for k in range(len(rounds) - 2, -1, -1):
        # equal ranks of round k: the next 2**k symbols are equal
        same = (rounds[k][np.minimum(a, n)] == rounds[k][np.minimum(b, n)]) & (a < n) & (b < n)
        step = np.where(same, 1 << k, 0)
        lcp[1:] += step
        a, b = a + step, b + step
    return order, rank, lcp


def nearest_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the nearest one to the left with a smaller value; -1 if there is none. Places jump
    along what the others have found so far, so that a few rounds do."""
    at = np.arange(-1, len(values) - 1)
    open_ = np.arange(len(values))
    while len(open_):
        open_ = open_[(at[open_] >= 0) & (values[np.maximum(at[open_], 0)] >= values[open_])]
        at[open_] = at[at[open_]]
    return at


def branching_squares(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and half length of every branching square of ``text`` (start ascending by end, then half length)."""
    order, rank, lcp = suffix_array(text)
    n = len(text)
    some = np.flatnonzero(lcp > 0)
    if not len(some):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    left = nearest_smaller(lcp)
    right = n - 1 - nearest_smaller(lcp[::-1])[::-1]  # the nearest smaller to the right; n if there is none
    # places with one LCP and one smaller neighbour bound the children of one interval
    some = some[np.lexsort((some, lcp[some], left[some]))]
    depth, low, high = lcp[some], left[some], right[some]
    fresh = np.ones(len(some), bool)
    fresh[1:] = (low[1:] != low[:-1]) | (depth[1:] != depth[:-1])
    interval = np.cumsum(fresh) - 1
    begin = np.flatnonzero(fresh)
    # children: [low, first bound), [bound, next bound) ..., [last bound, high)
    child_low = np.concatenate((low[begin], some))
    child_of = np.concatenate((interval[begin], interval))
    by = np.lexsort((child_low, child_of))
    child_low, child_of = child_low[by], child_of[by]
    child_high = np.append(child_low[1:], 0)
    last = np.append(child_of[1:] != child_of[:-1], True)
    child_high[last] = high[begin][child_of[last]]
    size = child_high - child_low
    # all but the largest child of each interval (the first of them, if several are)
    by = np.lexsort((child_low, -size, child_of))
    largest = by[np.append(True, child_of[by[1:]] != child_of[by[:-1]])]
    small = np.ones(len(size), bool)
    small[largest] = False
    small = np.flatnonzero(small)
    starts, halves = [], []
    total = np.cumsum(size[small])
    lo = 0
    while lo < len(small):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + PIECE)))
        child = small[lo:hi]
        count = size[child]
        child = np.repeat(child, count)
        place = child_low[child] + np.arange(len(child)) - np.repeat(np.cumsum(count) - count, count)
        at, of = order[place], child_of[child]
        length = depth[begin][of]
        for shift in (length, -length):
            other = at + shift
            inside = np.flatnonzero((other >= 0) & (other < n))
            r = rank[other[inside]]
            c, o = child[inside], of[inside]
            hit = inside[(r >= low[begin][o]) & (r < high[begin][o]) & ((r < child_low[c]) | (r >= child_high[c]))]
            starts.append(np.minimum(at[hit], other[hit]))
            halves.append(length[hit])
        lo = hi
    start, half = np.concatenate(starts), np.concatenate(halves)
    by = np.lexsort((half, start + 2 * half))
    start, half = start[by], half[by]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (start[1:] != start[:-1]) | (half[1:] != half[:-1])
    return start[fresh], half[fresh]


def _equal_to_the_left(text: np.ndarray, start: int, period: int) -> int:
    """How many words left of ``start`` equal the word a period later, one after the other."""
    done, step = 0, 64
    while True:
        low = max(0, start - done - step)
        high = start - done
        differ = np.flatnonzero(text[low:high] != text[low + period:high + period])
        if len(differ):
            return done + high - 1 - low - int(differ[-1])
        done += high - low
        if low == 0:
            return done
        step *= 2


def find(text: np.ndarray, least_length: int, least_periods: int) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence of symbols from 0 on, by start, then period."""
    start, half = branching_squares(text)
    # rotated far enough to the left, a square grows to the least run; others don't matter
    need = np.maximum(least_length - 2 * half, (least_periods - 2) * half)
    fits = start >= need
    # a look at the farthest word it needs, and at those next to it, spares most the walk
    for share in (0, 1, 2, 4):
        back = np.where(fits, np.maximum(need >> share, 1), 1)
        probe = np.where(fits & (need > 0), start - back, 0)
        fits &= (need <= 0) | (text[probe] == text[probe + half])
    runs: set[tuple[int, int, int]] = set()
    end_now, known = -1, []
    for s, q in zip(start[fits].tolist(), half[fits].tolist()):
        end = s + 2 * q
        if end != end_now:
            end_now, known = end, []
        # a square that repeats a shorter period of a run with the same end belongs to that run
        if any(q % p == 0 and s >= first for p, first in known):
            continue
        first = s - _equal_to_the_left(text, s, q)
        known.append((q, first))
        if end - first >= max(least_length, least_periods * q):
            runs.add((first, end - first, q))
    return sorted(runs, key=lambda r: (r[0], r[2]))


# --- documents --------------------------------------------------------------------------------------------


def periodic_runs(words: W.Words, least_length: int = LEAST_LENGTH,
                  least_periods: int = LEAST_PERIODS) -> dict[int, list[tuple[int, int, int]]]:
    """Runs of each row that has some, as (start, length, period) in words of the row."""
    h, row = words.hash, words.row
    # the run's own grams recur in it: of a run of length m and period q at least all of up to m - 2q + 1 words
    # twice, so with these thresholds all of so many words
    gram = _recurring_gram(least_length, least_periods)
    n = len(h) - gram + 1
    if n <= 0:
        return {}
    mixed = np.zeros(n, np.uint64)
    for k in range(gram):
        mixed = W.mix(mixed + h[k:k + n])
    mixed = W.mix(mixed + row[:n].astype(np.uint64))
    inside = row[:n] == row[gram - 1:]
    _, which, times = np.unique(mixed, return_inverse=True, return_counts=True)
    again = inside & (times[which] > 1)
    # stretches of positions of one row whose gram recurs, long enough for a run
    other_row = row[1:n] != row[:n - 1]
    begin = np.flatnonzero(again & np.append(True, ~again[:-1] | other_row))
    end = np.flatnonzero(again & np.append(~again[1:] | other_row, True)) + gram
    long = end - begin >= least_length
    begin, end = begin[long], end[long]
    first = words.per_row()
    out: dict[int, list[tuple[int, int, int]]] = {}
    if not len(begin):
        return out
    lo = 0
    total = np.cumsum(end - begin)
    while lo < len(begin):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + STRETCH_WORDS)))
        b, e = begin[lo:hi], end[lo:hi]
        length = e - b
        origin = np.repeat(b - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
        stretch = np.repeat(np.arange(len(b)), length)
        # words are told apart by stretch, so that nothing matches from one to another
        by = np.lexsort((h[origin], stretch))
        new = np.ones(len(by), bool)
        new[1:] = (h[origin][by[1:]] != h[origin][by[:-1]]) | (stretch[by[1:]] != stretch[by[:-1]])
        symbol = np.empty(len(by), np.int64)
        symbol[by] = np.cumsum(new) - 1
        for s, m, q in find(symbol, least_length, least_periods):
            r = int(row[origin[s]])
            out.setdefault(r, []).append((int(origin[s] - first[r]), m, q))
        lo = hi
    for r in out:
        out[r].sort(key=lambda x: (x[0], x[2]))
    return out


def _recurring_gram(least_length: int, least_periods: int) -> int:
    """The longest gram that occurs twice in a run wherever it starts, whatever the period."""
    return max(1, min(max(least_length, least_periods * q) - 2 * q + 1 for q in range(1, least_length + 1)))


RUN = pa.struct([("start", _I64), ("length", _I64), ("period", _I64)])
OUT = ("doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
       "longest struct<start:long,length:long,period:long>, collapsed string")


def _record(run: tuple[int, int, int]) -> dict:
    return dict(zip(("start", "length", "period"), run))


def _find(least_length: int, least_periods: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            found = W.split(*W.utf8(column))
            runs = periodic_runs(found, least_length, least_periods)
            counts, lists, longest, collapsed = np.diff(found.per_row()), [], [], []
            for r, text in enumerate(column.to_pylist()):
                own = runs.get(r, [])
                tokens = text.encode().split()
                if own:
                    gone = np.zeros(len(tokens) + 1, np.int64)
                    s, m, q = np.array(own).T
                    np.add.at(gone, s + q, 1)
                    np.add.at(gone, s + m, -1)
                    tokens = [tokens[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]
                lists.append([_record(x) for x in own])
                # as whole numbers: lengths over periods differ by 2**-62 at least
                longest.append(_record(min(own, key=lambda x: (-((x[1] << 64) // x[2]), x[0], x[2]))) if own else None)
                collapsed.append(b" ".join(tokens).decode())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(counts, _I64), pa.array(lists, pa.list_(RUN)), pa.array(longest, RUN),
                pa.array(collapsed, pa.string())], names=["doc_id", "n_words", "runs", "longest", "collapsed"])
    return run


def find_runs(docs: DataFrame, least_length: int = LEAST_LENGTH, least_periods: int = LEAST_PERIODS) -> DataFrame:
    """Periodic runs of words (``[^\\x20\\x09-\\x0D]+``) in every text of ``docs`` (doc_id, text; others are ignored).

    Returns doc_id, n_words, runs (start and length in words, smallest period; at least ``least_length`` words and
    ``least_periods`` (two or more) periods; by start, then period), longest (the run with the most periods, ties by
    start, then period; null without a run) and collapsed (the text without what each run holds after its first
    period, words joined by one space). Words are compared by a 64-bit hash. A null or empty text has no word and no
    run; a null doc_id stays null; repeated rows give repeated rows; an empty table an empty result. Nothing is
    shuffled; memory follows the longest text."""
    if least_periods < 2:
        raise ValueError("a run has two periods at least")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_find(least_length, least_periods), OUT)


# --- the query's edit ---------------------------------------------------------------------------------------


def with_periods(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with a periodic end in about every tenth text: with h the crc32 of the doc_id as text
    and g = h div 10, in texts of n words with h mod 10 = 0 each word i >= a becomes word a + (i - a) mod p, where
    a = g mod n and p = 1 + (n - a) div (3 + g mod 8). Their words are joined by one space; other texts, and texts
    without a doc_id, stay as they are."""
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))
    edited = F.transform(F.array(words), lambda w: F.transform(
        F.array(F.struct((F.floor(h / 10) % F.size(w)).alias("a"), F.size(w).alias("n"))),
        lambda x: F.array_join(F.transform(w, lambda word, i: F.when(i < x["a"], word).otherwise(
            F.get(w, (x["a"] + (i - x["a"]) % (1 + F.floor((x["n"] - x["a"]) / (3 + F.floor(h / 10) % 8)))).cast("int")))),
            " "))[0])[0]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.when((h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]"), edited)
                       .otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """Counts, the longest run and digests of a result of ``find_runs``."""
    line = F.concat_ws("", F.transform("runs", lambda r: F.concat_ws(
        "", r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"),
        F.lit("\n"))))
    top = F.col("longest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), top["start"].alias("start"), top["length"].alias("length"),
        top["period"].alias("period"),
        F.floor(top["length"] * 1000 / top["period"]).cast("long").alias("exponent_milli"),
        F.sha2(line.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
