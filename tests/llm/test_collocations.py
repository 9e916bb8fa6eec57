"""op12: phrase counts and scores against counting every phrase; the SQL oracle compares the query."""

import os
import random
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(__file__))

import corpus  # noqa: E402
import pyarrow as pa  # noqa: E402
import pytest  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from tributary.llm import collocations as C  # noqa: E402
from tributary.llm.common import prepare  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def brute(rows, least, longest, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    often = {(g, p): a for (g, p), a in f.items() if a >= least}
    out = []
    for lang in n:
        scored = []
        for (g, p), a in often.items():
            if g != lang or len(p) < 2:
                continue
            if any(h == g and len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for (h, q), b in often.items()):
                continue
            cuts = [(1000 * a * n[lang] // (f[g, p[:j]] * f[g, p[j:]]), j) for j in range(1, len(p))]
            score, j = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), f[g, p[:j]], f[g, p[j:]]))
        for i, (s, a, text, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, i, text.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def made(seed, docs):
    """Prose of few words, with set phrases in it, so that phrases of all lengths are often."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(25)] + ["É", "New", "ÉCOLE", "a-b", "ß"]
    phrases = ["New York City Hall Park", "as soon as", "É w1", "x y x y x", "of the", "one two three four five six seven"]
    rows = []
    for _ in range(docs):
        parts = []
        for _ in range(rng.randint(0, 30)):
            parts.append(rng.choice(phrases) if rng.random() < .4 else rng.choice(words))
            if rng.random() < .15:
                parts.append(rng.choice([",", ".", "\n", " ; ", "\t", "\x0b", "?!"]))
        rows.append((" ".join(parts), rng.choice(["en", "en", "en", "fr", None, "und"])))
    return rows


@pytest.mark.parametrize("least,longest,top,shards", [(20, 5, 2000, 3), (8, 3, 4, 1), (5, 4, 10, 2), (15, 2, 50, 5)])
def test_against_counting_everything(spark, least, longest, top, shards):
    prepare(spark)
    rows = made(least, 300)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    got = C.collocations(df, least, longest, top, shards)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(rows, least, longest, top)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 5


@pytest.mark.parametrize("few", [0, 25, 60])
def test_counts_survive_a_saturated_bitmap_and_small_buffers(spark, monkeypatch, few):
    """The way of large tables, from the start or from some scan on, with a bitmap that lets everything through: phrases
    are counted before they are active, and those scans go again."""
    prepare(spark)
    rows = made(3, 200)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    real = C.member_bits

    def full(hashes, column, bits):
        got = real(hashes, column, bits)
        return got | 255 if got.any() else got

    monkeypatch.setattr(C, "member_bits", full)
    monkeypatch.setattr(C, "BROADCAST_PHRASES", few)
    assert sorted(map(tuple, C.collocations(df, 12, 4, 100, 3).collect())) == brute(rows, 12, 4, 100)


def test_sums_in_a_task():
    import numpy as np

    counts = C.Counts()
    u = lambda *x: np.array(x, np.uint64)
    counts.add(2, u(5, 7, 5), u(1, 2, 1), u(3, 4, 3))
    counts.add(3, u(9), u(5), u(7))
    counts.add(2, u(7), u(2), u(4))
    assert counts.summed().T.tolist() == [[2, 5, 1, 3, 2], [2, 7, 2, 4, 2], [3, 9, 5, 7, 1]]
    counts.add(2, u(5), u(1), u(3))
    assert counts.summed()[4].tolist() == [3, 2, 1]
    assert C.Counts().summed().shape == (5, 0)
    tally = C.Tally()
    assert tally.rows().num_rows == 0
    tally.add(np.array([5, 3, 5]))
    tally.merge()
    tally.add(np.array([4, 3]))
    assert tally.rows().to_pydict() == {"key": [3, 4, 5], "n": [2, 1, 2]}


def test_numbers():
    import numpy as np

    numbers = C.Numbers(np.array([10, 20, 30], np.uint64))
    key = lambda k, since, left, right: (k << C.SCAN_BITS | since) << 2 * C.NUMBER_BITS | left << C.NUMBER_BITS | right
    numbers.add(np.array([key(2, 0, 3, 1), key(2, 0, 1, 2)]), 1)
    numbers.add(np.array([key(3, 1, 4, 5)]), 2)
    pair = [a << C.NUMBER_BITS | b for a, b in ((3, 1), (1, 2), (4, 5), (1, 3))]
    assert numbers.look_up(np.array(pair)).tolist() == [4, 5, 6, 0]
    assert numbers.reached.tolist() == [0, 0, 0, 0, 1, 1, 2] and numbers.k.tolist() == [1, 1, 1, 1, 2, 2, 3]
    assert [int(x) for x in C.taken_apart(np.array(key(5, 14, 1 << 19, 7)))] == [5, 14, 1 << 19, 7]


def test_pieces():
    text = "A b,C\tÉd.\n..x-y  ;z"
    found, begins = C.pieces(pa.array([text, None, "q"]))
    got = [found.data[a:b].tobytes().decode() for a, b in zip(found.start, found.end)]
    assert got == ["a", "b", "c", "Éd", "x-y", "z", "q"]
    assert begins.tolist() == [True, False, True, False, True, True, True]


def test_odd_rows(spark):
    prepare(spark)
    rows = corpus.odd_rows()
    got = C.collocations(corpus.frame(spark), 30, 3, 50, 2)
    assert sorted(map(tuple, got.collect())) == brute([(r[1], r[2]) for r in rows], 30, 3, 50)
    empty = C.collocations(corpus.frame(spark).where("false"))
    assert empty.count() == 0 and empty.columns == got.columns
    none = C.collocations(corpus.frame(spark).withColumn("text", F.lit(None).cast("string")))
    assert none.count() == 0


def test_large_products_are_exact(spark):
    big = spark.createDataFrame([(9_000_000_000_000_000, 9_100_000_000_000_000, 3)], "a long, n long, l long")
    over = C._big(F.lit(1000)) * C._big(F.col("a")) * C._big(F.col("n"))
    got = big.select(F.call_function("div", over, C._big(F.col("a")) * C._big(F.col("l"))).alias("q")).first().q
    assert got == 1000 * 9_100_000_000_000_000 // 3
