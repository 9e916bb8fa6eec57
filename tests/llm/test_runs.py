"""op11: periodic runs against a comparison of all words a period apart."""

import hashlib
import os
import random
import re
import sys
import zlib
from fractions import Fraction

sys.path.insert(0, os.path.dirname(__file__))

import corpus  # noqa: E402
import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
import pytest  # noqa: E402
from tributary.llm import queries, runs  # noqa: E402
from tributary.llm import words as W  # noqa: E402


def brute(w, length=24, periods=3):
    out, seen = [], set()
    for q in range(1, len(w) // periods + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(length, periods * q) and (i, j + q) not in seen:
                seen.add((i, j + q))  # a longer period of the same stretch is not its smallest
                out.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def digest(doc_id, w):
    found = brute(w)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    top = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (doc_id, len(found), *(top or (None, None, None)), top and 1000 * top[1] // top[2],
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def edited(doc_id, w):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def periodic(rng):
    k, w = rng.choice([1, 2, 3, 5, 30]), []
    while len(w) < rng.randint(0, 250):
        if rng.random() < .5:
            w += [str(rng.randint(0, k)) for _ in range(rng.randint(1, 10))]
        else:
            unit = [str(rng.randint(0, k)) for _ in range(rng.randint(1, 12))] * rng.randint(2, 9)
            w += unit[:rng.randint(1, len(unit))]
            w *= rng.choice([1, 1, 1, 2, 3])
    return w


@pytest.mark.parametrize("length,periods", [(24, 3), (6, 2), (10, 4), (1, 2)])
def test_random_words(length, periods):
    rng, some = random.Random(length), 0
    for _ in range(25):
        texts = [periodic(rng) for _ in range(30)]
        got = runs.periodic_runs(W.split(*W.utf8(pa.array([" ".join(t) for t in texts]))), length, periods)
        for r, t in enumerate(texts):
            want = brute(t, length, periods)
            assert got.get(r, []) == want
            some += len(want)
    assert some > 100


def test_suffix_array_and_lcp():
    rng = random.Random(2)
    for n, k in ((1, 1), (2, 1), (50, 2), (200, 3), (300, 1), (400, 40)):
        text = np.array([rng.randint(0, k) for _ in range(n)])
        order, rank, lcp = runs.suffix_array(text)
        want = sorted(range(n), key=lambda i: text[i:].tolist())
        assert order.tolist() == want and rank[order].tolist() == list(range(n))
        for a, b, length in zip(want, want[1:], lcp[1:].tolist()):
            x, y = text[a:].tolist(), text[b:].tolist()
            assert length == next((i for i, (c, d) in enumerate(zip(x, y)) if c != d), min(len(x), len(y)))
        below = [max((j for j in range(i) if lcp[j] < lcp[i]), default=-1) for i in range(n)]
        assert runs.nearest_smaller(lcp).tolist() == below


def test_branching_squares():
    rng = random.Random(6)
    for k in (1, 2, 4):
        t = [rng.randint(0, k) for _ in range(60)] * 2 + [0] * 9
        want = sorted(((i, q) for i in range(len(t)) for q in range(1, len(t) // 2 + 1)
                       if t[i:i + q] == t[i + q:i + 2 * q] and len(t[i:i + 2 * q]) == 2 * q
                       and (i + 2 * q == len(t) or t[i + q] != t[i + 2 * q])), key=lambda s: (s[0] + 2 * s[1], s[1]))
        start, half = runs.branching_squares(np.array(t))
        assert list(zip(start.tolist(), half.tolist())) == want


def test_long_texts_of_one_kind():
    for words in (["w"] * 200_000, [str(i % 7) for i in range(200_000)], [str(i % 60_000) for i in range(200_000)]):
        q = len(set(words))
        got = runs.periodic_runs(W.split(*W.utf8(pa.array([" ".join(words)]))))
        assert got == {0: [(0, 200_000, q)]}


def test_odd_rows(spark):
    rows = corpus.odd_rows() + [(20, "x " * 23, None, None, None, *corpus.odd_rows()[0][5:]),
                                (21, "x " * 24, None, None, None, *corpus.odd_rows()[0][5:])]
    frame = corpus.frame(spark, rows)
    got = runs.find_runs(frame).collect()
    key = lambda r: (r[0] is None, r[0] or 0, str(r[1:]))
    want = sorted(((r[0], len(split(r[1])), brute(split(r[1])) if len(split(r[1])) < 1000 else []) for r in rows), key=key)
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs]) for r in got), key=key) == want
    assert {r.doc_id: r.collapsed for r in got}[21] == "x"
    assert runs.find_runs(frame.where("false")).count() == 0
    with pytest.raises(ValueError, match="periods"):
        runs.find_runs(frame, least_periods=1)


def test_edit(spark):
    rows = [(i, corpus.prose(i, i % 40)) for i in range(300)] + [(None, "a b c"), (3, None), (4, "")]
    got = runs.with_periods(corpus.docs(spark, {}).sparkSession.createDataFrame(rows, "doc_id long, text string")).collect()
    changed = 0
    for (doc_id, text), r in zip(rows, got):
        want = edited(doc_id, split(text))
        assert split(r.text) == want
        changed += want != split(text)
    assert changed > 10


def test_query_on_a_whole_table(spark):
    docs = corpus.read(spark, "documents").select("doc_id", "text").collect()
    want = [digest(r.doc_id, edited(r.doc_id, split(r.text))) for r in docs]
    got = queries.op11_periodic_runs(spark, corpus.SMALL)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert sum(r[1] > 0 for r in want) > 10
