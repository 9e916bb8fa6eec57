"""op10: removed words against all runs of all documents; the index against counting."""

import hashlib
import os
import random
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(__file__))

import corpus  # noqa: E402
import numpy as np  # noqa: E402
from hypothesis import given, settings, strategies as st  # noqa: E402
from tributary.llm import substrings as sub  # noqa: E402


def brute(rows, n=35):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    runs = Counter(tuple(w[k:k + n]) for w in words for k in range(len(w) - n + 1))
    out = Counter()
    for (doc_id, _), w in zip(rows, words):
        gone = bytearray(len(w))
        for k in range(len(w) - n + 1):
            if runs[tuple(w[k:k + n])] > 1:
                gone[k:k + n] = b"\1" * n
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[(doc_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    return out


def check(df, rows):
    got = df.collect()
    assert Counter(tuple(r[:4]) for r in got) == brute(rows)
    assert all(r.n_removed == sum(x["end"] - x["start"] for x in r.removed) for r in got)


def repeated_texts():
    rng = random.Random(4)
    passage, base = corpus.prose(20, 60), corpus.prose(21, 120).split()
    texts = [f"{corpus.prose(100 + i, 40)} {passage} {corpus.prose(200 + i, 30)}" for i in range(60)]
    for i in range(60):  # near copies
        w = base[:]
        w[rng.randrange(len(w))] = f"new{i}"
        texts.append(" ".join(w))
    texts += [corpus.prose(22, 90)] * 25 + ["word " * 70, "a b " * 40, " ".join(passage.split()[:35]), " ".join(passage.split()[:34])]
    texts += [corpus.prose(23, 50) + "\n\t" + corpus.prose(23, 50), corpus.prose(24, 35), corpus.prose(24, 36)]
    return list(enumerate(texts))


def test_whole_table(spark):
    docs = corpus.read(spark, "documents", "/root/testdata/sf0.01")
    check(sub.dedup_substrings(docs), [(r.doc_id, r.text) for r in docs.collect()])


def test_passages_copies_and_periods(spark):
    rows = repeated_texts()
    check(sub.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)), rows)


def test_minimizers_with_very_many_segments(spark, monkeypatch):
    monkeypatch.setattr(sub, "SPLIT_SEGMENTS", 5)
    monkeypatch.setattr(sub, "INDEX_WORDS", 100)
    rows = repeated_texts()
    check(sub.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)), rows)


def test_odd_documents_and_empty_table(spark):
    check(sub.dedup_substrings(corpus.frame(spark)), [(r[0], r[1]) for r in corpus.odd_rows()])
    assert sub.dedup_substrings(corpus.frame(spark, [])).collect() == []


def test_marks_of_repeated_rows_are_kept_once(spark, monkeypatch):
    kept, written = {}, sub.written
    monkeypatch.setattr(sub, "written", lambda df, name: kept.setdefault(name, written(df, name)))
    rows = [(1, corpus.prose(30, 90))] * 40 + [(None, corpus.prose(31, 80))] * 20
    check(sub.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)), rows)
    marks = [[tuple(m) for m in r.marks] for r in kept["marks"].collect()]
    assert len(marks) == 2 and all(len(m) == len(set(m)) for m in marks)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=120), st.integers(1, 20))
def test_matching_statistics(symbols, most):
    text = np.array([0, *symbols, 0])
    index = sub.FMIndex(text, 5)
    ends = np.arange(1, len(text) + 1)
    got = index.matching_statistics(text, ends, most)
    flat = "".join(map(str, text.tolist()))

    def times(s):
        return sum(flat.startswith(s, i) for i in range(len(flat)))

    for e, n in zip(ends, got):
        want = 0
        while want < min(most, e) and "0" not in flat[e - want - 1:e] and times(flat[e - want - 1:e]) >= 2:
            want += 1
        assert n == want


def test_wavelet_ranks():
    rng = np.random.default_rng(1)
    s = rng.integers(0, 37, 500)
    w = sub.WaveletMatrix(s, 37)
    c, i = rng.integers(0, 37, 300), rng.integers(0, 501, 300)
    present = np.isin(c, s)
    got = w.down(c, i) - w.first[c]
    assert (got[present] == [(s[:k] == x).sum() for x, k in zip(c[present], i[present])]).all()
