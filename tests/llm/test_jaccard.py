"""op2: classes and links against a comparison of all pairs."""

import itertools
import os
import random
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(__file__))

import corpus  # noqa: E402
import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
from tributary.llm import chosen_path as cp  # noqa: E402
from tributary.llm.components import components  # noqa: E402


def small(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" or "À" <= c <= "Þ" and c != "×" else c for c in text)


def shingles(text):
    words = re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", small(text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k:k + 5]) for k in range(len(words) - 4))


def brute(rows, similarity=0.8):
    """Per row: links, and the number of its class."""
    sets = [shingles(t) for _, t in rows]
    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, set()).add(i)
    links, parent = Counter(), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        near = Counter(j for x in s for j in where[x] if j < i)
        for j, both in near.items():
            if both >= similarity * (len(s) + len(sets[j]) - both) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    return links, [root(i) for i in range(len(rows))]


def check(df, rows):
    links, group = brute(rows)
    got = df.collect()
    assert len(got) == len(rows)
    want = Counter((doc_id, small(text or ""), links[i]) for i, (doc_id, text) in enumerate(rows))
    texts = {}
    least = {}
    for i, (doc_id, text) in enumerate(rows):
        key = (doc_id is None, doc_id or 0)
        least[group[i]] = min(least.get(group[i], key), key)
    classes = Counter((rows[i][0], links[i], None if least[group[i]][0] else least[group[i]][1]) for i in range(len(rows)))
    assert Counter((r.doc_id, r.n_links, r.class_id) for r in got) == classes
    assert sum(want.values()) == len(got) and not texts


def near_copies(n, words=60, seed=3):
    """A text and copies with one changed word each: all are alike."""
    rng = random.Random(seed)
    base = corpus.prose(seed, words).split()
    out = []
    for i in range(n):
        w = base[:]
        w[rng.randrange(len(w))] = f"changed{i}"
        out.append(" ".join(w))
    return out


def test_whole_table(spark):
    docs = corpus.read(spark, "documents", "/root/testdata/sf0.01")
    check(cp.jaccard_classes(docs), [(r.doc_id, r.text) for r in docs.collect()])


def test_large_group_of_near_copies_and_of_copies(spark):
    texts = near_copies(260) + [corpus.prose(9, 80)] * 150 + [corpus.prose(i, 70) for i in range(20, 120)]
    # documents that share a long passage but aren't alike
    passage = corpus.prose(8, 40)
    texts += [f"{passage} {corpus.prose(1000 + i, 60)}" for i in range(120)]
    rows = list(enumerate(texts))
    check(cp.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)), rows)


def test_blocks_of_an_exact_comparison(spark, monkeypatch):
    monkeypatch.setattr(cp, "BLOCK_SETS", 16)
    monkeypatch.setattr(cp, "SMALL_NODE", 8)
    rows = list(enumerate(near_copies(70) + near_copies(20, 30, 4)))
    check(cp.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_odd_documents_and_empty_table(spark):
    got = cp.jaccard_classes(corpus.frame(spark)).collect()
    assert len(got) == len(corpus.odd_rows())
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert [r.n_links for r in by[5]] == [2, 2] and {r.class_id for r in by[5]} == {5}  # the third copy has id 6
    assert {r.class_id for r in by[6]} == {5, 6} and [r.class_id for r in by[7]] == [6]
    assert all(r.n_links == 0 and r.class_id == r.doc_id for i in (1, 2, 3, 4, 8) for r in by[i])
    assert cp.jaccard_classes(corpus.frame(spark, [])).collect() == []


def test_one_row_of_each_class_stays(spark):
    docs = corpus.frame(spark)
    kept = cp.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted(
        (r[0] is None, r[0] or 0, r[1] or "") for k, r in enumerate(corpus.odd_rows())
        if k not in (7, 8, 10))  # the second row of id 5, its copy under id 6, and ONE of id 7


def test_embedding_agrees_as_the_sets_do():
    rng = random.Random(1)
    a = [f"w{i}" for i in range(400)]
    b = a[:]
    for i in rng.sample(range(400), 12):
        b[i] = f"x{i}"
    text = pa.array([" ".join(a), " ".join(b), "one two", None])
    h, row = cp.shingle_sets(text)
    code = cp.tokens(h, row, 4)
    s, t = shingles(" ".join(a)), shingles(" ".join(b))
    true = len(s & t) / len(s | t)
    assert abs((code[0] == code[1]).mean() - true) < 0.12
    assert (np.bincount(row, minlength=4) == [len(s), len(t), 1, 0]).all() and not code[3].any()


def test_every_node_draws_a_place():
    node = np.arange(3000, dtype=np.uint64)
    embedded = np.random.default_rng(2).integers(0, 1 << 32, (3000, cp.PLACES)).astype(np.uint32)
    for draws in (1, cp.DRAW, cp.FIRST_DRAW, cp.PLACES):
        row, child = cp.children(node, embedded, draws, 8)
        times = np.bincount(row, minlength=3000)
        assert times.min() >= int(draws) and abs(times.mean() - draws) < 0.05 and (np.diff(row) >= 0).all()
        assert len(set(zip(row.tolist(), child.tolist()))) == len(row)


def test_pairs_all_of_whose_tokens_are_in_large_nodes(spark, monkeypatch):
    # every text is five of twelve passages and a few words of its own; only twins share five
    monkeypatch.setattr(cp, "SMALL_NODE", 24)
    rng, passages = random.Random(6), [corpus.prose(500 + i, 30) for i in range(12)]
    chosen = [c for c in itertools.combinations(range(12), 5)]
    rng.shuffle(chosen)
    texts = []
    for i, c in enumerate(chosen[:600]):
        for _ in range(2 if i < 200 else 1):
            texts.append(" ".join(passages[k] for k in c) + f" own{len(texts)}" + " and" * 8)
    rows = list(enumerate(texts))
    assert sum(brute(rows)[0].values()) >= 400
    check(cp.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)), rows)


def test_rows_of_large_nodes_are_joined_once_by_node(spark, monkeypatch):
    """Every row of a large node is made by one join by node a level, and their number follows that of the near copies."""
    monkeypatch.setattr(cp, "SMALL_NODE", 32)
    passes, written = [], cp.written

    def noted(df, name, *by):
        out = written(df, name, *by)
        text = df._jdf.queryExecution().analyzed().toString()
        passes.append((name, text.count("Join Inner, (node#"), out.count() if name == "path-step" else 0))
        return out

    monkeypatch.setattr(cp, "written", noted)
    made = []
    for n in (200, 400):
        rng, base = random.Random(3), corpus.prose(9, 120).split()
        rows = []
        for i in range(n):
            words = base[:]
            for k in rng.sample(range(len(words)), 4):
                words[k] = f"own{i}x{k}"
            rows.append((i, " ".join(words)))
        del passes[:]
        got = cp.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert len(got) == n
        levels = sum(name == "path-step" for name, _, _ in passes)
        assert levels and sum(joins for _, joins, _ in passes) == levels
        made.append(sum(rows for _, _, rows in passes))
    assert made[1] < 3 * made[0]


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 200 + i) for i in range(60)] + [
        (rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    linked = {x for a, b in links for x in (a, b) if a != b}
    assert got == {x: root(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
