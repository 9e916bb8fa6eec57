"""op9: targets, quotas and what is taken against brute force."""

import heapq
import os
import re
import sys
from collections import Counter, defaultdict

sys.path.insert(0, os.path.dirname(__file__))

import corpus  # noqa: E402
import pytest  # noqa: E402
from tributary.llm import mixing  # noqa: E402


def targets(sizes, weights=(5, 2, 1), share=1.5, repeats=2):
    """Shares by weight, capped and shared again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, open_, rest = {}, set(names), share * sum(sizes.values())
    while open_:
        level = rest / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * level > repeats * sizes[s]]
        if not full:
            out |= {s: weight[s] * level for s in open_}
            break
        for s in full:
            out[s] = repeats * sizes[s]
            rest -= out[s]
            open_.remove(s)
    return out, names


def quotas(target, names, sizes, block, repeats=2):
    """Highest quotients, one block after the other."""
    most = {s: repeats * sizes[s] // block for s in names}
    n = min(int(sum(target.values()) / block + 0.5), sum(most.values()))
    got = Counter()
    heap = [(-target[s], i, s) for i, s in enumerate(names) if most[s]]
    heapq.heapify(heap)
    for _ in range(n):
        _, i, s = heapq.heappop(heap)
        got[s] += 1
        if got[s] < most[s]:
            heapq.heappush(heap, (-target[s] / (2 * got[s] + 1), i, s))
    return got


def check(df, rows, block=mixing.BLOCK_WORDS, shards=mixing.SHARDS, shard_words=mixing.SHARD_WORDS):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    target, names = targets(sizes)
    quota = quotas(target, names, sizes, block)
    got = df.collect()
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source], rel=1e-9, abs=1e-9)
        assert r.quota == quota[r.source] * block // (shards * shard_words)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in names:
        assert taken[s] == quota[s] * block
        assert abs(taken[s] - target[s]) <= (1 if block == 1 else 3 * block)
    return got


def test_whole_table(spark):
    docs = corpus.read(spark, "documents")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    first = check(mixing.mix(docs), rows)
    assert sorted(first) == sorted(mixing.mix(docs.repartition(9)).collect())


def test_odd_documents(spark):
    rows = [(r[0], r[1], r[3]) for r in corpus.odd_rows()]
    got = check(mixing.mix(corpus.frame(spark), block=2, shards=2, shard_words=3), rows, 2, 2, 3)
    assert all(r.taken == 0 for r in got if r.size == 0)


def test_empty_table_and_no_words(spark):
    assert mixing.mix(corpus.frame(spark, [])).collect() == []
    rows = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in mixing.mix(rows).collect()] == [(0, 0.0, 0)] * 2


def test_many_uneven_sources(spark):
    rows = [(i, "w " * (1 + (i * i) % 97), f"s{(i * 31) % 17 if i % 3 else 0}") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check(mixing.mix(df, block=3, shards=4), rows, 3, 4)
    check(mixing.mix(df), rows)


def test_small_sources_get_their_share(spark):
    """Sixty sources of fifty words beside one of two thousand, and some of a word or two."""
    rows = [(i, "w " * 50, f"s{i}") for i in range(60)] + [(100 + i, "w " * 200, "large") for i in range(10)]
    rows += [(200, "w", "tiny"), (201, "a b", "tiny2")]
    got = check(mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")), rows)
    assert sum(r.taken for r in got) == int(1.5 * 5003 + 0.5) and all(r.taken > 0 for r in got if r.source != "large")
    kept = mixing.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert kept.select("source").distinct().count() == 63


def test_mixed_rows_keep_their_columns(spark):
    docs = corpus.frame(spark)
    out = mixing.mixed(docs, block=2)
    assert out.columns == docs.columns
    plan = mixing.mix(docs, block=2).collect()
    want = Counter()
    for r in plan:
        if r.size:
            want[(r.doc_id, r.source)] += int(r.taken / r.size + 0.5)
    got = Counter((r.doc_id, r.source) for r in out.collect())
    assert got == Counter({k: v for k, v in want.items() if v})


@pytest.mark.parametrize("aims", [
    [(1, 0.01)] * 3000 + [(1000, 5.0), (1000, 0.0)],  # the sum of many small targets goes to the quotients of a large one
    [(1, 0.49)] * 90 + [(4000, 1000.5), (3, 6.0), (0, 0.0)],
    [(50, 10.49)] * 70 + [(50, 10.49 * 3)] * 9 + [(9, 18.0)] * 5,  # equal quotients
    [(10_000, 7_000.2), (10_000, 333.3), (2, 4.0)],
])
def test_highest_quotients_win_whatever_the_targets(spark, aims):
    names = [f"s{i:03}" for i in range(len(aims))]
    rows = [(s, size, i + 1, 1.0, float(t)) for i, (s, (size, t)) in enumerate(zip(names, aims))]
    df = spark.createDataFrame(rows, "source string, source_size long, rank int, weight double, target double")
    target, sizes = {s: t for s, (_, t) in zip(names, aims)}, {s: n for s, (n, _) in zip(names, aims)}
    for block in (1, 3):
        want = quotas(target, [s for s in names if target[s]], sizes, block)
        assert {r.source: r.quota for r in mixing.quotas(df, block, 2).collect()} == {s: want[s] for s in names}


def test_prices_need_no_small_range(spark):
    """Quotients by the ten million: those listed stay a few a source, and what wins is still exact."""
    rows = [("a", 10**9, 1, 1.0, 9e8 + 0.3), ("b", 10**8, 2, 1.0, 2e8), ("c", 3, 3, 1.0, 1.7)]
    df = spark.createDataFrame(rows, "source string, source_size long, rank int, weight double, target double")
    got = {r.source: r.quota for r in mixing.quotas(df, 1, 2).collect()}
    assert got == {"a": 900_000_000, "b": 200_000_000, "c": 2}
    able = df.selectExpr("*", "2 * source_size AS most")
    low, high = mixing.prices(able, 1_100_000_002)
    below, above = (able.select(mixing._wins(p).alias("n")).groupBy().sum("n").first()[0] for p in (low, high))
    assert above <= 1_100_000_002 <= below and below - above <= 3 + mixing.LISTED
