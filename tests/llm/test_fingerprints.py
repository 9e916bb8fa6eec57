"""op1: fingerprints against direct sums over paragraphs."""

import hashlib
import sys
from collections import Counter
import os

sys.path.insert(0, os.path.dirname(__file__))

import corpus  # noqa: E402
from hypothesis import given, settings, strategies as st  # noqa: E402
from tributary.llm import fingerprints as fp  # noqa: E402
from tributary.llm.common import prepare  # noqa: E402


def brute(rows):
    """Rows in order of (id, nulls first, hash unknown): only for distinct ids."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = {}
    for i, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        new = text[:len(text) - half] + following[:half]
        a, b, c = (fp.vector(t.encode()) for t in (text, new, following))
        out[doc_id] = (len(text), hashlib.sha256(new.encode()).hexdigest(), fp.encode(a), fp.encode(b),
                       fp.likeness(a, b), fp.likeness(a, c))
    return out


def result(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def test_whole_table_against_brute_force(spark):
    docs = corpus.read(spark, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = fp.fingerprint_documents(docs.repartition(5), partitions=3).drop("x")
    assert result(got) == brute(rows)


def test_odd_documents(spark):
    prepare(spark)
    rows = fp.fingerprint_documents(corpus.frame(spark)).collect()
    assert len(rows) == len(corpus.odd_rows())
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    by_text = {}
    for r, text in [(r, t) for r in rows for t in [next(x[1] or "" for x in corpus.odd_rows() if x[0] == r.doc_id and len(x[1] or "") == r.n_chars)]]:
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
    assert len(set(by_text.values())) == len(by_text)


def test_an_id_that_many_rows_share(spark):
    """Null ids, and one id, on a third of all rows each: their rows span several ranges, and neighbours stay right."""
    from pyspark.sql import functions as F

    prepare(spark)
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text {i} {corpus.prose(i, 5)}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    keyed = df.withColumns({"key": F.coalesce("doc_id", F.lit(fp.LEAST)), "tie": F.xxhash64("text")})
    bounds = fp._bounds(keyed, 24)
    assert sum(k == 7 for k, _ in bounds) >= 6 and sum(k == fp.LEAST for k, _ in bounds) >= 6
    sizes = [r["count"] for r in keyed.groupBy(fp._range_of(bounds)("key", "tie")).count().collect()]
    assert sum(sizes) == 600 and max(sizes) <= 3 * 600 / 24
    order = [(r.doc_id, r.text) for r in keyed.orderBy("key", "tie", "text").collect()]
    want = Counter((d, len(t), hashlib.sha256(fp.edited(t, order[(i + 1) % 600][1]).encode()).hexdigest())
                   for i, (d, t) in enumerate(order))
    got = fp.fingerprint_documents(df, partitions=6).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want


def test_empty_table_and_single_document(spark):
    assert fp.fingerprint_documents(corpus.frame(spark, [])).collect() == []
    one = fp.fingerprint_documents(corpus.docs(spark, {3: "ab"})).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"aa").hexdigest() and one[0].near_next == 1.0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab \né", max_size=30), min_size=1, max_size=6), st.randoms())
def test_sum_is_homomorphic(paragraphs, rng):
    paragraphs = [p for x in paragraphs for p in x.split("\n")]
    whole = fp.vector("\n".join(paragraphs).encode())
    shuffled = paragraphs[:]
    rng.shuffle(shuffled)
    assert fp.encode(fp.vector("\n".join(shuffled).encode())) == fp.encode(whole)
    total = fp.vector(None)
    for p in paragraphs:
        total = fp.insert(total, fp.vector(p.encode()))
    assert fp.encode(total) == fp.encode(whole)
    rest = fp.vector("\n".join(paragraphs[1:]).encode() if len(paragraphs) > 1 else None)
    assert fp.encode(fp.delete(whole, fp.vector(paragraphs[0].encode()))) == fp.encode(rest)
    v = fp.decode(fp.encode(whole))
    assert fp.encode(v) == fp.encode(whole)


def test_pieces_of_a_long_text_add_up(monkeypatch):
    text = corpus.prose(4, 3000).encode()
    whole = fp.encode(fp.vector(text))
    monkeypatch.setattr(fp, "PIECE", 1000)
    assert fp.encode(fp.vector(text)) == whole


def test_likeness_follows_the_shared_part():
    a, b = corpus.prose(5, 800), corpus.prose(6, 800)
    mixed = a[:len(a) // 2] + b[:len(a) // 2]
    near = fp.likeness(fp.vector(a.encode()), fp.vector(mixed.encode()))
    far = fp.likeness(fp.vector(a.encode()), fp.vector(b.encode()))
    assert 0.3 < near < 0.7 and far < 0.3
