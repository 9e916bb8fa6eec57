"""op4: the noisy-or against plain Python, held-out accuracy, defined cases."""

import os
import re
import sys
import zlib

sys.path.insert(0, os.path.dirname(__file__))

import corpus  # noqa: E402
import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
from tributary.llm import toxicity as tox, words as W  # noqa: E402


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = corpus.read(spark, "documents", sf), corpus.read(spark, "labels", sf)
    rows = tox.toxicity(docs, labels).join(labels, "doc_id").select("doc_id", "held_out", "score", "predicted", "toxic").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    hit = sum(r.predicted and r.toxic for r in held)
    assert hit / sum(r.predicted for r in held) > 0.9  # of those called toxic; some labels are noise
    assert hit / sum(r.toxic for r in held) > 0.85  # of those labelled so; some labels are noise
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)


def hashes(word):
    data = np.frombuffer(word.encode(), np.uint8)
    out = [W.byte_hash(data, np.array([0]), np.array([len(data)]))[0]]
    for k, n in enumerate(tox.PREFIXES):
        h = W.byte_hash(data, np.array([0]), np.array([min(n, len(data))]))
        out.append(W.mix(h + np.uint64(k + 1))[0])
    return out


def test_noisy_or_and_located_sentences():
    bad = hashes("dreadful")
    order = np.argsort(np.array(bad, np.uint64))
    weights = np.array([6.0, 0.5, 0.25, 0.25])
    model = tox.Model(np.array(bad, np.uint64)[order], weights[order], -4.0)
    text = "Éa ok. A dreadful thing! dreadful dreadful\nDreads; fine? ..."
    score, offending = tox._score(model, pa.array([text, None, "", "...", "fine"]))
    known = dict(zip(bad, weights))
    clean = 1.0
    spans = []
    for m in re.finditer(r"[^.!?\n]+", text):
        words = re.findall(r"\w+", m[0].lower())
        if words:
            p = tox._sigmoid(np.array(-4.0 + sum(known.get(h, 0) for h in {h for w in words for h in hashes(w)})))
            clean *= 1 - p
            if p >= 0.5:
                body = list(re.finditer(r"\w+", m[0]))
                spans.append((m.start() + body[0].start(), m.start() + body[-1].end()))
    assert np.isclose(score[0], 1 - clean)
    assert [(s["start"], s["end"]) for s in offending[0]] == spans
    assert score[1] == score[2] == score[3] == 0 and 0 < score[4] < 0.1


def test_odd_documents_and_tables(spark):
    docs = corpus.frame(spark)
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, None), (None, 1), (5, 0)], "doc_id long, toxic int")
    rows = tox.toxicity(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0 for r in rows if r.doc_id in (1, 2, 3))
    none = labels.where("false")
    assert all(r.score < 1e-9 and r.predicted == 0 for r in tox.toxicity(docs, none).collect())
    assert tox.toxicity(corpus.frame(spark, []), labels).collect() == []
    assert tox.keep_harmless(docs, none).collect() == docs.collect()


def test_an_id_on_many_rows_gives_one_text(spark, monkeypatch):
    """The sample that goes to the driver has at most a text for each id, however many rows share the id."""
    rows = [(1, f"vile words {i}") for i in range(300)] + [(i, f"good words {i}") for i in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2 == 1)) for i in range(1, 40)], "doc_id long, toxic int")
    seen = []
    real = tox.written
    monkeypatch.setattr(tox, "written", lambda df, name: seen.append(real(df, name)) or seen[-1])
    tox.train(docs, labels)
    assert seen[0].count() <= 39 and seen[0].where("text like 'vile%'").count() <= 1
