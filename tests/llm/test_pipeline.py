"""The pipeline's stages, each on its own input, and the whole run."""

import os
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(__file__))

import corpus  # noqa: E402
import corpus_pipeline as cp  # noqa: E402
from test_jaccard import brute as near_duplicates  # noqa: E402
from tributary.llm import decontaminate, mixing, toxicity  # noqa: E402

SF = "/root/testdata/sf0.01"


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_each_stage_on_its_own_input(spark, tmp_path):
    docs = corpus.read(spark, "documents", SF)
    at = 0
    for (name, stage), check in zip(cp.STAGES, (toxic, duplicates, leaked, mixed, sharded)):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / str(at)))
        out = spark.read.parquet(str(tmp_path / str(at)))
        check(spark, docs, out)
        if name != cp.STAGES[-1][0]:
            assert out.columns == docs.columns
        docs, at = out, at + 1


def toxic(spark, docs, out):
    labels = corpus.read(spark, "labels", SF)
    scored = toxicity.toxicity(docs, labels).collect()
    assert ids(out) == Counter(r.doc_id for r in scored if not r.predicted) and len(ids(out)) < len(scored)


def duplicates(spark, docs, out):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    _, group = near_duplicates(rows)
    least = {}
    for (doc_id, _), g in zip(rows, group):
        least[g] = min(least.get(g, doc_id), doc_id)
    assert ids(out) == Counter(least.values())


def leaked(spark, docs, out):
    found = {r.doc_id for r in decontaminate.find_leaks(docs, corpus.read(spark, "benchmark", SF)).collect()}
    assert found and ids(out) == Counter({i: n for i, n in ids(docs).items() if i not in found})


def mixed(spark, docs, out):
    plan = mixing.mix(docs).collect()
    assert ids(out) == Counter({r.doc_id: n for r in plan if (n := int(r.taken / max(1, r.size) + 0.5))})


def sharded(spark, docs, out):
    assert ids(out) == ids(docs)


def test_run_equals_the_stages_and_odd_documents(spark, tmp_path):
    sf = str(tmp_path / "odd")
    corpus.frame(spark).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(4, 1, 1), (5, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(0, corpus.prose(77, 40))], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    rows = cp.run(spark, sf).collect()
    assert rows and Counter(r.law for r in rows) == {"rows": len(rows)}
    empty = str(tmp_path / "empty")
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").where("false").write.parquet(f"{empty}/{name}.parquet")
    assert cp.run(spark, empty).collect() == []
