"""Toxicity by multiple-instance learning.

Only documents carry labels; sentences are the instances. A sentence gets
p = sigmoid(bias + sum of the weights of its features), and a document is toxic
if any of its sentences is: P = 1 - product of (1 - p), the noisy-or. Weights
are fitted to the document labels through that formula, so that the sentences
of a toxic document that carry no evidence stay low, and the same weights then
locate the offending sentences.

Features of a word are hashes of the word and of its first 4, 5 and 6 bytes, in
small letters. Sentences end at ``.``, ``!``, ``?`` and line breaks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm import words as W
from tributary.llm.common import written

#: Labelled rows that are used for fitting, at most, of each class.
FIT_TOXIC, FIT_CLEAN = 1500, 3000
#: A feature is tried if it is in so many toxic documents of the sample at least, and so many times as frequent there.
LEAST_DOCUMENTS, LEAST_LIFT = 6, 4.0
PREFIXES = (4, 5, 6)
THRESHOLD, OFFENDING = 0.7, 0.5
STEPS, RATE, L2 = 600, 0.1, 1e-4

_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?\n"]] = True


@dataclass
class Instances:
    """Words of a batch with their sentence (numbered through the batch) and features (a column each)."""

    words: W.Words
    sentence: np.ndarray
    features: np.ndarray


def instances(column: pa.Array) -> Instances:
    data, offsets = W.utf8(column)
    found = W.split(W.lower(data), offsets, W.NOT_WORD)
    ends = np.cumsum(_END[data], dtype=np.int64)
    # a sentence number is unlike those of other rows as it starts anew at each row
    number = ends[found.start] + found.row if len(data) else np.zeros(0, np.int64)
    features = [found.hash]
    for k, n in enumerate(PREFIXES):
        cut = np.minimum(found.end, found.start + n)
        features.append(W.mix(W.byte_hash(found.data, found.start, cut) + np.uint64(k + 1)))
    return Instances(found, number, np.stack(features, axis=1))


@dataclass
class Model:
    """Sorted feature hashes with their weights, and the bias."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def evidence(self, features: np.ndarray) -> np.ndarray:
        """Index of each feature in the model, or -1."""
        if not len(self.features):
            return np.full(features.shape, -1)
        at = np.minimum(np.searchsorted(self.features, features), len(self.features) - 1)
        return np.where(self.features[at] == features, at, -1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def count_features(texts: pa.Array, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of a batch, with the number of toxic and of clean documents that have them."""
    bag = instances(texts)
    row = np.repeat(bag.words.row, bag.features.shape[1])
    every = bag.features.ravel()
    _, once = np.unique(W.mix(every + W.mix(row.astype(np.uint64))), return_index=True)
    names, feature = np.unique(every[once], return_inverse=True)
    label = toxic[row[once]]
    return (names, np.bincount(feature, weights=label, minlength=len(names)).astype(np.int64),
            np.bincount(feature, weights=~label, minlength=len(names)).astype(np.int64))


def evidence(texts: pa.Array, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sentences of each row; and (row, sentence, feature) of every feature that is in ``features``, once a sentence."""
    bag = instances(texts)
    at = Model(features, features, 0.0).evidence(bag.features)
    word, column = np.nonzero(at >= 0)
    found = np.unique(np.stack([bag.words.row[word], bag.sentence[word], at[word, column]], axis=1), axis=0)
    first = np.flatnonzero(np.concatenate(([True], bag.sentence[1:] != bag.sentence[:-1]))) if len(bag.sentence) else []
    return np.bincount(bag.words.row[first], minlength=len(texts)), found


def fit(features: np.ndarray, toxic: np.ndarray, sentences: np.ndarray, found: np.ndarray) -> Model:
    """Weights of ``features`` that make the noisy-or of the sentences match the labels (balanced, L2, Adam).

    ``sentences`` counts them for each document; ``found`` has (document, sentence, feature) rows."""
    if not len(toxic) or toxic.all() or not toxic.any():
        return Model(np.zeros(0, np.uint64), np.zeros(0), -40.0)
    docs, tried = len(toxic), len(features)
    with_some, sentence = np.unique(found[:, :2], axis=0, return_inverse=True)
    document, feature = with_some[:, 0], found[:, 2]
    # sentences without any feature are alike, and only counted
    plain = sentences - np.bincount(document, minlength=docs)
    share = np.where(toxic, 0.5 / toxic.sum(), 0.5 / (~toxic).sum())

    theta = np.concatenate([np.full(tried, 1.0), [-6.0]])
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        weights, bias = theta[:-1], theta[-1]
        p = _sigmoid(bias + np.bincount(sentence, weights=weights[feature], minlength=len(with_some)))
        p0 = _sigmoid(np.array(bias))
        clean = plain * np.log1p(-p0) + np.bincount(document, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=docs)
        odds = np.exp(clean) / np.maximum(-np.expm1(clean), 1e-12)  # (1 - P) / P
        slope = share * np.where(toxic, -np.minimum(odds, 1e6), 1.0)  # of the loss, by -log(1 - P)
        pull = slope[document] * p
        grad = np.concatenate([np.bincount(feature, weights=pull[sentence], minlength=tried) + L2 * weights,
                               [pull.sum() + (slope * plain).sum() * p0]])
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad ** 2
        theta = theta - RATE * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-10)
    return Model(features, theta[:-1], float(theta[-1]))


def _score(model: Model, column: pa.Array) -> tuple[np.ndarray, list[list[dict]]]:
    """Score of each row, and its offending sentences with code point offsets."""
    rows = len(column)
    bag = instances(column)
    offending: list[list[dict]] = [[] for _ in range(rows)]
    if not len(bag.sentence):
        return np.zeros(rows), offending
    first = np.flatnonzero(np.concatenate(([True], bag.sentence[1:] != bag.sentence[:-1])))
    of = np.cumsum(np.concatenate(([False], bag.sentence[1:] != bag.sentence[:-1])))
    at = model.evidence(bag.features)
    word, col = np.nonzero(at >= 0)
    pairs = np.unique(np.stack([of[word], at[word, col]], axis=1), axis=0) if len(word) else np.zeros((0, 2), np.int64)
    z = model.bias + np.bincount(pairs[:, 0], weights=model.weights[pairs[:, 1]] if len(pairs) else None,
                                 minlength=len(first))
    p = _sigmoid(z)
    row = bag.words.row[first]
    clean = np.bincount(row, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=rows)
    bad = np.flatnonzero(p >= OFFENDING)
    if len(bad):
        data, offsets = bag.words.data, bag.words.offsets
        points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        last = np.concatenate((first[1:], [len(of)])) - 1
        for s in bad:
            base = points[offsets[row[s]]]
            offending[row[s]].append({"start": int(points[bag.words.start[first[s]]] - base),
                                      "end": int(points[bag.words.end[last[s]]] - base), "score": float(p[s])})
    return -np.expm1(clean), offending


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3 (a null id counts as an empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits on a bounded sample of the labelled rows that aren't held out: of each class those with the
    least hashes of the id. The sample is chosen among the labels alone; ids with two labels count as
    toxic, null ids and null labels don't count. Of an id that several rows share one text is taken, so there are
    as many texts as ids at most."""
    known = (labels.where("doc_id is not null and toxic is not null")
             .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .where(remainder(F.col("doc_id")) != 1).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    some = lambda kind, n: known.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    chosen = some(1, FIT_TOXIC).unionByName(some(0, FIT_CLEAN))
    # at most FIT_TOXIC + FIT_CLEAN ids of 12 bytes
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text")).join(F.broadcast(chosen), "doc_id")
    # of an id that several rows have one text, the one with the least hash: the sample is bounded in rows too
    rows = written(rows.groupBy("doc_id", "toxic").agg(F.min(F.struct("text_hash", "text")).alias("least")).select(
        "least.text", "toxic", "least.text_hash"), "toxic-sample")
    of = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not of.get(1) or not of.get(0):
        return fit(*(np.zeros(0),) * 4)
    counts = rows.mapInArrow(_count, "feature long, hits long, misses long").groupBy("feature").agg(
        F.sum("hits").alias("hits"), F.sum("misses").alias("misses"))
    lift = F.col("hits") / of[1] / ((F.col("misses") + 1) / of[0])
    tried = counts.where((F.col("hits") >= LEAST_DOCUMENTS) & (lift >= LEAST_LIFT)).select("feature")
    features = np.sort(tried.toArrow().column("feature").to_numpy().view(np.uint64))
    found = rows.mapInArrow(_find(features), FOUND).orderBy("text_hash", "toxic").toArrow()
    places = found.column("places").to_pylist()
    triples = [(d, p["sentence"], p["feature"]) for d, of_one in enumerate(places) for p in of_one]
    return fit(features, found.column("toxic").to_numpy() == 1, found.column("sentences").to_numpy(),
               np.array(triples, np.int64).reshape(-1, 3))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, hits, misses = count_features(batch.column("text"), batch.column("toxic").to_numpy() == 1)
        yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(hits), pa.array(misses)],
                                         names=["feature", "hits", "misses"])


FOUND = "text_hash long, toxic int, sentences long, places array<struct<sentence:long,feature:long>>"


def _find(features: np.ndarray):
    kind = pa.list_(pa.struct([("sentence", pa.int64()), ("feature", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            sentences, found = evidence(texts, features)
            places: list[list[dict]] = [[] for _ in range(len(texts))]
            for row, sentence, feature in found.tolist():
                places[row].append({"sentence": sentence, "feature": feature})
            yield pa.RecordBatch.from_arrays([batch.column("text_hash"), batch.column("toxic"), pa.array(sentences.astype(np.int64)),
                                              pa.array(places, kind)], names=["text_hash", "toxic", "sentences", "places"])
    return run


OUT = ("doc_id long, held_out boolean, score double, predicted int,"
       " offending array<struct<start:long,end:long,score:double>>")


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """Scores every row of ``docs`` (doc_id, text; other columns are ignored) in one pass without a shuffle.

    Returns doc_id, held_out, score (0 to 1; a null or empty text has no sentence and gets 0), predicted
    (1 from ``THRESHOLD``) and the offending sentences with their scores. Repeated rows score alike."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()),
                        ("predicted", pa.int32()), ("offending", pa.list_(pa.struct(
                            [("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score, offending = _score(model, batch.column("text"))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("held_out"), pa.array(score),
                pa.array((score >= THRESHOLD).astype(np.int32)), pa.array(offending, schema.field("offending").type)],
                schema=schema)

    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), (remainder(doc_id) == 1).alias("held_out"), "text").mapInArrow(run, OUT)


def keep_harmless(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score is under ``THRESHOLD``."""
    model = train(docs, labels)

    @F.arrow_udf("boolean")
    def harmless(text: pa.Array) -> pa.Array:
        return pa.array(_score(model, text)[0] < THRESHOLD)

    return docs.where(harmless("text"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``score_documents`` with a model of ``train``; without labels of both classes all scores are 0."""
    return score_documents(docs, train(docs, labels))
