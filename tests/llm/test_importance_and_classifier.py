"""Importance resampling against brute force; the quality classifier on held-out rows and hand-made ones."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weekloom.llm import classifier, importance
from weekloom.llm.importance import resample

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def _buckets(text):
    w = WORDS.findall((text or "").translate(LOWER))
    return [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10_000 for k in (1, 2, 3) for i in range(len(w) - k + 1)], len(w)


def brute(docs, target):
    """``docs``: id and text."""
    found = [_buckets(text) for _, text in docs]
    s, t = Counter(b for f, _ in found for b in f), Counter(b for text in target for b in _buckets(text)[0])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log(((t[b] + 1) * (all_s + 10_000)) / ((s[b] + 1) * (all_t + 10_000)))) for b in range(10_000)]
    rows = []
    for (doc_id, _), (buckets, n) in zip(docs, found):
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in buckets)
        rows.append([doc_id, len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    drawn = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    ranks = {id(r): k + 1 for k, r in enumerate(drawn[: len(drawn) * 5 // 100])}
    return sorted([tuple(r[:4]) + (ranks.get(id(r)),) for r in rows], key=str)


def got(df, target):
    return sorted([tuple(r) for r in resample(df, target).collect()], key=str)


def _made(seed, n):
    rng = random.Random(seed)
    vocabulary = ["alpha", "Béta", "gam-ma", "ÉTÉ", "x" * 90, "中文", "a_b", "7", "the", "The"]
    return [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 60)))) for i in range(n)]


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    target = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(docs, target) == brute(rows, [r.text for r in target.collect()])


def test_edges_ties_and_clashing_names(spark, monkeypatch):
    monkeypatch.setattr(importance, "JOINED_BYTES", 500)
    monkeypatch.setattr(importance, "BLOCK_BYTES", 40)
    rows = _made(1, 300) + [(None, "the " * 30), (900, None), (901, ""), (902, "..."), (903, "the the"), (903, "the the")]
    rows += [(77, "alpha " * 25)] * 60 + [(904, "é " * 3_000)]
    target = [(1, "the alpha the"), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for name in ("row", "out", "position", "place", "weight", "score", "rank"):
        df = df.withColumn(name, F.lit("clash"))
    assert got(df, spark.createDataFrame(target, "item_id long, text string")) == brute(rows, [t for _, t in target])


def test_no_documents_and_no_target(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert got(empty, empty) == []
    rows = _made(2, 50)
    assert got(spark.createDataFrame(rows, "doc_id long, text string"), empty) == brute(rows, [])


@pytest.mark.parametrize("block", [1, 7, 1 << 20])
def test_features_cross_no_document_whatever_the_block(monkeypatch, block):
    monkeypatch.setattr(importance, "BLOCK_BYTES", block)
    texts = [t for _, t in _made(3, 80)] + ["", "one", "..", "\xff two"]
    found = [[] for _ in texts]
    for docs, buckets in importance.features([t.encode() for t in texts]):
        for d, b in zip(docs.tolist(), buckets.tolist()):
            found[d].append(b)
    assert [sorted(f) for f in found] == [sorted(_buckets(t)[0]) for t in texts]


# ------------------------------------------------------------------ quality classifier


def _auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    ones = label == 1
    return (rank[ones].sum() - ones.sum() * (ones.sum() - 1) / 2) / (ones.sum() * (~ones).sum())


def test_held_out_documents_are_told_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = classifier.train(docs, labels, ~classifier.held_out())
    scored = classifier.score_quality(docs, model).where(classifier.held_out()).join(labels, "doc_id").toPandas()
    assert len(scored) > 1_000 and scored["score"].between(0, 1).all()
    assert _auc(scored["score"].to_numpy(), scored["quality"].to_numpy()) > 0.99
    assert (scored["predicted"] == scored["quality"]).mean() > 0.98


def test_indicators_are_distinct_and_belong_to_one_text():
    texts = ["The THE the the.", "", None, "a", "ab", "The THE the the.", "# $$$ 12 Äß " * 40]
    found = [set(row.tolist()) for row in classifier.indicators(pa.array(texts))]
    alone = [set(next(classifier.indicators(pa.array([t], pa.string()))).tolist()) for t in texts]
    assert found == alone and found[0] == found[5] and found[1] == found[2] == set()
    assert all(len(set(r)) == len(r) for r in (row.tolist() for row in classifier.indicators(pa.array(texts))))


def test_descent_reaches_the_optimum(monkeypatch):
    """With enough rounds no step from the weights lowers the loss; with the given ones little is left to gain."""
    few = classifier.ROUNDS
    monkeypatch.setattr(classifier, "ROUNDS", 2_000)
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(80, 6)), np.where(rng.random(80) < 0.5, 1.0, -1.0)
    x[:, 0] += y
    rows, cost = [np.arange(6)] * 80, np.full(80, 0.5)
    w, b = classifier.descend(rows, list(x), y, cost, 6)
    loss = lambda w, b: (w @ w + b * b) / 2 + (cost * np.maximum(0, 1 - y * (x @ w + b))).sum()
    least = loss(w, b)
    for _ in range(300):
        assert loss(w + rng.normal(0, 0.02, 6), b + rng.normal(0, 0.02)) > least - 1e-4
    monkeypatch.setattr(classifier, "ROUNDS", few)
    assert loss(*classifier.descend(rows, list(x), y, cost, 6)) < 1.01 * least


def test_few_or_no_labels_ties_and_odd_rows(spark):
    docs = spark.createDataFrame([(1, "good text"), (2, "BAD!!"), (2, "BAD!!"), (3, None), (None, ""), (4, "x " * 40_000)], "doc_id long, text string")
    for name in ("order", "label", "score", "features", "rank"):
        docs = docs.withColumn(name, F.lit("clash"))

    def scores(rows):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, text string")
        model = classifier.train(docs, labels, F.col("doc_id").isNotNull())
        return classifier.score_quality(docs, model).collect()

    assert {r.score for r in scores([])} == {0.5} and {r.predicted for r in scores([])} == {1}
    assert {round(r.score) for r in scores([(1, 1, None), (4, 1, None)])} == {1}
    assert {r.predicted for r in scores([(2, 0, None), (2, None, None), (9, 1, None), (None, 1, None)])} == {0}
    both = scores([(1, 1, None), (2, 0, None), (2, 0, None), (3, 1, None), (4, 1, None)])
    assert len(both) == 6 and all(0 <= r.score <= 1 for r in both)
    assert classifier.score_quality(docs.limit(0), classifier._constant(0.5)).collect() == []


def test_one_id_with_a_third_of_all_rows_is_learned_from_once(spark):
    docs = spark.range(600).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("t "), "id").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    found = []
    whole = classifier.fit
    try:
        classifier.fit = lambda rows, y, sizes: found.append(len(y)) or whole(rows, y, sizes)
        classifier.train(docs, labels, F.lit(True))
    finally:
        classifier.fit = whole
    assert found == [docs.select("doc_id").distinct().count()]
