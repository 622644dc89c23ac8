"""Fitted operators: held-out accuracy, and exact parts against brute force."""

import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from perilscope.llm import lm, quality, queries, toxicity
from tests.llm import data

SF = "/root/testdata/sf0.01"


def remainder(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def test_tree_paths_are_conjunctions():
    text = """RandomForestClassificationModel: uid=x, numTrees=1
  Tree 0 (weight 1.0):
    If (feature 0 <= 0.5)
     If (feature 1 <= 2.0)
      Predict: 0.0
     Else (feature 1 > 2.0)
      Predict: 1.0
    Else (feature 0 > 0.5)
     Predict: 1.0
"""
    rules = {r.terms for r in quality.tree_paths(text, ["a", "b"])}
    assert rules == {(("a", False, 0.5),), (("a", True, 0.5),), (("a", False, 0.5), ("b", False, 2.0)), (("a", False, 0.5), ("b", True, 2.0))}


@pytest.mark.parametrize("name,label,least", [("op3_rule_ensemble", "quality", 0.97), ("op10_weak_supervision", "toxic", 0.94)])
def test_held_out_accuracy(spark, name, label, least):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.QUERIES[name](spark, SF).collect()
    assert len(got) == docs.count()
    truth = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(r["held_out"] == (remainder(r["doc_id"], 3) == 1) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 50
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) >= least
    if label == "toxic":                                             # clean documents are left alone
        assert not any(r["predicted"] for r in held if not truth[r["doc_id"]])


@pytest.mark.parametrize("run", [quality.classify, toxicity.classify])
@pytest.mark.parametrize("docs", [data.clashing, data.empty])
@pytest.mark.parametrize("labels", [data.some_labels, data.no_labels])
def test_classifier_edges(spark, run, docs, labels):
    d = docs(spark)
    rows = run(d, labels(spark)).collect()
    assert len(rows) == d.count()
    assert all(r["score"] is not None and 0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)


def test_statistics_of_empty_texts_are_zero(spark):
    rows = quality.with_statistics(data.awkward(spark).where("text is null or text = ''")).collect()
    assert len(rows) == 3 and all(r[c] == 0 for r in rows for c in quality.FEATURES if c not in ("distinct_lines",))


def test_voters_and_label_model(spark):
    d = spark.createDataFrame([("you Idiot, vequer vequla",), ("vequla idiots",), ("",)], "text string")
    got = [r[0] for r in d.select(toxicity.votes(F.col("text"), ["idiot", "vequ*", "vequ**"])).collect()]
    assert [b & 7 for b in got] == [7, 2, 0]
    # voters of known rates: the model recovers them from unlabelled votes
    rng = np.random.default_rng(0)
    y = rng.random(20000) < 0.2
    t, c = np.array([0.6, 0.5, 0.7, 0.4]), np.array([0.02, 0.05, 0.01, 0.1])
    x = rng.random((len(y), 4)) < np.where(y[:, None], t, c)
    bits = collections.Counter((x @ (1 << np.arange(4))).tolist())
    patterns = spark.createDataFrame([(int(b), n) for b, n in bits.items()], "bits bigint, n bigint")
    m = toxicity.label_model(patterns, toxicity.LabelModel(0.2, np.full(4, 0.5), np.full(4, 0.1), np.zeros((4, 4))), 4)
    assert (m.toxic > 3 * m.clean).all()
    p = m.posterior(x.astype(float))
    assert p[y].mean() > 0.8 and p[~y].mean() < 0.3               # silence leaves the prior, 0.2


def test_language_model_against_brute_force(spark):
    docs = {r["doc_id"]: (r["text"] or "").encode().lower().split() + [b""]
            for r in spark.read.parquet(f"{data.SF}/documents.parquet").collect()}
    count = collections.Counter(w for i, ws in docs.items() if remainder(i, 10) for w in ws)
    n, v = sum(count.values()), len(count)
    got = queries.QUERIES["op4_log_bilinear"](spark, data.SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ws = docs[r["doc_id"]]
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        assert r["base_score"] == pytest.approx(base) and r["n_tokens"] == len(ws) and r["train_tokens"] == n
        assert r["n_known"] == sum(count[w] > 0 for w in ws) and r["held_out"] == (remainder(r["doc_id"], 10) == 0)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_language_model_is_normalised_and_edges(spark):
    sample = np.array([[(0 * 6 + 1) * 6 + 2, 50], [(1 * 6 + 2) * 6 + 3, 50]])
    first, last, bias = lm.fit_nce(sample, 5, dim=4, epochs=50, batch=16, noise=8)
    m = lm.Model({}, np.ones(lm.SHAPES), first, last, bias)
    z = first[0] + last[1] + bias
    total = m.log_totals(np.array([0]), np.array([1]))[0]
    assert np.exp(z - total).sum() == pytest.approx(1, abs=1e-4) and z.argmax() == 2
    rows = lm.score_documents(data.clashing(spark), draws=2000, frequent_share=0.01).collect()
    assert len(rows) == len(data.awkward_rows())
    assert all(math.isfinite(r["score"]) and r["score"] < 0 and math.isfinite(r["base_score"]) for r in rows)
    assert lm.score_documents(data.empty(spark)).count() == 0
    one = data.awkward(spark).where("doc_id in (1, 3)")
    twice = sorted(r["score"] for r in lm.score_documents(one.union(one), draws=2000).collect())
    assert twice[0] == twice[1] and twice[2] == twice[3]             # equal rows, equal scores


def test_language_model_learns_from_every_triple(spark):
    # a cycle of 24 words, 200 texts: seen thousands of times, but few draws of it are taken
    words = [f"w{chr(97 + i)}" for i in range(24)]
    docs = spark.createDataFrame([(i, " ".join(words[(i + k) % 24] for k in range(30))) for i in range(200)], "doc_id long, text string")
    got = lm.score_documents(docs, draws=20).collect()
    assert sum(r["score"] for r in got) > 0.5 * sum(r["base_score"] for r in got)
