"""The corpus pipeline, stage by stage, against plain Python on the stage's own input."""

import collections
import re

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import data
from tests.llm.test_exact import brute_components

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "n-gram Jaccard join",
                                                      "mixing to target weights", "best-fit packing"]
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before = docs.collect()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        path = str(tmp_path / str(k))
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        after = docs.collect()
        if k < 4:
            assert docs.columns == columns
        if name == "toxicity":
            gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
            assert not [d for d in gone if toxic.get(d) == 0]           # clean documents stay
        elif name == "exact dedup":
            best = {}
            for r in before:
                t = r["text"] or ""
                best[t] = max(best.get(t, -1), r["doc_id"])
            assert sorted((r["doc_id"], r["text"]) for r in after) == sorted((i, t) for t, i in best.items())
        elif name == "n-gram Jaccard join":
            parts = brute_components([(r["doc_id"], r["text"]) for r in before])
            assert sorted(str(r["doc_id"]) for r in after) == sorted({c for _, _, c in parts})
        elif name == "mixing to target weights":
            copies = collections.Counter(r["doc_id"] for r in after)
            assert set(copies) <= {r["doc_id"] for r in before} and max(copies.values()) <= 3
            size = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in before}
            total, taken = sum(size.values()), sum(size[d] * n for d, n in copies.items())
            assert abs(taken - total) < 0.25 * total
        else:
            sequences = collections.defaultdict(int)
            whole = collections.Counter(r["doc_id"] for r in before)
            for r in after:
                sequences[r["sequence_id"]] += r["length"]
            assert collections.Counter(r["doc_id"] for r in after if r["piece"] == 0) == whole
            assert max(sequences.values()) <= 4096 and len(sequences) <= -(-sum(sequences.values()) // 4096) + 1
        before = after


def folder(spark, path, docs):
    docs.write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages_keep_columns_with_clashing_names(spark, tmp_path):
    docs = data.clashing(spark).withColumn("bits", F.lit("b")).withColumn("_source", F.lit("s")).withColumn("_draw", F.lit(1))
    columns = docs.columns
    sf = folder(spark, tmp_path, docs)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r["doc_id"] for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, sf).write.parquet(str(tmp_path / f"stage-{k}"))
        docs = spark.read.parquet(str(tmp_path / f"stage-{k}"))
        assert docs.columns == columns, name
        rows = docs.collect()
        assert rows and {r["doc_id"] for r in rows} <= kept and {r["bits"] for r in rows} == {"b"}, name
        kept = {r["doc_id"] for r in rows}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() >= len(kept)


def test_pipeline_on_an_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, folder(spark, tmp_path, data.empty(spark))).count() == 0
