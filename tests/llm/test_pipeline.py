"""The pipeline's stages against brute force on their own inputs."""

import test_decontaminate
import test_jaccard
from pyspark.sql import functions as F
from test_tokens import FILES, check_packed, expected_ids

import __spark_entry__
import corpus_pipeline
from cowrie.llm import language, toxicity
from cowrie.session import shared_folder

SF = "/root/testdata/sf0.001"


def test_stages_are_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    known, toxic = language.fit(docs), toxicity.fit(docs, labels)
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]

    def expected(name, rows):
        pairs = [(r["doc_id"], r["text"]) for r in rows]
        if name == "language ID":
            return [d for d, t in pairs if (found := known.predict(t))[0] != "und" and found[1] >= 0.5]
        if name == "toxicity":
            return [d for d, t in pairs if toxic.score(t) < 0.5]
        if name == "n-gram Jaccard join":
            return sorted({c for _, _, c in test_jaccard.brute(pairs, 5, 80)})
        return [r[0] for r in test_decontaminate.brute(pairs, items) if not r[-1]]

    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        folder = shared_folder(spark, "stage")
        stage(spark, rows, SF).write.parquet(folder)
        before, rows = rows, spark.read.parquet(folder)
        assert rows.columns == docs.columns
        assert sorted(r["doc_id"] for r in rows.collect()) == sorted(expected(name, before.collect()))
    left = rows.collect()
    assert 0 < len(left) < docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, rows, SF).collect()
    lengths = {r["doc_id"]: len(ids) for r, ids in zip(left, expected_ids([r["text"] for r in left], FILES[1]))}
    check_packed(packed, lengths, 2048)


def test_odd_rows_pass_all_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.range(6).select(
        F.when(F.col("id") < 4, -1 - F.floor(F.col("id") / 2)).alias("doc_id"),
        F.when(F.col("id") == 4, "").when(F.col("id") == 3, "12 ?!").when(F.col("id") < 3, "the same and the other of it").alias("text"),
        F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("long").alias("n_chars"),
    ).withColumn("score", F.lit(1)).withColumn("length", F.lit("x"))
    rows = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, SF)
        assert rows.columns == odd.columns
    assert [r["doc_id"] for r in rows.collect()] == [-2]
    assert corpus_pipeline.STAGES[-1][1](spark, rows, SF).count() == 1
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def test_registered():
    names = __spark_entry__.queries()
    assert {name.split("_")[0] for name in names if name.startswith("op")} == {f"op{k}" for k in range(1, 14)}
    assert names["pipeline"] is corpus_pipeline.run
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "toxicity", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing",
    ]
