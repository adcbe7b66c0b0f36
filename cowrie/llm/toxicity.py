"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes ratios.

A feature is the presence of a hashed n-gram of 4 to 6 characters.  Its scale is the
log ratio of the rates at which the two labels' texts have it (naive Bayes), counted over
all labelled texts and drawn towards 0 by ``CONFIDENCE`` standard errors: the scale is what
the ratio is at least, and 0 where the counts don't tell it from 0.  A logistic regression
on the scaled features, learned with AdaGrad from a bounded sample, gives the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cowrie.llm.ngrams import buckets, slices
from cowrie.llm.slices import bounded
from cowrie.llm.tokens import forget
from cowrie.llm.training import held_out
from cowrie.session import shared_folder

LOW, HIGH, BITS = 4, 6, 20
#: Distinct labelled rows of each label, about, that weights are learned from, and the most
#: n-grams of all of them together (four bytes each) that the driver takes.
SAMPLE_EACH, MOST_FIGURES = 4_000, 10_000_000
#: Labelled ids, of some forty bytes each, up to which they are broadcast to the texts.
MOST_BROADCAST = 1_000_000
#: Standard errors by which a ratio is drawn towards 0.
CONFIDENCE = 3.0
EPOCHS, RATE, DECAY = 30, 0.1, 1e-3
_WHOLE = 1 << 30


def present(text: str | None) -> np.ndarray:
    """Buckets of the n-grams a whole text has, ascending; none for null and empty texts."""
    return np.unique(buckets(text, LOW, HIGH, BITS))


@dataclass
class Model:
    """``place`` of each bucket among the features, -1 for none; ``weights`` with the scales in them."""

    place: np.ndarray
    weights: np.ndarray
    constant: float

    def score(self, text: str | None) -> float:
        places = self.place[buckets(text, LOW, HIGH, BITS)]
        z = self.constant + float(self.weights[np.unique(places[places >= 0])].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def _labelled(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int) -> DataFrame:
    """``doc_id, text, label, times`` of all labelled rows outside the held-out fold, equal labels once."""
    allowed = labels.select("doc_id", F.col(label).alias("label")).where(
        F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id", folds, fold)
    )
    once = allowed.groupBy("doc_id", "label").agg(F.count(F.lit(1)).alias("times"))
    if once.count() <= MOST_BROADCAST:
        once = F.broadcast(once)  # else texts and labels are shuffled by id
    return docs.select("doc_id", "text").join(once, "doc_id")


def ratios(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, dict[int, int]]:
    """Buckets whose scale isn't 0, ascending, their scales, and the texts of each label.

    ``rows (label, text)`` count ``times`` each where they have that column.  Every task adds
    up the texts of each label that have a bucket; Spark adds the sums.
    """
    schema = pa.schema([("bucket", pa.int32()), ("label", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        total = np.zeros((2, (1 << BITS) + 1), np.int64)
        for columns in slices(bounded(batches, "text")):
            for label, text, times in zip(columns["label"], columns["text"], columns["times"]):
                total[label, present(text)] += times
                total[label, -1] += times
        label, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket, pa.int32()), pa.array(label, pa.int32()), pa.array(total[label, bucket])], schema=schema
        )

    one = F.col("label") == 1
    times = F.col("times") if "times" in rows.columns else F.lit(1)
    counts = (
        rows.select("label", "text", times.cast("long").alias("times")).mapInArrow(count, "bucket int, label int, n long")
        .groupBy("bucket")
        .agg(F.sum(F.when(one, F.col("n"))).alias("with"), F.sum(F.when(~one, F.col("n"))).alias("without"))
        .na.fill(0)
    )
    folder = shared_folder(rows.sparkSession, "ratios")
    counts.write.parquet(folder)
    counts = rows.sparkSession.read.schema(counts.schema).parquet(folder)
    totals = counts.where(F.col("bucket") == 1 << BITS).first()
    texts = {1: totals["with"], 0: totals["without"]} if totals else {0: 0, 1: 0}
    if not texts[0] or not texts[1]:
        return np.empty(0, np.int64), np.empty(0), texts
    having, without = F.col("with") + 0.5, F.col("without") + 0.5
    ratio = F.log(having / (texts[1] + 1)) - F.log(without / (texts[0] + 1))
    error = F.sqrt(1 / having - 1 / (texts[1] + 1) + 1 / without - 1 / (texts[0] + 1))
    scale = F.signum(ratio) * F.greatest(F.lit(0.0), F.abs(ratio) - CONFIDENCE * error)
    known = counts.where(F.col("bucket") < 1 << BITS).select("bucket", scale.alias("scale"))
    table = known.where("scale <> 0").orderBy("bucket").toArrow()  # at most 2**BITS rows
    return table["bucket"].to_numpy().astype(np.int64), table["scale"].to_numpy(), texts


def _drawn(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, each: int, texts: dict[int, int]) -> DataFrame:
    """About ``each`` distinct labelled rows of both labels, by a hash of the row, with the rows they stand for.

    Rows are drawn before they meet their labels, at the greater of the two rates.
    """
    rates = {k: min(1.0, each / n) for k, n in texts.items()}
    row = F.pmod(F.xxhash64("doc_id", "text", F.lit("sample")), F.lit(_WHOLE))
    some = docs.where(row < max(rates.values()) * _WHOLE)
    rate = F.when(F.col("label") == 1, rates[1]).otherwise(rates[0])
    joined = _labelled(some, labels, label, folds, fold).where(row < rate * _WHOLE)
    # copies are one row of their number: an id or a text that repeats can't fill the sample
    return joined.groupBy("doc_id", "text", "label").agg((F.sum("times") / F.any_value(rate)).alias("weight"))


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, fold: int = 0, each: int = SAMPLE_EACH
) -> Model:
    """Learns ``labels.<label>`` (0 or 1) from the texts of labelled rows outside the held-out fold.

    Other labels, null ids and labels without a document teach nothing; a repeated row
    counts each time.  Where one of the labels is missing, the model scores every text
    with the share of label 1 it has seen, 0 for none.  Where no n-gram tells the labels
    apart, it scores every text with the share of label 1.
    """
    spark = docs.sparkSession
    bucket, ratio, texts = ratios(_labelled(docs, labels, label, folds, fold))
    place = np.full(1 << BITS, -1, np.int32)
    place[bucket] = np.arange(len(bucket), dtype=np.int32)
    if not texts[0] or not texts[1]:
        return Model(place, np.zeros(len(bucket)), 500.0 if texts[1] else -500.0)
    shared = spark.sparkContext.broadcast(place)
    schema = pa.schema([
        ("row", pa.int64()), ("label", pa.int32()), ("weight", pa.float64()), ("found", pa.list_(pa.int32())),
    ])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in slices(bounded(batches, "text")):
            places = (shared.value[buckets(t, LOW, HIGH, BITS)] for t in columns["text"])
            found = [np.unique(p[p >= 0]) for p in places]
            arrays = [columns["row"], columns["label"], columns["weight"], found]
            yield pa.RecordBatch.from_arrays([pa.array(a, f.type) for a, f in zip(arrays, schema)], schema=schema)

    drawn = _drawn(docs, labels, label, folds, fold, each, texts)
    numbers = drawn.select(F.xxhash64("doc_id", "text").alias("row"), F.col("label").cast("int").alias("label"), "weight", "text")
    folder, kinds = shared_folder(spark, "features"), "row long, label int, weight double, found array<int>"
    numbers.mapInArrow(features, kinds).write.parquet(folder)
    shared.destroy()
    sample = spark.read.schema(kinds).parquet(folder)
    figures = sample.agg(F.sum(F.size("found"))).first()[0] or 0
    if figures > MOST_FIGURES:  # long texts: fewer of them, by the hash of the row
        share = MOST_FIGURES / figures
        kept = F.pmod(F.xxhash64("row", F.lit("fewer")), F.lit(_WHOLE)) < share * _WHOLE
        sample = sample.where(kept).withColumn("weight", F.col("weight") / share)
    table = sample.orderBy("row", "label").toArrow()
    y, weight = table["label"].to_numpy().astype(float), table["weight"].to_numpy()
    if len(y) == 0:
        return Model(place, np.zeros(len(bucket)), float(np.log(texts[1] / texts[0])))
    lists = table["found"].combine_chunks()
    rows = np.split(lists.values.to_numpy(), lists.offsets.to_numpy()[1:-1])
    weights, constant = _logistic(rows, ratio, y, weight)
    return Model(place, weights * ratio, constant)


def _logistic(found: list[np.ndarray], scale: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """AdaGrad on the log loss with weight decay; one row at a time, in a fixed random order."""
    weight = weight / weight.mean()
    w, seen = np.zeros(len(scale)), np.full(len(scale), 1e-8)
    share = float(np.clip((weight * y).sum() / weight.sum(), 1e-6, 1 - 1e-6))
    constant, seen_constant = float(np.log(share / (1 - share))), 1e-8
    random = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for i in random.permutation(len(y)).tolist():
            f = found[i]
            z = constant + w[f] @ scale[f]
            error = weight[i] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[i])
            gradient = error * scale[f] + DECAY * w[f]
            seen[f] += gradient * gradient
            w[f] -= RATE * gradient / np.sqrt(seen[f])
            seen_constant += error * error
            constant -= RATE * error / np.sqrt(seen_constant)
    return w, constant


def predict(docs: DataFrame, model: Model, folds: int = 5, fold: int = 0) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; only the text is looked at.

    Null and empty texts have no n-grams: their score is that of the constant alone.
    Repeated rows score alike, a null id isn't held out, an empty table gives no rows, and
    other columns are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS places, bounded features

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in slices(bounded(batches, "text")):
            arrays = [columns["doc_id"], columns["held_out"], [shared.value.score(t) for t in columns["text"]]]
            yield pa.RecordBatch.from_arrays([pa.array(a, f.type) for a, f in zip(arrays, schema)], schema=schema)

    rows = docs.select("doc_id", held_out("doc_id", folds, fold).alias("held_out"), "text")
    scored = rows.mapInArrow(score, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of ``docs``, with all their columns, that score below 0.5; nulls, repeats and empty tables as in ``predict``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            clean = [shared.value.score(text.as_py()) < 0.5 for text in batch.column("text")]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
