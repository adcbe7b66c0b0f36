"""Language identification: sparse multinomial logistic regression on TF-IDF n-grams.

Character n-grams of 1 to 3 characters are hashed.  Document frequencies are counted
over all training rows; the weights are learned with follow-the-regularised-leader
(FTRL-proximal, elastic-net penalty) from a bounded sample; the temperature that divides
the logits is fitted on a part of the sample the weights haven't seen.
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
from cowrie.llm.training import held_out, sampled

LOW, HIGH, BITS = 1, 3, 15
UNKNOWN = "und"
#: Documents of each language that the weights are learned from.
SAMPLE_EACH = 500
CALIBRATION = 0.2
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 1e-3


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


@dataclass
class Model:
    """``weights`` of the n-gram buckets and, last, of the constant, by language."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float = 1.0

    def logits(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        values, _ = _tf_idf(found, counts, self.idf)
        return values @ self.weights[found] + self.weights[-1]

    def predict(self, text: str | None) -> tuple[str, float]:
        """The likeliest language, ties to the first by name, and its calibrated probability."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        p = softmax(self.logits(*counted(text)) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max())
    return e / e.sum()


def counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of a whole text, ascending, and how often each occurs."""
    counts = np.bincount(buckets(text, LOW, HIGH, BITS), minlength=1 << BITS)
    found = np.flatnonzero(counts)
    return found, counts[found]


def _tf_idf(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, float]:
    values = counts * idf[found]
    norm = float(np.sqrt(values @ values)) or 1.0
    return values / norm, norm


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of the whole texts each bucket occurs, and the number of texts.

    Every task adds up a vector of its own; Spark adds the vectors by bucket.
    """
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        total = np.zeros((1 << BITS) + 1, np.int64)
        for columns in slices(bounded(batches, "text")):
            for text in columns["text"]:
                total[counted(text)[0]] += 1
            total[-1] += len(columns["text"])
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int32()), pa.array(total[found], pa.int64())], schema=schema
        )

    totals = docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    frequencies = np.zeros((1 << BITS) + 1, np.int64)
    for row in totals.collect():  # at most 2**BITS + 1 rows
        frequencies[row["bucket"]] = row["n"]
    return frequencies[:-1], int(frequencies[-1])


def learn(
    examples: list[tuple[np.ndarray, np.ndarray, int, bool]], languages: list[str], idf: np.ndarray
) -> Model:
    """FTRL-proximal over ``(buckets, counts, language number, for calibration)``, then the temperature."""
    k = len(languages)
    z, n, w = (np.zeros((len(idf) + 1, k)) for _ in range(3))
    model = Model(languages, idf, w)
    # the vector of a document doesn't change: take it once
    vectors = [(np.append(f, len(idf)), np.append(_tf_idf(f, c, idf)[0], 1.0), y, cal) for f, c, y, cal in examples]
    trained = [i for i, v in enumerate(vectors) if not v[3]] or list(range(len(vectors)))
    random = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for i in random.permutation(trained).tolist():
            found, values, label, _ = vectors[i]
            error = softmax(values @ w[found])
            error[label] -= 1
            gradient = values[:, None] * error
            square = gradient * gradient
            sigma = (np.sqrt(n[found] + square) - np.sqrt(n[found])) / ALPHA
            z[found] += gradient - sigma * w[found]
            n[found] += square
            zf = z[found]
            shrunk = np.sign(zf) * np.maximum(np.abs(zf) - L1, 0)
            w[found] = -shrunk / ((BETA + np.sqrt(n[found])) / ALPHA + L2)
    held = [v for v in vectors if v[3]]
    model.temperature = _temperature([(v[1] @ w[v[0]], v[2]) for v in held])
    return model


def _temperature(logits: list[tuple[np.ndarray, int]]) -> float:
    """The temperature with the least log loss, by golden-section search on its logarithm."""
    if not logits:
        return 1.0
    rows, labels = np.array([x for x, _ in logits]), np.array([y for _, y in logits])

    def loss(log_t: float) -> float:
        s = rows / np.exp(log_t)
        s = s - s.max(1, keepdims=True)
        return float((np.log(np.exp(s).sum(1)) - s[np.arange(len(s)), labels]).mean())

    low, high, golden = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(docs: DataFrame, folds: int = 5, fold: int = 0, each: int = SAMPLE_EACH) -> Model:
    """Learns from ``docs (doc_id, text, lang)`` outside the held-out fold.

    Rows without an id, a language or a letter in their text teach nothing.  An empty
    table gives a model that knows no language.
    """
    rows = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
        & ~held_out("doc_id", folds, fold)
    )
    frequencies, n = document_frequencies(rows)
    idf = np.log((1 + n) / (1 + frequencies)) + 1

    schema = pa.schema([
        ("doc_id", pa.int64()), ("lang", pa.string()), ("found", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())),
    ])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in slices(bounded(batches, "text")):
            kept = [r for r in zip(columns["doc_id"], columns["lang"], columns["text"]) if has_letter(r[2])]
            vectors = [counted(text) for _, _, text in kept]
            arrays = [[d for d, _, _ in kept], [g for _, g, _ in kept], [f for f, _ in vectors], [c for _, c in vectors]]
            yield pa.RecordBatch.from_arrays([pa.array(a, f.type) for a, f in zip(arrays, schema)], schema=schema)

    drawn = sampled(rows, "doc_id", "lang", each).select("doc_id", "lang", "text")
    table = drawn.mapInArrow(features, "doc_id long, lang string, found array<int>, counts array<int>").toArrow()
    order = np.argsort(np.array(table["doc_id"].to_pylist(), np.int64), kind="stable")
    langs = table["lang"].to_pylist()
    languages = sorted(set(langs))
    number = {name: k for k, name in enumerate(languages)}
    found, counts = table["found"].combine_chunks(), table["counts"].combine_chunks()
    examples = []
    for rank, i in enumerate(order.tolist()):
        f, c = found[i].values.to_numpy().astype(np.int64), counts[i].values.to_numpy()
        examples.append((f, c, number[langs[i]], rank % round(1 / CALIBRATION) == 0))
    if not examples:
        return Model([], idf, np.zeros((len(idf) + 1, 0)))
    return learn(examples, languages, idf)


def predict(docs: DataFrame, model: Model, folds: int = 5, fold: int = 0) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row; only the text is looked at.

    Null texts and texts without a letter are ``und`` with score 0, and so is every text
    under a model that has learned no language.  Repeated rows are predicted alike, a null id
    isn't held out, an empty table gives no rows, and other columns are not read.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()),
    ])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS weights a language

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in slices(bounded(batches, "text")):
            found = [shared.value.predict(text) for text in columns["text"]]
            arrays = [columns["doc_id"], columns["held_out"], [g for g, _ in found], [p for _, p in found]]
            yield pa.RecordBatch.from_arrays([pa.array(a, f.type) for a, f in zip(arrays, schema)], schema=schema)

    rows = docs.select("doc_id", held_out("doc_id", folds, fold).alias("held_out"), "text")
    return rows.mapInArrow(score, "doc_id long, held_out boolean, lang_pred string, score double")


def accepted(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Rows of ``docs``, with all their columns, whose language is known with score ``least`` or more.

    Nulls, repeated rows and empty tables count as in ``predict``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in bounded(batches, "text"):
            known = [shared.value.predict(text.as_py()) for text in batch.column("text")]
            yield batch.filter(pa.array([g != UNKNOWN and p >= least for g, p in known], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
