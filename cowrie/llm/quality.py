"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` characters.  Each passage is encoded by
figures of its text and a learned layer; gated attention weighs the passages; a logistic
output scores their weighted sum.  Layer, attention and output are learned together
from document labels alone (Ilse et al., 2018), with Adam on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cowrie.llm.ngrams import slices
from cowrie.llm.training import held_out, sampled

PASSAGE = 400
#: Labelled documents of each label that the model is learned from.
SAMPLE_EACH = 2_000
HIDDEN, ATTENTION, EPOCHS, BATCH, RATE, DECAY = 24, 12, 12, 32, 5e-3, 1e-4


def _classes() -> np.ndarray:
    """A class for each code below 256: kinds of letters, digits and spaces, each other ASCII mark by itself."""
    table = np.zeros(257, np.int64)
    mark = 7
    for code in range(256):
        c = chr(code)
        if c == "\n":
            table[code] = 1
        elif c.isspace():
            table[code] = 2
        elif c.isdigit():
            table[code] = 3
        elif c.islower():
            table[code] = 4
        elif c.isupper():
            table[code] = 5
        elif code < 128 and c.isprintable():
            table[code] = mark
            mark += 1
        else:
            table[code] = 6
    table[256] = 4  # beyond Latin-1: counted as letters
    return table


CLASS_OF = _classes()
CLASSES = int(CLASS_OF.max()) + 1
FIGURES = CLASSES + 5


def passages(text: str | None) -> np.ndarray:
    """Figures of each passage of a whole text, one row each; null and empty texts are one row of zeros."""
    if not text:
        return np.zeros((1, FIGURES), np.float32)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    n = -(-len(codes) // PASSAGE)
    kind = CLASS_OF[np.minimum(codes, 256)]
    shares = np.bincount(np.arange(len(codes)) // PASSAGE * CLASSES + kind, minlength=n * CLASSES)
    sizes = np.full(n, PASSAGE)
    sizes[-1] = len(codes) - (n - 1) * PASSAGE
    out = np.empty((n, FIGURES), np.float32)
    # roots lift rare marks to the size of common letters
    out[:, :CLASSES] = np.sqrt(shares.reshape(n, CLASSES) / sizes[:, None])
    for k in range(n):
        words = text[k * PASSAGE : (k + 1) * PASSAGE].split()
        distinct = len(set(words))
        again = sum(map(str.__eq__, words, words[1:]))
        out[k, CLASSES:] = (
            1.0,
            sizes[k] / PASSAGE,
            distinct / len(words) if words else 0.0,
            again / len(words) if words else 0.0,
            sum(map(len, words)) / len(words) / 10 if words else 0.0,
        )
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """``encode`` figures → representation, ``tanh`` and ``gate`` its attention, ``out`` the score."""

    encode: np.ndarray
    tanh: np.ndarray
    gate: np.ndarray
    attend: np.ndarray
    out: np.ndarray

    @classmethod
    def fresh(cls) -> Model:
        random = np.random.default_rng(0)

        def draw(*shape: int) -> np.ndarray:
            return random.normal(0, 1 / np.sqrt(shape[0]), shape)

        return cls(
            draw(FIGURES, HIDDEN), draw(HIDDEN, ATTENTION), draw(HIDDEN, ATTENTION), draw(ATTENTION), draw(HIDDEN + 1)
        )

    def forward(self, x: np.ndarray, begins: np.ndarray) -> dict[str, np.ndarray]:
        """Bags of passages ``x``, each from one of ``begins`` to the next."""
        bag = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(x))))
        h = np.tanh(x @ self.encode)
        t, g = np.tanh(h @ self.tanh), _sigmoid(h @ self.gate)
        e = (t * g) @ self.attend
        e = np.exp(e - np.maximum.reduceat(e, begins)[bag])
        a = e / np.add.reduceat(e, begins)[bag]
        z = np.add.reduceat(a[:, None] * h, begins)
        return {"bag": bag, "h": h, "t": t, "g": g, "a": a, "z": z, "p": _sigmoid(z @ self.out[:-1] + self.out[-1])}

    def score(self, text: str | None) -> float:
        return float(self.forward(passages(text), np.array([0]))["p"][0])

    def gradients(self, x: np.ndarray, begins: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        f = self.forward(x, begins)
        bag, h, t, g, a = f["bag"], f["h"], f["t"], f["g"], f["a"]
        error = weight * (f["p"] - y) / len(y)
        d_out = np.append(error @ f["z"], error.sum())
        d_z = error[:, None] * self.out[:-1]
        d_a = (h * d_z[bag]).sum(1)
        d_e = a * (d_a - np.add.reduceat(a * d_a, begins)[bag])
        d_t, d_g = d_e[:, None] * self.attend * g, d_e[:, None] * self.attend * t
        d_t, d_g = d_t * (1 - t * t), d_g * g * (1 - g)
        d_h = a[:, None] * d_z[bag] + d_t @ self.tanh.T + d_g @ self.gate.T
        d_x = d_h * (1 - h * h)
        return [x.T @ d_x, h.T @ d_t, h.T @ d_g, (t * g).T @ d_e, d_out]


def learn(bags: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> Model:
    """Adam over batches of bags in a fixed random order."""
    model = Model.fresh()
    parameters = [model.encode, model.tanh, model.gate, model.attend, model.out]
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    random, step = np.random.default_rng(1), 0
    for _ in range(EPOCHS):
        order = random.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            x = np.concatenate([bags[i] for i in rows])
            begins = np.cumsum([0, *(len(bags[i]) for i in rows[:-1])])
            step += 1
            for p, m, v, d in zip(parameters, first, second, model.gradients(x, begins, y[rows], weight[rows])):
                d = d + DECAY * p
                m += 0.1 * (d - m)
                v += 0.001 * (d * d - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 3, fold: int = 1, each: int = SAMPLE_EACH
) -> Model:
    """Learns ``labels.<label>`` (0 or 1) from the texts of labelled rows outside the held-out fold.

    Other labels, null ids and labels without a document teach nothing.  An empty table
    gives a model that hasn't learned anything; its scores are between 0 and 1 all the same.
    """
    allowed = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & ~held_out("doc_id", folds, fold)
    )
    drawn = sampled(allowed, "doc_id", "label", each)
    # at most about 2 * each rows of three numbers, whatever the size of the tables
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    schema = pa.schema([
        ("doc_id", pa.int64()), ("label", pa.int32()), ("weight", pa.float64()), ("figures", pa.list_(pa.float32())),
    ])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in slices(batches):
            figures = [passages(t).ravel() for t in columns["text"]]
            arrays = [columns["doc_id"], columns["label"], columns["weight"], figures]
            yield pa.RecordBatch.from_arrays([pa.array(a, f.type) for a, f in zip(arrays, schema)], schema=schema)

    table = rows.select("doc_id", "label", "weight", "text").mapInArrow(
        features, "doc_id long, label int, weight double, figures array<float>"
    ).toArrow()
    y, weight = table["label"].to_numpy().astype(float), table["weight"].to_numpy()
    if len(y) == 0:
        return Model.fresh()
    order = np.lexsort((y, table["doc_id"].to_numpy()))
    lists = table["figures"].combine_chunks()
    bags = [lists[i].values.to_numpy().reshape(-1, FIGURES) for i in order.tolist()]
    return learn(bags, y[order], (weight / weight.mean())[order])


def predict(docs: DataFrame, model: Model, folds: int = 3, fold: int = 1) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; only the text is looked at."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in slices(batches):
            arrays = [columns["doc_id"], columns["held_out"], [shared.value.score(t) for t in columns["text"]]]
            yield pa.RecordBatch.from_arrays([pa.array(a, f.type) for a, f in zip(arrays, schema)], schema=schema)

    rows = docs.select("doc_id", held_out("doc_id", folds, fold).alias("held_out"), "text")
    scored = rows.mapInArrow(score, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
