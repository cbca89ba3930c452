"""Quality of texts by attention-based multiple-instance learning.

A text is a bag of passages and only the bag has a label. Every passage is
encoded by a small layer; a gated attention (the product of a tanh and a sigmoid
branch) weighs the passages against each other, and a logistic unit scores the
weighted sum of their encodings. All parts are learned together from document
labels by gradient descent.

Learning uses at most ``train_rows`` labelled rows of ids in the table, the first in order of a hash
of their ids; this is the bound on what reaches the driver (its passages as
numbers, no texts). Scoring reads every whole text once, without a shuffle.

Null or empty texts are one empty passage and get a score as well. Rows with a null
id are scored, count as not held out, and are never learned from; labels that
are null or of unknown ids are ignored, those of repeated ids count each. Without usable
labels every score is one half and the model is not ``learned``. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellindex.llm.passages import N_FEATURES, measure
from cellindex.llm.shared import columns_of, slices


@dataclass(frozen=True)
class Settings:
    train_rows: int = 6000
    passage_words: int = 64
    hidden: int = 24
    attention: int = 12
    epochs: int = 40
    batch: int = 128
    rate: float = 0.01
    decay: float = 1e-4
    seed: int = 7


def held_out(key: Column) -> Column:
    """Whether a row's id puts it in the held-out part: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Model:
    """Passage encoder, gated attention and scorer, as plain arrays."""

    def __init__(self, settings: Settings):
        self.passage_words = settings.passage_words
        #: Whether there was something to learn from.
        self.learned = False
        draw = np.random.default_rng(settings.seed)

        def matrix(a: int, b: int) -> np.ndarray:
            return (draw.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)

        h, k = settings.hidden, settings.attention
        self.mean, self.scale = np.zeros(N_FEATURES, np.float32), np.ones(N_FEATURES, np.float32)
        self.parts = {
            "encode": matrix(N_FEATURES, h), "encode0": np.zeros(h, np.float32),
            "tanh": matrix(h, k), "gate": matrix(h, k), "attend": matrix(k, 1)[:, 0],
            "score": np.zeros(h, np.float32), "score0": np.zeros(1, np.float32),
        }

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict:
        """``first`` numbers the first passage of each bag; bags are not empty."""
        p = self.parts
        size = np.diff(np.append(first, len(x)))
        h = np.tanh(x @ p["encode"] + p["encode0"])
        t, g = np.tanh(h @ p["tanh"]), _sigmoid(h @ p["gate"])
        e = (t * g) @ p["attend"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, first), size))
        a = e / np.repeat(np.add.reduceat(e, first), size)
        z = np.add.reduceat(h * a[:, None], first)
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "size": size, "y": _sigmoid(z @ p["score"] + p["score0"][0])}

    def gradients(self, x: np.ndarray, first: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        p, f = self.parts, self.forward(x, first)
        off = ((f["y"] - label) / len(label)).astype(np.float32)
        dz = off[:, None] * p["score"]
        each = np.repeat(dz, f["size"], axis=0)
        da = (each * f["h"]).sum(axis=1)
        de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, first), f["size"]))
        dt = de[:, None] * p["attend"] * f["g"] * (1 - f["t"] ** 2)
        dg = de[:, None] * p["attend"] * f["t"] * f["g"] * (1 - f["g"])
        dh = each * f["a"][:, None] + dt @ p["tanh"].T + dg @ p["gate"].T
        du = dh * (1 - f["h"] ** 2)
        return {
            "encode": x.T @ du, "encode0": du.sum(axis=0), "tanh": f["h"].T @ dt, "gate": f["h"].T @ dg,
            "attend": (f["t"] * f["g"]).T @ de, "score": f["z"].T @ off, "score0": off.sum(keepdims=True),
        }

    def learn(self, x: np.ndarray, size: np.ndarray, label: np.ndarray, settings: Settings) -> None:
        self.learned = True
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + np.float32(0.02)
        x = (x - self.mean) / self.scale
        first = np.cumsum(size) - size
        draw = np.random.default_rng(settings.seed)
        m1 = {k: np.zeros_like(v) for k, v in self.parts.items()}
        m2 = {k: np.zeros_like(v) for k, v in self.parts.items()}
        step, steps = 0, settings.epochs * -(-len(label) // settings.batch)
        for _ in range(settings.epochs):
            order = draw.permutation(len(label))
            for i in range(0, len(order), settings.batch):
                bags = order[i : i + settings.batch]
                rows = np.concatenate([np.arange(first[b], first[b] + size[b]) for b in bags])
                own = np.cumsum(size[bags]) - size[bags]
                step += 1
                rate = settings.rate * (1 - step / (steps + 1))
                for k, d in self.gradients(x[rows], own, label[bags]).items():
                    d = d + settings.decay * self.parts[k]
                    m1[k] += 0.1 * (d - m1[k])
                    m2[k] += 0.01 * (d * d - m2[k])
                    fit = (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-8)
                    self.parts[k] -= (rate * fit).astype(np.float32)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        x, size = measure(texts, self.passage_words)
        return self.forward((x - self.mean) / self.scale, np.cumsum(size) - size)["y"].astype(np.float64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text"
) -> Model:
    """Learn from labelled rows that are not held out; ``labels`` has the key and ``quality`` (0 or 1)."""
    marks = labels.select(labels[key].alias("marked_id"), labels["quality"].cast("int").alias("quality"))
    marks = marks.dropna().filter("quality IN (0, 1)").filter(~held_out(F.col("marked_id")))
    # Labels of other ids take no places of the sample.
    marks = marks.join(docs.select(docs[key].alias("doc_id")), F.col("doc_id") == F.col("marked_id"), "left_semi")
    order = F.md5(F.col("marked_id").cast("string"))
    # At most train_rows ids are broadcast, whatever the corpus.
    chosen = F.broadcast(marks.orderBy(order, "quality").limit(settings.train_rows))
    texts = docs.select(docs[key].alias("doc_id"), docs[text].alias("text")).join(
        chosen, F.col("doc_id") == F.col("marked_id")
    )
    words = settings.passage_words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x, size = measure(batch.column("text").to_pylist(), words)
            first = np.cumsum(size) - size
            raw = [x[f : f + n].tobytes() for f, n in zip(first, size)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.string()), pa.array(raw, pa.binary()), batch.column("quality")],
                names=["doc_id", "passages", "quality"],
            )

    bags = texts.select("doc_id", "text", "quality").mapInArrow(run, "doc_id string, passages binary, quality int")
    # A document that repeats an id is learned from once; order and number of rows are then fixed.
    bags = bags.groupBy("doc_id", "quality").agg(F.min("passages").alias("passages")).toArrow()
    bags = bags.sort_by([("doc_id", "ascending"), ("quality", "ascending")])
    label = bags["quality"].to_numpy().astype(np.float32)
    model = Model(replace(settings))
    if len(label) and 0 < label.mean() < 1:
        raw = bags["passages"].to_pylist()
        x = np.frombuffer(b"".join(raw), np.float32).reshape(-1, N_FEATURES)
        model.learn(x, np.array([len(r) // (4 * N_FEATURES) for r in raw]), label, settings)
    return model


def score(
    docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", keep: bool = False, name: str = "score"
) -> DataFrame:
    """``doc_id`` and score of every row or, with ``keep``, all columns and the score (replacing one of its name)."""
    if keep:
        kept = docs.drop(name).schema
        columns = columns_of(docs.drop(name))
    else:
        kept = docs.select(docs[key].alias("doc_id")).schema
        columns = [docs[key]]
    schema = type(kept)([*kept.fields]).add(name, "double")
    # Plain names for the way through Python; those of the table come back with the schema.
    plain = docs.select(docs[text].alias("text"), *[c.alias(f"c{k}") for k, c in enumerate(columns)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = model.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(out)], names=schema.fieldNames())

    return plain.mapInArrow(run, schema)


def judge(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = 0.7, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: id, whether it is held out, score, and 1 if the score reaches the threshold."""
    scored = score(docs, train(docs, labels, settings, key, text), key, text)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
