"""Sparse logistic models on hashed presence features, trained by FTRL-proximal."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Features = Callable[[bytes], np.ndarray]


@dataclass(frozen=True)
class Settings:
    """Learning rates per coordinate (``alpha``, ``beta``), penalties and passes."""

    bits: int = 18
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.01
    passes: int = 5
    # Rows the model may be fitted on; a documented bound, the fitting is one task.
    max_rows: int = 12_000


@dataclass(frozen=True)
class Model:
    """Bias and non-zero weights; at most ``2**bits`` of them, so always broadcastable."""

    bits: int
    bias: float
    index: np.ndarray
    weight: np.ndarray

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits)
        out[self.index] = self.weight
        return out


def score(dense: np.ndarray, bias: float, features: np.ndarray) -> float:
    weights = dense[features]
    used = np.unique(features[weights != 0])
    return float(1 / (1 + np.exp(-np.clip(bias + dense[used].sum(), -30, 30))))


def ftrl(rows: list[tuple[float, np.ndarray]], s: Settings) -> tuple[float, np.ndarray]:
    """Bias and dense weights from (target in 0..1, distinct feature indices) rows."""
    z, n = np.zeros(1 << s.bits), np.zeros(1 << s.bits)
    positive = sum(y for y, _ in rows)
    # Without rows one document in ten is taken for positive.
    bias, bias_n = float(np.log((positive + 1) / (len(rows) - positive + 9))), 1.0
    for _ in range(s.passes):
        for y, at in rows:
            zi, ni = z[at], n[at]
            root = np.sqrt(ni)
            w = np.where(np.abs(zi) <= s.l1, 0.0, -(zi - np.sign(zi) * s.l1) / ((s.beta + root) / s.alpha + s.l2))
            p = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -30, 30)))
            g = p - y
            z[at] = zi + g - (np.sqrt(ni + g * g) - root) / s.alpha * w
            n[at] = ni + g * g
            bias -= s.alpha * g / (s.beta + np.sqrt(bias_n))
            bias_n += g * g
    root = np.sqrt(n)
    weights = np.where(np.abs(z) <= s.l1, 0.0, -(z - np.sign(z) * s.l1) / ((s.beta + root) / s.alpha + s.l2))
    return bias, weights


def fit(sample: DataFrame, features: Features, s: Settings) -> Model:
    """A model from ``sample(place, target, text)``, of ``s.max_rows`` rows at most.

    Features are hashed where the texts lie; one task then learns from them in the
    order of ``place``, so that reruns give the same weights.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.unique(features(t or b"")) for t in batch.column(2).to_pylist()]
            out = pa.array(lists, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], out], names=["place", "target", "features"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            lists = batch.column(2)
            flat, ends = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())
            places, targets = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows += list(zip(places, targets, np.split(flat, ends[:-1]), strict=True))
        rows.sort(key=lambda r: (r[0], r[1]))
        bias, weights = ftrl([(y, at) for _, y, at in rows], s)
        used = np.flatnonzero(weights)
        index = np.concatenate(([-1], used))
        yield pa.RecordBatch.from_arrays(
            [pa.array(index), pa.array(np.concatenate(([bias], weights[used])))], names=["index", "weight"]
        )

    rows = sample.select("place", F.col("target").cast("double").alias("target"), F.col("text").cast("binary"))
    rows = rows.mapInArrow(hashed, "place string, target double, features array<int>")
    learned = rows.repartition(1).mapInArrow(learn, "index long, weight double").toPandas()
    parts = learned.sort_values("index")
    return Model(s.bits, float(parts["weight"].iloc[0]), parts["index"].to_numpy()[1:], parts["weight"].to_numpy()[1:])


def scored(
    docs: DataFrame, keep: list[str], text_column: str, model: Model, features: Features, name: str
) -> DataFrame:
    """Columns ``keep`` of ``docs`` and the score of every whole text as the double ``name``."""
    # Broadcast values are pickled by name, so plain arrays are sent.
    shared = docs.sparkSession.sparkContext.broadcast((model.bits, model.bias, model.index, model.weight))
    inner = [f"c{i}" for i in range(len(keep))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        dense = model.dense()
        for batch in batches:
            values = [score(dense, model.bias, features(t or b"")) for t in batch.column(len(inner)).to_pylist()]
            columns = [*batch.columns[:-1], pa.array(values, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*inner, "score"])

    kept = docs.select(*[F.col(f"`{k}`").alias(i) for k, i in zip(keep, inner, strict=True)],
                       F.col(f"`{text_column}`").cast("binary").alias("bytes"))
    schema = T.StructType(kept.schema.fields[:-1]).add("score", "double")
    return kept.mapInArrow(work, schema).toDF(*keep, name)
