"""Toxicity from character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.tables import Workspace, ship_package


class ToxicitySettings(NamedTuple):
    """ngram: characters (UTF-8 bytes) of a feature; bits: 2**bits features.
    most_labels: the labelled rows the classifier is fitted on, at most, chosen by a
    seeded hash of the id. shard_labels, shard_features: of those fitted in one task,
    and their features, about; the tasks' weights are averaged. steps, rate, decay: of the fit."""

    ngram: int = 5
    bits: int = 18
    most_labels: int = 12_000
    shard_labels: int = 2_000
    shard_features: int = 16_000_000
    steps: int = 60
    rate: float = 0.3
    decay: float = 1e-4
    seed: int = 17


class ToxicityModel(NamedTuple):
    """``ratios``: log-count ratio of each feature; ``weights`` of the scaled features; ``bias``."""

    ratios: np.ndarray
    weights: np.ndarray
    bias: float


def features(text: str | None, settings: ToxicitySettings) -> np.ndarray:
    """The distinct n-grams of the lower-cased text between blanks, hashed to ``bits`` bits."""
    raw = np.frombuffer(f" {(text or '').lower()} ".encode(), np.uint8)
    n = len(raw) - settings.ngram + 1
    if n < 1:
        return np.zeros(0, np.uint32)
    mixed = np.full(n, 0x811C9DC5, np.uint32)
    for j in range(settings.ngram):
        mixed = (mixed * np.uint32(0x01000193)) ^ raw[j : n + j]
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    mixed ^= mixed >> np.uint32(12)
    return np.unique(mixed >> np.uint32(32 - settings.bits))


def scale(ratios: np.ndarray) -> float:
    """A document's scaled features have length 1."""
    return 1 / np.sqrt(np.square(ratios).sum() + 1e-9)


def fit(found: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, settings: ToxicitySettings) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on the scaled features, by Adam."""
    flat = np.concatenate(found)
    row = np.repeat(np.arange(len(found), dtype=np.int32), [len(f) for f in found])
    value = (ratios[flat] * np.array([scale(ratios[f]) for f in found])[row]).astype(np.float32)
    # Both labels weigh the same in all.
    weight = np.where(labels > 0, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1))
    weights = np.zeros(len(ratios) + 1)
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, settings.steps + 1):
        margin = np.bincount(row, weights=weights[flat] * value, minlength=len(found)) + weights[-1]
        error = (1 / (1 + np.exp(-margin)) - labels) * weight
        slope = np.append(np.bincount(flat, weights=error[row] * value, minlength=len(ratios)), error.sum())
        slope[:-1] += settings.decay * weights[:-1]
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope * slope
        weights -= settings.rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return weights[:-1], float(weights[-1])


def fold(doc_id: str | Column = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id as text, mod ``folds``; null without an id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % folds


def train(documents: DataFrame, labels: DataFrame, settings: ToxicitySettings = ToxicitySettings()) -> ToxicityModel:
    """A model of ``labels`` (``doc_id``, ``toxic`` 0 or 1) on ``documents`` (``doc_id``, ``text``).

    Labels without an id or a value count for nothing; an id with several has their
    maximum. At most ``most_labels`` of them are used. Their documents are written
    aside, in one pass over all, and meet the workers in groups that are bounded by
    documents and by features: first each counts its n-grams by label, which gives
    the ratios, then each fits weights, which are averaged. The driver gets the chosen
    labels and three arrays of 2**bits numbers a group.
    """
    work = Workspace(documents.sparkSession, "toxicity")
    size = 1 << settings.bits
    chosen = (
        labels.filter("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64(F.lit(settings.seed), "doc_id"), "doc_id")
        .limit(settings.most_labels)
        .toPandas()
    )
    rows = len(chosen)
    chosen = documents.sparkSession.createDataFrame(chosen, labels.select("doc_id", "toxic").schema)
    # Bounded by most_labels.
    texts = work.stored(documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "sample")
    # A text has at most as many distinct features as bytes, and as there are features.
    most = F.least(F.coalesce(F.octet_length("text"), F.lit(0)) + 2, F.lit(size)).cast("long")
    total = texts.agg(F.sum(most)).first()[0] or 0
    shards = max(1, -(-rows // settings.shard_labels), -(-total // settings.shard_features))
    shard = F.pmod(F.xxhash64(F.lit(settings.seed + 1), "doc_id"), F.lit(shards))
    sample = texts.select(shard.alias("shard"), "toxic", "text")

    def counted(group: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros((2, size), np.int32)
        rows = np.zeros(2, np.int64)
        for text, label in zip(group["text"], group["toxic"], strict=True):
            counts[int(label > 0), features(text, settings)] += 1
            rows[int(label > 0)] += 1
        return pd.DataFrame({"clean": [counts[0].tobytes()], "toxic": [counts[1].tobytes()], "n": [rows.tolist()]})

    totals, rows = np.zeros((2, size)), np.zeros(2)
    for part in sample.groupBy("shard").applyInPandas(counted, "clean binary, toxic binary, n array<long>").collect():
        totals += [np.frombuffer(part["clean"], np.int32), np.frombuffer(part["toxic"], np.int32)]
        rows += part["n"]
    clean, toxic = np.log((totals + 1) / (rows + 2)[:, None])
    ratios = toxic - clean

    def fitted(group: pd.DataFrame) -> pd.DataFrame:
        found = [features(text, settings) for text in group["text"]]
        weights, bias = fit(found, (group["toxic"].to_numpy() > 0).astype(float), ratios, settings)
        return pd.DataFrame({"weights": [weights.astype(np.float32).tobytes()], "bias": [bias]})

    weights, bias, parts = np.zeros(size), 0.0, 0
    for part in sample.groupBy("shard").applyInPandas(fitted, "weights binary, bias double").collect():
        weights += np.frombuffer(part["weights"], np.float32)
        bias, parts = bias + part["bias"], parts + 1
    work.drop()
    return ToxicityModel(ratios, weights / max(parts, 1), bias / max(parts, 1) if parts else -np.inf)


def toxicity_scores(
    documents: DataFrame, model: ToxicityModel, settings: ToxicitySettings = ToxicitySettings(), column: str = "score"
) -> DataFrame:
    """All columns of ``documents`` and ``column``, from 0 to 1, higher for toxic.

    Every text is scored whole, a null one as empty. Without any labels to learn
    from, every score is 0. A column of that name is replaced. The model that tasks
    get has 2 * 2**bits numbers.
    """
    ship_package(documents.sparkSession)
    documents = documents.drop(column)
    ratios = model.ratios.astype(np.float32)
    weighted = (model.ratios * model.weights).astype(np.float32)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for i, text in enumerate(batch["text"]):
                found = features(text.as_py(), settings)
                margin = weighted[found].sum() * scale(ratios[found]) + model.bias
                scores[i] = 1 / (1 + np.exp(min(-margin, 700.0)))
            yield batch.append_column(column, pa.array(scores))

    schema = documents.withColumn(column, F.lit(0.0)).schema
    return documents.mapInArrow(scored, schema)
