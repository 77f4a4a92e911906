import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmart.llm.queries import QUERIES
from salesmart.llm.toxicity import ToxicityModel, ToxicitySettings, features, fold, toxicity_scores, train


def labelled(spark, n=400):
    chance = np.random.default_rng(1)
    plain = [f"word{i}" for i in range(200)]
    bad = ["horrid", "vileness", "nastier"]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        text = list(chance.choice(plain, 40)) + (list(chance.choice(bad, 4)) if toxic else [])
        chance.shuffle(text)
        docs.append((i, " ".join(text), "x"))
        labels.append((i, int(toxic)))
    labels += [(None, 1), (3, None), (10**9, 1), (0, 1)]
    docs += [(n, None, "x"), (n + 1, "", "x"), (None, "horrid vileness", "x"), (0, docs[0][1], "x")]
    return spark.createDataFrame(docs, "doc_id BIGINT, text STRING, score STRING"), spark.createDataFrame(labels, "doc_id BIGINT, toxic INT")


def test_learns_the_words(spark):
    docs, labels = labelled(spark)
    model = train(docs, labels.filter(fold() != 0))
    rows = toxicity_scores(docs, model, column="toxicity").collect()
    assert len(rows) == docs.count() and rows[0]["score"] == "x"
    held = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 400 and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert sum((r["toxicity"] >= 0.5) == (r["doc_id"] % 5 == 0) for r in held) >= 0.97 * len(held)
    assert all(0 <= r["toxicity"] <= 1 for r in rows)
    assert next(r["toxicity"] for r in rows if r["doc_id"] is None) > 0.5


def test_score_is_the_scaled_linear_model(spark):
    settings = ToxicitySettings(ngram=3, bits=10)
    chance = np.random.default_rng(1)
    model = ToxicityModel(chance.normal(size=1024), chance.normal(size=1024), 0.3)
    text = "Some Text, some té xt"
    found = toxicity_scores(spark.createDataFrame([(1, text)], "doc_id INT, text STRING"), model, settings).first()["score"]
    f = features(text, settings)
    x = model.ratios[f] / np.linalg.norm(model.ratios[f])
    assert found == pytest.approx(1 / (1 + np.exp(-(x @ model.weights[f] + 0.3))), abs=1e-5)


def test_without_labels_or_rows(spark, nothing):
    docs, labels = labelled(spark, 20)
    model = train(docs, labels.limit(0))
    assert toxicity_scores(docs, model).agg(F.max("score")).first()[0] < 1e-9
    one_sided = train(docs, labels.filter("toxic = 0"))
    assert toxicity_scores(docs, one_sided).filter("score >= 0.5").count() == 0
    assert toxicity_scores(nothing, model).count() == 0


def test_held_out_precision_on_the_given_tables(spark):
    folder = "/root/testdata/sf0.01"
    if not Path(folder).exists():
        pytest.skip("no test tables")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = QUERIES["op8_toxicity"](spark, folder).join(labels, "doc_id").collect()
    chosen = [r["toxic"] for r in rows if r["held_out"] and r["predicted"]]
    assert chosen and sum(chosen) >= 0.9 * len(chosen)
