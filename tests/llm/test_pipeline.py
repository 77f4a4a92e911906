"""The stages on a small folder, against plain versions of what they decide."""

import re
from collections import Counter, defaultdict

import corpus_pipeline as pipeline
import numpy as np
import public_tokenizers
import pytest
from llm_corpus import corpus, words
from pyspark.sql import functions as F
from test_near_dedup import expected as near_groups
from tokenizers import Tokenizer

from salesmart.llm.mixing import capped_targets
from salesmart.llm.toxicity import toxicity_scores, train

# Names that the stages use inside.
CLASHING = "doc_id BIGINT, text STRING, source STRING, copies INT, nth INT, toxicity STRING, Body_Sha256 STRING, place INT, gone INT"


def rows(n=200):
    chance = np.random.default_rng(4)
    found = []
    for doc_id, text, source, *_ in corpus(n):
        if doc_id is not None and doc_id % 9 == 4 and text:
            text += " horrid vileness nastier " + " ".join(chance.choice(["horrid", "nastier"], 3))
        found.append((doc_id, text, source, 1, 2, "t", "b", 3, 4))
    return found


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows(), CLASHING).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 9 == 4)) for i in range(200)]
    spark.createDataFrame(labels, "doc_id BIGINT, toxic INT").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_toxicity_drops_what_the_model_rejects(spark, folder, docs):
    kept = pipeline.toxicity(spark, docs, folder)
    assert kept.columns == docs.columns
    model = train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    scores = toxicity_scores(docs, model, column="s")
    assert Counter(kept.collect()) == Counter(scores.filter("s < 0.5").select(docs.columns).collect())
    gone = {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in kept.collect()}
    assert gone and all(i % 9 == 4 for i in gone if i is not None)


def test_exact_dedup_keeps_one_of_each(spark, folder, docs):
    kept = pipeline.exact_dedup(spark, docs, folder)
    assert kept.columns == docs.columns
    groups = defaultdict(list)
    for doc_id, text, *_ in rows():
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id))
    best = Counter((key, min(members)[2]) for key, members in groups.items())
    assert Counter((re.sub(r"[\x20\x09-\x0D]", "", r["text"] or ""), r["doc_id"]) for r in kept.collect()) == best


def test_near_dedup_keeps_one_of_each_group(spark, folder, docs):
    kept = pipeline.near_dedup(spark, docs, folder)
    assert kept.columns == docs.columns
    groups = near_groups(rows(), 5)
    wanted = Counter(r[0] for r in rows() if r[0] is None or groups[r[0]] == r[0])
    assert Counter(r["doc_id"] for r in kept.collect()) == wanted
    assert sum(wanted.values()) < len(rows())


def test_mixing_repeats_and_drops(spark, folder, docs):
    mixed = pipeline.mixing(spark, docs, folder)
    assert mixed.columns == docs.columns
    sizes, longest = Counter(), Counter()
    for _, text, source, *_ in rows():
        sizes[source] += len(words(text))
        longest[source] = max(longest[source], len(words(text)))
    targets = capped_targets(sizes, pipeline.MIX_WEIGHTS, 1.5, 2)
    taken = Counter()
    for r in mixed.collect():
        taken[r["source"]] += len(words(r["text"]))
    for source, target in targets.items():
        assert abs(taken[source] - target) <= longest[source] + 1
    given = Counter(map(tuple, docs.collect()))
    assert all(n <= 2 * given[row] for row, n in Counter(map(tuple, mixed.collect())).items())


def test_all_stages(spark, folder):
    pieces = pipeline.run(spark, folder)
    again = pipeline.run(spark, folder)
    assert Counter(pieces.drop("sequence_id", "offset").collect()) == Counter(again.drop("sequence_id", "offset").collect())
    assert pieces.agg(F.max("length")).first()[0] <= pipeline.SEQUENCE_TOKENS
    # Every document that is left has all its tokens, as often as the mix takes it.
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = defaultdict(set)
    for doc_id, text, *_ in rows():
        lengths[doc_id].add(len(library.encode(text or "", add_special_tokens=False).ids) + 1)
    total, starts = Counter(), Counter()
    for r in pieces.collect():
        total[r["doc_id"]] += r["length"]
        starts[r["doc_id"]] += r["start"] == 0
    assert total and all(total[i] in {n * starts[i] for n in lengths[i]} for i in total if len(lengths[i]) == 1)
    assert set(starts.values()) <= {1, 2, 3, 4}


def test_empty_tables(spark, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame([], CLASHING).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id BIGINT, toxic INT").write.parquet(f"{path}/labels.parquet")
    assert pipeline.run(spark, path).count() == 0
