"""From raw documents to packed training sequences, stage by stage.

Each stage takes the documents its predecessor kept, with all their columns, and
is written before the next one reads it. Rows repeat where the mix repeats them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.llm.exact_dedup import exact_duplicates, normalised
from salesmart.llm.mixing import mixed, word_count
from salesmart.llm.near_dedup import NearSettings, near_duplicates
from salesmart.llm.packing import packed_sequences
from salesmart.llm.tables import Workspace
from salesmart.llm.toxicity import toxicity_scores, train

# Documents scored as likely toxic or likelier go.
TOXIC_FROM = 0.5
# Shares of the sources in code-point order, repeating.
MIX_WEIGHTS = (3, 1, 2)
SEQUENCE_TOKENS = 1024


def unused(df: DataFrame, name: str) -> str:
    """``name``, or it with underscores, so that it is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that a classifier, learnt from all labels, scores as toxic.

    A null text is scored as an empty one. Without labels every document stays.
    """
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = unused(docs, "toxicity")
    return toxicity_scores(docs, model, column=score).filter(F.col(score) < TOXIC_FROM).drop(score)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of texts that are equal but for white space.

    Rows that also repeat a ``doc_id`` are told apart by nothing else that matters:
    the longest of them stays, or any of the longest.
    """
    work = Workspace(spark, "pipeline-exact")
    judged = work.stored(exact_duplicates(docs).select("doc_id", "text_sha256", "kept"), "judged")
    body, place = unused(docs, "body_sha256"), unused(docs, "place")
    keys = judged.filter("kept").select(F.col("text_sha256").alias(body), F.col("doc_id").alias(f"{body}_doc"))
    repeated = work.stored(
        judged.groupBy(F.col("text_sha256").alias(body), F.col("doc_id").alias(f"{body}_doc")).count().filter("count > 1").drop("count"),
        "repeated",
    )
    rows = docs.withColumn(body, F.sha2(normalised().cast("binary"), 256))

    def same_key(other: DataFrame):
        return (rows[body] == other[body]) & rows["doc_id"].eqNullSafe(other[f"{body}_doc"])

    kept = rows.join(keys, same_key(keys), "left_semi")
    if repeated.isEmpty():
        return kept.drop(body)
    longest = Window.partitionBy(body, "doc_id").orderBy(F.length("text").desc_nulls_last())
    several = kept.join(repeated, same_key(repeated), "left_semi").withColumn(place, F.row_number().over(longest))
    return kept.join(repeated, same_key(repeated), "left_anti").unionByName(several.filter(F.col(place) == 1).drop(place)).drop(body)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: five words, similarity 0.8.

    Documents without an id or without words stay.
    """
    work = Workspace(spark, "pipeline-near")
    gone = work.stored(near_duplicates(docs, NearSettings(words=5)).filter("not kept").select(F.col("doc_id").alias("gone")).distinct(), "gone")
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as a mix of the sources to ``MIX_WEIGHTS`` takes it: 0 to 2 times."""
    work = Workspace(spark, "pipeline-mix")
    mix = mixed(docs, F.array("source"), word_count(), MIX_WEIGHTS)
    taken = work.stored(
        mix.filter("copies > 0")
        .select(F.col("doc_id").alias("mixed_doc"), F.element_at("pattern", 1).alias("mixed_source"), "copies")
        .distinct(),
        "taken",
    )
    copies = unused(docs, "copies")
    taken = taken.withColumnRenamed("copies", copies)
    on = docs["doc_id"].eqNullSafe(taken["mixed_doc"]) & docs["source"].eqNullSafe(taken["mixed_source"])
    both = docs.join(taken, on).select(*[docs[f"`{c}`"] for c in docs.columns], copies)
    nth = unused(both, "nth")
    return both.withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).drop(copies, nth)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences."""
    return packed_sequences(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=SEQUENCE_TOKENS)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# No SQL: the classifier and the tokenizer have none.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    work = Workspace(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = work.stored(stage(spark, docs, sf_dir), name)
        if before:
            work.drop(before)
        before = name
    return docs
