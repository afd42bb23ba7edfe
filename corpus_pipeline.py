"""From raw documents to token ids: the operators of ``tallgrain.llm`` one after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tallgrain.llm import bpe, mixing, quality, queries, simhash, suffix
from tallgrain.llm.common import table, written
from tallgrain.session import tune


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt from the labels, gives at least 0.5."""
    model = quality.fit_on_labels(docs, table(spark, sf_dir, "labels"))
    return model.score(docs, score="_score").where("_score >= 0.5").drop("_score")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each SimHash group."""
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that stand in an earlier one."""
    return suffix.remove_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Four fifths of the words, at the target weights; nothing is taken twice."""
    return mixing.mix(docs, queries.tree(), budget_share=0.8, max_epochs=1).drop("epoch")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the bytes they decode to."""
    return bpe.digests(docs, *queries.rank_file(), with_ids=True)


#: (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame.
STAGES = [
    ("quality", drop_low_quality),
    ("simhash", drop_near_copies),
    ("repeats", cut_repeats),
    ("mix", mix_sources),
    ("bpe", encode),
]

#: The stages learn models and build suffix arrays, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = table(tune(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
