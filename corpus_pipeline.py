"""From raw documents to packed training sequences: language, quality, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next stage's docs. All but
the last return the documents they keep, with all their columns. Empty tables pass through; null and empty texts, having no
letter, go in the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from causeway.llm import common, jaccard, langid, packing, quality


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages of the corpus."""
    return langid.keep_known(docs, langid.fit(docs))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the trees fitted to the labels."""
    return quality.keep_good(docs, common.table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of smallest id."""
    return jaccard.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences."""
    return packing.pack(docs)


STAGES = [("language ID", known_language), ("quality rules", good_quality), ("n-gram Jaccard join", one_of_each_group), ("best-fit packing", packed)]

#: Language models, trees and tokenisers cannot be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
