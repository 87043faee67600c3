"""The driver's queries of this subpackage: thin applications of the operators to whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import chat, jaccard, warc
from .common import table


def op1_ngram_jaccard(spark, sf_dir):
    from .jaccard import groups

    return groups(table(spark, sf_dir, "documents")).drop("rid", "component")


def op2_html_extraction(spark, sf_dir):
    from .html import extract

    return extract(table(spark, sf_dir, "pages"))


def op3_best_fit_packing(spark, sf_dir):
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"))


def op4_token_counts(spark, sf_dir):
    from .tokens import token_counts

    return token_counts(table(spark, sf_dir, "documents"))


def op5_warc(spark, sf_dir):
    from .warc import round_trip

    return round_trip(table(spark, sf_dir, "pages"))


def op6_language_id(spark, sf_dir):
    from .langid import fit, identify

    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))


def op7_quality_rules(spark, sf_dir):
    from .quality import judge

    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_byte_bpe(spark, sf_dir):
    from .bpe import round_trip

    return round_trip(table(spark, sf_dir, "documents"))


def op9_chat_formatting(spark, sf_dir):
    from .chat import TRICKY, digest

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).selectExpr("-7L as conv_id", "id as turn", "if(id = 0, 'user', 'assistant') as role").withColumn("text", F.lit(TRICKY))
    return digest(rows.unionByName(more))


def op10_nearest_neighbours(spark, sf_dir):
    from .ann import search

    rows = table(spark, sf_dir, "embeddings")
    return search(rows, rows.where("vec_id % 100 = 0"))


QUERIES = {f.__name__: f for f in (op1_ngram_jaccard, op2_html_extraction, op3_best_fit_packing, op4_token_counts, op5_warc, op6_language_id, op7_quality_rules, op8_byte_bpe, op9_chat_formatting, op10_nearest_neighbours)}

ORACLES: dict[str, str] = {"op1_ngram_jaccard": jaccard.ORACLE, "op5_warc": warc.ORACLE, "op9_chat_formatting": chat.ORACLE}
