"""A corpus through five of the training-data operators, as one job.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and reread as the next
one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimspark.llm import line_templates, mixing, near_dedup, packing, quality_rules
from claimspark.llm.common import DOCUMENT_COLUMNS, read, text_key
from claimspark.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a learned rule go."""
    rules = quality_rules.learn_rules(docs, read(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, rules).where("kept").select("row.*").select(*DOCUMENT_COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of recurring line templates go from the texts; a document
    goes if no word of it is left."""
    kept = line_templates.drop_templates(docs).where((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    text = F.col("text")
    return kept.select("row.doc_id", text, "row.lang", "row.source",
                       F.when(F.col("n_dropped") == 0, F.col("row.n_chars")).otherwise(F.length(text)).cast("long").alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the
    smallest doc_id (of five-word shingles, from a similarity of 0.8 on)."""
    found = near_dedup.near_duplicates(docs).where(~F.col("kept")) \
        .select(F.col("doc_id").alias("gone_id"), F.col("key").alias("gone_key")).distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found["gone_id"]) & (text_key(docs["text"]) == found["gone_key"]), "left_anti") \
        .select(*DOCUMENT_COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled so that sources, languages and topics reach their shares."""
    return mixing.calibrated(docs).where("sampled").select("row.*").select(*DOCUMENT_COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs)


STAGES = [("quality_rules", quality), ("line_dedup", line_dedup), ("near_dedup", near_duplicates), ("mixing", mixture),
          ("packing", packed)]

#: The first stage learns its rules, which SQL cannot express; tests/llm/test_pipeline.py
#: compares each stage with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
