"""A training corpus from the documents, in five stages.

Each stage reads what its predecessor kept and returns the columns of the documents; the last one
returns what it has made of them. Between stages the documents are written as Parquet and read
again, so a lost executor costs no more than a part of one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.exact import exact_dedup
from clickloom.llm.frames import table, written
from clickloom.llm.mixing import mix, words
from clickloom.llm.pieces import encode_pieces, read_model
from clickloom.llm.quality import fit, with_score
from clickloom.llm.queries import PIECES, WEIGHTS, levels
from clickloom.llm.simhash import near_groups

# Of the tokens that are left by then, the mixture takes this share, no document twice.
SHARE = 0.95


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It is learned from all labels."""
    ranking = fit(docs, table(spark, sf_dir, "labels"))
    columns = docs.columns
    scored = with_score(docs, ranking, target="_score")
    return scored.where("_score >= 0.5").select(*columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    others = near_groups(docs).where("doc_id <> component_id").select("doc_id")
    return docs.join(others, "doc_id", "left_anti")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by the target weights of domains, languages and sources."""
    return mix(docs, levels(), WEIGHTS, SHARE, words("text")).select(*docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether they decode to its text again."""
    model = read_model(public_tokenizers.path(PIECES))
    docs = docs.select("doc_id", "lang", "source", "text")
    return encode_pieces(docs, model, decoded="decoded").select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("bigint").alias("n_tokens"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("decodes"),
    )


STAGES = [
    ("quality", quality), ("exact", exact), ("near", near), ("mixture", mixture),
    ("pieces", pieces),
]

# The quality classifier is learned and pieces are merged, neither of which SQL can express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
