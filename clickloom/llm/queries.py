"""The registered queries of this folder; `queries()` and `oracle_sql()` name them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.exact import exact_groups
from clickloom.llm.frames import sha256_hex, table
from clickloom.llm.mixing import mix, words
from clickloom.llm.passages import repeated_passages
from clickloom.llm.pieces import encode_pieces, read_model
from clickloom.llm.quality import fit, with_score
from clickloom.llm.ranked import ranked_documents
from clickloom.llm.repair import repaired, summaries
from clickloom.llm.repeats import remove_repeats
from clickloom.llm.secrets import BASE, as_text, find_secrets, of_kinds
from clickloom.llm.shards import interleaved_shards
from clickloom.llm.simhash import near_groups
from clickloom.llm.statements import STATEMENTS
from clickloom.llm.topk import top_k
from clickloom.llm.toxicity import toxicity

SHARDS = 16
PIECES = "piece_bpe_32k.model"


def op1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = read_model(public_tokenizers.path(PIECES))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_pieces(docs, model, decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        sha256_hex(F.concat_ws(",", F.col("ids").cast("array<string>"))).alias("ids_sha256"),
        sha256_hex("decoded").alias("decoded_sha256"),
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def held_out() -> F.Column:
    """The documents whose labels are not learned from."""
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranking = fit(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return with_score(docs, ranking).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def domain(source: str = "source") -> F.Column:
    """The test tables name no domain: sources are put into four by the number they end in."""
    number = F.regexp_extract(source, r"(\d+)$", 1).cast("bigint")
    return F.concat(F.lit("domain"), F.coalesce(number % 4, F.lit(0)).cast("string"))


def levels() -> dict[str, F.Column]:
    return {"domain": domain(), "lang": F.col("lang"), "source": F.col("source")}


WEIGHTS = {
    "domain": {"domain0": 0.4, "domain1": 0.3, "domain2": 0.2, "domain3": 0.1},
    "lang": {"en": 0.55, "fr": 0.15, "de": 0.15, "es": 0.15},
}


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mix(docs, levels(), WEIGHTS, 1.0, words("text"), max_epochs=3)
    return mixed.select("doc_id", "epoch", "lang", "source")


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.octet_length(data) + 1).cast("bigint").alias("size"),
        F.crc32(data).alias("text_crc32"),
    )
    return interleaved_shards(docs, SHARDS, by="source", id="doc_id").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_secrets(docs).select("doc_id", "secrets")
    return found.select(
        "doc_id",
        *[F.size(of_kinds("secrets", (k,))).cast("bigint").alias(f"n_{k}") for k in BASE],
        F.sha2(as_text(of_kinds("secrets", BASE)), 256).alias("base_sha256"),
        as_text(F.col("secrets")).alias("spans"),
    )


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = remove_repeats(docs)
    removed = F.aggregate(
        "removed", F.lit(0).cast("bigint"), lambda n, run: n + run["end"] - run["start"]
    )
    return found.select(
        "doc_id", (F.octet_length("kept") + removed).alias("n_bytes"),
        removed.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"), (removed > 0).alias("shortened"), "removed",
        # A cut may fall inside a character; what is left of it is replaced.
        F.make_valid_utf8(F.col("kept").cast("string")).alias("kept"),
    )


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_groups(table(spark, sf_dir, "documents"))
    fingerprint = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", fingerprint.alias("fingerprint"), "component_id")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity(docs, table(spark, sf_dir, "labels").where(~held)).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """The conversations with faults put in by a checksum of each row's place; `present` rows are left.

    A row of another table comes out once or twice; a dropped one stays as a row that isn't present,
    so that its conversation is known.
    """
    place = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    text = F.coalesce("text", F.lit(" "))
    marked = conversations.select("conv_id", "turn", "role", "text", (F.crc32(place) % 20).alias("kind"))
    return marked.select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(F.col("kind") == 1, F.lit(""))
        .when(F.col("kind") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (F.col("kind") != 0).alias("present"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
    ).drop("col")


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(table(spark, sf_dir, "conversations"))
    return summaries(repaired(rows, present=F.col("present"))).withColumnRenamed("conv", "conv_id")


def op13_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict:
    return {q.__name__: q for q in (
        op1_pieces, op2_exact_dedup, op3_quality, op4_mixing, op5_shards, op6_secrets, op7_repeats,
        op8_topk, op9_passages, op10_simhash, op11_toxicity, op12_repair,
        op13_ranked,
    )}


def oracle_sql() -> dict[str, str]:
    return dict(STATEMENTS)
