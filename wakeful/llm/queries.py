"""The registered queries of this subpackage: one per operator, each over its whole
table, with the columns that the query's contract names."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeful.llm import alignment, exact, grammar, language, mixing, negatives, pieces, pii, quality, ring, simhash, toxicity, warc
from wakeful.llm.common import table, text_of


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, bits=2)
    return found.select("doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id")


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.mix(table(spark, sf_dir, "documents"), F.array("source"))
    return mixing.per_source(taken).select("doc_id", "size", "source_size", "target", "taken")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op4_warc_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    packages = warc.write_warc(table(spark, sf_dir, "pages"), least_bytes=0)
    return warc.read_warc(packages, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


LANGUAGES = ["de", "en", "es", "fr"]


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (host: their source; they declare nothing, their lang column is what
    the text model learns) and pages (host, suffix and markup as they are) in one
    result: ``doc_id`` or ``page_id`` is set."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    none = F.lit(None).cast("long")
    rows = docs.select("doc_id", none.alias("page_id"), "text", F.col("source").alias("host"), F.lit(None).cast("string").alias("declared")).union(
        pages.select(
            none.alias("doc_id"), "page_id", language.visible_text(text_of("html")), language.host_of(F.col("url")), language.declared_in(F.col("html"))
        )
    )
    return language.identify(rows, docs, LANGUAGES).select(
        "doc_id", "page_id", F.col("lang_found").alias("lang"), "confidence", "text_lang", "n_words"
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", *quality.BASE, "base_failed", "kept", "rule"
    )


def op7_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ring.assign_shards(table(spark, sf_dir, "documents"), shards=24)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op8_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels' two categories in a chain: low quality, then toxic."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    chain = toxicity.train_chain(docs, labels, ["low_quality", "toxic"])
    return toxicity.classify(docs, chain).select(
        "doc_id", "p_low_quality", F.col("p_toxic").alias("toxicity"), (F.col("p_toxic") >= 0.5).alias("toxic")
    )


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("word_bpe_49k.json")
    return grammar.read_ids(grammar.write_ids(table(spark, sf_dir, "documents"), model, end_id=2), digest=True)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.select("vec_id", "embedding", moved.alias("label")), "vec_id % 50 = 0")


def op12_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.cross_align(table(spark, sf_dir, "documents"), a, b)


def op13_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_private(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_source_mixing": op2_source_mixing,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_warc_packages": op4_warc_packages,
    "op5_language_id": op5_language_id,
    "op6_quality_rules": op6_quality_rules,
    "op7_ring_shards": op7_ring_shards,
    "op8_toxicity_chain": op8_toxicity_chain,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_token_ids": op10_token_ids,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_cross_tokenizer": op12_cross_tokenizer,
    "op13_private_data": op13_private_data,
}

ORACLE = {
    "op2_source_mixing": mixing.ORACLE,
    "op3_exact_dedup": exact.ORACLE,
    "op4_warc_packages": warc.ORACLE,
    "op11_hard_negatives": negatives.ORACLE,
}
