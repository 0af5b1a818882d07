"""From raw documents to token ids: the operators of ``wakeful.llm`` in a row.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all that the stage
before it kept; all but the last return the columns of ``documents``. Between stages
the documents are written as Parquet to the shared folder, so a lost executor costs
tasks of one stage only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeful.llm import exact, mixing, pieces, quality, simhash
from wakeful.llm.common import cut_lineage, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned decision list or the base rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    return exact.exact_dedup(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.one_per_group(docs, words=3, bits=2)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    sources = F.array("source")
    return mixing.apply_mix(docs, mixing.mix(docs, sources), sources)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every taken document, with digests of the ids and of their
    decoding."""
    return pieces.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("source_mixing", source_mixing),
    ("sentencepiece", sentencepiece),
]

# The learned rules and the 64-bit shingle hashes have no DuckDB SQL; tests hold every
# stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
