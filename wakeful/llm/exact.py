"""Exact de-duplication of texts: DataFrame functions only.

Rows are grouped by a 128-bit hash of the normalised text (MD5), the smallest id of
a group stays. Inside the groups whole texts are compared: grouping by (hash, text)
tells the hashes that stand for several texts, and their rows are then grouped by
the text itself. Aggregates combine on the map side, so a text that fills a third of
the table is one row per task before any shuffle; the join back to the rows is one
that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeful.llm.common import WHITE_SPACE, cut_lineage, text_of, without_rows


def normalised(text: str | Column) -> Column:
    """The text compared: every run of white space is one blank; null is empty."""
    return F.regexp_replace(text_of(text), WHITE_SPACE, " ")


def content_hash(text: Column) -> Column:
    """128 bits of content."""
    return F.unhex(F.md5(text))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of=content_hash) -> DataFrame:
    """A row per row of ``docs``: ``doc_id``, ``keep_id`` (smallest id among rows with
    an equal normalised text), ``group_size``, ``kept``, ``text_sha256``.

    Null text equals empty text. Null ids are never smallest: a group of null ids only
    has keep_id null and keeps one of its rows. Where the smallest id is repeated
    within a group, one of those rows is kept. Empty tables give no rows; other
    columns are not looked at. ``hash_of`` may be any function of the text: texts that
    share a hash are told apart by their bytes.
    """
    norm = normalised(text_col)
    rows = cut_lineage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.monotonically_increasing_id().alias("rid"),
            hash_of(norm).alias("h"),
            F.sha2(norm, 256).alias("text_sha256"),
        ),
        "hashes",
    )
    texts = docs.select(norm.alias("norm")).select(hash_of(F.col("norm")).alias("h"), "norm")
    several = cut_lineage(
        texts.groupBy("h", "norm").agg(F.lit(1).alias("one")).groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"),
        "collided",
    )
    if several.isEmpty():
        return _kept(rows, ["h"])
    clean = _kept(rows.join(several, "h", "left_anti"), ["h"])
    clashing = cut_lineage(
        docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("rid"), norm.alias("norm"))
        .withColumn("h", hash_of(F.col("norm")))
        .join(several, "h", "left_semi")
        .withColumn("text_sha256", F.sha2("norm", 256)),
        "clashing",
    )
    return clean.union(_kept(clashing, ["h", "norm"]))


def _kept(rows: DataFrame, key: list[str]) -> DataFrame:
    first = rows.groupBy(*key).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "rid")).alias("first"),
        F.count("*").alias("group_size"),
    )
    return rows.join(first, key).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("rid") == F.col("first.rid")).alias("kept"),
        "text_sha256",
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, that of the smallest id;
    columns as given. A null id is larger than all others. Where the smallest id is
    repeated within a group (or all its ids are null), one of those rows stays, which
    one isn't defined.

    The decision is carried by (id, hash of the text), so that rows which share their
    id but not their text are told apart."""
    groups = exact_groups(docs, id_col, text_col).select(
        F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_key"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("least"), "kept"
    )
    decided = cut_lineage(groups.where("not kept"), "dropped")
    goes = decided.where("not least").select("_id", "_key")
    repeated = decided.where("least").select("_id", "_key").distinct()
    return without_rows(docs, F.sha2(normalised(F.col(f"`{text_col}`")), 256), id_col, goes, repeated)


ORACLE = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (
  SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm
)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.norm) AS text_sha256
FROM n JOIN g ON n.norm = g.norm
"""
