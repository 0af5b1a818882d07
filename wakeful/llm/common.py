"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeful.session import checkpoint_dir, cut_lineage, scratch_path  # noqa: F401

# The white space of all text contracts: blank, tab, line feed, vertical tab, form
# feed and carriage return.
WHITE_SPACE = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def squeezed(column: str | Column) -> Column:
    """The text's words with one blank between them and none around them."""
    return F.trim(F.regexp_replace(text_of(column), WHITE_SPACE, " "))


def word_count(column: str | Column) -> Column:
    """Number of words of the text (null and empty: 0)."""
    words = squeezed(column)
    return F.when(words == "", F.lit(0)).otherwise(
        F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit(""))) + 1
    ).cast("long")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also where the body
    uses it several times or inside other lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def free_name(df: DataFrame, name: str) -> str:
    """A column name close to ``name`` that ``df`` doesn't have (names are compared
    without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without_rows(docs: DataFrame, key: Column, id_col: str, goes: DataFrame, repeated: DataFrame) -> DataFrame:
    """``docs`` without the rows whose (id, key) is a row (``_id``, ``_key``) of
    ``goes``; of the rows whose (id, key) is in ``repeated`` one stays. Null ids are
    equal to each other. Columns as given; the joins carry ids and keys only, and a
    second pass over ``docs`` is made only where something is repeated."""
    own = free_name(docs, "row_key")
    keyed = docs.withColumn(own, key)

    def same(other: DataFrame) -> Column:
        return keyed[f"`{id_col}`"].eqNullSafe(other["_id"]) & (keyed[own] == other["_key"])

    if repeated.isEmpty():
        return keyed.join(goes, same(goes), "left_anti").drop(own)
    out = goes.select("_id", "_key").union(repeated.select("_id", "_key"))
    rest = keyed.join(out, same(out), "left_anti").drop(own)
    row = free_name(docs, "whole_row")
    held = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = (
        keyed.join(repeated, same(repeated), "left_semi")
        .groupBy(F.col(f"`{id_col}`"), F.col(own))
        .agg(F.first(held).alias(row))
        .select(*[F.col(row)[c].alias(c) for c in docs.columns])
    )
    return rest.union(one)
