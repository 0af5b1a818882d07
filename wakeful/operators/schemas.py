"""Table schemas and validation (P10, §1.2 of the survey).

A schema is a list of column rules; ``validate`` casts with ``try_cast`` (coercion
never raises), checks strictness on the DataFrame's schema (metadata only), and
counts violations of every rule in ONE aggregate pass. NaN is a missing value. The
result is a table (rule, n_bad), and :func:`rejects` lists the rows, so nothing is
silently dropped.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wakeful.functions.scalar import nan_to_null
from wakeful.settings import MODEL_FEATURES


@dataclass(frozen=True)
class ColumnRule:
    name: str
    dtype: str
    nullable: bool = False
    ge: float | None = None
    gt: float | None = None
    le: float | None = None
    lt: float | None = None


@dataclass(frozen=True)
class Schema:
    name: str
    columns: tuple[ColumnRule, ...]
    strict: bool = True
    optional: tuple[str, ...] = ()


def _features() -> tuple[ColumnRule, ...]:
    out = []
    for f in MODEL_FEATURES:
        if f in ("circadian_sin", "circadian_cos"):
            out.append(ColumnRule(f, "double", ge=-1.0, le=1.0))
        else:
            out.append(ColumnRule(f, "double", nullable=(f == "hr_jumpiness_5min")))
    return tuple(out)


# fixed schema definitions of the original pipeline
HEART_RATE_RAW = Schema("HeartRateRaw", (ColumnRule("id", "bigint"), ColumnRule("HRTIME", "string"), ColumnRule("HR", "double", nullable=True, gt=0.0)))
SLEEP_RAW = Schema("SleepRaw", (ColumnRule("id", "bigint"), ColumnRule("START", "string"), ColumnRule("END", "string"), ColumnRule("rating", "double", gt=0.0), ColumnRule("comments", "string", nullable=True)))
PVT_RAW = Schema("PVTRaw", (ColumnRule("id", "bigint"), ColumnRule("TESTID", "bigint"), ColumnRule("TESTSTART", "string"), ColumnRule("TRIALID", "bigint"), ColumnRule("TRIALNAME", "string"), ColumnRule("TRIALSTART", "string"), ColumnRule("TAPTIME", "bigint", ge=0.0)))
MODEL_INPUTS = Schema("ModelInputs", _features() + (ColumnRule("user_id", "string", nullable=True),), optional=("user_id",))
TARGETS = Schema("Targets", (ColumnRule("fatigue_score", "double", ge=0.0, le=1.0), ColumnRule("user_id", "string", nullable=True), ColumnRule("HRTIME", "timestamp_ntz", nullable=True)), optional=("user_id", "HRTIME"))
OUTPUTS = Schema("Outputs", (ColumnRule("prediction", "double", ge=0.0, le=1.0), ColumnRule("user_id", "string", nullable=True), ColumnRule("timestamp", "timestamp_ntz", nullable=True)), optional=("user_id", "timestamp"))
SHAP_VALUES = Schema("SHAPValues", tuple(ColumnRule(f, "float", nullable=True) for f in MODEL_FEATURES), strict=False, optional=MODEL_FEATURES)
FEATURE_IMPORTANCES = Schema("FeatureImportances", (ColumnRule("Feature", "string"), ColumnRule("Importance", "double")))
SCHEMAS = (HEART_RATE_RAW, SLEEP_RAW, PVT_RAW, MODEL_INPUTS, TARGETS, OUTPUTS, SHAP_VALUES, FEATURE_IMPORTANCES)


def coerce(df: DataFrame, schema: Schema) -> DataFrame:
    """Cast every schema column with ``try_cast`` (bad values -> NULL)."""
    cols = []
    names = {c.name for c in schema.columns}
    for c in schema.columns:
        if c.name in df.columns:
            cols.append(F.expr(f"try_cast(`{c.name}` AS {c.dtype})").alias(c.name))
    extra = [F.col(c) for c in df.columns if c not in names]
    return df.select(*cols, *extra)


def _checks(df: DataFrame, schema: Schema) -> list[tuple[str, Column]]:
    """(rule, condition that a row violates it) of the columns that ``df`` has."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    checks = []
    for c in schema.columns:
        if c.name not in df.columns:
            continue
        raw = F.col(f"`{c.name}`")
        if kinds[c.name] in ("double", "float"):
            raw = nan_to_null(raw)
        cast = F.expr(f"try_cast(`{c.name}` AS {c.dtype})")
        if c.dtype in ("double", "float"):
            cast = nan_to_null(cast)
        checks.append((f"coerce:{c.name}", raw.isNotNull() & cast.isNull()))
        if not c.nullable:
            checks.append((f"null:{c.name}", raw.isNull()))
        for op, bound in (("ge", c.ge), ("gt", c.gt), ("le", c.le), ("lt", c.lt)):
            if bound is None:
                continue
            ok = {"ge": cast >= bound, "gt": cast > bound, "le": cast <= bound, "lt": cast < bound}[op]
            checks.append((f"{op}:{c.name}", cast.isNotNull() & ~ok))
    return checks


def rejects(df: DataFrame, schema: Schema, keys: Sequence[str]) -> DataFrame:
    """(schema, rule, keys...): a row per input row and rule that it violates, found in
    one pass without a shuffle."""
    broken = F.filter(F.array(*[F.when(bad, F.lit(rule)) for rule, bad in _checks(df, schema)]), lambda r: r.isNotNull())
    return df.select(F.lit(schema.name).alias("schema"), F.explode(broken).alias("rule"), *keys)


def validate(df: DataFrame, schema: Schema) -> DataFrame:
    """Violations per rule: (schema, rule, n_bad). Rules: missing/extra columns
    (metadata), coercion failures, nulls, bounds."""
    spark = df.sparkSession
    meta = []
    for c in schema.columns:
        if c.name not in df.columns and c.name not in schema.optional:
            meta.append((f"missing:{c.name}", 1))
    if schema.strict:
        allowed = {c.name for c in schema.columns}
        meta += [(f"unexpected:{c}", 1) for c in df.columns if c not in allowed]
    checks = _checks(df, schema)
    counts = df.agg(*[F.count_if(cond).alias(f"c{i}") for i, (_, cond) in enumerate(checks)]) if checks else None
    parts = []
    if counts is not None:
        parts.append(
            counts.select(
                F.explode(
                    F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"c{i}").cast("long").alias("n_bad")) for i, (name, _) in enumerate(checks)])
                ).alias("r")
            ).select("r.*")
        )
    if meta:
        parts.append(spark.createDataFrame(meta, "rule string, n_bad long"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(schema.name).alias("schema"), "rule", "n_bad")


def check(df: DataFrame, schema: Schema) -> DataFrame:
    """Validate and return the coerced table; raise if any rule is violated
    (one aggregate job; the violations table is a handful of rows)."""
    bad = validate(df, schema).where(F.col("n_bad") > 0).collect()
    if bad:
        raise ValueError(f"{schema.name} violations: " + ", ".join(f"{r.rule}={r.n_bad}" for r in bad))
    return coerce(df, schema)


@dataclass
class Checked:
    """What :func:`quarantine` wrote: ``valid`` rows (coerced), ``rejected`` rows (the
    rules they break and the row as JSON), and ``counts`` (schema, rule, n_bad)."""

    valid: DataFrame
    rejected: DataFrame
    counts: DataFrame


def quarantine(df: DataFrame, schema: Schema, path: str) -> Checked:
    """Validate in one pass: the same job writes valid rows and rejected ones and counts
    the violations of every rule while they go by. ``rows:valid`` and ``rows:rejected``
    are among the counts; missing and unexpected columns are found without reading."""
    spark, checks = df.sparkSession, _checks(df, schema)
    names = {c.name for c in schema.columns}
    meta = [(f"missing:{c.name}", 1) for c in schema.columns if c.name not in df.columns and c.name not in schema.optional]
    if schema.strict:
        meta += [(f"unexpected:{c}", 1) for c in df.columns if c not in names]
    broken = F.filter(F.array(*[F.when(bad, F.lit(rule)) for rule, bad in checks]), lambda r: r.isNotNull()) if checks else F.array().cast("array<string>")
    raw = F.struct(*[F.col(f"`{c}`").alias(c) for c in df.columns])
    rows = df.withColumn("_rules", broken).withColumn("_row", F.when(F.size("_rules") > 0, F.to_json(raw))).withColumn("_ok", F.size("_rules") == 0)
    seen = Observation()
    counts = [F.count_if(bad).alias(f"c{i}") for i, (_, bad) in enumerate(checks)]
    rows = rows.observe(seen, F.count_if(F.col("_ok")).alias("valid"), F.count_if(~F.col("_ok")).alias("rejected"), *counts)
    fixed = coerce(rows, schema)
    fixed.write.mode("overwrite").partitionBy("_ok").parquet(path)
    n = seen.get
    found = [(rule, n[f"c{i}"]) for i, (rule, _) in enumerate(checks)] + meta + [("rows:valid", n["valid"]), ("rows:rejected", n["rejected"])]
    back = spark.read.schema(fixed.schema).parquet(path)
    table = spark.createDataFrame(found, "rule string, n_bad long").select(F.lit(schema.name).alias("schema"), "rule", "n_bad")
    kept = [c for c in fixed.columns if c not in ("_rules", "_row", "_ok")]
    return Checked(back.where("_ok").select(*kept), back.where("not _ok").select(F.lit(schema.name).alias("schema"), F.col("_rules").alias("rules"), F.col("_row").alias("row")), table)
