"""Advice selection.

The knowledge base is a fixed-size table (five courses with one embedding each).
Its five vectors are read once (bounded: 5 x dim floats) and placed in the plan as
a literal array, so matching a vector against it is an array expression per row,
with no join at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The course table of the original knowledge base, in its order.
COURSES = (
    (
        "acute_recovery",
        "Acute Fatigue Recovery",
        "10-20 min power nap. Eyes closed, no phone. Avoid caffeine 6 hours before main sleep. "
        "A short rest now restores alertness",
    ),
    (
        "sleep_debt",
        "Sleep Debt Repair",
        "Sleep extension strategy: go to bed earlier. Avoid sleep debt denial. Weekend recovery "
        "without oversleeping. Fatigue is accumulated biology.",
    ),
    (
        "stress_awareness",
        "Stress vs Activity",
        "Breathing exercises (4-6 breathing). Short walk. Cognitive offloading: write down worries. "
        "Differentiate between mental stress and physical load.",
    ),
    (
        "circadian",
        "Circadian Optimization",
        "Respect biological troughs (1 PM - 3 PM). Use light exposure. Schedule light tasks now. "
        "This dip is biological, not personal failure.",
    ),
    (
        "physiological",
        "Physiological Basics",
        "Check hydration. Reduce late-day caffeine. Balanced snacks with protein and fiber. "
        "Water intake is critical for energy stability.",
    ),
)
# Rule thresholds of the course cascade.
AWAKE_LIMIT_H = 14.0
DEBT_LIMIT_H = 3.0
STRESS_CV_LIMIT = 0.15
ADVICE_PREFIX = "Coach Insight: "

# The dashboard safety overrides (sleep in the supplied history).
SAFETY_RULES = (
    (0.95, "🚨 CRITICAL (Medical Standard): Cumulative Sleep Debt. Total sleep < 15hrs over 72hrs. "
           "Risk of cognitive tunnel vision."),
    (0.8142, "⚠️ WARNING (Construction OHS): Physiological Strain. HR failed to return to baseline. "
             "Risk of physical collapse detected."),
    (0.8871, "🌙 DANGER (Shift Work Standard): Circadian Low-Point. Biological clock at peak pressure. "
             "Risk of micro-sleeps."),
)
SLEEP_CRITICAL_H = 15.0
MIN_HR_STRAIN = 90.0
NIGHT_HOURS = (2, 5)
NIGHT_SLEEP_H = 18.0


def kb_vectors(kb: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> list[tuple[int, list[float]]]:
    """Read the knowledge base (fixed size) in id order."""
    rows = kb.orderBy(id_col).select(id_col, vec_col).collect()
    if len(rows) > 64:
        raise ValueError("knowledge base is expected to be a small fixed table")
    return [(int(r[0]), [float(x) for x in r[1]]) for r in rows]


def _vec_literal(vecs: list[list[float]]) -> Column:
    return F.array(*[F.array(*[F.lit(x).cast("double") for x in v]) for v in vecs])


def kb_match(df: DataFrame, kb: list[tuple[int, list[float]]], vec_col: str = "embedding") -> DataFrame:
    """J5 + F7 + O3: cosine similarity of each row's vector to every KB vector and the
    best KB row (ties -> lowest KB id). Adds kb_id, kb_rank (0-based) and similarity."""
    ids = F.array(*[F.lit(i) for i, _ in kb])
    kbv = _vec_literal([v for _, v in kb])
    sims = F.transform(
        kbv,
        lambda e: F.aggregate(F.zip_with(F.col(vec_col), e, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda acc, x: acc + x)
        / (
            F.sqrt(F.aggregate(F.transform(F.col(vec_col), lambda a: a.cast("double") * a.cast("double")), F.lit(0.0), lambda acc, x: acc + x))
            * F.sqrt(F.aggregate(F.transform(e, lambda a: a * a), F.lit(0.0), lambda acc, x: acc + x))
        ),
    )
    best = F.array_max(sims)
    rank = F.array_position(sims, best) - 1  # first maximum = lowest id (ids are sorted)
    return df.withColumn("_sims", sims).select(
        *df.columns,
        F.element_at(ids, rank.cast("int") + 1).alias("kb_id"),
        rank.cast("int").alias("kb_rank"),
        F.array_max("_sims").alias("similarity"),
    )


def course_column(rank: Column, field: int) -> Column:
    expr = F.lit(None).cast("string")
    for i, c in enumerate(COURSES):
        expr = F.when(rank == i, F.lit(c[field])).otherwise(expr)
    return expr


def select_course(features: DataFrame, fallback_rank: int | Column) -> DataFrame:
    """L1: awake > 14 h -> acute; debt > 3 -> debt; stress_cv > 0.15 -> stress; else the
    semantic fallback (nearest KB course). Missing features count as 0."""
    fb = fallback_rank if isinstance(fallback_rank, Column) else F.lit(int(fallback_rank))
    awake = F.coalesce(F.col("hours_awake"), F.lit(0.0))
    debt = F.coalesce(F.col("cum_sleep_debt"), F.lit(0.0))
    stress = F.coalesce(F.col("stress_cv"), F.lit(0.0))
    rank = F.when(awake > AWAKE_LIMIT_H, 0).when(debt > DEBT_LIMIT_H, 1).when(stress > STRESS_CV_LIMIT, 2).otherwise(fb)
    return features.withColumn("course_rank", rank).withColumn("course_id", course_column(F.col("course_rank"), 0))


def advice_text(df: DataFrame, score: str, threshold: float = 0.3) -> DataFrame:
    """L2: advice only when score > threshold: "Coach Insight: " + course text."""
    text = F.concat(F.lit(ADVICE_PREFIX), course_column(F.col("course_rank"), 2))
    return df.withColumn("advice", F.when(F.col(score) > threshold, text))


def safety_overrides(hr: DataFrame, sleep: DataFrame, key: str = "request_id") -> DataFrame:
    """A16 + L3: per request, total supplied sleep, minimum HR and the hour of the
    latest HR reading -> override probability, flag and message (NULL if none)."""
    s = sleep.groupBy(key).agg(
        F.sum((F.unix_micros(F.col("END").cast("timestamp")) - F.unix_micros(F.col("START").cast("timestamp"))) / 3.6e9).alias(
            "total_sleep_h"
        )
    )
    h = hr.groupBy(key).agg(F.min("HR").alias("min_hr"), F.hour(F.max("HRTIME")).alias("last_hour"))
    x = h.join(s, key, "left").withColumn("total_sleep_h", F.coalesce("total_sleep_h", F.lit(0.0)))
    (p1, m1), (p2, m2), (p3, m3) = SAFETY_RULES
    r1 = F.col("total_sleep_h") < SLEEP_CRITICAL_H
    r2 = F.col("min_hr") > MIN_HR_STRAIN
    r3 = F.col("last_hour").between(*NIGHT_HOURS) & (F.col("total_sleep_h") < NIGHT_SLEEP_H)
    prob = F.when(r1, p1).when(r2, p2).when(r3, p3)
    msg = F.when(r1, m1).when(r2, m2).when(r3, m3)
    code = F.when(r1, "CRIT").when(r2, "WARN").when(r3, "NIGHT")
    return x.select(
        key, "total_sleep_h", "min_hr", "last_hour", prob.alias("override_probability"),
        prob.isNotNull().alias("override_fatigued"), code.alias("override_rule"), msg.alias("override_advice")
    )
