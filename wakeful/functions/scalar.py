"""Scalar column functions (F1-F10). All are built-in expressions, so they stay
inside whole-stage code generation; none is a Python UDF."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeful.settings import MICROS_PER_HOUR

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_us(c) -> Column:
    """Microseconds since the epoch of a naive timestamp (session zone is UTC)."""
    c = col_(c)
    return F.unix_micros(c.cast("timestamp"))


def us_to_ts(c) -> Column:
    """Inverse of :func:`ts_us`, as ``timestamp_ntz``."""
    return F.timestamp_micros(col_(c)).cast("timestamp_ntz")


def hours_between(later, earlier) -> Column:
    """(later - earlier) in hours, as double (F4/W11 time deltas)."""
    return (ts_us(later) - ts_us(earlier)) / float(MICROS_PER_HOUR)


def parse_time(c) -> Column:
    """ISO-like string -> naive timestamp. A trailing zone offset is dropped and
    the wall clock kept; unparsable text becomes NULL."""
    stripped = F.regexp_replace(col_(c), r"(Z|[+-]\d{2}:?\d{2})$", "")
    return F.try_to_timestamp(stripped).cast("timestamp_ntz")


def fatigue_score(rt, low: float = 300.0, high: float = 400.0) -> Column:
    """piecewise-linear ramp, 0 below ``low``, 1 from ``high``; NULL stays NULL."""
    rt = col_(rt)
    return (
        F.when(rt < low, F.lit(0.0))
        .when(rt < high, (rt - F.lit(low)) / F.lit(high - low))
        .when(rt.isNotNull(), F.lit(1.0))
    ).cast("double")


def circadian(ts, fn: str) -> Column:
    """sin/cos of 2*pi*(hour + minute/60)/24."""
    ts = col_(ts)
    hour = F.hour(ts) + F.minute(ts) / 60.0
    angle = F.lit(2 * math.pi) * hour / F.lit(24.0)
    return F.sin(angle) if fn == "sin" else F.cos(angle)


def sleep_inertia(hours_awake) -> Column:
    """1 / (hours_awake + 0.1)."""
    return F.lit(1.0) / (col_(hours_awake) + F.lit(0.1))


def sleep_debt(duration, need: float = 8.0) -> Column:
    """need - duration."""
    return F.lit(need) - col_(duration)


def threshold_flag(score, threshold: float, inclusive: bool = True) -> Column:
    """1 if score >= t (or > t), else 0; NULL score stays NULL."""
    s = col_(score)
    hit = s >= threshold if inclusive else s > threshold
    return F.when(s.isNull(), F.lit(None)).otherwise(hit.cast("int"))


def status_label(flag) -> Column:
    return F.when(col_(flag) == 1, F.lit("Fatigued")).when(col_(flag) == 0, F.lit("Awake"))


def _dsum(expr: str) -> str:
    return f"aggregate({expr}, CAST(0 AS DOUBLE), (acc, v) -> acc + v)"


def dot(a: str, b: str) -> Column:
    return F.expr(_dsum(f"zip_with({a}, {b}, (x, y) -> CAST(x AS DOUBLE) * CAST(y AS DOUBLE))"))


def norm(a: str) -> Column:
    return F.sqrt(F.expr(_dsum(f"transform({a}, x -> CAST(x AS DOUBLE) * CAST(x AS DOUBLE))")))


def cosine_similarity(a: str, b: str) -> Column:
    """1 - cosine distance of two float arrays, computed in double."""
    return dot(a, b) / (norm(a) * norm(b))


def extract_id(c, pattern: str) -> Column:
    """digits matched by ``*`` of a glob-like file pattern (``HR_*.csv``)."""
    regex = "^" + pattern.replace(".", r"\.").replace("*", r"(\d+)") + "$"
    return F.regexp_extract(col_(c), regex, 1)


def nan_to_null(c) -> Column:
    """Pandas aggregates skip NaN; Spark ones propagate it. Normalise on read."""
    return F.nanvl(col_(c), F.lit(None).cast("double"))


def round6(c) -> Column:
    return F.round(col_(c), 6)
