"""Parameters that define the semantics of the feature pipeline.

The defaults are the values the original batch pipeline uses for 1 Hz heart-rate
streams. ``EVENTS_SCALE`` rescales the time constants for the driver's ``events``
table, which carries ~66 events per user over 30 days (median gap ~7 h).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

MICROS_PER_SECOND = 1_000_000
MICROS_PER_MINUTE = 60 * MICROS_PER_SECOND
MICROS_PER_HOUR = 60 * MICROS_PER_MINUTE
MICROS_PER_DAY = 24 * MICROS_PER_HOUR


@dataclass(frozen=True)
class FeatureSettings:
    # Fixed values (must equal the original pipeline's defaults).
    hr_limits: tuple[float, float] = (40.0, 180.0)  # exclusive bounds
    sleep_limits: tuple[float, float] = (0.25, 36.0)  # hours, exclusive bounds
    tolerance_us: int = 15 * MICROS_PER_MINUTE  # nearest-grid match tolerance
    window_us: int = 5 * MICROS_PER_MINUTE  # rolling window (t - w, t]
    min_periods: int = 30  # non-null observations per window
    jumpiness_window_us: int = 5 * MICROS_PER_MINUTE
    jumpiness_min_periods: int = 30
    max_gap_us: int | None = 5 * MICROS_PER_SECOND  # training masks diffs over gaps > 5 s
    offsets_us: tuple[int, ...] = tuple(m * MICROS_PER_MINUTE for m in (0, 1, 2, 3, 4))
    grid_us: int = MICROS_PER_MINUTE  # resample bin
    pvt_artifact_ms: float = 100.0  # taps at or below are false starts
    fatigue_low_ms: float = 300.0  # score 0 below
    fatigue_high_ms: float = 400.0  # score 1 at or above
    pvt_min_year: int = 2000  # keep tests with year strictly greater
    default_hours_awake: float = 14.0
    sleep_need_hours: float = 8.0
    debt_rows: int = 3  # rolling sum over the last 3 sleeps
    test_size: float = 0.2
    split_seed: int = 42
    # Physical knob (not semantic): time bucket used to split one user's series
    # over many tasks. Must be >= every window / gap above.
    bucket_us: int = MICROS_PER_DAY
    target_col: str = "fatigue_score"
    extra: dict = field(default_factory=dict)

    def with_(self, **kw) -> "FeatureSettings":
        return replace(self, **kw)

    def __post_init__(self):
        longest = max(self.window_us, self.jumpiness_window_us, self.max_gap_us or 0)
        if self.bucket_us < longest:
            raise ValueError("bucket_us must cover the longest window or gap")


DEFAULTS = FeatureSettings()

# Time constants rescaled for the driver's ``events`` feed.
EVENTS_SCALE = FeatureSettings(
    hr_limits=(1.0, 180.0),
    window_us=3 * MICROS_PER_DAY,
    min_periods=3,
    jumpiness_window_us=3 * MICROS_PER_DAY,
    jumpiness_min_periods=3,
    max_gap_us=12 * MICROS_PER_HOUR,
    offsets_us=tuple(h * MICROS_PER_HOUR for h in (0, 1, 2, 3, 4)),
    grid_us=MICROS_PER_DAY,
    tolerance_us=2 * MICROS_PER_DAY,
    bucket_us=7 * MICROS_PER_DAY,
)

# The twelve model features, in the order the model expects them.
MODEL_FEATURES = (
    "mean_hr_5min",
    "hr_volatility_5min",
    "hr_mean_total",
    "hr_std_total",
    "hr_zscore",
    "hr_jumpiness_5min",
    "stress_cv",
    "cum_sleep_debt",
    "hours_awake",
    "sleep_inertia_idx",
    "circadian_sin",
    "circadian_cos",
)

# Columns of the feature tables (training grid, inference rows) and those that drift
# monitoring watches.
FEATURE_COLS = (
    "HR hr_diff hr_mean_total hr_std_total mean_hr_5min hr_volatility_5min hr_jumpiness_5min "
    "hr_zscore stress_cv duration cum_sleep_debt hours_awake sleep_inertia_idx circadian_sin circadian_cos"
).split()
INFER_COLS = (
    "mean_hr_5min hr_volatility_5min hr_mean_total hr_std_total hr_zscore hr_jumpiness_5min stress_cv "
    "cum_sleep_debt hours_awake sleep_inertia_idx circadian_sin circadian_cos"
).split()
MONITORED = ("mean_hr_5min", "hr_volatility_5min", "hours_awake", "stress_cv")
