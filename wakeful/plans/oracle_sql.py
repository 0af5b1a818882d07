"""DuckDB statements equivalent to the registered Spark queries.

They are written the naive way on purpose (per-user windows, dense grids,
brute-force nearest search) so that they check the bucketed Spark plans
independently. Doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

from wakeful.operators.advise import ADVICE_PREFIX, COURSES, SAFETY_RULES  # fixed texts

# test-scale constants (EVENTS_SCALE): window 3 d, min periods 3, gap 12 h,
# grid 1 d, tolerance 2 d, offsets 0-4 h, HR bounds (1, 180)
W_US = 3 * 86_400_000_000
GAP_US = 12 * 3_600_000_000
GRID_US = 86_400_000_000
TOL_US = 2 * 86_400_000_000

FEEDS = """
hr_raw AS (SELECT user_id, ts AS HRTIME, value AS HR FROM events
           WHERE event_type IN ('click', 'purchase', 'signup')),
sleep_raw AS (SELECT user_id,
                     make_timestamp(epoch_us(ts) - CAST(round(value * 720000000) AS BIGINT)) AS "START",
                     ts AS "END"
              FROM events WHERE event_type = 'view'),
pvt_raw AS (SELECT user_id, ts AS TESTSTART, event_id AS TESTID, value * 6 AS TAPTIME
            FROM events WHERE event_type = 'error')
"""

HR_CLEAN = """
hr_clean AS (SELECT user_id, HRTIME, avg(HR) AS HR, epoch_us(HRTIME) AS t
             FROM hr_src WHERE HR IS NOT NULL AND HR > 1 AND HR < 180 GROUP BY user_id, HRTIME)
"""


def hr_features_sql(gap_mask: bool = True) -> str:
    diff = f"CASE WHEN t - pt <= {GAP_US} THEN abs(HR - ph) END" if gap_mask else "abs(HR - ph)"
    return f"""
hr_w AS (
  SELECT *, lag(t) OVER wo AS pt, lag(HR) OVER wo AS ph,
         count(HR) OVER we AS ce, avg(HR) OVER we AS ae, stddev_samp(HR) OVER we AS se
  FROM hr_clean
  WINDOW wo AS (PARTITION BY user_id ORDER BY t),
         we AS (PARTITION BY user_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
hr_d AS (SELECT *, {diff} AS hr_diff FROM hr_w),
hr_r AS (
  SELECT user_id, t, HRTIME, HR, hr_diff,
         CASE WHEN ce >= 3 THEN ae END AS hr_mean_total,
         coalesce(CASE WHEN ce >= 3 THEN se END, 1.0) AS hr_std_total,
         CASE WHEN count(HR) OVER wr >= 3 THEN avg(HR) OVER wr END AS mean_hr_5min,
         CASE WHEN count(HR) OVER wr >= 3 THEN stddev_samp(HR) OVER wr END AS hr_volatility_5min,
         CASE WHEN count(hr_diff) OVER wr >= 3 THEN sqrt(avg(hr_diff * hr_diff) OVER wr) END AS hr_jumpiness_5min
  FROM hr_d
  WINDOW wr AS (PARTITION BY user_id ORDER BY t RANGE BETWEEN {W_US - 1} PRECEDING AND CURRENT ROW)),
hr_feat AS (
  SELECT *, (HR - hr_mean_total) / (hr_std_total + 0.1) AS hr_zscore,
         hr_volatility_5min / (mean_hr_5min + 0.1) AS stress_cv
  FROM hr_r WHERE mean_hr_5min IS NOT NULL)
"""


SLEEP_FEAT = """
sleep_clean AS (
  SELECT user_id, "START", "END", (epoch_us("END") - epoch_us("START")) / 3600000000.0 AS duration
  FROM (SELECT DISTINCT user_id, "START", "END" FROM sleep_src
        WHERE "START" IS NOT NULL AND "END" IS NOT NULL)),
sleep_feat AS (
  SELECT user_id, "START", "END", duration, epoch_us("END") AS end_us,
         sum(8.0 - duration) OVER (PARTITION BY user_id ORDER BY "END", "START"
                                   ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS cum_sleep_debt
  FROM sleep_clean WHERE duration > 0.25 AND duration < 36)
"""

CONTINUOUS = """
joined AS (
  SELECT h.*, s."START", s."END" AS last_sleep_end, s.duration, s.cum_sleep_debt,
         (h.t - s.end_us) / 3600000000.0 AS hours_awake
  FROM hr_feat h ASOF LEFT JOIN sleep_feat s ON h.user_id = s.user_id AND h.t >= s.end_us),
imputed AS (
  SELECT * REPLACE (coalesce(hours_awake, median(hours_awake) OVER (PARTITION BY user_id), 14.0) AS hours_awake,
                    coalesce(cum_sleep_debt, 0.0) AS cum_sleep_debt)
  FROM joined),
cont AS (
  SELECT *, 1.0 / (hours_awake + 0.1) AS sleep_inertia_idx,
         sin(2 * pi() * (hour(HRTIME) + minute(HRTIME) / 60.0) / 24.0) AS circadian_sin,
         cos(2 * pi() * (hour(HRTIME) + minute(HRTIME) / 60.0) / 24.0) AS circadian_cos
  FROM imputed)
"""

GRID = f"""
bins AS (
  SELECT user_id, CAST(floor(t / {GRID_US}) AS BIGINT) * {GRID_US} AS bin,
         avg(HR) AS HR, avg(hr_diff) AS hr_diff, avg(hr_mean_total) AS hr_mean_total,
         avg(hr_std_total) AS hr_std_total, avg(mean_hr_5min) AS mean_hr_5min,
         avg(hr_volatility_5min) AS hr_volatility_5min, avg(hr_jumpiness_5min) AS hr_jumpiness_5min,
         avg(hr_zscore) AS hr_zscore, avg(stress_cv) AS stress_cv, avg(duration) AS duration,
         avg(cum_sleep_debt) AS cum_sleep_debt, avg(hours_awake) AS hours_awake,
         avg(sleep_inertia_idx) AS sleep_inertia_idx, avg(circadian_sin) AS circadian_sin,
         avg(circadian_cos) AS circadian_cos
  FROM cont GROUP BY ALL)
"""

FEATURE_COLS = (
    "HR hr_diff hr_mean_total hr_std_total mean_hr_5min hr_volatility_5min hr_jumpiness_5min "
    "hr_zscore stress_cv duration cum_sleep_debt hours_awake sleep_inertia_idx circadian_sin circadian_cos"
).split()


def r6(cols, prefix="") -> str:
    return ", ".join(f"{rnd(prefix + c)} AS {c}" for c in cols)


def rnd(expr: str) -> str:
    """Same rounding as ``round_doubles`` on the Spark side."""
    return f"round(({expr}) + 2.5e-8, 6)"


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts)


TRAIN_USERS = """
users AS (SELECT user_id FROM (SELECT DISTINCT user_id FROM hr_raw)
          INTERSECT SELECT user_id FROM (SELECT DISTINCT user_id FROM sleep_raw)
          INTERSECT SELECT user_id FROM (SELECT DISTINCT user_id FROM pvt_raw)),
hr_src AS (SELECT * FROM hr_raw WHERE user_id IN (SELECT user_id FROM users)),
sleep_src AS (SELECT * FROM sleep_raw WHERE user_id IN (SELECT user_id FROM users)),
pvt_src AS (SELECT * FROM pvt_raw WHERE user_id IN (SELECT user_id FROM users))
"""

INFER_USERS = """
users AS (SELECT user_id FROM (SELECT DISTINCT user_id FROM hr_raw)
          INTERSECT SELECT user_id FROM (SELECT DISTINCT user_id FROM sleep_raw)),
hr_src AS (SELECT * FROM hr_raw WHERE user_id IN (SELECT user_id FROM users)),
sleep_src AS (SELECT * FROM sleep_raw WHERE user_id IN (SELECT user_id FROM users))
"""

PVT_TARGETS = """
pvt_clean AS (
  SELECT user_id, TESTSTART, TESTID, avg(TAPTIME) AS pvt_mean_rt
  FROM pvt_src WHERE TAPTIME > 100 GROUP BY user_id, TESTSTART, TESTID),
pvt AS (
  SELECT *, CASE WHEN pvt_mean_rt < 300 THEN 0.0 WHEN pvt_mean_rt < 400 THEN (pvt_mean_rt - 300) / 100.0
                 WHEN pvt_mean_rt IS NOT NULL THEN 1.0 END AS fatigue_score
  FROM pvt_clean WHERE year(TESTSTART) > 2000)
"""

NEAREST = f"""
extent AS (SELECT user_id, min(bin) AS first_bin, max(bin) AS last_bin FROM bins GROUP BY user_id),
dense AS (SELECT user_id, unnest(generate_series(first_bin, last_bin, {GRID_US})) AS g FROM extent),
aug AS (SELECT p.*, o.off AS offset_us, epoch_us(p.TESTSTART) - o.off AS match_us
        FROM pvt p CROSS JOIN (VALUES (0), (3600000000), (7200000000), (10800000000), (14400000000)) o(off)),
cand AS (
  SELECT a.*, d.g, row_number() OVER (PARTITION BY a.user_id, a.TESTSTART, a.TESTID, a.offset_us
                                      ORDER BY abs(d.g - a.match_us), d.g) AS rk
  FROM aug a JOIN dense d ON a.user_id = d.user_id AND abs(d.g - a.match_us) <= {TOL_US}),
matched AS (
  SELECT c.user_id, c.TESTSTART, c.TESTID, c.offset_us, make_timestamp(c.match_us) AS MATCH_TIME,
         make_timestamp(b.bin) AS HRTIME, c.pvt_mean_rt, c.fatigue_score, {r6(FEATURE_COLS, "b.")}
  FROM cand c JOIN bins b ON c.user_id = b.user_id AND c.g = b.bin
  WHERE c.rk = 1 AND b.mean_hr_5min IS NOT NULL AND b.hours_awake IS NOT NULL AND c.fatigue_score IS NOT NULL)
"""


def q_hr_clean() -> str:
    return with_(FEEDS, "hr_src AS (SELECT * FROM hr_raw)", HR_CLEAN) + """
SELECT user_id, HRTIME, round((HR) + 2.5e-8, 6) AS HR FROM hr_clean"""


def q_hr_features() -> str:
    cols = "HR hr_diff hr_mean_total hr_std_total hr_zscore mean_hr_5min hr_volatility_5min hr_jumpiness_5min stress_cv".split()
    return with_(FEEDS, "hr_src AS (SELECT * FROM hr_raw)", HR_CLEAN, hr_features_sql(True)) + f"""
SELECT user_id, HRTIME, {r6(cols)} FROM hr_feat"""


def q_sleep_features() -> str:
    return with_(FEEDS, "sleep_src AS (SELECT * FROM sleep_raw)", SLEEP_FEAT) + """
SELECT user_id, "START", "END" AS last_sleep_end, round((duration) + 2.5e-8, 6) AS duration,
       round((cum_sleep_debt) + 2.5e-8, 6) AS cum_sleep_debt FROM sleep_feat"""


def q_pvt_targets() -> str:
    return with_(FEEDS, "pvt_src AS (SELECT * FROM pvt_raw)", PVT_TARGETS) + """
SELECT user_id, TESTSTART, TESTID, round((pvt_mean_rt) + 2.5e-8, 6) AS pvt_mean_rt,
       round((fatigue_score) + 2.5e-8, 6) AS fatigue_score FROM pvt"""


def q_continuous_features() -> str:
    cols = FEATURE_COLS
    return with_(FEEDS, TRAIN_USERS, HR_CLEAN, hr_features_sql(True), SLEEP_FEAT, CONTINUOUS) + f"""
SELECT user_id, HRTIME, "START", last_sleep_end, {r6(cols)} FROM cont"""


def q_feature_grid() -> str:
    return with_(FEEDS, TRAIN_USERS, HR_CLEAN, hr_features_sql(True), SLEEP_FEAT, CONTINUOUS, GRID) + f"""
SELECT user_id, make_timestamp(bin) AS HRTIME, {r6(FEATURE_COLS)} FROM bins"""


def q_training_features() -> str:
    return with_(FEEDS, TRAIN_USERS, HR_CLEAN, hr_features_sql(True), SLEEP_FEAT, CONTINUOUS, GRID, PVT_TARGETS, NEAREST) + """
SELECT user_id, TESTSTART, TESTID, offset_us, MATCH_TIME, HRTIME, round((pvt_mean_rt) + 2.5e-8, 6) AS pvt_mean_rt,
       round((fatigue_score) + 2.5e-8, 6) AS fatigue_score, * EXCLUDE (user_id, TESTSTART, TESTID, offset_us, MATCH_TIME,
       HRTIME, pvt_mean_rt, fatigue_score)
FROM matched"""


INFER_COLS = (
    "mean_hr_5min hr_volatility_5min hr_mean_total hr_std_total hr_zscore hr_jumpiness_5min stress_cv "
    "cum_sleep_debt hours_awake sleep_inertia_idx circadian_sin circadian_cos"
).split()


def q_inference_features() -> str:
    return with_(FEEDS, INFER_USERS, HR_CLEAN, hr_features_sql(False), SLEEP_FEAT, CONTINUOUS, GRID) + f"""
SELECT user_id, make_timestamp(bin) AS HRTIME, {r6(INFER_COLS)} FROM bins
WHERE mean_hr_5min IS NOT NULL AND hours_awake IS NOT NULL"""


# ---------------------------------------------------------------- metrics
SCORED = """
scored AS (SELECT l_discount * 10 AS y_true, (l_quantity - 1) / 49 AS y_pred FROM lineitem)
"""
EVAL_T = 0.26  # evaluation / inference threshold of the original jobs


def _conf(t: float, tt: float) -> str:
    return f"""
conf AS (SELECT count(*) FILTER (WHERE y_true >= {tt} AND y_pred >= {t}) AS tp,
                count(*) FILTER (WHERE y_true < {tt} AND y_pred >= {t}) AS fp,
                count(*) FILTER (WHERE y_true >= {tt} AND y_pred < {t}) AS fn,
                count(*) FILTER (WHERE y_true < {tt} AND y_pred < {t}) AS tn FROM scored)
"""


def _div(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) > 0 THEN ({a}) * 1.0 / ({b}) ELSE 0.0 END"


def q_regression_metrics() -> str:
    return with_(SCORED, """
a AS (SELECT avg(abs(y_pred - y_true)) AS mae, avg((y_pred - y_true) * (y_pred - y_true)) AS mse,
             sum((y_pred - y_true) * (y_pred - y_true)) AS ss_res, var_pop(y_true) * count(y_true) AS ss_tot
      FROM scored)""") + f"""
SELECT metric, {rnd("value")} AS value FROM (
  SELECT 'mae' AS metric, mae AS value FROM a UNION ALL SELECT 'mse', mse FROM a
  UNION ALL SELECT 'rmse', sqrt(mse) FROM a
  UNION ALL SELECT 'r2', CASE WHEN ss_tot > 0 THEN 1 - ss_res / ss_tot WHEN ss_res = 0 THEN 1.0 ELSE 0.0 END FROM a)"""


def auc_sql(tt: float) -> str:
    return f"""
per AS (SELECT y_pred AS s, sum(CASE WHEN y_true >= {tt} THEN 1 ELSE 0 END) AS pos,
               sum(CASE WHEN y_true >= {tt} THEN 0 ELSE 1 END) AS neg FROM scored GROUP BY y_pred),
cumneg AS (SELECT *, sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn FROM per),
auc AS (SELECT CASE WHEN sum(pos) > 0 AND sum(neg) > 0
                    THEN sum(pos * (cn - neg + 0.5 * neg)) / (sum(pos) * sum(neg)) ELSE 0.0 END AS roc_auc
        FROM cumneg)
"""


def q_binary_metrics(t: float = 0.5, tt: float = 0.5) -> str:
    return with_(SCORED, _conf(t, tt), auc_sql(tt)) + f"""
SELECT metric, {rnd("value")} AS value FROM (
  SELECT 'recall_at_{t}' AS metric, {_div("tp", "tp + fn")} AS value FROM conf
  UNION ALL SELECT 'precision_at_{t}', {_div("tp", "tp + fp")} FROM conf
  UNION ALL SELECT 'f1_at_{t}', {_div("2 * tp", "2 * tp + fp + fn")} FROM conf
  UNION ALL SELECT 'accuracy', {_div("tp + tn", "tp + tn + fp + fn")} FROM conf
  UNION ALL SELECT 'roc_auc', roc_auc FROM auc)"""


def q_confusion_matrix(t: float = EVAL_T) -> str:
    return with_(SCORED, _conf(t, t)) + """
SELECT true_label, pred_label, CAST(count AS BIGINT) AS count FROM (
  SELECT 1 AS true_label, 1 AS pred_label, tp AS count FROM conf UNION ALL SELECT 0, 1, fp FROM conf
  UNION ALL SELECT 1, 0, fn FROM conf UNION ALL SELECT 0, 0, tn FROM conf)"""


def q_classification_report(t: float = EVAL_T) -> str:
    pf, rf, ff = _div("tp", "tp + fp"), _div("tp", "tp + fn"), _div("2 * tp", "2 * tp + fp + fn")
    pa, ra, fa = _div("tn", "tn + fn"), _div("tn", "tn + fp"), _div("2 * tn", "2 * tn + fn + fp")
    n = "(tp + fp + fn + tn)"
    return with_(SCORED, _conf(t, t)) + f"""
SELECT label, {rnd("precision")} AS precision, {rnd("recall")} AS recall, {rnd("f1_score")} AS f1_score,
       {rnd("support")} AS support FROM (
  SELECT 'Awake' AS label, {pa} AS precision, {ra} AS recall, {fa} AS f1_score, CAST(tn + fp AS DOUBLE) AS support FROM conf
  UNION ALL SELECT 'Fatigued', {pf}, {rf}, {ff}, CAST(tp + fn AS DOUBLE) FROM conf
  UNION ALL SELECT 'accuracy', NULL, NULL, {_div("tp + tn", n)}, CAST({n} AS DOUBLE) FROM conf
  UNION ALL SELECT 'macro avg', ({pa} + {pf}) / 2, ({ra} + {rf}) / 2, ({fa} + {ff}) / 2, CAST({n} AS DOUBLE) FROM conf
  UNION ALL SELECT 'weighted avg', {_div(f"({pa}) * (tn + fp) + ({pf}) * (tp + fn)", n)},
         {_div(f"({ra}) * (tn + fp) + ({rf}) * (tp + fn)", n)}, {_div(f"({fa}) * (tn + fp) + ({ff}) * (tp + fn)", n)},
         CAST({n} AS DOUBLE) FROM conf)"""


def q_pr_curve(tt: float = EVAL_T) -> str:
    return with_(SCORED, f"""
per AS (SELECT CAST(y_pred AS DOUBLE) AS threshold, sum(CASE WHEN y_true >= {tt} THEN 1 ELSE 0 END) AS pos,
               sum(CASE WHEN y_true >= {tt} THEN 0 ELSE 1 END) AS neg FROM scored GROUP BY y_pred),
c AS (SELECT threshold, sum(pos) OVER (ORDER BY threshold DESC) AS cp, sum(neg) OVER (ORDER BY threshold DESC) AS cn,
             sum(pos) OVER () AS p FROM per)""") + f"""
SELECT {rnd("threshold")} AS threshold, {rnd(_div("cp", "cp + cn"))} AS precision,
       {rnd("CASE WHEN p > 0 THEN cp * 1.0 / p ELSE 1.0 END")} AS recall FROM c
UNION ALL SELECT NULL, 1.0, 0.0"""


def q_roc_auc(tt: float = 0.5) -> str:
    return with_(SCORED, auc_sql(tt)) + f"""
SELECT {rnd("roc_auc")} AS roc_auc FROM auc"""


def q_inference_stats(t: float = EVAL_T) -> str:
    return with_(SCORED) + f"""
SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE y_pred >= {t}) AS BIGINT) AS fatigue_count,
       CAST(count(*) FILTER (WHERE y_pred < {t}) AS BIGINT) AS awake_count,
       {rnd(_div(f"count(*) FILTER (WHERE y_pred >= {t}) * 100.0", "count(*)"))} AS fatigue_pct,
       {rnd(_div(f"count(*) FILTER (WHERE y_pred < {t}) * 100.0", "count(*)"))} AS awake_pct,
       {rnd("avg(y_pred)")} AS mean_probability
FROM scored"""


# ---------------------------------------------------------------- drift
MONITORED = ("mean_hr_5min", "hr_volatility_5min", "hours_awake", "stress_cv")
DRIFT_SPLIT = "2024-01-16"
PI2 = 9.869604401089358  # pi ** 2


def _monitor_long() -> str:
    cols = ", ".join(MONITORED)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in MONITORED)
    return f"""
mon AS (SELECT CASE WHEN bin < epoch_us(TIMESTAMP '{DRIFT_SPLIT}') THEN 0 ELSE 1 END AS side, {cols}
        FROM bins WHERE mean_hr_5min IS NOT NULL AND hours_awake IS NOT NULL AND {nn}),
lng AS (UNPIVOT mon ON {cols} INTO NAME feature VALUE value),
rparams AS (SELECT feature, side, quantile_cont(value, 0.5) AS center,
                   quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr
            FROM lng GROUP BY feature, side),
scaled AS (SELECT l.feature, l.side, (l.value - p.center) / CASE WHEN p.iqr = 0 THEN 1.0 ELSE p.iqr END AS value
           FROM lng l JOIN rparams p ON l.feature = p.feature AND l.side = p.side)
"""


def _drift_base() -> str:
    return with_(FEEDS, INFER_USERS, HR_CLEAN, hr_features_sql(False), SLEEP_FEAT, CONTINUOUS, GRID, _monitor_long())


KS = f"""
per AS (SELECT feature, value, count(*) FILTER (WHERE side = 0) AS c0, count(*) FILTER (WHERE side = 1) AS c1
        FROM scaled GROUP BY feature, value),
cum AS (SELECT *, sum(c0) OVER w AS k0, sum(c1) OVER w AS k1,
               sum(c0) OVER (PARTITION BY feature) AS n0, sum(c1) OVER (PARTITION BY feature) AS n1
        FROM per WINDOW w AS (PARTITION BY feature ORDER BY value)),
ks0 AS (SELECT feature, max(abs(k0 / n0 - k1 / n1)) AS statistic, CAST(any_value(n0) AS BIGINT) AS n0, CAST(any_value(n1) AS BIGINT) AS n1,
               CAST(max(abs(k0 * n1 - k1 * n0)) AS BIGINT) AS top
        FROM cum GROUP BY feature),
ks1 AS (SELECT *, sqrt(CAST(n0 AS DOUBLE) * n1 / (CAST(n0 AS DOUBLE) + n1)) * statistic AS lam FROM ks0),
limit_p AS (SELECT *, greatest(0.0, least(1.0,
          CASE WHEN lam <= 0 THEN 1.0
               WHEN lam < 1 THEN 1 - {2.5066282746310002} / lam * list_sum(list_transform(range(1, 21),
                    lambda k: exp(-pow(2 * k - 1, 2) * {PI2} / (8 * lam * lam))))
               ELSE 2 * list_sum(list_transform(range(1, 21),
                    lambda k: pow(-1, k - 1) * exp(-2 * k * k * lam * lam))) END)) AS p_limit
       FROM ks1),
-- samples of at most 10,000 rows: the walk over (values of one, values of the other) of the
-- pooled sample, kept while it stays in the band around equal shares
walk AS (
  SELECT feature, n0, n1, n0 + n1 AS n, top, CAST(0 AS BIGINT) AS t, CAST(0 AS BIGINT) AS lo, [CAST(1 AS DOUBLE)] AS mass
  FROM ks1 WHERE top > 0 AND greatest(n0, n1) <= 10000
  UNION ALL
  SELECT feature, n0, n1, n, top, t + 1, lo2,
         list_transform(range(lo2, hi2 + 1), lambda i:
           CASE WHEN i - lo + 1 BETWEEN 1 AND len(mass) THEN mass[i - lo + 1] * (1 - CAST(n0 - i AS DOUBLE) / (n - t)) ELSE 0 END +
           CASE WHEN i - lo BETWEEN 1 AND len(mass) THEN mass[i - lo] * (n0 - i + 1) / (n - t) ELSE 0 END)
  FROM (SELECT *, greatest(0, t + 1 - n1, CAST(floor(((t + 1) * n0 - top) / n) AS BIGINT) + 1) AS lo2,
               least(n0, t + 1, CAST(ceil(((t + 1) * n0 + top) / n) AS BIGINT) - 1) AS hi2 FROM walk WHERE t < n)),
ks AS (SELECT l.feature, l.statistic, l.n0, l.n1,
              CASE WHEN greatest(l.n0, l.n1) > 10000 THEN l.p_limit WHEN l.top = 0 THEN 1.0
                   ELSE greatest(0.0, 1 - coalesce(w.mass[1], 0)) END AS p_value
       FROM limit_p l LEFT JOIN walk w ON w.feature = l.feature AND w.t = w.n)
"""


def q_robust_scale() -> str:
    return _drift_base() + f"""
SELECT feature, side, {rnd("center")} AS center, {rnd("CASE WHEN iqr = 0 THEN 1.0 ELSE iqr END")} AS scale
FROM rparams"""


def q_ks_drift() -> str:
    return _drift_base().replace("WITH", "WITH RECURSIVE", 1) + "," + KS + f"""
SELECT feature, {rnd("statistic")} AS statistic, {rnd("p_value")} AS p_value, p_value < 0.05 AS drift_detected,
       CAST(n0 AS BIGINT) AS n_reference, CAST(n1 AS BIGINT) AS n_current FROM ks"""


def q_drift_summary() -> str:
    n = len(MONITORED)
    return _drift_base().replace("WITH", "WITH RECURSIVE", 1) + "," + KS + f"""
SELECT CAST({n} AS BIGINT) AS n_features, CAST(count(*) FILTER (WHERE p_value < 0.05) AS BIGINT) AS n_drifted,
       {rnd(f"count(*) FILTER (WHERE p_value < 0.05) / {float(n)}")} AS drift_share,
       count(*) FILTER (WHERE p_value < 0.05) / {float(n)} < 0.3 AS drift_passed
FROM ks"""


def q_zscore_drift() -> str:
    return _drift_base() + f""",
fit AS (SELECT feature, avg(value) AS mean, CASE WHEN stddev_pop(value) = 0 THEN 1.0 ELSE stddev_pop(value) END AS std FROM lng WHERE side = 0 GROUP BY feature)
SELECT c.feature, {rnd("any_value(f.mean)")} AS mean, {rnd("any_value(f.std)")} AS std, {rnd("avg((c.value - f.mean) / f.std)")} AS z_mean,
       {rnd("avg(CAST(abs((c.value - f.mean) / f.std) > 3 AS DOUBLE))")} AS share_outside, avg(CAST(abs((c.value - f.mean) / f.std) > 3 AS DOUBLE)) > 0.15 AS alert
FROM lng c JOIN fit f ON f.feature = c.feature WHERE c.side = 1 GROUP BY c.feature"""


def q_label_drift(t: float, split: str) -> str:
    return _train_users() + f""",
l AS (SELECT CASE WHEN fatigue_score >= {t} THEN 'Fatigued' ELSE 'Awake' END AS label, TESTSTART >= TIMESTAMP '{split}' AS cur FROM matched),
s AS (SELECT label, count(*) FILTER (WHERE NOT cur) / (SELECT count(*) FROM l WHERE NOT cur) AS a,
             count(*) FILTER (WHERE cur) / (SELECT count(*) FROM l WHERE cur) AS b FROM l GROUP BY label)
SELECT label, {rnd("a")} AS share_reference, {rnd("b")} AS share_current, {rnd("b - a")} AS change, abs(b - a) > 0.15 AS alert FROM s"""


def q_stratified_sample(share: float, seed: int = 42) -> str:
    return f"""
SELECT l_returnflag, l_orderkey, l_linenumber FROM (
  SELECT l_returnflag, l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_returnflag) AS n,
         row_number() OVER (PARTITION BY l_returnflag ORDER BY md5('{seed}:' || l_orderkey || ':' || l_linenumber), l_orderkey, l_linenumber) AS r FROM lineitem)
WHERE r <= ceil({share} * n)"""


def q_density_histogram(nbins: int = 20) -> str:
    return _drift_base() + f""",
ext AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM scaled GROUP BY feature),
b AS (SELECT s.feature, s.side, e.lo, e.hi, (e.hi - e.lo) / {nbins} AS w,
             CASE WHEN (e.hi - e.lo) / {nbins} > 0
                  THEN least(CAST(floor((s.value - e.lo) / ((e.hi - e.lo) / {nbins})) AS INTEGER), {nbins - 1})
                  ELSE 0 END AS bin
      FROM scaled s JOIN ext e ON s.feature = e.feature),
cnt AS (SELECT feature, side, bin, any_value(lo) AS lo, any_value(w) AS w, count(*) AS c FROM b GROUP BY ALL),
n AS (SELECT feature, side, count(*) AS n FROM scaled GROUP BY ALL)
SELECT c.feature, c.side, c.bin, {rnd("c.lo + c.bin * c.w")} AS bin_lo, {rnd("c.lo + (c.bin + 1) * c.w")} AS bin_hi,
       {rnd("c.c / (n.n * CASE WHEN c.w > 0 THEN c.w ELSE 1.0 END)")} AS density
FROM cnt c JOIN n ON c.feature = n.feature AND c.side = n.side"""


MODEL_FEATURES = (
    "mean_hr_5min hr_volatility_5min hr_mean_total hr_std_total hr_zscore hr_jumpiness_5min stress_cv "
    "cum_sleep_debt hours_awake sleep_inertia_idx circadian_sin circadian_cos"
).split()


def q_impute_scale_fit() -> str:
    cols = ", ".join(MODEL_FEATURES)
    base = with_(FEEDS, TRAIN_USERS, HR_CLEAN, hr_features_sql(True), SLEEP_FEAT, CONTINUOUS, GRID, PVT_TARGETS, NEAREST)
    return base + f""",
feat_raw AS (SELECT {", ".join(f"b.{c}" for c in MODEL_FEATURES)}
        FROM cand c JOIN bins b ON c.user_id = b.user_id AND c.g = b.bin
        WHERE c.rk = 1 AND b.mean_hr_5min IS NOT NULL AND b.hours_awake IS NOT NULL AND c.fatigue_score IS NOT NULL),
lng AS (SELECT * FROM feat_raw UNPIVOT INCLUDE NULLS (value FOR feature IN ({cols}))),
fill AS (SELECT feature, quantile_cont(value, 0.5) AS fill FROM lng GROUP BY feature),
st AS (SELECT l.feature, avg(coalesce(l.value, f.fill, 0.0)) AS center, stddev_pop(coalesce(l.value, f.fill, 0.0)) AS sd
       FROM lng l JOIN fill f ON l.feature = f.feature GROUP BY l.feature)
SELECT f.feature, {rnd("f.fill")} AS fill, {rnd("s.center")} AS center, {rnd("CASE WHEN s.sd = 0 THEN 1.0 ELSE s.sd END")} AS scale
FROM fill f JOIN st s ON f.feature = s.feature"""


# ---------------------------------------------------------------- splits
def _train_users() -> str:
    return with_(FEEDS, TRAIN_USERS, HR_CLEAN, hr_features_sql(True), SLEEP_FEAT, CONTINUOUS, GRID, PVT_TARGETS, NEAREST)


def q_group_split(test_size: float = 0.2, seed: int = 42) -> str:
    return _train_users() + f""",
u AS (SELECT DISTINCT user_id FROM matched),
r AS (SELECT user_id, row_number() OVER (ORDER BY md5(concat('{seed}:', CAST(user_id AS VARCHAR))), user_id) - 1 AS rk,
             count(*) OVER () AS n FROM u)
SELECT user_id, CASE WHEN rk < ceil({test_size} * n) THEN 'test' ELSE 'train' END AS split FROM r"""


def _greedy(k: int) -> str:
    """CTE ``dealt`` (user_id, cnt, fold): users of ``sz`` one by one to the lightest fold."""
    zeros = ", ".join(["0"] * k)
    return f"""
rr AS (SELECT user_id, cnt, row_number() OVER (ORDER BY cnt DESC, user_id) AS i FROM sz),
step AS (
  SELECT CAST(0 AS BIGINT) AS i, CAST([{zeros}] AS BIGINT[]) AS loads, CAST(0 AS BIGINT) AS f
  UNION ALL
  SELECT i, list_transform(loads, lambda x, j: x + CASE WHEN j = f THEN cnt ELSE 0 END), f
  FROM (SELECT rr.i, rr.cnt, s.loads, list_position(s.loads, list_min(s.loads)) AS f FROM step s JOIN rr ON rr.i = s.i + 1)),
dealt AS (SELECT rr.user_id, rr.cnt, CAST(s.f - 1 AS INTEGER) AS fold FROM rr JOIN step s ON s.i = rr.i)"""


def q_group_kfold(k: int = 5) -> str:
    return _train_users().replace("WITH", "WITH RECURSIVE", 1) + f""",
sz AS (SELECT user_id, count(*) AS cnt FROM matched GROUP BY user_id),
{_greedy(k).strip()}
SELECT user_id, fold FROM dealt"""


# ---------------------------------------------------------------- requests / advice
DAY_US = 86_400_000_000

REQ_ROWS = f"""
req_hr AS (SELECT user_id, CAST(floor(epoch_us(HRTIME) / {DAY_US}) AS BIGINT) AS day, HRTIME, HR FROM hr_raw),
reqs AS (SELECT DISTINCT user_id, day FROM req_hr),
req_sleep AS (SELECT r.user_id, r.day, s."START", s."END" FROM reqs r JOIN sleep_raw s
              ON s.user_id = r.user_id AND CAST(floor(epoch_us(s."END") / {DAY_US}) AS BIGINT) BETWEEN r.day - 2 AND r.day)
"""

REQ_FEATURES = f"""
rhc AS (SELECT user_id, day, HRTIME, avg(HR) AS HR, epoch_us(HRTIME) AS t FROM req_hr
        WHERE HR > 1 AND HR < 180 GROUP BY user_id, day, HRTIME),
rw AS (SELECT *, lag(t) OVER wo AS pt, lag(HR) OVER wo AS ph,
              count(HR) OVER we AS ce, avg(HR) OVER we AS ae, stddev_samp(HR) OVER we AS se
       FROM rhc WINDOW wo AS (PARTITION BY user_id, day ORDER BY t),
                       we AS (PARTITION BY user_id, day ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
rd AS (SELECT *, abs(HR - ph) AS hr_diff FROM rw),
rr AS (SELECT user_id, day, t, HRTIME, HR,
              CASE WHEN ce >= 3 THEN ae END AS hr_mean_total,
              coalesce(CASE WHEN ce >= 3 THEN se END, 1.0) AS hr_std_total,
              CASE WHEN count(HR) OVER wr >= 3 THEN avg(HR) OVER wr END AS mean_hr_5min,
              CASE WHEN count(HR) OVER wr >= 3 THEN stddev_samp(HR) OVER wr END AS hr_volatility_5min,
              CASE WHEN count(hr_diff) OVER wr >= 3 THEN sqrt(avg(hr_diff * hr_diff) OVER wr) END AS hr_jumpiness_5min
       FROM rd WINDOW wr AS (PARTITION BY user_id, day ORDER BY t RANGE BETWEEN {W_US - 1} PRECEDING AND CURRENT ROW)),
rf AS (SELECT *, (HR - hr_mean_total) / (hr_std_total + 0.1) AS hr_zscore,
              hr_volatility_5min / (mean_hr_5min + 0.1) AS stress_cv FROM rr WHERE mean_hr_5min IS NOT NULL),
rsc AS (SELECT user_id, day, "START", "END", (epoch_us("END") - epoch_us("START")) / 3600000000.0 AS duration
        FROM req_sleep WHERE "START" IS NOT NULL AND "END" IS NOT NULL),
rsf AS (SELECT user_id, day, epoch_us("END") AS end_us,
               sum(8.0 - duration) OVER (PARTITION BY user_id, day ORDER BY "END", "START"
                                         ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS cum_sleep_debt
        FROM rsc WHERE duration > 0.25 AND duration < 36),
rj AS (SELECT h.*, s.cum_sleep_debt, coalesce((h.t - s.end_us) / 3600000000.0, 14.0) AS hours_awake
       FROM rf h ASOF LEFT JOIN rsf s ON h.user_id = s.user_id AND h.day = s.day AND h.t >= s.end_us),
rc AS (SELECT *, 1.0 / (hours_awake + 0.1) AS sleep_inertia_idx,
              sin(2 * pi() * (hour(HRTIME) + minute(HRTIME) / 60.0) / 24.0) AS circadian_sin,
              cos(2 * pi() * (hour(HRTIME) + minute(HRTIME) / 60.0) / 24.0) AS circadian_cos,
              row_number() OVER (PARTITION BY user_id, day ORDER BY t DESC) AS rn FROM rj),
rmean AS (SELECT user_id, day, avg(HR) AS m FROM rhc GROUP BY user_id, day),
rvec AS (
  SELECT r.user_id, r.day, l.rn IS NOT NULL AS has_features,
         CASE WHEN l.rn IS NULL THEN coalesce(m.m, 75.0) ELSE coalesce(l.mean_hr_5min, 0.0) END AS mean_hr_5min,
         CASE WHEN l.rn IS NULL THEN 0.0 ELSE coalesce(l.hr_volatility_5min, 0.0) END AS hr_volatility_5min,
         CASE WHEN l.rn IS NULL THEN coalesce(m.m, 75.0) ELSE coalesce(l.hr_mean_total, 0.0) END AS hr_mean_total,
         CASE WHEN l.rn IS NULL THEN 0.0 ELSE coalesce(l.hr_std_total, 0.0) END AS hr_std_total,
         CASE WHEN l.rn IS NULL THEN 0.0 ELSE coalesce(l.hr_zscore, 0.0) END AS hr_zscore,
         CASE WHEN l.rn IS NULL THEN 0.0 ELSE coalesce(l.hr_jumpiness_5min, 0.0) END AS hr_jumpiness_5min,
         CASE WHEN l.rn IS NULL THEN 0.0 ELSE coalesce(l.stress_cv, 0.0) END AS stress_cv,
         CASE WHEN l.rn IS NULL THEN 2.0 ELSE coalesce(l.cum_sleep_debt, 0.0) END AS cum_sleep_debt,
         CASE WHEN l.rn IS NULL THEN 16.0 ELSE coalesce(l.hours_awake, 0.0) END AS hours_awake,
         CASE WHEN l.rn IS NULL THEN 0.1 ELSE coalesce(l.sleep_inertia_idx, 0.0) END AS sleep_inertia_idx,
         CASE WHEN l.rn IS NULL THEN 0.0 ELSE coalesce(l.circadian_sin, 0.0) END AS circadian_sin,
         CASE WHEN l.rn IS NULL THEN 0.0 ELSE coalesce(l.circadian_cos, 0.0) END AS circadian_cos
  FROM reqs r LEFT JOIN (SELECT * FROM rc WHERE rn = 1) l ON r.user_id = l.user_id AND r.day = l.day
  LEFT JOIN rmean m ON r.user_id = m.user_id AND r.day = m.day)
"""


def q_request_features() -> str:
    return with_(FEEDS, REQ_ROWS, REQ_FEATURES) + f"""
SELECT concat_ws('-', user_id, day) AS request_id, {r6(MODEL_FEATURES)}, has_features FROM rvec"""


def q_payload_parse() -> str:
    return with_(FEEDS, REQ_ROWS) + """
SELECT concat_ws('-', user_id, day) AS request_id, HRTIME, round((HR) + 2.5e-8, 6) AS HR FROM req_hr"""


def q_safety_overrides() -> str:
    return with_(FEEDS, REQ_ROWS) + """,
s AS (SELECT user_id, day, sum((epoch_us("END") - epoch_us("START")) / 3.6e9) AS tot FROM req_sleep GROUP BY ALL),
h AS (SELECT user_id, day, min(HR) AS min_hr, hour(max(HRTIME)) AS last_hour FROM req_hr GROUP BY ALL),
x AS (SELECT h.*, coalesce(s.tot, 0.0) AS total_sleep_h FROM h LEFT JOIN s ON h.user_id = s.user_id AND h.day = s.day)
SELECT concat_ws('-', user_id, day) AS request_id, round((total_sleep_h) + 2.5e-8, 6) AS total_sleep_h,
       round((min_hr) + 2.5e-8, 6) AS min_hr, CAST(last_hour AS INTEGER) AS last_hour,
       round((CASE WHEN total_sleep_h < 15 THEN 0.95 WHEN min_hr > 90 THEN 0.8142
            WHEN last_hour BETWEEN 2 AND 5 AND total_sleep_h < 18 THEN 0.8871 END) + 2.5e-8, 6) AS override_probability,
       (total_sleep_h < 15 OR min_hr > 90 OR (last_hour BETWEEN 2 AND 5 AND total_sleep_h < 18)) AS override_fatigued,
       CASE WHEN total_sleep_h < 15 THEN 'CRIT' WHEN min_hr > 90 THEN 'WARN'
            WHEN last_hour BETWEEN 2 AND 5 AND total_sleep_h < 18 THEN 'NIGHT' END AS override_rule,
       CASE WHEN total_sleep_h < 15 THEN '""" + SAFETY_RULES[0][1] + """' WHEN min_hr > 90 THEN '""" + SAFETY_RULES[1][1] + """'
            WHEN last_hour BETWEEN 2 AND 5 AND total_sleep_h < 18 THEN '""" + SAFETY_RULES[2][1] + """' END AS override_advice
FROM x"""


KB = """
kb AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, row_number() OVER (ORDER BY vec_id) - 1 AS rk
       FROM (SELECT * FROM embeddings ORDER BY vec_id LIMIT 5)),
kbn AS (SELECT *, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS nk FROM kb)
"""


def _sim(q: str) -> str:
    return (f"list_sum(list_transform(list_zip(CAST({q}.embedding AS DOUBLE[]), kbn.e), lambda p: p[1] * p[2])) / "
            f"(sqrt(list_sum(list_transform(CAST({q}.embedding AS DOUBLE[]), lambda x: x * x))) * kbn.nk)")


def q_kb_match() -> str:
    return with_(KB) + f""",
sims AS (SELECT q.vec_id, kbn.vec_id AS kb_id, kbn.rk, {_sim("q")} AS sim FROM embeddings q CROSS JOIN kbn),
best AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, rk) AS rn FROM sims)
SELECT vec_id, kb_id, CAST(rk AS INTEGER) AS kb_rank, round((sim) + 2.5e-8, 6) AS similarity FROM best WHERE rn = 1"""


FALLBACK = f"""
qv AS (SELECT * FROM embeddings ORDER BY vec_id LIMIT 1 OFFSET 5),
fb AS (SELECT kbn.rk FROM qv CROSS JOIN kbn ORDER BY {_sim("qv")} DESC, kbn.rk LIMIT 1)
"""
COURSE_IDS = ("acute_recovery", "sleep_debt", "stress_awareness", "circadian", "physiological")


def q_advice() -> str:
    ids = ", ".join(f"'{c}'" for c in COURSE_IDS)
    texts = ", ".join("'" + c[2].replace("'", "''") + "'" for c in COURSES)
    base = with_(FEEDS, TRAIN_USERS, HR_CLEAN, hr_features_sql(True), SLEEP_FEAT, CONTINUOUS, GRID, PVT_TARGETS, NEAREST, KB, FALLBACK)
    return base + f""",
c AS (SELECT m.*, CASE WHEN coalesce(m.hours_awake, 0) > 14 THEN 0 WHEN coalesce(m.cum_sleep_debt, 0) > 3 THEN 1
                       WHEN coalesce(m.stress_cv, 0) > 0.15 THEN 2 ELSE (SELECT rk FROM fb) END AS rank
      FROM matched m)
SELECT user_id, TESTSTART, TESTID, offset_us, ([{ids}])[rank + 1] AS course_id, fatigue_score > 0.3 AS gets_advice,
  CASE WHEN fatigue_score > 0.3 THEN '{ADVICE_PREFIX}' || ([{texts}])[rank + 1] END AS advice
FROM c"""


def q_asof_nearest_tests(tol_us: int = TOL_US) -> str:
    return with_(FEEDS, "hr_src AS (SELECT * FROM hr_raw)", HR_CLEAN) + f""",
p AS (SELECT DISTINCT user_id, TESTSTART, TESTID FROM pvt_raw),
c AS (SELECT p.*, h.HRTIME AS nearest_hrtime, h.HR AS nearest_hr,
             row_number() OVER (PARTITION BY p.user_id, p.TESTSTART, p.TESTID
                                ORDER BY abs(h.t - epoch_us(p.TESTSTART)), h.t) AS rn
      FROM p JOIN hr_clean h ON p.user_id = h.user_id AND abs(h.t - epoch_us(p.TESTSTART)) <= {tol_us})
SELECT p.user_id, p.TESTSTART, p.TESTID, c.nearest_hrtime, round((c.nearest_hr) + 2.5e-8, 6) AS nearest_hr
FROM p LEFT JOIN (SELECT * FROM c WHERE rn = 1) c
  ON p.user_id = c.user_id AND p.TESTSTART = c.TESTSTART AND p.TESTID = c.TESTID"""


def q_asof_backward_sleep() -> str:
    return with_(FEEDS, "hr_src AS (SELECT * FROM hr_raw)", "sleep_src AS (SELECT * FROM sleep_raw)", HR_CLEAN, SLEEP_FEAT) + """
SELECT h.user_id, h.HRTIME, s."END" AS last_sleep_end, round((s.cum_sleep_debt) + 2.5e-8, 6) AS cum_sleep_debt
FROM hr_clean h ASOF LEFT JOIN sleep_feat s ON h.user_id = s.user_id AND h.t >= s.end_us"""


# ---------------------------------------------------------------- sources
def q_csv_roundtrip() -> str:
    return with_(FEEDS) + """
SELECT user_id, HRTIME, round((HR) + 2.5e-8, 6) AS HR FROM hr_raw"""


def q_limit_rows(n: int = 1000) -> str:
    return f"""
SELECT o_orderkey, o_custkey, o_orderstatus, round((o_totalprice) + 2.5e-8, 6) AS o_totalprice, o_orderdate,
       o_orderpriority FROM orders ORDER BY o_orderkey LIMIT {n}"""


def q_discover_users() -> str:
    return with_(FEEDS) + """
SELECT DISTINCT user_id FROM hr_raw"""


def q_users_with_all_feeds() -> str:
    return with_(FEEDS, TRAIN_USERS) + """
SELECT user_id FROM users"""


def q_dataset_profile() -> str:
    return """
SELECT 'importances' AS name, 'orders' AS source, CAST(count(*) AS BIGINT) AS num_rows, CAST(2 AS BIGINT) AS num_columns,
       'Feature:string,Importance:double' AS columns,
       '{"Feature":' || count(*) FILTER (WHERE o_orderkey % 5 = 0 OR o_orderpriority IS NULL) || ',"Importance":' ||
       count(*) FILTER (WHERE o_orderkey % 8 = 0 OR o_totalprice IS NULL) || '}' AS null_counts, true AS has_digest FROM orders"""


def q_split_outputs_test() -> str:
    return _train_users() + f""",
u AS (SELECT DISTINCT user_id FROM matched),
r AS (SELECT user_id, row_number() OVER (ORDER BY md5(concat('42:', CAST(user_id AS VARCHAR))), user_id) - 1 AS rk,
             count(*) OVER () AS n FROM u)
SELECT m.user_id, m.TESTSTART, m.TESTID, m.offset_us, {", ".join("m." + c for c in MODEL_FEATURES)}
FROM matched m JOIN r ON m.user_id = r.user_id WHERE r.rk < ceil(0.2 * r.n)"""


def q_inference_ids() -> str:
    return with_(FEEDS, INFER_USERS, HR_CLEAN, hr_features_sql(False), SLEEP_FEAT, CONTINUOUS, GRID) + """
SELECT user_id, make_timestamp(bin) AS HRTIME FROM bins WHERE mean_hr_5min IS NOT NULL AND hours_awake IS NOT NULL"""


def q_stream_minute_grid(delay_us: int = 15 * 60_000_000) -> str:
    return with_(FEEDS) + f""",
h AS (SELECT user_id, HRTIME, HR FROM hr_raw WHERE HR > 1 AND HR < 180),
g AS (SELECT user_id, time_bucket(INTERVAL 1 MINUTE, HRTIME) AS HRTIME, avg(HR) AS HR, count(*) AS n FROM h GROUP BY ALL)
SELECT user_id, HRTIME, round((HR) + 2.5e-8, 6) AS HR, CAST(n AS BIGINT) AS n_readings FROM g
WHERE epoch_us(HRTIME) + 60000000 <= (SELECT epoch_us(max(HRTIME)) FROM h) - {delay_us}"""


def q_validate_inputs() -> str:
    """Same rules as ``schemas.MODEL_INPUTS`` on the inference features."""
    base = with_(FEEDS, INFER_USERS, HR_CLEAN, hr_features_sql(False), SLEEP_FEAT, CONTINUOUS, GRID) + """,
inf AS (SELECT * FROM bins WHERE mean_hr_5min IS NOT NULL AND hours_awake IS NOT NULL)"""
    parts = []
    for f in MODEL_FEATURES:
        parts.append(f"SELECT 'coerce:{f}' AS rule, 0 AS n_bad")
        if f != "hr_jumpiness_5min":
            parts.append(f"SELECT 'null:{f}', count(*) FILTER (WHERE {f} IS NULL) FROM inf")
        if f in ("circadian_sin", "circadian_cos"):
            parts.append(f"SELECT 'ge:{f}', count(*) FILTER (WHERE {f} < -1.0) FROM inf")
            parts.append(f"SELECT 'le:{f}', count(*) FILTER (WHERE {f} > 1.0) FROM inf")
    parts.append("SELECT 'coerce:user_id', 0")
    parts.append("SELECT 'unexpected:HRTIME', 1")
    return base + "\nSELECT 'ModelInputs' AS schema, rule, CAST(n_bad AS BIGINT) AS n_bad FROM (" + "\nUNION ALL ".join(parts) + ")"


def q_metric_thresholds() -> str:
    limits = "(VALUES ('rmse', 0.5, false), ('mae', 0.45, false), ('r2', 0.0, true)) t(metric, threshold, greater_is_better)"
    return f"""
WITH m AS ({q_regression_metrics()})
SELECT m.metric, m.value, round((t.threshold) + 2.5e-8, 6) AS threshold, t.greater_is_better,
       CASE WHEN t.greater_is_better THEN m.value >= t.threshold ELSE m.value <= t.threshold END AS passed
FROM m JOIN {limits} ON m.metric = t.metric"""


# ---------------------------------------------------------------- model outputs
def _small_tree(least_split: int = 18, least_leaf: int = 2, bins: int = 32) -> str:
    """One tree of depth 2 on the training side of the user split, without a bootstrap and
    over all features: cuts at quantiles, the split whose squared error falls most (ties:
    first feature, lowest cut). Targets count in units of 2^-24 of the largest, as the
    grower adds them. CTEs: ``parts`` (samples with split and rid), ``x`` (rid, fi,
    value: filled), ``leaf`` (rid, node), ``node`` (id, feature, threshold, n, value)."""
    names = ", ".join(f"({i}, '{f}')" for i, f in enumerate(MODEL_FEATURES))
    probs = ", ".join(str(k / bins) for k in range(1, bins))
    whole = "s::DOUBLE * s / n"

    def best(source: str, out: str) -> str:
        return f"""
{out}_all AS (
  SELECT t.node, c.fi, c.cut, t.n, t.s, count(*) FILTER (WHERE x.value <= c.cut) AS ln,
         coalesce(sum(r.y) FILTER (WHERE x.value <= c.cut), 0)::DOUBLE AS ls
  FROM {source} r JOIN x ON x.rid = r.rid JOIN cuts c ON c.fi = x.fi
  JOIN (SELECT node, count(*) AS n, sum(y)::DOUBLE AS s FROM {source} GROUP BY node) t ON t.node = r.node
  GROUP BY ALL),
{out} AS (
  SELECT * FROM (
    SELECT *, ls * ls / nullif(ln, 0) + (s - ls) * (s - ls) / nullif(n - ln, 0) - {whole} AS gain FROM {out}_all
    WHERE n >= {least_split} AND ln >= {least_leaf} AND n - ln >= {least_leaf})
  WHERE gain > 1e-9 * greatest({whole}, 1)
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, fi, cut) = 1)"""

    def child(source: str, split: str) -> str:
        return f"""
  SELECT r.rid, r.y, CASE WHEN b.node IS NULL THEN r.node WHEN x.value <= b.cut THEN 2 * r.node ELSE 2 * r.node + 1 END AS node, b.node IS NULL AS done
  FROM {source} r LEFT JOIN {split} b ON b.node = r.node LEFT JOIN x ON x.rid = r.rid AND x.fi = b.fi"""

    return _train_users() + f""",
u AS (SELECT DISTINCT user_id FROM matched),
rk AS (SELECT user_id, row_number() OVER (ORDER BY md5(concat('42:', CAST(user_id AS VARCHAR))), user_id) - 1 AS rk,
              count(*) OVER () AS n FROM u),
parts AS MATERIALIZED (SELECT m.*, CASE WHEN r.rk < ceil(0.2 * r.n) THEN 'test' ELSE 'train' END AS split,
                 row_number() OVER (ORDER BY m.user_id, m.TESTSTART, m.TESTID, m.offset_us) AS rid
          FROM matched m JOIN rk r ON m.user_id = r.user_id),
names AS (SELECT * FROM (VALUES {names}) t(fi, feature)),
lng AS (SELECT rid, split, feature, value FROM (SELECT rid, split, {", ".join(MODEL_FEATURES)} FROM parts)
        UNPIVOT INCLUDE NULLS (value FOR feature IN ({", ".join(MODEL_FEATURES)}))),
fill AS (SELECT feature, quantile_cont(value, 0.5) AS fill FROM lng WHERE split = 'train' GROUP BY feature),
x AS MATERIALIZED (SELECT l.rid, l.split, n.fi, coalesce(l.value, f.fill, 0) AS value FROM lng l JOIN names n ON n.feature = l.feature JOIN fill f ON f.feature = l.feature),
cuts AS MATERIALIZED (SELECT DISTINCT fi, unnest(q) AS cut FROM (SELECT fi, quantile_disc(value, [{probs}]) AS q FROM x WHERE split = 'train' GROUP BY fi)),
unit AS (SELECT max(abs(fatigue_score)) / 16777216 AS u FROM parts WHERE split = 'train'),
all1 AS MATERIALIZED (SELECT rid, CAST(round(fatigue_score / u) AS BIGINT) AS y, 1 AS node, split FROM parts, unit),
row1 AS (SELECT * FROM all1 WHERE split = 'train'),
{best("row1", "split1").strip()},
row2 AS MATERIALIZED (SELECT * FROM ({child("row1", "split1")}) WHERE NOT done),
{best("row2", "split2").strip()},
all2 AS ({child("all1", "split1")}),
leaf AS MATERIALIZED ({child("all2", "split2")}),
seen AS (SELECT node, y FROM row1 UNION ALL SELECT node, y FROM row2
         UNION ALL SELECT l.node, l.y FROM leaf l JOIN parts p ON p.rid = l.rid WHERE p.split = 'train' AND NOT l.done),
splits AS (SELECT * FROM split1 UNION ALL SELECT * FROM split2),
node AS (SELECT v.node AS id, n.feature, b.cut AS threshold, v.n, v.s * (SELECT u FROM unit) / v.n AS value
         FROM (SELECT node, count(*) AS n, sum(y)::DOUBLE AS s FROM seen GROUP BY node) v
         LEFT JOIN splits b ON b.node = v.node LEFT JOIN names n ON n.fi = b.fi)"""


def q_small_tree() -> str:
    return _small_tree() + f"""
SELECT CAST(id AS BIGINT) AS id, feature, {rnd("threshold")} AS threshold, CAST(n AS BIGINT) AS n, {rnd("value")} AS value FROM node"""


def q_stitched_predictions(t: float) -> str:
    feats = ", ".join("p." + c for c in MODEL_FEATURES)
    return _small_tree() + f"""
SELECT p.user_id, p.TESTSTART, p.TESTID, p.offset_us, {feats}, {rnd("p.fatigue_score")} AS fatigue_score, {rnd("n.value")} AS prediction,
  CAST(n.value >= {t} AS INTEGER) AS fatigue_event_alert, CASE WHEN n.value >= {t} THEN 'Fatigued' ELSE 'Awake' END AS status
FROM parts p JOIN leaf l ON l.rid = p.rid JOIN node n ON n.id = l.node WHERE p.split = 'test'"""


def _split_of(side: str) -> str:
    """Training samples of one side of the user split (CTE ``part``)."""
    cmp = "<" if side == "test" else ">="
    return _train_users() + f""",
u AS (SELECT DISTINCT user_id FROM matched),
r AS (SELECT user_id, row_number() OVER (ORDER BY md5(concat('42:', CAST(user_id AS VARCHAR))), user_id) - 1 AS rk,
             count(*) OVER () AS n FROM u),
part AS (SELECT m.* FROM matched m JOIN r ON m.user_id = r.user_id WHERE r.rk {cmp} ceil(0.2 * r.n))"""


def q_model_importance() -> str:
    return "SELECT feature, true AS in_range, true AS sums_to_one FROM (VALUES " + ", ".join(f"('{f}')" for f in MODEL_FEATURES) + ") t(feature)"


def q_batch_inference() -> str:
    return f"SELECT user_id, HRTIME, true AS in_range, true AS alert_matches, true AS status_matches FROM ({q_inference_ids()})"


def q_evaluate_model(t: float) -> str:
    return _split_of("test") + f""",
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE fatigue_score >= {t}) AS pos FROM part)
SELECT 'regression' AS part, metric AS name, CAST(NULL AS BIGINT) AS n, true AS ok FROM (VALUES ('mae'), ('mse'), ('rmse'), ('r2')) v(metric)
UNION ALL SELECT 'report', 'Fatigued', pos, true FROM c
UNION ALL SELECT 'report', 'Awake', n - pos, true FROM c
UNION ALL SELECT 'report', label, n, true FROM c, (VALUES ('accuracy'), ('macro avg'), ('weighted avg')) v(label)
UNION ALL SELECT 'pr_curve', 'points', NULL, true
UNION ALL SELECT 'stats', 'total', n, true FROM c"""


def q_explain_samples() -> str:
    return _split_of("test") + "\nSELECT user_id, TESTSTART, TESTID, offset_us, true AS additive FROM part"


def q_cross_validate(k: int) -> str:
    return _split_of("train").replace("WITH", "WITH RECURSIVE", 1) + f""",
sz AS (SELECT user_id, count(*) AS cnt FROM part GROUP BY user_id),
{_greedy(k).strip()}
SELECT fold, CAST(sum(cnt) AS BIGINT) AS n_test, true AS rmse_in_range, true AS recall_in_range FROM dealt GROUP BY fold"""


def q_score_requests() -> str:
    return (
        "SELECT request_id, has_features, true AS has_course, true AS in_range, true AS flag_matches, true AS advice_matches "
        f"FROM ({q_request_features()})"
    )


# ---------------------------------------------------------------- validation
_DIRTY_HR = """
dirty AS (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 10 = 3 THEN 'u' || user_id ELSE CAST(user_id AS VARCHAR) END AS id,
                 CAST(ts AS VARCHAR) AS HRTIME, CASE WHEN event_id % 13 = 0 THEN NULL ELSE value - 50 END AS HR FROM events)"""
_HR_RULES = {
    "coerce:id": "id IS NOT NULL AND TRY_CAST(id AS BIGINT) IS NULL",
    "null:id": "id IS NULL",
    "coerce:HRTIME": "false",
    "null:HRTIME": "HRTIME IS NULL",
    "coerce:HR": "false",
    "gt:HR": "HR <= 0",
}


def q_validate_raw() -> str:
    sleep = {
        "coerce:id": "false", "null:id": "o_orderkey IS NULL", "coerce:START": "false", "null:START": "o_orderdate IS NULL",
        "coerce:END": "false", "null:END": "o_orderdate IS NULL", "coerce:rating": "false",
        "null:rating": "o_orderkey % 9 = 0 OR o_totalprice IS NULL", "gt:rating": "o_orderkey % 9 <> 0 AND o_totalprice - 100000 <= 0",
        "coerce:comments": "false",
    }
    score = "(l_discount * 12 - 0.2)"
    targets = {
        "coerce:fatigue_score": "false", "null:fatigue_score": "l_discount IS NULL", "ge:fatigue_score": f"{score} < 0",
        "le:fatigue_score": f"{score} > 1", "coerce:user_id": "false",
    }
    parts = []
    for schema, source, rules in (("HeartRateRaw", "dirty", _HR_RULES), ("SleepRaw", "orders", sleep), ("Targets", "lineitem", targets)):
        parts += [f"SELECT '{schema}' AS schema, '{r}' AS rule, count(*) FILTER (WHERE {c}) AS n_bad FROM {source}" for r, c in rules.items()]
    return "WITH " + _DIRTY_HR.strip() + "\n" + "\nUNION ALL ".join(parts)


def _all_rules() -> dict[str, tuple[str, dict[str, str]]]:
    """schema -> (source, rule -> condition that breaks it)."""
    pvt = {
        "coerce:id": "l_orderkey % 13 = 0", "null:id": "l_orderkey IS NULL", "coerce:TESTID": "false", "null:TESTID": "l_linenumber IS NULL",
        "coerce:TESTSTART": "false", "null:TESTSTART": "l_orderkey % 17 = 0 OR l_shipdate IS NULL", "coerce:TRIALID": "false", "null:TRIALID": "l_partkey IS NULL",
        "coerce:TRIALNAME": "false", "null:TRIALNAME": "l_returnflag IS NULL", "coerce:TRIALSTART": "false", "null:TRIALSTART": "l_shipdate IS NULL",
        "coerce:TAPTIME": "false", "null:TAPTIME": "l_quantity IS NULL", "ge:TAPTIME": "l_quantity * 10 - 50 < 0",
    }
    score = "(l_discount * 12 - 0.2)"
    outputs = {"coerce:prediction": "false", "null:prediction": "l_discount IS NULL", "ge:prediction": f"{score} < 0", "le:prediction": f"{score} > 1", "coerce:user_id": "false"}
    shap = {"coerce:mean_hr_5min": "event_id % 7 = 0", "coerce:stress_cv": "false"}
    importances = {
        "coerce:Feature": "false", "null:Feature": "o_orderkey % 5 = 0 OR o_orderpriority IS NULL", "coerce:Importance": "false",
        "null:Importance": "o_orderkey % 8 = 0 OR o_totalprice IS NULL",
    }
    inputs = {}
    for f in MODEL_FEATURES:
        inputs[f"coerce:{f}"] = "false"
        if f.startswith("circadian"):
            v = "(value / 50 - 1)" if f.endswith("sin") else "(value / 60 - 1.5)"
            inputs |= {f"null:{f}": "value IS NULL", f"ge:{f}": f"{v} < -1", f"le:{f}": f"{v} > 1"}
        elif f != "hr_jumpiness_5min":
            inputs[f"null:{f}"] = "event_id % 9 = 0 OR value IS NULL"
    inputs["coerce:user_id"] = "false"
    sleep = {
        "coerce:id": "false", "null:id": "o_orderkey IS NULL", "coerce:START": "false", "null:START": "o_orderdate IS NULL",
        "coerce:END": "false", "null:END": "o_orderdate IS NULL", "coerce:rating": "false",
        "null:rating": "o_orderkey % 9 = 0 OR o_totalprice IS NULL", "gt:rating": "o_orderkey % 9 <> 0 AND o_totalprice - 100000 <= 0",
        "coerce:comments": "false",
    }
    targets = {
        "coerce:fatigue_score": "false", "null:fatigue_score": "l_discount IS NULL", "ge:fatigue_score": f"{score} < 0",
        "le:fatigue_score": f"{score} > 1", "coerce:user_id": "false",
    }
    return {
        "HeartRateRaw": ("dirty", _HR_RULES), "SleepRaw": ("orders", sleep), "Targets": ("lineitem", targets), "PVTRaw": ("lineitem", pvt), "Outputs": ("lineitem", outputs),
        "SHAPValues": ("events", shap), "FeatureImportances": ("orders", importances), "ModelInputs": ("events", inputs),
    }


def q_validate_all() -> str:
    parts = []
    for schema, (source, rules) in _all_rules().items():
        bad = " OR ".join(f"coalesce({c}, false)" for c in rules.values())
        rules = rules | {"rows:rejected": bad, "rows:valid": f"NOT ({bad})"}
        parts += [f"SELECT '{schema}' AS schema, '{r}' AS rule, count(*) FILTER (WHERE {c}) AS n_bad FROM {source}" for r, c in rules.items()]
    return "WITH " + _DIRTY_HR.strip() + "\n" + "\nUNION ALL ".join(parts)


def q_rejected_pvt() -> str:
    _, rules = _all_rules()["PVTRaw"]
    broken = ", ".join(f"CASE WHEN {c} THEN '{r}' END" for r, c in rules.items() if c != "false")
    return f"""
SELECT concat_ws(',', {broken}) AS rules, CASE WHEN l_orderkey % 13 = 0 THEN 'u' ELSE '' END || l_orderkey AS id,
       CAST(l_linenumber AS BIGINT) AS test_id, {rnd("l_quantity * 10 - 50")} AS tap
FROM lineitem WHERE {" OR ".join(f"coalesce({c}, false)" for c in rules.values())}"""


def q_csv_rejects() -> str:
    return """
SELECT CASE event_id % 10 WHEN 3 THEN event_id || ',' || user_id WHEN 5 THEN event_id || ',u,' || user_id
            WHEN 7 THEN event_id || ',' || user_id || ',1,2' ELSE event_id || ':' || user_id || ':' || event_id % 100 END AS line
FROM events"""


def q_adapter_inference(rule: dict[str, float], constant: float, t: float) -> str:
    score = " + ".join([str(constant), *[f"coalesce({f}, 0) * {w}" for f, w in rule.items()]])
    return with_(FEEDS, INFER_USERS, HR_CLEAN, hr_features_sql(False), SLEEP_FEAT, CONTINUOUS, GRID) + f""",
s AS (SELECT user_id, make_timestamp(bin) AS HRTIME, greatest(0.0, least(1.0, {score})) AS p
      FROM bins WHERE mean_hr_5min IS NOT NULL AND hours_awake IS NOT NULL)
SELECT user_id, HRTIME, {rnd("p")} AS fatigue_probability, CAST(p >= {t} AS INTEGER) AS fatigue_event_alert,
       CASE WHEN p >= {t} THEN 'Fatigued' ELSE 'Awake' END AS status FROM s"""


def q_rejected_rows() -> str:
    parts = [f"SELECT 'HeartRateRaw' AS schema, '{r}' AS rule, event_id FROM dirty WHERE {c}" for r, c in _HR_RULES.items()]
    return "WITH " + _DIRTY_HR.strip() + "\n" + "\nUNION ALL ".join(parts)


# ---------------------------------------------------------------- written outputs
def q_split_outputs() -> str:
    """All six outputs stacked: split x (inputs, targets, ids)."""
    feats = ", ".join(f"CASE WHEN o.output = 'inputs' THEN {rnd('m.' + c)} END AS {c}" for c in MODEL_FEATURES)
    return _train_users() + f""",
u AS (SELECT DISTINCT user_id FROM matched),
r AS (SELECT user_id, row_number() OVER (ORDER BY md5(concat('42:', CAST(user_id AS VARCHAR))), user_id) - 1 AS rk,
             count(*) OVER () AS n FROM u)
SELECT CASE WHEN r.rk < ceil(0.2 * r.n) THEN 'test' ELSE 'train' END AS split, o.output, m.user_id, m.TESTSTART, m.TESTID, m.offset_us,
  {feats}, CASE WHEN o.output = 'targets' THEN m.fatigue_score END AS fatigue_score
FROM matched m JOIN r ON m.user_id = r.user_id, (VALUES ('inputs'), ('targets'), ('ids')) o(output)"""
