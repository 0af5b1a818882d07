"""Registered queries: each binds operators to the driver's tables.

Every callable takes (spark, sf_dir) and returns a DataFrame over the whole
tables; the matching DuckDB statement lives in :mod:`wakeful.plans.oracle_sql`.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeful.functions.scalar import nan_to_null, parse_time, ts_us
from wakeful.operators.clean import clean_hr, clean_pvt, clean_sleep, select_monitor_columns
from wakeful.operators.windows import hr_series_features, sleep_features
from wakeful.plans import oracle_sql as O
from wakeful.plans.features import (
    continuous_features,
    feature_grid,
    inference_features,
    labelled_features,
    round_doubles,
)
from wakeful.session import configure, cut_lineage
from wakeful.settings import EVENTS_SCALE as S
from wakeful.operators import drift as D
from wakeful.operators import metrics as M
from wakeful.operators.forest import ForestParams, fit_forest, node_rows
from wakeful.operators.split import group_kfold, group_split, stratified_sample
from wakeful.operators.treeshap import shap_additivity
from wakeful.plans import modeling as MD
from wakeful.plans import scoring as SC
from wakeful.operators import advise as AD
from wakeful.operators import predictors as PR
from wakeful.operators import schemas as SCH
from wakeful.operators.asof import asof_backward, asof_nearest
from wakeful.sources import files as FS
from wakeful.sources.feeds import kb_feed
from wakeful.sources.payload import build_requests, parse_payload, payload_hr, request_rows
from wakeful.streaming import telemetry as ST
from wakeful.session import scratch_path
from wakeful.settings import FEATURE_COLS, INFER_COLS, MICROS_PER_DAY, MODEL_FEATURES, MONITORED
from wakeful.sources.feeds import events_feeds, scored_feed, table
from wakeful.sources.files import users_with_all_feeds

Query = Callable[[SparkSession, str], DataFrame]


def _feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    configure(spark)
    return events_feeds(spark, sf_dir)


def hr_clean_q(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    return round_doubles(clean_hr(f["hr"], S).select("user_id", "HRTIME", "HR"))


def hr_features_q(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    hr = clean_hr(f["hr"], S, bucketed=True)
    out = hr_series_features(hr, S, passthrough=("HRTIME",)).drop("b")
    cols = "HR hr_diff hr_mean_total hr_std_total hr_zscore mean_hr_5min hr_volatility_5min hr_jumpiness_5min stress_cv"
    return round_doubles(out.select("user_id", "HRTIME", *cols.split()))


def sleep_features_q(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    sl = sleep_features(clean_sleep(f["sleep"], S), S)
    return round_doubles(sl.select("user_id", "START", F.col("END").alias("last_sleep_end"), "duration", "cum_sleep_debt"))


def pvt_targets_q(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    return round_doubles(clean_pvt(f["pvt"], S, min_year=S.pvt_min_year))


def _train_feeds(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    users = users_with_all_feeds([f["hr"], f["sleep"], f["pvt"]])
    return {k: v.join(users, "user_id", "left_semi") for k, v in f.items()}


def continuous_features_q(spark, sf_dir):
    f = _train_feeds(spark, sf_dir)
    cont = continuous_features(f["hr"], f["sleep"], S)
    return round_doubles(cont.select("user_id", "HRTIME", "START", "last_sleep_end", *FEATURE_COLS))


def feature_grid_q(spark, sf_dir):
    f = _train_feeds(spark, sf_dir)
    bins = feature_grid(continuous_features(f["hr"], f["sleep"], S), S)
    return round_doubles(bins.select("user_id", "HRTIME", *FEATURE_COLS))


def training_features_q(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    lab = labelled_features(f["hr"], f["sleep"], f["pvt"], S)
    cols = ["user_id", "TESTSTART", "TESTID", "offset_us", "MATCH_TIME", "HRTIME", "pvt_mean_rt", "fatigue_score"]
    return round_doubles(lab.select(*cols, *FEATURE_COLS))


def inference_features_q(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    inf = inference_features(f["hr"], f["sleep"], S)
    return round_doubles(inf.select("user_id", "HRTIME", *INFER_COLS))


def _scored(spark, sf_dir):
    configure(spark)
    return scored_feed(table(spark, sf_dir, "lineitem"))


EVAL_T = 0.26  # threshold of the evaluation and inference jobs


def regression_metrics_q(spark, sf_dir):
    return round_doubles(M.regression_metrics(_scored(spark, sf_dir)))


def binary_metrics_q(spark, sf_dir):
    return round_doubles(M.binary_metrics(_scored(spark, sf_dir), threshold=0.5, target_threshold=0.5))


def roc_auc_q(spark, sf_dir):
    return round_doubles(M.roc_auc(_scored(spark, sf_dir), "y_true", "y_pred", 0.5))


def confusion_matrix_q(spark, sf_dir):
    return M.confusion_matrix(_scored(spark, sf_dir), "y_true", "y_pred", EVAL_T)


def classification_report_q(spark, sf_dir):
    return round_doubles(M.classification_report(_scored(spark, sf_dir), "y_true", "y_pred", EVAL_T))


def pr_curve_q(spark, sf_dir):
    return round_doubles(M.pr_curve(_scored(spark, sf_dir), "y_true", "y_pred", EVAL_T))


def inference_stats_q(spark, sf_dir):
    return round_doubles(M.inference_stats(_scored(spark, sf_dir), "y_pred", EVAL_T))


DRIFT_SPLIT = "2024-01-16"


def _monitor_long(spark, sf_dir):
    """Monitoring input: inference features before (reference) and from (current)
    the split date, each side robust-scaled by itself (as in the original job)."""
    f = _feeds(spark, sf_dir)
    inf = inference_features(f["hr"], f["sleep"], S)
    ref = inf.where(F.col("HRTIME") < F.lit(DRIFT_SPLIT).cast("timestamp_ntz"))
    cur = inf.where(F.col("HRTIME") >= F.lit(DRIFT_SPLIT).cast("timestamp_ntz"))
    return cut_lineage(D.monitoring_long(ref, cur, select_monitor_columns(ref, cur, MONITORED)))


def robust_scale_q(spark, sf_dir):
    return round_doubles(D.robust_params(_monitor_long(spark, sf_dir), ("feature", "side")))


def _scaled_long(spark, sf_dir):
    return cut_lineage(D.robust_scale_long(_monitor_long(spark, sf_dir), ("feature", "side")))


def ks_drift_q(spark, sf_dir):
    return round_doubles(D.ks_two_sample(_scaled_long(spark, sf_dir)))


def drift_summary_q(spark, sf_dir):
    return round_doubles(D.drift_summary(D.ks_two_sample(_scaled_long(spark, sf_dir)), len(MONITORED)))


def zscore_drift_q(spark, sf_dir):
    return round_doubles(D.zscore_drift(_monitor_long(spark, sf_dir)))


def label_drift_q(spark, sf_dir):
    """Shares of the fatigue labels among the tests before and from the split date."""
    lab = _labelled(spark, sf_dir)
    label = F.when(F.col("fatigue_score") >= EVAL_T, "Fatigued").otherwise("Awake")
    side = (F.col("TESTSTART") >= F.lit(DRIFT_SPLIT).cast("timestamp_ntz")).cast("int")
    return round_doubles(D.label_drift(lab.select(label.alias("status"), side.alias("side")), "status"))


def stratified_sample_q(spark, sf_dir):
    """A quarter of the order lines of each return flag, exactly."""
    configure(spark)
    return stratified_sample(table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber"), "l_returnflag", ["l_orderkey", "l_linenumber"], 0.25)


def density_histogram_q(spark, sf_dir):
    return round_doubles(D.density_histogram(_scaled_long(spark, sf_dir), 20))


def impute_scale_fit_q(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    lab = labelled_features(f["hr"], f["sleep"], f["pvt"], S)
    return round_doubles(D.fit_impute_scale(cut_lineage(lab), MODEL_FEATURES))


def _labelled(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    return labelled_features(f["hr"], f["sleep"], f["pvt"], S)


def group_split_q(spark, sf_dir):
    return group_split(_labelled(spark, sf_dir), "user_id", S.test_size, S.split_seed)


def group_kfold_q(spark, sf_dir):
    return group_kfold(_labelled(spark, sf_dir), 5)


_FITTED: dict = {}


def _fitted(spark, sf_dir):
    """Samples with split + the forest trained on the train split (memoised per
    session and folder: several queries share one model)."""
    key = (spark.sparkContext.applicationId, id(spark), sf_dir)
    if key not in _FITTED:
        samples = cut_lineage(MD.split_samples(cut_lineage(_labelled(spark, sf_dir), "labelled"), S.test_size, S.split_seed))
        ff = MD.train(samples.where(F.col("split") == "train"), ForestParams())
        _FITTED[key] = (samples, ff)
    return _FITTED[key]


# Values of the full forest have no SQL twin (its draws are hashes of rows); tests hold
# them against brute force. Beside them, ``holds_*`` queries state what must be true of
# every row, and ``small_tree`` / ``stitched_predictions`` put a forest of one tree of
# depth 2, which SQL can grow, under an oracle with all its values.


def model_importance_q(spark, sf_dir):
    return round_doubles(_fitted(spark, sf_dir)[1].importances())


def _share(c: str):
    return F.coalesce(F.col(c).between(0.0, 1.0), F.lit(False))


def holds_importance_q(spark, sf_dir):
    imp = cut_lineage(_fitted(spark, sf_dir)[1].importances(), "importances", small=True)
    whole = imp.agg((F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"))
    return M.attach_row(imp.select("feature", _share("importance").alias("in_range")), whole)


def _batch_inference(spark, sf_dir):
    _, ff = _fitted(spark, sf_dir)
    f = _feeds(spark, sf_dir)
    return MD.batch_inference(ff, inference_features(f["hr"], f["sleep"], S), EVAL_T)


def batch_inference_q(spark, sf_dir):
    return round_doubles(_batch_inference(spark, sf_dir))


def holds_inference_q(spark, sf_dir):
    alert = F.col("fatigue_probability") >= EVAL_T
    return _batch_inference(spark, sf_dir).select(
        *MD.INFERENCE_KEY,
        _share("fatigue_probability").alias("in_range"),
        (F.col("fatigue_event_alert").cast("int") == alert.cast("int")).alias("alert_matches"),
        (F.col("status") == F.when(alert, "Fatigued").otherwise("Awake")).alias("status_matches"),
    )


def _evaluation(spark, sf_dir):
    samples, ff = _fitted(spark, sf_dir)
    return MD.evaluate(ff, samples.where(F.col("split") == "test"), EVAL_T)


def evaluate_model_q(spark, sf_dir):
    """Every value of the evaluation as (part, name, metric, value)."""

    def long(df: DataFrame, part: str, name) -> DataFrame:
        values = [c for c, t in df.dtypes if t in ("double", "float", "bigint", "int")]
        pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in values])
        return df.select(F.lit(part).alias("part"), name.alias("name"), F.explode(pairs).alias("m")).select("part", "name", "m.*")

    ev = _evaluation(spark, sf_dir)
    point = F.coalesce(F.round("threshold", 9).cast("string"), F.lit("end"))
    parts = [
        long(ev["regression"], "regression", F.col("metric")),
        long(ev["report"], "report", F.col("label")),
        long(ev["pr_curve"], "pr_curve", point),
        long(ev["stats"], "stats", F.lit("total")),
    ]
    return round_doubles(reduce(DataFrame.unionByName, parts))


def holds_evaluation_q(spark, sf_dir):
    ev = _evaluation(spark, sf_dir)
    none = F.lit(None).cast("long")
    value = F.col("value")
    sane = F.when(F.col("metric") == "r2", value <= 1).otherwise(value.between(0, 1))
    # every point a share, and the lowest threshold finds all
    curve = ev["pr_curve"].agg((F.every(_share("precision") & _share("recall")) & (F.max("recall") == 1)).alias("ok"))
    stats = ev["stats"]
    return (
        ev["regression"].select(F.lit("regression").alias("part"), F.col("metric").alias("name"), none.alias("n"), sane.alias("ok"))
        .unionByName(
            ev["report"].select(
                F.lit("report").alias("part"),
                F.col("label").alias("name"),
                F.col("support").cast("long").alias("n"),
                ((F.col("precision").isNull() | _share("precision")) & _share("f1_score")).alias("ok"),
            )
        )
        .unionByName(curve.select(F.lit("pr_curve").alias("part"), F.lit("points").alias("name"), none.alias("n"), "ok"))
        .unionByName(
            stats.select(
                F.lit("stats").alias("part"),
                F.lit("total").alias("name"),
                F.col("total").alias("n"),
                ((F.col("fatigue_count") + F.col("awake_count") == F.col("total")) & _share("mean_probability")).alias("ok"),
            )
        )
    )


def explain_samples_q(spark, sf_dir):
    samples, ff = _fitted(spark, sf_dir)
    return round_doubles(MD.explain(ff, samples.where(F.col("split") == "test"), list(MD.SAMPLE_KEY)))


def holds_attributions_q(spark, sf_dir):
    samples, ff = _fitted(spark, sf_dir)
    test, keys = samples.where(F.col("split") == "test"), list(MD.SAMPLE_KEY)
    raw = ff.transform(test, clip=False).select(*keys, "prediction")
    total = shap_additivity(MD.explain(ff, test, keys), raw, keys, ff.features)
    return total.select(*keys, (F.abs(F.col("reconstructed") - F.col("prediction")) < 1e-5).alias("additive"))


N_FOLDS, N_TRIALS = 5, 50


def _cross_validation(spark, sf_dir):
    samples, _ = _fitted(spark, sf_dir)
    return MD.cross_validate(samples.where(F.col("split") == "train"), ForestParams(), N_FOLDS, EVAL_T)


def cross_validate_q(spark, sf_dir):
    return round_doubles(_cross_validation(spark, sf_dir))


def holds_folds_q(spark, sf_dir):
    cv = _cross_validation(spark, sf_dir)
    return cv.select("fold", "n_test", _share("rmse").alias("rmse_in_range"), _share("recall").alias("recall_in_range"))


def search_params_q(spark, sf_dir):
    samples, _ = _fitted(spark, sf_dir)
    train = samples.where(F.col("split") == "train")
    return round_doubles(MD.search_params(train, n_trials=N_TRIALS, n_splits=N_FOLDS, threshold=EVAL_T))


SMALL_TREE = ForestParams(n_estimators=1, max_depth=2, max_features=1.0, bootstrap=False)


def _small_tree(spark, sf_dir):
    """Samples (features as the oracle rounds them) with their split, and the tree."""
    lab = cut_lineage(_labelled(spark, sf_dir), "labelled")
    rounded = round_doubles(lab.select(*MD.SAMPLE_KEY, *MODEL_FEATURES)).join(lab.select(*MD.SAMPLE_KEY, "fatigue_score"), list(MD.SAMPLE_KEY))
    samples = cut_lineage(MD.split_samples(cut_lineage(rounded, "rounded"), S.test_size, S.split_seed), "split")
    return samples, fit_forest(samples.where(F.col("split") == "train"), "fatigue_score", SMALL_TREE)


def small_tree_q(spark, sf_dir):
    """The tree's nodes, thresholds in the features' own units."""
    _, ff = _small_tree(spark, sf_dir)
    names = spark.createDataFrame(list(enumerate(ff.features)), "feature int, name string")
    nodes = spark.createDataFrame(node_rows(ff)).join(F.broadcast(names), "feature", "left").withColumnRenamed("name", "f")
    units = ff.prep.select(F.col("feature").alias("f"), "center", "scale")
    raw = F.col("threshold") * F.col("scale") + F.col("center")
    return round_doubles(nodes.join(F.broadcast(units), "f", "left").select("id", F.col("f").alias("feature"), raw.alias("threshold"), F.col("cover").cast("long").alias("n"), "value"))


def stitched_predictions_q(spark, sf_dir):
    """The written ids, inputs, targets and predictions of the test side, by key."""
    samples, ff = _small_tree(spark, sf_dir)
    base, keys = scratch_path(spark, "stitch"), list(MD.SAMPLE_KEY)
    info = FS.write_split_outputs(samples, base, MODEL_FEATURES, "fatigue_score", keys)
    ids, inputs, targets = (FS.read_split(spark, info["samples"], "test", info[c]) for c in ("ids", "inputs", "targets"))
    scored = M.score_outputs(ff.transform(inputs), "prediction", EVAL_T).select(*keys, "prediction", "fatigue_event_alert", "status")
    FS.write_parquet(scored, f"{base}/predictions")
    whole = MD.stitch(ids, [inputs, targets, spark.read.parquet(f"{base}/predictions")], keys)
    return round_doubles(whole.withColumn("fatigue_event_alert", F.col("fatigue_event_alert").cast("int")))


def _requests(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    return build_requests(f["hr"], f["sleep"], MICROS_PER_DAY, 3)


def request_features_q(spark, sf_dir):
    return round_doubles(SC.request_features(_requests(spark, sf_dir), S))


def payload_parse_q(spark, sf_dir):
    hr = payload_hr(parse_payload(_requests(spark, sf_dir)))
    return round_doubles(hr.select("request_id", parse_time("HRTIME").alias("HRTIME"), "HR"))


def safety_overrides_q(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    h, sl = request_rows(f["hr"], f["sleep"], MICROS_PER_DAY, 3)
    return round_doubles(AD.safety_overrides(h, sl))


def _kb(spark, sf_dir):
    return AD.kb_vectors(kb_feed(table(spark, sf_dir, "embeddings")))


def kb_match_q(spark, sf_dir):
    configure(spark)
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return round_doubles(AD.kb_match(emb, _kb(spark, sf_dir)).drop("embedding"))


QUERY_VEC_ID = 5  # stands in for the encoded query text: the first embedding that is no course


def _fallback_rank(spark, sf_dir) -> int:
    """Semantic fallback course: the KB course nearest to the query vector."""
    q = table(spark, sf_dir, "embeddings").select("vec_id", "embedding").where(F.col("vec_id") >= QUERY_VEC_ID).orderBy("vec_id").limit(1)
    return int(AD.kb_match(q, _kb(spark, sf_dir)).select("kb_rank").first()[0])


def advice_q(spark, sf_dir):
    lab = _labelled(spark, sf_dir)
    c = AD.select_course(lab, _fallback_rank(spark, sf_dir))
    c = AD.advice_text(c, "fatigue_score", 0.3)
    return c.select("user_id", "TESTSTART", "TESTID", "offset_us", "course_id", F.col("advice").isNotNull().alias("gets_advice"), "advice")


def _scores_hold(scored: DataFrame) -> DataFrame:
    flagged = F.col("fatigue_probability") > SC.API_THRESHOLD
    return scored.select(
        "request_id",
        "has_features",
        F.col("course_id").isNotNull().alias("has_course"),
        _share("fatigue_probability").alias("in_range"),
        (F.col("is_fatigued") == flagged).alias("flag_matches"),
        (F.col("advice").isNotNull() == flagged).alias("advice_matches"),
    )


def _score_requests(spark, sf_dir):
    _, ff = _fitted(spark, sf_dir)
    return SC.score_requests(_requests(spark, sf_dir), S, ff, _fallback_rank(spark, sf_dir))


def score_requests_q(spark, sf_dir):
    return round_doubles(_score_requests(spark, sf_dir))


def holds_scores_q(spark, sf_dir):
    return _scores_hold(_score_requests(spark, sf_dir))


def validate_inputs_q(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    inf = inference_features(f["hr"], f["sleep"], S)
    return SCH.validate(inf.select("user_id", *MODEL_FEATURES, "HRTIME"), SCH.MODEL_INPUTS)


def asof_nearest_q(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    hr = clean_hr(f["hr"], S)
    p = f["pvt"].select("user_id", "TESTSTART", "TESTID").distinct().withColumn("_tus", ts_us("TESTSTART"))
    m = asof_nearest(p, hr.select("user_id", "t", "HRTIME", "HR"), ["user_id"], "_tus", "t", ["HRTIME", "HR"], S.tolerance_us, S.bucket_us, "nearest_")
    return round_doubles(m.select("user_id", "TESTSTART", "TESTID", F.col("nearest_HRTIME").alias("nearest_hrtime"), F.col("nearest_HR").alias("nearest_hr")))


def asof_backward_q(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    hr = clean_hr(f["hr"], S)
    sl = sleep_features(clean_sleep(f["sleep"], S), S).withColumn("_e", ts_us("END")).withColumn("_s", ts_us("START"))
    j = asof_backward(hr, sl, ["user_id"], "t", "_e", ["END", "cum_sleep_debt"], S.bucket_us, right_order=["_s"])
    return round_doubles(j.select("user_id", "HRTIME", F.col("END").alias("last_sleep_end"), "cum_sleep_debt"))


def csv_roundtrip_q(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    path = scratch_path(spark, "hr-csv")
    fmt = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    f["hr"].write.option("header", True).option("timestampNTZFormat", fmt).csv(path)
    back = spark.read.option("timestampNTZFormat", fmt).csv(path, header=True, schema="user_id long, HRTIME timestamp_ntz, HR double")
    return round_doubles(back)


def limit_rows_q(spark, sf_dir):
    configure(spark)
    return round_doubles(FS.read_parquet(spark, f"{sf_dir}/orders.parquet", limit=1000, order_by=["o_orderkey"]))


RAW_FEEDS = {  # feed -> (file prefix, order of a file's rows, CSV schema)
    "hr": ("HR", ["HRTIME"], "HRTIME string, HR double"),
    "sleep": ("sleep", ["END", "START"], "START string, END string"),
    "pvt": ("pvt", ["TESTSTART", "TESTID"], "TESTSTART string, TESTID long, TAPTIME double"),
}


def _raw_folder(spark, sf_dir) -> str:
    """The feeds as the original's raw files: one CSV file per user and feed, a folder
    per feed."""
    folder = scratch_path(spark, "raw")
    for name, feed in _feeds(spark, sf_dir).items():
        prefix, order, schema = RAW_FEEDS[name]
        texts = [F.col(c).cast("string").alias(c) if f"{c} string" in schema else F.col(c) for c in feed.columns]
        cut_lineage(FS.write_user_files(feed.select(*texts), f"{folder}/{name}", prefix, order), "raw-files")
    return folder


def _read_raw(spark, folder) -> dict[str, DataFrame]:
    return {n: FS.read_user_feed(spark, f"{folder}/{n}", schema, f"{prefix}_*.csv") for n, (prefix, _, schema) in RAW_FEEDS.items()}


def raw_to_features_q(spark, sf_dir):
    """Raw CSV files to the labelled table: read, set invalid readings apart, build features."""
    f = _read_raw(spark, _raw_folder(spark, sf_dir))
    checked = SCH.quarantine(f["hr"].select(F.col("user_id").alias("id"), "HRTIME", "HR"), SCH.HEART_RATE_RAW, scratch_path(spark, "checked-hr"))
    f["hr"] = checked.valid.withColumnRenamed("id", "user_id")  # valid rows go on, the others stay in quarantine
    f |= {n: cut_lineage(f[n], f"raw-{n}") for n in ("sleep", "pvt")}  # the files are opened once, the feeds used twice
    lab = labelled_features(f["hr"], f["sleep"], f["pvt"], S)
    cols = ["user_id", "TESTSTART", "TESTID", "offset_us", "MATCH_TIME", "HRTIME", "pvt_mean_rt", "fatigue_score"]
    return round_doubles(lab.select(*cols, *FEATURE_COLS))


def discover_users_q(spark, sf_dir):
    """Users by the names of their raw heart-rate files."""
    users = FS.discover_users(spark, _raw_folder(spark, sf_dir), "HR_*.csv")
    return users.select(F.col("user_id").cast("long"))


def _dirty(spark, sf_dir) -> dict:
    """Tables with violations of every kind, derived from ``events``, ``orders`` and
    ``lineitem``: (schema, rows, keys)."""
    configure(spark)
    events, orders, items = (table(spark, sf_dir, t) for t in ("events", "orders", "lineitem"))
    hr = events.selectExpr(
        "event_id",
        "CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 10 = 3 THEN concat('u', user_id) ELSE cast(user_id AS string) END AS id",
        "cast(ts AS string) AS HRTIME",
        "CASE WHEN event_id % 13 = 0 THEN double('NaN') ELSE value - 50 END AS HR",
    )
    sleep = orders.selectExpr(
        "o_orderkey AS id",
        "cast(o_orderdate AS string) AS START",
        "cast(o_orderdate AS string) AS END",
        "CASE WHEN o_orderkey % 9 = 0 THEN double('NaN') ELSE o_totalprice - 100000 END AS rating",
        "cast(NULL AS string) AS comments",
    )
    targets = items.selectExpr("l_orderkey", "l_discount * 12 - 0.2 AS fatigue_score", "cast(l_suppkey AS string) AS user_id")
    return {"hr": (SCH.HEART_RATE_RAW, hr, ["event_id"]), "sleep": (SCH.SLEEP_RAW, sleep, []), "targets": (SCH.TARGETS, targets, ["l_orderkey"])}


def validate_raw_q(spark, sf_dir):
    parts = [SCH.validate(df.drop(*keys), schema) for schema, df, keys in _dirty(spark, sf_dir).values()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def rejected_rows_q(spark, sf_dir):
    schema, df, keys = _dirty(spark, sf_dir)["hr"]
    return SCH.rejects(df, schema, keys)


def _dirty_all(spark, sf_dir) -> dict[str, tuple]:
    """A table with violations for each of the eight schemas."""
    events, orders, items = (table(spark, sf_dir, t) for t in ("events", "orders", "lineitem"))
    dirty = _dirty(spark, sf_dir)
    pvt = items.selectExpr(
        "CASE WHEN l_orderkey % 13 = 0 THEN concat('u', l_orderkey) ELSE cast(l_orderkey AS string) END AS id",
        "l_linenumber AS TESTID", "CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE cast(l_shipdate AS string) END AS TESTSTART",
        "l_partkey AS TRIALID", "l_returnflag AS TRIALNAME", "cast(l_shipdate AS string) AS TRIALSTART", "l_quantity * 10 - 50 AS TAPTIME",
    )
    outputs = items.selectExpr("l_discount * 12 - 0.2 AS prediction", "cast(l_suppkey AS string) AS user_id")
    shap = events.selectExpr("CASE WHEN event_id % 7 = 0 THEN 'bad' ELSE cast(value AS string) END AS mean_hr_5min", "value / 100 AS stress_cv")
    importances = orders.selectExpr("CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS Feature", "CASE WHEN o_orderkey % 8 = 0 THEN double('NaN') ELSE o_totalprice END AS Importance")
    plain = [f"CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END AS {c}" for c in MODEL_FEATURES if not c.startswith("circadian")]
    inputs = events.selectExpr(*plain, "value / 50 - 1 AS circadian_sin", "value / 60 - 1.5 AS circadian_cos", "cast(user_id AS string) AS user_id")
    rows = {k: (s, df.drop(*keys)) for k, (s, df, keys) in dirty.items()}
    return rows | {"pvt": (SCH.PVT_RAW, pvt), "outputs": (SCH.OUTPUTS, outputs), "shap": (SCH.SHAP_VALUES, shap), "importances": (SCH.FEATURE_IMPORTANCES, importances), "inputs": (SCH.MODEL_INPUTS, inputs)}


def validate_all_q(spark, sf_dir):
    """P10 on all eight schemas: violations by rule, valid and rejected rows, counted
    while both are written."""
    found = [SCH.quarantine(df, schema, scratch_path(spark, f"checked-{k}")) for k, (schema, df) in _dirty_all(spark, sf_dir).items()]
    return reduce(DataFrame.unionByName, [c.counts for c in found])


def rejected_pvt_q(spark, sf_dir):
    """The rejected rows of one table, with the rules they break."""
    schema, df = _dirty_all(spark, sf_dir)["pvt"]
    bad = SCH.quarantine(df, schema, scratch_path(spark, "checked-pvt")).rejected
    row = F.from_json("row", "id string, TESTID long, TAPTIME double")
    return round_doubles(bad.select(F.concat_ws(",", "rules").alias("rules"), row["id"].alias("id"), row["TESTID"].alias("test_id"), row["TAPTIME"].alias("tap")))


def csv_rejects_q(spark, sf_dir):
    """S1 over damaged files written from ``events``: lines cut short, cells of another
    type, cells too many; the rejected lines with their files."""
    configure(spark)
    ev = table(spark, sf_dir, "events")
    text = F.expr(
        "CASE WHEN event_id % 10 = 3 THEN concat_ws(',', event_id, user_id) WHEN event_id % 10 = 5 THEN concat_ws(',', event_id, 'u', user_id) "
        "WHEN event_id % 10 = 7 THEN concat_ws(',', event_id, user_id, 1, 2) ELSE concat_ws(',', event_id, user_id, event_id % 100) END"
    )
    folder = scratch_path(spark, "damaged")
    ev.select(text.alias("value")).repartition(3, "value").write.text(f"{folder}/a")
    good, bad = FS.read_csv_checked(spark, f"{folder}/a", "event_id long, user_id long, n long", header=False)
    return bad.select("line").unionByName(good.select(F.concat_ws(":", "event_id", "user_id", "n").alias("line")))


def pvt_variants_q(spark, sf_dir):
    """Raw test files of three kinds of headers (as they are, in lower case,
    and with a time stamp and mean reaction times) read into one targets table."""
    pvt, folder = _feeds(spark, sf_dir)["pvt"], scratch_path(spark, "pvt-variants")
    tests = pvt.where(F.col("TAPTIME") > S.pvt_artifact_ms).groupBy("user_id", "TESTSTART", "TESTID").agg(F.avg("TAPTIME").alias("MEAN_RT"))
    parts = [
        pvt.where("user_id % 3 = 0"),
        pvt.where("user_id % 3 = 1").select("user_id", F.col("TESTSTART").alias("teststart"), F.col("TESTID").alias("testid"), F.col("TAPTIME").alias("taptime")),
        tests.where("user_id % 3 = 2").withColumnRenamed("TESTSTART", "TIMESTAMP"),
    ]
    fmt, out = "yyyy-MM-dd HH:mm:ss.SSSSSS", []
    for k, df in enumerate(parts):
        df.write.option("header", True).option("timestampNTZFormat", fmt).csv(f"{folder}/{k}")
        raw = spark.read.csv(f"{folder}/{k}", header=True).withColumn("user_id", F.col("user_id").cast("long"))
        found = clean_pvt(raw, S, min_year=S.pvt_min_year)
        out.append(found.select("user_id", "TESTSTART", F.col("TESTID").cast("long").alias("TESTID"), "pvt_mean_rt", "fatigue_score"))
    return round_doubles(reduce(DataFrame.unionByName, out))


RULE = {"hours_awake": 0.01, "stress_cv": 0.2, "cum_sleep_debt": -0.005}


def adapter_inference_q(spark, sf_dir):
    """X1 through M5: a predictor that is no forest, saved, loaded and checked."""
    path = scratch_path(spark, "predictor")
    for version, constant in ((1, 0.9), (2, 0.05)):
        PR.save_predictor(spark, PR.Predictor(PR.LinearRule(RULE, constant), list(MODEL_FEATURES), "rule", version), path)
    model = PR.load_predictor(spark, path, features=MODEL_FEATURES)
    f = _feeds(spark, sf_dir)
    return round_doubles(MD.batch_inference(model, inference_features(f["hr"], f["sleep"], S), EVAL_T).withColumn("fatigue_event_alert", F.col("fatigue_event_alert").cast("int")))


def users_with_all_feeds_q(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    return users_with_all_feeds([f["hr"], f["sleep"], f["pvt"]])


def dataset_profile_q(spark, sf_dir):
    configure(spark)
    dirty = _dirty_all(spark, sf_dir)["importances"][1]
    prof = FS.dataset_profile(dirty.withColumn("Importance", nan_to_null(F.col("Importance"))), "importances", "orders")
    fields = F.from_json(F.get_json_object("schema_json", "$.fields"), "array<struct<name: string, type: string>>")
    columns = F.concat_ws(",", F.transform(fields, lambda x: F.concat_ws(":", x["name"], x["type"])))
    return prof.select("name", "source", "num_rows", "num_columns", columns.alias("columns"), "null_counts", (F.col("digest_xor") != 0).alias("has_digest"))


def split_outputs_test_q(spark, sf_dir):
    lab = _labelled(spark, sf_dir)
    samples = lab.join(group_split(lab, "user_id", S.test_size, S.split_seed), "user_id")
    base = scratch_path(spark, "split")
    info = FS.write_split_outputs(samples, base, MODEL_FEATURES, "fatigue_score", MD.SAMPLE_KEY)
    return round_doubles(FS.read_split(spark, info["samples"], "test", info["inputs"]))


def split_outputs_q(spark, sf_dir):
    """All six outputs of the split, read back and stacked."""
    lab = cut_lineage(_labelled(spark, sf_dir), "samples")
    samples = lab.join(group_split(lab, "user_id", S.test_size, S.split_seed), "user_id")
    info = FS.write_split_outputs(samples, scratch_path(spark, "split"), MODEL_FEATURES, "fatigue_score", MD.SAMPLE_KEY)
    parts = []
    for split in ("train", "test"):
        for output in ("inputs", "targets", "ids"):
            part = FS.read_split(spark, info["samples"], split, info[output])
            lacking = [F.lit(None).cast("double").alias(c) for c in (*MODEL_FEATURES, "fatigue_score") if c not in info[output]]
            parts.append(part.select(F.lit(split).alias("split"), F.lit(output).alias("output"), "*", *lacking))
    return round_doubles(reduce(DataFrame.unionByName, parts))


def inference_outputs_q(spark, sf_dir):
    """The features table of the inference outputs, read back."""
    f = _feeds(spark, sf_dir)
    info = FS.write_inference_outputs(inference_features(f["hr"], f["sleep"], S), scratch_path(spark, "inference"))
    return round_doubles(spark.read.parquet(info["features"]).select("user_id", "HRTIME", *INFER_COLS))


def inference_ids_q(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    inf = inference_features(f["hr"], f["sleep"], S)
    info = FS.write_inference_outputs(inf, scratch_path(spark, "inference"))
    return spark.read.parquet(info["ids"])


def stream_minute_grid_q(spark, sf_dir):
    configure(spark)
    schema = table(spark, sf_dir, "events").schema
    out = ST.run_to_table(ST.minute_grid_stream(ST.hr_stream(spark, sf_dir, schema), S), "minute-grid")
    return round_doubles(spark.read.parquet(out))


def _request_stream(spark, sf_dir, name):
    """Requests from files. A micro-batch takes some files for each core: the scorer's
    plan has a price per batch, and a batch of one file is read by one task."""
    src = scratch_path(spark, name)
    _requests(spark, sf_dir).repartition("request_id").write.parquet(src)
    return ST.table_stream(spark, src, spark.read.parquet(src).schema, max_files=4 * spark.sparkContext.defaultParallelism)


def stream_request_features_q(spark, sf_dir):
    out = ST.score_stream(_request_stream(spark, sf_dir, "requests-in"), lambda b: SC.request_features(b, S), "request-features")
    return round_doubles(spark.read.parquet(out).drop("batch"))


METRIC_LIMITS = {"rmse": (0.5, False), "mae": (0.45, False), "r2": (0.0, True)}  # example pass/fail gates


def metric_thresholds_q(spark, sf_dir):
    return round_doubles(M.metric_thresholds(M.regression_metrics(_scored(spark, sf_dir)), METRIC_LIMITS))


def _stream_score_requests(spark, sf_dir):
    """T2 with the model: every micro-batch of requests is scored by the forest."""
    _, ff = _fitted(spark, sf_dir)
    rank = _fallback_rank(spark, sf_dir)
    out = ST.score_stream(_request_stream(spark, sf_dir, "score-in"), lambda b: SC.score_requests(b, S, ff, rank), "request-scores")
    return spark.read.parquet(out).drop("batch")


def stream_score_requests_q(spark, sf_dir):
    return round_doubles(_stream_score_requests(spark, sf_dir))


def holds_stream_scores_q(spark, sf_dir):
    return _scores_hold(_stream_score_requests(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "stream_score_requests": stream_score_requests_q,
    "holds_importance": holds_importance_q,
    "holds_inference": holds_inference_q,
    "holds_evaluation": holds_evaluation_q,
    "holds_attributions": holds_attributions_q,
    "holds_folds": holds_folds_q,
    "holds_scores": holds_scores_q,
    "holds_stream_scores": holds_stream_scores_q,
    "small_tree": small_tree_q,
    "stitched_predictions": stitched_predictions_q,
    "metric_thresholds": metric_thresholds_q,
    "request_features": request_features_q,
    "payload_parse": payload_parse_q,
    "safety_overrides": safety_overrides_q,
    "kb_match": kb_match_q,
    "advice": advice_q,
    "score_requests": score_requests_q,
    "validate_inputs": validate_inputs_q,
    "asof_nearest": asof_nearest_q,
    "asof_backward": asof_backward_q,
    "csv_roundtrip": csv_roundtrip_q,
    "limit_rows": limit_rows_q,
    "discover_users": discover_users_q,
    "raw_to_features": raw_to_features_q,
    "validate_raw": validate_raw_q,
    "validate_all": validate_all_q,
    "rejected_pvt": rejected_pvt_q,
    "csv_rejects": csv_rejects_q,
    "pvt_variants": pvt_variants_q,
    "adapter_inference": adapter_inference_q,
    "rejected_rows": rejected_rows_q,
    "users_with_all_feeds": users_with_all_feeds_q,
    "dataset_profile": dataset_profile_q,
    "split_outputs_test": split_outputs_test_q,
    "inference_ids": inference_ids_q,
    "inference_outputs": inference_outputs_q,
    "split_outputs": split_outputs_q,
    "stream_minute_grid": stream_minute_grid_q,
    "stream_request_features": stream_request_features_q,
    "group_split": group_split_q,
    "group_kfold": group_kfold_q,
    "model_importance": model_importance_q,
    "batch_inference": batch_inference_q,
    "evaluate_model": evaluate_model_q,
    "explain_samples": explain_samples_q,
    "cross_validate": cross_validate_q,
    "search_params": search_params_q,
    "robust_scale": robust_scale_q,
    "ks_drift": ks_drift_q,
    "drift_summary": drift_summary_q,
    "density_histogram": density_histogram_q,
    "zscore_drift": zscore_drift_q,
    "label_drift": label_drift_q,
    "stratified_sample": stratified_sample_q,
    "impute_scale_fit": impute_scale_fit_q,
    "regression_metrics": regression_metrics_q,
    "binary_metrics": binary_metrics_q,
    "roc_auc": roc_auc_q,
    "confusion_matrix": confusion_matrix_q,
    "classification_report": classification_report_q,
    "pr_curve": pr_curve_q,
    "inference_stats": inference_stats_q,
    "hr_clean": hr_clean_q,
    "hr_features": hr_features_q,
    "sleep_features": sleep_features_q,
    "pvt_targets": pvt_targets_q,
    "continuous_features": continuous_features_q,
    "feature_grid": feature_grid_q,
    "training_features": training_features_q,
    "inference_features": inference_features_q,
}

ORACLE: dict[str, str] = {
    "holds_importance": O.q_model_importance(),
    "holds_inference": O.q_batch_inference(),
    "holds_evaluation": O.q_evaluate_model(EVAL_T),
    "holds_attributions": O.q_explain_samples(),
    "holds_folds": O.q_cross_validate(N_FOLDS),
    "holds_scores": O.q_score_requests(),
    "holds_stream_scores": O.q_score_requests(),
    "small_tree": O.q_small_tree(),
    "stitched_predictions": O.q_stitched_predictions(EVAL_T),
    "metric_thresholds": O.q_metric_thresholds(),
    "request_features": O.q_request_features(),
    "payload_parse": O.q_payload_parse(),
    "safety_overrides": O.q_safety_overrides(),
    "kb_match": O.q_kb_match(),
    "advice": O.q_advice(),
    "validate_inputs": O.q_validate_inputs(),
    "asof_nearest": O.q_asof_nearest_tests(),
    "asof_backward": O.q_asof_backward_sleep(),
    "csv_roundtrip": O.q_csv_roundtrip(),
    "limit_rows": O.q_limit_rows(1000),
    "discover_users": O.q_discover_users(),
    "raw_to_features": O.q_training_features(),
    "validate_raw": O.q_validate_raw(),
    "validate_all": O.q_validate_all(),
    "rejected_pvt": O.q_rejected_pvt(),
    "csv_rejects": O.q_csv_rejects(),
    "pvt_variants": O.q_pvt_targets(),
    "adapter_inference": O.q_adapter_inference(RULE, 0.05, EVAL_T),
    "rejected_rows": O.q_rejected_rows(),
    "users_with_all_feeds": O.q_users_with_all_feeds(),
    "dataset_profile": O.q_dataset_profile(),
    "split_outputs_test": O.q_split_outputs_test(),
    "inference_ids": O.q_inference_ids(),
    "inference_outputs": O.q_inference_features(),
    "split_outputs": O.q_split_outputs(),
    "stream_minute_grid": O.q_stream_minute_grid(),
    "stream_request_features": O.q_request_features(),
    "group_split": O.q_group_split(),
    "group_kfold": O.q_group_kfold(5),
    "robust_scale": O.q_robust_scale(),
    "ks_drift": O.q_ks_drift(),
    "drift_summary": O.q_drift_summary(),
    "density_histogram": O.q_density_histogram(20),
    "zscore_drift": O.q_zscore_drift(),
    "label_drift": O.q_label_drift(EVAL_T, DRIFT_SPLIT),
    "stratified_sample": O.q_stratified_sample(0.25),
    "impute_scale_fit": O.q_impute_scale_fit(),
    "regression_metrics": O.q_regression_metrics(),
    "binary_metrics": O.q_binary_metrics(0.5, 0.5),
    "roc_auc": O.q_roc_auc(0.5),
    "confusion_matrix": O.q_confusion_matrix(),
    "classification_report": O.q_classification_report(),
    "pr_curve": O.q_pr_curve(),
    "inference_stats": O.q_inference_stats(),
    "hr_clean": O.q_hr_clean(),
    "hr_features": O.q_hr_features(),
    "sleep_features": O.q_sleep_features(),
    "pvt_targets": O.q_pvt_targets(),
    "continuous_features": O.q_continuous_features(),
    "feature_grid": O.q_feature_grid(),
    "training_features": O.q_training_features(),
    "inference_features": O.q_inference_features(),
}
