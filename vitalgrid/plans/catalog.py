"""The named queries: each takes (spark, folder of Parquet tables) and returns a DataFrame."""

import time

from pyspark.sql import functions as F

from ..operators import (
    drift, features, federated, keyed_trees, labels, merge, metrics, models, reports, rules, similarity, sketches, spine,
    vitals, window_drift,
)
from ..operators.attach import attach
from ..schemas import DEFAULT_NODES, MERGED_COLUMNS, WEARABLE
from ..session import scratch_path, written
from ..sources import committed, events, readers, writers
from ..streaming import episodes, hourly, run, stored
from . import incremental, stages, tables

REGIONS = ["hospital_A", "hospital_C"]
KEYS = ["location", "timestamp"]

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df, digits, *names):
    """Round the named columns (all doubles when none is named), for comparable output."""
    names = names or [f.name for f in df.schema if f.dataType.typeName() == "double"]
    return df.withColumns({n: F.round(n, digits) for n in names})


# ---- vitals and merge ----------------------------------------------------


@query
def hourly_vitals(spark, folder):
    return vitals.hourly_vitals(stages.sources(spark, folder, cumulative=True).wearable)


@query
def cumulative_steps_daily(spark, folder):
    wearable = stages.sources(spark, folder, cumulative=True).wearable
    return wearable.select("event_id", "user_id", "timestamp", "cumulative_steps")


@query
def cumulative_steps_lifetime(spark, folder):
    wearable = stages.sources(spark, folder).wearable
    total = vitals.lifetime_running_steps(wearable, ["ts", "event_id"])
    return total.select("event_id", "user_id", "timestamp", "cumulative_steps")


@query
def user_keys(spark, folder):
    keyed = spine.with_user_key(stages.sources(spark, folder).wearable)
    return keyed.groupBy("user_key").agg(F.count(F.lit(1)).alias("readings"))


@query
def aqi_from_pm(spark, folder):
    return stages.sources(spark, folder).air.select(*KEYS, "pm25", "pm10", "aqi")


@query
def env_join(spark, folder):
    s = stages.sources(spark, folder, cumulative=True)
    return merge.join_environment(vitals.hourly_vitals(s.wearable), s.air, s.weather)


@query
def merged_features(spark, folder):
    return stages.merged(spark, folder, cumulative=True)


@query
def all_nodes_merged(spark, folder):
    """The merged table of every site that there is, in time order."""
    return stages.merged(spark, folder, cumulative=True).orderBy("timestamp", "location")


@query
def merged_hour_aligned(spark, folder):
    raw = events.read_events(spark, folder)
    out = merge.merge_sources(
        events.wearable_view(raw, cumulative=False).withColumn("timestamp", F.col("ts")),
        events.air_readings(raw), events.weather_readings(raw), align="hour",
    )
    return out.select(*KEYS, "heart_rate_mean", "spo2_mean", "pm25", "aqi", "temperature", "precipitation")


@query
def csv_sources(spark, folder):
    """Write the wearable table as CSV and read it back with its fixed schema."""
    path = scratch_path(spark, "wearable-csv")
    s = stages.sources(spark, folder, cumulative=True)
    writers.write_node_csv(s.wearable.select("location", *readers.WEARABLE.names), path)
    back = readers.read_partitioned_csv(spark, path, readers.WEARABLE)
    return back.groupBy("location").agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.sum("steps").alias("steps"),
        F.sum(F.round(F.col("heart_rate") * 10).cast("long")).alias("heart_rate_tenths"),
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
    )


@query
def csv_to_labels(spark, folder):
    """All three sources of every site as CSV, one site in the second wearable layout, read back and labeled."""
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "processed")
    s = stages.sources(spark, folder, cumulative=True)
    writers.write_sources_csv(s, raw, alternative=["hospital_C"])
    found = readers.read_source_folders(spark, raw)
    merged = merge.merge_sources(found.wearable, found.air, found.weather)
    writers.write_by_location(merged, f"{out}/merged")
    stored = readers.read_labeled(spark, f"{out}/merged", merged.schema)
    labeled = labels.binary_labels(labels.with_risk_score(stored))
    writers.write_by_location(labeled, writers.labeled_path(out, "binary"))
    node = readers.read_labeled(spark, writers.labeled_path(out, "binary"), labeled.schema)
    # no combined table was written: the load path falls back to the tables of the sites
    table = readers.combined_or_parts(None, [node], labeled.schema, spark)
    return merge.drop_matching(table, "category").select(*KEYS, "risk_score", "health_risk", "aqi", "temperature", "heart_rate_mean")


@query
def merged_table(spark, folder):
    """Write the merged table by location and read one location back by partition filter."""
    path = scratch_path(spark, "merged-by-location")
    table = stages.merged(spark, folder, cumulative=True)
    writers.write_by_location(table, path)
    return readers.read_labeled(spark, path, table.schema, "hospital_B").select(*MERGED_COLUMNS)


@query
def hourly_spine(spark, folder):
    return spine.hourly_spine(stages.sources(spark, folder).wearable)


@query
def time_gaps(spark, folder):
    return spine.time_gaps(stages.sources(spark, folder).wearable)


@query
def expected_pollution(spark, folder):
    out = spine.expected_pollution(stages.sources(spark, folder).air)
    computed = ["expected_pm25", "expected_pm10", "pm25_residual", "pm10_residual"]
    return rounded(out, 6, *computed).select(*KEYS, "pm25", "pm10", "traffic_band", *computed)


@query
def expected_temperature(spark, folder):
    out = spine.expected_temperature(stages.sources(spark, folder).weather)
    computed = ["expected_temperature", "temperature_residual"]
    return rounded(out, 6, *computed).select(*KEYS, "temperature", *computed)


@query
def activity_profile(spark, folder):
    return rounded(spine.activity_profile(stages.sources(spark, folder).wearable), 6)


# ---- risk and labels -----------------------------------------------------


@query
def risk_components(spark, folder):
    table = labels.with_risk_components(stages.merged(spark, folder))
    return table.select(*KEYS, *labels.risk.COMPONENTS, "risk_score")


@query
def risk_score(spark, folder):
    return labels.with_risk_score(stages.merged(spark, folder)).select(*KEYS, "risk_score")


@query
def label_thresholds(spark, folder):
    return rounded(labels.thresholds(stages.scored(spark, folder)), 9)


@query
def label_binary_node(spark, folder):
    return stages.labeled(spark, folder).select(*KEYS, "risk_score", "health_risk", "risk_category")


@query
def label_binary_global(spark, folder):
    table = stages.labeled(spark, folder, "global")
    return table.select(*KEYS, "risk_score", "health_risk", "risk_category")


@query
def label_continuous(spark, folder):
    scored = labels.with_risk_score(stages.merged(spark, folder))
    return labels.continuous_labels(scored).select(*KEYS, "health_risk", "risk_category")


@query
def label_distribution(spark, folder):
    return labels.label_distribution(stages.labeled(spark, folder), ["location"])


@query
def label_constant_fallback(spark, folder):
    """The labels when all scores are alike: every row gets the same score first."""
    flat = stages.scored(spark, folder).withColumn("risk_score", F.lit(0.5))
    return labels.binary_labels(flat).select(*KEYS, "health_risk")


@query
def label_one_constant_site(spark, folder):
    """One site whose scores are all alike among others whose are not."""
    score = F.when(F.col("location") == "hospital_B", F.lit(0.5)).otherwise(F.col("risk_score"))
    table = written(stages.scored(spark, folder).withColumn("risk_score", score), "one-constant")
    return labels.binary_labels(table).select(*KEYS, "health_risk", "risk_category")


# ---- reports -------------------------------------------------------------


@query
def node_summary(spark, folder):
    return rounded(reports.node_summary(stages.labeled(spark, folder)), 6)


@query
def node_summary_global(spark, folder):
    return rounded(reports.node_summary(stages.labeled(spark, folder, "global")), 6)


@query
def regional_comparison(spark, folder):
    return rounded(reports.regional_comparison(stages.labeled(spark, folder), REGIONS), 6)


@query
def source_summary(spark, folder):
    s = stages.sources(spark, folder)
    return rounded(reports.source_summary(s.air, s.weather), 6)


@query
def kpi_overview(spark, folder):
    return rounded(reports.kpi_overview(stages.labeled(spark, folder, "global")), 6)


@query
def daily_risk_trends(spark, folder):
    return rounded(reports.daily_risk_trends(stages.labeled(spark, folder, "global")), 6)


@query
def daily_risk_trends_by_node(spark, folder):
    return rounded(reports.daily_risk_trends(stages.labeled(spark, folder), ["location"]), 6)


@query
def citizen_daily(spark, folder):
    return rounded(reports.citizen_daily(stages.labeled(spark, folder), ["location"]), 6)


@query
def daily_health(spark, folder):
    return rounded(reports.daily_health(stages.merged(spark, folder), ["location"]), 6)


@query
def time_extent(spark, folder):
    return reports.time_extent(stages.merged(spark, folder))


def _expected_nodes(spark):
    return spark.createDataFrame([(n,) for n in (*DEFAULT_NODES, "hospital_D")], ["location"])


@query
def input_coverage(spark, folder):
    return reports.input_coverage(stages.merged(spark, folder), _expected_nodes(spark))


@query
def missing_inputs(spark, folder):
    return reports.missing_locations(stages.merged(spark, folder), _expected_nodes(spark))


@query
def latest_status(spark, folder):
    return reports.latest_status(stages.labeled(spark, folder))


@query
def recent_risk_rate(spark, folder):
    return rounded(reports.recent_risk_rate(stages.labeled_once(spark, folder)), 9)


@query
def alerts(spark, folder):
    shown = rules.alert_display(rules.alerts(stages.labeled_once(spark, folder)))
    return rounded(shown, 9, "value")


@query
def region_alerts(spark, folder):
    found = rules.region_alerts(stages.labeled_once(spark, folder), REGIONS)
    return rounded(found, 9, "value")


@query
def citizen_alerts(spark, folder):
    found = rules.alerts(stages.labeled_once(spark, folder))
    return rounded(rules.alerts_for(found, "hospital_B"), 9, "value")


@query
def recommendations(spark, folder):
    return rules.recommendations(stages.labeled(spark, folder))


@query
def env_series(spark, folder):
    return reports.long_series(stages.merged(spark, folder), reports.ENVIRONMENT_SERIES, ordered=True)


@query
def vitals_series(spark, folder):
    return reports.long_series(stages.merged(spark, folder), reports.VITALS_SERIES, ordered=True)


@query
def detail_table(spark, folder):
    return reports.detail_table(stages.labeled(spark, folder, "global"))


@query
def last_7_days(spark, folder):
    recent = reports.last_days(stages.labeled_once(spark, folder))
    return recent.select(*KEYS, "health_risk", "aqi")


@query
def date_range(spark, folder):
    table = reports.in_regions(stages.merged(spark, folder), REGIONS)
    return reports.in_date_range(table, ["2024-01-05", "2024-01-12"]).select(*KEYS, "aqi", "heart_rate_mean")


@query
def panel_rows(spark, folder):
    """How many rows each panel of authorities and citizens shows."""
    everything, node = stages.labeled_once(spark, folder, "global"), stages.labeled_once(spark, folder)
    shown = {
        "authority": tables.authority_panels(everything, node, REGIONS, ["2024-01-05", "2024-01-12"]),
        "citizen": tables.citizen_panels(node, "hospital_B"),
    }
    parts = [
        panel.agg(F.count(F.lit(1)).alias("n")).select(F.lit(who).alias("viewer"), F.lit(name).alias("panel"), "n")
        for who, panels in shown.items() for name, panel in panels.items()
    ]
    return merge.union_sites(parts)


# ---- features ------------------------------------------------------------


@query
def vocabulary(spark, folder):
    return features.vocabulary(stages.merged(spark, folder))


@query
def one_hot_features(spark, folder):
    table = stages.merged(spark, folder)
    hot = features.one_hot(table, features.CATEGORY_VOCABULARY)
    return hot.select(*KEYS, *[c for c in hot.columns if "_category_" in c])


@query
def prepared_features(spark, folder):
    return stages.model_rows(spark, folder)[0]


@query
def feature_alignment(spark, folder):
    table = stages.labeled(spark, folder).drop("risk_score")
    return features.prepare_features(table, names=["spo2_mean", "unseen_feature", "aqi"])[0]


@query
def scaler_stats(spark, folder):
    rows, names = stages.model_rows(spark, folder)
    stats = features.scaler_stats(rows, names, ["location"])
    return rounded(features.long_stats(stats, names, ["location"]), 6)


@query
def scaled_features(spark, folder):
    rows, names = stages.model_rows(spark, folder)
    stats = features.scaler_stats(rows, names, ["location"])
    return rounded(features.scaled(rows, stats, names, ["location"]), 6)


@query
def stratified_split(spark, folder):
    split = features.stratified_split(stages.labeled_once(spark, folder), by=["location", "health_risk"])
    return split.select(*KEYS, "health_risk", "is_test")


@query
def random_split(spark, folder):
    table = written(stages.merged(spark, folder).select(*KEYS), "keys")
    return features.random_split(table).select(*KEYS, "is_test")


# ---- metrics on a fixed scorer -------------------------------------------


def _scored_linear(spark, folder):
    return stages.linear_scorer(stages.labeled_once(spark, folder))


@query
def confusion_metrics(spark, folder):
    return rounded(metrics.confusion_metrics(_scored_linear(spark, folder), ["location"]), 9)


@query
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(_scored_linear(spark, folder), ["location"])


@query
def class_counts(spark, folder):
    return metrics.class_counts(stages.labeled(spark, folder), ["location"])


@query
def roc_auc(spark, folder):
    return rounded(metrics.roc_auc(_scored_linear(spark, folder), ["location"]), 9)


@query
def fedavg_scaler(spark, folder):
    """The sites' scalers, learned on their training rows, averaged by the number of those."""
    rows, names = stages.model_rows(spark, folder)
    stats = features.scaler_stats(federated.local_split(rows).filter(~F.col("is_test")), names, ["location"])
    return rounded(federated.average_parameters(federated.scaler_parameters(stats, names)), 6)


@query
def federated_metrics(spark, folder):
    client = metrics.evaluate(_scored_linear(spark, folder), ["location"])
    return rounded(federated.average_metrics(client), 9)


# ---- models --------------------------------------------------------------
# Fits end in floats that no SQL repeats, so these queries return what can be stated exactly: the
# rows that took part, and whether each measure reaches its floor.

FLOORS = {"accuracy": 0.7, "precision": 0.5, "recall": 0.5, "f1": 0.5, "roc_auc": 0.85}


def _floors(df, *keep):
    """The kept columns, and for each metric whether it reaches its floor."""
    reached = [(F.col(m) >= floor).alias(f"{m}_reached") for m, floor in FLOORS.items()]
    return df.select(*keep, *reached)


def _split_rows(spark, folder):
    rows, names = stages.model_rows(spark, folder)
    return written(features.stratified_split(rows), "split"), names


def _trained(spark, folder, kind):
    rows, names = _split_rows(spark, folder)
    return _floors(models.train_and_score(rows, names, kind, ["location"]), "location", "model_type", "n")


@query
def train_logistic(spark, folder):
    return _trained(spark, folder, "logistic_regression")


@query
def train_forest(spark, folder):
    return _trained(spark, folder, "random_forest")


@query
def train_gbt(spark, folder):
    return _trained(spark, folder, "gradient_boosting")


@query
def central_train(spark, folder):
    """The centralized trainer on a table of which some hours have no label."""
    table = stages.labeled_once(spark, folder, "global", cumulative=True).drop("risk_score")
    known = F.when(F.hour("timestamp") != 0, F.col("health_risk"))
    found = models.central_train(table.withColumn("health_risk", known), scratch_path(spark, "central-model"))
    return found.select("n", "left_out", (F.col("accuracy") >= FLOORS["accuracy"]).alias("accuracy_reached"))


@query
def saved_model(spark, folder):
    """A model that was saved and loaded scores every row as before."""
    rows, names = _split_rows(spark, folder)
    path = scratch_path(spark, "forest")
    model = models.HealthModel("random_forest", {"n_estimators": 10}, list(names)).fit(rows.filter(~F.col("is_test")))
    model.save(path)
    loaded = models.HealthModel.load(path, "random_forest")
    test = rows.filter("is_test")
    before, after = (m.predict(test).select(*KEYS, "prediction", "score") for m in (model, loaded))
    after = after.select(*KEYS, F.col("prediction").alias("p"), F.col("score").alias("s"))
    same = (F.col("prediction") == F.col("p")) & (F.col("score") == F.col("s"))
    return before.join(after, KEYS).groupBy("location").agg(F.count(F.lit(1)).alias("n"), F.bool_and(same).alias("same"))


@query
def feature_importance(spark, folder):
    """Every feature with its place; importances are not negative and sum to one."""
    rows, names = stages.model_rows(spark, folder)
    found = models.HealthModel("random_forest", {}, names).fit(rows).importances()
    total = written(found, "importances").agg(F.round(F.sum("value"), 9)).scalar()
    return found.select("idx", "feature", ((F.col("value") >= 0) & (total == 1)).alias("valid"))


# two levels of one tree a site on all its rows and features: what SQL can state
SMALL_TREE = {"trees": 1, "depth": 2, "bootstrap": False}


def _small_trees(spark, folder):
    rows, names = stages.model_rows(spark, folder)
    z = features.scaled(rows, features.scaler_stats(rows, names, ["location"]), names, ["location"])
    design = federated.keyed_design(rounded(z, 9, *names), names)
    return keyed_trees.fit_forests(design, keyed_trees.Forest(subset=len(names), **SMALL_TREE)), names


def _named(names):
    return F.element_at(F.array(*map(F.lit, names)), F.col("feature") + 1).alias("feature")


@query
def forest_splits(spark, folder):
    """Splits, counts and gains of the first two levels of a tree per site, all sites in the same passes."""
    splits, names = _small_trees(spark, folder)
    found = splits.select(
        "location", "node", _named(names), "threshold", "n", "positives", "left_n", "left_positives", "gain"
    )
    return rounded(rounded(found, 6, "threshold"), 9, "gain")


@query
def forest_importances(spark, folder):
    """Shares of the features in the summed gains of those trees."""
    splits, names = _small_trees(spark, folder)
    found = keyed_trees.importances(splits, len(names)).withColumnRenamed("idx", "feature")
    return rounded(found.select("location", _named(names), "value"), 6)


@query
def federated_gradient(spark, folder):
    """What each site would send in the first step: sums of gradient and curvature at zero parameters.

    Shown are the gradient and the first term of the curvature, a quarter of the site's rows.
    """
    rows, names = stages.model_rows(spark, folder)
    train = federated.local_split(rows).filter(~F.col("is_test"))
    design = federated.design_rows(train, features.scaler_stats(train, names, ["location"]), names)
    sums = federated.site_sums(design, len(names) + 1)
    shown = sums.filter(F.col("idx") <= len(names) + 1)
    return rounded(shown.select("location", "idx", (F.col("value") + 0.0).alias("value")), 6)


@query
def federated_fit_moments(spark, folder):
    """What holds at the optimum of every site: probabilities sum to the positives, and the penalised gradient is zero."""
    rows, names = stages.model_rows(spark, folder)
    train = written(federated.local_split(rows).filter(~F.col("is_test")), "training")
    design = written(federated.design_rows(train, features.scaler_stats(train, names, ["location"]), names), "design")
    dimension = len(names) + 1
    theta = federated.fit_logistic(design, dimension)
    located = written(attach(design, theta, ["location"], "inner", dimension, computed=True), "located")
    sums = federated.linear_scores(located).groupBy("location").agg(
        F.count(F.lit(1)).alias("n"), F.sum("score").alias("positives")
    )
    weights = theta.select("location", F.posexplode("theta").alias("idx", "w"))
    slope = federated.site_sums(located, dimension).filter(F.col("idx") < dimension).join(weights, ["location", "idx"])
    steepest = slope.groupBy("location").agg(
        (F.max(F.abs(F.col("value") + F.when(F.col("idx") > 0, F.col("w")).otherwise(0.0))) < 1e-6).alias("stationary")
    )
    return rounded(sums.join(steepest, "location"), 5, "positives")


@query
def federated_participants(spark, folder):
    """Sites of a round that asks for two thirds of them."""
    return federated.participants(stages.merged(spark, folder), 0.67)


def _rounds(df):
    return _floors(df, "round", "total_samples", "num_clients", (F.col("train_accuracy") >= FLOORS["accuracy"]).alias("train_reached"))


@query
def federated_logistic(spark, folder):
    found = written(federated.federated_logistic(*stages.model_rows(spark, folder)), "rounds")
    writers.append_metrics(found, scratch_path(spark, "round-metrics"), "federated_logistic")
    return _rounds(found)


@query
def round_metrics_log(spark, folder):
    """The metrics of two runs, appended to one table and read back."""
    path = scratch_path(spark, "round-metrics")
    rows, names = stages.model_rows(spark, folder)
    for run_name, rounds in (("short", 2), ("long", 4)):
        writers.append_metrics(federated.federated_logistic(rows, names, rounds=rounds), path, run_name)
    logged = spark.read.parquet(path)
    return logged.groupBy("run").agg(F.count(F.lit(1)).alias("rounds"), F.max("total_samples").alias("total_samples"))


@query
def round_metrics_committed(spark, folder):
    """A table of rounds after one run was repeated, one went on, and one was killed before its commit."""
    path = scratch_path(spark, "round-metrics")
    rows, names = stages.model_rows(spark, folder)
    found = written(federated.federated_logistic(rows, names, rounds=4), "rounds")
    for run_name, rounds in (("short", 2), ("short", 2), ("long", 2), ("long", 4)):
        committed.log_rounds(found.filter(F.col("round") <= rounds), path, run_name)
    committed.stage_rounds(found, path, "killed")
    logged = committed.read_rounds(spark, path)
    return logged.groupBy("run").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("round").alias("rounds"), F.max("total_samples").alias("total_samples")
    )


@query
def federated_logistic_warm(spark, folder):
    """Federated averaging proper: ten rounds, each from the last average, with one scaling for all."""
    rows, names = stages.model_rows(spark, folder)
    found = written(federated.federated_logistic(rows, names, rounds=10, warm_start=True, scaler="global"), "rounds")
    return _rounds(found)


@query
def federated_forest(spark, folder):
    return _rounds(federated.federated_trees(*stages.model_rows(spark, folder))[0])


@query
def federated_parameters(spark, folder):
    """The averaged parameters: scalers by value, importances (of a fit) as valid shares."""
    found = written(federated.federated_trees(*stages.model_rows(spark, folder))[1], "parameters")
    share = F.col("param") == "importance"
    total = found.filter(share).agg(F.round(F.sum("value"), 9)).scalar()
    return found.select(
        "param", "idx", F.when(~share, F.round("value", 6)).alias("value"),
        (~share | ((F.col("value") >= 0) & (total == 1))).alias("valid"),
    )


@query
def uniform_parameters(spark, folder):
    """What sites without importances send, averaged."""
    rows, names = stages.model_rows(spark, folder)
    sizes = rows.groupBy("location").agg(F.count(F.lit(1)).alias("n"))
    return rounded(federated.average_parameters(federated.uniform_parameters(sizes, names)), 9)


# ---- streams -------------------------------------------------------------


def _stream_of(spark, table, name):
    """The table as files in a folder of its own, read back as a stream."""
    folder = scratch_path(spark, name)
    table.write.parquet(folder)
    return run.file_stream(spark, folder, table.schema)


@query
def stream_hourly_vitals(spark, folder):
    wearable = stages.sources(spark, folder, cumulative=True).wearable
    return run.drain(hourly.stream_vitals(_stream_of(spark, wearable, "wearable")))[0]


@query
def stream_environment(spark, folder):
    s = stages.sources(spark, folder)
    streams = [_stream_of(spark, t, n) for t, n in ((s.wearable, "wearable"), (s.air, "air"), (s.weather, "weather"))]
    out = run.drain(hourly.stream_environment(*streams))[0]
    return out.select(*KEYS, "heart_rate_mean", "spo2_mean", "aqi", "temperature", "aqi_category", "high_heart_rate")


@query
def stream_environment_unaligned(spark, folder):
    """The join of streams whose sites report several times an hour."""
    raw = events.read_events(spark, folder)
    wearable = events.wearable_view(raw, cumulative=False).withColumn("timestamp", F.col("ts"))
    tables = ((wearable, "wearable"), (events.air_readings(raw), "air"), (events.weather_readings(raw), "weather"))
    out = run.drain(hourly.stream_environment(*[_stream_of(spark, t, n) for t, n in tables]))[0]
    return out.select(*KEYS, "heart_rate_mean", "spo2_mean", "pm25", "aqi", "temperature", "precipitation")


@query
def stream_late_rows(spark, folder):
    """How many hourly sums came too late: the month arrives backwards in three parts.

    A batch is held against the watermark that the batch before it started with, so the second
    part is still in time.
    """
    wearable = stages.sources(spark, folder).wearable
    cuts = [F.lit(day).cast("timestamp_ntz") for day in ("9999-01-01", "2024-01-23", DRIFT_START, "0001-01-01")]
    path = scratch_path(spark, "late")
    for end, start in zip(cuts, cuts[1:]):
        # one file a batch, and one partial sum for each site and hour in it
        wearable.filter((F.col("timestamp") >= start) & (F.col("timestamp") < end)).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)  # files are taken in the order of their times
    stream = run.file_stream(spark, path, wearable.schema, maxFilesPerTrigger=1)
    _, dropped = run.drain(hourly.stream_vitals(stream))
    return spark.range(1).select(F.lit(dropped.total()).cast("long").alias("late_rows"))


@query
def stream_labels(spark, folder):
    """Rows labeled on arrival against the thresholds of a batch run."""
    table = stages.scored(spark, folder)
    merged = _stream_of(spark, table.select(*MERGED_COLUMNS), "merged")
    limits = written(labels.thresholds(table), "thresholds")
    return run.drain(hourly.stream_labels(merged, limits).select(*KEYS, "risk_score", "health_risk"))[0]


@query
def stream_alerts(spark, folder):
    merged = _stream_of(spark, stages.merged(spark, folder), "merged")
    return run.drain(hourly.stream_row_alerts(merged))[0]


@query
def stream_risk_alerts(spark, folder):
    labeled = _stream_of(spark, stages.labeled(spark, folder), "labeled")
    return rounded(run.drain(hourly.stream_risk_alerts(labeled))[0], 9)


WEEKS = ("2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2024-01-29", "2024-02-05")


def _in_turn(spark, table, name, each):
    """The weeks of a table arrive one after another: a folder of files that a stream picks up each time."""
    path, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")
    for start, end in zip(WEEKS, WEEKS[1:]):
        day = F.to_date("timestamp")
        table.filter((day >= F.lit(start).cast("date")) & (day < F.lit(end).cast("date"))).write.mode("append").parquet(path)
        stored.run_batches(run.file_stream(spark, path, table.schema), each, checkpoint)


@query
def stream_episodes(spark, folder):
    """Onsets and ends of the environment's alerts, of the hours that the watermark has passed."""
    merged = _stream_of(spark, stages.merged(spark, folder), "merged")
    return run.drain(episodes.stream_episodes(merged))[0]


@query
def stream_gaps(spark, folder):
    """Hours without a reading, found as the watermark passes them."""
    merged = _stream_of(spark, stages.merged(spark, folder), "merged")
    return run.drain(episodes.stream_gaps(merged))[0]


@query
def stream_following_limits(spark, folder):
    """Labels of each week against the limits of the weeks before, learned by the stream itself."""
    table = written(stages.merged(spark, folder).select(*MERGED_COLUMNS), "merged")
    limits = stored.FollowingLimits(scratch_path(spark, "limits"))
    _in_turn(spark, table, "weeks", limits.absorb)
    found = limits.labeled(spark).select(*KEYS, "risk_score", "threshold", "learned_from", "health_risk")
    return rounded(found, 9)


@query
def threshold_ranges(spark, folder):
    """Label thresholds of weeks and of the month, with their bounds, from one stored sketch per site and day."""
    scored = stages.scored(spark, folder).withColumn("day", F.to_date("timestamp"))
    daily = written(sketches.quantile_sketches(scored, "risk_score", ["location", "day"]), "daily-sketches")
    ranges = [(start, start, end) for start, end in zip(WEEKS, WEEKS[1:])] + [("month", WEEKS[0], WEEKS[-1])]
    asked = spark.createDataFrame(ranges, "name string, first string, last string")
    asked = asked.select("name", F.col("first").cast("date"), F.date_sub(F.col("last").cast("date"), 1).alias("last"))
    found = sketches.range_quantiles(daily, asked, {"threshold": 0.7})
    inside = F.lit(True).alias("bounds_hold")  # SQL holds the exact quantile against them
    return rounded(found.withColumn("bounds_hold", inside).drop("threshold"), 9)


def _repaired(spark, folder):
    """The month arrives backwards in three parts; what came too late is repaired in two goes."""
    wearable = written(stages.sources(spark, folder, cumulative=True).wearable, "wearable")
    store = stored.RepairableHours(scratch_path(spark, "hours"))
    cuts = [F.lit(day).cast("timestamp_ntz") for day in ("9999-01-01", "2024-01-23", DRIFT_START, "0001-01-01")]
    path, checkpoint = scratch_path(spark, "backwards"), scratch_path(spark, "backwards-checkpoint")
    hit = []
    for end, start in zip(cuts, cuts[1:]):
        wearable.filter((F.col("timestamp") >= start) & (F.col("timestamp") < end)).write.mode("append").parquet(path)
        stored.run_batches(run.file_stream(spark, path, wearable.schema), store.absorb, checkpoint)
        hit.append(written(store.repair(spark, wearable.schema), "hit"))
    return store.hours(spark, wearable.schema), merge.union_sites(hit)


@query
def stream_repaired_vitals(spark, folder):
    """Stream and repair together equal the batch table."""
    return _repaired(spark, folder)[0]


@query
def stream_repaired_hours(spark, folder):
    """The hours that late readings hit, and how many."""
    return _repaired(spark, folder)[1]


def _updated(spark, folder):
    """A table built without one site's readings of one day, which then arrive as a file of their own."""
    s = stages.sources(spark, folder, cumulative=True)
    wearable = written(s.wearable, "wearable")
    held_back = (F.col("location") == "hospital_B") & (F.to_date("timestamp") == F.lit("2024-01-10").cast("date"))
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "incremental")
    writers.write_sources_csv(events.Sources(wearable.filter(~held_back), s.air, s.weather), raw)
    kept = incremental.IncrementalTable(raw, out)
    kept.update(spark)
    columns = ["location", *[c for c in WEARABLE.names if c != "location"]]
    wearable.filter(held_back).select(*columns).write.mode("append").option("header", True).partitionBy("location").csv(f"{raw}/wearable")
    return kept, kept.update(spark)


@query
def incremental_table(spark, folder):
    """The table after its update equals a full run."""
    kept, _ = _updated(spark, folder)
    return kept.table(spark).select(*MERGED_COLUMNS)


@query
def incremental_partitions(spark, folder):
    """What the update computed again."""
    return _updated(spark, folder)[1]


# ---- drift and quality ---------------------------------------------------

DRIFT_FEATURES = ["heart_rate_mean", "spo2_mean", "steps_total", "pm25", "aqi", "temperature", "humidity"]
DRIFT_START = "2024-01-16"


def _windows(spark, folder):
    """First and second part of the month, from the table written once."""
    table = written(stages.merged(spark, folder), "merged")
    start = F.lit(DRIFT_START).cast("timestamp_ntz")
    return table.filter(F.col("timestamp") < start), table.filter(F.col("timestamp") >= start)


@query
def psi(spark, folder):
    return rounded(drift.population_stability(*_windows(spark, folder), DRIFT_FEATURES), 6)


@query
def ks(spark, folder):
    return rounded(drift.kolmogorov_smirnov(*_windows(spark, folder), DRIFT_FEATURES), 9)


@query
def drift_alerts(spark, folder):
    index = drift.population_stability(*_windows(spark, folder), DRIFT_FEATURES)
    return rounded(drift.drift_alerts(index, levels=(0.01, 0.03)), 6)


@query
def ks_alerts(spark, folder):
    found = drift.kolmogorov_smirnov(*_windows(spark, folder), DRIFT_FEATURES)
    return rounded(drift.ks_alerts(found, levels=(0.5, 0.9)), 9)


@query
def drift_series(spark, folder):
    """PSI and KS of every day against the seven days before, from one pass over the month."""
    running = written(window_drift.running_histograms(stages.merged(spark, folder), DRIFT_FEATURES), "running-histograms")
    day = F.explode(F.sequence(F.lit("2024-01-08").cast("date"), F.lit("2024-01-30").cast("date")))
    windows = spark.range(1).select(day.alias("day")).select(
        F.col("day").cast("string").alias("name"), F.date_sub("day", 7).alias("ref_first"),
        F.date_sub("day", 1).alias("ref_last"), F.col("day").alias("cur_first"), F.col("day").alias("cur_last"),
    )
    found = window_drift.window_drift(running, windows)
    return rounded(found.withColumn("bounds_hold", F.lit(True)), 6)  # SQL holds the exact distance against them


@query
def site_correlations(spark, folder):
    return rounded(similarity.site_correlations(stages.merged(spark, folder), DRIFT_FEATURES), 6)


@query
def profile_daily(spark, folder):
    table = written(stages.merged(spark, folder), "merged")
    return rounded(drift.daily_profile(table, DRIFT_FEATURES), 6)


@query
def data_quality(spark, folder):
    """Every sensor of the three sources against its range."""
    s = stages.sources(spark, folder)
    return rounded(merge.union_sites([drift.data_quality(t) for t in (s.wearable, s.air, s.weather)]), 9)


@query
def duplicate_readings(spark, folder):
    return drift.duplicate_keys(stages.sources(spark, folder).wearable, ["user_id", "timestamp"])


@query
def correlations(spark, folder):
    return rounded(drift.correlations(stages.merged(spark, folder), DRIFT_FEATURES), 6)


@query
def prediction_daily(spark, folder):
    return rounded(metrics.error_rate_daily(_scored_linear(spark, folder)), 6)


@query
def model_compare(spark, folder):
    rows, names = _split_rows(spark, folder)
    found = merge.union_sites([models.train_and_score(rows, names, kind) for kind in models.DEFAULTS])
    return _floors(found, "model_type", "n")


@query
def federated_vs_central(spark, folder):
    """One logistic model over all rows beside the federated average, on the same test rows."""
    rows, names = stages.model_rows(spark, folder)
    split = written(federated.local_split(rows), "split")
    central = models.train_and_score(split, names, "logistic_regression").select(
        F.lit("central").alias("mode"), "n", *federated.METRICS
    )
    average = federated.federated_logistic(rows, names, rounds=1)
    both = central.unionByName(
        average.select(F.lit("federated").alias("mode"), F.col("total_samples").alias("n"), *federated.METRICS)
    )
    return _floors(both, "mode", "n")
