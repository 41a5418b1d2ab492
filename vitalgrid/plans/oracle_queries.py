"""One SQL text per named query that SQL can express."""

from .oracle import DRIFT_FEATURES, FEATURES, MERGED, SUMMARY, TRENDS, sql

REGIONS = "('hospital_A', 'hospital_C')"

REACHED = "true AS accuracy_reached, true AS precision_reached, true AS recall_reached, true AS f1_reached, true AS roc_auc_reached"
HOUR_ALIGNED = """
    SELECT location, "timestamp", heart_rate_mean, spo2_mean, a.pm25, a.aqi, w.temperature, w.precipitation
    FROM vitals
    JOIN (SELECT location, "timestamp", round(avg(pm25), 9) AS pm25, round(avg(aqi), 9) AS aqi
          FROM air_all GROUP BY ALL) a USING (location, "timestamp")
    JOIN (SELECT location, "timestamp", round(avg(temperature), 9) AS temperature,
                 max(precipitation) AS precipitation
          FROM weather_all GROUP BY ALL) w USING (location, "timestamp")"""
WEEKS = """SELECT cast(first AS varchar) AS name, first, first + 7 AS last
                 FROM (SELECT unnest([DATE '2024-01-01', DATE '2024-01-08', DATE '2024-01-15', DATE '2024-01-22', DATE '2024-01-29']) AS first)"""
AVERAGED_SCALERS = " UNION ALL ".join(
    f"""SELECT '{p}' AS param, {i} AS idx, round(sum(n * {c}_{f}) / sum(n), 6) AS value FROM training_scales"""
    for i, f in enumerate(FEATURES) for p, c in (("scaler_mean", "mean"), ("scaler_scale", "scale")))

QUERIES = {
    # ---- vitals and merge
    "hourly_vitals": sql("SELECT * FROM vitals", "vitals"),
    "cumulative_steps_daily": sql(
        'SELECT event_id, user_id, "timestamp", cumulative_steps FROM wearable', "wearable"),
    "cumulative_steps_lifetime": sql(
        """SELECT event_id, user_id, "timestamp",
                  cast(sum(steps) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS bigint)
                      AS cumulative_steps
           FROM readings""", "readings"),
    "user_keys": sql(
        """SELECT concat(location, '_user_', CASE WHEN user_id < 1000 THEN lpad(cast(user_id AS varchar), 3, '0')
                                                  ELSE cast(user_id AS varchar) END) AS user_key, count(*) AS readings
           FROM readings GROUP BY ALL""", "readings"),
    "aqi_from_pm": sql('SELECT location, "timestamp", pm25, pm10, aqi FROM air', "air"),
    "env_join": sql("SELECT * FROM joined", "joined"),
    "merged_features": sql(f"SELECT {MERGED} FROM merged", "merged"),
    "all_nodes_merged": sql(f"SELECT {MERGED} FROM merged", "merged"),
    "merged_hour_aligned": sql(HOUR_ALIGNED, "vitals", "air_all", "weather_all"),
    "csv_to_labels": sql(
        'SELECT location, "timestamp", risk_score, health_risk, aqi, temperature, heart_rate_mean FROM labeled', "labeled"),
    "csv_sources": sql(
        """SELECT location, count(*) AS rows_read, cast(sum(steps) AS bigint) AS steps,
                  cast(sum(cast(round(heart_rate * 10) AS bigint)) AS bigint) AS heart_rate_tenths,
                  min("timestamp") AS first_ts, max("timestamp") AS last_ts
           FROM wearable GROUP BY location""", "wearable"),
    "merged_table": sql(f"SELECT {MERGED} FROM merged WHERE location = 'hospital_B'", "merged"),
    "hourly_spine": sql(
        """SELECT location, unnest(generate_series(min("timestamp"), max("timestamp"), INTERVAL 1 HOUR)) AS "timestamp"
           FROM readings GROUP BY location""", "readings"),
    "time_gaps": sql(
        """SELECT location, "timestamp" FROM (
               SELECT location, unnest(generate_series(min("timestamp"), max("timestamp"), INTERVAL 1 HOUR)) AS "timestamp"
               FROM readings GROUP BY location)
           EXCEPT SELECT location, "timestamp" FROM readings""", "readings"),
    "expected_pollution": sql(
        """SELECT location, "timestamp", pm25, pm10, traffic_band,
                  round(b25 * f, 6) AS expected_pm25, round(b10 * f, 6) AS expected_pm10,
                  round(pm25 - b25 * f, 6) AS pm25_residual, round(pm10 - b10 * f, 6) AS pm10_residual
           FROM (SELECT *, (CASE traffic_band WHEN 'rush' THEN 1.3e0 WHEN 'daytime' THEN 1.1e0 ELSE 0.9e0 END)
                        * (CASE WHEN isodow("timestamp") >= 6 THEN 0.85e0 ELSE 1e0 END)
                        * (1 + sin(2 * pi() * hour("timestamp") / 24e0) * 0.1e0) AS f
                 FROM (SELECT *, CASE WHEN hour("timestamp") BETWEEN 7 AND 9 OR hour("timestamp") BETWEEN 17 AND 19 THEN 'rush'
                                      WHEN hour("timestamp") BETWEEN 10 AND 16 THEN 'daytime' ELSE 'night' END AS traffic_band,
                              CASE location WHEN 'hospital_A' THEN 35e0 WHEN 'hospital_B' THEN 25e0
                                            WHEN 'hospital_C' THEN 45e0 ELSE 30e0 END AS b25,
                              CASE location WHEN 'hospital_A' THEN 50e0 WHEN 'hospital_B' THEN 40e0
                                            WHEN 'hospital_C' THEN 65e0 ELSE 45e0 END AS b10
                       FROM air))""", "air"),
    "expected_temperature": sql(
        """SELECT location, "timestamp", temperature, round(e, 6) AS expected_temperature,
                  round(temperature - e, 6) AS temperature_residual
           FROM (SELECT *, b + sin(2 * pi() * (hour("timestamp") - 4) / 24e0) * r
                        + sin(2 * pi() * dayofyear("timestamp") / 365e0) * 5e0 AS e
                 FROM (SELECT *, CASE location WHEN 'hospital_A' THEN 22e0 WHEN 'hospital_B' THEN 18e0
                                               WHEN 'hospital_C' THEN 28e0 ELSE 20e0 END AS b,
                              CASE location WHEN 'hospital_A' THEN 8e0 WHEN 'hospital_B' THEN 6e0
                                            WHEN 'hospital_C' THEN 10e0 ELSE 8e0 END AS r
                       FROM weather))""", "weather"),
    "activity_profile": sql(
        """SELECT location, CASE WHEN hour("timestamp") BETWEEN 2 AND 6 THEN 'night'
                                 WHEN hour("timestamp") BETWEEN 7 AND 10 THEN 'morning'
                                 WHEN hour("timestamp") BETWEEN 11 AND 18 THEN 'day' ELSE 'evening' END AS activity_band,
                  count(*) AS readings, round(avg(heart_rate), 6) AS avg_heart_rate,
                  cast(sum(sleep_status) AS bigint) AS sleep_hour_readings
           FROM readings GROUP BY ALL""", "readings"),
    # ---- risk and labels
    "risk_components": sql(
        """SELECT location, "timestamp", aqi_risk, heart_rate_risk, spo2_risk, pm25_risk,
                  weather_risk, combined_risk, risk_score FROM scored""", "scored"),
    "risk_score": sql('SELECT location, "timestamp", risk_score FROM scored', "scored"),
    "label_thresholds": sql(
        """SELECT location, count(risk_score) AS n, round(quantile_cont(risk_score, 0.7e0), 9) AS threshold
           FROM scored GROUP BY location""", "scored"),
    "label_binary_node": sql(
        'SELECT location, "timestamp", risk_score, health_risk, risk_category FROM labeled', "labeled"),
    "label_binary_global": sql(
        'SELECT location, "timestamp", risk_score, health_risk, risk_category FROM labeled_all', "labeled_all"),
    "label_continuous": sql(
        """SELECT location, "timestamp", risk_score AS health_risk,
                  CASE WHEN risk_score <= 0 THEN NULL WHEN risk_score <= 0.3e0 THEN 'Low'
                       WHEN risk_score <= 0.6e0 THEN 'Medium' WHEN risk_score <= 1 THEN 'High' END AS risk_category
           FROM scored""", "scored"),
    "label_distribution": sql(
        "SELECT location, health_risk, count(*) AS n FROM labeled GROUP BY ALL", "labeled"),
    "label_constant_fallback": sql(
        """SELECT location, "timestamp",
                  CASE WHEN row_number() OVER (PARTITION BY location
                                ORDER BY md5(concat_ws('|', location, cast("timestamp" AS varchar))))
                            <= greatest(1, floor(0.3e0 * count(*) OVER (PARTITION BY location)))
                       THEN 1 ELSE 0 END AS health_risk
           FROM scored""", "scored"),
    "label_one_constant_site": sql(
        """SELECT location, "timestamp", health_risk, risk_category FROM labeled WHERE location <> 'hospital_B'
           UNION ALL
           SELECT location, "timestamp", health_risk, CASE health_risk WHEN 1 THEN 'High' ELSE 'Low' END
           FROM (SELECT location, "timestamp",
                        CASE WHEN row_number() OVER (ORDER BY md5(concat_ws('|', location, cast("timestamp" AS varchar))))
                                  <= greatest(1, floor(0.3e0 * count(*) OVER ())) THEN 1 ELSE 0 END AS health_risk
                 FROM scored WHERE location = 'hospital_B')""", "labeled", "scored"),
    # ---- reports
    "node_summary": sql(SUMMARY.format(table="labeled", where=""), "labeled"),
    "node_summary_global": sql(SUMMARY.format(table="labeled_all", where=""), "labeled_all"),
    "regional_comparison": sql(SUMMARY.format(table="labeled", where=f"WHERE location IN {REGIONS}"), "labeled"),
    "source_summary": sql(
        """SELECT location, air_rows, avg_aqi, avg_pm25, weather_rows, avg_temperature, avg_humidity
           FROM (SELECT location, count(*) AS air_rows, round(avg(aqi), 6) AS avg_aqi, round(avg(pm25), 6) AS avg_pm25
                 FROM air GROUP BY location)
           FULL JOIN (SELECT location, count(*) AS weather_rows, round(avg(temperature), 6) AS avg_temperature,
                             round(avg(humidity), 6) AS avg_humidity FROM weather GROUP BY location)
           USING (location)""", "air", "weather"),
    "kpi_overview": sql(
        """SELECT count(*) AS total_records, cast(sum(health_risk) AS bigint) AS total_high_risk,
                  round(sum(health_risk) / count(*) * 100, 6) AS risk_percentage,
                  round(avg(aqi), 6) AS avg_aqi, round(avg(pm25), 6) AS avg_pm25,
                  CASE WHEN avg(aqi) < 50 THEN 'Good' WHEN avg(aqi) < 100 THEN 'Moderate' ELSE 'Unhealthy' END AS aqi_status
           FROM labeled_all""", "labeled_all"),
    "daily_risk_trends": sql(TRENDS.format(by="", table="labeled_all"), "labeled_all"),
    "daily_risk_trends_by_node": sql(TRENDS.format(by="location,", table="labeled"), "labeled"),
    "citizen_daily": sql(
        """SELECT location, cast("timestamp" AS date) AS date, round(avg(health_risk), 6) AS health_risk,
                  round(avg(aqi), 6) AS aqi, round(avg(pm25), 6) AS pm25, round(avg(temperature), 6) AS temperature,
                  round(avg(heart_rate_mean), 6) AS heart_rate_mean, round(avg(spo2_mean), 6) AS spo2_mean,
                  round(avg(health_risk) * 100, 6) AS risk_percentage
           FROM labeled GROUP BY ALL""", "labeled"),
    "daily_health": sql(
        """SELECT location, cast("timestamp" AS date) AS date, round(avg(heart_rate_mean), 6) AS heart_rate_mean,
                  round(avg(spo2_mean), 6) AS spo2_mean, round(avg(active_users_count), 6) AS active_users_count
           FROM merged GROUP BY ALL""", "merged"),
    "time_extent": sql(
        'SELECT location, min("timestamp") AS first_ts, max("timestamp") AS last_ts FROM merged GROUP BY location',
        "merged"),
    "input_coverage": sql(
        """SELECT location, coalesce(n, 0) AS n, coalesce(n, 0) > 0 AS present
           FROM (VALUES ('hospital_A'), ('hospital_B'), ('hospital_C'), ('hospital_D')) e(location)
           LEFT JOIN (SELECT location, count(*) AS n FROM merged GROUP BY location) USING (location)""", "merged"),
    "missing_inputs": sql(
        """SELECT location FROM (VALUES ('hospital_A'), ('hospital_B'), ('hospital_C'), ('hospital_D')) e(location)
           WHERE location NOT IN (SELECT location FROM merged)""", "merged"),
    "latest_status": sql(
        """SELECT location, "timestamp", strftime("timestamp", '%Y-%m-%d %H:%M') AS updated, health_risk,
                  CASE WHEN health_risk >= 0.7e0 THEN 'High Risk' WHEN health_risk >= 0.4e0 THEN 'Medium Risk'
                       ELSE 'Low Risk' END AS current_risk,
                  aqi, CASE WHEN aqi < 50 THEN 'Good' WHEN aqi < 100 THEN 'Moderate' ELSE 'Unhealthy' END AS aqi_status,
                  temperature,
                  CASE WHEN temperature BETWEEN 15 AND 30 THEN 'Comfortable' ELSE 'Extreme' END AS temperature_status,
                  pm25, CASE WHEN pm25 < 25 THEN 'Safe' WHEN pm25 < 50 THEN 'Moderate' ELSE 'Unhealthy' END AS pm25_status
           FROM latest""", "latest"),
    "recent_risk_rate": sql("SELECT location, round(rate, 9) AS recent_risk_rate FROM recent", "recent"),
    "alerts": sql(
        """SELECT location, "timestamp", rule, round(value, 9) AS value, type, severity, message,
                  upper(type) AS title, strftime("timestamp", '%Y-%m-%d %H:%M') AS time FROM alert_rows""", "alert_rows"),
    "region_alerts": sql(
        f"""SELECT location, "timestamp", rule, round(value, 9) AS value, type, severity, message
            FROM alert_rows WHERE location IN {REGIONS}""", "alert_rows"),
    "citizen_alerts": sql(
        """SELECT location, "timestamp", rule, round(value, 9) AS value, type, severity, message
           FROM alert_rows WHERE location = 'hospital_B'""", "alert_rows"),
    "recommendations": sql(
        """SELECT location, "timestamp", 1 AS rule, aqi AS value, CASE WHEN aqi > 150 THEN 'high' ELSE 'medium' END AS priority,
                  'Air Quality Alert' AS title,
                  concat('The air quality index is ', cast(floor(aqi) AS bigint), ': stay inside or wear a mask.') AS message
           FROM latest WHERE aqi > 100
           UNION ALL
           SELECT location, "timestamp", 2, pm25, CASE WHEN pm25 > 75 THEN 'high' ELSE 'medium' END, 'High PM2.5',
                  concat('Fine particles are at ', cast(floor(pm25) AS bigint), ': avoid effort outside.')
           FROM latest WHERE pm25 > 50
           UNION ALL
           SELECT location, "timestamp", 3, temperature, 'medium', 'High Temperature',
                  concat('It has ', cast(floor(temperature) AS bigint), ' degrees: drink water and seek shade.')
           FROM latest WHERE temperature > 35
           UNION ALL
           SELECT location, "timestamp", 4, temperature, 'medium', 'Low Temperature',
                  concat('It has ', cast(floor(temperature) AS bigint), ' degrees: keep warm.')
           FROM latest WHERE temperature < 5
           UNION ALL
           SELECT location, "timestamp", 5, health_risk, CASE WHEN health_risk > 0.7e0 THEN 'high' ELSE 'medium' END,
                  'Elevated Health Risk', 'Signs of raised health risk here: watch how you feel.'
           FROM latest WHERE health_risk > 0.4e0""", "latest"),
    "env_series": sql(
        """UNPIVOT (SELECT location, "timestamp", aqi, pm25, temperature, humidity FROM merged)
           ON aqi, pm25, temperature, humidity INTO NAME metric VALUE value""", "merged"),
    "vitals_series": sql(
        """UNPIVOT (SELECT location, "timestamp", heart_rate_mean, spo2_mean FROM merged)
           ON heart_rate_mean, spo2_mean INTO NAME metric VALUE value""", "merged"),
    "detail_table": sql(
        """SELECT "timestamp", location, health_risk, aqi, pm25, temperature, heart_rate_mean, spo2_mean
           FROM labeled_all ORDER BY "timestamp" DESC, location""", "labeled_all"),
    "last_7_days": sql(
        """SELECT location, "timestamp", health_risk, aqi FROM labeled
           JOIN (SELECT location, cast(max("timestamp") AS date) - 7 AS start FROM labeled GROUP BY location)
           USING (location) WHERE "timestamp" >= start""", "labeled"),
    "date_range": sql(
        f"""SELECT location, "timestamp", aqi, heart_rate_mean FROM merged
            WHERE location IN {REGIONS} AND cast("timestamp" AS date) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'""",
        "merged"),
    "panel_rows": sql(
        f""", a AS (SELECT * FROM labeled_all WHERE location IN {REGIONS}
                AND cast("timestamp" AS date) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'),
            a_last AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY location ORDER BY "timestamp" DESC) = 1),
            a_rate AS (SELECT location, avg(health_risk) AS rate
                FROM a JOIN (SELECT location, max("timestamp") AS t FROM a GROUP BY location) USING (location)
                WHERE "timestamp" >= t - INTERVAL 24 HOURS GROUP BY location),
            c AS (SELECT * FROM labeled WHERE location = 'hospital_B'
                AND "timestamp" >= (SELECT cast(max("timestamp") AS date) - 7 FROM labeled WHERE location = 'hospital_B')),
            c_last AS (SELECT * FROM c ORDER BY "timestamp" DESC LIMIT 1)
            SELECT 'authority' AS viewer, 'rows' AS panel, count(*) AS n FROM a
            UNION ALL SELECT 'authority', 'kpi', 1
            UNION ALL SELECT 'authority', 'alerts', (SELECT count(*) FROM a_rate WHERE rate > 0.3e0) + (SELECT
                coalesce(cast(sum((aqi > 150)::INT + (pm25 > 50)::INT + (temperature > 35 OR temperature < 5)::INT) AS bigint), 0)
                FROM a_last)
            UNION ALL SELECT 'authority', 'comparison', count(DISTINCT location) FROM labeled WHERE location IN {REGIONS}
            UNION ALL SELECT 'authority', 'trends', count(DISTINCT cast("timestamp" AS date)) FROM a
            UNION ALL SELECT 'authority', 'environment', 4 * count(*) FROM a
            UNION ALL SELECT 'authority', 'vitals', 2 * count(*) FROM a
            UNION ALL SELECT 'authority', 'detail', count(*) FROM a
            UNION ALL SELECT 'citizen', 'rows', count(*) FROM c
            UNION ALL SELECT 'citizen', 'status', count(*) FROM c_last
            UNION ALL SELECT 'citizen', 'alerts', (SELECT count(*) FROM c_last WHERE (SELECT avg(health_risk) FROM c
                WHERE "timestamp" >= (SELECT max("timestamp") FROM c) - INTERVAL 24 HOURS) > 0.3e0) + (SELECT
                coalesce(cast(sum((aqi > 150)::INT + (pm25 > 50)::INT + (temperature > 35 OR temperature < 5)::INT) AS bigint), 0)
                FROM c_last)
            UNION ALL SELECT 'citizen', 'daily', count(DISTINCT cast("timestamp" AS date)) FROM c
            UNION ALL SELECT 'citizen', 'health', count(DISTINCT cast("timestamp" AS date)) FROM c
            UNION ALL SELECT 'citizen', 'environment', 4 * count(*) FROM c
            UNION ALL SELECT 'citizen', 'recommendations', coalesce(cast(sum((aqi > 100)::INT + (pm25 > 50)::INT
                + (temperature > 35 OR temperature < 5)::INT + (health_risk > 0.4e0)::INT) AS bigint), 0) FROM c_last""",
        "labeled", "labeled_all"),
    # ---- features
    "vocabulary": sql(
        """SELECT 'aqi_category' AS feature, aqi_category AS category FROM merged WHERE aqi_category IS NOT NULL
           UNION
           SELECT 'temp_category', temp_category FROM merged WHERE temp_category IS NOT NULL""", "merged"),
    "one_hot_features": sql(
        'SELECT location, "timestamp", ' + ", ".join(
            f"cast({n} AS integer) AS {n}" for n in FEATURES if "_category_" in n) + " FROM features", "features"),
    "prepared_features": sql("SELECT * FROM features", "features"),
    "feature_alignment": sql(
        """SELECT location, "timestamp", health_risk, cast(spo2_mean AS double) AS spo2_mean, 0e0 AS unseen_feature,
                  cast(aqi AS double) AS aqi FROM labeled""", "labeled"),
    "scaler_stats": sql(
        "SELECT location, n, feature, mean, scale FROM (" + " UNION ALL ".join(
            f"SELECT location, n, '{n}' AS feature, round(mean_{n}, 6) AS mean, round(scale_{n}, 6) AS scale FROM scales"
            for n in FEATURES) + ")", "scales"),
    "scaled_features": sql(
        'SELECT location, "timestamp", health_risk, ' + ", ".join(
            f"round(({n} - mean_{n}) / scale_{n}, 6) AS {n}" for n in FEATURES)
        + " FROM features JOIN scales USING (location)", "features", "scales"),
    "stratified_split": sql('SELECT location, "timestamp", health_risk, is_test FROM split', "split"),
    "random_split": sql(
        """SELECT location, "timestamp",
                  row_number() OVER (ORDER BY md5(concat_ws('|', location, cast("timestamp" AS varchar), '42')))
                      <= ceil(0.2e0 * count(*) OVER ()) AS is_test
           FROM merged""", "merged"),
    # ---- metrics on a fixed scorer
    "confusion_metrics": sql(
        """SELECT location, n, round(accuracy, 9) AS accuracy, round("precision", 9) AS "precision",
                  round(recall, 9) AS recall, round(f1, 9) AS f1 FROM node_metrics""", "node_metrics"),
    "confusion_matrix": sql(
        "SELECT location, health_risk, prediction, count(*) AS n FROM linear GROUP BY ALL", "linear"),
    "class_counts": sql(
        "SELECT location, count(DISTINCT health_risk) AS classes FROM labeled GROUP BY location", "labeled"),
    "roc_auc": sql("SELECT location, round(roc_auc, 9) AS roc_auc FROM area", "area"),
    "fedavg_scaler": sql(f"SELECT * FROM ({AVERAGED_SCALERS})", "training_scales"),
    "federated_metrics": sql(
        """SELECT round(sum(n * accuracy) / sum(n), 9) AS accuracy, round(sum(n * "precision") / sum(n), 9) AS "precision",
                  round(sum(n * recall) / sum(n), 9) AS recall, round(sum(n * f1) / sum(n), 9) AS f1,
                  round(sum(n * roc_auc) / sum(n), 9) AS roc_auc, round(sum(n * (1 - accuracy)) / sum(n), 9) AS loss,
                  cast(sum(n) AS bigint) AS total_samples, count(*) AS num_clients
           FROM node_metrics""", "node_metrics"),
    # ---- models: the rows that take part; every floor is to be reached
    **{name: sql(
        f"""SELECT location, '{kind}' AS model_type, count(*) FILTER (is_test) AS n, {REACHED}
            FROM split_by_label GROUP BY location""", "split_by_label")
       for name, kind in (("train_logistic", "logistic_regression"), ("train_forest", "random_forest"),
                          ("train_gbt", "gradient_boosting"))},
    "central_train": sql(
        """SELECT cast(ceil(0.2e0 * count(*) FILTER (hour <> 0)) AS bigint) AS n,
                  count(*) FILTER (hour = 0) AS left_out, true AS accuracy_reached FROM labeled_all""", "labeled_all"),
    "saved_model": sql(
        "SELECT location, count(*) AS n, true AS same FROM split_by_label WHERE is_test GROUP BY location", "split_by_label"),
    "feature_importance": " UNION ALL ".join(
        f"SELECT {i} AS idx, '{f}' AS feature, true AS valid" for i, f in enumerate(FEATURES)),
    "forest_splits": sql(
        """SELECT location, node, feature, round(edge, 6) AS threshold, n, positives, left_n, left_positives, round(gain, 9) AS gain
           FROM tree_splits""", "tree_splits"),
    "forest_importances": sql(
        f"""SELECT location, feature, round(coalesce(gained, 0e0) / sum(gained) OVER (PARTITION BY location), 6) AS value
            FROM (SELECT DISTINCT location FROM tree_splits)
            CROSS JOIN (SELECT unnest([{", ".join(f"'{f}'" for f in FEATURES)}]) AS feature)
            LEFT JOIN (SELECT location, feature, sum(n * gain) AS gained FROM tree_splits GROUP BY ALL) USING (location, feature)""",
        "tree_splits"),
    "federated_gradient": sql(
        "SELECT location, idx, round(value, 6) + 0e0 AS value FROM (" + " UNION ALL ".join(
            f"SELECT location, {i} AS idx, sum((0.5e0 - health_risk) * {x}) AS value FROM training JOIN training_scales "
            "USING (location) GROUP BY location"
            for i, x in enumerate(["1e0", *[f"(training.{f} - mean_{f}) / scale_{f}" for f in FEATURES]]))
        + f" UNION ALL SELECT location, {len(FEATURES) + 1}, count(*) * 0.25e0 FROM training GROUP BY location)",
        "training", "training_scales"),
    "federated_fit_moments": sql(
        """SELECT location, count(*) AS n, round(cast(sum(health_risk) AS double), 5) AS positives, true AS stationary
           FROM training GROUP BY location""", "training"),
    "federated_participants": sql(
        "SELECT location FROM (SELECT DISTINCT location FROM merged) ORDER BY md5(location) LIMIT 2", "merged"),
    **{name: sql(
        f"""SELECT cast(unnest(range(1, 11)) AS integer) AS round, total_samples, num_clients, true AS train_reached, {REACHED}
            FROM (SELECT count(*) AS total_samples, count(DISTINCT location) AS num_clients FROM split WHERE is_test)""",
        "split") for name in ("federated_logistic", "federated_logistic_warm", "federated_forest")},
    "round_metrics_log": sql(
        """SELECT run, rounds, total_samples FROM (VALUES ('short', cast(2 AS bigint)), ('long', 4)) r(run, rounds),
                  (SELECT count(*) AS total_samples FROM split WHERE is_test)""", "split"),
    "round_metrics_committed": sql(
        """SELECT run, rounds AS n_rows, rounds, total_samples FROM (VALUES ('short', cast(2 AS bigint)), ('long', 4)) r(run, rounds),
                  (SELECT count(*) AS total_samples FROM split WHERE is_test)""", "split"),
    "federated_parameters": sql(
        f"SELECT param, idx, value, true AS valid FROM ({AVERAGED_SCALERS}) UNION ALL "
        + " UNION ALL ".join(f"SELECT 'importance', {i}, NULL, true" for i in range(len(FEATURES))), "training_scales"),
    "uniform_parameters": " UNION ALL ".join(
        f"SELECT 'importance' AS param, {i} AS idx, round(1e0 / {len(FEATURES)}, 9) AS value" for i in range(len(FEATURES))),
    "model_compare": sql(
        f"""SELECT kind AS model_type, n, {REACHED} FROM (SELECT count(*) AS n FROM split_by_label WHERE is_test),
            (VALUES ('logistic_regression'), ('random_forest'), ('gradient_boosting')) k(kind)""", "split_by_label"),
    "federated_vs_central": sql(
        f"""SELECT mode, n, {REACHED} FROM (SELECT count(*) AS n FROM split WHERE is_test),
            (VALUES ('central'), ('federated')) m(mode)""", "split"),
    # ---- tables kept up to date, sketches, streams with stored state
    "incremental_table": sql(f"SELECT {MERGED} FROM merged", "merged"),
    "incremental_partitions": sql(
        """SELECT location, cast("timestamp" AS date) AS day, count(*) AS hours FROM merged
           WHERE location = 'hospital_B' AND cast("timestamp" AS date) = DATE '2024-01-10' GROUP BY ALL""", "merged"),
    "threshold_ranges": sql(
        f"""SELECT name, location, n, round(any_value(low) FILTER (place = floor(h)), 9) AS threshold_low,
                   round(any_value(high) FILTER (place = ceil(h)), 9) AS threshold_high,
                   round((CASE WHEN any_value(cell) FILTER (place = floor(h)) = any_value(cell) FILTER (place = ceil(h))
                          THEN any_value(here) FILTER (place = floor(h))
                          ELSE any_value(here) FILTER (place = floor(h)) + any_value(here) FILTER (place = ceil(h)) END) / n, 9)
                       AS threshold_rank_error,
                   quantile_cont(risk_score, 0.7e0) BETWEEN any_value(low) FILTER (place = floor(h)) - 1e-12
                       AND any_value(high) FILTER (place = ceil(h)) + 1e-12 AS bounds_hold
            FROM (SELECT *, (n - 1) * 0.7e0 AS h, min(risk_score) OVER same AS low, max(risk_score) OVER same AS high,
                         count(*) OVER same AS here
                  FROM (SELECT name, location, risk_score, floor(risk_score * 4096) AS cell,
                               row_number() OVER (PARTITION BY name, location ORDER BY risk_score) - 1 AS place,
                               count(*) OVER (PARTITION BY name, location) AS n
                        FROM scored JOIN ({WEEKS} UNION ALL SELECT 'month', DATE '2024-01-01', DATE '2024-02-05') w
                        ON cast("timestamp" AS date) >= first AND cast("timestamp" AS date) < last)
                  WINDOW same AS (PARTITION BY name, location, cell))
            GROUP BY name, location, n""", "scored"),
    "stream_following_limits": sql(
        f"""SELECT s.location, s."timestamp", risk_score, round(threshold, 9) AS threshold, learned_from,
                   cast(risk_score >= threshold AS integer) AS health_risk
            FROM (SELECT scored.*, name FROM scored JOIN ({WEEKS}) w
                  ON cast("timestamp" AS date) >= first AND cast("timestamp" AS date) < last) s
            LEFT JOIN (SELECT name, location, n AS learned_from, high AS threshold
                       FROM (SELECT name, location, max(risk_score) OVER (PARTITION BY name, location, floor(risk_score * 4096)) AS high,
                                    row_number() OVER (PARTITION BY name, location ORDER BY risk_score) - 1 AS place,
                                    count(*) OVER (PARTITION BY name, location) AS n
                             FROM scored JOIN ({WEEKS}) w ON cast("timestamp" AS date) < first)
                       WHERE place = ceil((n - 1) * 0.7e0)) l ON s.name = l.name AND s.location = l.location""", "scored"),
    "stream_episodes": sql(
        """SELECT location, type, event, "timestamp", hours, peak FROM (
               SELECT location, type, 'onset' AS event, min("timestamp") AS "timestamp", cast(1 AS bigint) AS hours,
                      arg_min(value, "timestamp") AS peak
               FROM episode_hours GROUP BY location, type, episode
               UNION ALL
               SELECT location, type, 'end', CASE WHEN max(silent::int) = 1 THEN max("timestamp") ELSE max(next) END, count(*), max(value)
               FROM episode_hours GROUP BY location, type, episode HAVING max(next) > max("timestamp"))""", "episode_hours"),
    "stream_gaps": sql(
        """SELECT location, "timestamp" FROM (
               SELECT location, unnest(generate_series(min("timestamp"), max("timestamp"), INTERVAL 1 HOUR)) AS "timestamp"
               FROM passed_hours GROUP BY location)
           EXCEPT SELECT location, "timestamp" FROM passed_hours""", "passed_hours"),
    "stream_repaired_vitals": sql("SELECT * FROM vitals", "vitals"),
    "stream_repaired_hours": sql(
        """SELECT location, "timestamp", count(*) AS late_readings FROM readings
           WHERE "timestamp" < TIMESTAMP '2024-01-23' GROUP BY ALL""", "readings"),
    # ---- streams: append mode holds back hours the watermark has not passed
    "stream_hourly_vitals": sql(
        """SELECT * FROM vitals
           WHERE "timestamp" + INTERVAL 1 HOUR <= (SELECT max("timestamp") FROM readings) - INTERVAL 2 HOURS""",
        "vitals", "readings"),
    "stream_environment": sql(
        """SELECT location, "timestamp", heart_rate_mean, spo2_mean, round(aqi, 9) AS aqi, round(temperature, 9) AS temperature,
                  aqi_category, high_heart_rate
           FROM merged
           WHERE "timestamp" + INTERVAL 1 HOUR <= (SELECT max("timestamp") FROM readings) - INTERVAL 2 HOURS""",
        "merged", "readings"),
    "stream_environment_unaligned": sql(
        HOUR_ALIGNED
        + """ WHERE "timestamp" + INTERVAL 1 HOUR <= (SELECT max(ts) FROM readings) - INTERVAL 2 HOURS""",
        "vitals", "air_all", "weather_all", "readings"),
    "stream_late_rows": sql(
        """SELECT count(*) AS late_rows FROM (
               SELECT DISTINCT location, "timestamp" FROM readings WHERE "timestamp" < TIMESTAMP '2024-01-16')""", "readings"),
    "stream_labels": sql('SELECT location, "timestamp", risk_score, health_risk FROM labeled', "labeled"),
    "stream_alerts": sql("SELECT * FROM environment_alerts", "environment_alerts"),
    "stream_risk_alerts": sql(
        """SELECT location, until, count(health_risk) AS n, round(avg(health_risk), 9) AS value, 'high_risk' AS type,
                  CASE WHEN avg(health_risk) > 0.5e0 THEN 'high' ELSE 'medium' END AS severity
           FROM (SELECT location, health_risk, unnest(generate_series("timestamp" + INTERVAL 1 HOUR,
                        "timestamp" + INTERVAL 24 HOURS, INTERVAL 1 HOUR)) AS until FROM labeled)
           WHERE until <= (SELECT max("timestamp") FROM labeled) - INTERVAL 2 HOURS
           GROUP BY location, until HAVING avg(health_risk) > 0.3e0""", "labeled"),
    # ---- drift and quality
    "psi": sql("SELECT feature, round(psi, 6) AS psi FROM psi", "psi"),
    "ks": sql(
        """SELECT feature, n_ref, n_cur, round(max(abs(cum_ref / n_ref - cum_cur / n_cur)), 9) AS ks
           FROM (SELECT feature, cum_ref, cum_cur,
                        cast(max(cum_ref) OVER (PARTITION BY feature) AS bigint) AS n_ref,
                        cast(max(cum_cur) OVER (PARTITION BY feature) AS bigint) AS n_cur
                 FROM (SELECT feature,
                              count(*) FILTER (NOT is_current) OVER (PARTITION BY feature ORDER BY value) AS cum_ref,
                              count(*) FILTER (is_current) OVER (PARTITION BY feature ORDER BY value) AS cum_cur
                       FROM long_rows))
           GROUP BY feature, n_ref, n_cur""", "long_rows"),
    "drift_alerts": sql(
        """SELECT feature, round(psi, 6) AS value, 'drift' AS type,
                  CASE WHEN psi > 0.03e0 THEN 'high' ELSE 'medium' END AS severity FROM psi WHERE psi > 0.01e0""", "psi"),
    "profile_daily": sql(
        """SELECT date, feature, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
                  round(min(value), 6) AS min, round(max(value), 6) AS max, round(quantile_cont(value, 0.25e0), 6) AS p25,
                  round(quantile_cont(value, 0.5e0), 6) AS p50, round(quantile_cont(value, 0.75e0), 6) AS p75
           FROM long_rows GROUP BY date, feature""", "long_rows"),
    "data_quality": sql(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) AS n, count(*) FILTER ({c} IS NULL) AS nulls,
                       count(*) FILTER ({c} < {low} OR {c} > {high}) AS out_of_range,
                       round(count(*) FILTER ({c} IS NULL) / count(*), 9) AS null_share FROM {table}"""
            for table, c, low, high in (
                ("readings", "heart_rate", 50, 180), ("readings", "spo2", 90, 100), ("readings", "sleep_quality", 0, 100),
                ("air", "aqi", 0, 500), ("air", "co2", 400, 1000), ("weather", "humidity", 20, 100),
                ("weather", "wind_speed", 0, 50), ("weather", "pressure", 980, 1050), ("weather", "rainfall", 0, 50))),
        "readings", "air", "weather"),
    "duplicate_readings": sql(
        'SELECT user_id, "timestamp", count(*) AS n FROM readings GROUP BY ALL HAVING count(*) > 1', "readings"),
    "ks_alerts": sql(
        """SELECT feature, round(ks, 9) AS value, round(0.5e0 * unit, 9) AS critical, 'drift' AS type,
                  CASE WHEN ks > 0.9e0 * unit THEN 'high' ELSE 'medium' END AS severity
           FROM (SELECT feature, sqrt((n_ref + n_cur) / (n_ref * 1e0 * n_cur)) AS unit, ks
                 FROM (SELECT feature, n_ref, n_cur, max(abs(cum_ref / n_ref - cum_cur / n_cur)) AS ks
                       FROM (SELECT feature, cum_ref, cum_cur, max(cum_ref) OVER (PARTITION BY feature) AS n_ref,
                                    max(cum_cur) OVER (PARTITION BY feature) AS n_cur
                             FROM (SELECT feature,
                                          count(*) FILTER (NOT is_current) OVER (PARTITION BY feature ORDER BY value) AS cum_ref,
                                          count(*) FILTER (is_current) OVER (PARTITION BY feature ORDER BY value) AS cum_cur
                                   FROM long_rows)) GROUP BY ALL))
           WHERE ks > 0.5e0 * unit""", "long_rows"),
    "drift_series": sql(
        """SELECT c.name, c.feature, c.n_ref, c.n_cur, round(psi, 6) AS psi, round(ks_low, 6) AS ks_low, round(ks_high, 6) AS ks_high,
                  ks BETWEEN ks_low - 1e-9 AND ks_high + 1e-9 AS bounds_hold
           FROM (SELECT name, feature, n_ref, n_cur, max(low) AS ks_low, max(high) AS ks_high,
                        sum((greatest(ref / n_ref, 1e-4) - greatest(cur / n_cur, 1e-4))
                            * ln(greatest(ref / n_ref, 1e-4) / greatest(cur / n_cur, 1e-4))) AS psi
                 FROM (SELECT name, feature, n_ref, n_cur, bin, sum(ref) AS ref, sum(cur) AS cur,
                              max(abs(upto_ref / n_ref - upto_cur / n_cur)) AS low,
                              max(greatest(upto_ref / n_ref - (upto_cur - cur) / n_cur, upto_cur / n_cur - (upto_ref - ref) / n_ref)) AS high
                       FROM (SELECT *, least(9, floor((upto_ref - ref) * 10 / n_ref)) AS bin
                             FROM (SELECT name, feature, ref, cur, sum(ref) OVER upto AS upto_ref, sum(cur) OVER upto AS upto_cur,
                                          cast(sum(ref) OVER every AS bigint) AS n_ref, cast(sum(cur) OVER every AS bigint) AS n_cur
                                   FROM (SELECT name, feature,
                                                CASE WHEN value < 0 THEN -1 ELSE 1 END * floor(ln(1 + abs(value)) * 512 + 0.37e0) AS cell,
                                                count(*) FILTER (NOT here) AS ref, count(*) FILTER (here) AS cur
                                         FROM day_pairs GROUP BY ALL)
                                   WINDOW upto AS (PARTITION BY name, feature ORDER BY cell), every AS (PARTITION BY name, feature)))
                       GROUP BY ALL) GROUP BY ALL) c
           JOIN (SELECT name, feature, max(abs(cum_ref / n_ref - cum_cur / n_cur)) AS ks
                 FROM (SELECT name, feature, count(*) FILTER (NOT here) OVER upto AS cum_ref, count(*) FILTER (here) OVER upto AS cum_cur,
                              count(*) FILTER (NOT here) OVER every AS n_ref, count(*) FILTER (here) OVER every AS n_cur
                       FROM day_pairs
                       WINDOW upto AS (PARTITION BY name, feature ORDER BY value), every AS (PARTITION BY name, feature))
                 GROUP BY ALL) e USING (name, feature)
           WHERE c.n_ref > 0 AND c.n_cur > 0""", "day_pairs"),
    "site_correlations": sql(
        " UNION ALL ".join(
            f"""SELECT '{m}' AS measure, x.location AS a, y.location AS b, count(*) AS n, round(corr(x.{m}, y.{m}), 6) AS corr
                FROM merged x JOIN merged y ON x."timestamp" = y."timestamp" AND x.location < y.location GROUP BY ALL"""
            for m in DRIFT_FEATURES), "merged"),
    "correlations": sql(
        " UNION ALL ".join(
            f"""SELECT location, '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM merged GROUP BY location"""
            for i, a in enumerate(DRIFT_FEATURES) for b in DRIFT_FEATURES[i + 1:]), "merged"),
    "prediction_daily": sql(
        """SELECT location, cast("timestamp" AS date) AS date, count(*) AS predictions,
                  round(avg(prediction), 6) AS positive_rate, round(avg(score), 6) AS mean_score,
                  round(avg(CASE WHEN prediction <> health_risk THEN 1 ELSE 0 END), 6) AS error_rate
           FROM linear GROUP BY ALL""", "linear"),
}
