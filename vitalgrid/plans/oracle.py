"""SQL counterparts of the named queries, for a single-node engine on the same files."""

TABLES = {
    "base": """
        SELECT event_id, ts, user_id,
               cast(json_extract(props, '$.k') AS bigint) AS k,
               cast(round(value * 100) AS bigint) AS v,
               CASE user_id % 3 WHEN 0 THEN 'hospital_A' WHEN 1 THEN 'hospital_B' ELSE 'hospital_C' END AS location,
               date_trunc('hour', ts) AS "timestamp"
        FROM events""",
    "readings": """
        SELECT "timestamp", location, user_id, event_id, ts,
               55 + (v % 700) / 10.0e0 AS heart_rate,
               cast(v % 900 AS integer) AS steps,
               88 + ((v * 31 + k * 17) % 121) / 10.0e0 AS spo2,
               CASE WHEN hour("timestamp") >= 23 OR hour("timestamp") < 7 THEN 1 ELSE 0 END AS sleep_status,
               (CASE WHEN hour("timestamp") >= 23 OR hour("timestamp") < 7 THEN k ELSE 0 END) * 1e0 AS sleep_quality
        FROM base""",
    "wearable": """
        SELECT *, cast(sum(steps) OVER (PARTITION BY user_id, cast("timestamp" AS date)
                                        ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS bigint) AS cumulative_steps
        FROM readings""",
    "air_raw": """
        SELECT location, "timestamp", event_id, ts, (v % 26000) / 100.0e0 AS pm25, k * 3.5e0 + (v % 100) / 10.0e0 AS pm10,
               cast(400 + k * 6 AS double) AS co2
        FROM base""",
    "air_indexed": """
        SELECT *,
               CASE WHEN pm25 <= 12 THEN pm25 / 12e0 * 50
                    WHEN pm25 <= 35.4e0 THEN 50 + (pm25 - 12) / (35.4e0 - 12) * 50
                    WHEN pm25 <= 55.4e0 THEN 100 + (pm25 - 35.4e0) / (55.4e0 - 35.4e0) * 50
                    WHEN pm25 <= 150.4e0 THEN 150 + (pm25 - 55.4e0) / (150.4e0 - 55.4e0) * 100
                    ELSE 250 + (pm25 - 150.4e0) / (250.4e0 - 150.4e0) * 150 END AS i25,
               CASE WHEN pm10 <= 54 THEN pm10 / 54e0 * 50
                    WHEN pm10 <= 154 THEN 50 + (pm10 - 54) / 100e0 * 50
                    WHEN pm10 <= 254 THEN 100 + (pm10 - 154) / 100e0 * 50
                    WHEN pm10 <= 354 THEN 150 + (pm10 - 254) / 100e0 * 100
                    ELSE 250 + (pm10 - 354) / 70e0 * 150 END AS i10
        FROM air_raw""",
    "air_all": """
        SELECT location, "timestamp", event_id, ts, pm25, pm10,
               least(500e0, greatest(0e0, greatest(i25, i10))) AS aqi, co2
        FROM air_indexed""",
    "air": """
        SELECT location, "timestamp", pm25, pm10, aqi, co2 FROM air_all
        QUALIFY row_number() OVER (PARTITION BY location, "timestamp" ORDER BY event_id) = 1""",
    "weather_all": """
        SELECT location, "timestamp", event_id, ts,
               -2 + ((event_id * 37) % 430) / 10.0e0 AS temperature,
               20 + ((event_id * 53) % 801) / 10.0e0 AS humidity,
               (event_id * 29 % 500) / 10.0e0 AS wind_speed,
               980 + (event_id * 13 % 701) / 10.0e0 AS pressure,
               CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS precipitation,
               CASE WHEN event_id % 5 = 0 THEN (k % 50) / 2.0e0 ELSE 0e0 END AS rainfall
        FROM base""",
    "weather": """
        SELECT * EXCLUDE (event_id, ts) FROM weather_all
        QUALIFY row_number() OVER (PARTITION BY location, "timestamp" ORDER BY event_id DESC) = 1""",
    "vitals": """
        SELECT location, "timestamp",
               round(avg(heart_rate), 9) AS heart_rate_mean,
               round(stddev_samp(heart_rate), 9) AS heart_rate_std,
               max(heart_rate) AS heart_rate_max,
               cast(coalesce(sum(steps), 0) AS bigint) AS steps_total,
               max(cumulative_steps) AS cumulative_steps_max,
               round(avg(spo2), 9) AS spo2_mean,
               min(spo2) AS spo2_min,
               cast(coalesce(sum(sleep_status), 0) AS bigint) AS sleeping_users_count,
               round(avg(sleep_quality), 9) AS sleep_quality_mean,
               count(user_id) AS active_users_count
        FROM wearable GROUP BY location, "timestamp" """,
    "joined": """
        SELECT * FROM vitals JOIN air USING (location, "timestamp") JOIN weather USING (location, "timestamp")""",
    "merged": """
        SELECT *,
               cast(hour("timestamp") AS integer) AS hour,
               cast(isodow("timestamp") - 1 AS integer) AS day_of_week,
               cast(month("timestamp") AS integer) AS month,
               CASE WHEN isodow("timestamp") >= 6 THEN 1 ELSE 0 END AS is_weekend,
               CASE WHEN aqi <= 0 THEN NULL WHEN aqi <= 50 THEN 'Good' WHEN aqi <= 100 THEN 'Moderate'
                    WHEN aqi <= 150 THEN 'Sensitive' WHEN aqi <= 200 THEN 'Unhealthy'
                    WHEN aqi <= 300 THEN 'Very_Unhealthy' WHEN aqi <= 500 THEN 'Hazardous' END AS aqi_category,
               CASE WHEN temperature <= -999 THEN NULL WHEN temperature <= 10 THEN 'Cold'
                    WHEN temperature <= 20 THEN 'Mild' WHEN temperature <= 30 THEN 'Warm'
                    WHEN temperature <= 999 THEN 'Hot' END AS temp_category,
               CASE WHEN heart_rate_mean > 90 THEN 1 ELSE 0 END AS high_heart_rate,
               CASE WHEN spo2_mean < 95 THEN 1 ELSE 0 END AS low_spo2,
               CASE WHEN aqi > 100 THEN 1 ELSE 0 END AS high_pollution
        FROM joined""",
    "components": """
        SELECT *,
               CASE WHEN aqi > 150 THEN 0.8e0 WHEN aqi > 100 THEN 0.5e0 WHEN aqi > 50 THEN 0.2e0 ELSE 0e0 END AS aqi_risk,
               CASE WHEN heart_rate_mean > 110 THEN 0.9e0
                    ELSE least(1e0, greatest(0e0, (heart_rate_mean - 60) / 50e0)) * 0.6e0 END AS heart_rate_risk,
               CASE WHEN spo2_mean < 90 THEN 1e0 WHEN spo2_mean < 94 THEN 0.7e0
                    WHEN spo2_mean < 96 THEN 0.35e0 ELSE 0e0 END AS spo2_risk,
               CASE WHEN pm25 > 55 THEN 0.7e0 WHEN pm25 > 35 THEN 0.4e0 WHEN pm25 > 12 THEN 0.15e0 ELSE 0e0 END AS pm25_risk,
               least(1e0, greatest(0e0,
                   (CASE WHEN temperature > 35 OR temperature < 5 THEN 0.3e0
                         WHEN temperature > 30 OR temperature < 10 THEN 0.15e0 ELSE 0e0 END)
                 + (CASE WHEN humidity > 85 THEN 0.2e0 WHEN humidity < 30 THEN 0.1e0 ELSE 0e0 END))) AS weather_risk,
               least(1e0, greatest(0e0,
                   (CASE WHEN aqi > 100 THEN 1 ELSE 0 END) * 0.3e0
                 + (CASE WHEN heart_rate_mean > 90 THEN 1 ELSE 0 END) * 0.2e0
                 + (CASE WHEN spo2_mean < 95 THEN 1 ELSE 0 END) * 0.3e0)) AS combined_risk
        FROM merged""",
    "scored": """
        SELECT *, round(least(1e0, greatest(0e0,
                   0.25e0 * aqi_risk + 0.15e0 * heart_rate_risk + 0.20e0 * spo2_risk
                 + 0.15e0 * pm25_risk + 0.10e0 * weather_risk + 0.15e0 * combined_risk)), 9) AS risk_score
        FROM components""",
    "limits": """
        SELECT location, quantile_cont(risk_score, 0.7e0) AS threshold FROM scored GROUP BY location""",
    "labeled": """
        SELECT scored.*, CASE WHEN risk_score >= threshold THEN 1 ELSE 0 END AS health_risk,
               CASE WHEN risk_score >= threshold THEN 'High' ELSE 'Low' END AS risk_category
        FROM scored JOIN limits USING (location)""",
    "labeled_all": """
        SELECT scored.*, CASE WHEN risk_score >= threshold THEN 1 ELSE 0 END AS health_risk,
               CASE WHEN risk_score >= threshold THEN 'High' ELSE 'Low' END AS risk_category
        FROM scored, (SELECT quantile_cont(risk_score, 0.7e0) AS threshold FROM scored)""",
    "latest": """
        SELECT * FROM labeled QUALIFY row_number() OVER (PARTITION BY location ORDER BY "timestamp" DESC) = 1""",
    "recent": """
        SELECT location, avg(health_risk) AS rate
        FROM labeled JOIN (SELECT location, max("timestamp") AS last_ts FROM labeled GROUP BY location) USING (location)
        WHERE "timestamp" >= last_ts - INTERVAL 24 HOURS GROUP BY location""",
    "environment_alerts": """
        SELECT location, "timestamp", 2 AS rule, aqi AS value, 'air_quality' AS type,
               CASE WHEN aqi > 200 THEN 'high' ELSE 'medium' END AS severity,
               concat('Air quality index at ', cast(floor(aqi) AS bigint)) AS message FROM merged WHERE aqi > 150
        UNION ALL
        SELECT location, "timestamp", 3, pm25, 'pm25', CASE WHEN pm25 > 75 THEN 'high' ELSE 'medium' END,
               concat('Fine particles at ', cast(floor(pm25) AS bigint)) FROM merged WHERE pm25 > 50
        UNION ALL
        SELECT location, "timestamp", CASE WHEN temperature > 35 THEN 4 ELSE 5 END, temperature, 'temperature', 'medium',
               concat(CASE WHEN temperature > 35 THEN 'Heat: ' ELSE 'Cold: ' END, cast(floor(temperature) AS bigint),
                      ' degrees') FROM merged WHERE temperature > 35 OR temperature < 5""",
    "alert_rows": """
        SELECT location, "timestamp", 1 AS rule, rate AS value, 'high_risk' AS type,
               CASE WHEN rate > 0.5e0 THEN 'high' ELSE 'medium' END AS severity,
               concat('High-risk hours of the last day: ', cast(floor(rate * 100) AS bigint), ' percent') AS message
        FROM latest JOIN recent USING (location) WHERE rate > 0.3e0
        UNION ALL
        SELECT location, "timestamp", rule, value, type, severity, message FROM environment_alerts
        JOIN (SELECT location, "timestamp" FROM latest) USING (location, "timestamp")""",
    "linear": """
        SELECT *, CASE WHEN score >= 0.5e0 THEN 1 ELSE 0 END AS prediction
        FROM (SELECT *, round(least(1e0, greatest(0e0,
                  0.002e0 * aqi + 0.01e0 * (heart_rate_mean - 60e0) + 0.02e0 * (96e0 - spo2_mean))), 9) AS score
              FROM labeled)""",
    "confusion": """
        SELECT location,
               count(*) FILTER (health_risk = 1 AND prediction = 1) AS tp,
               count(*) FILTER (health_risk = 0 AND prediction = 1) AS fp,
               count(*) FILTER (health_risk = 1 AND prediction = 0) AS fn,
               count(*) FILTER (health_risk = 0 AND prediction = 0) AS tn
        FROM linear GROUP BY location""",
    "ranked": """
        SELECT location, health_risk,
               rank() OVER (PARTITION BY location ORDER BY score)
               + (count(*) OVER (PARTITION BY location, score) - 1) / 2e0 AS mid_rank
        FROM linear""",
    "area": """
        SELECT location, CASE WHEN p = 0 OR q = 0 THEN 0e0 ELSE (r - p * (p + 1) / 2e0) / (p * q) END AS roc_auc
        FROM (SELECT location, cast(count(*) FILTER (health_risk = 1) AS double) AS p,
                     cast(count(*) FILTER (health_risk = 0) AS double) AS q,
                     coalesce(sum(mid_rank) FILTER (health_risk = 1), 0) AS r
              FROM ranked GROUP BY location)""",
    "node_metrics": """
        SELECT location, tp + fp + fn + tn AS n,
               (tp + tn) / cast(tp + fp + fn + tn AS double) AS accuracy,
               CASE WHEN tp + fp = 0 THEN 0e0 ELSE tp / cast(tp + fp AS double) END AS "precision",
               CASE WHEN tp + fn = 0 THEN 0e0 ELSE tp / cast(tp + fn AS double) END AS recall,
               CASE WHEN 2 * tp + fp + fn = 0 THEN 0e0 ELSE 2 * tp / cast(2 * tp + fp + fn AS double) END AS f1,
               roc_auc
        FROM confusion JOIN area USING (location)""",
}

ORDER = list(TABLES)


def sql(body: str, *tables: str) -> str:
    """`body` after the common tables it needs, with those they need themselves."""
    needed, queue = set(), list(tables)
    while queue:
        name = queue.pop()
        if name not in needed:
            needed.add(name)
            words = set(TABLES[name].replace(",", " ").replace("(", " ").replace(")", " ").split())
            queue.extend(t for t in ORDER if t in words)
    parts = ",\n".join(f"{name} AS ({TABLES[name]})" for name in ORDER if name in needed)
    return f"WITH {parts}\n{body}"


MERGED = """ "timestamp", heart_rate_mean, heart_rate_std, heart_rate_max, steps_total, cumulative_steps_max,
    spo2_mean, spo2_min, sleeping_users_count, sleep_quality_mean, active_users_count, pm25, pm10, aqi, co2,
    temperature, humidity, wind_speed, pressure, precipitation, rainfall, location, hour, day_of_week, month,
    is_weekend, aqi_category, temp_category, high_heart_rate, low_spo2, high_pollution"""

SUMMARY = """
    SELECT location AS node_name, count(*) AS total_records, min("timestamp") AS date_from, max("timestamp") AS date_to,
           round(sum(health_risk) / count(*) * 100, 6) AS high_risk_percentage,
           round(avg(aqi), 6) AS avg_aqi, round(avg(pm25), 6) AS avg_pm25,
           round(avg(temperature), 6) AS avg_temperature, round(avg(heart_rate_mean), 6) AS avg_heart_rate
    FROM {table} {where} GROUP BY location"""

TRENDS = """
    SELECT {by} cast("timestamp" AS date) AS date, cast(sum(health_risk) AS bigint) AS high_risk_count,
           count(health_risk) AS total_count, round(avg(health_risk) * 100, 6) AS risk_percentage,
           round(avg(aqi), 6) AS avg_aqi, round(avg(pm25), 6) AS avg_pm25,
           round(avg(temperature), 6) AS avg_temperature, round(avg(heart_rate_mean), 6) AS avg_heart_rate
    FROM {table} GROUP BY ALL"""

NUMERIC = [
    "heart_rate_mean", "heart_rate_std", "heart_rate_max", "steps_total", "cumulative_steps_max", "spo2_mean",
    "spo2_min", "sleeping_users_count", "sleep_quality_mean", "active_users_count", "pm25", "pm10", "aqi", "co2",
    "temperature", "humidity", "wind_speed", "pressure", "precipitation", "rainfall", "hour", "day_of_week", "month",
    "is_weekend", "high_heart_rate", "low_spo2", "high_pollution",
]
INDICATORS = [f"aqi_category_{c}" for c in
              ("Good", "Moderate", "Sensitive", "Unhealthy", "Very_Unhealthy", "Hazardous")]
INDICATORS += [f"temp_category_{c}" for c in ("Cold", "Mild", "Warm", "Hot")]


def _indicator(name: str) -> str:
    for column in ("aqi_category", "temp_category"):
        if name.startswith(column + "_"):
            return f"CASE WHEN {column} = '{name[len(column) + 1:]}' THEN 1 ELSE 0 END"
    return name


FEATURES = sorted(NUMERIC + INDICATORS)
FEATURE_LIST = ", ".join(f"coalesce(cast({_indicator(n)} AS double), 0e0) AS {n}" for n in FEATURES)
TABLES["features"] = f"""
        SELECT location, "timestamp", health_risk, {FEATURE_LIST} FROM labeled"""
TABLES["scales"] = "SELECT location, count(*) AS n, " + ", ".join(
    f"avg({n}) AS mean_{n}, CASE WHEN round(stddev_pop({n}), 9) = 0 THEN 1e0 ELSE stddev_pop({n}) END AS scale_{n}"
    for n in FEATURES) + " FROM features GROUP BY location"
TABLES["split"] = """
        SELECT *, row_number() OVER (PARTITION BY location, health_risk
                      ORDER BY md5(concat_ws('|', location, cast("timestamp" AS varchar), '42')))
                  <= ceil(0.2e0 * count(*) OVER (PARTITION BY location, health_risk)) AS is_test
        FROM labeled"""
TABLES["split_by_label"] = TABLES["split"].replace("PARTITION BY location, health_risk", "PARTITION BY health_risk")
TABLES["training"] = """
        SELECT features.* FROM features JOIN split USING (location, "timestamp") WHERE NOT is_test"""
TABLES["training_scales"] = TABLES["scales"].replace("FROM features", "FROM training")
TABLES["scaled_long"] = f"""
        SELECT location, "timestamp", health_risk, feature, round(value, 9) AS value
        FROM (UNPIVOT (SELECT location, "timestamp", health_risk, {", ".join(f"({n} - mean_{n}) / scale_{n} AS {n}" for n in FEATURES)}
                       FROM features JOIN scales USING (location))
              ON {", ".join(FEATURES)} INTO NAME feature VALUE value)"""
TABLES["tree_edges"] = """
        SELECT location, feature, edge
        FROM (SELECT *, sum(n) OVER (PARTITION BY location, feature ORDER BY cell) AS upto,
                     sum(n) OVER (PARTITION BY location, feature) AS whole
              FROM (SELECT location, feature, count(*) AS n, max(value) AS edge,
                           CASE WHEN value < 0 THEN -1 ELSE 1 END * floor(ln(1 + abs(value)) * 64 + 0.37e0) AS cell
                    FROM scaled_long GROUP BY location, feature, cell))
        WHERE floor(upto * 32 / whole) > floor((upto - n) * 32 / whole) AND upto < whole"""


def _gini(n: str, p: str) -> str:
    return f"2 * ({p} / {n}) * (1 - {p} / {n})"


def _splits(rows: str, node: str) -> str:
    """The best split of every node of the rows: first by gain, then by feature and edge."""
    right = _gini("(n - left_n)", "(positives - left_positives)")
    return f"""
        SELECT * FROM (
            SELECT *, round({_gini("n", "positives")} - (left_n * {_gini("left_n", "left_positives")}
                            + (n - left_n) * {right}) / n, 12) AS gain
            FROM (SELECT location, {node} AS node, feature, edge, count(*) AS n, cast(sum(health_risk) AS bigint) AS positives,
                         count(*) FILTER (value <= edge) AS left_n,
                         cast(sum(CASE WHEN value <= edge THEN health_risk ELSE 0 END) AS bigint) AS left_positives
                  FROM {rows} JOIN tree_edges USING (location, feature) GROUP BY ALL)
            WHERE left_n > 0 AND left_n < n)
        WHERE gain > 1e-12
        QUALIFY row_number() OVER (PARTITION BY location, node ORDER BY gain DESC, feature, edge) = 1"""


TABLES["root_splits"] = _splits("scaled_long", "cast(1 AS bigint)")
TABLES["tree_children"] = """
        SELECT s.*, CASE WHEN side.value <= root_splits.edge THEN cast(2 AS bigint) ELSE 3 END AS child
        FROM root_splits JOIN scaled_long AS side USING (location, feature)
        JOIN scaled_long AS s ON s.location = side.location AND s."timestamp" = side."timestamp" """
TABLES["tree_splits"] = "SELECT * FROM root_splits UNION ALL " + _splits("tree_children", "child")
DRIFT_FEATURES = ["heart_rate_mean", "spo2_mean", "steps_total", "pm25", "aqi", "temperature", "humidity"]
TABLES["long_rows"] = f"""
        SELECT feature, round(value, 9) AS value, "timestamp" >= TIMESTAMP '2024-01-16' AS is_current,
               cast("timestamp" AS date) AS date
        FROM (UNPIVOT (SELECT "timestamp", {", ".join(f"cast({n} AS double) AS {n}" for n in DRIFT_FEATURES)}
                       FROM merged)
              ON {", ".join(DRIFT_FEATURES)} INTO NAME feature VALUE value)"""
TABLES["edges"] = f"""
        SELECT feature, quantile_cont(value, [{", ".join(f"{i / 10}e0" for i in range(1, 10))}]) AS edges
        FROM long_rows WHERE NOT is_current GROUP BY feature"""
TABLES["binned"] = """
        SELECT feature, is_current, len(list_filter(edges, lambda e: value > e)) AS bin
        FROM long_rows JOIN edges USING (feature)"""
TABLES["shares"] = """
        SELECT feature, greatest(ref / sum(ref) OVER (PARTITION BY feature), 1e-4) AS p,
               greatest(cur / sum(cur) OVER (PARTITION BY feature), 1e-4) AS q
        FROM (SELECT feature, bin, count(*) FILTER (NOT is_current) AS ref, count(*) FILTER (is_current) AS cur
              FROM binned GROUP BY feature, bin)"""
TABLES["psi"] = "SELECT feature, sum((p - q) * ln(p / q)) AS psi FROM shares GROUP BY feature"
TABLES["day_pairs"] = """
        SELECT name, feature, value, date = day AS here
        FROM long_rows JOIN (SELECT cast(day AS varchar) AS name, day
              FROM (SELECT cast(unnest(generate_series(DATE '2024-01-08', DATE '2024-01-30', INTERVAL 1 DAY)) AS date) AS day))
        ON date BETWEEN day - 7 AND day"""
TABLES["passed_hours"] = """
        SELECT * FROM merged WHERE "timestamp" < (SELECT max("timestamp") FROM merged) - INTERVAL 2 HOURS"""
TABLES["alert_hours"] = """
        SELECT location, "timestamp", 'air_quality' AS type, CASE WHEN aqi > 150 THEN aqi END AS value FROM passed_hours
        UNION ALL SELECT location, "timestamp", 'pm25', CASE WHEN pm25 > 50 THEN pm25 END FROM passed_hours
        UNION ALL SELECT location, "timestamp", 'temperature', CASE WHEN temperature > 35 OR temperature < 5 THEN temperature END
        FROM passed_hours"""
TABLES["episode_hours"] = """
        SELECT * FROM (
            SELECT *, sum(first::int) OVER (PARTITION BY location, type ORDER BY "timestamp") AS episode
            FROM (SELECT *, next > "timestamp" + INTERVAL 6 HOURS AS silent,
                         value IS NOT NULL AND (before IS NULL OR last < "timestamp" - INTERVAL 6 HOURS) AS first
                  FROM (SELECT *, lag(value) OVER w AS before, lag("timestamp") OVER w AS last, lead("timestamp") OVER w AS next
                        FROM alert_hours WINDOW w AS (PARTITION BY location, type ORDER BY "timestamp"))))
        WHERE value IS NOT NULL"""
ORDER = list(TABLES)


def queries() -> dict[str, str]:
    from .oracle_queries import QUERIES

    return dict(QUERIES)
