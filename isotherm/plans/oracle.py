"""DuckDB SQL for the registered queries, written from the definitions, not from the operators.

Where an operator uses a rewrite (blocks of series, a RANGE frame, running totals) the SQL takes
the plain form: join on time, self join, one global window.
"""

from __future__ import annotations

VARIABLES = (
    "temperature_2m_max",
    "temperature_2m_min",
    "temperature_2m_mean",
    "dew_point_2m_mean",
    "precipitation_sum",
    "wind_speed_10m_max",
    "shortwave_radiation_sum",
)


def _r(expression: str, name: str | None = None) -> str:
    """Six decimals, no negative zero."""
    return f"round({expression}, 6) + 0.0 AS {name or expression.split('.')[-1]}"


def _each(columns: str) -> str:
    return ", ".join(_r(c) for c in columns.split())


CITY = """city AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS country_code
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

DAILY = f"""{CITY},
daily AS (
  SELECT city_id, city_name, country_code, lower(replace(trim(city_name), ' ', '_')) AS city_slug,
         CAST(year(o_orderdate) AS BIGINT) AS year, CAST(o_orderdate AS DATE) AS date,
         max(o_totalprice) / CAST(9999.991 AS DOUBLE) AS temperature_2m_max,
         min(o_totalprice) / CAST(9999.991 AS DOUBLE) AS temperature_2m_min,
         avg(o_totalprice) / CAST(9999.991 AS DOUBLE) AS temperature_2m_mean,
         avg(o_totalprice) / CAST(19999.999 AS DOUBLE) AS dew_point_2m_mean,
         count(*) * CAST(2.5 AS DOUBLE) AS precipitation_sum,
         max(c_acctbal) / CAST(999.983 AS DOUBLE) AS wind_speed_10m_max,
         avg(c_acctbal) / CAST(999.983 AS DOUBLE) AS shortwave_radiation_sum
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN city ON c_nationkey = city_id
  GROUP BY ALL)"""

CLEANING = """clean AS (
  SELECT city_id, city_name, country_code, date,
         temperature_2m_max AS tmax_c, temperature_2m_min AS tmin_c, temperature_2m_mean AS tmean_c,
         dew_point_2m_mean AS dewpoint_c, precipitation_sum AS precip_mm,
         wind_speed_10m_max AS wind_max_ms, shortwave_radiation_sum AS sw_radiation,
         year, CAST(month(date) AS BIGINT) AS month, CAST(dayofyear(date) AS BIGINT) AS day_of_year,
         CAST(coalesce(month(date) IN (6, 7, 8), false) AS INTEGER) AS is_summer,
         CAST(coalesce(temperature_2m_max >= 30, false) AS INTEGER) AS is_heat_day,
         CAST(coalesce(temperature_2m_min >= 20, false) AS INTEGER) AS is_tropical_night,
         CAST(coalesce(precipitation_sum >= 10, false) AS INTEGER) AS is_heavy_precip_day
  FROM daily)"""

CLEAN = f"{DAILY},\n{CLEANING}"

MONTHS = """monthly AS (
  SELECT city_id, city_name, country_code, year, month, count(*) AS days_in_month,
         avg(tmax_c) AS avg_tmax_c, avg(tmin_c) AS avg_tmin_c, avg(tmean_c) AS avg_tmean_c,
         avg(dewpoint_c) AS avg_dewpoint_c, avg(wind_max_ms) AS avg_wind_max_ms,
         avg(sw_radiation) AS avg_sw_radiation, sum(precip_mm) AS total_precip_mm,
         CAST(sum(is_heat_day) AS BIGINT) AS heat_day_count,
         CAST(sum(is_tropical_night) AS BIGINT) AS tropical_night_count,
         CAST(sum(is_heavy_precip_day) AS BIGINT) AS heavy_precip_day_count,
         CAST(sum(is_summer) AS BIGINT) AS summer_day_count
  FROM clean GROUP BY ALL)"""

MONTHLY = f"{CLEAN},\n{MONTHS}"

CLIMATE = f"""{MONTHLY},
climate AS (
  SELECT city_id, city_name, country_code, month,
         avg(avg_tmean_c) AS climatology_tmean_c, avg(avg_tmax_c) AS climatology_tmax_c,
         avg(avg_tmin_c) AS climatology_tmin_c, avg(total_precip_mm) AS climatology_total_precip_mm,
         stddev_samp(avg_tmean_c) AS climatology_tmean_std_c,
         stddev_samp(total_precip_mm) AS climatology_total_precip_std_mm
  FROM monthly WHERE year BETWEEN 1996 AND 1999 GROUP BY ALL)"""

ANOMALY = f"""{CLIMATE},
anomaly AS (
  SELECT m.city_id, m.city_name, m.country_code, m.year, m.month,
         strftime(make_date(2000, m.month, 1), '%B') AS month_name,
         ['DJF', 'MAM', 'JJA', 'SON'][CAST((m.month % 12) // 3 + 1 AS INTEGER)] AS season,
         m.avg_tmean_c, m.avg_tmax_c, m.avg_tmin_c, m.total_precip_mm,
         climatology_tmean_c, climatology_tmax_c, climatology_tmin_c, climatology_total_precip_mm,
         climatology_tmean_std_c, climatology_total_precip_std_mm,
         m.avg_tmean_c - climatology_tmean_c AS anomaly_tmean_c,
         m.avg_tmax_c - climatology_tmax_c AS anomaly_tmax_c,
         m.avg_tmin_c - climatology_tmin_c AS anomaly_tmin_c,
         m.total_precip_mm - climatology_total_precip_mm AS anomaly_total_precip_mm,
         (m.avg_tmean_c - climatology_tmean_c)
           / CASE WHEN climatology_tmean_std_c > 0 THEN climatology_tmean_std_c END AS zscore_tmean,
         (m.total_precip_mm - climatology_total_precip_mm)
           / CASE WHEN climatology_total_precip_std_mm > 0 THEN climatology_total_precip_std_mm END
           AS zscore_total_precip,
         coalesce(anomaly_tmean_c >= 1, false) AS is_positive_temp_anomaly,
         coalesce(anomaly_tmean_c <= -1, false) AS is_negative_temp_anomaly,
         coalesce(zscore_tmean >= 2, false) AS is_strong_positive_temp_anomaly,
         coalesce(zscore_tmean <= -2, false) AS is_strong_negative_temp_anomaly
  FROM monthly m LEFT JOIN climate c ON m.city_id = c.city_id AND m.month = c.month)"""

LAGS = f"""{ANOMALY},
points AS (SELECT city_id, city_name, year * 12 + month AS t, anomaly_tmean_c AS x FROM anomaly),
lags AS (
  SELECT a.city_id, a.city_name, b.city_id AS other_city_id, b.city_name AS other_city_name,
         CAST(b.t - a.t AS BIGINT) AS lag_months, count(*) AS n_observations,
         corr(a.x, b.x) AS r_raw,
         CASE WHEN isnan(r_raw) OR count(a.x + b.x) < 2 THEN NULL ELSE r_raw END AS r
  FROM points a JOIN points b ON a.city_id <> b.city_id AND b.t BETWEEN a.t - 6 AND a.t + 6
  GROUP BY ALL)"""

BEST = f"""{LAGS},
ranked AS (
  SELECT city_id, abs(r) AS strength, lag_months,
         row_number() OVER (PARTITION BY city_id
           ORDER BY round(abs(r), 9) DESC NULLS LAST, abs(lag_months), lag_months) AS place
  FROM lags),
links AS (
  SELECT city_id, max(strength) AS max_lagged_corr,
         max(CASE WHEN place = 1 AND strength IS NOT NULL THEN lag_months END) AS lead_lag_months
  FROM ranked GROUP BY city_id)"""

FLEET = """monthly AS (
  SELECT l_suppkey AS city_id, s_name AS city_name, 'N' || s_nationkey AS country_code,
         CAST(year(l_shipdate) AS BIGINT) AS year, CAST(month(l_shipdate) AS BIGINT) AS month,
         avg(l_extendedprice) / CAST(9999.991 AS DOUBLE) AS avg_tmean_c,
         max(l_extendedprice) / CAST(9999.991 AS DOUBLE) AS avg_tmax_c,
         min(l_extendedprice) / CAST(9999.991 AS DOUBLE) AS avg_tmin_c,
         sum(l_quantity) / CAST(999.983 AS DOUBLE) AS total_precip_mm
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)"""

# The same steps over the months of the fleet.
FLEET_LAGS, FLEET_BEST = LAGS.replace(MONTHLY, FLEET), BEST.replace(MONTHLY, FLEET)

# A station follows its region's mean, some months late.
REGIONAL = FLEET.replace("monthly AS", "own AS") + """,
regions AS (SELECT city_id % 5 AS region, year * 12 + month AS t, avg(avg_tmean_c) AS regional FROM own GROUP BY ALL),
monthly AS (
  SELECT o.* REPLACE (0.98::DOUBLE * regional + 0.02::DOUBLE * avg_tmean_c AS avg_tmean_c)
  FROM own o JOIN regions r ON o.city_id % 5 = r.region AND r.t = o.year * 12 + o.month - o.city_id // 5 % 4)"""
REGIONAL_LAGS, REGIONAL_BEST = LAGS.replace(MONTHLY, REGIONAL), BEST.replace(MONTHLY, REGIONAL)

NEIGHBOURS = """near AS (
  SELECT s_suppkey AS a, unnest([lead(s_suppkey, 1) OVER w, lead(s_suppkey, 2) OVER w]) AS b
  FROM supplier WINDOW w AS (PARTITION BY s_nationkey % 5 ORDER BY s_suppkey)),
pairs AS (SELECT a AS city_id, b AS other_city_id FROM near WHERE b IS NOT NULL
          UNION SELECT b, a FROM near WHERE b IS NOT NULL)"""

ROLLED = """rolled AS (
  SELECT city_id, city_name, year, month, year * 12 + month AS time_index, anomaly_tmean_c,
         is_strong_positive_temp_anomaly OR is_strong_negative_temp_anomaly AS strong,
         avg(anomaly_tmean_c) OVER three AS roll_mean_3, avg(anomaly_tmean_c) OVER six AS roll_mean_6,
         stddev_samp(anomaly_tmean_c) OVER three AS roll_std_3,
         stddev_samp(anomaly_tmean_c) OVER six AS roll_std_6,
         anomaly_tmean_c - lag(anomaly_tmean_c, 1) OVER rows_so_far AS delta_1m,
         anomaly_tmean_c - lag(anomaly_tmean_c, 3) OVER rows_so_far AS delta_3m
  FROM anomaly
  WINDOW rows_so_far AS (PARTITION BY city_id ORDER BY year, month),
         three AS (PARTITION BY city_id ORDER BY year, month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
         six AS (PARTITION BY city_id ORDER BY year, month ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)),
labelled AS (
  SELECT now.*, CAST(coalesce(following.strong, false) AS INTEGER) AS is_event_next_month
  FROM rolled now LEFT JOIN rolled following
    ON following.city_id = now.city_id AND following.time_index = now.time_index + 1)"""

FEATURES = f"""{BEST}, {ROLLED},
features AS (
  SELECT city_id, city_name, year, month, sin(2 * pi() * month / 12) AS sin_month,
         cos(2 * pi() * month / 12) AS cos_month, anomaly_tmean_c, roll_mean_3, roll_mean_6,
         roll_std_3, roll_std_6, delta_1m, delta_3m, max_lagged_corr, lead_lag_months,
         is_event_next_month
  FROM labelled LEFT JOIN links USING (city_id)
  WHERE anomaly_tmean_c + roll_mean_3 + roll_mean_6 + roll_std_3 + roll_std_6 + delta_1m + delta_3m
        + max_lagged_corr + lead_lag_months IS NOT NULL)"""

RUNS = """runs AS (
  SELECT event_id AS id, 'flow_' || (user_id % 2) AS flow_name, event_type AS run_mode,
         CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_type = 'error' THEN 'failed'
              ELSE 'success' END AS status,
         ts AS started_at, ts + to_minutes(user_id % 60) AS finished_at,
         CAST(floor(value * 10) AS BIGINT) AS rows_bronze, user_id AS rows_gold_ml,
         CAST(floor(value) AS BIGINT) AS rows_bronze_delta, user_id % 7 AS rows_gold_ml_delta,
         CAST(ts AS DATE) AS bronze_max_date, CAST(date_trunc('month', ts) AS DATE) AS gold_ml_max_date,
         ['fresh', 'stale', 'very_stale'][CAST(user_id % 3 + 1 AS INTEGER)] AS freshness_status
  FROM events)"""

RUN_DAYS = f"""{RUNS},
run_days AS (
  SELECT CAST(date_trunc('day', started_at) AS TIMESTAMP) AS run_date, flow_name, run_mode,
         count(*) AS n_runs, count(*) FILTER (status = 'success') AS runs_success,
         count(*) FILTER (status <> 'success') AS runs_failed, max(started_at) AS last_run_at,
         max(rows_bronze) AS rows_bronze_max, max(rows_gold_ml) AS rows_gold_ml_max,
         max(rows_bronze_delta) AS rows_bronze_delta_max,
         max(rows_gold_ml_delta) AS rows_gold_ml_delta_max
  FROM runs GROUP BY ALL)"""

METRICS = """metrics AS (
  SELECT ts AS created_at, event_type AS run_mode, CAST(floor(value * 100) AS BIGINT) AS train_size,
         1.0::DOUBLE / (value + 20) AS positive_class_ratio, value / (value + 10) AS accuracy,
         CASE WHEN user_id % 10 <> 0 THEN value / (value + 15) END AS roc_auc,
         value / (value + 31) AS precision_1, value / (value + 32) AS recall_1,
         value / (value + 33) AS f1_1
  FROM events)"""

ML_DAYS = f"""{METRICS},
ml_days AS (
  SELECT CAST(created_at AS DATE) AS run_date, run_mode, count(*) AS n_runs,
         max(created_at) AS last_run_at, max(train_size) AS last_n_train,
         avg(accuracy) AS avg_accuracy, avg(roc_auc) AS avg_roc_auc,
         avg(precision_1) AS avg_precision_pos, avg(recall_1) AS avg_recall_pos,
         avg(f1_1) AS avg_f1_pos
  FROM metrics GROUP BY ALL)"""
ML_DAY_KEYS = "run_date, run_mode, n_runs, last_run_at, last_n_train"

SCORED = """scored AS (
  SELECT event_id, CAST(user_id % 10 = 0 AS BIGINT) AS label, CAST(value >= 25 AS BIGINT) AS called,
         value AS score
  FROM events)"""

REPORT = f"""{SCORED},
classes AS (
  SELECT class, count(*) FILTER (label = class) AS support,
         count(*) FILTER (called = class) AS n_called,
         count(*) FILTER (label = class AND called = class) AS hits
  FROM scored, (SELECT DISTINCT unnest([label, called]) AS class FROM scored)
  GROUP BY class),
per_class AS (
  SELECT class, support, hits,
         CASE WHEN n_called > 0 THEN hits / n_called ELSE 0.0 END AS precision,
         CASE WHEN support > 0 THEN hits / support ELSE 0.0 END AS recall,
         CASE WHEN hits > 0 THEN 2.0 * hits / (n_called + support) ELSE 0.0 END AS f1
  FROM classes),
report AS (
  SELECT CAST(class AS VARCHAR) AS class, precision, recall, f1, support FROM per_class
  UNION ALL
  SELECT 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support), sum(hits) / sum(support),
         CAST(sum(support) AS BIGINT) FROM per_class
  UNION ALL
  SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM per_class
  UNION ALL
  SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
         sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per_class)"""

AUC = """auc AS (
  SELECT CASE WHEN p > 0 AND n > 0 THEN (rank_sum - p * (p + 1) / 2) / (p * n) END AS roc_auc,
         CAST(p AS BIGINT) AS n_positive, CAST(n AS BIGINT) AS n_negative
  FROM (SELECT sum(label) AS p, sum(1 - label) AS n,
               sum(label * (low + (same - 1) / 2)) AS rank_sum
        FROM (SELECT label, rank() OVER (ORDER BY score) AS low,
                     count(*) OVER (PARTITION BY score) AS same FROM scored)))"""

ATTEMPTS = """attempts AS (
  SELECT 'CITY_' || user_id AS city_name, event_type <> 'error' AS succeeded FROM events)"""

FAULTY = f"""{DAILY},
docs AS (
  SELECT city_id, city_slug, year, list(struct_pack(date := date, {", ".join(f"{v} := {v}" for v in VARIABLES)}) ORDER BY date) AS days
  FROM daily GROUP BY ALL),
faults AS (
  SELECT *, CASE WHEN city_id % 7 = 6 THEN 'none' WHEN city_id % 5 = 1 THEN 'rain'
                 WHEN city_id % 5 = 2 THEN 'wind'
                 WHEN city_id % 5 = 3 AND year % 2 = 0 THEN 'time' ELSE '' END AS fault
  FROM docs)"""

HEALTH = f"""{DAILY},
report AS (
  SELECT d.city_id, c.city_name, c.country_code, min(date) AS first_date, max(date) AS last_date,
         count(*) AS n_days,
         CASE WHEN DATE '2001-08-04' - max(date) <= 1 THEN 'fresh'
              WHEN DATE '2001-08-04' - max(date) <= 7 THEN 'stale' ELSE 'very_stale' END
           AS freshness_status
  FROM daily d LEFT JOIN city c USING (city_id) GROUP BY ALL)"""

LANDED = "city_id, city_name, country_code, city_slug, year, date"
VARIABLE_LIST = " ".join(VARIABLES)
MONTH_MEASURES = (
    "avg_tmax_c avg_tmin_c avg_tmean_c avg_dewpoint_c avg_wind_max_ms avg_sw_radiation total_precip_mm"
)
MONTH_COUNTS = "heat_day_count, tropical_night_count, heavy_precip_day_count, summer_day_count"
CLIMATE_MEASURES = (
    "climatology_tmean_c climatology_tmax_c climatology_tmin_c climatology_total_precip_mm "
    "climatology_tmean_std_c climatology_total_precip_std_mm"
)
ANOMALY_MEASURES = (
    "avg_tmean_c avg_tmax_c avg_tmin_c total_precip_mm " + CLIMATE_MEASURES + " anomaly_tmean_c "
    "anomaly_tmax_c anomaly_tmin_c anomaly_total_precip_mm zscore_tmean zscore_total_precip"
)
ROLLING = "roll_mean_3 roll_mean_6 roll_std_3 roll_std_6 delta_1m delta_3m"

NEW_DAYS = f"""{DAILY},
stored AS (SELECT * FROM daily WHERE date <= DATE '2000-06-30'),
incoming AS (
  SELECT * REPLACE (temperature_2m_max + 1 AS temperature_2m_max) FROM daily
  WHERE date >= DATE '2000-01-01')"""
UPSERTED = f"""WITH {NEW_DAYS}
SELECT {LANDED}, {_each(VARIABLE_LIST)}
FROM (SELECT * FROM stored WHERE date < DATE '2000-01-01' UNION ALL SELECT * FROM incoming)"""

WINDOWS = """windows AS (
  SELECT city_id, city_name, lower(replace(trim(city_name), ' ', '_')) AS city_slug,
         CAST(y AS BIGINT) AS year,
         greatest(make_date(y, 1, 1), DATE '1993-03-15') AS window_start,
         least(make_date(y, 12, 31), DATE '2002-02-10') AS window_end
  FROM city, range(1993, 2003) AS years(y))"""


def _check(table: str, source: str, rules: dict[str, str]) -> str:
    """One SELECT per rule: how many rows of `source` meet the failing condition."""
    parts = [
        f"SELECT '{table}' AS table_name, 'not_empty' AS rule, count(*) AS n_rows, "
        f"CAST(count(*) = 0 AS BIGINT) AS n_failed FROM {source}"
    ]
    parts += [
        f"SELECT '{table}', '{rule}', count(*), count(*) FILTER ({condition}) FROM {source}"
        for rule, condition in rules.items()
    ]
    return "\nUNION ALL\n".join(parts)


def _not_null(columns: str) -> dict[str, str]:
    return {f"not_null({c})": f"{c} IS NULL" for c in columns.split()}


def _range(column: str, low, high) -> dict[str, str]:
    bounds = [f"{column} < {low}"] if low is not None else []
    bounds += [f"{column} > {high}"] if high is not None else []
    return {f"accepted_range({column})": " OR ".join(bounds)}


_MONTH_VALUES = {"accepted_values(month)": "month NOT BETWEEN 1 AND 12"}
_FEATURE_NAMES = (
    "anomaly_tmean_c roll_mean_3 roll_mean_6 roll_std_3 roll_std_6 delta_1m delta_3m "
    "max_lagged_corr lead_lag_months sin_month cos_month"
)
_CHECKS = "\nUNION ALL\n".join(
    [
        _check("landing_daily_weather", "daily", _not_null("city_id date")),
        _check(
            "clean_daily_weather_features",
            "clean",
            _not_null("city_id date tmax_c")
            | _range("tmax_c", -60, 60)
            | _range("tmin_c", -60, 60)
            | _range("precip_mm", 0, 500),
        ),
        _check(
            "clean_monthly_climate", "monthly",
            _not_null("city_id city_name year month") | _MONTH_VALUES,
        ),
        _check(
            "climatology_city_month", "climate",
            _not_null("city_id city_name month") | _MONTH_VALUES,
        ),
        _check(
            "anomaly_city_month", "anomaly",
            _not_null("city_id city_name year month") | _MONTH_VALUES,
        ),
        _check(
            "anomaly_city_events",
            "anomaly",
            _not_null("city_id year month")
            | {"not_null(z_score)": "zscore_tmean IS NULL"}
            | {f"not_null({c})": "false" for c in ("is_hot_event", "is_cold_event", "is_extreme_event")}
            | _range("month", 1, 12),
        ),
        _check(
            "anomaly_city_correlations",
            "(SELECT city_id AS city_id_1, city_name AS city_name_1, other_city_id AS city_id_2, "
            "other_city_name AS city_name_2, n_observations, r AS anomaly_correlation "
            "FROM lags WHERE lag_months = 0 AND city_id < other_city_id)",
            _not_null(
                "city_id_1 city_name_1 city_id_2 city_name_2 n_observations anomaly_correlation"
            )
            | _range("n_observations", 12, None)
            | {"accepted_range(anomaly_correlation)": "abs(anomaly_correlation) > 1"},
        ),
        _check(
            "anomaly_city_lags",
            "(SELECT *, r AS anomaly_correlation FROM lags)",
            _not_null("city_id other_city_id lag_months anomaly_correlation n_observations")
            | _range("lag_months", -6, 6)
            | {"accepted_range(anomaly_correlation)": "abs(anomaly_correlation) > 1"},
        ),
        _check(
            "ml_features",
            "features",
            _not_null("city_id year month is_event_next_month")
            | _range("month", 1, 12)
            | {"binary(is_event_next_month)": "is_event_next_month NOT IN (0, 1)"}
            | {f"complete({c})": f"{c} IS NULL OR isnan({c})" for c in _FEATURE_NAMES.split()},
        ),
        _check("pipeline_runs", "runs", _not_null("id started_at")),
    ]
)


_FAULTS = """planted_days AS (
  SELECT * REPLACE (
    CASE day_of_year % 50 WHEN 7 THEN 99 WHEN 8 THEN NULL ELSE tmax_c END AS tmax_c,
    CASE day_of_year % 50 WHEN 9 THEN -99 ELSE tmin_c END AS tmin_c,
    CASE day_of_year % 50 WHEN 10 THEN -1 ELSE precip_mm END AS precip_mm,
    CASE WHEN day_of_year % 50 <> 11 THEN city_id END AS city_id,
    CASE WHEN day_of_year % 50 <> 12 THEN date END AS date) FROM clean),
planted_months AS (
  SELECT * REPLACE (
    CASE WHEN month <> 3 THEN city_name END AS city_name,
    CASE WHEN month <> 4 THEN year END AS year,
    CASE month WHEN 2 THEN 14 WHEN 5 THEN NULL ELSE month END AS month) FROM monthly),
planted_events AS (
  SELECT city_id, year, CASE month WHEN 6 THEN 0 ELSE month END AS month,
         CASE WHEN month <> 7 THEN zscore_tmean END AS z_score,
         CASE WHEN month <> 8 THEN true END AS flag FROM anomaly)"""
_FAULTY_CHECKS = "\nUNION ALL\n".join(
    [
        _check(
            "clean_daily_weather_features",
            "planted_days",
            _not_null("city_id date tmax_c")
            | _range("tmax_c", -60, 60)
            | _range("tmin_c", -60, 60)
            | _range("precip_mm", 0, 500),
        ),
        _check(
            "clean_monthly_climate", "planted_months",
            _not_null("city_id city_name year month") | _MONTH_VALUES,
        ),
        _check(
            "anomaly_city_events",
            "planted_events",
            _not_null("city_id year month z_score")
            | {f"not_null({c})": "flag IS NULL" for c in ("is_hot_event", "is_cold_event", "is_extreme_event")}
            | _range("month", 1, 12),
        ),
    ]
)


def _unique(table: str, source: str, keys: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, 'unique({keys})' AS rule, CAST(sum(n) AS BIGINT) AS n_rows, "
        f"count(*) FILTER (n > 1) AS n_failed "
        f"FROM (SELECT count(*) AS n FROM {source} GROUP BY {keys})"
    )


DIM_CITY = f"""
SELECT s_suppkey AS city_id, CASE WHEN s_suppkey % 4 <> 0 THEN s_name || ' 1' ELSE s_name END AS city_name,
       CASE WHEN s_suppkey % 3 <> 0 THEN 'XX' ELSE 'N' || s_nationkey END AS country_code,
       {_r("s_acctbal / 100 + 1", "latitude")}, {_r("s_acctbal / 50 + 1", "longitude")},
       'UTC' AS timezone, CAST(NULL AS VARCHAR) AS admin1, CAST(NULL AS VARCHAR) AS admin2,
       s_suppkey * 1000 + 1 AS population, 'geocoding/' || s_suppkey || '.json' AS raw_geocoding_file
FROM supplier WHERE s_suppkey % 10 <> 9"""

ORACLE: dict[str, str] = {
    # ------------------------------------------------------------------ landing
    "station_daily": f"WITH {DAILY} SELECT {LANDED}, {_each(VARIABLE_LIST)} FROM daily",
    "dim_city_build": DIM_CITY,
    "dim_city_csv": DIM_CITY,
    "raw_validation": f"""WITH {FAULTY},
        found AS (
          SELECT city_slug, year, len(days) AS n,
            CASE fault
              WHEN 'none' THEN ['missing daily']
              WHEN 'rain' THEN ['missing daily.precipitation_sum']
              WHEN 'wind' THEN ['length of daily.wind_speed_10m_max: expected ' || len(days) || ', got ' || (len(days) - 1)]
              WHEN 'time' THEN ['empty daily.time'] || list_transform(
                {list(VARIABLES)}, lambda v: 'length of daily.' || v || ': expected 0, got ' || len(days))
              ELSE CAST([] AS VARCHAR[]) END AS errors,
            fault
          FROM faults)
        SELECT city_slug, year, CAST(CASE WHEN fault IN ('none', 'time') THEN 0 ELSE n END AS BIGINT) AS n_records,
               len(errors) AS n_errors, array_to_string(errors, '; ') AS errors FROM found""",
    "flatten_daily": f"""WITH {FAULTY},
        numbered AS (
          SELECT city_slug, year, fault, days, len(days) AS n, unnest(range(1, len(days) + 1)) AS i
          FROM faults WHERE fault NOT IN ('none', 'time'))
        SELECT city_slug, year, days[i].date AS date,
               {", ".join(_r(f"days[i].{v}", v) for v in VARIABLES if v not in ("precipitation_sum", "wind_speed_10m_max"))},
               {_r("CASE WHEN fault <> 'rain' THEN days[i].precipitation_sum END", "precipitation_sum")},
               {_r("CASE WHEN fault <> 'wind' THEN days[i].wind_speed_10m_max WHEN i < n THEN days[i + 1].wind_speed_10m_max END", "wind_speed_10m_max")}
        FROM numbered""",
    "city_slug_join": f"""WITH {DAILY}
        SELECT CASE WHEN city_id % 6 <> 5 THEN city_id END AS city_id,
               CASE WHEN city_id % 6 <> 5 THEN city_name END AS city_name,
               CASE WHEN city_id % 6 <> 5 THEN country_code END AS country_code,
               city_slug, year, date, {_each(VARIABLE_LIST)} FROM daily""",
    "incremental_high_watermark": f"""WITH {NEW_DAYS}
        SELECT {LANDED}, {_each(VARIABLE_LIST)}
        FROM (SELECT * FROM stored UNION ALL
              SELECT * FROM incoming WHERE date > (SELECT max(date) FROM stored))""",
    "incremental_upsert": UPSERTED,
    "stored_upsert": UPSERTED,
    "upsert_months": f"""WITH {NEW_DAYS},
        updated AS (SELECT * FROM stored WHERE date < DATE '2000-01-01' UNION ALL SELECT * FROM incoming),
        {CLEANING.replace("FROM daily)", "FROM updated)")}, {MONTHS}
        SELECT city_id, city_name, country_code, year, month, days_in_month, {_each(MONTH_MEASURES)},
               {MONTH_COUNTS} FROM monthly""",
    "landing_zone": f"WITH {DAILY} SELECT {LANDED}, {_each(VARIABLE_LIST)} FROM daily",
    "stream_landing": f"WITH {DAILY} SELECT {LANDED}, {_each(VARIABLE_LIST)} FROM daily",
    "rewritten_zone": f"WITH {DAILY} SELECT {LANDED}, {_each(VARIABLE_LIST)} FROM daily",
    "keyed_stream": UPSERTED,
    "raw_files": f"WITH {DAILY} SELECT city_slug, year, date, {_each(VARIABLE_LIST)} FROM daily",
    "window_plan_backfill": f"""WITH {DAILY}, {WINDOWS}
        SELECT * FROM windows w WHERE NOT EXISTS (
          SELECT 1 FROM daily d WHERE d.city_slug = w.city_slug AND d.year = w.year AND month(d.date) = 12)""",
    "window_plan_recent": """
        SELECT c_custkey AS city_id, c_name AS city_name, lower(replace(trim(c_name), ' ', '_')) AS city_slug,
               CAST(2001 AS BIGINT) AS year, DATE '2001-01-01' AS window_start,
               DATE '2001-08-03' AS window_end FROM customer""",
    "window_plan_missing": f"""WITH {DAILY},
        calendar AS (SELECT city_id, city_name, lower(replace(trim(city_name), ' ', '_')) AS city_slug,
                            CAST(unnest(generate_series(DATE '1993-03-15', DATE '2002-02-10', INTERVAL 1 DAY)) AS DATE) AS date
                     FROM city),
        missing AS (SELECT *, CAST(year(date) AS BIGINT) AS year FROM calendar ANTI JOIN daily USING (city_slug, date)),
        marked AS (SELECT *, CAST(coalesce(date - lag(date) OVER w - 1 > 3, true) AS INTEGER) AS is_new
                   FROM missing WINDOW w AS (PARTITION BY city_id, year ORDER BY date)),
        numbered AS (SELECT *, sum(is_new) OVER (PARTITION BY city_id, year ORDER BY date) AS number FROM marked)
        SELECT city_id, city_name, city_slug, year, min(date) AS window_start, max(date) AS window_end,
               count(*) AS missing_days FROM numbered GROUP BY city_id, city_name, city_slug, year, number""",
    "schema_drift": f"""WITH {DAILY},
        docs AS (SELECT city_id, city_slug, year,
                        CASE WHEN city_id % 7 = 3 AND year % 2 = 0 THEN 'retyped' WHEN city_id % 7 = 4 THEN 'units'
                             WHEN city_id % 7 = 5 AND year % 3 = 0 THEN 'broken' WHEN city_id % 7 = 6 AND year % 3 = 1 THEN 'list'
                             WHEN city_id % 5 = 1 THEN 'snow' END AS fault
                 FROM daily GROUP BY city_id, city_slug, year)
        SELECT city_slug, CASE fault WHEN 'retyped' THEN '$.daily.precipitation_sum' WHEN 'units' THEN '$.daily_units'
                                     WHEN 'snow' THEN '$.daily.snow_depth' ELSE '$' END AS path,
               CASE fault WHEN 'retyped' THEN 'retyped' WHEN 'units' THEN 'unknown' WHEN 'snow' THEN 'unknown'
                          ELSE 'unreadable' END AS finding, count(*) AS n_documents
        FROM docs WHERE fault IS NOT NULL GROUP BY ALL""",
    "window_plan_coverage": f"""WITH {DAILY}, {WINDOWS}
        SELECT w.* FROM windows w LEFT JOIN daily d
          ON d.city_slug = w.city_slug AND d.date BETWEEN w.window_start AND w.window_end
        GROUP BY ALL HAVING count(DISTINCT d.date) < w.window_end - w.window_start + 1""",
    "landed_summary": f"""WITH {ATTEMPTS}
        SELECT 'recent' AS mode, count(DISTINCT city_name) AS total_cities, count(*) AS total_requests,
               count(*) FILTER (succeeded) AS successes, count(*) FILTER (NOT succeeded) AS failures,
               count(DISTINCT city_name) FILTER (NOT succeeded) AS n_failed_cities,
               NOT bool_or(succeeded) AS run_failed FROM attempts""",
    "failed_cities": f"""WITH {ATTEMPTS}
        SELECT city_name, count(*) AS failures FROM attempts WHERE NOT succeeded GROUP BY city_name""",
    # ------------------------------------------------------------------ clean, anomaly
    "clean_daily": f"""WITH {CLEAN}
        SELECT city_id, city_name, country_code, date,
               {_each("tmax_c tmin_c tmean_c dewpoint_c precip_mm wind_max_ms sw_radiation")},
               year, month, day_of_year, is_summer, is_heat_day, is_tropical_night, is_heavy_precip_day
        FROM clean""",
    "monthly_climate": f"""WITH {MONTHLY}
        SELECT city_id, city_name, country_code, year, month, days_in_month, {_each(MONTH_MEASURES)},
               {MONTH_COUNTS} FROM monthly""",
    "stored_monthly": f"""WITH {MONTHLY}
        SELECT city_id, city_name, country_code, year, month, days_in_month, {_each(MONTH_MEASURES)},
               {MONTH_COUNTS} FROM monthly""",
    "climatology": f"""WITH {CLIMATE}
        SELECT city_id, city_name, country_code, month, {_each(CLIMATE_MEASURES)} FROM climate""",
    "retracted_months": f"""WITH {MONTHLY}
        SELECT city_id, city_name, country_code, year, month, days_in_month, {_each(MONTH_MEASURES)},
               {MONTH_COUNTS} FROM monthly""",
    "retracted_climatology": f"""WITH {CLIMATE}
        SELECT city_id, city_name, country_code, month, {_each(CLIMATE_MEASURES)} FROM climate""",
    "anomaly_month": f"""WITH {ANOMALY}
        SELECT city_id, city_name, country_code, year, month, month_name, season,
               {_each(ANOMALY_MEASURES)}, is_positive_temp_anomaly, is_negative_temp_anomaly,
               is_strong_positive_temp_anomaly, is_strong_negative_temp_anomaly FROM anomaly""",
    "anomaly_events": f"""WITH {ANOMALY}
        SELECT city_id, city_name, year, month, {_r("anomaly_tmean_c", "temperature_anomaly")},
               {_r("zscore_tmean", "z_score")}, is_strong_positive_temp_anomaly AS is_hot_event,
               is_strong_negative_temp_anomaly AS is_cold_event,
               coalesce(abs(zscore_tmean) >= 3, false) AS is_extreme_event,
               CAST(is_strong_positive_temp_anomaly OR is_strong_negative_temp_anomaly AS INTEGER)
                 AS is_event_next_month
        FROM anomaly""",
    # ------------------------------------------------------------------ correlations
    "anomaly_correlations": f"""WITH {LAGS}
        SELECT city_id AS city_id_1, city_name AS city_name_1, other_city_id AS city_id_2,
               other_city_name AS city_name_2, n_observations, {_r("r", "anomaly_correlation")}
        FROM lags WHERE lag_months = 0 AND city_id < other_city_id""",
    "anomaly_lags": f"""WITH {LAGS}
        SELECT city_id, city_name, other_city_id, other_city_name, lag_months, n_observations,
               {_r("r", "anomaly_correlation")} FROM lags""",
    "best_lag": f"WITH {BEST} SELECT city_id, {_r('max_lagged_corr')}, lead_lag_months FROM links",
    "strongest_links": f"WITH {BEST} SELECT city_id, {_r('max_lagged_corr')}, lead_lag_months FROM links",
    "fleet_monthly": f"""WITH {FLEET}
        SELECT city_id, city_name, country_code, year, month,
               {_each("avg_tmean_c avg_tmax_c avg_tmin_c total_precip_mm")} FROM monthly""",
    "fleet_correlations": f"""WITH {FLEET_LAGS}
        SELECT city_id AS city_id_1, city_name AS city_name_1, other_city_id AS city_id_2,
               other_city_name AS city_name_2, n_observations, {_r("r", "anomaly_correlation")}
        FROM lags WHERE lag_months = 0 AND city_id < other_city_id""",
    "fleet_links": f"WITH {FLEET_BEST} SELECT city_id, {_r('max_lagged_corr')}, lead_lag_months FROM links",
    "candidate_lags": f"""WITH {FLEET_LAGS}, {NEIGHBOURS}
        SELECT city_id, city_name, other_city_id, other_city_name, lag_months, n_observations,
               {_r("r", "anomaly_correlation")} FROM lags SEMI JOIN pairs USING (city_id, other_city_id)""",
    "similar_links": f"""WITH {REGIONAL_LAGS}
        SELECT city_id, city_name, other_city_id, other_city_name, lag_months, n_observations,
               {_r("r", "anomaly_correlation")} FROM lags WHERE abs(r) >= 0.8""",
    "strongest_similar": f"""WITH {REGIONAL_BEST}
        SELECT city_id, {_r('max_lagged_corr')}, lead_lag_months FROM links WHERE max_lagged_corr >= 0.8""",
    "updated_correlations": f"""WITH {FLEET_LAGS}
        SELECT city_id AS city_id_1, city_name AS city_name_1, other_city_id AS city_id_2,
               other_city_name AS city_name_2, n_observations, {_r("r", "anomaly_correlation")}
        FROM lags WHERE lag_months = 0 AND city_id < other_city_id""",
    "updated_links": f"WITH {FLEET_BEST} SELECT city_id, {_r('max_lagged_corr')}, lead_lag_months FROM links",
    "links_as_of": f"""WITH {FLEET_BEST.replace("AS x FROM anomaly)", "AS x FROM anomaly WHERE year <= 1999)")}
        SELECT city_id, {_r('max_lagged_corr')}, lead_lag_months FROM links""",
    "listing_order": f"""WITH {LAGS},
        shown AS (SELECT city_id AS city_id_1, other_city_id AS city_id_2, round(r, 6) AS r FROM lags
                  WHERE lag_months = 0 AND city_id < other_city_id)
        SELECT city_id_1, city_id_2,
               row_number() OVER (ORDER BY r DESC NULLS LAST, city_id_1, city_id_2) AS position FROM shown""",
    # ------------------------------------------------------------------ features, model
    "rolling_features": f"""WITH {ANOMALY}, {ROLLED}
        SELECT city_id, year, month, time_index, {_each(ROLLING)} FROM rolled""",
    "next_month_label": f"""WITH {ANOMALY}, {ROLLED}
        SELECT city_id, year, month, is_event_next_month FROM labelled""",
    "ml_features": f"""WITH {FEATURES}
        SELECT city_id, city_name, year, month, {_each("sin_month cos_month anomaly_tmean_c")},
               {_each(ROLLING)}, {_r("max_lagged_corr")}, lead_lag_months, is_event_next_month
        FROM features""",
    "ordered_split": f"""WITH {MONTHLY},
        placed AS (SELECT city_id, year, month, row_number() OVER (ORDER BY city_id, year, month) AS position,
                          count(*) OVER () AS n FROM monthly)
        SELECT city_id, year, month, position, position <= floor(n * 0.75) AS is_train FROM placed""",
    "time_split": f"""WITH {MONTHLY},
        placed AS (SELECT city_id, year, month, count(*) OVER (ORDER BY year, month) AS upto,
                          count(*) OVER () AS n FROM monthly)
        SELECT city_id, year, month, upto <= floor(n * 0.75) AS is_train FROM placed""",
    "class_weights": f"""WITH {SCORED},
        sizes AS (SELECT label, count(*) AS n_class, sum(count(*)) OVER () AS n, count(*) OVER () AS k
                  FROM scored GROUP BY label)
        SELECT event_id, CAST(label AS INTEGER) AS is_event_next_month,
               {_r("CAST(n AS DOUBLE) / (k * n_class)", "class_weight")}
        FROM scored JOIN sizes USING (label)""",
    "class_distribution": f"""WITH {SCORED}
        SELECT label AS class, count(*) AS n, {_r("count(*) / sum(count(*)) OVER ()", "share")}
        FROM scored GROUP BY label""",
    "classification_report": f"""WITH {REPORT}
        SELECT class, {_each("precision recall f1")}, support FROM report""",
    "roc_auc": f"WITH {SCORED}, {AUC} SELECT {_r('roc_auc')}, n_positive, n_negative FROM auc",
    "metrics_record": f"""WITH {REPORT}, {AUC}
        SELECT CAST(NULL AS BIGINT) AS pipeline_run_id, 'train-baseline' AS flow_name, 'daily' AS run_mode,
               'baseline_random_forest' AS model_name, 'v1' AS model_version,
               n_positive + n_negative AS train_size, n_positive + n_negative AS test_size,
               {_r("n_positive / (n_positive + n_negative)", "positive_class_ratio")},
               {_r("(SELECT f1 FROM report WHERE class = 'accuracy')", "accuracy")}, {_r("roc_auc")},
               {", ".join(_r(f"(SELECT {m} FROM report WHERE class = '{c}')", f"{m}_{c}") for c in "01" for m in ("precision", "recall", "f1"))}
        FROM auc""",
    "event_probability": f"""
        SELECT event_id, {_r("1 / (1 + exp((25 - value) / 10))", "prob_event_next_month")},
               CAST(value >= 25 AS INTEGER) AS pred_event_next_month FROM events""",
    "probability_forms": f"""
        SELECT event_id, form,
               {_r("CASE WHEN form = 'label' THEN CAST(value >= 25 AS DOUBLE) ELSE 1 / (1 + exp((25 - value) / 10)) END", "prob_event_next_month")},
               CAST(value >= 25 AS INTEGER) AS pred_event_next_month
        FROM events, (SELECT unnest(['probability', 'margin_vector', 'margin', 'label']) AS form)""",
    "auc_by_day": f"""WITH scored AS (
          SELECT CAST(ts AS DATE) AS day, CAST(date_trunc('month', ts) AS DATE) AS month, user_id % 10 = 0 AS hit FROM events),
        periods AS (SELECT 'day' AS period, day AS starts, hit FROM scored
                    UNION ALL SELECT 'month', month, hit FROM scored)
        SELECT period, starts, count(*) FILTER (hit) AS n_positive, count(*) FILTER (NOT hit) AS n_negative,
               CASE WHEN n_positive > 0 AND n_negative > 0 THEN true END AS within_bound
        FROM periods GROUP BY period, starts""",
    "metrics_document": f"""WITH {REPORT}, {AUC}
        SELECT 'baseline_random_forest' AS model_name, n_positive + n_negative AS test_size, {_r("roc_auc")},
               'is_event_next_month' AS target_column, CAST(11 AS BIGINT) AS n_features, CAST(2 AS BIGINT) AS n_classes,
               class, {_each("precision recall f1")}, support
        FROM report, auc""",
    "rf_agreement": f"""WITH {FEATURES},
        placed AS (SELECT *, row_number() OVER (ORDER BY city_id, year, month) AS position, count(*) OVER () AS n FROM features)
        SELECT city_id, year, month, {_r("anomaly_tmean_c")}, true AS agrees, true AS ranks_better_than_chance
        FROM placed WHERE position <= floor(n * 0.75)""",
    "exported_predictions": f"""WITH {SCORED}
        SELECT event_id, CAST(label AS INTEGER) AS is_event_next_month,
               CAST(called AS INTEGER) AS pred_event_next_month, score AS prob_event_next_month
        FROM scored""",
    "complete_feature_rows": f"""WITH {FEATURES}
        SELECT city_id, year, month FROM features
        WHERE month NOT IN (1, 2) AND {" AND ".join(f"{c} IS NOT NULL" for c in _FEATURE_NAMES.split())}""",
    "model_round_trip": f"""WITH {FEATURES}
        SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_changed, CAST(0 AS BIGINT) AS n_disagreeing,
               CAST(0 AS BIGINT) AS n_out_of_range FROM features
        WHERE {" AND ".join(f"{c} IS NOT NULL" for c in _FEATURE_NAMES.split())}""",
    # ------------------------------------------------------------------ observability
    "stored_log": f"""WITH {RUNS}
        SELECT row_number() OVER (ORDER BY status = 'failed' NULLS LAST, id) AS id, * EXCLUDE (id)
        FROM runs""",
    "run_log_view": f"WITH {RUNS} SELECT * FROM runs",
    "run_daily_summary": f"WITH {RUN_DAYS} SELECT * FROM run_days",
    "ml_metrics_view": f"""WITH {METRICS}
        SELECT created_at AS run_at, run_mode, train_size AS n_train, {_each("accuracy roc_auc")}
        FROM metrics""",
    "ml_daily_summary": f"""WITH {ML_DAYS}
        SELECT {ML_DAY_KEYS},
               {_each("avg_accuracy avg_roc_auc avg_precision_pos avg_recall_pos avg_f1_pos")}
        FROM ml_days""",
    "run_stats": f"""WITH {MONTHLY}, {RUNS},
        previous AS (SELECT rows_bronze, rows_gold_ml FROM runs WHERE status = 'success'
                     ORDER BY started_at DESC LIMIT 1),
        now AS (SELECT (SELECT count(*) FROM daily) AS rows_bronze, (SELECT count(*) FROM monthly) AS rows_gold_ml,
                       (SELECT max(date) FROM daily) AS bronze_max_date,
                       (SELECT max(make_date(year, month, 1)) FROM monthly) AS gold_ml_max_date)
        SELECT now.rows_bronze, now.rows_gold_ml, now.rows_bronze - previous.rows_bronze AS rows_bronze_delta,
               now.rows_gold_ml - previous.rows_gold_ml AS rows_gold_ml_delta,
               bronze_max_date, gold_ml_max_date,
               CASE WHEN DATE '2001-08-04' - bronze_max_date <= 1 THEN 'fresh'
                    WHEN DATE '2001-08-04' - bronze_max_date <= 7 THEN 'stale' ELSE 'very_stale' END
                 AS freshness_status
        FROM now, previous""",
    "log_append": f"""WITH {RUNS}
        SELECT (SELECT max(id) FROM runs) + row_number() OVER (ORDER BY id) AS id, id AS source_id,
               run_mode, started_at FROM runs""",
    "last_success": f"""WITH {RUNS}
        SELECT rows_bronze, rows_gold_ml FROM runs WHERE status = 'success'
        ORDER BY started_at DESC LIMIT 1""",
    "ingestion_health": f"WITH {HEALTH} SELECT * FROM report",
    "freshness_counts": f"""WITH {HEALTH}
        SELECT freshness_status, count(*) AS n_cities FROM report GROUP BY freshness_status""",
    "ingestion_status": f"""WITH {HEALTH},
        counted AS (SELECT count(*) AS n_cities, count(*) FILTER (freshness_status = 'fresh') AS n_fresh,
                           count(*) FILTER (freshness_status = 'stale') AS n_stale,
                           count(*) FILTER (freshness_status = 'very_stale') AS n_very_stale,
                           count(*) FILTER (freshness_status = 'unknown') AS n_unknown FROM report)
        SELECT *, CASE WHEN n_cities = 0 THEN 3 WHEN n_very_stale > 0 THEN 2
                       WHEN n_fresh < n_cities THEN 1 ELSE 0 END AS exit_code FROM counted""",
    "recent_ml_summary": f"""WITH {ML_DAYS}
        SELECT {ML_DAY_KEYS}, {_each("avg_accuracy avg_roc_auc")} FROM ml_days
        ORDER BY run_date DESC, run_mode LIMIT 10""",
    "ml_health": f"""WITH {ML_DAYS},
        newest AS (SELECT * FROM ml_days ORDER BY run_date DESC, run_mode LIMIT 1),
        last_row AS (SELECT m.positive_class_ratio FROM metrics m, newest
                     WHERE CAST(m.created_at AS DATE) = newest.run_date AND m.run_mode = newest.run_mode
                     ORDER BY m.created_at DESC LIMIT 1)
        SELECT {ML_DAY_KEYS}, {_each("avg_accuracy avg_roc_auc positive_class_ratio")},
               concat_ws('; ', CASE WHEN avg_accuracy < 0.8 THEN 'accuracy' END,
                         CASE WHEN avg_roc_auc < 0.6 THEN 'roc_auc' END,
                         CASE WHEN positive_class_ratio < 0.01 THEN 'positive_class_ratio' END) AS failures,
               CASE WHEN avg_accuracy < 0.8 OR avg_roc_auc < 0.6 OR positive_class_ratio < 0.01
                    THEN 1 ELSE 0 END AS exit_code
        FROM newest, last_row""",
    # ------------------------------------------------------------------ dashboards
    "monthly_trend": f"""WITH {MONTHLY}
        SELECT city_name, country_code, make_date(year, month, 1) AS date, {_each(MONTH_MEASURES)},
               {MONTH_COUNTS} FROM monthly""",
    "metric_trend_of_cities": f"""WITH {MONTHLY}
        SELECT city_name, country_code, make_date(year, month, 1) AS date, {_r("total_precip_mm")}
        FROM monthly WHERE city_name IN ('NATION_3', 'NATION_7', 'NATION_11')""",
    "metric_summary": f"""WITH {MONTHLY}
        SELECT city_name, round_even(avg(avg_tmean_c), 2) + 0.0 AS mean,
               round_even(stddev_samp(avg_tmean_c), 2) + 0.0 AS std,
               round_even(min(avg_tmean_c), 2) + 0.0 AS min, round_even(max(avg_tmean_c), 2) + 0.0 AS max
        FROM monthly GROUP BY city_name""",
    "city_names": f"WITH {MONTHLY} SELECT DISTINCT city_name FROM monthly",
    "success_rate": f"""WITH {RUN_DAYS}
        SELECT run_date, flow_name, run_mode, runs_success AS success_count, runs_failed AS failure_count,
               n_runs, {_r("runs_success / n_runs", "success_rate")}, rows_bronze_max, rows_gold_ml_max,
               rows_bronze_delta_max, rows_gold_ml_delta_max FROM run_days""",
    "latest_per_mode": f"""WITH {ML_DAYS}
        SELECT {ML_DAY_KEYS},
               {_each("avg_accuracy avg_roc_auc avg_precision_pos avg_recall_pos avg_f1_pos")}
        FROM ml_days d WHERE run_date = (SELECT max(run_date) FROM ml_days x WHERE x.run_mode = d.run_mode)""",
    # ------------------------------------------------------------------ checks
    "dq_report": f"""WITH {FEATURES}, {RUNS}, results AS ({_CHECKS})
        SELECT table_name, rule, n_rows, n_failed, n_failed = 0 AS passed FROM results""",
    "dq_contracts": """
        SELECT * FROM (VALUES ('landing_daily_weather', 'contract', 13::BIGINT, 0::BIGINT, true),
            ('clean_monthly_climate', 'contract', 10, 2, false), ('climatology_city_month', 'contract', 6, 0, true),
            ('anomaly_city_month', 'contract', 10, 2, false), ('anomaly_city_events', 'contract', 8, 0, true))
        AS t(table_name, rule, n_rows, n_failed, passed)""",
    "dq_faults": f"""WITH {ANOMALY}, {_FAULTS}, results AS ({_FAULTY_CHECKS})
        SELECT table_name, rule, n_rows, n_failed, n_failed = 0 AS passed FROM results""",
    "target_values": f"""WITH {SCORED}
        SELECT DISTINCT CAST(label AS INTEGER) AS is_event_next_month FROM scored""",
    "dq_unique_keys": f"""WITH {MONTHLY}, {ATTEMPTS}, results AS (
        {_unique("landing_daily_weather", "daily", "city_id, date")} UNION ALL
        {_unique("clean_monthly_climate", "monthly", "city_id, year, month")} UNION ALL
        {_unique("load_attempts", "attempts", "city_name")})
        SELECT table_name, rule, n_rows, n_failed, n_failed = 0 AS passed FROM results""",
}
