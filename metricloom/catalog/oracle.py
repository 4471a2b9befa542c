"""Reference SQL for the registered queries (DuckDB dialect), written against the raw tables."""

from __future__ import annotations

SERIES = """series AS (
  SELECT event_type AS series_key, ts, event_id, value,
         least(round_even(value, 2), 100.0)::DOUBLE AS x,
         CASE WHEN value > 120 THEN 1 ELSE 0 END AS is_anomaly
  FROM events)"""
ORDER = "PARTITION BY series_key ORDER BY ts, event_id"
SQL: dict[str, str] = {}


def r6(expression: str, name: str) -> str:
    return f"round(({expression})::DOUBLE + 1e-9, 6) + 0.0 AS {name if name.isidentifier() else chr(34) + name + chr(34)}"


def put(name: str, body: str, *ctes: str) -> None:
    SQL[name] = f"WITH {', '.join([SERIES, *ctes])}\n{body}"


def frame(rows: int) -> str:
    return f"({ORDER} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"


TREND = "CASE WHEN count(x) OVER w >= 2 THEN regr_slope(x, rn) OVER w ELSE 0 END"
NUMBERED = f"numbered AS (SELECT *, row_number() OVER ({ORDER}) AS rn, count(*) OVER (PARTITION BY series_key) AS n FROM series)"


def rolling_columns(w: int, trend: bool = False, prefix: str = "w") -> dict[str, str]:
    mean = f"avg(x) OVER {prefix}"
    top, low = f"max(x) OVER {prefix}", f"min(x) OVER {prefix}"
    out = {
        f"{w}min_mean": mean,
        f"{w}min_std": f"coalesce(stddev_samp(x) OVER {prefix}, 0)",
        f"{w}min_max": top,
        f"{w}min_min": low,
        f"{w}min_range": f"{top} - {low}",
        f"{w}min_change": f"x - {mean}",
        f"{w}min_pct_change": f"x / ({mean} + 1e-8) - 1",
    }
    if trend:
        out[f"{w}min_trend"] = f"CASE WHEN count(x) OVER {prefix} >= 2 THEN regr_slope(x, rn) OVER {prefix} ELSE 0 END"
    return out


def listed(columns: dict[str, str]) -> str:
    return ", ".join(r6(e, n) for n, e in columns.items())


# --- rolling windows -----------------------------------------------------------------------------

for w in (5, 15, 30, 60):
    put(f"rolling_stats_{w}", f"SELECT series_key, event_id, {listed(rolling_columns(w))} FROM series WINDOW w AS {frame(w)}")
put(
    "rolling_flagged",
    f"SELECT series_key, event_id, (x > 80)::INT AS is_high_usage, {r6('avg(x) OVER w', '5min_mean')}, "
    f"{r6('coalesce(stddev_samp(x) OVER w, 0)', '5min_std')} FROM series WINDOW w AS {frame(5)}",
)
put(
    "rolling_trend",
    "SELECT series_key, event_id, "
    + ", ".join(r6(TREND.replace(" w ", f" w{w} "), f"{w}min_trend") for w in (5, 15, 30, 60))
    + " FROM numbered WINDOW "
    + ", ".join(f"w{w} AS {frame(w)}" for w in (5, 15, 30, 60)),
    NUMBERED,
)
_long = rolling_columns(5, trend=True)
put(
    "rolling_long_frames",
    f"SELECT series_key, event_id, {listed({n: e for n, e in _long.items() if n.split('_', 1)[1] in ('mean', 'std', 'max', 'min', 'trend')})} "
    f"FROM numbered WINDOW w AS {frame(300)}",
    NUMBERED,
)
for m in (15, 60):
    put(
        f"rolling_time_range_{m}",
        f"SELECT series_key, event_id, (count(x) OVER w)::BIGINT AS \"{m}min_count\", {listed(rolling_columns(m))} "
        f"FROM (SELECT *, floor(epoch(ts))::BIGINT AS sec FROM series) "
        f"WINDOW w AS (PARTITION BY series_key ORDER BY sec RANGE BETWEEN {60 * m - 1} PRECEDING AND CURRENT ROW)",
    )
# e: endless (infinite) value, f: finite value, g: any value that is not missing
WITH_GAPS = """holed AS (SELECT *, CASE WHEN e THEN 'infinity'::DOUBLE ELSE f END AS g FROM (
  SELECT *, event_id % 97 <> 0 AND (event_id % 211 = 0 OR rn = 1) AS e, epoch(ts)::BIGINT AS sec,
    CASE WHEN event_id % 97 <> 0 AND event_id % 211 <> 0 AND rn > 1 THEN x END AS f FROM numbered))"""
_ENDLESS = "coalesce(bool_or(e) OVER w, false)"
_holed = {
    "mean": f"CASE WHEN NOT {_ENDLESS} THEN avg(f) OVER w END",
    "std": f"CASE WHEN NOT {_ENDLESS} THEN coalesce(stddev_samp(f) OVER w, 0) END",
    "min": "min(g) OVER w",
    "change": f"CASE WHEN NOT {_ENDLESS} THEN f - avg(f) OVER w END",
    "trend": f"CASE WHEN NOT {_ENDLESS} THEN CASE WHEN count(f) OVER w >= 2 THEN regr_slope(f, rn) OVER w ELSE 0 END END",
}
put(
    "rolling_stats_nan",
    f"SELECT series_key, event_id, {_ENDLESS}::INT AS is_endless, {listed({f'15min_{n}': e for n, e in _holed.items()})} "
    f"FROM holed WINDOW w AS {frame(15)}",
    NUMBERED,
    WITH_GAPS,
)
put(
    "rolling_time_range_nan",
    f"SELECT series_key, event_id, (count(CASE WHEN event_id % 97 <> 0 THEN 1 END) OVER w)::BIGINT AS \"240min_count\", "
    f"{listed({f'240min_{n}': e for n, e in _holed.items() if n != 'trend'})} FROM (SELECT * REPLACE (floor(epoch(ts))::BIGINT AS sec) FROM holed) "
    "WINDOW w AS (PARTITION BY series_key ORDER BY sec RANGE BETWEEN 14399 PRECEDING AND CURRENT ROW)",
    NUMBERED,
    WITH_GAPS,
)
put(
    "rolling_offset",
    "SELECT series_key, event_id, "
    + ", ".join(
        f'round({e} OVER w{w} + 1e-5, 2) AS "{w}min_{n}"' if n == "mean" else f'round(coalesce({e} OVER w{w}, 0) + 1e-5, 2) AS "{w}min_{n}"'
        for w in (5, 60)
        for n, e in (("mean", "avg(y)"), ("std", "stddev_samp(y)"))
    )
    + " FROM (SELECT *, x + CASE WHEN event_id * 2 > (SELECT max(event_id) FROM series) THEN 1e9 ELSE 0 END AS y FROM series) WINDOW "
    + ", ".join(f"w{w} AS {frame(w)}" for w in (5, 60)),
)
put(
    "zscore_nan",
    f"SELECT series_key, event_id, {r6('(f - avg(f) OVER s) / (stddev_samp(f) OVER s + 1e-8)', 'z_score')} FROM holed WINDOW s AS (PARTITION BY series_key)",
    NUMBERED,
    WITH_GAPS,
)
put(
    "describe_nan",
    "SELECT series_key, count(f)::BIGINT AS count, "
    + listed({"mean": "avg(f)", "std": "stddev_samp(f)", "min": "min(f)", "max": "max(f)"} | {f"p{q}": f"quantile_cont(f, 0.{q})" for q in (25, 50, 75)})
    + " FROM holed GROUP BY 1",
    NUMBERED,
    WITH_GAPS,
)
put(
    "merged_stats",
    "SELECT series_key, count(*)::BIGINT AS n_rows, count(f)::BIGINT AS n_values, count(DISTINCT f)::BIGINT AS n_distinct, "
    + listed({"v_min": "min(f)", "v_max": "max(f)", "v_mean": "avg(f)", "v_std": "stddev_samp(f)"}
             | {n: f"quantile_cont(f, {q})" for n, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))})
    + " FROM holed GROUP BY 1",
    NUMBERED,
    WITH_GAPS,
)
put(
    "merged_ranks",
    f"""SELECT series_key, event_id, {r6('CASE WHEN f IS NOT NULL THEN (rank() OVER w + (count(*) OVER (PARTITION BY series_key, f) - 1) / 2) / count(f) OVER (PARTITION BY series_key) END', 'cpu_rank')}
FROM holed WINDOW w AS (PARTITION BY series_key ORDER BY f NULLS LAST)""",
    NUMBERED,
    WITH_GAPS,
)
put(
    "usage_streak",
    "SELECT series_key, event_id, "
    + ", ".join(f"(sum((x > 80)::INT) OVER {frame(n)})::BIGINT AS high_usage_streak_{n}" for n in (3, 5, 10))
    + " FROM series",
)
put(
    "anomaly_streak",
    "SELECT series_key, event_id, "
    + ", ".join(f"(sum(is_anomaly) OVER {frame(n)})::BIGINT AS anomaly_streak_{n}" for n in (3, 5, 10))
    + " FROM series",
)
put(
    "coefficient_of_variation",
    "SELECT series_key, event_id, "
    + ", ".join(
        r6(f"coalesce(stddev_samp(x) OVER w{w}, 0) / (avg(x) OVER w{w} + 1e-8)", f"{w}min_cv") for w in (15, 30, 60)
    )
    + " FROM series WINDOW "
    + ", ".join(f"w{w} AS {frame(w)}" for w in (15, 30, 60)),
)
put("row_index", "SELECT series_key, event_id, (rn - 1)::BIGINT AS row_index FROM numbered", NUMBERED)

# --- scalars -------------------------------------------------------------------------------------

put(
    "threshold_flags",
    "SELECT series_key, event_id, (x > 80)::INT AS is_high_usage, (x > 90)::INT AS is_very_high_usage, "
    "(x < 10)::INT AS is_low_usage FROM series",
)
put(
    "calendar_features",
    "SELECT series_key, event_id, hour(ts)::INT AS hour, (isodow(ts) - 1)::INT AS weekday, minute(ts)::INT AS minute, "
    "(isodow(ts) >= 6)::INT AS is_weekend, (hour(ts) BETWEEN 9 AND 17)::INT AS is_business_hour, "
    "(hour(ts) BETWEEN 10 AND 16)::INT AS is_peak_hour, strftime(ts, '%Y-%m-%d') AS date FROM series",
)
_CYCLE = f"{r6('sin(2 * pi() * hour(ts) / 24)', 'hour_sin')}, {r6('cos(2 * pi() * hour(ts) / 24)', 'hour_cos')}"
put("cyclic_hour", f"SELECT series_key, event_id, {_CYCLE} FROM series")
put(
    "clean_numeric",
    "SELECT event_id, CASE WHEN value > 200 OR value < 2 THEN 0.0 ELSE value END::DOUBLE AS x FROM events",
)
put("round2", "SELECT event_id, round_even(value / 8, 2)::DOUBLE AS x FROM events")
put("clip", "SELECT event_id, least(greatest(value, 5), 95)::DOUBLE AS x FROM events")
put("validity_filter", "SELECT event_id, value FROM events WHERE value < 0 OR value > 100")
put("normalize_label", "SELECT series_key, event_id, is_anomaly::INT AS is_anomaly FROM series")
put("label_filter", "SELECT event_id, event_type, value FROM events WHERE event_type = 'error'")
put(
    "epoch_conversion",
    "SELECT series_key, event_id, floor(epoch(ts))::BIGINT AS epoch, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS back FROM series",
)
put(
    "time_index",
    "SELECT series_key, event_id, CASE WHEN is_anomaly = 0 THEN floor(epoch(ts))::DOUBLE END AS epoch FROM series",
)
put("time_index_mixed", "SELECT series_key, event_id, floor(epoch(ts))::DOUBLE AS epoch FROM series")
put(
    "point_features",
    "SELECT series_key, event_id, x AS cpu_usage, hour(ts)::INT AS hour, (isodow(ts) - 1)::INT AS weekday, "
    f"(isodow(ts) >= 6)::INT AS is_weekend, {_CYCLE} FROM series",
)
put("select_features", "SELECT series_key, event_id, x AS cpu_utilization, 0.0::DOUBLE AS absent, 1::INT AS n_missing_features FROM series")

# --- whole-series statistics ---------------------------------------------------------------------

STATS = """stats AS (
  SELECT series_key, min(x) AS lo, max(x) AS hi, avg(x) AS mean, stddev_samp(x) AS sd,
         quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3
  FROM series GROUP BY series_key)"""
NORMAL = "(x - lo) / (hi - lo)"
Z = "(x - mean) / (sd + 1e-8)"
put("min_max_normalize", f"SELECT series_key, event_id, {r6(NORMAL, 'cpu_normalized')} FROM series JOIN stats USING (series_key)", STATS)
put(
    "zscore",
    f"SELECT series_key, event_id, {r6(Z, 'z_score')}, {r6(Z, 'cpu_deviation_from_mean')} FROM series JOIN stats USING (series_key)",
    STATS,
)
HOURLY = "x - avg(x) OVER (PARTITION BY series_key, hour(ts))"
DAILY = "x - avg(x) OVER (PARTITION BY series_key, ts::DATE)"
RANK = (
    "(rank() OVER (PARTITION BY series_key ORDER BY x) + (count(*) OVER (PARTITION BY series_key, x) - 1) / 2.0)"
    " / count(*) OVER (PARTITION BY series_key)"
)
put("hourly_deviation", f"SELECT series_key, event_id, {r6(HOURLY, 'cpu_deviation_hourly')} FROM series")
put("daily_deviation", f"SELECT series_key, event_id, {r6(DAILY, 'cpu_deviation_daily')} FROM series")
put("pct_rank", f"SELECT series_key, event_id, {r6(RANK, 'cpu_rank')} FROM series")
put(
    "quantiles",
    "SELECT series_key, "
    + ", ".join(r6(f"quantile_cont(x, {q})", n) for n, q in (("p1", 0.01), ("p25", 0.25), ("p75", 0.75), ("p99", 0.99)))
    + " FROM series GROUP BY series_key",
)
# A sketch of 10 000 samples is exact for series that are no longer.
put(
    "approx_quantiles",
    f"SELECT series_key, {', '.join(r6(f'quantile_disc(x, {q})', n) for n, q in (('p10', 0.1), ('p50', 0.5), ('p90', 0.9)))} FROM series GROUP BY 1",
)
put(
    "describe",
    f"SELECT series_key, count(x)::BIGINT AS count, {r6('avg(x)', 'mean')}, {r6('stddev_samp(x)', 'std')}, {r6('min(x)', 'min')}, "
    f"{r6('quantile_cont(x, 0.25)', 'p25')}, {r6('quantile_cont(x, 0.5)', 'p50')}, {r6('quantile_cont(x, 0.75)', 'p75')}, "
    f"{r6('max(x)', 'max')} FROM series GROUP BY series_key",
)

# --- quality -------------------------------------------------------------------------------------

WORKDAY = "avg(x) FILTER (isodow(ts) <= 5) - avg(x) FILTER (isodow(ts) >= 6)"
VARIATION = """variation AS (
  SELECT series_key, max(m) - min(m) AS daily_variation
  FROM (SELECT series_key, hour(ts) AS h, avg(x) AS m FROM series GROUP BY 1, 2) GROUP BY 1)"""
GAPS = """gaps AS (
  SELECT series_key, coalesce(avg(g), -1) AS avg_anomaly_gap_min
  FROM (SELECT series_key, CASE WHEN is_anomaly = 1 THEN
               epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY series_key, is_anomaly ORDER BY ts, event_id) END / 6e7 AS g
        FROM series) GROUP BY 1)"""
put(
    "quality_report",
    f"""SELECT series_key, n_anomalies::BIGINT AS n_anomalies, n_total::BIGINT AS n_total, 1 AS time_continuity,
  1 AS continuity_ok, (validity = 100)::INT AS validity_ok, (ratio BETWEEN 5 AND 15)::INT AS anomaly_ratio_ok,
  (workday > 5)::INT AS workday_ok, (daily_variation > 20)::INT AS daily_variation_ok,
  (avg_anomaly_gap_min > 60)::INT AS anomaly_gap_ok,
  {r6('100', 'completeness')}, {r6('100', 'completeness_by_cell')}, {r6('validity', 'validity')},
  {r6('ratio', 'anomaly_ratio')}, {r6('workday', 'workday_difference')}, {r6('daily_variation', 'daily_variation')},
  {r6('avg_anomaly_gap_min', 'avg_anomaly_gap_min')}
FROM (SELECT series_key, sum(is_anomaly) AS n_anomalies, count(*) AS n_total, avg(is_anomaly) * 100 AS ratio,
             avg((x BETWEEN 0 AND 100)::INT) * 100 AS validity, {WORKDAY} AS workday
      FROM series GROUP BY 1) JOIN variation USING (series_key) JOIN gaps USING (series_key)""",
    VARIATION,
    GAPS,
)
HOLED = "holed AS (SELECT series_key, ts, event_id, is_anomaly, CASE WHEN x < 20 OR x > 60 THEN x END AS x FROM series)"
put(
    "completeness",
    f"SELECT series_key, {r6('(1 - count(*) FILTER (x IS NULL) / count(*)) * 100', 'completeness')}, "
    f"{r6('(1 - count(*) FILTER (x IS NULL) / (count(*) * 4)) * 100', 'completeness_by_cell')} FROM holed GROUP BY 1",
    HOLED,
)
put("validity", f"SELECT series_key, {r6('avg((value BETWEEN 0 AND 100)::INT) * 100', 'validity')} FROM series GROUP BY 1")
put(
    "anomaly_ratio",
    f"SELECT series_key, (avg(is_anomaly) BETWEEN 0.05 AND 0.15)::INT AS anomaly_ratio_ok, {r6('avg(is_anomaly) * 100', 'anomaly_ratio')} FROM series GROUP BY 1",
)
put("workday_difference", f"SELECT series_key, {r6(WORKDAY, 'workday_difference')} FROM series GROUP BY 1")
put("daily_variation", f"SELECT series_key, {r6('daily_variation', 'daily_variation')} FROM variation", VARIATION)
put("anomaly_gap", f"SELECT series_key, {r6('avg_anomaly_gap_min', 'avg_anomaly_gap_min')} FROM gaps", GAPS)
put("time_continuity", "SELECT series_key, (count(ts) = count(*))::INT AS time_continuity FROM series GROUP BY 1")
put(
    "out_of_order",
    """SELECT series_key, count(*) FILTER (late)::BIGINT AS n_out_of_order
FROM (SELECT series_key, ts < lag(ts) OVER (PARTITION BY series_key ORDER BY md5(event_id::VARCHAR)) AS late FROM series) GROUP BY 1""",
)
put(
    "dataset_report",
    f"""SELECT series_key, count(*)::BIGINT AS n_total, epoch_us(min(ts))::BIGINT AS first_ts, epoch_us(max(ts))::BIGINT AS last_ts,
  (count(*) - sum(is_anomaly))::BIGINT AS n_normal, sum(is_anomaly)::BIGINT AS n_anomaly,
  {r6('1 - avg(is_anomaly)', 'normal_ratio')}, {r6('avg(is_anomaly)', 'anomaly_ratio')}, {r6('avg(x)', 'mean')},
  {r6('min(x)', 'min')}, {r6('max(x)', 'max')}, {r6('stddev_pop(x)', 'std_pop')} FROM series GROUP BY 1""",
)
put(
    "quality_report_nan",
    f"""SELECT series_key, n_anomalies::BIGINT AS n_anomalies, n_total::BIGINT AS n_total, 1 AS time_continuity, 1 AS continuity_ok,
  (validity = 100)::INT AS validity_ok, (ratio BETWEEN 5 AND 15)::INT AS anomaly_ratio_ok, (workday > 5)::INT AS workday_ok,
  (daily_variation > 20)::INT AS daily_variation_ok, (avg_anomaly_gap_min > 60)::INT AS anomaly_gap_ok,
  {r6('(1 - missing / n_total) * 100', 'completeness')}, {r6('(1 - missing / (n_total * 4)) * 100', 'completeness_by_cell')}, {r6('validity', 'validity')},
  {r6('ratio', 'anomaly_ratio')}, {r6('workday', 'workday_difference')}, {r6('daily_variation', 'daily_variation')},
  {r6('avg_anomaly_gap_min', 'avg_anomaly_gap_min')}
FROM (SELECT series_key, sum(is_anomaly) AS n_anomalies, count(*) AS n_total, avg(is_anomaly) * 100 AS ratio, count(*) FILTER (g IS NULL) AS missing,
             (count(*) - count(*) FILTER (g < 0 OR g > 100)) / count(*) * 100 AS validity, {WORKDAY.replace('x', 'f')} AS workday
      FROM holed GROUP BY 1) JOIN variation USING (series_key) JOIN gaps USING (series_key)""",
    NUMBERED,
    WITH_GAPS,
    VARIATION.replace("avg(x)", "avg(f)").replace("FROM series", "FROM holed"),
    GAPS,
)
put(
    "dataset_report_nan",
    f"SELECT series_key, count(*)::BIGINT AS n_total, {r6('avg(f)', 'mean')}, {r6('min(f)', 'min')}, {r6('max(f)', 'max')}, "
    f"{r6('stddev_pop(f)', 'std_pop')} FROM holed GROUP BY 1",
    NUMBERED,
    WITH_GAPS,
)
put("preview", "SELECT series_key, event_id, x AS cpu_utilization FROM series ORDER BY ts, event_id LIMIT 10")
put(
    "trailing_range",
    "SELECT series_key, event_id, x AS cpu_utilization FROM series WHERE ts >= (SELECT max(ts) FROM series) - INTERVAL 24 HOUR",
)
put(
    "row_gaps",
    f"SELECT series_key, event_id, {r6(f'(epoch_us(ts) - lag(epoch_us(ts)) OVER ({ORDER})) / 1e6', 'gap_seconds')} FROM series",
)
put(
    "label_summary",
    f"""SELECT split, count(*)::BIGINT AS n_rows, count(*) FILTER (x IS NULL)::BIGINT AS n_missing, {r6('avg(is_anomaly)', 'label_mean')}
FROM (SELECT *, CASE WHEN row_number() OVER ({ORDER}) <= floor(0.8 * count(*) OVER (PARTITION BY series_key)) THEN 'train' ELSE 'test' END AS split FROM holed)
GROUP BY 1""",
    HOLED,
)

# --- fills, runs, latest -------------------------------------------------------------------------

put(
    "fill_chain",
    f"""SELECT series_key, event_id, coalesce(
  last_value(x IGNORE NULLS) OVER ({ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(x IGNORE NULLS) OVER ({ORDER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS cpu_utilization FROM holed""",
    HOLED,
)
put(
    "fill_chain_nan",
    f"""SELECT series_key, event_id, coalesce(
  last_value(g IGNORE NULLS) OVER ({ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(g IGNORE NULLS) OVER ({ORDER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS cpu_utilization FROM holed""",
    NUMBERED,
    WITH_GAPS,
)
put(
    "run_length",
    """SELECT series_key, event_id, CASE WHEN is_anomaly = 1 THEN row_number() OVER (PARTITION BY series_key, island, is_anomaly ORDER BY rn) ELSE 0 END::BIGINT AS run_length
FROM (SELECT *, sum(1 - is_anomaly) OVER (PARTITION BY series_key ORDER BY rn) AS island FROM numbered)""",
    NUMBERED,
)
RUNS = """hot AS (SELECT *, (x > 15)::INT AS flag FROM numbered),
 ends AS (SELECT series_key, max(rn) AS top, coalesce(max(rn) FILTER (flag = 0), 0) AS normal FROM hot GROUP BY 1),
 runs AS (SELECT h.series_key, max(ts) AS latest_ts, min(ts) FILTER (rn > normal) AS run_start,
                 count(*) FILTER (rn > normal) AS run_rows FROM hot h JOIN ends USING (series_key) GROUP BY 1)"""
_MINUTES = r6("coalesce((epoch_us(latest_ts) - epoch_us(run_start)) / 6e7, 0)", "run_minutes")
put(
    "current_run",
    f"""SELECT series_key, epoch_us(latest_ts)::DOUBLE AS latest_ts, (run_rows > 0)::INT AS is_anomalous,
  epoch_us(run_start)::DOUBLE AS run_start, run_rows::BIGINT AS run_rows, {_MINUTES} FROM runs""",
    NUMBERED,
    RUNS,
)
put(
    "run_tracker",
    f"SELECT series_key, epoch_us(run_start)::DOUBLE AS run_start, run_rows::BIGINT AS run_rows, {_MINUTES} FROM runs",
    NUMBERED,
    RUNS,
)
put(
    "latest_row",
    "SELECT series_key, event_id, x AS cpu_utilization, is_anomaly::INT AS is_anomaly FROM numbered WHERE rn = n",
    NUMBERED,
)
put(
    "recent_status",
    """SELECT series_key, event_id, CASE WHEN is_anomaly = 0 THEN x END AS status_0, CASE WHEN is_anomaly = 1 THEN x END AS status_1
FROM series WHERE ts >= (SELECT max(ts) FROM series) - INTERVAL 360 MINUTE""",
)
put(
    "union_labels",
    f"""SELECT series_key, event_id, (max((x >= 100 OR x < 1)::INT) OVER ({ORDER} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))::INT AS is_marked FROM series""",
)

# --- detectors -----------------------------------------------------------------------------------

put(
    "zscore_flags",
    f"SELECT series_key, event_id, (abs({Z}) > 1.5)::INT AS z_score_anomaly, {r6(Z, 'z_score')} FROM series JOIN stats USING (series_key)",
    STATS,
)
put(
    "iqr_flags",
    """SELECT event_id, (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1))::INT AS iqr_anomaly
FROM events JOIN (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1) USING (event_type)""",
)
# All pairs of distinct values of a series, straight from the definition of the outlier factor.
LOF = """h AS (SELECT series_key, x, count(*) AS c FROM series GROUP BY 1, 2),
 sizes AS (SELECT series_key, sum(c) AS total FROM h GROUP BY 1),
 pairs AS (SELECT a.series_key, a.x AS v, b.x AS u, b.c - (a.x = b.x)::INT AS c, abs(b.x - a.x) AS d FROM h a JOIN h b USING (series_key)),
 seen AS (SELECT series_key, v, d, sum(c) OVER (PARTITION BY series_key, v ORDER BY d RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS within FROM pairs),
 kd AS (SELECT series_key, v, min(d) AS kdist FROM seen JOIN sizes USING (series_key) WHERE within >= least(20, total - 1) GROUP BY 1, 2),
 near AS (SELECT p.series_key, p.v, p.u, p.c, greatest(p.d, o.kdist) AS reach
          FROM pairs p JOIN kd k ON k.series_key = p.series_key AND k.v = p.v AND p.d <= k.kdist
          JOIN kd o ON o.series_key = p.series_key AND o.v = p.u),
 lrd AS (SELECT series_key, v, 1 / (sum(c * reach) / sum(c) + 1e-10) AS lrd FROM near GROUP BY 1, 2),
 lof AS (SELECT n.series_key, n.v, round(-(sum(n.c * o.lrd) / sum(n.c) / any_value(m.lrd)), 9) AS score
         FROM near n JOIN lrd o ON o.series_key = n.series_key AND o.v = n.u
         JOIN lrd m ON m.series_key = n.series_key AND m.v = n.v GROUP BY 1, 2),
 scored AS (SELECT s.*, score FROM series s JOIN lof ON lof.series_key = s.series_key AND lof.v = s.x),
 cut AS (SELECT series_key, quantile_cont(score, 0.1) AS cut FROM scored GROUP BY 1),
 flagged AS (SELECT scored.*, (score < cut)::INT AS lof_anomaly FROM scored JOIN cut USING (series_key))"""
put("lof_flags", "SELECT series_key, event_id, lof_anomaly FROM flagged", LOF)
# The published algorithm on the same draws: 100 trees of 256 rows, grown level by level.
TREES, SAMPLE = 100, 256
DRAW = "('0x' || substr(md5({}), 1, 13))::BIGINT"


def usual_path(n: str) -> str:
    return f"(CASE WHEN {n} <= 1 THEN 0.0 WHEN {n} = 2 THEN 1.0 ELSE 2 * (ln({n} - 1.0) + 0.5772156649015329) - 2 * ({n} - 1.0) / {n} END)"


def levels(count: int = 8) -> list[str]:
    own = DRAW.format("series_key || '-42-' || t || '-n' || node")
    out = ["level0 AS (SELECT series_key, t, x, 1 AS node, -1e300::DOUBLE AS low, lim FROM sampled)"]
    for d in range(count + 1):
        out.append(
            f"""nodes{d} AS (SELECT series_key, t, node, lim, low, min(x) AS a, max(x) AS b, count(*) AS m,
  min(x) + {own} / power(2, 52) * (max(x) - min(x)) AS thr FROM level{d} GROUP BY series_key, t, node, lim, low)"""
        )
        out.append(
            f"""level{d + 1} AS (SELECT series_key, t, x, 2 * node + (x > thr)::INT AS node, CASE WHEN x > thr THEN thr ELSE n.low END AS low, lim
  FROM level{d} JOIN (SELECT series_key, t, node, low, thr FROM nodes{d} WHERE a < b AND lim > {d}) n USING (series_key, t, node))"""
        )
    leaves = " UNION ALL ".join(
        f"SELECT series_key, t, a, low, {d} + {usual_path('m')} AS len FROM nodes{d} WHERE a = b OR lim <= {d}" for d in range(count + 1)
    )
    return [*out, f"tips AS ({leaves})"]


ISOLATION = [
    "iso_h AS (SELECT series_key, x, count(*) AS c FROM series GROUP BY 1, 2)",
    "iso_sizes AS (SELECT series_key, sum(c)::BIGINT AS total FROM iso_h GROUP BY 1)",
    "placed AS (SELECT series_key, x, row_number() OVER (PARTITION BY series_key ORDER BY x) - 1 AS pos FROM series)",
    f"""draws AS (SELECT series_key, t, i, CASE WHEN total <= {SAMPLE} THEN i ELSE {DRAW.format("series_key || '-42-' || t || '-p' || i")} % total END AS pos
  FROM iso_sizes, (SELECT unnest(generate_series(0, {TREES - 1})) AS t), (SELECT unnest(generate_series(0, 1023)) AS i) WHERE total > {SAMPLE} OR i < total)""",
    f"""picked AS (SELECT series_key, t, pos FROM (SELECT series_key, t, pos, row_number() OVER (PARTITION BY series_key, t ORDER BY min(i)) AS place
  FROM draws GROUP BY series_key, t, pos) WHERE place <= {SAMPLE})""",
    f"""sampled AS (SELECT series_key, t, x, ceil(log2(greatest(least(total, {SAMPLE}), 2))) AS lim
  FROM picked JOIN placed USING (series_key, pos) JOIN iso_sizes USING (series_key))""",
    *levels(),
    "marks AS (SELECT series_key, low, len - coalesce(lag(len) OVER (PARTITION BY series_key, t ORDER BY a), 0) AS step FROM tips)",
    """swept AS (SELECT series_key, x, kind, sum(step) OVER (PARTITION BY series_key ORDER BY x, kind) AS path
  FROM (SELECT series_key, x, 0 AS kind, 0.0::DOUBLE AS step FROM iso_h UNION ALL SELECT series_key, low, 1, step FROM marks))""",
    f"""iso_scored AS (SELECT s.series_key, s.event_id, s.x, round(-power(2.0, -(path / {TREES}.0 / {usual_path(f'least(total, {SAMPLE})')})), 9) AS score
  FROM series s JOIN swept USING (series_key, x) JOIN iso_sizes USING (series_key) WHERE kind = 0)""",
    "iso_cut AS (SELECT series_key, quantile_cont(score, 0.1) AS cut FROM iso_scored GROUP BY 1)",
    "isolated AS (SELECT series_key, event_id, (score < cut)::INT AS iso_forest_anomaly FROM iso_scored JOIN iso_cut USING (series_key))",
]
put("isolation_flags", "SELECT series_key, event_id, iso_forest_anomaly FROM isolated", *ISOLATION)
put(
    "consensus",
    """SELECT series_key, event_id, (is_anomaly + (x > 80)::INT + (x > 90)::INT + (x < 10)::INT)::INT AS algorithm_consensus,
  (is_anomaly + (x > 80)::INT + (x > 90)::INT + (x < 10)::INT >= 2)::INT AS algorithm_agreement FROM series""",
)
put(
    "interaction_products",
    f"SELECT series_key, event_id, {r6(f'lof_anomaly * {Z}', 'lof_x_zscore')} FROM flagged JOIN stats USING (series_key)",
    STATS,
    LOF,
)
_ALL = {
    "cpu_normalized": NORMAL,
    "cpu_rank": RANK,
    "cpu_deviation_from_mean": Z,
    "cpu_deviation_hourly": HOURLY,
    "cpu_deviation_daily": DAILY,
    "is_high_usage": "(x > 80)::INT",
    "is_very_high_usage": "(x > 90)::INT",
    "is_low_usage": "(x < 10)::INT",
    **{n: e for w in (5, 15, 30, 60) for n, e in rolling_columns(w, True, f"w{w}").items()},
    "hour": "hour(ts)",
    "weekday": "isodow(ts) - 1",
    "minute": "minute(ts)",
    "is_weekend": "(isodow(ts) >= 6)::INT",
    "is_business_hour": "(hour(ts) BETWEEN 9 AND 17)::INT",
    "is_peak_hour": "(hour(ts) BETWEEN 10 AND 16)::INT",
    "lof_anomaly": "lof_anomaly",
    "z_score": Z,
    "z_score_anomaly": f"(abs({Z}) > 3)::INT",
    "iqr_anomaly": "(x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1))::INT",
    "lof_x_zscore": f"lof_anomaly * {Z}",
    **{f"high_usage_streak_{n}": f"sum((x > 80)::INT) OVER {frame(n)}" for n in (3, 5, 10)},
    **{f"{w}min_cv": f"coalesce(stddev_samp(x) OVER w{w}, 0) / (avg(x) OVER w{w} + 1e-8)" for w in (15, 30, 60)},
}
_VOTES = f"(iso_forest_anomaly + lof_anomaly + {_ALL['z_score_anomaly']} + {_ALL['iqr_anomaly']})"
_ALL |= {
    "iso_forest_anomaly": "iso_forest_anomaly",
    "algorithm_consensus": _VOTES,
    "algorithm_agreement": f"({_VOTES} >= 2)::INT",
    "iso_x_deviation": f"iso_forest_anomaly * {Z}",
    **{f"anomaly_streak_{n}": f"sum(({_VOTES} >= 2)::INT) OVER {frame(n)}" for n in (3, 5, 10)},
}
_BASE = f"""base AS (SELECT f.*, iso_forest_anomaly, lo, hi, mean, sd, q1, q3, row_number() OVER ({ORDER}) AS rn
  FROM flagged f JOIN stats USING (series_key) JOIN isolated USING (series_key, event_id))"""
for _name in ("all_features", "all_features_exact"):
    put(
        _name,
        f"SELECT series_key, event_id, {listed(_ALL)} FROM base WINDOW " + ", ".join(f"w{w} AS {frame(w)}" for w in (5, 15, 30, 60)),
        STATS,
        LOF,
        *ISOLATION,
        _BASE,
    )

# --- splits, weights, scaling --------------------------------------------------------------------

HASHED = """hashed AS (
  SELECT *, row_number() OVER (PARTITION BY is_anomaly ORDER BY md5(series_key || '-' || event_id || '-42'), series_key, event_id) AS hn,
         count(*) OVER (PARTITION BY is_anomaly) AS hc FROM series)"""
put(
    "stratified_split",
    "SELECT series_key, event_id, is_anomaly::INT AS is_anomaly, CASE WHEN hn <= round(0.2 * hc) THEN 'test' ELSE 'train' END AS split FROM hashed",
    HASHED,
)
put("folds", "SELECT series_key, event_id, ((hn - 1) % 3)::INT AS fold FROM hashed", HASHED)
put("chrono_split", "SELECT series_key, event_id, CASE WHEN rn <= floor(0.8 * n) THEN 'train' ELSE 'test' END AS split FROM numbered", NUMBERED)
put(
    "class_weights",
    f"SELECT is_anomaly::INT AS is_anomaly, count(*)::BIGINT AS n, {r6('(SELECT count(*) FROM series) / ((SELECT count(DISTINCT is_anomaly) FROM series) * count(*))', 'weight')} FROM series GROUP BY 1",
)
put(
    "scaled",
    f"""SELECT series_key, event_id, {r6('(x - (SELECT avg(x) FROM series)) / (SELECT stddev_pop(x) FROM series)', 'cpu_utilization')},
  {r6('(hour(ts) - (SELECT avg(hour(ts)) FROM series)) / (SELECT stddev_pop(hour(ts)) FROM series)', 'hour')}, {r6('0', 'constant')} FROM series""",
)
put("threshold_predictions", "SELECT series_key, event_id, (x / 100 >= 0.8)::INT AS prediction FROM series")

# --- evaluation ----------------------------------------------------------------------------------

SCORES = "scores AS (SELECT series_key, event_id, is_anomaly AS y, x / 100 AS p, (x / 100 >= 0.8)::INT AS f FROM series)"
CELLS = """cells AS (SELECT count(*) FILTER (y = 0 AND f = 0) AS tn, count(*) FILTER (y = 0 AND f = 1) AS fp,
  count(*) FILTER (y = 1 AND f = 0) AS fn, count(*) FILTER (y = 1 AND f = 1) AS tp FROM scores)"""
put("confusion", "SELECT tn::BIGINT AS tn, fp::BIGINT AS fp, fn::BIGINT AS fn, tp::BIGINT AS tp FROM cells", SCORES, CELLS)
put(
    "class_report",
    f"""SELECT class, support::BIGINT AS support, {r6('precision', 'precision')}, {r6('recall', 'recall')}, {r6('f1', 'f1')} FROM (
  SELECT * FROM per_class
  UNION ALL SELECT 'accuracy', tp + tn + fp + fn, (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn) FROM cells
  UNION ALL SELECT 'macro avg', sum(support), avg(precision), avg(recall), avg(f1) FROM per_class
  UNION ALL SELECT 'weighted avg', sum(support), sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support) FROM per_class)""",
    SCORES,
    CELLS,
    """per_class AS (
  SELECT '0' AS class, tn + fp AS support, coalesce(tn / nullif(tn + fn, 0), 0) AS precision, coalesce(tn / nullif(tn + fp, 0), 0) AS recall, coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0) AS f1 FROM cells
  UNION ALL SELECT '1', tp + fn, coalesce(tp / nullif(tp + fp, 0), 0), coalesce(tp / nullif(tp + fn, 0), 0), coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) FROM cells)""",
)
put("accuracy", f"SELECT {r6('avg((y = f)::INT)', 'accuracy')} FROM scores", SCORES)
CURVE = """curve AS (
  SELECT p, sum(sum(y)) OVER (ORDER BY p DESC) AS tp, sum(sum(1 - y)) OVER (ORDER BY p DESC) AS fp FROM scores GROUP BY p),
 totals AS (SELECT sum(y) AS pos, sum(1 - y) AS neg FROM scores)"""
put(
    "roc_curve",
    f"SELECT {r6('p', 'threshold')}, {r6('fp / neg', 'fpr')}, {r6('tp / pos', 'tpr')} FROM curve, totals",
    SCORES,
    CURVE,
)
put(
    "roc_auc",
    f"""SELECT {r6('sum(wins) / (any_value(pos) * any_value(neg))', 'roc_auc')} FROM (
  SELECT y * (rank() OVER (ORDER BY p) - 1 + (count(*) OVER (PARTITION BY p) - 1) / 2.0 + 1) AS wins FROM scores
  UNION ALL SELECT -pos * (pos + 1) / 2 FROM totals), totals""",
    SCORES,
    CURVE,
)
put(
    "pr_curve",
    f"SELECT {r6('p', 'threshold')}, {r6('tp / (tp + fp)', 'precision')}, {r6('tp / pos', 'recall')} FROM curve, totals",
    SCORES,
    CURVE,
)
put(
    "pr_auc",
    f"""SELECT {r6('sum((r - r0) * (q + q0) / 2)', 'pr_auc')} FROM (
  SELECT r, q, lag(r, 1, 0.0) OVER (ORDER BY p DESC) AS r0, lag(q, 1, 1.0) OVER (ORDER BY p DESC) AS q0
  FROM (SELECT p, tp / pos AS r, tp / (tp + fp) AS q FROM curve, totals))""",
    SCORES,
    CURVE,
)
# --- one tree --------------------------------------------------------------------------------------


def gini(a: str, b: str) -> str:
    return f"(1 - (power({a}, 2) + power({b}, 2)) / power({a} + {b}, 2))"


def split_nodes(name: str, rows: str, by: str, features: list[str], least: int) -> list[str]:
    """CTEs that end in `name`: the best split (f, thr, gain, w) of every node of `rows`, nodes told apart by `by`."""
    cells = " UNION ALL ".join(
        f"SELECT {by}, {i} AS f, {c}::DOUBLE AS v, sum(wt * (1 - y)) AS w0, sum(wt * y) AS w1, count(*) AS n FROM {rows} GROUP BY {by}, {c}"
        for i, c in enumerate(features)
    )
    left, right, whole = ("l0", "l1"), ("(t0 - l0)", "(t1 - l1)"), ("t0", "t1")
    share = lambda s: f"({s[0]} + {s[1]}) / (t0 + t1) * {gini(*s)}"
    return [
        f"{name}_cells AS ({cells})",
        f"""{name}_runs AS (SELECT {by}, f, v, lead(v) OVER c AS nv, sum(w0) OVER c AS l0, sum(w1) OVER c AS l1, sum(n) OVER c AS ln,
  sum(w0) OVER t AS t0, sum(w1) OVER t AS t1, sum(n) OVER t AS tn FROM {name}_cells
  WINDOW c AS (PARTITION BY {by}, f ORDER BY v), t AS (PARTITION BY {by}, f))""",
        f"""{name}_gains AS (SELECT {by}, f, (v + nv) / 2 AS thr, t0 + t1 AS w, {gini(*whole)} - {share(left)} - {share(right)} AS gain
  FROM {name}_runs WHERE nv IS NOT NULL AND ln >= {least} AND tn - ln >= {least})""",
        f"""{name} AS (SELECT {by}, f, thr, gain, w FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY round(gain, 12) DESC, f, thr) AS best FROM {name}_gains)
  WHERE best = 1 AND gain > 1e-9)""",
    ]


def tree(features: list[str], least: int = 1, deep: str = "true") -> list[str]:
    """CTEs from `fit` (k, y, wt, features) and `app` (k, features, more) to `scored`: app with the share p of class 1.

    Each k is a fit of its own, two levels deep where `deep` holds and else one. Leaves of one parent that predict the
    same class are one leaf.
    """
    goes = lambda t: f"(CASE {t}.f " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(features)) + f" END > {t}.thr)::INT"
    share = "sum(wt * y) / sum(wt) AS p"
    return [
        *split_nodes("root", "fit", "k", features, least),
        f"below AS (SELECT fit.*, {goes('root')} AS side FROM fit JOIN root USING (k))",
        *split_nodes("child", "below", "k, side", features, least),
        f"leaves AS (SELECT below.*, {goes('child')} AS side2 FROM below JOIN child USING (k, side))",
        f"share0 AS (SELECT k, {share} FROM fit GROUP BY k)",
        f"share1 AS (SELECT k, side, {share} FROM below GROUP BY k, side)",
        f"share2 AS (SELECT k, side, side2, {share} FROM leaves GROUP BY k, side, side2)",
        f"""split2 AS (SELECT child.* FROM child JOIN (SELECT k, side FROM share2 GROUP BY k, side HAVING count(DISTINCT p > 0.5) = 2) USING (k, side)
  WHERE {deep})""",
        """split1 AS (SELECT * FROM root WHERE k IN (SELECT k FROM split2)
  OR k IN (SELECT k FROM share1 GROUP BY k HAVING count(DISTINCT p > 0.5) = 2))""",
        f"app1 AS (SELECT app.*, {goes('split1')} AS side FROM app LEFT JOIN split1 USING (k))",
        f"app2 AS (SELECT app1.*, {goes('split2')} AS side2 FROM app1 LEFT JOIN split2 USING (k, side))",
        """scored AS (SELECT app2.*, coalesce(share2.p, share1.p, share0.p) AS p FROM app2 JOIN share0 USING (k)
  LEFT JOIN share1 USING (k, side) LEFT JOIN share2 USING (k, side, side2))""",
        "cells AS (SELECT k, count(*) FILTER (y = 1 AND p > 0.5) AS tp, count(*) FILTER (y = 0 AND p > 0.5) AS fp, count(*) FILTER (y = 1 AND p <= 0.5) AS fn, "
        "count(*) FILTER (y = 0 AND p <= 0.5) AS tn FROM scored GROUP BY k)",
        "f1s AS (SELECT k, CASE WHEN tp = 0 THEN 0 ELSE 2 * tp / (2.0 * tp + fp + fn) END AS f1 FROM cells)",
    ]


TREE_FEATURES = ["band", "last_digit", "hour", "weekday"]
TREE_ROWS = """points AS (
  SELECT series_key, event_id, is_anomaly AS y, least(floor(x / 40), 2) AS band, floor(x) % 10 AS last_digit, hour(ts) AS hour, isodow(ts) - 1 AS weekday,
         hc, (hn - 1) % 3 AS fold, (SELECT count(*) FROM series) / ((SELECT count(DISTINCT is_anomaly) FROM series) * hc::DOUBLE) AS wt FROM hashed)"""
WHOLE = [HASHED, TREE_ROWS, "fit AS (SELECT 0 AS k, * FROM points)", "app AS (SELECT 0 AS k, * FROM points)", *tree(TREE_FEATURES)]
put("tree_scores", f"SELECT series_key, event_id, (p >= 0.75)::INT AS prediction, {r6('p', 'probability')} FROM scored", *WHOLE)
IMPORTANCE = """gains AS (SELECT f, sum(gain * w) AS gain FROM (SELECT k, f, gain, w FROM split1 UNION ALL SELECT k, f, gain, w FROM split2) GROUP BY f)"""
put(
    "tree_importance",
    f"""SELECT feature, {r6('coalesce(gain / (SELECT sum(gain) FROM gains), 0)', 'importance')}
FROM (SELECT unnest({TREE_FEATURES}) AS feature, unnest([0, 1, 2, 3]) AS f) LEFT JOIN gains USING (f) ORDER BY gain DESC NULLS LAST, feature LIMIT 2""",
    *WHOLE,
    IMPORTANCE,
)
BY_FOLD = [
    HASHED,
    TREE_ROWS,
    "ks AS (SELECT unnest([0, 1, 2]) AS k)",
    "fit AS (SELECT k, points.* FROM points JOIN ks ON fold <> k)",
    "app AS (SELECT fold AS k, * FROM points)",
    *tree(TREE_FEATURES),
]
put("tree_cv_f1", f"SELECT k::INT AS fold, {r6('f1', 'f1')} FROM f1s", *BY_FOLD)
put("tree_cv_summary", f"SELECT {r6('avg(f1)', 'cv_mean')}, {r6('2 * stddev_pop(f1)', 'cv_spread')} FROM f1s", *BY_FOLD)
put(
    "tree_search",
    f"SELECT (k // 10)::INT AS maxDepth, 2 AS minInstancesPerNode, {r6('avg(f1)', 'f1_mean')}, {r6('stddev_pop(f1)', 'f1_std')} FROM f1s GROUP BY 1",
    HASHED,
    TREE_ROWS,
    "ks AS (SELECT unnest([10, 11, 12, 20, 21, 22]) AS k)",
    "fit AS (SELECT k, points.* FROM points JOIN ks ON fold <> k % 10)",
    "app AS (SELECT k, points.* FROM points JOIN ks ON fold = k % 10)",
    *tree(TREE_FEATURES, 2, "k >= 20"),
)

TRAIN_FEATURES = ["hour", "weekday", "is_high_usage", "high_usage_streak_3", "high_usage_streak_10"]


def training(rows: str) -> list[str]:
    """CTEs from `rows` to `dealt`: their features, split, fold inside the training part, and class weight there."""
    by_hash = "PARTITION BY is_anomaly ORDER BY md5(series_key || '-' || ts::VARCHAR || '-' || event_id || '-42'), series_key, ts, event_id"
    return [
        "ready AS (SELECT series_key, ts, event_id, is_anomaly, hour(ts) AS hour, isodow(ts) - 1 AS weekday, (x > 80)::INT AS is_high_usage, "
        + ", ".join(f"sum((x > 80)::INT) OVER {frame(n)} AS high_usage_streak_{n}" for n in (3, 10)) + f" FROM {rows})",
        f"cut AS (SELECT *, row_number() OVER ({by_hash}) > round(0.2 * count(*) OVER (PARTITION BY is_anomaly)) AS train FROM ready)",
        f"""dealt AS (SELECT *, is_anomaly AS y, (row_number() OVER ({by_hash.replace('is_anomaly', 'train, is_anomaly', 1)}) - 1) % 3 AS fold,
  count(*) OVER (PARTITION BY train) / (2.0 * count(*) OVER (PARTITION BY train, is_anomaly)) AS wt FROM cut)""",
    ]


put(
    "tree_history",
    f"""SELECT (SELECT count(*) FROM cut WHERE train)::BIGINT AS train_size, (SELECT count(*) FROM cut WHERE NOT train)::BIGINT AS test_size,
  count(*) FILTER (y = 0 AND p < 0.5)::BIGINT AS tn, count(*) FILTER (y = 0 AND p >= 0.5)::BIGINT AS fp,
  count(*) FILTER (y = 1 AND p < 0.5)::BIGINT AS fn, count(*) FILTER (y = 1 AND p >= 0.5)::BIGINT AS tp,
  (SELECT {TRAIN_FEATURES}[f + 1] FROM (SELECT f, gain, w FROM split1 WHERE k = (SELECT d * 10 + 9 FROM winner)
     UNION ALL SELECT f, gain, w FROM split2 WHERE k = (SELECT d * 10 + 9 FROM winner)) GROUP BY f ORDER BY sum(gain * w) DESC LIMIT 1) AS top_feature,
  (SELECT d FROM winner)::INT AS best_depth, {r6('(SELECT avg(is_anomaly) FROM cut)', 'anomaly_ratio')},
  {r6('(SELECT any_value(wt) FROM dealt WHERE train AND y = 0)', 'weight_0')}, {r6('(SELECT any_value(wt) FROM dealt WHERE train AND y = 1)', 'weight_1')},
  {r6('(SELECT m FROM winner)', 'best_cv_score')}, {r6('(SELECT s FROM winner)', 'cv_f1_std')},
  {r6('(SELECT sum(wins) / (any_value(pos) * any_value(neg)) FROM (SELECT y * (rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0) AS wins FROM scores UNION ALL SELECT -pos * (pos + 1) / 2 FROM totals), totals)', 'test_roc_auc')},
  {r6('(SELECT sum((r - r0) * (q + q0) / 2) FROM (SELECT r, q, lag(r, 1, 0.0) OVER (ORDER BY p DESC) AS r0, lag(q, 1, 1.0) OVER (ORDER BY p DESC) AS q0 FROM (SELECT p, tp / pos AS r, tp / (tp + fp) AS q FROM curve, totals)))', 'test_pr_auc')}
FROM scores""",
    *training("series"),
    "ks AS (SELECT unnest([10, 11, 12, 19, 20, 21, 22, 29]) AS k)",
    "fit AS (SELECT k, dealt.* FROM dealt JOIN ks ON fold <> k % 10 WHERE train)",
    "app AS (SELECT k, dealt.* FROM dealt JOIN ks ON CASE WHEN train THEN fold = k % 10 ELSE k % 10 = 9 END)",
    *tree(TRAIN_FEATURES, 2, "k >= 20"),
    "winner AS (SELECT k // 10 AS d, avg(f1) AS m, stddev_pop(f1) AS s FROM f1s WHERE k % 10 < 3 GROUP BY 1 ORDER BY round(avg(f1), 9) DESC, 1 LIMIT 1)",
    "scores AS (SELECT y, round(p, 12) AS p FROM scored WHERE k = (SELECT d * 10 + 9 FROM winner))",
    CURVE,
)
put(
    "tree_reload",
    f"SELECT series_key, event_id, (p >= 0.75)::INT AS prediction, 0 AS n_missing_features, {r6('p', 'probability')} FROM scored",
    NUMBERED,
    "early AS (SELECT * FROM numbered WHERE rn <= floor(0.8 * n))",
    "late AS (SELECT * FROM numbered WHERE rn > floor(0.8 * n))",
    *training("early"),
    "fit AS (SELECT 0 AS k, * FROM dealt WHERE train)",
    training("late")[0].replace("ready", "fresh", 1),
    "app AS (SELECT 0 AS k, is_anomaly AS y, * FROM fresh)",
    *tree(TRAIN_FEATURES),
)

# Newton steps of the penalised regression on one feature, over its levels: (a, b) is the constant and the slope.
P = "(1 / (1 + exp(-(a + b * s))))"
STEP = f"""SELECT a - (g0 * (h11 + 1) - g1 * h01) / (h00 * (h11 + 1) - h01 * h01) AS a, b - (g1 * h00 - g0 * h01) / (h00 * (h11 + 1) - h01 * h01) AS b
  FROM (SELECT any_value(a) AS a, any_value(b) AS b, sum(n * {P} - n1) AS g0, sum(s * (n * {P} - n1)) + any_value(b) AS g1,
          sum(n * {P} * (1 - {P})) AS h00, sum(n * s * {P} * (1 - {P})) AS h01, sum(n * s * s * {P} * (1 - {P})) AS h11 FROM levels, """
put(
    "logistic_levels",
    f"SELECT s::BIGINT AS high_usage_streak_10, ({P} >= 0.5)::INT AS prediction, n::BIGINT AS n, {r6(P, 'probability')} FROM levels, newton12",
    f"streaks AS (SELECT is_anomaly, sum((x > 80)::INT) OVER {frame(10)} AS s FROM series)",
    "levels AS (SELECT s::DOUBLE AS s, count(*)::DOUBLE AS n, sum(is_anomaly)::DOUBLE AS n1 FROM streaks GROUP BY 1)",
    "newton0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b)",
    *[f"newton{i + 1} AS MATERIALIZED ({STEP} newton{i}))" for i in range(12)],
)

# --- predictions ---------------------------------------------------------------------------------

put(
    "prediction_summary",
    f"SELECT sum(f)::BIGINT AS anomaly_count, count(*)::BIGINT AS total_count, {r6('avg(f)', 'anomaly_ratio')} FROM scores",
    SCORES,
)
put(
    "probability_range",
    f"SELECT count(*) FILTER (p < 0.8 AND f = 1)::BIGINT AS n_below_threshold, {r6('min(p)', 'min_probability')}, {r6('max(p)', 'max_probability')} FROM scores",
    SCORES,
)

# --- files and exchange formats ------------------------------------------------------------------

put(
    "csv_roundtrip",
    'SELECT series_key, floor(epoch(ts))::BIGINT AS "timestamp", x AS cpu_utilization, is_anomaly::INT AS is_anomaly FROM series',
)
DAMAGED = """cells AS (
  SELECT event_id, CASE WHEN event_id % 53 = 0 THEN 'soon' ELSE floor(epoch(ts))::BIGINT::VARCHAR END AS t, event_id % 307 = 0 AS short,
    CASE WHEN event_id % 97 = 0 THEN 'n/a' WHEN event_id % 89 = 0 THEN '' ELSE x::VARCHAR END AS v,
    CASE WHEN event_id % 211 = 0 THEN 'maybe' ELSE is_anomaly::VARCHAR END AS y FROM series),
lost AS (
  SELECT event_id, CASE WHEN t = 'soon' THEN t END AS timestamp_text, CASE WHEN NOT short AND v = 'n/a' THEN v END AS cpu_utilization_text,
    CASE WHEN NOT short AND y = 'maybe' THEN y END AS is_anomaly_text, CASE WHEN short THEN event_id || ',' || t END AS _line_text FROM cells),
bad AS (SELECT * FROM lost WHERE coalesce(timestamp_text, cpu_utilization_text, is_anomaly_text, _line_text) IS NOT NULL)"""
put(
    "dirty_header",
    "SELECT event_id, coalesce(try_cast(t AS BIGINT), -1) AS \"timestamp\", CASE WHEN NOT short THEN try_cast(v AS DOUBLE) END AS cpu_utilization, "
    "CASE WHEN short THEN -1 ELSE coalesce(try_cast(y AS INT), -1) END AS is_anomaly FROM cells",
    DAMAGED,
)
put("csv_rescued", "SELECT * FROM bad", DAMAGED)
put(
    "csv_rescue_report",
    """SELECT k AS "column", n::BIGINT AS n_cells, (SELECT count(*) FROM cells)::BIGINT AS n_rows, (SELECT count(*) FROM bad)::BIGINT AS n_rescued FROM (
  SELECT NULL AS k, count(*) AS n FROM bad UNION ALL SELECT 'timestamp', count(timestamp_text) FROM bad
  UNION ALL SELECT 'cpu_utilization', count(cpu_utilization_text) FROM bad UNION ALL SELECT 'is_anomaly', count(is_anomaly_text) FROM bad
  UNION ALL SELECT '_line', count(_line_text) FROM bad) WHERE k IS NULL OR n > 0""",
    DAMAGED,
)
put("two_column_csv", 'SELECT floor(epoch(ts))::BIGINT AS "timestamp", x AS cpu_utilization FROM series')
put(
    "range_json",
    "SELECT 'host_name=' || series_key AS series_key, floor(epoch(ts))::BIGINT AS \"timestamp\", x AS cpu_utilization FROM series",
)
_LINE = "'cpu_usage{status=\"' || %s || '\",series_key=\"' || series_key || '\"} ' || x::VARCHAR || ' ' || (floor(epoch(ts))::BIGINT * 1000)::VARCHAR AS value"
put("exposition_lines", f"SELECT {_LINE % 'is_anomaly'} FROM series")

# --- streams -------------------------------------------------------------------------------------

LIVE = f"""recent AS (SELECT * FROM series WHERE ts >= (SELECT max(ts) FROM series) - INTERVAL 12 HOUR),
 live AS (SELECT *, avg(x) OVER {frame(5)} / 100 AS p, row_number() OVER (PARTITION BY series_key ORDER BY ts DESC, event_id DESC) AS back FROM recent)"""
put(
    "stream_live_score",
    f"SELECT series_key, event_id, x AS cpu_utilization, (p >= 0.4)::INT AS prediction, {r6('p', 'probability')} FROM live WHERE back = 1",
    LIVE,
)
put("status_write_back", f"SELECT {_LINE % '(p >= 0.4)::INT'} FROM live WHERE back = 1", LIVE)
put(
    "counter_rate",
    f"""SELECT host_name, window_start, {r6('(1 - avg(rate)) * 100', 'utilization')} FROM (
  SELECT host_name, cpu, floor(epoch(date_trunc('hour', ts)))::BIGINT AS window_start, sum(up) / sum(dt) AS rate FROM (
    SELECT *, CASE WHEN c < c0 THEN c ELSE c - c0 END AS up, (epoch_us(ts) - epoch_us(t0)) / 1e6 AS dt FROM (
      SELECT *, lag(c) OVER w AS c0, lag(ts) OVER w AS t0 FROM (
        SELECT event_type AS host_name, user_id % 2 AS cpu, ts, event_id,
               round(sum(value / 100) OVER (PARTITION BY event_type, user_id % 2 ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 4) % 50 AS c FROM events)
      WINDOW w AS (PARTITION BY host_name, cpu ORDER BY ts, event_id))
    WHERE c0 IS NOT NULL) GROUP BY 1, 2, 3) GROUP BY 1, 2""",
)
SAMPLES = """counted AS (
  SELECT event_type AS host_name, user_id % 2 AS cpu, epoch_us(ts) AS us, row_number() OVER w AS rn,
         round(sum(value / 100) OVER w, 4) % 50 AS c FROM events
  WINDOW w AS (PARTITION BY event_type, user_id % 2 ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
risen AS (
  SELECT *, CASE WHEN c < c0 THEN c ELSE c - c0 END AS up FROM (
    SELECT *, lag(c) OVER (PARTITION BY host_name, cpu ORDER BY rn) AS c0 FROM counted)),
steps AS (SELECT unnest(generate_series(low, high)) AS k FROM (
  SELECT ceil(min(us) / 1800e6)::BIGINT AS low, floor(max(us) / 1800e6)::BIGINT AS high FROM risen)),
ranges AS (
  SELECT host_name, cpu, k, count(*) AS n, sum(up) - coalesce(arg_min(coalesce(up, 0), rn), 0) AS inc, (max(us) - min(us)) / 1e6 AS dt,
         arg_min(c, rn) AS c1, (min(us) - (k * 1800e6 - 7200e6)) / 1e6 AS l, (k * 1800e6 - max(us)) / 1e6 AS r
  FROM risen JOIN steps ON us > k * 1800000000 - 7200000000 AND us <= k * 1800000000 GROUP BY host_name, cpu, k HAVING count(*) > 1),
sides AS (
  SELECT *, CASE WHEN l >= dt / (n - 1) * 1.1 THEN dt / (n - 1) / 2 ELSE l END AS left_side,
         CASE WHEN r >= dt / (n - 1) * 1.1 THEN dt / (n - 1) / 2 ELSE r END AS right_side FROM ranges)"""
_FROM_ZERO = "CASE WHEN inc > 0 AND c1 >= 0 THEN least(left_side, dt * c1 / inc) ELSE left_side END"
for name, rate in (
    ("counter_rate_stepped", f"inc * (dt + {_FROM_ZERO} + right_side) / dt / 7200"),
    ("counter_rate_between", "inc / dt"),
):
    put(name, f"SELECT host_name, k * 1800 AS step_at, {r6(f'(1 - avg({rate})) * 100', 'utilization')} FROM sides GROUP BY 1, 2", SAMPLES)


def lookback(step: int, seconds: int, value: str, source: str, low: str, high: str) -> tuple[str, str]:
    """The body and its CTE: the newest value at or before every step."""
    seen = f"""seen AS (SELECT series_key, epoch_us(ts) AS us, arg_max({value}, event_id) AS x FROM {source} WHERE {value} IS NOT NULL GROUP BY 1, 2),
steps AS (SELECT series_key, unnest(generate_series(ceil({low} / {step}e6)::BIGINT, floor({high} / {step}e6)::BIGINT)) AS k FROM seen GROUP BY 1)"""
    if "min(" in low:
        seen = seen.replace(low, f"(SELECT {low} FROM seen)").replace(high, f"(SELECT {high} FROM seen)")
    age = f"(k * {step}000000 - us) / 1e6"
    return (
        f"SELECT g.series_key, k * {step} AS step_at, {r6('x', 'cpu_utilization')}, {r6(age, 'age_seconds')} "
        f"FROM steps g ASOF JOIN seen s ON g.series_key = s.series_key AND g.k * {step}000000 >= s.us WHERE {age} < {seconds}",
        seen,
    )


_body, _seen = lookback(30, 300, "x", "series", "min(us)", "max(us)")
put("range_grid_lookback", _body, _seen)
_body, _seen = lookback(3600, 21600, "g", "holed", "epoch_us(TIMESTAMP '2024-01-08')", "epoch_us(TIMESTAMP '2024-01-15')")
put("range_grid_week", _body, NUMBERED, WITH_GAPS, _seen)


def grid(step: int) -> str:
    return f"""points AS (
  SELECT series_key, floor(epoch(ts) / {step})::BIGINT AS slot, arg_max(x, (ts, event_id)) AS x FROM series GROUP BY 1, 2)"""


put("range_grid", "SELECT series_key, slot * 30 AS step_start, x AS cpu_utilization FROM points", grid(30))
put(
    "range_grid_gaps",
    """SELECT g.series_key, g.slot * 300 AS step_start, x AS cpu_utilization FROM (
  SELECT series_key, unnest(generate_series(min(slot), max(slot))) AS slot FROM points GROUP BY 1) g
LEFT JOIN points p ON p.series_key = g.series_key AND p.slot = g.slot""",
    grid(300),
)
put(
    "tumbling_stats",
    f"""SELECT series_key, floor(epoch(date_trunc('hour', ts)))::BIGINT AS window_start, count(*)::BIGINT AS n_rows, {r6('avg(x)', 'mean')},
  {r6('avg((x BETWEEN 0 AND 100)::INT) * 100', 'validity')}, {r6('avg(is_anomaly)', 'anomaly_ratio')} FROM series GROUP BY 1, 2""",
)
put(
    "tumbling_stats_nan",
    f"""SELECT series_key, floor(epoch(date_trunc('hour', ts)))::BIGINT AS window_start, count(*)::BIGINT AS n_rows, {r6('avg(f)', 'mean')},
  {r6('(count(*) - count(*) FILTER (g < 0 OR g > 100)) / count(*) * 100', 'validity')}, {r6('avg(is_anomaly)', 'anomaly_ratio')} FROM holed GROUP BY 1, 2""",
    NUMBERED,
    WITH_GAPS,
)
