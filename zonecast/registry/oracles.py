"""SQL for every query that SQL can express, over the driver's views.

The SQL follows the plain definition (grids are cross joins, windows are BETWEEN joins), so
it checks the Spark plans independently.
"""

from __future__ import annotations

import re

from zonecast.functions.calendar import HOLIDAYS, SEQUENCE_CALENDAR, TABULAR_CALENDAR

Z = "PULocationID"
HOUR, LAST_DAY, MODEL = "TIMESTAMP '2024-01-25 23:00:00'", "TIMESTAMP '2024-01-30 00:00:00'", "'lagmean_1_2_3_24'"
RATIO = "absolute_error / nullif(actual_demand, 0)"


def r(expression: str, name: str) -> str:
    return f"round({expression}, 6) + 0.0 AS {name}"


def bundle(count: str = "num_predictions") -> str:
    return ", ".join([
        f"count(*) AS {count}", r("avg(absolute_error)", "mae"), r("sqrt(avg(squared_error))", "rmse"),
        r(f"avg({RATIO})", "mape_excluding_zero_actuals")])


def lagged(source: str, lags: tuple[int, ...], horizon: int = 1, by: str = Z) -> str:
    columns = ", ".join(f"lag(demand, {lag + horizon - 1}) OVER w AS lag_{lag}" for lag in lags)
    return f"SELECT *, {columns} FROM {source} WINDOW w AS (PARTITION BY {by} ORDER BY hour)"


def grid(source: str) -> str:
    return f"""
      SELECT h.hour, z.{Z}, CAST(coalesce(d.demand, 0) AS DOUBLE) AS demand
      FROM (SELECT unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour FROM {source}) h
      CROSS JOIN (SELECT DISTINCT {Z} FROM {source}) z
      LEFT JOIN {source} d ON d.hour = h.hour AND d.{Z} = z.{Z}"""


def error_rows(actuals: str) -> str:
    return f"""
      SELECT p.forecast_run_timestamp, p.target_timestamp, p.{Z}, CAST(a.demand AS DOUBLE) AS actual_demand,
             p.predicted_demand, p.model_version, p.predicted_demand - a.demand AS raw_error,
             abs(p.predicted_demand - a.demand) AS absolute_error,
             power(p.predicted_demand - a.demand, 2) AS squared_error
      FROM predictions p JOIN {actuals} a
      ON p.target_timestamp = a.hour AND p.{Z} = CAST(a.{Z} AS VARCHAR)"""


def rolling(errors: str, zone: bool = False) -> str:
    key = f"e.{Z}, " if zone else ""
    return f"""
      SELECT CAST(w.s + INTERVAL 167 HOUR AS DATE) AS metric_date, {key}w.s AS window_start_timestamp,
             w.s + INTERVAL 167 HOUR AS window_end_timestamp, e.model_version, {bundle()}
      FROM (SELECT DISTINCT target_timestamp AS s FROM {errors} WHERE hour(target_timestamp) = 0) w
      JOIN {errors} e ON e.target_timestamp BETWEEN w.s AND w.s + INTERVAL 167 HOUR
      WHERE w.s + INTERVAL 167 HOUR <= (SELECT max(target_timestamp) FROM {errors})
      GROUP BY w.s, {key}e.model_version"""


# Rows that the stream of errors gets last, behind all lateness.
TOO_LATE = f"CAST({Z} AS INTEGER) % 10 = 1 AND dayofmonth(target_timestamp) <= 3"


def rolling_of_stream(zone: bool = False) -> str:
    """Windows of the days that are over one hour before the latest error, complete or not."""
    key = f"e.{Z}, " if zone else ""
    return f"""
      SELECT CAST(d.day AS DATE) AS metric_date, {key}d.day - INTERVAL 144 HOUR AS window_start_timestamp,
             d.day + INTERVAL 23 HOUR AS window_end_timestamp, e.model_version, {bundle()}
      FROM (SELECT unnest(generate_series(date_trunc('day', min(target_timestamp)), date_trunc('day', max(target_timestamp) - INTERVAL 1 HOUR) - INTERVAL 1 DAY,
                                          INTERVAL 1 DAY)) AS day FROM errors) d
      JOIN errors e ON e.target_timestamp BETWEEN d.day - INTERVAL 144 HOUR AND d.day + INTERVAL 23 HOUR
      WHERE NOT ({TOO_LATE}) GROUP BY d.day, {key}e.model_version"""


def rolling_at(zone: bool = False) -> str:
    key = f"{Z}, " if zone else ""
    return f"""
      SELECT CAST({HOUR} AS DATE) AS metric_date, {key}{HOUR} - INTERVAL 167 HOUR AS window_start_timestamp,
             {HOUR} AS window_end_timestamp, model_version, {bundle()}
      FROM errors WHERE model_version = {MODEL}
        AND target_timestamp BETWEEN {HOUR} - INTERVAL 167 HOUR AND {HOUR}
      GROUP BY {key}model_version"""


_DAYS = ", ".join(f"DATE '{d}'" for d in HOLIDAYS)


def calendar(stamp: str) -> dict[str, str]:
    dow = f"(isodow({stamp}) - 1)"
    angles = {"hour": f"2 * pi() * hour({stamp}) / 24", "dow": f"2 * pi() * {dow} / 7",
              "month": f"2 * pi() * (month({stamp}) - 1) / 12"}
    columns = {f"{n}_{f}": f"round({f}({a}), 6) + 0.0" for n, a in angles.items() for f in ("sin", "cos")}
    columns["is_weekend"] = f"CAST({dow} >= 5 AS DOUBLE)"
    columns["is_holiday"] = f"CAST(CAST({stamp} AS DATE) IN ({_DAYS}) AS DOUBLE)"
    return columns


def calendar_list(stamp: str, order=TABULAR_CALENDAR) -> str:
    columns = calendar(stamp)
    return ", ".join(f"{columns[name]} AS {name}" for name in order)


def calendar_array(stamp: str, order) -> str:
    columns = calendar(stamp)
    return "[" + ", ".join(columns[name] for name in order) + "]"


def entries(keys: str, columns: dict[str, str], source: str) -> str:
    """Array entries as rows, positions from 0."""
    return " UNION ALL ".join(
        f"SELECT {keys}, '{part}' AS part, CAST(i AS INTEGER) AS position, round(a[i + 1], 6) + 0.0 AS value "
        f"FROM (SELECT {keys}, a, unnest(range(len(a))) AS i FROM (SELECT {keys}, {array} AS a FROM {source}))"
        for part, array in columns.items())


_SPLIT = """CASE WHEN hour < TIMESTAMP '2024-01-21' THEN 'train'
                 WHEN hour < TIMESTAMP '2024-01-26' THEN 'validation' ELSE 'test' END AS split"""
_SCALER = f"""SELECT {Z}, avg(demand) AS mean,
       CASE WHEN min(demand) = max(demand) THEN 1.0 ELSE stddev_pop(demand) END AS scale"""
_CORR = ", ".join(
    f"""CASE WHEN min({c}) <> max({c}) AND min(demand) <> max(demand)
            THEN round(abs(corr({c}, demand)), 6) ELSE 0 END AS {c}"""
    for c in ("lag_1", "lag_2", "lag_3", "lag_24", *TABULAR_CALENDAR))

# Building blocks, in an order where each only uses earlier ones.
BLOCKS = {
    "hourly": f"""
      SELECT date_trunc('hour', ts) AS hour, CAST(user_id AS INTEGER) AS {Z}, count(*) AS demand FROM events
      WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01' AND user_id IS NOT NULL GROUP BY 1, 2""",
    "lookup": """
      SELECT CAST(c_custkey AS INTEGER) AS LocationID, trim(r_name) AS Borough FROM customer
      JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "nation_hourly": f"""
      SELECT hour, c_nationkey AS {Z}, CAST(sum(demand) AS BIGINT) AS demand
      FROM hourly JOIN customer ON {Z} = c_custkey GROUP BY 1, 2""",
    "nation_panel": grid("nation_hourly"),
    "order_days": f"""
      SELECT o_orderdate AS hour, CAST(o_custkey AS INTEGER) AS {Z}, count(*) AS demand FROM orders GROUP BY 1, 2""",
    "panel": grid("hourly"),
    "lagged": lagged("panel", (1, 2, 3, 24)),
    "split_panel": f"SELECT *, {_SPLIT} FROM panel",
    "scaler": f"{_SCALER} FROM split_panel WHERE split = 'train' GROUP BY {Z}",
    "predictions": f"""
      SELECT hour - INTERVAL 1 HOUR AS forecast_run_timestamp, hour AS target_timestamp,
             CAST({Z} AS VARCHAR) AS {Z}, lag_24 AS predicted_demand, 'naive_24' AS model_version
      FROM lagged WHERE lag_24 IS NOT NULL
      UNION ALL
      SELECT hour - INTERVAL 1 HOUR, hour, CAST({Z} AS VARCHAR), (lag_1 + lag_2 + lag_3 + lag_24) / 4,
             'lagmean_1_2_3_24' FROM lagged WHERE lag_24 IS NOT NULL""",
    "errors": error_rows("hourly"),
    "errors_dense": error_rows("panel"),
    "shifted_errors": f"""
      SELECT * REPLACE (target_timestamp + INTERVAL 1 MINUTE * (20 * (CAST({Z} AS INTEGER) % 3)) AS target_timestamp) FROM errors""",
    "compared": f"""
      SELECT * FROM (
        SELECT target_timestamp, {Z}, max(absolute_error) FILTER (model_version = {MODEL}) AS one, max(absolute_error) FILTER (model_version = 'naive_24') AS two
        FROM errors GROUP BY 1, 2) WHERE one IS NOT NULL AND two IS NOT NULL""",
    "compared_days": """
      SELECT metric, CAST(target_timestamp AS DATE) AS day, count(*) AS n, sum(power(one, p)) AS a, sum(power(two, p)) AS b
      FROM compared, (VALUES ('mae', 1), ('mse', 2)) m(metric, p) GROUP BY 1, 2""",
    "replicated": """
      SELECT metric, sum(w * (a - b)) / nullif(sum(w * n), 0) AS difference
      FROM (SELECT *, len([k for k in range(12) if u >= list_sum([exp(-1) / factorial(i::INTEGER) for i in range(k + 1)])]) AS w
            FROM (SELECT *, ('0x' || substr(md5(day || ':' || replicate || ':1'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
                  FROM compared_days, (SELECT unnest(range(1, 201)) AS replicate)))
      GROUP BY metric, replicate""",
    "hour_metrics": f"SELECT model_version, target_timestamp, {bundle('num_zones')} FROM errors GROUP BY 1, 2",
    "day_metrics": f"""
      SELECT model_version, CAST(target_timestamp AS DATE) AS target_date, {bundle()} FROM errors GROUP BY 1, 2""",
    "early_errors": f"SELECT * FROM errors WHERE target_timestamp < {LAST_DAY}",
    "cells": f"""
      SELECT hour AS target_timestamp, {Z} AS zone, (lag_1 + lag_2 + lag_3 + lag_24) / 4 AS predicted,
             demand AS actual, abs((lag_1 + lag_2 + lag_3 + lag_24) / 4 - demand) AS miss
      FROM ({lagged("(SELECT * FROM split_panel WHERE split = 'test')", (1, 2, 3, 24))})
      WHERE lag_24 IS NOT NULL""",
    "per_zone": f"""
      SELECT zone, {r('avg(miss)', 'mae')}, {r('sqrt(avg(miss * miss))', 'rmse')},
             {r('avg(100 * miss / nullif(abs(actual), 0))', 'mape')} FROM cells GROUP BY zone""",
    "zone_strength": f"""
      SELECT {Z}, {_CORR}
      FROM (SELECT *, {calendar_list('hour')} FROM lagged WHERE lag_24 IS NOT NULL) GROUP BY {Z}""",
    "importance_rows": " UNION ALL ".join(
        [f"SELECT 'lag_{lag}_zone_' || {Z} AS feature, lag_{lag} AS importance FROM zone_strength"
         for lag in (1, 2, 3, 24)]
        + [f"SELECT '{c}', {c} FROM zone_strength" for c in TABULAR_CALENDAR]),
    "importance": """
      SELECT feature, avg(importance) AS importance, nullif(regexp_extract(feature, 'lag_\\d+'), '') AS lag,
             nullif(regexp_extract(feature, 'zone_(\\d+)', 1), '') AS zone,
             CASE WHEN contains(feature, 'lag_') THEN 'spatial' ELSE 'other' END AS type
      FROM importance_rows GROUP BY feature""",
    "nation_lags": lagged("nation_panel", (1, 2, 3, 24)),
    "nation_vectors": f"""
      SELECT hour, list(demand ORDER BY {Z}) AS labels,
             list_concat(list(demand ORDER BY {Z}), {calendar_array('hour', SEQUENCE_CALENDAR)}) AS features
      FROM nation_panel GROUP BY hour""",
}


def sql(select: str) -> str:
    """The select with the blocks it needs, however deep, in front."""
    needed: set[str] = set()
    pending = [select]
    while pending:
        text = pending.pop()
        for name in BLOCKS:
            if name not in needed and re.search(rf"\b{name}\b", re.sub(r"'[^']*'", "''", text)):
                needed.add(name)
                pending.append(BLOCKS[name])
    blocks = ", ".join(f"{name} AS ({BLOCKS[name]})" for name in BLOCKS if name in needed)
    return f"WITH {blocks} {select}" if blocks else select


def _top_bottom() -> str:
    lists = []
    for name in ("worst_rmse", "best_rmse", "worst_mae", "best_mae", "worst_mape", "best_mape"):
        direction, measure = name.split("_")
        order = f"{measure} {'ASC' if direction == 'best' else 'DESC'}, zone"
        lists.append(f"""
          SELECT zone, mae, rmse, mape, '{name}' AS type, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS rank
          FROM per_zone WHERE {measure} IS NOT NULL QUALIFY rank <= 5""")
    return " UNION ALL ".join(f"({text})" for text in lists)


def _windows(back: int, horizon: int, output: int = 1) -> str:
    """Frames by plain index arithmetic over the numbered hours."""
    return f"""
      SELECT t.hour AS target_timestamp, flatten(list(p.features ORDER BY p.hour)) AS past,
             any_value(t.future) AS future
      FROM (SELECT hour, flatten(list(labels) OVER
              (ORDER BY hour ROWS BETWEEN CURRENT ROW AND {output - 1} FOLLOWING)) AS future,
              count(*) OVER (ORDER BY hour ROWS BETWEEN CURRENT ROW AND {output - 1} FOLLOWING) AS n_future
            FROM nation_vectors) t
      JOIN nation_vectors p ON p.hour BETWEEN t.hour - INTERVAL {back + horizon - 1} HOUR
                                          AND t.hour - INTERVAL {horizon} HOUR
      WHERE t.n_future = {output}
      GROUP BY t.hour HAVING count(*) = {back}"""


_OVERALL = f"""
  SELECT model_version, count(*) AS num_predictions, {r('avg(actual_demand)', 'avg_actual_demand')},
         {r('avg(predicted_demand)', 'avg_predicted_demand')}, {r('avg(raw_error)', 'mean_error')},
         {r('avg(absolute_error)', 'mae')}, {r('sqrt(avg(squared_error))', 'rmse')},
         {r(f'avg({RATIO})', 'mape_excluding_zero_actuals')} FROM errors GROUP BY model_version"""
_ZONES = f"""
  SELECT model_version, {Z}, {bundle()}, {r('avg(actual_demand)', 'average_actual_demand')}
  FROM errors GROUP BY 1, 2"""
_ERRORS = "SELECT * FROM errors"
_HOURS = "SELECT * FROM hour_metrics"
_HOURS_DENSE = f"SELECT model_version, target_timestamp, {bundle('num_zones')} FROM errors_dense GROUP BY 1, 2"
_DAYS_DENSE = f"""
  SELECT model_version, CAST(target_timestamp AS DATE) AS target_date, {bundle()} FROM errors_dense GROUP BY 1, 2"""


def _dense(text: str) -> str:
    return text.replace("FROM errors ", "FROM errors_dense ").replace("FROM errors\n", "FROM errors_dense\n")


def _refreshed(stale: str, fresh: str, keys: tuple[str, ...]) -> str:
    match = " AND ".join(f"s.{k} = f.{k}" for k in keys)
    return f"""
      SELECT * FROM ({stale}) s WHERE NOT EXISTS (SELECT 1 FROM ({fresh}) f WHERE {match})
      UNION ALL BY NAME SELECT * FROM ({fresh})"""


def _scaled(value: str = "(demand - mean) / scale") -> str:
    return r(value, "demand")


_TEST_LAGS = ", ".join(f"lag_{lag}" for lag in (1, 2, 3, 24))
_ALL_SCALED = f"({_SCALER} FROM panel GROUP BY {Z})"
_LATEST = "(SELECT max(hour) FROM hourly)"

SELECTS = {
    "month_list": """
      SELECT strftime(unnest(generate_series(date_trunc('month', min(o_orderdate)),
             date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)), '%Y-%m') AS year_month FROM orders""",
    "load_months": f"SELECT hour, {Z}, CAST(demand AS DOUBLE) AS demand FROM order_days",
    "hourly_demand": f"SELECT hour, {Z}, demand FROM hourly",
    "hourly_demand_borough": f"""
      SELECT hour, {Z}, demand FROM hourly
      WHERE {Z} IN (SELECT LocationID FROM lookup WHERE Borough = 'ASIA')""",
    "hourly_demand_license": f"""
      SELECT date_trunc('hour', ts) AS hour, CAST(user_id AS INTEGER) AS {Z}, count(*) AS demand FROM events
      WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01' AND event_type = 'purchase'
      GROUP BY 1, 2""",
    "borough_zones": f"SELECT DISTINCT LocationID AS {Z} FROM lookup WHERE Borough = 'ASIA'",
    "actuals_load": f"SELECT hour, CAST({Z} AS VARCHAR) AS {Z}, CAST(demand AS DOUBLE) AS demand FROM hourly",
    "latest_timestamp": "SELECT max(hour) AS latest_hour FROM hourly",
    "latest_actuals": f"""
      SELECT hour, CAST({Z} AS VARCHAR) AS {Z}, CAST(demand AS DOUBLE) AS demand FROM hourly
      WHERE hour >= {_LATEST} - INTERVAL 24 HOUR""",
    "next_hour_actuals": f"""
      SELECT hour, CAST({Z} AS VARCHAR) AS {Z}, CAST(demand AS DOUBLE) AS demand FROM hourly
      WHERE hour = (SELECT max(hour) FROM hourly WHERE hour < {LAST_DAY}) + INTERVAL 1 HOUR""",
    "prediction_exists": f"""
      SELECT * FROM predictions WHERE NOT (model_version = {MODEL} AND target_timestamp < {HOUR})""",
    "full_panel": "SELECT * FROM panel",
    "align_zones": f"""
      SELECT h.hour, z.{Z}, CAST(coalesce(d.demand, 0) AS DOUBLE) AS demand
      FROM (SELECT unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour FROM hourly) h
      CROSS JOIN (SELECT LocationID AS {Z} FROM lookup WHERE Borough = 'ASIA') z
      LEFT JOIN hourly d ON d.hour = h.hour AND d.{Z} = z.{Z}""",
    "panel_wide": f"""
      SELECT hour, {', '.join(f'coalesce(max(demand) FILTER ({Z} = {z}), 0) AS zone_{z}' for z in range(25))}
      FROM nation_panel GROUP BY hour""",
    "panel_melted": "SELECT * FROM nation_panel",
    "split_by_month": f"""
      SELECT hour, {Z}, demand, CASE WHEN hour < TIMESTAMP '1999-01-01' THEN 'train'
             WHEN hour < TIMESTAMP '2000-01-01' THEN 'validation' ELSE 'test' END AS split FROM order_days""",
    "raw_targets": f"SELECT hour, {Z}, demand FROM panel WHERE hour >= TIMESTAMP '2024-01-27'",
    "time_features": f"SELECT hour, {calendar_list('hour')} FROM (SELECT DISTINCT hour FROM hourly)",
    "fit_scaler": f"SELECT {Z}, {r('mean', 'mean')}, {r('scale', 'scale')} FROM scaler",
    "fit_scaler_all": f"SELECT {Z}, {r('mean', 'mean')}, {r('scale', 'scale')} FROM {_ALL_SCALED}",
    "scaled_panel": f"SELECT hour, {Z}, {_scaled()}, split FROM split_panel JOIN scaler USING ({Z})",
    "inverse_scaled": f"SELECT hour, {Z}, {_scaled('demand')} FROM panel",
    "lag_features": f"""
      SELECT split, hour AS target_timestamp, {Z}, demand AS target, {_TEST_LAGS}, {calendar_list('hour')}
      FROM ({lagged('split_panel', (1, 2, 3, 24), 1, f'split, {Z}')}) WHERE lag_24 IS NOT NULL""",
    "lag_features_horizon_3": f"""
      SELECT split, hour AS target_timestamp, {Z}, demand AS target, lag_1, lag_2, lag_24, {calendar_list('hour')}
      FROM ({lagged('split_panel', (1, 2, 24), 3, f'split, {Z}')}) WHERE lag_24 IS NOT NULL""",
    "lag_matrix": entries("target_timestamp", {
        "features": f"list_concat(l1, list_concat(l2, list_concat(l3, list_concat(l24, "
                    f"{calendar_array('target_timestamp', TABULAR_CALENDAR)}))))",
        "labels": "labels"}, f"""(
      SELECT hour AS target_timestamp, list(demand ORDER BY {Z}) AS labels,
             {', '.join(f'list(lag_{n} ORDER BY {Z}) AS l{n}' for n in (1, 2, 3, 24))}
      FROM nation_lags WHERE lag_24 IS NOT NULL GROUP BY hour)"""),
    "feature_names": f"""
      SELECT CAST(row_number() OVER (ORDER BY lag, {Z}) - 1 AS INTEGER) AS position,
             'lag_' || lag || '_zone_' || {Z} AS feature
      FROM (SELECT DISTINCT {Z} FROM nation_hourly), (SELECT unnest([1, 2, 3, 24]) AS lag)
      UNION ALL
      SELECT CAST(4 * (SELECT count(DISTINCT {Z}) FROM nation_hourly) + i AS INTEGER), names[i + 1]
      FROM (SELECT {list(TABULAR_CALENDAR)} AS names), range(8) t(i)""",
    "sequence_features": """
      SELECT hour, CAST(i AS INTEGER) AS position, round(features[i + 1], 6) + 0.0 AS value
      FROM (SELECT hour, features, unnest(range(len(features))) AS i FROM nation_vectors)""",
    "flat_windows": entries("target_timestamp", {"features": "past", "labels": "future"}, f"({_windows(24, 1)})"),
    "sequence_windows": entries("target_timestamp", {"x": "past", "y": "future"}, f"({_windows(24, 1, 1)})"),
    "flat_samples_by_reference": entries("target_timestamp", {"features": "past", "labels": "future"}, f"({_windows(24, 1)})"),
    "sequence_samples_by_reference": entries("target_timestamp", {"x": "past", "y": "future"}, f"({_windows(48, 1, 6)})"),
    "batch_predictions": f"""
      SELECT hour - INTERVAL 1 HOUR AS forecast_run_timestamp, hour AS target_timestamp,
             CAST({Z} AS VARCHAR) AS {Z}, {r('(lag_1 + lag_2 + lag_3 + lag_24) / 4', 'predicted_demand')},
             {MODEL} AS model_version FROM lagged WHERE lag_24 IS NOT NULL""",
    "inference_row": f"""
      SELECT {_LATEST} AS forecast_run_timestamp, {_LATEST} + INTERVAL 1 HOUR AS target_timestamp, {Z},
             {', '.join(f"max(demand) FILTER (hour = {_LATEST} - INTERVAL {n - 1} HOUR) AS lag_{n}" for n in (1, 2, 3, 24))},
             {calendar_list(f'({_LATEST} + INTERVAL 1 HOUR)')}
      FROM panel GROUP BY {Z}""",
    "next_hour_prediction": f"""
      SELECT {_LATEST} AS forecast_run_timestamp, {_LATEST} + INTERVAL 1 HOUR AS target_timestamp,
             CAST({Z} AS VARCHAR) AS {Z}, {r('demand', 'predicted_demand')}, 'naive_24' AS model_version
      FROM panel WHERE hour = {_LATEST} - INTERVAL 23 HOUR""",
    "prediction_error": _ERRORS,
    "prediction_error_bucketed": _ERRORS,
    "prediction_error_dense": "SELECT * FROM errors_dense",
    "metrics_by_hour": _HOURS,
    "metrics_by_hour_dense": _HOURS_DENSE,
    "metrics_by_day": "SELECT * FROM day_metrics",
    "metrics_by_day_dense": _DAYS_DENSE,
    "metrics_by_zone": _ZONES,
    "metrics_by_zone_dense": _dense(_ZONES),
    "metrics_overall": _OVERALL,
    "metrics_overall_dense": _dense(_OVERALL),
    "rolling_7d_bulk": rolling("errors"),
    "rolling_7d_bulk_dense": rolling("errors_dense"),
    "rolling_7d_byzone_bulk": rolling("errors", zone=True),
    "rolling_7d_byzone_bulk_dense": rolling("errors_dense", zone=True),
    "rolling_7d_at": rolling_at(),
    "rolling_7d_byzone_at": rolling_at(zone=True),
    "latest_rolling_7d": f"""
      SELECT * FROM ({rolling('errors')})
      QUALIFY row_number() OVER (PARTITION BY model_version ORDER BY window_end_timestamp DESC) = 1""",
    "freshness": """
      SELECT 'actuals' AS source, max(hour) AS latest FROM hourly
      UNION ALL SELECT 'predictions', max(target_timestamp) FROM predictions""",
    "missing_predictions": f"""
      SELECT h.hour AS target_timestamp, CAST(h.{Z} AS VARCHAR) AS {Z}, h.demand, m.model_version
      FROM hourly h CROSS JOIN (SELECT DISTINCT model_version FROM predictions) m
      WHERE NOT EXISTS (SELECT 1 FROM predictions p WHERE p.target_timestamp = h.hour
        AND p.{Z} = CAST(h.{Z} AS VARCHAR) AND p.model_version = m.model_version)""",
    "eval_overall": f"""
      SELECT {r('avg(miss)', 'overall_mae')}, {r('sqrt(avg(miss * miss))', 'overall_rmse')},
             {r('avg(100 * miss / nullif(abs(actual), 0))', 'overall_mape')} FROM cells""",
    "eval_overall_epsilon": f"""
      SELECT {r('avg(miss)', 'overall_mae')}, {r('sqrt(avg(miss * miss))', 'overall_rmse')},
             {r('avg(100 * miss / greatest(abs(actual), 0.5))', 'overall_mape')} FROM cells""",
    "eval_per_zone": "SELECT * FROM per_zone",
    "top_bottom_zones": _top_bottom(),
    "importance_by_feature": f"SELECT feature, {r('importance', 'importance')}, lag, zone, type FROM importance",
    "importance_by_lag": f"""
      SELECT lag, {r('sum(importance)', 'importance')} FROM importance WHERE lag IS NOT NULL GROUP BY lag""",
    "importance_by_zone": f"""
      SELECT zone, {r('sum(importance)', 'importance')} FROM importance WHERE zone IS NOT NULL GROUP BY zone""",
    "importance_by_type": f"""
      SELECT type, {r('sum(importance)', 'sum')}, {r('avg(importance)', 'mean')}, count(*) AS count
      FROM importance GROUP BY type""",
    "merge_prediction_error": f"""
      SELECT * FROM errors WHERE target_timestamp < {HOUR}
         OR (target_timestamp = {HOUR} AND model_version = {MODEL})""",
    "merge_metrics_by_hour": f"""
      SELECT * FROM hour_metrics WHERE target_timestamp < {HOUR}
         OR (target_timestamp = {HOUR} AND model_version = {MODEL})""",
    "merge_metrics_by_day": _refreshed(
        f"""SELECT model_version, CAST(target_timestamp AS DATE) AS target_date, {bundle()}
            FROM errors WHERE target_timestamp < {HOUR} GROUP BY 1, 2""",
        f"SELECT * FROM day_metrics WHERE target_date = CAST({HOUR} AS DATE) AND model_version = {MODEL}",
        ("target_date", "model_version")),
    "merge_rolling_7d": _refreshed(
        f"SELECT * REPLACE (CAST(0 AS BIGINT) AS num_predictions) FROM ({rolling('early_errors')})",
        rolling_at(), ("metric_date", "model_version")),
    "merge_rolling_7d_byzone": _refreshed(
        f"SELECT * REPLACE (CAST(0 AS BIGINT) AS num_predictions) FROM ({rolling('early_errors', zone=True)})",
        rolling_at(zone=True), ("metric_date", Z, "model_version")),
    "hourly_cycle": f"""
      SELECT * FROM ({rolling('early_errors')})
      UNION ALL BY NAME
      SELECT DATE '2024-01-30' AS metric_date, TIMESTAMP '2024-01-24' AS window_start_timestamp,
             TIMESTAMP '2024-01-30 23:00:00' AS window_end_timestamp, model_version, {bundle()}
      FROM errors WHERE target_timestamp BETWEEN TIMESTAMP '2024-01-24' AND TIMESTAMP '2024-01-30 23:00:00'
        AND EXISTS (SELECT 1 FROM hourly WHERE hour = TIMESTAMP '2024-01-30 23:00:00')
      GROUP BY model_version""",
    "stream_hourly_demand": f"SELECT hour, {Z}, demand FROM hourly",
    "stream_closed_hours": f"""
      SELECT hour, {Z}, demand FROM hourly WHERE hour + INTERVAL 2 HOUR <= (SELECT max(ts) FROM events)""",
    "stream_late_trips": f"""
      SELECT CASE WHEN late THEN 'late' ELSE 'closed' END AS kind, hour, {Z}, count(*) AS demand
      FROM (SELECT event_id % 10 = 0 AND dayofmonth(ts) <= 5 AS late, date_trunc('hour', ts) AS hour, CAST(user_id AS INTEGER) AS {Z} FROM events)
      WHERE hour + INTERVAL 2 HOUR <= (SELECT max(ts) FROM events) GROUP BY ALL""",
    "scaler_by_months": f"""
      SELECT {Z}, {r('sum(demand) / h', 'mean')},
             {r('CASE WHEN min(demand) = max(demand) AND count(*) = h THEN 1.0 ELSE sqrt(sum(demand * demand) / h - power(sum(demand) / h, 2)) END', 'scale')}
      FROM order_days, (SELECT date_diff('hour', min(hour), max(hour)) + 1 AS h FROM order_days) GROUP BY {Z}, h""",
    "rolling_7d_of_stamps": rolling("shifted_errors"),
    "rolling_7d_byzone_of_stamps": rolling("shifted_errors", zone=True),
    "stream_rolling_7d": rolling_of_stream(),
    "stream_rolling_7d_byzone": rolling_of_stream(zone=True),
    "stream_late_errors": f"""
      SELECT model_version, {Z}, CAST(target_timestamp AS DATE) AS target_date, count(*) AS late FROM errors WHERE {TOO_LATE} GROUP BY ALL""",
    "compare_versions": f"""
      SELECT metric, n_cells, n_days, {r('mean_one', 'mean_one')}, {r('mean_two', 'mean_two')}, {r('mean_one - mean_two', 'difference')}, {r('lower', 'lower')}, {r('upper', 'upper')}
      FROM (SELECT metric, sum(n)::BIGINT AS n_cells, count(*) AS n_days, sum(a) / sum(n) AS mean_one, sum(b) / sum(n) AS mean_two FROM compared_days GROUP BY metric)
      JOIN (SELECT metric, quantile_cont(difference, 0.025) AS lower, quantile_cont(difference, 0.975) AS upper FROM replicated GROUP BY metric) USING (metric)""",
    "sql_script": f"SELECT * FROM day_metrics WHERE model_version = {MODEL}",
    "stream_cycle_hours": _HOURS,
    "monthly_trips": f"SELECT hour, {Z}, demand FROM hourly",
    "zone_lookup_csv": "SELECT LocationID, Borough FROM lookup",
    "processed_months": f"""
      SELECT hour, {Z}, CAST(demand AS DOUBLE) AS demand FROM order_days
      WHERE hour >= TIMESTAMP '1996-02-01' AND hour < TIMESTAMP '1997-02-01'""",
    "sql_file": f"""
      SELECT target_timestamp, {Z}, absolute_error FROM errors WHERE target_timestamp = {HOUR} AND model_version = {MODEL}""",
    "view_overall": _OVERALL,
    "view_by_zone": _ZONES,
    "view_latest_rolling": f"""
      SELECT * FROM ({rolling('errors')})
      QUALIFY row_number() OVER (PARTITION BY model_version ORDER BY window_end_timestamp DESC) = 1""",
    "importance_report": f"SELECT feature, {r('importance', 'importance')}, lag, zone, type FROM importance",
    "per_zone_report": "SELECT * FROM per_zone",
    "stream_hourly_cycle": """
      SELECT * FROM day_metrics
      WHERE target_date IN (SELECT CAST(hour AS DATE) FROM hourly WHERE hour(hour) = 23)""",
}

ORACLES = {name: sql(text) for name, text in SELECTS.items()}
