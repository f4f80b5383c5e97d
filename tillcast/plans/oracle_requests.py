"""The SQL each request query must agree with; it works on numbered history rows."""

from tillcast.constants import FEATURES, FOURIER_HARMONICS, FOURIER_PERIODS, LAGS, WINDOWS
from tillcast.plans.oracle_features import CALENDAR_SELECT, PANEL, WEATHER, rnd

_BASE = f"""WITH {PANEL},
history AS (
  SELECT series_id AS request_id, city_id, dt, sale_amount, stockout_ratio, is_stockout, stockout_hours,
    row_number() OVER (PARTITION BY series_id ORDER BY dt DESC) AS k
  FROM panel WHERE date_diff('day', dt, (SELECT max(dt) FROM panel)) < 90 * (1 + city_id % 8)),
asked AS (SELECT DISTINCT series_id AS request_id, city_id FROM panel),
sizes AS (SELECT request_id, city_id, CAST(count(k) AS INTEGER) AS n, avg(sale_amount) AS mean
  FROM asked LEFT JOIN history USING (request_id, city_id) GROUP BY ALL),
judged AS (SELECT *, n >= 7 AS valid,
  CASE WHEN n < 7 THEN 'history has fewer than 7 days' END AS reject_reason FROM sizes),
slots AS (SELECT CAST(unnest(generate_series(1, 28)) AS INTEGER) AS k),
padded AS (
  SELECT j.request_id, j.n, s.k, coalesce(h.sale_amount, j.mean) AS s, coalesce(h.stockout_ratio, 0) AS r
  FROM judged j CROSS JOIN slots s LEFT JOIN history h ON h.request_id = j.request_id AND h.k = s.k WHERE valid),
looks AS (
  SELECT request_id, any_value(n) AS n_history_days,
    {', '.join(f'max(s) FILTER (WHERE k = {k}) AS lag_{k}' for k in LAGS)},
    {', '.join(f'avg(s) FILTER (WHERE k <= {w}) AS rolling_mean_{w}' for w in WINDOWS)},
    {', '.join(f'stddev_pop(s) FILTER (WHERE k <= {w}) AS rolling_std_{w}' for w in WINDOWS)},
    {', '.join(f'stddev_samp(s) FILTER (WHERE k <= {w}) AS sample_std_{w}' for w in WINDOWS)},
    {', '.join(f'avg(r) FILTER (WHERE k <= {w}) AS stockout_ratio_{w}d' for w in WINDOWS)}
  FROM padded GROUP BY request_id),
scaled AS (SELECT looks.*, CASE WHEN rolling_mean_28 > 0 THEN rolling_mean_28 ELSE 1 END AS series_scale,
    h.stockout_ratio, h.is_stockout, h.stockout_hours
  FROM looks JOIN history h ON h.request_id = looks.request_id AND h.k = 1),
dates AS (SELECT CAST((SELECT max(dt) FROM panel) + CAST(unnest(generate_series(1, 7)) AS INTEGER) AS DATE) AS dt),
ahead AS (SELECT dt, {CALENDAR_SELECT}, {WEATHER}, 0.0::DOUBLE AS discount, 0 AS activity_flag FROM dates),
fourier AS (SELECT *, {', '.join(
    f'{fn}(2 * pi() * {k} * day_of_week / {p}.0::DOUBLE) AS {fn}_{p}d_h{k}'
    for p in FOURIER_PERIODS for k in FOURIER_HARMONICS for fn in ('sin', 'cos'))} FROM ahead),
answered AS (SELECT scaled.*, fourier.* EXCLUDE (dt), 1.0::DOUBLE AS first_category_id_te,
    1.0::DOUBLE AS city_id_te, asked.city_id
  FROM scaled JOIN asked USING (request_id) CROSS JOIN fourier)"""

_INTS = {"is_stockout", "stockout_hours", "day_of_week", "week_of_year", "month", "is_weekend", "day_of_month",
         "activity_flag", "holiday_flag", "city_id"}
_FEATURES = f"""{_BASE} SELECT request_id, n_history_days,
  {', '.join(f if f in _INTS else rnd(f) for f in FEATURES)} FROM answered"""
_RF = "greatest(lag_1 - lag_7, 0)"
_RESPONSE = f"""{_BASE}, based AS (SELECT *, lag_7 AS x, rolling_mean_28 AS l, {_RF} AS f FROM answered)
  SELECT request_id, day_of_week, month, {rnd('demand_xgboost', 'x', 4)}, {rnd('demand_lightgbm', 'l', 4)},
    {rnd('demand_ensemble', '''coalesce((CASE WHEN x > 0 THEN x ELSE 0 END + CASE WHEN l > 0 THEN l ELSE 0 END
      + CASE WHEN f > 0 THEN f ELSE 0 END) / nullif(CAST(x > 0 AS INTEGER) + CAST(l > 0 AS INTEGER)
      + CAST(f > 0 AS INTEGER), 0), 0)''', 4)},
    'xgboost,lightgbm,random_forest' AS models, CAST(45 AS INTEGER) AS features_used, n_history_days FROM based"""

SQL = {
    "request_validate": f"{_BASE} SELECT request_id, n AS n_history_days, valid, reject_reason FROM judged",
    "request_features": _FEATURES,
    "request_features_trained": f"""{_BASE}, long_scale AS (SELECT request_id, avg(sale_amount) AS scale
          FROM history WHERE k <= 90 GROUP BY ALL)
        SELECT request_id, day_of_month, month, {rnd('rolling_std_7', 'sample_std_7')},
          {rnd('rolling_std_28', 'sample_std_28')}, {rnd('series_scale', 'scale')}
        FROM answered JOIN long_scale USING (request_id)""",
    "request_json": f"""{_BASE} SELECT request_id, n AS n_history_days, day_of_week, month, day_of_month,
        {rnd('avg_temperature')}, 1.0::DOUBLE AS city_id_te, 1.0::DOUBLE AS first_category_id_te
        FROM judged CROSS JOIN ahead""",
    "request_response": _RESPONSE,
    "stream_features": _FEATURES,
    "stream_response": _RESPONSE,
    "stream_rejects": f"{_BASE} SELECT request_id, reject_reason FROM judged WHERE NOT valid",
}
