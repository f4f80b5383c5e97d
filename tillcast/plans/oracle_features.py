"""The SQL each panel query must agree with."""

from tillcast.constants import (
    ENCODED_COLUMNS, FEATURES, FOURIER_HARMONICS, FOURIER_PERIODS, LAGS, WINDOWS,
)

WEATHER = """
    CAST(day(dt) IN (1, 15) AS INTEGER) AS holiday_flag,
    ((dayofyear(dt) * 7) % 10) / 10.0::DOUBLE AS precpt,
    10.0::DOUBLE + dayofyear(dt) % 20 AS avg_temperature,
    60.0::DOUBLE + dayofyear(dt) % 30 AS avg_humidity,
    CAST(dayofyear(dt) % 5 AS DOUBLE) AS avg_wind_level"""

PANEL = f"""
daily AS (
  SELECT l_suppkey AS store_id, p_type AS product_id, CAST(s_nationkey AS INTEGER) AS city_id,
    p_type AS first_category_id, CAST(l_shipdate AS DATE) AS dt,
    sum(l_quantity) AS sale_amount, round(avg(l_discount), 6) AS discount,
    CAST(least(16, 4 * count(*) FILTER (WHERE l_returnflag = 'R')) AS INTEGER) AS stock_hour6_22_cnt
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY ALL),
panel AS (
  SELECT daily.*, CAST(discount > 0.05::DOUBLE AS INTEGER) AS activity_flag,
    sale_amount * (1 + stock_hour6_22_cnt / 16.0::DOUBLE) AS sale_amount_pred, {WEATHER},
    store_id::VARCHAR || '__' || product_id AS series_id,
    CAST(stock_hour6_22_cnt > 0 AS INTEGER) AS is_stockout,
    stock_hour6_22_cnt / 16.0::DOUBLE AS stockout_ratio, stock_hour6_22_cnt AS stockout_hours,
    sale_amount * (1 + stock_hour6_22_cnt / 16.0::DOUBLE) AS y_eff
  FROM daily)"""

_FRAMES = ", ".join(
    [f"w{w} AS (PARTITION BY store_id, product_id ORDER BY dt ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
     for w in (*WINDOWS, 90)]
    + ["s AS (PARTITION BY store_id, product_id ORDER BY dt)"])

LOOK_BACK = {
    **{f"lag_{k}": f"lag(y_eff, {k}) OVER s" for k in LAGS},
    **{f"rolling_mean_{w}": f"avg(y_eff) OVER w{w}" for w in WINDOWS},
    **{f"rolling_std_{w}": f"stddev_samp(y_eff) OVER w{w}" for w in WINDOWS},
    **{f"stockout_ratio_{w}d": f"avg(stockout_ratio) OVER w{w}" for w in WINDOWS},
    "series_scale": "CASE WHEN count(y_eff) OVER w90 >= 7 THEN avg(y_eff) OVER w90 END",
}
_LOOK_BACK_SELECT = ", ".join(f"{e} AS {n}" for n, e in LOOK_BACK.items())

LOOKED = f"looked AS (SELECT *, {_LOOK_BACK_SELECT} FROM panel WINDOW {_FRAMES})"

CALENDAR = {
    "day_of_week": "CAST(isodow(dt) - 1 AS INTEGER)",
    "week_of_year": "CAST(weekofyear(dt) AS INTEGER)",
    "month": "CAST(month(dt) AS INTEGER)",
    "is_weekend": "CAST(isodow(dt) >= 6 AS INTEGER)",
    "day_of_month": "CAST(day(dt) AS INTEGER)",
}
CALENDAR_SELECT = ", ".join(f"{e} AS {n}" for n, e in CALENDAR.items())

FOURIER = {
    f"{fn}_{p}d_h{k}": f"{fn}(2 * pi() * {k} * date_diff('day', (SELECT min(dt) FROM panel), dt) / {p}.0::DOUBLE)"
    for p in FOURIER_PERIODS for k in FOURIER_HARMONICS for fn in ("sin", "cos")}
FOURIER_SELECT = ", ".join(f"{e} AS {n}" for n, e in FOURIER.items())


def split_of(source, name="parted", calendar=True):
    extra = f", {CALENDAR_SELECT}" if calendar else ""
    return f"""{name} AS (
  SELECT *{extra},
    CASE WHEN dt >= (SELECT max(dt) FROM panel) - 6 THEN 'test'
         WHEN dt >= (SELECT max(dt) FROM panel) - 13 THEN 'val' ELSE 'train' END AS split
  FROM {source})"""


def lookup_of(column, source="parted"):
    return f"""lookup_{column} AS (
  SELECT {column}, month, (sum(y_eff) + 100 * (SELECT avg(y_eff) FROM {source} WHERE split = 'train'))
    / (count(y_eff) + 100) AS {column}_te
  FROM {source} WHERE split = 'train' GROUP BY {column}, month)"""


def encoded_of(source="parted"):
    joins = " ".join(f"LEFT JOIN lookup_{c} USING ({c}, month)" for c in ENCODED_COLUMNS)
    te = ", ".join(
        f"coalesce({c}_te, (SELECT avg(y_eff) FROM {source} WHERE split = 'train')) AS {c}_te"
        for c in ENCODED_COLUMNS)
    return (", ".join(lookup_of(c, source) for c in ENCODED_COLUMNS)
            + f", encoded AS (SELECT {source}.*, {te} FROM {source} {joins})")


def rnd(name, expression=None, digits=6):
    return f"round({expression or name}, {digits}) + 0.0::DOUBLE AS {name}"


def _looked(names):
    return f"WITH {PANEL}, {LOOKED} SELECT store_id, product_id, dt, {', '.join(map(rnd, names))} FROM looked"


_DOUBLES = ("sale_amount", "discount", "sale_amount_pred", "precpt", "avg_temperature", "avg_humidity",
            "avg_wind_level", "stockout_ratio", "y_eff")
_FILLED = ["lag_1", "lag_7", "lag_28", "rolling_std_7", "series_scale"]
_MEDIANS = ", ".join(f"(SELECT median({c}) FROM parted WHERE split = 'train') AS m_{c}" for c in _FILLED)
_INT_FEATURES = {"is_stockout", "stockout_hours", "day_of_week", "week_of_year", "month", "is_weekend",
                 "day_of_month", "activity_flag", "holiday_flag", "city_id"}
_SCALED = ["sale_amount", "discount", "avg_temperature", "stockout_ratio"]

SQL = {
    "panel_daily": f"""WITH {PANEL} SELECT store_id, product_id, city_id, first_category_id, dt,
        stock_hour6_22_cnt, activity_flag, holiday_flag, series_id, is_stockout, stockout_hours,
        {', '.join(map(rnd, _DOUBLES))},
        {rnd('demand_ratio', 'sale_amount_pred / (sale_amount + 0.01::DOUBLE)')},
        {rnd('demand_gap', 'sale_amount_pred - sale_amount')} FROM panel""",
    "panel_density": f"""WITH {PANEL} SELECT store_id, product_id, count(*) AS n_rows,
        min(dt) AS first_day, max(dt) AS last_day,
        date_diff('day', min(dt), max(dt)) + 1 - count(DISTINCT dt) AS n_gaps,
        count(*) - count(DISTINCT dt) AS n_repeats,
        count(*) = count(DISTINCT dt) AND count(DISTINCT dt) = date_diff('day', min(dt), max(dt)) + 1 AS dense
        FROM panel GROUP BY ALL""",
    "panel_densified": f"""WITH {PANEL},
        series AS (SELECT DISTINCT store_id, product_id, city_id FROM panel),
        days AS (SELECT CAST(unnest(generate_series((SELECT min(dt) FROM panel)::TIMESTAMP,
            (SELECT max(dt) FROM panel)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS dt),
        grid AS (SELECT * FROM series CROSS JOIN days)
        SELECT store_id, product_id, grid.city_id, count(*) AS n_days,
          count(*) FILTER (WHERE coalesce(sale_amount, 0) > 0) AS n_selling,
          {rnd('total', 'sum(coalesce(sale_amount, 0))')},
          {rnd('spread', 'stddev_samp(coalesce(sale_amount, 0))')}
        FROM grid LEFT JOIN panel USING (store_id, product_id, dt) GROUP BY ALL""",
    "feat_lags": _looked([f"lag_{k}" for k in LAGS]),
    "feat_rolling": _looked([f"rolling_{s}_{w}" for s in ("mean", "std") for w in WINDOWS]),
    "feat_stockout_rolling": _looked([f"stockout_ratio_{w}d" for w in WINDOWS]),
    "feat_series_scale": _looked(["series_scale"]),
    "feat_calendar": f"WITH {PANEL} SELECT store_id, product_id, dt, {CALENDAR_SELECT} FROM panel",
    "feat_fourier": f"""WITH {PANEL} SELECT store_id, product_id, dt,
        {', '.join(rnd(n, e) for n, e in FOURIER.items())} FROM panel""",
    "feature_table": f"""WITH {PANEL}, {LOOKED}, {split_of('looked')}, {encoded_of()},
        full_table AS (SELECT *, {FOURIER_SELECT} FROM encoded)
        SELECT store_id, product_id, dt, split,
          {', '.join(f if f in _INT_FEATURES else rnd(f) for f in FEATURES)} FROM full_table""",
    "split_weights": f"""WITH {PANEL}, {split_of('panel', calendar=False)},
        aged AS (SELECT *, CAST(date_diff('day', dt, (SELECT max(dt) FROM panel)) AS INTEGER) AS days_ago
                 FROM parted)
        SELECT store_id, product_id, dt, split, days_ago,
          CASE WHEN days_ago <= 30 THEN 1.0::DOUBLE WHEN days_ago <= 60 THEN 0.5::DOUBLE
               ELSE 0.25::DOUBLE END AS sample_weight FROM aged""",
    "eval_target_mask": f"""WITH {PANEL}, {split_of('panel', calendar=False)}
        SELECT store_id, product_id, dt, split, CASE WHEN is_stockout = 0 THEN sale_amount END AS eval_target
        FROM parted""",
    "target_encoding": f"""WITH {PANEL}, {split_of('panel')}, {encoded_of()}
        SELECT store_id, product_id, dt, split, {rnd('first_category_id_te')}, {rnd('city_id_te')} FROM encoded""",
    "encoding_lookup": f"""WITH {PANEL}, {split_of('panel')}, {lookup_of('city_id')}
        SELECT city_id, month, {rnd('city_id_te')} FROM lookup_city_id""",
    "column_profile": f"WITH {PANEL} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, {rnd('mean', f'avg({c})')},
            {rnd('std_samp', f'stddev_samp({c})')}, {rnd('std_pop', f'stddev_pop({c})')},
            {rnd('min', f'min({c})')}, {rnd('max', f'max({c})')} FROM panel"""
        for c in ("sale_amount", "sale_amount_pred", "discount", "stockout_ratio")),
    "column_medians": f"WITH {PANEL}, {LOOKED}, {split_of('looked')} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {rnd('median', f'median({c})')} FROM parted WHERE split = 'train'"""
        for c in _FILLED),
    "median_fill": f"""WITH {PANEL}, {LOOKED}, {split_of('looked')}, medians AS (SELECT {_MEDIANS})
        SELECT store_id, product_id, dt, {', '.join(rnd(c, f'coalesce({c}, m_{c})') for c in _FILLED)}
        FROM parted CROSS JOIN medians""",
    "standardize": f"""WITH {PANEL}, {split_of('panel', calendar=False)}, moments AS (SELECT
          {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in _SCALED)}
          FROM parted WHERE split = 'train')
        SELECT store_id, product_id, dt,
          {', '.join(rnd(f'{c}_z', f'({c} - m_{c}) / coalesce(nullif(s_{c}, 0), 1)') for c in _SCALED)}
        FROM parted CROSS JOIN moments""",
    "min_group_guard": f"""WITH {PANEL}, {split_of('panel', calendar=False)}
        SELECT city_id, count(*) AS n_rows, count(sale_amount_pred) AS n_targets FROM parted
        WHERE split = 'train' GROUP BY city_id HAVING count(*) >= 100 AND count(sale_amount_pred) >= 50""",
    "valid_rows": f"""WITH {PANEL}, {LOOKED}, {split_of('looked')}
        SELECT split, count(*) AS n, min(dt) AS first_day FROM parted
        WHERE sale_amount_pred IS NOT NULL AND {' AND '.join(f'{c} IS NOT NULL' for c in _FILLED)}
        GROUP BY split""",
}
