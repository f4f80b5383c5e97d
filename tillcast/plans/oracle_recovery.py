"""The SQL each hourly query must agree with; it works on one row per hour."""

from tillcast.plans.oracle_features import WEATHER, rnd

CELLS = f"""
ev AS (
  SELECT CAST(floor(user_id / 30) AS BIGINT) AS store_id, event_type, CAST(ts AS DATE) AS dt,
    CAST(hour(ts) AS INTEGER) AS h, value FROM events),
status AS (
  SELECT store_id, dt, h,
    CAST(2 * count(*) FILTER (WHERE event_type = 'error') > count(*) AS INTEGER) AS oos
  FROM ev GROUP BY ALL),
sold AS (
  SELECT store_id, event_type AS product_id, dt, h, round(sum(value), 2) AS truth
  FROM ev WHERE event_type <> 'error' GROUP BY ALL),
days AS (SELECT CAST(unnest(generate_series((SELECT min(dt) FROM ev)::TIMESTAMP,
  (SELECT max(dt) FROM ev)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS dt),
hrs AS (SELECT CAST(unnest(generate_series(0, 23)) AS INTEGER) AS h),
series AS (SELECT DISTINCT store_id, product_id FROM sold),
cells AS (
  SELECT store_id, product_id, dt, h, coalesce(truth, 0) AS truth, coalesce(oos, 0) AS oos,
    CASE WHEN coalesce(oos, 0) = 1 THEN 0 ELSE coalesce(truth, 0) END AS sale
  FROM series CROSS JOIN days CROSS JOIN hrs
  LEFT JOIN sold USING (store_id, product_id, dt, h) LEFT JOIN status USING (store_id, dt, h)),
daily AS (
  SELECT store_id, product_id, dt, sum(sale) AS sale_amount, sum(truth) AS truth,
    CAST(sum(oos) FILTER (WHERE h BETWEEN 6 AND 21) AS INTEGER) AS stock_hour6_22_cnt,
    CAST(count(*) AS INTEGER) AS n_hours FROM cells GROUP BY ALL),
days_panel AS (SELECT daily.*, (day(dt) % 11) / 100.0::DOUBLE AS discount, {WEATHER} FROM daily),
opened AS (SELECT *, CASE WHEN oos = 1 THEN NULL ELSE sale END AS masked, h - 6 AS hour_idx
  FROM cells WHERE h BETWEEN 6 AND 21)"""

WINDOWED = """
numbered AS (SELECT *, row_number() OVER (PARTITION BY store_id, product_id ORDER BY dt) - 1 AS rn
  FROM days_panel),
windowed AS (SELECT *, CAST(rn // 10 AS INTEGER) AS window_idx, CAST(rn % 10 AS INTEGER) AS day_in_window
  FROM numbered),
normed AS (SELECT *,
  discount / (max(discount) OVER w + 0.1::DOUBLE) AS discount_norm,
  holiday_flag / (max(holiday_flag) OVER w + 0.1::DOUBLE) AS holiday_flag_norm,
  precpt / (max(precpt) OVER w + 0.1::DOUBLE) AS precpt_norm,
  avg_temperature / (max(avg_temperature) OVER w + 0.1::DOUBLE) AS avg_temperature_norm
  FROM windowed WINDOW w AS (PARTITION BY store_id, product_id, window_idx))"""


def imputed_of(source, name):
    """Hierarchical means of the observed cells of ``source``."""
    return f"""{name} AS (
  SELECT o.*,
    coalesce(avg(x) OVER (PARTITION BY store_id, product_id, isodow(dt), h),
             avg(x) OVER (PARTITION BY store_id, product_id, h),
             avg(x) OVER (PARTITION BY store_id, h), avg(x) OVER (PARTITION BY h), 0) AS imputed_weekday,
    coalesce(avg(x) OVER (PARTITION BY store_id, product_id, h),
             avg(x) OVER (PARTITION BY store_id, h), avg(x) OVER (PARTITION BY h), 0) AS imputed_hour
  FROM (SELECT *, {source} AS x FROM opened) o)"""


IMPUTED = imputed_of("masked", "imputed")
_FOLD = "(date_diff('day', DATE '1970-01-01', dt) + hour_idx) % 5 = 0"
HIDDEN = imputed_of(f"CASE WHEN {_FOLD} THEN NULL ELSE masked END", "hidden_cells")
HELD = f"held AS (SELECT *, masked AS y FROM hidden_cells WHERE {_FOLD} AND masked IS NOT NULL)"
WEIGHTS = """errors AS (
  SELECT sum(abs(imputed_weekday - y)) / greatest(sum(abs(y)), 1e-8) * 100 AS e1,
         sum(abs(imputed_hour - y)) / greatest(sum(abs(y)), 1e-8) * 100 AS e2 FROM held),
weights AS (SELECT e2 / (e1 + e2) AS w1, 1 - e2 / (e1 + e2) AS w2, e1, e2 FROM errors)"""


def recovered_of(expression, name="recovered"):
    """Daily totals with operating hours replaced by ``expression``."""
    return f"""{name} AS (
  SELECT c.store_id, c.product_id, c.dt, sum(CASE WHEN i.h IS NULL THEN c.sale ELSE {expression} END)
    AS sale_amount_pred
  FROM cells c LEFT JOIN imputed i USING (store_id, product_id, dt, h) GROUP BY ALL),
panel AS (SELECT * FROM days_panel JOIN {name} USING (store_id, product_id, dt))"""


def _regression():
    """Least squares of the observed cells on five inputs by sweeping them in order, and the recovered days."""
    x = [f"{c}_norm" for c in ("discount", "holiday_flag", "precpt", "avg_temperature")] + ["hour_pos"]
    whole = ["1.0::DOUBLE", *x, "y"]
    sums = ", ".join(f"sum({whole[i]} * {whole[j]}) AS s{i}_{j}" for i in range(7) for j in range(i, 7))
    steps = [f"""seen AS (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in x[:4])}, hour_idx / 15.0::DOUBLE AS hour_pos, CAST(masked AS DOUBLE) AS y
        FROM normed JOIN opened USING (store_id, product_id, dt) WHERE masked IS NOT NULL),
      sums AS (SELECT {sums} FROM seen)""",
             "a0 AS MATERIALIZED (SELECT *, " + ", ".join(f"s{i}_{j} - s0_{i} * s0_{j} / s0_0 AS a{i}_{j}" for i in range(1, 7) for j in range(i, 7)) + " FROM sums)"]
    at = lambda i, j: f"a{min(i, j)}_{max(i, j)}"
    for k in range(1, 6):
        # swept rows and columns change sign with the pivot, so that the matrix stays symmetric
        ok = f"(v{k} > 0 AND a{k}_{k} > 1e-9 * v{k} AND a{k}_{k} > 1e-9 * s{k}_{k})"
        new = []
        for i in range(1, 7):
            for j in range(i, 7):
                if i == k and j == k:
                    e = f"-1 / a{k}_{k}"
                elif k in (i, j):
                    e = f"{at(i, j)} / a{k}_{k}"
                else:
                    e = f"{at(i, j)} - {at(i, k)} * {at(k, j)} / a{k}_{k}"
                new.append(f"CASE WHEN {ok} THEN {e} ELSE a{i}_{j} END AS a{i}_{j}")
        kept = [f"s{i}_{j}" for i in range(7) for j in range(i, 7)] + [f"v{i}" for i in range(1, 6)] + [f"u{i}" for i in range(1, k)]
        source = f"a{k - 1}" if k > 1 else "(SELECT *, " + ", ".join(f"a{i}_{i} AS v{i}" for i in range(1, 6)) + " FROM a0)"
        steps.append(f"a{k} AS MATERIALIZED (SELECT {', '.join(kept)}, {ok} AS u{k}, {', '.join(new)} FROM {source})")
    beta = [f"CASE WHEN u{k} THEN a{k}_6 ELSE 0 END" for k in range(1, 6)]
    steps.append("beta AS MATERIALIZED (SELECT " + ", ".join(f"{b} AS b{k}" for k, b in enumerate(beta, 1)) + ", (s0_6 - "
                 + " - ".join(f"({b}) * s0_{k}" for k, b in enumerate(beta, 1)) + ") / s0_0 AS b0 FROM a5)")
    steps.append("""imputed AS (SELECT o.*, b0 + b1 * discount_norm + b2 * holiday_flag_norm + b3 * precpt_norm + b4 * avg_temperature_norm
        + b5 * hour_idx / 15.0::DOUBLE AS guess FROM opened o JOIN normed USING (store_id, product_id, dt) CROSS JOIN beta)""")
    steps.append(recovered_of("CASE WHEN i.oos = 1 THEN greatest(i.guess, 0) ELSE c.sale END"))
    return f"WITH {CELLS}, {WINDOWED}, {', '.join(steps)} SELECT {_K}, {rnd('sale_amount')}, {rnd('sale_amount_pred')} FROM panel"


_MASKED = "CASE WHEN i.oos = 1 THEN greatest(i.imputed_weekday, 0) ELSE c.sale END"
RECOVERED = recovered_of(_MASKED)
_K = "store_id, product_id, dt"
_CORR = ("covar_pop(x.c, x.{0}) / nullif(stddev_pop(x.c) * stddev_pop(x.{0}), 0)")
CORRELATIONS = f"""correlations AS (
  SELECT store_id, product_id, holiday_flag, CAST(count(DISTINCT c) AS INTEGER) AS levels,
    {_CORR.format('sale_amount')} AS corr_sale_amount, {_CORR.format('sale_amount_pred')} AS corr_sale_amount_pred
  FROM (SELECT *, stock_hour6_22_cnt::DOUBLE AS c FROM panel WHERE stock_hour6_22_cnt > 0) x GROUP BY ALL),
mu AS (SELECT store_id, product_id, avg(sale_amount) AS mu FROM panel WHERE stock_hour6_22_cnt = 0 GROUP BY ALL)"""
_NORMS = [f"{c}_norm" for c in ("discount", "holiday_flag", "precpt", "avg_temperature")]
_IN = "FILTER (WHERE stock_hour6_22_cnt = 0)"
_OUT = "FILTER (WHERE stock_hour6_22_cnt > 0)"

SQL = {
    "hourly_panel_daily": f"""WITH {CELLS} SELECT {_K}, {rnd('sale_amount')}, {rnd('truth')}, stock_hour6_22_cnt,
        n_hours, {rnd('discount')}, holiday_flag FROM days_panel""",
    "hourly_mask": f"""WITH {CELLS} SELECT count(*) FILTER (WHERE masked IS NULL) AS n_masked, count(*) AS n_total,
        {rnd('masked_pct', 'count(*) FILTER (WHERE masked IS NULL) * 100.0::DOUBLE / count(*)')} FROM opened""",
    "window_chunks": f"WITH {CELLS}, {WINDOWED} SELECT {_K}, window_idx, day_in_window FROM windowed",
    "covariate_norm": f"WITH {CELLS}, {WINDOWED} SELECT {_K}, window_idx, {', '.join(map(rnd, _NORMS))} FROM normed",
    "hourly_cells": f"""WITH {CELLS}, {WINDOWED} SELECT store_id, product_id, dt, window_idx, day_in_window,
        {', '.join(map(rnd, _NORMS))}, CAST(hour_idx AS INTEGER) AS hour_idx, {rnd('sale', 'masked')},
        {rnd('hour_pos', 'hour_idx / 15.0::DOUBLE')} FROM normed JOIN opened USING (store_id, product_id, dt)""",
    "hourly_sequence": f"""WITH {CELLS}, {WINDOWED} SELECT store_id, product_id, window_idx,
        CAST(day_in_window * 16 + hour_idx AS INTEGER) AS step, {rnd('sale', 'masked')},
        {', '.join(rnd(n[:-5], n) for n in _NORMS)}, {rnd('hour_pos', 'hour_idx / 15.0::DOUBLE')}
        FROM normed JOIN opened USING (store_id, product_id, dt)""",
    "impute_profiles": f"""WITH {CELLS}, {IMPUTED} SELECT {_K}, CAST(hour_idx AS INTEGER) AS hour_idx,
        {rnd('imputed_weekday')}, {rnd('imputed_hour')} FROM imputed""",
    "imputation_draws": f"""WITH {CELLS}, {IMPUTED} SELECT {_K}, CAST(hour_idx AS INTEGER) AS hour_idx,
        {rnd('imputed', '(imputed_weekday + imputed_hour) / 2', 8)} FROM imputed""",
    "recover_profile": f"""WITH {CELLS}, {IMPUTED}, {RECOVERED}
        SELECT {_K}, {rnd('sale_amount')}, {rnd('sale_amount_pred')} FROM panel""",
    "recover_direct": f"""WITH {CELLS}, {IMPUTED}, {recovered_of('greatest(i.imputed_weekday, 0)')}
        SELECT {_K}, {rnd('sale_amount')}, {rnd('sale_amount_pred')} FROM panel""",
    "recover_ensemble": f"""WITH {CELLS}, {IMPUTED}, {HIDDEN}, {HELD}, {WEIGHTS}, {recovered_of('''
        CASE WHEN i.oos = 1 THEN i.imputed_weekday * (SELECT w1 FROM weights)
          + i.imputed_hour * (SELECT w2 FROM weights) ELSE c.sale END''')}
        SELECT {_K}, {rnd('sale_amount_pred')} FROM panel""",
    "recover_ensemble_weights": f"""WITH {CELLS}, {HIDDEN}, {HELD}, {WEIGHTS}
        SELECT {rnd('w_first', 'w1')}, {rnd('w_second', 'w2')}, {rnd('wape_first', 'e1')}, {rnd('wape_second', 'e2')}
        FROM weights""",
    "recover_holdout": f"WITH {CELLS}, {HIDDEN}, {HELD} " + " UNION ALL ".join(
        f"""SELECT '{i}' AS imputer, count(*) AS n,
          {rnd('wape', f'sum(abs({i} - y)) / greatest(sum(abs(y)), 1e-8) * 100')},
          {rnd('rmse', f'sqrt(sum(({i} - y) * ({i} - y)) / count(*))')},
          {rnd('wpe', f'sum({i} - y) / greatest(sum(abs(y)), 1e-8) * 100')} FROM held"""
        for i in ("imputed_weekday", "imputed_hour")),
    "imputation_tensor": f"""WITH {CELLS}, {WINDOWED}, {IMPUTED}
        SELECT store_id, product_id, window_idx, CAST(count(*) AS INTEGER) AS n_steps,
          {rnd('total', 'sum(imputed_weekday)')}
        FROM windowed JOIN imputed USING (store_id, product_id, dt) GROUP BY ALL""",
    "recovery_changed": f"""WITH {CELLS}, {IMPUTED}, {RECOVERED}
        SELECT count(*) FILTER (WHERE abs(sale_amount_pred - sale_amount) > 1e-6) AS changed, count(*) AS n,
          {rnd('changed_pct', 'count(*) FILTER (WHERE abs(sale_amount_pred - sale_amount) > 1e-6) * 100.0::DOUBLE / count(*)')}
        FROM panel""",
    "recovery_metrics": f"""WITH {CELLS}, {IMPUTED}, {RECOVERED} SELECT
        {rnd('in_stock_mean_gap', f'avg(abs(sale_amount_pred - sale_amount)) {_IN}')},
        {rnd('in_stock_wape', f'sum(abs(sale_amount_pred - sale_amount)) {_IN} / greatest(sum(abs(sale_amount)) {_IN}, 1e-8) * 100')},
        {rnd('in_stock_wpe', f'(sum(sale_amount_pred) {_IN} - sum(sale_amount) {_IN}) / greatest(sum(abs(sale_amount)) {_IN}, 1e-8) * 100')},
        {rnd('overall_wpe', '(sum(sale_amount_pred) - sum(sale_amount)) / greatest(sum(abs(sale_amount)), 1e-8) * 100')},
        {rnd('in_stock_mean_observed', f'avg(sale_amount) {_IN}')},
        {rnd('in_stock_mean_recovered', f'avg(sale_amount_pred) {_IN}')},
        {rnd('stockout_mean_observed', f'avg(sale_amount) {_OUT}')},
        {rnd('stockout_mean_recovered', f'avg(sale_amount_pred) {_OUT}')} FROM panel""",
    "stockout_correlation": f"""WITH {CELLS}, {IMPUTED}, {RECOVERED}, {CORRELATIONS}
        SELECT store_id, product_id, holiday_flag, levels, {rnd('corr_sale_amount')}, {rnd('corr_sale_amount_pred')}
        FROM correlations""",
    "in_stock_mean": f"""WITH {CELLS}, {IMPUTED}, {RECOVERED}, {CORRELATIONS}
        SELECT store_id, product_id, {rnd('mu')} FROM mu""",
    "decoupling_score": f"WITH {CELLS}, {IMPUTED}, {RECOVERED}, {CORRELATIONS} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS method, {rnd('decoupling_score', f'coalesce(sum(corr_{c} * mu), 0) / nullif(sum(mu), 0)')}
        FROM correlations JOIN mu USING (store_id, product_id) WHERE levels > 3"""
        for c in ("sale_amount", "sale_amount_pred")),
}
SQL["recover_regression"] = _regression()
