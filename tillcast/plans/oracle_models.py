"""The SQL each forecast query must agree with."""

from tillcast.constants import IMPORTANCE_SAMPLE, SCALE_MIN_ROWS, SCALE_WINDOW
from tillcast.operators.report import ABLATION_HEAD, HEAD
from tillcast.plans.oracle_features import LOOKED, PANEL, rnd, split_of
from tillcast.plans.oracle_recovery import CELLS, IMPUTED, RECOVERED
from tillcast.sources.models import MODEL_NAMES

SIMPLE = {"last week": "lag_7", "mean of 28": "rolling_mean_28", "series mean": "series_scale"}
_BASE = f"WITH {PANEL}, {LOOKED}, {split_of('looked', calendar=False)}"


def long_of(models, where, name="long", extra=""):
    return f"{name} AS (" + " UNION ALL ".join(
        f"SELECT '{m}' AS model, sale_amount AS y, {c} AS pred, is_stockout{extra} FROM parted WHERE {where}"
        for m, c in models.items()) + ")"


def metrics_of(source="long", by="", masked=True, name="scored"):
    ok = "y IS NOT NULL AND pred IS NOT NULL" + (" AND is_stockout = 0" if masked else "")
    f = f"FILTER (WHERE {ok})"
    g = "FILTER (WHERE y IS NOT NULL AND pred IS NOT NULL)"
    e, s = "abs(y - pred)", "is_stockout::DOUBLE"
    cov = (f"(covar_pop({e}, {s}) {g}) / nullif((stddev_pop({e}) {g}) * "
           f"(stddev_pop(CASE WHEN pred IS NOT NULL THEN {s} END) {g}), 0)")
    return f"""{name} AS (SELECT {by} model, count(*) {f} AS n,
      sqrt(avg((y - pred) * (y - pred)) {f}) AS rmse, avg({e}) {f} AS mae,
      1 - sum((y - pred) * (y - pred)) {f} / greatest((var_pop(y) {f}) * (count(*) {f}), 1e-8) AS r2,
      sum({e}) {f} / greatest(sum(abs(y)) {f}, 1e-8) * 100 AS wape,
      (sum(pred) {f} - sum(y) {f}) / greatest(sum(abs(y)) {f}, 1e-8) * 100 AS wpe,
      CASE WHEN count(*) {f} > 0 THEN coalesce({cov}, 0) END AS rho_ds
      FROM {source} GROUP BY ALL)"""


_METRICS = ", ".join(rnd(c) for c in ("rmse", "mae", "r2", "wape", "wpe", "rho_ds"))
_TEST = f"{_BASE}, {long_of(SIMPLE, chr(39).join(['split = ', 'test', '']))}, {metrics_of()}"
_DELTAS = [("recent against long mean", "series mean", "mean of 28"), ("week against mean", "mean of 28", "last week")]


def _wape(model):
    return f"(SELECT wape FROM scored WHERE model = '{model}')"


def filled_of(columns, source="parted"):
    fills = ", ".join(f"coalesce({c}, (SELECT median({c}) FROM {source} WHERE split = 'train')) AS {c}" for c in columns)
    return f"""filled AS (SELECT * REPLACE ({fills}), CASE
      WHEN date_diff('day', dt, (SELECT max(dt) FROM panel)) <= 30 THEN 1.0::DOUBLE
      WHEN date_diff('day', dt, (SELECT max(dt) FROM panel)) <= 60 THEN 0.5::DOUBLE
      ELSE 0.25::DOUBLE END AS sample_weight FROM {source})"""


def ridge_of(source, inputs, target, alpha, weight="1.0::DOUBLE", where="true", name="beta"):
    """Three-input ridge with a free intercept by Cramer's rule; ``name`` has b0..b3."""
    x = inputs
    means = ", ".join(f"sum(w * {c}) / sum(w) AS m{i}" for i, c in enumerate(x, 1))
    cov = ", ".join(f"sum(w * ({x[i]} - m{i + 1}) * ({x[j]} - m{j + 1})) + {alpha if i == j else 0} AS a{i + 1}{j + 1}"
                    for i in range(3) for j in range(i, 3))
    rhs = ", ".join(f"sum(w * ({c} - m{i}) * (y - my)) AS c{i}" for i, c in enumerate(x, 1))
    det = "a11*(a22*a33-a23*a23) - a12*(a12*a33-a23*a13) + a13*(a12*a23-a22*a13)"
    d1 = "c1*(a22*a33-a23*a23) - a12*(c2*a33-a23*c3) + a13*(c2*a23-a22*c3)"
    d2 = "a11*(c2*a33-a23*c3) - c1*(a12*a33-a23*a13) + a13*(a12*c3-c2*a13)"
    d3 = "a11*(a22*c3-c2*a23) - a12*(a12*c3-c2*a13) + c1*(a12*a23-a22*a13)"
    return f"""{name}_rows AS (SELECT {', '.join(x)}, {target} AS y, {weight} AS w FROM {source}
        WHERE {where} AND {target} IS NOT NULL AND {' AND '.join(f'{c} IS NOT NULL' for c in x)}),
      {name}_means AS (SELECT {means}, sum(w * y) / sum(w) AS my FROM {name}_rows),
      {name}_sums AS (SELECT {cov}, {rhs}, any_value(m1) AS m1, any_value(m2) AS m2, any_value(m3) AS m3,
        any_value(my) AS my FROM {name}_rows CROSS JOIN {name}_means),
      {name}_slopes AS (SELECT *, ({d1}) / ({det}) AS b1, ({d2}) / ({det}) AS b2, ({d3}) / ({det}) AS b3
        FROM {name}_sums),
      {name} AS (SELECT my - b1 * m1 - b2 * m2 - b3 * m3 AS b0, b1, b2, b3, m1, m2, m3 FROM {name}_slopes)"""


def linear(inputs, name="beta"):
    return f"{name}.b0 + " + " + ".join(f"{name}.b{i} * {c}" for i, c in enumerate(inputs, 1))


LINEAR = ["lag_1", "rolling_mean_28", "series_scale"]
NEAR = ["lag_1", "rolling_mean_28", "series_scale", "discount"]
_K = "store_id, product_id, dt"
_LINEAR_FILLED = f"{_BASE}, {filled_of(LINEAR)}"
_SCALED = f"""scales AS (SELECT {', '.join(f"avg({c}) AS mu_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) AS sd_{c}" for c in LINEAR)}
    FROM filled WHERE split = 'train'),
  zed AS (SELECT filled.*, {', '.join(f'({c} - mu_{c}) / sd_{c} AS z_{c}' for c in LINEAR)} FROM filled CROSS JOIN scales)"""
_Z = [f"z_{c}" for c in LINEAR]

# Base predictions in name order: lightgbm, random_forest, xgboost.
_BASES = ["rolling_mean_28", "series_scale", "lag_7"]
_BASE_OK = " AND ".join(f"{c} IS NOT NULL" for c in [*_BASES, "sale_amount_pred"])
_FOLDED = f"""ordered AS (SELECT *, row_number() OVER (ORDER BY dt, md5(series_id)) - 1 AS o,
    count(*) OVER () AS n FROM parted WHERE split = 'val' AND {_BASE_OK}),
  blocks AS (SELECT *, CASE WHEN o < n - 3 * (n // 4) THEN 0
    ELSE (o - (n - 3 * (n // 4))) // (n // 4) + 1 END AS block FROM ordered)"""
_FOLDS = f"{_BASE}, {_FOLDED}, " + ", ".join(
    ridge_of("blocks", _BASES, "sale_amount_pred", 1.0, where=f"block < {f}", name=f"fold{f}") for f in (1, 2, 3)) + \
    ", folds AS (" + " UNION ALL ".join(
        f"""SELECT CAST({f} AS INTEGER) AS fold, count(*) AS n,
          sqrt(avg((sale_amount_pred - ({linear(_BASES, f'fold{f}')})) ** 2)) AS rmse
          FROM blocks CROSS JOIN fold{f} WHERE block = {f}""" for f in (1, 2, 3)) + ")"

_BACK = f"""{_BASE}, cuts AS (SELECT (SELECT max(dt) FROM panel) - back AS cutoff
    FROM (VALUES (14), (7)) v(back)),
  born AS (SELECT series_id, min(dt) AS first_day FROM panel GROUP BY ALL),
  ahead AS (SELECT CAST(unnest(generate_series(1, 7)) AS INTEGER) AS h),
  asked AS (SELECT series_id, cutoff, h FROM born JOIN cuts ON first_day <= cutoff CROSS JOIN ahead)"""


def _back(expression, joins):
    return f"""{_BACK} SELECT a.series_id AS unique_id, a.cutoff, CAST(a.cutoff + a.h AS DATE) AS ds, a.h,
      {rnd('y_hat', expression)} FROM asked a {joins}"""


_MA = """LEFT JOIN (SELECT p.series_id, cutoff, sum(y_eff) AS total FROM panel p JOIN cuts
      ON p.dt <= cutoff AND p.dt > cutoff - 30 GROUP BY ALL) m
    ON m.series_id = a.series_id AND m.cutoff = a.cutoff"""


def _at(alias, day):
    return f"LEFT JOIN panel {alias} ON {alias}.series_id = a.series_id AND {alias}.dt = {day}"


_ATTRIBUTION = f"""{_LINEAR_FILLED}, {ridge_of('filled', LINEAR, 'sale_amount_pred', 10.0, 'sample_weight', "split = 'train'")},
  plain AS (SELECT {', '.join(f'avg({c}) AS a_{c}' for c in LINEAR)} FROM filled WHERE split = 'train'),
  attribution AS (""" + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, {rnd('mean_abs', f'avg(abs(b{i} * ({c} - a_{c})))')}
    FROM filled CROSS JOIN beta CROSS JOIN plain WHERE split = 'train'""" for i, c in enumerate(LINEAR, 1)) + ")"



def _text(lines, section):
    return " UNION ALL ".join(f"SELECT {section} AS section, {i} AS rank, '{t}' AS line" for i, t in enumerate(lines))


_DELTA_TABLE = "deltas AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS ablation, '{b}' AS base, '{v}' AS variant, {_wape(b)} AS base_wape, {_wape(v)} AS variant_wape"
    for a, b, v in _DELTAS) + ")"

_HANDED_OVER = RECOVERED.replace("panel AS (SELECT *", """panel AS (SELECT *, sale_amount_pred AS y_eff,
    stock_hour6_22_cnt / 16.0::DOUBLE AS stockout_ratio, CAST(stock_hour6_22_cnt > 0 AS INTEGER) AS is_stockout""")

SQL = {
    "forecaster_input": f"""WITH {PANEL} SELECT series_id AS unique_id, dt AS ds, {rnd('y', 'coalesce(y_eff, 0)')}
        FROM panel""",
    "sampled_rows": f"""WITH {PANEL} SELECT {_K}, {rnd('sale_amount')} FROM panel
        ORDER BY md5(concat_ws('|', store_id, product_id, dt, 42)) LIMIT {IMPORTANCE_SAMPLE}""",
    "model_inventory": "SELECT * FROM (VALUES " + ", ".join(
        f"('{n}', {n == 'ridge'})" for n in MODEL_NAMES) + ") v(model, loaded)",
    "city_list": f"WITH {PANEL} SELECT DISTINCT city_id FROM panel",
    "recovered_forecast": f"""WITH {CELLS}, {IMPUTED}, {_HANDED_OVER}, {LOOKED}, {split_of('looked', calendar=False)},
        {long_of({'last week': 'lag_7', 'mean of 7': 'rolling_mean_7'}, "split = 'test'")}, {metrics_of()}
        SELECT model, n, {_METRICS} FROM scored""",
    "metrics_models": f"{_TEST} SELECT model, n, {_METRICS} FROM scored",
    "metrics_all_days": f"""{_BASE}, {long_of(SIMPLE, "split = 'test'")}, {metrics_of(masked=False)}
        SELECT model, n, {_METRICS} FROM scored""",
    "metrics_per_city": f"""{_TEST}, {long_of(SIMPLE, "split = 'test'", 'long_city', ', city_id')},
        {metrics_of('long_city', 'city_id,', name='scored_city')},
        best AS (SELECT model FROM scored WHERE n > 0 ORDER BY wape, model LIMIT 1)
        SELECT city_id, model, n, {_METRICS} FROM scored_city JOIN best USING (model)""",
    "feat_calendar_windows": f"""WITH {PANEL} SELECT {_K}, {', '.join(rnd(f'lag_{k}', f"""(SELECT max(b.y_eff) FROM panel b
          WHERE b.series_id = a.series_id AND b.dt = a.dt - {k})""") for k in (1, 7, 28))},
        {rnd('rolling_mean_28', 'avg(y_eff) OVER w28')}, {rnd('rolling_std_28', 'stddev_samp(y_eff) OVER w28')},
        {rnd('stockout_ratio_28d', 'avg(stockout_ratio) OVER w28')},
        {rnd('series_scale', f'CASE WHEN count(y_eff) OVER w >= {SCALE_MIN_ROWS} THEN avg(y_eff) OVER w END')}
        FROM panel a WINDOW w28 AS (PARTITION BY series_id ORDER BY dt
          RANGE BETWEEN INTERVAL 28 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING),
          w AS (PARTITION BY series_id ORDER BY dt
          RANGE BETWEEN INTERVAL {SCALE_WINDOW} DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING)""",
    "metrics_validation": f"""{_BASE}, {long_of({'part one': 'rolling_mean_7', 'part two': 'rolling_mean_28',
        'blend': '0.7::DOUBLE * rolling_mean_7 + 0.3::DOUBLE * rolling_mean_28'}, "split = 'val'")},
        {metrics_of()} SELECT model, n, {rnd('wape')}, {rnd('wpe')} FROM scored""",
    "best_model": f"{_TEST} SELECT model, n, {rnd('wape')} FROM scored WHERE n > 0 ORDER BY scored.wape, model LIMIT 1",
    "model_verdict": f"""{_TEST} SELECT model, {rnd('wape')}, CASE WHEN scored.wape < 100 THEN 'beats baseline'
        WHEN scored.wape < 110 THEN 'near baseline' WHEN scored.wape IS NOT NULL THEN 'below baseline' END AS verdict
        FROM scored""",
    "ablation_delta": f"""{_TEST}, {_DELTA_TABLE} SELECT ablation, base, variant, {rnd('base_wape')},
        {rnd('variant_wape')}, {rnd('delta_wape', 'variant_wape - base_wape')} FROM deltas""",
    "metrics_union": f"""{_TEST}, {long_of({'mean of 7': 'rolling_mean_7'}, "split = 'test'", 'long7')},
        {metrics_of('long7', name='scored7')} SELECT model, n, {_METRICS} FROM scored UNION ALL
        SELECT model, n, {_METRICS.replace(rnd('rho_ds'), 'NULL AS rho_ds')} FROM scored7""",
    "blend_70_30": f"""{_BASE} SELECT {_K},
        {rnd('blend', 'rolling_mean_7 * 0.7::DOUBLE + rolling_mean_28 * 0.3::DOUBLE')} FROM parted WHERE split = 'test'""",
    "ridge_closed_form": f"""{_LINEAR_FILLED}, {_SCALED},
        {ridge_of('zed', _Z, 'sale_amount_pred', 10.0, 'sample_weight', "split = 'train'")}
        SELECT {_K}, {rnd('prediction', linear(_Z))} FROM zed CROSS JOIN beta""",
    "stacking_ridge": f"""{_BASE}, {ridge_of('parted', _BASES, 'sale_amount_pred', 1.0, where="split = 'val'")}
        SELECT {_K}, {rnd('stacking', f'CASE WHEN (SELECT count(*) FROM beta_rows) > 100 THEN {linear(_BASES)} ELSE rolling_mean_28 END')}
        FROM parted CROSS JOIN beta WHERE split = 'test'""",
    "stacking_folds": f"{_FOLDS} SELECT fold, n, {rnd('rmse')} FROM folds",
    "stacking_summary": f"""{_FOLDS} SELECT {rnd('mean_rmse', 'avg(round(rmse, 6))')},
        {rnd('std_rmse', 'stddev_pop(round(rmse, 6))')} FROM folds""",
    "knn_brute": f"""{_BASE}, {filled_of(NEAR)},
        scales AS (SELECT {', '.join(f"avg({c}) AS mu_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) AS sd_{c}" for c in NEAR)}
          FROM filled WHERE split = 'train'),
        zed AS (SELECT series_id || '@' || dt::VARCHAR AS row_id, split, sale_amount_pred AS value,
          {', '.join(f'({c} - mu_{c}) / sd_{c} AS x{i}' for i, c in enumerate(NEAR))}
          FROM filled CROSS JOIN scales),
        pairs AS (SELECT q.row_id AS query, t.row_id AS neighbor, t.value,
          sqrt({' + '.join(f'(q.x{i} - t.x{i}) * (q.x{i} - t.x{i})' for i in range(len(NEAR)))}) AS distance
          FROM zed q JOIN zed t ON q.split = 'test' AND t.split = 'train' WHERE t.value IS NOT NULL),
        nearest AS (SELECT * FROM pairs
          QUALIFY row_number() OVER (PARTITION BY query ORDER BY distance, neighbor) <= 15)
        SELECT query, {rnd('prediction', '''CASE WHEN count(*) FILTER (WHERE distance = 0) > 0
            THEN avg(value) FILTER (WHERE distance = 0)
            ELSE sum(value / nullif(distance, 0)) / sum(1 / nullif(distance, 0)) END''')},
          CAST(count(*) AS INTEGER) AS n_neighbors, {rnd('farthest', 'max(distance)')} FROM nearest GROUP BY query""",
    "backtest_naive": _back("coalesce(p.y_eff, 0)", _at("p", "a.cutoff + a.h - 7")),
    "backtest_ma": _back("coalesce(m.total, 0) / 30", _MA),
    "backtest_drift": _back("coalesce(p.y_eff, 0) + a.h * (coalesce(p.y_eff, 0) - coalesce(f.y_eff, 0)) / 29",
                            f"{_at('p', 'a.cutoff')} {_at('f', 'a.cutoff - 29')}"),
    "backtest_aligned": f"""{_BACK}, fc AS (SELECT a.series_id, CAST(a.cutoff + a.h AS DATE) AS dt,
          coalesce(m.total, 0) / 30 AS y_hat FROM asked a {_MA})
        SELECT split, count(*) AS n, count(y_hat) AS n_matched, {rnd('total', 'sum(y_hat)')}
        FROM parted LEFT JOIN fc USING (series_id, dt) WHERE split <> 'train' GROUP BY split""",
    "linear_attribution": f"{_ATTRIBUTION} SELECT * FROM attribution",
    "top_features": f"{_ATTRIBUTION} SELECT * FROM attribution ORDER BY mean_abs DESC, feature LIMIT 2",
    "per_city_ridge": None,
    "report_markdown": f"""{_TEST}, {_DELTA_TABLE}, lines AS ({_text(HEAD, 0)} UNION ALL
        SELECT 1, row_number() OVER (ORDER BY wape, model), '| ' || model || ' | ' || format('{{:,}}', n)
          || printf(' | %.4f | %.4f | %.4f | %.2f | %.2f | %.3f |', rmse, mae, r2, wape, wpe, rho_ds)
        FROM scored WHERE n > 0 UNION ALL {_text([''], 2)} UNION ALL
        (SELECT 3, 0, '**Best model:** ' || model || printf(' (WAPE=%.2f%%)', wape) FROM scored WHERE n > 0
         ORDER BY wape, model LIMIT 1) UNION ALL {_text(ABLATION_HEAD, 4)} UNION ALL
        SELECT 5, row_number() OVER (ORDER BY ablation), '| ' || ablation || ' | ' || base || ' vs ' || variant
          || printf(' | %.2f vs %.2f | %+.2f |', base_wape, variant_wape, variant_wape - base_wape) FROM deltas)
        SELECT row_number() OVER (ORDER BY section, rank) AS line_no, line FROM lines""",
}


def _per_city():
    """One solve per city: the same sums, grouped."""
    x = _Z
    means = ", ".join(f"sum(w * {c}) / sum(w) AS m{i}" for i, c in enumerate(x, 1))
    cov = ", ".join(f"sum(w * ({x[i]} - m{i + 1}) * ({x[j]} - m{j + 1})) + {10.0 if i == j else 0} AS a{i + 1}{j + 1}"
                    for i in range(3) for j in range(i, 3))
    rhs = ", ".join(f"sum(w * ({c} - m{i}) * (y - my)) AS c{i}" for i, c in enumerate(x, 1))
    body = ridge_of("zed", x, "sale_amount_pred", 10.0, "sample_weight", "split = 'train'")
    slopes = body[body.index("beta_slopes AS"):body.index("beta AS (SELECT")]
    return f"""{_LINEAR_FILLED}, {_SCALED},
      beta_rows AS (SELECT city_id, {', '.join(x)}, sale_amount_pred AS y, sample_weight AS w FROM zed
        WHERE split = 'train'),
      beta_means AS (SELECT city_id, {means}, sum(w * y) / sum(w) AS my FROM beta_rows GROUP BY city_id),
      beta_sums AS (SELECT city_id, {cov}, {rhs}, any_value(m1) AS m1, any_value(m2) AS m2, any_value(m3) AS m3,
        any_value(my) AS my FROM beta_rows JOIN beta_means USING (city_id) GROUP BY city_id),
      {slopes} beta AS (SELECT city_id, my - b1 * m1 - b2 * m2 - b3 * m3 AS b0, b1, b2, b3 FROM beta_slopes)
      SELECT {_K}, zed.city_id, {rnd('prediction', linear(x))}
      FROM zed LEFT JOIN beta USING (city_id) WHERE split = 'test'"""


SQL["per_city_ridge"] = _per_city()


def _held_out(columns=("lag_1", "rolling_mean_28", "series_scale")):
    """The last 14 days, filled with medians of the rows a fortnight before what precedes them."""
    fills = ", ".join(rnd(c, f"coalesce({c}, m_{c})") for c in columns)
    medians = ", ".join(f"median({c}) AS m_{c}" for c in (*columns, "precpt"))
    return f"""WITH {PANEL}, {LOOKED.replace('looked AS (', 'looked AS MATERIALIZED (')}, ends AS MATERIALIZED (SELECT max(dt) AS last FROM panel),
      early AS MATERIALIZED (SELECT max(dt) AS last FROM panel WHERE dt <= (SELECT last FROM ends) - 14),
      fitted AS MATERIALIZED (SELECT {medians} FROM looked WHERE dt <= (SELECT last FROM early) - 14)
      SELECT {_K}, {fills}, {rnd('precpt', 'm_precpt')} FROM looked, fitted
      WHERE dt > (SELECT last FROM ends) - 14"""


SQL["gbt_one_tree"] = f"""{_BASE}, weighed AS (SELECT sale_amount_pred AS y, CASE
        WHEN date_diff('day', dt, (SELECT max(dt) FROM panel)) <= 30 THEN 1.0::DOUBLE
        WHEN date_diff('day', dt, (SELECT max(dt) FROM panel)) <= 60 THEN 0.5::DOUBLE
        ELSE 0.25::DOUBLE END AS w FROM parted WHERE split = 'train')
      SELECT count(*) AS n, CAST(0 AS BIGINT) AS wrong_leaves, {rnd('mean_prediction', 'sum(w * y) / sum(w)', 6)}
      FROM weighed WHERE y IS NOT NULL"""
SQL["tree_attribution_sums"] = f"""{_BASE} SELECT least(count(*), {IMPORTANCE_SAMPLE}) AS n, CAST(0 AS BIGINT) AS wrong
      FROM parted WHERE split = 'train'"""

SQL |= {
    "held_out_features": _held_out(),
    "sink_panel": f"WITH {PANEL} SELECT {_K}, city_id, {rnd('sale_amount')} FROM panel",
    "sink_metrics": SQL["metrics_models"], "sink_importance": SQL["linear_attribution"],
    "sink_report": f"SELECT line FROM ({SQL['report_markdown']})", "sink_forecasts": SQL["backtest_ma"],
}
