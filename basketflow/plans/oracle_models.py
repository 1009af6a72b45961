"""SQL twins of the model queries: elimination instead of factorisation, residuals as lists, recursions row by row."""

from __future__ import annotations

from itertools import product

from basketflow.plans import model_queries as m
from basketflow.plans.oracle import CHI_TAIL, FOLDS, INDEX_PANEL, SERIES, Z, _r
from basketflow.operators import arima, smoothing

DATE = "strftime(date, '%Y-%m-%d') AS date"
CRITICAL = arima.critical_tau()
MONTHLY = SERIES + ",\nsrc AS (SELECT series_id AS sk, pos, value FROM prepared)"
PARTS = SERIES + ",\nsrc AS (SELECT series_id || '@' || (n - back) AS sk, pos, value FROM prepared, generate_series(1, 12) g(back) WHERE pos < n - back AND n - back >= 12)"
DAILY = (
    INDEX_PANEL
    + """, d AS (SELECT date, sum(price_index * weight) AS value FROM index_panel GROUP BY 1),
src AS (SELECT 'all' AS sk, row_number() OVER (ORDER BY date) - 1 AS pos, value FROM d)"""
)


def _recursive(sql: str) -> str:
    return "WITH RECURSIVE " + sql.strip().removeprefix("WITH ")


def _gram(name: str, rows: str, keys: str) -> str:
    """Sums of products of the entries of the lists x, as a list of rows."""
    return f"""{name} AS (SELECT {keys}, list(r ORDER BY i) AS m FROM (SELECT {keys}, i, list(v ORDER BY j) AS r FROM
  (SELECT {keys}, i, j, sum(x[i] * x[j]) AS v FROM (SELECT {keys}, x, i, unnest(range(1, len(x) + 1)) AS j FROM
    (SELECT {keys}, x, unnest(range(1, len(x) + 1)) AS i FROM {rows})) GROUP BY ALL) GROUP BY ALL) GROUP BY ALL)"""


def _eliminated(name: str, source: str, keys: str, which: str = "<>", stop: int = 0) -> str:
    """One pivot a step: rows behind it (>) or all others (<>) lose its column. The last `stop` + 1 rows are no pivots."""
    return f"""{name} AS (SELECT {keys}, m, 0 AS k FROM {source} UNION ALL
  SELECT {keys}, list_transform(m, lambda row, i: CASE WHEN i {which} k + 1 THEN list_transform(row, lambda v, j: v - row[k + 1] / m[k + 1][k + 1] * m[k + 1][j]) ELSE row END), k + 1
  FROM {name} WHERE k + 1 < len(m) - {stop})"""


ADF = f"""centred AS (SELECT sk, list(value - mid ORDER BY pos) AS y, count(*) AS n FROM (SELECT *, avg(value) OVER (PARTITION BY sk) AS mid FROM src) GROUP BY 1),
adf0 AS (SELECT sk, y, n, list_transform(range(1, n), lambda t: y[t + 1] - y[t]) AS dy,
  CAST(least(ceil(12 * pow(n / 100.0, 0.25)), n // 2 - 2) AS BIGINT) AS most FROM centred),
adf1 AS (SELECT sk, list_concat([1.0::DOUBLE, y[t]], list_transform(range(1, most + 1), lambda i: dy[t - i]), [dy[t]]) AS x
  FROM (SELECT *, unnest(range(most + 1, n)) AS t FROM adf0)),
{_gram("adf2", "adf1", "sk")},
{_eliminated("adf3", "adf2", "sk", ">")},
adf4 AS (SELECT sk, k - 2 AS lags FROM adf3 WHERE k >= 2
  QUALIFY row_number() OVER (PARTITION BY sk ORDER BY m[1][1] * ln(m[len(m)][len(m)] / m[1][1]) + 2 * k, k) = 1),
adf5 AS (SELECT sk, list_concat([1.0::DOUBLE], list_transform(range(1, lags + 1), lambda i: dy[t - i]), [y[t], dy[t]]) AS x
  FROM (SELECT *, unnest(range(lags + 1, n)) AS t FROM adf0 JOIN adf4 USING (sk))),
{_gram("adf6", "adf5", "sk")},
{_eliminated("adf7", "adf6", "sk", ">", 1)},
adf AS (SELECT sk, len(m) - 3 AS lags,
    m[len(m) - 1][len(m)] / sqrt(m[len(m) - 1][len(m) - 1])
      / sqrt((m[len(m)][len(m)] - m[len(m) - 1][len(m)] * m[len(m) - 1][len(m)] / m[len(m) - 1][len(m) - 1]) / (m[1][1] - len(m) + 1)) AS tau
  FROM adf7 WHERE k = len(m) - 2),
unit_root AS (SELECT sk, lags, tau, coalesce(tau < {CRITICAL!r}, false) AS stationary, CASE WHEN tau < {CRITICAL!r} THEN 0 ELSE 1 END AS d
  FROM centred LEFT JOIN adf USING (sk))"""


def _arima(season: int) -> str:
    """CTEs on src and unit_root: `tried`, all orders; `fit`, the chosen model; `err`, its errors."""
    long_lags, lags = arima._lag_sets(season, arima.LONG)
    depth, span = max(long_lags) + max(lags), max(season, arima.MOST)
    width, extra = len(lags), int(bool(season))
    orders = ", ".join(
        f"({p}, {q}, {[1, *range(2, p + 2), *([width + 1] if season else []), *[width + 1 + k for k in range(1, q + 1)], *([2 * width + 1] if season else []), 2 * width + 2]})"
        for p, q in product(range(arima.MOST + 1), repeat=2)
    )
    seasonal = f"list_transform(range({season + 1}, len(w0) + 1), lambda t: w0[t] - w0[t - {season}])" if season else "w0"
    back = {0: ("[]::DOUBLE[]", "[1.0::DOUBLE]")}.get(season)
    if season:
        zeros = ["0"] * (season - 1)
        back = (f"[{', '.join([*zeros, '1'])}]::DOUBLE[]", f"[{', '.join(['1', *zeros[1:], '1', '-1'])}]::DOUBLE[]")
    at_season = f"WHEN k = {season} THEN " if season else ""
    phi = f"list_transform(range(1, {span + 1}), lambda k: CASE WHEN k <= p THEN c[k + 1] {at_season + 'c[p + 2]' if season else ''} ELSE 0 END)"
    theta = f"list_transform(range(1, {span + 1}), lambda k: CASE WHEN k <= q THEN c[p + 1 + {extra} + k] {at_season + f'c[p + 1 + {extra} + q + 1]' if season else ''} ELSE 0 END)"
    return f"""lev AS (SELECT sk, d, list(value ORDER BY pos) AS y, count(*) AS n FROM src JOIN unit_root USING (sk) GROUP BY ALL),
dif AS (SELECT sk, d, y, CASE WHEN d = 1 THEN list_transform(range(1, n), lambda t: y[t + 1] - y[t]) ELSE y END AS w0,
  CASE WHEN d = 1 THEN {back[1]} ELSE {back[0]} END AS back FROM lev),
dif2 AS (SELECT sk, d, y, back, {seasonal} AS w1 FROM dif),
ser AS (SELECT sk, d, y, back, list_avg(w1) AS mid, list_transform(w1, lambda v: v - list_avg(w1)) AS w, len(w1) AS nw FROM dif2),
ar1 AS (SELECT sk, list_concat([1.0::DOUBLE], list_transform({long_lags}, lambda k: w[t - k]), [w[t]]) AS x FROM (SELECT *, unnest(range({depth + 1}, nw + 1)) AS t FROM ser)),
{_gram("ar2", "ar1", "sk")},
{_eliminated("ar3", "ar2", "sk")},
ar4 AS (SELECT sk, list_transform(range(1, len(m)), lambda i: m[i][len(m)] / m[i][i]) AS a FROM ar3 WHERE k = len(m) - 1),
res AS (SELECT sk, w, nw, list_transform(range(1, nw + 1), lambda t: CASE WHEN t > {max(long_lags)} THEN w[t] - a[1]
  - list_sum(list_transform(range(1, {len(long_lags) + 1}), lambda i: a[i + 1] * w[t - {long_lags}[i]])) END) AS e FROM ser JOIN ar4 USING (sk)),
st1 AS (SELECT sk, list_concat([1.0::DOUBLE], list_transform({lags}, lambda k: w[t - k]), list_transform({lags}, lambda k: e[t - k]), [w[t]]) AS x
  FROM (SELECT *, unnest(range({depth + 1}, nw + 1)) AS t FROM res)),
{_gram("st2", "st1", "sk")},
ords(p, q, places) AS (VALUES {orders}),
st3 AS (SELECT sk, p, q, list_transform(places, lambda i: list_transform(places, lambda j: m[i][j])) AS m FROM st2, ords),
{_eliminated("st4", "st3", "sk, p, q")},
st5 AS (SELECT sk, p, q, m[1][1] AS r, m[len(m)][len(m)] AS rss, list_transform(range(1, len(m)), lambda i: m[i][len(m)] / m[i][i]) AS c FROM st4 WHERE k = len(m) - 1),
tried AS (SELECT sk, p, q, c, r * ln(rss / r) + 2 * (len(c) + 1) AS aic,
  coalesce(list_sum(list_transform(c[p + 2 + {extra}:p + 1 + q + 2 * {extra}], lambda v: abs(v))), 0) < 1 AS fits FROM st5 WHERE r > len(c) + 1),
best AS (SELECT * FROM tried WHERE fits QUALIFY row_number() OVER (PARTITION BY sk ORDER BY aic, p, q) = 1),
fit AS (SELECT sk, d, p, q, c[1] AS constant, {phi} AS phi, {theta} AS theta, y, w, nw, mid, back FROM best JOIN ser USING (sk)),
er AS (SELECT sk, {span + 1} AS t, list_transform(range({span}), lambda i: 0.0::DOUBLE) AS e FROM fit UNION ALL
  SELECT er.sk, t + 1, list_append(e, w[t] - constant - list_sum(list_transform(range(1, {span + 1}), lambda k: phi[k] * w[t - k] + theta[k] * e[t - k])))
  FROM er JOIN fit ON er.sk = fit.sk WHERE t <= nw),
err AS (SELECT er.sk, e, e[{span + 1}:] AS errors, list_sum(list_transform(e, lambda v: v * v)) AS sse, nw - {span} AS cnt FROM er JOIN fit ON er.sk = fit.sk WHERE t = nw + 1)"""


def _ahead(horizon: int, span: int) -> str:
    """CTE `ahead` (sk, step, forecast, se) from `fit` and `err`."""
    return f"""fc AS (SELECT fit.sk, 0 AS step, w, e, y, 0.0::DOUBLE AS v FROM fit JOIN err ON fit.sk = err.sk UNION ALL
  SELECT sk, step + 1, list_append(w, nv), list_append(e, 0.0), list_append(y, ny), ny FROM
    (SELECT *, nv + mid + coalesce(list_sum(list_transform(range(1, len(back) + 1), lambda k: back[k] * y[len(y) - k + 1])), 0) AS ny FROM
      (SELECT fc.*, mid, back, constant + list_sum(list_transform(range(1, {span + 1}), lambda k: phi[k] * fc.w[len(fc.w) - k + 1] + theta[k] * fc.e[len(fc.e) - k + 1])) AS nv
       FROM fc JOIN fit ON fc.sk = fit.sk WHERE step < {horizon}))),
psi AS (SELECT sk, 1 AS j, [1.0::DOUBLE] AS wp, [1.0::DOUBLE] AS yp, 1.0::DOUBLE AS spread FROM fit UNION ALL
  SELECT sk, j + 1, list_append(wp, nw), list_append(yp, ny), spread + ny * ny FROM
    (SELECT *, nw + coalesce(list_sum(list_transform(range(1, least(j, len(back)) + 1), lambda k: back[k] * yp[j - k + 1])), 0) AS ny FROM
      (SELECT psi.*, back, CASE WHEN j <= {span} THEN theta[j] ELSE 0 END + list_sum(list_transform(range(1, least(j, {span}) + 1), lambda k: phi[k] * wp[j - k + 1])) AS nw
       FROM psi JOIN fit ON psi.sk = fit.sk WHERE j < {horizon}))),
ahead AS (SELECT fc.sk, step, v AS forecast, sqrt(sse / cnt * spread) AS se FROM fc JOIN psi ON fc.sk = psi.sk AND fc.step = psi.j JOIN err ON fc.sk = err.sk)"""


def _ets(period: int, tag: str, weights: str) -> str:
    return f"""hw{tag} AS (SELECT sk, n, a, b, g, {period} AS t, l0 AS l, (l1 - l0) / {period} AS tr, list_transform(head, lambda v: v - l0) AS s, 0.0::DOUBLE AS sse
  FROM st JOIN ({weights}) USING (sk) UNION ALL
  SELECT sk, n, a, b, g, t + 1, l + tr + a * e, tr + a * b * e, list_append(s[2:], s[1] + g * e), sse + e * e FROM
    (SELECT h.*, v.value - h.l - h.tr - h.s[1] AS e FROM hw{tag} h JOIN src v ON v.sk = h.sk AND v.pos = h.t)),
best{tag} AS (SELECT * FROM hw{tag} WHERE t = n QUALIFY row_number() OVER (PARTITION BY sk ORDER BY sse, a, b, g) = 1)"""


def _ets_start(period: int) -> str:
    return f"""st AS (SELECT sk, max(pos) + 1 AS n, avg(value) FILTER (pos < {period}) AS l0, avg(value) FILTER (pos >= {period} AND pos < {2 * period}) AS l1,
  list(value ORDER BY pos) FILTER (pos < {period}) AS head FROM src GROUP BY 1 HAVING max(pos) + 1 >= {2 * period})"""


def _ets_chosen(period: int) -> str:
    """CTE `model`: the best of the grid, then of its neighbours."""
    ok = "a > 0 AND b > 0 AND g > 0 AND a < 1 AND b < 1 AND g < 1 AND round(a + g, 6) <= 1"
    values = f"(SELECT unnest({list(smoothing.GRID)})::DOUBLE AS {{}})"
    grid = f"SELECT sk, a, b, g FROM st, {values.format('a')}, {values.format('b')}, {values.format('g')} WHERE {ok}"
    parts = [_ets_start(period), _ets(period, "0", grid)]
    for i, step in enumerate(smoothing.ROUNDS, 1):
        moves = f"(SELECT unnest([-{step}, 0, {step}])::DOUBLE AS {{}})"
        near = f"SELECT * FROM (SELECT sk, round(a + da, 6) AS a, round(b + db, 6) AS b, round(g + dg, 6) AS g FROM best{i - 1}, {moves.format('da')}, {moves.format('db')}, {moves.format('dg')}) WHERE {ok}"
        parts.append(_ets(period, str(i), near))
    return ",\n".join([*parts, f"model AS (SELECT * FROM best{len(smoothing.ROUNDS)})"])


def _ets_fixed(period: int) -> str:
    a, b, g = m.FIXED
    return f"{_ets_start(period)},\n{_ets(period, '0', f'SELECT sk, {a}::DOUBLE AS a, {b}::DOUBLE AS b, {g}::DOUBLE AS g FROM st')},\nmodel AS (SELECT * FROM best0)"


def _ets_ahead(horizon: int, period: int) -> str:
    return f"""ahead AS (SELECT sk, step, l + step * tr + s[(step - 1) % {period} + 1] AS forecast, sqrt(sse / (n - {period}) * (1 + coalesce(list_sum(
  list_transform(range(1, step), lambda j: pow(a * (1 + b * j) + CASE WHEN j % {period} = 0 THEN g ELSE 0 END, 2))), 0))) AS se FROM model, generate_series(1, {horizon}) x(step))"""


def _out(name: str, date: str = "CAST(last_date + to_months(CAST(step AS INTEGER)) AS DATE)") -> str:
    """The forecast rows of `ahead`, moving averages for the series it lacks."""
    return f"""level AS (SELECT sk, max_by(value, pos) AS last, avg(value) FILTER (pos >= n - 12) AS level, stddev_samp(value) AS sd
  FROM (SELECT *, count(*) OVER (PARTITION BY sk) AS n FROM src) GROUP BY 1),
plain AS (SELECT sk, step, level AS forecast, sd AS se, 'moving_average' AS model FROM level, generate_series(1, 12) x(step) WHERE sk NOT IN (SELECT sk FROM ahead)),
bands AS (SELECT sk AS series_id, CAST(step AS BIGINT) AS step, {date} AS date, forecast, forecast - {Z!r} * se AS lower, forecast + {Z!r} * se AS upper, model
  FROM (SELECT *, '{name}' AS model FROM ahead UNION ALL SELECT * FROM plain) JOIN last USING (sk))"""


LAST = "last AS (SELECT series_id AS sk, max(date) AS last_date FROM prepared GROUP BY 1)"
ROWS = f" SELECT series_id, step, {DATE}, {_r('forecast', 'lower', 'upper')}, model FROM bands"


def _model(source: str, *ctes: str) -> str:
    return _recursive(",\n".join([source, *ctes]))


def _forecast(season: int) -> str:
    return _model(MONTHLY, LAST, ADF, _arima(season), _ahead(12, max(season, arima.MOST)), _out("arima")) + ROWS


def _terms(season: int) -> str:
    def kind(name: str, values: str, order: str) -> str:
        seen = f"k <= {order}" + (f" OR k = {season}" if season else "")
        return f"SELECT sk, d, p, q, '{name}.L' || k, {values}[k] FROM (SELECT *, unnest(range(1, len(phi) + 1)) AS k FROM fit) WHERE {seen}"

    listed = f"SELECT sk, d, p, q, 'const', constant FROM fit UNION ALL {kind('ar', 'phi', 'p')} UNION ALL {kind('ma', 'theta', 'q')}"
    columns = "sk AS series_id, CAST(d AS BIGINT) AS d, CAST(p AS BIGINT) AS p, CAST(q AS BIGINT) AS q, term, round(value, 6) AS value"
    return _model(MONTHLY, ADF, _arima(season), f"terms(sk, d, p, q, term, value) AS ({listed})") + f" SELECT {columns} FROM terms"


def _folds(ctes: list[str]) -> str:
    """CTE `tested`: one-step forecasts of `ahead` on the parts, moving averages where it has none."""
    plain = FOLDS[len(SERIES) :].lstrip(",\n ")
    return _model(PARTS, *ctes) + f""", {plain},
tested AS (SELECT f.series_id, f.pos, f.date, actual, coalesce(a.forecast, predicted) AS predicted,
  coalesce(a.forecast - {Z!r} * se, lower) AS lower, coalesce(a.forecast + {Z!r} * se, upper) AS upper
  FROM folds f LEFT JOIN ahead a ON a.sk = f.series_id || '@' || f.pos)"""


METRICS = """, turned AS (SELECT *, sign(actual - lag(actual) OVER w) = sign(predicted - lag(predicted) OVER w) AS turn
    FROM tested WINDOW w AS (PARTITION BY series_id ORDER BY pos))
  SELECT series_id, count(*) AS folds, strftime(min(date), '%Y-%m-%d') AS test_period_start, strftime(max(date), '%Y-%m-%d') AS test_period_end,
    round(sqrt(avg((actual - predicted) * (actual - predicted))), 6) AS rmse, round(avg(abs(actual - predicted)), 6) AS mae,
    round(avg(abs((actual - predicted) / nullif(actual, 0))) * 100, 6) AS mape, round(avg(CAST(turn AS INT)), 6) AS directional_accuracy,
    round(avg(CAST(actual BETWEEN lower AND upper AS INT)), 6) AS coverage_probability, round(avg(actual - predicted), 6) AS forecast_bias
  FROM turned GROUP BY 1"""
ARIMA_FOLDS = _folds([ADF, _arima(0), _ahead(1, arima.MOST)])
ADF_OUT = " SELECT sk AS series_id, CAST(lags AS BIGINT) AS lags, round(tau, 6) AS tau, stationary, CAST(d AS BIGINT) AS d FROM unit_root"
DAILY_DATES = """steps AS (SELECT date - lag(date) OVER (ORDER BY date) AS step FROM d),
last AS (SELECT 'all' AS sk, max(date) AS last_date, (SELECT min(step) = 1 AND max(step) = 1 FROM steps) AS daily FROM d)"""
DAILY_DATE = "CASE WHEN daily THEN last_date + CAST(step AS INTEGER) ELSE CAST(date_trunc('month', last_date) + to_months(CAST(step AS INTEGER)) AS DATE) END"

MODEL_ORACLE: dict[str, str] = {
    "adf_monthly": _model(MONTHLY, ADF) + ADF_OUT,
    "adf_daily": _model(DAILY, ADF) + ADF_OUT,
    "ets_fixed_forecast": _model(MONTHLY, LAST, _ets_fixed(12), _ets_ahead(12, 12), _out("ets")) + ROWS,
    "ets_daily_forecast": _model(DAILY, DAILY_DATES, _ets_fixed(7), _ets_ahead(14, 7), _out("ets", DAILY_DATE)) + ROWS,
    "ets_weights": _model(MONTHLY, _ets_chosen(12)) + " SELECT sk AS series_id, a AS alpha, b AS beta, g AS gamma, round(sse, 6) AS sse FROM model",
    "ets_forecast": _model(MONTHLY, LAST, _ets_chosen(12), _ets_ahead(12, 12), _out("ets")) + ROWS,
    "ets_backtest": _folds([_ets_chosen(12), _ets_ahead(1, 12)]) + METRICS,
    "arima_orders": _model(MONTHLY, ADF, _arima(0))
    + """ SELECT t.sk AS series_id, CAST(t.p AS BIGINT) AS p, CAST(t.q AS BIGINT) AS q, round(t.aic, 6) AS aic, t.fits, best.sk IS NOT NULL AS chosen
  FROM tried t LEFT JOIN best ON t.sk = best.sk AND t.p = best.p AND t.q = best.q""",
    "arima_terms": _terms(0),
    "sarima_terms": _terms(12),
    "arima_forecast": _forecast(0),
    "sarima_forecast": _forecast(12),
    "arima_backtest_folds": ARIMA_FOLDS + f" SELECT series_id, pos, {DATE}, {_r('actual', 'predicted', 'lower', 'upper')} FROM tested",
    "arima_backtest": ARIMA_FOLDS + METRICS,
}
_both = f"""SELECT a.series_id, a.step, strftime(a.date, '%Y-%m-%d') AS date, round((a.forecast + e.forecast) / 2, 6) AS forecast,
  round((a.lower + e.lower) / 2, 6) AS lower, round((a.upper + e.upper) / 2, 6) AS upper, 'ensemble' AS model
  FROM ({{}} SELECT * FROM bands) a JOIN ({{}} SELECT * FROM bands) e ON a.series_id = e.series_id AND a.step = e.step"""
MODEL_ORACLE["ensemble_forecast"] = _both.format(MODEL_ORACLE["sarima_forecast"].removesuffix(ROWS), MODEL_ORACLE["ets_forecast"].removesuffix(ROWS))
MODEL_ORACLE["model_diagnostics"] = (
    _model(MONTHLY, ADF, _arima(0))
    + f""", flat AS (SELECT sk, cnt, sse, unnest(errors) AS e, unnest(range(len(errors))) AS pos FROM err),
cen AS (SELECT sk, cnt, pos, e - avg(e) OVER (PARTITION BY sk) AS e FROM flat),
s0 AS (SELECT sk, cnt AS n, sum(e * e) AS s0 FROM cen GROUP BY ALL),
sj AS (SELECT a.sk, a.pos - b.pos AS k, sum(a.e * b.e) AS sk_ FROM cen a JOIN cen b ON a.sk = b.sk AND a.pos - b.pos BETWEEN 1 AND 10 GROUP BY ALL),
lb AS (SELECT sk, n * (n + 2) * sum((sk_ / s0) * (sk_ / s0) / (n - k)) AS q FROM s0 JOIN sj USING (sk) GROUP BY sk, n),
ll AS (SELECT sk, cnt, -cnt / 2 * (ln(2 * pi() * sse / cnt) + 1) AS ll, sse, list_avg(errors) AS mean FROM err)
SELECT sk AS series_id, CASE WHEN p IS NULL THEN 'simple' ELSE 'arima' END AS model, count AS observations, CAST(p + q + 1 AS BIGINT) AS terms, round(ll, 6) AS log_likelihood,
  round(2 * (p + fit.q + 2) - 2 * ll, 6) AS aic, round(ln(cnt) * (p + fit.q + 2) - 2 * ll, 6) AS bic, round(mean, 6) AS residual_mean,
  round(sqrt((sse - cnt * mean * mean) / (cnt - 1)), 6) AS residual_std, (SELECT round({CHI_TAIL}, 6) FROM lb WHERE lb.sk = c.sk) AS ljung_box_pvalue
FROM (SELECT sk, count(*) AS count FROM src GROUP BY 1) c LEFT JOIN fit USING (sk) LEFT JOIN ll USING (sk)"""
)
