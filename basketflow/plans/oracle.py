"""The registered queries as plain SQL over the same tables: an independent check of the results."""

from __future__ import annotations

from datetime import datetime, timedelta

from basketflow.plans import queries as q
from basketflow.schema import CATEGORY_MAP, CPI_WEIGHTS, SUBCATEGORIES, UNIT_MULTIPLIERS
from basketflow.sources.panels import PART_TYPE_CATEGORY, RAW_CATEGORY, UNITS

# Two-sided 95 % quantiles of the normal distribution and of Student's t with 7 degrees of freedom.
Z = 1.959963984540054
TQ = 2.364624251592785


def _case(column: str, mapping: dict[str, str], default: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {column} {arms} ELSE '{default}' END"


def _ts(t: datetime) -> str:
    return f"TIMESTAMP '{t:%Y-%m-%d %H:%M:%S}'"


UNIT_LIST = "[" + ", ".join(f"'{u}'" for u in UNITS) + "]"
PANEL = f"""panel AS (
  SELECT p_brand || '/' || p_type AS product_id, p_name AS product_name, l_extendedprice / l_quantity AS price,
         {_case("p_type", PART_TYPE_CATEGORY, "other")} AS category, CAST(l_suppkey AS VARCHAR) AS retailer,
         l_shipdate AS ts, {UNIT_LIST}[p_size % 6 + 1] AS unit, l_quantity AS quantity,
         l_orderkey, l_linenumber, l_partkey, l_extendedprice
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
EVENTS = """panel AS (
  SELECT CAST(user_id AS VARCHAR) AS product_id, value AS price, event_type AS category,
         json_extract_string(props, '$.k') AS retailer, ts, event_id FROM events)"""
WEIGHTS = "weights(category, weight) AS (VALUES " + ", ".join(f"('{c}', CAST({w} AS DOUBLE))" for c, w in CPI_WEIGHTS.items()) + ")"


def _base(start: datetime = q.BASE, days: int = 30) -> str:
    return f"""base AS (SELECT product_id, category, avg(price) AS base_price FROM panel
  WHERE ts >= {_ts(start)} AND ts < {_ts(start + timedelta(days=days))} GROUP BY 1, 2)"""


FALLBACK_BASE = """base AS (SELECT product_id, category, avg(price) AS base_price FROM
  (SELECT * FROM panel WHERE ts < (SELECT min(ts) FROM panel) + INTERVAL 30 DAY) GROUP BY 1, 2)"""


def _points(*times: datetime) -> str:
    return "points(as_of) AS (VALUES " + ", ".join(f"({_ts(t)})" for t in times) + ")"


MANY = f"points AS (SELECT {_ts(q.FIRST)} + to_hours(6 * i) + to_seconds(i) AS as_of FROM range(10000) r(i))"
DAYS = f"points AS (SELECT unnest(generate_series({_ts(q.FIRST)}, {_ts(q.LAST)}, INTERVAL 1 DAY)) AS as_of)"
MONTHS = "points AS (SELECT unnest(generate_series(TIMESTAMP '1995-02-01', TIMESTAMP '2001-11-01', INTERVAL 1 MONTH)) AS as_of)"


def _index(points: str, weighted: bool = True, base: str | None = None) -> str:
    """CTEs up to `res`: one row per as-of with all result columns, unrounded."""
    total = "sum(idx * weight)" if weighted else "CASE WHEN span = 'cur' THEN avg(idx) ELSE sum(idx * weight) END"
    return f"""WITH {PANEL}, {points}, {base or _base()}, {WEIGHTS},
spans AS (SELECT as_of, span, as_of - to_days(off + 7) AS lo, as_of - to_days(off) AS hi
  FROM points, (VALUES ('cur', 0), ('mom', 30), ('yoy', 365)) s(span, off)),
win AS (SELECT as_of, span, category, product_id, price FROM spans JOIN panel ON ts >= lo AND ts <= hi),
cnt AS (SELECT as_of, span, count(*) AS n FROM win GROUP BY 1, 2),
idx AS (SELECT as_of, span, category, CASE WHEN count(*) >= 10 THEN exp(avg(ln(price / base_price))) * 100 ELSE 100 END AS idx
  FROM win JOIN base USING (category, product_id) WHERE price > 0 AND base_price > 0 GROUP BY 1, 2, 3),
cells AS (SELECT as_of, span, category, weight, coalesce(idx, 100.0) AS idx
  FROM spans CROSS JOIN weights LEFT JOIN idx USING (as_of, span, category)),
tot AS (SELECT as_of, span, {total} AS total, avg(idx) AS mean, stddev_samp(idx) / sqrt(count(*)) AS sem FROM cells GROUP BY 1, 2),
wide AS (SELECT t.as_of,
    max(CASE WHEN span = 'cur' THEN coalesce(n, 0) END) AS n, max(CASE WHEN span = 'cur' THEN total END) AS cur,
    max(CASE WHEN span = 'cur' THEN mean END) AS mean, max(CASE WHEN span = 'cur' THEN sem END) AS sem,
    max(CASE WHEN span = 'mom' AND n > 0 THEN total END) AS mom, max(CASE WHEN span = 'yoy' AND n > 0 THEN total END) AS yoy
  FROM tot t LEFT JOIN cnt USING (as_of, span) GROUP BY 1),
res AS (SELECT as_of, CAST(n AS BIGINT) AS observation_count, CASE WHEN n > 0 THEN cur ELSE 100.0 END AS price_index,
    CASE WHEN n > 0 THEN cur - 100 ELSE 0.0 END AS inflation_rate,
    CASE WHEN n > 0 AND mom > 0 THEN (cur / mom - 1) * 100 ELSE 0.0 END AS inflation_mom,
    CASE WHEN n > 0 AND yoy > 0 THEN (cur / yoy - 1) * 100 ELSE 0.0 END AS inflation_yoy,
    CASE WHEN n > 0 THEN mean - {TQ!r} * sem ELSE 0.0 END AS ci_lower,
    CASE WHEN n > 0 THEN mean + {TQ!r} * sem ELSE 0.0 END AS ci_upper FROM wide)
"""


def _r(*names: str, digits: int = 6) -> str:
    """Rounded columns; adding zero turns -0.0 into 0.0."""
    return ", ".join(f"round({n}, {digits}) + 0.0 AS {n}" for n in names)


INDEX_OUT = f"SELECT as_of, observation_count, {_r(*q.INDEX_COLUMNS, 'ci_lower', 'ci_upper')} FROM res"
SERIES_OUT = f"SELECT as_of AS date, observation_count, {_r(*q.INDEX_COLUMNS)} FROM res"

OFFICIAL = """official AS (
  SELECT date, v / first_value(v) OVER (ORDER BY date) * 100 AS cpi_value FROM (
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, avg(o_totalprice) AS v FROM orders GROUP BY 1))"""
OFFICIAL_ASOF = OFFICIAL + ", points AS (SELECT CAST(date AS TIMESTAMP) AS as_of FROM official)"
ALIGNED = _index(OFFICIAL_ASOF) + """, aligned AS (
  SELECT date, round(price_index, 9) AS price_index, cpi_value FROM official JOIN res ON res.as_of = CAST(official.date AS TIMESTAMP))"""

INDEX_PANEL = f"""WITH {PANEL}, {_base()}, {WEIGHTS},
index_panel AS (SELECT CAST(ts AS DATE) AS date, category, exp(avg(ln(price / base_price))) * 100 AS price_index, any_value(weight) AS weight
  FROM panel JOIN base USING (category, product_id) JOIN weights USING (category)
  WHERE price > 0 AND base_price > 0 GROUP BY 1, 2)"""

SERIES = f"""WITH {PANEL},
monthly AS (SELECT category AS series_id, CAST(date_trunc('month', ts) AS DATE) AS date, avg(price) AS value FROM panel GROUP BY 1, 2),
prepared AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date) - 1 AS pos,
  count(*) OVER (PARTITION BY series_id) AS n FROM monthly)"""
MA = f"""{SERIES},
level AS (SELECT series_id, avg(CASE WHEN pos >= n - 12 THEN value END) AS level, stddev_samp(value) AS sd, max(date) AS last_date
  FROM prepared WHERE n >= 12 GROUP BY 1),
ma AS (SELECT series_id, CAST(step AS BIGINT) AS step, CAST(last_date + to_months(CAST(step AS INTEGER)) AS DATE) AS date,
  level AS forecast, level - {Z!r} * sd AS lower, level + {Z!r} * sd AS upper
  FROM level, generate_series(1, 12) g(step))"""
FOLDS = f"""{SERIES},
rolled AS (SELECT *, avg(value) OVER (PARTITION BY series_id ORDER BY date ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS predicted,
  stddev_samp(value) OVER (PARTITION BY series_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS sd
  FROM prepared WHERE n >= 12),
folds AS (SELECT series_id, pos, date, value AS actual, predicted, predicted - {Z!r} * sd AS lower, predicted + {Z!r} * sd AS upper
  FROM rolled WHERE n - pos <= 12 AND pos >= 12)"""

AMOUNT = "format('{:,.2f}', l_extendedprice)"
_maps = " ".join(
    f"WHEN lower(retailer) = '{r}' AND lower(category) = '{raw}' THEN '{cpi}'" for r, m in CATEGORY_MAP.items() for raw, cpi in m.items()
)
CPI_CATEGORY = f"CASE {_maps} ELSE 'other' END"
FEED = f"""feed0 AS (SELECT *, CASE WHEN l_suppkey % 2 = 0 THEN 'Amazon' ELSE 'Walmart' END AS retailer FROM lineitem JOIN part ON l_partkey = p_partkey),
feed1 AS (SELECT *, CASE WHEN retailer = 'Amazon' THEN 'B' || lpad(CAST(l_partkey AS VARCHAR), 9, '0')
  ELSE CAST(l_partkey + 100000000 AS VARCHAR) END AS product_id FROM feed0),
feed AS (SELECT product_id, chr(9) || ' ' || p_name || ' ' AS product_name,
  CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN 'N/A' WHEN l_linenumber = 6 AND l_returnflag = 'N' THEN '-$' || {AMOUNT}
       WHEN l_linenumber = 5 AND l_returnflag = 'A' THEN NULL ELSE ' $' || {AMOUNT} || ' ' END AS price_text,
  p_retailprice AS original_price, {_case("p_type", RAW_CATEGORY, "Misc")} AS category, retailer,
  CASE WHEN l_tax = CAST(0.08 AS DOUBLE) THEN 'not-a-valid-url' WHEN l_tax = CAST(0.07 AS DOUBLE) THEN '//host-only/dp/B000000001'
       WHEN retailer = 'Amazon' THEN 'https://www.amazon.com/dp/' || product_id
       ELSE 'https://www.walmart.com/ip/' || replace(lower(p_name), ' ', '-') || '/' || product_id END AS url,
  l_shipdate AS ts, {UNIT_LIST}[p_size % 6 + 1] AS unit, CASE WHEN l_discount = CAST(0.1 AS DOUBLE) THEN 0.0 ELSE l_quantity END AS quantity,
  round(l_quantity / 9, 1) AS rating, CAST(l_linenumber - 1 AS BIGINT) AS review_count, l_orderkey FROM feed1),
typed AS (SELECT *, TRY_CAST(trim(replace(replace(price_text, '$', ''), ',', '')) AS DOUBLE) AS price FROM feed),
broken AS (SELECT *, coalesce(price > 0, false) AS ok_price, regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]+') AS ok_url,
  quantity > 0 AS ok_quantity, rating BETWEEN 0 AND 5 AS ok_rating FROM typed),
valid AS (SELECT * FROM broken WHERE ok_price AND ok_url AND ok_quantity AND ok_rating),
feed_panel AS (SELECT product_id, trim(product_name, chr(9) || ' ') AS product_name,
  trim(replace(replace(price_text, '$', ''), ',', '')) AS price_text, price, original_price, {CPI_CATEGORY} AS category, retailer, url, ts,
  unit, quantity, rating, review_count, l_orderkey FROM typed)"""


def _outliers(source: str) -> str:
    """CTEs `stats` and `flagged` over a relation with category and price."""
    return f"""stats AS (SELECT category, count(*) AS n_rows, avg(price) AS mean, stddev_samp(price) AS sd,
  quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM {source} WHERE category IS NOT NULL GROUP BY 1),
flagged0 AS (SELECT s.*, coalesce(n_rows >= 3 AND sd > 0 AND abs((price - mean) / sd) > 3, false) AS z_outlier,
  coalesce(n_rows >= 4 AND (price < q1 - 1.5 * (q3 - q1) OR price > q3 + 1.5 * (q3 - q1)), false) AS iqr_outlier
  FROM {source} s LEFT JOIN stats USING (category)),
flagged AS (SELECT *, z_outlier OR iqr_outlier AS is_outlier FROM flagged0)"""


def _percent(x: str) -> str:
    return f"printf('%.2f%%', {x} * 100)"


REPORT_COLUMNS = [
    "product_id", "product_name", "price", "original_price", "category", "retailer", "url", "timestamp", "unit", "quantity", "rating", "review_count", "metadata",
]
STORED_AS = {"price": "price_text", "timestamp": "ts", "metadata": "l_orderkey"}


def _report(absent: str | None = None) -> str:
    """The quality report as one row per check, for a feed without the absent column."""
    there = [c for c in REPORT_COLUMNS if c != absent]
    nulls = {c: f"count(*) - count({STORED_AS.get(c, c)})" for c in there}
    rows = ["SELECT 'empty' AS check_name, 'error' AS severity, '' AS subject, CAST(n AS DOUBLE) AS value, CAST(0 AS DOUBLE) AS threshold, "
            "n = 0 AS triggered, 'DataFrame is empty' AS message FROM m"]
    for c in ["product_id", "product_name", "price", "category", "retailer", "timestamp"]:
        rows.append(f"SELECT 'required_column', 'error', '{c}', {float(c == absent)}, 0.0, {str(c == absent).lower()}, 'Missing required column: {c}'")
    rows.append("SELECT 'data_type', 'error', 'price', CAST(no_number AS DOUBLE), 0.0, no_number > 0, 'Column ''price'' has invalid data type, expected numeric' FROM m")

    def counted(check: str, severity: str, subject: str, n: str, text: str, source: str = "m") -> None:
        head, tail = text.split("{}")
        rows.append(f"SELECT '{check}', '{severity}', '{subject}', CAST({n} AS DOUBLE), 0.0, {n} > 0, '{head}' || CAST({n} AS BIGINT) || '{tail}' FROM {source}")

    counted("null_price", "warning", "price", "no_price", "Found {} null price values")
    counted("below_min", "warning", "price", "p_low", "{} prices below minimum threshold (0.01)")
    counted("above_max", "warning", "price", "p_high", "{} prices above maximum threshold (100000.0)")
    counted("negative_price", "error", "price", "p_neg", "Found {} negative prices")
    total = " + ".join(f"null_{c}" for c in there)
    rows.append(f"SELECT 'completeness', 'warning', '', c, 0.95, c < 0.95, 'Data completeness (' || {_percent('c')} || ') below threshold (95.00%)' "
                f"FROM (SELECT 1 - ({total}) / (n * {len(there)}) AS c FROM m)")
    for c in there:
        rows.append(f"SELECT 'null_ratio', 'warning', '{c}', r, 0.05, r > 0.05, 'Column ''{c}'' has high null ratio: ' || {_percent('r')} "
                    f"FROM (SELECT null_{c} / n AS r FROM m)")
    if absent == "timestamp":
        rows.append("SELECT 'stale', 'warning', 'timestamp', NULL, NULL, true, 'No timestamp column found for freshness check'")
    else:
        rows.append("SELECT 'stale', 'warning', 'timestamp', CAST(stale AS DOUBLE), 0.0, oldest < cutoff, stale || ' records are older than 1 day, 0:00:00' FROM m")
    for c in ("oldest", "newest") if absent != "timestamp" else ():
        rows.append(f"SELECT '{c}_record', 'info', 'timestamp', NULL, NULL, false, strftime({c}, '%Y-%m-%dT%H:%M:%S') FROM m")
    counted("outliers", "warning", "price", "n", "Detected {} potential outliers", "(SELECT count(*) AS n FROM flagged WHERE is_outlier)")
    valid = ", ".join(f"'{c}'" for c in CPI_WEIGHTS)
    counted("invalid_categories", "warning", "category", "n", "Found {} invalid categories",
            f"(SELECT count(DISTINCT category) AS n FROM feed_panel WHERE category NOT IN ({valid}))")
    counted("exact_duplicates", "warning", "", "n", "Found {} exact duplicate rows",
            f"(SELECT (SELECT count(*) FROM feed_panel) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(STORED_AS.get(c, c) for c in there)} FROM feed_panel)) AS n)")
    counted("key_duplicates", "warning", "product_id, retailer", "n", "Found {} duplicate product_id/retailer combinations",
            "(SELECT (SELECT count(*) FROM feed_panel) - (SELECT count(*) FROM (SELECT DISTINCT product_id, retailer FROM feed_panel)) AS n)")
    cutoff = _ts(q.FEED_NOW - timedelta(days=1))
    sums = ", ".join(f"{v} AS null_{c}" for c, v in nulls.items())
    return (
        f"WITH {FEED}, {_outliers('feed_panel')}, m AS (SELECT count(*) AS n, {sums}, count(*) - count(price) AS no_price, "
        f"count(price_text) - count(price) AS no_number, count(*) FILTER (price < 0.01) AS p_low, "
        f"count(*) FILTER (price > 100000) AS p_high, count(*) FILTER (price < 0) AS p_neg, min(ts) AS oldest, max(ts) AS newest, "
        f"{cutoff} AS cutoff, count(*) FILTER (ts < {cutoff}) AS stale FROM feed_panel), report AS ({' UNION ALL '.join(rows)})"
    )


CATALOG = f"""catalog0 AS (SELECT retailer, {_case("p_type", RAW_CATEGORY, "Misc")} AS category, p_partkey,
  CASE WHEN retailer = 'Amazon' THEN 'B' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') ELSE CAST(p_partkey + 100000000 AS VARCHAR) END AS product_id,
  p_name AS product_name, p_retailprice AS price FROM part, (VALUES ('Amazon'), ('Walmart')) r(retailer)),
catalog AS (SELECT *, row_number() OVER (PARTITION BY retailer, category ORDER BY p_partkey, product_id) AS rn FROM catalog0)"""
PRODUCT_URL = """CASE WHEN retailer = 'Amazon' THEN 'https://www.amazon.com/dp/' || product_id
  ELSE 'https://www.walmart.com/ip/' || replace(lower(product_name), ' ', '-') || '/' || product_id END"""
LISTING = f"SELECT product_id, product_name, round(price, 2) AS price, {CPI_CATEGORY} AS category, retailer, {PRODUCT_URL} AS url, p_partkey AS listing_pos FROM catalog"
_units = " ".join(f"WHEN '{u}' THEN CAST({m} AS DOUBLE)" for u, m in UNIT_MULTIPLIERS.items())
UNIT_PRICE = f"CASE WHEN quantity <> 0 THEN price * (CASE unit {_units} ELSE 1.0 END) / quantity ELSE price END"
LINE = "l_orderkey, l_linenumber, l_partkey, price"
_names = sorted({s for subs in SUBCATEGORIES.values() for s in subs})
_bridge = ", ".join(f"('{c}', '{s}')" for c, subs in SUBCATEGORIES.items() for s in subs)
_heat = ", ".join(
    f"round(avg(CASE WHEN strftime(date, '%Y-%m') = '1999-{m:02d}' THEN price_index END) - 100, 6) AS m{m:02d}" for m in range(1, 13)
)
_half = ["1.0"]
for _i in range(1, 5):
    _half.append(f"{_half[-1]} * (q / 2) / {_i}")
CHI_TAIL = "exp(-q / 2) * (" + " + ".join(_half) + ")"
LJUNG = (
    SERIES
    + """, resid AS (SELECT series_id, pos, value - avg(value) OVER (PARTITION BY series_id ORDER BY date ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS r
  FROM prepared),
e AS (SELECT series_id, pos, r - avg(r) OVER (PARTITION BY series_id) AS e FROM resid WHERE pos >= 12),
s0 AS (SELECT series_id, count(*) AS n, sum(e * e) AS s0 FROM e GROUP BY 1),
sk AS (SELECT a.series_id, a.pos - b.pos AS k, sum(a.e * b.e) AS sk FROM e a JOIN e b ON a.series_id = b.series_id AND a.pos - b.pos BETWEEN 1 AND 10 GROUP BY 1, 2),
lb AS (SELECT series_id, n, n * (n + 2) * sum((sk / s0) * (sk / s0) / (n - k)) AS q FROM s0 JOIN sk USING (series_id) GROUP BY 1, 2)"""
)
SEASONAL = (
    SERIES
    + """, t0 AS (SELECT *, (avg(value) OVER (PARTITION BY series_id ORDER BY pos ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING)
    + avg(value) OVER (PARTITION BY series_id ORDER BY pos ROWS BETWEEN 5 PRECEDING AND 6 FOLLOWING)) / 2 AS ma FROM prepared),
t1 AS (SELECT *, CASE WHEN pos BETWEEN 6 AND n - 7 THEN ma END AS trend FROM t0),
lines AS (SELECT series_id,
    regr_slope(trend, pos) FILTER (pos >= 6 AND pos < least(18, n - 7)) AS fs, regr_intercept(trend, pos) FILTER (pos >= 6 AND pos < least(18, n - 7)) AS fi,
    regr_slope(trend, pos) FILTER (pos >= greatest(6, n - 19) AND pos < n - 7) AS bs,
    regr_intercept(trend, pos) FILTER (pos >= greatest(6, n - 19) AND pos < n - 7) AS bi FROM t1 GROUP BY 1),
t2 AS (SELECT t1.* EXCLUDE (trend), CASE WHEN pos < 6 THEN fi + fs * pos WHEN pos > n - 7 THEN bi + bs * pos ELSE trend END AS trend FROM t1 JOIN lines USING (series_id)),
raw AS (SELECT series_id, pos % 12 AS phase, avg(value / trend) AS raw FROM t2 GROUP BY 1, 2),
fac AS (SELECT series_id, phase, raw / avg(raw) OVER (PARTITION BY series_id) AS seasonal FROM raw),
adj AS (SELECT series_id, date, value, CASE WHEN n >= 24 THEN seasonal ELSE 1.0 END AS seasonal FROM t2 JOIN fac ON t2.series_id = fac.series_id AND t2.pos % 12 = fac.phase)"""
).replace("SELECT series_id, date, value, CASE WHEN n", "SELECT t2.series_id, date, value, CASE WHEN n")
DATE = "strftime(date, '%Y-%m-%d') AS date"
CUT = _ts(q.CUT)
PAIRS = f"""WITH {PANEL}, past AS (SELECT DISTINCT product_id, retailer, price AS old FROM panel WHERE ts < {CUT}),
jumps AS (SELECT product_id, retailer, count(*) AS pairs, count(*) FILTER (abs((price - old) / old) > 0.5) AS jumps
  FROM panel JOIN past USING (product_id, retailer) WHERE ts >= {CUT} GROUP BY 1, 2)"""
ALERTS = """SELECT as_of, 'high_inflation' AS type, 'High inflation detected: ' || printf('%.2f%%', {c}) AS message, 'warning' AS severity FROM res WHERE round({c}, 9) > 5
UNION ALL SELECT as_of, 'deflation', 'Deflation detected: ' || printf('%.2f%%', {c}), 'warning' FROM res WHERE round({c}, 9) < 0"""
LAGS = " UNION ALL ".join(
    f"SELECT CAST({k} AS BIGINT) AS lag, CASE WHEN stddev_pop(a.price_index) > 0 THEN round(corr(a.price_index, b.cpi_value), 6) END AS correlation FROM pos a JOIN pos b ON b.p = a.p - ({k})" for k in range(-4, 5)
)
TRANSFORMED = f"""WITH {PANEL}, ranked AS (SELECT *, CAST(ts AS DATE) AS date, hour(ts) AS hour, row_number() OVER (
    PARTITION BY product_id, retailer, CAST(ts AS DATE), hour(ts)
    ORDER BY ts DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC, price DESC) AS rn FROM panel),
last AS (SELECT * FROM ranked WHERE rn = 1)"""
VALID_DEDUP = f"""WITH {FEED}, ranked AS (SELECT price, {CPI_CATEGORY} AS category, row_number() OVER (
    PARTITION BY product_id, retailer, CAST(ts AS DATE), hour(ts) ORDER BY ts DESC, price DESC) AS rn FROM valid),
kept AS (SELECT category, price FROM ranked WHERE rn = 1), {_outliers("kept")}"""

RULES = f"""WITH {FEED}, m AS (SELECT count(*) AS n, count(price) AS priced, count(category) AS named, count(product_id) AS ids,
    count(*) FILTER (price NOT BETWEEN 0.01 AND 100000) AS bad_price,
    count(*) FILTER (category NOT IN ({", ".join(f"'{c}'" for c in CPI_WEIGHTS)})) AS bad_category FROM feed_panel),
  rules AS (SELECT 'column_to_exist' AS expectation, unnest(['price', 'product_id', 'category']) AS col, 0 AS seen, 0 AS bad
    UNION ALL SELECT 'values_to_be_between', 'price', priced, bad_price FROM m
    UNION ALL SELECT 'values_to_not_be_null', 'product_id', n, n - ids FROM m
    UNION ALL SELECT 'values_to_be_in_set', 'category', named, bad_category FROM m)"""

ORACLE: dict[str, str] = {
    "nowcast_at_date": _index(_points(q.AS_OF)) + INDEX_OUT,
    "nowcast_intraday": _index(_points(*q.INTRADAY)) + INDEX_OUT,
    "nowcast_many_instants": _index(MANY) + INDEX_OUT,
    "nowcast_unweighted": _index(_points(q.AS_OF), weighted=False) + INDEX_OUT,
    "nowcast_empty_window": _index(_points(datetime(2010, 1, 1), q.AS_OF)) + INDEX_OUT,
    "category_breakdown": _index(_points(q.AS_OF))
    + "SELECT as_of, category, weight, round(idx, 6) AS price_index, round(idx - 100, 6) AS inflation_rate, "
    "round((idx - 100) * weight, 6) AS contribution FROM cells WHERE span = 'cur'",
    "base_prices": f"WITH {PANEL}, {_base()} SELECT product_id, category, {_r('base_price')} FROM base",
    "base_price_fallback": f"WITH {PANEL}, {FALLBACK_BASE} SELECT product_id, category, {_r('base_price')} FROM base",
    "historical_nowcasts": _index(DAYS) + SERIES_OUT,
    "monthly_nowcasts": _index(MONTHS) + SERIES_OUT,
    "nowcast_json": _index(_points(q.AS_OF))
    + "SELECT as_of, round(price_index, 6) AS price_index, category, round(idx, 6) AS category_index FROM res JOIN cells USING (as_of) WHERE span = 'cur'",
    "cpi_comparison": ALIGNED
    + """ SELECT count(*) AS points, CASE WHEN stddev_pop(price_index) > 0 THEN round(corr(price_index, cpi_value), 6) END AS correlation,
  round(sqrt(avg((price_index - cpi_value) * (price_index - cpi_value))), 6) AS rmse, round(avg(abs(price_index - cpi_value)), 6) AS mae,
  round(avg(price_index - cpi_value), 6) AS bias, round(stddev_pop(price_index - cpi_value), 6) AS tracking_error FROM aligned""",
    "lead_lag_correlation": ALIGNED + f", pos AS (SELECT *, row_number() OVER (ORDER BY date) AS p FROM aligned) {LAGS}",
    "official_cpi_change": f"WITH {OFFICIAL} SELECT {DATE}, round(cpi_value, 6) AS cpi_value, round((cpi_value / 100 - 1) * 100, 6) AS yoy_change FROM official",
    "valid_records": f"""WITH {FEED} SELECT product_id, product_name, price, original_price, 'USD' AS currency, category, retailer, url,
  ts AS timestamp, unit, quantity, true AS in_stock, rating, review_count FROM valid""",
    "quarantine_reasons": f"""WITH {FEED} SELECT reason, count(*) AS records FROM (
  SELECT unnest(['price', 'url', 'quantity', 'rating']) AS reason, unnest([NOT ok_price, NOT ok_url, NOT ok_quantity, NOT ok_rating]) AS bad FROM broken)
  WHERE bad GROUP BY 1""",
    "category_mapping": f"WITH {FEED} SELECT retailer, category AS raw_category, {CPI_CATEGORY} AS cpi_category, count(*) AS records FROM feed GROUP BY 1, 2, 3",
    "unit_prices": f"WITH {PANEL} SELECT {LINE}, unit, quantity, {UNIT_PRICE} AS unit_price FROM panel",
    "transform_panel": f"""{TRANSFORMED} SELECT product_id, retailer, ts AS timestamp, {DATE}, hour, isodow(ts) - 1 AS day_of_week, week(ts) AS week_of_year,
  product_name, category, price, {UNIT_PRICE} AS price_normalized,
  round(coalesce((price / lag(price) OVER (PARTITION BY product_id, retailer ORDER BY date, hour) - 1) * 100, 0.0), 6) AS price_change_pct FROM last""",
    "hourly_keep_last": f"""WITH {EVENTS}, ranked AS (SELECT *, hour(ts) AS hour, row_number() OVER (
    PARTITION BY product_id, category, CAST(ts AS DATE), hour(ts) ORDER BY ts DESC, event_id DESC) AS rn FROM panel)
  SELECT product_id, category, hour, ts AS timestamp, price, event_id FROM ranked WHERE rn = 1""",
    "incremental_batch": f"""WITH {EVENTS} SELECT event_id, product_id, category, price, ts AS timestamp FROM panel
  WHERE ts > TIMESTAMP '2024-01-20 12:00:00' AND category IN ('purchase', 'view')""",
    "run_metrics": VALID_DEDUP
    + """, n AS (SELECT (SELECT count(*) FROM valid) AS e, (SELECT count(*) FROM kept) AS t, (SELECT count(*) FROM flagged WHERE is_outlier) AS f,
    (SELECT count(*) FROM feed) AS a)
  SELECT '20011105_000000' AS run_id, e AS landed, a - e AS quarantined, t AS transformed, f AS outliers, t - f AS stored, round((t - f) / e, 6) AS stored_share,
    CAST(1 AS BIGINT) AS problems FROM n""",
    "repeated_run": VALID_DEDUP
    + """ SELECT '20011105_000000' AS run_id, (SELECT count(*) FROM valid) AS landed, (SELECT count(*) FROM kept) AS stored, (SELECT count(*) FROM kept) AS in_table""",
    "quarantined_records": f"""WITH {FEED}, named AS (SELECT ts, concat_ws(',', CASE WHEN NOT ok_price THEN 'price' END, CASE WHEN NOT ok_url THEN 'url' END,
    CASE WHEN NOT ok_quantity THEN 'quantity' END, CASE WHEN NOT ok_rating THEN 'rating' END) AS reasons FROM broken)
  SELECT 'lines' AS feed, reasons, count(*) AS records, min(ts) AS first FROM named WHERE reasons <> '' GROUP BY 2""",
    "quality_report": _report() + " SELECT check_name, severity, subject, round(value, 6) AS value, threshold, triggered, message FROM report",
    "quality_report_gaps": _report("timestamp") + " SELECT check_name, severity, subject, round(value, 6) AS value, threshold, triggered, message FROM report",
    "quality_policies": _report()
    + """ SELECT policy, policy = 'raise' AS raised, string_agg(message, '; ' ORDER BY message) AS errors FROM report, (VALUES ('record'), ('raise')) p(policy)
  WHERE triggered AND severity = 'error' GROUP BY 1""",
    "incremental_report": f"""WITH {FEED}, fresh AS (SELECT * FROM feed_panel WHERE ts >= {CUT}), past AS (SELECT DISTINCT product_id, retailer, price AS old FROM feed_panel WHERE ts < {CUT}),
  m AS (SELECT count(*) AS n, count(*) - count(price) AS gone, count(*) FILTER (price < 0) AS neg,
    (SELECT count(*) FROM fresh) - (SELECT count(*) FROM (SELECT DISTINCT product_id, retailer FROM fresh)) AS dup,
    (SELECT count(*) FROM fresh JOIN past USING (product_id, retailer) WHERE abs((price - old) / old) > 0.5) AS jumps FROM fresh)
  SELECT 'empty' AS check_name, CAST(n AS DOUBLE) AS value, n = 0 AS triggered, 'DataFrame is empty' AS message FROM m
  UNION ALL SELECT 'null_price', CAST(gone AS DOUBLE), gone > 0, 'Found ' || gone || ' null price values' FROM m
  UNION ALL SELECT 'negative_price', CAST(neg AS DOUBLE), neg > 0, 'Found ' || neg || ' negative prices' FROM m
  UNION ALL SELECT 'key_duplicates', CAST(dup AS DOUBLE), dup > 0, 'Found ' || dup || ' duplicate product_id/retailer combinations' FROM m
  UNION ALL SELECT 'price_jumps', CAST(jumps AS DOUBLE), jumps > 0, CASE WHEN jumps > 0 THEN jumps || ' products have suspicious price changes (>50%)' END FROM m""",
    "quality_summary": _report()
    + """ SELECT count(*) FILTER (triggered AND severity = 'error') = 0 AS is_valid,
  coalesce(string_agg(message, '; ' ORDER BY message) FILTER (triggered AND severity = 'error'), '') AS errors,
  count(*) FILTER (triggered AND severity = 'warning') AS warnings, CAST(max(value) FILTER (check_name = 'outliers') AS BIGINT) AS outlier_count FROM report""",
    "invalid_categories": f"""WITH {FEED} SELECT category, count(*) AS records FROM feed
  WHERE category NOT IN ({", ".join(f"'{c}'" for c in CPI_WEIGHTS)}) GROUP BY 1""",
    "outlier_flags": f"WITH {PANEL}, {_outliers('panel')} SELECT {LINE}, category, z_outlier, iqr_outlier, is_outlier FROM flagged",
    "clean_panel": f"WITH {PANEL}, {_outliers('panel')} SELECT {LINE}, category, retailer, ts AS timestamp FROM flagged WHERE NOT is_outlier",
    "outliers_per_category": f"""WITH {EVENTS}, {_outliers('panel')} SELECT category, count(*) FILTER (z_outlier) AS z_outliers,
  count(*) FILTER (iqr_outlier) AS iqr_outliers, count(*) FILTER (is_outlier) AS outliers FROM flagged GROUP BY 1""",
    "price_jump_counts": PAIRS + " SELECT product_id, retailer, pairs, jumps FROM jumps",
    "price_jump_warning": PAIRS
    + """, s AS (SELECT CAST(coalesce(sum(jumps), 0) AS BIGINT) AS jumps FROM jumps)
  SELECT jumps, CASE WHEN jumps > 0 THEN jumps || ' products have suspicious price changes (>50%)' END AS message FROM s""",
    "expectation_suite": RULES
    + """ SELECT expectation, col AS column, bad = 0 AS success, CAST(seen AS BIGINT) AS element_count, CAST(bad AS BIGINT) AS unexpected_count,
    CASE WHEN seen = 0 THEN 0.0 ELSE round(bad / seen * 100, 6) END AS unexpected_percent FROM rules""",
    "suite_summary": RULES
    + """ SELECT bool_and(bad = 0) AS success, count(*) AS evaluated, count(*) FILTER (bad = 0) AS successful, count(*) FILTER (bad > 0) AS unsuccessful,
    round(count(*) FILTER (bad = 0) / count(*) * 100, 6) AS success_percent FROM rules""",
    "nowcast_stored": _index(_points(q.AS_OF)) + INDEX_OUT,
    "duplicate_rows": f"""WITH {FEED}, d AS (SELECT * FROM feed_panel UNION ALL SELECT * FROM feed_panel WHERE rating >= 4)
  SELECT 'exact' AS kind, (SELECT count(*) FROM d) - (SELECT count(*) FROM (SELECT DISTINCT * FROM d)) AS records
  UNION ALL SELECT 'key', (SELECT count(*) FROM d) - (SELECT count(*) FROM (SELECT DISTINCT product_id, retailer FROM d))""",
    "summary_stats": f"""WITH {PANEL} SELECT count(*) AS total_records, count(DISTINCT product_id) AS unique_products,
  count(DISTINCT retailer) AS unique_retailers, count(DISTINCT category) AS categories, round(avg(price), 4) AS price_mean,
  round(median(price), 4) AS price_median, round(stddev_samp(price), 4) AS price_std, round(min(price), 4) AS price_min,
  round(max(price), 4) AS price_max FROM panel""",
    "category_distribution": f"WITH {PANEL} SELECT category, count(*) AS records FROM panel GROUP BY 1",
    "product_counts": f"""WITH {PANEL} SELECT 'retailer' AS dimension, retailer AS name, count(product_id) AS records FROM panel GROUP BY 2
  UNION ALL SELECT 'category', category, count(product_id) FROM panel GROUP BY 2""",
    "distinct_retailers": f"WITH {PANEL} SELECT DISTINCT retailer FROM panel",
    "data_quality_tile": f"WITH {PANEL} SELECT count(*) AS total_observations, count(DISTINCT category) AS categories_tracked FROM panel",
    "price_describe": f"""WITH {PANEL} SELECT category, count(price) AS count, round(avg(price), 2) AS mean, round(stddev_samp(price), 2) AS std,
  round(min(price), 2) AS min, round(quantile_cont(price, 0.25), 2) AS p25, round(quantile_cont(price, 0.5), 2) AS p50,
  round(quantile_cont(price, 0.75), 2) AS p75, round(max(price), 2) AS max FROM panel GROUP BY 1""",
    "price_histogram": f"""WITH {PANEL}, ends AS (SELECT category, min(price) AS lo, max(price) AS hi FROM panel GROUP BY 1),
  binned AS (SELECT category, lo, hi, least(CAST(floor((price - lo) / (hi - lo) * 8) AS BIGINT), 7) AS bin FROM panel JOIN ends USING (category))
  SELECT category, bin, round(lo + (hi - lo) / 8 * bin, 6) AS bin_start, round(lo + (hi - lo) / 8 * (bin + 1), 6) AS bin_end, count(*) AS records
  FROM binned GROUP BY category, lo, hi, bin""",
    "daily_mean_price": f"WITH {PANEL} SELECT strftime(ts, '%Y-%m-%d') AS date, CAST(sum(CAST(price AS DECIMAL(20,8))) AS DOUBLE) / count(price) AS avg_price FROM panel GROUP BY 1",
    "daily_category_mean": f"WITH {PANEL} SELECT strftime(ts, '%Y-%m-%d') AS date, category, CAST(sum(CAST(price AS DECIMAL(20,8))) AS DOUBLE) / count(price) AS avg_price FROM panel GROUP BY 1, 2",
    "weighted_daily_index": INDEX_PANEL + f" SELECT {DATE}, round(sum(price_index * weight), 6) AS weighted_index FROM index_panel GROUP BY 1",
    "selected_daily_index": INDEX_PANEL
    + f""" SELECT {DATE}, round(sum(price_index * weight), 6) AS weighted_index FROM index_panel
  WHERE date BETWEEN DATE '1998-01-01' AND DATE '2000-12-31' AND category IN ('grocery', 'housing') GROUP BY 1""",
    "kpi_row": INDEX_PANEL
    + f""", {OFFICIAL}, d AS (SELECT date, sum(price_index * weight) / sum(weight) AS idx FROM index_panel GROUP BY 1),
  cur AS (SELECT * FROM d WHERE date = (SELECT max(date) FROM d)),
  cpi AS (SELECT cpi_value FROM official WHERE date = (SELECT max(date) FROM official))
  SELECT strftime(cur.date, '%Y-%m-%d') AS date, round(cur.idx, 6) AS current_index, round(cur.idx - 100, 6) AS inflation_rate,
    round(coalesce((cur.idx / p.idx - 1) * 100, 0.0), 6) AS mom_change, round(cpi_value, 6) AS official_cpi,
    round(abs(cur.idx - cpi_value), 6) AS tracking_error FROM cur CROSS JOIN cpi LEFT JOIN d p ON p.date = cur.date - 30""",
    "latest_slice": INDEX_PANEL
    + f" SELECT {DATE}, category, round(price_index, 6) AS price_index, weight FROM index_panel WHERE date = (SELECT max(date) FROM index_panel)",
    "yoy_row_lag": INDEX_PANEL
    + f""", d AS (SELECT date, sum(price_index * weight) AS value FROM index_panel GROUP BY 1)
  SELECT {DATE}, round(value, 6) AS value, round((value / lag(value, 365) OVER (ORDER BY d.date) - 1) * 100, 6) AS change FROM d""",
    "index_heatmap": INDEX_PANEL + " SELECT category, strftime(date, '%Y-%m') AS month, round(avg(price_index) - 100, 6) AS deviation FROM index_panel GROUP BY 1, 2",
    "index_heatmap_wide": INDEX_PANEL + f" SELECT category, {_heat} FROM index_panel WHERE year(date) = 1999 GROUP BY 1",
    "inflation_band": _index(MONTHS)
    + "SELECT as_of AS date, CASE WHEN inflation_yoy < 2 THEN 'green' WHEN inflation_yoy < 4 THEN 'yellow' ELSE 'red' END AS band FROM res",
    "alerts": _index(MONTHS) + ALERTS.format(c="inflation_rate"),
    "alerts_on_yoy": _index(MONTHS) + ALERTS.format(c="inflation_yoy"),
    "weights_sorted": f"""WITH {PANEL}, {WEIGHTS} SELECT category, weight, count(product_id) AS records FROM weights LEFT JOIN panel USING (category)
  GROUP BY 1, 2 ORDER BY weight""",
    "subcategory_bridge": f"""WITH bridge(category, subcategory) AS (VALUES {_bridge}),
  lines AS (SELECT {[*_names]}[l_partkey % {len(_names)} + 1] AS subcategory, l_extendedprice FROM lineitem)
  SELECT category, subcategory, count(*) AS records, round(sum(l_extendedprice), 2) AS amount FROM lines JOIN bridge USING (subcategory) GROUP BY 1, 2""",
    "panel_preview": f"WITH {PANEL} SELECT ts AS timestamp, product_id, retailer, price, category FROM panel ORDER BY ts, product_id, retailer, price LIMIT 10",
    "source_categories": f"WITH {CATALOG} SELECT DISTINCT retailer, category FROM catalog",
    "category_scan": f"WITH {CATALOG} {LISTING}",
    "top_products": f"WITH {CATALOG} {LISTING} WHERE retailer = 'Walmart' AND lower(category) = 'grocery' AND rn <= 10",
    "product_lookup": f"""WITH {FEED}, {CATALOG}, ids AS (SELECT retailer, url, CASE WHEN retailer = 'Amazon' THEN nullif(regexp_extract(url, '/dp/([A-Z0-9]{{10}})', 1), '')
    ELSE nullif(regexp_extract(url, '/ip/[^/]+/(\\d+)', 1), '') END AS id FROM feed),
  named AS (SELECT retailer, product_id, product_name, price, {CPI_CATEGORY} AS category FROM catalog)
  SELECT ids.retailer, url, product_id, product_name, round(price, 2) AS price, category
  FROM ids LEFT JOIN named ON named.retailer = ids.retailer AND named.product_id = ids.id""",
    "stored_prices": f"""WITH {PANEL}, runs AS (SELECT '20011105_000000' AS run_id, * FROM panel UNION ALL SELECT '20011106_000000', * FROM panel WHERE ts >= {CUT})
  SELECT run_id, category, count(*) AS records, round(sum(price), 2) AS total FROM runs GROUP BY 1, 2""",
    "retention_files": f"""WITH {PANEL} SELECT status, 1 AS runs, true AS has_files, true AS has_bytes FROM (VALUES ('expired'), ('kept')) s(status)
  WHERE EXISTS (SELECT 1 FROM panel WHERE status = 'expired' OR ts >= {CUT})""",
    "retention_drop": f"WITH {PANEL} SELECT '20011106_000000' AS run_id, count(*) AS records, 1 AS runs_deleted FROM panel WHERE ts >= {CUT}",
    "latest_snapshot": f"WITH {PANEL} SELECT product_id, retailer, ts AS timestamp, category, price FROM panel WHERE ts >= {CUT}",
    "history_scan": f"""WITH {PANEL} SELECT DISTINCT product_id, product_name, retailer, ts AS timestamp, category, price, unit, quantity FROM panel
  WHERE ts BETWEEN TIMESTAMP '1999-07-01' AND TIMESTAMP '2000-06-30' AND category = 'grocery'""",
    "stored_by_category": f"WITH {PANEL} SELECT category, '20011105_000000' AS run_id, count(*) AS records, min(ts) AS first, max(ts) AS last FROM panel GROUP BY 1",
    "raw_landing": f"WITH {FEED} SELECT '20011105_000000' AS run_id, retailer, category, count(*) AS records, count(price_text) AS priced FROM feed GROUP BY 2, 3",
    "retention_report": f"""WITH {PANEL} SELECT CASE WHEN ts >= {CUT} THEN 'kept' ELSE 'expired' END AS status, count(DISTINCT CAST(ts AS DATE)) AS days,
  count(*) AS records FROM panel GROUP BY 1""",
    "csv_series_scan": SERIES + f" SELECT series_id, {DATE}, round(value, 6) AS value FROM monthly",
    "seasonal_adjusted_series": SEASONAL
    + f" SELECT series_id, {DATE}, round(value, 6) AS value, round(seasonal, 6) AS seasonal, round(value / seasonal, 6) AS adjusted FROM adj",
    "ma_forecast": MA + f" SELECT series_id, step, {DATE}, {_r('forecast', 'lower', 'upper')}, 'moving_average' AS model FROM ma",
    "ma_forecast_daily": INDEX_PANEL
    + f""", d AS (SELECT date, sum(price_index * weight) AS value FROM index_panel GROUP BY 1),
  steps AS (SELECT date - lag(date) OVER (ORDER BY date) AS step FROM d),
  f AS (SELECT min(step) = 1 AND max(step) = 1 AS daily FROM steps),
  level AS (SELECT max(date) AS last_date, stddev_samp(value) AS sd, (SELECT avg(value) FROM (SELECT value FROM d ORDER BY date DESC LIMIT 12)) AS level FROM d)
  SELECT 'all' AS series_id, CAST(step AS BIGINT) AS step,
    strftime(CASE WHEN daily THEN last_date + CAST(step AS INTEGER) ELSE CAST(date_trunc('month', last_date) + to_months(CAST(step AS INTEGER)) AS DATE) END, '%Y-%m-%d') AS date,
    round(level, 6) AS forecast, round(level - {Z!r} * sd, 6) AS lower, round(level + {Z!r} * sd, 6) AS upper, 'moving_average' AS model
  FROM level, f, generate_series(1, 30) g(step)""",
    "ma_backtest_folds": FOLDS + f" SELECT series_id, pos, {DATE}, {_r('actual', 'predicted', 'lower', 'upper')} FROM folds",
    "backtest_metrics": FOLDS
    + """, turned AS (SELECT *, sign(actual - lag(actual) OVER w) = sign(predicted - lag(predicted) OVER w) AS turn
    FROM folds WINDOW w AS (PARTITION BY series_id ORDER BY pos))
  SELECT series_id, count(*) AS folds, strftime(min(date), '%Y-%m-%d') AS test_period_start, strftime(max(date), '%Y-%m-%d') AS test_period_end,
    round(sqrt(avg((actual - predicted) * (actual - predicted))), 6) AS rmse, round(avg(abs(actual - predicted)), 6) AS mae,
    round(avg(abs((actual - predicted) / actual)) * 100, 6) AS mape, round(avg(CAST(turn AS INTEGER)), 6) AS directional_accuracy,
    round(avg(CAST(actual BETWEEN lower AND upper AS INTEGER)), 6) AS coverage_probability, round(avg(actual - predicted), 6) AS forecast_bias
  FROM turned GROUP BY 1""",
    "backtest_errors": FOLDS
    + " SELECT series_id, row_number() OVER (PARTITION BY series_id ORDER BY pos) - 1 AS fold, round(actual - predicted, 6) AS error FROM folds",
    "ljung_box": LJUNG + f" SELECT series_id, n, round(q, 6) AS q, round({CHI_TAIL}, 6) AS p_value FROM lb",
    "short_series": f"""WITH {PANEL} SELECT product_id || '@' || retailer AS series_id, count(DISTINCT date_trunc('month', ts)) AS points FROM panel
  GROUP BY 1 HAVING count(DISTINCT date_trunc('month', ts)) < 12""",
    "forecast_band_table": MA
    + " SELECT series_id, strftime(date, '%Y-%m') AS month, round(forecast, 6) AS forecast, round(forecast - 1.5, 6) AS lower, round(forecast + 1.5, 6) AS upper FROM ma",
    "first_forecast_steps": MA + f" SELECT series_id, step, {DATE}, round(forecast, 6) AS forecast FROM ma WHERE step <= 3",
    "band_outline": MA
    + """ SELECT series_id, step - 1 AS i, strftime(date, '%Y-%m-%d') AS x, round(upper, 6) AS y FROM ma
  UNION ALL SELECT series_id, 24 - step, strftime(date, '%Y-%m-%d'), round(lower, 6) FROM ma""",
    "forecast_chart_series": MA
    + f""" SELECT series_id, {DATE}, 'history' AS kind, round(value, 6) AS value, CAST(NULL AS DOUBLE) AS lower, CAST(NULL AS DOUBLE) AS upper
  FROM prepared WHERE pos >= n - 24
  UNION ALL SELECT series_id, {DATE}, 'forecast', {_r('forecast', 'lower', 'upper')} FROM ma""",
    "forecast_json": FOLDS
    + f""", level AS (SELECT series_id, avg(CASE WHEN pos >= n - 12 THEN value END) AS level, stddev_samp(value) AS sd, max(date) AS last_date
    FROM prepared WHERE n >= 12 GROUP BY 1),
  rmse AS (SELECT series_id, sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse FROM folds GROUP BY 1)
  SELECT series_id, 'moving_average' AS model, round(rmse, 6) AS rmse, CAST(i AS BIGINT) AS i,
    strftime(last_date + to_months(CAST(i + 1 AS INTEGER)), '%Y-%m-%d') AS date, round(level, 6) AS forecast, round(level + {Z!r} * sd, 6) AS upper
  FROM level JOIN rmse USING (series_id), generate_series(0, 11) g(i)""",
    "stream_hourly_last": f"""WITH {EVENTS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY product_id, retailer, date_trunc('hour', ts)
    ORDER BY ts DESC, event_id DESC) AS rn FROM panel)
  SELECT product_id, retailer, strftime(ts, '%Y-%m-%d %H') AS hour, price, category, event_id FROM ranked WHERE rn = 1""",
    "stream_category_index": f"""WITH {EVENTS}, {_base(q.EVENTS_START, 10)},
  rel AS (SELECT CAST(ts AS DATE) AS day, category, ln(price / base_price) AS l FROM panel JOIN base USING (category, product_id) WHERE price > 0 AND base_price > 0),
  win AS (SELECT day - CAST(k AS INTEGER) AS window_start, category, l FROM rel, generate_series(0, 6) g(k))
  SELECT strftime(window_start, '%Y-%m-%d') AS window_start, strftime(window_start + 7, '%Y-%m-%d') AS window_end, category, count(*) AS n_rel,
    round(CASE WHEN count(*) >= 10 THEN exp(avg(l)) * 100 ELSE 100.0 END, 6) AS price_index FROM win GROUP BY window_start, category""",
}
