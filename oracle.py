"""Independent SQL for the catalog's queries, for DuckDB over the same parquet tables.

Written as named CTEs; a query lists the CTEs it needs and gets their dependencies.
"""

from __future__ import annotations

CTES: dict[str, tuple[tuple[str, ...], str]] = {}
ORACLE: dict[str, str] = {}
STORED = {"ec", "e", "hit"}  # read more than once by the queries that label the panel


def cte(name: str, body: str, *deps: str) -> None:
    CTES[name] = (deps, body)


def sql(name: str, select: str, *deps: str) -> None:
    order: list[str] = []

    def need(n):
        for d in CTES[n][0]:
            need(d)
        if n not in order:
            order.append(n)

    for d in deps:
        need(d)
    head = ", ".join(f"{n} AS {'MATERIALIZED ' if n in STORED else ''}({CTES[n][1]})" for n in order)
    recursive = "RECURSIVE " if any("UNION ALL SELECT /* step */" in CTES[n][1] for n in order) else ""
    ORACLE[name] = f"WITH {recursive}{head} {select}" if head else select


def r(x: str, digits: int = 6, name: str | None = None) -> str:
    scale = f"{10**digits}.0::DOUBLE"
    return f"floor(({x}) * {scale} + 0.4871::DOUBLE) / {scale} AS {name or x.split('.')[-1]}"


def rs(columns: str, digits: int = 6) -> str:
    return ", ".join(r(c, digits) for c in columns.split())


E_DIMS = ("kpi_name", "tier", "band")
O_DIMS = ("kpi_name", "region", "segment", "priority")
L_DIMS = ("kpi_name", "region", "segment", "priority", "return_flag", "line_status")
ED, OD, LD = ("date, " + ", ".join(d) for d in (E_DIMS, O_DIMS, L_DIMS))
MONEY = "DECIMAL(18,2)"

# ------------------------------------------------------------------ panels

cte("ec", f"""
SELECT CAST(ts AS DATE) AS date, CONCAT('T', CAST(user_id % 3 AS VARCHAR)) AS tier,
  CASE WHEN k < 34 THEN 'low' WHEN k < 67 THEN 'mid' ELSE 'high' END AS band,
  COUNT(*) FILTER (event_type='view') AS impressions, COUNT(*) FILTER (event_type='click') AS clicks,
  COUNT(*) FILTER (event_type='signup') AS conversions, COUNT(*) FILTER (event_type='purchase') AS orders,
  COALESCE(CAST(SUM(CAST(value AS {MONEY})) FILTER (event_type='purchase') AS DOUBLE), 0.0) AS revenue,
  CAST(SUM(CAST(value AS {MONEY})) FILTER (event_type='error') AS DOUBLE)
    / NULLIF(COUNT(*) FILTER (event_type='error'), 0) AS latency_ms
FROM (SELECT *, CAST(json_extract_string(props,'$.k') AS INT) AS k FROM events) GROUP BY 1, 2, 3""")
_E_KPIS = {
    "conversion_rate": "COALESCE(CAST(conversions AS DOUBLE)/NULLIF(clicks,0),0.0)",
    "click_through_rate": "COALESCE(CAST(clicks AS DOUBLE)/NULLIF(impressions,0),0.0)",
    "average_order_value": "COALESCE(revenue/NULLIF(orders,0),0.0)",
    "latency_ms": "latency_ms",
    "revenue_per_session": "COALESCE(revenue/NULLIF(impressions,0),0.0)",
}


def long(source: str, keys: str, kpis: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {keys}, '{k}' AS kpi_name, CAST({e} AS DOUBLE) AS kpi_value FROM {source}" for k, e in kpis.items()
    )


_COUNTERS = "impressions, clicks, conversions, orders, revenue, latency_ms"
cte("e", long("ec", f"date, tier, band, {_COUNTERS}", _E_KPIS), "ec")
cte("ow", f"""
SELECT CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS date, r_name AS region, c_mktsegment AS segment,
  o_orderpriority AS priority, COUNT(*) AS orders, COUNT(DISTINCT o_custkey) AS customers,
  CAST(SUM(CAST(o_totalprice AS {MONEY})) AS DOUBLE) AS revenue, COUNT(*) FILTER (o_orderstatus='F') AS finished
FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey
JOIN region ON n_regionkey=r_regionkey GROUP BY 1,2,3,4""")
cte("o", long("ow", "date, region, segment, priority", {
    "average_order_value": "revenue/NULLIF(orders,0)",
    "revenue_per_customer": "revenue/NULLIF(customers,0)",
    "finished_rate": "CAST(finished AS DOUBLE)/NULLIF(orders,0)",
}), "ow")
cte("lw", f"""
SELECT CAST(DATE_TRUNC('month', l_shipdate) AS DATE) AS date, r_name AS region, c_mktsegment AS segment,
  o_orderpriority AS priority, l_returnflag AS return_flag, l_linestatus AS line_status, COUNT(*) AS lines,
  CAST(SUM(CAST(l_quantity AS {MONEY})) AS DOUBLE) AS quantity,
  CAST(SUM(CAST(l_extendedprice AS {MONEY})) AS DOUBLE) AS gross,
  CAST(SUM(CAST(l_discount AS {MONEY})) AS DOUBLE) AS discounted,
  CAST(SUM(CAST(l_tax AS {MONEY})) AS DOUBLE) AS taxed
FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey
JOIN nation ON c_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey GROUP BY 1,2,3,4,5,6""")
cte("l", long("lw", "date, region, segment, priority, return_flag, line_status, lines, quantity, gross, discounted, taxed", {
    "units_per_line": "quantity/NULLIF(lines,0)",
    "discount_rate": "discounted/NULLIF(lines,0)",
    "price_per_unit": "gross/NULLIF(quantity,0)",
}), "lw")

sql("kpi_panel_events", f"SELECT {ED}, {r('kpi_value')} FROM e", "e")
sql("kpi_panel_orders", f"SELECT {OD}, {r('kpi_value', 4)} FROM o", "o")
sql("kpi_panel_lineitem",
    f"SELECT {LD}, lines, {rs('quantity gross discounted taxed', 2)}, {r('kpi_value')} FROM l", "l")

RULES = """(VALUES
 ('INC-CONVERSION-T1-LOW','conversion_drop','Conversion rate drop in T1 low.',DATE '2024-01-20',DATE '2024-01-24','conversion_rate','T1','low'),
 ('INC-LATENCY-T0','latency_spike','Latency spike in T0.',DATE '2024-01-15',DATE '2024-01-18','latency_ms','T0',NULL),
 ('INC-LATENCY-T0-HIGH','latency_spike_high','Latency spike in T0 high.',DATE '2024-01-17',DATE '2024-01-22','latency_ms','T0','high')
) AS rules(id, typ, descr, d0, d1, kpi, t, b)"""
cte("rule_days", f"SELECT id, typ, descr, kpi, t, b, CAST(UNNEST(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) AS date FROM {RULES}")
cte("hit", """SELECT date, kpi_name, tier, band, string_agg(id, '|' ORDER BY id) AS ids, string_agg(typ, '|' ORDER BY id) AS typs,
    string_agg(descr, ' ' ORDER BY id) AS descrs
  FROM (SELECT DISTINCT date, kpi_name, tier, band FROM e) x JOIN rule_days USING (date)
  WHERE COALESCE(kpi, kpi_name) = kpi_name AND COALESCE(t, tier) = tier AND COALESCE(b, band) = band GROUP BY 1, 2, 3, 4""", "e", "rule_days")
cte("lab", """SELECT e.*, hit.ids IS NOT NULL AS is_incident, COALESCE(hit.ids, '') AS incident_id, COALESCE(hit.typs, '') AS incident_type,
  COALESCE(hit.descrs, '') AS incident_description FROM e LEFT JOIN hit USING (date, kpi_name, tier, band)""", "e", "hit")
_LABELS = "is_incident, incident_id, incident_type, incident_description"
sql("labelled_panel", f"SELECT {ED}, {r('kpi_value')}, {_LABELS} FROM lab", "lab")
sql("payload_flatten", f"""SELECT CAST(ts AS DATE) AS date, 'pageviews' AS kpi_name,
  CONCAT('p', CAST(user_id % 6 AS VARCHAR)) AS project, event_type AS access, 'user' AS agent,
  {r('value', name='kpi_value')} FROM events""")
cte("doc", """SELECT event_id, event_type AS access, CONCAT('p', CAST(user_id % 6 AS VARCHAR)) AS project, 'user' AS agent,
  CAST(ts AS DATE) AS date, value, event_id % 7 = 0 AS broken, event_id % 7 <> 0 AND event_id % 11 = 0 AS empty FROM events""")
sql("payload_failures", """SELECT event_id, access, CASE WHEN broken THEN 'Unreadable payload' ELSE 'Empty payload' END AS error
  FROM doc WHERE broken OR empty""", "doc")
cte("asked", """SELECT project, access, 'user' AS agent FROM (SELECT UNNEST(['p0', 'p1', 'p2', 'p3', 'p4', 'p5', 'p6']) AS project),
  (SELECT UNNEST(['view', 'click', 'signup', 'purchase', 'error']) AS access)""")
cte("came", "SELECT * FROM doc WHERE NOT broken AND NOT empty", "doc")
sql("series_ledger", """SELECT a.project, a.access, a.agent, COUNT(c.event_id) AS rows, COUNT(DISTINCT c.date) AS days, MIN(c.date) AS first_day,
  MAX(c.date) AS last_day, CASE WHEN COUNT(c.event_id) > 0 THEN 'received' ELSE 'failed' END AS status,
  CASE WHEN COUNT(c.event_id) = 0 THEN 'No payload' END AS error
  FROM asked a LEFT JOIN came c USING (project, access, agent) GROUP BY 1, 2, 3""", "asked", "came")
sql("requested_coverage", f"""SELECT {r('share', 2, 'health_score')}, CASE WHEN share >= 98 AND observed_series = 35 THEN 'PASS' ELSE 'FAIL' END AS status,
  35 AS expected_series, observed_series, observed_days, {r('share', 2, 'coverage_pct')}, 35 - observed_series AS fetch_failures
  FROM (SELECT COUNT(DISTINCT (project, access)) AS observed_series, COUNT(DISTINCT date) AS observed_days,
    100 * (COUNT(DISTINCT (date, project, access))::DOUBLE / (35 * COUNT(DISTINCT date))) AS share FROM came)""", "came")
sql("requested_missing_cells", """SELECT project, access, agent, date FROM (SELECT project, access, agent,
    CAST(UNNEST(generate_series(DATE '2024-01-10', DATE '2024-01-20', INTERVAL 1 DAY)) AS DATE) AS date FROM asked) g
  WHERE NOT EXISTS (SELECT 1 FROM came c WHERE c.project = g.project AND c.access = g.access AND c.agent = g.agent AND c.date = g.date)""", "asked", "came")
cte("cells", """SELECT l_orderkey, l_linenumber, l_orderkey + l_linenumber AS n, l_shipdate, l_quantity, l_extendedprice, l_returnflag, l_linestatus FROM lineitem""")
sql("typed_cells", f"""SELECT l_orderkey, l_linenumber, CASE WHEN n % 5 <> 0 AND n % 7 <> 0 THEN CAST(l_shipdate AS DATE) END AS shipped,
  CASE WHEN n % 3 <> 0 AND n % 4 <> 0 THEN CAST(trunc(l_quantity) AS BIGINT) END AS quantity,
  {r("CASE WHEN n % 6 <> 0 AND n % 8 <> 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) END", 2, "price")},
  n % 9 <> 0 AND (l_returnflag = 'R' OR n % 2 = 0) AS returned, l_linestatus AS mode FROM cells""", "cells")
sql("lookback_rows", f"""SELECT {ED}, {r('kpi_value')} FROM e
  WHERE date BETWEEN DATE '2024-01-19' AND DATE '2024-01-28'""", "e")
sql("report_window_rows", f"""SELECT {OD}, {r('kpi_value', 4)} FROM o
  WHERE date >= (SELECT MAX(date) FROM o) - 364""", "o")
sql("panel_slice", f"""SELECT {OD}, {r('kpi_value', 4)} FROM o WHERE kpi_name='average_order_value'
  AND date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' AND region IN ('ASIA','EUROPE') AND priority='1-URGENT'""", "o")
sql("concatenated_panels", f"""SELECT date, kpi_name, {r('kpi_value', 4)} FROM
  (SELECT date, kpi_name, kpi_value FROM e UNION ALL SELECT date, kpi_name, kpi_value FROM o)""", "e", "o")

# ------------------------------------------------------------------ monitoring

THRESHOLDS = {
    "e": {"conversion_rate": (.08, .16, "lower_is_bad"), "click_through_rate": (.06, .10, "lower_is_bad"),
          "average_order_value": (.08, .12, "lower_is_bad"), "latency_ms": (.15, .30, "higher_is_bad"),
          "revenue_per_session": (.18, .30, "lower_is_bad")},
    "o": {"average_order_value": (.08, .12, "lower_is_bad"), "finished_rate": (.1013, .2537, "higher_is_bad")},
    "l": {"units_per_line": (.1537, .3071, "lower_is_bad"), "discount_rate": (.2537, .5071, "higher_is_bad"),
          "price_per_unit": (.1013, .2029, "lower_is_bad")},
}


def case(table: dict[str, object], default: str) -> str:
    quote = lambda v: f"'{v}'" if isinstance(v, str) else f"CAST({v} AS DOUBLE)"
    return "CASE kpi_name " + " ".join(f"WHEN '{k}' THEN {quote(v)}" for k, v in table.items()) + f" ELSE {default} END"


def define_monitoring(p: str, dims: tuple[str, ...]) -> None:
    t = THRESHOLDS[p]
    warn = case({k: v[0] for k, v in t.items()}, "CAST(0.05 AS DOUBLE)")
    crit = case({k: v[1] for k, v in t.items()}, "CAST(0.10 AS DOUBLE)")
    direction = case({k: v[2] for k, v in t.items()}, "'lower_is_bad'")
    keys = ", ".join(dims)
    w = f"PARTITION BY {keys} ORDER BY date ROWS BETWEEN"
    cte(f"{p}m0", f"""
SELECT date, {keys}, kpi_value AS actual_value,
  AVG(kpi_value) OVER ({w} 6 PRECEDING AND CURRENT ROW) AS rolling_avg_7d,
  AVG(kpi_value) OVER ({w} 13 PRECEDING AND CURRENT ROW) AS rolling_avg_14d,
  AVG(kpi_value) OVER ({w} 27 PRECEDING AND CURRENT ROW) AS rolling_avg_28d,
  CASE WHEN COUNT(kpi_value) OVER ({w} 28 PRECEDING AND 1 PRECEDING) >= 7
    THEN list_sum(list_sort(list(kpi_value) FILTER (kpi_value IS NOT NULL) OVER ({w} 28 PRECEDING AND 1 PRECEDING)))
      / COUNT(kpi_value) OVER ({w} 28 PRECEDING AND 1 PRECEDING) END AS moving_baseline,
  CASE WHEN COUNT(kpi_value) OVER ({w} 28 PRECEDING AND 1 PRECEDING) >= 7
    THEN STDDEV_SAMP(kpi_value) OVER ({w} 28 PRECEDING AND 1 PRECEDING) END AS std
FROM {p}""", p)
    cte(f"{p}m1", f"""
SELECT *, moving_baseline AS expected_value, actual_value - moving_baseline AS absolute_variance,
  (actual_value - moving_baseline) / NULLIF(moving_baseline, 0) AS percent_variance,
  {warn} AS warn, {crit} AS crit, {direction} AS threshold_direction FROM {p}m0""", f"{p}m0")
    cte(f"{p}m", f"""
SELECT * EXCLUDE (warn, crit), CASE WHEN monitoring_status='CRITICAL' THEN crit ELSE warn END AS threshold_value,
  monitoring_status <> 'NORMAL' AS threshold_breached
FROM (SELECT *, CASE WHEN threshold_direction='higher_is_bad'
    THEN CASE WHEN percent_variance >= crit THEN 'CRITICAL' WHEN percent_variance >= warn THEN 'WARNING' ELSE 'NORMAL' END
    ELSE CASE WHEN percent_variance <= -crit THEN 'CRITICAL' WHEN percent_variance <= -warn THEN 'WARNING' ELSE 'NORMAL' END
  END AS monitoring_status FROM {p}m1)""", f"{p}m1")
    cte(f"{p}z", f"""
SELECT *, zscore_severity <> 'NORMAL' AS zscore_anomaly FROM (SELECT *,
  CASE WHEN ABS(z_score) >= 4 THEN 'CRITICAL' WHEN ABS(z_score) >= 3 THEN 'WARNING' ELSE 'NORMAL' END AS zscore_severity
  FROM (SELECT *, (actual_value - moving_baseline) / NULLIF(std, 0) AS z_score FROM {p}m))""", f"{p}m")


for _p, _d in (("e", E_DIMS), ("o", O_DIMS), ("l", L_DIMS)):
    define_monitoring(_p, _d)

_MON = "actual_value rolling_avg_7d rolling_avg_14d rolling_avg_28d moving_baseline expected_value absolute_variance percent_variance threshold_value"
_MON_TEXT = "threshold_direction, threshold_breached, monitoring_status"
sql("rolling_means", f"SELECT {ED}, {rs('rolling_avg_7d rolling_avg_14d rolling_avg_28d')} FROM em", "em")
sql("lagged_baseline", f"""SELECT {OD}, {rs('actual_value moving_baseline absolute_variance', 3)},
  {r('percent_variance')} FROM om""", "om")
for _n in ("monitoring_table_events", "monitoring_table_blocked", "staged_monitoring"):
    sql(_n, f"SELECT {ED}, {rs(_MON)}, {_MON_TEXT} FROM em", "em")
sql("detector_slice", f"SELECT {ED}, {rs(_MON)}, {_MON_TEXT} FROM em WHERE threshold_breached", "em")
sql("monitoring_table_lineitem", f"""SELECT {LD}, {r('moving_baseline', 5)}, {rs('percent_variance threshold_value')},
  threshold_breached, monitoring_status FROM lm""", "lm")
sql("monitoring_status_fallback", f"SELECT {OD}, threshold_value, {_MON_TEXT} FROM om", "om")
sql("monitoring_summary", """SELECT COUNT(*) AS total_monitoring_rows,
  string_agg(DISTINCT kpi_name, ',' ORDER BY kpi_name) AS kpi_names, MIN(date) AS date_min, MAX(date) AS date_max,
  COUNT(*) FILTER (monitoring_status='WARNING') AS warning_count,
  COUNT(*) FILTER (monitoring_status='CRITICAL') AS critical_count,
  COUNT(*) FILTER (threshold_breached) AS threshold_breach_count FROM om""", "om")
sql("breaches_by_kpi", "SELECT kpi_name, COUNT(*) AS breaches FROM om WHERE threshold_breached GROUP BY 1", "om")
sql("worst_variances", f"""SELECT {OD}, {r('round_even(actual_value, 6)', 3, 'actual_value')},
  {r('round_even(expected_value, 6)', 3, 'expected_value')}, {r('round_even(percent_variance, 6)', name='percent_variance')}, monitoring_status
  FROM om WHERE percent_variance IS NOT NULL ORDER BY ABS(percent_variance) DESC, {OD} LIMIT 10""", "om")


def health(source: str, digits: int = 6, fill: bool = False, digits_pct: int | None = None) -> str:
    z = (lambda x: f"COALESCE({x}, 0.0)") if fill else (lambda x: x)
    v = digits if digits_pct is None else digits_pct
    return f"""SELECT date, kpi_name, COUNT(*) AS monitored_rows, COUNT(*) FILTER (monitoring_status='NORMAL') AS normal_rows,
  COUNT(*) FILTER (monitoring_status='WARNING') AS warning_rows, COUNT(*) FILTER (monitoring_status='CRITICAL') AS critical_rows,
  COUNT(*) FILTER (threshold_breached) AS breach_rows, {r('AVG(actual_value)', digits, 'avg_actual_value')},
  {r(z('AVG(expected_value)'), digits, 'avg_expected_value')}, {r(z('AVG(percent_variance)'), v, 'avg_percent_variance')},
  {r(z('MAX(ABS(percent_variance))'), v, 'max_abs_percent_variance')},
  {r("GREATEST(0.0, LEAST(100.0, 100 - (COUNT(*) FILTER (monitoring_status='WARNING') * 0.5::DOUBLE + COUNT(*) FILTER (monitoring_status='CRITICAL') * 1.5::DOUBLE) / COUNT(*) * 100))", v, 'health_score')}
FROM {source} GROUP BY 1, 2"""


sql("kpi_health_by_day", health("em"), "em")
sql("kpi_health_filled", health("em", fill=True), "em")
sql("kpi_health_lineitem", health("lm", 5), "lm")

# ------------------------------------------------------------------ detection

for _n in ("zscore_events", "zscore_blocked"):
    sql(_n, f"SELECT {ED}, {r('z_score')}, zscore_severity, zscore_anomaly FROM ez", "ez")
sql("zscore_lineitem", f"SELECT {LD}, {r('z_score')}, zscore_severity, zscore_anomaly FROM lz", "lz")
cte("wide", "SELECT *, COALESCE(CAST(conversions AS DOUBLE)/NULLIF(clicks,0),0.0) AS conversion_rate FROM ec", "ec")


def define_wide(name: str, metric: str) -> None:
    w = "OVER (PARTITION BY tier, band ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"
    cte(name, f"""
SELECT *, ABS(z) > 2 AS flagged FROM (SELECT *, COALESCE(({metric} - rolling_mean) / NULLIF(rolling_std, 0), 0.0) AS z
FROM (SELECT *, CASE WHEN COUNT({metric}) {w} >= 7 THEN AVG({metric}) {w} END AS rolling_mean,
  CASE WHEN COUNT({metric}) {w} >= 7 THEN STDDEV_SAMP({metric}) {w} END AS rolling_std FROM wide))""", "wide")
    cte(f"{name}_worst", f"""
SELECT date, tier, band, round_even(z, 2) AS z_score, round_even({metric}, 4) AS actual_value,
  round_even(rolling_mean, 4) AS rolling_mean, z FROM {name} WHERE flagged ORDER BY ABS(z) DESC, date, tier, band LIMIT 10""", name)


for _m, _n in (("conversion_rate", "wc"), ("latency_ms", "wl"), ("revenue", "wr")):
    define_wide(_n, _m)
sql("wide_detector", f"""SELECT date, tier, band, {rs('conversion_rate rolling_mean rolling_std')},
  {r('z', name='conversion_rate_zscore')}, flagged AS conversion_rate_anomaly FROM wc""", "wc")
sql("wide_worst", "SELECT * EXCLUDE (z) FROM wc_worst", "wc_worst")


def digest(metric: str, name: str) -> str:
    return f"""SELECT '{metric}' AS kpi, COALESCE(printf('%.4f', actual_value), 'N/A') AS current_value,
  COALESCE(printf('%.4f', rolling_mean), 'N/A') AS rolling_baseline, COALESCE(printf('%.2f', z_score), '0.00') AS z_score,
  CASE WHEN ABS(z_score) >= 5 THEN 'Critical' WHEN ABS(z_score) >= 3 THEN 'High' WHEN ABS(z_score) >= 2 THEN 'Medium'
    ELSE 'Normal' END AS severity,
  COALESCE(tier || ' / ' || band || ' / any', 'No anomaly detected') AS primary_offender,
  CASE WHEN tier IS NULL THEN 'No immediate investigation suggested.' ELSE
   'Review the affected segment for recent product, tracking, campaign, or performance changes.' END AS suggested_investigation
FROM (SELECT 1) LEFT JOIN (SELECT * FROM {name}_worst ORDER BY ABS(z_score) DESC, date, tier, band LIMIT 1) ON TRUE"""


sql("metric_digest", " UNION ALL ".join((digest("conversion_rate", "wc"), digest("latency_ms", "wl"), digest("revenue", "wr"))),
    "wc_worst", "wl_worst", "wr_worst")


def define_split(p: str) -> None:
    cte(f"{p}s", f"""SELECT d[1] AS start, d[greatest(1, least(len(d) - 1, CAST(floor(len(d) * 0.7::DOUBLE) AS INT))) + 1] AS split
FROM (SELECT list_sort(list(DISTINCT date)) AS d FROM {p})""", p)


for _p in ("e", "o", "l"):
    define_split(_p)
sql("train_split_date", "SELECT start, split FROM os", "os")
sql("baseline_median", f"SELECT kpi_name, {r('MEDIAN(moving_baseline)', name='median')} FROM lm GROUP BY 1", "lm")
sql("baseline_median_overall", f"SELECT {r('MEDIAN(moving_baseline)', 3, 'median')} FROM om", "om")
cte("emed", "SELECT MEDIAN(moving_baseline) AS med FROM em", "em")
_vocab = " || ".join(
    f"CAST(CAST({c}='{v}' AS INT) AS VARCHAR)"
    for c, vs in (("tier", ("T0", "T1", "T2")), ("band", ("high", "low", "mid")))
    for v in vs
)
sql("model_features", f"""SELECT {ED}, {r('COALESCE(moving_baseline, med)', name='feature_moving_baseline')},
  CAST(date - start AS DOUBLE) AS feature_days_since_start, CAST((isodow(date) - 1) AS DOUBLE) AS feature_day_of_week,
  CAST(month(date) AS DOUBLE) AS feature_month, {_vocab} AS one_hot FROM em, emed, es""", "em", "emed", "es")


def define_ridge(name: str, p: str, group: str, min_rows: int, dims: str) -> None:
    """One standardised feature: slope = n cov / (var (n + alpha))."""
    cte(f"{name}x", f"SELECT z.*, COALESCE(moving_baseline, (SELECT MEDIAN(moving_baseline) FROM {p}z)) AS x FROM {p}z z", f"{p}z")
    cte(f"{name}f", f"""SELECT {group}, COUNT(*) AS n, AVG(x) AS mx, AVG(actual_value) AS my,
  COALESCE(COUNT(*) * COVAR_POP(x, actual_value) / NULLIF(VAR_POP(x) * (COUNT(*) + 1.0), 0), 0.0) AS w
FROM {name}x, {p}s WHERE date < split AND actual_value IS NOT NULL GROUP BY {group}""", f"{name}x", f"{p}s")
    cte(f"{name}p", f"""SELECT x.*, CASE WHEN f.n >= {min_rows} THEN f.my + f.w * (x.x - f.mx) ELSE moving_baseline END AS predicted_value
FROM {name}x x LEFT JOIN {name}f f USING ({group})""", f"{name}x", f"{name}f")


define_ridge("er", "e", "kpi_name", 8, ED)
define_ridge("or", "o", "kpi_name, region, segment, priority", 50, OD)
_adverse = case({k: v[2] for k, v in THRESHOLDS["e"].items()}, "NULL")
cte("ere", f"""
SELECT *, residual_severity <> 'NORMAL' AS residual_anomaly FROM (SELECT *,
  CASE WHEN bad >= 0.40::DOUBLE THEN 'CRITICAL' WHEN bad >= 0.20::DOUBLE THEN 'WARNING' ELSE 'NORMAL' END AS residual_severity
 FROM (SELECT *, CASE WHEN dir='higher_is_bad' THEN residual_percent WHEN dir='lower_is_bad' THEN -residual_percent END AS bad
  FROM (SELECT *, actual_value - predicted_value AS residual, {_adverse} AS dir,
    (actual_value - predicted_value) / NULLIF(predicted_value, 0) AS residual_percent FROM erp)))""", "erp")
_RES = "residual_anomaly, residual_severity"
sql("residual_ridge_univariate", f"SELECT {ED}, {rs('predicted_value residual residual_percent')}, {_RES} FROM ere", "ere")
sql("residual_ridge_per_series", f"SELECT {OD}, {r('predicted_value', 3)} FROM orp", "orp")


def define_full_ridge(p: str, dims: tuple[str, ...], alpha: float = 1.0) -> None:
    """All features: the normal equations of every KPI as a list of lists, solved by Gauss-Jordan steps."""
    hot = ", ".join(f"{{'f': '{d}=' || {d}, 'v': 1.0::DOUBLE}}" for d in dims)
    cte(f"{p}x", f"""SELECT {p}m.*, row_number() OVER () AS rid, date < split AND actual_value IS NOT NULL AS train,
  COALESCE(moving_baseline, (SELECT MEDIAN(moving_baseline) FROM {p}m)) AS x1, CAST(date - start AS DOUBLE) AS x2,
  CAST(isodow(date) - 1 AS DOUBLE) AS x3, CAST(month(date) AS DOUBLE) AS x4 FROM {p}m, {p}s""", f"{p}m", f"{p}s")
    centred = ", ".join(f"x{i} - AVG(x{i}) FILTER (train) OVER k AS c{i}" for i in range(1, 5))
    cte(f"{p}c", f"SELECT *, {centred}, AVG(actual_value) FILTER (train) OVER k AS ybar FROM {p}x WINDOW k AS (PARTITION BY kpi_name)", f"{p}x")
    numeric = ", ".join(f"{{'f': '#{i}', 'v': c{i}}}" for i in range(1, 5))
    cte(f"{p}f", f"""SELECT rid, kpi_name, train, y, t.f AS f, t.v AS v FROM (
  SELECT rid, kpi_name, train, actual_value - ybar AS y, UNNEST([{numeric}, {hot}]) AS t FROM {p}c)""", f"{p}c")
    cte(f"{p}n", f"""SELECT kpi_name, f, ROW_NUMBER() OVER (PARTITION BY kpi_name ORDER BY f) AS spot, n, mu, sqrt(sq / n - mu * mu) AS sd, b - n * mu * yb AS b FROM (
  SELECT kpi_name, f, n, yb, SUM(v) / n AS mu, SUM(v * v) AS sq, SUM(v * y) AS b FROM {p}f
  JOIN (SELECT kpi_name, CAST(COUNT(*) AS DOUBLE) AS n, AVG(actual_value - ybar) AS yb FROM {p}c WHERE train GROUP BY 1) USING (kpi_name)
  WHERE train GROUP BY kpi_name, f, n, yb) WHERE sqrt(greatest(sq / n - mu * mu, 0)) > 1e-9""", f"{p}f", f"{p}c")
    cte(f"{p}g", f"""SELECT a.kpi_name, a.f AS fa, b.f AS fb, SUM(a.v * b.v) AS g FROM {p}f a JOIN {p}f b USING (rid)
  WHERE a.train GROUP BY ALL""", f"{p}f")
    cte(f"{p}w", f"""SELECT kpi_name, list(line ORDER BY spot) AS m FROM (
  SELECT a.kpi_name, a.spot, list_concat(list((COALESCE(g, 0) - a.n * a.mu * b.mu) / (a.sd * b.sd) + CASE WHEN a.f = b.f THEN {alpha} ELSE 0 END ORDER BY b.spot),
    list(DISTINCT a.b / a.sd)) AS line
  FROM {p}n a JOIN {p}n b USING (kpi_name) LEFT JOIN {p}g g ON g.kpi_name = a.kpi_name AND fa = a.f AND fb = b.f GROUP BY 1, 2) GROUP BY 1""", f"{p}n", f"{p}g")
    cte(f"{p}j", f"""SELECT kpi_name, 0 AS k, m FROM {p}w UNION ALL SELECT /* step */ kpi_name, k + 1,
  list_transform(m, lambda r, i: CASE WHEN i = k + 1 THEN list_transform(r, lambda x: x / m[k + 1][k + 1])
    ELSE list_transform(r, lambda x, j: x - r[k + 1] * m[k + 1][j] / m[k + 1][k + 1]) END) FROM {p}j WHERE k < len(m)""", f"{p}w")
    cte(f"{p}b", f"""SELECT n.kpi_name, n.f, n.mu, j.m[n.spot][len(j.m) + 1] / n.sd AS w
  FROM {p}j j JOIN {p}n n ON n.kpi_name = j.kpi_name WHERE j.k = len(j.m)""", f"{p}j", f"{p}n")
    cte(f"{p}p", f"""SELECT c.*, CASE WHEN (SELECT COUNT(*) FROM {p}c t WHERE t.train AND t.kpi_name = c.kpi_name) >= 8
    THEN ybar + level + fit ELSE moving_baseline END AS predicted_value FROM {p}c c
  JOIN (SELECT f.rid, COALESCE(SUM(f.v * b.w), 0.0) AS fit FROM {p}f f LEFT JOIN {p}b b USING (kpi_name, f) GROUP BY 1) USING (rid)
  JOIN (SELECT kpi_name, -SUM(mu * w) AS level FROM {p}b GROUP BY 1) USING (kpi_name)""", f"{p}c", f"{p}f", f"{p}b")


cte("lrm", "SELECT * FROM lz", "lz")
cte("lrs", "SELECT * FROM ls", "ls")
define_full_ridge("lr", L_DIMS[1:])
_l_adverse = case({k: v[2] for k, v in THRESHOLDS["l"].items()}, "NULL")
cte("lre", f"""
SELECT *, residual_severity <> 'NORMAL' AS residual_anomaly FROM (SELECT *,
  CASE WHEN bad >= 0.40::DOUBLE THEN 'CRITICAL' WHEN bad >= 0.20::DOUBLE THEN 'WARNING' ELSE 'NORMAL' END AS residual_severity
 FROM (SELECT *, CASE WHEN dir='higher_is_bad' THEN residual_percent WHEN dir='lower_is_bad' THEN -residual_percent END AS bad
  FROM (SELECT *, actual_value - predicted_value AS residual, {_l_adverse} AS dir,
    (actual_value - predicted_value) / NULLIF(predicted_value, 0) AS residual_percent FROM lrp)))""", "lrp")
sql("residual_ridge_full", f"SELECT {LD}, {rs('predicted_value residual residual_percent')}, {_RES} FROM lre", "lre")
cte("gx", """SELECT em.*, row_number() OVER () AS rid, date < split AND actual_value IS NOT NULL AS train,
  COALESCE(moving_baseline, (SELECT MEDIAN(moving_baseline) FROM em)) AS x0, CAST(date - start AS DOUBLE) AS x1,
  CAST(isodow(date) - 1 AS DOUBLE) AS x2, CAST(month(date) AS DOUBLE) AS x3 FROM em, es""", "em", "es")
cte("gb", "SELECT kpi_name, AVG(actual_value) AS base, COUNT(*) AS n FROM gx WHERE train GROUP BY 1", "gx")
cte("gf", """SELECT rid, kpi_name, train, g, t.f AS f, t.x AS x, t.m AS m FROM (SELECT rid, kpi_name, train, actual_value - base AS g,
  UNNEST([{'f': 0, 'x': x0, 'm': NULL}, {'f': 1, 'x': x1, 'm': NULL}, {'f': 2, 'x': x2, 'm': NULL}, {'f': 3, 'x': x3, 'm': NULL},
    {'f': 4, 'x': NULL, 'm': tier}, {'f': 5, 'x': NULL, 'm': band}]) AS t FROM gx JOIN gb USING (kpi_name))""", "gx", "gb")
cte("gc", """SELECT DISTINCT kpi_name, f, d[CAST(ceil(i * len(d) / 32.0) AS INT)] AS v, NULL::VARCHAR AS m FROM (
  SELECT kpi_name, f, list_sort(list(x)) AS d, UNNEST(range(1, 32)) AS i FROM gf WHERE train AND f < 4 GROUP BY 1, 2)
UNION ALL SELECT DISTINCT kpi_name, f, NULL, m FROM gf WHERE train AND f >= 4""", "gf")
cte("gs", """SELECT kpi_name, f, v, m, gl, nl, gr, nr, gl * gl / (nl + 1) + gr * gr / (nr + 1) - (gl + gr) * (gl + gr) / (nl + nr + 1) AS gain FROM (
  SELECT c.kpi_name, c.f, c.v, c.m, SUM(g) FILTER (hit) AS gr, COUNT(*) FILTER (hit) AS nr, SUM(g) FILTER (NOT hit) AS gl, COUNT(*) FILTER (NOT hit) AS nl
  FROM (SELECT c.*, r.g, CASE WHEN c.f < 4 THEN r.x > c.v ELSE r.m = c.m END AS hit FROM gc c JOIN gf r ON r.kpi_name = c.kpi_name AND r.f = c.f AND r.train) c
  GROUP BY 1, 2, 3, 4) WHERE nl > 0 AND nr > 0""", "gc", "gf")
cte("gt", "SELECT * FROM gs QUALIFY row_number() OVER (PARTITION BY kpi_name ORDER BY gain DESC, f, v, m DESC) = 1", "gs")
sql("residual_boosted_stump", f"""SELECT {ED}, {r('actual_value')}, {r('p', name='predicted_value')} FROM (
  SELECT x.*, base + 0.5 * CASE WHEN (t.f < 4 AND r.x > t.v) OR (t.f >= 4 AND r.m = t.m) THEN gr / (nr + 1) ELSE gl / (nl + 1) END AS p
  FROM gx x JOIN gb USING (kpi_name) JOIN gt t USING (kpi_name) JOIN gf r ON r.rid = x.rid AND r.f = t.f)""", "gx", "gb", "gt", "gf")
cte("emad", """
SELECT kpi_name, med, MEDIAN(ABS(residual - med)) AS mad FROM ere JOIN
  (SELECT kpi_name, MEDIAN(residual) AS med FROM ere GROUP BY 1) USING (kpi_name) GROUP BY 1, 2""", "ere")
cte("erm", """
SELECT * EXCLUDE (residual_severity, residual_anomaly), CASE WHEN bad2 >= 5.0 THEN 'CRITICAL' WHEN bad2 >= 3.5 THEN 'WARNING' ELSE 'NORMAL' END AS residual_severity
FROM (SELECT *, CASE WHEN dir='higher_is_bad' THEN residual_modified_zscore WHEN dir='lower_is_bad' THEN -residual_modified_zscore END AS bad2
 FROM (SELECT ere.*, 0.6745::DOUBLE * (residual - med) / NULLIF(mad, 0) AS residual_modified_zscore FROM ere JOIN emad USING (kpi_name)))""", "ere", "emad")
sql("residual_robust_mad", f"""SELECT {ED}, {rs('residual residual_modified_zscore')},
  residual_severity <> 'NORMAL' AS residual_anomaly, residual_severity FROM erm""", "erm")
_rank = lambda c: f"CASE {c} WHEN 'CRITICAL' THEN 2 WHEN 'WARNING' THEN 1 ELSE 0 END"
_name = lambda x: f"CASE {x} WHEN 2 THEN 'CRITICAL' WHEN 1 THEN 'WARNING' ELSE 'NORMAL' END"
_worse = _name(f"GREATEST({_rank('zscore_severity')}, {_rank('residual_severity')})")
cte("ea", f"""
SELECT ere.*, zscore_anomaly OR residual_anomaly AS combined_anomaly, {_worse} AS combined_severity, {_LABELS}
FROM ere LEFT JOIN lab USING (date, kpi_name, tier, band)""", "ere", "lab")
sql("combined_detector", f"SELECT {ED}, zscore_severity, residual_severity, combined_anomaly, combined_severity FROM ea", "ea")
_ANOM = (f"{rs('actual_value expected_value moving_baseline percent_variance')}, monitoring_status, threshold_breached, "
         f"{r('z_score')}, zscore_anomaly, zscore_severity, {rs('predicted_value residual residual_percent')}, "
         f"residual_anomaly, residual_severity, combined_anomaly, combined_severity, {_LABELS}")
for _n in ("anomaly_results", "staged_anomalies"):
    sql(_n, f"SELECT {ED}, {_ANOM} FROM ea", "ea")
sql("anomaly_results_unlabelled", f"""SELECT {OD}, {r('z_score')}, zscore_severity, FALSE AS is_incident, '' AS incident_id,
  '' AS incident_type, '' AS incident_description FROM oz""", "oz")

# ------------------------------------------------------------------ evaluation


def confusion(source: str, detectors: list[str]) -> str:
    parts = " UNION ALL ".join(
        f"""SELECT '{d}' AS detector, COUNT(*) FILTER (is_incident AND {d}) AS tp, COUNT(*) FILTER (NOT is_incident AND {d}) AS fp,
  COUNT(*) FILTER (is_incident AND NOT {d}) AS fn, COUNT(*) FILTER (NOT is_incident AND NOT {d}) AS tn,
  COUNT(*) FILTER (is_incident) AS support, COUNT(*) AS total_rows FROM {source}""" for d in detectors)
    return f"""SELECT detector, round_even(p, 6) AS precision, round_even(rc, 6) AS recall,
  round_even(COALESCE(2*p*rc/NULLIF(p+rc,0),0.0), 6) AS f1_score, tp AS true_positives, fp AS false_positives,
  fn AS false_negatives, tn AS true_negatives, support, total_rows
FROM (SELECT *, COALESCE(CAST(tp AS DOUBLE)/NULLIF(tp+fp,0),0.0) AS p, COALESCE(CAST(tp AS DOUBLE)/NULLIF(tp+fn,0),0.0) AS rc FROM ({parts}))"""


cte("ev", confusion("ea", ["threshold_breached", "zscore_anomaly", "residual_anomaly", "combined_anomaly"]), "ea")
sql("detector_evaluation", "SELECT * FROM ev", "ev")
sql("best_detector", "SELECT * FROM ev ORDER BY f1_score DESC, recall DESC, precision DESC, detector LIMIT 1", "ev")
cte("doclab", """SELECT quality = 1 AS is_incident, n_chars >= 500 AS long_text, n_chars >= 2000 AS very_long_text
  FROM labels JOIN documents USING (doc_id)""")
sql("document_label_evaluation", confusion("doclab", ["long_text", "very_long_text"]), "doclab")

# ------------------------------------------------------------------ root causes


def exact(x: str, over: str = "") -> str:
    """A sum on a grid of integers, the same in any order of rows."""
    return f"(CAST(SUM(CAST(round({x} * {2**60}::DOUBLE) AS HUGEINT)) {over} AS DOUBLE) / {2**60}::DOUBLE)"


def define_rca(p: str, specs: dict[str, tuple[str, ...]], source: str | None = None, detector: str = "threshold_breached",
               severity: str = "monitoring_status", thresholds: str | None = None) -> None:
    t, source = THRESHOLDS[thresholds or p], source or f"{p}m"
    higher = [k for k, v in t.items() if v[2] == "higher_is_bad"]
    lst = ", ".join(f"'{k}'" for k in higher)
    cte(f"{p}cand", f"""SELECT *, GREATEST(0.0, CASE WHEN kpi_name IN ({lst}) THEN actual_value - expected_value
  ELSE expected_value - actual_value END) AS degradation_amount FROM {source}
  WHERE {detector} AND {severity} IN ('WARNING','CRITICAL') AND expected_value IS NOT NULL
    AND percent_variance IS NOT NULL""", source)
    union = " UNION ALL ".join(
        f"""SELECT date AS analysis_date, kpi_name, '{detector}' AS detector_used, '{name}' AS dimension_type,
  concat_ws(' + ', {', '.join(cols)}) AS dimension_value, AVG(actual_value) AS actual_value_sum_or_avg,
  AVG(expected_value) AS expected_value_sum_or_avg, {exact('degradation_amount')} AS degradation_amount,
  CAST(COUNT(*) AS BIGINT) AS anomaly_count, {_name("MAX(" + _rank(severity) + ")")} AS severity_max
FROM {p}cand WHERE degradation_amount > 0 GROUP BY ALL""" for name, cols in specs.items())
    cte(f"{p}rca", f"""
SELECT *, 'Review ' || kpi_name || ' drivers for ' || dimension_type || ' = ' || dimension_value ||
  '; check recent releases, tracking changes, campaign mix, and operational issues.' AS recommended_action,
  LEAST(1.0, degradation_amount / {exact('degradation_amount', 'OVER (PARTITION BY analysis_date, kpi_name, dimension_type)')}) AS contribution_share,
  CAST(ROW_NUMBER() OVER (PARTITION BY analysis_date, kpi_name, dimension_type ORDER BY degradation_amount DESC, dimension_value) AS INT)
    AS contribution_rank FROM ({union})""", f"{p}cand")


define_rca("e", {"tier": ("tier",), "band": ("band",), "full_segment": ("tier", "band")})
define_rca("o", {"region": ("region",), "segment": ("segment",), "priority": ("priority",),
                 "region_segment": ("region", "segment"), "full_segment": ("region", "segment", "priority")})
define_rca("l", {**{c: (c,) for c in L_DIMS[1:]}, "region_segment_priority": ("region", "segment", "priority"),
                 "full_segment": L_DIMS[1:]})
cte("ldet", f"""SELECT *, zscore_anomaly OR residual_anomaly AS combined_anomaly, {_worse} AS combined_severity, FALSE AS is_incident,
  '' AS incident_id, '' AS incident_type, '' AS incident_description FROM lre""", "lre")
sql("detected_lineitem", f"SELECT {LD}, {_ANOM} FROM ldet", "ldet")
sql("residual_anomaly_counts", "SELECT date, kpi_name, COUNT(*) AS anomaly_count FROM ldet WHERE residual_anomaly GROUP BY 1, 2", "ldet")
define_rca("ld", {**{c: (c,) for c in L_DIMS[1:]}, "region_segment_priority": ("region", "segment", "priority"),
                  "full_segment": L_DIMS[1:]}, "ldet", "residual_anomaly", "residual_severity", "l")
sql("rca_candidates", f"SELECT {OD}, {r('degradation_amount', 3)}, monitoring_status FROM ocand", "ocand")
sql("rca_candidate_summary", """SELECT COUNT(*) AS detector_anomaly_count,
  COUNT(*) FILTER (expected_value IS NOT NULL AND percent_variance IS NOT NULL) AS valid_expected_baseline_count,
  COUNT(*) FILTER (expected_value IS NOT NULL AND percent_variance IS NOT NULL AND degradation > 0) AS degrading_anomaly_count,
  COUNT(*) FILTER (expected_value IS NULL OR percent_variance IS NULL) AS excluded_missing_expected_or_baseline,
  COUNT(*) FILTER (expected_value IS NOT NULL AND percent_variance IS NOT NULL AND degradation <= 0) AS excluded_non_degrading
FROM (SELECT *, CASE WHEN kpi_name='finished_rate' THEN actual_value - expected_value ELSE expected_value - actual_value END AS degradation
  FROM om WHERE threshold_breached)""", "om")
sql("rca_candidate_count", "SELECT COUNT(*) AS total_anomalies_analyzed FROM ocand", "ocand")
_RCA_KEYS = "kpi_name, detector_used, dimension_type, dimension_value"


def rca_columns(digits: int, share: int = 6) -> str:
    return (f"{_RCA_KEYS}, {rs('actual_value_sum_or_avg expected_value_sum_or_avg degradation_amount', digits)}, "
            f"{r('contribution_share', share)}, contribution_rank, anomaly_count, severity_max")


sql("rca_contributions", f"SELECT analysis_date, {rca_columns(6)}, recommended_action FROM erca", "erca")
sql("rca_ranked_by_detector", f"SELECT analysis_date, {rca_columns(6)}, CAST(anomaly_count AS INT) AS anomaly_count, recommended_action FROM erca"
    .replace("anomaly_count, severity_max, CAST", "severity_max, CAST"), "erca")
ORACLE["staged_rca"] = ORACLE["rca_ranked_by_detector"]
sql("rca_contributions_orders", f"SELECT analysis_date, {rca_columns(2)}, recommended_action FROM orca", "orca")
sql("rca_contributions_lineitem", f"SELECT analysis_date, {rca_columns(4, 5)}, recommended_action FROM lrca", "lrca")
sql("rca_contributions_residual", f"SELECT analysis_date, {rca_columns(4, 5)}, recommended_action FROM ldrca", "ldrca")


def statement(share: str = "contribution_share", higher: str = "kpi_name='latency_ms'") -> str:
    return (f"'For ' || kpi_name || ' on ' || CAST(analysis_date AS VARCHAR) || ', ' || dimension_value || CASE WHEN {higher} "
            f"THEN ' accounted for ' ELSE ' contributed ' END || printf('%.1f', {share} * 100) || '% of ' || CASE WHEN {higher} "
            f"THEN 'excess latency.' ELSE 'measured degradation.' END")


sql("rca_statements", f"""SELECT analysis_date, kpi_name, dimension_type, dimension_value,
  {statement()} AS root_cause_statement FROM erca""", "erca")
_TOP = f"analysis_date, kpi_name, dimension_type, dimension_value, {r('degradation_amount', 3)}, {r('contribution_share')}"
_TIES = "analysis_date, kpi_name, dimension_type, dimension_value"
_BY_SHARE = f"contribution_share DESC, degradation_amount DESC, {_TIES}"
_BY_AMOUNT = f"degradation_amount DESC, contribution_share DESC, {_TIES}"
_INTER = "dimension_type IN ('region_segment','full_segment')"


def define_causes(p: str, table: str, interactions: str) -> None:
    cte(f"{p}top", f"SELECT *, ROW_NUMBER() OVER (ORDER BY {_BY_SHARE}) AS pos, 2 AS pr FROM {table} WHERE {interactions} AND contribution_share >= 0.05 ORDER BY pos LIMIT 10", table)
    cte(f"{p}kpi", f"""SELECT *, ROW_NUMBER() OVER (ORDER BY {_BY_AMOUNT}) AS pos, 0 AS pr FROM (SELECT * FROM {table} WHERE {interactions}
  QUALIFY ROW_NUMBER() OVER (PARTITION BY kpi_name ORDER BY {_BY_AMOUNT}) = 1)""", table)
    cte(f"{p}dim", f"""SELECT *, ROW_NUMBER() OVER (ORDER BY {_BY_AMOUNT}) AS pos, 1 AS pr FROM (SELECT * FROM {table}
  QUALIFY ROW_NUMBER() OVER (PARTITION BY dimension_type ORDER BY {_BY_AMOUNT}) = 1)""", table)
    cte(f"{p}causes", f"""SELECT *, ROW_NUMBER() OVER (ORDER BY pr, pos) AS position FROM (
  SELECT * FROM (SELECT * FROM {p}kpi UNION ALL BY NAME SELECT * FROM {p}dim UNION ALL BY NAME SELECT * FROM {p}top)
  QUALIFY ROW_NUMBER() OVER (PARTITION BY {_TIES} ORDER BY pr, pos) = 1) ORDER BY position LIMIT 10""", f"{p}kpi", f"{p}dim", f"{p}top")


define_causes("o", "orca", _INTER)
define_causes("ld", "ldrca", "dimension_type IN ('region_segment_priority','full_segment')")
sql("rca_top_causes_residual", f"""SELECT analysis_date, {rca_columns(4, 5)}, recommended_action, CAST(position AS INT) AS position
  FROM ldcauses""", "ldcauses")
sql("rca_overall_top", f"SELECT {_TOP} FROM otop", "otop")
sql("rca_top_by_kpi", f"SELECT {_TOP} FROM okpi", "okpi")
sql("rca_top_by_dimension", f"SELECT {_TOP} FROM odim", "odim")
for _n, _k in (("rca_top_contributors_by_kpi", "kpi_name"), ("rca_top_contributors_by_dimension", "dimension_type")):
    sql(_n, f"""SELECT {_TOP}, CAST(position AS INT) AS position FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {_k} ORDER BY {_BY_SHARE})
  AS position FROM orca) WHERE position <= 10""", "orca")
sql("rca_top_causes", f"""SELECT {_TOP}, CAST(position AS INT) AS position, {statement(higher="kpi_name='finished_rate'")} AS root_cause_statement
  FROM ocauses""", "ocauses")
sql("rca_action_examples", """SELECT recommended_action, CAST(MIN(position) AS INT) AS position FROM ocauses GROUP BY 1
  ORDER BY 2, 1 LIMIT 5""", "ocauses")
sql("rca_slice", f"""SELECT analysis_date, {rca_columns(3)}, recommended_action FROM orca WHERE kpi_name='average_order_value'
  AND analysis_date=DATE '1998-03-01' AND dimension_type='full_segment'
  ORDER BY contribution_share DESC, degradation_amount DESC, dimension_value LIMIT 20""", "orca")

# ------------------------------------------------------------------ quality

cte("q", """
SELECT COUNT(*) AS n, COUNT(*) FILTER (latency_ms IS NULL) AS lat_null, COUNT(*) FILTER (kpi_value IS NULL) AS val_null,
  COUNT(*) FILTER (impressions < 1) AS imp_low, COUNT(*) FILTER (latency_ms IS NULL OR latency_ms < 1 OR latency_ms > 200) AS lat_range,
  COUNT(*) FILTER (kpi_value IS NULL OR kpi_value < 0) AS val_range, COUNT(*) FILTER (tier NOT IN ('T0','T1')) AS tier_bad,
  COUNT(*) FILTER (band NOT IN ('low','mid','high')) AS band_bad,
  COUNT(DISTINCT date) AS days, CAST(MAX(date) - MIN(date) AS BIGINT) + 1 AS span, CAST(DATE '2024-02-20' - MAX(date) AS BIGINT) AS age,
  (SELECT MIN(c) FROM (SELECT COUNT(*) AS c FROM lab GROUP BY date)) AS fewest,
  (SELECT COALESCE(SUM(c), 0) FROM (SELECT COUNT(*) AS c FROM lab GROUP BY date, kpi_name, tier HAVING COUNT(*) > 1)) AS dup
FROM lab""", "lab")
cte("qc", """
SELECT 'schema' AS "check", TRUE AS passed, 1.0::DOUBLE AS score, 20 AS weight, 0::BIGINT AS issue_count,
  'Required schema present' AS yes, '' AS no FROM q
UNION ALL SELECT 'data_types', lat_null + val_null = 0, 1 - (lat_null + val_null)::DOUBLE / (n * 6), 15, lat_null + val_null,
  'Data types are parseable', 'Data type parse failures' FROM q
UNION ALL SELECT 'accepted_values', tier_bad + band_bad = 0, CASE WHEN tier_bad + band_bad = 0 THEN 1.0 ELSE 0.0 END, 10,
  CAST(tier_bad > 0 AS BIGINT) + CAST(band_bad > 0 AS BIGINT), 'Accepted value checks passed', 'Invalid categorical values' FROM q
UNION ALL SELECT 'nulls', lat_null + val_null = 0, 1 - (lat_null + val_null)::DOUBLE / (n * 4), 15, lat_null + val_null,
  'No required-field nulls found', 'Required-field nulls found' FROM q
UNION ALL SELECT 'duplicates', dup = 0, 1 - dup::DOUBLE / n, 10, CAST(dup AS BIGINT), 'No duplicate business keys found',
  'Duplicate business-key rows found' FROM q
UNION ALL SELECT 'freshness', age <= 14, CASE WHEN age <= 14 THEN 1.0 ELSE 0.0 END, 10, age, 'Freshness check passed',
  'Latest data is too old or undated' FROM q
UNION ALL SELECT 'completeness', days::DOUBLE / GREATEST(span, 60) >= 0.98::DOUBLE AND days >= 60,
  LEAST(1.0, days::DOUBLE / GREATEST(span, 60) / 0.98::DOUBLE), 10, days, 'Date completeness check passed', 'Date completeness below expectation' FROM q
UNION ALL SELECT 'volume', n >= 1500 AND fewest >= 45, LEAST(1.0, n / 1500::DOUBLE, fewest / 45::DOUBLE), 5, fewest,
  'Volume check passed', 'Volume below configured expectation' FROM q
UNION ALL SELECT 'numeric_ranges', imp_low + lat_range + val_range = 0, 1 - (imp_low + lat_range + val_range)::DOUBLE / (n * 3), 5,
  imp_low + lat_range + val_range, 'Numeric range checks passed', 'Numeric range failures' FROM q""", "q")
cte("qr", """
SELECT CASE WHEN health_score >= 90 AND bad = 0 THEN 'PASS' ELSE 'FAIL' END AS status, health_score >= 90 AND bad = 0 AS is_healthy,
  health_score, issues FROM (SELECT CAST(GREATEST(0, LEAST(100, round_even(100 - SUM(weight * (1 - score)), 0))) AS INT) AS health_score,
  COUNT(*) FILTER (NOT passed) AS bad, COALESCE(string_agg(no, '; ' ORDER BY ord) FILTER (NOT passed), '') AS issues FROM (SELECT *, list_position(['schema','data_types','accepted_values','nulls','duplicates','freshness','completeness','volume','numeric_ranges'], "check") AS ord FROM qc))""", "qc")
sql("quality_checks", f"""SELECT "check", passed, {r('score')}, weight, issue_count, CASE WHEN passed THEN yes ELSE no END AS summary FROM qc""", "qc")
sql("quality_failures", """SELECT * FROM (
  SELECT 'data_types' AS "check", 'latency_ms' AS "column", lat_null AS failing FROM q UNION ALL SELECT 'data_types', 'kpi_value', val_null FROM q
  UNION ALL SELECT 'nulls', 'latency_ms', lat_null FROM q UNION ALL SELECT 'nulls', 'kpi_value', val_null FROM q
  UNION ALL SELECT 'accepted_values', 'tier', tier_bad FROM q UNION ALL SELECT 'accepted_values', 'band', band_bad FROM q
  UNION ALL SELECT 'numeric_ranges', 'impressions', imp_low FROM q UNION ALL SELECT 'numeric_ranges', 'latency_ms', lat_range FROM q
  UNION ALL SELECT 'numeric_ranges', 'kpi_value', val_range FROM q) WHERE failing > 0""", "q")
sql("quality_report", "SELECT * FROM qr", "qr")
sql("quality_gate", f"""SELECT n AS actual_records, {r('nulls', 4, 'max_null_percentage')}, n >= 10 AS volume_passed,
  nulls <= 0.01::DOUBLE AS nulls_passed, 100 - CASE WHEN n < 10 THEN 30 ELSE 0 END - CASE WHEN nulls > 0.01::DOUBLE THEN 40 ELSE 0 END AS health_score,
  CASE WHEN 100 - CASE WHEN n < 10 THEN 30 ELSE 0 END - CASE WHEN nulls > 0.01::DOUBLE THEN 40 ELSE 0 END < 70 THEN 'FAIL' ELSE 'PASS' END AS status,
  100 - CASE WHEN n < 10 THEN 30 ELSE 0 END - CASE WHEN nulls > 0.01::DOUBLE THEN 40 ELSE 0 END >= 70 AS is_healthy,
  concat_ws('; ', CASE WHEN n < 10 THEN 'Low volume' END, CASE WHEN nulls > 0.01::DOUBLE THEN printf('High Nulls (%.1f%%)', nulls * 100) END) AS issues
FROM (SELECT COUNT(*) AS n, GREATEST(AVG(CAST(latency_ms IS NULL AS INT)), AVG(CAST(kpi_value IS NULL AS INT))) AS nulls FROM e)""", "e")
sql("offending_values", """SELECT "column", value, rows, CAST(position AS INT) AS position FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY "column" ORDER BY value) AS position
FROM (SELECT 'lang' AS "column", lang AS value, COUNT(*) AS rows FROM documents WHERE lang NOT IN ('en','fr') GROUP BY 1,2
  UNION ALL SELECT 'source', source, COUNT(*) FROM documents WHERE source NOT IN ('src0','src1','src2') GROUP BY 1,2)) WHERE position <= 10""")
sql("duplicate_keys", "SELECT l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem GROUP BY 1,2 HAVING COUNT(*) > 1")
sql("duplicate_key_sample", "SELECT l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem GROUP BY 1,2 HAVING COUNT(*) > 1 ORDER BY 1,2 LIMIT 5")
sql("coverage_quality", f"""SELECT {r('share', 2, 'health_score')}, CASE WHEN share / 100 >= 0.98::DOUBLE THEN 'PASS' ELSE 'FAIL' END AS status,
  2250 AS expected_series, observed_series, observed_days, {r('share', 2, 'coverage_pct')}, 0 AS fetch_failures
FROM (SELECT COUNT(*) AS rows, COUNT(DISTINCT (kpi_name, region, segment, priority, return_flag, line_status)) AS observed_series,
  COUNT(DISTINCT date) AS observed_days, 100 * (COUNT(*)::DOUBLE / (2250 * COUNT(DISTINCT date))) AS share FROM l)""", "l")
sql("table_assertions", """SELECT assertion, violations, violations = 0 AS passed FROM (
  SELECT 'orders.o_orderkey unique' AS assertion, COUNT(*) AS violations FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING COUNT(*) > 1)
  UNION ALL SELECT 'lineitem.l_orderkey not_null', COUNT(*) FROM lineitem WHERE l_orderkey IS NULL
  UNION ALL SELECT 'lineitem.l_returnflag accepted', COUNT(DISTINCT l_returnflag) FROM lineitem WHERE l_returnflag NOT IN ('A','N')
  UNION ALL SELECT 'lineitem key unique', COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)
  UNION ALL SELECT 'lineitem.l_discount bounds', COUNT(*) FROM lineitem WHERE l_discount < 0 OR l_discount > 0.05::DOUBLE
  UNION ALL SELECT 'lineitem.l_orderkey relationship', COUNT(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
  UNION ALL SELECT 'orders.o_custkey relationship', COUNT(DISTINCT o_custkey) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
  UNION ALL SELECT 'documents.doc_id labelled', COUNT(DISTINCT doc_id) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
  UNION ALL SELECT 'rca.contribution_share bounds', COUNT(*) FROM erca WHERE contribution_share < 0 OR contribution_share > 1
  UNION ALL SELECT 'rca key unique', COUNT(*) FROM (SELECT 1 FROM erca GROUP BY analysis_date, kpi_name, detector_used, dimension_type, dimension_value HAVING COUNT(*) > 1))""", "erca")

# ------------------------------------------------------------------ incidents

cte("iagg", f"""SELECT date, kpi_name, AVG(actual_value) AS a, AVG(expected_value) AS x, AVG(percent_variance) AS v, COUNT(*) AS n,
  MAX(ABS(percent_variance)) AS worst, MAX({_rank('monitoring_status')}) AS sev FROM em
  WHERE threshold_breached AND monitoring_status IN ('WARNING','CRITICAL') AND expected_value IS NOT NULL AND percent_variance IS NOT NULL
  GROUP BY 1,2""", "em")
sql("incident_aggregates", f"""SELECT date, kpi_name, {r('a', name='mean_actual')}, {r('x', name='mean_expected')}, {r('v', name='mean_variance')},
  n AS anomaly_count, {r('worst', name='worst_variance')}, sev AS severity_rank FROM iagg""", "iagg")
cte("icause", """SELECT *, round_even(contribution_share, 6) AS share6 FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY analysis_date, kpi_name
  ORDER BY contribution_share DESC, degradation_amount DESC, dimension_type, dimension_value) AS rn
  FROM erca WHERE dimension_type = 'full_segment') WHERE rn <= 3""", "erca")
sql("incident_causes", f"""SELECT analysis_date, kpi_name, CAST(rn - 1 AS INT) AS "at", dimension_type, dimension_value,
  {r('share6', name='contribution_share')}, {r('round_even(degradation_amount, 6)', name='degradation_amount')}, severity_max AS severity, recommended_action FROM icause""", "icause")
cte("evt", confusion("(SELECT em.threshold_breached, lab.is_incident FROM em JOIN lab USING (date, kpi_name, tier, band))", ["threshold_breached"]), "em", "lab")
cte("inc0", """SELECT date, kpi_name, string_agg(dimension_value, ' / ' ORDER BY rn) AS dims, string_agg(recommended_action, '~' ORDER BY rn) AS acts,
  MAX(share6) AS share, MAX(share6) FILTER (rn = 1) AS first_share, MAX(dimension_value) FILTER (rn = 1) AS cause
  FROM (SELECT analysis_date AS date, * FROM icause) GROUP BY 1,2""", "icause")
cte("inc1", f"""SELECT g.*, COALESCE(c.dims, '') AS dims, COALESCE(c.acts, '') AS acts, COALESCE(c.share, 0.0) AS share,
  COALESCE(c.first_share, 0.0) AS first_share, COALESCE(c.cause, 'the affected segment') AS cause,
  (SELECT f1_score FROM evt) AS f1, (SELECT health_score FROM qr)::DOUBLE AS hs, (SELECT status FROM qr) AS qstatus,
  (SELECT COUNT(*) FROM em WHERE monitoring_status='CRITICAL') AS ncrit
FROM iagg g LEFT JOIN inc0 c USING (date, kpi_name)""", "iagg", "inc0", "evt", "qr", "em")
_RPS = ("'Review revenue per session drivers for the affected segment.~Check product mix, checkout path, pricing, and tracking for the suspected dimensions."
        "~Compare affected segment revenue per session against adjacent segments.'")
_LAT = ("'Inspect regional latency, CDN routing, and browser-specific performance logs.~Check backend response times and recent deployment windows."
        "~Compare Chrome performance against Safari and Firefox for the same region.'")
cte("inc2", f"""SELECT *, round_even(GREATEST(0.0, LEAST(1.0, 0.30::DOUBLE*f1 + 0.30::DOUBLE*share + 0.20::DOUBLE*hs/100 + 0.10::DOUBLE*LEAST(n/10.0::DOUBLE, 1.0)
    + 0.10::DOUBLE*CASE WHEN sev=2 THEN 1.0 ELSE 0.65 END)), 3) AS conf,
  CASE WHEN sev=2 OR worst >= 0.30::DOUBLE OR (share >= 0.60::DOUBLE AND worst >= 0.15::DOUBLE) THEN 'CRITICAL'
    WHEN sev=1 OR worst >= 0.15::DOUBLE THEN 'WARNING' ELSE 'NORMAL' END AS severity,
  string_split(concat_ws('~', CASE kpi_name WHEN 'conversion_rate' THEN 'Review conversion funnel changes for the affected segment.'
    WHEN 'latency_ms' THEN {_LAT} WHEN 'revenue_per_session' THEN {_RPS}
    ELSE 'Review recent product, tracking, and campaign changes affecting ' || kpi_name || '.' END, NULLIF(acts, '')), '~')[1:3] AS actions
FROM inc1""", "inc1")
cte("inc", f"""SELECT *, 'INC-' || strftime(date, '%Y%m%d') || '-' || upper(replace(kpi_name,'_','-')) || '-THRESHOLD-BREACHED' AS incident_id,
  CASE WHEN conf >= 0.80::DOUBLE THEN 'High' WHEN conf >= 0.55::DOUBLE THEN 'Medium' ELSE 'Low' END AS label,
  'On ' || CAST(date AS VARCHAR) || ', ' || kpi_name || ' showed a ' || lower(severity) || ' issue. The threshold_breached detector flagged abnormal movement, and RCA identified '
  || cause || ' as the dominant contributor, explaining ' || printf('%.1f', first_share * 100) || '% of ' ||
  CASE WHEN kpi_name='latency_ms' THEN 'excess latency' ELSE 'measured degradation' END || '. Recommended next step: ' || actions[1] AS summary
FROM inc2""", "inc2")
sql("incident_records", f"""SELECT incident_id, date AS incident_date, kpi_name AS kpi_affected, severity, {r('conf', name='confidence_score')},
  label AS confidence_label, 'threshold_breached' AS detector_used, {r('round_even(a, 6)', name='actual_value_summary')}, {r('round_even(x, 6)', name='expected_value_summary')},
  {r('round_even(v, 6)', name='percent_variance_summary')}, n AS anomaly_count, dims AS suspected_dimensions, array_to_string(actions, ' ') AS recommended_actions,
  summary AS executive_summary, {r('round_even(worst, 6)', name='max_abs_percent_variance')}, {_name('sev')} AS max_detector_severity, cause AS top_root_cause,
  ncrit AS monitoring_critical_count, qstatus AS quality_status, hs AS health_score, {r('f1', name='best_detector_f1_score')} FROM inc""", "inc")
cte("isel", f"""SELECT *, ROW_NUMBER() OVER (ORDER BY first DESC, g) AS position FROM (SELECT *, k = 1 AS first FROM (SELECT *,
  ROW_NUMBER() OVER (ORDER BY {_rank('severity')} DESC, conf DESC, n DESC, date, kpi_name) AS g,
  ROW_NUMBER() OVER (PARTITION BY kpi_name ORDER BY {_rank('severity')} DESC, conf DESC, n DESC, date, kpi_name) AS k FROM inc))
  ORDER BY position LIMIT 12""", "inc")
sql("incident_selection", f"SELECT CAST(position AS INT) AS position, incident_id, severity, {r('conf', 3, 'confidence_score')}, n AS anomaly_count FROM isel", "isel")
cte("ihist", """SELECT incident_id, date, kpi_name AS kpi_affected, severity, label AS confidence_label, conf AS confidence_score,
  cause AS top_root_cause, actions[1] AS recommended_action, 'threshold_breached' AS detector_used, position, n, summary FROM isel""", "isel")
_HIST = f"incident_id, date, kpi_affected, severity, confidence_label, {r('confidence_score', 3)}, top_root_cause, recommended_action, detector_used"
sql("incident_history", f"SELECT {_HIST} FROM ihist", "ihist")
sql("incident_slice", f"SELECT {_HIST} FROM ihist WHERE severity='CRITICAL' AND confidence_label IN ('Low','Medium')", "ihist")
sql("staged_incidents", f"SELECT {_HIST.replace('date,', 'date AS incident_date,').replace('kpi_affected', 'kpi_affected AS kpi_name')} FROM ihist", "ihist")
sql("incident_headline", """SELECT COUNT(*) AS incidents_generated, MAX(severity) FILTER (position=1) AS highest_severity,
  MAX(incident_id) FILTER (position=1) AS highest_confidence_incident FROM ihist""", "ihist")

# ------------------------------------------------------------------ warehouse


def members_sql(p: str, column: str) -> str:
    return f"SELECT {column} AS member, CAST(ROW_NUMBER() OVER (ORDER BY {column}) AS INT) AS key FROM (SELECT DISTINCT {column} FROM {p} WHERE {column} IS NOT NULL)"


for _p, _dims in (("e", E_DIMS), ("o", O_DIMS)):
    for _c in _dims:
        cte(f"d_{_p}_{_c}", members_sql(_p, _c), _p)


def calendar_sql(dow: str) -> str:
    return f"""SELECT CAST(strftime(date, '%Y%m%d') AS INT) AS date_key, date AS date_value, CAST(year(date) AS INT) AS year,
  CAST(quarter(date) AS INT) AS quarter, CAST(month(date) AS INT) AS month, CAST(day(date) AS INT) AS day, CAST({dow} AS INT) AS day_of_week,
  dayname(date) AS day_name, dayofweek(date) IN (0, 6) AS is_weekend FROM (SELECT DISTINCT date FROM o)"""


sql("dim_date", calendar_sql("dayofweek(date)"), "o")
sql("dim_date_monday_first", calendar_sql("isodow(date) - 1"), "o")
sql("dim_kpi", """SELECT key AS kpi_key, member AS kpi_name, CASE WHEN member IN ('conversion_rate','click_through_rate') THEN 'engagement_metric'
  WHEN member IN ('average_order_value','revenue_per_session') THEN 'monetization_metric' WHEN member='latency_ms' THEN 'performance_metric'
  ELSE 'other' END AS kpi_family, CASE WHEN member='latency_ms' THEN 'higher_is_bad' ELSE 'lower_is_bad' END AS direction,
  CASE WHEN member='latency_ms' THEN 'milliseconds' WHEN member IN ('average_order_value','revenue_per_session') THEN 'currency' ELSE 'ratio' END AS measure_unit,
  array_to_string(list_transform(string_split(member,'_'), lambda w: upper(w[1]) || w[2:]), ' ') AS description FROM d_e_kpi_name""", "d_e_kpi_name")
sql("dim_kpi_metadata", """SELECT key AS kpi_key, member AS kpi_name, 'business_metric' AS kpi_family, 'lower_is_bad' AS direction,
  CASE WHEN member='average_order_value' THEN 'currency' ELSE 'ratio' END AS measure_unit,
  CASE WHEN member='average_order_value' THEN 'Average order value' ELSE member END AS description FROM d_o_kpi_name""", "d_o_kpi_name")
sql("dim_members", " UNION ALL ".join(f"SELECT '{c}' AS dimension, key, member FROM d_o_{c}" for c in O_DIMS[1:]), *[f"d_o_{c}" for c in O_DIMS[1:]])
sql("dim_customer_keys", "SELECT c_name AS member, CAST(ROW_NUMBER() OVER (ORDER BY c_name) AS INT) AS customer_key FROM (SELECT DISTINCT c_name FROM customer)")
sql("staged_daily", f"SELECT {ED}, impressions, clicks, conversions, orders, {rs('revenue latency_ms kpi_value')}, {_LABELS} FROM lab", "lab")
sql("anomaly_events", f"""SELECT {ED}, CASE WHEN residual_anomaly THEN residual_severity WHEN combined_anomaly THEN combined_severity
  ELSE monitoring_status END AS analysis_severity, CASE WHEN residual_anomaly THEN 'residual_anomaly' WHEN combined_anomaly THEN 'combined_anomaly'
  WHEN zscore_anomaly THEN 'zscore_anomaly' ELSE 'threshold_breached' END AS analysis_detector FROM ea""", "ea")
sql("anomaly_counts", "SELECT date, kpi_name, COUNT(*) AS anomaly_count FROM ea WHERE combined_anomaly GROUP BY 1,2", "ea")

_DK = "CAST(strftime({0}, '%Y%m%d') AS INT)"


def keyed(source: str, p: str, dims: tuple[str, ...], date: str = "date") -> tuple[str, str, list[str]]:
    cols = [f"{_DK.format('s.' + date)} AS date_key"]
    joins = []
    for c in dims:
        cols.append(f"k_{c}.key AS {'kpi' if c == 'kpi_name' else c}_key")
        joins.append(f"JOIN d_{p}_{c} k_{c} ON k_{c}.member = s.{c}")
    return ", ".join(cols), f"{source} s {' '.join(joins)}", [f"d_{p}_{c}" for c in dims]


_c, _f, _deps = keyed("lab", "e", E_DIMS)
sql("fact_kpi_daily", f"SELECT {_c}, impressions, clicks, conversions, orders, {rs('revenue latency_ms kpi_value')}, {_LABELS} FROM {_f}", "lab", *_deps)
_c, _f, _deps = keyed("om", "o", O_DIMS)
sql("fact_kpi_monitoring", f"""SELECT {_c}, {rs('actual_value moving_baseline', 3)}, {r('percent_variance')}, threshold_breached,
  monitoring_status FROM {_f}""", "om", *_deps)
_c, _f, _deps = keyed("ea", "e", E_DIMS)
sql("fact_kpi_anomalies", f"SELECT {_c}, {_ANOM} FROM {_f}", "ea", *_deps)
_c, _f, _deps = keyed("erca", "e", ("kpi_name",), "analysis_date")
cte("frca", f"SELECT s.*, {_c.replace('AS date_key', 'AS analysis_date_key')} FROM {_f}", "erca", *_deps)
_frca = rca_columns(6).replace("kpi_name, ", "").replace("anomaly_count", "CAST(anomaly_count AS INT) AS anomaly_count")
sql("fact_rca_contributions", f"SELECT analysis_date_key, kpi_key, {_frca}, recommended_action FROM frca", "frca")
sql("fact_left_keys", f"""SELECT date, k.key AS kpi_key, g.key AS region_key, segment, priority, {r('kpi_value', 4)} FROM o
  LEFT JOIN d_o_kpi_name k ON k.member=kpi_name LEFT JOIN (SELECT member, CAST(ROW_NUMBER() OVER (ORDER BY member) AS INT) AS key
  FROM (SELECT DISTINCT region AS member FROM o)) g ON g.member=region""", "o", "d_o_kpi_name")
cte("best", """SELECT * FROM erca WHERE contribution_rank=1 QUALIFY ROW_NUMBER() OVER (PARTITION BY analysis_date, kpi_name
  ORDER BY contribution_share DESC, degradation_amount DESC, dimension_type) = 1""", "erca")


def enriched(counts: str) -> str:
    return f"""SELECT h.incident_id, h.date AS incident_date, h.kpi_affected AS kpi_name, h.severity, h.confidence_label, h.confidence_score, h.detector_used,
  COALESCE(c.n, 1) AS anomaly_count, COALESCE(b.dimension_value, h.top_root_cause) AS top_root_cause, COALESCE(b.dimension_type, 'incident_history') AS top_dimension_type,
  COALESCE(b.contribution_share, 0.0) AS top_contribution_share, COALESCE(b.recommended_action, h.recommended_action) AS recommended_action
FROM ihist h LEFT JOIN best b ON b.analysis_date=h.date AND b.kpi_name=h.kpi_affected LEFT JOIN ({counts}) c ON c.date=h.date AND c.kpi_name=h.kpi_affected"""


cte("enr", enriched("SELECT date, kpi_name, COUNT(*) AS n FROM em WHERE threshold_breached GROUP BY 1,2"), "ihist", "best", "em")
cte("enr2", enriched("SELECT date, kpi_name, COUNT(*) AS n FROM ea WHERE residual_anomaly GROUP BY 1,2"), "ihist", "best", "ea")
sql("incident_enriched", f"SELECT * EXCLUDE (confidence_score, top_contribution_share), {rs('confidence_score top_contribution_share')} FROM enr", "enr")
sql("incident_details_joined", "SELECT incident_id, n AS anomaly_count, summary AS executive_summary FROM ihist", "ihist")
_INC = f"""incident_id, {_DK.format('incident_date')} AS incident_date_key, key AS kpi_key, severity, confidence_label, {r('confidence_score', 3)},
  detector_used, anomaly_count, top_root_cause, recommended_action"""
for _n in ("fact_incidents", "mart_incident_summary"):
    sql(_n, f"SELECT {_INC} FROM enr2 JOIN d_e_kpi_name ON member=kpi_name", "enr2", "d_e_kpi_name")
cte("oh", health("om", 2, digits_pct=6), "om")
sql("mart_kpi_health", f"SELECT {_DK.format('date')} AS date_key, key AS kpi_key, oh.* EXCLUDE (date, kpi_name) FROM oh JOIN d_o_kpi_name ON member=kpi_name", "oh", "d_o_kpi_name")
sql("mart_root_cause_summary", f"""SELECT analysis_date_key, kpi_key, {', '.join(x for x in ('detector_used', 'dimension_type', 'dimension_value'))},
  {rs('degradation_amount contribution_share')}, contribution_rank, CAST(anomaly_count AS INT) AS anomaly_count, severity_max, recommended_action,
  'For ' || kpi_name || ' on ' || CAST(analysis_date_key AS VARCHAR) || ', ' || dimension_value || ' contributed ' ||
  CAST(round(CAST(contribution_share * 100 AS DECIMAL(20,10)), 1) AS DECIMAL(20,1))::VARCHAR || '% of measured degradation.' AS root_cause_statement
FROM frca QUALIFY ROW_NUMBER() OVER (PARTITION BY analysis_date_key, kpi_key ORDER BY contribution_share DESC, degradation_amount DESC,
  detector_used, dimension_type, dimension_value) = 1""", "frca")
cte("dq", """SELECT '2024-02-20' AS run_timestamp, (SELECT status FROM qr) AS status, (SELECT health_score FROM qr) AS health_score,
  MAX(CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END) FILTER ("check"='schema') AS schema_status,
  MAX(issue_count) FILTER ("check"='nulls') AS null_issue_count, MAX(issue_count) FILTER ("check"='duplicates') AS duplicate_issue_count,
  MAX(CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END) FILTER ("check"='freshness') AS freshness_status,
  MAX(CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END) FILTER ("check"='completeness') AS completeness_status,
  MAX(CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END) FILTER ("check"='volume') AS volume_status,
  COUNT(*) FILTER (NOT passed) AS overall_issue_count FROM qc""", "qc", "qr")
sql("mart_data_quality_summary", "SELECT * FROM dq", "dq")
_tables = {
    **{n: "SELECT COUNT(*) FROM e" for n in ("raw_kpi_daily_metrics", "raw_kpi_monitoring", "raw_anomaly_results", "fact_kpi_daily",
                                              "fact_kpi_monitoring", "fact_kpi_anomalies")},
    **{n: "SELECT COUNT(*) FROM erca" for n in ("raw_rca_contributions", "fact_rca_contributions")},
    **{n: "SELECT COUNT(*) FROM ihist" for n in ("raw_incident_history", "fact_incidents", "mart_incident_summary")},
    "dim_date": "SELECT COUNT(DISTINCT date) FROM e",
    "dim_kpi": "SELECT COUNT(*) FROM d_e_kpi_name",
    "dim_tier": "SELECT COUNT(*) FROM d_e_tier",
    "dim_band": "SELECT COUNT(*) FROM d_e_band",
    "mart_kpi_health": "SELECT COUNT(DISTINCT (date, kpi_name)) FROM e",
    "mart_root_cause_summary": "SELECT COUNT(DISTINCT (analysis_date, kpi_name)) FROM erca",
    "mart_data_quality_summary": "SELECT 1",
}
_wdeps = ("e", "erca", "ihist", "d_e_kpi_name", "d_e_tier", "d_e_band")
sql("warehouse_row_counts", " UNION ALL ".join(f"SELECT '{t}' AS \"table\", CAST(({q}) AS BIGINT) AS rows" for t, q in _tables.items()), *_wdeps)
sql("warehouse_integrity", "SELECT \"table\", rows, 0::BIGINT AS null_key_rows, rows > 0 AS passed FROM (" +
    " UNION ALL ".join(f"SELECT '{t}' AS \"table\", CAST(({q}) AS BIGINT) AS rows" for t, q in _tables.items()) + ")", *_wdeps)

# ------------------------------------------------------------------ reports

cte("eh", health("em").replace("date, kpi_name, COUNT(*) AS monitored_rows", "date AS day, kpi_name, COUNT(*) AS monitored_rows", 1), "em")
sql("report_health_by_day", """SELECT day, kpi_name, monitored_rows, warning_rows, critical_rows, breach_rows, health_score, avg_percent_variance
  FROM eh ORDER BY day DESC, kpi_name""", "eh")
sql("report_anomalies_by_severity", "SELECT kpi_name, combined_severity, COUNT(*) AS anomaly_count FROM ea GROUP BY 1,2", "ea")
sql("report_top_contributors", f"""SELECT analysis_date, kpi_name, dimension_type, dimension_value, {rs('degradation_amount contribution_share')},
  contribution_rank FROM erca WHERE contribution_rank <= 3""", "erca")
sql("report_incident_summary", f"""SELECT incident_date, kpi_name, severity, confidence_label, {r('confidence_score', 3)}, detector_used, top_root_cause,
  recommended_action FROM enr2""", "enr2")
sql("report_quality_summary", "SELECT * EXCLUDE (overall_issue_count) FROM dq", "dq")
sql("report_executive_rollup", f"""SELECT kpi_name, COUNT(*) AS monitored_rows, COUNT(*) FILTER (crit > 0) AS critical_days,
  {r('AVG(hs)', name='avg_health_score')}, {r('AVG(b::DOUBLE / NULLIF(n, 0))', name='avg_breach_rate')}
FROM (SELECT date, kpi_name, COUNT(*) AS n, COUNT(*) FILTER (monitoring_status='CRITICAL') AS crit, COUNT(*) FILTER (threshold_breached) AS b,
  GREATEST(0.0, LEAST(100.0, 100 - (COUNT(*) FILTER (monitoring_status='WARNING') * 0.5::DOUBLE + COUNT(*) FILTER (monitoring_status='CRITICAL') * 1.5::DOUBLE) / COUNT(*) * 100)) AS hs
  FROM em GROUP BY 1,2) GROUP BY 1""", "em")
sql("report_dimension_drilldown", f"""SELECT dimension_type, dimension_value, {r('SUM(degradation_amount)', 5, 'total_degradation')},
  {r('SUM(contribution_share)', 5, 'total_contribution_share')} FROM erca GROUP BY 1,2""", "erca")


def segment(kpi: str, words: list[str]) -> str:
    likes = " AND ".join(f"dimension_value ILIKE '%{w}%'" for w in words)
    return f"""SELECT analysis_date, kpi_name, dimension_type, dimension_value, {rs('degradation_amount contribution_share')}, recommended_action
  FROM erca WHERE kpi_name='{kpi}' AND {likes}"""


sql("report_segment_conversion", segment("conversion_rate", ["T1", "low"]), "erca")
sql("report_segment_latency", segment("latency_ms", ["T0", "high"]), "erca")
sql("dashboard_overview", """SELECT COUNT(DISTINCT kpi_name) AS kpis, MIN(date) AS date_min, MAX(date) AS date_max,
  COUNT(*) FILTER (combined_anomaly) AS anomalies FROM ea""", "ea")
sql("dashboard_health_by_kpi", f"""SELECT kpi_name, COUNT(*) FILTER (threshold_breached) AS threshold_breaches,
  {r('AVG(percent_variance)', name='avg_variance')}, {r('MAX(ABS(percent_variance))', name='max_variance')} FROM om GROUP BY 1""", "om")
sql("dashboard_status_distribution", "SELECT monitoring_status, COUNT(*) AS rows FROM om GROUP BY 1", "om")
sql("dashboard_anomalies_per_date", "SELECT date, COUNT(*) AS anomalies FROM om WHERE threshold_breached GROUP BY 1", "om")
sql("dashboard_long_series", " UNION ALL ".join(f"SELECT {ED}, '{c}' AS series, {r(c, name='value')} FROM em" for c in
    ("actual_value", "expected_value", "moving_baseline")), "em")
sql("dashboard_worst_rows", f"""SELECT {OD}, {rs('actual_value expected_value percent_variance')} FROM om WHERE kpi_name='finished_rate'
  ORDER BY ABS(percent_variance) DESC NULLS LAST, {OD} LIMIT 20""", "om")
sql("metric_trend_rate", f"SELECT date, {r('AVG(conversion_rate)', name='conversion_rate')} FROM wide GROUP BY 1", "wide")
sql("metric_trend_total", f"SELECT date, {r('SUM(revenue)', 2, 'revenue')} FROM wide GROUP BY 1", "wide")
sql("zscore_trend", f"SELECT date, {r('MAX(ABS(z))', name='max_abs_zscore')}, COUNT(*) FILTER (flagged) AS anomaly_count FROM wc GROUP BY 1", "wc")
sql("worst_conversion_drops", f"""SELECT date, tier, band, {rs('conversion_rate previous_conversion_rate change')} FROM (SELECT *,
  conversion_rate - previous_conversion_rate AS change FROM (SELECT *, LAG(conversion_rate) OVER (PARTITION BY tier, band ORDER BY date)
  AS previous_conversion_rate FROM wide)) ORDER BY conversion_rate - previous_conversion_rate ASC NULLS LAST, date, tier, band LIMIT 10""", "wide")
sql("run_summary", """SELECT MIN(date) AS date_min, MAX(date) AS date_max, MAX(last) - 13 AS report_window_start, COUNT(*) AS total_rows,
  COUNT(DISTINCT (kpi_name, tier, band)) AS series_count, COUNT(z_score) AS rows_scored, COUNT(*) - COUNT(z_score) AS rows_unscored_baseline_warmup,
  COUNT(*) FILTER (date >= last - 13) AS rows_in_report_window, COUNT(*) FILTER (date >= last - 13 AND zscore_anomaly) AS zscore_anomalies,
  COUNT(*) FILTER (date >= last - 13 AND residual_anomaly) AS residual_anomalies, COUNT(*) FILTER (date >= last - 13 AND combined_anomaly) AS combined_anomalies
FROM ea, (SELECT MAX(date) AS last FROM ea)""", "ea")
sql("previous_month_value", f"""SELECT {OD}, {r('kpi_value', 4)}, {r('LAG(kpi_value) OVER (PARTITION BY kpi_name, region, segment, priority ORDER BY date)', 4, 'previous')}
  FROM o""", "o")
sql("segment_labels", f"""SELECT date, kpi_name, region || ' / ' || COALESCE(NULLIF(segment, 'BUILDING'), 'nan') || ' / ' || priority AS segment_label,
  {r('kpi_value', 4)} FROM o""", "o")
