"""DuckDB oracle SQL for the profiling, drift, metrics and scoring queries."""

from __future__ import annotations

from fleetlens.operators.scoring import RISK_ACTIONS, RISK_LEVELS, RISK_MESSAGES
from fleetlens.plans.oracle_sql import LABELS_CTE, SERIES_CTE, rd

SPLIT_TS = "TIMESTAMP '2024-01-16 00:00:00'"
LI_SPLIT = "TIMESTAMP '1998-01-01 00:00:00'"
LI_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
EV_FEATURES = ["value", "k"]

SCORED_CTE = """,
scored AS (
  SELECT unit_id, cycle, ts, rul, failure_label, is_error AS label,
         value / (value + 20.0) AS score, CAST(rul AS DOUBLE) AS y_true, k AS y_pred
  FROM processed)"""


def with_processed(body: str, scored: bool = False) -> str:
    return f"WITH {SERIES_CTE}{LABELS_CTE}{SCORED_CTE if scored else ''}\n{body}"


# ── profiling ───────────────────────────────────────────────────────────────


def q_unit_lifetimes() -> str:
    return f"WITH {SERIES_CTE}\nSELECT unit_id, max(cycle) AS lifetime FROM series GROUP BY unit_id"


def q_lifetime_summary() -> str:
    return (
        f"WITH {SERIES_CTE},\nlives AS (SELECT unit_id, max(cycle) AS lifetime FROM series GROUP BY unit_id)\n"
        f"SELECT count(*) AS n_units, CAST(sum(lifetime) AS BIGINT) AS n_rows, {rd('avg(lifetime)')} AS mean_lifetime,\n"
        f"       min(lifetime) AS min_lifetime, max(lifetime) AS max_lifetime,\n"
        f"       {rd('quantile_cont(lifetime, 0.5)')} AS median_lifetime FROM lives"
    )


def q_sensor_profile() -> str:
    parts = [
        f"SELECT '{c}' AS sensor, {rd(f'avg({c})')} AS mean, {rd(f'stddev_samp({c})')} AS std, "
        f"{rd(f'min({c})')} AS min, {rd(f'max({c})')} AS max FROM lineitem"
        for c in LI_FEATURES
    ]
    return "\nUNION ALL\n".join(parts)


def q_label_balance() -> str:
    return with_processed(
        f"SELECT CASE WHEN ts < {SPLIT_TS} THEN 'train' ELSE 'test' END AS split, count(*) AS total_rows,\n"
        f"       count(*) FILTER (WHERE failure_label = 1) AS n_failure, count(*) FILTER (WHERE failure_label = 0) AS n_healthy,\n"
        f"       {rd('avg(CAST(failure_label AS DOUBLE)) * 100.0')} AS failure_rate_pct\n"
        f"FROM processed GROUP BY 1"
    )


def q_data_checks() -> str:
    rules = [
        ("missing_raw_values", "sum(CAST(value IS NULL AS BIGINT) + CAST(k IS NULL AS BIGINT))"),
        ("infinite_values", "sum(CASE WHEN isinf(value) THEN 1 ELSE 0 END + CASE WHEN isinf(k) THEN 1 ELSE 0 END)"),
        ("missing_unit_id", "count(*) FILTER (WHERE unit_id IS NULL)"),
        ("label_not_binary", "count(*) FILTER (WHERE failure_label NOT IN (0, 1) OR failure_label IS NULL)"),
        ("rul_out_of_range", "count(*) FILTER (WHERE rul < 0 OR rul > 125)"),
        (
            "single_class",
            "CAST(count(*) FILTER (WHERE failure_label = 1) = 0 AS BIGINT) + CAST(count(*) FILTER (WHERE failure_label = 0) = 0 AS BIGINT)",
        ),
    ]
    parts = [f"SELECT '{n}' AS check_name, CAST({e} AS BIGINT) AS violations FROM processed" for n, e in rules]
    parts.append(
        "SELECT 'first_cycle_not_1', CAST(count(*) FILTER (WHERE m <> 1) AS BIGINT) FROM "
        "(SELECT unit_id, min(cycle) AS m FROM processed GROUP BY unit_id)"
    )
    parts.append("SELECT 'required_columns_missing', CAST(0 AS BIGINT)")
    return with_processed("\nUNION ALL\n".join(parts))


# ── drift ───────────────────────────────────────────────────────────────────


def _li_long() -> str:
    parts = [
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, l_shipdate < {LI_SPLIT} AS is_base FROM lineitem "
        f"WHERE {c} IS NOT NULL AND NOT isnan({c}) AND l_shipdate IS NOT NULL"
        for c in LI_FEATURES
    ]
    return "long AS (\n" + "\nUNION ALL\n".join(parts) + ")"


def _ev_long() -> str:
    parts = [
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, ts < {SPLIT_TS} AS is_base FROM series "
        f"WHERE {c} IS NOT NULL AND NOT isnan({c}) AND ts IS NOT NULL"
        for c in EV_FEATURES
    ]
    return "long AS (\n" + "\nUNION ALL\n".join(parts) + ")"


BOTH = """,
cnt AS (SELECT feature, count(*) FILTER (WHERE is_base) AS n_base, count(*) FILTER (WHERE NOT is_base) AS n_cur
        FROM long GROUP BY feature
        HAVING count(*) FILTER (WHERE is_base) > 0 AND count(*) FILTER (WHERE NOT is_base) >= 10),
both_ AS (SELECT feature, value, is_base FROM long WHERE feature IN (SELECT feature FROM cnt))"""


def _psi_ctes() -> str:
    probs = ", ".join(f"{i / 10!r}" for i in range(11))
    cnts = []
    for k in range(1, 10):
        cnts.append(f"count(*) FILTER (WHERE is_base AND value < e[{k + 1}]) AS b{k}")
        cnts.append(f"count(*) FILTER (WHERE NOT is_base AND value < e[{k + 1}]) AS c{k}")
    terms = []
    for k in range(10):
        def cnt(side):
            hi = ("n_base" if side == "b" else "n_cur") if k == 9 else f"{side}{k + 1}"
            lo = "0" if k == 0 else f"{side}{k}"
            return f"({hi} - {lo})"

        pb = f"({cnt('b')} / greatest(n_base, 1))"
        pc = f"({cnt('c')} / greatest(n_cur, 1))"
        pb = f"(CASE WHEN {pb} = 0 THEN 1e-6 ELSE {pb} END)"
        pc = f"(CASE WHEN {pc} = 0 THEN 1e-6 ELSE {pc} END)"
        terms.append(f"({pc} - {pb}) * ln({pc} / {pb})")
    return (
        f",\nedges AS (SELECT feature, quantile_cont(value, [{probs}]) AS e FROM both_ GROUP BY feature),\n"
        f"bins AS (SELECT feature, {', '.join(cnts)} FROM both_ JOIN edges USING (feature) GROUP BY feature),\n"
        f"psi_t AS (SELECT feature, {' + '.join(terms)} AS psi FROM bins JOIN cnt USING (feature))"
    )


def _ks_ctes() -> str:
    series = "list_sum(list_transform(range(1, 101), lambda j: (CASE WHEN j % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * j * j * lam * lam)))"
    return (
        ",\ndist AS (SELECT feature, value, count(*) FILTER (WHERE is_base) AS cb, count(*) FILTER (WHERE NOT is_base) AS cc\n"
        "         FROM both_ GROUP BY feature, value),\n"
        "run AS (SELECT feature, value,\n"
        "        sum(cb) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) / sum(cb) OVER (PARTITION BY feature) AS f1,\n"
        "        sum(cc) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) / sum(cc) OVER (PARTITION BY feature) AS f2\n"
        "        FROM dist),\n"
        "ks_s AS (SELECT feature, max(abs(f1 - f2)) AS ks_stat FROM run GROUP BY feature),\n"
        "ks_l AS (SELECT feature, ks_stat, ks_stat * sqrt(CAST(n_base * n_cur AS DOUBLE) / CAST(n_base + n_cur AS DOUBLE)) AS lam\n"
        "         FROM ks_s JOIN cnt USING (feature)),\n"
        f"ks_t AS (SELECT feature, ks_stat, CASE WHEN lam < 0.05 THEN 1.0 ELSE least(greatest(2.0 * {series}, 0.0), 1.0) END AS ks_pvalue FROM ks_l)"
    )


def _report_cte() -> str:
    return (
        ",\nreport AS (SELECT feature, round(psi, 5) + 0.0 AS psi, psi > 0.2 AS psi_drift, round(ks_stat, 5) + 0.0 AS ks_stat,\n"
        "        round(ks_pvalue, 5) + 0.0 AS ks_pvalue, ks_pvalue < 0.05 AS ks_drift, (psi > 0.2 OR ks_pvalue < 0.05) AS drifted,\n"
        "        CASE WHEN psi < 0.1 THEN 'none' WHEN psi <= 0.2 THEN 'moderate' ELSE 'significant' END AS psi_band\n"
        "        FROM psi_t JOIN ks_t USING (feature))"
    )


def _drift_with(long_cte: str, series_needed: bool = False) -> str:
    head = f"WITH {SERIES_CTE},\n" if series_needed else "WITH "
    return head + long_cte + BOTH + _psi_ctes() + _ks_ctes() + _report_cte()


SUMMARY_SELECT = (
    "SELECT count(*) AS total_features, count(*) FILTER (WHERE drifted) AS drifted_features,\n"
    "       count(*) FILTER (WHERE psi_drift) AS psi_drifted, count(*) FILTER (WHERE ks_drift) AS ks_drifted,\n"
    "       round(COALESCE(avg(psi), 0.0), 5) + 0.0 AS avg_psi,\n"
    "       CASE WHEN count(*) FILTER (WHERE drifted) / greatest(count(*), 1) > 0.5 THEN 'CRITICAL — Retrain required'\n"
    "            WHEN count(*) FILTER (WHERE drifted) / greatest(count(*), 1) > 0.2 THEN 'WARNING — Investigate drift'\n"
    "            WHEN count(*) FILTER (WHERE drifted) > 0 THEN 'WATCH — Minor drift detected' ELSE 'OK' END AS alert_level"
)

REPORT_COLS = (
    f"feature, {rd('psi')} AS psi, psi_drift, {rd('ks_stat')} AS ks_stat, {rd('ks_pvalue')} AS ks_pvalue, ks_drift, drifted, psi_band"
)


def q_drift_baseline() -> str:
    return (
        f"WITH {_li_long()}\n"
        f"SELECT feature, count(*) AS n, {rd('avg(value)')} AS mean, {rd('stddev_pop(value)')} AS std,\n"
        f"       {rd('quantile_cont(value, 0.25)')} AS q25, {rd('quantile_cont(value, 0.75)')} AS q75\n"
        f"FROM long WHERE is_base GROUP BY feature"
    )


def q_psi() -> str:
    return _drift_with(_li_long()) + f"\nSELECT feature, {rd('psi')} AS psi FROM psi_t"


def q_ks_stat() -> str:
    return _drift_with(_li_long()) + f"\nSELECT feature, {rd('ks_stat')} AS ks_stat FROM ks_t"


def q_ks_pvalue() -> str:
    return _drift_with(_li_long()) + f"\nSELECT feature, {rd('ks_stat')} AS ks_stat, {rd('ks_pvalue')} AS ks_pvalue FROM ks_t"


def q_drift_report() -> str:
    return _drift_with(_li_long()) + f"\nSELECT {REPORT_COLS} FROM report"


def q_drift_summary() -> str:
    return _drift_with(_li_long()) + f"\n{SUMMARY_SELECT} FROM report"


def q_drift_topk() -> str:
    return _drift_with(_li_long()) + f"\nSELECT {REPORT_COLS} FROM report ORDER BY psi DESC, feature LIMIT 5"


def q_drift_events() -> str:
    return _drift_with(_ev_long(), series_needed=True) + f"\nSELECT {REPORT_COLS} FROM report"


def q_stream_drift() -> str:
    """The report of each of two micro-batches against the same baseline."""
    middle = "TIMESTAMP '2024-01-23 00:00:00'"
    parts = []
    for i, cond in enumerate((f"ts < {middle}", f"(ts < {SPLIT_TS} OR ts >= {middle})")):
        body = _drift_with(_ev_long().replace("AND ts IS NOT NULL", f"AND {cond}"), series_needed=True)
        parts.append(f"SELECT {i} AS batch_id, r.* FROM ({body}\nSELECT {REPORT_COLS} FROM report) r")
    return "\nUNION ALL\n".join(parts)


def q_drift_check_details() -> str:
    """Every request of at least 30 readings against all readings before the split."""
    requests = (
        "late AS (SELECT user_id * 1048576 + (place - 1) // 100 AS request_id, value, k FROM (\n"
        "  SELECT unit_id AS user_id, value, k, row_number() OVER (PARTITION BY unit_id ORDER BY ts, event_id) AS place\n"
        f"  FROM series WHERE ts >= {SPLIT_TS} AND unit_id IS NOT NULL) WHERE value IS NOT NULL AND k IS NOT NULL),\n"
        "ok AS (SELECT request_id FROM late GROUP BY 1 HAVING count(*) >= 30),\n"
        "base AS (" + " UNION ALL ".join(f"SELECT '{c}' AS f, {c} AS value FROM series WHERE ts < {SPLIT_TS} AND {c} IS NOT NULL" for c in EV_FEATURES) + "),\n"
        "mine AS (" + " UNION ALL ".join(f"SELECT request_id, '{c}' AS f, {c} AS value FROM late JOIN ok USING (request_id)" for c in EV_FEATURES) + "),\n"
        "long AS (SELECT request_id || '|' || f AS feature, value, true AS is_base FROM ok CROSS JOIN base\n"
        "         UNION ALL SELECT request_id || '|' || f, value, false FROM mine)"
    )
    return (
        _drift_with(requests, series_needed=True)
        + ",\nparts AS (SELECT CAST(split_part(feature, '|', 1) AS BIGINT) AS request_id, split_part(feature, '|', 2) AS f, psi, ks_pvalue, drifted FROM report),\n"
        + "levels AS (SELECT request_id, lv.* FROM (SELECT DISTINCT request_id FROM parts) q, LATERAL ("
        + SUMMARY_SELECT
        + " FROM (SELECT psi, drifted, false AS psi_drift, false AS ks_drift FROM parts p WHERE p.request_id = q.request_id)) lv)\n"
        + f"SELECT request_id, alert_level, total_features, drifted_features, {rd('avg_psi')} AS avg_psi, f AS feature, {rd('psi')} AS psi, {rd('ks_pvalue')} AS ks_pvalue, drifted\n"
        + "FROM parts JOIN levels USING (request_id)"
    )


def q_ks_exact() -> str:
    """The lattice walk of the exact two-sample test, one step of all tests at a time."""
    return (
        f"WITH RECURSIVE {SERIES_CTE},\n"
        f"long AS (SELECT CAST(unit_id AS VARCHAR) AS feature, value, ts < {SPLIT_TS} AS is_base FROM series WHERE value IS NOT NULL)"
        + BOTH
        + _ks_ctes()
        + ",\ntests AS (SELECT feature, ks_stat, n_base, n_cur, round(ks_stat * lcm(n_base, n_cur)) AS h, lcm(n_base, n_cur) AS whole FROM ks_s JOIN cnt USING (feature)),\n"
        "walk AS (\n"
        "  SELECT feature, 0::BIGINT AS i, 0::BIGINT AS j, 1.0::DOUBLE AS u FROM tests\n"
        "  UNION ALL\n"
        "  SELECT feature, i, j, sum(u) AS u FROM (\n"
        "    SELECT w.feature, w.i + s.di AS i, w.j + s.dj AS j, n_base, n_cur, h, whole,\n"
        "           w.u * (CASE WHEN s.di = 1 THEN n_base - w.i ELSE n_cur - w.j END) / (n_base + n_cur - w.i - w.j) AS u\n"
        "    FROM walk w JOIN tests t ON t.feature = w.feature CROSS JOIN (VALUES (1, 0), (0, 1)) AS s(di, dj)\n"
        "    WHERE w.i + s.di <= n_base AND w.j + s.dj <= n_cur)\n"
        "  WHERE abs(i * (whole // n_base) - j * (whole // n_cur)) < h GROUP BY feature, i, j),\n"
        "stay AS (SELECT w.feature, w.u FROM walk w JOIN tests t ON t.feature = w.feature AND w.i = t.n_base AND w.j = t.n_cur)\n"
        f"SELECT feature, {rd('ks_stat')} AS ks_stat, CAST(n_base AS BIGINT) AS n_base, CAST(n_cur AS BIGINT) AS n_cur, {rd('CASE WHEN h <= 0 THEN 1.0 ELSE 1.0 - COALESCE(u, 0.0) END')} AS ks_pvalue\n"
        "FROM tests LEFT JOIN stay USING (feature)"
    )


def q_drift_slices() -> str:
    parts = []
    for m in ("1998-01", "1998-05", "1998-09"):
        month = _li_long().replace("AND l_shipdate IS NOT NULL", f"AND (l_shipdate < {LI_SPLIT} OR strftime(l_shipdate, '%Y-%m') = '{m}')")
        parts.append(f"SELECT * FROM ({_drift_with(month)}\n" + SUMMARY_SELECT.replace("SELECT ", f"SELECT '{m}' AS scenario, ", 1) + " FROM report)")
    return "\nUNION ALL\n".join(parts)


def q_drift_scenarios() -> str:
    normal = _drift_with(_li_long()) + "\n" + SUMMARY_SELECT.replace("SELECT ", "SELECT 'normal' AS scenario, ", 1) + " FROM report"
    shifted_long = (
        "raw AS (\n"
        + "\nUNION ALL\n".join(
            f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, l_shipdate < {LI_SPLIT} AS is_base FROM lineitem "
            f"WHERE {c} IS NOT NULL AND NOT isnan({c}) AND l_shipdate IS NOT NULL"
            for c in LI_FEATURES
        )
        + "),\nlong AS (SELECT feature, CASE WHEN is_base THEN value ELSE value + 2.5 * sd END AS value, is_base\n"
        "         FROM raw JOIN (SELECT feature, stddev_samp(value) AS sd FROM raw WHERE NOT is_base GROUP BY feature) USING (feature))"
    )
    shifted = _drift_with(shifted_long) + "\n" + SUMMARY_SELECT.replace("SELECT ", "SELECT 'shifted' AS scenario, ", 1) + " FROM report"
    return f"SELECT * FROM ({normal})\nUNION ALL\nSELECT * FROM ({shifted})"


# ── metrics ─────────────────────────────────────────────────────────────────

CONF = (
    "count(*) FILTER (WHERE label <> 1 AND score < 0.5) AS tn, count(*) FILTER (WHERE label <> 1 AND score >= 0.5) AS fp,\n"
    "count(*) FILTER (WHERE label = 1 AND score < 0.5) AS fn, count(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp,\n"
    "count(*) AS total"
)


def q_confusion() -> str:
    return with_processed(f"SELECT {CONF} FROM scored", scored=True)


def _z(num: str, den: str) -> str:
    return f"COALESCE(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0), 0.0)"


def q_class_metrics() -> str:
    tp, tn, fp, fn, n = "tp", "tn", "fp", "fn", "total"
    po = _z(f"({tp} + {tn})", n)
    pe = _z(f"(CAST({tp} + {fp} AS DOUBLE) * ({tp} + {fn}) + CAST({tn} + {fn} AS DOUBLE) * ({tn} + {fp}))", f"(CAST({n} AS DOUBLE) * {n})")
    body = (
        f"c AS (SELECT {CONF} FROM scored)\n"
        f"SELECT tn, fp, fn, tp, total, {rd(_z('(tp + tn)', 'total'))} AS accuracy,\n"
        f"  {rd(_z('tp', '(tp + fp)'))} AS precision, {rd(_z('tp', '(tp + fn)'))} AS recall,\n"
        f"  {rd(_z('2 * tp', '(2 * tp + fp + fn)'))} AS f1_score,\n"
        f"  {rd(_z('(CAST(tp AS DOUBLE) * tn - CAST(fp AS DOUBLE) * fn)', 'sqrt(CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn))'))} AS mcc,\n"
        f"  {rd(_z(f'({po} - {pe})', f'(1.0 - {pe})'))} AS cohen_kappa\n"
        f"FROM c"
    )
    return f"WITH {SERIES_CTE}{LABELS_CTE}{SCORED_CTE},\n{body}"


SCORE_COUNTS = """,
sc AS (SELECT CAST(score AS DOUBLE) AS s, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
       FROM scored GROUP BY 1)"""


def q_roc_auc() -> str:
    return (
        f"WITH {SERIES_CTE}{LABELS_CTE}{SCORED_CTE}{SCORE_COUNTS},\n"
        "run AS (SELECT s, pos, neg, sum(neg) OVER (ORDER BY s ROWS UNBOUNDED PRECEDING) - neg AS below FROM sc)\n"
        f"SELECT {rd('sum(CAST(pos AS DOUBLE) * (CAST(below AS DOUBLE) + CAST(neg AS DOUBLE) / 2.0)) / (CAST((SELECT sum(pos) FROM sc) AS DOUBLE) * (SELECT sum(neg) FROM sc))')} AS roc_auc FROM run"
    )


DESC_RUN = """,
run AS (SELECT s, pos, neg,
        sum(pos) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS cp,
        sum(neg) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS cn,
        sum(pos) OVER () AS tp_all, sum(neg) OVER () AS tn_all FROM sc)"""


def q_avg_precision() -> str:
    return (
        f"WITH {SERIES_CTE}{LABELS_CTE}{SCORED_CTE}{SCORE_COUNTS}{DESC_RUN}\n"
        f"SELECT {rd('sum(CASE WHEN pos > 0 THEN (CAST(pos AS DOUBLE) / CAST(tp_all AS DOUBLE)) * (CAST(cp AS DOUBLE) / CAST(cp + cn AS DOUBLE)) ELSE 0.0 END)')} AS avg_precision FROM run"
    )


def q_youden() -> str:
    return (
        f"WITH {SERIES_CTE}{LABELS_CTE}{SCORED_CTE}{SCORE_COUNTS}{DESC_RUN},\n"
        "j AS (SELECT s, CAST(cp AS DOUBLE) / tp_all - CAST(cn AS DOUBLE) / tn_all AS j FROM run)\n"
        f"SELECT {rd('s')} AS threshold, {rd('j')} AS youden_j FROM j ORDER BY j DESC, s DESC LIMIT 1"
    )


def q_business_cost() -> str:
    return with_processed(
        "SELECT fn, fp, CAST(fn * 100 + fp * 10 AS DOUBLE) AS total_cost, CAST((tn + fp) * 10 AS DOUBLE) AS baseline_cost,\n"
        "       CAST((tn + fp) * 10 - (fn * 100 + fp * 10) AS DOUBLE) AS estimated_savings,\n"
        f"       {rd(_z('((tn + fp) * 10 - (fn * 100 + fp * 10))', '((tn + fp) * 10)') + ' * 100.0')} AS savings_pct\n"
        f"FROM (SELECT {CONF} FROM scored)",
        scored=True,
    )


def q_reg_metrics() -> str:
    d = "(y_pred - y_true)"
    return with_processed(
        f"SELECT count(*) AS n, {rd(f'sqrt(avg({d} * {d}))')} AS rmse, {rd(f'avg(abs({d}))')} AS mae,\n"
        f"       {rd(f'avg(abs({d} / NULLIF(y_true, 0))) * 100.0')} AS mape,\n"
        f"       {rd(f'quantile_cont(abs({d}), 0.5)')} AS median_ae,\n"
        f"       {rd(f'1.0 - sum({d} * {d}) / (var_pop(y_true) * count(*))')} AS r2,\n"
        f"       {rd(f'1.0 - (1.0 - (1.0 - sum({d} * {d}) / (var_pop(y_true) * count(*)))) * (CAST(count(*) - 1 AS DOUBLE) / CAST(count(*) - 3 AS DOUBLE))')} AS adj_r2\n"
        f"FROM scored",
        scored=True,
    )


def q_rul_score() -> str:
    d = "(y_pred - y_true)"
    return with_processed(
        f"SELECT {rd(f'sum(CASE WHEN {d} < 0 THEN exp(-{d} / 13.0) - 1 ELSE exp({d} / 10.0) - 1 END)')} AS rul_score FROM scored",
        scored=True,
    )


# ── scoring ─────────────────────────────────────────────────────────────────


def _level_case(p: str) -> str:
    return f"CASE WHEN {p} >= 0.75 THEN 'CRITICAL' WHEN {p} >= 0.5 THEN 'WARNING' WHEN {p} >= 0.25 THEN 'WATCH' ELSE 'HEALTHY' END"


def _message_case(lvl: str) -> str:
    whens = " ".join(f"WHEN {lvl} = '{n}' THEN '{RISK_MESSAGES[n]}'" for n in RISK_LEVELS)
    return f"CASE {whens} ELSE '{RISK_MESSAGES['HEALTHY']}' END"


PRED_CTE = """,
tail AS (SELECT s.* FROM scored s JOIN (SELECT unit_id, max(cycle) AS last FROM scored GROUP BY unit_id) e USING (unit_id)
         WHERE s.cycle > e.last - 10),
per AS (SELECT unit_id, avg(score) AS p, avg(y_pred) AS rul_estimate FROM tail GROUP BY unit_id),
pred AS (SELECT unit_id, p AS failure_probability, p >= 0.5 AS failure_predicted, LVL AS risk_level, rul_estimate,
                abs(p - 0.5) AS confidence_margin FROM per)"""


def _pred_cte() -> str:
    return PRED_CTE.replace("LVL", _level_case("p"))


def q_last_n_mean() -> str:
    return (
        f"WITH {SERIES_CTE}{LABELS_CTE}{SCORED_CTE}{_pred_cte()}\n"
        f"SELECT unit_id, {rd('failure_probability')} AS failure_probability, failure_predicted, risk_level,\n"
        f"       {rd('rul_estimate')} AS rul_estimate, {rd('confidence_margin')} AS confidence_margin,\n"
        f"       {_message_case('risk_level')} AS message FROM pred"
    )


def q_youden_decisions() -> str:
    pred = _pred_cte().replace("p >= 0.5 AS failure_predicted", "p >= (SELECT t FROM cut) AS failure_predicted").replace("abs(p - 0.5)", "abs(p - (SELECT t FROM cut))")
    cut = ",\nj AS (SELECT s, CAST(cp AS DOUBLE) / tp_all - CAST(cn AS DOUBLE) / tn_all AS j FROM run),\ncut AS (SELECT s AS t FROM j ORDER BY j DESC, s DESC LIMIT 1)"
    return (
        f"WITH {SERIES_CTE}{LABELS_CTE}{SCORED_CTE}{SCORE_COUNTS}{DESC_RUN}{cut}{pred}\n"
        f"SELECT unit_id, {rd('failure_probability')} AS failure_probability, failure_predicted, risk_level,\n"
        f"       {rd('rul_estimate')} AS rul_estimate, {rd('confidence_margin')} AS confidence_margin,\n"
        f"       {_message_case('risk_level')} AS message FROM pred"
    )


def q_batch_results() -> str:
    counts = ", ".join(f"count(*) FILTER (WHERE risk_level = '{n}') OVER b AS {n.lower()}_count" for n in RISK_LEVELS)
    return (
        f"WITH {SERIES_CTE}{LABELS_CTE}{SCORED_CTE}{_pred_cte()}\n"
        f"SELECT unit_id // 40 AS batch_id, count(*) OVER b AS total_engines, {counts},\n"
        f"       CAST(row_number() OVER (PARTITION BY unit_id // 40 ORDER BY unit_id) - 1 AS INTEGER) AS place, unit_id,\n"
        f"       {rd('failure_probability')} AS failure_probability, failure_predicted, risk_level,\n"
        f"       {rd('rul_estimate')} AS rul_estimate, {rd('confidence_margin')} AS confidence_margin,\n"
        f"       {_message_case('risk_level')} AS message FROM pred WINDOW b AS (PARTITION BY unit_id // 40)"
    )


def q_true_state() -> str:
    return with_processed(
        "SELECT unit_id, last_rul, CASE WHEN last_rul < 10 THEN 'CRITICAL' WHEN last_rul < 30 THEN 'WARNING'\n"
        "       WHEN last_rul < 80 THEN 'WATCH' ELSE 'HEALTHY' END AS true_state\n"
        "FROM (SELECT unit_id, arg_max(rul, cycle) AS last_rul FROM processed GROUP BY unit_id)"
    )


def q_fleet_summary() -> str:
    levels = ", ".join(f"({i}, '{n}', '{RISK_ACTIONS[n]}')" for i, n in enumerate(RISK_LEVELS))
    return (
        f"WITH {SERIES_CTE}{LABELS_CTE}{SCORED_CTE}{_pred_cte()},\n"
        f"lv(severity, risk_level, action) AS (VALUES {levels}),\n"
        "cnt AS (SELECT risk_level, count(*) AS n FROM pred GROUP BY risk_level)\n"
        "SELECT CAST(severity AS INTEGER) AS severity, risk_level, CAST(COALESCE(n, 0) AS BIGINT) AS n_units,\n"
        f"       {rd('COALESCE(n, 0) / greatest((SELECT count(*) FROM pred), 1) * 100.0')} AS pct, action\n"
        "FROM lv LEFT JOIN cnt USING (risk_level) ORDER BY severity"
    )


def q_batch_counts() -> str:
    counts = ", ".join(f"count(*) FILTER (WHERE risk_level = '{n}') AS {n.lower()}_count" for n in RISK_LEVELS)
    return f"WITH {SERIES_CTE}{LABELS_CTE}{SCORED_CTE}{_pred_cte()}\nSELECT count(*) AS total_engines, {counts} FROM pred"


def q_payload_flatten() -> str:
    return (
        f"WITH {SERIES_CTE}\n"
        "SELECT CAST(unit_id AS VARCHAR) AS unit_id, CAST(10 AS BIGINT) AS use_last_n, CAST((cycle - 1) % 100 AS INTEGER) AS pos,\n"
        f"       {rd('value')} AS value, {rd('k')} AS k, -0.0006 + 0.0 AS op_setting_1, 0.0004 + 0.0 AS op_setting_2,\n"
        "       100.0 + 0.0 AS op_setting_3, CAST(cycle AS BIGINT) AS cycle FROM series"
    )


def q_payload_quarantine() -> str:
    rules = ["malformed_request", "no_readings", "use_last_n_out_of_range", "missing_value", "missing_k", "cycle_below_1"]
    parts = [
        "SELECT 'malformed_request' AS rule, CAST(0 AS BIGINT) AS violations",
        "SELECT 'no_readings', CAST(0 AS BIGINT)",
        "SELECT 'use_last_n_out_of_range', CAST(0 AS BIGINT)",
        "SELECT 'missing_value', CAST(count(*) FILTER (WHERE value IS NULL) AS BIGINT) FROM series",
        "SELECT 'missing_k', CAST(count(*) FILTER (WHERE k IS NULL) AS BIGINT) FROM series",
        "SELECT 'cycle_below_1', CAST(count(*) FILTER (WHERE cycle < 1) AS BIGINT) FROM series",
    ]
    assert len(parts) == len(rules)
    return f"WITH {SERIES_CTE}\n" + "\nUNION ALL\n".join(parts)


def q_accuracy_monitor() -> str:
    correct = "CAST((CAST(score >= 0.5 AS INTEGER) = CAST(label AS INTEGER)) AS DOUBLE)"
    return with_processed(
        "SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,\n"
        f"       count(*) AS n, {rd(f'avg({correct})')} AS accuracy FROM scored WHERE ts IS NOT NULL GROUP BY 1, 2",
        scored=True,
    )


def q_rolling_accuracy() -> str:
    correct = "CAST((CAST(score >= 0.5 AS INTEGER) = CAST(label AS INTEGER)) AS DOUBLE)"
    w = "(PARTITION BY unit_id ORDER BY cycle ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"
    acc = f"CASE WHEN count(c) OVER {w} >= 10 THEN avg(c) OVER {w} END"
    return with_processed(
        f"SELECT unit_id, cycle, {rd(acc)} AS rolling_accuracy, ({acc}) < 0.8 AS accuracy_alert\n"
        f"FROM (SELECT unit_id, cycle, {correct} AS c FROM scored)",
        scored=True,
    )


ORACLES = {
    "unit_lifetimes": q_unit_lifetimes,
    "lifetime_summary": q_lifetime_summary,
    "sensor_profile": q_sensor_profile,
    "label_balance": q_label_balance,
    "data_checks": q_data_checks,
    "drift_baseline": q_drift_baseline,
    "psi": q_psi,
    "ks_stat": q_ks_stat,
    "ks_pvalue": q_ks_pvalue,
    "drift_report": q_drift_report,
    "drift_summary": q_drift_summary,
    "drift_topk": q_drift_topk,
    "drift_scenarios": q_drift_scenarios,
    "drift_slices": q_drift_slices,
    "drift_events": q_drift_events,
    "drift_check_details": q_drift_check_details,
    "ks_exact": q_ks_exact,
    "stream_drift": q_stream_drift,
    "confusion": q_confusion,
    "class_metrics": q_class_metrics,
    "roc_auc": q_roc_auc,
    "avg_precision": q_avg_precision,
    "youden": q_youden,
    "business_cost": q_business_cost,
    "reg_metrics": q_reg_metrics,
    "rul_score": q_rul_score,
    "last_n_mean": q_last_n_mean,
    "true_state": q_true_state,
    "fleet_summary": q_fleet_summary,
    "batch_counts": q_batch_counts,
    "batch_results": q_batch_results,
    "youden_decisions": q_youden_decisions,
    "payload_flatten": q_payload_flatten,
    "payload_quarantine": q_payload_quarantine,
    "accuracy_monitor": q_accuracy_monitor,
    "rolling_accuracy": q_rolling_accuracy,
}
