"""DuckDB twins of the queries over stored artefacts."""

from __future__ import annotations

from fleetlens.plans import analytics_sql as A
from fleetlens.plans import oracle_sql as O
from fleetlens.plans.oracle_sql import LABELS_CTE, SERIES_CTE, rd, rnd


def q_text_readings() -> str:
    return f"WITH {SERIES_CTE}\nSELECT unit_id, cycle, {rnd('value', 'value')}, {rnd('CASE WHEN unit_id % 10 <> 0 THEN k END', 'k')} FROM series"


def q_sampled_units() -> str:
    return f"WITH {SERIES_CTE}\nSELECT unit_id, cycle, {rnd('value', 'value')}, {rnd('k', 'k')} FROM series WHERE unit_id IN (SELECT DISTINCT unit_id FROM series ORDER BY 1 LIMIT 20)"


def q_rul_truth() -> str:
    return (
        f"WITH {SERIES_CTE},\nlives AS (SELECT unit_id, max(cycle) AS n FROM series GROUP BY unit_id)\n"
        "SELECT unit_id, cycle, CAST(least(n - cycle + n % 7, 125) AS INTEGER) AS rul FROM series JOIN lives USING (unit_id)"
    )


def _names() -> list[str]:
    feats = [n for n, _ in O.all_features(O.SENSORS)] + [f"{s}_entropy_{O.ENT_W}" for s in O.SENSORS]
    return [*O.SENSORS, *feats, "value_k_ratio"]


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(repr(x) for x in r) + ")" for r in rows)


def q_feature_list() -> str:
    return f"SELECT CAST(pos AS INTEGER) AS pos, feature FROM (VALUES {_values(enumerate(_names()))}) AS t(pos, feature)"


def q_column_roles() -> str:
    names = _names()
    calm = [n for n in names if "_roll_" not in n and "_lag_" not in n]
    roles = {"sensor": O.SENSORS, "classifier": [*names, "failure_label"], "regressor": [*names, "rul"], "monitored": calm[:15]}
    rows = [(role, i, n) for role, found in roles.items() for i, n in enumerate(found)]
    return f"SELECT role, CAST(pos AS INTEGER) AS pos, feature FROM (VALUES {_values(rows)}) AS t(role, pos, feature)"


def q_feature_catalog() -> str:
    has = lambda *parts: " OR ".join(f"contains(feature, '{p}')" for p in parts)
    families = {
        "Original sensors": f"NOT ({has('roll', 'lag', 'diff', 'ewm', 'slope', 'entropy', 'ratio')})",
        "Rolling statistics": has("roll"), "Lag features": has("lag_"), "Rate of change": has("diff_"), "EWMA": has("ewm_"),
        "Trend slope": has("slope"), "Entropy": has("entropy"), "Cross-sensor": has("ratio", "temp_diff"),
    }
    parts = [f"SELECT '{f}' AS family, CAST(count(*) AS INTEGER) AS n_features, arg_min(feature, pos) AS example FROM names WHERE {cond} HAVING count(*) > 0" for f, cond in families.items()]
    return f"WITH names AS ({q_feature_list()})\n" + "\nUNION ALL\n".join(parts)


def q_placeholder_labels() -> str:
    return f"WITH {SERIES_CTE}\nSELECT unit_id, cycle, 0::INTEGER AS rul, 0::INTEGER AS failure_label FROM series"


def q_absent_features() -> str:
    return A._drift_with(A._ev_long(), series_needed=True) + f"\nSELECT feature, {rd('psi')} AS psi FROM psi_t"


def q_rolling_skew() -> str:
    cols = []
    for n in (10, 30):
        w = O.frame(n)
        m = [f"avg(pow(value, {p})) OVER {w}" for p in (1, 2, 3)]
        var = f"({m[1]} - pow({m[0]}, 2))"
        third = f"({m[2]} - 3 * {m[0]} * {m[1]} + 2 * pow({m[0]}, 3))"
        cols.append(rnd(f"CASE WHEN count(value) OVER {w} >= {n // 2} THEN {third} / pow({var}, 1.5) END", f"value_roll_skew_{n}"))
    return f"WITH {SERIES_CTE}\nSELECT unit_id, cycle, {', '.join(cols)} FROM series"


def q_first_units() -> str:
    return A.q_true_state() + "\nORDER BY unit_id LIMIT 4"


def q_checked_write() -> str:
    rules = {
        "missing_raw_values": "count(*) FILTER (WHERE event_type = 'error') + count(*) FILTER (WHERE k = 0)",
        "infinite_values": "count(*) FILTER (WHERE event_type = 'view')",
        "missing_unit_id": "count(*) FILTER (WHERE event_type = 'signup')",
        "label_not_binary": "count(*) FILTER (WHERE k % 3 = 2)",
        "rul_out_of_range": "count(*) FILTER (WHERE trunc(value - 5) < 0 OR trunc(value - 5) > 125)",
        "first_cycle_not_1": "(SELECT count(*) FROM (SELECT CASE WHEN event_type <> 'signup' THEN user_id END AS u, min(k) AS m FROM e GROUP BY u) WHERE m <> 1)",
        "required_columns_missing": "1",
        "single_class": "0",
    }
    parts = [f"SELECT '{name}' AS check_name, CAST({sql} AS BIGINT) AS violations{'' if name in ('first_cycle_not_1', 'required_columns_missing', 'single_class') else ' FROM e'}" for name, sql in rules.items()]
    return "WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)\n" + "\nUNION ALL\n".join(parts)


def q_payload_dirty() -> str:
    whole, sent = "unit_id % 13 <> 0", "unit_id % 13 <> 0 AND unit_id % 11 <> 0 AND unit_id % 7 <> 0"
    rules = {
        "malformed_request": "blocks WHERE unit_id % 13 = 0", "no_readings": f"blocks WHERE {whole} AND unit_id % 11 = 0",
        "use_last_n_out_of_range": f"blocks WHERE {whole} AND unit_id % 7 = 0", "missing_value": f"series WHERE {sent} AND value IS NULL",
        "missing_k": f"series WHERE {sent} AND (k = 5 OR k IS NULL)", "cycle_below_1": f"series WHERE {sent} AND k = 9",
    }
    parts = [f"SELECT '{rule}' AS rule, count(*) AS violations FROM {rows}" for rule, rows in rules.items()]
    return f"WITH {SERIES_CTE},\nblocks AS (SELECT DISTINCT unit_id, (cycle - 1) // 100 AS block FROM series)\n" + "\nUNION ALL\n".join(parts)


ORACLES = {
    "payload_dirty": q_payload_dirty,
    "text_readings": q_text_readings,
    "sampled_units": q_sampled_units,
    "rul_truth": q_rul_truth,
    "stored_features": O.q_fill,
    "stored_scaler": O.q_scaled_values,
    "stored_report": A.q_class_metrics,
    "feature_list": q_feature_list,
    "column_roles": q_column_roles,
    "feature_catalog": q_feature_catalog,
    "placeholder_labels": q_placeholder_labels,
    "absent_features": q_absent_features,
    "rolling_skew": q_rolling_skew,
    "first_units": q_first_units,
    "checked_write": q_checked_write,
}
