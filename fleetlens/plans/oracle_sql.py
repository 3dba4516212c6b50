"""ANSI SQL (DuckDB dialect) twins of the registered queries.

Each string is an independent definition of the same result, written the plain
way (one window over the whole unit, full sorts); the driver runs it next to the
Spark job and compares row counts, schemas and values.
"""

from __future__ import annotations

from fleetlens.functions.columns import ewma_decay

R = 6  # output rounding digits shared with the Spark side

SERIES_CTE = """series AS (
  SELECT user_id AS unit_id,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS cycle,
         ts, event_id,
         CASE WHEN isnan(value) THEN NULL ELSE value END AS value,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
         CAST(event_type = 'error' AS INTEGER) AS is_error
  FROM events)"""

SENSORS = ["value", "k"]
WINDOWS = [5, 10, 20, 30]
LAGS = [1, 3, 5, 10]
DIFFS = [1, 5]
SPANS = [5, 10, 20]
TREND = 10
ENT_W = 10


def rnd(expr: str, alias: str) -> str:
    return f"{rd(expr)} AS {alias}"


def rd(expr: str) -> str:
    """ROUND to R decimals; + 0.0 turns -0.0 into 0.0."""
    return f"(ROUND(CAST({expr} AS DOUBLE), {R}) + 0.0)"


def frame(n: int) -> str:
    return f"(PARTITION BY unit_id ORDER BY cycle ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


UNIT_W = "(PARTITION BY unit_id ORDER BY cycle)"
PREFIX_W = "(PARTITION BY unit_id ORDER BY cycle ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def guard(s: str, n: int, m: int, value: str) -> str:
    return f"CASE WHEN count({s}) OVER {frame(n)} >= {m} THEN {value} END"


def rolling_exprs(stat: str, sensors=SENSORS, windows=WINDOWS):
    out = []
    for s in sensors:
        for n in windows:
            m = max(n // 2, 1)
            if stat == "mean":
                e = guard(s, n, m, f"avg({s}) OVER {frame(n)}")
            elif stat == "std":
                e = f"COALESCE({guard(s, n, m, f'stddev_samp({s}) OVER {frame(n)}')}, 0.0)"
            elif stat == "min":
                e = guard(s, n, m, f"min({s}) OVER {frame(n)}")
            else:
                e = guard(s, n, m, f"max({s}) OVER {frame(n)}")
            out.append((f"{s}_roll_{stat}_{n}", e))
    return out


def lag_exprs(sensors=SENSORS, lags=LAGS):
    return [(f"{s}_lag_{k}", f"lag({s}, {k}) OVER {UNIT_W}") for s in sensors for k in lags]


def diff_exprs(sensors=SENSORS, diffs=DIFFS):
    return [(f"{s}_diff_{k}", f"COALESCE({s} - lag({s}, {k}) OVER {UNIT_W}, 0.0)") for s in sensors for k in diffs]


def ewma_exprs(sensors=SENSORS, spans=SPANS):
    out = []
    for s in sensors:
        for sp in spans:
            r = repr(ewma_decay(sp))
            if sp == 1:  # no weight but the last reading's
                out.append((f"{s}_ewm_{sp}", f"last({s} IGNORE NULLS) OVER {PREFIX_W}"))
                continue
            num = f"sum(power({r}, -cycle) * {s}) OVER {PREFIX_W}"
            den = f"sum(CASE WHEN {s} IS NOT NULL THEN power({r}, -cycle) END) OVER {PREFIX_W}"
            out.append((f"{s}_ewm_{sp}", f"({num}) / NULLIF({den}, 0)"))
    return out


def slope_exprs(sensors=SENSORS, n=TREND):
    return [
        (f"{s}_slope_{n}", f"COALESCE({guard(s, n, 3, f'regr_slope({s}, CAST(cycle AS DOUBLE)) OVER {frame(n)}')}, 0.0)")
        for s in sensors
    ]


def entropy_exprs(sensors=SENSORS, n=ENT_W):
    out = []
    for s in sensors:
        lst = f"list({s}) FILTER (WHERE {s} IS NOT NULL) OVER {frame(n)}"
        out.append((f"_l_{s}", lst))
        out.append((f"_c_{s}", f"count({s}) OVER {frame(n)}"))
    return out


def entropy_finish(s: str, n: int = ENT_W) -> str:
    lst = f"_l_{s}"
    cnt = f"CAST(len({lst}) AS DOUBLE)"
    mn = f"list_min({lst})"
    mx = f"list_max({lst})"
    step = f"(({mx} - {mn}) / 4.0)"
    below = ["0"] + [f"len(list_filter({lst}, lambda x: x < {mn} + {k}.0 * {step}))" for k in (1, 2, 3)] + [f"len({lst})"]
    terms = []
    for k in range(4):
        c = f"({below[k + 1]} - {below[k]})"
        p = f"({c} / {cnt})"
        terms.append(f"CASE WHEN {c} > 0 THEN {p} * ln({p} + 1e-10) ELSE 0.0 END")
    mean = f"(list_sum({lst}) / {cnt})"
    var = f"(list_sum(list_transform({lst}, lambda x: (x - {mean}) * (x - {mean}))) / {cnt})"
    ent = f"CASE WHEN sqrt({var}) < 1e-8 THEN 0.0 ELSE -({' + '.join(terms)}) END"
    return f"CASE WHEN _c_{s} >= {n // 2} THEN {ent} END"


def series_select(exprs, extra_cte: str = "") -> str:
    cols = ",\n       ".join(rnd(e, n) for n, e in exprs)
    return f"WITH {SERIES_CTE}{extra_cte}\nSELECT unit_id, cycle,\n       {cols}\nFROM series"


def q_rolling(stat: str) -> str:
    return series_select(rolling_exprs(stat))


def q_lags() -> str:
    return series_select(lag_exprs())


def q_diffs() -> str:
    return series_select(diff_exprs())


def q_ewma() -> str:
    return series_select(ewma_exprs())


def q_slope() -> str:
    return series_select(slope_exprs())


def q_entropy() -> str:
    inner = ",\n       ".join(f"{e} AS {n}" for n, e in entropy_exprs())
    outer = ",\n       ".join(rnd(entropy_finish(s), f"{s}_entropy_{ENT_W}") for s in SENSORS)
    return (
        f"WITH {SERIES_CTE},\nlists AS (SELECT unit_id, cycle, {inner} FROM series)\n"
        f"SELECT unit_id, cycle, {outer} FROM lists"
    )


def q_cross() -> str:
    return series_select([("value_k_ratio", "value / NULLIF(k, 0)"), ("value_k_diff", "value - k")])


def fill_expr(c: str) -> str:
    fwd = f"last({c} IGNORE NULLS) OVER (PARTITION BY unit_id ORDER BY cycle ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    bwd = f"first({c} IGNORE NULLS) OVER (PARTITION BY unit_id ORDER BY cycle ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return f"COALESCE({c}, {fwd}, {bwd})"


def q_fill() -> str:
    lags = lag_exprs()
    inner = ",\n       ".join(f"{e} AS {n}" for n, e in lags)
    outer = ",\n       ".join(rnd(fill_expr(n), n) for n, _ in lags)
    return (
        f"WITH {SERIES_CTE},\nlagged AS (SELECT unit_id, cycle, {inner} FROM series)\n"
        f"SELECT unit_id, cycle, {outer} FROM lagged"
    )


LABELS_CTE = """,
labeled AS (
  SELECT s.*, CAST(LEAST(e.last_cycle - s.cycle, 125) AS INTEGER) AS rul
  FROM series s JOIN (SELECT unit_id, max(cycle) AS last_cycle FROM series GROUP BY unit_id) e USING (unit_id)),
processed AS (
  SELECT *, CAST(rul <= 30 AS INTEGER) AS failure_label FROM labeled)"""


def q_feature_matrix() -> str:
    fams = (
        rolling_exprs("mean")
        + rolling_exprs("std")
        + rolling_exprs("min")
        + rolling_exprs("max")
    )
    # reference order: per sensor, per window: mean, std, min, max
    by_name = dict(fams)
    rolling = [(f"{s}_roll_{st}_{n}", by_name[f"{s}_roll_{st}_{n}"]) for s in SENSORS for n in WINDOWS for st in ("mean", "std", "min", "max")]
    feats = rolling + lag_exprs() + diff_exprs() + ewma_exprs() + slope_exprs()
    inner = ",\n       ".join(f"{e} AS {n}" for n, e in feats + entropy_exprs())
    ent_cols = [(f"{s}_entropy_{ENT_W}", entropy_finish(s)) for s in SENSORS]
    staged_cols = ",\n       ".join(
        ["unit_id", "cycle", "value", "k", "rul", "failure_label"] + [n for n, _ in feats] + [f"{e} AS {n}" for n, e in ent_cols]
    )
    names = ["value", "k", "rul", "failure_label"] + [n for n, _ in feats] + [n for n, _ in ent_cols]
    filled = ",\n       ".join(f"{fill_expr(n)} AS {n}" for n in names)
    final_cols = ["unit_id", "cycle"] + [
        (n if n in ("rul", "failure_label") else rnd(n, n)) for n in names
    ]
    not_null = " AND ".join(f"{n} IS NOT NULL" for n in names)
    return (
        f"WITH {SERIES_CTE}{LABELS_CTE},\n"
        f"feat AS (SELECT unit_id, cycle, value, k, rul, failure_label, {inner} FROM processed),\n"
        f"staged AS (SELECT {staged_cols} FROM feat),\n"
        f"filled AS (SELECT unit_id, cycle, {filled} FROM staged)\n"
        f"SELECT {', '.join(final_cols)} FROM filled WHERE {not_null}"
    )


def q_rul() -> str:
    return f"WITH {SERIES_CTE}{LABELS_CTE}\nSELECT unit_id, cycle, rul FROM processed"


def q_failure_label() -> str:
    return f"WITH {SERIES_CTE}{LABELS_CTE}\nSELECT unit_id, cycle, rul, failure_label FROM processed"


SPLIT_TS = "TIMESTAMP '2024-01-16 00:00:00'"


def q_scaler_params() -> str:
    parts = []
    for s in SENSORS:
        parts.append(
            f"SELECT '{s}' AS column_name, avg({s}) AS mean_, stddev_pop({s}) AS std_ FROM series WHERE ts < {SPLIT_TS}"
        )
    union = "\nUNION ALL\n".join(parts)
    return (
        f"WITH {SERIES_CTE},\nst AS ({union})\n"
        f"SELECT column_name AS \"column\", {rnd('mean_', 'mean')}, "
        f"{rnd('CASE WHEN std_ IS NULL OR std_ = 0 THEN 1.0 ELSE std_ END', 'scale')} FROM st"
    )


def q_scaled_values() -> str:
    cols = []
    for s in SENSORS:
        mean = f"(SELECT avg({s}) FROM series WHERE ts < {SPLIT_TS})"
        std = f"(SELECT stddev_pop({s}) FROM series WHERE ts < {SPLIT_TS})"
        cols.append(rnd(f"({s} - {mean}) / (CASE WHEN {std} IS NULL OR {std} = 0 THEN 1.0 ELSE {std} END)", s))
    return f"WITH {SERIES_CTE}\nSELECT unit_id, cycle, {', '.join(cols)} FROM series"


def q_stream_accuracy() -> str:
    correct = "CAST((CAST(value / (value + 20.0) >= 0.5 AS INTEGER) = CAST(event_type = 'error' AS INTEGER)) AS DOUBLE)"
    return (
        "SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,\n"
        f"       count(*) AS n, {rd(f'avg({correct})')} AS accuracy\n"
        "FROM events WHERE ts IS NOT NULL GROUP BY 1, 2"
    )


def all_features(sensors) -> list:
    """Every family but the entropy, in column order: per sensor and window the four
    rolling statistics, then lags, differences, weighted means and slopes."""
    by_name = dict(e for st in ("mean", "std", "min", "max") for e in rolling_exprs(st, sensors))
    rolling = [(n, by_name[n]) for s in sensors for w in WINDOWS for st in ("mean", "std", "min", "max") for n in [f"{s}_roll_{st}_{w}"]]
    return rolling + lag_exprs(sensors) + diff_exprs(sensors) + ewma_exprs(sensors) + slope_exprs(sensors)


SPARSE_CTE = """,
sparse AS (SELECT *, CASE WHEN is_error = 1 THEN value END AS error_value FROM series)"""


def q_stream_score() -> str:
    sensors = ["value", "error_value"]
    feats = all_features(sensors)
    inner = ",\n       ".join(f"{e} AS {n}" for n, e in feats + entropy_exprs(sensors))
    ent = [(f"{s}_entropy_{ENT_W}", entropy_finish(s)) for s in sensors]
    staged = ", ".join([n for n, _ in feats] + [f"{e} AS {n}" for n, e in ent])
    fwd = lambda c: f"last({c} IGNORE NULLS) OVER (PARTITION BY unit_id ORDER BY cycle ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    outer = ", ".join(rnd(fwd(n), n) for n in [*sensors, *[n for n, _ in feats], *[n for n, _ in ent]])
    last = fwd("value")
    return (
        f"WITH {SERIES_CTE}{SPARSE_CTE},\nf AS (SELECT unit_id, cycle, value, error_value, {inner} FROM sparse),\n"
        f"g AS (SELECT unit_id, cycle, value, error_value, {staged} FROM f)\n"
        f"SELECT unit_id, CAST(cycle AS BIGINT) AS cycle, {outer}, {rd(f'{last} / ({last} + 20.0)')} AS score FROM g"
    )


def q_sparse_ewma() -> str:
    cols = ",\n       ".join(rnd(e, n) for n, e in ewma_exprs(["error_value"], [1, 5, 20]))
    return f"WITH {SERIES_CTE}{SPARSE_CTE}\nSELECT unit_id, cycle, {cols} FROM sparse"
