"""Per-unit time-series operators (rolling statistics, lags, differences, EWMA,
trend slope, entropy, cross-sensor features, gap filling, last-N selection).

Scale design
------------
A naive ``Window.partitionBy(unit)`` sends every row of a unit to one task; with
one unit holding a third of all rows that task is the whole job.  Here a unit's
series is cut into *segments* of ``seg_rows`` consecutive cycles and every window
is partitioned by ``(unit, segment)``:

* bounded frames (rolling, lag, diff, slope, entropy) get a *halo*: the last
  ``halo`` rows of segment s are copied into segment s+1 (a bounded duplication of
  halo/seg_rows), computed there, and dropped afterwards;
* prefix quantities (EWMA, forward fill) and suffix quantities (back fill) are
  computed inside the segment and completed with a per-segment *carry* taken from
  a small ``(unit, segment)`` table (rows / seg_rows entries) -- a two-level scan.

Segments require a dense 1..n ``cycle`` per unit; :func:`assign_cycle` makes one
from any order key without a per-unit window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.columns import (
    ewma_decay,
    ewma_max_exponent_rows,
    ewma_reach_rows,
    safe_div,
)
from fleetlens.functions.columns import ENTROPY_LOG_EPS, ENTROPY_STD_FLOOR
from fleetlens.session import broadcast_if_small, materialize

# Fixed values that must equal the reference's for equal results.
KEY_LABEL_COLS = ["unit_id", "cycle", "rul", "failure_label"]
OP_SETTING_COLS = ["op_setting_1", "op_setting_2", "op_setting_3"]
NON_SENSOR_COLS = KEY_LABEL_COLS + OP_SETTING_COLS
DEFAULT_WINDOWS = (5, 10, 20, 30)
DEFAULT_LAGS = (1, 3, 5, 10)
DEFAULT_DIFFS = (1, 5)
DEFAULT_SPANS = (5, 10, 20)
DEFAULT_TREND_WINDOW = 10
SLOPE_MIN_PERIODS = 3
ENTROPY_WINDOW = 10
ENTROPY_SENSOR_COUNT = 4
# Cross-sensor features in output order: (name, operation, first, second sensor).
CROSS_FEATURES = (
    ("pressure_ratio_30_2", "ratio", "P30_HPC_outlet_pressure", "P2_fan_inlet_pressure"),
    ("temp_diff_50_30", "difference", "T50_LPT_outlet_temp", "T30_HPC_outlet_temp"),
    ("fan_core_speed_ratio", "ratio", "Nf_fan_speed", "Nc_core_speed"),
)

_SEG = "_seg"
_OWN = "_own"
_ROW = "_row"
_CTX = "_ctx"
# The unit as a one-field struct: structs of NULL are equal, so rows without a unit are
# one series in joins as they are in windows.
_KEY = "_key_of_unit_id"
_MAX_LOG = 600.0
SEG, KEY = _SEG, _KEY


# ── column selection (P1-P5) ────────────────────────────────────────────────


def sensor_columns(df: DataFrame, reserved: Sequence[str] = NON_SENSOR_COLS) -> list[str]:
    """Every column that is not a key, label or operating setting."""
    return [c for c in df.columns if c not in reserved]


def feature_columns(df: DataFrame, reserved: Sequence[str] = KEY_LABEL_COLS) -> list[str]:
    """Every column that is not a key or a label (op settings are features)."""
    return [c for c in df.columns if c not in reserved]


def classifier_frame(df: DataFrame, label: str = "failure_label") -> DataFrame:
    """Features + binary label."""
    return df.select(*feature_columns(df), label)


def regressor_frame(df: DataFrame, label: str = "rul") -> DataFrame:
    """Features + remaining life."""
    return df.select(*feature_columns(df), label)


def monitor_features(df: DataFrame, limit: int | None = None, exclude=("_roll_", "_lag_")) -> list[str]:
    """P5: feature names without rolling/lag families, optionally the first ``limit``."""
    names = [c for c in feature_columns(df) if not any(x in c for x in exclude)]
    return names if limit is None else names[:limit]


# ── dense cycle numbering without a per-unit window ────────────────────────


def assign_cycle(
    df: DataFrame,
    unit: str,
    order: Sequence[str],
    cycle: str = "cycle",
    partitions: int | None = None,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Number each unit's rows 1..n by ``order`` (which must be unique per unit).

    Equivalent to ``row_number() OVER (PARTITION BY unit ORDER BY order)`` but a hot
    unit is spread over many tasks: a global range sort cuts (unit, order) into
    contiguous ranges, each row gets its position inside its range partition, and
    a small ``(partition, unit)`` table (at most units + partitions rows) turns
    that into the position inside the unit.  The sorted, numbered rows are
    written to the checkpoint folder so both uses see the same range bounds, even
    after executor loss.  Rows without a unit are one series and keep their place.
    """
    spark = df.sparkSession
    n_part = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [unit, *order]
    ranged = (
        df.repartitionByRange(n_part, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    ranged = materialize(ranged, "cycle")
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    ranged = ranged.withColumn("_loc", local).withColumn(_KEY, F.struct(unit))

    per = ranged.groupBy("_pid", _KEY).agg(F.count(F.lit(1)).alias("_n"), F.min("_loc").alias("_first"))
    per_pid = per.groupBy("_pid").agg(F.sum("_n").alias("_pn"))
    # one row per partition: a window without partitioning is bounded by `partitions`
    pid_off = per_pid.select(
        "_pid",
        F.coalesce(
            F.sum("_pn").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_off"),
    )
    per = per.join(F.broadcast(pid_off), "_pid").withColumn("_gstart", F.col("_off") + F.col("_first"))
    ustart = per.groupBy(_KEY).agg(F.min("_gstart").alias("_ustart"))
    base = per.join(ustart, _KEY).select("_pid", _KEY, (F.col("_off") - F.col("_ustart")).alias("_base"))
    # `base` has at most units + partitions rows; AQE measures it after its
    # aggregate stage and broadcasts it only when it is below the broadcast
    # threshold, otherwise the join shuffles on (partition, unit), which has no
    # hot key.  ``broadcast_rows`` forces an explicit counted check instead.
    if broadcast_rows:
        base = broadcast_if_small(base, broadcast_rows)
    out = ranged.join(base, ["_pid", _KEY]).withColumn(
        cycle, (F.col("_base") + F.col("_loc") + F.lit(1)).cast("int")
    )
    return out.select(*[_q(c) for c in dict.fromkeys([*df.columns, cycle])])


# ── segmentation ────────────────────────────────────────────────────────────


def segment(df: DataFrame, cycle: str, seg_rows: int, halo: int, seg_col: str = "_seg", own_col: str = "_own") -> DataFrame:
    """Tag rows with ``seg_col`` = (cycle-1) div seg_rows and copy the last ``halo``
    rows of each segment into the next one (``own_col`` = false on the copies)."""
    if halo > seg_rows:
        raise ValueError("halo must not exceed seg_rows")
    pos = F.col(cycle) - F.lit(1)
    seg = F.floor(pos / F.lit(seg_rows)).cast("long")
    in_tail = F.pmod(pos, F.lit(seg_rows)) >= F.lit(seg_rows - halo)
    targets = F.when(F.lit(halo > 0) & in_tail, F.array(seg, seg + 1)).otherwise(F.array(seg))
    return df.select("*", F.posexplode(targets).alias("_copy", seg_col)).select(
        *df.columns, seg_col, (F.col("_copy") == 0).alias(own_col)
    )


def with_segments(df: DataFrame, *, unit: str = "unit_id", cycle: str = "cycle", seg_rows: int = 4096) -> DataFrame:
    """The keys that per-segment work is partitioned by, as columns KEY and SEG."""
    pos = F.col(cycle) - F.lit(1)
    return df.withColumn(_SEG, F.floor(pos / F.lit(seg_rows)).cast("long")).withColumn(_KEY, F.struct(unit))


def choose_seg_rows(seg_rows: int | None, halo: int, spans: Sequence[float]) -> int:
    """Segment length: large enough to amortise the halo, small enough that the
    EWMA power weights r^-q stay finite inside a segment."""
    size = seg_rows or 4096
    for span in spans:
        size = min(size, ewma_max_exponent_rows(span, _MAX_LOG))
    return max(size, halo, 1)


def _frame_halo(windows, lags, diffs, trend_window, entropy_window) -> int:
    """Rows before a row that its frames, lags and differences read."""
    frames = [*windows, *[w for w in (trend_window, entropy_window) if w]]
    return max([0] + [n - 1 for n in frames] + list(lags) + list(diffs))


def _one_segment(
    longest, sensors, *, windows=DEFAULT_WINDOWS, lags=DEFAULT_LAGS, diffs=DEFAULT_DIFFS, spans=DEFAULT_SPANS, trend_window=DEFAULT_TREND_WINDOW,
    entropy_sensors=None, entropy_window=ENTROPY_WINDOW, seg_rows=None, **_
) -> bool:
    """Whether :func:`temporal_features` keeps a series of ``longest`` rows in one segment."""
    halo = _frame_halo(windows, lags, diffs, trend_window, entropy_window if (sensors if entropy_sensors is None else entropy_sensors) else None)
    return all(ewma_max_exponent_rows(span, _MAX_LOG) >= halo for span in spans) and longest <= choose_seg_rows(seg_rows, halo, spans)


# ── feature families (expressions over the segment window) ─────────────────


# Expressions are written as SQL text and parsed once by the JVM: a feature
# build has hundreds of window expressions, and building them Column by Column
# costs several JVM round trips each on the driver.


def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _d(x: float) -> str:
    return f"{float(x)!r}D"


class _Spec:
    """SQL window specs over (unit, segment) ordered by cycle."""

    def __init__(self, unit: str, cycle: str):
        self.unit, self.cycle = unit, cycle
        self.base = f"PARTITION BY {_q(unit)}, {_q(_SEG)} ORDER BY {_q(cycle)}"

    def ordered(self) -> str:
        return f"({self.base})"

    def trailing(self, n: int) -> str:
        return f"({self.base} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"

    def prefix(self) -> str:
        return f"({self.base} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

    def whole(self) -> str:
        return f"({self.base} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"


def _guard(s: str, frame: str, m: int, value: str) -> str:
    """pandas ``min_periods``: ``value`` only where the frame holds >= m non-null values."""
    return f"CASE WHEN count({_q(s)}) OVER {frame} >= {m} THEN {value} END"


_ROLL_AGG = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max", "skew": "skewness"}


def _rolling(sensors, windows, stats, sp: _Spec):
    out = []
    for s in sensors:
        for n in windows:
            frame = sp.trailing(n)
            m = max(n // 2, 1)
            for st in stats:
                if st not in _ROLL_AGG:
                    raise ValueError(f"unknown rolling statistic {st}")
                e = _guard(s, frame, m, f"CAST({_ROLL_AGG[st]}({_q(s)}) OVER {frame} AS DOUBLE)")
                if st == "std":
                    e = f"COALESCE({e}, 0.0D)"
                out.append((f"{s}_roll_{st}_{n}", e))
    return out


def _lags(sensors, lags, sp: _Spec):
    return [(f"{s}_lag_{k}", f"lag({_q(s)}, {k}) OVER {sp.ordered()}") for s in sensors for k in lags]


def _diffs(sensors, steps, sp: _Spec):
    return [
        (f"{s}_diff_{k}", f"CAST(COALESCE({_q(s)} - lag({_q(s)}, {k}) OVER {sp.ordered()}, 0.0D) AS DOUBLE)")
        for s in sensors
        for k in steps
    ]


def _slopes(sensors, trend_window, sp: _Spec):
    frame = sp.trailing(trend_window)
    out = []
    for s in sensors:
        slope = f"regr_slope({_q(s)}, CAST({_q(sp.cycle)} AS DOUBLE)) OVER {frame}"
        out.append((f"{s}_slope_{trend_window}", f"CAST(COALESCE({_guard(s, frame, SLOPE_MIN_PERIODS, slope)}, 0.0D) AS DOUBLE)"))
    return out


def _entropy_lags(sensors, window, sp: _Spec):
    """W10 inputs: the window's values as lag(x, 0..window-1) columns plus the
    non-null count; the entropy itself is finished by :func:`_entropy_stages`."""
    out = []
    for s in sensors:
        out.append((f"_ec_{s}", f"count({_q(s)}) OVER {sp.trailing(window)}"))
        out += [(f"_ev{k}_{s}", f"lag({_q(s)}, {k}) OVER {sp.ordered()}") for k in range(1, window)]
    return out


def _entropy_stages(df: DataFrame, sensors, window, keep) -> DataFrame:
    """Finish W10 in three projections (moments, bin counts, entropy) so every
    intermediate is computed once and the stages stay scalar and codegen-friendly."""
    if not sensors:
        return df
    vals = {s: [_q(s)] + [_q(f"_ev{k}_{s}") for k in range(1, window)] for s in sensors}
    st1 = []
    for s in sensors:
        v = vals[s]
        n = " + ".join(f"CASE WHEN {x} IS NOT NULL THEN 1.0D ELSE 0.0D END" for x in v)
        tot = " + ".join(f"COALESCE({x}, 0.0D)" for x in v)
        st1 += [
            f"({n}) AS {_q('_en_' + s)}",
            f"try_divide({tot}, {n}) AS {_q('_em_' + s)}",
            f"least({', '.join(v)}) AS {_q('_elo_' + s)}",
            f"greatest({', '.join(v)}) AS {_q('_ehi_' + s)}",
        ]
    df = df.selectExpr("*", *st1)
    st2 = []
    for s in sensors:
        v = vals[s]
        mean, n, lo, hi = (_q(f"_em_{s}"), _q(f"_en_{s}"), _q(f"_elo_{s}"), _q(f"_ehi_{s}"))
        sq = " + ".join(f"CASE WHEN {x} IS NOT NULL THEN ({x} - {mean}) * ({x} - {mean}) ELSE 0.0D END" for x in v)
        st2.append(f"sqrt(try_divide({sq}, {n})) AS {_q('_esd_' + s)}")
        step = f"(({hi} - {lo}) / 4.0D)"
        for k in (1, 2, 3):
            edge = f"({lo} + {_d(k)} * {step})"
            flags = " + ".join(f"CASE WHEN {x} < {edge} THEN 1.0D ELSE 0.0D END" for x in v)
            st2.append(f"({flags}) AS {_q(f'_eb{k}_{s}')}")
    df = df.selectExpr("*", *st2)
    out = []
    for s in sensors:
        n = _q(f"_en_{s}")
        cuts = ["0.0D", _q(f"_eb1_{s}"), _q(f"_eb2_{s}"), _q(f"_eb3_{s}"), n]
        terms = []
        for k in range(4):
            cnt = f"({cuts[k + 1]} - {cuts[k]})"
            p = f"try_divide({cnt}, {n})"
            terms.append(f"CASE WHEN {cnt} > 0 THEN {p} * ln({p} + {_d(ENTROPY_LOG_EPS)}) ELSE 0.0D END")
        ent = f"CASE WHEN {_q('_esd_' + s)} < {_d(ENTROPY_STD_FLOOR)} THEN 0.0D ELSE -({' + '.join(terms)}) END"
        out.append(f"CASE WHEN {_q('_ec_' + s)} >= {window // 2} THEN {ent} END AS {_q(f'{s}_entropy_{window}')}")
    return df.selectExpr(*[_q(c) for c in keep], *out)


def _qpos(cycle: str, seg_rows: int) -> str:
    """Row offset inside its segment."""
    return f"({_q(cycle)} - 1 - {_q(_SEG)} * {seg_rows})"


# EWMA (W8): sum r^(t-i) x_i / sum r^(t-i) over the readings up to t.  Numerator and
# denominator are held relative to the last reading m, as (m, n, d) with
# n = sum r^(m-i) x_i: between readings both decay alike, so the mean needs no more, and
# d >= 1 whatever gap precedes t.  Two such states, A before B, merge to
# (m_B, n_A r^(m_B-m_A) + n_B, d_A r^(m_B-m_A) + d_B), which is associative: sums inside a
# segment, a merge over segments, and one more merge per row.


def _ewma_local(sensors, spans, sp: _Spec, seg_rows):
    """Inside-segment parts over own rows: the last reading's cycle and power sums."""
    q = _qpos(sp.cycle, seg_rows)
    out = []
    for s in sensors:
        ok = f"{_q(_OWN)} AND {_q(s)} IS NOT NULL"
        if spans:
            out.append((f"_wm_{s}", f"last(CASE WHEN {ok} THEN CAST({_q(sp.cycle)} AS BIGINT) END, true) OVER {sp.prefix()}"))
        for span in spans:
            r = ewma_decay(span)
            if r <= 0.0:
                out.append((f"_wn_{s}_{span}", f"last(CASE WHEN {ok} THEN CAST({_q(s)} AS DOUBLE) END, true) OVER {sp.prefix()}"))
                continue
            up = f"pow({_d(r)}, -{q})"
            out.append((f"_wn_{s}_{span}", f"sum(CASE WHEN {ok} THEN {up} * {_q(s)} END) OVER {sp.prefix()}"))
            out.append((f"_wd_{s}_{span}", f"sum(CASE WHEN {ok} THEN {up} END) OVER {sp.prefix()}"))
    return out


def _ewma_names(sensors, spans) -> list[tuple[str, float]]:
    return [(s, span) for s in sensors for span in spans]


def _ewma_carry(df: DataFrame, cycle, sensors, spans, seg_rows, state: DataFrame | None) -> DataFrame:
    """Per (unit, segment): the merged state of all earlier segments as ``_pl<i>``.

    A segment's own state is merged with those of the segments before it as far as a
    weight can reach before it is 0.0 in a double; the state carried into a segment is
    that of the last earlier segment with a reading, however far back it lies."""
    q = _qpos(cycle, seg_rows)
    names = _ewma_names(sensors, spans)
    own = df.where(F.col(_OWN))
    aggs = []
    for s in sensors:
        at = f"CASE WHEN {_q(s)} IS NOT NULL THEN CAST({_q(cycle)} AS BIGINT) END"
        aggs.append(F.expr(f"max({at})").alias(f"_m_{s}"))
        for span in spans:
            r = ewma_decay(span)
            if r <= 0.0:
                aggs.append(F.expr(f"CAST(max_by({_q(s)}, {at}) AS DOUBLE)").alias(f"_tn_{s}_{span}"))
                continue
            up = f"CASE WHEN {_q(s)} IS NOT NULL THEN pow({_d(r)}, -{q}) END"
            aggs.append(F.expr(f"sum({up} * {_q(s)})").alias(f"_tn_{s}_{span}"))
            aggs.append(F.expr(f"sum({up})").alias(f"_td_{s}_{span}"))
    sums = own.groupBy(_KEY, _SEG).agg(*aggs)
    states = []
    for i, (s, span) in enumerate(names):
        r = ewma_decay(span)
        scale = f"pow({_d(r)}, `_m_{s}` - 1 - {_q(_SEG)} * {seg_rows})" if r > 0.0 else "1.0D"
        d = f"{scale} * `_td_{s}_{span}`" if r > 0.0 else "1.0D"
        states.append(f"CASE WHEN `_m_{s}` IS NOT NULL THEN named_struct('m', `_m_{s}`, 'n', {scale} * `_tn_{s}_{span}`, 'd', {d}) END AS `_s{i}`")
    totals = sums.selectExpr(_q(_KEY), _q(_SEG), *states)
    if state is not None:
        # what came before the first row, as one more segment before the unit's first
        first = totals.groupBy(_KEY).agg((F.min(_SEG) - 1).alias(_SEG))
        given = state.select(F.col(_KEY), *[F.col(f"_s{i}") for i in range(len(names))])
        totals = totals.unionByName(given.join(first, _KEY).select(*totals.columns))
    back = max(int(math.ceil(ewma_reach_rows(span) / seg_rows)) + 1 for span in spans)
    # the per-unit table of segments is itself cut into groups of SUPER_ROWS segments
    # (halo: the `back` segments a merge reads), so no task holds all of a hot unit's
    totals = segment(totals.withColumn("_segp1", F.col(_SEG) + 2), "_segp1", max(SUPER_ROWS, back), back, "_sup", "_sown")
    cols = [_q(_KEY), _q(_SEG), "`_sown`"]
    for i, (s, span) in enumerate(names):
        reach = int(math.ceil(ewma_reach_rows(span) / seg_rows)) + 1
        frame = f"(PARTITION BY {_q(_KEY)}, `_sup` ORDER BY {_q(_SEG)} ROWS BETWEEN {reach} PRECEDING AND CURRENT ROW)"
        seen = f"collect_list(CASE WHEN `_s{i}` IS NOT NULL THEN named_struct('m', `_s{i}`.m, 'n', `_s{i}`.n, 'd', `_s{i}`.d) END) OVER {frame}"
        fade = f"pow({_d(max(ewma_decay(span), 0.0))}, e.m - acc.m)"
        merge = f"CASE WHEN acc.m IS NULL THEN e ELSE named_struct('m', e.m, 'n', e.n + {fade} * acc.n, 'd', e.d + {fade} * acc.d) END"
        zero = "named_struct('m', CAST(NULL AS BIGINT), 'n', CAST(NULL AS DOUBLE), 'd', CAST(NULL AS DOUBLE))"
        cols.append(f"CASE WHEN `_s{i}` IS NOT NULL THEN aggregate(array_sort({seen}), {zero}, (acc, e) -> {merge}) END AS `_l{i}`")
    merged = totals.selectExpr(*cols).where("_sown").drop("_sown")
    return _segment_carry(merged, _KEY, len(names), False)


def _ewma_finish(sensors, spans, seg_rows, carried: bool):
    """(name, expression) of the means, and of the state columns m, n and d behind them."""
    means, state = [], []
    for i, (s, span) in enumerate(_ewma_names(sensors, spans)):
        r = ewma_decay(span)
        m, carry = _q(f"_wm_{s}"), f"`_pl{i}`"
        here = f"pow({_d(r)}, {m} - 1 - {_q(_SEG)} * {seg_rows})" if r > 0.0 else "1.0D"
        fade = f"pow({_d(max(r, 0.0))}, {m} - {carry}.m)"
        parts = {}
        for kind in ("n", "d"):
            raw = _q(f"_w{kind}_{s}_{span}") if r > 0.0 or kind == "n" else "1.0D"
            if not carried:  # one segment a unit
                parts[kind] = f"CASE WHEN {m} IS NOT NULL THEN {here} * {raw} END"
                continue
            parts[kind] = f"CASE WHEN {m} IS NULL THEN {carry}.{kind} WHEN {carry}.m IS NULL THEN {here} * {raw} ELSE {here} * {raw} + {fade} * {carry}.{kind} END"
        means.append((f"{s}_ewm_{span}", f"try_divide({parts['n']}, {parts['d']})"))
        latest = f"COALESCE({m}, {carry}.m)" if carried else m
        state.append((f"_s{i}", f"CASE WHEN {latest} IS NOT NULL THEN named_struct('m', {latest}, 'n', {parts['n']}, 'd', {parts['d']}) END"))
    return means, state


def cross_sensor_columns(
    columns: Sequence[str], features: Sequence[tuple[str, str, str, str]] = CROSS_FEATURES
) -> list[tuple[str, Column]]:
    """Ratios (zero denominator -> NULL) and differences, in the table's order,
    each only when both input columns exist."""
    out = []
    for name, operation, a, b in features:
        if a in columns and b in columns:
            value = safe_div(F.col(a), F.col(b)) if operation == "ratio" else F.col(a) - F.col(b)
            out.append((name, value.cast("double")))
    return out


# ── public operators ────────────────────────────────────────────────────────


def temporal_features(
    df: DataFrame,
    sensors: Sequence[str] | None = None,
    *,
    unit: str = "unit_id",
    cycle: str = "cycle",
    windows: Sequence[int] = DEFAULT_WINDOWS,
    stats: Sequence[str] = ("mean", "std", "min", "max"),
    lags: Sequence[int] = DEFAULT_LAGS,
    diffs: Sequence[int] = DEFAULT_DIFFS,
    spans: Sequence[float] = DEFAULT_SPANS,
    trend_window: int | None = DEFAULT_TREND_WINDOW,
    entropy_sensors: Sequence[str] | None = None,
    entropy_window: int = ENTROPY_WINDOW,
    cross: bool | Sequence[tuple[str, str, str, str]] | dict = True,
    seg_rows: int | None = None,
    keep_segment: bool = False,
    context: DataFrame | None = None,
    ewma_state: DataFrame | None = None,
    keep_state: bool = False,
    longest: int | None = None,
    keep_key: bool = False,
) -> DataFrame:
    """Every feature family in one pass over ``(unit, segment)`` windows.

    Output = input columns followed by the generated columns in the reference's
    family order (rolling, lag, diff, ewm, slope, entropy, cross).  No filling or
    dropping is done here (see :func:`fill_gaps`, :func:`feature_matrix`).
    ``cycle`` must be dense 1..n per unit (see :func:`assign_cycle`).

    ``cross`` takes further features as (name, "ratio" or "difference", first, second)
    rows, or as {"ratios": [(name, first, second)], "differences": [...]}.

    A series can go on where an earlier call ended: ``context`` holds the rows (unit,
    cycle, sensors) just before ``df``'s, which frames and lags read but which are not
    returned, and ``ewma_state`` what ``keep_state=True`` gave on the unit's last row
    (``_s0``, ``_s1``, ... by sensor and span, beside the unit).

    ``longest`` is the largest ``cycle``, if it is known: where it lies in a unit's first
    segment nothing is carried between segments.  ``keep_segment`` and ``keep_key`` leave
    the keys SEG and KEY, by which the rows are dealt, for windows that follow.
    """
    sensors = list(sensor_columns(df) if sensors is None else sensors)
    if entropy_sensors is None:
        entropy_sensors = sensors[:ENTROPY_SENSOR_COUNT] if len(sensors) > ENTROPY_SENSOR_COUNT else sensors
    spans = list(spans)
    halo = _frame_halo(windows, lags, diffs, trend_window, entropy_window if entropy_sensors else None)
    if any(ewma_max_exponent_rows(span, _MAX_LOG) < halo for span in spans):
        # frames longer than a segment in which the power weights stay finite: the
        # weighted means get a pass of their own, over shorter segments
        shared = dict(unit=unit, cycle=cycle, seg_rows=seg_rows, longest=longest)
        weighted = temporal_features(
            df, sensors, windows=(), lags=(), diffs=(), spans=spans, trend_window=None, entropy_sensors=[], cross=False, ewma_state=ewma_state, keep_state=keep_state, **shared
        )
        rest = temporal_features(
            weighted, sensors, windows=windows, stats=stats, lags=lags, diffs=diffs, spans=(), trend_window=trend_window,
            entropy_sensors=entropy_sensors, entropy_window=entropy_window, cross=cross, keep_segment=keep_segment, context=context, keep_key=keep_key, **shared
        )
        means = [c for c in weighted.columns if c not in df.columns]
        other = [c for c in rest.columns if c not in weighted.columns]
        before = len(sensors) * (len(windows) * len(stats) + len(lags) + len(diffs))
        return rest.select(*[_q(c) for c in (*df.columns, *other[:before], *means, *other[before:])])
    size = choose_seg_rows(seg_rows, halo, spans)
    base_cols = df.columns
    rows = df.withColumn(_CTX, F.lit(False))
    if context is not None:
        before = context.select(unit, cycle, *sensors).withColumn(_CTX, F.lit(True))
        rows = rows.unionByName(before, allowMissingColumns=True)
    seg = segment(rows.withColumn(_KEY, F.struct(unit)), cycle, size, halo).withColumn(_OWN, F.col(_OWN) & ~F.col(_CTX))
    sp = _Spec(_KEY, cycle)

    fams: list[tuple[str, str]] = []
    fams += _rolling(sensors, windows, stats, sp)
    fams += _lags(sensors, lags, sp)
    fams += _diffs(sensors, diffs, sp)
    ewma_local = _ewma_local(sensors, spans, sp, size)
    slope = _slopes(sensors, trend_window, sp) if trend_window else []
    ent = _entropy_lags(entropy_sensors, entropy_window, sp)
    if cross is True:
        cr = cross_sensor_columns(base_cols)
    elif isinstance(cross, dict):
        wanted = [(n, "ratio", a, b) for n, a, b in cross.get("ratios", ())] + [(n, "difference", a, b) for n, a, b in cross.get("differences", ())]
        cr = cross_sensor_columns(base_cols, wanted)
    else:
        cr = cross_sensor_columns(base_cols, cross) if cross else []

    # an input that a join has left hashed by the unit alone would satisfy the windows:
    # deal it by (unit, segment), so that a hot unit is split
    dealt = seg.repartition(_KEY, _SEG)
    carried = bool(ewma_local) and (longest is None or longest > size or ewma_state is not None)
    carries: list[str] = []
    if carried:
        # joined in front of the windows, where rows are narrow and sorted for them anyway
        if ewma_state is not None:
            ewma_state = ewma_state.withColumn(_KEY, F.struct(unit))
        carry = _ewma_carry(seg, cycle, sensors, spans, size, ewma_state)
        carries = [c for c in carry.columns if c not in (_KEY, _SEG)]
        dealt = dealt.join(carry, [_KEY, _SEG], "left")
    staged = dealt.selectExpr(
        *[_q(c) for c in (*base_cols, _KEY, _SEG, _OWN, *carries)], *[f"{e} AS {_q(n)}" for n, e in fams + ewma_local + slope + ent]
    ).where(F.col(_OWN))
    ewm_names: list[str] = []
    state_names: list[str] = []
    if ewma_local:
        means, state = _ewma_finish(sensors, spans, size, carried)
        ewm_names = [n for n, _ in means]
        state_names = [n for n, _ in state] if keep_state else []
        staged = staged.selectExpr("*", *[f"{e} AS {_q(n)}" for n, e in means + (state if keep_state else [])])
    ordered = (
        list(base_cols)
        + [n for n, _ in fams]
        + ewm_names
        + [n for n, _ in slope]
    )
    if keep_segment:
        ordered = ordered + [_SEG]
    if keep_key:
        ordered = ordered + [_KEY]
    ordered = ordered + state_names
    ent_names = [f"{s}_entropy_{entropy_window}" for s in entropy_sensors]
    staged = _entropy_stages(staged, list(entropy_sensors), entropy_window, ordered)
    return staged.select(*[F.col(_q(c)) for c in ordered], *[F.col(_q(c)) for c in ent_names], *[e.alias(n) for n, e in cr])


SUPER_ROWS = 1024  # segments per group in the per-unit carry tables


def _segment_carry(edges: DataFrame, unit: str, n: int, do_back: bool) -> DataFrame:
    """Per (unit, segment): the last non-null value of every column in earlier
    segments (``_pl<i>``) and the first non-null in later ones (``_nf<i>``).

    Two levels, so a hot unit's segments are not ordered in one task: running
    frames inside groups of SUPER_ROWS segments, then the same over the (much
    smaller) table of groups.  Only running frames are used -- the backward
    carry runs over descending order -- because Spark re-evaluates frames that
    reach UNBOUNDED FOLLOWING on every row."""
    e = edges.withColumn("_sup", F.floor(F.col(_SEG) / F.lit(SUPER_ROWS)).cast("long"))
    asc = f"(PARTITION BY {_q(unit)}, `_sup` ORDER BY {_q(_SEG)} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    desc = f"(PARTITION BY {_q(unit)}, `_sup` ORDER BY {_q(_SEG)} DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    lvl1 = [_q(unit), _q(_SEG), "`_sup`"]
    sup_aggs = []
    for i in range(n):
        lvl1.append(f"last(`_l{i}`, true) OVER {asc} AS `_a{i}`")
        sup_aggs.append(F.expr(f"max_by(`_l{i}`, CASE WHEN `_l{i}` IS NOT NULL THEN {_q(_SEG)} END)").alias(f"_sl{i}"))
        if do_back:
            lvl1.append(f"last(`_f{i}`, true) OVER {desc} AS `_b{i}`")
            sup_aggs.append(F.expr(f"min_by(`_f{i}`, CASE WHEN `_f{i}` IS NOT NULL THEN {_q(_SEG)} END)").alias(f"_sf{i}"))
    inner = e.selectExpr(*lvl1)
    sups = e.groupBy(unit, "_sup").agg(*sup_aggs)
    sasc = f"(PARTITION BY {_q(unit)} ORDER BY `_sup` ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    sdesc = f"(PARTITION BY {_q(unit)} ORDER BY `_sup` DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    lvl2 = [_q(unit), "`_sup`"]
    for i in range(n):
        lvl2.append(f"last(`_sl{i}`, true) OVER {sasc} AS `_c{i}`")
        if do_back:
            lvl2.append(f"last(`_sf{i}`, true) OVER {sdesc} AS `_d{i}`")
    outer = sups.selectExpr(*lvl2)
    both = inner.join(outer, [unit, "_sup"], "left")
    out = [_q(unit), _q(_SEG)]
    for i in range(n):
        out.append(f"COALESCE(`_a{i}`, `_c{i}`) AS `_pl{i}`")
        if do_back:
            out.append(f"COALESCE(`_b{i}`, `_d{i}`) AS `_nf{i}`")
    return both.selectExpr(*out)


def fill_gaps(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    unit: str = "unit_id",
    cycle: str = "cycle",
    direction: str = "both",
    seg_rows: int = 4096,
    initial: DataFrame | None = None,
    longest: int | None = None,
) -> DataFrame:
    """Forward fill, then back fill, per unit in cycle order.

    Forward fill is a running ``last(ignorenulls)`` frame.  After it, only a
    unit's leading gap is still empty, and back filling that gap takes the unit's
    first non-null value: a whole-partition ``first(ignorenulls)`` in the same
    window (same sort).  Across segments, the last (first) non-null value of
    every earlier (later) segment comes from a small per-segment table.  Columns
    the schema proves non-null are passed through untouched.
    ``direction='forward'`` avoids the look-ahead of back filling (needed for
    streams); ``'both'`` is the reference's forward-then-back fill.  ``initial`` holds,
    beside the unit, the last non-null values before its first row here.  ``longest`` is
    the largest ``cycle``, if known: within one segment nothing is carried.
    """
    if direction not in ("both", "forward"):
        raise ValueError("direction must be 'both' or 'forward'")
    nullable = {f.name for f in df.schema.fields if f.nullable}
    wanted = columns if columns is not None else df.columns
    cols = [c for c in wanted if c not in (unit, cycle, _SEG, _KEY) and c in nullable]
    if not cols:
        return df
    base_cols = df.columns
    if _SEG not in df.columns:
        tagged = with_segments(df, unit=unit, cycle=cycle, seg_rows=seg_rows)
    elif _KEY not in df.columns:  # the feature stage's own segments
        tagged = df.withColumn(_KEY, F.struct(unit))
    else:
        # a table stored by (unit, segment): the windows below add no exchange
        tagged = df
    sp = _Spec(_KEY, cycle)
    do_back = direction == "both"
    if longest is not None and longest <= seg_rows and initial is None:
        filled = []
        for c in cols:
            e = f"{_q(c)}, last({_q(c)}, true) OVER {sp.prefix()}"
            filled.append(f"COALESCE({e}{f', first({_q(c)}, true) OVER {sp.whole()}' if do_back else ''}) AS {_q(c)}")
        return tagged.selectExpr(*[_q(c) for c in tagged.columns if c not in cols], *filled).select(*base_cols)
    edge_aggs = []
    for i, c in enumerate(cols):
        # max_by / min_by skip rows whose ordering is NULL: last / first non-null value
        at = f"CASE WHEN {_q(c)} IS NOT NULL THEN {_q(cycle)} END"
        edge_aggs.append(F.expr(f"max_by({_q(c)}, {at})").alias(f"_l{i}"))
        if do_back:
            edge_aggs.append(F.expr(f"min_by({_q(c)}, {at})").alias(f"_f{i}"))
    edges = tagged.groupBy(_KEY, _SEG).agg(*edge_aggs)
    carry = _segment_carry(edges, _KEY, len(cols), do_back)
    if initial is not None:
        known = [c for c in cols if c in initial.columns]
        given = initial.select(F.struct(unit).alias(_KEY), *[F.col(c).alias(f"_i{cols.index(c)}") for c in known])
        # joined to the segments' table, which has no hot unit's rows
        carry = carry.join(given, _KEY, "left")
        for c in known:
            i = cols.index(c)
            carry = carry.withColumn(f"_pl{i}", F.coalesce(f"_pl{i}", f"_i{i}")).drop(f"_i{i}")
    joined = tagged.join(carry, [_KEY, _SEG], "left")
    filled = []
    for i, c in enumerate(cols):
        e = f"COALESCE({_q(c)}, last({_q(c)}, true) OVER {sp.prefix()}, `_pl{i}`"
        if do_back:
            # after a forward fill only a unit's leading gap is still empty, and the
            # next value for any row of it is the first non-null value of the unit:
            # this segment's (one whole-partition frame, same sort) or a later one's
            e += f", first({_q(c)}, true) OVER {sp.whole()}, `_nf{i}`"
        filled.append(f"{e}) AS {_q(c)}")
    keep = [_q(c) for c in joined.columns if c not in cols]
    joined = joined.selectExpr(*keep, *filled)
    return joined.select(*base_cols)


def fill_inside(df: DataFrame, columns: Sequence[str], *, cycle: str = "cycle", direction: str = "both", initial: str | None = None, end: str | None = None) -> DataFrame:
    """The part of :func:`fill_gaps` that lies inside segments, of rows that
    :func:`temporal_features` has dealt by KEY and SEG: same windows' order, no exchange.

    It is the whole fill where every unit lies in one segment; else
    :func:`carry_forward` ends a forward fill.  ``initial`` names a struct column that
    holds, on a unit's first row here, the last non-null values before it.  ``end`` names
    a flag to add: the last row of its unit and segment."""
    nullable = {f.name for f in df.schema.fields if f.nullable}
    known = {f.name for f in df.schema[initial].dataType.fields} if initial else set()
    sp = _Spec(_KEY, cycle)
    out = []
    for c in df.columns:
        if c not in columns or c not in nullable:
            if c != initial:
                out.append(_q(c))
            continue
        first = f"COALESCE({_q(c)}, {_q(initial)}.{_q(c)})" if c in known else _q(c)
        e = f"COALESCE({_q(c)}, last({first}, true) OVER {sp.prefix()}"
        if direction == "both":
            e += f", first({_q(c)}, true) OVER {sp.whole()}"
        out.append(f"{e}) AS {_q(c)}")
    if end:
        out.append(f"lead({_q(cycle)}) OVER {sp.ordered()} IS NULL AS {_q(end)}")
    return df.selectExpr(*out)


def carry_forward(df: DataFrame, columns: Sequence[str], *, unit: str = "unit_id", end: str) -> DataFrame:
    """Ends a forward fill that :func:`fill_inside` has made inside segments: what is
    still empty takes the last value of the unit's earlier segments here.  ``df`` is
    stored and holds SEG and the flag ``end``; only units in several segments are carried."""
    tagged = df.withColumn(_KEY, F.struct(unit))
    ends = tagged.where(F.col(end))
    several = ends.groupBy(_KEY).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(_KEY)
    if several.isEmpty():
        return df
    edges = ends.join(several, _KEY, "left_semi").select(_KEY, _SEG, *[F.col(_q(c)).alias(f"_l{i}") for i, c in enumerate(columns)])
    carry = _segment_carry(edges, _KEY, len(columns), False)
    at = {c: i for i, c in enumerate(columns)}
    return tagged.join(carry, [_KEY, _SEG], "left").selectExpr(*[f"COALESCE({_q(c)}, `_pl{at[c]}`) AS {_q(c)}" if c in at else _q(c) for c in df.columns])


def feature_matrix(
    df: DataFrame,
    sensors: Sequence[str] | None = None,
    *,
    unit: str = "unit_id",
    cycle: str = "cycle",
    fill: str = "both",
    drop_incomplete: bool = True,
    materialize_features: bool = True,
    numbered: bool = False,
    once: bool = False,
    **feature_params,
) -> DataFrame:
    """Features (W1-W13) -> forward/back fill per unit (W14/W15) -> drop rows
    with any missing value (P6).  Units shorter than the longest requirement lose
    rows exactly as in the reference (trap T1); ``drop_incomplete=False`` keeps them.

    Frames count rows in ``cycle`` order, whatever gaps, ties (broken by a hash of the
    row) or first value ``cycle`` has; ``numbered=True`` says that it is already 1..n
    without gaps in every unit (see :func:`assign_cycle`) and saves the numbering.
    ``once=True`` says that the caller reads the result once, so it need not be stored."""
    sensors = list(sensor_columns(df) if sensors is None else sensors)
    if not numbered:
        hashed = df.withColumn("_tie", F.xxhash64(*df.columns))
        rows = assign_cycle(hashed, unit, [cycle, "_tie"], cycle=_ROW).drop("_tie").select(*df.columns, _ROW)
        kept = [c for c in df.columns if c not in (unit, cycle)]
        feats = feature_matrix(
            rows.withColumnRenamed(cycle, "_given"), sensors, unit=unit, cycle=_ROW, fill=fill, drop_incomplete=False,
            materialize_features=materialize_features, numbered=True, once=once, **feature_params
        )
        made = [c for c in feats.columns if c not in (unit, "_given", _ROW, *kept)]
        order = [_q("_given" if c == cycle else c) + " AS " + _q(c) for c in df.columns]
        feats = feats.selectExpr(*order, *[_q(c) for c in made])
        return feats.na.drop("any") if drop_incomplete else feats
    longest = feature_params.pop("longest", None)
    if fill != "none" and materialize_features:
        if longest is None:
            longest = df.agg(F.max(cycle)).first()[0] or 0
        if _one_segment(longest, sensors, **feature_params):
            # filled by the features' own windows: one exchange, one sort
            feats = temporal_features(df, sensors, unit=unit, cycle=cycle, keep_segment=True, keep_key=True, longest=longest, **feature_params)
            some = [c for c in feats.columns if c not in (unit, cycle, _SEG, _KEY)]
            feats = fill_inside(feats, some, cycle=cycle, direction=fill).drop(_SEG, _KEY)
            if not once:
                feats = materialize(feats, "features", dictionary=False)
            return feats.na.drop("any") if drop_incomplete else feats
    feats = temporal_features(df, sensors, unit=unit, cycle=cycle, keep_segment=True, longest=longest, **feature_params)
    gaps = None
    if fill != "none" and materialize_features:
        # the fill reads the features twice (per-segment edges + the rows).
        # Recomputing means running every window function twice (the costliest
        # per-row work here); writing once to the checkpoint folder costs one
        # shuffle of the wide rows instead, and also cuts the lineage.  One aggregate
        # of the stored columns finds those without a gap, which are not filled, and
        # whether every unit ends in its first segment, where nothing is carried.
        feats = materialize(feats, "features")
        some = [c for c in feats.columns if c not in (unit, cycle, _SEG)]
        counts = [F.count_if(F.col(_q(c)).isNull()).alias(f"_{i}") for i, c in enumerate(some)]
        got = feats.agg(F.max(_SEG).alias("_last"), *counts).first()
        gaps = [c for i, c in enumerate(some) if got[f"_{i}"]]
        longest = 1 if got["_last"] in (None, 0) else None
    if fill != "none" and gaps != []:
        feats = fill_gaps(feats, gaps, unit=unit, cycle=cycle, direction=fill, longest=longest if gaps is not None else None)
    feats = feats.drop(_SEG)
    return feats.na.drop("any") if drop_incomplete else feats


def last_n(df: DataFrame, n: int | Column = 10, *, unit: str = "unit_id", cycle: str = "cycle", salts: int = 64) -> DataFrame:
    """The last ``n`` rows of every unit by ``cycle`` (``n`` may be a per-row column);
    gaps do not matter and ties are broken by a hash of the row.

    Top-n in two steps: within (unit, salt) first, so a hot unit's rows are ranked in
    many tasks, then within the unit over at most ``n * salts`` rows."""
    keep = n if isinstance(n, Column) else F.lit(n)
    hashed = df.withColumn("_tie", F.xxhash64(*df.columns)).withColumn("_salt", F.pmod(F.hash("_tie"), F.lit(salts)))
    order = [F.desc(cycle), F.desc("_tie")]
    near = hashed.withColumn("_rn", F.row_number().over(Window.partitionBy(unit, "_salt").orderBy(*order))).where(F.col("_rn") <= keep)
    last = near.withColumn("_rn", F.row_number().over(Window.partitionBy(unit).orderBy(*order))).where(F.col("_rn") <= keep)
    return last.drop("_rn", "_salt", "_tie")


def last_value(df: DataFrame, value: str, *, unit: str = "unit_id", cycle: str = "cycle", alias: str | None = None):
    """The value on each unit's last cycle."""
    return df.groupBy(unit).agg(F.max_by(value, cycle).alias(alias or f"last_{value}"))
