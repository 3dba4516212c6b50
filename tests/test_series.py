import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fleetlens.operators import series as S
from tests import reference_math as RM

WINDOWS = [5, 10, 30]
LAGS = [1, 3, 10]
SPANS = [5, 20]


def _fixture(seed=7):
    rng = np.random.default_rng(seed)
    rows = []
    for unit, n in [(1, 60), (2, 400), (3, 3), (4, 1)]:
        s1 = np.cumsum(rng.normal(0, 1, n)) + 50
        s2 = rng.normal(10, 2, n)
        if unit == 2:
            s1[100:130] = 42.0  # constant stretch
            s2[200:260] = np.nan  # long gap that crosses small segments
            s2[5] = np.nan
        for i in range(n):
            rows.append((unit, i + 1, float(s1[i]), None if np.isnan(s2[i]) else float(s2[i])))
    return pd.DataFrame(rows, columns=["unit_id", "cycle", "s1", "s2"])


@pytest.fixture(scope="module")
def pdf():
    return _fixture()


@pytest.fixture(scope="module")
def sdf(spark, pdf):
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "unit_id long, cycle int, s1 double, s2 double")


def _close(a, b, tol=1e-9):
    a = np.asarray(a, dtype=float)
    b = np.asarray(b, dtype=float)
    both_nan = np.isnan(a) & np.isnan(b)
    ok = both_nan | (np.abs(a - b) <= tol * np.maximum(1.0, np.abs(b)))
    return ok.all(), np.where(~ok)[0][:5]


@pytest.mark.parametrize("seg_rows", [None, 37])
def test_features_match_pandas(spark, pdf, sdf, seg_rows):
    got = (
        S.temporal_features(
            sdf, ["s1", "s2"], windows=WINDOWS, lags=LAGS, spans=SPANS, entropy_sensors=["s1"], cross=False, seg_rows=seg_rows
        )
        .toPandas()
        .sort_values(["unit_id", "cycle"])
        .reset_index(drop=True)
    )
    exp = RM.features(pdf, ["s1", "s2"], windows=WINDOWS, lags=LAGS, spans=SPANS, entropy_sensors=["s1"])
    exp = exp.sort_values(["unit_id", "cycle"]).reset_index(drop=True)
    skip = {"s2_slope_10"}  # the reference's polyfit cannot take missing values
    for c in exp.columns:
        if c in skip or c not in got.columns:
            continue
        ok, bad = _close(got[c], exp[c])
        assert ok, (c, bad, got[c].values[bad], exp[c].values[bad])
    assert [c for c in exp.columns if c not in skip] == [c for c in got.columns if c not in skip]


def test_segment_size_does_not_change_results(spark, sdf):
    kw = dict(windows=WINDOWS, lags=LAGS, spans=SPANS, cross=False)
    a = S.feature_matrix(sdf, ["s1", "s2"], **kw).toPandas().sort_values(["unit_id", "cycle"]).reset_index(drop=True)
    b = S.feature_matrix(sdf, ["s1", "s2"], seg_rows=11, **kw).toPandas().sort_values(["unit_id", "cycle"]).reset_index(drop=True)
    assert list(a.columns) == list(b.columns)
    assert len(a) == len(b) > 0
    for c in a.columns:
        ok, bad = _close(a[c], b[c], 1e-9)
        assert ok, (c, bad)


def test_fill_matches_pandas_across_segments(spark, pdf, sdf):
    lagged = S.temporal_features(sdf, ["s2"], windows=[], lags=[3], diffs=[], spans=[], trend_window=None, entropy_sensors=[], cross=False)
    got = S.fill_gaps(lagged, seg_rows=7).toPandas().sort_values(["unit_id", "cycle"]).reset_index(drop=True)
    base = pdf[["unit_id", "cycle", "s2"]].copy()
    base["s2_lag_3"] = base.groupby("unit_id")["s2"].shift(3)
    exp = RM.fill(base).sort_values(["unit_id", "cycle"]).reset_index(drop=True)
    for c in ["s2", "s2_lag_3"]:
        ok, bad = _close(got[c], exp[c])
        assert ok, (c, bad)


def test_forward_only_fill_keeps_leading_gaps(spark, sdf):
    lagged = S.temporal_features(sdf, ["s1"], windows=[], lags=[2], diffs=[], spans=[], trend_window=None, entropy_sensors=[], cross=False)
    got = S.fill_gaps(lagged, direction="forward").where("unit_id = 1").orderBy("cycle").toPandas()
    assert got["s1_lag_2"].isna().sum() == 2


def test_feature_matrix_drops_short_units_and_has_no_gaps(spark, sdf):
    fm = S.feature_matrix(sdf, ["s1", "s2"], windows=WINDOWS, lags=LAGS, spans=SPANS, cross=False).toPandas()
    # units 3 and 4 are shorter than window 30's minimum of 15 rows: nothing to fill from
    assert set(fm["unit_id"]) == {1, 2}
    assert not fm.isna().any().any()
    assert not np.isinf(fm.select_dtypes("number").values).any()


def test_constant_sensor_entropy_std_slope_zero(spark):
    df = spark.createDataFrame([(1, i + 1, 5.0) for i in range(25)], "unit_id long, cycle int, c double")
    out = S.temporal_features(df, ["c"], windows=[5], lags=[], diffs=[], spans=[], entropy_sensors=["c"], cross=False).toPandas()
    tail = out[out.cycle >= 10]
    assert (tail["c_roll_std_5"] == 0).all()
    assert (tail["c_entropy_10"] == 0).all()
    assert (tail["c_slope_10"] == 0).all()


def test_cross_features_zero_denominator_is_null(spark):
    df = spark.createDataFrame(
        [(1, 1, 10.0, 0.0, 5.0, 2.0, 3.0, 0.0), (1, 2, 12.0, 4.0, 6.0, 1.0, 3.0, 1.5)],
        "unit_id long, cycle int, P30_HPC_outlet_pressure double, P2_fan_inlet_pressure double, "
        "T50_LPT_outlet_temp double, T30_HPC_outlet_temp double, Nf_fan_speed double, Nc_core_speed double",
    )
    out = df.select("cycle", *[e.alias(n) for n, e in S.cross_sensor_columns(df.columns)]).orderBy("cycle").collect()
    assert out[0]["pressure_ratio_30_2"] is None and out[0]["fan_core_speed_ratio"] is None
    assert out[1]["pressure_ratio_30_2"] == 3.0 and out[1]["temp_diff_50_30"] == 5.0
    assert out[1]["fan_core_speed_ratio"] == 2.0


def test_assign_cycle_matches_row_number_with_hot_unit(spark):
    rng = np.random.default_rng(3)
    n = 6000
    units = np.where(rng.random(n) < 0.34, 7, rng.integers(0, 50, n))  # unit 7 holds a third
    ts = rng.integers(0, 10_000_000, n)
    pdf = pd.DataFrame({"unit_id": units.astype("int64"), "ts": ts.astype("int64"), "eid": np.arange(n, dtype="int64")})
    df = spark.createDataFrame(pdf)
    got = S.assign_cycle(df, "unit_id", ["ts", "eid"], partitions=16).toPandas().sort_values("eid")
    exp = pdf.sort_values(["unit_id", "ts", "eid"]).groupby("unit_id").cumcount() + 1
    assert (got["cycle"].values == exp.sort_index().values).all()


def test_last_n_and_last_value(spark, sdf):
    tail = S.last_n(sdf, 10).groupBy("unit_id").agg(F.count("*").alias("n"), F.min("cycle").alias("lo")).toPandas()
    got = dict(zip(tail.unit_id, tail.n))
    assert got == {1: 10, 2: 10, 3: 3, 4: 1}
    last = {r["unit_id"]: r["last_s1"] for r in S.last_value(sdf, "s1").collect()}
    assert len(last) == 4


def test_column_selection_helpers(spark):
    df = spark.createDataFrame([(1, 1, 0.0, 1, 0.5, 0.1, 2.0)], "unit_id long, cycle int, op_setting_1 double, rul int, failure_label double, a double, b double")
    assert S.sensor_columns(df) == ["a", "b"]
    assert S.feature_columns(df) == ["op_setting_1", "a", "b"]
    assert S.classifier_frame(df).columns[-1] == "failure_label"
    assert S.regressor_frame(df).columns[-1] == "rul"


def test_windows_never_partition_by_unit_alone(spark, sdf):
    """Skew guard: every per-row window of the feature build is keyed by
    (unit, segment); only the small per-segment carry tables use unit alone."""
    feats = S.temporal_features(sdf, ["s1", "s2"], windows=WINDOWS, lags=LAGS, spans=SPANS, cross=False)
    plan = feats._jdf.queryExecution().executedPlan().toString()
    import re

    parts = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[", plan)
    assert parts, plan[:2000]
    per_row = [p for p in parts if "_seg" in p]
    assert per_row, parts
    # windows partitioned by the unit alone run over the per-segment carry table
    for p in parts:
        if "_seg" not in p:
            assert "unit_id" in p


def test_segments_bound_task_size_for_a_hot_unit(spark):
    n = 5000
    df = spark.createDataFrame([(7, i + 1, float(i % 13)) for i in range(n)], "unit_id long, cycle int, x double")
    seg = S.segment(df, "cycle", 500, 29)
    sizes = [r["count"] for r in seg.groupBy("unit_id", "_seg").count().collect()]
    # ten segments of 500 own rows (+ up to 29 halo copies); the last halo lands
    # in an 11th, halo-only partition that the build drops
    assert max(sizes) <= 500 + 29 and len(sizes) == 11
    own = [r["count"] for r in seg.where("_own").groupBy("unit_id", "_seg").count().collect()]
    assert sorted(own) == [500] * 10


def test_two_level_carries_match_pandas(spark, pdf, sdf, monkeypatch):
    """Tiny segments and groups: unit 2 (400 rows) has 100 segments of 4 rows,
    the EWMA carry groups hold 27 segments (its halo), the fill groups 3, so
    carries cross group borders."""
    monkeypatch.setattr(S, "SUPER_ROWS", 3)
    got = (
        S.temporal_features(sdf, ["s1", "s2"], windows=[5], lags=[3], spans=[5], entropy_sensors=[], trend_window=None, cross=False, seg_rows=3)
        .toPandas().sort_values(["unit_id", "cycle"]).reset_index(drop=True)
    )
    exp = RM.features(pdf, ["s1", "s2"], windows=[5], lags=[3], spans=[5], entropy_sensors=[])
    exp = exp.sort_values(["unit_id", "cycle"]).reset_index(drop=True)
    for c in [c for c in got.columns if "_ewm_" in c]:
        ok, bad = _close(got[c], exp[c])
        assert ok, (c, bad)
    lagged = S.temporal_features(sdf, ["s2"], windows=[], lags=[3], diffs=[], spans=[], trend_window=None, entropy_sensors=[], cross=False)
    filled = S.fill_gaps(lagged, seg_rows=5).toPandas().sort_values(["unit_id", "cycle"]).reset_index(drop=True)
    base = pdf[["unit_id", "cycle", "s2"]].copy()
    base["s2_lag_3"] = base.groupby("unit_id")["s2"].shift(3)
    ref = RM.fill(base).sort_values(["unit_id", "cycle"]).reset_index(drop=True)
    for c in ["s2", "s2_lag_3"]:
        ok, bad = _close(filled[c], ref[c])
        assert ok, (c, bad)


def test_last_n_counts_rows_with_gaps_and_ties(spark):
    gaps = [(1, 2 * i + 1, float(i)) for i in range(200)]
    ties = [(2, 1, float(i)) for i in range(50)]
    df = spark.createDataFrame(gaps + ties, "unit_id int, cycle int, v double")
    got = S.last_n(df, 10).groupBy("unit_id").agg(F.count("*").alias("n"), F.min("cycle").alias("lo")).orderBy("unit_id").collect()
    assert [(r.n, r.lo) for r in got] == [(10, 381), (10, 1)]


def test_feature_matrix_counts_rows_whatever_the_cycle_values(spark, pdf):
    kw = dict(windows=WINDOWS, lags=LAGS, spans=SPANS, cross=False)
    one = pdf[pdf.unit_id == 1]
    dense = S.feature_matrix(spark.createDataFrame(one), ["s1"], numbered=True, **kw).orderBy("cycle").toPandas()
    odd = one.assign(cycle=one.cycle * 2 + 7)
    got = S.feature_matrix(spark.createDataFrame(odd), ["s1"], seg_rows=31, **kw).orderBy("cycle").toPandas()
    assert list(got.columns) == list(dense.columns) and len(got) == len(dense) > 0
    assert (got["cycle"] == dense["cycle"] * 2 + 7).all()
    for c in dense.columns.drop("cycle"):
        ok, bad = _close(got[c], dense[c], 1e-9)
        assert ok, (c, bad)
    tied = S.feature_matrix(spark.createDataFrame(one.assign(cycle=1)), ["s1"], drop_incomplete=False, **kw).toPandas()
    assert len(tied) == len(one) and (tied["cycle"] == 1).all()


def test_weighted_mean_stays_finite_beside_long_windows(spark):
    x = [float((i * 37) % 101) for i in range(3000)]
    df = spark.createDataFrame([(1, i + 1, v) for i, v in enumerate(x)], "unit_id long, cycle int, s double")
    got = S.temporal_features(df, ["s"], windows=(2000,), lags=(1,), diffs=(), spans=(5,), cross=False).orderBy("cycle").toPandas()
    want = pd.Series(x).ewm(span=5).mean()
    assert np.allclose(got["s_ewm_5"], want, rtol=1e-9)
    assert np.allclose(got["s_roll_mean_2000"][1999:], pd.Series(x).rolling(2000).mean()[1999:])
    names = list(got.columns)
    assert names.index("s_lag_1") < names.index("s_ewm_5") < names.index("s_slope_10")


def test_hot_unit_is_dealt_by_segment_under_the_windows(spark):
    from pyspark.sql import functions as F

    from fleetlens.operators import labels as L

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(20000).select(F.lit(7).alias("unit_id"), (F.col("id") + 1).cast("int").alias("cycle"), F.rand(1).alias("s"))
        out = S.temporal_features(L.add_rul(df, cap=None), ["s"], windows=(5,), lags=(), diffs=(), spans=(), trend_window=None,
                                  entropy_sensors=[], cross=False, seg_rows=500)
        plan = out._jdf.queryExecution().executedPlan().toString()
        under = plan[plan.index("Window ") :]
        first = under[under.index("Exchange") :].split("\n")[0]
        assert "_seg" in first, plan
        rows = out.select("unit_id", "cycle", "rul").where("rul <> 20000 - cycle").count()
        assert rows == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_units_of_one_segment_are_filled_by_the_feature_windows(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(u, i + 1, float(rng.normal()) if rng.random() < 0.4 else None) for u in (1, 2, None) for i in range(60)]
    df = spark.createDataFrame(rows, "unit_id int, cycle int, x double")
    params = dict(windows=(5,), lags=(2,), diffs=(1,), spans=(5,), trend_window=None, entropy_sensors=[], cross=False)
    plans, write = [], S.materialize

    def watched(table, label="stage", *args, **options):
        if label == "features":
            plans.append(table._jdf.queryExecution().toString().split("== Physical Plan ==")[1])
        return write(table, label, *args, **options)

    monkeypatch.setattr(S, "materialize", watched)
    read = lambda d: {(r.unit_id, r.cycle): r.asDict() for r in d.collect()}
    got = S.feature_matrix(df, ["x"], numbered=True, drop_incomplete=False, **params)
    # stored filled: reading it needs no further exchange
    assert "Exchange" not in got._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plans[0].count("REPARTITION_BY_COL") == 1
    # the same rows as from many segments, and as from the two steps
    short = S.feature_matrix(df, ["x"], numbered=True, drop_incomplete=False, seg_rows=16, **params)
    steps = S.fill_gaps(S.temporal_features(df, ["x"], **params))
    one, many, two = read(got), read(short), read(steps)
    assert len(one) == len(rows) and one.keys() == many.keys() == two.keys()
    for key, row in one.items():
        assert list(row) == list(many[key]) == list(two[key])
        for c, v in row.items():
            for other in (many[key][c], two[key][c]):
                assert v == other or abs(v - other) < 1e-9, (key, c)
    assert read(S.feature_matrix(df, ["x"], numbered=True, once=True, **params)).keys() == {k for k, r in one.items() if None not in [v for c, v in r.items() if c != "unit_id"] and r["unit_id"] is not None}
