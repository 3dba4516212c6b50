import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from fleetlens.operators import labels as L
from fleetlens.operators import profile as P


def _units(spark, lengths):
    rows = [(u, c, float(c * u), float(u)) for u, n in lengths.items() for c in range(1, n + 1)]
    return spark.createDataFrame(rows, "unit_id long, cycle int, s1 double, s2 double")


def test_rul_capped_and_labels(spark):
    df = _units(spark, {1: 200, 2: 20})
    out = L.add_failure_label(L.add_rul(df)).toPandas()
    assert out["rul"].min() == 0 and out["rul"].max() == 125
    last = out.sort_values("cycle").groupby("unit_id").tail(1)
    assert (last["rul"] == 0).all()
    u2 = out[out.unit_id == 2].sort_values("cycle")
    assert list(u2["rul"]) == list(range(19, -1, -1))
    assert set(out["failure_label"]) == {0, 1}
    assert ((out["rul"] <= 30) == (out["failure_label"] == 1)).all()


def test_rul_with_truth_table(spark):
    df = _units(spark, {1: 5, 2: 5})
    truth = spark.createDataFrame([(1, 10), (2, 200)], "unit_id long, rul int")
    out = L.add_rul(df, truth=truth).toPandas()
    assert out[(out.unit_id == 1) & (out.cycle == 5)]["rul"].item() == 10
    assert out[out.unit_id == 2]["rul"].max() == 125


def test_scaler_population_std_and_constant_column(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (4.0, 7.0)], "a double, c double")
    params = {r["column"]: (r["mean"], r["scale"]) for r in L.fit_scaler(df, ["a", "c"]).collect()}
    assert abs(params["a"][1] - np.std([1, 2, 4])) < 1e-12  # population, not sample
    assert params["c"][1] == 1.0
    scaled = L.apply_scaler(df, params).toPandas()
    assert abs(scaled["a"].mean()) < 1e-12 and (scaled["c"] == 0).all()


def test_lifetime_summary_matches_pandas(spark):
    lengths = {1: 10, 2: 31, 3: 7, 4: 100}
    out = P.lifetime_summary(_units(spark, lengths)).collect()[0]
    v = np.array(list(lengths.values()))
    assert out["n_units"] == 4 and out["n_rows"] == v.sum()
    assert out["median_lifetime"] == np.median(v)
    assert out["min_lifetime"] == 7 and out["max_lifetime"] == 100
    assert abs(out["mean_lifetime"] - v.mean()) < 1e-12


def test_sensor_profile_matches_pandas(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"a": rng.normal(size=500), "b": rng.exponential(size=500)})
    out = {r["sensor"]: r for r in P.sensor_profile(spark.createDataFrame(pdf), ["a", "b"]).collect()}
    for c in "ab":
        assert abs(out[c]["mean"] - pdf[c].mean()) < 1e-12
        assert abs(out[c]["std"] - pdf[c].std()) < 1e-12
        assert out[c]["min"] == pdf[c].min() and out[c]["max"] == pdf[c].max()


def test_data_checks_flag_violations(spark):
    df = spark.createDataFrame(
        [(1, 1, 1.0, 5, 0), (1, 2, None, 200, 1), (2, 2, float("inf"), 3, 2)],
        "unit_id long, cycle int, s double, rul int, failure_label int",
    )
    got = {r["check_name"]: r["violations"] for r in P.data_checks(df, raw_columns=["s"], required=["s", "zz"]).collect()}
    assert got["missing_raw_values"] == 1
    assert got["infinite_values"] == 1
    assert got["first_cycle_not_1"] == 1
    assert got["label_not_binary"] == 1
    assert got["rul_out_of_range"] == 1
    assert got["required_columns_missing"] == 1
    assert got["single_class"] == 0
    assert got["missing_unit_id"] == 0


def test_label_balance(spark):
    df = spark.createDataFrame([("train", 1), ("train", 0), ("train", 0), ("test", 1)], "split string, failure_label int")
    got = {r["split"]: r for r in P.label_balance(df).collect()}
    assert got["train"]["n_failure"] == 1 and got["train"]["n_healthy"] == 2
    assert abs(got["train"]["failure_rate_pct"] - 100 / 3) < 1e-9


def test_feature_catalog_overlapping_families(spark):
    names = ["T30", "T30_roll_mean_5", "T30_lag_1", "T30_diff_1", "T30_ewm_5", "T30_slope_10", "T30_entropy_10",
             "temp_diff_50_30", "pressure_ratio_30_2"]
    got = {r["family"]: r["n_features"] for r in P.feature_catalog(spark, names).collect()}
    assert got["Original sensors"] == 1
    assert got["Rate of change"] == 2  # temp_diff_50_30 is also a cross-sensor feature
    assert got["Cross-sensor"] == 2


def test_placeholder_labels_and_monitor_subset(spark):
    from fleetlens.operators.series import monitor_features

    df = spark.createDataFrame([(1, 1, 2.0, 3.0, 4.0)], "unit_id long, cycle int, a double, a_roll_mean_5 double, a_lag_1 double")
    out = L.placeholder_labels(df)
    r = out.collect()[0]
    assert r["rul"] == 0 and r["failure_label"] == 0
    assert monitor_features(out) == ["a"]


def test_sample_units(spark):
    from fleetlens.sources.ingest import sample_units

    df = _units(spark, {5: 3, 1: 2, 9: 4, 2: 1})
    got = sample_units(df, 2).toPandas()
    assert sorted(got["unit_id"].unique()) == [1, 2] and len(got) == 3


def test_rul_keeps_rows_without_a_unit(spark):
    df = spark.createDataFrame([(1, 1), (1, 9000), (None, 3), (None, 5)], "unit_id long, cycle int")
    got = {(r.unit_id, r.cycle): r.rul for r in L.add_rul(df, cap=None).collect()}
    assert got == {(1, 1): 8999, (1, 9000): 0, (None, 3): 2, (None, 5): 0}
