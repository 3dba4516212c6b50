"""The stored drift baseline and the tests of many samples against it."""

import tempfile

import numpy as np
import pandas as pd
import pytest

from fleetlens.operators import baseline as B
from fleetlens.operators import drift as D


@pytest.fixture(scope="module")
def sides(spark):
    rng = np.random.default_rng(1)
    frame = lambda parts: spark.createDataFrame(pd.concat([pd.DataFrame({"feature": f, "value": v}) for f, v in parts]))
    early = frame([("x", rng.normal(0, 1, 3000).round(2)), ("y", rng.normal(5, 2, 2000)), ("z", np.full(100, 3.0)), ("only_base", rng.normal(size=50))])
    late = frame([("x", rng.normal(0.2, 1, 400).round(2)), ("y", rng.normal(50, 2, 300)), ("z", np.full(20, 3.0)), ("x", rng.normal(size=5)), ("few", np.ones(9)), ("only_cur", np.ones(30))])
    return early, late


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("range_rows", [7, 65_536])
def test_a_probe_gives_the_report_of_the_raw_baseline(spark, sides, range_rows):
    early, late = sides
    stored = B.store_baseline(early, tempfile.mkdtemp(), range_rows)
    assert _rows(B.drift_against(stored, late)) == _rows(D.drift_report(early, late))
    assert stored.names() == ["only_base", "x", "y", "z"]
    y = early.where("feature = 'y'").toPandas().value
    row = stored.features.where("feature = 'y'").first()
    assert row.n == len(y) and abs(row["std"] - y.std(ddof=0)) < 1e-9 and abs(row.q25 - np.percentile(y, 25)) < 1e-12


def test_merged_baselines_are_the_baseline_of_both(spark, sides):
    early, late = sides
    halves = [B.store_baseline(early.where(c), tempfile.mkdtemp(), 50) for c in ("value < 1", "value >= 1")]
    assert _rows(B.drift_against(B.merge_baselines(halves, tempfile.mkdtemp(), 50), late)) == _rows(D.drift_report(early, late))


def test_an_empty_baseline_is_not_stored(spark, sides):
    with pytest.raises(ValueError):
        B.store_baseline(sides[0].where("false"), tempfile.mkdtemp())


def test_every_sample_is_tested_on_its_own(spark, sides):
    early, _ = sides
    rng = np.random.default_rng(4)
    parts = []
    for i in range(6):
        parts.append(pd.DataFrame({"sample": i, "feature": "x", "value": rng.normal(0.3 * i, 1, 30).round(1 if i % 2 else 3)}))
        parts.append(pd.DataFrame({"sample": i, "feature": "z", "value": np.full(12, 3.0 + (i > 3))}))
    parts.append(pd.DataFrame({"sample": 9, "feature": "x", "value": np.ones(5)}))  # too few
    parts.append(pd.DataFrame({"sample": 8, "feature": "x", "value": np.full(10, -99.0)}))  # below every value
    parts.append(pd.DataFrame({"sample": 7, "feature": "x", "value": np.full(10, 99.0)}))
    samples = spark.createDataFrame(pd.concat(parts))
    stored = B.store_baseline(early, tempfile.mkdtemp(), 100)
    got = {(r["sample"], r.feature): r for r in B.drift_by_sample(stored, samples).collect()}
    assert len(got) == 14
    for (i, feature), r in got.items():
        one = samples.where((samples["sample"] == i) & (samples.feature == feature)).drop("sample")
        run, counts = D.ranked_values(early, one)
        ks = D.ks_from_ranked(run, counts).first()
        psi = D.psi_from_ranked(run, counts).first().psi
        assert abs(r.ks_stat - ks.ks_stat) < 1e-12 and abs(r.ks_pvalue - ks.ks_pvalue) < 1e-12 and abs(r.psi - psi) < 1e-9, (i, feature)
    details = {r["sample"]: r for r in B.drift_details(B.drift_by_sample(stored, samples)).collect()}
    assert details[0].total_features == 2 and [d.feature for d in details[0].details] == ["x", "z"]
    assert details[7].alert_level.startswith("CRITICAL") and 9 not in details
