"""State between micro-batches, exact p-values, selection and the ranges of the rank tool."""

import itertools
import math
import os
import tempfile
import time

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fleetlens.functions.ks_exact import exact_pvalue
from fleetlens.operators import drift as D
from fleetlens.operators import series as S
from fleetlens.plans.prefix import exact_quantiles, prefix_sums, range_count, rank_ladder
from fleetlens.streaming import jobs as J
from fleetlens.streaming.state import StateTable
from tests import reference_math as RM

NONE = dict(windows=(), lags=(), diffs=(), spans=(), trend_window=None, entropy_sensors=[])
PARAMS = dict(windows=(5,), stats=("mean",), lags=(2,), diffs=(1,), spans=(5,), trend_window=None, entropy_sensors=[])


@pytest.mark.parametrize("seg_rows", [None, 64])
def test_weighted_means_over_any_gap_equal_pandas(spark, seg_rows):
    rng = np.random.default_rng(0)
    long_gap = [(1, i + 1, float(rng.normal(5, 2)) if i < 300 or i == 8800 else None) for i in range(9000)]
    no_unit = [(None, i + 1, float(rng.normal(5, 2)) if rng.random() < 0.3 else None) for i in range(700)]
    empty = [(3, i + 1, None) for i in range(50)]
    rows, spans = long_gap + no_unit + empty, [1, 5, 20, 300.0]
    df = spark.createDataFrame(rows, "unit_id int, cycle int, x double")
    got = S.temporal_features(df, ["x"], cross=False, seg_rows=seg_rows, **{**NONE, "spans": spans}).toPandas()
    assert len(got) == len(rows)
    for unit, part in ((1, long_gap), (None, no_unit), (3, empty)):
        mine = got[got.unit_id.isna() if unit is None else got.unit_id == unit].sort_values("cycle")
        x = pd.Series([r[2] for r in part], dtype=float)
        for span in spans:
            want = x.ewm(span=span, adjust=True, min_periods=1).mean().to_numpy()
            np.testing.assert_allclose(mine[f"x_ewm_{span}"].to_numpy(float), want, rtol=0, atol=1e-9)


def test_features_go_on_from_context_and_state(spark):
    rng = np.random.default_rng(1)
    rows = [(u, i + 1, float(rng.normal()) if rng.random() < 0.5 else None) for u in (1, 2, None) for i in range(120)]
    df = spark.createDataFrame(rows, "unit_id int, cycle int, x double")
    whole = {(r.unit_id, r.cycle): r for r in S.temporal_features(df, ["x"], cross=False, seg_rows=16, **PARAMS).collect()}
    head = S.temporal_features(df.where("cycle <= 77"), ["x"], cross=False, seg_rows=16, keep_state=True, **PARAMS)
    rest = S.temporal_features(
        df.where("cycle > 77"), ["x"], cross=False, seg_rows=16, context=df.where("cycle > 72 and cycle <= 77"), ewma_state=head.where("cycle = 77").select("unit_id", "_s0"), **PARAMS
    ).collect()
    assert len(rest) == 3 * 43
    for r in rest:
        for a, b in zip(r, whole[(r.unit_id, r.cycle)]):
            assert a == b or abs(a - b) < 1e-12


def test_rows_without_a_unit_are_numbered_and_kept(spark):
    df = spark.createDataFrame([(None, 5), (None, 6), (1, 7), (1, 2)], "unit_id int, t int")
    got = S.assign_cycle(df, "unit_id", ["t"]).collect()
    assert sorted((r.unit_id or 0, r.t, r.cycle) for r in got) == [(0, 5, 1), (0, 6, 2), (1, 2, 1), (1, 7, 2)]


def test_cross_features_by_table_and_by_dict(spark):
    df = spark.createDataFrame([(1, 1, 6.0, 3.0), (1, 2, 1.0, 0.0)], "unit_id int, cycle int, a double, b double")
    for cross in ({"ratios": [("r", "a", "b")], "differences": [("d", "a", "b")]}, [("r", "ratio", "a", "b"), ("d", "difference", "a", "b")]):
        got = S.temporal_features(df, ["a", "b"], cross=cross, **NONE).orderBy("cycle").collect()
        assert [(x.r, x.d) for x in got] == [(2.0, 3.0), (None, 1.0)]
    made = S.feature_matrix(df, ["a", "b"], numbered=True, cross={"ratios": [("r", "a", "b")]}, drop_incomplete=False, **NONE)
    assert "r" in made.columns and made.count() == 2


def _file(folder, i, rows):
    pdf = pd.DataFrame(rows, columns=["unit_id", "ts", "event_id", "value"])
    table = pa.Table.from_pandas(pdf, schema=pa.schema([("unit_id", pa.int64()), ("ts", pa.timestamp("us")), ("event_id", pa.int64()), ("value", pa.float64())]), preserve_index=False)
    pq.write_table(table, os.path.join(folder, f"part-{i}.parquet"))
    time.sleep(1.1)  # file sources order files by modification time


def test_stream_with_gaps_and_late_rows_equals_the_batch(spark):
    rng = np.random.default_rng(3)
    start = pd.Timestamp("2024-01-01")
    rows = []
    for t in range(150):
        for u in (1, 2):
            # unit 1 reports a value at first, then nothing for longer than any frame
            value = float(rng.normal(10, 2)) if u == 2 or t < 10 or t == 140 else None
            rows.append((u, start + pd.Timedelta(minutes=t), 1000 * u + t, value))
    at = lambda r: (r[1] - start).total_seconds() / 60
    late = [r for r in rows if at(r) in (35, 36, 71)]
    lost = (2, start + pd.Timedelta(minutes=3), 9999, 1.0)
    files = [[r for r in rows if lo <= at(r) < lo + 50 and r not in late] for lo in (0, 50, 100)]
    files[1] += [r for r in late if at(r) < 50]
    files[2] += [r for r in late if at(r) >= 50] + [lost]
    src, run = tempfile.mkdtemp(prefix="fleetlens-src-"), tempfile.mkdtemp(prefix="fleetlens-run-")
    for i, part in enumerate(files):
        _file(src, i, part)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 1).parquet(src)
    job = J.ScoringJob(spark, ["value"], lambda df: df, f"{run}/s", f"{run}/o", order=("ts", "event_id"), delay="INTERVAL 40 MINUTES", feature_params=PARAMS, compact_every=2)
    job.start(stream, f"{run}/c").awaitTermination()
    job.drain()
    got = spark.read.parquet(f"{run}/o").toPandas().sort_values(["unit_id", "cycle"]).reset_index(drop=True)
    assert got.batch_id.nunique() == 4
    series = S.assign_cycle(spark.createDataFrame([(u, t.to_pydatetime(), e, v) for u, t, e, v in rows], "unit_id long, ts timestamp, event_id long, value double"), "unit_id", ["ts", "event_id"])
    feats = S.temporal_features(series.select("unit_id", "cycle", "value"), ["value"], cross=False, **PARAMS)
    want = S.fill_gaps(feats, direction="forward").toPandas().sort_values(["unit_id", "cycle"]).reset_index(drop=True)
    assert len(got) == len(want) == len(rows)
    for c in want.columns:
        np.testing.assert_allclose(got[c].to_numpy(float), want[c].to_numpy(float), atol=1e-9)
    assert [r.event_id for r in spark.read.parquet(f"{run}/s/late").collect()] == [9999]


def test_state_table_gives_the_latest_row_of_a_key(spark):
    path = tempfile.mkdtemp(prefix="fleetlens-state-")
    table = StateTable(spark, path, "k", compact_every=2)
    assert table.read(0) is None
    for i in range(7):
        table.upsert(spark.createDataFrame([(i % 3, i), (None, 10 * i)], "k int, v int"), i)
    now = lambda before: sorted((-1 if r.k is None else r.k, r.v) for r in table.read(before).collect())
    assert now(7) == [(-1, 60), (0, 6), (1, 4), (2, 5)] and now(6) == [(-1, 50), (0, 3), (1, 4), (2, 5)]
    table.upsert(spark.createDataFrame([(0, 99)], "k int, v int"), 6)  # replayed
    assert now(6) == [(-1, 50), (0, 3), (1, 4), (2, 5)] and now(7)[1] == (0, 99)


def _share_of_walks(h, m, n):
    far = total = 0
    for ups in itertools.combinations(range(m + n), m):
        i = j = widest = 0
        for k in range(m + n):
            i, j = (i + 1, j) if k in ups else (i, j + 1)
            widest = max(widest, abs(i * n - j * m))
        total += 1
        far += widest >= h
    return far / total


@pytest.mark.parametrize("m,n", [(3, 4), (5, 5), (2, 7), (6, 4), (1, 1)])
def test_exact_pvalues_equal_enumeration(m, n):
    for h in range(0, m * n + 1, math.gcd(m, n)):
        assert abs(exact_pvalue(h / (m * n), m, n) - _share_of_walks(h, m, n)) < 1e-12


def test_ks_mode_follows_the_sample_size(spark):
    df = spark.createDataFrame([(0.25, 30, 200), (0.25, 30, 20_000)], "d double, n1 long, n2 long")
    got = df.select(*[D.ks_pvalue(F.col("d"), F.col("n1"), F.col("n2"), m).alias(m) for m in ("auto", "exact", "asymptotic")]).collect()
    assert abs(got[0].auto - 0.0641283) < 1e-6 and got[0].auto == got[0].exact
    assert got[1].exact is None and got[1].auto == got[1].asymptotic


def test_selection_lists_little_and_is_exact(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 30_000), "v": rng.normal(size=30_000).round(3)})
    pdf.loc[:9_000, "v"] = 0.25  # one value holds a third of the rows
    df, probs = spark.createDataFrame(pdf), [0.0, 0.1, 0.25, 0.5, 0.93, 1.0]
    for options in ({}, dict(accuracy=200, whole_rows=100), dict(accuracy=50, whole_rows=100, buckets=5)):
        for r in exact_quantiles(df, ["g"], "v", probs, **options).collect():
            for i, p in enumerate(probs):
                assert abs(r[f"q_{i}"] - np.percentile(pdf[pdf.g == r.g].v, 100 * p)) < 1e-12
    ladder = rank_ladder(df.withColumn("c", F.lit(1)), ["g"], "v", ["c"], probs, accuracy=500, whole_rows=100)
    assert ladder.count() < 0.2 * df.distinct().count() and ladder.agg(F.sum("c")).first()[0] == len(pdf)


def test_psi_by_selection_equals_numpy(spark):
    rng = np.random.default_rng(6)
    a, b = rng.normal(0, 1, 20_000).round(2), rng.normal(0.3, 1.2, 15_000).round(2)
    long = lambda v: spark.createDataFrame(pd.DataFrame({"feature": "f", "value": v}))
    got = D.psi(long(a), long(b), accuracy=400, whole_rows=1000).first().psi
    assert abs(got - RM.psi(a, b)) < 1e-9


def test_ranges_grow_with_the_rows_and_need_no_nested_loop(spark):
    assert [range_count(n, 1000) for n in (0, 1000, 1001, 1_000_000)] == [1, 1, 2, 1000]
    df = spark.range(5000).select(F.col("id").cast("double").alias("v"), F.lit(1).cast("long").alias("w"))
    out = prefix_sums(df, [], "v", ["w"], range_rows=100)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert out.where("cum_w <> v + 1 or tot_w <> 5000").count() == 0


def test_an_empty_baseline_is_an_error(spark):
    empty = spark.createDataFrame([], "feature string, value double")
    with pytest.raises(ValueError):
        D.drift_report(empty, spark.createDataFrame([("f", float(i)) for i in range(20)], "feature string, value double"))
