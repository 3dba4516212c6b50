import os
import tempfile
import time

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from fleetlens.operators import series as S
from fleetlens.streaming import jobs as J

PARAMS = dict(windows=(5, 10), stats=("mean", "std"), lags=(1, 3), diffs=(1,), spans=(5,), trend_window=10, entropy_sensors=[])


def _keep(df):
    return df


def test_stream_scoring_with_history_equals_batch(spark):
    rng = np.random.default_rng(11)
    src = tempfile.mkdtemp(prefix="fleetlens-stream-src-")
    n_units, per_file, files = 4, 30, 3
    allrows = []
    for f in range(files):
        rows = []
        for u in range(n_units):
            for i in range(per_file):
                t = f * per_file + i
                rows.append((u, pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=t), t, float(rng.normal(10, 2)), float(rng.normal())))
        pdf = pd.DataFrame(rows, columns=["unit_id", "ts", "event_id", "value", "k"])
        pq.write_table(pa.Table.from_pandas(pdf, preserve_index=False), os.path.join(src, f"part-{f}.parquet"), coerce_timestamps="us")
        allrows.append(pdf)
        time.sleep(1.1)  # file sources order files by modification time
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    run = tempfile.mkdtemp(prefix="fleetlens-stream-run-")
    J.start_scoring(stream, ["value", "k"], _keep, f"{run}/h", f"{run}/o", f"{run}/c", order=("ts", "event_id"), feature_params=PARAMS).awaitTermination()
    out = spark.read.parquet(f"{run}/o")
    assert out.select("batch_id").distinct().count() == files
    got = out.drop("batch_id").toPandas().sort_values(["unit_id", "cycle"]).reset_index(drop=True)

    full = spark.createDataFrame(pd.concat(allrows))
    series = S.assign_cycle(full, "unit_id", ["ts", "event_id"])
    feats = S.temporal_features(series.select("unit_id", "cycle", "value", "k"), ["value", "k"], cross=False, **PARAMS)
    exp = S.fill_gaps(feats, direction="forward").toPandas().sort_values(["unit_id", "cycle"]).reset_index(drop=True)
    assert len(got) == len(exp) == n_units * per_file * files
    for c in exp.columns:
        a, b = got[c].astype(float).values, exp[c].astype(float).values
        ok = (np.isnan(a) & np.isnan(b)) | (np.abs(a - b) <= 1e-9 * np.maximum(1, np.abs(b)))
        assert ok.all(), (c, np.where(~ok)[0][:5])


def test_accuracy_stream_drops_nothing_on_time(spark):
    pdf = pd.DataFrame({
        "ts": pd.date_range("2024-01-01", periods=48, freq="h"),
        "label": [1, 0] * 24,
        "score": [0.9, 0.1] * 12 + [0.1, 0.9] * 12,
    })
    src = tempfile.mkdtemp(prefix="fleetlens-acc-src-")
    pq.write_table(pa.Table.from_pandas(pdf, preserve_index=False), os.path.join(src, "a.parquet"), coerce_timestamps="us")
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    run = tempfile.mkdtemp(prefix="fleetlens-acc-run-")
    J.start_accuracy(stream, f"{run}/o", f"{run}/c").awaitTermination()
    got = {r["window_start"].day: (r["n"], r["accuracy"]) for r in J.latest_per_key(spark, f"{run}/o", ["window_start", "window_end"]).collect()}
    assert got == {1: (24, 1.0), 2: (24, 0.0)}


def test_batches_over_several_segments_build_features_once(spark, monkeypatch):
    rng = np.random.default_rng(5)
    # unit 2 reports a value now and then, unit 3 none, and one series has no unit
    seen = {1: 1.0, 2: 0.04, 3: 0.0, None: 0.5}
    rows = [(u, t, float(rng.normal(10, 2)) if rng.random() < share else None) for u, share in seen.items() for t in range(170) if u != 3 or t > 100]
    df = spark.createDataFrame(rows, "unit_id long, t int, value double")
    params = dict(PARAMS, lags=(1,), seg_rows=16)
    plans, write = [], J.materialize

    def watched(table, label, *args, **options):
        if label == "stream-features":
            plans.append(table._jdf.queryExecution().toString())
        return write(table, label, *args, **options)

    monkeypatch.setattr(J, "materialize", watched)
    run = tempfile.mkdtemp(prefix="fleetlens-stream-run-")
    job = J.ScoringJob(spark, ["value"], _keep, f"{run}/s", f"{run}/o", order=("t",), feature_params=params, compact_every=2)
    for i, (lo, hi) in enumerate(((0, 70), (70, 75), (75, 170))):
        job.process(df.where((F.col("t") >= lo) & (F.col("t") < hi)), i)
    # the windows run once a batch, over rows dealt once
    assert [p.split("== Physical Plan ==")[1].count("REPARTITION_BY_COL") for p in plans] == [1, 1, 1]

    got = spark.read.parquet(f"{run}/o").drop("batch_id").toPandas().sort_values(["unit_id", "cycle"]).reset_index(drop=True)
    series = S.assign_cycle(df, "unit_id", ["t"])
    feats = S.temporal_features(series, ["value"], cross=False, **params)
    made = [c for c in feats.columns if c not in ("unit_id", "t", "cycle")]
    exp = S.fill_gaps(feats, made, direction="forward").toPandas().sort_values(["unit_id", "cycle"]).reset_index(drop=True)
    assert len(got) == len(exp) == len(rows)
    for c in exp.columns:
        np.testing.assert_allclose(got[c].to_numpy(float), exp[c].to_numpy(float), atol=1e-9, err_msg=c)
    state = {r.unit_id: r for r in job.units.read(3).collect()}
    for unit in seen:
        mine = exp[exp.unit_id.isna() if unit is None else exp.unit_id == unit]
        assert state[unit].last_cycle == len(mine)
        assert [x.cycle for x in state[unit].tail] == list(range(len(mine) - job.need + 1, len(mine) + 1))
        last = mine.iloc[-1]
        np.testing.assert_allclose([np.nan if state[unit].filled[c] is None else state[unit].filled[c] for c in made], last[made].to_numpy(float), atol=1e-9)
