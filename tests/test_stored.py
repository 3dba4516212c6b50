"""Stored feature layout, observed checks and batch limits."""

import json
import re
import tempfile
import uuid

from fleetlens.operators import profile as P
from fleetlens.operators import series as S
from fleetlens.sources import ingest as I
from fleetlens.sources import sinks as K


def test_no_exchange_under_the_windows_of_a_stored_table(spark):
    rows = [(u, c, float(c % 5) if c % 3 else None) for u in (1, 2, None) for c in range(1, 200)]
    df = spark.createDataFrame(rows, "unit_id int, cycle int, x double")
    stored = K.write_features(df, f"t_{uuid.uuid4().hex}", path=tempfile.mkdtemp(prefix="fleetlens-stored-") + "/t", seg_rows=16, buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        filled = S.fill_gaps(stored)
        plan = filled._jdf.queryExecution().executedPlan().toString()
        # the wide rows: from the last window down to their scan
        lines = plan.split("\n")
        start = next(i for i, text in enumerate(lines) if "Window [" in text)
        join = next(i for i, text in enumerate(lines[start:], start) if "Join" in text)
        left = lines[join + 1 :]
        scan = next(i for i, text in enumerate(left) if "FileScan" in text)
        assert "Bucketed: true" in left[scan] and not any("Exchange" in text for text in lines[start:join] + left[:scan]), plan
        got = sorted(map(tuple, filled.select("unit_id", "cycle", "x").collect()), key=str)
        want = sorted(map(tuple, S.fill_gaps(df, seg_rows=16).collect()), key=str)
        assert got == want and len(got) == len(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_checks_ride_on_the_write(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1, 1.0, 5, 0), (1, 2, None, 200, 1), (2, 2, inf, 3, 2), (None, 1, nan, 3, None), (None, 2, nan, -1, 1)]
    df = spark.createDataFrame(rows, "unit_id long, cycle int, s double, rul int, failure_label int")
    path = tempfile.mkdtemp(prefix="fleetlens-checked-") + "/t"
    got = {r.check_name: r.violations for r in P.write_checked(df, path, raw_columns=["s"], required=["s", "zz"]).collect()}
    assert got == {r.check_name: r.violations for r in P.data_checks(df, raw_columns=["s"], required=["s", "zz"]).collect()}
    assert got == {
        "missing_raw_values": 3, "infinite_values": 1, "missing_unit_id": 2, "label_not_binary": 2, "rul_out_of_range": 2,
        "first_cycle_not_1": 1, "required_columns_missing": 1, "single_class": 0,
    }
    assert K.read_table(spark, path).count() == 5
    empty = {r.check_name: r.violations for r in P.write_checked(df.where("false"), path).collect()}
    assert empty["missing_unit_id"] == 0 and empty["single_class"] == 2


def test_empty_and_too_large_batches_are_quarantined(spark):
    engine = {"unit_id": "A", "readings": [{"a": 1.0}]}
    batches = [{"engines": []}, {"engines": [engine] * 1001}, {"engines": [engine] * 1000}, {"other": 1}]
    df = spark.createDataFrame([(i, json.dumps(b)) for i, b in enumerate(batches)], "batch_id int, payload string")
    valid, quarantine = I.flatten_batch(df, sensors=["a"])
    assert valid.count() == 1000
    assert sorted((r.request_id, r.rule) for r in quarantine.collect()) == [("0", "empty_batch"), ("1", "too_many_engines"), ("3", "malformed_batch")]


def test_short_text_lines_give_nulls(spark):
    path = tempfile.mkdtemp(prefix="fleetlens-lines-")
    with open(f"{path}/a.txt", "w") as f:
        f.write("1 1 2.5\n1 2\n\n2 1 nan \n2 2 x\n")
    rows = I.read_readings(spark, path, fmt="text", schema=spark.createDataFrame([], "unit_id long, cycle int, v double").schema)
    assert sorted((r.unit_id, r.cycle, r.v) for r in rows.collect()) == [(1, 1, 2.5), (1, 2, None), (2, 1, None), (2, 2, None)]
    assert re.match("unit_id", rows.columns[0])
