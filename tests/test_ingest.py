import json
import os
import tempfile

from fleetlens.sources import ingest as I
from fleetlens.sources import sinks as K


def test_read_space_separated_raw_file(spark):
    d = tempfile.mkdtemp(prefix="fleetlens-raw-")
    line = lambda u, c: " ".join([str(u), str(c), "-0.0007", "-0.0004", "100.0"] + [f"{i}.5" for i in range(21)]) + " "
    with open(os.path.join(d, "train.txt"), "w") as f:
        f.write("\n".join(line(u, c) for u in (1, 2) for c in (1, 2, 3)) + "\n\n")
    df = I.read_readings(spark, d, fmt="text")
    rows = df.orderBy("unit_id", "cycle").collect()
    assert len(rows) == 6 and len(df.columns) == 26
    assert rows[0]["op_setting_1"] == -0.0007 and rows[0]["T2_fan_inlet_temp"] == 0.5
    assert rows[-1]["W32_LPT_coolant_bleed"] == 20.5


def test_read_rul_truth_keeps_line_order(spark):
    d = tempfile.mkdtemp(prefix="fleetlens-rul-")
    vals = [112, 98, 69, 82, 91, 7, 145]
    with open(os.path.join(d, "RUL_X.txt"), "w") as f:
        f.write("".join(f"{v} \n" for v in vals))
    got = I.read_rul_truth(spark, d).orderBy("unit_id").collect()
    assert [(r["unit_id"], r["rul"]) for r in got] == list(enumerate(vals, start=1))


def test_payload_defaults_quarantine_and_order(spark):
    sensors = ["a", "b"]
    good = {"unit_id": "E1", "readings": [{"a": 1.0, "b": 2.0}, {"a": 3.0, "b": 4.0, "cycle": 1}, {"a": 5.0, "b": 6.0}], "use_last_n": 2}
    bad_n = {"unit_id": "E2", "readings": [{"a": 1.0, "b": 2.0}], "use_last_n": 500}
    missing = {"readings": [{"a": 1.0}, {"a": 2.0, "b": 1.0, "cycle": 0}]}
    empty = {"unit_id": "E4", "readings": []}
    payloads = [json.dumps(x) for x in (good, bad_n, missing, empty)] + ["{not json"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "request_id long, payload string")
    valid, quarantine = I.flatten_requests(I.parse_requests(df, sensors=sensors), sensors=sensors)
    v = valid.orderBy("request_id", "pos").collect()
    assert [(r["unit_id"], r["pos"], r["cycle"]) for r in v] == [("E1", 0, 1), ("E1", 1, 1), ("E1", 2, 1)]
    assert v[0]["op_setting_3"] == 100.0 and v[0]["op_setting_1"] == -0.0006
    q = {(r["request_id"], r["rule"]) for r in quarantine.collect()}
    assert (1, "use_last_n_out_of_range") in q
    assert (2, "missing_b") in q and (2, "cycle_below_1") in q
    assert (3, "no_readings") in q and (4, "malformed_request") in q
    summary = {r["rule"]: r["violations"] for r in I.quarantine_summary(quarantine, sensors).collect()}
    assert summary["missing_a"] == 0 and summary["missing_b"] == 1
    ordered = I.order_readings(valid).orderBy("pos").collect()
    assert [r["cycle"] for r in ordered] == [1, 2, 3]  # ties on the default cycle keep payload order


def test_batch_payload(spark):
    batch = {"engines": [{"unit_id": "A", "readings": [{"a": 1.0, "b": 1.0}]}, {"unit_id": "B", "readings": [{"a": 2.0, "b": 2.0}]}]}
    df = spark.createDataFrame([(json.dumps(batch),)], "payload string")
    valid, quarantine = I.flatten_batch(df, sensors=["a", "b"])
    assert sorted(r["unit_id"] for r in valid.collect()) == ["A", "B"]
    assert quarantine.count() == 0


def test_sinks_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="fleetlens-sink-")
    params = spark.createDataFrame([("a", 1.0, 2.0)], "column string, mean double, scale double")
    K.save_scaler(params, f"{d}/scaler")
    assert K.load_scaler(spark, f"{d}/scaler").collect()[0]["scale"] == 2.0
    meta = K.save_training_metadata(spark, ["f1", "f2"], f"{d}/meta", model="rf")
    assert K.feature_list(K.load_training_metadata(spark, f"{d}/meta")) == ["f1", "f2"]
    K.write_table(params, f"{d}/t")
    assert K.read_table(spark, f"{d}/t").count() == 1
