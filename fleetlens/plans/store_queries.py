"""Registered queries over stored artefacts: readers, sinks, column choice and checks.

Each writes a table or text derived from the driver's tables with the library's sinks,
reads it back with its readers and returns what came through."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.operators import drift as D
from fleetlens.operators import labels as L
from fleetlens.operators import metrics as M
from fleetlens.operators import profile as P
from fleetlens.operators import scoring as SC
from fleetlens.operators import series as S
from fleetlens.plans.queries import _params, readings, rounded, series
from fleetlens.session import scratch_path
from fleetlens.sources import ingest as I
from fleetlens.sources import sinks as K
from fleetlens.sources.tables import DRIFT_SPLIT_TS, EVENT_SENSORS, event_readings

SAMPLE_UNITS = 20


def q_text_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings written as space-separated text and loaded again; one unit in ten
    has lines that end before the second sensor."""
    path = scratch_path(spark, "text-readings")
    r = readings(spark, sf_dir)
    short = F.col("unit_id") % 10 == 0
    line = F.concat_ws(" ", F.col("unit_id").cast("string"), F.col("cycle").cast("string"), F.col("value").cast("string"), F.when(~short, F.col("k").cast("string")))
    r.select(F.concat(line, F.lit(" ")).alias("value")).write.text(path)
    fields = [("unit_id", T.LongType()), ("cycle", T.IntegerType()), ("value", T.DoubleType()), ("k", T.DoubleType())]
    return rounded(I.read_readings(spark, path, fmt="text", schema=T.StructType([T.StructField(n, t) for n, t in fields])))


def q_sampled_units(spark, sf_dir):
    """All rows of the first units in unit order."""
    return rounded(I.sample_units(readings(spark, sf_dir), SAMPLE_UNITS))


def q_rul_truth(spark, sf_dir):
    """S3 with L1: remaining life beyond each unit's last reading from a truth file, a
    line for each unit; the unit's number is its line's."""
    path = scratch_path(spark, "rul-truth")
    lives = P.unit_lifetimes(readings(spark, sf_dir))
    # one line a unit, as such files are: sorted, so the line number follows the unit
    lives.orderBy("unit_id").select(F.concat((F.col("lifetime") % 7).cast("string"), F.lit(" ")).alias("value")).coalesce(1).write.text(path)
    truth = I.read_rul_truth(spark, path).select(F.col("unit_id").alias("line"), F.col("rul").alias("beyond"))
    units = S.assign_cycle(lives.withColumn("_all", F.lit(0)), "_all", ["unit_id"], cycle="line").select("unit_id", F.col("line").cast("long").alias("line"))
    named = units.join(truth, "line").select("unit_id", F.col("beyond").alias("rul"))
    return L.add_rul(readings(spark, sf_dir), truth=named).select("unit_id", "cycle", "rul")


def q_stored_features(spark, sf_dir):
    """A feature table stored by (unit, run of cycles), read and filled there."""
    lagged = S.temporal_features(readings(spark, sf_dir), EVENT_SENSORS, cross=False, **_params(lags=S.DEFAULT_LAGS)).drop(*EVENT_SENSORS)
    name = f"features_{uuid.uuid4().hex}"
    stored = K.write_features(lagged, name, path=scratch_path(spark, "features"), seg_rows=32, buckets=8)
    return rounded(S.fill_gaps(stored).drop(S.KEY, S.SEG))


def q_stored_scaler(spark, sf_dir):
    """Scaler parameters stored, loaded and applied."""
    path = scratch_path(spark, "scaler")
    early = series(spark, sf_dir).where(F.col("ts") < F.lit(DRIFT_SPLIT_TS).cast("timestamp_ntz"))
    K.save_scaler(L.fit_scaler(early, EVENT_SENSORS), path)
    return rounded(L.apply_scaler(readings(spark, sf_dir), K.load_scaler(spark, path)))


def q_stored_report(spark, sf_dir):
    """An evaluation report as JSON lines."""
    from fleetlens.plans.analytics_queries import scored

    path = scratch_path(spark, "report")
    metrics = M.class_metrics(scored(spark, sf_dir))
    K.save_report(metrics, path)
    return rounded(spark.read.schema(metrics.schema).json(path))


def _catalog_features(spark, sf_dir) -> DataFrame:
    return S.temporal_features(L.placeholder_labels(readings(spark, sf_dir)), EVENT_SENSORS, cross=[("value_k_ratio", "ratio", "value", "k")])


def q_feature_list(spark, sf_dir):
    """The feature list of a training run, stored and read back."""
    path = scratch_path(spark, "metadata")
    K.save_training_metadata(spark, S.feature_columns(_catalog_features(spark, sf_dir)), path, model="none")
    return K.load_training_metadata(spark, path).select(F.posexplode("feature_names").alias("pos", "feature"))


def q_column_roles(spark, sf_dir):
    """Which columns each projection takes, in order."""
    df = _catalog_features(spark, sf_dir)
    roles = {
        "sensor": S.sensor_columns(L.placeholder_labels(readings(spark, sf_dir))),
        "classifier": S.classifier_frame(df).columns,
        "regressor": S.regressor_frame(df).columns,
        "monitored": S.monitor_features(df, 15),
    }
    rows = [(role, i, c) for role, names in roles.items() for i, c in enumerate(names)]
    return spark.createDataFrame(rows, "role string, pos int, feature string")


def q_feature_catalog(spark, sf_dir):
    """Families of features by name."""
    return P.feature_catalog(spark, S.feature_columns(_catalog_features(spark, sf_dir)))


def q_placeholder_labels(spark, sf_dir):
    """P10."""
    return L.placeholder_labels(readings(spark, sf_dir)).select("unit_id", "cycle", "rul", "failure_label")


def q_absent_features(spark, sf_dir):
    """Features that one side lacks are skipped."""
    s = series(spark, sf_dir)
    early = F.col("ts") < F.lit(DRIFT_SPLIT_TS).cast("timestamp_ntz")
    names = [*EVENT_SENSORS, "not_there"]
    return rounded(D.psi(D.to_long(s.where(early).withColumn("only_early", F.col("k")), [*names, "only_early"]), D.to_long(s.where(~early), names)).select("feature", "psi"))


def q_rolling_skew(spark, sf_dir):
    """Population skewness over trailing windows."""
    feats = S.temporal_features(readings(spark, sf_dir).drop("k"), ["value"], cross=False, **_params(windows=(10, 30), stats=("skew",)))
    return rounded(feats.drop("value"))


def q_first_units(spark, sf_dir):
    """The true state of the first units."""
    labelled = L.add_rul(readings(spark, sf_dir))
    return SC.first_units(SC.true_state(labelled))


def q_checked_write(spark, sf_dir):
    """A10 on uncleaned rows, with S4 in the same job: readings of sign-ups have no
    unit, those of errors a NaN, those of views an infinite value."""
    e = event_readings(spark, sf_dir)
    kind = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type")
    e = e.join(kind, "event_id")
    value = F.when(F.col("event_type") == "error", F.lit(float("nan"))).when(F.col("event_type") == "view", F.lit(float("inf"))).otherwise(F.col("value"))
    dirty = e.select(
        F.when(F.col("event_type") != "signup", F.col("unit_id")).alias("unit_id"), F.col("k").cast("int").alias("cycle"), value.alias("value"),
        F.when(F.col("k") > 0, F.col("k")).alias("k"), (F.col("k") % 3).cast("int").alias("failure_label"), (F.col("value") - 5).cast("int").alias("rul"),
    )
    return P.write_checked(dirty, scratch_path(spark, "checked"), raw_columns=EVENT_SENSORS, required=[*EVENT_SENSORS, "pressure"])


def q_payload_dirty(spark, sf_dir):
    """S6-S8 on faulty requests: truncated ones, ones without readings or with a
    ``use_last_n`` out of range, and readings without a sensor or with cycle 0."""
    s = series(spark, sf_dir)
    block = F.floor((F.col("cycle") - 1) / 100).alias("block")
    reading = F.struct(F.when(F.col("k") != 9, F.col("cycle").cast("long")).otherwise(F.lit(0)).alias("cycle"), "value", F.when(F.col("k") != 5, F.col("k")).alias("k"))
    sent = s.groupBy("unit_id", block).agg(F.collect_list(reading).alias("readings"))
    unit = F.col("unit_id")
    body = F.struct(
        unit.cast("string").alias("unit_id"), F.when(unit % 11 != 0, F.col("readings")).otherwise(F.slice("readings", 1, 0)).alias("readings"),
        F.when(unit % 7 != 0, F.lit(10)).otherwise(F.lit(500)).alias("use_last_n"),
    )
    text = F.to_json(body)
    requests = sent.select((unit * F.lit(1 << 20) + F.col("block")).alias("request_id"), F.when(unit % 13 != 0, text).otherwise(F.substring(text, 1, 10)).alias("payload"))
    _, quarantine = I.flatten_requests(I.parse_requests(requests, sensors=EVENT_SENSORS), sensors=EVENT_SENSORS)
    return I.quarantine_summary(quarantine, EVENT_SENSORS)


REGISTRY = {
    "payload_dirty": q_payload_dirty,
    "text_readings": q_text_readings,
    "sampled_units": q_sampled_units,
    "rul_truth": q_rul_truth,
    "stored_features": q_stored_features,
    "stored_scaler": q_stored_scaler,
    "stored_report": q_stored_report,
    "feature_list": q_feature_list,
    "column_roles": q_column_roles,
    "feature_catalog": q_feature_catalog,
    "placeholder_labels": q_placeholder_labels,
    "absent_features": q_absent_features,
    "rolling_skew": q_rolling_skew,
    "first_units": q_first_units,
    "checked_write": q_checked_write,
}
