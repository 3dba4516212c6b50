"""Registered stream jobs over the ``events`` table read as a file stream
(``trigger(availableNow=True)``: every file present is processed, then the
query stops).  Each run writes under its own folder of the checkpoint root."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.columns import nan_to_null
from fleetlens.operators import drift as D
from fleetlens.operators.baseline import store_baseline
from fleetlens.session import ensure_checkpoint_dir
from fleetlens.sources.tables import DRIFT_SPLIT_TS, EVENT_SENSORS, event_series
from fleetlens.streaming import jobs as J

# readings of one kind of event only: a sensor with long gaps
STREAM_SENSORS = ["value", "error_value"]
DRIFT_MIDDLE_TS = "2024-01-23 00:00:00"
#: The events arrive in this many slices of time ...
SLICES = 2
#: ... and every so many by a slice late.
LATE_EVERY = 20


def _run_dir(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/fleetlens-stream-{name}-{uuid.uuid4().hex}"


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events file as a stream source (a one-file glob: file sources need a
    directory or a pattern)."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")


def _stream_readings(stream: DataFrame) -> DataFrame:
    return stream.select(
        F.col("user_id").alias("unit_id"),
        "ts",
        "event_id",
        nan_to_null(F.col("value")).alias("value"),
        nan_to_null(F.get_json_object("props", "$.k").try_cast("double")).alias("k"),
        (F.col("event_type") == F.lit("error")).cast("int").alias("label"),
    )


def q_stream_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily accuracy of the fixed score, watermark 1 day."""
    base = _stream_readings(events_stream(spark, sf_dir))
    scored = base.select("ts", "label", (F.col("value") / (F.col("value") + F.lit(20.0))).alias("score"))
    run = _run_dir(spark, "accuracy")
    J.start_accuracy(scored, f"{run}/out", f"{run}/checkpoint").awaitTermination()
    out = J.latest_per_key(spark, f"{run}/out", ["window_start", "window_end"])
    return out.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "n",
        (F.round(F.col("accuracy") * F.lit(1e6)) / F.lit(1e6) + F.lit(0.0)).alias("accuracy"),
    )


def q_stream_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings from the split on, in two micro-batches, against the stored baseline
    of the readings before it."""
    split, middle = (F.lit(t).cast("timestamp_ntz") for t in (DRIFT_SPLIT_TS, DRIFT_MIDDLE_TS))
    run = _run_dir(spark, "drift")
    series = event_series(spark, sf_dir)
    baseline = store_baseline(D.to_long(series.where(F.col("ts") < split), EVENT_SENSORS), f"{run}/baseline")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    for part in ((F.col("ts") >= split) & (F.col("ts") < middle), F.col("ts") >= middle):
        events.where(part).write.mode("append").parquet(f"{run}/source")
        current = _stream_readings(spark.readStream.schema(events.schema).parquet(f"{run}/source"))
        J.start_drift(current, baseline, f"{run}/out", f"{run}/checkpoint", method="asymptotic").awaitTermination()
    from fleetlens.plans.queries import rounded

    # the report of every micro-batch
    return rounded(spark.read.parquet(f"{run}/out"))


def _score_fixed(df: DataFrame) -> DataFrame:
    return df.drop("ts", "event_id").withColumn("score", F.col("value") / (F.col("value") + F.lit(20.0)))


def q_stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feature (forward fill only) and the fixed score of arriving readings.

    The events come in SLICES slices of time, one run of the stream each, and every
    LATE_EVERY-th event comes a slice late; the watermark waits as long."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").where("ts is not null")
    start, end = events.agg(F.min("ts"), F.max("ts")).first()
    run = _run_dir(spark, "score")
    if start is None:
        start = end = datetime.datetime(2000, 1, 1)
    width = max((end - start).total_seconds() / SLICES, 1.0)
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6) - F.lit(start.replace(tzinfo=datetime.timezone.utc).timestamp())
    late = (F.pmod(F.xxhash64("event_id"), F.lit(LATE_EVERY)) == 0).cast("int")
    slices = events.withColumn("_slice", F.least(F.floor(seconds / F.lit(width)) + late, F.lit(SLICES - 1)))
    job = J.ScoringJob(
        spark, STREAM_SENSORS, _score_fixed, f"{run}/state", f"{run}/out", order=("ts", "event_id"),
        delay=f"INTERVAL '{int(width) + 1}' SECOND", feature_params=dict(entropy_sensors=STREAM_SENSORS), compact_every=2,
    )
    for i in range(SLICES):
        slices.where(F.col("_slice") == i).drop("_slice").write.mode("append").parquet(f"{run}/source")
        stream = _stream_readings(spark.readStream.schema(events.schema).parquet(f"{run}/source"))
        stream = stream.withColumn("error_value", F.when(F.col("label") == 1, F.col("value")))
        job.start(stream, f"{run}/checkpoint").awaitTermination()
    job.drain()
    from fleetlens.plans.queries import rounded

    return rounded(spark.read.parquet(f"{run}/out").drop("batch_id"))


REGISTRY = {
    "stream_accuracy": q_stream_accuracy,
    "stream_drift": q_stream_drift,
    "stream_score": q_stream_score,
}
