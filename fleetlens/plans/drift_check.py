"""Drift check over a sample of readings (the request flow of the
reference's drift endpoint), composed from the library operators:
typed readings -> stored scaler -> feature matrix -> drift report vs the stored
baseline -> summary, for all requests together or for each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.operators import drift as D
from fleetlens.operators import labels as L
from fleetlens.operators import series as S
from fleetlens.operators.baseline import StoredBaseline, drift_against, drift_by_sample, drift_details
from fleetlens.session import materialize
from fleetlens.sources.ingest import order_readings

MIN_READINGS = 30


def short_requests(readings: DataFrame, min_readings: int = MIN_READINGS) -> DataFrame:
    """The requests with too few readings for a drift check."""
    sizes = readings.groupBy("request_id").agg(F.count(F.lit(1)).alias("readings"))
    return sizes.where(F.col("readings") < min_readings).select("request_id", F.lit("too_few_readings").alias("rule"), "readings")


def _request_features(readings: DataFrame, scaler_params, sensors: Sequence[str], min_readings: int, feature_params: dict) -> tuple[DataFrame, DataFrame]:
    """(features of the accepted requests with their request_id, refused requests)."""
    # parsed once: the sizes, the numbering's splitters and its rows read them
    readings = materialize(readings, "check-readings")
    short = short_requests(readings, min_readings)
    ok = readings.join(short.select("request_id"), "request_id", "left_anti")
    ordered = order_readings(ok)
    series = ordered.withColumn("series_id", F.concat_ws("|", F.col("request_id").cast("string"), F.col("unit_id").cast("string")))
    scaled = L.apply_scaler(series.select("series_id", "request_id", "cycle", *sensors), scaler_params)
    fm = S.feature_matrix(L.placeholder_labels(scaled), list(sensors), unit="series_id", cycle="cycle", numbered=True, once=True, **feature_params)
    # read several times (edges, ranks, counts): write once
    return materialize(fm, "check-features", dictionary=False), short


_NOT_FEATURES = ("series_id", "request_id", "cycle", "rul", "failure_label")


def drift_check(
    readings: DataFrame,
    scaler_params: DataFrame | dict,
    baseline: StoredBaseline | DataFrame,
    sensors: Sequence[str],
    features: Sequence[str] | None = None,
    *,
    min_readings: int = MIN_READINGS,
    method: str = "auto",
    **feature_params,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Returns (summary, report, rejected) of all accepted requests together.
    ``readings`` are the valid rows of
    :func:`fleetlens.sources.ingest.flatten_requests`; every request is its own
    series (unit 'unknown' when none is given, trap T3) ordered by (cycle,
    position).  Requests with fewer than ``min_readings`` rows are refused: ``rejected``
    has one row (request_id, rule, readings) for each."""
    fm, short = _request_features(readings, scaler_params, sensors, min_readings, feature_params)
    cols = list(features) if features is not None else [c for c in fm.columns if c not in _NOT_FEATURES]
    current = D.to_long(fm, cols)
    if isinstance(baseline, StoredBaseline):
        report = drift_against(baseline, current, method=method)
    else:
        report = D.drift_report(baseline, current, method=method)
    return D.drift_summary(report), report, short


def drift_check_requests(
    readings: DataFrame,
    scaler_params: DataFrame | dict,
    baseline: StoredBaseline,
    sensors: Sequence[str],
    features: Sequence[str] | None = None,
    *,
    min_readings: int = MIN_READINGS,
    method: str = "auto",
    **feature_params,
) -> tuple[DataFrame, DataFrame]:
    """Returns (responses, rejected): for every accepted request a row of its own with
    request_id, alert_level, total_features, drifted_features, avg_psi and ``details``
    by feature.  All requests are tested in one plan against the shared baseline."""
    fm, short = _request_features(readings, scaler_params, sensors, min_readings, feature_params)
    names = list(features) if features is not None else baseline.names()
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in names if c in fm.columns]))
    samples = fm.select("request_id", kv.alias("kv")).select("request_id", "kv.feature", "kv.value").where("value is not null and not isnan(value)")
    return drift_details(drift_by_sample(baseline, samples, "request_id", method=method), "request_id"), short
