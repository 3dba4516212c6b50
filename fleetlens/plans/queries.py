"""Registered queries: each is ``(spark, sf_dir) -> DataFrame`` over the driver's
tables, built from the library operators.  Double outputs are rounded to 6
decimals (the oracle SQL does the same) so engines agree to the last digit."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.operators import labels as L
from fleetlens.operators import series as S
from fleetlens.sources.tables import DRIFT_SPLIT_TS, EVENT_SENSORS, event_series, longest_series

R = 6


def round_half_away(c, digits: int = R):
    """round(x * 10^d) / 10^d, half away from zero, on the binary value -- the same
    arithmetic as the SQL oracle's ROUND, so both engines agree on ties; + 0.0
    maps -0.0 to 0.0."""
    scale = float(10**digits)
    x = c * F.lit(scale)
    # F.round goes through decimal text; ties are exact in a double, so rint needs help there only
    whole = F.when(F.abs(x - F.rint(x)) == F.lit(0.5), x + F.signum(x) * F.lit(0.5)).otherwise(F.rint(x))
    return whole / F.lit(scale) + F.lit(0.0)


def rounded(df: DataFrame, digits: int = R) -> DataFrame:
    """Round every DOUBLE column (float noise below 1e-6 is not a result)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round_half_away(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_series(spark, sf_dir)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series(spark, sf_dir).select("unit_id", "cycle", *EVENT_SENSORS)


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings + remaining life (capped) + failure label (L1-L3)."""
    return L.add_failure_label(L.add_rul(readings(spark, sf_dir)))


def _family(spark, sf_dir, pick, **params) -> DataFrame:
    base = readings(spark, sf_dir)
    feats = S.temporal_features(base, EVENT_SENSORS, cross=False, longest=longest_series(spark, sf_dir), **params)
    return rounded(feats.select("unit_id", "cycle", *[c for c in feats.columns if pick(c)]))


_NO_FAMILIES = dict(windows=(), lags=(), diffs=(), spans=(), trend_window=None, entropy_sensors=[])


def _params(**over):
    p = dict(_NO_FAMILIES)
    p.update(over)
    return p


def q_rolling(stat: str):
    def run(spark, sf_dir):
        return _family(
            spark, sf_dir, lambda c: f"_roll_{stat}_" in c, **_params(windows=S.DEFAULT_WINDOWS, stats=(stat,))
        )

    return run


def q_lag_features(spark, sf_dir):
    return _family(spark, sf_dir, lambda c: "_lag_" in c, **_params(lags=S.DEFAULT_LAGS))


def q_rate_of_change(spark, sf_dir):
    return _family(spark, sf_dir, lambda c: "_diff_" in c, **_params(diffs=S.DEFAULT_DIFFS))


def q_ewma(spark, sf_dir):
    return _family(spark, sf_dir, lambda c: "_ewm_" in c, **_params(spans=S.DEFAULT_SPANS))


def sparse_readings(spark, sf_dir):
    """Readings of one kind of event only, so most cycles are gaps."""
    s = series(spark, sf_dir)
    return s.select("unit_id", "cycle", F.when(F.col("is_error") == 1, F.col("value")).alias("error_value"))


def q_sparse_ewma(spark, sf_dir):
    """W8 over gaps and many short segments."""
    feats = S.temporal_features(sparse_readings(spark, sf_dir), ["error_value"], cross=False, seg_rows=8, **_params(spans=(1, 5, 20)))
    return rounded(feats.drop("error_value"))


def q_trend_slope(spark, sf_dir):
    return _family(spark, sf_dir, lambda c: "_slope_" in c, **_params(trend_window=S.DEFAULT_TREND_WINDOW))


def q_rolling_entropy(spark, sf_dir):
    return _family(spark, sf_dir, lambda c: "_entropy_" in c, **_params(entropy_sensors=EVENT_SENSORS))


def q_cross_ratio(spark, sf_dir):
    base = readings(spark, sf_dir)
    cols = S.cross_sensor_columns(
        base.columns, [("value_k_ratio", "ratio", "value", "k"), ("value_k_diff", "difference", "value", "k")]
    )
    return rounded(base.select("unit_id", "cycle", *[e.alias(n) for n, e in cols]))


def q_ffill_bfill(spark, sf_dir):
    base = readings(spark, sf_dir)
    lagged = S.temporal_features(base, EVENT_SENSORS, cross=False, **_params(lags=S.DEFAULT_LAGS))
    lag_cols = [c for c in lagged.columns if "_lag_" in c]
    filled = S.fill_gaps(lagged.select("unit_id", "cycle", *lag_cols), longest=longest_series(spark, sf_dir))
    return rounded(filled)


def q_feature_matrix(spark, sf_dir):
    fm = S.feature_matrix(processed(spark, sf_dir), EVENT_SENSORS, numbered=True, longest=longest_series(spark, sf_dir))
    return rounded(fm)


def q_rul_capped(spark, sf_dir):
    return L.add_rul(readings(spark, sf_dir)).select("unit_id", "cycle", "rul")


def q_failure_label(spark, sf_dir):
    return processed(spark, sf_dir).select("unit_id", "cycle", "rul", "failure_label")


def _train_rows(spark, sf_dir):
    return series(spark, sf_dir).where(F.col("ts") < F.lit(DRIFT_SPLIT_TS).cast("timestamp_ntz"))


def q_scaler_params(spark, sf_dir):
    return rounded(L.fit_scaler(_train_rows(spark, sf_dir), EVENT_SENSORS))


def q_scaled_values(spark, sf_dir):
    params = L.fit_scaler(_train_rows(spark, sf_dir), EVENT_SENSORS)
    return rounded(L.apply_scaler(readings(spark, sf_dir), params))


@lru_cache(maxsize=1)
def registry():
    from fleetlens.plans.analytics_queries import REGISTRY as ANALYTICS
    from fleetlens.plans.store_queries import REGISTRY as STORED
    from fleetlens.streaming.queries import REGISTRY as STREAMS

    return {**_series_registry(), **ANALYTICS, **STORED, **STREAMS}


def _series_registry():
    return {
        "rolling_mean": q_rolling("mean"),
        "rolling_std": q_rolling("std"),
        "rolling_min": q_rolling("min"),
        "rolling_max": q_rolling("max"),
        "lag_features": q_lag_features,
        "rate_of_change": q_rate_of_change,
        "ewma": q_ewma,
        "sparse_ewma": q_sparse_ewma,
        "trend_slope": q_trend_slope,
        "rolling_entropy": q_rolling_entropy,
        "cross_ratio": q_cross_ratio,
        "ffill_bfill": q_ffill_bfill,
        "feature_matrix": q_feature_matrix,
        "rul_capped": q_rul_capped,
        "failure_label": q_failure_label,
        "scaler_params": q_scaler_params,
        "scaled_values": q_scaled_values,
    }


def oracles():
    from fleetlens.plans import oracle_sql as O
    from fleetlens.plans.analytics_sql import ORACLES
    from fleetlens.plans.store_sql import ORACLES as STORED

    out = {**_series_oracles(O), **{k: f() for k, f in {**ORACLES, **STORED}.items()}}
    # a request holds up to 100 readings of a unit that carry both sensors
    out["drift_check_rejected"] = """
        WITH late AS (
            SELECT user_id, value, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
                   row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place
            FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00' AND user_id IS NOT NULL)
        SELECT user_id * 1048576 + (place - 1) // 100 AS request_id, 'too_few_readings' AS rule, count(*) AS readings
        FROM late WHERE value IS NOT NULL AND k IS NOT NULL
        GROUP BY 1 HAVING count(*) < 30"""
    out["stream_accuracy"] = O.q_stream_accuracy()
    out["stream_score"] = O.q_stream_score()
    return out


def _series_oracles(O):
    return {
        "rolling_mean": O.q_rolling("mean"),
        "rolling_std": O.q_rolling("std"),
        "rolling_min": O.q_rolling("min"),
        "rolling_max": O.q_rolling("max"),
        "lag_features": O.q_lags(),
        "rate_of_change": O.q_diffs(),
        "ewma": O.q_ewma(),
        "sparse_ewma": O.q_sparse_ewma(),
        "trend_slope": O.q_slope(),
        "rolling_entropy": O.q_entropy(),
        "cross_ratio": O.q_cross(),
        "ffill_bfill": O.q_fill(),
        "feature_matrix": O.q_feature_matrix(),
        "rul_capped": O.q_rul(),
        "failure_label": O.q_failure_label(),
        "scaler_params": O.q_scaler_params(),
        "scaled_values": O.q_scaled_values(),
    }
