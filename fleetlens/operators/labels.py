"""Remaining-life labels and standard scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results.
RUL_CAP = 125
FAILURE_HORIZON = 30

# cycles per join key of the remaining-life lookup
RUL_SEGMENT = 4096


def add_rul(
    df: DataFrame,
    *,
    unit: str = "unit_id",
    cycle: str = "cycle",
    cap: int | None = RUL_CAP,
    truth: DataFrame | None = None,
    truth_col: str = "rul",
    out: str = "rul",
) -> DataFrame:
    """L1/L2: remaining life = last cycle of the unit - cycle (+ the unit's true
    remaining life after its last reading, when a truth table is given), capped.

    The last cycle comes from a grouped aggregate and is joined back on (unit, run of
    ``RUL_SEGMENT`` cycles), so a hot unit's rows meet in many tasks when that table is
    too large for AQE to broadcast.  Rows without a unit form one group of their own
    and keep their place; rows without a cycle get a NULL.
    """
    tagged = df.withColumn("_run", F.floor((F.col(cycle) - F.lit(1)) / F.lit(RUL_SEGMENT)))
    runs = tagged.groupBy(F.col(unit).alias("_ru"), F.col("_run").alias("_rr")).agg(F.max(cycle).alias("_end"))
    ends = runs.groupBy(F.col("_ru").alias(unit)).agg(F.max("_end").alias("_end"))
    if truth is not None:
        ends = ends.join(truth.select(unit, F.col(truth_col).alias("_truth")), unit, "left")
        extra = F.coalesce(F.col("_truth"), F.lit(0))
    else:
        extra = F.lit(0)
    ends = ends.select(F.col(unit).alias("_eu"), (F.col("_end") + extra).alias("_end"))
    keyed = runs.drop("_end").join(ends, F.col("_ru").eqNullSafe(F.col("_eu"))).drop("_eu")
    rul = F.col("_end") - F.col(cycle)
    if cap is not None:
        rul = F.least(rul, F.lit(cap))
    joined = tagged.join(keyed, F.col(unit).eqNullSafe(F.col("_ru")) & F.col("_run").eqNullSafe(F.col("_rr")))
    return joined.withColumn(out, rul.cast("int")).drop("_end", "_run", "_ru", "_rr")


def add_failure_label(df: DataFrame, *, horizon: int = FAILURE_HORIZON, rul: str = "rul", out: str = "failure_label"):
    """L3: 1 when the unit fails within ``horizon`` cycles (inclusive), else 0."""
    return df.withColumn(out, (F.col(rul) <= F.lit(horizon)).cast("int"))


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """L4: one pass, one row per column: (column, mean, scale) with the
    *population* std as scale and 1 where the std is 0 (sklearn's rule).

    The result is a tiny table (one row per column) meant to be stored (S9)."""
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, mean double, scale double")
    # NaN -> NULL must already have happened at ingest; NULLs are skipped like sklearn's nan-aware fit
    wide = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"), F.avg(F.col(c).cast("double")).alias("mean"), F.stddev_pop(F.col(c).cast("double")).alias("std")
            ).alias(f"s{i}")
            for i, c in enumerate(columns)
        ]
    )
    # one row, turned into one row per column
    stats = wide.select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(columns))])).alias("s")).select("s.*")
    return stats.select(
        "column",
        "mean",
        F.when(F.col("std").isNull() | (F.col("std") == 0), F.lit(1.0)).otherwise(F.col("std")).alias("scale"),
    )


def apply_scaler(df: DataFrame, params: DataFrame | dict) -> DataFrame:
    """(x - mean) / scale for every column listed in ``params``.

    ``params`` is the small table of :func:`fit_scaler` (collected: one row per
    column, a size fixed by the schema, not by the data) or a ``{col: (mean, scale)}``
    dict; the values become literals so the projection stays in codegen."""
    if isinstance(params, DataFrame):
        params = {r["column"]: (r["mean"], r["scale"]) for r in params.collect()}
    cols = []
    for c in df.columns:
        if c in params:
            mean, scale = params[c]
            if mean is None:  # a column without values stays so
                cols.append(F.col(c).cast("double").alias(c))
                continue
            cols.append(((F.col(c) - F.lit(float(mean))) / F.lit(float(scale))).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def prepare(
    train: DataFrame,
    test: DataFrame | None = None,
    columns: Sequence[str] | None = None,
    *,
    unit: str = "unit_id",
    cycle: str = "cycle",
    cap: int = RUL_CAP,
    horizon: int = FAILURE_HORIZON,
    test_truth: DataFrame | None = None,
):
    """Fit the scaler on ``train`` only, apply it to both, add labels (train.py stage 2).
    Returns (train_processed, test_processed_or_None, scaler_params)."""
    from fleetlens.operators.series import sensor_columns

    cols = list(columns) if columns is not None else sensor_columns(train, [unit, cycle, "rul", "failure_label"])
    params = fit_scaler(train, cols)
    collected = {r["column"]: (r["mean"], r["scale"]) for r in params.collect()}

    def _one(df, truth):
        df = apply_scaler(df, collected)
        df = add_rul(df, unit=unit, cycle=cycle, cap=cap, truth=truth)
        return add_failure_label(df, horizon=horizon)

    return _one(train, None), (_one(test, test_truth) if test is not None else None), params


def placeholder_labels(df: DataFrame, rul: str = "rul", label: str = "failure_label") -> DataFrame:
    """P10: when no scaler/labels are available (scoring payloads), add constant
    ``rul`` = 0 and ``failure_label`` = 0 so the feature layout matches training.
    Existing columns are kept."""
    add = {c: F.lit(0) for c in (rul, label) if c not in df.columns}
    return df.withColumns(add) if add else df
