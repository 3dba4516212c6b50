"""Fleet profiling and data checks (A1-A10).

All aggregates here are algebraic (count, sum, avg, std, min, max): Spark combines
them map-side, so a hot unit or a single feature with every row costs one
partial row per task in the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fleetlens.plans.prefix import exact_quantiles

# Feature families by name pattern (overlapping, as in the reference).
FEATURE_FAMILIES = [
    ("Original sensors", None),
    ("Rolling statistics", ["roll"]),
    ("Lag features", ["lag_"]),
    ("Rate of change", ["diff_"]),
    ("EWMA", ["ewm_"]),
    ("Trend slope", ["slope"]),
    ("Entropy", ["entropy"]),
    ("Cross-sensor", ["ratio", "temp_diff"]),
]
ORIGINAL_EXCLUDES = ["roll", "lag", "diff", "ewm", "slope", "entropy", "ratio"]


def unit_lifetimes(df: DataFrame, *, unit: str = "unit_id", cycle: str = "cycle") -> DataFrame:
    """A2: lifetime of each unit = its last cycle."""
    return df.groupBy(unit).agg(F.max(cycle).alias("lifetime"))


def lifetime_summary(df: DataFrame, *, unit: str = "unit_id", cycle: str = "cycle") -> DataFrame:
    """Units, rows, mean/min/median/max lifetime (one row).

    The median is exact (linear interpolation) via the two-level rank tool, so a
    fleet with millions of units never funnels its lifetimes into one task."""
    lives = unit_lifetimes(df, unit=unit, cycle=cycle)
    stats = lives.agg(
        F.count(F.lit(1)).alias("n_units"),
        F.sum("lifetime").cast("long").alias("n_rows"),
        F.avg("lifetime").alias("mean_lifetime"),
        F.min("lifetime").alias("min_lifetime"),
        F.max("lifetime").alias("max_lifetime"),
    ).withColumn("_g", F.lit(0))
    med = exact_quantiles(lives.withColumn("_g", F.lit(0)), ["_g"], "lifetime", [0.5]).select(
        "_g", F.col("q_0").cast("double").alias("median_lifetime")
    )
    return stats.join(med, "_g", "left").drop("_g")


def sensor_profile(df: DataFrame, sensors: Sequence[str]) -> DataFrame:
    """A5: mean, sample std, min, max per sensor.

    One global aggregate over the wide table (no unpivot shuffle), then the single
    result row is reshaped with ``stack`` into one row per sensor."""
    aggs = []
    for s in sensors:
        aggs += [
            F.avg(s).alias(f"{s}__mean"),
            F.stddev_samp(s).alias(f"{s}__std"),
            F.min(s).cast("double").alias(f"{s}__min"),
            F.max(s).cast("double").alias(f"{s}__max"),
        ]
    wide = df.agg(*aggs)
    args = ", ".join(f"'{s}', `{s}__mean`, `{s}__std`, `{s}__min`, `{s}__max`" for s in sensors)
    return wide.selectExpr(f"stack({len(sensors)}, {args}) AS (sensor, mean, std, min, max)")


def label_balance(df: DataFrame, *, split: str = "split", label: str = "failure_label") -> DataFrame:
    """Rows, positives, negatives and failure rate (%) per split."""
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(label) == 1).alias("n_failure"),
        F.count_if(F.col(label) == 0).alias("n_healthy"),
        (F.avg(F.col(label).cast("double")) * F.lit(100.0)).alias("failure_rate_pct"),
    )


def _row_rules(df: DataFrame, unit: str, raw_columns: Sequence[str], label: str | None, rul: str | None, rul_cap: int) -> list:
    """The rules that look at one row at a time, as aggregates."""
    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    missing = lambda c: F.col(c).isNull() | F.isnan(c) if c in floats else F.col(c).isNull()
    endless = lambda c: F.coalesce(F.col(c).isin(float("inf"), float("-inf")), F.lit(False))
    each = lambda tests: sum((t.cast("long") for t in tests), F.lit(0).cast("long"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    aggs = [
        total(each(missing(c) for c in raw_columns)).alias("missing_raw_values"),
        total(each(endless(c) for c in sorted(floats))).alias("infinite_values"),
        F.count_if(F.col(unit).isNull()).alias("missing_unit_id"),
    ]
    if label:
        aggs += [
            F.count_if(~F.col(label).isin(0, 1) | F.col(label).isNull()).alias("label_not_binary"),
            F.count_if(F.col(label) == 1).alias("_pos"),
            F.count_if(F.col(label) == 0).alias("_neg"),
        ]
    if rul:
        aggs.append(F.count_if((F.col(rul) < 0) | (F.col(rul) > rul_cap)).alias("rul_out_of_range"))
    return aggs


def _first_cycles(df: DataFrame, unit: str, cycle: str) -> DataFrame:
    return df.groupBy(unit).agg(F.min(cycle).alias("_m")).agg(F.count_if(F.col("_m") != 1).alias("first_cycle_not_1"))


def _check_rows(checks: DataFrame, missing_required: int, label: str | None) -> DataFrame:
    checks = checks.withColumn("required_columns_missing", F.lit(missing_required).cast("long"))
    if label:
        checks = checks.withColumn(
            "single_class", ((F.col("_pos") == 0).cast("long") + (F.col("_neg") == 0).cast("long"))
        ).drop("_pos", "_neg")
    names = [c for c in checks.columns]
    args = ", ".join(f"'{c}', CAST(`{c}` AS BIGINT)" for c in names)
    return checks.selectExpr(f"stack({len(names)}, {args}) AS (check_name, violations)")


def data_checks(
    df: DataFrame,
    *,
    unit: str = "unit_id",
    cycle: str = "cycle",
    raw_columns: Sequence[str] = (),
    required: Sequence[str] = (),
    label: str | None = "failure_label",
    rul: str | None = "rul",
    rul_cap: int = 125,
) -> DataFrame:
    """A10: one row per rule with its violation count (0 = passes).

    Rules: missing values (NULL or NaN) in raw columns, units whose first cycle is not 1,
    required columns absent, infinite numeric values, missing unit id, labels
    outside {0,1}, a label class absent, remaining life outside [0, cap].
    Row rules are terms of one aggregate; the per-unit rule is a
    grouped aggregate (partial per task)."""
    row = df.agg(*_row_rules(df, unit, raw_columns, label, rul, rul_cap))
    checks = row.withColumn("_g", F.lit(0)).join(_first_cycles(df, unit, cycle).withColumn("_g", F.lit(0)), "_g").drop("_g")
    return _check_rows(checks, len([c for c in required if c not in df.columns]), label)


def write_checked(
    df: DataFrame,
    path: str,
    *,
    unit: str = "unit_id",
    cycle: str = "cycle",
    raw_columns: Sequence[str] = (),
    required: Sequence[str] = (),
    label: str | None = "failure_label",
    rul: str | None = "rul",
    rul_cap: int = 125,
    mode: str = "overwrite",
) -> DataFrame:
    """S4 and A10 in one job: write the table as Parquet, and the counts of
    :func:`data_checks` with it.  The row rules are observed metrics of the write, so the
    rows are read once; the rule on a unit's first cycle reads two stored columns."""
    spark = df.sparkSession
    watch = Observation()
    df.observe(watch, *_row_rules(df, unit, raw_columns, label, rul, rul_cap)).write.mode(mode).parquet(path)
    counts = spark.createDataFrame([watch.get])  # one row
    first = _first_cycles(spark.read.parquet(path), unit, cycle)
    checks = counts.withColumn("_g", F.lit(0)).join(first.withColumn("_g", F.lit(0)), "_g").drop("_g")
    return _check_rows(checks, len([c for c in required if c not in df.columns]), label)


def feature_catalog(spark, feature_names: Sequence[str]) -> DataFrame:
    """Features per family (name patterns overlap), count and first example;
    empty families are left out.  Works on the feature *names* (schema metadata)."""
    rows = []
    for fam, pats in FEATURE_FAMILIES:
        if pats is None:
            members = [f for f in feature_names if not any(x in f for x in ORIGINAL_EXCLUDES)]
        else:
            members = [f for f in feature_names if any(x in f for x in pats)]
        if members:
            rows.append((fam, len(members), members[0]))
    return spark.createDataFrame(rows, "family string, n_features int, example string")
