"""Drift monitoring (M1-M10): baseline statistics, population stability index,
two-sample Kolmogorov-Smirnov test, per-feature report and fleet summary.

All features are handled in *one* job over a long ``(feature, side, value)``
table.  Grouping is by feature, so every group is large by construction; only
algebraic aggregates (counts, sums, moments), selection by rank brackets (PSI,
quantiles) and the sample-sorted rank tool (KS) are used, never a collect of a
feature's values into one task.  A baseline that many samples are held against is
stored ranked (:mod:`fleetlens.operators.baseline`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.columns import PSI_BINS, PSI_EPS, ROUND_DIGITS, ks_asymptotic_pvalue
from fleetlens.functions.ks_exact import EXACT_MAX, ks_exact_pvalue
from fleetlens.plans.prefix import ACCURACY, exact_quantiles, prefix_sums, quantiles_from_ranked, rank_ladder
from fleetlens.session import materialize

# Fixed values that must equal the reference's for equal results.
PSI_THRESHOLD = 0.2
KS_ALPHA = 0.05
MIN_CURRENT_VALUES = 10
PSI_BANDS = ((0.1, "none"), (0.2, "moderate"))  # above the last cut: "significant"
ALERT_LEVELS = (
    (0.5, "CRITICAL — Retrain required"),
    (0.2, "WARNING — Investigate drift"),
)
ALERT_WATCH = "WATCH — Minor drift detected"
ALERT_OK = "OK"


def round_half_away(c: Column, digits: int) -> Column:
    scale = float(10**digits)
    return F.round(c * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def to_long(df: DataFrame, features: Sequence[str], side: str | None = None) -> DataFrame:
    """Unpivot feature columns to ``(feature, value)`` (+ constant ``side``),
    dropping missing values per feature (P7).  Columns absent from ``df`` are
    skipped (P8)."""
    present = [c for c in features if c in df.columns]
    if not present:
        raise ValueError("none of the features is present")
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in present]))
    out = df.select(kv.alias("kv")).select("kv.feature", "kv.value").where(F.col("value").isNotNull() & ~F.isnan("value"))
    return out.withColumn("side", F.lit(side)) if side is not None else out


def fit_baseline(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """M1: per feature n, mean, population std, exact q25 and q75."""
    long = to_long(df, features)
    moments = long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")
    )
    qs = exact_quantiles(long, ["feature"], "value", [0.25, 0.75]).select(
        "feature", F.col("q_0").alias("q25"), F.col("q_1").alias("q75")
    )
    return moments.join(qs, "feature")


def _both_sides(baseline_long: DataFrame, current_long: DataFrame) -> DataFrame:
    b = baseline_long.select("feature", "value", F.lit(1).cast("long").alias("cb"), F.lit(0).cast("long").alias("cc"))
    c = current_long.select("feature", "value", F.lit(0).cast("long").alias("cb"), F.lit(1).cast("long").alias("cc"))
    return b.unionByName(c)


def sample_sizes(counted: DataFrame) -> DataFrame:
    """Per feature n_base and n_cur, of features that can be compared."""
    sizes = counted.groupBy("feature").agg(F.sum("cb").alias("n_base"), F.sum("cc").alias("n_cur"))
    return sizes.where((F.col("n_base") > 0) & (F.col("n_cur") >= MIN_CURRENT_VALUES))


def ranked_values(baseline_long: DataFrame, current_long: DataFrame, buckets: int | None = None):
    """One row per (feature, distinct value) with per-side counts and their
    running totals in value order (sample-sorted prefix sums), plus per-feature
    sample sizes (P8, P9 filters applied).  PSI edges and the KS distance both
    read this one table.

    The raw samples are aggregated once; the distinct-value table and its ranks
    are written to the checkpoint folder, because every consumer prunes other
    columns and Spark would otherwise recompute the whole chain per consumer."""
    distinct = _both_sides(baseline_long, current_long).groupBy("feature", "value").agg(F.sum("cb").alias("cb"), F.sum("cc").alias("cc"))
    distinct = materialize(distinct, "drift-values")
    counts = sample_sizes(distinct)
    run = prefix_sums(distinct, ["feature"], "value", ["cb", "cc"], buckets=buckets)
    # as in `counts`
    run = run.where((F.col("tot_cb") > 0) & (F.col("tot_cc") >= MIN_CURRENT_VALUES))
    both = [(F.col(f"{p}cb") + F.col(f"{p}cc")).alias(f"{p}ca") for p in ("", "cum_", "tot_")]
    return materialize(run.select("*", *both), "drift-ranks"), counts


def psi_edges(n_bins: int = PSI_BINS) -> list[float]:
    return [i / n_bins for i in range(n_bins + 1)]


def psi_from_ranked(run: DataFrame, counts: DataFrame, n_bins: int = PSI_BINS, eps: float = PSI_EPS) -> DataFrame:
    """PSI from per-value counts and running counts of both sides.  ``run`` needs to hold
    the values at and beside each edge only: what lies below an edge is the running count
    in front of the first value that is not."""
    edges = quantiles_from_ranked(run, ["feature"], "value", "ca", "cum_ca", "tot_ca", psi_edges(n_bins))
    # inner edges only: the outer ones (min - eps, max + eps) bound every value
    aggs = []
    for k in range(1, n_bins):
        above = F.col("value") >= F.col(f"q_{k}")
        aggs.append(F.min(F.when(above, F.col("cum_cb") - F.col("cb"))).alias(f"b{k}"))
        aggs.append(F.min(F.when(above, F.col("cum_cc") - F.col("cc"))).alias(f"c{k}"))
    below = run.join(edges, "feature").groupBy("feature").agg(*aggs).join(counts, "feature")
    terms = []
    for k in range(n_bins):
        def cnt(side, k=k):
            total = F.col(f"n_{'base' if side == 'b' else 'cur'}")
            hi = total if k == n_bins - 1 else F.coalesce(F.col(f"{side}{k + 1}"), total)
            lo = F.lit(0) if k == 0 else F.coalesce(F.col(f"{side}{k}"), total)
            return hi - lo

        pb = cnt("b") / F.greatest(F.col("n_base"), F.lit(1))
        pc = cnt("c") / F.greatest(F.col("n_cur"), F.lit(1))
        pb = F.when(pb == 0, F.lit(eps)).otherwise(pb)
        pc = F.when(pc == 0, F.lit(eps)).otherwise(pc)
        terms.append((pc - pb) * F.log(pc / pb))
    return below.select("feature", sum(terms[1:], terms[0]).alias("psi"), "n_base", "n_cur")


def ks_from_ranked(run: DataFrame, counts: DataFrame, method: str = "auto") -> DataFrame:
    """KS distance and p-value; the distance is also taken just before each value, so
    ``run`` may leave out values that only one side has between those of the other."""
    at = F.abs(F.col("cum_cb") / F.col("tot_cb") - F.col("cum_cc") / F.col("tot_cc"))
    before = F.abs((F.col("cum_cb") - F.col("cb")) / F.col("tot_cb") - (F.col("cum_cc") - F.col("cc")) / F.col("tot_cc"))
    ks = run.groupBy("feature").agg(F.max(F.greatest(at, before)).alias("ks_stat")).join(counts, "feature")
    return ks.withColumn("ks_pvalue", ks_pvalue(F.col("ks_stat"), F.col("n_base"), F.col("n_cur"), method))


def ks_pvalue(d: Column, n1: Column, n2: Column, method: str = "auto") -> Column:
    """M4: two-sided p-value.  ``auto``: exact where both samples have at most EXACT_MAX
    values, else asymptotic; or one of the two by name (D8)."""
    if method not in ("auto", "exact", "asymptotic"):
        raise ValueError("method must be 'auto', 'exact' or 'asymptotic'")
    if method == "asymptotic":
        return ks_asymptotic_pvalue(d, n1, n2)
    exact = ks_exact_pvalue(d, n1, n2)
    return exact if method == "exact" else F.when(F.greatest(n1, n2) <= EXACT_MAX, exact).otherwise(ks_asymptotic_pvalue(d, n1, n2))


def psi(
    baseline_long: DataFrame, current_long: DataFrame, n_bins: int = PSI_BINS, eps: float = PSI_EPS, *, accuracy: int = ACCURACY, whole_rows: int = 4 * ACCURACY
) -> DataFrame:
    """M2: population stability index per feature.

    Edges = exact deciles of baseline ∪ current (outer edges widened by eps);
    bins half-open, last closed; shares of 0 replaced by eps;
    PSI = sum((cur - base) * ln(cur / base)).  Duplicate edges are allowed (tied
    data), which is why the counts use ``value < edge`` comparisons rather than
    a bucketizer.  Edges are selected, not sorted out: see ``rank_ladder``."""
    ladder = rank_ladder(_both_sides(baseline_long, current_long), ["feature"], "value", ["cb", "cc"], psi_edges(n_bins), accuracy=accuracy, whole_rows=whole_rows)
    counts = sample_sizes(ladder)
    kept = ladder.join(counts.select("feature"), "feature", "left_semi").withColumn("ca", F.col("cb") + F.col("cc"))
    return psi_from_ranked(prefix_sums(kept, ["feature"], "value", ["cb", "cc", "ca"]), counts, n_bins, eps)


def ks_statistic(baseline_long: DataFrame, current_long: DataFrame, buckets: int | None = None) -> DataFrame:
    """M3: two-sample KS distance sup|F_base - F_cur| per feature.

    Reduced to distinct values with per-side counts, then two-level running sums
    of both counts in value order; the supremum is attained at a data value."""
    run, counts = ranked_values(baseline_long, current_long, buckets)
    return ks_from_ranked(run, counts, "asymptotic").drop("ks_pvalue")


def ks_test(baseline_long: DataFrame, current_long: DataFrame, method: str = "auto") -> DataFrame:
    """M3 + M4: KS statistic and two-sided p-value (:func:`ks_pvalue`)."""
    run, counts = ranked_values(baseline_long, current_long)
    return ks_from_ranked(run, counts, method)


def drift_report(
    baseline_long: DataFrame,
    current_long: DataFrame,
    *,
    psi_threshold: float = PSI_THRESHOLD,
    ks_alpha: float = KS_ALPHA,
    method: str = "auto",
) -> DataFrame:
    """M5, M6, M8: one row per feature with PSI, KS statistic and p-value, the
    three flags (decided before rounding), values rounded to 5 decimals, and the
    three-band PSI reading.  Raises ValueError where the baseline holds no value."""
    if baseline_long.isEmpty():
        raise ValueError("the drift baseline holds no value: fit it first")
    run, counts = ranked_values(baseline_long, current_long)
    return report_from_ranked(run, counts, psi_threshold=psi_threshold, ks_alpha=ks_alpha, method=method)


def report_from_ranked(
    run: DataFrame, counts: DataFrame, *, psi_threshold: float = PSI_THRESHOLD, ks_alpha: float = KS_ALPHA, method: str = "auto"
) -> DataFrame:
    """The drift report of ranked values (see :func:`drift_report`)."""
    p = psi_from_ranked(run, counts).select("feature", "psi")
    k = ks_from_ranked(run, counts, method).select("feature", "ks_stat", "ks_pvalue")
    r = p.join(k, "feature")
    psi_drift = F.col("psi") > F.lit(psi_threshold)
    ks_drift = F.col("ks_pvalue") < F.lit(ks_alpha)
    band = F.when(F.col("psi") < F.lit(PSI_BANDS[0][0]), F.lit(PSI_BANDS[0][1])).when(
        F.col("psi") <= F.lit(PSI_BANDS[1][0]), F.lit(PSI_BANDS[1][1])
    ).otherwise(F.lit("significant"))
    return r.select(
        "feature",
        round_half_away(F.col("psi"), ROUND_DIGITS).alias("psi"),
        psi_drift.alias("psi_drift"),
        round_half_away(F.col("ks_stat"), ROUND_DIGITS).alias("ks_stat"),
        round_half_away(F.col("ks_pvalue"), ROUND_DIGITS).alias("ks_pvalue"),
        ks_drift.alias("ks_drift"),
        (psi_drift | ks_drift).alias("drifted"),
        band.alias("psi_band"),
    )


def alert_level() -> Column:
    """The alert by the share of drifted features (drifted_features, total_features)."""
    share = F.col("drifted_features") / F.greatest(F.col("total_features"), F.lit(1))
    return F.when(share > F.lit(ALERT_LEVELS[0][0]), F.lit(ALERT_LEVELS[0][1])).when(
        share > F.lit(ALERT_LEVELS[1][0]), F.lit(ALERT_LEVELS[1][1])
    ).when(F.col("drifted_features") > 0, F.lit(ALERT_WATCH)).otherwise(F.lit(ALERT_OK))


def drift_summary(report: DataFrame) -> DataFrame:
    """M7: totals, flag counts, mean of the rounded PSI and the alert level.
    An empty report gives zeros and OK."""
    agg = report.agg(
        F.count(F.lit(1)).alias("total_features"),
        F.count_if(F.col("drifted")).alias("drifted_features"),
        F.count_if(F.col("psi_drift")).alias("psi_drifted"),
        F.count_if(F.col("ks_drift")).alias("ks_drifted"),
        F.coalesce(F.avg("psi"), F.lit(0.0)).alias("avg_psi"),
    )
    return agg.select(
        "total_features",
        "drifted_features",
        "psi_drifted",
        "ks_drifted",
        round_half_away(F.col("avg_psi"), ROUND_DIGITS).alias("avg_psi"),
        alert_level().alias("alert_level"),
    )


def top_drift(report: DataFrame, k: int = 5) -> DataFrame:
    """M9: the k features with the highest PSI (feature name breaks ties)."""
    return report.orderBy(F.desc("psi"), F.asc("feature")).limit(k)


def compare_scenarios(scenarios: dict[str, DataFrame]) -> DataFrame:
    """Summaries of several scenarios side by side (``scenario`` column)."""
    out = None
    for name, rep in scenarios.items():
        s = drift_summary(rep).select(F.lit(name).alias("scenario"), "*")
        out = s if out is None else out.unionByName(s)
    return out


def shift(df: DataFrame, features: Sequence[str], strength: float = 2.5) -> DataFrame:
    """Shift features by ``strength`` standard deviations (sample std), as the
    reference's tests do to exercise the detector; deterministic (no noise)."""
    stats = df.agg(*[F.stddev_samp(c).alias(f"_sd_{c}") for c in features]).withColumn("_g", F.lit(0))
    out = df.withColumn("_g", F.lit(0)).join(F.broadcast(stats), "_g")  # one-row table
    for c in features:
        out = out.withColumn(c, F.col(c) + F.lit(strength) * F.col(f"_sd_{c}"))
    return out.drop("_g", *[f"_sd_{c}" for c in features])


def accuracy_by_window(
    df: DataFrame, *, ts: str = "ts", label: str = "label", score: str = "score", threshold: float = 0.5, window: str = "1 day"
) -> DataFrame:
    """M11 (batch twin of the X3 stream): rows and share of correct decisions per
    event-time window -- a grouped aggregate, no global ordering."""
    correct = ((F.col(score) >= F.lit(threshold)).cast("int") == F.col(label).cast("int")).cast("double")
    return (
        df.groupBy(F.window(ts, window).alias("w"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg(correct).alias("accuracy"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "accuracy")
    )


def rolling_accuracy(
    df: DataFrame,
    n: int = 50,
    *,
    alert_below: float = 0.8,
    unit: str = "unit_id",
    cycle: str = "cycle",
    label: str = "label",
    score: str = "score",
    threshold: float = 0.5,
) -> DataFrame:
    """Per unit, accuracy over its last ``n`` scored cycles (segmented
    rolling window, so a hot unit is split) and an alert when it drops below
    ``alert_below``."""
    from fleetlens.operators.series import temporal_features

    correct = ((F.col(score) >= F.lit(threshold)).cast("int") == F.col(label).cast("int")).cast("double")
    base = df.select(unit, cycle, correct.alias("correct"))
    feats = temporal_features(
        base, ["correct"], unit=unit, cycle=cycle, windows=(n,), stats=("mean",), lags=(), diffs=(), spans=(),
        trend_window=None, entropy_sensors=[], cross=False,
    )
    acc = F.col(f"correct_roll_mean_{n}")
    return feats.select(unit, cycle, acc.alias("rolling_accuracy"), (acc < F.lit(alert_below)).alias("accuracy_alert"))
