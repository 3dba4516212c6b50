"""A drift baseline stored ranked, for many samples to be held against.

The raw baseline is read once: one row per (feature, value) with its count and the
running count, dealt in ranges of values, a directory of the ranges and one row of
statistics a feature are written.  A sample is then *probed*: its distinct values are
placed in the ranges by the directory, and only ranges that hold a sample value or a
PSI edge are opened.  Nothing of the baseline is grouped, ranked or written again.
Baselines merge by adding counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.operators import drift as D
from fleetlens.plans.prefix import RANGE_ROWS, prefix_sums, quantiles_from_ranked
from fleetlens.session import materialize

#: Ranges of one feature at most: a sample value looks its range up among these.
MAX_RANGES = 4096


@dataclass
class StoredBaseline:
    """``ranks``: feature, part, value, cb, cum_cb; ``parts``: feature, part, low, start
    (values before it); ``features``: feature, n, mean, std, q25, q75."""

    ranks: DataFrame
    parts: DataFrame
    features: DataFrame

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> StoredBaseline:
        return cls(*(spark.read.parquet(f"{path}/{t}") for t in ("ranks", "parts", "features")))

    def names(self) -> list[str]:
        """The features that the baseline holds (one row each)."""
        return sorted(r.feature for r in self.features.select("feature").collect())


def _store(counted: DataFrame, path: str, range_rows: int) -> StoredBaseline:
    """``counted``: one row per (feature, value) with its count ``cb``, written already."""
    spark = counted.sparkSession
    sizes = counted.agg(F.count(F.lit(1)).alias("n")).first().n
    if sizes == 0:
        raise ValueError("the drift baseline holds no value")
    ranked = materialize(prefix_sums(counted, ["feature"], "value", ["cb"]), "baseline-ranks")
    # ranges of equally many distinct values: their number follows the data up to MAX_RANGES
    rows = max(range_rows, -(-sizes // MAX_RANGES))
    place = prefix_sums(ranked.withColumn("_one", F.lit(1).cast("long")), ["feature"], "value", ["_one"])
    part = F.floor((F.col("cum__one") - 1) / F.lit(rows)).cast("int")
    placed = place.select("feature", part.alias("part"), "value", "cb", "cum_cb")
    placed.repartitionByRange("feature", "value").sortWithinPartitions("feature", "value").write.mode("overwrite").partitionBy("part").parquet(f"{path}/ranks")
    ranks = spark.read.parquet(f"{path}/ranks")
    parts = ranks.groupBy("feature", "part").agg(F.min("value").alias("low"), F.min(F.col("cum_cb") - F.col("cb")).alias("start"))
    parts.write.mode("overwrite").parquet(f"{path}/parts")
    # weighted moments about the mean, from the distinct values
    n, value = F.sum("cb"), F.col("value")
    mean = counted.groupBy("feature").agg(n.alias("n"), (F.sum(value * F.col("cb")) / n).alias("mean"))
    spread = counted.join(mean, "feature").groupBy("feature").agg(F.sqrt(F.sum(F.col("cb") * (value - F.col("mean")) ** 2) / F.sum("cb")).alias("std"))
    quartiles = quantiles_from_ranked(ranked, ["feature"], "value", "cb", "cum_cb", "tot_cb", [0.25, 0.75])
    stats = mean.join(spread, "feature").join(quartiles.select("feature", F.col("q_0").alias("q25"), F.col("q_1").alias("q75")), "feature")
    stats.write.mode("overwrite").parquet(f"{path}/features")
    return StoredBaseline.load(spark, path)


def store_baseline(baseline_long: DataFrame, path: str, range_rows: int = RANGE_ROWS) -> StoredBaseline:
    """M1 as a stored summary of a long (feature, value) table; ValueError if empty."""
    counted = baseline_long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("cb"))
    return _store(materialize(counted, "baseline-values"), path, range_rows)


def merge_baselines(baselines: list[StoredBaseline], path: str, range_rows: int = RANGE_ROWS) -> StoredBaseline:
    """The baseline of all their values together, from the stored counts."""
    rows = baselines[0].ranks.select("feature", "value", "cb")
    for b in baselines[1:]:
        rows = rows.unionByName(b.ranks.select("feature", "value", "cb"))
    return _store(materialize(rows.groupBy("feature", "value").agg(F.sum("cb").alias("cb")), "baseline-values"), path, range_rows)


def probe(baseline: StoredBaseline, current_long: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(run, counts) as of ``ranked_values``, of the opened ranges only."""
    values = materialize(current_long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("cc")), "sample-values")
    sizes = values.groupBy("feature").agg(F.sum("cc").alias("n_cur")).where(F.col("n_cur") >= D.MIN_CURRENT_VALUES)
    counts = materialize(sizes.join(baseline.features.select("feature", F.col("n").alias("n_base")), "feature").select("feature", "n_base", "n_cur"), "sample-sizes")

    # at most MAX_RANGES lows a feature
    lows = baseline.parts.groupBy("feature").agg(F.sort_array(F.collect_list("low")).alias("lows"))
    at = F.greatest(F.size(F.filter("lows", lambda low: low <= F.col("value"))) - 1, F.lit(0))
    sample = values.join(counts.select("feature"), "feature", "left_semi").join(lows, "feature").select("feature", at.alias("part"), "value", "cc")
    sample = materialize(sample, "sample-parts")
    held = sample.groupBy("feature", "part").agg(F.sum("cc").alias("in_part"))

    # Where the ranks of the PSI edges fall among both samples: a range holds the ranks
    # from its start to the next one's, with the sample's values added
    by_part = Window.partitionBy("feature").orderBy("part")
    directory = baseline.parts.join(counts, "feature").join(held, ["feature", "part"], "left").withColumn("in_part", F.coalesce("in_part", F.lit(0)))
    before = F.coalesce(F.sum("in_part").over(by_part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    directory = directory.withColumn("before", before).withColumn("from", F.col("start") + F.col("before"))
    n = F.col("n_base") + F.col("n_cur")
    directory = directory.withColumn("to", F.coalesce(F.lead("from").over(by_part), n))
    edge = F.lit(False)
    for p in D.psi_edges():
        h = (n - 1).cast("double") * F.lit(p)
        for rank in (F.floor(h), F.ceil(h)):
            edge = edge | ((rank >= F.col("from")) & (rank < F.col("to")))
    opened = directory.where(edge | (F.col("in_part") > 0)).select("feature", "part", "start", "before", "n_base", "n_cur")
    opened = materialize(opened, "opened-parts")

    both = baseline.ranks.join(opened.select("feature", "part"), ["feature", "part"], "left_semi").select("feature", "part", "value", "cb", "cum_cb", F.lit(0).cast("long").alias("cc"))
    mine = sample.select("feature", "part", "value", F.lit(0).cast("long").alias("cb"), F.lit(None).cast("long").alias("cum_cb"), "cc")
    merged = both.unionByName(mine).groupBy("feature", "part", "value").agg(F.sum("cb").alias("cb"), F.max("cum_cb").alias("cum_cb"), F.sum("cc").alias("cc"))
    line = Window.partitionBy("feature", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    run = merged.join(opened, ["feature", "part"]).select(
        "feature", "value", "cb", "cc", (F.col("cb") + F.col("cc")).alias("ca"),
        F.coalesce(F.last("cum_cb", ignorenulls=True).over(line), F.col("start")).alias("cum_cb"),
        (F.sum("cc").over(line) + F.col("before")).alias("cum_cc"),
        F.col("n_base").alias("tot_cb"), F.col("n_cur").alias("tot_cc"), (F.col("n_base") + F.col("n_cur")).alias("tot_ca"),
    )
    return materialize(run.withColumn("cum_ca", F.col("cum_cb") + F.col("cum_cc")), "sample-ranks"), counts


def drift_against(baseline: StoredBaseline, current_long: DataFrame, **options) -> DataFrame:
    """The drift report (``drift_report``) of a sample against a stored baseline."""
    run, counts = probe(baseline, current_long)
    return D.report_from_ranked(run, counts, **options)


# ── many small samples against one baseline ─────────────────────────────────


def _part_bounds(baseline: StoredBaseline, column: str) -> DataFrame:
    """Per feature the sorted lower bounds of its ranges (at most MAX_RANGES)."""
    return baseline.parts.groupBy("feature").agg(F.sort_array(F.collect_list(column)).alias("_bounds"))


def _asof(baseline: StoredBaseline, points: DataFrame, column: str, bound: str, key, gives) -> DataFrame:
    """For each (feature, ``column``) of ``points`` what the last baseline row whose
    ``key`` is at most it gives, NULL before the first.  Only ranges with points open."""
    at = F.greatest(F.size(F.filter("_bounds", lambda b: b <= F.col(column))) - 1, F.lit(0))
    asked = points.select("feature", F.col(column).alias("_at")).distinct().withColumnRenamed("_at", column)
    asked = asked.join(_part_bounds(baseline, bound), "feature").select("feature", at.alias("part"), F.col(column).cast("double").alias("_key"))
    names = [f"_v{i}" for i in range(len(gives))]
    rows = baseline.ranks.join(asked.select("feature", "part").distinct(), ["feature", "part"], "left_semi")
    rows = rows.select("feature", "part", key.cast("double").alias("_key"), F.lit(0).alias("_asks"), *[g.alias(n) for g, n in zip(gives, names)])
    line = Window.partitionBy("feature", "part").orderBy("_key", "_asks").rowsBetween(Window.unboundedPreceding, 0)
    both = rows.unionByName(asked.withColumn("_asks", F.lit(1)), allowMissingColumns=True)
    seen = both.select("feature", "_key", "_asks", *[F.last(n, ignorenulls=True).over(line).alias(n) for n in names])
    return seen.where("_asks = 1").select("feature", F.col("_key").alias(column), *names)


def counts_at(baseline: StoredBaseline, points: DataFrame) -> DataFrame:
    """(feature, value) with ``below`` and ``upto``: baseline values < and <= it."""
    got = _asof(baseline, points, "value", "low", F.col("value"), [F.col("value"), F.col("cb"), F.col("cum_cb")])
    upto = F.coalesce("_v2", F.lit(0))
    below = F.when(F.col("_v0") == F.col("value"), upto - F.col("_v1")).otherwise(upto)
    return got.select("feature", "value", below.alias("below"), upto.alias("upto"))


def values_at(baseline: StoredBaseline, ranks: DataFrame) -> DataFrame:
    """(feature, rank, value): the baseline's value at each 0-based rank."""
    got = _asof(baseline, ranks, "rank", "start", F.col("cum_cb") - F.col("cb"), [F.col("value")])
    return got.select("feature", F.col("rank").cast("long").alias("rank"), F.col("_v0").alias("value"))


def drift_by_sample(baseline: StoredBaseline, samples: DataFrame, sample: str = "sample", n_bins: int = D.PSI_BINS, eps: float = D.PSI_EPS, method: str = "auto") -> DataFrame:
    """PSI and KS test of every (sample, feature) of ``samples`` (sample, feature,
    value) against the shared baseline, in one plan.

    The baseline is asked three times by as-of joins inside opened ranges: how many of
    its values lie below each sample value, which values stand at the ranks of the
    PSI's edges (an edge's rank in the merged order, less the sample's values before
    it), and how many lie below each edge.  Samples with fewer values than the drift
    report needs are left out."""
    sizes = baseline.features.select("feature", F.col("n").alias("n_base"))
    group = [sample, "feature"]
    counted = samples.groupBy(*group, "value").agg(F.count(F.lit(1)).alias("cc"))
    whole = Window.partitionBy(*group)
    line = whole.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    counted = counted.withColumn("n_cur", F.sum("cc").over(whole)).withColumn("cum_cc", F.sum("cc").over(line)).where(F.col("n_cur") >= D.MIN_CURRENT_VALUES)
    counted = counted.join(sizes, "feature")
    counted = materialize(counted.join(counts_at(baseline, counted), ["feature", "value"]), "samples")

    f1, f2 = lambda c: F.col(c) / F.col("n_base"), lambda c: c / F.col("n_cur")
    gap = F.greatest(F.abs(f1("upto") - f2(F.col("cum_cc"))), F.abs(f1("below") - f2(F.col("cum_cc") - F.col("cc"))))
    ks = counted.groupBy(*group).agg(F.max(gap).alias("ks_stat"), F.max("n_base").alias("n_base"), F.max("n_cur").alias("n_cur"))

    # The merged order has a sample value's copies from rank `first` on, in front of the
    # baseline's equal values.  A rank is one of these, or the baseline's own value at
    # the rank less the sample values before it.
    first = F.col("below") + F.col("cum_cc") - F.col("cc")
    n = F.col("n_base") + F.col("n_cur")
    asked = []
    for i, p in enumerate(D.psi_edges(n_bins)[1:-1], start=1):
        h = (n - 1).cast("double") * F.lit(p)
        asked += [F.struct(F.lit(i).alias("edge"), F.lit(k).alias("side"), r.cast("long").alias("at"), h.alias("h")) for k, r in enumerate((F.floor(h), F.ceil(h)))]
    places = counted.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct(first.alias("first"), "cc", "value"))).alias("mine"), F.max("n_base").alias("n_base"), F.max("n_cur").alias("n_cur"))
    ranks = places.select(*group, "mine", F.explode(F.array(*asked)).alias("q")).select(*group, "mine", "q.*")
    own = F.filter("mine", lambda m: (m["first"] <= F.col("at")) & (F.col("at") < m["first"] + m["cc"]))
    before = F.aggregate(F.filter("mine", lambda m: m["first"] <= F.col("at")), F.lit(0).cast("long"), lambda acc, m: acc + m["cc"])
    ranks = ranks.select(*group, "edge", "side", "at", "h", F.get(own, F.lit(0))["value"].alias("own"), (F.col("at") - before).alias("rank"))
    ranks = materialize(ranks, "sample-edges")
    found = values_at(baseline, ranks.where("own is null")).withColumnRenamed("value", "theirs")
    ranks = ranks.join(found, ["feature", "rank"], "left").withColumn("v", F.coalesce("own", "theirs"))
    edges = ranks.groupBy(*group, "edge").agg(F.max("h").alias("h"), F.max(F.when(F.col("side") == 0, F.col("v"))).alias("lo"), F.max(F.when(F.col("side") == 1, F.col("v"))).alias("hi"))
    edges = materialize(edges.select(*group, "edge", (F.col("lo") + (F.col("h") - F.floor("h")) * (F.col("hi") - F.col("lo"))).alias("value")), "sample-edges")

    below = edges.join(counts_at(baseline, edges).select("feature", "value", "below"), ["feature", "value"])
    below = below.join(places.select(*group, "mine", "n_base", "n_cur"), group)
    mine = F.aggregate(F.filter("mine", lambda m: m["value"] < F.col("value")), F.lit(0).cast("long"), lambda acc, m: acc + m["cc"])
    cuts = below.select(*group, "edge", "below", mine.alias("own"), "n_base", "n_cur").groupBy(*group).agg(
        F.sort_array(F.collect_list(F.struct("edge", "below", "own"))).alias("e"), F.max("n_base").alias("n_base"), F.max("n_cur").alias("n_cur")
    )
    share = lambda hi, lo, n: F.when(hi == lo, F.lit(eps)).otherwise((hi - lo) / n)
    terms = []
    for k in range(n_bins):
        ends = {}
        for field, total in (("below", F.col("n_base")), ("own", F.col("n_cur"))):
            ends[field] = share(total if k == n_bins - 1 else F.col("e")[k][field], F.lit(0) if k == 0 else F.col("e")[k - 1][field], total)
        terms.append((ends["own"] - ends["below"]) * F.log(ends["own"] / ends["below"]))
    psi = cuts.select(*group, sum(terms[1:], terms[0]).alias("psi"))
    return psi.join(ks, group).withColumn("ks_pvalue", D.ks_pvalue(F.col("ks_stat"), F.col("n_base"), F.col("n_cur"), method))


def drift_details(tests: DataFrame, sample: str = "sample", psi_threshold: float = D.PSI_THRESHOLD, ks_alpha: float = D.KS_ALPHA) -> DataFrame:
    """One row per sample: alert level, totals and ``details`` (feature, psi, ks_pvalue,
    drifted) by feature; flags are decided before rounding."""
    psi_drift, ks_drift = F.col("psi") > psi_threshold, F.col("ks_pvalue") < ks_alpha
    rows = tests.select(
        sample, "feature", D.round_half_away(F.col("psi"), D.ROUND_DIGITS).alias("psi"), D.round_half_away(F.col("ks_pvalue"), D.ROUND_DIGITS).alias("ks_pvalue"),
        (psi_drift | ks_drift).alias("drifted"),
    )
    out = rows.groupBy(sample).agg(
        F.count(F.lit(1)).alias("total_features"), F.count_if("drifted").alias("drifted_features"), F.avg("psi").alias("_psi"),
        F.sort_array(F.collect_list(F.struct("feature", "psi", "ks_pvalue", "drifted"))).alias("details"),
    )
    return out.select(sample, D.alert_level().alias("alert_level"), "total_features", "drifted_features", D.round_half_away(F.col("_psi"), D.ROUND_DIGITS).alias("avg_psi"), "details")
