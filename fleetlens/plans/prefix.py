"""Prefix sums over a total order inside groups, and exact quantiles by selection.

Global-order statistics (KS distance, ROC AUC with ties, average precision, Youden's
threshold) need running totals over all values of a group in sorted order.  A window
``PARTITION BY group ORDER BY value`` would put a whole group -- e.g. every value of one
feature -- into one task.  Here:

1. the input is first reduced to one row per (group, value) by the caller (a
   partial-aggregated groupBy, so one value holding a third of the rows costs
   nothing extra);
2. its rows are counted, and a sample sort deals them by (group, value) into ranges of
   about ``range_rows``: Spark takes the splitters from the rows themselves, so the
   number of ranges grows with the data;
3. totals per (group, range) -> running totals over a group's ranges (one row per range)
   -> exclusive offsets;
4. running sums inside each (group, range) window + the offset.

The result is exact (ranges only decide which task does the work).

Quantiles need no order of all values: a sketch bounds each requested rank by a narrow
bracket, one aggregate counts what lies between the brackets and lists the values inside
them, and only that list is ranked.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Distinct rows of one range of the sample sort.
RANGE_ROWS = 65_536
#: Groups that are broadcast beside their brackets, after a count.
BROADCAST_GROUPS = 10_000
#: 1 / the rank error of the sketch that brackets quantiles.
ACCURACY = 10_000


def range_count(rows: int, range_rows: int = RANGE_ROWS) -> int:
    return max(1, math.ceil(rows / range_rows))


def prefix_sums(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    values: Sequence[str],
    *,
    descending: bool = False,
    buckets: int | None = None,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Add ``cum_<v>`` (inclusive running sum of ``v`` in ``order`` within ``group``)
    and ``tot_<v>`` (group total) for every ``v`` in ``values``.

    ``order`` must be unique within a group (aggregate to distinct values first), and
    ``df`` cheap to read more than once.  ``descending=True`` accumulates from the
    largest value down.  ``buckets`` sets the number of ranges; by default it follows
    the counted rows.
    """
    from fleetlens.session import materialize

    group = list(group)
    key = F.col(order) if not descending else -F.col(order)
    keyed = df.withColumn("_key", key.cast("double"))
    n = buckets or range_count(df.count(), range_rows)
    if n == 1:  # few rows: one window a group
        gw = Window.partitionBy(*group)
        lw = gw.orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
        return keyed.select(
            *[c for c in df.columns], *[F.sum(v).over(gw).alias(f"tot_{v}") for v in values], *[F.sum(v).over(lw).alias(f"cum_{v}") for v in values]
        )
    ungrouped = not group
    if ungrouped:  # one global group: a constant key keeps every step an equi-join
        keyed, group = keyed.withColumn("_g0", F.lit(0)), ["_g0"]
    ranged = keyed.repartitionByRange(n, *group, "_key").withColumn("_bucket", F.spark_partition_id())
    # written once: totals and running sums must see the same ranges
    ranged = materialize(ranged, "ranges")
    part = group + ["_bucket"]
    totals = ranged.groupBy(*part).agg(*[F.sum(v).alias(f"_bt_{v}") for v in values])
    gw = Window.partitionBy(*group).orderBy("_bucket")
    offsets = totals.select(
        *part,
        *[
            F.coalesce(F.sum(f"_bt_{v}").over(gw.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"_off_{v}")
            for v in values
        ],
        *[F.sum(f"_bt_{v}").over(Window.partitionBy(*group)).alias(f"tot_{v}") for v in values],
    )
    # a row per (group, range); AQE measures it and broadcasts it when small
    joined = ranged.join(offsets, part)
    lw = Window.partitionBy(*part).orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
    out = joined.select(
        *[c for c in joined.columns if not c.startswith("_off_") and c not in ("_key", "_bucket")],
        *[(F.sum(v).over(lw) + F.col(f"_off_{v}")).alias(f"cum_{v}") for v in values],
    )
    return out.drop("_g0") if ungrouped else out


def quantiles_from_ranked(
    ranked: DataFrame,
    group: Sequence[str],
    value: str,
    count: str,
    cum: str,
    total: str,
    probs: Sequence[float],
) -> DataFrame:
    """Exact linear-interpolation quantiles from a distinct-value table that
    already carries per-value counts and inclusive running counts.

    Every value row tests whether it holds the floor / ceil rank of each
    requested quantile (0-based ranks ``[cum - count, cum)``); one aggregate keeps the
    hits.  Returns one row per group with ``q_<i>``."""
    group = list(group)
    first, n = F.col(cum) - F.col(count), F.col(total)
    aggs = [F.max(total).alias("_n")]
    place = lambda p, n: (n - F.lit(1)).cast("double") * F.lit(float(p))
    for i, p in enumerate(probs):
        for name, rank in (("lo", F.floor(place(p, n))), ("hi", F.ceil(place(p, n)))):
            aggs.append(F.max(F.when((rank >= first) & (rank < F.col(cum)), F.col(value))).alias(f"_{name}{i}"))
    hits = ranked.groupBy(*group).agg(*aggs)
    out = []
    for i, p in enumerate(probs):
        h = place(p, F.col("_n"))
        out.append((F.col(f"_lo{i}") + (h - F.floor(h)) * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(f"q_{i}"))
    return hits.select(*group, *out)


def rank_ladder(
    df: DataFrame, group: Sequence[str], value: str, counts: Sequence[str], probs: Sequence[float], *, accuracy: int = ACCURACY, whole_rows: int = 4 * ACCURACY
) -> DataFrame:
    """The part of the distinct values that the quantiles ``probs`` can fall on.

    One row per (group, value) inside a bracket around a quantile, and one row for all
    values between two brackets (``value`` is their least), each with the sums of
    ``counts``; so running sums over the ladder give the exact rank of every listed
    value.  A quantile sketch with rank error n / accuracy sets the brackets two errors
    to each side, so the ranks lie inside whatever the values; groups of at most
    ``whole_rows`` rows are listed whole.  Two scans and no order of all values; about
    4 / accuracy of the values are listed for each quantile.  A row is one
    value; ``counts`` are 0 or 1 (such as which sample it belongs to).
    """
    from fleetlens.session import materialize

    group = list(group)
    eps = 2.0 / accuracy
    asked = [min(max(p + side * eps, 0.0), 1.0) for p in probs for side in (-1, 1)]
    sketch = df.groupBy(*group).agg(F.percentile_approx(value, asked, accuracy).alias("_b"), F.count(F.lit(1)).alias("_n"))
    ends = [F.when(F.col("_n") > whole_rows, F.col("_b")[i]).otherwise(F.lit(math.inf if i % 2 else -math.inf)).alias(f"_b{i}") for i in range(len(asked))]
    brackets = materialize(sketch.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], *ends), "brackets")
    if brackets.count() <= BROADCAST_GROUPS:
        brackets = F.broadcast(brackets)
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)]
    on = same[0]
    for s in same[1:]:
        on = on & s
    v = F.col(value)
    inside = F.lit(False)
    below = F.lit(0)
    for i in range(0, len(asked), 2):
        inside = inside | v.between(F.col(f"_b{i}"), F.col(f"_b{i + 1}"))
        below = below + (v > F.col(f"_b{i + 1}")).cast("int")
    tagged = df.join(brackets, on).select(*group, value, *counts, below.alias("_gap"), F.when(inside, v).alias("_exact"))
    ladder = tagged.groupBy(*group, "_gap", "_exact").agg(F.min(value).alias(value), *[F.sum(c).alias(c) for c in counts])
    return materialize(ladder.drop("_gap", "_exact"), "ladder")


def exact_quantiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    probs: Sequence[float],
    *,
    buckets: int | None = None,
    accuracy: int = ACCURACY,
    whole_rows: int = 4 * ACCURACY,
) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy's default, Spark's
    ``percentile``) per group, by selection: only the values around the asked ranks are
    ranked, whatever the number of distinct values.

    Returns one row per group with ``q_<i>`` columns, in the order of ``probs``.
    """
    group = list(group)
    ones = df.where(F.col(value).isNotNull()).withColumn("_c", F.lit(1).cast("long"))
    ladder = rank_ladder(ones, group, value, ["_c"], probs, accuracy=accuracy, whole_rows=whole_rows)
    ranked = prefix_sums(ladder, group, value, ["_c"], buckets=buckets)
    return quantiles_from_ranked(ranked, group, value, "_c", "cum__c", "tot__c", probs)
