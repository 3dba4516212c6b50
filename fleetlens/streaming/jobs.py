"""Structured Streaming jobs.

* X1 :class:`ScoringJob` -- score arriving readings with state per unit: the raw rows
  that frames and lags still need, the last non-null value of every column and the
  weighted sums of the EWMAs.  The state of a unit has a bounded size, so a micro-batch
  reads no history, and no gap is too long for it.  Rows wait until the watermark has
  passed them, so rows that come out of order within the delay are numbered in order;
  rows behind what was already scored go to a table of their own.
* X2 :func:`start_drift` -- drift report of each micro-batch against a stored
  baseline summary (see ``operators/baseline.py``), read and never ranked again.
* X3 :func:`start_accuracy` -- rolling accuracy per event-time window with a
  watermark; late rows beyond the watermark are dropped by Spark.

Sinks are ``foreachBatch`` writers with one folder per batch id in shared storage, so a
restarted query (same checkpoint location) rewrites the same batch idempotently.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetlens.operators import drift as D
from fleetlens.operators import series as S
from fleetlens.operators.baseline import StoredBaseline, drift_against
from fleetlens.session import discard, materialize
from fleetlens.streaming.state import StateTable, read_version, versions, write_version

AVAILABLE_NOW = {"availableNow": True}
#: Cycles of a unit that share a join key when its last rows are picked.
RUN_ROWS = 4096


def latest_per_key(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Final view of an update-mode sink: the row of the latest batch per key."""
    out = spark.read.parquet(path)
    vals = [c for c in out.columns if c not in (*keys, "batch_id")]
    best = out.groupBy(*keys).agg(F.max_by(F.struct(*vals), "batch_id").alias("_v"))
    return best.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in vals])


# ── X3: windowed accuracy with watermark ───────────────────────────────────


def accuracy_stream(
    readings: DataFrame,
    *,
    ts: str = "ts",
    label: str = "label",
    score: str = "score",
    threshold: float = 0.5,
    window: str = "1 day",
    watermark: str = "1 day",
) -> DataFrame:
    """Per event-time window: number of scored rows and share of correct decisions."""
    correct = ((F.col(score) >= F.lit(threshold)).cast("int") == F.col(label).cast("int")).cast("double")
    if readings.schema[ts].dataType.typeName() == "timestamp_ntz":
        # watermarks need TIMESTAMP; with the session zone UTC the instants are unchanged
        readings = readings.withColumn(ts, F.col(ts).cast("timestamp"))
    return (
        readings.withWatermark(ts, watermark)
        .groupBy(F.window(ts, window).alias("w"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg(correct).alias("accuracy"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "accuracy")
    )


def start_accuracy(stream: DataFrame, out_path: str, checkpoint: str, trigger: dict | None = None, **kw) -> StreamingQuery:
    """Run X3 with update output mode; the sink keeps every batch's updates."""
    agg = accuracy_stream(stream, **kw)
    return (
        agg.writeStream.outputMode("update")
        .foreachBatch(lambda df, bid: write_version(df, out_path, bid))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


# ── X2: drift per micro-batch ───────────────────────────────────────────────


def start_drift(
    stream: DataFrame, baseline: StoredBaseline, out_path: str, checkpoint: str, features: Sequence[str] | None = None, trigger: dict | None = None, **options
) -> StreamingQuery:
    """Run X2: every micro-batch's drift report against the stored baseline, of all its
    features unless some are named."""
    names = list(features) if features is not None else baseline.names()

    def per_batch(df: DataFrame, batch_id: int) -> None:
        write_version(drift_against(baseline, D.to_long(df, names), **options), out_path, batch_id)

    return (
        stream.writeStream.foreachBatch(per_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


# ── X1: scoring with state per unit ─────────────────────────────────────────


def frame_rows_needed(windows: Sequence[int], lags: Sequence[int], diffs: Sequence[int], trend_window: int | None, entropy_window: int) -> int:
    """Rows before a new one that its bounded frames, lags and differences read."""
    need = [0] + [w - 1 for w in windows] + list(lags) + list(diffs) + [entropy_window - 1]
    if trend_window:
        need.append(trend_window - 1)
    return max(need)


class ScoringJob:
    """Features and scores of a stream of readings, the same rows as the batch
    features (forward fill only: the future is unknown) over all readings in order.

    ``delay`` is an SQL expression that is subtracted from the largest first ``order``
    column seen (such as ``INTERVAL 1 HOUR`` or ``5``): rows up to there are scored, later
    ones wait.  None scores each row with its batch.  A row whose order is not behind
    its unit's last scored one, or that has no order, goes to ``<state_path>/late``.
    ``scorer`` gets the unit, ``cycle`` (the row's number in its unit), ``order``, the
    sensors and all features; its result is written under ``out_path``.
    """

    def __init__(
        self,
        spark: SparkSession,
        sensors: Sequence[str],
        scorer: Callable[[DataFrame], DataFrame],
        state_path: str,
        out_path: str,
        *,
        unit: str = "unit_id",
        order: Sequence[str] = ("cycle",),
        delay: str | None = None,
        feature_params: dict | None = None,
        compact_every: int = 16,
    ):
        self.spark, self.sensors, self.scorer = spark, list(sensors), scorer
        self.state_path, self.out_path = state_path, out_path
        self.unit, self.order, self.delay = unit, list(order), delay
        self.params = dict(feature_params or {})
        self.need = frame_rows_needed(
            self.params.get("windows", S.DEFAULT_WINDOWS), self.params.get("lags", S.DEFAULT_LAGS), self.params.get("diffs", S.DEFAULT_DIFFS),
            self.params.get("trend_window", S.DEFAULT_TREND_WINDOW), self.params.get("entropy_window", S.ENTROPY_WINDOW),
        )
        self.units = StateTable(spark, f"{state_path}/units", unit, compact_every)

    # the number of the row in its unit may clash with an order column of that name
    @property
    def cycle(self) -> str:
        return "cycle" if "cycle" not in self.order else "row_number"

    def start(self, stream: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or AVAILABLE_NOW)).start()

    def drain(self) -> None:
        """Score the rows that still wait, once the stream has ended."""
        done = versions(self.spark, f"{self.state_path}/clock")
        waiting = read_version(self.spark, f"{self.state_path}/waiting", done[-1] + 1) if done else None
        if waiting is not None:
            self.process(waiting.limit(0), done[-1] + 1, release_all=True)

    def process(self, batch: DataFrame, batch_id: int, release_all: bool = False) -> None:
        state_at = lambda kind: f"{self.state_path}/{kind}"
        columns = [self.unit, *self.order, *self.sensors]
        arrived = batch.select(*columns)
        waiting = read_version(self.spark, state_at("waiting"), batch_id)
        clock = read_version(self.spark, state_at("clock"), batch_id)
        first = self.order[0]
        # written once: an external batch may not be read alike twice, and its rows
        # feed the clock, the late table, the waiting rows and the features
        rows = arrived if waiting is None else arrived.unionByName(waiting.select(*columns))
        rows = materialize(rows.withColumn("_key", F.struct(self.unit)), "stream-rows")
        seen = rows.agg(F.max(first).alias("high"))
        high = materialize(seen if clock is None else seen.unionByName(clock.select("high")).agg(F.max("high").alias("high")), "stream-clock")

        state = self.units.read(batch_id, rows.select("_key").distinct())
        if state is not None:
            state = materialize(state, "stream-state")
        order = F.struct(*self.order)
        placed = rows
        if state is not None:
            last = state.select(F.struct(self.unit).alias("_key"), "last_order", "last_cycle")
            placed = placed.join(last, "_key", "left")
        else:
            placed = placed.withColumn("last_order", F.lit(None).cast(rows.select(order.alias("o")).schema["o"].dataType)).withColumn("last_cycle", F.lit(None).cast("long"))
        late = F.coalesce(order <= F.col("last_order"), F.lit(False)) | F.col(first).isNull()
        ready = ~late
        if self.delay is not None and not release_all:
            placed = placed.withColumn("_g", F.lit(0)).join(F.broadcast(high.withColumn("_g", F.lit(0))), "_g")  # one row
            ready = ready & (F.col(first) <= F.col("high") - F.expr(self.delay))
        placed = placed.withColumn("_fate", F.when(late, "late").when(ready, "ready").otherwise("waiting"))
        placed = materialize(placed.select(*columns, "_key", "last_cycle", "_fate"), "stream-placed")

        self._score(placed.where("_fate = 'ready'"), state, batch_id)
        write_version(placed.where("_fate = 'late'").select(*columns), state_at("late"), batch_id)
        write_version(placed.where("_fate = 'waiting'").select(*columns), state_at("waiting"), batch_id)
        write_version(high, state_at("clock"), batch_id)
        for used in (rows, high, placed, *([state] if state is not None else [])):
            discard(used)

    def _score(self, ready: DataFrame, state: DataFrame | None, batch_id: int) -> None:
        unit, cycle, sensors = self.unit, self.cycle, self.sensors
        ranked = S.assign_cycle(ready, unit, self.order, cycle="_rank")
        number = (F.coalesce("last_cycle", F.lit(0)) + F.col("_rank")).cast("long").alias(cycle)
        rows = ranked.select(unit, number, *self.order, *sensors)
        numbered = ranked.select(unit, number, *self.order, *sensors, "_rank")
        context = ewma_state = longest = None
        spans = self.params.get("spans", S.DEFAULT_SPANS)
        states = [f"_s{i}" for i in range(len(sensors) * len(spans))]
        given = numbered.drop("_rank")
        if state is not None:
            context = state.select(unit, F.explode("tail").alias("_t")).select(unit, "_t.*")
            ewma_state = state.select(unit, "ewma.*") if states else None
            # the last values before a unit's first row here go with that row
            before = state.select(F.struct(unit).alias("_key"), F.col("filled").alias("_before"))
            first = numbered.where("_rank = 1").drop("_rank").withColumn("_key", F.struct(unit)).join(before, "_key", "left").drop("_key")
            given = numbered.where("_rank > 1").drop("_rank").unionByName(first, allowMissingColumns=True)
        else:
            longest = rows.agg(F.max(cycle)).first()[0] or 0
        feats = S.temporal_features(
            given, sensors, unit=unit, cycle=cycle, cross=False, context=context, ewma_state=ewma_state, keep_state=bool(states), longest=longest,
            keep_segment=True, keep_key=True, **self.params
        )
        fill = [c for c in feats.columns if c not in (unit, cycle, *self.order, *states, S.SEG, S.KEY, "_before")]
        # filled by the windows' own order and written once; the rest is carried
        inside = S.fill_inside(feats, fill, cycle=cycle, direction="forward", initial="_before" if state is not None else None, end="_end")
        stored = materialize(inside.drop(S.KEY), "stream-features", dictionary=False)
        filled = S.carry_forward(stored, fill, unit=unit, end="_end")
        write_version(self.scorer(filled.drop(*states, S.SEG, "_end")), self.out_path, batch_id)

        # a unit's last row is the last one of a segment: few rows, no sort of all
        ends = filled.where("_end").withColumn("_key", F.struct(unit))
        latest = materialize(ends.groupBy("_key").agg(F.max(cycle).alias("last_cycle")), "stream-ends")
        parts = {"last_order": F.struct(*self.order), "filled": F.struct(*fill)}
        if states:
            parts["ewma"] = F.struct(*states)
        last = ends.join(latest, "_key").where(F.col(cycle) == F.col("last_cycle")).select("_key", "last_cycle", *[v.alias(k) for k, v in parts.items()])
        raw = rows.select(unit, cycle, *sensors)
        if context is not None:
            raw = raw.unionByName(context.select(unit, cycle, *sensors))
        # at most `need` rows a unit; numbers have no gaps, so the last ones are known
        need = max(self.need, 1)
        runs = F.explode(F.sequence(_run(F.col("last_cycle") - F.lit(need - 1)), _run(F.col("last_cycle")))).alias("_run")
        near = raw.withColumn("_key", F.struct(unit)).withColumn("_run", _run(F.col(cycle))).join(latest.select("_key", "last_cycle", runs), ["_key", "_run"])
        kept = near.where(F.col(cycle) > F.col("last_cycle") - F.lit(need))
        tail = kept.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct(cycle, *sensors))).alias("tail"))
        fresh = last.join(tail, "_key").select(f"_key.{unit}", "last_cycle", *parts, "tail")
        self.units.upsert(fresh, batch_id)
        for used in (stored, latest):
            discard(used)


def _run(cycle: Column) -> Column:
    """The run of RUN_ROWS cycles that a row lies in: a join key no hot unit fills."""
    return F.floor(cycle / F.lit(RUN_ROWS)).cast("long")


def start_scoring(
    stream: DataFrame,
    sensors: Sequence[str],
    scorer: Callable[[DataFrame], DataFrame],
    state_path: str,
    out_path: str,
    checkpoint: str,
    *,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Run X1 (:class:`ScoringJob`)."""
    return ScoringJob(stream.sparkSession, sensors, scorer, state_path, out_path, **options).start(stream, checkpoint, trigger)
