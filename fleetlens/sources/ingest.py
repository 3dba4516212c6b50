"""Ingest (S1-S3, S6-S8): raw reading files, remaining-life truth files and
JSON request payloads, with typed parsing, defaults and a quarantine split.

Everything stays distributed: files are read by Spark's split-parallel readers,
line numbers come from the skew-safe numbering of ``assign_cycle`` (never a
whole-file read), and payloads are flattened with ``explode``/``posexplode``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.operators.series import assign_cycle

# Fixed values that must equal the reference's for equal results.
PAYLOAD_SENSORS = [
    "T2_fan_inlet_temp",
    "T24_LPC_outlet_temp",
    "T30_HPC_outlet_temp",
    "T50_LPT_outlet_temp",
    "P2_fan_inlet_pressure",
    "P15_bypass_duct_pressure",
    "P30_HPC_outlet_pressure",
    "Nf_fan_speed",
    "Nc_core_speed",
    "epr_engine_pressure_ratio",
    "Ps30_static_pressure",
    "phi_fuel_flow",
    "NRf_corrected_fan_speed",
    "NRc_corrected_core_speed",
]
READING_DEFAULTS = {"op_setting_1": -0.0006, "op_setting_2": 0.0004, "op_setting_3": 100.0}
DEFAULT_CYCLE = 1
USE_LAST_N_DEFAULT = 10
USE_LAST_N_RANGE = (1, 100)
DEFAULT_UNIT_ID = "unknown"
BATCH_ENGINES_RANGE = (1, 1000)
# Remaining sensor channels of the public run-to-failure files (Saxena et al., 2008),
# after the 14 named above, in file order.
EXTRA_RAW_SENSORS = [
    "BPR_bypass_ratio",
    "farB_burner_fuel_air_ratio",
    "htBleed_bleed_enthalpy",
    "Nf_dmd_demanded_fan_speed",
    "PCNfR_dmd_demanded_corrected_fan_speed",
    "W31_HPT_coolant_bleed",
    "W32_LPT_coolant_bleed",
]
RAW_COLUMNS = ["unit_id", "cycle", "op_setting_1", "op_setting_2", "op_setting_3"] + PAYLOAD_SENSORS + EXTRA_RAW_SENSORS


def raw_schema() -> T.StructType:
    fields = [T.StructField("unit_id", T.LongType()), T.StructField("cycle", T.IntegerType())]
    fields += [T.StructField(c, T.DoubleType()) for c in RAW_COLUMNS[2:]]
    return T.StructType(fields)


def _without_nan(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating-point column (a short text line's missing
    fields are NULL already)."""
    kinds = (T.DoubleType, T.FloatType)
    return df.select(*[F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name) if isinstance(f.dataType, kinds) else F.col(f.name) for f in df.schema.fields])


def read_readings(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """A reading table from Parquet, JSON lines or space-separated text
    (the public run-to-failure format: unit, cycle, 3 settings, 21 sensors).
    An explicit schema is always used for text (no inference pass)."""
    if fmt == "parquet":
        reader = spark.read
        if schema is not None:
            reader = reader.schema(schema)
        return _without_nan(reader.parquet(path))
    if fmt == "json":
        return _without_nan(spark.read.schema(schema or raw_schema()).json(path))
    if fmt in ("text", "space"):
        lines = spark.read.text(path)
        parts = F.split(F.trim(F.col("value")), r"\s+")
        sch = schema or raw_schema()
        cols = [F.get(parts, F.lit(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(sch.fields)]
        return _without_nan(lines.where(F.length(F.trim("value")) > 0).select(*cols))
    raise ValueError(f"unknown format {fmt}")


def sample_units(df: DataFrame, n_units: int, unit: str = "unit_id") -> DataFrame:
    """All rows of the first ``n_units`` units in unit order (a sampling
    operator: the limit is the feature).  Semi-join, so rows are not copied."""
    keep = df.select(unit).distinct().orderBy(unit).limit(n_units)
    return df.join(keep, unit, "left_semi")


def read_rul_truth(spark: SparkSession, path: str, unit_col: str = "unit_id", rul_col: str = "rul") -> DataFrame:
    """S3: remaining-life truth text (one integer per line, line number = unit).

    Lines are read split-parallel; their numbers come from the position in the
    file (scan order id) turned dense by :func:`assign_cycle`, per file.  Every line
    counts; blank and non-numeric ones are left out after numbering, so they do not
    shift the units behind them."""
    lines = spark.read.text(path).select(
        F.input_file_name().alias("_file"),
        F.monotonically_increasing_id().alias("_pos"),
        F.regexp_extract(F.col("value"), r"^\s*(-?\d+)\s*$", 1).alias("_num"),
    )
    numbered = assign_cycle(lines, "_file", ["_pos"], cycle=unit_col).where(F.col("_num") != "")
    return numbered.select(F.col(unit_col).cast("long").alias(unit_col), F.col("_num").cast("int").alias(rul_col), "_file")


# ── payloads ────────────────────────────────────────────────────────────────


def reading_schema(sensors: Sequence[str] = PAYLOAD_SENSORS, defaults: dict | None = None) -> T.StructType:
    defaults = READING_DEFAULTS if defaults is None else defaults
    fields = [T.StructField(s, T.DoubleType()) for s in sensors]
    fields += [T.StructField(c, T.DoubleType()) for c in defaults]
    fields.append(T.StructField("cycle", T.LongType()))
    return T.StructType(fields)


def request_schema(sensors: Sequence[str] = PAYLOAD_SENSORS, defaults: dict | None = None) -> T.StructType:
    return T.StructType(
        [
            T.StructField("unit_id", T.StringType()),
            T.StructField("readings", T.ArrayType(reading_schema(sensors, defaults))),
            T.StructField("use_last_n", T.LongType()),
        ]
    )


def batch_schema(sensors: Sequence[str] = PAYLOAD_SENSORS, defaults: dict | None = None) -> T.StructType:
    return T.StructType([T.StructField("engines", T.ArrayType(request_schema(sensors, defaults)))])


def parse_requests(df: DataFrame, json_col: str = "payload", sensors: Sequence[str] = PAYLOAD_SENSORS, defaults: dict | None = None) -> DataFrame:
    """JSON request strings -> typed request structs (one row per request),
    keeping a request id.  Malformed JSON gives a NULL request (quarantined)."""
    return df.select(
        F.monotonically_increasing_id().alias("request_id") if "request_id" not in df.columns else F.col("request_id"),
        F.from_json(F.col(json_col), request_schema(sensors, defaults)).alias("req"),
        # from_json is permissive (all-NULL struct on bad input); this flags it
        F.json_object_keys(F.col(json_col)).isNotNull().alias("_json_ok"),
    )


def flatten_requests(
    requests: DataFrame,
    sensors: Sequence[str] = PAYLOAD_SENSORS,
    defaults: dict | None = None,
    *,
    explicit_unit: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Request structs -> (valid readings, quarantine).

    One row per reading: the parent's ``unit_id`` (default 'unknown'), the
    reading position ``pos`` (the tie-break when cycles repeat, e.g. the default
    cycle 1), defaults filled for optional fields.  Rule violations go to the
    quarantine table as ``(request_id, pos, rule)`` instead of failing the batch:
    malformed request, no readings, ``use_last_n`` outside 1..100, a missing
    required sensor, ``cycle`` < 1."""
    defaults = READING_DEFAULTS if defaults is None else defaults
    lo, hi = USE_LAST_N_RANGE
    req = requests.select(
        "request_id",
        (F.col("req").isNull() | (~F.col("_json_ok") if "_json_ok" in requests.columns else F.lit(False))).alias("_bad_json"),
        F.coalesce(F.col("req.unit_id"), F.lit(DEFAULT_UNIT_ID)).alias("unit_id") if explicit_unit is None else explicit_unit.alias("unit_id"),
        F.coalesce(F.col("req.use_last_n"), F.lit(USE_LAST_N_DEFAULT)).alias("use_last_n"),
        F.col("req.readings").alias("readings"),
    )
    req_rules = [
        ("malformed_request", F.col("_bad_json")),
        ("no_readings", ~F.col("_bad_json") & (F.coalesce(F.size("readings"), F.lit(0)) <= 0)),
        ("use_last_n_out_of_range", ~F.col("_bad_json") & ((F.col("use_last_n") < lo) | (F.col("use_last_n") > hi))),
    ]
    req_q = req.select(
        "request_id", F.lit(None).cast("int").alias("pos"),
        F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in req_rules]))).alias("rule"),
    )
    ok_req = req.where(~F.col("_bad_json") & (F.size("readings") > 0) & F.col("use_last_n").between(lo, hi))
    rows = ok_req.select("request_id", "unit_id", "use_last_n", F.posexplode("readings").alias("pos", "r"))
    cols = [F.col(f"r.{s}").alias(s) for s in sensors]
    cols += [F.coalesce(F.col(f"r.{c}"), F.lit(float(v))).alias(c) for c, v in defaults.items()]
    cols.append(F.coalesce(F.col("r.cycle"), F.lit(DEFAULT_CYCLE)).alias("cycle"))
    flat = rows.select("request_id", "unit_id", "use_last_n", F.col("pos").cast("int").alias("pos"), *cols)
    row_rules = [(f"missing_{s}", F.col(s).isNull()) for s in sensors] + [("cycle_below_1", F.col("cycle") < 1)]
    flagged = flat.withColumn("_rules", F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in row_rules])))
    row_q = flagged.where(F.size("_rules") > 0).select("request_id", "pos", F.explode("_rules").alias("rule"))
    valid = flagged.where(F.size("_rules") == 0).drop("_rules")
    return valid, req_q.unionByName(row_q)


def flatten_batch(batches: DataFrame, json_col: str = "payload", sensors: Sequence[str] = PAYLOAD_SENSORS, defaults: dict | None = None):
    """Batch payloads ``{"engines": [request, ...]}`` -> (valid readings,
    quarantine); engines become requests with id "batch:position", the batch id being the
    column ``batch_id`` where there is one.  A batch that cannot be read, has no engine or
    more than 1,000 is quarantined whole."""
    ids = F.col("batch_id").cast("string") if "batch_id" in batches.columns else F.monotonically_increasing_id().cast("string")
    parsed = batches.select(ids.alias("batch_id"), F.from_json(F.col(json_col), batch_schema(sensors, defaults)).alias("b"))
    lo, hi = BATCH_ENGINES_RANGE
    n = F.size("b.engines")
    rule = F.when(F.col("b.engines").isNull(), "malformed_batch").when(n < lo, "empty_batch").when(n > hi, "too_many_engines")
    judged = parsed.withColumn("_rule", rule)
    engines = judged.where("_rule is null").select("batch_id", F.posexplode("b.engines").alias("engine_pos", "req"))
    requests = engines.select(F.concat_ws(":", "batch_id", "engine_pos").alias("request_id"), "req")
    valid, quarantine = flatten_requests(requests, sensors, defaults)
    bad = judged.where("_rule is not null").select(F.col("batch_id").alias("request_id"), F.lit(None).cast("int").alias("pos"), F.col("_rule").alias("rule"))
    return valid, quarantine.unionByName(bad)


def order_readings(valid: DataFrame, unit: str = "unit_id") -> DataFrame:
    """Dense per-(request, unit) cycle order from (cycle, pos): repeated cycles
    (default 1) keep their position order (trap T5)."""
    keyed = valid.withColumn("_series", F.concat_ws("|", F.col("request_id").cast("string"), F.col(unit).cast("string")))
    out = assign_cycle(keyed.withColumnRenamed("cycle", "reported_cycle"), "_series", ["reported_cycle", "pos"])
    return out.drop("_series")


def quarantine_summary(quarantine: DataFrame, sensors: Sequence[str] = PAYLOAD_SENSORS) -> DataFrame:
    """Violation count per quarantine rule, every rule listed (zeros included)."""
    rules = ["malformed_request", "no_readings", "use_last_n_out_of_range"] + [f"missing_{s}" for s in sensors] + ["cycle_below_1"]
    counts = quarantine.groupBy("rule").agg(F.count(F.lit(1)).alias("violations"))
    names = quarantine.sparkSession.createDataFrame([(r,) for r in rules], "rule string")  # fixed rule list
    return F.broadcast(names).join(counts, "rule", "left").select("rule", F.coalesce("violations", F.lit(0)).cast("long").alias("violations"))
