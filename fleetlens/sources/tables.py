"""Readers for the sensor tables used by the queries.

The driver's ``events`` table stands in for a fleet's readings: a user is a unit,
its events in time order are its cycles, ``value`` and the JSON property ``k`` are
two sensors and an ``error`` event is a positive label.  ``lineitem`` gives a
four-feature numeric table for profiling and drift.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.columns import nan_to_null
from fleetlens.operators.series import assign_cycle
from fleetlens.session import materialize

# Fixed values of the driver-table mapping.
EVENT_SENSORS = ["value", "k"]
DRIFT_SPLIT_TS = "2024-01-16 00:00:00"
LINEITEM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINEITEM_SPLIT_DATE = "1998-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events projected to reading columns (no cycle yet); NaN -> NULL at ingest."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("unit_id"),
        "ts",
        "event_id",
        nan_to_null(F.col("value")).alias("value"),
        nan_to_null(F.get_json_object("props", "$.k").try_cast("double")).alias("k"),
        (F.col("event_type") == F.lit("error")).cast("int").alias("is_error"),
    )


_SERIES_TABLES: dict[tuple, DataFrame] = {}
_LONGEST: dict[tuple, int] = {}


def table_version(spark: SparkSession, path: str) -> tuple:
    """(files, bytes, latest change) of a table's folder or file."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    return len(found), sum(f.getLen() for f in found), max((f.getModificationTime() for f in found), default=0)


def event_series(spark: SparkSession, sf_dir: str, reuse: bool = True) -> DataFrame:
    """Readings with a dense per-unit ``cycle`` ordered by (ts, event_id).

    Numbering writes a table to the checkpoint folder (see ``assign_cycle``);
    with ``reuse`` every later job of the same application reads that table
    instead of numbering again -- the series view is built once, like the
    reference's processed table -- until the files of the table change."""
    key = (spark.sparkContext.applicationId, sf_dir, table_version(spark, f"{sf_dir}/events.parquet"))
    if reuse and key in _SERIES_TABLES:
        return _SERIES_TABLES[key]
    out = materialize(assign_cycle(event_readings(spark, sf_dir), "unit_id", ["ts", "event_id"]), "series")
    if reuse:
        _SERIES_TABLES[key] = out
    return out


def longest_series(spark: SparkSession, sf_dir: str) -> int:
    """The largest ``cycle`` of :func:`event_series`, looked up once per table."""
    df = event_series(spark, sf_dir)
    key = (spark.sparkContext.applicationId, df._written_at)
    if key not in _LONGEST:
        _LONGEST[key] = df.agg(F.max("cycle")).first()[0] or 0
    return _LONGEST[key]


def lineitem_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_shipdate", *[nan_to_null(F.col(c)).alias(c) for c in LINEITEM_FEATURES])
