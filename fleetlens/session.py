"""Session helpers: building a local session for tests/bench and resolving the
reliable checkpoint folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "fleetlens") -> SparkSession:
    """A local session configured like the tests and the bench expect."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # PySpark-side call-site capture costs ~5 extra JVM round trips per
        # Column function; wide feature plans build thousands of them
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``
    (read from the session, never overridden).  Only a local-mode session with
    no folder configured (tests, bench) gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="fleetlens-ckpt-", dir=os.environ.get("FLEETLENS_SCRATCH", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the reliable checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/fleetlens-{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage", dictionary: bool = True) -> DataFrame:
    """Write ``df`` as Parquet under the reliable checkpoint folder and read it back.

    One job (a DataFrame checkpoint computes its input twice unless cached); the
    files live in shared storage, so a lost executor costs a re-read, not a
    recomputation, and every later use sees exactly the same rows.  Wide tables of
    measured values are written faster without a ``dictionary`` of each column."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").option("parquet.enable.dictionary", str(dictionary).lower()).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_at = path
    _written.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    return out


_written: dict[str, list[str]] = {}


def discard_all(spark: SparkSession, keep: tuple[str, ...] = ("series", "featured", "leaderboard")) -> int:
    """Delete the tables that :func:`materialize` wrote in this application, but those of
    the labels ``keep``, which are read again; for the end of a run, when no result that
    reads the others is still to be computed.  Returns how many."""
    application = spark.sparkContext.applicationId
    kept = [p for p in _written.get(application, []) if any(f"/fleetlens-{label}-" in p for label in keep)]
    gone = [p for p in _written.get(application, []) if p not in kept]
    for path in gone:
        _delete(spark, path)
    _written[application] = kept
    return len(gone)


def _delete(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that :func:`materialize` wrote, once nothing that is
    still to run reads them.  Other tables are left alone."""
    path = getattr(df, "_written_at", None)
    if path is None:
        return
    _delete(df.sparkSession, path)
    written = _written.get(df.sparkSession.sparkContext.applicationId, [])
    if path in written:
        written.remove(path)


def broadcast_if_small(df: DataFrame, max_rows: int = 2_000_000) -> DataFrame:
    """Broadcast hint only behind a checked row count; otherwise a shuffle join.

    The count runs on a side that is already aggregated (one row per key), so it
    is cheap; the bound keeps the broadcast table far below executor memory.
    """
    n = df.count()
    return F.broadcast(df) if n <= max_rows else df
