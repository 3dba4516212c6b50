"""Keyed state between micro-batches, as tables in shared storage.

Each micro-batch upserts the rows of the keys it touched as a *delta* folder named by
its batch id; every ``compact_every`` batches the latest rows of all keys are written
as a *snapshot*.  A read takes the newest snapshot and the deltas after it, so its work
follows the number of keys, not the length of the history.  A batch reads only versions
below its own id and overwrites its own folder, so a replayed batch gives the same state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, path: str) -> list[int]:
    """Batch ids whose folders under ``path`` are complete, ascending."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    found = [s.getPath() for s in fs.listStatus(p) if s.isDirectory()]
    done = [f.getName() for f in found if f.getName().startswith("batch_id=") and fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS"))]
    return sorted(int(name.split("=")[1]) for name in done)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def write_version(df: DataFrame, path: str, batch_id: int) -> None:
    """One folder per batch id: a replayed batch overwrites its own output only."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_version(spark: SparkSession, path: str, before: int) -> DataFrame | None:
    """The newest version below ``before`` (for state that each batch writes whole)."""
    ids = [v for v in versions(spark, path) if v < before]
    return spark.read.parquet(f"{path}/batch_id={ids[-1]}") if ids else None


class StateTable:
    """The latest row of every key (NULL is a key of its own)."""

    def __init__(self, spark: SparkSession, path: str, key: str, compact_every: int = 16):
        self.spark, self.path, self.key, self.compact_every = spark, path, key, compact_every

    def read(self, before: int, touched: DataFrame | None = None) -> DataFrame | None:
        """Latest rows as of the batches below ``before``; with ``touched`` (a column
        ``_key`` of one-field structs) those of its keys only.  None without state."""
        whole = [v for v in versions(self.spark, f"{self.path}/snapshot") if v < before]
        since = whole[-1] if whole else -1
        later = [v for v in versions(self.spark, f"{self.path}/delta") if since < v < before]
        folders = ([f"{self.path}/snapshot/batch_id={since}"] if whole else []) + [f"{self.path}/delta/batch_id={v}" for v in later]
        if not folders:
            return None
        # basePath gives each row the batch_id of its folder
        parts = [self.spark.read.option("basePath", f.rsplit("/", 1)[0]).parquet(f) for f in folders]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        rows = rows.withColumn("_key", F.struct(self.key))
        if touched is not None:
            rows = rows.join(touched, "_key", "left_semi")
        values = [c for c in rows.columns if c not in ("_key", "batch_id")]
        best = rows.groupBy("_key").agg(F.max_by(F.struct(*values), "batch_id").alias("_row"))
        return best.select("_row.*")

    def upsert(self, rows: DataFrame, batch_id: int) -> None:
        write_version(rows, f"{self.path}/delta", batch_id)
        whole = versions(self.spark, f"{self.path}/snapshot")
        deltas = [v for v in versions(self.spark, f"{self.path}/delta") if v > (whole[-1] if whole else -1)]
        if len(deltas) >= self.compact_every:
            write_version(self.read(batch_id + 1), f"{self.path}/snapshot", batch_id)
            self._prune(whole)

    def _prune(self, whole: Sequence[int]) -> None:
        """Versions older than the snapshot before the one just written."""
        if not whole:
            return
        for kind in ("snapshot", "delta"):
            for v in versions(self.spark, f"{self.path}/{kind}"):
                if v < whole[-1]:
                    delete(self.spark, f"{self.path}/{kind}/batch_id={v}")
