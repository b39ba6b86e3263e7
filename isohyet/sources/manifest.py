"""Append-only manifest of processed datasets."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.sources import runs

SCHEMA = "dataset string, stage string, status string, error string, ts timestamp_ntz"


def record(spark: SparkSession, path: str, entries: Sequence[tuple[str, str, str, str | None]]) -> None:
    """Append (dataset, stage, status, error) entries with the current time."""
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    rows = [(*entry, now) for entry in entries]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    """The manifest, or an empty one when it is absent; files that cannot be read are skipped."""
    if not runs.path_exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).option("ignoreCorruptFiles", "true").parquet(path)


def latest_status(manifest: DataFrame, keys: Sequence[str] = ("dataset",), ts: str = "ts") -> DataFrame:
    """The last entry per dataset. Of two entries at one time, the later name wins."""
    order = F.struct(F.col(ts), F.col("status"))
    return manifest.groupBy(*keys).agg(F.max_by("status", order).alias("status"), F.max(ts).alias(ts))


def batch_summary(manifest: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Entries per status."""
    return manifest.groupBy(*keys, "status").agg(F.count(F.lit(1)).alias("n"))


def failures(manifest: DataFrame, keys: Sequence[str] = ("dataset",)) -> DataFrame:
    """Datasets whose latest entry is a failure, with its error."""
    order = F.struct("ts", "status")
    latest = manifest.groupBy(*keys).agg(F.max_by(F.struct("status", "error", "ts"), order).alias("last"))
    return latest.filter(F.col("last.status") == "failed").select(*keys, "last.error", "last.ts")
