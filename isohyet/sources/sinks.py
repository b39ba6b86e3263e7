"""Sinks. Writes are rebalanced by their partition columns, so a large model
or year is split over tasks and a small one makes one file. Tables are written in
runs of their own and are read by their last commit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isohyet.constants import OUTPUT_ATTRIBUTES, TARGET_RESOLUTION
from isohyet.operators.naming import to_float32
from isohyet.sources import runs


@dataclass(frozen=True)
class Staged:
    """A run that is written and not yet visible."""

    path: str
    folder: str
    schema: T.StructType


def stage_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> Staged:
    """Write a run as snappy Parquet; `commit_table` makes it visible."""
    folder = runs.new_run(path)
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    rows.write.option("compression", "snappy").partitionBy(*partition_by).parquet(folder)
    return Staged(path, folder, T.StructType([f for f in df.schema if f.name not in partition_by] + [df.schema[c] for c in partition_by]))


def commit_table(spark: SparkSession, staged: Staged, keys: Sequence[str] = (), values: Sequence[Sequence[str]] = ()) -> None:
    """Make a staged run the table; with `keys` only its rows whose keys have one of `values`, the rest of the table stays.

    The run before stays readable for readers that are at work; older ones go.
    """
    runs.commit(spark, staged.path, staged.folder, staged.schema, keys, values)
    runs.vacuum(spark, staged.path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), keys: Sequence[str] = (),
                values: Sequence[Sequence[str]] = ()) -> None:
    """Stage and commit a table, or with `keys` the rows whose keys have one of `values`, which `df` holds."""
    commit_table(df.sparkSession, stage_table(df, path, partition_by), keys, values)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """What the last finished run left."""
    return runs.read(spark, path)


def read_split(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """The training table, or one split of it by partition pruning."""
    df = read_table(spark, path)
    return df.filter(F.col("split") == split) if split else df


def downscaled_table(df: DataFrame, values: Mapping[str, str] | None = None) -> DataFrame:
    """Predictions as stored: float32 `tas` and `pr` with unit and name metadata."""
    values = values or {"pred_tas": "tas", "pred_pr": "pr"}
    out = to_float32(df.withColumnsRenamed(dict(values)), list(values.values()))
    for name in values.values():
        out = out.withMetadata(name, OUTPUT_ATTRIBUTES[name])
    return out


def write_downscaled(df: DataFrame, path: str, model_paths: Mapping[str, object], algorithm: str,
                     pairs: DataFrame | None = None) -> None:
    """Predictions by scenario and model, and provenance rows beside them.

    `pairs` are the (model, scenario) of this run; the data of other pairs and the provenance of
    earlier runs stay as they were written. Without it the pairs are taken from `df`.
    """
    made = df.select("model", "scenario").distinct() if pairs is None else pairs
    # A list of requested pairs, not of rows.
    values = [(r["scenario"], r["model"]) for r in made.distinct().collect()]
    write_table(downscaled_table(df), f"{path}/data", ("scenario", "model"), ("scenario", "model"), values)
    provenance(made, model_paths, algorithm).repartition(1).write.mode("append").json(f"{path}/provenance")


def provenance(df: DataFrame, model_paths: Mapping[str, object], algorithm: str) -> DataFrame:
    """One row per model, scenario and variable with what made it."""
    pairs = df.select("model", "scenario").distinct()
    used = {
        "tas": {"model_file": model_paths.get("tas_path")},
        "pr": {"precip_occurrence_model": model_paths.get("occ_path"), "precip_amount_model": model_paths.get("amt_path"),
               "model_file": model_paths.get("pr_path")},
    }

    def attributes(name: str) -> F.Column:
        entries = {**OUTPUT_ATTRIBUTES[name], **{k: str(v) for k, v in used[name].items() if v},
                   "model_algorithm": algorithm, "target_resolution": TARGET_RESOLUTION}
        flat = [F.lit(x) for item in entries.items() for x in item]
        return F.struct(F.lit(name).alias("variable"), F.create_map(*flat).alias("attributes"))

    rows = pairs.select("model", "scenario", F.explode(F.array(attributes("tas"), attributes("pr"))).alias("r"))
    return rows.select("model", "scenario", "r.*", F.current_timestamp().alias("creation_date"))


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics.repartition(1).write.mode("overwrite").json(path)
