"""Renames, aliases and unit columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.constants import TRAINING_NAMES, UNUSED_COORDS
from isohyet.functions.units import missing_to_null


def rename_coords(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def standardize_coords(df: DataFrame, values: Sequence[str] = ()) -> DataFrame:
    """Rename the coordinate whose name contains time, lat or lon, in any case.

    `values` are data columns, which keep their names whatever these contain.
    Two coordinates that claim the same name are an error.
    """
    mapping: dict[str, str] = {}
    for name in df.columns:
        if name in values:
            continue
        target = next((t for t in ("time", "lat", "lon") if t in name.lower()), None)
        if target is None:
            continue
        if target in mapping.values():
            raise ValueError(f"two columns look like {target}: {df.columns}")
        mapping[name] = target
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k != v})


def drop_coords(df: DataFrame, names: Sequence[str] = UNUSED_COORDS) -> DataFrame:
    return df.drop(*names)


def alias_variable(df: DataFrame, candidates: Sequence[str], name: str) -> DataFrame:
    """Rename the first candidate that is present."""
    found = next((c for c in candidates if c in df.columns), None)
    if found is None:
        raise KeyError(f"none of {list(candidates)} in {df.columns}")
    return df.withColumnRenamed(found, name)


def rename_training(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(TRAINING_NAMES)


def nulls_for_nan(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: missing_to_null(F.col(c)) for c in columns})


def to_float32(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Narrow values for storage only."""
    return df.withColumns({c: F.col(c).cast("float") for c in columns})
