"""Run-time checks of keys and values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def fail_when(condition: Column, message: str, value: Column) -> Column:
    """`value`, or a run-time error where the condition holds."""
    return F.when(condition, F.raise_error(F.lit(message))).otherwise(value)


def one_per_key(df: DataFrame, keys: Sequence[str], values: Sequence[str], what: str) -> DataFrame:
    """Check that each key occurs once, while the plan runs.

    The aggregate hashes by the keys, so a join on the same keys that follows
    needs no further shuffle, and duplicates are combined before it.
    """
    rows = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.max(v).alias(v) for v in values]
    )
    message = f"{what}: more than one row for a key of ({', '.join(keys)})"
    checked = [fail_when(F.col("_rows") > 1, message, F.col(v)).alias(v) for v in values]
    return rows.select(*keys, *checked)
