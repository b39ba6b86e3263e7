"""Dataset names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dataset_name(model: Column, scenario: Column, variable: Column) -> Column:
    """`model_scenario_variable`; missing when a part is missing."""
    return F.concat(model, F.lit("_"), scenario, F.lit("_"), variable)
