"""Gridded-climate analytics as Spark jobs.

Cubes are long DataFrames, one row per (model, scenario, time, cell); every
operator takes and returns DataFrames.
"""

__version__ = "0.1.0"
