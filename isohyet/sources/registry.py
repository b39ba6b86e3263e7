"""Model registry: which saved models a scoring run uses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Name patterns of saved models.
TEMPERATURE = r"_tas$"
PRECIPITATION = r"_pr[^/]*$"
OCCURRENCE = r"_pr_(occ|occurrence)"
AMOUNT = r"_pr_(amt|amount)"


class ModelNotFound(ValueError):
    pass


def _name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)/*$", 1)


def select_models(registry: DataFrame, keys: tuple[str, ...] = (), path: str = "path") -> DataFrame:
    """First model per role by name, per directory or other key.

    A precipitation pair (occurrence and amount) goes before a single model.
    Columns: tas_path, occ_path, amt_path, pr_path, two_stage, complete.
    """
    name = _name(F.col(path))

    def first(pattern: str) -> Column:
        return F.min_by(F.when(name.rlike(pattern), F.col(path)), F.when(name.rlike(pattern), F.struct(name, F.col(path))))

    found = registry.groupBy(*keys).agg(
        first(TEMPERATURE).alias("tas_path"), first(OCCURRENCE).alias("_occ"),
        first(AMOUNT).alias("_amt"), first(PRECIPITATION).alias("_pr"),
    )
    two_stage = F.col("_occ").isNotNull() & F.col("_amt").isNotNull()
    return found.select(
        *keys, "tas_path",
        F.when(two_stage, F.col("_occ")).alias("occ_path"), F.when(two_stage, F.col("_amt")).alias("amt_path"),
        F.when(~two_stage, F.col("_pr")).alias("pr_path"), two_stage.alias("two_stage"),
        (F.col("tas_path").isNotNull() & F.col("_pr").isNotNull()).alias("complete"),
    )


def resolve_models(registry: DataFrame | None, tas_path: str | None = None,
                   pr_path: str | None = None) -> dict[str, str | bool | None]:
    """The paths a run uses; explicit paths fill what the registry lacks."""
    found = None if registry is None else select_models(registry).first()
    out = {
        "tas_path": (found and found["tas_path"]) or tas_path,
        "occ_path": found and found["occ_path"], "amt_path": found and found["amt_path"],
        "pr_path": found and found["pr_path"], "two_stage": bool(found and found["two_stage"]),
    }
    if not out["two_stage"]:
        out["pr_path"] = out["pr_path"] or pr_path
    if out["tas_path"] is None or not (out["two_stage"] or out["pr_path"]):
        raise ModelNotFound("no temperature or precipitation model found")
    return out
