"""Fitting, scoring and their metrics, at the default hyperparameters and with early stopping by patience.

A model is fitted once per application and table folder, stored, and read by every query that needs it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.operators import learning as ml
from isohyet.operators.grids import grid_of
from isohyet.plans import preprocess, scoring, training as train_plan
from isohyet.queries.alignment import TRAINING_SQL, TRAINING_TABLES, training
from isohyet.queries.base import multi, observed, observed_points, query, r6, raw_target, scratch
from isohyet.queries.sqltext import linear_tables
from isohyet.sources import registry, sinks

_FOLDERS: dict[tuple[str, str], str] = {}
_FITTED: set[str] = set()
# Model type, algorithm and rows of each stored model, by its file name.
FITS = {
    "gbt_tas": ("temperature", "gbt"), "rf_tas": ("temperature", "rf"), "gbt_pr": ("precipitation", "gbt"),
    "gbt_pr_occ": ("precipitation_occurrence", "gbt"), "gbt_pr_amt": ("precipitation", "gbt"),
}


def folder_of(spark, sf) -> str:
    """Where the application keeps the training table and the models of one table folder; the table is written once."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FOLDERS:
        folder = scratch(spark)
        train_plan.save_training_table(training(spark, sf), f"{folder}/training")
        _FOLDERS[key] = folder
    return _FOLDERS[key]


def table_of(spark, sf) -> DataFrame:
    return sinks.read_split(spark, f"{folder_of(spark, sf)}/training").filter(F.col("split").isNotNull())


def rows_of(spark, sf, name: str) -> DataFrame:
    """The rows a model is fitted on and judged by."""
    rows = ml.with_wet(table_of(spark, sf))
    return rows.filter("era_tp_mm > 0") if name.endswith("_amt") else rows


def stored(spark, sf, name: str) -> ml.DownscalingModel:
    """One of FITS, fitted where that has not happened yet, as it comes back from its folder."""
    path = f"{folder_of(spark, sf)}/models/{name}"
    if path not in _FITTED:
        kind, algorithm = FITS[name]
        ml.DownscalingModel(kind, algorithm).fit(rows_of(spark, sf, name), early_stopping=True).save(path)
        _FITTED.add(path)
    return ml.DownscalingModel.load(path)


def _metrics(name: str):
    return lambda spark, sf: stored(spark, sf, name).evaluate(rows_of(spark, sf, name))


query("fit_temperature")(_metrics("gbt_tas"))
query("fit_temperature_forest")(_metrics("rf_tas"))
query("fit_precip")(_metrics("gbt_pr"))
query("fit_occurrence")(_metrics("gbt_pr_occ"))
query("fit_amount")(_metrics("gbt_pr_amt"))
# Saved and loaded again, as all of them.
query("save_load")(_metrics("gbt_tas"))


@query("early_stop")
def _(spark, sf):
    """The validation error of every round until patience ran out, and the rounds that the model keeps."""
    return stored(spark, sf, "gbt_tas").curve(spark)


def _base_sql(name: str, target: str, where: str = "true") -> str:
    """Rows of each split, and the error of the mean of the training rows: what a model is held against."""
    return f"""select '{name}' as model, split, count(*) as n_rows, {r6(f'sqrt(avg(({target} - m)*({target} - m)))', 'mean_rmse')}, true as agrees,
        case when split = 'train' then true end as beats_mean
        from (select *, avg(case when split = 'train' then {target} end) over () as m from (
            select split, era_t2m_degC as t, era_tp_log1p as p, case when era_tp_mm > 0 then 1.0 else 0.0 end as wet
            from ({TRAINING_SQL}) where split is not null and {where})) group by split"""


@query("fit_checks", " union all ".join(_base_sql(*args) for args in (
    ("gbt_tas", "t"), ("rf_tas", "t"), ("gbt_pr", "p"), ("gbt_pr_occ", "wet"), ("gbt_pr_amt", "p", "era_tp_mm > 0"))), TRAINING_TABLES)
def _(spark, sf):
    """Every fitted model: its rows, whether its metrics are those of its stored predictions, and whether it beats the mean in training.

    Where nothing can be learned (a target that does not vary, rows too few for a split) the mean itself will do.
    """
    return reduce(DataFrame.unionByName, [_compared(spark, sf, name) for name in FITS])


def _compared(spark, sf, name: str) -> DataFrame:
    model = stored(spark, sf, name)
    rows = rows_of(spark, sf, name)
    path = f"{folder_of(spark, sf)}/predictions/{name}"
    predictions = model.predict(rows, "_score").select("split", F.col(model.target).cast("double").alias("y"), "_score")
    sinks.write_table(predictions, path)
    kept = sinks.read_table(spark, path)
    # The mean is held against the values as the training query gives them, to six places.
    kept = kept.withColumn("_y6", F.round("y", 6))
    mean = kept.filter("split = 'train'").agg(F.avg("_y6").alias("_mean"), F.avg("y").alias("_own"))
    square = lambda y, x: F.sqrt(F.avg((F.col(y) - x) ** 2))
    # A one-row table.
    again = kept.join(F.broadcast(mean)).groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), square("_y6", F.col("_mean")).alias("mean_rmse"), square("y", F.col("_own")).alias("_own_rmse"),
        square("y", F.col("_score")).alias("_rmse"),
        F.avg(((F.col("_score") > 0.5).cast("int") == F.col("y")).cast("int")).alias("_right"))
    told = model.evaluate(rows)
    name_of, value = ("accuracy", "_right") if model.occurrence else ("rmse_log" if "rmse_log" in told.columns else "rmse", "_rmse")
    # Without training rows both are missing, and the metrics of a classifier have no row.
    agrees = F.coalesce((F.abs(F.col("_told") - F.col(value)) < 1e-9) | (F.col("_told").isNull() & F.col(value).isNull()), F.lit(False))
    return again.join(told.select("split", F.col(name_of).alias("_told")), "split", "left").select(
        F.lit(name).alias("model"), "split", "n_rows", "mean_rmse", agrees.alias("agrees"),
        F.when(F.col("split") == "train", F.col("_rmse") < F.col("_own_rmse") + 1e-9).alias("beats_mean"))


@query("evaluate_split")
def _(spark, sf):
    """The metrics that the fit left in the history, per split."""
    model = stored(spark, sf, "gbt_tas")
    rows = [(s, k, None if v is None else float(v)) for s, m in model.history["metrics"].items() for k, v in m.items()]
    return spark.createDataFrame(rows, "split string, metric string, value double")


@query("feature_importance")
def _(spark, sf):
    return stored(spark, sf, "gbt_tas").feature_importance(spark)


@query("train_two_stage")
def _(spark, sf):
    pair = ml.ModelSet(None, None, stored(spark, sf, "gbt_pr_occ"), stored(spark, sf, "gbt_pr_amt"))
    return ml.evaluate_two_stage(table_of(spark, sf), pair)


def trained(spark, sf) -> ml.ModelSet:
    """The stored models of a scoring run, found again by name."""
    for name in ("gbt_tas", "gbt_pr_occ", "gbt_pr_amt"):
        stored(spark, sf, name)
    folder = f"{folder_of(spark, sf)}/models"
    names = spark.createDataFrame([(f"{folder}/{n}",) for n in ("gbt_tas", "gbt_pr_occ", "gbt_pr_amt")], "path string")
    return ml.ModelSet.load(registry.resolve_models(names))


def raw_scenarios(spark, sf):
    """Raw cells of five models and two scenarios under climate-model names."""
    return multi(spark, sf).select(
        "model", "scenario", F.col("time").alias("TIME"), F.col("lat").alias("YAX"), F.col("lon").alias("XAX"),
        F.col("tas").alias("TMP"), F.col("pr").alias("PRE"),
    )


@query("score_scenarios")
def _(spark, sf):
    grid = grid_of(observed_points(spark, sf))
    models = trained(spark, sf)
    return scoring.downscale(raw_scenarios(spark, sf), models, grid)


@query("downscale_all")
def _(spark, sf):
    """The stored predictions of every pair and the ensemble over them, each dataset with the status of the run; pairs without input have no cells."""
    grid = grid_of(observed_points(spark, sf))
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    folder = f"{scratch(spark)}/downscaled"
    status = scoring.downscale_all(spark, raw_scenarios(spark, sf), trained(spark, sf), grid, folder, names, ["ssp126", "ssp585"])
    cells = sinks.read_table(spark, f"{folder}/data").select("model", "scenario", "time", "lat", "lon", F.col("tas").cast("double"), F.col("pr").cast("double"))
    spread = {n: F.lit(None).cast(kind) for n, kind in (("n_models", "long"), ("tas_std", "double"), ("pr_std", "double"))}
    pairs = status.join(cells, ["model", "scenario"], "left").withColumns(spread)
    mean = sinks.read_table(spark, f"{folder}/ensemble").select(
        F.lit("ensemble").alias("model"), "scenario", F.lit("completed").alias("status"), F.lit(None).cast("string").alias("error"), "time", "lat", "lon",
        F.col("tas_mean").alias("tas"), F.col("pr_mean").alias("pr"), "n_models", "tas_std", "pr_std")
    return pairs.unionByName(mean)


_STORED = ", ".join(f"{e} as {n}" for e, n in (("yr", "year"), ("mon", "month")))
_CELLS = f"{_STORED}, lat, lon, {r6('tas', 'tas')}, {r6('pr', 'pr')}"


@query("process_and_save", f"""with {linear_tables('monthly_95', 'obs', 'tgt', ('yr', 'mon'), extra='raw_target, obs')},
    {linear_tables('multi_hist', 'obs', 'models', ('model', 'yr', 'mon'), extra='multi', prefix='m_')}
    select 'reference' as dataset, {_CELLS}, 'completed' as status from obs where yr between 1995 and 1998
    union all select 'target', {_CELLS}, 'completed' from tgt union all select model, {_CELLS}, 'completed' from models
    union all select 'NO-SUCH-MODEL', null, null, null, null, null, null, 'failed'""")
def _(spark, sf):
    """All stored cells of all cubes with the status that the log has of them."""
    reference = observed(spark, sf).withColumnsRenamed({"tas": "tmp", "pr": "pre"})
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "NO-SUCH-MODEL"]
    out = f"{scratch(spark)}/processed"
    log = preprocess.process_and_save(
        spark, reference, raw_target(spark, sf), raw_scenarios(spark, sf), out, names, years=(1995, 1998),
    )
    cells = [sinks.read_table(spark, f"{out}/{n}").withColumn("dataset", F.lit(n)) for n in ("reference", "target")]
    cells.append(sinks.read_table(spark, f"{out}/models").withColumn("dataset", F.col("model")))
    stored_cells = reduce(DataFrame.unionByName, [c.select(
        "dataset", F.year("time").alias("year"), F.month("time").alias("month"), "lat", "lon", "tas", "pr") for c in cells])
    return stored_cells.join(F.broadcast(log.select("dataset", "status")), "dataset", "right")


@query("process_bad_model", """select distinct model as dataset, case when model = '2-HIGH' then 'failed' else 'completed' end as status,
    model = '2-HIGH' as twice from multi""", ("multi",))
def _(spark, sf):
    """A model with repeated cells is logged and does not stop the others."""
    reference = observed(spark, sf).withColumnsRenamed({"tas": "tmp", "pr": "pre"})
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    raw = raw_scenarios(spark, sf)
    raw = raw.unionByName(raw.filter("model = '2-HIGH'"))
    log = preprocess.process_and_save(
        spark, reference, raw_target(spark, sf), raw, f"{scratch(spark)}/processed", names, years=(1995, 1998))
    return log.filter(F.col("dataset").isin(*names)).select(
        "dataset", "status", F.coalesce(F.col("error").endswith("cells that stand twice"), F.lit(False)).alias("twice"))
