"""Classification metrics and exact ranks over scores of any number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from isohyet.functions.statistics import both
from isohyet.session import checkpoint_dir

def _number(score: Column) -> Column:
    """The score as a double; NaN counts as missing."""
    value = score.cast("double")
    return F.when(~F.isnan(value), value)


def score_counts(df: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score; tied rows collapse here.

    Rows that miss the label or the score are left out.
    """
    pairs = df.withColumn("_score", _number(F.col(score))).filter(both(F.col(label), F.col("_score")))
    return pairs.groupBy(*keys, F.col("_score").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("n_pos"), F.count_if(F.col(label) != 1).alias("n_neg")
    )


def totals_below(counts: DataFrame, values: Sequence[str], keys: Sequence[str] = (), by: str = "score",
                 ranges: int | None = None) -> DataFrame:
    """Add <v>_below: the total of <v> over all rows with a smaller `by` (and the same keys).

    `counts` holds each `by` once per key, without NaN. A range exchange deals it out by
    `by`, and is stored in the shared folder, so the ranges are the same for all that follows and
    the input is run once. Sums run inside each range and are shifted by the totals of the ranges
    before it: no task ever sorts the whole, whatever the distribution. `ranges` is
    the number of ranges, by default the session's number of shuffle partitions. A missing key is a group like any other.
    """
    checkpoint_dir(counts.sparkSession)
    dealt = counts.repartitionByRange(ranges, by) if ranges else counts.repartitionByRange(by)
    ranged = dealt.withColumn("_range", F.spark_partition_id()).checkpoint()
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range and key.
    shift = ranged.groupBy(*keys, "_range").agg(*[F.sum(v).alias(v) for v in values]).select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_range").alias("_key__range"),
        *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_shift_{v}") for v in values],
    )
    inside = Window.partitionBy(*keys, "_range").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumns({f"{v}_below": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values})
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in (*keys, "_range")]
    return local.join(shift, same).withColumns(
        {f"{v}_below": F.col(f"{v}_below") + F.col(f"_shift_{v}") for v in values}
    ).drop("_range", "_key__range", *[f"_key_{k}" for k in keys], *[f"_shift_{v}" for v in values])


def tied_ranks(df: DataFrame, score: str, keys: Sequence[str] = (),
               ranges: int | None = None) -> DataFrame:
    """Each distinct score with its row count and its average rank, ties shared."""
    rows = df.withColumn("_score", _number(F.col(score))).filter(F.col("_score").isNotNull())
    counts = rows.groupBy(*keys, F.col("_score").alias("score")).agg(
        F.count(F.lit(1)).alias("n")
    )
    ranked = totals_below(counts, ["n"], keys, ranges=ranges)
    return ranked.select(*keys, "score", "n", (F.col("n_below") + (F.col("n") + 1) / 2).alias("rank"))


def classification_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5,
                           keys: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """Accuracy, precision, recall and exact ROC AUC, all from the score counts.

    A row is predicted positive when its score is strictly above the threshold.
    Precision and recall are 0 without a denominator. AUC (pairs ranked right,
    ties counted half) is missing when one class is absent.
    """
    ranked = totals_below(score_counts(df, label, score, keys), ["n_neg"], keys, ranges=ranges)
    high = F.col("score") > threshold
    pos, neg = F.sum("n_pos"), F.sum("n_neg")
    true_pos = F.sum(F.when(high, F.col("n_pos")).otherwise(0))
    said_pos = F.sum(F.when(high, F.col("n_pos") + F.col("n_neg")).otherwise(0))
    right = F.sum(F.when(high, F.col("n_pos")).otherwise(F.col("n_neg")))
    ordered = F.sum(F.col("n_pos").cast("double") * (F.col("n_neg_below") + F.col("n_neg") / 2))
    return ranked.groupBy(*keys).agg(
        F.try_divide(right, pos + neg).alias("accuracy"),
        F.coalesce(F.try_divide(true_pos, said_pos), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(true_pos, pos), F.lit(0.0)).alias("recall"),
        F.try_divide(ordered, pos.cast("double") * neg).alias("roc_auc"),
    )
