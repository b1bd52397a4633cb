"""Forecasts without a fit, to hold a learner against."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from volspark.schemas import PREDICTIONS, TARGET


def _as_predictions(scored: DataFrame, predicted) -> DataFrame:
    return scored.withColumn("actual", F.col(TARGET)).withColumn("predicted", predicted).select(
        *PREDICTIONS.names
    )


def persistence(rows: DataFrame) -> DataFrame:
    """The volatility of today as the forecast."""
    return _as_predictions(rows.filter(F.col("refit_id").isNotNull()), F.col("realized_vol"))


def train_mean(rows: DataFrame) -> DataFrame:
    """The mean target of the training rows of each refit.

    Rows are summed per (symbol, first refit that trains on them) before anything is
    ordered; the running total then goes over one row per refit.
    """
    earlier = (
        Window.partitionBy("symbol")
        .orderBy("segment")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    sums = rows.groupBy("symbol", "segment", "refits").agg(
        F.sum(TARGET).alias("total"), F.count(TARGET).alias("rows")
    )
    means = sums.select(
        "symbol",
        "segment",
        "refits",
        F.try_divide(F.sum("total").over(earlier), F.sum("rows").over(earlier)).alias("mean"),
        F.lead("segment").over(Window.partitionBy("symbol").orderBy("segment")).alias("upto"),
    )
    # A segment without rows has the mean of the one before.
    last = F.least(F.coalesce(F.col("upto"), F.col("refits")), F.col("refits")) - 1
    per_refit = means.filter(last >= F.col("segment")).select(
        "symbol", F.explode(F.sequence(F.col("segment"), last)).alias("refit_id"), "mean"
    )
    scored = rows.filter(F.col("refit_id").isNotNull())
    return _as_predictions(
        scored.join(per_refit, ["symbol", "refit_id"], "left"), F.col("mean")
    )


BASELINES = {"persistence": persistence, "train_mean": train_mean}
