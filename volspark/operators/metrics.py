"""Forecast errors per symbol, in one window and one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from volspark.functions import change_sign, decimals_text, percent_text
from volspark.operators.series import WHOLE, SeriesLayout, over_series


def _error() -> Column:
    return F.col("actual") - F.col("predicted")


def in_date_range(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows from ``start`` to ``end``, both included; an empty bound is no bound."""
    if start:
        df = df.filter(F.col("date") >= F.lit(start).cast("date"))
    if end:
        df = df.filter(F.col("date") <= F.lit(end).cast("date"))
    return df


def mean_absolute_error() -> Column:
    return F.avg(F.abs(_error()))


def root_mean_squared_error() -> Column:
    return F.sqrt(F.avg(_error() * _error()))


def correlation() -> Column:
    """Pearson correlation; NULL where one side is constant, which ``corr`` fails on."""
    spread = F.stddev_pop("actual") * F.stddev_pop("predicted")
    return F.try_divide(F.covar_pop("actual", "predicted"), spread)


def directional_accuracy() -> Column:
    """Share of steps on which both sides move the same way; standing still is a way."""
    return F.avg((F.col("actual_sign") == F.col("predicted_sign")).cast("double"))


def add_directions(predictions: DataFrame, layout: SeriesLayout = WHOLE) -> DataFrame:
    """Add the sign of each step of ``actual`` and ``predicted``."""
    return over_series(
        predictions,
        lambda df, w: df.withColumns(
            {
                "actual_sign": change_sign("actual", w),
                "predicted_sign": change_sign("predicted", w),
            }
        ),
        before=1,
        layout=layout,
    )


def evaluate(
    predictions: DataFrame,
    start: str | None = None,
    end: str | None = None,
    layout: SeriesLayout = WHOLE,
) -> DataFrame:
    """MAE, RMSE, directional accuracy and correlation of each symbol.

    Steps run over fold borders. Dates outside the range leave before the steps are
    taken, so the first row kept has no predecessor.
    """
    kept = in_date_range(predictions, start, end).select("symbol", "date", "actual", "predicted")
    return (
        add_directions(kept, layout)
        .groupBy("symbol")
        .agg(
            F.count("predicted").alias("n"),
            mean_absolute_error().alias("mae"),
            root_mean_squared_error().alias("rmse"),
            directional_accuracy().alias("directional_accuracy"),
            correlation().alias("correlation"),
        )
    )


def format_metrics(metrics: DataFrame) -> DataFrame:
    """The four metrics as display text, one row per symbol."""
    return metrics.select(
        "symbol",
        decimals_text(F.col("mae")).alias("mae"),
        decimals_text(F.col("rmse")).alias("rmse"),
        decimals_text(F.col("correlation")).alias("correlation"),
        percent_text(F.col("directional_accuracy")).alias("directional_accuracy"),
    )


def backtest_period(predictions: DataFrame) -> DataFrame:
    """First and last scored date and the number of predictions."""
    return predictions.groupBy("symbol").agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count(F.lit(1)).alias("n_predictions"),
    )
