"""Report tables: what a dashboard of the backtest shows, for all symbols or one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from volspark.functions import symbol_label
from volspark.operators.metrics import evaluate, format_metrics, in_date_range
from volspark.operators.series import (
    WHOLE,
    SeriesLayout,
    add_series_value,
    number_rows,
    over_series,
)

HIGH_VOL, LOW_VOL = 0.25, 0.12


def actual_vs_predicted(
    predictions: DataFrame, start: str | None = None, end: str | None = None
) -> DataFrame:
    return in_date_range(predictions, start, end).select("symbol", "date", "actual", "predicted")


def regime_flags(df: DataFrame, high: float = HIGH_VOL, low: float = LOW_VOL) -> DataFrame:
    """Add ``is_high`` and ``is_low``; a value on a threshold is neither."""
    actual = F.col("actual")
    return df.withColumns(
        {
            "is_high": F.coalesce(actual > F.lit(float(high)), F.lit(False)),
            "is_low": F.coalesce(actual < F.lit(float(low)), F.lit(False)),
        }
    )


def regimes(
    predictions: DataFrame,
    start: str | None = None,
    end: str | None = None,
    high: float = HIGH_VOL,
    low: float = LOW_VOL,
    layout: SeriesLayout = WHOLE,
) -> DataFrame:
    """Intervals of high and of low volatility.

    An interval runs from its first row to the first row that is out again; one
    still open ends on the last date in range. ``n_rows`` counts the rows inside.
    """

    def previous(df: DataFrame, w) -> DataFrame:
        return df.withColumns(
            {"was_high": F.lag("is_high").over(w), "was_low": F.lag("is_low").over(w)}
        )

    def following(df: DataFrame, w) -> DataFrame:
        return df.withColumns(
            {"next_date": F.lead("date").over(w), "next_idx": F.lead("row_idx").over(w)}
        )

    kept = in_date_range(predictions, start, end).select("symbol", "date", "actual")
    flagged = number_rows(regime_flags(kept, high, low), layout)
    flagged = add_series_value(flagged, "last_date", F.max("date"), layout)
    flagged = over_series(flagged, previous, before=1, layout=layout)

    # Only rows on which a flag turns matter from here on; runs collapse to two rows.
    both = F.array(
        *[
            F.struct(
                F.lit(name).alias("regime"),
                F.col(f"is_{name}").alias("inside"),
                (F.col(f"is_{name}") != F.coalesce(F.col(f"was_{name}"), F.lit(False))).alias(
                    "turned"
                ),
            )
            for name in ("high", "low")
        ]
    )
    turns = (
        flagged.select("symbol", "date", "row_idx", "n", "last_date", F.inline(both))
        .filter("turned")
        .drop("turned")
    )
    spans = over_series(turns, following, after=1, layout=layout, keys=("symbol", "regime"))
    return spans.filter("inside").select(
        "symbol",
        "regime",
        F.col("date").alias("start_date"),
        F.coalesce("next_date", "last_date").alias("end_date"),
        (F.coalesce("next_idx", "n") - F.col("row_idx")).alias("n_rows"),
    )


def residuals(
    predictions: DataFrame, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Predicted minus actual, classed "over" above zero and "under" otherwise."""
    residual = F.col("predicted") - F.col("actual")
    return in_date_range(predictions, start, end).select(
        "symbol",
        "date",
        residual.alias("residual"),
        F.when(residual > 0, "over").otherwise("under").alias("side"),
    )


def importances(models: DataFrame, ascending: bool = True) -> DataFrame:
    """Feature importances of each model, sorted; ascending is the chart's order."""
    order = F.col("importance").asc() if ascending else F.col("importance").desc()
    return (
        models.select("symbol", "refit_id", F.explode("importances").alias("feature", "importance"))
        .orderBy("symbol", "refit_id", order, "feature")
    )


def rounded_importances(models: DataFrame) -> DataFrame:
    """The printed ranking: descending, four decimals."""
    return importances(models, ascending=False).withColumn("importance", F.bround("importance", 4))


def scatter(predictions: DataFrame) -> DataFrame:
    return predictions.select("symbol", "actual", "predicted")


def scatter_bounds(predictions: DataFrame) -> DataFrame:
    """Ends of the identity line: joint minimum and maximum of both columns."""
    return predictions.groupBy("symbol").agg(
        F.least(F.min("actual"), F.min("predicted")).alias("line_from"),
        F.greatest(F.max("actual"), F.max("predicted")).alias("line_to"),
    )


def date_bounds(predictions: DataFrame) -> DataFrame:
    """First and last date allowed, and the range picked at first: the same."""
    low, high = F.min("date"), F.max("date")
    return predictions.groupBy("symbol").agg(
        low.alias("min_allowed"),
        high.alias("max_allowed"),
        low.alias("start_date"),
        high.alias("end_date"),
    )


def last_rows(df: DataFrame, rows: int = 3) -> DataFrame:
    """The latest rows of each symbol. Spark cuts to ``rows`` before it shuffles."""
    newest = Window.partitionBy("symbol").orderBy(F.col("date").desc())
    return (
        df.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= rows)
        .drop("_rank")
    )


def symbols(predictions: DataFrame, labels: dict[str, str] | None = None) -> DataFrame:
    """The symbols to choose from, with their display names."""
    return (
        predictions.groupBy("symbol")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("label", symbol_label(F.col("symbol"), labels))
    )


def bundle(
    predictions: DataFrame,
    models: DataFrame | None = None,
    symbol: str | None = None,
    start: str | None = None,
    end: str | None = None,
    high: float = HIGH_VOL,
    low: float = LOW_VOL,
    layout: SeriesLayout = WHOLE,
) -> dict[str, DataFrame]:
    """All report tables. Metrics, scatter and bounds cover all dates, the rest the range."""
    if symbol:
        predictions = predictions.filter(F.col("symbol") == symbol)
        models = None if models is None else models.filter(F.col("symbol") == symbol)
    tables = {
        "metrics": format_metrics(evaluate(predictions, layout=layout)),
        "series": actual_vs_predicted(predictions, start, end),
        "regimes": regimes(predictions, start, end, high, low, layout),
        "residuals": residuals(predictions, start, end),
        "scatter": scatter(predictions),
        "scatter_bounds": scatter_bounds(predictions),
        "date_bounds": date_bounds(predictions),
        "symbols": symbols(predictions),
    }
    if models is not None:
        tables["importances"] = importances(models)
    return tables
