"""One model for all symbols together, per refit date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from volspark.learners.boosting import BoostParams
from volspark.learners.spread import fit_models, predictions_and_models
from volspark.operators.split import require_model_columns
from volspark.schemas import MODELS, PREDICTIONS, TARGET
from volspark.sinks import materialize

#: The symbol that models of all symbols are stored under.
POOL = "*"

#: Days of a calendar, at most; a symbol's rows are numbered from a multiple of it.
DAYS = 1 << 21


def _number() -> Column:
    """What sampling goes by: the symbol and the day, however the rows lie."""
    of_symbol = F.conv(F.substring(F.md5(F.col("symbol").cast("binary")), 1, 7), 16, 10)
    return of_symbol.cast("long") * DAYS + F.col("row_idx")


def fit_pooled(
    rows: DataFrame, columns: list[str] | None = None, params: BoostParams = BoostParams()
) -> tuple[DataFrame, DataFrame]:
    """Predictions and models for the rows of ``pooled_rows``.

    Refit g trains on the rows of every symbol dated before its cut. Which rows a tree is
    grown on follows from symbol and day, so a model does not depend on the layout of its
    input. Fitting runs when this is called; rows stay spread over tasks at any size.
    """
    columns = require_model_columns(rows, columns)
    needed = [c for c in PREDICTIONS.names if c not in ("actual", "predicted")]
    rows = rows.select(*needed, "train_cut", "segment", "refits", TARGET, *columns)
    rows = materialize(rows, "pooled-rows")
    if rows.filter(F.col("refits") > 0).isEmpty():
        spark = rows.sparkSession
        return spark.createDataFrame([], PREDICTIONS), spark.createDataFrame([], MODELS)
    state = rows.select(
        F.lit(POOL).alias("series"),
        _number().alias("number"),
        F.col("segment").cast("int").alias("segment"),
        F.col("refits").cast("int").alias("refits"),
        F.col(TARGET).alias("y"),
        F.array(*columns).alias("x"),
    )
    fitted = fit_models(state, len(columns), params)
    return predictions_and_models(rows, fitted, columns, F.lit(POOL))
