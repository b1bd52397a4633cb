"""Positions in a series and the chronological holdout split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volspark.functions import truncated_share
from volspark.operators.series import WHOLE, SeriesLayout, number_rows
from volspark.schemas import TARGET, feature_columns


def require_model_columns(df: DataFrame, columns: list[str] | None = None) -> list[str]:
    """The model inputs, or an error that names those the table lacks."""
    columns = feature_columns() if columns is None else list(columns)
    missing = [c for c in (*columns, TARGET) if c not in df.columns]
    if missing:
        raise ValueError(f"features lack {missing}; were they built without the index series?")
    return columns


def with_position(df: DataFrame, layout: SeriesLayout = WHOLE) -> DataFrame:
    """Add ``row_idx`` (0-based, in date order) and the series length ``n``."""
    return number_rows(df, layout)


def slice_rows(positioned: DataFrame, first: int, stop: int) -> DataFrame:
    """The rows at positions ``[first, stop)`` of every series."""
    return positioned.filter((F.col("row_idx") >= first) & (F.col("row_idx") < stop))


def chronological_split(
    df: DataFrame, test_size: float = 0.2, layout: SeriesLayout = WHOLE
) -> DataFrame:
    """Add ``split``: "train" for the earliest rows of each series, "test" for the rest."""
    cut = truncated_share(F.col("n"), 1 - test_size)
    label = F.when(F.col("row_idx") < cut, "train").otherwise("test")
    return with_position(df, layout).withColumn("split", label)


def split_bounds(split: DataFrame) -> DataFrame:
    """Rows and true first and last date of each part."""
    return split.groupBy("symbol", "split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )
