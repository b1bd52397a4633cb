"""Missing values and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nan_to_null(df: DataFrame) -> DataFrame:
    """One kind of missing value: NaN compares as the largest number, NULL does not."""
    nan = F.lit(float("nan"))
    floats = {name for name, kind in df.dtypes if kind in ("double", "float")}
    return df.select(*[F.nullif(c, nan).alias(c) if c in floats else c for c in df.columns])


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Keep the rows that hold a value in every column."""
    return df.na.drop("any")


def unique_dates(side: DataFrame, on: str = "date") -> DataFrame:
    """A side series with one row per date; a date with two rows fails the job when it runs."""
    rows = F.count(F.lit(1))
    clash = F.raise_error(
        F.concat(F.lit("duplicate date in side series: "), F.col(on).cast("string"))
    )
    others = [c for c in side.columns if c != on]
    kept = [F.first(c).alias(c) for c in others]
    one = side.groupBy(on).agg(F.when(rows > 1, clash).otherwise(rows).alias("rows_"), *kept)
    return one.filter("rows_ = 1").select(*side.columns)


def one_row_per_date(side: DataFrame, value: str) -> DataFrame:
    """(date, value) of a side series, one row per date."""
    return unique_dates(side.select("date", value))
