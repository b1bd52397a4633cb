"""Market data: daily bars of any number of symbols and the shared index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from volspark.operators.clean import drop_incomplete, nan_to_null, one_row_per_date
from volspark.schemas import BARS, VIX_SYMBOL


def _read_raw(
    spark: SparkSession,
    path: str,
    fmt: str,
    symbols: Sequence[str] | None,
    start: str | None,
    end: str | None,
) -> DataFrame:
    reader = spark.read.schema(BARS)
    df = reader.csv(path, header=True) if fmt == "csv" else reader.format(fmt).load(path)
    if symbols:
        df = df.filter(F.col("symbol").isin(*symbols))
    # The end date itself is not included, as in a market data download.
    if start:
        df = df.filter(F.col("date") >= F.lit(start).cast("date"))
    if end:
        df = df.filter(F.col("date") < F.lit(end).cast("date"))
    # not the folders the table may lie in
    return df.select(*BARS.names)


def read_bars(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    symbols: Sequence[str] | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Complete daily bars from ``start`` up to, not including, ``end``."""
    return drop_incomplete(_read_raw(spark, path, fmt, symbols, start, end))


def read_implied_vol(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    start: str | None = None,
    end: str | None = None,
    symbol: str = VIX_SYMBOL,
) -> DataFrame:
    """``date, vix``: the closes of the index symbol in a table of bars."""
    raw = _read_raw(spark, path, fmt, [symbol], start, end)
    closes = nan_to_null(raw.select("date", F.col("close").alias("vix")))
    return one_row_per_date(closes, "vix")
