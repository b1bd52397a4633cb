"""Log returns and annualized rolling volatility."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from volspark.functions import PERIODS_PER_YEAR, annualize, rolling_std
from volspark.functions.prefix import Rolling, add_rolling
from volspark.operators.clean import drop_incomplete
from volspark.operators.series import WHOLE, SeriesLayout, over_series


def _add_returns(df: DataFrame, w: WindowSpec) -> DataFrame:
    # The window sees neighbours in date order anyway, so the key check is free.
    repeated = F.lag("date").over(w) == F.col("date")
    clash = F.raise_error(
        F.concat(F.lit("duplicate (symbol, date): "), F.col("symbol"), F.lit(" "), F.col("date"))
    )
    growth = F.try_divide(F.col("close"), F.lag("close").over(w))
    return df.withColumn("log_return", F.when(repeated, clash).otherwise(F.ln(growth)))


def log_returns(bars: DataFrame, layout: SeriesLayout = WHOLE) -> DataFrame:
    """Add ``log_return``; NULL on the first row of a symbol and around a zero close."""
    return over_series(bars, _add_returns, before=1, layout=layout)


def realized_volatility(
    bars: DataFrame,
    window: int = 21,
    periods_per_year: int = PERIODS_PER_YEAR,
    layout: SeriesLayout = WHOLE,
    running: bool = False,
    keys: Sequence[str] = ("symbol",),
) -> DataFrame:
    """Add ``log_return`` and ``realized_vol`` and drop every incomplete row.

    ``realized_vol`` is the sample deviation of the last ``window`` returns,
    annualized, so the first ``window`` rows of each symbol go. With ``running`` it comes
    from running sums, whatever the window's length.
    """

    def compute(df: DataFrame, w: WindowSpec) -> DataFrame:
        if running:
            df = add_rolling(_add_returns(df, w), w, {"realized_vol": Rolling("log_return", window)})
            return df.withColumn("realized_vol", annualize(F.col("realized_vol"), periods_per_year))
        vol = annualize(rolling_std("log_return", window, w), periods_per_year)
        return _add_returns(df, w).withColumn("realized_vol", vol)

    return drop_incomplete(over_series(bars, compute, before=window, layout=layout, keys=keys))
