"""The feature matrix: lags, rolling moments, index features and the forward target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from volspark.functions import PERIODS_PER_YEAR, annualize, rolling_mean, rolling_std
from volspark.functions.prefix import Rolling, add_rolling
from volspark.operators.clean import drop_incomplete
from volspark.operators.series import WHOLE, SeriesLayout, over_series
from volspark.schemas import TARGET

LAGS = (1, 5, 10, 21)
SHORT, MONTH, QUARTER = 5, 21, 63
HORIZON = 5


def vol_lags(w: WindowSpec, lags: Sequence[int] = LAGS) -> dict[str, Column]:
    return {f"vol_lag_{k}": F.lag("realized_vol", k).over(w) for k in lags}


def vol_of_vol(w: WindowSpec) -> dict[str, Column]:
    return {f"vol_of_vol_{n}": rolling_std("realized_vol", n, w) for n in (SHORT, MONTH)}


def mean_returns(w: WindowSpec) -> dict[str, Column]:
    return {f"mean_return_{n}": rolling_mean("log_return", n, w) for n in (SHORT, MONTH)}


def window_vols(w: WindowSpec, periods_per_year: int = PERIODS_PER_YEAR) -> dict[str, Column]:
    return {
        f"vol_{n}d": annualize(rolling_std("log_return", n, w), periods_per_year)
        for n in (SHORT, QUARTER)
    }


def vol_ratio() -> dict[str, Column]:
    return {"vol_ratio": F.try_divide(F.col("vol_5d"), F.col("vol_63d"))}


def abs_return() -> dict[str, Column]:
    return {"abs_return": F.abs("log_return")}


def vix_level() -> dict[str, Column]:
    """The index in the unit of ``realized_vol``, and its premium over it."""
    level = F.col("vix") / 100
    return {"vix_normalized": level, "vol_risk_premium": level - F.col("realized_vol")}


def vix_history(w: WindowSpec) -> dict[str, Column]:
    return {
        "vix_lag_1": F.lag("vix_normalized").over(w),
        "vix_rolling_5": rolling_mean("vix_normalized", SHORT, w),
    }


def target(w: WindowSpec, horizon: int = HORIZON) -> dict[str, Column]:
    """``realized_vol`` as it will stand ``horizon`` rows later.

    The trailing window has not moved on entirely by then: with 21 rows and a
    horizon of 5, 16 of its returns are already known.
    """
    return {TARGET: F.lead("realized_vol", horizon).over(w)}


def running_features(with_vix: bool = True) -> dict[str, Rolling]:
    """The means and deviations among the features, those of returns not yet annualized."""
    found = {f"vol_of_vol_{n}": Rolling("realized_vol", n) for n in (SHORT, MONTH)}
    found |= {f"mean_return_{n}": Rolling("log_return", n, False) for n in (SHORT, MONTH)}
    found |= {f"vol_{n}d": Rolling("log_return", n) for n in (SHORT, QUARTER)}
    if with_vix:
        found["vix_rolling_5"] = Rolling("vix_normalized", SHORT, False)
    return found


def add_features(
    processed: DataFrame,
    horizon: int = HORIZON,
    lags: Sequence[int] = LAGS,
    periods_per_year: int = PERIODS_PER_YEAR,
    layout: SeriesLayout = WHOLE,
    running: bool = False,
    keys: Sequence[str] = ("symbol",),
) -> DataFrame:
    """Add the features and ``target_vol`` and drop every incomplete row.

    The index features are added only where there is a ``vix`` column. All windows
    share one partitioning and order, so they cost one sort. With ``running``, means and
    deviations come from running sums, whatever the length of their windows.
    """
    with_vix = "vix" in processed.columns

    def compute(df: DataFrame, w: WindowSpec) -> DataFrame:
        if with_vix:
            df = df.withColumns(vix_level())
        if running:
            df = add_rolling(df, w, running_features(with_vix))
            annual = {c: annualize(F.col(c), periods_per_year) for c in ("vol_5d", "vol_63d")}
            index = {"vix_lag_1": F.lag("vix_normalized").over(w)} if with_vix else {}
            return df.withColumns(vol_lags(w, lags) | annual | index | target(w, horizon))
        return df.withColumns(
            vol_lags(w, lags)
            | vol_of_vol(w)
            | mean_returns(w)
            | window_vols(w, periods_per_year)
            | (vix_history(w) if with_vix else {})
            | target(w, horizon)
        )

    reach = max(QUARTER - 1, *lags)
    wide = over_series(processed, compute, before=reach, after=horizon, layout=layout, keys=keys)
    wide = wide.withColumns(vol_ratio() | abs_return())
    ordered = [
        *processed.columns,
        *[f"vol_lag_{k}" for k in lags],
        *["vol_of_vol_5", "vol_of_vol_21", "mean_return_5", "mean_return_21"],
        *["vol_5d", "vol_63d", "vol_ratio", "abs_return"],
        *(["vix_normalized", "vol_risk_premium", "vix_lag_1", "vix_rolling_5"] if with_vix else []),
        TARGET,
    ]
    return drop_incomplete(wide.select(*ordered))
