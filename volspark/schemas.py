"""Table layouts and the names every stage agrees on."""

from pyspark.sql import types as T

# Column names of the feature matrix, in model order.
PRICE_FEATURES = (
    "vol_lag_1",
    "vol_lag_5",
    "vol_lag_10",
    "vol_lag_21",
    "vol_of_vol_5",
    "vol_of_vol_21",
    "mean_return_5",
    "mean_return_21",
    "vol_5d",
    "vol_63d",
    "vol_ratio",
    "abs_return",
)
VIX_FEATURES = (
    "vix_normalized",
    "vol_risk_premium",
    "vix_lag_1",
    "vix_rolling_5",
)
TARGET = "target_vol"

# The study set of the default run.
SYMBOLS = ("SPY", "QQQ", "GLD")
SYMBOL_LABELS = {
    "SPY": "SPY — S&P 500 ETF",
    "QQQ": "QQQ — Nasdaq 100 ETF",
    "GLD": "GLD — Gold ETF",
}
START, END = "2015-01-01", "2024-12-31"
VIX_SYMBOL = "^VIX"


def feature_columns(with_vix: bool = True) -> list[str]:
    """The model inputs: all sixteen, or the twelve that need no index."""
    return list(PRICE_FEATURES + (VIX_FEATURES if with_vix else ()))


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


BARS = _struct(
    symbol=T.StringType(),
    date=T.DateType(),
    open=T.DoubleType(),
    high=T.DoubleType(),
    low=T.DoubleType(),
    close=T.DoubleType(),
    volume=T.LongType(),
)
IMPLIED_VOL = _struct(date=T.DateType(), vix=T.DoubleType())

# Column order of the per-symbol CSV exchange file.
PROCESSED_CSV = _struct(
    date=T.DateType(),
    close=T.DoubleType(),
    high=T.DoubleType(),
    low=T.DoubleType(),
    open=T.DoubleType(),
    volume=T.LongType(),
    log_return=T.DoubleType(),
    realized_vol=T.DoubleType(),
    vix=T.DoubleType(),
)
PROCESSED = T.StructType([BARS["symbol"], *PROCESSED_CSV.fields])

RESULTS_CSV = _struct(date=T.DateType(), actual=T.DoubleType(), predicted=T.DoubleType())

PREDICTIONS = _struct(
    symbol=T.StringType(),
    date=T.DateType(),
    row_idx=T.LongType(),
    fold_id=T.IntegerType(),
    refit_id=T.IntegerType(),
    actual=T.DoubleType(),
    predicted=T.DoubleType(),
)

# One fitted model, with the rows it scored.
SCORED = T.StructType([f for f in PREDICTIONS.fields if f.name not in ("symbol", "refit_id")])
FITS = _struct(
    symbol=T.StringType(),
    refit_id=T.IntegerType(),
    train_cut=T.LongType(),
    n_train=T.LongType(),
    model=T.StringType(),
    importances=T.MapType(T.StringType(), T.DoubleType()),
    predictions=T.ArrayType(SCORED),
)
MODELS = T.StructType([f for f in FITS.fields if f.name != "predictions"])
