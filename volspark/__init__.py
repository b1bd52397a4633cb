"""Volatility analytics and forecasting on price panels, as Spark DataFrames."""

from volspark.operators.align import attach_series
from volspark.operators.features import add_features
from volspark.operators.metrics import evaluate, format_metrics
from volspark.operators.returns import log_returns, realized_volatility
from volspark.operators.series import WHOLE, SeriesLayout, choose_layout
from volspark.operators.split import chronological_split, with_position
from volspark.operators.folds import WalkForward, fold_plan, refit_plan, scored_rows
from volspark.plans.pipeline import run_pipeline

__all__ = [
    "WHOLE",
    "SeriesLayout",
    "WalkForward",
    "add_features",
    "attach_series",
    "choose_layout",
    "chronological_split",
    "evaluate",
    "fold_plan",
    "format_metrics",
    "log_returns",
    "realized_volatility",
    "refit_plan",
    "run_pipeline",
    "scored_rows",
    "with_position",
]
