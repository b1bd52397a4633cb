"""Holdout and walk-forward runs of a learner over all series at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volspark.functions import truncated_share
from volspark.learners.baseline import BASELINES
from volspark.learners.boosting import BoostParams
from volspark.learners.grouped import FITTERS, LANE_ROWS, fit_grouped
from volspark.learners.pooled import fit_pooled
from volspark.learners.spread import fit_spread
from volspark.operators.folds import WalkForward
from volspark.operators.series import MAX_TASK_ROWS, WHOLE, SeriesLayout
from volspark.operators.split import require_model_columns, with_position
from volspark.schemas import MODELS, PREDICTIONS, TARGET
from volspark.sinks import materialize


@dataclass
class Backtest:
    """What a run yields: scored rows, and the models where the learner has any."""

    predictions: DataFrame
    models: DataFrame | None = None


def walk_forward_rows(
    features: DataFrame, plan: WalkForward = WalkForward(), layout: SeriesLayout = WHOLE
) -> DataFrame:
    """The rows a walk-forward run uses, each marked with its part in it.

    ``segment`` is the first refit that trains on the row; ``fold_id``, ``refit_id``
    and ``train_cut`` are set on the rows that get scored.
    """
    n, row_idx = F.col("n"), F.col("row_idx")
    positioned = with_position(features, layout).withColumn("refits", plan.refit_count(n))
    stop = plan.first_cut(n) + plan.fold_count(n) * plan.step_size
    fold = F.when(row_idx >= plan.first_cut(n), plan.fold_of(row_idx, n))
    return (
        positioned.filter((F.col("refits") > 0) & (row_idx < stop))
        .withColumn("segment", plan.training_segment(row_idx, n))
        .withColumn("fold_id", fold)
        .withColumn("refit_id", plan.refit_of(F.col("fold_id")))
        .withColumn("train_cut", plan.cut_of(F.col("refit_id"), n))
    )


def holdout_rows(
    features: DataFrame, test_size: float = 0.2, layout: SeriesLayout = WHOLE
) -> DataFrame:
    """The same marks for one fit on the earliest rows, scored on the rest."""
    cut = truncated_share(F.col("n"), 1 - test_size)
    test = F.col("row_idx") >= cut
    return with_position(features, layout).withColumns(
        {
            "refits": F.lit(1).cast("long"),
            "segment": test.cast("int"),
            "fold_id": F.when(test, 0),
            "refit_id": F.when(test, 0),
            "train_cut": F.when(test, cut),
        }
    )


def by_calendar(features: DataFrame, plan: WalkForward | None, test_size: float) -> DataFrame:
    """(date, segment, fold_id, refit_id, train_cut, row_idx, refits): one cut date per refit.

    The dates of all symbols together are split like one series, so no row that a model
    trains on is dated after its first scored one. A calendar has one row per day.
    """
    days = features.select(F.lit("all").alias("symbol"), "date").distinct()
    marked = holdout_rows(days, test_size) if plan is None else walk_forward_rows(days, plan)
    return marked.drop("symbol", "n")


def pooled_rows(
    features: DataFrame, plan: WalkForward | None = None, test_size: float = 0.2
) -> DataFrame:
    """The rows of every symbol, marked by date: a holdout, or a walk forward by ``plan``."""
    return features.join(by_calendar(features, plan, test_size), "date")


def _run_pooled(
    features: DataFrame,
    plan: WalkForward | None,
    test_size: float,
    params: BoostParams,
    columns: list[str] | None,
) -> Backtest:
    rows = pooled_rows(features, plan, test_size)
    return Backtest(*fit_pooled(rows, columns, params))


def _run(
    rows: DataFrame,
    learner: str,
    params: BoostParams,
    store: bool,
    max_fit_rows: int,
    columns: list[str] | None,
    lane_rows: int = LANE_ROWS,
) -> Backtest:
    if learner in BASELINES:
        return Backtest(BASELINES[learner](rows))
    if learner not in FITTERS:
        known = [*BASELINES, *FITTERS, "pooled"]
        raise ValueError(f"unknown learner {learner!r}; one of {known}")
    columns = require_model_columns(rows, columns)

    # What the learners use, no more. By length, whatever the layout: long series are
    # fitted as Spark aggregates.
    keys = [c for c in PREDICTIONS.names if c not in ("actual", "predicted")]
    marks = ["n", "train_cut", "segment", "refits"]
    rows = materialize(rows.select(*keys, *marks, TARGET, *columns), "learning-rows")
    short = rows.filter(F.col("n") <= max_fit_rows)
    long = rows.filter(F.col("n") > max_fit_rows)
    fits = fit_grouped(short, columns, params, learner, lane_rows)
    if store:
        fits = materialize(fits, "fits")
    models = fits.select(*MODELS.names)
    predictions = fits.select("symbol", "refit_id", F.inline("predictions")).select(
        *PREDICTIONS.names
    )
    if not long.isEmpty():
        more_models, more_predictions = fit_spread(long, columns, params)
        models = models.unionByName(more_models)
        predictions = predictions.unionByName(more_predictions)
    return Backtest(predictions, models)


def walk_forward(
    features: DataFrame,
    plan: WalkForward = WalkForward(),
    learner: str = "boosted",
    params: BoostParams = BoostParams(),
    layout: SeriesLayout = WHOLE,
    store: bool = False,
    max_fit_rows: int = MAX_TASK_ROWS,
    columns: list[str] | None = None,
    lane_rows: int = LANE_ROWS,
) -> Backtest:
    """Score every fold with the model of its refit, trained on all rows before its cut.

    ``store`` writes the fits to the shared folder once, so that reading both the
    predictions and the models does not fit twice. ``columns`` are the inputs, all
    sixteen features unless given. With few series, less ``lane_rows`` spread their
    refits over more tasks; ``balanced_lane_rows`` finds how many. The ``pooled`` learner
    takes the plan by the calendar of all symbols.
    """
    if learner == "pooled":
        return _run_pooled(features, plan, 0.0, params, columns)
    rows = walk_forward_rows(features, plan, layout)
    return _run(rows, learner, params, store, max_fit_rows, columns, lane_rows)


def holdout(
    features: DataFrame,
    test_size: float = 0.2,
    learner: str = "boosted",
    params: BoostParams = BoostParams(),
    layout: SeriesLayout = WHOLE,
    store: bool = False,
    max_fit_rows: int = MAX_TASK_ROWS,
    columns: list[str] | None = None,
) -> Backtest:
    """Fit each series on its earliest rows and score the rest; ``pooled``, all by date."""
    if learner == "pooled":
        return _run_pooled(features, None, test_size, params, columns)
    rows = holdout_rows(features, test_size, layout)
    return _run(rows, learner, params, store, max_fit_rows, columns)
