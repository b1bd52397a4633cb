"""The whole run, from bars to report tables. Actions happen only where tables are written."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from volspark.learners.boosting import BoostParams
from volspark.learners.grouped import FITTERS, LANE_ROWS, balanced_lane_rows
from volspark.learners.pooled import POOL
from volspark.operators import reports
from volspark.operators.align import attach_series
from volspark.operators.backtest import holdout, walk_forward
from volspark.operators.clean import drop_incomplete
from volspark.operators.features import HORIZON, add_features
from volspark.operators.folds import WalkForward
from volspark.operators.metrics import evaluate
from volspark.operators.returns import realized_volatility
from volspark.operators.series import WHOLE, SeriesLayout, choose_layout
from volspark.sinks import (
    SHARD,
    by_shard,
    clearing_scratch,
    dropping_shuffles,
    materialize,
    write_table,
)
from volspark.sources.tables import read_models, read_processed, read_results

#: Report tables written side by side.
TABLES_AT_ONCE = 4

#: Report tables with a row per row of the results, which are written as these lie.
ROW_BY_ROW = ("series", "residuals", "scatter")


def build_processed(
    bars: DataFrame,
    implied_vol: DataFrame | None,
    window: int = 21,
    layout: SeriesLayout = WHOLE,
    span_days: int | None = None,
) -> DataFrame:
    """Returns and volatility first, then the index: a date it lacks costs a row, not a return.

    Rows that ``by_shard`` has dealt out stay where they lie.
    """
    keys = (SHARD, "symbol") if SHARD in bars.columns else ("symbol",)
    processed = realized_volatility(drop_incomplete(bars), window, layout=layout, keys=keys)
    if implied_vol is None:
        return processed
    return attach_series(processed, implied_vol, span_days=span_days)


def _of_run(df: DataFrame, symbols: DataFrame | None) -> DataFrame:
    """Rows of the run's symbols: the folder may hold those of other runs too."""
    return df if symbols is None else df.join(symbols, "symbol", "left_semi")


def _model_symbols(
    spark: SparkSession, learner: str, symbols: DataFrame | None
) -> DataFrame | None:
    """The symbols that a run's models are stored under."""
    return spark.createDataFrame([(POOL,)], "symbol string") if learner == "pooled" else symbols


def store_processed(
    processed: DataFrame, out_dir: str, symbols: DataFrame | None = None
) -> DataFrame:
    path = write_table(processed, f"{out_dir}/processed", symbols)
    return _of_run(read_processed(processed.sparkSession, path), symbols)


def store_features(
    processed: DataFrame,
    out_dir: str,
    symbols: DataFrame | None = None,
    horizon: int = HORIZON,
    layout: SeriesLayout = WHOLE,
) -> DataFrame:
    if layout.chunk_rows is None:
        # one shuffle serves the windows and the folders of the table
        features = add_features(by_shard(processed), horizon, layout=layout, keys=(SHARD, "symbol"))
    else:
        features = add_features(processed, horizon=horizon, layout=layout)
    path = write_table(features, f"{out_dir}/features", symbols)
    features = features.drop(SHARD)
    stored = processed.sparkSession.read.schema(features.schema).parquet(path)
    return _of_run(stored.select(*features.columns), symbols)


def store_holdout(
    features: DataFrame,
    out_dir: str,
    symbols: DataFrame | None = None,
    test_size: float = 0.2,
    learner: str = "boosted",
    params: BoostParams = BoostParams(),
    layout: SeriesLayout = WHOLE,
) -> dict[str, str]:
    """Fit on the earliest rows, store the models and their errors on the rest."""
    run = holdout(features, test_size, learner, params, layout, store=True)
    metrics = evaluate(run.predictions, layout=layout).drop("correlation")
    paths = {"holdout_metrics": write_table(metrics, f"{out_dir}/holdout_metrics", symbols)}
    if run.models is not None:
        under = _model_symbols(features.sparkSession, learner, symbols)
        paths["models"] = write_table(run.models, f"{out_dir}/models", under)
    return paths


def store_backtest(
    features: DataFrame,
    out_dir: str,
    symbols: DataFrame | None = None,
    plan: WalkForward = WalkForward(),
    learner: str = "boosted",
    params: BoostParams = BoostParams(),
    layout: SeriesLayout = WHOLE,
) -> dict[str, str]:
    """Walk forward, store predictions, the refitted models and the metrics."""
    lane_rows = balanced_lane_rows(features, plan) if learner in FITTERS else LANE_ROWS
    run = walk_forward(features, plan, learner, params, layout, store=True, lane_rows=lane_rows)
    paths = {"results": write_table(run.predictions, f"{out_dir}/results", symbols)}
    if run.models is not None:
        path = f"{out_dir}/backtest_models"
        under = _model_symbols(features.sparkSession, learner, symbols)
        paths["backtest_models"] = write_table(run.models, path, under)
    results = _of_run(read_results(features.sparkSession, paths["results"]), symbols)
    metrics = evaluate(results, layout=layout)
    paths["metrics"] = write_table(metrics, f"{out_dir}/metrics", symbols)
    return paths


def store_reports(
    spark: SparkSession,
    out_dir: str,
    learner: str | None,
    layout: SeriesLayout = WHOLE,
    symbols: DataFrame | None = None,
    **options,
) -> dict[str, str]:
    """Write the report tables of the stored results, as ``options`` ask for them.

    ``learner`` is the one that stored models, None where there are none.
    """
    under = _model_symbols(spark, learner, symbols) if learner else None
    models = _of_run(read_models(spark, f"{out_dir}/models"), under) if learner else None
    results = _of_run(read_results(spark, f"{out_dir}/results"), symbols)
    tables = reports.bundle(results, models, layout=layout, **options)

    def store(name: str) -> str:
        own = under if name == "importances" else symbols
        lies = name in ROW_BY_ROW
        return write_table(tables[name], f"{out_dir}/reports/{name}", own, as_they_lie=lies)

    # small tables of one source: their jobs fill the cluster better side by side
    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        paths = list(pool.map(inheritable_thread_target(store), tables))
    return {f"report_{name}": path for name, path in zip(tables, paths)}


def run_pipeline(
    spark: SparkSession,
    bars: DataFrame,
    implied_vol: DataFrame,
    out_dir: str,
    symbols: Sequence[str] | None = None,
    start: str | None = None,
    end: str | None = None,
    window: int = 21,
    horizon: int = HORIZON,
    test_size: float = 0.2,
    plan: WalkForward = WalkForward(),
    learner: str = "boosted",
    params: BoostParams = BoostParams(),
    high: float = reports.HIGH_VOL,
    low: float = reports.LOW_VOL,
    layout: SeriesLayout | None = None,
) -> dict[str, str]:
    """Run every stage for all symbols and return the path of each table.

    The period is [``start``, ``end``), as when the bars were downloaded for it. A folder
    used before keeps its other symbols; those of this run are replaced in every table.
    Intermediate tables are deleted at the end.
    """
    if symbols:
        bars = bars.filter(F.col("symbol").isin(*symbols))
    if start:
        bars = bars.filter(F.col("date") >= F.lit(start).cast("date"))
        implied_vol = implied_vol.filter(F.col("date") >= F.lit(start).cast("date"))
    if end:
        bars = bars.filter(F.col("date") < F.lit(end).cast("date"))
        implied_vol = implied_vol.filter(F.col("date") < F.lit(end).cast("date"))
    if layout is None:
        layout = choose_layout(bars, start=start, end=end)

    with clearing_scratch(spark), dropping_shuffles(spark):
        own = bars.select("symbol").distinct()
        if symbols:  # also those without a bar in the period
            named = spark.createDataFrame([(s,) for s in symbols], "symbol string")
            own = own.unionByName(named).distinct()
        own = materialize(own, "run-symbols")
        # one shuffle serves the windows and the folders of the table
        dealt = by_shard(bars) if layout.chunk_rows is None else bars
        processed = build_processed(dealt, implied_vol, window, layout)
        processed = store_processed(processed, out_dir, own)
        features = store_features(processed, out_dir, own, horizon, layout)
        paths = {"processed": f"{out_dir}/processed", "features": f"{out_dir}/features"}
        paths |= store_holdout(features, out_dir, own, test_size, learner, params, layout)
        paths |= store_backtest(features, out_dir, own, plan, learner, params, layout)
        fitted = learner if "models" in paths else None
        paths |= store_reports(spark, out_dir, fitted, layout, own, high=high, low=low)
        return paths
