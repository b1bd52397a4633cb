"""Every operator as a query over the test tables, all rows of them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, timedelta
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from volspark.functions import symbol_label
from volspark.learners.baseline import BASELINES
from volspark.learners.boosting import BoostParams
from volspark.learners.grouped import LANE_ROWS, balanced_lane_rows
from volspark.learners.pooled import POOL, fit_pooled
from volspark.learners.scoring import score
from volspark.learners.spread import fit_spread
from volspark.operators import features as feature_columns_of
from volspark.operators import reports
from volspark.operators.adjust import adjust_prices
from volspark.operators.align import attach_series
from volspark.operators.backtest import (
    Backtest,
    holdout,
    holdout_rows,
    pooled_rows,
    walk_forward,
    walk_forward_rows,
)
from volspark.operators.clean import drop_incomplete
from volspark.operators.features import add_features
from volspark.operators.folds import WalkForward, fold_plan, refit_plan, scored_rows
from volspark.operators.metrics import (
    add_directions,
    backtest_period,
    evaluate,
    format_metrics,
    in_date_range,
)
from volspark.operators.parts import (
    merge_metric_states,
    metric_states,
    metrics_in_range,
    metrics_of,
    regimes_in_range,
    run_states,
)
from volspark.operators.returns import log_returns, realized_volatility
from volspark.operators.series import (
    SeriesLayout,
    calendar_span,
    choose_layout,
    over_series,
)
from volspark.operators.split import (
    chronological_split,
    slice_rows,
    split_bounds,
    with_position,
)
from volspark.plans.append import SeriesStore
from volspark.plans.pipeline import run_pipeline
from volspark.schemas import BARS, TARGET, feature_columns
from volspark.sinks import (
    clearing_scratch,
    dropping_shuffles,
    materialize,
    scratch_path,
    write_table,
)
from volspark.sources.bars import read_bars, read_implied_vol
from volspark.sources.boosters import read_booster_files, write_booster_files
from volspark.sources.fixtures import bars_from_lineitem, index_from_orders
from volspark.sources.tables import (
    load_featured,
    read_importances,
    read_models,
    read_processed,
    read_results,
    write_processed_csv,
    write_results_csv,
)

Query = Callable[[SparkSession, str], DataFrame]

# The unit prices of the test tables swing far more than markets do.
HIGH, LOW = 8.0, 7.0
RANGE = ("1997-01-01", "2000-06-30")
# Both ends within a month.
RANGE_CUT = ("1997-02-11", "2000-05-17")
LABELS = {"A": "Returned", "N": "Not returned", "R": "Refused"}
# Short chunks, to send the test series down the path of very long ones.
CHUNKED = SeriesLayout(256)
SMALL_FIT = BoostParams(trees=3, depth=2)


# Prices are cents over whole quantities and do end on halves, exactly but for the
# last bit of a sum; so the cut between two rounded numbers lies a little off the half.
CUT = 0.5012345679


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to ``digits`` decimals, by arithmetic that any engine repeats."""
    scale = 10.0**digits

    def kept(name: str, kind: str) -> Column | str:
        if kind != "double":
            return name
        return (F.floor(F.col(name) * scale + CUT) / scale).alias(name)

    return df.select(*[kept(*column) for column in df.dtypes])


@dataclass
class Panel:
    """The panel of one folder of test tables, one series per value of ``symbol``."""

    spark: SparkSession
    path: str
    symbol: str = "l_returnflag"
    chunked: bool = False
    plan: WalkForward = field(default_factory=WalkForward)

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/lineitem.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/orders.parquet")

    @cached_property
    def layout(self) -> SeriesLayout:
        return CHUNKED if self.chunked else choose_layout(self.lineitem, "l_shipdate")

    @cached_property
    def bars(self) -> DataFrame:
        return bars_from_lineitem(self.lineitem, self.symbol, self.layout)

    @cached_property
    def index(self) -> DataFrame:
        return index_from_orders(self.orders)

    @cached_property
    def index_span(self) -> int:
        return calendar_span(self.orders, "o_orderdate")

    @cached_property
    def vol(self) -> DataFrame:
        return realized_volatility(self.bars, layout=self.layout)

    @cached_property
    def processed(self) -> DataFrame:
        return attach_series(self.vol, self.index, span_days=self.index_span)

    @cached_property
    def features(self) -> DataFrame:
        return add_features(self.processed, layout=self.layout)

    @cached_property
    def positioned(self) -> DataFrame:
        return with_position(self.features, self.layout)

    def run(
        self, learner: str = "boosted", params: BoostParams = BoostParams(), store: bool = False
    ) -> Backtest:
        learns = learner not in BASELINES
        lane_rows = balanced_lane_rows(self.features, self.plan) if learns else LANE_ROWS
        return walk_forward(
            self.features, self.plan, learner, params, self.layout, store, lane_rows=lane_rows
        )

    def predictions(self, learner: str = "persistence") -> DataFrame:
        return self.run(learner).predictions


def on_panel(build: Callable[[Panel], DataFrame], **options) -> Query:
    return lambda spark, path: build(Panel(spark, path, **options))


def _feature_group(make: Callable) -> Callable[[Panel], DataFrame]:
    """Some columns of the feature matrix, before incomplete rows go."""

    def build(panel: Panel) -> DataFrame:
        keys = ["symbol", "date"]
        wide = over_series(panel.processed, make, before=62, after=5, layout=panel.layout)
        return rounded(wide.select(*keys, *wide.columns[len(panel.processed.columns) :]))

    return build


def _vix_features(df: DataFrame, w) -> DataFrame:
    level = df.withColumns(feature_columns_of.vix_level())
    return level.withColumns(feature_columns_of.vix_history(w))


def _vol_summary(panel: Panel) -> DataFrame:
    return rounded(
        panel.vol.groupBy("symbol").agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("realized_vol").alias("mean_vol"),
            F.min("realized_vol").alias("min_vol"),
            F.max("realized_vol").alias("max_vol"),
        )
    )


def _drop_incomplete(panel: Panel) -> DataFrame:
    """Bars with the index where there is one, then complete rows only."""
    return rounded(drop_incomplete(panel.bars.join(panel.index, "date", "left")))


def _warmup_counts(panel: Panel) -> DataFrame:
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("symbol").agg(F.count(F.lit(1)).alias(name))

    return (
        counted(panel.bars, "n_bars")
        .join(counted(panel.vol, "n_vol"), "symbol")
        .join(counted(panel.processed, "n_processed"), "symbol")
        .join(counted(panel.features, "n_features"), "symbol")
    )


def _split_columns(panel: Panel) -> DataFrame:
    split = chronological_split(panel.features, layout=panel.layout)
    return rounded(split.select("symbol", "date", "row_idx", "n", "split", TARGET))


def _split_bounds(panel: Panel) -> DataFrame:
    return split_bounds(chronological_split(panel.features, layout=panel.layout))


def _model_matrix(panel: Panel) -> DataFrame:
    return rounded(panel.features.select("symbol", "date", *feature_columns(), TARGET))


def _position_slice(panel: Panel) -> DataFrame:
    cut = slice_rows(panel.positioned, 10, 40)
    return rounded(cut.select("symbol", "date", "row_idx", TARGET))


def _scored_rows(panel: Panel) -> DataFrame:
    scored = scored_rows(panel.positioned, panel.plan)
    return rounded(scored.select("symbol", "date", "row_idx", "fold_id", "refit_id", TARGET))


def _training_sets(panel: Panel) -> DataFrame:
    """Rows and mean target per training set, of the expanding windows."""
    marked = walk_forward_rows(panel.features, panel.plan, panel.layout)
    sums = marked.groupBy("symbol", "segment", "refits").agg(
        F.count(F.lit(1)).alias("rows"), F.max("date").alias("last")
    )
    refits = F.sequence(F.col("segment"), F.col("refits").cast("int") - 1)
    return (
        sums.filter(F.col("segment") < F.col("refits"))
        .select("symbol", F.explode(refits).alias("refit_id"), "rows", "last")
        .groupBy("symbol", "refit_id")
        .agg(F.sum("rows").alias("n_train"), F.max("last").alias("last_train_date"))
    )


def _holdout_metrics(panel: Panel) -> DataFrame:
    run = holdout(panel.features, learner="persistence", layout=panel.layout)
    return rounded(evaluate(run.predictions, layout=panel.layout).drop("correlation"))


def _directions(panel: Panel) -> DataFrame:
    return (
        add_directions(panel.predictions(), panel.layout)
        .filter(F.col("actual_sign").isNotNull())
        .groupBy("symbol", "actual_sign", "predicted_sign")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "symbol",
            F.col("actual_sign").cast("int").alias("actual_sign"),
            F.col("predicted_sign").cast("int").alias("predicted_sign"),
            "n",
        )
    )


def _one_metric(name: str) -> Callable[[Panel], DataFrame]:
    def build(panel: Panel) -> DataFrame:
        return rounded(evaluate(panel.predictions(), layout=panel.layout).select("symbol", name))

    return build


def _metrics(panel: Panel, learner: str = "persistence") -> DataFrame:
    return rounded(evaluate(panel.predictions(learner), layout=panel.layout))


def _metrics_in_range(panel: Panel) -> DataFrame:
    return rounded(evaluate(panel.predictions(), *RANGE, layout=panel.layout))


def _regimes(panel: Panel, start: str | None = None, end: str | None = None) -> DataFrame:
    return reports.regimes(panel.predictions(), start, end, HIGH, LOW, panel.layout)


def _metrics_from_states(panel: Panel) -> DataFrame:
    """Months merge into years, years into all."""
    years = merge_metric_states(metric_states(panel.predictions(), "month"), "year")
    return rounded(metrics_of(merge_metric_states(years)))


def _metrics_in_range_from_states(panel: Panel) -> DataFrame:
    predictions = panel.predictions()
    return rounded(metrics_in_range(metric_states(predictions), predictions, *RANGE_CUT))


def _regimes_from_parts(panel: Panel, *dates: str) -> DataFrame:
    predictions = panel.predictions()
    return regimes_in_range(run_states(predictions, HIGH, LOW), predictions, *dates, HIGH, LOW)


def _labels(panel: Panel) -> DataFrame:
    return panel.bars.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "label", symbol_label(F.col("symbol"), LABELS)
    )


def _stored_bars(panel: Panel) -> str:
    """Bars and index as one table of bars, the index under its own symbol."""
    index = panel.index.select(
        F.lit("^VIX").alias("symbol"), "date", *[F.col("vix").alias(c) for c in
        ("open", "high", "low", "close")], F.lit(0).cast("long").alias("volume"),
    )
    path = scratch_path(panel.spark, "bars")
    return write_table(panel.bars.unionByName(index).select(*BARS.names), path)


def _read_bars(panel: Panel) -> DataFrame:
    bars = read_bars(
        panel.spark, _stored_bars(panel), symbols=["A", "R"], start=RANGE[0], end=RANGE[1]
    )
    return rounded(bars)


def _read_implied_vol(panel: Panel) -> DataFrame:
    return rounded(read_implied_vol(panel.spark, _stored_bars(panel)))


def _processed_table(panel: Panel) -> DataFrame:
    path = write_table(panel.processed, scratch_path(panel.spark, "processed"))
    return rounded(read_processed(panel.spark, path, symbol="N"))


def _featured_from_table(panel: Panel) -> DataFrame:
    path = write_table(panel.processed, scratch_path(panel.spark, "processed"))
    featured = load_featured(panel.spark, path, layout=panel.layout)
    return rounded(featured.select("symbol", "date", *feature_columns(), TARGET))


def _results_table(panel: Panel) -> DataFrame:
    path = write_table(panel.predictions(), scratch_path(panel.spark, "results"))
    return rounded(read_results(panel.spark, path, symbol="A"))


def _pipeline_paths(panel: Panel, learner: str, params: BoostParams) -> dict[str, str]:
    return run_pipeline(
        panel.spark,
        panel.bars,
        panel.index,
        scratch_path(panel.spark, "run"),
        learner=learner,
        params=params,
        high=HIGH,
        low=LOW,
        layout=panel.layout,
    )


def _pipeline(panel: Panel, table: str, learner: str, params: BoostParams = SMALL_FIT):
    paths = _pipeline_paths(panel, learner, params)
    return panel.spark.read.parquet(paths[table]).drop("bucket")


def _boosted_holdout(panel: Panel) -> DataFrame:
    run = holdout(panel.features, params=SMALL_FIT, layout=panel.layout)
    return rounded(run.predictions.drop("fold_id", "refit_id"), 4)


def _spread_holdout(panel: Panel) -> DataFrame:
    """The same fit as Spark aggregates, the way of series too long for a task."""
    rows = materialize(holdout_rows(panel.features, layout=panel.layout), "learning-rows")
    _, predictions = fit_spread(rows, feature_columns())
    return rounded(predictions.drop("fold_id", "refit_id"), 4)


def _boosted_models(panel: Panel) -> DataFrame:
    """What every refit trained on and scored, and whether its importances add up."""
    run = panel.run(store=True)
    scored = run.predictions.groupBy("symbol", "refit_id").agg(
        F.count("predicted").alias("n_scored")
    )
    total = F.aggregate(F.map_values("importances"), F.lit(0.0), lambda a, v: a + v)
    return run.models.join(scored, ["symbol", "refit_id"]).select(
        "symbol",
        "refit_id",
        "train_cut",
        "n_train",
        "n_scored",
        F.size("importances").cast("long").alias("n_features"),
        F.round(total, 6).alias("importance_total"),
    )


def _boosted_walk_small(panel: Panel) -> DataFrame:
    return rounded(panel.run(params=SMALL_FIT).predictions, 4)


def _boosted_predictions(panel: Panel) -> DataFrame:
    return rounded(panel.predictions("boosted"), 4)


def _boosted_metrics(panel: Panel) -> DataFrame:
    return rounded(evaluate(panel.run().predictions, layout=panel.layout), 4)


def _boosted_holdout_full(panel: Panel) -> DataFrame:
    run = holdout(panel.features, layout=panel.layout)
    return rounded(evaluate(run.predictions, layout=panel.layout).drop("correlation"), 4)


def _importance(panel: Panel) -> DataFrame:
    run = holdout(panel.features, layout=panel.layout)
    path = write_table(run.models, scratch_path(panel.spark, "models"))
    return rounded(read_importances(panel.spark, path), 4)


def _importance_printed(panel: Panel) -> DataFrame:
    return reports.rounded_importances(holdout(panel.features, layout=panel.layout).models)


def _stored_models(panel: Panel) -> DataFrame:
    run = holdout(panel.features, layout=panel.layout)
    path = write_table(run.models, scratch_path(panel.spark, "models"))
    return read_models(panel.spark, path).select("symbol", "refit_id", "train_cut", "n_train")


def _stored_models_score(panel: Panel) -> DataFrame:
    """Models written, read back, and used on the rows they had not seen."""
    run = holdout(panel.features, layout=panel.layout)
    path = write_table(run.models, scratch_path(panel.spark, "models"))
    scored = score(panel.features, read_models(panel.spark, path)).drop("refit_id")
    test = holdout_rows(panel.features, layout=panel.layout).filter(F.col("refit_id") == 0)
    kept = test.select("symbol", "date", "row_idx", F.col(TARGET).alias("actual"))
    return rounded(kept.join(scored, ["symbol", "date"]), 4)


def _without_index(panel: Panel) -> DataFrame:
    """The ablation: the same fit on the features that need no index."""
    plain = feature_columns(with_vix=False)
    bare = add_features(panel.vol, layout=panel.layout)
    run = holdout(bare, layout=panel.layout, columns=plain)
    return rounded(run.predictions.drop("fold_id", "refit_id"), 4)


def _run_importances(panel: Panel) -> DataFrame:
    """A whole run that trains, and the importances of the models it stored."""
    return rounded(reports.importances(_pipeline(panel, "models", "boosted", BoostParams())), 4)


def _run_models(panel: Panel) -> DataFrame:
    stored = _pipeline(panel, "models", "boosted", BoostParams())
    return stored.select("symbol", "refit_id", "train_cut", "n_train")


def _run_holdout_metrics(panel: Panel) -> DataFrame:
    return rounded(_pipeline(panel, "holdout_metrics", "boosted", BoostParams()), 4)


def _rerun(panel: Panel) -> DataFrame:
    """Runs for some symbols, for the others and for some again, into one folder."""
    out = scratch_path(panel.spark, "run")
    odd = F.crc32(F.col("symbol").cast("binary")) % 2 == 1
    for part in (odd, ~odd, odd):
        paths = run_pipeline(
            panel.spark,
            panel.bars.filter(part),
            panel.index,
            out,
            learner="persistence",
            layout=panel.layout,
        )
    return rounded(panel.spark.read.parquet(paths["metrics"]).drop("bucket"))


def _report_one_symbol(panel: Panel) -> DataFrame:
    """The report bundle of one symbol and a range of dates: its residuals."""
    tables = reports.bundle(
        panel.predictions(), symbol="A", start=RANGE[0], end=RANGE[1], layout=panel.layout
    )
    return rounded(tables["residuals"])


def _processed_csv(panel: Panel) -> DataFrame:
    folder = write_processed_csv(panel.processed, scratch_path(panel.spark, "csv"))
    return rounded(read_processed(panel.spark, folder, "csv", symbol="N"))


def _results_csv(panel: Panel) -> DataFrame:
    folder = write_results_csv(panel.predictions(), scratch_path(panel.spark, "csv"))
    return rounded(read_results(panel.spark, folder, "csv", symbol="A"))


#: Last days of the parts in which the series are appended; what follows is the last part.
PARTS = ("1996-12-31", "1999-06-30", "1999-07-02")


def _appended(panel: Panel, table: str) -> DataFrame:
    """A table of a store that got the days in parts, one of them folded into the others."""
    store = SeriesStore(panel.spark, scratch_path(panel.spark, "store"), layout=panel.layout)
    with clearing_scratch(panel.spark), dropping_shuffles(panel.spark):
        # made once, not once per part: a part reads its days of them
        bars, index = materialize(panel.bars, "bars"), materialize(panel.index, "index")
        after = "0001-01-01"
        for last in (*PARTS, "9999-12-31"):
            of_part = F.col("date").between(F.lit(after).cast("date"), F.lit(last).cast("date"))
            store.append(bars.filter(of_part), index.filter(of_part), panel.index_span)
            after = str(date.fromisoformat(last) + timedelta(days=1)) if last < "9999" else last
            if last == PARTS[1]:
                store.compact()
                store.drop_folded()
    return store.read(table)


def _appended_features(panel: Panel) -> DataFrame:
    return rounded(_appended(panel, "features"))


def _appended_processed(panel: Panel) -> DataFrame:
    return rounded(_appended(panel, "processed"))


def _actions(panel: Panel) -> DataFrame:
    """Actions made from the bars: dividends on the first bar of a quarter, splits of a year."""

    def first_bar(unit: str) -> DataFrame:
        by = F.trunc("date", unit)
        return panel.bars.groupBy("symbol", by.alias("part")).agg(
            F.min("date").alias("date"), F.min_by("volume", "date").alias("volume")
        )

    dividends = first_bar("quarter").select(
        "symbol",
        "date",
        F.lit(None).cast("double").alias("split"),
        (F.lit(0.125) * (1 + F.col("volume") % 5)).alias("dividend"),
    )
    ratio = F.when(F.year("date") == 1995, 2.0).when(F.year("date") == 1999, 0.25)
    splits = first_bar("year").select(
        "symbol", "date", ratio.alias("split"), F.lit(None).cast("double").alias("dividend")
    )
    return dividends.union(splits.filter("split IS NOT NULL"))


def _adjusted(panel: Panel) -> DataFrame:
    return rounded(adjust_prices(panel.bars, _actions(panel)))


def _booster_files(panel: Panel) -> DataFrame:
    """Models written as files of the published layout, read again and scored."""
    run = holdout(panel.features, layout=panel.layout, store=True)
    folder = write_booster_files(run.models, scratch_path(panel.spark, "model-files"))
    scored = score(panel.features, read_booster_files(panel.spark, folder))
    held_out = run.predictions.select("symbol", "date", "row_idx", "actual")
    return rounded(
        held_out.join(scored, ["symbol", "date"]).drop("refit_id"), 4
    )


def _pooled_plan(panel: Panel) -> DataFrame:
    """Per refit of the pooled learner: what it trains on and what it scores."""
    # the calendar and the marks both read the days of the features: they are made once
    days = materialize(panel.features.select("symbol", "date"), "feature-days")
    rows = pooled_rows(days, panel.plan)
    refits = rows.filter(F.col("refit_id").isNotNull()).groupBy("refit_id").agg(
        F.min("date").alias("first_scored"), F.count(F.lit(1)).alias("n_scored")
    )
    by_day = rows.groupBy("segment").agg(
        F.count(F.lit(1)).alias("rows"), F.max("date").alias("last")
    )
    # one row per refit on either side
    trained = refits.join(by_day, F.col("segment") <= F.col("refit_id")).groupBy("refit_id").agg(
        F.sum("rows").alias("n_train"), F.max("last").alias("last_trained")
    )
    return refits.join(trained, "refit_id")


def _pooled(panel: Panel) -> DataFrame:
    predictions, _ = fit_pooled(pooled_rows(panel.features))
    return rounded(evaluate(predictions, layout=panel.layout).drop("correlation"), 4)


def _pooled_walk(panel: Panel) -> DataFrame:
    run = walk_forward(panel.features, panel.plan, "pooled")
    return rounded(run.predictions, 4)


def _pooled_run(panel: Panel) -> DataFrame:
    """The whole run with one model for all symbols, and its stored model scored again."""
    paths = _pipeline_paths(panel, "pooled", SMALL_FIT)
    models = read_models(panel.spark, paths["models"])
    held_out = pooled_rows(panel.features).filter(F.col("refit_id").isNotNull())
    scored = score(held_out.select(*panel.features.columns), models, of=POOL)
    return rounded(scored.select("symbol", "date", "predicted"), 4)


def queries() -> dict[str, Query]:
    made = {
        # sources
        "bars": lambda p: rounded(p.bars),
        "implied_vol": lambda p: rounded(p.index),
        "read_bars": _read_bars,
        "read_implied_vol": _read_implied_vol,
        "processed_table": _processed_table,
        "adjusted_bars": _adjusted,
        "booster_file_round_trip": _booster_files,
        "load_featured": _featured_from_table,
        "results_table": _results_table,
        # returns, volatility, alignment
        "log_returns": lambda p: rounded(
            log_returns(p.bars, p.layout).select("symbol", "date", "close", "log_return")
        ),
        "realized_vol": lambda p: rounded(
            p.vol.select("symbol", "date", "log_return", "realized_vol")
        ),
        "vol_summary": _vol_summary,
        "attach_index": lambda p: rounded(
            p.processed.select("symbol", "date", "realized_vol", "vix")
        ),
        "drop_incomplete": _drop_incomplete,
        # features
        "vol_lags": _feature_group(lambda df, w: df.withColumns(feature_columns_of.vol_lags(w))),
        "vol_of_vol": _feature_group(
            lambda df, w: df.withColumns(feature_columns_of.vol_of_vol(w))
        ),
        "mean_returns": _feature_group(
            lambda df, w: df.withColumns(feature_columns_of.mean_returns(w))
        ),
        "vol_5_63_ratio": _feature_group(
            lambda df, w: df.withColumns(feature_columns_of.window_vols(w)).withColumns(
                feature_columns_of.vol_ratio()
            )
        ),
        "abs_return": _feature_group(
            lambda df, w: df.withColumns(feature_columns_of.abs_return())
        ),
        "vix_features": _feature_group(_vix_features),
        "target_vol": _feature_group(lambda df, w: df.withColumns(feature_columns_of.target(w))),
        "features_full": lambda p: rounded(p.features),
        "running_realized_vol": lambda p: rounded(
            realized_volatility(p.bars, layout=p.layout, running=True).select(
                "symbol", "date", "log_return", "realized_vol"
            )
        ),
        "running_features": lambda p: rounded(
            add_features(p.processed, layout=p.layout, running=True)
        ),
        "features_without_index": lambda p: rounded(add_features(p.vol, layout=p.layout)),
        "feature_warmup_counts": _warmup_counts,
        "model_matrix": _model_matrix,
        "last_rows": lambda p: rounded(
            reports.last_rows(p.features).select("symbol", "date", "close", "realized_vol", "vix")
        ),
        # positions, split, folds
        "position_slice": _position_slice,
        "chronological_split": _split_columns,
        "split_bounds": _split_bounds,
        "fold_plan": lambda p: fold_plan(p.features, p.plan),
        "refit_plan": lambda p: refit_plan(p.features, p.plan),
        "scored_rows": _scored_rows,
        "training_sets": _training_sets,
        # runs and metrics
        "walk_forward_persistence": lambda p: rounded(p.predictions()),
        "walk_forward_train_mean": lambda p: rounded(p.predictions("train_mean")),
        "holdout_metrics_persistence": _holdout_metrics,
        "backtest_metrics": _metrics,
        "backtest_metrics_train_mean": lambda p: _metrics(p, "train_mean"),
        "backtest_metrics_in_range": _metrics_in_range,
        "backtest_period": lambda p: backtest_period(p.predictions()),
        "directional_accuracy": _one_metric("directional_accuracy"),
        "correlation": _one_metric("correlation"),
        "step_directions": _directions,
        "metrics_text": lambda p: format_metrics(evaluate(p.predictions(), layout=p.layout)),
        # report tables
        "date_range_filter": lambda p: rounded(in_date_range(p.predictions(), *RANGE)),
        "actual_vs_predicted": lambda p: rounded(
            reports.actual_vs_predicted(p.predictions(), *RANGE)
        ),
        "regime_intervals": _regimes,
        "regime_intervals_in_range": lambda p: _regimes(p, *RANGE),
        "residuals": lambda p: rounded(reports.residuals(p.predictions(), *RANGE)),
        "scatter": lambda p: rounded(reports.scatter(p.predictions())),
        "scatter_bounds": lambda p: rounded(reports.scatter_bounds(p.predictions())),
        "date_bounds": lambda p: reports.date_bounds(p.predictions()),
        "symbol_labels": _labels,
        # states of date parts
        "backtest_metrics_from_states": _metrics_from_states,
        "metrics_in_range_from_states": _metrics_in_range_from_states,
        "regimes_from_parts": lambda p: _regimes_from_parts(p, None, None),
        "regimes_in_range_from_parts": lambda p: _regimes_from_parts(p, *RANGE_CUT),
        # days added to stored series
        "appended_features": _appended_features,
        "appended_processed": _appended_processed,
        # whole runs
        "run_metrics": lambda p: rounded(_pipeline(p, "metrics", "persistence")),
        "run_regimes": lambda p: _pipeline(p, "report_regimes", "persistence"),
        # boosted trees
        "boosted_holdout_small": _boosted_holdout,
        "boosted_holdout_spread": _spread_holdout,
        "boosted_holdout_without_index": _without_index,
        "score_stored_models": _stored_models_score,
        "boosted_models": _boosted_models,
        "stored_models": _stored_models,
        "walk_forward_boosted_small": _boosted_walk_small,
        "walk_forward_boosted": _boosted_predictions,
        "walk_forward_boosted_metrics": _boosted_metrics,
        "holdout_boosted": _boosted_holdout_full,
        "feature_importance": _importance,
        "run_models": _run_models,
        "run_importances": _run_importances,
        "run_holdout_metrics": _run_holdout_metrics,
        "report_bundle_one_symbol": _report_one_symbol,
        "processed_csv_round_trip": _processed_csv,
        "results_csv_round_trip": _results_csv,
        "feature_importance_printed": _importance_printed,
        "pooled_boosted": _pooled,
        "pooled_walk_forward": _pooled_walk,
        "run_pooled_small": _pooled_run,
    }
    found = {name: on_panel(build) for name, build in made.items()}

    # The path of very long series must give what the whole series give.
    for name in (
        "realized_vol",
        "features_full",
        "scored_rows",
        "walk_forward_train_mean",
        "backtest_metrics",
        "regime_intervals",
        "running_features",
    ):
        found[f"chunked_{name}"] = on_panel(made[name], chunked=True)

    found["suppliers_rerun"] = on_panel(_rerun, symbol="l_suppkey")
    found["suppliers_pooled_plan"] = on_panel(_pooled_plan, symbol="l_suppkey")

    # One series per supplier: many symbols, as in a market.
    for name in (
        "features_full",
        "fold_plan",
        "walk_forward_train_mean",
        "backtest_metrics",
        "regime_intervals",
        "run_metrics",
        "boosted_holdout_small",
        "appended_features",
        "backtest_metrics_from_states",
        "regimes_from_parts",
        "adjusted_bars",
    ):
        found[f"suppliers_{name}"] = on_panel(made[name], symbol="l_suppkey")
    return found
