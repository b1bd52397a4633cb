import hashlib
import json
from contextlib import nullcontext
from datetime import date, timedelta

import brute
import numpy as np
import pandas as pd
import pytest
from conftest import collect
from pyspark.sql import functions as F

from volspark import WalkForward, evaluate
from volspark.learners import boosting, spread
from volspark.learners.baseline import train_mean
from volspark.learners.boosting import BoostParams, Model
from volspark.learners.grouped import fit_grouped
from volspark.learners.pooled import POOL, fit_pooled
from volspark.learners.scoring import score
from volspark.learners.spread import fit_spread
from volspark.operators.backtest import (
    holdout,
    holdout_rows,
    pooled_rows,
    walk_forward,
    walk_forward_rows,
)
from volspark.operators.reports import importances, rounded_importances
from volspark.operators.series import SeriesLayout
from volspark.schemas import MODELS, PREDICTIONS, feature_columns
from volspark.sinks import write_table
from volspark.sources import read_models

COLUMNS = feature_columns()


def numbers(n, seed=0, width=16):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width))
    return x, 2 * x[:, 0] + np.sin(3 * x[:, 1]) + rng.normal(0, 0.1, n)


@pytest.fixture(scope="module")
def features(spark):
    """Two series with a target that depends on the first two columns."""
    parts = []
    for symbol, n, seed in (("A", 300, 1), ("B", 220, 2)):
        x, y = numbers(n, seed)
        part = pd.DataFrame(x, columns=COLUMNS)
        part.insert(0, "symbol", symbol)
        part.insert(1, "date", [date(2020, 1, 1) + timedelta(days=i) for i in range(n)])
        parts.append(part.assign(realized_vol=y[::-1], target_vol=y))
    shuffled = pd.concat(parts).sample(frac=1, random_state=0)
    return spark.createDataFrame(shuffled).repartition(4).cache()


def model_texts(models):
    return {(r.symbol, r.refit_id): json.loads(r.model) for r in models.collect()}


# The booster itself.


def test_one_split_is_the_best_of_all():
    x, y = numbers(80, width=3)
    params = BoostParams(trees=1, depth=1, subsample=1.0, learning_rate=1.0)
    model = boosting.fit(x, y, np.arange(80), list("abc"), params)
    gaps = y.mean() - y

    def score(rows):
        return gaps[rows].sum() ** 2 / (rows.sum() + 1)

    options = []
    for f in range(3):
        for edge in boosting.bin_edges(x[:, f], 256):
            left = x[:, f] < edge
            options.append((score(left) + score(~left), -f, edge, left))
    best = max(options, key=lambda o: o[:2])
    tree = model.trees[0]
    assert (tree.feature[0], tree.threshold[0]) == (-best[1], best[2])
    left = best[3]
    assert tree.value[1] == pytest.approx(-gaps[left].sum() / (left.sum() + 1), rel=1e-6)
    assert tree.value[2] == pytest.approx(-gaps[~left].sum() / ((~left).sum() + 1), rel=1e-6)
    assert model.importances() == {c: float(c == "abc"[-best[1]]) for c in "abc"}


def test_edges_fill_bins_evenly():
    x = np.random.default_rng(0).exponential(size=10_000)
    edges = boosting.bin_edges(x, 16)
    sizes = np.bincount(np.searchsorted(edges, x, side="right"))
    assert len(edges) == 15 and sizes.min() > 500 and sizes.max() < 750
    assert len(boosting.bin_edges(np.ones(9), 16)) == 0
    assert boosting.bin_edges(np.array([1.0, 1.0, 2.0]), 16).tolist() == [2.0]


@pytest.mark.parametrize("outlier", [10.0, 1e4, -1e12])
def test_an_outlier_costs_no_borders(outlier):
    x = np.append(np.random.default_rng(4).normal(0, 0.01, 2_400), outlier)
    assert len(boosting.bin_edges(x, 256)) >= 250


def test_sampling_is_a_share_of_rows_and_changes_with_the_tree():
    rows, params = np.arange(100_000), BoostParams()
    first, second = boosting.sampled(rows, 0, params), boosting.sampled(rows, 1, params)
    assert first.mean() == pytest.approx(0.8, abs=0.005)
    assert (first & second).mean() == pytest.approx(0.64, abs=0.02)
    assert (first != boosting.sampled(rows, 0, BoostParams(seed=1))).any()


def test_row_order_does_not_matter_and_models_can_be_stored():
    x, y = numbers(500)
    order = np.random.default_rng(3).permutation(500)
    params = BoostParams(trees=20)
    model = boosting.fit(x, y, np.arange(500), COLUMNS, params)
    again = boosting.fit(x[order], y[order], order, COLUMNS, params)
    assert again.to_json() == model.to_json()
    assert (Model.from_json(model.to_json()).predict(x) == model.predict(x)).all()
    assert sum(model.importances().values()) == pytest.approx(1)


def test_fit_learns():
    x, y = numbers(2000)
    model = boosting.fit(x[:1500], y[:1500], np.arange(1500), COLUMNS, BoostParams())
    error = np.abs(model.predict(x[1500:]) - y[1500:]).mean()
    assert error < 0.25 * np.abs(y[1500:] - y[:1500].mean()).mean()
    ranked = sorted(model.importances(), key=model.importances().get, reverse=True)
    assert set(ranked[:2]) == set(COLUMNS[:2])


def test_constant_target_gives_a_constant():
    x, _ = numbers(50)
    model = boosting.fit(x, np.full(50, 0.25), np.arange(50), COLUMNS, BoostParams(trees=3))
    assert (model.predict(x) == 0.25).all()
    assert sum(model.importances().values()) == 0


# Runs over series.


def test_walk_forward_fits_what_a_loop_fits(features):
    params = BoostParams(trees=5)
    run = walk_forward(features, params=params)
    found = collect(run.predictions, "symbol", "row_idx")
    assert run.predictions.columns == PREDICTIONS.names
    expected = []
    for symbol, n, seed in (("A", 300, 1), ("B", 220, 2)):
        x, y = numbers(n, seed)
        for start, cut in brute.folds(n, 0.6, 21, 63):
            model = boosting.fit(x[:cut], y[:cut], np.arange(cut), COLUMNS, params)
            values = model.predict(x[start : start + 21])
            expected += [(symbol, start + i, y[start + i], v) for i, v in enumerate(values)]
    assert [(r["symbol"], r["row_idx"], r["actual"], r["predicted"]) for r in found] == expected


def test_lanes_and_partitions_do_not_change_models(features):
    rows = walk_forward_rows(features)
    params = BoostParams(trees=3)
    one = model_texts(fit_grouped(rows, COLUMNS, params, lane_rows=10**9))
    many = model_texts(fit_grouped(rows.repartition(9), COLUMNS, params, lane_rows=1))
    assert one == many and len(one) == 4


def test_models_and_predictions_come_from_one_stored_fit(features):
    run = walk_forward(features, params=BoostParams(trees=3), store=True)
    assert run.models.columns == MODELS.names
    sizes = {(r.symbol, r.refit_id): (r.train_cut, r.n_train) for r in run.models.collect()}
    assert sizes == {
        ("A", 0): (180, 180), ("A", 1): (243, 243), ("B", 0): (132, 132), ("B", 1): (195, 195),
    }
    assert "applyInArrow" not in run.models._jdf.queryExecution().toString()


def test_embargo_trains_on_fewer_rows(features):
    run = walk_forward(features, WalkForward(embargo=5), params=BoostParams(trees=1))
    assert {r.train_cut - r.n_train for r in run.models.collect()} == {5}


def test_spread_fits_the_same_models(features, monkeypatch):
    monkeypatch.setattr(spread, "TREES_PER_STATE", 2)
    rows, params = walk_forward_rows(features), BoostParams(trees=3, depth=2)
    grouped = walk_forward(features, params=params)
    models, predictions = fit_spread(rows, COLUMNS, params, refits_per_batch=1)
    assert model_texts(models) == model_texts(grouped.models)
    keys = ("symbol", "row_idx")
    assert collect(predictions, *keys) == collect(grouped.predictions, *keys)
    shares = {(r.symbol, r.refit_id): r for r in models.collect()}
    for row in grouped.models.collect():
        other = shares[row.symbol, row.refit_id]
        assert (other.train_cut, other.n_train) == (row.train_cut, row.n_train)
        assert other.importances == pytest.approx(row.importances)


def test_spread_has_the_same_borders(spark):
    rng = np.random.default_rng(6)
    wide = np.concatenate([rng.normal(0, 0.01, 600), [0.0] * 80, [0.5] * 40, [1e9, -1e9, -0.25]])
    even = 100 + np.arange(len(wide)) * 1e-7
    x = np.column_stack([wide, even, np.ones(len(wide))])
    segment = rng.integers(0, 4, len(wide))
    rows = [("A", int(s), float(i), v.tolist()) for i, (s, v) in enumerate(zip(segment, x))]
    train = spark.createDataFrame(rows, "series string, segment int, y double, x array<double>")
    growths = spread._starts(train, 4)
    spread._place_borders(train, growths, 3, BoostParams(max_bins=32))
    for refit, edges in enumerate(growths["A"].edges):
        own = x[segment <= refit]
        assert growths["A"].n[refit] == len(own)
        for f in range(3):
            assert edges[f].tolist() == boosting.bin_edges(own[:, f], 32).tolist()


def test_spread_stores_a_row_once_for_all_refits(features, monkeypatch):
    stored = []

    def kept(train, growths, refits):
        stored.append((first_state(train, growths, refits), refits))
        return stored[-1][0]

    first_state = spread._first_state
    monkeypatch.setattr(spread, "_first_state", kept)
    # what the fit stored stays, to be looked at
    monkeypatch.setattr(spread, "clearing_scratch", lambda _: nullcontext())
    rows = walk_forward_rows(features)
    fit_spread(rows, COLUMNS, BoostParams(trees=1, depth=1))
    (state, refits), = stored
    assert refits == 2
    assert state.count() == rows.filter("segment < refits").count()


def test_spread_adds_up_by_a_shuffle_as_well(features, monkeypatch):
    rows, params = holdout_rows(features).repartition(5), BoostParams(trees=2)
    few, _ = fit_spread(rows, COLUMNS, params)
    monkeypatch.setattr(spread, "GATHERED", 0)
    many, _ = fit_spread(rows, COLUMNS, params)
    assert model_texts(few) == model_texts(many)


def test_series_are_worked_on_in_shares(features, monkeypatch):
    rows, params = holdout_rows(features), BoostParams(trees=1, depth=1)
    together, _ = fit_spread(rows, COLUMNS, params)
    monkeypatch.setattr(spread, "MODELS_AT_ONCE", 1)
    apart, _ = fit_spread(rows, COLUMNS, params)
    assert model_texts(together) == model_texts(apart)


def test_long_series_take_the_spread_way(features):
    params = BoostParams(trees=2, depth=1)
    layout = SeriesLayout(128)
    mixed = holdout(features, params=params, layout=layout, max_fit_rows=250)
    plain = holdout(features, params=params)
    keys = ("symbol", "row_idx")
    assert collect(mixed.predictions, *keys) == collect(plain.predictions, *keys)
    assert model_texts(mixed.models) == model_texts(plain.models)


def test_boosted_beats_the_mean(features):
    def mae(learner):
        return {r.symbol: r.mae for r in evaluate(
            walk_forward(features, learner=learner).predictions).collect()}

    boosted, mean = mae("boosted"), mae("train_mean")
    assert all(boosted[s] < 0.6 * mean[s] for s in mean)


def test_train_mean_is_the_mean_of_the_training_rows(features):
    found = {
        (r["symbol"], r["row_idx"]): r["predicted"]
        for r in collect(train_mean(walk_forward_rows(features)), "symbol")
    }
    for symbol, n, seed in (("A", 300, 1), ("B", 220, 2)):
        _, y = numbers(n, seed)
        for start, cut in brute.folds(n, 0.6, 21, 63):
            assert found[symbol, start + 20] == pytest.approx(y[:cut].mean())


def test_importances_are_sorted(features):
    models = holdout(features, params=BoostParams(trees=5), store=True).models
    rows = [r for r in importances(models).collect() if r.symbol == "A"]
    values = [r.importance for r in rows]
    assert values == sorted(values) and len(values) == 16 and sum(values) == pytest.approx(1)
    printed = [r for r in rounded_importances(models).collect() if r.symbol == "A"]
    assert printed[0].feature == rows[-1].feature
    assert printed[0].importance == round(rows[-1].importance, 4)


def test_pooled_learns_from_all_symbols(features):
    rows = pooled_rows(features)
    predictions, models = fit_pooled(rows, params=BoostParams(trees=5, learning_rate=0.3))
    # the last 60 of 300 dates; the shorter series ended before
    assert predictions.count() == 60
    model, = models.collect()
    assert model.symbol == POOL and model.n_train == 240 + 220
    assert max(model.importances, key=model.importances.get) == COLUMNS[0]
    assert sum(model.importances.values()) == pytest.approx(1)


def test_pooled_equals_one_fit_of_all_rows(features):
    params = BoostParams(trees=4)
    rows = pooled_rows(features)
    _, models = fit_pooled(rows.repartition(7), params=params)
    train = [r for r in rows.collect() if r.segment == 0]
    x = np.array([[r[c] for c in COLUMNS] for r in train])
    code = {s: int(hashlib.md5(s.encode()).hexdigest()[:7], 16) * 2**21 for s in "AB"}
    number = np.array([code[r.symbol] + r.row_idx for r in train])
    plain = boosting.fit(x, np.array([r.target_vol for r in train]), number, COLUMNS, params)
    stored = boosting.Model.from_json(models.first().model)
    assert stored.base == plain.base
    for ours, theirs in zip(stored.trees, plain.trees, strict=True):
        for name in ("feature", "threshold", "value", "gain"):
            assert getattr(ours, name).tolist() == getattr(theirs, name).tolist()


def test_pooled_never_trains_on_a_later_date(features):
    rows = pooled_rows(features, WalkForward()).collect()
    for refit in {r.refit_id for r in rows} - {None}:
        first = min(r.date for r in rows if r.refit_id == refit)
        assert max(r.date for r in rows if r.segment <= refit) < first
    none = pooled_rows(features.filter(F.col("date") < "2020-01-10"), WalkForward())
    assert fit_pooled(none)[0].count() == 0


def test_pooled_models_score_every_symbol(features):
    run = holdout(features, learner="pooled", params=BoostParams(trees=3))
    again = {(r.symbol, r.date): r.predicted for r in score(features, run.models, of=POOL).collect()}
    assert len(again) == 520
    known = {(r.symbol, r.date): r.predicted for r in run.predictions.collect()}
    assert {k: again[k] for k in known} == known


def test_stored_models_score_later(features, tmp_path, spark):
    params = BoostParams(trees=5)
    run = holdout(features, params=params, store=True)
    path = write_table(run.models, str(tmp_path / "models"))
    again = score(features, read_models(spark, path))
    keys = ("symbol", "date")
    known = {(r["symbol"], r["date"]): r["predicted"] for r in collect(run.predictions, *keys)}
    found = {(r["symbol"], r["date"]): r["predicted"] for r in collect(again, *keys)}
    assert len(found) == 520
    assert {k: found[k] for k in known} == known


def test_the_latest_refit_scores(features):
    run = walk_forward(features, params=BoostParams(trees=2), store=True)
    assert {r.refit_id for r in score(features, run.models).collect()} == {1}


def test_fewer_inputs(features):
    some = holdout(features, params=BoostParams(trees=2), columns=COLUMNS[:12])
    assert set(some.models.first().importances) == set(COLUMNS[:12])
    thin = features.drop(*COLUMNS[12:])
    same = holdout(thin, params=BoostParams(trees=2), columns=feature_columns(with_vix=False))
    keys = ("symbol", "row_idx")
    assert collect(same.predictions, *keys) == collect(some.predictions, *keys)
    with pytest.raises(ValueError, match="vix_lag_1"):
        holdout(thin)


def test_unknown_learner_is_refused(features):
    with pytest.raises(ValueError, match="unknown learner"):
        walk_forward(features, learner="guess")


def test_series_without_folds_yield_nothing(features):
    short = features.filter(F.col("date") < "2020-01-15")
    assert walk_forward(short, params=BoostParams(trees=1)).predictions.count() == 0


def test_pooled_plan_makes_the_features_once(spark, features):
    from volspark.catalog import queries as catalog

    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    panel = catalog.Panel(spark, "none")
    panel.features = features.mapInArrow(counted, features.schema)
    plan = catalog._pooled_plan(panel).collect()
    assert plan and made.value == features.count()


def test_learning_rows_hold_what_learners_use(features, monkeypatch):
    import volspark.operators.backtest as module

    kept = []

    def watched(df, name, by=()):
        kept.append(df.columns)
        return df

    monkeypatch.setattr(module, "materialize", watched)
    module.holdout(features, params=BoostParams(trees=1, depth=1), columns=COLUMNS)
    assert set(kept[0]) >= {"symbol", "date", "n", "target_vol", *COLUMNS}
    assert "realized_vol" not in kept[0]
