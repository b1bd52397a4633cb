from datetime import date, timedelta

import brute
import pytest
from conftest import collect
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from volspark import WalkForward, chronological_split, fold_plan, refit_plan, with_position
from volspark.operators.backtest import holdout_rows, walk_forward_rows
from volspark.operators.folds import scored_rows
from volspark.operators.series import SeriesLayout, calendar_span, choose_layout
from volspark.operators.split import require_model_columns, slice_rows, split_bounds

SIZES = {"S0": 5, "S1": 21, "S2": 62, "S3": 101, "S4": 400}


@pytest.fixture(scope="module")
def series(spark):
    first = date(2020, 1, 1)
    rows = [
        (symbol, first + timedelta(days=i), float(i), float(i))
        for symbol, n in SIZES.items()
        for i in range(n)
    ]
    schema = "symbol string, date date, realized_vol double, target_vol double"
    return spark.createDataFrame(rows, schema).repartition(3).cache()


def plans():
    return [
        WalkForward(),
        WalkForward(retrain_every=0),
        WalkForward(retrain_every=50),
        WalkForward(0.1, 7, 30),
        WalkForward(0.9),
    ]


@pytest.mark.parametrize("plan", plans())
def test_folds_equal_a_loop(series, plan):
    found = {}
    for r in collect(fold_plan(series, plan), "symbol", "fold_id"):
        found.setdefault(r["symbol"], []).append(r)
    for symbol, n in SIZES.items():
        share = (plan.initial_train_size, plan.step_size, plan.retrain_every)
        expected = brute.folds(n, *share)
        rows = found.get(symbol, [])
        assert [(r["score_from"], r["train_cut"]) for r in rows] == expected
        assert all(r["score_to"] - r["score_from"] == plan.step_size for r in rows)
        cuts = sorted({cut for _, cut in expected})
        assert [cuts[r["refit_id"]] for r in rows] == [cut for _, cut in expected]


@settings(max_examples=300, deadline=None)
@given(
    n=st.integers(0, 3000),
    share=st.sampled_from([0.1, 0.35, 0.6, 0.7, 0.9]),
    step=st.integers(1, 63),
    every=st.integers(0, 200),
)
def test_fold_arithmetic(n, share, step, every):
    """The closed form itself, in plain numbers, against the loop."""
    plan = WalkForward(share, step, every)
    first = int(n * share)
    count = max(0, -(-(n - step - first) // step))
    expected = brute.folds(n, share, step, every)
    assert len(expected) == count
    for k, (start, cut) in enumerate(expected):
        assert start == first + k * step
        assert cut == first + k // plan.folds_per_refit * plan.refit_rows


@pytest.mark.parametrize("layout", [SeriesLayout(), SeriesLayout(50)])
@pytest.mark.parametrize("plan", plans())
def test_marked_rows_agree_with_the_plan(series, plan, layout):
    marked = collect(walk_forward_rows(series, plan, layout), "symbol", "row_idx")
    for symbol, n in SIZES.items():
        rows = [r for r in marked if r["symbol"] == symbol]
        expected = brute.folds(n, plan.initial_train_size, plan.step_size, plan.retrain_every)
        scored = [r for r in rows if r["refit_id"] is not None]
        assert [r["row_idx"] for r in scored] == [
            start + i for start, _ in expected for i in range(plan.step_size)
        ]
        for refit, cut in enumerate(sorted({cut for _, cut in expected})):
            assert sum(r["segment"] <= refit for r in rows) == cut
            assert {r["train_cut"] for r in scored if r["refit_id"] == refit} == {cut}


def test_embargo_and_tail(series):
    plain = collect(refit_plan(series, WalkForward()), "symbol", "refit_id")
    assert [r["folds"] for r in plain if r["symbol"] == "S4"] == [3, 3, 1]
    marked = walk_forward_rows(series, WalkForward(embargo=5)).filter("symbol = 'S4'")
    assert marked.filter("segment <= 0").count() == 240 - 5
    whole = scored_rows(with_position(series), WalkForward(score_tail=True))
    last = {r["symbol"]: r["last"] for r in whole.groupBy("symbol").agg(
        F.max("row_idx").alias("last")).collect()}
    assert last == {s: n - 1 for s, n in SIZES.items()}


@pytest.mark.parametrize("layout", [SeriesLayout(), SeriesLayout(50)])
def test_split_is_chronological(series, layout):
    split = chronological_split(series, layout=layout)
    found = {(r["symbol"], r["split"]): r for r in collect(split_bounds(split), "symbol")}
    for symbol, n in SIZES.items():
        cut = int(n * (1 - 0.2))
        assert found[symbol, "train"]["n_rows"] == cut
        assert found[symbol, "test"]["n_rows"] == n - cut
        assert found[symbol, "train"]["last_date"] < found[symbol, "test"]["first_date"]


def test_holdout_rows(series):
    rows = collect(holdout_rows(series).filter("symbol = 'S3'"), "row_idx")
    assert [r["refit_id"] for r in rows] == [None] * 80 + [0] * 21
    assert {r["train_cut"] for r in rows[80:]} == {80}


def test_slices(series):
    part = slice_rows(with_position(series), 3, 30).groupBy("symbol").count()
    assert {r["symbol"]: r["count"] for r in part.collect()} == {
        s: max(0, min(n, 30) - 3) for s, n in SIZES.items()
    }


def test_layout_follows_the_calendar(series):
    assert calendar_span(series) == 400
    assert choose_layout(series).chunk_rows is None
    assert choose_layout(series, max_rows=100).chunk_rows == 100
    assert choose_layout(start="2015-01-01", end="2024-12-31").chunk_rows is None
    assert calendar_span(series.filter("1 = 0")) == 0
    with pytest.raises(ValueError):
        choose_layout()


def test_missing_model_columns_are_named(series):
    with pytest.raises(ValueError, match="vix_normalized"):
        require_model_columns(series)
