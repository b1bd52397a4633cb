from datetime import date, timedelta

import brute
import numpy as np
import pytest
from conftest import collect

from volspark import evaluate, format_metrics, schemas
from volspark.operators import reports
from volspark.operators.metrics import backtest_period, in_date_range
from volspark.operators.series import SeriesLayout

FIRST = date(2020, 1, 1)
LAYOUTS = [SeriesLayout(), SeriesLayout(16)]


def table(spark, **series):
    rows = [
        (symbol, FIRST + timedelta(days=i), i, 0, 0, float(a), float(p))
        for symbol, (actual, predicted) in series.items()
        for i, (a, p) in enumerate(zip(actual, predicted))
    ]
    return spark.createDataFrame(rows, schemas.PREDICTIONS).repartition(3)


@pytest.fixture(scope="module")
def noisy():
    rng = np.random.default_rng(11)
    made = {}
    for symbol, n in (("A", 90), ("B", 41)):
        actual = 0.18 + 0.08 * np.sin(np.arange(n) / 4) + rng.normal(0, 0.03, n)
        # Rounded predictions stand still now and then.
        made[symbol] = (actual.tolist(), np.round(actual + rng.normal(0, 0.03, n), 1).tolist())
    return made


@pytest.fixture(scope="module")
def predictions(spark, noisy):
    return table(spark, **noisy).cache()


@pytest.mark.parametrize("layout", LAYOUTS)
def test_metrics_equal_brute_force(predictions, noisy, layout):
    for row in collect(evaluate(predictions, layout=layout), "symbol"):
        for name, value in brute.errors(*noisy[row["symbol"]]).items():
            assert row[name] == pytest.approx(value), name


def test_range_is_cut_before_steps_are_taken(predictions, noisy):
    start, end = FIRST + timedelta(days=10), FIRST + timedelta(days=30)
    found = collect(evaluate(predictions, str(start), str(end)), "symbol")[0]
    actual, predicted = noisy["A"]
    assert found == {"symbol": "A"} | {
        k: pytest.approx(v) for k, v in brute.errors(actual[10:31], predicted[10:31]).items()
    }


def test_constant_sides_have_no_correlation(spark):
    df = table(spark, FLAT=([0.2] * 5, [0.1, 0.2, 0.3, 0.2, 0.1]), ONE=([0.1], [0.2]))
    flat, one = collect(evaluate(df), "symbol")
    assert flat["correlation"] is None and flat["directional_accuracy"] == 0.0
    assert one["directional_accuracy"] is None and one["n"] == 1
    assert evaluate(df.filter("1 = 0")).count() == 0


def test_standing_still_counts_as_a_direction(spark):
    df = table(spark, X=([0.1, 0.1, 0.2, 0.2], [0.3, 0.3, 0.3, 0.4]))
    assert collect(evaluate(df), "symbol")[0]["directional_accuracy"] == pytest.approx(1 / 3)


def test_texts(spark):
    df = table(spark, X=([0.1, 0.2, 0.3, 0.25], [0.1, 0.25, 0.3, 0.35]))
    (row,) = collect(format_metrics(evaluate(df)), "symbol")
    expected = brute.errors([0.1, 0.2, 0.3, 0.25], [0.1, 0.25, 0.3, 0.35])
    assert row["mae"] == f"{expected['mae']:.4f}"
    assert row["rmse"] == f"{expected['rmse']:.4f}"
    assert row["correlation"] == f"{expected['correlation']:.4f}"
    assert row["directional_accuracy"] == "66.67%"


def expected_regimes(symbol, values, offset=0):
    last = FIRST + timedelta(days=offset + len(values) - 1)
    out = []
    for name, inside in (("high", lambda v: v > 0.25), ("low", lambda v: v < 0.12)):
        for start, stop, rows in brute.runs(values, inside):
            end = last if stop is None else FIRST + timedelta(days=offset + stop)
            out.append((symbol, name, FIRST + timedelta(days=offset + start), end, rows))
    return sorted(out)


def as_tuples(df):
    return sorted(tuple(r) for r in df.collect())


SERIES = {
    "open_at_end": [0.2, 0.3, 0.3],
    "single_last_row": [0.2, 0.2, 0.3],
    "touching": [0.25, 0.12, 0.26, 0.25, 0.11, 0.12],
    "jump": [0.3, 0.05, 0.3, 0.05],
    "all_low": [0.1] * 4,
    "none": [0.2] * 4,
    "one": [0.5],
}


@pytest.mark.parametrize("layout", [SeriesLayout(), SeriesLayout(2)])
def test_regimes_of_hand_made_series(spark, layout):
    df = table(spark, **{k: (v, v) for k, v in SERIES.items()})
    expected = sorted(r for k, v in SERIES.items() for r in expected_regimes(k, v))
    assert as_tuples(reports.regimes(df, layout=layout)) == expected


@pytest.mark.parametrize("layout", LAYOUTS)
def test_regimes_of_random_series(spark, layout):
    rng = np.random.default_rng(4)
    made = {f"R{i}": rng.choice([0.05, 0.12, 0.2, 0.25, 0.3], 60).tolist() for i in range(10)}
    df = table(spark, **{k: (v, v) for k, v in made.items()})
    expected = sorted(r for k, v in made.items() for r in expected_regimes(k, v))
    assert as_tuples(reports.regimes(df, layout=layout)) == expected


def test_regimes_within_dates(predictions, noisy):
    start, end = FIRST + timedelta(days=20), FIRST + timedelta(days=60)
    found = as_tuples(reports.regimes(predictions, str(start), str(end)))
    assert [r for r in found if r[0] == "A"] == expected_regimes("A", noisy["A"][0][20:61], offset=20)


def test_date_range_is_inclusive_and_optional(predictions):
    day = str(FIRST + timedelta(days=3))
    assert in_date_range(predictions, day, day).count() == 2
    assert in_date_range(predictions, "", None).count() == predictions.count()


def test_residual_sides(spark):
    df = table(spark, X=([0.2, 0.2, 0.2], [0.3, 0.2, 0.1]))
    assert [r["side"] for r in collect(reports.residuals(df), "date")] == ["over", "under", "under"]


def test_bounds_and_last_rows(predictions, noisy):
    line = collect(reports.scatter_bounds(predictions), "symbol")[0]
    both = noisy["A"][0] + noisy["A"][1]
    assert line == {"symbol": "A", "line_from": min(both), "line_to": max(both)}
    bounds = collect(reports.date_bounds(predictions), "symbol")[1]
    assert bounds["min_allowed"] == bounds["start_date"] == FIRST
    assert bounds["max_allowed"] == bounds["end_date"] == FIRST + timedelta(days=40)
    assert [r["row_idx"] for r in collect(reports.last_rows(predictions), "symbol", "date")] == [
        87, 88, 89, 38, 39, 40,
    ]
    period = collect(backtest_period(predictions), "symbol")[1]
    assert period["n_predictions"] == 41 and period["first_date"] == FIRST


def test_labels(spark):
    df = table(spark, SPY=([0.1], [0.1]), ZZZ=([0.1], [0.1]))
    found = {r["symbol"]: r["label"] for r in collect(reports.symbols(df), "symbol")}
    assert found == {"SPY": "SPY — S&P 500 ETF", "ZZZ": "ZZZ"}


def test_bundle_covers_all_dates_where_it_should(predictions):
    tables = reports.bundle(predictions, symbol="A", start=str(FIRST + timedelta(days=50)))
    assert tables["series"].count() == 40
    assert tables["residuals"].count() == 40
    assert tables["scatter"].count() == 90
    assert tables["metrics"].count() == 1
    assert "importances" not in tables
