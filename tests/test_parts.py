"""States of date parts, merged in any grouping, against the metrics and regimes of all rows."""

import random
from datetime import date, timedelta

import pytest
from conftest import collect

from volspark.operators.metrics import evaluate
from volspark.operators.parts import (
    ALL,
    merge_metric_states,
    merge_run_states,
    metric_states,
    metrics_in_range,
    metrics_of,
    regimes_in_range,
    regimes_of,
    run_states,
)
from volspark.operators.reports import regimes

RANGES = [
    (None, None),
    ("2020-02-11", "2021-09-17"),
    ("2020-03-01", "2020-03-31"),
    ("2020-03-05", "2020-03-06"),
    (None, "2020-12-31"),
    ("2021-06-15", None),
    ("2030-01-01", "2031-01-01"),
]


@pytest.fixture(scope="module")
def scored(spark):
    """Long runs, lone days, gaps of months, values without a prediction, a constant series."""
    rng, rows = random.Random(9), []
    for symbol, days, hold in (("A", 700, 9), ("B", 500, 60), ("C", 40, 1), ("D", 1, 1)):
        level = 0.2
        for i in range(days):
            if rng.random() < 0.15 or (symbol == "B" and 150 < i < 260):
                continue
            if rng.random() < 1 / hold:
                level = rng.choice([0.05, 0.12, 0.2, 0.25, 0.4])
            predicted = None if rng.random() < 0.05 else level + rng.choice([0, 0.01, -0.03])
            rows.append((symbol, date(2020, 1, 20) + timedelta(days=i), level, predicted))
    rows += [("E", date(2020, 1, 30) + timedelta(days=i), 0.3, 0.2) for i in range(5)]
    rng.shuffle(rows)
    return spark.createDataFrame(
        rows, "symbol string, date date, actual double, predicted double"
    ).cache()


def close(ours, theirs):
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs):
        assert a.keys() == b.keys()
        for name, value in b.items():
            if isinstance(value, float):
                assert a[name] == pytest.approx(value, abs=1e-9), name
            else:
                assert a[name] == value, name


@pytest.mark.parametrize("start,end", RANGES)
def test_metrics_of_a_range(scored, start, end):
    ours = metrics_in_range(metric_states(scored), scored, start, end)
    close(collect(ours, "symbol"), collect(evaluate(scored, start, end), "symbol"))


@pytest.mark.parametrize("start,end", RANGES)
def test_regimes_of_a_range(scored, start, end):
    keys = ("symbol", "regime", "start_date")
    ours = collect(regimes_in_range(run_states(scored), scored, start, end), *keys)
    assert ours == collect(regimes(scored, start, end), *keys)


@pytest.mark.parametrize("way", [["month"], ["month", "quarter"], ["month", "year"], [ALL], ["year"]])
def test_any_grouping_merges_to_the_same(scored, way):
    states, runs = metric_states(scored, way[0]), run_states(scored, unit=way[0])
    for unit in (*way[1:], ALL):
        states, runs = merge_metric_states(states, unit), merge_run_states(runs, unit)
    close(collect(metrics_of(states), "symbol"), collect(evaluate(scored), "symbol"))
    keys = ("symbol", "regime", "start_date")
    assert collect(regimes_of(runs), *keys) == collect(regimes(scored), *keys)


def test_only_cut_parts_are_read_as_rows(scored):
    from volspark.operators.parts import _cut_parts

    months = {(r.date.year, r.date.month) for r in _cut_parts(scored, "month", "2020-02-11", "2021-09-17").collect()}
    assert months == {(2020, 2), (2021, 9)}
    assert _cut_parts(scored, "month", "2020-02-01", "2020-02-29").count() == 0


def test_scored_rows_are_read_once(spark, scored):
    """However often the states are merged, each scored row is computed one time."""
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    rows = scored.count()
    once = scored.mapInArrow(counted, scored.schema)
    regimes_in_range(run_states(once), once).collect()
    assert reads.value == rows
