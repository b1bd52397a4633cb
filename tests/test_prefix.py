"""Means and deviations from running sums."""

import math
import random
import statistics
from datetime import date, timedelta
from fractions import Fraction

import pytest
from conftest import collect
from pyspark.errors import PySparkException
from pyspark.sql import Window

from volspark import realized_volatility
from volspark.functions.prefix import BITS, LIMIT, Rolling, add_rolling
from volspark.operators.align import attach_series
from volspark.operators.features import add_features
from volspark.operators.series import SeriesLayout

KEYS = ("symbol", "date")


def rolled(df, **wanted):
    """The columns added, row by row."""
    return collect(add_rolling(df, Window.partitionBy("symbol").orderBy("date"), wanted), "date")


def table(spark, values, symbol="A"):
    rows = [(symbol, date(2000, 1, 1) + timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "symbol string, date date, x double")


@pytest.mark.parametrize("seed,size", [(1, 1e-9), (2, 0.01), (3, 60.0)])
def test_windows_are_exact(spark, seed, size):
    """Against fractions, of values already on the grid: only the last steps round."""
    rng = random.Random(seed)
    values = [rng.uniform(-size, size) for _ in range(300)]
    values[50:60] = [None] * 3 + [size] * 7
    values[200:240] = [values[199]] * 40
    wanted = {"mean_7": Rolling("x", 7, False), "dev_7": Rolling("x", 7), "dev_90": Rolling("x", 90)}
    found = rolled(table(spark, values), **wanted)
    on_grid = [None if v is None else Fraction(round(v * 2**BITS), 2**BITS) for v in values]
    for i, row in enumerate(found):
        for name, rolling in wanted.items():
            window = on_grid[max(0, i + 1 - rolling.rows) : i + 1]
            if len(window) < rolling.rows or None in window:
                assert row[name] is None
                continue
            mean = sum(window) / rolling.rows
            if not rolling.deviation:
                assert row[name] == pytest.approx(float(mean), rel=1e-14, abs=1e-28)
                continue
            spread = sum((x - mean) ** 2 for x in window) / (rolling.rows - 1)
            assert (row[name] == 0) == (spread == 0)
            assert row[name] == pytest.approx(math.sqrt(spread), rel=1e-13)


def test_far_from_zero(spark):
    """Values that differ in their last places only."""
    values = [60 + 1e-9 * (i % 3) for i in range(40)]
    found = rolled(table(spark, values), d=Rolling("x", 6))
    assert found[20]["d"] == pytest.approx(statistics.stdev([0, 1e-9, 2e-9] * 2), rel=1e-4)


def test_values_beyond_the_grid_fail(spark):
    with pytest.raises(PySparkException, match="x beyond"):
        rolled(table(spark, [1.0, LIMIT * 2]), d=Rolling("x", 2))


def test_layouts_agree_in_every_bit(bars, implied_vol):
    found = []
    for layout in (SeriesLayout(), SeriesLayout(70)):
        vol = realized_volatility(bars, layout=layout, running=True)
        wide = attach_series(vol, implied_vol)
        found.append(collect(add_features(wide, layout=layout, running=True), *KEYS))
    assert found[0] == found[1] and found[0]
    plain = collect(add_features(attach_series(realized_volatility(bars), implied_vol)), *KEYS)
    assert len(plain) == len(found[0])
    for a, b in zip(found[0], plain):
        assert a == {k: pytest.approx(v, rel=1e-9, abs=1e-12) if isinstance(v, float) else v for k, v in b.items()}


def test_without_an_index(bars):
    vol = realized_volatility(bars, running=True)
    ours, plain = (collect(add_features(vol, running=r), *KEYS) for r in (True, False))
    assert [r["vol_63d"] for r in ours] == pytest.approx([r["vol_63d"] for r in plain])
    assert ours[0].keys() == plain[0].keys()
