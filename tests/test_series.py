from datetime import date, timedelta

import numpy as np
import pytest
from conftest import collect
from pyspark.sql import functions as F

from volspark import WalkForward
from volspark.learners.boosting import BoostParams
from volspark.operators.backtest import walk_forward
from volspark.operators.features import add_features
from volspark.operators.returns import realized_volatility
from volspark.operators.series import (
    SeriesLayout,
    add_series_value,
    number_rows,
    over_series,
)
from volspark.schemas import feature_columns


@pytest.fixture(scope="module")
def skewed(spark):
    """One symbol with half of all rows, dates with gaps, no order."""
    rng = np.random.default_rng(8)
    rows = []
    for symbol, n in (("HOT", 700), *[(f"S{i}", 50) for i in range(14)]):
        days = np.cumsum(rng.integers(1, 5, n))
        rows += [
            (symbol, date(1965, 1, 1) + timedelta(days=int(d)), float(v))
            for d, v in zip(days, rng.normal(100, 1, n))
        ]
    order = rng.permutation(len(rows))
    schema = "symbol string, date date, close double"
    return spark.createDataFrame([rows[i] for i in order], schema).repartition(5).cache()


def moments(df, w):
    return df.withColumns(
        {
            "back": F.sum("close").over(w.rowsBetween(-9, 0)),
            "ahead": F.lead("close", 3).over(w),
            "rows": F.count("close").over(w.rowsBetween(-9, 3)),
        }
    )


@pytest.mark.parametrize("size", [10, 37, 64, 10_000])
def test_chunks_give_what_whole_series_give(skewed, size):
    whole = over_series(skewed, moments, before=9, after=3)
    cut = over_series(skewed, moments, before=9, after=3, layout=SeriesLayout(size))
    assert cut.columns == whole.columns
    keys = ("symbol", "date")
    for a, b in zip(collect(whole, *keys), collect(cut, *keys), strict=True):
        assert a["back"] == pytest.approx(b["back"]) and a["ahead"] == b["ahead"]
        assert (a["symbol"], a["date"], a["rows"]) == (b["symbol"], b["date"], b["rows"])


def test_no_group_is_longer_than_a_chunk_and_its_neighbours(skewed):
    sizes = []

    def measured(df, w):
        sizes.append(df.groupBy("symbol", "_chunk").count().agg(F.max("count")).first()[0])
        return moments(df, w)

    over_series(skewed, measured, before=9, after=3, layout=SeriesLayout(64)).count()
    assert sizes[0] <= 64 + 9 + 3


@pytest.mark.parametrize("size", [10, 64, 10_000])
def test_numbers_and_totals(skewed, size):
    keys = ("symbol", "date")
    whole, cut = (number_rows(skewed, layout) for layout in (SeriesLayout(), SeriesLayout(size)))
    assert collect(whole, *keys) == collect(cut.select(*whole.columns), *keys)
    last = add_series_value(skewed, "last", F.max("date"), SeriesLayout(size))
    assert collect(last, *keys) == collect(add_series_value(skewed, "last", F.max("date")), *keys)


def test_frames_must_fit_a_chunk(skewed):
    with pytest.raises(ValueError, match="shorter than a frame"):
        over_series(skewed, moments, before=9, layout=SeriesLayout(8))


def test_hot_symbol_through_the_whole_run(spark, skewed):
    """Features, folds and trees of a hot symbol, cut and whole, agree."""
    noisy = skewed.select(
        "symbol", "date", *[F.col("close").alias(c) for c in ("open", "high", "low", "close")],
        F.lit(1).cast("long").alias("volume"),
    )

    def run(layout, max_fit_rows):
        vol = realized_volatility(noisy, layout=layout)
        processed = vol.withColumn("vix", F.col("close") / 5)
        features = add_features(processed, layout=layout)
        return walk_forward(
            features, WalkForward(0.6, 63, 126), params=BoostParams(trees=2, depth=1),
            layout=layout, max_fit_rows=max_fit_rows,
        ).predictions

    keys = ("symbol", "row_idx")
    whole = collect(run(SeriesLayout(), 10_000), *keys)
    cut = collect(run(SeriesLayout(100), 200), *keys)
    assert whole and {r["symbol"] for r in whole} == {"HOT"}
    for a, b in zip(whole, cut, strict=True):
        assert a["predicted"] == pytest.approx(b["predicted"], rel=1e-6)
        assert (a["date"], a["fold_id"], a["refit_id"]) == (b["date"], b["fold_id"], b["refit_id"])


def test_a_long_series_is_fitted_whatever_the_layout(spark):
    rows = [("S", date(2020, 1, 1) + timedelta(days=i), 1.0, i / 7) for i in range(300)]
    schema = "symbol string, date date, realized_vol double, target_vol double"
    df = spark.createDataFrame(rows, schema)
    inputs = enumerate(feature_columns(), 2)
    df = df.withColumns({c: F.pmod(F.col("target_vol") * i, F.lit(5.0)) for i, c in inputs})
    params = BoostParams(trees=2, depth=1)
    long = walk_forward(df, params=params, max_fit_rows=100).predictions
    assert collect(long, "row_idx") == collect(walk_forward(df, params=params).predictions, "row_idx")
