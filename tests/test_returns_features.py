import math
from datetime import date, timedelta

import brute
import pandas as pd
import pytest
from conftest import collect, frame, walk
from pyspark.sql import functions as F

from volspark import add_features, attach_series, log_returns, realized_volatility, schemas
from volspark.operators.clean import drop_incomplete, nan_to_null
from volspark.operators.series import SeriesLayout
from volspark.schemas import feature_columns

LAYOUTS = [SeriesLayout(), SeriesLayout(64), SeriesLayout(90)]


def by_symbol(rows):
    out = {}
    for row in sorted(rows, key=lambda r: (r["symbol"], r["date"])):
        out.setdefault(row["symbol"], []).append(row)
    return out


def assert_close(found, expected, columns):
    assert len(found) == len(expected)
    for a, b in zip(found, expected):
        assert a["date"] == b["date"]
        for c in columns:
            assert a[c] == pytest.approx(b[c], rel=1e-9, abs=1e-12), (a["date"], c)


@pytest.fixture(scope="module")
def vol(bars):
    return realized_volatility(bars).cache()


@pytest.fixture(scope="module")
def featured(vol, implied_vol):
    return add_features(attach_series(vol, implied_vol)).cache()


def test_volatility_schema(vol):
    assert vol.columns == [*schemas.BARS.names, "log_return", "realized_vol"]
    assert dict(vol.dtypes)["realized_vol"] == "double"


def test_volatility_has_no_missing_values_and_is_positive(vol):
    missing = [F.col(c).isNull() for c in vol.columns] + [F.isnan("realized_vol")]
    anything = missing[0]
    for m in missing[1:]:
        anything = anything | m
    assert vol.filter(anything).count() == 0
    assert vol.filter(F.col("realized_vol") <= 0).count() == 0


def test_volatility_level(vol):
    for row in vol.groupBy("symbol").agg(F.avg("realized_vol").alias("v")).collect():
        assert 0.05 < row.v < 1.0


def test_volatility_costs_the_window(vol):
    counts = {r["symbol"]: r["count"] for r in vol.groupBy("symbol").count().collect()}
    assert counts == {"AAA": 129, "BBB": 129, "CCC": 129}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_volatility_equals_brute_force(bars, price_rows, layout):
    found = by_symbol(collect(realized_volatility(bars, layout=layout), "symbol", "date"))
    given = by_symbol(price_rows.to_dict("records"))
    for symbol, rows in given.items():
        expected = brute.volatility(rows)
        assert_close(found[symbol], expected, ["close", "log_return", "realized_vol"])


def test_feature_schema(featured):
    expected = [*schemas.BARS.names, "log_return", "realized_vol", "vix"]
    assert featured.columns == [*expected, *feature_columns(), "target_vol"]
    assert len(featured.columns) == 27


def test_features_complete_and_counted(featured):
    assert featured.na.drop("any").count() == featured.count() == 3 * 62


def test_feature_levels(featured):
    row = featured.agg(
        F.avg("vix_normalized").alias("level"), F.min("vol_ratio").alias("ratio")
    ).first()
    assert 0.05 < row.level < 1.0
    assert row.ratio > 0


@pytest.mark.parametrize("layout", LAYOUTS)
def test_features_equal_brute_force(bars, price_rows, implied_vol, layout):
    processed = attach_series(realized_volatility(bars, layout=layout), implied_vol)
    found = by_symbol(collect(add_features(processed, layout=layout), "symbol", "date"))
    index = {r.date: r.vix for r in implied_vol.collect()}
    for symbol, rows in by_symbol(price_rows.to_dict("records")).items():
        joined = [r | {"vix": index[r["date"]]} for r in brute.volatility(rows)]
        expected = brute.features(joined)
        assert_close(found[symbol], expected, [*feature_columns(), "target_vol"])


def test_features_without_index(vol, price_rows):
    plain = add_features(vol)
    assert "vix_normalized" not in plain.columns
    found = by_symbol(collect(plain, "symbol", "date"))
    for symbol, rows in by_symbol(price_rows.to_dict("records")).items():
        expected = brute.features(brute.volatility(rows), with_vix=False)
        assert_close(found[symbol], expected, [*feature_columns(False), "target_vol"])


def test_premium_is_zero_when_the_index_is_the_volatility(vol):
    same = vol.withColumn("vix", F.col("realized_vol") * 100)
    worst = add_features(same).agg(F.max(F.abs("vol_risk_premium"))).first()[0]
    assert worst < 1e-12


def test_a_gap_in_the_index_drops_rows_but_not_returns(bars, price_rows, implied_vol):
    gap = date(2022, 1, 3) + timedelta(days=80)
    holed = implied_vol.filter(F.col("date") != F.lit(gap))
    found = by_symbol(
        collect(add_features(attach_series(realized_volatility(bars), holed)), "symbol", "date")
    )
    index = {r.date: r.vix for r in holed.collect()}
    rows = by_symbol(price_rows.to_dict("records"))["BBB"]
    kept = [r | {"vix": index[r["date"]]} for r in brute.volatility(rows) if r["date"] in index]
    assert_close(found["BBB"], brute.features(kept), [*feature_columns(), "target_vol"])
    assert gap not in [r["date"] for r in found["BBB"]]


@pytest.mark.parametrize("partitions", [1, 7])
def test_partitioning_does_not_matter(bars, implied_vol, featured, partitions):
    moved = bars.repartition(partitions)
    again = add_features(attach_series(realized_volatility(moved), implied_vol))
    assert collect(again, "symbol", "date") == collect(featured, "symbol", "date")


def test_constant_close_gives_no_ratio_and_no_error(spark, implied_vol):
    flat = walk("FLAT", 150, 1).assign(open=5.0, high=5.0, low=5.0, close=5.0)
    vol = realized_volatility(frame(spark, flat, schemas.BARS))
    assert vol.agg(F.max("realized_vol")).first()[0] == 0.0
    assert add_features(attach_series(vol, implied_vol)).count() == 0


def test_zero_close_drops_every_window_it_touches(spark):
    rows = walk("ZERO", 120, 2)
    rows.loc[60, "close"] = 0.0
    found = collect(realized_volatility(frame(spark, rows, schemas.BARS)), "date")
    expected = brute.volatility(rows.to_dict("records"))
    assert_close(found, expected, ["log_return", "realized_vol"])
    assert len(found) == 120 - 21 - 22


def test_missing_closes_leave_at_the_source(spark):
    rows = walk("GAP", 100, 3)
    rows["close"] = rows["close"].astype(object)
    rows.loc[40, "close"] = None
    df = frame(spark, rows, schemas.BARS)
    df = df.withColumn(
        "close", F.when(F.col("volume") == int(rows.loc[50, "volume"]), float("nan"))
        .otherwise(F.col("close"))
    )
    assert drop_incomplete(df).count() == 98
    assert nan_to_null(df).filter(F.col("close").isNull()).count() == 2
    kept = [r for i, r in enumerate(rows.to_dict("records")) if i not in (40, 50)]
    found = collect(realized_volatility(drop_incomplete(df)), "date")
    assert_close(found, brute.volatility(kept), ["log_return", "realized_vol"])


def test_first_return_is_missing_and_symbols_do_not_mix(bars):
    rows = by_symbol(collect(log_returns(bars), "symbol", "date"))
    for series in rows.values():
        assert series[0]["log_return"] is None
        assert series[1]["log_return"] == pytest.approx(
            math.log(series[1]["close"] / series[0]["close"])
        )


@pytest.mark.parametrize("layout", [SeriesLayout(), SeriesLayout(64)])
def test_duplicate_dates_fail(spark, layout):
    rows = walk("DUP", 100, 4)
    twice = frame(spark, pd.concat([rows, rows.iloc[[63]]]), schemas.BARS)
    with pytest.raises(Exception, match="duplicate"):
        realized_volatility(twice, layout=layout).collect()


def test_wide_side_series_is_joined_without_broadcast(vol, implied_vol):
    joined = attach_series(vol, implied_vol, max_broadcast_rows=10)
    plain = attach_series(vol, implied_vol)
    assert collect(joined, "symbol", "date") == collect(plain, "symbol", "date")
