"""Adjusted prices against a loop over the actions."""

from datetime import date, timedelta

import pandas as pd
import pytest
from conftest import collect, frame, walk
from pyspark.errors import PySparkException

from volspark import log_returns, schemas
from volspark.operators.adjust import adjust_prices

ACTIONS = "symbol string, date date, split double, dividend double"


def day(i):
    return date(2022, 1, 3) + timedelta(days=i)


def brute(rows, actions):
    """Each ex-date in turn multiplies all earlier bars."""
    rows = [dict(r) for r in sorted(rows, key=lambda r: (r["symbol"], r["date"]))]
    raw = [dict(r) for r in rows]
    for symbol, ex in sorted({(a[0], a[1]) for a in actions if a[1]}):
        split, dividend = 1.0, 0.0
        for s, d, ratio, amount in actions:
            if (s, d) == (symbol, ex):
                split *= ratio if ratio is not None else 1.0
                dividend += amount or 0.0
        earlier = [i for i, r in enumerate(raw) if r["symbol"] == symbol and r["date"] < ex]
        closes = [raw[i]["close"] for i in earlier if raw[i]["close"] is not None]
        if not earlier:
            continue
        kept = 1 - dividend * split / closes[-1] if closes else 1.0
        for i in earlier:
            for name in ("open", "high", "low", "close"):
                if rows[i][name] is not None:
                    rows[i][name] *= kept / split
            rows[i]["volume"] *= split
    for r in rows:
        r["volume"] = int(r["volume"] + 0.5)
    return rows


@pytest.fixture(scope="module")
def made():
    rows = pd.concat([walk("A", 60, 1), walk("B", 40, 2), walk("C", 5, 3)])
    rows.loc[(rows.symbol == "A") & (rows.date.isin([day(20), day(29)])), "close"] = None
    return rows


CASES = {
    "none": [],
    "splits": [("A", day(10), 2.0, None), ("A", day(30), 0.1, None), ("B", day(1), 3.0, None)],
    "dividends": [("A", day(k), None, 0.5 + k / 100) for k in (5, 21, 30, 59)],
    "both at once": [("A", day(15), 2.0, 1.0), ("A", day(15), 1.5, None), ("A", day(15), None, 0.25)],
    "before, behind and between bars": [
        ("A", day(0), None, 3.0), ("A", day(0) - timedelta(days=9), 2.0, 1.0),
        ("B", day(40), None, 0.75), ("B", day(300), 4.0, None), ("C", day(6), None, 1.0),
        ("C", day(7), None, 1.5),
    ],
    "unknown symbol, no date": [("X", day(3), 2.0, 1.0), ("A", None, 2.0, 1.0)],
    "nothing told": [("A", day(9), None, None)],
}


@pytest.mark.parametrize("name", CASES)
def test_adjusted_equals_action_by_action(spark, made, name):
    bars = frame(spark, made.sample(frac=1, random_state=2), schemas.BARS)
    actions = spark.createDataFrame(CASES[name], ACTIONS)
    ours = collect(adjust_prices(bars, actions), "symbol", "date")
    wanted = brute([r.asDict() for r in bars.collect()], CASES[name])
    assert len(ours) == len(wanted)
    for a, b in zip(ours, wanted):
        assert a == {k: pytest.approx(v) if isinstance(v, float) else v for k, v in b.items()}


@pytest.mark.parametrize(
    "action", [("A", day(9), 0.0, None), ("A", day(9), -2.0, None), ("A", day(9), None, 1e6), ("A", day(9), None, -1.0)]
)
def test_actions_out_of_range_fail(spark, made, action):
    bars = frame(spark, made, schemas.BARS)
    with pytest.raises(PySparkException, match="out of range"):
        adjust_prices(bars, spark.createDataFrame([action], ACTIONS)).collect()


def test_no_bars(spark):
    bars = spark.createDataFrame([], schemas.BARS)
    actions = spark.createDataFrame(CASES["splits"], ACTIONS)
    assert adjust_prices(bars, actions).count() == 0


def test_returns_run_on_over_a_split(spark, made):
    raw = made[made.symbol == "B"].copy()
    split = raw.copy()
    late = split.date >= day(25)
    for name in ("open", "high", "low", "close"):
        split.loc[late, name] = split.loc[late, name] / 4
    actions = spark.createDataFrame([("B", day(25), 4.0, None)], ACTIONS)
    plain = collect(log_returns(frame(spark, raw, schemas.BARS)), "date")
    ours = collect(log_returns(adjust_prices(frame(spark, split, schemas.BARS), actions)), "date")
    found, wanted = ([r["log_return"] for r in rows[1:]] for rows in (ours, plain))
    assert found == pytest.approx(wanted)
