"""Prices adjusted for splits and dividends, from raw bars and a table of actions.

An action changes what earlier prices are worth in shares of today: every bar before its
ex-date is multiplied by the action's factor, so a bar's own factor is the product over all
later ex-dates. Factors are worked out per symbol on the actions alone, which are few; bars
find theirs by the number of ex-dates up to their day. No window runs over the bars, and the
last price before an ex-date is a partial aggregate, so a series may be of any length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PRICES = ("open", "high", "low", "close")


def _ex_dates(actions: DataFrame) -> DataFrame:
    """One row per symbol and ex-date: product of splits, sum of dividends, number in order."""
    by_date = (
        actions.filter(F.col("date").isNotNull())
        .groupBy("symbol", "date")
        .agg(
            F.coalesce(F.product("split"), F.lit(1.0)).alias("split"),
            F.coalesce(F.sum("dividend"), F.lit(0.0)).alias("dividend"),
        )
    )
    in_order = Window.partitionBy("symbol").orderBy("date")
    return by_date.withColumn("number", F.row_number().over(in_order) - 1)


def _passed(dates: Column, day: str) -> Column:
    """How many of the sorted ``dates`` are at or before the day, by halving steps."""
    size = F.coalesce(F.size(dates), F.lit(0))
    steps = F.array(*[F.lit(1 << k) for k in range(30, -1, -1)])
    return F.aggregate(
        F.filter(steps, lambda step: step <= size),
        F.lit(0),
        lambda found, step: F.when(
            F.get(dates, found + step - 1) <= F.col(day), found + step
        ).otherwise(found),
    )


def adjustment_factors(bars: DataFrame, actions: DataFrame) -> DataFrame:
    """(symbol, dates, prices, shares) of every symbol with actions: its ex-dates in order, and
    what prices and numbers of shares before each of them are multiplied by.

    ``actions`` has symbol, date, split (new shares for an old one) and dividend (per new
    share), either NULL. A split multiplies earlier prices by 1 / split, a dividend by
    1 - dividend / price, for the last price before the ex-date in new shares; before any
    bar, it changes nothing. A split that is not positive, or a dividend not below the price,
    fails the job when it runs.
    """
    ex = _ex_dates(actions)
    dates = ex.groupBy("symbol").agg(F.array_sort(F.collect_list("date")).alias("dates"))
    closes = (
        bars.filter(F.col("close").isNotNull())
        .join(dates, "symbol")
        .withColumn("number", _passed(F.col("dates"), "date"))
        .groupBy("symbol", "number")
        .agg(F.max_by("close", "date").alias("close"))
    )
    # an ex-date without a bar since the one before it looks further back
    before = Window.partitionBy("symbol").orderBy("number")
    priced = ex.join(closes, ["symbol", "number"], "left").withColumn(
        "close", F.last("close", ignorenulls=True).over(before)
    )
    kept = F.when(F.col("dividend") == 0, F.lit(1.0)).otherwise(
        F.coalesce(1 - F.col("dividend") * F.col("split") / F.col("close"), F.lit(1.0))
    )
    clash = F.raise_error(
        F.concat(F.lit("split or dividend out of range: "), "symbol", F.lit(" "), "date")
    )
    sound = (F.col("split") > 0) & (kept > 0) & F.col("dividend").between(0, 1e300)
    priced = priced.withColumn("price", F.when(sound, kept / F.col("split")).otherwise(clash))
    later = Window.partitionBy("symbol").orderBy(F.col("number").desc())
    parts = F.struct(
        "number",
        "date",
        F.product("price").over(later).alias("price"),
        F.product("split").over(later).alias("share"),
    )
    factors = priced.withColumn("part", parts).groupBy("symbol")
    return factors.agg(F.array_sort(F.collect_list("part")).alias("parts")).select(
        "symbol",
        F.col("parts.date").alias("dates"),
        F.col("parts.price").alias("prices"),
        F.col("parts.share").alias("shares"),
    )


def adjust_prices(bars: DataFrame, actions: DataFrame) -> DataFrame:
    """``bars`` with prices, and volume in shares, as they compare to the last bar's.

    Bars on an ex-date or after it are not changed by it; symbols without actions stay as
    they are. Volumes are rounded to whole shares.
    """
    factors = adjustment_factors(bars, actions)
    place = _passed(F.col("dates"), "date")
    joined = bars.join(factors, "symbol", "left").withColumn("place_", place)
    price = F.coalesce(F.get("prices", F.col("place_")), F.lit(1.0))
    share = F.coalesce(F.get("shares", F.col("place_")), F.lit(1.0))
    changed = {name: F.col(name) * price for name in PRICES if name in bars.columns}
    if "volume" in bars.columns:
        changed["volume"] = F.round(F.col("volume") * share).cast("long")
    return joined.select(*[changed[c].alias(c) if c in changed else c for c in bars.columns])
