"""Daily bars and an index made from the order tables of the test data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volspark.operators.series import WHOLE, SeriesLayout, over_series


def bars_from_lineitem(
    lineitem: DataFrame, symbol: str = "l_returnflag", layout: SeriesLayout = WHOLE
) -> DataFrame:
    """Unit prices of the line items per ship date, one series per value of ``symbol``.

    The aggregate runs by (symbol, day) with partial sums before its shuffle, so a
    symbol with most of the rows costs no more than its days.
    """
    price = F.col("l_extendedprice") / F.col("l_quantity")
    daily = (
        lineitem.select(
            F.col(symbol).cast("string").alias("symbol"),
            F.col("l_shipdate").cast("date").alias("date"),
            price.alias("price"),
            "l_quantity",
        )
        .groupBy("symbol", "date")
        .agg(
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            (F.sum(F.col("price") * F.col("l_quantity")) / F.sum("l_quantity")).alias("close"),
            F.sum("l_quantity").cast("long").alias("volume"),
        )
    )
    opened = over_series(
        daily,
        lambda df, w: df.withColumn("open", F.coalesce(F.lag("close").over(w), F.col("close"))),
        before=1,
        layout=layout,
    )
    return opened.select("symbol", "date", "open", "high", "low", "close", "volume")


def index_from_orders(orders: DataFrame) -> DataFrame:
    """``date, vix``: relative spread of the order totals of a day, in percent."""
    return (
        orders.groupBy(F.col("o_orderdate").cast("date").alias("date"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            (F.stddev_samp("o_totalprice") * 100 / F.avg("o_totalprice")).alias("vix"),
        )
        .filter(F.col("orders") > 1)
        .select("date", "vix")
    )
