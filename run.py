"""The whole run as a job: spark-submit run.py --bars /data/bars --out /data/run"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from volspark import run_pipeline, schemas
from volspark.learners.baseline import BASELINES
from volspark.learners.grouped import FITTERS
from volspark.sources import read_bars, read_implied_vol


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--bars", required=True, help="table of daily bars")
    parser.add_argument("--index", help="table of bars with the index; by default that of --bars")
    parser.add_argument("--out", required=True, help="folder for the tables of the run")
    parser.add_argument("--format", default="parquet", help="format of the bars")
    parser.add_argument("--symbols", nargs="*", default=list(schemas.SYMBOLS))
    parser.add_argument("--all-symbols", action="store_true", help="every symbol but the index")
    parser.add_argument("--index-symbol", default=schemas.VIX_SYMBOL)
    parser.add_argument("--start", default=schemas.START)
    parser.add_argument("--end", default=schemas.END, help="first day not included")
    parser.add_argument("--learner", default="boosted", choices=[*FITTERS, *BASELINES])
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict[str, str]:
    given = arguments(argv)
    spark = spark or SparkSession.builder.appName("volspark").getOrCreate()
    symbols = None if given.all_symbols else given.symbols
    period = {"start": given.start, "end": given.end}
    bars = read_bars(spark, given.bars, given.format, symbols, **period)
    bars = bars.filter(bars.symbol != given.index_symbol)
    index = read_implied_vol(
        spark, given.index or given.bars, given.format, symbol=given.index_symbol, **period
    )
    paths = run_pipeline(
        spark, bars, index, given.out, symbols, learner=given.learner, **period
    )
    spark.read.parquet(paths["report_metrics"]).drop("bucket").orderBy("symbol").show(truncate=False)
    return paths


if __name__ == "__main__":
    main()
