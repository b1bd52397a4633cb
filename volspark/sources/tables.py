"""Reading what the pipeline wrote, and the per-symbol CSV files of others."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from volspark.operators.clean import nan_to_null
from volspark.operators.features import add_features
from volspark.operators.reports import importances
from volspark.operators.series import WHOLE, SeriesLayout
from volspark.schemas import BARS, MODELS, PREDICTIONS, PROCESSED, PROCESSED_CSV, RESULTS_CSV
from volspark.sinks import bucket_of, write_exchange

HEADER_LINES = 3


def _of_symbol(df: DataFrame, symbol: str | None) -> DataFrame:
    """Rows of one symbol; of a table in buckets only its bucket is read."""
    if not symbol:
        return df
    if "bucket" in df.columns:
        df = df.filter(F.col("bucket") == bucket_of(F.lit(symbol)))
    return df.filter(F.col("symbol") == symbol)


def _read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    suffix: str,
    header_lines: int,
    symbol: str | None,
) -> DataFrame:
    """Files named ``{symbol}{suffix}``, or the one of ``symbol``; headers have no date.

    A file whose number of dateless lines is not ``header_lines`` fails the job when it
    runs, so a bad data row cannot pass as a header. Nothing runs before.
    """
    if symbol:
        escaped = re.sub(r"([\\*?\[\]{},])", r"\\\1", symbol)
        files = f"{escaped}{suffix}"
    else:
        files = f"*{suffix}"
    raw = (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("pathGlobFilter", files)
        .csv(path)
        .withColumn("file", F.col("_metadata.file_name"))
    )
    headers = F.count_if(F.col("date").isNull())
    clash = F.raise_error(
        F.concat(
            F.lit(f"expected {header_lines} lines without a date per file, found "),
            F.col("file"),
            F.lit(": "),
            headers.cast("string"),
        )
    )
    counts = raw.groupBy("file").agg(
        F.when(headers != header_lines, clash).otherwise(headers).alias("headers")
    )
    name = F.regexp_extract(F.url_decode("file"), r"^(.*)" + suffix.replace(".", r"\.") + "$", 1)
    # every file has its row of counts, so the join only checks
    rows = raw.filter(F.col("date").isNotNull()).join(counts, "file")
    rows = rows.filter(F.col("headers") == header_lines).withColumn("symbol", name)
    return nan_to_null(rows.select("symbol", *schema.names))


def read_processed(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    symbol: str | None = None,
    header_lines: int = HEADER_LINES,
) -> DataFrame:
    """Bars with returns, volatility and index: the table, or the CSV files in a folder."""
    if fmt == "csv":
        suffix = "_processed.csv"
        df = _read_csv(spark, path, PROCESSED_CSV, suffix, header_lines, symbol)
    else:
        df = spark.read.schema(PROCESSED).format(fmt).load(path)
    return _of_symbol(df, symbol).select(*PROCESSED.names)


def load_featured(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    symbol: str | None = None,
    layout: SeriesLayout = WHOLE,
    header_lines: int = HEADER_LINES,
) -> DataFrame:
    """The processed table with its features."""
    processed = read_processed(spark, path, fmt, symbol, header_lines)
    return add_features(processed, layout=layout)


def read_results(
    spark: SparkSession, path: str, fmt: str = "parquet", symbol: str | None = None
) -> DataFrame:
    """Backtest predictions; a ``symbol`` prunes to its bucket."""
    if fmt == "csv":
        return _read_csv(spark, path, RESULTS_CSV, "_backtest_results.csv", 1, symbol)
    df = spark.read.schema(PREDICTIONS).format(fmt).load(path)
    return _of_symbol(df, symbol).select(*PREDICTIONS.names)


def read_models(spark: SparkSession, path: str, symbol: str | None = None) -> DataFrame:
    return _of_symbol(spark.read.schema(MODELS).parquet(path), symbol).select(*MODELS.names)


def read_importances(spark: SparkSession, path: str, symbol: str | None = None) -> DataFrame:
    """Feature importances of the stored models, ascending."""
    return importances(read_models(spark, path, symbol))


def write_processed_csv(processed: DataFrame, folder: str) -> str:
    """The exchange files ``{symbol}_processed.csv``, with their three header lines."""
    names = PROCESSED_CSV.names
    others = "," * (len(names) - 1)
    titles = [c.capitalize() if c in BARS.names else c for c in names[1:]]
    header = [",".join(["Price", *titles]), "Ticker" + ",{symbol}" + others[1:], "Date" + others]
    return write_exchange(processed.select("symbol", *names), folder, "_processed.csv", header)


def write_results_csv(results: DataFrame, folder: str) -> str:
    """The exchange files ``{symbol}_backtest_results.csv``, with one header line."""
    names = RESULTS_CSV.names
    header = [",".join(["", *names[1:]])]
    return write_exchange(
        results.select("symbol", *names), folder, "_backtest_results.csv", header
    )
