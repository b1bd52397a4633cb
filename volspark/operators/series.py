"""Ordered work on series, with a bound on the rows any one task has to hold.

Bars are daily, and ``(symbol, date)`` is a key that ``log_returns`` enforces, so
no series can be longer than the calendar its table covers. While that span is
small every symbol is one window group: one shuffle and one sort serve all
windows. Beyond the span the series are cut into chunks of consecutive rows; each
chunk also receives the few rows before and after it that its frames reach, so
the values are the same and no task holds more than one chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from volspark.sinks import materialize

# About 25 MB of feature rows; as a span of days it is five centuries.
MAX_TASK_ROWS = 200_000


@dataclass(frozen=True)
class SeriesLayout:
    """``chunk_rows`` None keeps each series whole; a number cuts it."""

    chunk_rows: int | None = None


WHOLE = SeriesLayout()


def calendar_span(df: DataFrame, day: str = "date") -> int:
    """Days from the first to the last date: a bound on the length of any daily series."""
    low, high = df.agg(
        F.min(day).cast("date").alias("low"), F.max(day).cast("date").alias("high")
    ).first()
    return 0 if low is None else (high - low).days + 1


def choose_layout(
    df: DataFrame | None = None,
    day: str = "date",
    *,
    start: str | None = None,
    end: str | None = None,
    max_rows: int = MAX_TASK_ROWS,
) -> SeriesLayout:
    """Whole series where the calendar proves them short, else chunks of ``max_rows``.

    With both ``start`` and ``end`` the proof costs nothing; otherwise it is one
    min/max over the date column.
    """
    if start and end:
        span = (date.fromisoformat(end) - date.fromisoformat(start)).days + 1
    elif df is not None:
        span = calendar_span(df, day)
    else:
        raise ValueError("give a table, or both start and end")
    return WHOLE if span <= max_rows else SeriesLayout(max_rows)


def number_rows(
    df: DataFrame,
    layout: SeriesLayout = WHOLE,
    keys: Sequence[str] = ("symbol",),
    *,
    position: str = "row_idx",
    length: str | None = "n",
) -> DataFrame:
    """Add the 0-based position in date order and, unless ``length`` is None, the row count."""
    keys = list(keys)
    if layout.chunk_rows is None:
        whole = Window.partitionBy(*keys)
        df = df.withColumn(position, F.row_number().over(whole.orderBy("date")).cast("long") - 1)
        return df.withColumn(length, F.count(F.lit(1)).over(whole)) if length else df

    # A block of days holds at most that many rows. The block counts are a small
    # table; their running sum is where each block starts in its series. The rows are
    # read twice, so they are stored first: else each step would run those before twice.
    blocked = materialize(df, "series").withColumn(
        "_block", F.floor(F.unix_date("date") / F.lit(float(layout.chunk_rows)))
    )
    per_series = Window.partitionBy(*keys)
    earlier = per_series.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocked.groupBy(*keys, "_block")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    )
    if length:
        starts = starts.withColumn(length, F.sum("_rows").over(per_series))
    in_block = Window.partitionBy(*keys, "_block").orderBy("date")
    return (
        blocked.join(starts.drop("_rows"), [*keys, "_block"])
        .withColumn(position, F.col("_first") + F.row_number().over(in_block) - 1)
        .drop("_block", "_first")
    )


def over_series(
    df: DataFrame,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    *,
    before: int = 0,
    after: int = 0,
    layout: SeriesLayout = WHOLE,
    keys: Sequence[str] = ("symbol",),
) -> DataFrame:
    """Run window expressions that reach ``before`` rows back and ``after`` ahead.

    ``compute`` gets a frame and the window to use. It may add columns but must
    keep every row: rows near a chunk border are there as neighbours only.
    """
    keys = list(keys)
    if layout.chunk_rows is None:
        return compute(df, Window.partitionBy(*keys).orderBy("date"))

    size = layout.chunk_rows
    if max(before, after) > size:
        raise ValueError(f"chunks of {size} rows are shorter than a frame")
    home, offset = F.col("_home"), F.col("_position") - F.col("_home") * size
    chunks = F.array(
        home,
        F.when(offset >= size - before, home + 1),
        F.when(offset < after, home - 1),
    )
    chunked = (
        number_rows(df, layout, keys, position="_position", length=None)
        .withColumn("_home", F.floor(F.col("_position") / F.lit(float(size))))
        .withColumn("_chunk", F.explode(F.array_compact(chunks)))
    )
    done = compute(chunked, Window.partitionBy(*keys, "_chunk").orderBy("date"))
    return done.filter(F.col("_chunk") == home).drop("_position", "_home", "_chunk")


def add_series_value(
    df: DataFrame,
    name: str,
    aggregate: Column,
    layout: SeriesLayout = WHOLE,
    keys: Sequence[str] = ("symbol",),
) -> DataFrame:
    """Add an aggregate over the whole series to each of its rows."""
    keys = list(keys)
    if layout.chunk_rows is None:
        return df.withColumn(name, aggregate.over(Window.partitionBy(*keys)))
    return df.join(df.groupBy(*keys).agg(aggregate.alias(name)), keys)
