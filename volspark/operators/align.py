"""Joining a series that all symbols share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volspark.operators.clean import drop_incomplete, unique_dates
from volspark.operators.series import MAX_TASK_ROWS, calendar_span


def attach_series(
    processed: DataFrame,
    side: DataFrame,
    on: str = "date",
    *,
    span_days: int | None = None,
    max_broadcast_rows: int = MAX_TASK_ROWS,
) -> DataFrame:
    """Add the side series by date and drop the rows it does not cover.

    The side has one row per date (a second one fails the job when it runs), so its span in
    days bounds its size. Inside ``max_broadcast_rows`` it is broadcast, which leaves the symbol partitioning of
    the other side as it is; beyond, Spark chooses the join. Without ``span_days``
    the span is read from ``side``.
    """
    span = calendar_span(side, on) if span_days is None else span_days
    side = unique_dates(side, on)
    if span <= max_broadcast_rows:
        side = F.broadcast(side)
    return drop_incomplete(processed.join(side, on, "inner").select(*processed.columns, *[
        c for c in side.columns if c not in processed.columns
    ]))
