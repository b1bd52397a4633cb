"""What several operators here share: words, free column names, shared tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from volspark.sinks import materialize

__all__ = ["WORD", "few_at_once", "free_name", "materialize", "one_row", "word_count"]

#: A word: no blank, tab, line feed, vertical tab, form feed or carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words in a text as a long; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def one_row(rows: DataFrame, row: str, by: list[str]) -> DataFrame:
    """One struct ``row`` for every value of ``by``: the greatest by a hash of all its columns.

    Rows that agree in all columns are alike, so whichever is taken, the result is the same.
    """
    order = F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256)
    return rows.groupBy(*by).agg(F.max_by(row, order).alias(row)).select(row)


def few_at_once(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that a worker holds few results at a time."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)
