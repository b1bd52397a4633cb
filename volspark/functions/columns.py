"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

import math

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from volspark.schemas import SYMBOL_LABELS

PERIODS_PER_YEAR = 252


def _rolling(agg, name: str, rows: int, w: WindowSpec) -> Column:
    """``agg`` over the trailing ``rows`` rows; NULL until all of them hold a value."""
    frame = w.rowsBetween(1 - rows, 0)
    return F.when(F.count(name).over(frame) == rows, agg(name).over(frame))


def rolling_std(name: str, rows: int, w: WindowSpec) -> Column:
    """Sample standard deviation over a full trailing window."""
    return _rolling(F.stddev_samp, name, rows, w)


def rolling_mean(name: str, rows: int, w: WindowSpec) -> Column:
    """Mean over a full trailing window."""
    return _rolling(F.avg, name, rows, w)


def annualize(c: Column, periods_per_year: int = PERIODS_PER_YEAR) -> Column:
    return c * F.lit(math.sqrt(periods_per_year))


def change_sign(name: str, w: WindowSpec) -> Column:
    """Sign of the step from the previous row; NULL on the first row."""
    return F.signum(F.col(name) - F.lag(name).over(w))


def truncated_share(n: Column, share: float) -> Column:
    """Whole rows in a share of ``n``, in double arithmetic, cut towards zero."""
    return F.floor(n.cast("double") * F.lit(float(share))).cast("long")


def decimals_text(c: Column) -> Column:
    return F.format_string("%.4f", c)


def percent_text(c: Column) -> Column:
    return F.format_string("%.2f%%", c * 100)


def symbol_label(symbol: Column, labels: dict[str, str] | None = None) -> Column:
    """Display name of a symbol; the symbol itself where none is known."""
    pairs = SYMBOL_LABELS if labels is None else labels
    if not pairs:
        return symbol
    lookup = F.create_map(*[F.lit(text) for pair in pairs.items() for text in pair])
    return F.coalesce(F.try_element_at(lookup, symbol), symbol)
