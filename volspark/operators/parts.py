"""Metrics and volatility regimes from the states of date parts, which merge.

A state says of one symbol and part (a month, say) all that the parts beside it need. States
of neighbours merge into the state of both, in any grouping, so a series of any length is
never put in order as a whole: rows are ordered within parts, and merging orders parts within
coarser parts. Stored states answer for any range of dates; only the parts it cuts are read as
rows again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from volspark.functions import change_sign
from volspark.operators.metrics import in_date_range
from volspark.operators.reports import HIGH_VOL, LOW_VOL, regime_flags
from volspark.sinks import materialize

#: Months in a part, by its name.
MONTHS = {"month": 1, "quarter": 3, "year": 12}
#: The part that holds all dates.
ALL = "all"

#: Values and pairs of values whose moments a state keeps.
SIDES = {"a": "actual", "p": "predicted"}


def part_of(unit: str, day: str = "date") -> Column:
    """First day of the part a date lies in; one day for all dates of the part ALL."""
    if unit == ALL:
        return F.lit("0001-01-01").cast("date")
    return F.trunc(F.col(day), unit)


def _pair(value: str) -> Column:
    """A value where both sides have one."""
    return F.when(F.col("actual").isNotNull() & F.col("predicted").isNotNull(), F.col(value))


def metric_states(predictions: DataFrame, unit: str = "month") -> DataFrame:
    """The state of each symbol and part of its scored rows.

    Counts, error sums, moments about the mean, steps within the part and how many of them
    agree, and the first and last row, for the steps between parts.
    """
    rows = predictions.select("symbol", "date", "actual", "predicted", part_of(unit).alias("part"))
    w = Window.partitionBy("symbol", "part").orderBy("date")
    same = change_sign("actual", w) == change_sign("predicted", w)
    error = F.col("actual") - F.col("predicted")
    sums = [
        F.count("predicted").alias("n"),
        F.count(error).alias("errors"),
        F.sum(F.abs(error)).alias("abs_sum"),
        F.sum(error * error).alias("square_sum"),
        F.count("same").alias("steps"),
        F.count_if("same").alias("hits"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    ]
    for k, side in SIDES.items():
        sums += [
            F.count(side).alias(f"n_{k}"),
            F.avg(side).alias(f"mean_{k}"),
            (F.var_pop(side) * F.count(side)).alias(f"spread_{k}"),
            F.avg(_pair(side)).alias(f"pair_mean_{k}"),
            F.min_by(side, "date").alias(f"first_{k}"),
            F.max_by(side, "date").alias(f"last_{k}"),
        ]
    pairs = F.count(_pair("actual"))
    sums += [pairs.alias("pairs"), (F.covar_pop("actual", "predicted") * pairs).alias("joint")]
    return rows.withColumn("same", same).groupBy("symbol", "part").agg(*sums)


def merge_metric_states(states: DataFrame, unit: str = ALL) -> DataFrame:
    """The states of coarser parts, from those of parts that lie whole within them."""
    coarse = states.withColumn("part", part_of(unit, "first_date"))
    together = Window.partitionBy("symbol", "part")
    in_order = together.orderBy("first_date")
    # the step from one part to the next
    signs = [
        F.signum(F.col(f"first_{k}") - F.lag(f"last_{k}").over(in_order)) for k in SIDES
    ]
    coarse = coarse.withColumn("border", signs[0] == signs[1])

    def mean(weight: str, value: str) -> Column:
        total = F.sum(F.col(weight) * F.col(value)).over(together)
        return F.try_divide(total, F.sum(weight).over(together))

    wanted = {f"all_mean_{k}": mean(f"n_{k}", f"mean_{k}") for k in SIDES}
    wanted |= {f"all_pair_{k}": mean("pairs", f"pair_mean_{k}") for k in SIDES}
    coarse = coarse.withColumns(wanted)
    sums = [F.sum(c).alias(c) for c in ("n", "errors", "abs_sum", "square_sum")]
    sums += [
        (F.sum("steps") + F.count("border")).alias("steps"),
        (F.sum("hits") + F.count_if("border")).alias("hits"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
    ]
    for k in SIDES:
        off = F.col(f"mean_{k}") - F.col(f"all_mean_{k}")
        sums += [
            F.sum(f"n_{k}").alias(f"n_{k}"),
            F.max(f"all_mean_{k}").alias(f"mean_{k}"),
            F.sum(F.col(f"spread_{k}") + F.col(f"n_{k}") * off * off).alias(f"spread_{k}"),
            F.max(f"all_pair_{k}").alias(f"pair_mean_{k}"),
            F.min_by(f"first_{k}", "first_date").alias(f"first_{k}"),
            F.max_by(f"last_{k}", "first_date").alias(f"last_{k}"),
        ]
    off_a, off_p = (F.col(f"pair_mean_{k}") - F.col(f"all_pair_{k}") for k in SIDES)
    joint = F.sum(F.col("joint") + F.col("pairs") * off_a * off_p)
    sums += [F.sum("pairs").alias("pairs"), joint.alias("joint")]
    return coarse.groupBy("symbol", "part").agg(*sums).select(*states.columns)


def metrics_of(states: DataFrame) -> DataFrame:
    """What ``evaluate`` gives, from one state per symbol."""
    deviations = F.sqrt(F.try_divide("spread_a", "n_a")) * F.sqrt(F.try_divide("spread_p", "n_p"))
    return states.select(
        "symbol",
        "n",
        F.try_divide("abs_sum", "errors").alias("mae"),
        F.sqrt(F.try_divide("square_sum", "errors")).alias("rmse"),
        F.try_divide("hits", "steps").alias("directional_accuracy"),
        F.try_divide(F.try_divide("joint", "pairs"), deviations).alias("correlation"),
    )


def _whole_parts(df: DataFrame, unit: str, start: str | None, end: str | None) -> DataFrame:
    """Rows of a table of parts that the range holds whole."""
    if start:
        df = df.filter(F.col("part") >= F.lit(start).cast("date"))
    if end:
        after = F.add_months("part", MONTHS[unit])
        df = df.filter(after <= F.date_add(F.lit(end).cast("date"), 1))
    return df


def _cut_parts(rows: DataFrame, unit: str, start: str | None, end: str | None) -> DataFrame:
    """Rows in range, of the parts that its ends cut. The dates are bounds a scan can use."""
    kept = in_date_range(rows, start, end)
    part, after = part_of(unit), F.add_months(part_of(unit), MONTHS[unit])
    cut = F.lit(False)
    if start:
        first = F.lit(start).cast("date")
        cut |= (F.col("date") < F.add_months(F.trunc(first, unit), MONTHS[unit])) & (part < first)
    if end:
        last = F.lit(end).cast("date")
        cut |= (F.col("date") >= F.trunc(last, unit)) & (after > F.date_add(last, 1))
    return kept.filter(cut)


def metrics_in_range(
    states: DataFrame,
    predictions: DataFrame,
    start: str | None = None,
    end: str | None = None,
    unit: str = "month",
) -> DataFrame:
    """What ``evaluate`` gives for a range of dates, from the ``states`` of parts.

    ``predictions`` is read for the parts that the range cuts only.
    """
    edges = metric_states(_cut_parts(predictions, unit, start, end), unit)
    inside = _whole_parts(states, unit, start, end)
    return metrics_of(merge_metric_states(inside.unionByName(edges)))


@dataclass
class RunStates:
    """Parts, and the intervals of each regime in them.

    An interval without ``end_date`` goes on at the part's last row, one with ``from_first``
    begins at its first; all others are as they will stay.
    """

    parts: DataFrame
    runs: DataFrame

    def union(self, other: RunStates) -> RunStates:
        return RunStates(self.parts.unionByName(other.parts), self.runs.unionByName(other.runs))


def run_states(
    predictions: DataFrame, high: float = HIGH_VOL, low: float = LOW_VOL, unit: str = "month"
) -> RunStates:
    """The state of each symbol and part of its scored rows.

    The rows are read once: those where a regime turns and those at the edges of a part are
    stored in the shared folder, and both tables come from them.
    """
    rows = predictions.select("symbol", "date", "actual", part_of(unit).alias("part"))
    w = Window.partitionBy("symbol", "part").orderBy("date")
    placed = regime_flags(rows, high, low).withColumns(
        {
            "place": F.row_number().over(w).cast("long"),
            "size": F.count(F.lit(1)).over(Window.partitionBy("symbol", "part")),
            "was_high": F.coalesce(F.lag("is_high").over(w), F.lit(False)),
            "was_low": F.coalesce(F.lag("is_low").over(w), F.lit(False)),
        }
    )
    turned = (F.col("is_high") != F.col("was_high")) | (F.col("is_low") != F.col("was_low"))
    at_edge = (F.col("place") == 1) | (F.col("place") == F.col("size"))
    placed = materialize(placed.filter(turned | at_edge).drop("actual"), "turns")
    parts = placed.groupBy("symbol", "part").agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )
    both = [
        F.struct(F.lit(k).alias("regime"), F.col(f"is_{k}").alias("inside"), F.col(f"was_{k}").alias("was"))
        for k in ("high", "low")
    ]
    turns = placed.select(
        "symbol", "part", "date", "place", "size", F.inline(F.array(*both))
    ).filter("inside != was")
    each = Window.partitionBy("symbol", "part", "regime").orderBy("date")
    runs = turns.withColumns(
        {"end_date": F.lead("date").over(each), "until": F.lead("place").over(each)}
    ).filter("inside")
    return RunStates(
        parts,
        runs.select(
            "symbol",
            "part",
            "regime",
            F.col("date").alias("start_date"),
            "end_date",
            (F.coalesce("until", F.col("size") + 1) - F.col("place")).alias("n_rows"),
            (F.col("place") == 1).alias("from_first"),
        ),
    )


def merge_run_states(states: RunStates, unit: str = ALL) -> RunStates:
    """The states of coarser parts. Only intervals at the edge of a part are put in order."""
    coarse = part_of(unit, "first_date")
    together = Window.partitionBy("symbol", "coarse").orderBy("first_date")
    parts = states.parts.withColumn("coarse", coarse)
    parts = parts.withColumn("after", F.lead("first_date").over(together))
    parts = parts.withColumn("begins", F.lag("first_date").over(together).isNull())
    runs = states.runs.join(
        parts.select("symbol", "part", "coarse", "after", "begins"), ["symbol", "part"]
    )
    columns = ["symbol", "part", "regime", "start_date", "end_date", "n_rows", "from_first"]
    edge = F.col("from_first") | F.col("end_date").isNull()
    settled = runs.filter(~edge).withColumn("part", F.col("coarse")).select(*columns)

    each = Window.partitionBy("symbol", "coarse", "regime").orderBy("start_date")
    # an open interval goes on in the next part if that begins with one
    goes_on = F.col("from_first") & F.coalesce(
        F.lag("end_date").over(each).isNull() & (F.lag("after").over(each) == F.col("start_date")),
        F.lit(False),
    )
    chained = runs.filter(edge).withColumn("chain", F.sum((~goes_on).cast("int")).over(each))
    last = F.struct("start_date", "end_date", "after")
    merged = chained.groupBy("symbol", F.col("coarse").alias("part"), "regime", "chain").agg(
        F.min("start_date").alias("start"),
        F.max_by(last, "start_date").alias("last"),
        F.sum("n_rows").alias("n_rows"),
        F.min_by(F.col("from_first") & F.col("begins"), "start_date").alias("from_first"),
    )
    # where no interval follows on, the first row of the next part is out
    end = F.coalesce(F.col("last.end_date"), F.col("last.after"))
    merged = merged.withColumns({"start_date": F.col("start"), "end_date": end}).select(*columns)
    whole = parts.groupBy("symbol", F.col("coarse").alias("part")).agg(
        F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date")
    )
    return RunStates(whole, settled.unionByName(merged))


def regimes_of(states: RunStates) -> DataFrame:
    """What ``regimes`` gives, from one state per symbol."""
    ends = states.parts.select("symbol", "last_date")
    return states.runs.join(ends, "symbol").select(
        "symbol",
        "regime",
        "start_date",
        F.coalesce("end_date", "last_date").alias("end_date"),
        "n_rows",
    )


def regimes_in_range(
    states: RunStates,
    predictions: DataFrame,
    start: str | None = None,
    end: str | None = None,
    high: float = HIGH_VOL,
    low: float = LOW_VOL,
    unit: str = "month",
    through: Sequence[str] = ("year",),
) -> DataFrame:
    """What ``regimes`` gives for a range of dates, from ``states`` of the same thresholds.

    ``predictions`` is read for the parts that the range cuts only; parts merge by way of
    the coarser ones in ``through``, which are stored: each step reads the one before
    several times.
    """
    merged = RunStates(
        _whole_parts(states.parts, unit, start, end), _whole_parts(states.runs, unit, start, end)
    )
    if start or end:
        cut = _cut_parts(predictions, unit, start, end)
        merged = merged.union(run_states(cut, high, low, unit))
    for coarser in through:
        merged = merge_run_states(merged, coarser)
        merged = RunStates(
            materialize(merged.parts, "parts"), materialize(merged.runs, "runs")
        )
    return regimes_of(merge_run_states(merged, ALL))
