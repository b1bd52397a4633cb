"""Fitting many short series at once: one grouped Spark job over series and refits."""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from volspark.learners.boosting import BoostParams
from volspark.learners.boosting import fit as fit_boosted
from volspark.operators.folds import WalkForward, series_lengths
from volspark.schemas import FITS, TARGET

# What the tasks run travels with the job, so executors need not have this package.
for _module in (__name__, fit_boosted.__module__):
    cloudpickle.register_pickle_by_value(sys.modules[_module])

# Rows times fits of one series that a task takes on alone: some ten seconds of work.
# A decade of days is far below, so a wide panel is shuffled once, without copies.
LANE_ROWS = 200_000


FITTERS: dict[str, Callable] = {"boosted": fit_boosted}


def _fit_lane(columns: list[str], params: BoostParams, fit: Callable, out: pa.Schema):
    """The function run on the rows of one series and lane."""
    scored_type = out.field("predictions").type.value_type

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("row_idx")
        whole = {name: table.column(name).to_numpy() for name in ("row_idx", "segment", TARGET)}
        x = np.column_stack([table.column(c).to_numpy() for c in columns])
        lane, lanes = table.column("lane")[0].as_py(), table.column("lanes")[0].as_py()
        refit_of = table.column("refit_id").fill_null(-1).to_numpy()
        done = []
        for refit in np.unique(refit_of[refit_of >= 0]):
            if refit % lanes != lane:
                continue
            trained = np.flatnonzero(whole["segment"] <= refit)
            scored = np.flatnonzero(refit_of == refit)
            model, values = None, pa.nulls(len(scored), pa.float64())
            if len(trained):
                inputs = x[trained], whole[TARGET][trained], whole["row_idx"][trained]
                model = fit(*inputs, columns, params)
                values = pa.array(model.predict(x[scored]), pa.float64())
            rows = table.take(scored)
            parts = {
                "date": rows.column("date").combine_chunks(),
                "row_idx": rows.column("row_idx").combine_chunks(),
                "fold_id": rows.column("fold_id").combine_chunks(),
                "actual": rows.column(TARGET).combine_chunks(),
                "predicted": values,
            }
            structs = pa.StructArray.from_arrays(
                [parts[f.name].cast(f.type) for f in scored_type], fields=list(scored_type)
            )
            done.append(
                {
                    "symbol": table.column("symbol")[0].as_py(),
                    "refit_id": int(refit),
                    "train_cut": rows.column("train_cut")[0].as_py(),
                    "n_train": len(trained),
                    "model": model and model.to_json(),
                    "importances": list(model.importances().items()) if model else None,
                    "predictions": structs,
                }
            )
        arrays = []
        for field in out:
            values = [one[field.name] for one in done]
            if field.name == "predictions":
                offsets = np.cumsum([0, *map(len, values)])
                flat = pa.concat_arrays(values) if values else pa.array([], scored_type)
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)
                arrays.append(lists.cast(field.type))
            else:
                arrays.append(pa.array(values, field.type))
        return pa.Table.from_arrays(arrays, schema=out)

    return run


def busy_tasks(spark: SparkSession) -> int:
    """Enough tasks to keep every core at work to the end."""
    return 4 * spark.sparkContext.defaultParallelism


def balanced_lane_rows(features: DataFrame, plan: WalkForward) -> int:
    """``lane_rows`` that keep all cores at work where a panel has few series.

    Counts the rows of each series, so ``features`` should be a stored table.
    """
    n = F.col("n")
    total = series_lengths(features).agg(F.sum(plan.refit_count(n) * n)).first()[0] or 0
    return min(LANE_ROWS, max(1, total // busy_tasks(features.sparkSession)))


def fit_grouped(
    rows: DataFrame,
    columns: list[str],
    params: BoostParams = BoostParams(),
    learner: str = "boosted",
    lane_rows: int = LANE_ROWS,
) -> DataFrame:
    """One row per (symbol, refit): the model, its importances and the rows it scored.

    ``rows`` comes from ``walk_forward_rows`` or ``holdout_rows``, of series short enough
    for a task (``walk_forward`` and ``holdout`` see to that). A series whose fits add up
    to much work is copied to several lanes, each with a share of its refits; fits
    outweigh the copies by far.
    """
    spark = rows.sparkSession
    work = F.col("refits") * F.col("n") / F.lit(float(lane_rows))
    lanes = F.greatest(F.lit(1), F.least(F.col("refits"), F.ceil(work))).cast("int")
    needed = ["symbol", "date", "row_idx", "segment", "fold_id", "refit_id", "train_cut"]
    laned = rows.select(*needed, TARGET, *columns, lanes.alias("lanes")).withColumn(
        "lane", F.explode(F.sequence(F.lit(0), F.col("lanes") - 1))
    )
    # The rows are few but the work on them is not: keep the tasks apart, whatever
    # their size in bytes.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), busy_tasks(spark))
    out = to_arrow_schema(FITS)
    run = _fit_lane(list(columns), params, FITTERS[learner], out)
    return (
        laned.repartition(tasks, "symbol", "lane").groupBy("symbol", "lane").applyInArrow(run, FITS)
    )
