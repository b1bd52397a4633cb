"""Walk-forward folds in closed form.

A loop that scores ``step`` rows at a time and refits every ``retrain_every`` rows
visits positions that follow from the series length alone, so the folds are
columns computed from ``row_idx`` and ``n``, not loop state.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from volspark.functions import truncated_share


@dataclass(frozen=True)
class WalkForward:
    """First training share, rows scored per fold, rows between refits.

    ``embargo`` keeps that many rows before each cut out of training: their targets
    are realized after the cut. ``score_tail`` also scores the last, partial fold.
    """

    initial_train_size: float = 0.6
    step_size: int = 21
    retrain_every: int = 63
    embargo: int = 0
    score_tail: bool = False

    @property
    def folds_per_refit(self) -> int:
        return max(1, math.ceil(self.retrain_every / self.step_size))

    @property
    def refit_rows(self) -> int:
        return self.folds_per_refit * self.step_size

    def first_cut(self, n: Column) -> Column:
        return truncated_share(n, self.initial_train_size)

    def fold_count(self, n: Column) -> Column:
        # A fold runs only while more than one whole step is left; with the tail, any row.
        spare = 0 if self.score_tail else self.step_size
        left = (n - spare - self.first_cut(n)).cast("double")
        return F.greatest(F.lit(0), F.ceil(left / F.lit(float(self.step_size)))).cast("long")

    def refit_count(self, n: Column) -> Column:
        folds = self.fold_count(n).cast("double")
        return F.ceil(folds / F.lit(float(self.folds_per_refit))).cast("long")

    def fold_of(self, row_idx: Column, n: Column) -> Column:
        past = (row_idx - self.first_cut(n)).cast("double")
        return F.floor(past / F.lit(float(self.step_size))).cast("int")

    def refit_of(self, fold: Column) -> Column:
        return F.floor(fold.cast("double") / F.lit(float(self.folds_per_refit))).cast("int")

    def cut_of(self, refit: Column, n: Column) -> Column:
        return self.first_cut(n) + refit.cast("long") * self.refit_rows

    def training_segment(self, row_idx: Column, n: Column) -> Column:
        """The first refit whose training set holds the row; refit g trains on segments <= g."""
        past = (row_idx + self.embargo - self.first_cut(n)).cast("double")
        return F.greatest(
            F.lit(0), F.floor(past / F.lit(float(self.refit_rows))) + 1
        ).cast("int")


def series_lengths(df: DataFrame) -> DataFrame:
    return df.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


def fold_plan(df: DataFrame, plan: WalkForward = WalkForward()) -> DataFrame:
    """One row per fold: what it scores and which refit, trained below ``train_cut``, it uses."""
    n, fold = F.col("n"), F.col("fold_id")
    folds = plan.fold_count(n)
    # sequence(0, -1) would count down, so series without a fold leave first.
    listed = (
        series_lengths(df)
        .filter(folds > 0)
        .select("symbol", "n", F.explode(F.sequence(F.lit(0).cast("long"), folds - 1)).alias("k"))
        .withColumn("fold_id", F.col("k").cast("int"))
        .withColumn("refit_id", plan.refit_of(fold))
        .withColumn("score_from", plan.first_cut(n) + F.col("k") * plan.step_size)
    )
    return listed.select(
        "symbol",
        "fold_id",
        "refit_id",
        plan.cut_of(F.col("refit_id"), n).alias("train_cut"),
        "score_from",
        F.least(n, F.col("score_from") + plan.step_size).alias("score_to"),
    )


def refit_plan(df: DataFrame, plan: WalkForward = WalkForward()) -> DataFrame:
    """One row per refit: its training cut and the rows it scores."""
    return (
        fold_plan(df, plan)
        .groupBy("symbol", "refit_id", "train_cut")
        .agg(
            F.min("score_from").alias("score_from"),
            F.max("score_to").alias("score_to"),
            F.count(F.lit(1)).alias("folds"),
        )
    )


def scored_rows(positioned: DataFrame, plan: WalkForward = WalkForward()) -> DataFrame:
    """The rows some fold scores, with ``fold_id`` and ``refit_id``; no join needed."""
    n, row_idx = F.col("n"), F.col("row_idx")
    stop = plan.first_cut(n) + plan.fold_count(n) * plan.step_size
    return (
        positioned.filter((row_idx >= plan.first_cut(n)) & (row_idx < stop))
        .withColumn("fold_id", plan.fold_of(row_idx, n))
        .withColumn("refit_id", plan.refit_of(F.col("fold_id")))
    )
