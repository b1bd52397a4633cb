"""Predictions from stored models, without fitting again and without Python in the tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODEL_JSON = (
    "struct<columns: array<string>, base: double, single: boolean, trees: array<struct<"
    "feature: array<int>, threshold: array<double>, value: array<double>, gain: array<double>, "
    "left: array<int>, right: array<int>, missing_left: array<boolean>, steps: int>>>"
)


def walk_down(feature: Column, goes_right, depth: Column) -> Column:
    """The node a row comes to: children of i are 2i+1 and 2i+2, a leaf has no feature."""
    return F.aggregate(
        F.sequence(F.lit(1), depth),
        F.lit(0),
        lambda node, _: F.when(
            F.get(feature, node) >= 0,
            node * 2 + 1 + goes_right(F.get(feature, node), node).cast("int"),
        ).otherwise(node),
    )


def sum_of_trees(start: Column, trees: Column, leaf) -> Column:
    """``start`` plus the value of the leaf that ``leaf`` finds in each tree."""
    return F.aggregate(trees, start, lambda total, tree: total + F.get(tree["value"], leaf(tree)))


def leaf_by_value(tree: Column) -> Column:
    """The leaf of the row whose inputs are in the array column ``x``."""
    depth = F.log2(F.size(tree["feature"]) + 1).cast("int") - 1
    return walk_down(
        tree["feature"], lambda f, node: F.get("x", f) >= F.get(tree["threshold"], node), depth
    )


def leaf_by_children(tree: Column) -> Column:
    """The same for a tree that lists its children, and which of them missing inputs go to."""

    def below(node: Column) -> Column:
        x = F.nullif(F.get("x", F.get(tree["feature"], node)), F.lit(float("nan")))
        left = F.coalesce(x < F.get(tree["threshold"], node), F.get(tree["missing_left"], node))
        return F.when(left, F.get(tree["left"], node)).otherwise(F.get(tree["right"], node))

    # a leaf stays where it is, so a step too many is none
    return F.aggregate(
        F.sequence(F.lit(1), F.greatest(tree["steps"], F.lit(1))),
        F.lit(0),
        lambda node, _: F.when(F.get(tree["feature"], node) >= 0, below(node)).otherwise(node),
    )


def leaf_of(tree: Column) -> Column:
    return F.when(tree["left"].isNull(), leaf_by_value(tree)).otherwise(leaf_by_children(tree))


def score(features: DataFrame, models: DataFrame, of: str | None = None) -> DataFrame:
    """``symbol, date, refit_id, predicted`` by the latest stored model of each symbol.

    With ``of``, all symbols are scored by the models stored under that one.
    """
    if of is not None:
        models = models.filter(F.col("symbol") == of)
    latest = models.groupBy(F.col("symbol").alias("model_of")).agg(
        F.max_by(F.struct("refit_id", "model"), "refit_id").alias("latest")
    )
    inputs = [c for c, kind in features.dtypes if kind == "double"]
    names = F.array(*[F.lit(c) for c in inputs])
    # where each input lies is looked up once per model, not per row
    parsed = latest.select(
        "model_of", "latest.refit_id", F.from_json("latest.model", MODEL_JSON).alias("model")
    ).withColumn(
        "places",
        F.transform("model.columns", lambda c: F.array_position(names, c).cast("int") - 1),
    )
    rows = features.select("symbol", "date", F.array(*inputs).alias("inputs"))
    key = F.col("symbol") if of is None else F.lit(of)
    joined = rows.withColumn("model_of", key).join(parsed, "model_of")
    x = F.transform("places", lambda at: F.get("inputs", at))
    rounded = F.transform(x, lambda value: value.cast("float").cast("double"))
    x = F.when(F.col("model.single"), rounded).otherwise(x)
    return joined.withColumn("x", x).select(
        "symbol",
        "date",
        "refit_id",
        sum_of_trees(F.col("model.base"), F.col("model.trees"), leaf_of).alias("predicted"),
    )
