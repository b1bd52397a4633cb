"""Model files in the published JSON layout of a common boosting package.

One file per symbol. A file's trees keep their own node numbers: children are looked up, so
trees may have any depth and shape. Inputs and borders are compared in single precision, as the
package does, except in files written here, which say that theirs are double. Sums are double.
Only plain regression trees are read: linear boosters, dropout weights, categorical splits,
several outputs and objectives that transform the sum are refused when the job runs.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from volspark.schemas import MODELS, feature_columns
from volspark.sinks import write_lines

# The file's name behind the symbol, and the package's names of what is read.
SUFFIX = "_xgb_model.json"
BOOSTER, OBJECTIVE = "gbtree", "reg:squarederror"
ROOT_PARENT = 2147483647

#: The attribute by which files written here say that their borders are double.
DOUBLE = "double_borders"

MODEL_FIELDS = (
    "symbol string, refit_id int, train_cut long, n_train long, model string,"
    " importances map<string, double>"
)


def _depth_first(tree: dict) -> tuple[list[int], int]:
    """The nodes that the root leads to, and the most steps from it to a leaf."""
    left, right = tree["left_children"], tree["right_children"]
    order, waiting, deepest = [], [(0, 0)], 0
    while waiting:
        node, depth = waiting.pop()
        order.append(node)
        deepest = max(deepest, depth)
        if len(order) > len(left):
            raise ValueError("a tree's nodes form a circle")
        if left[node] >= 0:
            waiting += [(right[node], depth + 1), (left[node], depth + 1)]
    return order, deepest


def decoded(text: str, columns: list[str] | None = None) -> dict:
    """The model that a file holds, in the layout of ``MODELS.model``.

    ``columns`` are the inputs where the file does not name them.
    """
    learner = json.loads(text)["learner"]
    booster, params = learner["gradient_booster"], learner["learner_model_param"]
    objective = learner.get("objective", {}).get("name", OBJECTIVE)
    if booster["name"] != BOOSTER or objective != OBJECTIVE:
        raise ValueError(f"not a plain regression booster: {booster['name']}, {objective}")
    if int(params.get("num_class") or 0) > 1 or int(params.get("num_target") or 1) > 1:
        raise ValueError("models of several outputs are not read")
    # a number, or a list of one in later versions
    base = float(params["base_score"].strip("[]"))
    double = learner.get("attributes", {}).get(DOUBLE) == "1"
    names = learner.get("feature_names") or columns
    if not names or len(names) != int(params.get("num_feature") or len(names)):
        raise ValueError("the file does not name its inputs: give as many columns as it has")

    def number(value: float) -> float:
        return float(value) if double else float(np.float32(value))

    trees = []
    for tree in booster["model"]["trees"]:
        if any(tree.get("categories_nodes") or []) or any(tree.get("split_type") or []):
            raise ValueError("categorical splits are not read")
        order, steps = _depth_first(tree)
        new = {old: i for i, old in enumerate(order)}
        inner = [tree["left_children"][old] >= 0 for old in order]

        def child(side: str, inner=inner, order=order, new=new, tree=tree) -> list[int]:
            return [new[tree[side][old]] if i else -1 for old, i in zip(order, inner)]

        at = [(old, is_inner) for old, is_inner in zip(order, inner)]
        trees.append(
            {
                "feature": [tree["split_indices"][old] if i else -1 for old, i in at],
                "threshold": [number(tree["split_conditions"][old]) if i else 0.0 for old, i in at],
                "value": [0.0 if i else number(tree["split_conditions"][old]) for old, i in at],
                "gain": [float(tree["loss_changes"][old]) if i else 0.0 for old, i in at],
                "left": child("left_children"),
                "right": child("right_children"),
                "missing_left": [bool(tree["default_left"][old]) for old, _ in at],
                "steps": steps,
            }
        )
    return {"columns": names, "base": base, "single": not double, "trees": trees}


def importances(model: dict) -> dict[str, float]:
    """Mean gain of the splits on each input, scaled to sum to one."""
    total, times = np.zeros(len(model["columns"])), np.zeros(len(model["columns"]))
    for tree in model["trees"]:
        for feature, gain in zip(tree["feature"], tree["gain"]):
            if feature >= 0:
                total[feature] += gain
                times[feature] += 1
    mean = total / np.maximum(times, 1)
    share = mean / mean.sum() if mean.sum() > 0 else mean
    return dict(zip(model["columns"], share.tolist()))


def encoded(model: dict) -> str:
    """The file of a model of ``MODELS.model``; ``decoded`` gives it back, node numbers aside."""
    trees = [_as_published(i, tree, len(model["columns"])) for i, tree in enumerate(model["trees"])]
    size = str(len(trees))
    learner = {
        "attributes": {} if model.get("single") else {DOUBLE: "1"},
        "feature_names": model["columns"],
        "feature_types": ["float"] * len(model["columns"]),
        "gradient_booster": {
            "model": {
                "gbtree_model_param": {"num_parallel_tree": "1", "num_trees": size},
                "iteration_indptr": list(range(len(trees) + 1)),
                "tree_info": [0] * len(trees),
                "trees": trees,
            },
            "name": BOOSTER,
        },
        "learner_model_param": {
            "base_score": repr(model["base"]),
            "boost_from_average": "1",
            "num_class": "0",
            "num_feature": str(len(model["columns"])),
            "num_target": "1",
        },
        "objective": {"name": OBJECTIVE, "reg_loss_param": {"scale_pos_weight": "1"}},
    }
    return json.dumps({"learner": learner, "version": [2, 0, 0]})


def _as_published(number: int, tree: dict, width: int) -> dict:
    """A tree's nodes as parallel lists, numbered breadth first."""
    size = len(tree["feature"])
    # without child lists, the children of i are 2i+1 and 2i+2
    left = tree.get("left") or [2 * i + 1 for i in range(size)]
    right = tree.get("right") or [2 * i + 2 for i in range(size)]
    missing = tree.get("missing_left") or [False] * size
    order, parents = [0], [ROOT_PARENT]
    for place, node in enumerate(order):
        if tree["feature"][node] >= 0:
            order += [left[node], right[node]]
            parents += [place, place]
    new = {old: i for i, old in enumerate(order)}
    inner = [tree["feature"][old] >= 0 for old in order]
    at = list(zip(order, inner))
    values = [0.0 if i else tree["value"][old] for old, i in at]
    return {
        "base_weights": values,
        "categories": [],
        "categories_nodes": [],
        "categories_segments": [],
        "categories_sizes": [],
        "default_left": [int(bool(missing[old])) for old in order],
        "id": number,
        "left_children": [new[left[old]] if i else -1 for old, i in at],
        "loss_changes": [tree["gain"][old] if i else 0.0 for old, i in at],
        "parents": parents,
        "right_children": [new[right[old]] if i else -1 for old, i in at],
        "split_conditions": [tree["threshold"][old] if i else tree["value"][old] for old, i in at],
        "split_indices": [tree["feature"][old] if i else 0 for old, i in at],
        "split_type": [0] * len(order),
        "sum_hessian": [0.0] * len(order),
        "tree_param": {
            "num_deleted": "0",
            "num_feature": str(width),
            "num_nodes": str(len(order)),
            "size_leaf_vector": "1",
        },
    }


def read_booster_files(
    spark: SparkSession,
    folder: str,
    symbol: str | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """MODELS from the files ``{symbol}_xgb_model.json`` of a folder, or the one of ``symbol``.

    What the files do not hold, the rows trained on, is NULL. ``score`` takes the result.
    """
    names = columns or feature_columns()
    escaped = "*" if symbol is None else re.sub(r"([\\*?\[\]{},])", r"\\\1", symbol)
    files = (
        spark.read.option("wholetext", True)
        .option("pathGlobFilter", f"{escaped}{SUFFIX}")
        .text(folder)
        .select(F.url_decode(F.col("_metadata.file_name")).alias("file"), "value")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for file, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                try:
                    model = decoded(text.as_py(), names)
                except (KeyError, TypeError, ValueError, IndexError) as error:
                    raise ValueError(f"{file}: {error}") from error
                own = importances(model)
                rows.append((file.removesuffix(SUFFIX), json.dumps(model), list(own.items())))
            nothing = pa.nulls(len(rows), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.string()),
                    pa.array([0] * len(rows), pa.int32()),
                    nothing,
                    nothing,
                    pa.array([r[1] for r in rows], pa.string()),
                    pa.array([r[2] for r in rows], pa.map_(pa.string(), pa.float64())),
                ],
                MODELS.names,
            )

    return files.mapInArrow(run, MODEL_FIELDS)


def write_booster_files(models: DataFrame, folder: str) -> str:
    """The latest model of every symbol as a file ``{symbol}_xgb_model.json`` in ``folder``."""
    latest = models.groupBy("symbol").agg(F.max_by("model", "refit_id").alias("model"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [encoded(json.loads(m)) for m in batch.column("model").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("symbol"), pa.array(lines, pa.string())], ["symbol", "line"]
            )

    lines = latest.mapInArrow(run, "symbol string, line string")
    return write_lines(lines, folder, SUFFIX)
