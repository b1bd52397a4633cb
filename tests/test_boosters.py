"""Model files of the published layout: read, scored, written."""

import json
import math
import os

import numpy as np
import pytest
from conftest import collect
from pyspark.errors import PySparkException

from volspark.learners.scoring import score
from volspark.sources.boosters import decoded, encoded, read_booster_files, write_booster_files

COLUMNS = ["a", "b", "c"]

#: A chain of six splits whose nodes are numbered in no order, a stump, and a lone leaf.
CHAIN = {
    "left_children": [4, -1, 9, -1, -1, 2, -1, 12, -1, -1, -1, 7, -1],
    "right_children": [5, -1, 11, -1, -1, 3, -1, 8, -1, -1, -1, 6, -1],
    "split_indices": [0, 0, 2, 0, 0, 1, 0, 0, 0, 0, 0, 1, 0],
    "split_conditions": [-1.5, 0, 0.1, 3.0, -4.0, 0.3, 6.25, -0.7, 8.5, 9.0, 0, -0.2, 12.0],
    "default_left": [0, 0, 1, 0, 0, 1, 0, 0, 0, 0, 0, 1, 0],
    "loss_changes": [5.0, 0, 2.0, 0, 0, 1.0, 0, 0.5, 0, 0, 0, 4.0, 0],
}
STUMP = {
    "left_children": [1, -1, -1],
    "right_children": [2, -1, -1],
    "split_indices": [2, 0, 0],
    "split_conditions": [0.1, -0.25, 0.25],
    "default_left": [False, False, False],
    "loss_changes": [3.0, 0.0, 0.0],
}
LEAF = {
    "left_children": [-1],
    "right_children": [-1],
    "split_indices": [0],
    "split_conditions": [0.125],
    "default_left": [0],
    "loss_changes": [0.0],
}


def written_by_hand(**changes):
    learner = {
        "attributes": {},
        "feature_names": COLUMNS,
        "gradient_booster": {"model": {"trees": [CHAIN, STUMP, LEAF]}, "name": "gbtree"},
        "learner_model_param": {"base_score": "5E-1", "num_class": "0", "num_feature": "3"},
        "objective": {"name": "reg:squarederror"},
    }
    return json.dumps({"learner": learner | changes, "version": [2, 0, 3]})


def walked(tree, row):
    node = 0
    while tree["left_children"][node] >= 0:
        x, border = row[tree["split_indices"][node]], np.float32(tree["split_conditions"][node])
        if x is None or math.isnan(x):
            left = tree["default_left"][node]
        else:
            left = np.float32(x) < border
        node = (tree["left_children"] if left else tree["right_children"])[node]
    return float(np.float32(tree["split_conditions"][node]))


@pytest.fixture
def rows(spark):
    rng = np.random.default_rng(8)
    # also values at a border, and just off it in double but not in single precision
    near = [0.1, 0.1 + 1e-12, 0.3, -0.2, -0.7, -1.5, math.nan, None]
    made = [tuple(float(v) for v in rng.uniform(-2, 1, 3)) for _ in range(150)]
    made += [(float(rng.uniform(-2, 1)), a, b) for a in near for b in near]
    made += [(a, b, 0.0) for a in near for b in near]
    return [("S^1", i, *m) for i, m in enumerate(made)]


def table(spark, rows):
    shape = "symbol string, date int, a double, b double, c double"
    return spark.createDataFrame(rows, shape)


def test_a_hand_written_file_is_scored_as_it_says(spark, tmp_path, rows):
    (tmp_path / "S^1_xgb_model.json").write_text(written_by_hand())
    (tmp_path / "notes.json").write_text("{}")
    models = read_booster_files(spark, str(tmp_path))
    assert [r.symbol for r in models.collect()] == ["S^1"]
    found = {r.date: r.predicted for r in score(table(spark, rows), models).collect()}
    for _, i, *row in rows:
        assert found[i] == pytest.approx(0.5 + sum(walked(t, row) for t in (CHAIN, STUMP, LEAF)))
    # mean gain of the splits on each input
    gains = {"a": (5 + 0.5) / 2, "b": (1 + 4) / 2, "c": (2 + 3) / 2}
    shares = models.first().importances
    assert shares == pytest.approx({k: v / sum(gains.values()) for k, v in gains.items()})


def test_round_trip_keeps_every_score(spark, tmp_path, rows):
    first, second = tmp_path / "first", tmp_path / "second"
    first.mkdir()
    for name, base in (("S^1", "5E-1"), ("T", "[2.5E-1]")):
        params = {"base_score": base, "num_class": "0", "num_feature": "3"}
        text = written_by_hand(learner_model_param=params)
        (first / f"{name}_xgb_model.json").write_text(text)
    models = read_booster_files(spark, str(first))
    write_booster_files(models, str(second))
    files = {f for f in os.listdir(second) if not f.startswith(".")}
    assert files == {"S^1_xgb_model.json", "T_xgb_model.json"}
    again = read_booster_files(spark, str(second))
    both = table(spark, rows + [("T", *r[1:]) for r in rows])
    keys = ("symbol", "date")
    assert collect(score(both, again), *keys) == collect(score(both, models), *keys)
    assert {r.symbol: r.importances for r in again.collect()} == {
        r.symbol: r.importances for r in models.collect()
    }


def test_files_written_here_keep_double_borders(spark, tmp_path):
    """Two values that single precision cannot tell apart stay on their sides."""
    value = 0.1 + 1e-12
    model = {
        "columns": COLUMNS,
        "base": 0.0,
        "trees": [
            {"feature": [0, -1, -1], "threshold": [value, 0, 0], "value": [0, -1.0, 1.0], "gain": [1, 0, 0]}
        ],
    }
    (tmp_path / "S_xgb_model.json").write_text(encoded(model))
    rows = [("S", 0, 0.1, 0.0, 0.0), ("S", 1, value, 0.0, 0.0)]
    models = read_booster_files(spark, str(tmp_path), "S")
    found = {r.date: r.predicted for r in score(table(spark, rows), models).collect()}
    assert found == {0: -1.0, 1: 1.0}


def test_published_lists_fit_together():
    """Parents name their children, numbers rise on the way down, leaves hold values."""
    text = encoded(decoded(written_by_hand()) | {"single": True})
    trees = json.loads(text)["learner"]["gradient_booster"]["model"]["trees"]
    for tree, source in zip(trees, (CHAIN, STUMP, LEAF)):
        size = len(tree["left_children"])
        assert {len(tree[k]) for k in ("parents", "split_conditions", "default_left")} == {size}
        assert tree["tree_param"]["num_nodes"] == str(size)
        for node, (left, right) in enumerate(zip(tree["left_children"], tree["right_children"])):
            if left >= 0:
                assert tree["parents"][left] == tree["parents"][right] == node < min(left, right)
        rng = np.random.default_rng(1)
        for row in rng.uniform(-2, 1, (50, 3)).tolist():
            assert walked(tree, row) == walked(source, row)


@pytest.mark.parametrize(
    "changes,says",
    [
        ({"objective": {"name": "reg:logistic"}}, "not a plain regression"),
        ({"gradient_booster": {"name": "dart", "gbtree": {}}}, "not a plain regression"),
        (
            {"learner_model_param": {"base_score": "0", "num_class": "3", "num_feature": "3"}},
            "several outputs",
        ),
        ({"feature_names": ["a"]}, "does not name its inputs"),
        ({"learner_model_param": {}}, "base_score"),
        (
            {
                "gradient_booster": {
                    "name": "gbtree",
                    "model": {"trees": [STUMP | {"split_type": [1, 0, 0]}]},
                }
            },
            "categorical",
        ),
        (
            {
                "gradient_booster": {
                    "name": "gbtree",
                    "model": {"trees": [STUMP | {"left_children": [0, -1, -1]}]},
                }
            },
            "circle",
        ),
    ],
)
def test_files_that_are_not_read(spark, tmp_path, changes, says):
    (tmp_path / "S_xgb_model.json").write_text(written_by_hand(**changes))
    with pytest.raises(PySparkException, match=says):
        read_booster_files(spark, str(tmp_path)).collect()


def test_inputs_that_a_file_does_not_name(spark, tmp_path):
    (tmp_path / "S_xgb_model.json").write_text(written_by_hand(feature_names=[]))
    models = read_booster_files(spark, str(tmp_path), columns=COLUMNS)
    assert list(models.first().importances) == COLUMNS
