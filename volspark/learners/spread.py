"""The same boosted trees for series too long for one task: rows stay where Spark has them.

A row is stored once, whatever the number of refits that train on it: the place of each input
among all borders of all refits, and one running prediction per refit. A level of a tree, for
all models of a batch at once, is one pass: every task adds up histograms of gradients over
(model, node, feature, bin), Spark sums them, and what reaches the driver has a size that
depends on models, features and bins only. Of two children only the smaller is counted; the
other is the parent less that one, which is exact, as gradients are whole numbers. So are the
leaves, which need no pass of their own. Sums being exact, the models equal those that
``boosting.fit`` makes, bit for bit.

Results of each step are tables in the shared folder: no lineage builds up, and a lost
executor costs the step at hand.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from volspark.learners import boosting
from volspark.learners.boosting import BoostParams, Tree
from volspark.learners.scoring import leaf_by_value, sum_of_trees
from volspark.schemas import MODELS, PREDICTIONS, TARGET
from volspark.sinks import clearing_scratch, materialize, scratch_path

#: Refits whose predictions a row holds at once, and models worked on side by side: the driver
#: holds the trees of these and a level's histograms.
REFITS_AT_ONCE, MODELS_AT_ONCE = 64, 128
#: Trees a row is walked through before its predictions are stored again.
TREES_PER_STATE = 10
#: So few tasks, times models, hand their histograms (some 400 kB of each) to the driver as they
#: are, without a shuffle.
GATHERED = 64
#: Above any number of ranges on one side of zero.
RANGES = 1 << 21

#: One model: its series and its refit.
FITTED = (
    "series string, refit_id int, n_train long, base double, trees array<struct<"
    "feature: array<int>, threshold: array<double>, value: array<double>, gain: array<double>>>"
)


@dataclass
class Growth:
    """The models of one series in a batch, one per refit."""

    n: np.ndarray
    base: np.ndarray
    unit: np.ndarray
    #: Borders by refit and feature; all borders of a feature; and by refit and feature the bin
    #: of every place among all borders.
    edges: list[list[np.ndarray]] = field(default_factory=list)
    every: list[np.ndarray] = field(default_factory=list)
    bins: np.ndarray | None = None
    trees: list[list[Tree]] = field(default_factory=list)
    cuts: list[list[np.ndarray]] = field(default_factory=list)

    def place_borders(self, edges: list[list[np.ndarray]]) -> None:
        self.edges = edges
        width = len(edges[0])
        self.every = [np.unique(np.concatenate([of[f] for of in edges])) for f in range(width)]
        places = max(map(len, self.every)) + 1
        self.bins = np.zeros((len(edges), width, places), np.int16)
        for r, of in enumerate(edges):
            for f, borders in enumerate(of):
                at = np.searchsorted(borders, self.every[f], side="right")
                self.bins[r, f, 1 : len(at) + 1] = at


def _walk(
    feature: np.ndarray, cut: np.ndarray, bins: np.ndarray, places: np.ndarray, steps: int
) -> np.ndarray:
    """The node every row comes to by the bins of one model."""
    node = np.zeros(len(places), np.int64)
    rows = np.arange(len(places))
    for _ in range(steps):
        split = feature[node]
        used = np.maximum(split, 0)
        right = bins[used, places[rows, used]] > cut[node]
        node = np.where(split >= 0, 2 * node + 1 + right, node)
    return node


class Rows:
    """One series' rows of a batch of the state."""

    def __init__(self, batch: pa.RecordBatch, width: int, refits: int) -> None:
        self.segment = batch.column("segment").to_numpy()
        self.number = batch.column("number").to_numpy()
        self.y = batch.column("y").to_numpy()
        self.places = _matrix(batch.column("places"), np.uint16, width)
        self.predicted = _matrix(batch.column("predicted"), np.float64, refits).copy()

    def settle(self, growth: Growth, first: int, refit: int, rows: np.ndarray) -> np.ndarray:
        """Predictions of one refit for some rows, by the trees from ``first`` on."""
        predicted, places = self.predicted[rows, refit], self.places[rows]
        for tree, cut in zip(growth.trees[refit][first:], growth.cuts[refit][first:]):
            depth = (len(tree.feature) + 1).bit_length() - 2
            node = _walk(tree.feature, cut, growth.bins[refit], places, depth)
            predicted = predicted + tree.value[node]
        return predicted


def _matrix(blobs: pa.Array, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs.to_pylist()), kind).reshape(-1, width)


def _by_series(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
    names = batch.column("series").dictionary_encode()
    codes = names.indices.to_numpy()
    for code, name in enumerate(names.dictionary.to_pylist()):
        yield name, batch.take(pa.array(np.flatnonzero(codes == code)))


def _range_of(value: Column) -> Column:
    """The range a value falls in, in the order of values: 1,024 to a doubling."""
    place = F.floor(F.log2(F.abs(value)) * 1024) + RANGES
    return F.when(value > 0, place).when(value < 0, -place).otherwise(F.lit(0)).cast("long")


def _starts(train: DataFrame, refits: int) -> dict[str, Growth]:
    """Rows, base value and gradient unit of every model."""
    parts = train.groupBy("series", "segment").agg(
        F.count(F.lit(1)).alias("n"), F.min("y").alias("low"), F.max("y").alias("high")
    )
    # a row per model at most
    found: dict[str, np.ndarray] = {}
    for p in parts.collect():
        own = found.setdefault(p["series"], np.tile([[0.0], [np.inf], [-np.inf]], refits))
        own[:, p["segment"]] = p["n"], p["low"], p["high"]
    for own in found.values():
        own[0], own[1] = np.cumsum(own[0]), np.minimum.accumulate(own[1])
        own[2] = np.maximum.accumulate(own[2])
    units = {
        name: [boosting.power_of_two(max(abs(low), abs(high)), 30) if n else 1.0 for n, low, high in own.T]
        for name, own in found.items()
    }
    shared = train.sparkSession.sparkContext.broadcast(units)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, rows in _by_series(batch):
                own = totals.setdefault(name, np.zeros(refits, np.int64))
                y, segment = rows.column("y").to_numpy(), rows.column("segment").to_numpy()
                for r, unit in enumerate(shared.value[name]):
                    own[r] += np.rint(y[segment <= r] / unit).astype(np.int64).sum()
        for name, own in totals.items():
            yield pa.record_batch(
                [pa.array([name] * refits), pa.array(np.arange(refits)), pa.array(own)],
                ["series", "refit", "total"],
            )

    sums = train.select("series", "segment", "y").mapInArrow(
        run, "series string, refit long, total long"
    )
    totals = {
        (s["series"], s["refit"]): s["total"]
        for s in sums.groupBy("series", "refit").agg(F.sum("total").alias("total")).collect()
    }
    growths = {}
    for name, own in found.items():
        n = own[0].astype(np.int64)
        base, unit = np.zeros(refits), np.ones(refits)
        for r in np.flatnonzero(n):
            base[r] = totals[name, r] * units[name][r] / int(n[r])
            furthest = max(abs(own[2, r] - base[r]), abs(own[1, r] - base[r]))
            unit[r] = boosting.power_of_two(float(furthest), 29)
        empty = [[] for _ in range(refits)]
        growths[name] = Growth(n, base, unit, trees=empty, cuts=[[] for _ in range(refits)])
    return growths


def _counts(table: pa.Table, at: np.ndarray, size: int, refits: int) -> np.ndarray:
    """Rows by place and refit, from rows by place and first refit."""
    rows = np.zeros((size, refits), np.int64)
    np.add.at(rows, (at, table.column("segment").to_numpy()), table.column("rows").to_numpy())
    return rows.cumsum(axis=1)


def _place_borders(train: DataFrame, growths: dict[str, Growth], width: int, params: BoostParams):
    """Find the borders by rank, as ``boosting.bin_edges`` has them, for all refits at once.

    Distinct values are counted by the first refit that trains on them. Counts add up within
    narrow ranges of values, on top of what lies below a range; only ranges that a border
    falls into are looked at by value. No task orders a whole feature.
    """
    refits, bins = len(next(iter(growths.values())).n), params.max_bins
    shared = train.sparkSession.sparkContext.broadcast({k: g.n for k, g in growths.items()})
    keys = ["series", "feature"]
    counts = (
        train.select("series", "segment", F.posexplode("x").alias("feature", "value"))
        .groupBy(*keys, "value", "segment")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("range", _range_of(F.col("value")))
    )
    counts = materialize(counts, "value-counts")
    ranges = counts.groupBy(*keys, "range", "segment").agg(
        F.sum("rows").alias("rows"), F.min("value").alias("least")
    )

    def levels(upto: np.ndarray, n: np.ndarray) -> np.ndarray:
        return upto * bins // np.maximum(n, 1)

    def wanted(table: pa.Table) -> pa.Table:
        name = table.column("series")[0].as_py()
        n = shared.value[name]
        found, at = np.unique(table.column("range").to_numpy(), return_inverse=True)
        rows = _counts(table, at, len(found), refits)
        least = np.full((len(found), refits), np.inf)
        np.minimum.at(least, (at, table.column("segment").to_numpy()), table.column("least").to_numpy())
        least = np.minimum.accumulate(least, axis=1)
        upto = rows.cumsum(axis=0)
        above = np.full_like(least, np.inf)
        above[:-1] = np.minimum.accumulate(least[::-1], axis=0)[::-1][1:]
        rose = np.flatnonzero((levels(upto, n) > levels(upto - rows, n)).any(axis=1))
        return pa.table(
            {
                "series": pa.array([name] * len(rose), pa.string()),
                "feature": pa.array([table.column("feature")[0].as_py()] * len(rose), pa.int32()),
                "range": found[rose],
                "below": pa.array((upto - rows)[rose].tolist(), pa.list_(pa.int64())),
                "above": pa.array(above[rose].tolist(), pa.list_(pa.float64())),
            }
        )

    needed = ranges.groupBy(*keys).applyInArrow(
        wanted, "series string, feature int, range long, below array<long>, above array<double>"
    )
    needed = materialize(needed, "border-ranges")

    def borders(table: pa.Table, where: pa.Table) -> pa.Table:
        name, feature = where.column("series")[0].as_py(), where.column("feature")[0].as_py()
        n = shared.value[name]
        below, above = (np.array(where.column(c)[0].as_py()) for c in ("below", "above"))
        values, at = np.unique(table.column("value").to_numpy(), return_inverse=True)
        rows = _counts(table, at, len(values), refits)
        upto = below + rows.cumsum(axis=0)
        rose = levels(upto, n) > levels(upto - rows, n)
        refit, border = [], []
        for r in range(refits):
            own = np.flatnonzero(rows[:, r])
            following = np.append(values[own[1:]], above[r]) if len(own) else own
            border.append(following[rose[own, r]])
            refit.append(np.full(len(border[-1]), r))
        border, refit = np.concatenate(border), np.concatenate(refit)
        kept = np.isfinite(border)
        return pa.table(
            {
                "series": pa.array([name] * int(kept.sum()), pa.string()),
                "feature": pa.array([feature] * int(kept.sum()), pa.int32()),
                "refit": pa.array(refit[kept], pa.int64()),
                "border": pa.array(border[kept], pa.float64()),
            }
        )

    each = [*keys, "range"]
    near = counts.join(needed.select(*each), each, "left_semi")
    found = (
        near.groupBy(*each)
        .cogroup(needed.groupBy(*each))
        .applyInArrow(borders, "series string, feature int, refit long, border double")
    )
    edges = {name: [[[] for _ in range(width)] for _ in range(refits)] for name in growths}
    # fewer than max_bins of a model's feature
    for name, feature, refit, border in zip(*(c.to_pylist() for c in found.toArrow().columns)):
        edges[name][refit][feature].append(border)
    for name, of in edges.items():
        growths[name].place_borders([[np.unique(b) for b in own] for own in of])


def _first_state(train: DataFrame, growths: dict[str, Growth], refits: int) -> DataFrame:
    shared = train.sparkSession.sparkContext.broadcast(
        {name: (g.every, g.base) for name, g in growths.items()}
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, rows in _by_series(batch):
                every, base = shared.value[name]
                x = rows.column("x").flatten().to_numpy().reshape(len(rows), len(every))
                places = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(every)]
                places = np.stack(places, axis=1).astype(np.uint16)
                blobs = [row.tobytes() for row in places]
                kept = [rows.column(c) for c in ("series", "number", "segment", "y")]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(blobs, pa.binary()), pa.array([base.tobytes()] * len(rows), pa.binary())],
                    ["series", "number", "segment", "y", "places", "predicted"],
                )

    state = train.mapInArrow(
        run, "series string, number long, segment int, y double, places binary, predicted binary"
    )
    return materialize(state, "fit-state")


def _settled(state: DataFrame, shared, first: int, width: int, refits: int) -> DataFrame:
    """The state with the trees from ``first`` on in its predictions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, own in _by_series(batch):
                rows, growth = Rows(own, width, refits), shared.value[name]
                for r in range(refits):
                    at = np.flatnonzero(rows.segment <= r)
                    rows.predicted[at, r] = rows.settle(growth, first, r, at)
                blobs = pa.array([p.tobytes() for p in rows.predicted], pa.binary())
                yield own.set_column(own.schema.get_field_index("predicted"), "predicted", blobs)

    return materialize(state.mapInArrow(run, state.schema), "fit-state")


def _level_sums(
    state: DataFrame,
    shared,
    first: int,
    tree: int,
    width: int,
    refits: int,
    params: BoostParams,
    gathered: bool,
) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Gradient sums and rows by (refit, wanted node, feature, bin) of each series.

    ``shared`` has, by series, the growth, the trees being grown and, by refit and node, the
    slot of the nodes wanted (or -1).
    """
    bins = params.max_bins

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for name, own in _by_series(batch):
                if name not in shared.value:
                    continue
                growth, growing, slots, level = shared.value[name]
                number = int(slots.max()) + 1
                shape = refits, number, width, bins
                if name not in sums:
                    sums[name] = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
                rows = Rows(own, width, refits)
                drawn = boosting.sampled(rows.number, tree, params)
                for r in range(refits):
                    if slots[r].max() < 0:
                        continue
                    at = np.flatnonzero(drawn & (rows.segment <= r))
                    feature, cut = growing[r]
                    node = _walk(feature, cut, growth.bins[r], rows.places[at], level)
                    slot = slots[r][node]
                    at, slot = at[slot >= 0], slot[slot >= 0]
                    grad = np.rint((rows.settle(growth, first, r, at) - rows.y[at]) / growth.unit[r])
                    start = slot * bins
                    for f in range(width):
                        cell = start + growth.bins[r, f][rows.places[at, f]]
                        for total, weight in zip(sums[name], (grad, None)):
                            added = np.bincount(cell, weight, number * bins)
                            total[r, :, f] += added.reshape(number, bins).astype(np.int64)
        for name, (grads, counts) in sums.items():
            cell = np.flatnonzero(counts)
            for at in range(0, len(cell), 100_000):
                part = cell[at : at + 100_000]
                yield pa.record_batch(
                    [
                        pa.array([name] * len(part), pa.string()),
                        pa.array(part),
                        pa.array(grads.ravel()[part]),
                        pa.array(counts.ravel()[part]),
                    ],
                    ["series", "cell", "grad", "rows"],
                )

    cells = state.mapInArrow(run, "series string, cell long, grad long, rows long")
    if not gathered:
        sums = F.sum("grad").alias("grad"), F.sum("rows").alias("rows")
        cells = cells.groupBy("series", "cell").agg(*sums)
    found = {}
    for name, part in _by_name(cells.toArrow()):
        number = int(shared.value[name][2].max()) + 1
        shape = refits, number, width, bins
        totals = []
        for column in ("grad", "rows"):
            total = np.zeros(np.prod(shape), np.int64)
            np.add.at(total, part.column("cell").to_numpy(), part.column(column).to_numpy())
            totals.append(total.reshape(shape).astype(float))
        found[name] = tuple(totals)
    return found


def _by_name(table: pa.Table) -> Iterator[tuple[str, pa.Table]]:
    for name in table.column("series").unique().to_pylist():
        yield name, table.filter(pc.equal(table.column("series"), name))


class Sprout:
    """A tree being grown for one model, with the histograms of its open nodes."""

    def __init__(self, growth: Growth, refit: int, params: BoostParams) -> None:
        self.growth, self.refit, self.params = growth, refit, params
        self.tree = Tree.empty(params.depth)
        self.cut = np.zeros(len(self.tree.feature), np.int64)
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        #: nodes to count, and of each the parent's histogram and the node that gets the rest
        self.wanted: dict[int, tuple[tuple | None, int]] = {0: (None, -1)} if growth.n[refit] else {}

    def take(self, counted: dict[int, tuple[np.ndarray, np.ndarray]]) -> None:
        """Split the nodes that have been counted, and their siblings."""
        for node, own in counted.items():
            parent, other = self.wanted[node]
            self.open[node] = own
            if parent is not None:
                self.open[other] = parent[0] - own[0], parent[1] - own[1]
        self.wanted = {}
        unit = self.growth.unit[self.refit]
        for node in sorted(self.open):
            grads, rows = self.open[node]
            self._value(node, grads[0].sum(), rows[0].sum())
            gain, feature, cut = (
                found[0] for found in boosting.best_splits(grads[None], rows[None], unit, self.params)
            )
            if not gain > self.params.min_gain:
                continue
            self.tree.feature[node], self.cut[node] = feature, cut
            self.tree.threshold[node] = self.growth.edges[self.refit][feature][cut]
            self.tree.gain[node], self.tree.value[node] = gain, 0.0
            left = grads[feature, : cut + 1].sum(), rows[feature, : cut + 1].sum()
            right = grads[feature].sum() - left[0], rows[feature].sum() - left[1]
            for child, totals in ((2 * node + 1, left), (2 * node + 2, right)):
                self._value(child, *totals)
            small, large = 2 * node + 1, 2 * node + 2
            if right[1] < left[1]:
                small, large = large, small
            self.wanted[small] = (grads, rows), large
        self.open = {}

    def _value(self, node: int, total: float, rows: float) -> None:
        weight = -(total * self.growth.unit[self.refit]) / (rows + self.params.reg_lambda)
        self.tree.value[node] = weight * self.params.learning_rate if rows else 0.0


def _grow(
    state: DataFrame,
    growths: dict[str, Growth],
    first: int,
    tree: int,
    width: int,
    params: BoostParams,
    gathered: bool,
) -> None:
    """Grow one tree for every model."""
    context = state.sparkSession.sparkContext
    sprouts = {
        name: [Sprout(growth, r, params) for r in range(len(growth.n))]
        for name, growth in growths.items()
    }
    for level in range(params.depth):
        plan = {}
        for name, own in sprouts.items():
            slots = np.full((len(own), len(own[0].cut)), -1)
            for r, sprout in enumerate(own):
                slots[r, list(sprout.wanted)] = np.arange(len(sprout.wanted))
            if slots.max() >= 0:
                growing = [(sprout.tree.feature, sprout.cut) for sprout in own]
                plan[name] = growths[name], growing, slots, level
        if not plan:
            break
        shared = context.broadcast(plan)
        refits = len(next(iter(growths.values())).n)
        sums = _level_sums(state, shared, first, tree, width, refits, params, gathered)
        shared.destroy()
        nothing = np.zeros((2, width, params.max_bins))
        for name in plan:
            for r, sprout in enumerate(sprouts[name]):
                counted = {}
                for slot, node in enumerate(sprout.wanted):
                    # a tree's sample may hold no row of a model
                    known = name in sums
                    counted[node] = tuple(s[r, slot] for s in sums[name]) if known else tuple(nothing)
                sprout.take(counted)
    for name, own in sprouts.items():
        for r, sprout in enumerate(own):
            growths[name].trees[r].append(sprout.tree)
            growths[name].cuts[r].append(sprout.cut)


def _fit_batch(train: DataFrame, width: int, refits: int, params: BoostParams) -> dict[str, Growth]:
    growths = _starts(train, refits)
    if not growths:
        return growths
    _place_borders(train, growths, width, params)
    state = _first_state(train, growths, refits)
    tasks = state.select(F.spark_partition_id().alias("task")).distinct().count()
    gathered = tasks * refits * len(growths) <= GATHERED
    settled = 0
    for tree in range(params.trees):
        if tree - settled == TREES_PER_STATE:
            shared = train.sparkSession.sparkContext.broadcast(growths)
            state, settled = _settled(state, shared, settled, width, refits), tree
            shared.destroy()
        _grow(state, growths, settled, tree, width, params, gathered)
    return growths


def _table(spark: SparkSession, growths: dict[str, Growth], first: int) -> DataFrame:
    rows = []
    for name, growth in growths.items():
        for r in np.flatnonzero(growth.n).tolist():
            trees = [
                (t.feature.tolist(), t.threshold.tolist(), t.value.tolist(), t.gain.tolist())
                for t in growth.trees[r]
            ]
            rows.append((name, first + r, int(growth.n[r]), float(growth.base[r]), trees))
    return spark.createDataFrame(rows, FITTED)


def fit_models(
    rows: DataFrame,
    width: int,
    params: BoostParams = BoostParams(),
    refits_at_once: int = REFITS_AT_ONCE,
) -> DataFrame:
    """series, refit_id, n_train, base and trees of every model.

    ``rows`` is a stored table of series, number (what sampling goes by), segment (the first
    refit that trains on the row), refits (of the series), y and x (``width`` inputs).
    Fitting runs when this is called.
    """
    if params.max_bins > 256:
        raise ValueError("at most 256 bins")
    spark = rows.sparkSession
    most, series = rows.agg(F.max("refits"), F.count_distinct("series")).first()
    if not most:
        raise ValueError("no series has a row to score")
    at_once = min(most, refits_at_once)
    shares = max(1, -(-series * at_once // MODELS_AT_ONCE))
    if shares > 1:
        # a share is a folder, so that each is read without the others
        share = F.pmod(F.xxhash64("series"), F.lit(shares)).cast("int")
        rows = materialize(rows.withColumn("share", share), "fit-rows", ("share",))
    path = scratch_path(spark, "fitted")
    for part in range(shares):
        own = rows.filter(F.col("share") == part) if shares > 1 else rows
        for first in range(0, most, at_once):
            stop = F.least(F.col("refits"), F.lit(first + at_once))
            train = own.filter(F.greatest("segment", F.lit(first)) < stop).select(
                "series",
                "number",
                (F.greatest("segment", F.lit(first)) - first).cast("int").alias("segment"),
                "y",
                "x",
            )
            with clearing_scratch(spark):
                growths = _fit_batch(train, width, min(at_once, most - first), params)
                _table(spark, growths, first).write.parquet(f"{path}/batch={part}-{first}")
    return spark.read.parquet(path).drop("batch")


def _importances(fitted: DataFrame, columns: list[str]) -> DataFrame:
    model = ["series", "refit_id"]
    split = F.arrays_zip("tree.feature", "tree.gain")
    per_feature = (
        fitted.select(*model, F.explode("trees").alias("tree"))
        .select(*model, F.inline(split).alias("feature", "gain"))
        .filter(F.col("feature") >= 0)
        .groupBy(*model, "feature")
        .agg(F.avg("gain").alias("gain"))
        .groupBy(*model)
        .agg(
            F.map_from_entries(F.collect_list(F.struct("feature", "gain"))).alias("gains"),
            F.sum("gain").alias("scale"),
        )
    )
    names = F.array(*[F.lit(c) for c in columns])
    shares = [
        F.coalesce(
            F.try_divide(F.try_element_at(F.col("gains"), F.lit(f)), F.col("scale")), F.lit(0.0)
        )
        for f in range(len(columns))
    ]
    return fitted.join(per_feature, model, "left").withColumn(
        "importances", F.map_from_arrays(names, F.array(*shares))
    )


def predictions_and_models(
    rows: DataFrame, fitted: DataFrame, columns: list[str], series: str | Column = "symbol"
) -> tuple[DataFrame, DataFrame]:
    """What the models predict for the rows each refit scores, and the models to store.

    ``series`` is the model's series of a row; it is the symbol of the stored model.
    """
    series = F.col(series) if isinstance(series, str) else series
    scored = rows.filter(F.col("refit_id").isNotNull()).withColumn("series", series)
    total = sum_of_trees(F.col("base"), F.col("trees"), leaf_by_value)
    model = ["series", "refit_id"]
    predictions = (
        scored.join(fitted.select(*model, "base", "trees"), model, "left")
        .withColumn("x", F.array(*columns))
        .withColumn("actual", F.col(TARGET))
        .withColumn("predicted", total)
        .select(*PREDICTIONS.names)
    )
    names = F.array(*[F.lit(c) for c in columns])
    cuts = scored.groupBy(*model).agg(F.max("train_cut").alias("train_cut"))
    models = (
        _importances(fitted, columns)
        .join(cuts, model)
        .withColumn("model", F.to_json(F.struct(names.alias("columns"), "base", "trees")))
        .withColumnRenamed("series", "symbol")
        .select(*MODELS.names)
    )
    return predictions, models


def fit_spread(
    rows: DataFrame,
    columns: list[str],
    params: BoostParams = BoostParams(),
    refits_per_batch: int = REFITS_AT_ONCE,
) -> tuple[DataFrame, DataFrame]:
    """Models and predictions for ``rows`` of ``walk_forward_rows`` or ``holdout_rows``.

    ``rows`` is read several times and should be a stored table. Fitting runs when this is
    called.
    """
    state = rows.select(
        F.col("symbol").alias("series"),
        F.col("row_idx").alias("number"),
        F.col("segment").cast("int").alias("segment"),
        F.col("refits").cast("int").alias("refits"),
        F.col(TARGET).alias("y"),
        F.array(*columns).alias("x"),
    )
    fitted = fit_models(state, len(columns), params, refits_per_batch)
    predictions, models = predictions_and_models(rows, fitted, columns)
    return models, predictions
