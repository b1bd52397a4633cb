"""Exact top-k by inner product with a pivot-distance index.

Vectors become whole numbers, floor(1024 * x) by default. Some pivots are fitted on a
bounded sample; every vector is keyed by its nearest pivot and its distance to it. Sorted
by distance, the vectors of a pivot form annuli. For a query q, a vector v of pivot p and
the triangle inequality |d(q,p) - d(v,p)| <= d(q,v), the score q.v = (|q|^2 + |v|^2 -
d(q,v)^2) / 2 is at most (|q|^2 + largest |v|^2 of the annulus - gap^2) / 2. A query takes
annuli in order of that bound and stops where the next one is below its k-th best score.

Two passes: each query first searches one shard of its own pivot, which gives a k-th best
score; then it goes only to shards whose bound reaches that score. A shard holds a bounded
share of a pivot's vectors, so a pivot with very many of them, copies included, is many
shards; queries come in blocks of bounded size too. What the driver collects is the sample
and a few numbers per annulus: both bounded by the parameters.

Defined cases: vectors that are null, or hold a null or a non-finite component, take no
part; shorter vectors count as padded with zeros; a null id takes no part; ties go to the
smaller id; rows that repeat an id are candidates of their own, and none is one for its own
id; as a query such an id asks once, with the vector first in the order of stored bytes;
fewer than k candidates give fewer rows; an empty table gives an empty result. A score
beyond a long raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Vectors sampled to fit the pivots, number of pivots, rounds of fitting.
SAMPLE, PIVOTS, ROUNDS = 4_096, 64, 5

#: Annuli per pivot, vectors per shard (about), queries per block (about).
ANNULI, SHARD, QUERY_BLOCK = 32, 16_384, 16_384

#: Slack of the bounds for rounding, relative.
SLACK = 1e-9


def whole_numbers(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, v) of the vectors that take part; v is array<long>."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    infinite = F.lit(float("inf"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == infinite))
    usable = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad
    long = F.transform(v, lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    return vectors.filter(usable).select("vec_id", long.alias("v"))


def packed(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    """The vectors of a batch as rows, padded with zeros."""
    column = batch.column("v")
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    rows = np.zeros((len(sizes), dim), dtype=np.int64)
    rows[np.arange(dim)[None, :] < sizes[:, None]] = flat
    return rows


def fit_pivots(sample: np.ndarray, pivots: int, rounds: int) -> np.ndarray:
    """Means of the sample: farthest points first, then a few rounds of averaging."""
    points = sample.astype(np.float64)
    chosen = [0]
    nearest = np.full(len(points), np.inf)
    while len(chosen) < min(pivots, len(points)):
        nearest = np.minimum(nearest, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
        far = int(nearest.argmax())
        if nearest[far] == 0:
            break
        chosen.append(far)
    means = points[chosen]
    for _ in range(rounds):
        of = distances(points, means).argmin(axis=1)
        for p in range(len(means)):
            if (of == p).any():
                means[p] = points[of == p].mean(axis=0)
    return means


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances, row by pivot, pivot after pivot to bound memory."""
    wide = rows.astype(np.float64)
    return np.stack([np.sqrt(((wide - p) ** 2).sum(axis=1)) for p in pivots], axis=1)


KEYED = "vec_id {kind}, pivot int, dist double, norm double, v binary"


def keyed(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Every vector with its nearest pivot, the distance to it, and its squared norm."""
    dim = pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = packed(batch, dim)
            far = distances(rows, pivots)
            pivot = far.argmin(axis=1) if len(rows) else np.zeros(0, dtype=int)
            norm = (rows.astype(np.float64) ** 2).sum(axis=1)
            yield pa.record_batch(
                [
                    batch.column("vec_id"),
                    pa.array(pivot.astype(np.int32)),
                    pa.array(far[np.arange(len(rows)), pivot]),
                    pa.array(norm),
                    pa.array([r.tobytes() for r in rows], pa.binary()),
                ],
                ["vec_id", "pivot", "dist", "norm", "v"],
            )

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.mapInArrow(run, KEYED.format(kind=kind))


def bounds(
    norm: np.ndarray, to_pivot: np.ndarray, low: np.ndarray, high: np.ndarray, top: np.ndarray
) -> np.ndarray:
    """Highest score of queries (rows) with annuli (columns) of one pivot."""
    gap = np.maximum(0, np.maximum(to_pivot[:, None] - high, low - to_pivot[:, None]))
    best = (norm[:, None] + top - gap**2) / 2
    return best + SLACK * (norm[:, None] + top + to_pivot[:, None] ** 2 + high**2) + 1e-6


def top_of(
    query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query among flat candidates; ties to the smaller id."""
    order = np.lexsort((ids, -scores, query))
    query, ids, scores = query[order], ids[order], scores[order]
    new = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.zeros(0, int)
    place = np.arange(len(query)) - np.repeat(new, np.diff(np.r_[new, len(query)]))
    keep = place < k
    return query[keep], ids[keep], scores[keep]


def search(
    ids: np.ndarray,
    rows: np.ndarray,
    dist: np.ndarray,
    norm: np.ndarray,
    query_ids: np.ndarray,
    queries: np.ndarray,
    to_pivot: np.ndarray,
    floor: np.ndarray,
    k: int,
    annuli: int = ANNULI,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, score) of each query's k best of one pivot's rows, at least ``floor``."""
    order = np.argsort(dist, kind="stable")
    ids, rows, dist, norm = ids[order], rows[order], dist[order], norm[order]
    edges = np.unique(np.linspace(0, len(ids), min(annuli, len(ids)) + 1).astype(int))
    first, last = edges[:-1], edges[1:]
    top = np.maximum.reduceat(norm, first)
    wide = queries.astype(np.float64)
    limit = bounds((wide**2).sum(axis=1), to_pivot, dist[first], dist[last - 1], top)
    turn = np.argsort(-limit, axis=1, kind="stable")
    small = rows.shape[1] * float(np.abs(rows).max(initial=0)) * float(
        np.abs(queries).max(initial=0)
    )
    if small >= 2**63:
        raise ValueError("a score does not fit a long")
    exact = np.float64 if small < 2**53 else np.int64
    rows, wide = rows.astype(exact), queries.astype(exact)
    kth = floor.astype(np.float64)
    best = (np.zeros(0, int), ids[:0], np.zeros(0, np.int64))
    active = np.arange(len(queries))
    for step in range(len(first)):
        active = active[limit[active, turn[active, step]] >= kth[active]]
        if not len(active):
            break
        found = [best]
        at = turn[active, step]
        for ring in np.unique(at):
            asked = active[at == ring]
            part = slice(first[ring], last[ring])
            scores = (wide[asked] @ rows[part].T).astype(np.int64)
            own = query_ids[asked][:, None] == ids[part][None, :]
            row, column = np.nonzero((scores >= kth[asked][:, None]) & ~own)
            found.append((asked[row], ids[part][column], scores[row, column]))
        best = top_of(*(np.concatenate(x) for x in zip(*found)), k)
        full = np.flatnonzero(np.r_[best[0][1:] != best[0][:-1], True]) if len(best[0]) else []
        counts = np.bincount(best[0], minlength=len(queries))
        for end in full:
            if counts[best[0][end]] == k:
                kth[best[0][end]] = max(kth[best[0][end]], best[2][end])
    return best


def _searching(dim: int, k: int):
    def run(part: pa.Table, asked: pa.Table) -> pa.Table:
        def vectors(table: pa.Table) -> np.ndarray:
            data = b"".join(table.column("v").to_pylist())
            return np.frombuffer(data, dtype=np.int64).reshape(-1, dim)

        out = {"query_id": [], "vec_id": [], "score": []}
        if len(part) and len(asked):
            query_ids = asked.column("query_id").to_numpy()
            row, ids, scores = search(
                part.column("vec_id").to_numpy(),
                vectors(part),
                part.column("dist").to_numpy(),
                part.column("norm").to_numpy(),
                query_ids,
                vectors(asked),
                asked.column("to_pivot").to_numpy(),
                asked.column("floor").to_numpy(),
                k,
            )
            out = {"query_id": query_ids[row], "vec_id": ids, "score": scores}
        return pa.table({name: pa.array(x, pa.int64()) for name, x in out.items()})

    return run


def routed(queries: DataFrame, pivots: np.ndarray, rings: dict, nearest: bool) -> DataFrame:
    """Queries at the pivots they need: (pivot, query_id, v, to_pivot, floor).

    ``nearest`` sends each to the pivot nearest to it that has any vectors; else to those
    whose best annulus may reach the query's floor.
    """
    dim = pivots.shape[1]
    numbers = sorted(rings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("v").to_pylist()
            rows = np.frombuffer(b"".join(raw), dtype=np.int64).reshape(-1, dim)
            ids = batch.column("vec_id").to_numpy()
            floor = batch.column("floor").to_numpy()
            far = distances(rows, pivots)
            norm = (rows.astype(np.float64) ** 2).sum(axis=1)
            home = np.array(numbers)[far[:, numbers].argmin(axis=1)] if len(rows) else far[:, 0]
            for p in numbers:
                if nearest:
                    to = np.flatnonzero(home == p)
                else:
                    low, high, top = rings[p]
                    limit = bounds(norm, far[:, p], low, high, top).max(axis=1)
                    to = np.flatnonzero(limit >= floor)
                yield pa.record_batch(
                    [
                        pa.array(np.full(len(to), p, dtype=np.int32)),
                        pa.array(ids[to]),
                        pa.array([raw[i] for i in to], pa.binary()),
                        pa.array(far[to, p]),
                        pa.array(floor[to]),
                    ],
                    ["pivot", "query_id", "v", "to_pivot", "floor"],
                )

    schema = "pivot int, query_id long, v binary, to_pivot double, floor double"
    return queries.select("vec_id", "v", "floor").mapInArrow(run, schema)


def by_pivot(numbers: dict[int, int]) -> Column:
    """A number of each pivot; NULL for others. At most as many as there are pivots."""
    if not numbers:
        return F.lit(None).cast("int")
    pairs = [F.lit(x) for pair in numbers.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), F.col("pivot"))


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query, with ranks; at most k rows per query and shard come in."""
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = 1024,
    pivots: int = PIVOTS,
    sample: int = SAMPLE,
    shard: int = SHARD,
    block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest scores among other rows."""
    spark = vectors.sparkSession
    vectors = whole_numbers(vectors, scale).withColumn("vec_id", F.col("vec_id").cast("long"))
    empty = "query_id long, rank int, vec_id long, score long"
    dim = vectors.agg(F.max(F.size("v"))).first()[0]
    if not dim:
        if dim is None:
            return spark.createDataFrame([], empty)
        dim = 1
    some = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(sample).select("v").toArrow()
    points = np.concatenate([packed(b, dim) for b in some.to_batches()])
    centres = fit_pivots(points, pivots, ROUNDS)
    index = materialize(keyed(vectors, centres), "topk-index")

    # low, high, largest norm per annulus of equal width: at most pivots * ANNULI rows
    spans = index.groupBy("pivot").agg(
        F.count(F.lit(1)).alias("n"), F.min("dist").alias("low"), F.max("dist").alias("high")
    )
    spans = spans.toPandas()
    ring = F.lit(0)
    for row in spans.itertuples():
        width = (row.high - row.low) / ANNULI or 1.0
        number = F.floor((F.col("dist") - F.lit(float(row.low))) / F.lit(float(width)))
        ring = F.when(F.col("pivot") == int(row.pivot), number).otherwise(ring)
    numbers = index.groupBy("pivot", ring.alias("ring")).agg(
        F.min("dist").alias("low"), F.max("dist").alias("high"), F.max("norm").alias("top")
    )
    rings = {
        int(p): tuple(part[c].to_numpy() for c in ("low", "high", "top"))
        for p, part in numbers.toPandas().groupby("pivot")
    }
    shards = {int(r.pivot): int(-(-r.n // shard)) for r in spans.itertuples()}
    place = F.pmod(F.xxhash64("vec_id", "v"), by_pivot(shards)).cast("int")
    stored = index.withColumn("shard", place)

    # an id asks once: repeated rows would count a candidate twice towards the k-th best
    asked = index.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = materialize(asked.withColumn("floor", F.lit(float("-inf"))), "topk-queries")

    def searched(queries: DataFrame, nearest: bool) -> DataFrame:
        to = materialize(routed(queries, centres, rings, nearest), "topk-routed")
        # a pivot's vectors are sent once for so many queries of theirs, and not without any
        numbers = {r["pivot"]: r["count"] for r in to.groupBy("pivot").count().collect()}
        blocks = by_pivot({p: -(-n // block) for p, n in numbers.items()})

        def every(count: Column) -> Column:
            return F.explode(F.sequence(F.lit(0), (count - 1).cast("int")))

        rows = stored.filter("shard = 0") if nearest else stored
        rows = rows.filter(blocks.isNotNull()).withColumn("block", every(blocks))
        shard = F.lit(0) if nearest else every(by_pivot(shards))
        to = to.withColumn("block", F.pmod(F.xxhash64("query_id"), blocks).cast("int"))
        to = to.withColumn("shard", shard)
        key = ["pivot", "shard", "block"]
        return (
            rows.groupBy(*key)
            .cogroup(to.groupBy(*key))
            .applyInArrow(_searching(dim, k), "query_id long, vec_id long, score long")
        )

    first = searched(asked, True)
    kth = F.when(F.count(F.lit(1)) >= k, F.min("score").cast("double"))
    floors = ranked(first, k).groupBy("query_id").agg(kth.alias("kth"))
    floors = materialize(floors.withColumnRenamed("query_id", "of"), "topk-floors")
    again = (
        asked.drop("floor")
        .join(floors, F.col("vec_id") == F.col("of"), "left")
        .withColumn("floor", F.coalesce("kth", F.lit(float("-inf"))))
    )
    return ranked(searched(again, False), k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
