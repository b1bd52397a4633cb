import math
import random

import numpy as np
from pyspark.sql import functions as F

from volspark.llm import topk


def brute(rows, k=10):
    good = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.append((i, [math.floor(1024 * x) for x in v]))
    out = []
    for q, a in good:
        if q % 100:
            continue
        scores = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def ours(spark, rows, **how):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = topk.top_k(table, F.col("vec_id") % 100 == 0, **how)
    return sorted(map(tuple, found.collect()))


def some(n, dim=8, seed=1, hot=0):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=dim))], 0) for i in range(n)]
    return [(i, rows[0][1] if i < hot else v, 0) for i, v, _ in rows]


def test_against_brute_force(spark):
    rows = some(900)
    assert ours(spark, rows, pivots=7, shard=50, block=3) == brute([r[:2] for r in rows])


def test_many_copies_of_one_vector(spark):
    rows = some(500, hot=250, seed=2)
    assert ours(spark, rows, pivots=5, shard=40, block=2) == brute([r[:2] for r in rows])


def test_edges(spark):
    rows = some(120, dim=4, seed=3)
    rows += [(200, None, 0), (300, [1.0, None, 0.0, 0.0], 0), (400, [float("nan")] * 4, 0)]
    rows += [(500, [float("inf"), 0.0, 0.0, 0.0], 0), (None, [0.0] * 4, 0), (600, [0.5, 0.5], None)]
    rows += [(700, [], 0), (800, [-0.0001, 0.0, 0.0, 0.0], 0)]
    assert ours(spark, rows, pivots=3) == brute([r[:2] for r in rows])
    few = [(0, [1.0, 2.0], 0), (100, [1.0, 2.0], 0), (7, [1.0, 2.0], 1)]
    assert ours(spark, few) == brute([r[:2] for r in few])
    assert ours(spark, []) == [] and ours(spark, [(1, None, 0)]) == []


def test_repeated_rows_ask_once(spark):
    rows = some(400, seed=6)
    twice = [
        (q, 2 * rank - 1 + more, i, score)
        for q, rank, i, score in brute([r[:2] for r in rows], 5)
        for more in (0, 1)
    ]
    assert ours(spark, rows + rows, pivots=1) == sorted(twice)
    assert ours(spark, rows + rows, pivots=4, shard=60, block=2) == sorted(twice)


def test_search_stops_early():
    """The bounds hold: no annulus is left out that could still score."""
    rng = random.Random(5)
    centres = np.array([[0.0, 0.0], [500.0, 0.0]])
    rows = np.array([[rng.randint(-900, 900), rng.randint(-900, 900)] for _ in range(400)])
    far = topk.distances(rows, centres)
    norm = (rows.astype(float) ** 2).sum(axis=1)
    query = rows[:5]
    low, high = np.array([100.0]), np.array([300.0])
    inside = (far[:, 0] >= 100) & (far[:, 0] <= 300)
    limit = topk.bounds(norm[:5], far[:5, 0], low, high, np.array([norm[inside].max()]))
    assert ((query @ rows[inside].T).max(axis=1) <= limit[:, 0]).all()


def test_columns_of_the_same_names(spark):
    from .conftest import CLASHING

    rows = some(150, seed=9)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    for i, name in enumerate([*CLASHING, "v", "pivot", "shard", "block", "dist", "norm", "floor"]):
        table = table.withColumn(name, F.lit(i))
    found = topk.top_k(table, F.col("vec_id") % 100 == 0, pivots=3, shard=40, block=1)
    assert sorted(map(tuple, found.collect())) == brute([r[:2] for r in rows])


def test_vectors_go_only_where_queries_ask(spark, monkeypatch):
    """Queries all lie at one end; vectors of pivots beyond their reach are not sent again."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=4) * 0.01 + (50 if i % 100 else 60))], 0) for i in range(1000)]
    rows += [(10_001 + i, [float(x) for x in np.float32(rng.normal(size=4) * 0.01 - 50)], 0) for i in range(98)]
    sent = []
    searching = topk._searching

    def counted(dim, k):
        run = searching(dim, k)
        seen = spark.sparkContext.accumulator(0)
        sent.append(seen)

        def counts(part, asked):
            seen.add(len(part))
            return run(part, asked)

        return counts

    monkeypatch.setattr(topk, "_searching", counted)
    assert ours(spark, rows, pivots=2, shard=2000, block=5) == brute([r[:2] for r in rows])
    # ten queries in two blocks: the near end twice in either pass, the far end never
    assert [s.value for s in sent] == [2000, 2000]
