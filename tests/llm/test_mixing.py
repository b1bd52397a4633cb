import collections
import re

import pytest

from volspark.llm import mixing


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """Round by round: what is above its cap is shared out among the others by weight."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, rest = {}, set(names), share * sum(sizes.values())
    while open_:
        unit = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if unit * weight[s] > cap * sizes[s]}
        if not full:
            target |= {s: unit * weight[s] for s in open_}
            break
        for s in full:
            target[s] = cap * sizes[s]
            rest -= target[s]
        open_ -= full
    return target


def check(docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    sizes = collections.Counter()
    for r in docs.select("source", "text").collect():
        sizes[r.source] += words(r.text)
    targets = brute_targets(sizes)
    taken, largest = collections.Counter(), collections.Counter()
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source], abs=1e-6)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= largest[s] / 2 + 1e-6
    return rows


def test_targets_and_nearness(some_docs):
    rows = check(some_docs)
    again = mixing.mix(some_docs.repartition(5)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_edge_rows(edge_docs):
    check_rows = mixing.mix(edge_docs).collect()
    assert len(check_rows) == edge_docs.count()
    mixed = mixing.mixed(edge_docs)
    assert mixed.columns == edge_docs.columns
    counts = collections.Counter(r.doc_id for r in mixed.collect())
    for r in check_rows:
        if r.doc_id not in (2, None):
            assert counts[r.doc_id] == r.copies


def test_empty(no_docs):
    assert mixing.mix(no_docs).count() == 0
    assert mixing.mixed(no_docs).columns == no_docs.columns
    assert mixing.mixed(no_docs).count() == 0


def test_order_follows_odds(spark):
    """Documents of higher weight get the extra copy more often."""
    rows = [(i, "w " * (1 if i % 2 else 30), None, "s", 0) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long")
    out = mixing.mix(docs, share=0.5).collect()
    short = [r.copies for r in out if r.size == 1]
    long = [r.copies for r in out if r.size == 30]
    assert sum(long) / len(long) > sum(short) / len(short) + 0.15
