import collections
import hashlib

import numpy as np
from pyspark.sql import functions as F

from volspark.llm import exact


def brute(rows):
    groups = collections.defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, digest, keep, len(ids), i == keep) for i in ids]
    return sorted(out, key=repr)


def check(docs, **how):
    got = exact.exact_duplicates(docs, **how)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_against_brute_force(some_docs, edge_docs, no_docs):
    check(some_docs)
    check(some_docs, batches=1)
    check(edge_docs, batches=3)
    check(no_docs)


def test_texts_with_one_digest_stay_apart(some_docs):
    weak = exact.exact_duplicates(some_docs, digest=lambda text: F.substring(F.md5(text), 1, 1))
    sha = exact.exact_duplicates(some_docs)
    columns = ["doc_id", "keep_id", "group_size", "kept"]
    assert sorted(map(tuple, weak.select(columns).collect())) == sorted(
        map(tuple, sha.select(columns).collect())
    )


def test_stage(edge_docs, no_docs):
    out = exact.without_exact_duplicates(edge_docs)
    assert out.columns == edge_docs.columns
    rows = [(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()]
    assert collections.Counter(r.doc_id for r in out.collect()) == collections.Counter(
        i for i, _, _, _, kept in brute(rows) if kept
    )
    assert exact.without_exact_duplicates(no_docs).count() == 0


def test_filters_let_all_members_through():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 10, 1000, 30_000):
        keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.int64).view(np.uint64))
        made = exact.build_filter(keys)
        assert exact.let_through(keys, *made).all()
        others = rng.integers(0, 1 << 63, 20_000, dtype=np.int64).view(np.uint64)
        assert exact.let_through(others, *made).mean() < 0.02
    assert len(made[3]) < 1.35 * len(keys)
