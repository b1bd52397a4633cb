import collections
import random

import numpy as np
import xxhash

from volspark.llm import links, simhash


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    grams = [words] if len(words) < 4 else [words[i : i + 4] for i in range(len(words) - 3)]
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    left, out = set(nodes), {}
    while left:
        start = left.pop()
        group, front = {start}, [start]
        while front:
            a = front.pop()
            near = {b for b in left if linked(a, b)}
            left -= near
            group |= near
            front += near
        for a in group:
            out[a] = min(group)
    return out


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    prints = [(r.doc_id, brute_fingerprint(r.text)) for r in rows]
    near = brute_components({f for _, f in prints}, lambda a, b: (a ^ b).bit_count() <= 4)
    least = collections.defaultdict(list)
    for i, f in prints:
        least[near[f]] += [i] if i is not None else []
    expected = [(i, f"{f:016x}", min(least[near[f]], default=None)) for i, f in prints]
    found = simhash.near_duplicates(docs).select(
        "doc_id", simhash.hexadecimal("fp"), "component_id"
    )
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_against_brute_force(some_docs, edge_docs, no_docs):
    check(some_docs)
    check(edge_docs)
    check(no_docs)


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = " ".join(random.Random(1).choice("a bb ccc dddd".split()) for _ in range(5_000))
    whole = simhash.text_fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 100)
    assert simhash.text_fingerprint(text) == whole == brute_fingerprint(text)


def near_ones(n, seed):
    """Fingerprints, many of them within a few bits of another."""
    rng = random.Random(seed)
    out = {0, (1 << 64) - 1}
    while len(out) < n:
        base = rng.getrandbits(64) if rng.random() < 0.4 else rng.choice(list(out))
        for _ in range(rng.randint(0, 6)):
            base ^= 1 << rng.randrange(64)
        out.add(base)
    return sorted(out)


def test_every_link_is_found(spark):
    values = near_ones(700, 2)
    signed = np.array(values, dtype=np.uint64).view(np.int64).tolist()
    table = spark.createDataFrame([(v,) for v in signed], "fp long")
    near = brute_components(signed, lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4)
    for share in (simhash.SHARE, 5):
        found = links.components(simhash.linked(table, share=share)).collect()
        got = {r.node: r.root for r in found}
        assert {v: got.get(v, v) for v in signed} == near


def test_anchors_cover():
    """Any two within four bits meet at an anchor where one of them is at home."""
    rng = random.Random(3)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(1, 4)):
            b ^= 1 << bit
        pair = np.array([a, b], dtype=np.uint64).view(np.int64)
        row, anchor, home = simhash.anchored(pair)
        at = [{x for x, r in zip(anchor, row) if r == i} for i in (0, 1)]
        homes = {x for x, h in zip(anchor, home) if h}
        assert at[0] & at[1] & homes
        assert sum(home[row == 0]) == len(simhash.BLOCKS)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i + 1, i) for i in range(200)] + [(1000, 1000 + i) for i in range(300)] + [(5, 5)]
    table = spark.createDataFrame(chain, "u long, v long")
    got = {r.node: r.root for r in links.components(table).collect()}
    assert {got[i] for i in range(201)} == {0} and {got[1000 + i] for i in range(300)} == {1000}
    assert links.components(table.limit(0)).count() == 0


def test_stage(edge_docs, no_docs):
    out = simhash.one_of_each(edge_docs)
    assert out.columns == edge_docs.columns
    kept = {r.doc_id for r in out.collect()}
    assert 1 in kept and not kept & {2, 11} and None in kept
    assert simhash.one_of_each(no_docs).count() == 0


def test_stage_tells_rows_with_one_id_apart(spark):
    first, second = "a b c d e f", "quite another text of seven words here"
    rows = [(1, first), (5, first), (5, second), (5, second), (7, second), (None, second)]
    out = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, out.collect())) == [(1, first), (5, second), (5, second)]
