"""The trie of conversations against one built turn by turn."""

import hashlib
import random
import re
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from volspark.llm import trie

from .conftest import CLASHING

TURNS = "conv_id long, turn long, role string, text string"


def words_in(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def rebuilt(rows, family):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            told = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            place = (turn is not None, turn or 0, words_in(text), told[:32])
            own.setdefault(conv, []).append((place, role, text))
    own = {c: [t[1:] for t in sorted(turns)] for c, turns in own.items()}
    if not family:
        return own
    made = {}
    for conv, turns in own.items():
        h = crc32(str(conv).encode()) % 4
        base = conv - int(abs(conv) % family * (1 if conv >= 0 else -1))
        made[conv] = own.get(base, [])[:h] + turns[h:]
    return made


def brute(rows, family):
    sequences = rebuilt(rows, family)
    members = {}
    for conv, turns in sequences.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(conv)
    found = {}
    for node in sorted(members, key=len, reverse=True):
        convs = members[node]
        saved = (len(convs) - 1) * words_in(node[-1][1]) if node else 0
        ends = sorted(c for c in convs if len(sequences[c]) == len(node))
        own = found.setdefault(node, {"kids": 0, "leaves": 0, "saved": 0})
        own |= {
            "conv": min(convs),
            "n": len(convs),
            "sha": hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        }
        own["saved"] += saved
        own["leaves"] = own["leaves"] or 1
        if node:
            above = found.setdefault(node[:-1], {"kids": 0, "leaves": 0, "saved": 0})
            above["kids"] += 1
            above["leaves"] += own["leaves"]
            above["saved"] += own["saved"]
    return {
        (
            own["conv"], len(node), found[node[:-1]]["conv"] if node else None, own["n"],
            own["kids"], own["leaves"], own["saved"], own["sha"],
        )
        for node, own in found.items()
    }


def rows_of(df):
    found = [tuple(r[c] for c in trie.COLUMNS) for r in df.collect()]
    assert len(found) == len(set(found))
    return set(found)


def talks(seed, convs, texts, longest):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(-60, 4 * convs), convs):
        shared = rng.randrange(longest)
        for turn in range(rng.choice([shared, rng.randrange(longest)])):
            text = f"{' word' * (turn % 4)} {rng.choice(texts)}"
            rows.append((conv, turn, rng.choice(["user", "bot"]) if turn > 1 else "user", text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "cells,fewest,shard", [(4_000_000, 64, 16_000_000), (60, 8, 3_000), (20, 4, 800)]
)
@pytest.mark.parametrize("family", [0, 20])
def test_nodes_equal_those_built_turn_by_turn(spark, monkeypatch, cells, fewest, shard, family):
    """With blocks so small that nodes of every depth are put together again, in rounds."""
    for name, value in (("CELLS", cells), ("FEWEST", fewest), ("SHARD", shard)):
        monkeypatch.setattr(trie, name, value)
    rows = talks(1, 120, ["a", "b"], 9)
    turns = spark.createDataFrame(rows, TURNS)
    assert rows_of(trie.prefix_trie(trie.sequences(turns, family))) == brute(rows, family)


def test_a_third_of_all_conversations_is_one(spark, monkeypatch):
    """Copies lie in many blocks; the ids that end at their node are hashed in order."""
    monkeypatch.setattr(trie, "CELLS", 100)
    monkeypatch.setattr(trie, "FEWEST", 8)
    rows = [(c, t, "user", f"same {t}") for c in range(0, 300, 3) for t in range(3)]
    rows += [(c, 0, "user", f"own {c}") for c in range(300) if c % 3]
    rows += [(1000, t, "user", f"same {t}") for t in range(50)]
    turns = spark.createDataFrame(rows, TURNS).repartition(5)
    assert rows_of(trie.prefix_trie(trie.sequences(turns))) == brute(rows, 0)


def test_some_conversations(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(trie.prefix_trie(trie.sequences(turns, 20))) == brute(rows, 20)


def test_edge_rows(spark):
    long = "many words " * 30_000
    rows = [
        (1, 0, "user", "hello"),
        (1, None, None, None),
        (1, None, "user", ""),
        (1, 1, "bot", long),
        (1, 1, "bot", long),
        (2, 5, "user", "tie a"),
        (2, 5, "user", "tie b"),
        (2, 5, "bot", "tie"),
        (3, 0, "use", "rhello"),
        (4, None, None, None),
        (20, 0, "user", "日本語 😀"),
        (21, 0, "user", "a\u0085b"),
        (-7, 0, "user", "hello"),
        (2**62, 0, "user", "hello"),
        (None, 0, "user", "no conversation"),
    ]
    turns = spark.createDataFrame(rows, TURNS)
    for i, name in enumerate([*CLASHING, "base", "conv", "own", "head", "made", "at", "kind"]):
        if name not in turns.columns:
            turns = turns.withColumn(name, F.lit(i))
    for family in (0, 20):
        assert rows_of(trie.prefix_trie(trie.sequences(turns, family))) == brute(rows, family)


def test_conversations_without_turns_are_members_of_the_root(spark):
    """Their head is absent, and all of their own turns are replaced by it."""
    convs = [c for c in range(21, 40) if crc32(str(c).encode()) % 4 == 3][:2]
    rows = [(c, 0, "user", "only") for c in convs]
    turns = spark.createDataFrame(rows, TURNS)
    found = rows_of(trie.prefix_trie(trie.sequences(turns, 20)))
    assert found == brute(rows, 20) and len(found) == 1


def test_no_conversations(spark):
    assert trie.prefix_trie(trie.sequences(spark.createDataFrame([], TURNS), 20)).count() == 0


def test_many_turns_beside_few(spark):
    rows = [(1, t, "user", str(t)) for t in range(3000)]
    rows += [(2, t, "user", str(t)) for t in range(2500)]
    rows += [(c, 0, "user", "0") for c in range(3, 60)]
    turns = spark.createDataFrame(rows, TURNS)
    found = rows_of(trie.prefix_trie(trie.sequences(turns)))
    assert len(found) == 3001
    assert {f[:6] for f in found if f[1] in (0, 1, 2500, 2501)} == {
        (1, 0, None, 59, 1, 1), (1, 1, 1, 59, 1, 1), (1, 2500, 1, 2, 1, 1), (1, 2501, 1, 1, 1, 1),
    }
