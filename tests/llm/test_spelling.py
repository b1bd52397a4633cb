"""Spelling variants against all pairs of words."""

import random
import re
from collections import Counter
from zlib import crc32

import pytest

from volspark.llm import spelling
from volspark.llm.spelling import Order

COLUMNS = ("word", "n", "n_near", "form", "form_n", "root")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words_of(rows, least, twice, every):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode()) & 0xFFFFFFFF
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= twice}


def one_edit(a, b):
    """By trying every edit."""
    letters = set(a + b)
    made = {a[:i] + a[i + 1 :] for i in range(len(a))}
    made |= {a[:i] + c + a[i + 1 :] for i in range(len(a)) for c in letters}
    made |= {a[:i] + c + a[i:] for i in range(len(a) + 1) for c in letters}
    return a != b and b in made


def brute(words, times=10):
    near = {w: [o for o in words if abs(len(o) - len(w)) < 2 and one_edit(w, o)] for w in words}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[word] = best if best is not None and words[best] >= times * words[word] else None
    found = set()
    for word, n in words.items():
        root = word
        while form[root] is not None:
            root = form[root]
        own = form[word]
        found.add((word, n, len(near[word]), own, None if own is None else words[own], root))
    return found


def rows_of(df):
    found = [tuple(r[c] for c in COLUMNS) for r in df.collect()]
    assert len(found) == len(set(found))
    return set(found)


def noisy_rows(seed, size, alphabet):
    """Words in clusters of edits, some of them much more frequent."""
    rng = random.Random(seed)
    words = []
    for _ in range(size):
        word = "".join(rng.choice(alphabet) for _ in range(rng.randint(7, 12)))
        words += [word] * rng.choice([1, 2, 30, 400])
        for _ in range(rng.randint(0, 6)):
            i, c = rng.randrange(len(word) + 1), rng.choice(alphabet)
            word = rng.choice([word[:i] + c + word[i:], word[:i] + word[i + 1 :], word[:i] + c + word[i + 1 :]])
            words += [word] * rng.choice([1, 2, 3, 25])
    rng.shuffle(words)
    return [(i, rng.choice([" ", "-", "1"]).join(words[i::40])) for i in range(40)]


@pytest.mark.parametrize("seed,alphabet", [(1, "ab"), (2, "abcé"), (3, "abcdefghijklmnopqrstuvwxyzß÷")])
def test_variants_equal_all_pairs(spark, seed, alphabet):
    rows = noisy_rows(seed, 25, alphabet)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = rows_of(spelling.variants(docs, every=31))
    wanted = brute(words_of(rows, 7, 2, 31))
    assert found == wanted
    assert any(f[3] for f in found)


def test_some_documents(spark, some_docs):
    rows = [(r.doc_id, r.text) for r in some_docs.select("doc_id", "text").limit(60).collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(spelling.variants(docs, every=31)) == brute(words_of(rows, 7, 2, 31))


def test_edge_rows(spark, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()]
    # short words and single ones too, so that the odd rows have any
    found = rows_of(spelling.variants(edge_docs, least=4, twice=1))
    assert found == brute(words_of(rows, 4, 1, 0))
    assert spelling.variants(no_docs).count() == 0
    with pytest.raises(ValueError, match="three bigrams"):
        spelling.variants(no_docs, least=3)


def test_very_long_runs(spark):
    """Work grows with a run's length, also where one bigram fills it."""
    same, mixed = "a" * 200_000, "ab" * 100_000
    texts = [same, same, same + "a", same + "a", mixed, mixed, mixed[1:], mixed[1:]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.word: r.n_near for r in spelling.variants(docs).collect()}
    assert found == {same: 1, same + "a": 1, mixed: 1, mixed[1:]: 1}


def test_forms_lead_to_the_last(spark):
    """A chain of forms as long as counts allow."""
    chain = ["abcdefg" + "h" * i for i in range(5)]
    words = [(w, 3 * 10**i) for i, w in enumerate(chain)] + [("zzzzzzzz", 5)]
    found = spelling.forms(spark.createDataFrame(words, "word string, n long"))
    rooted = spelling.with_roots(found, most=3 * 10**4)
    assert {r.word: r.root for r in rooted.collect()} == dict.fromkeys(chain, chain[-1]) | {
        "zzzzzzzz": "zzzzzzzz"
    }


def test_pivots_are_the_cheapest_disjoint_pair():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(7, 14))) for _ in range(300)]
    counts = Counter(w[i : i + 2] for w in words for i in range(len(w) - 1))
    order = Order(counts)
    for word in words:
        last, places = order.prefix(word)
        assert len(places) >= 3 and max(order.rank[word[i : i + 2]] for i in places) == last

        def cost(a, b, word=word):
            behind = len(word) - 2 - b
            return (
                order.weight[word[a : a + 2]] - spelling.GAIN * (a + spelling.edge(a))
                + order.weight[word[b : b + 2]] - spelling.GAIN * (behind + spelling.edge(behind))
            )

        a, b = order.pivots(word, places)
        assert b >= a + 2
        best = min(cost(x, y) for x in places for y in places if y >= x + 2)
        assert cost(a, b) == pytest.approx(best)


def test_long_words_by_their_digests(spark):
    """Around the length from which words are sent as digests."""
    rng = random.Random(11)
    words = {}
    for size in (62, 63, 64, 65, 66):
        for _ in range(6):
            word = "".join(rng.choice("abcde") for _ in range(size))
            for made in (word, word[:30] + word[31:], word + "e", "x" + word[1:]):
                words[made] = rng.choice([2, 3, 50])
    docs = spark.createDataFrame(
        [(i, " ".join([w] * n)) for i, (w, n) in enumerate(words.items())], "doc_id long, text string"
    )
    assert rows_of(spelling.variants(docs)) == brute(words)
