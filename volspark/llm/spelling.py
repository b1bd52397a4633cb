"""Spelling variants: words one edit apart, found through pivotal bigrams.

Bigrams are ordered from rare to common over all words. A word's prefix is its three rarest
bigrams, with every other occurrence of the third one; one edit touches two bigrams at most,
so the prefixes of near words share a bigram. Three bigrams hold two that do not overlap; a
dynamic programme picks such a pair, the pivots, of which one edit spares at least one. Of
two near words, the pivots of the one whose prefix ends earlier in the order (ties: the
smaller word) meet the prefix of the other.

Position limits: with pivots at a and b, an edit

- behind b leaves everything up to b as it is: the other word has b at the same distance
  from its start, after the same letters;
- before a leaves a and all behind it at the same distance from the end;
- from behind a to the end of b leaves a with its start, and what lies behind b;
- within a leaves b with its end, and what lies before a.

So a pivot is looked up in the index of prefixes together with the letters on the side that
stays, with a few letters from the far edge where these stay too, and with a length at most
one off. The index is a join on a hash of these; what meets is verified by its letters. The
programme's costs are the logarithms of how many words such a look-up is likely to meet, so
it takes rare bigrams that lie well inside.

Defined cases: null and empty texts have no words; a null doc_id counts as an empty one in
the hash that decides on a deletion; repeated rows count again; an empty table gives an empty
result. No run, word, link or chain is cut or capped.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from hashlib import sha256
from zlib import crc32

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Letters of words: A-Z and the range U+00C0 to U+00FF; 90 once A-Z is lower-cased, so at
#: most 8,100 bigrams.
LETTERS = "A-Za-zÀ-ÿ"
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

#: Letters taken from the far edge, the most that stay; and the look-up's gain per letter.
EDGES, GAIN = (4, 2, 0), math.log(8)

#: Distinct words a task counts before it hands them on, and words it makes the keys of.
HELD, KEYED = 200_000, 25_000

#: Letters of words that go along with their keys (longer ones send a digest, as their keys may
#: be as many as their letters), and keys that a task holds.
LONG, KEYS = 64, 50_000

#: What digests begin with; no word has it.
DIGEST = "#"


def runs_of(text: str, least: int) -> list[str]:
    """Maximal runs of letters of at least ``least`` code points, A-Z lower-cased."""
    lower = text.encode("utf-8", "surrogatepass").translate(LOWER).decode("utf-8", "surrogatepass")
    return re.findall(f"[{LETTERS}]{{{least},}}", lower)


def misspelt(run: str, doc_id: object, every: int) -> str:
    """The run, one code point deleted where a hash of id and run is a multiple of ``every``."""
    h = crc32(run.encode(), crc32(f"{'' if doc_id is None else doc_id}:".encode()))
    if every and h % every == 0:
        at = h % len(run)
        return run[:at] + run[at + 1 :]
    return run


def word_counts(docs: DataFrame, least: int = 7, twice: int = 2, every: int = 0) -> DataFrame:
    """word, n of all words of at least ``least`` letters that occur ``twice`` or more often.

    ``every`` deletes a letter from one in so many (doc_id, word), 0 from none.
    """

    def handed_on(counts: Counter) -> pa.RecordBatch:
        words = pa.array(list(counts), pa.string())
        return pa.record_batch([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                for found, times in Counter(runs_of(text.as_py() or "", least)).items():
                    word = misspelt(found, doc_id, every)
                    if len(word) >= least:
                        counts[word] += times
                if len(counts) >= HELD:
                    yield handed_on(counts)
                    counts = Counter()
        yield handed_on(counts)

    own = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = own.mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= twice)


def bigram_counts(words: DataFrame) -> dict[str, int]:
    """How often each bigram occurs in ``words``; at most the square of the letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                counts.update(map(str.__add__, word, word[1:]))
        grams = pa.array(list(counts), pa.string())
        yield pa.record_batch([grams, pa.array(list(counts.values()), pa.int64())], ["gram", "n"])

    found = words.select("word").mapInArrow(run, "gram string, n long")
    return {r["gram"]: r["n"] for r in found.groupBy("gram").agg(F.sum("n").alias("n")).collect()}


class Order:
    """Bigrams from rare to common, and what follows from it for a word."""

    def __init__(self, counts: dict[str, int]) -> None:
        self.rank = {g: i for i, g in enumerate(sorted(counts, key=lambda g: (counts[g], g)))}
        self.weight = {g: math.log(n) for g, n in counts.items()}

    def prefix(self, word: str) -> tuple[int, list[int]]:
        """The rank its third rarest bigram has, and the places of all up to that rank."""
        ranks = [self.rank[gram] for gram in map(str.__add__, word, word[1:])]
        last = sorted(ranks)[2]
        return last, [at for at, rank in enumerate(ranks) if rank <= last]

    def pivots(self, word: str, places: list[int]) -> tuple[int, int]:
        """The cheapest two places whose bigrams do not overlap, by dynamic programming.

        ``first`` is the best of the places that end before the one looked at.
        """
        first = pair = None
        waiting = 0
        for b in places:
            while places[waiting] + 2 <= b:
                a = places[waiting]
                cost = self.weight[word[a : a + 2]] - GAIN * (a + edge(a))
                if first is None or cost < first[0]:
                    first = cost, a
                waiting += 1
            if first is not None:
                behind = len(word) - 2 - b
                cost = first[0] + self.weight[word[b : b + 2]] - GAIN * (behind + edge(behind))
                if pair is None or cost < pair[0]:
                    pair = cost, first[1], b
        return pair[1:]


def edge(stays: int) -> int:
    """How many letters of a far edge of ``stays`` letters are looked at."""
    return next(k for k in EDGES if k <= stays)


def key(kind: str, side: int, far: str, size: int) -> int:
    """A look-up: the side that stays with its bigram, the far edge, the word's length."""
    return xxhash.xxh64_intdigest(f"{kind}{size} {side} {far}".encode()) - (1 << 63)


def sides(word: str, ends: Iterable[int]) -> Iterator[int]:
    """Hashes of the beginnings of ``word`` that end at ``ends`` (ascending), in one pass."""
    hashed, done = xxhash.xxh64(), 0
    for end in ends:
        hashed.update(word[done:end].encode())
        done = end
        yield hashed.intdigest()


def pivot_keys(word: str, a: int, b: int) -> Iterator[int]:
    """What words near ``word`` are looked up by."""
    size = len(word)
    behind, before = edge(size - 2 - b), edge(a)
    start, whole_start = sides(word, (a + 2, b + 2))
    end, whole_end = sides(word[::-1], (size - b, size - a))
    wanted = (
        ("start", whole_start, ""),
        ("end", whole_end, ""),
        ("start", start, word[size - behind :]),
        ("end", end, word[:before]),
    )
    for kind, side, far in wanted:
        for other in (size - 1, size, size + 1):
            yield key(kind, side, far, other)


def prefix_keys(word: str, places: list[int]) -> Iterator[int]:
    """What ``word`` is found by."""
    size = len(word)
    for at, side in zip(places, sides(word, [at + 2 for at in places])):
        for k in EDGES:
            if at + 2 + k <= size:
                yield key("start", side, word[size - k :], size)
    back = places[::-1]
    for at, side in zip(back, sides(word[::-1], [size - at for at in back])):
        for k in EDGES:
            if k <= at:
                yield key("end", side, word[:k], size)


def sent_as(word: str) -> str:
    """A word, or the digest of a long one."""
    return word if len(word) <= LONG else DIGEST + sha256(word.encode()).hexdigest()


def near(r: str, s: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point leads from r to s."""
    if len(r) > len(s):
        r, s = s, r
    at = next((i for i, (x, y) in enumerate(zip(r, s)) if x != y), len(r))
    if len(r) == len(s):
        return at < len(r) and r[at + 1 :] == s[at + 1 :]
    return len(s) - len(r) == 1 and r[at:] == s[at + 1 :]


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("word"), batch.column("other"))
        yield batch.filter(pa.array([near(r.as_py(), s.as_py()) for r, s in pairs], pa.bool_()))


def links(words: DataFrame) -> DataFrame:
    """word, n, other, other_n for each pair of near words of ``words`` (word, n), both ways.

    ``words`` has each word once, of three bigrams or more, and is read several times.
    """
    context = words.sparkSession.sparkContext
    shared = context.broadcast(Order(bigram_counts(words)))
    # a word is a few bytes and much work
    words = words.select("word", "n").repartition(
        max(context.defaultParallelism, words.count() // KEYED)
    )

    def keyed(pivotal: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            order = shared.value
            for batch in batches:
                sent = pa.array([sent_as(w) for w in batch.column("word").to_pylist()], pa.string())
                keys, rows, last = [], [], []

                def handed_on(keys=keys, rows=rows, last=last, sent=sent, batch=batch):
                    at = pa.array(rows, pa.int32())
                    columns = [pa.array(keys, pa.int64()), pa.array(last, pa.int32())]
                    columns += [sent.take(at), batch.column("n").take(at)]
                    for held in (keys, rows, last):
                        held.clear()
                    return pa.RecordBatch.from_arrays(columns, ["key", "last", "word", "n"])

                for row, word in enumerate(batch.column("word").to_pylist()):
                    end, places = order.prefix(word)
                    found = (
                        pivot_keys(word, *order.pivots(word, places))
                        if pivotal
                        else prefix_keys(word, places)
                    )
                    for key in found:
                        keys.append(key)
                        rows.append(row)
                        last.append(end)
                        if len(keys) >= KEYS:
                            yield handed_on()
                yield handed_on()

        return words.mapInArrow(run, "key long, last int, word string, n long")

    pivots = keyed(True).alias("r")
    index = keyed(False).alias("s")
    # levenshtein with a bound stops early; -1 where it lies beyond
    one_edit = "levenshtein({}, {}, 1) = 1"
    met = pivots.join(index, "key").filter(
        "(r.last < s.last OR (r.last = s.last AND r.word < s.word)) AND"
        f" (startswith(r.word, '{DIGEST}') OR startswith(s.word, '{DIGEST}')"
        f" OR {one_edit.format('r.word', 's.word')})"
    )
    met = met.select("r.word", "r.n", F.col("s.word").alias("other"), F.col("s.n").alias("other_n"))
    met = met.distinct()
    long = words.filter(F.length("word") > LONG)
    if not long.isEmpty():
        told = F.concat(F.lit(DIGEST), F.sha2(F.col("word").cast("binary"), 256))
        for name in ("word", "other"):
            whole = long.select(told.alias(name), F.col("word").alias("whole"))
            met = met.join(whole, name, "left").withColumn(name, F.coalesce("whole", name))
            met = met.drop("whole")
        met = met.select("word", "n", "other", "other_n")
        # the bounded levenshtein of the JVM is quadratic in long words
        either = F.greatest(F.length("word"), F.length("other")) > LONG
        met = materialize(met, "links")
        met = met.filter(~either).union(met.filter(either).mapInArrow(_near, met.schema))
    ways = [
        F.struct(*[F.col(c).alias(name) for c, name in zip(way, met.columns)])
        for way in (met.columns, ["other", "other_n", "word", "n"])
    ]
    # both ways from one join
    return met.select(F.inline(F.array(*ways)))


def forms(words: DataFrame, times: int = 10) -> DataFrame:
    """word, n, n_near, form, form_n of all ``words``.

    A word's form is its near word of greatest n (ties: the first in code-point order), if
    that occurs ``times`` as often.
    """
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word")))
    found = (
        links(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    )
    found = words.join(found, "word", "left")
    taken = F.col("best.n") <= -times * F.col("n")
    return found.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, F.col("best.word")).alias("form"),
        F.when(taken, -F.col("best.n")).alias("form_n"),
    )


def with_roots(found: DataFrame, most: int, times: int = 10) -> DataFrame:
    """``found`` (word, form, ...) with ``root``, the last word on the way along the forms.

    Each step along a chain multiplies n by ``times``, so no n above ``most`` means few steps;
    every join doubles the steps taken.
    """
    steps = F.col("word").alias("at"), F.col("form").alias("to")
    chain = found.filter("form IS NOT NULL").select(*steps)
    reach, longest = 1, math.log(max(most, 1), times)
    while reach <= longest:
        further = chain.select(F.col("at").alias("to"), F.col("to").alias("beyond"))
        chain = chain.join(further, "to", "left").select(
            "at", F.coalesce("beyond", "to").alias("to")
        )
        reach *= 2
    root = chain.select(F.col("at").alias("word"), F.col("to").alias("root"))
    return found.join(root, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(
    docs: DataFrame, least: int = 7, twice: int = 2, times: int = 10, every: int = 0
) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of ``docs`` (doc_id, text)."""
    if least < 4:
        raise ValueError("words need three bigrams: least must be 4 or more")
    words = materialize(word_counts(docs, least, twice, every), "words")
    found = materialize(forms(words, times), "forms")
    most = words.agg(F.max("n")).first()[0]
    return with_roots(found, most or 1, times)
