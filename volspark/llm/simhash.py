"""SimHash near-duplicates by anchor-point covering.

Two fingerprints of 64 bits link where they differ in at most four. The bits are cut into
blocks of 23, 23 and 18. Four differing bits cannot be two or more in both of the first
blocks and one or more in the last, so a linked pair agrees up to 1, 1 or 0 bits in one of
them. Per block the anchors are a covering code: the perfect binary Golay code for 23 bits
(4,096 anchors, covering radius 3), all words for 18 bits (radius 0). A fingerprint is
replicated to every anchor within radius + threshold, about 5.3 anchors in a Golay block,
and one in the last. The anchor nearest to one of a pair is then within reach of the other,
so every linked pair meets at the home of one of them; there all 64 bits are compared.

At an anchor the linked ones are not listed as pairs: a search takes each reached
fingerprint out of the group, and what is left is a star per local component. Anchors with
many fingerprints are dealt out: the members fall into k shares by hash, and each pair of
shares is a group of its own. k comes from the counts per anchor, of which there are at
most 270,336 whatever the input.

Equal fingerprints are one row before all that, so copies cost nothing here.

Defined cases: a null text is empty; a text without words has fingerprint zero, linked as
any other; texts of fewer words than a shingle are one shingle; component ids ignore null
doc_ids, and a component with none but null ids has a null id; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import few_at_once, free_name, materialize, one_row
from .links import components

#: Words of a shingle, seed of its hash, greatest number of differing bits.
SHINGLE, SEED, BITS = 4, 42, 4

#: Shift, width and threshold of the blocks.
BLOCKS = ((41, 23, 1), (18, 23, 1), (0, 18, 0))

#: Generator polynomial of the Golay code (fixed value), and its covering radius.
GOLAY, RADIUS = 0b101011100011, 3

#: Members of a share of an anchor's group, about.
SHARE = 4_096

#: Shingles hashed before their bits are added up: bounds memory for long texts.
CHUNK = 65_536


def text_fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit fingerprint: bit set where more than half of the shingles have it set.

    Splitting bytes at white space and lower-casing A-Z is what bytes.split and lower do.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    of = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist())
        hashes = np.array([of(line[a:b], seed) for a, b in spans], dtype=">u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    value = np.packbits(counts * 2 > len(starts))
    return int.from_bytes(value.tobytes(), "big")


def fingerprints(
    docs: DataFrame,
    shingle: int = SHINGLE,
    seed: int = SEED,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The columns ``keep`` and the fingerprint ``fp`` of every row, as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_at_once(batches):
            texts = batch.column("text")
            values = [text_fingerprint(t.as_py(), shingle, seed) for t in texts]
            fp = np.array(values, dtype=np.uint64).view(np.int64)
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.record_batch([*columns, pa.array(fp)], [*keep, "fp"])

    kept = docs.select(*keep)
    return docs.select(*keep, "text").mapInArrow(run, kept.schema.add("fp", "long"))


@lru_cache(maxsize=1)
def golay_homes() -> tuple[np.ndarray, np.ndarray]:
    """For every 11-bit remainder: the one error of at most 3 bits that has it, and all
    errors of at most 4 bits that have it, as rows padded with -1.

    A word minus an error with the word's remainder is a code word.
    """

    bits = 1 << np.arange(23)
    errors = [np.array([0])]
    for _ in range(RADIUS + 1):
        last = errors[-1]
        more = (last[:, None] | bits[None, :]).ravel()
        more = np.unique(more[np.bitwise_count(more) == np.bitwise_count(last[0]) + 1])
        errors.append(more)
    near = np.concatenate(errors)
    of = remainders(near)
    home = np.full(2048, -1)
    small = np.bitwise_count(near) <= RADIUS
    home[of[small]] = near[small]
    order = np.argsort(of, kind="stable")
    sizes = np.bincount(of, minlength=2048)
    reach = np.full((2048, sizes.max()), -1)
    reach[of[order], np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = near[
        order
    ]
    return home, reach


def remainders(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words by the generator."""
    left = words.copy()
    for bit in range(22, 10, -1):
        left ^= np.where(left >> bit & 1, GOLAY << (bit - 11), 0)
    return left


def anchored(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, home): each fingerprint at every anchor within radius + threshold.

    Anchor numbers carry their block's number above the word.
    """
    rows, anchors, homes = [], [], []
    bits = fp.view(np.uint64)
    for number, (shift, width, threshold) in enumerate(BLOCKS):
        word = ((bits >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)
        if not threshold:
            rows.append(np.arange(len(fp)))
            anchors.append(word | number << 32)
            homes.append(np.ones(len(fp), dtype=bool))
            continue
        home, reach = golay_homes()
        of = remainders(word)
        errors = reach[of]
        row, _ = np.nonzero(errors >= 0)
        error = errors[errors >= 0]
        rows.append(row)
        anchors.append(word[row] ^ error | number << 32)
        homes.append(error == home[of][row])
    return np.concatenate(rows), np.concatenate(anchors), np.concatenate(homes)


def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column("fp").to_numpy()
        row, anchor, home = anchored(fp)
        yield pa.record_batch(
            [pa.array(anchor), pa.array(fp[row]), pa.array(home)], ["anchor", "fp", "home"]
        )


def stars(fp: np.ndarray, home: np.ndarray, bits: int = BITS) -> list[tuple[int, int]]:
    """Links (member, least member) of the components among distinct fingerprints.

    Two link within ``bits``, where one of them is at home here. Whatever a search has
    reached is taken out, so each is compared with what is left only.
    """
    values = fp.view(np.uint64)
    order = np.argsort(~home, kind="stable")
    left, at_home = values[order], int(home.sum())
    links = []
    limit = bits
    while at_home:
        front = [(left[0], True)]
        left, at_home = left[1:], at_home - 1
        group = []
        while front:
            value, is_home = front.pop()
            group.append(value)
            # one that is not at home is compared with those that are
            width = len(left) if is_home else at_home
            hit = np.bitwise_count(left[:width] ^ value) <= limit
            found = np.flatnonzero(hit)
            if len(found):
                front += [(left[i], i < at_home) for i in found.tolist()]
                stay = np.ones(len(left), dtype=bool)
                stay[found] = False
                at_home -= int((found < at_home).sum())
                left = left[stay]
        if len(group) > 1:
            signed = np.array(group, dtype=np.uint64).view(np.int64)
            least = int(signed.min())
            links += [(int(v), least) for v in signed.tolist() if v != least]
    return links


def _compare(bits: int):
    def run(group: pa.Table) -> pa.Table:
        fp = group.column("fp").to_numpy()
        home = group.column("home").to_numpy(zero_copy_only=False)
        found = stars(fp, home, bits)
        u = [a for a, _ in found]
        v = [b for _, b in found]
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return run


def linked(distinct: DataFrame, bits: int = BITS, share: int = SHARE) -> DataFrame:
    """Links (u, v) that connect what is connected among distinct fingerprints ``fp``."""
    at = materialize(
        distinct.select("fp").mapInArrow(replicate, "anchor long, fp long, home boolean"),
        "simhash-anchors",
    )
    many = at.groupBy("anchor").count().filter(F.col("count") > share)
    # at most one row per anchor there is: 2 * 4,096 + 2 ** 18
    shares = materialize(
        many.select("anchor", F.ceil(F.col("count") / share).cast("int").alias("k")),
        "simhash-shares",
    )
    rows = at.join(F.broadcast(shares), "anchor", "left").withColumn("k", F.coalesce("k", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("k")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("k") - 1))
    rows = rows.withColumn("own", own).withColumn("other", other)
    rows = rows.select(
        "anchor",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        "fp",
        "home",
    )
    # many comparisons for few bytes: not left to be packed into few tasks by their size
    tasks = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(tasks, "anchor", "i", "j")
    return rows.groupBy("anchor", "i", "j").applyInArrow(_compare(bits), "u long, v long")


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    seed: int = SEED,
    bits: int = BITS,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The columns ``keep``, fp and component_id (least doc_id it reaches by links) of every row.

    ``keep`` includes doc_id.
    """
    found = with_roots(docs, shingle, seed, bits, keep)
    return found.select(*keep, "fp", "component_id")


def with_roots(
    docs: DataFrame,
    shingle: int = SHINGLE,
    seed: int = SEED,
    bits: int = BITS,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``near_duplicates`` with root, the least fingerprint of the component, beside."""
    if not 0 <= bits <= BITS:
        raise ValueError(f"the blocks cover up to {BITS} differing bits")
    ids = materialize(fingerprints(docs, shingle, seed, keep), "simhash-fingerprints")
    classes = materialize(
        ids.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes"
    )
    roots = components(linked(classes, bits)).withColumnRenamed("node", "fp")
    members = classes.join(roots, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"
    )
    named = members.groupBy("root").agg(F.min("least").alias("component_id"))
    of = members.select("fp", "root").join(named, "root").select("fp", "root", "component_id")
    return ids.join(of, "fp", "left").select(*keep, "fp", "root", "component_id")


def hexadecimal(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id names their component. All columns.

    Rows are told apart by id and text: of several with one id, each stays or goes by its
    own component. Rows that repeat both, or share an id within one component, stay
    together; a row without an id stays only where its whole component has none.
    """
    row = free_name(docs, "row")
    slim = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    found = near_duplicates(slim, keep=("doc_id", "text_key"))
    drop = found.filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    drop = drop.select(F.col("doc_id").alias("gone"), F.col("text_key").alias("gone_key")).distinct()
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row))
    same = F.col(f"{row}.doc_id").eqNullSafe(F.col("gone")) & (
        F.xxhash64(F.col(f"{row}.text")) == F.col("gone_key")
    )
    return packed.join(drop.hint("merge"), same, "left_anti").select(f"{row}.*")


def one_of_each_component(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for every component, all columns, also where ids repeat or are null.

    Of the rows with the component's least id, those with the least hash of the text stay; of
    rows that repeat id and text, one.
    """
    row = free_name(docs, "row")
    slim = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    found = materialize(with_roots(slim, keep=("doc_id", "text_key")), "simhash-found")
    least = F.col("doc_id").eqNullSafe(F.col("component_id"))
    chosen = found.filter(least).groupBy("root").agg(
        F.min("text_key").alias("chosen_key"), F.count(F.lit(1)).alias("n")
    )
    # by root and key: what stays, and how often
    found = found.join(chosen, "root").withColumn(
        "stays", least & (F.col("text_key") == F.col("chosen_key"))
    )
    pairs = found.filter(~F.col("stays") | (F.col("n") > 1)).groupBy("doc_id", "text_key").agg(
        F.first("stays").alias("stays"), F.count(F.lit(1)).alias("n")
    )
    pairs = pairs.filter(~F.col("stays") | (F.col("n") > 1))
    pairs = materialize(
        pairs.select(F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key"), "stays"),
        "simhash-pairs",
    )
    key = free_name(docs, "key")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row))
    packed = packed.withColumn(key, F.xxhash64(F.col(f"{row}.text")))
    same = F.col(f"{row}.doc_id").eqNullSafe(F.col("of_id")) & (F.col(key) == F.col("of_key"))
    left = packed.join(pairs.hint("merge"), same, "left_anti").select(row)
    again = pairs.filter("stays")
    if not again.isEmpty():
        rows = packed.join(again.hint("merge"), same)
        left = left.unionByName(one_row(rows, row, ["of_id", "of_key"]))
    return left.select(f"{row}.*")
