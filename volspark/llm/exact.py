"""Exact duplicates: binary-fuse filters of frozen snapshots, exact buckets, byte checks.

Documents arrive in batches. A finished batch is frozen as a snapshot: one row per digest
in hash buckets, and per bucket a static binary-fuse filter (three positions and one byte
per key, 1.2 bytes or less a key). The digests of the next batch are grouped on their own,
once, and screened by the filters; only those a filter lets through are joined to the exact
buckets. Every class with more than one member, within a batch or across, is then checked
byte by byte: rows count as equal only where their texts are.

Only digests travel until then; texts are shuffled once, for that check. Copies meet
partial aggregation before any shuffle, so a class of any size is a few rows per task.
Rows join classes by sorting at any size: classes grow with the rows, so a broadcast would
only hold for small inputs, and AQE splits a class whose rows make a partition too large.

Defined cases: null text is empty text; the largest doc_id of a class stays, null being
smaller than any; where all ids of a class are null, keep_id is null and all of them stay.
Rows that repeat an id and its text stay together. Different texts with one digest are
classes of their own, told apart by a second hash and the length; where those agree too,
the run fails rather than merge them. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize, one_row

#: Keys of a bucket that a filter is built for, about; buckets there are at least.
BUCKET_KEYS, LEAST_BUCKETS = 65_536, 64

#: Shares a class's rows are dealt out to for the byte check.
SALTS = 16

FILTER_SCHEMA = "bucket long, seed long, segment long, segments long, bytes binary"


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


# A binary-fuse filter: key k has positions in three neighbouring segments; the bytes at
# them xor to the key's fingerprint.


def scrambled(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well mixed bits per key (the finishing steps of a multiply-xorshift hash)."""
    x = keys + np.uint64(seed)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def positions(mixed: np.ndarray, segment: int, segments: int) -> np.ndarray:
    """Three slots per key, shape (3, n)."""
    span = np.uint64(segment * segments)
    first = ((mixed >> np.uint64(32)) * span) >> np.uint64(32)
    mask = np.uint64(segment - 1)
    second = first + np.uint64(segment)
    third = second + np.uint64(segment)
    return np.stack(
        [first, second ^ ((mixed >> np.uint64(18)) & mask), third ^ (mixed & mask)]
    ).astype(np.int64)


def prints(mixed: np.ndarray) -> np.ndarray:
    return ((mixed ^ (mixed >> np.uint64(32))) & np.uint64(0xFF)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, np.ndarray]:
    """(seed, segment, segments, bytes) of a filter over distinct 64-bit keys.

    Keys are peeled in rounds: slots that one key alone still uses give that key its slot.
    Where a seed leaves a knot, the next seed is tried with a little more room.
    """
    n = len(keys)
    seed = 0
    while True:
        segment = 1 << max(2, int(np.log(max(n, 2)) / np.log(3.33) + 2.25))
        room = (1.125 if n > 1_000 else 1.4) + 0.05 * seed
        size = int(n * max(room, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2))))
        segments = max(1, -(-size // segment) - 2)
        mixed = scrambled(keys, seed)
        where = positions(mixed, segment, segments)
        slots = segment * (segments + 2)
        used = np.bincount(where.ravel(), minlength=slots)
        who = np.zeros(slots, dtype=np.int64)
        numbers = np.arange(n)
        for row in where:
            np.bitwise_xor.at(who, row, numbers)
        rounds = []
        peeled = 0
        while True:
            alone = np.flatnonzero(used == 1)
            if not len(alone):
                break
            owners, pick = np.unique(who[alone], return_index=True)
            rounds.append((owners, alone[pick]))
            peeled += len(owners)
            for row in where:
                np.subtract.at(used, row[owners], 1)
                np.bitwise_xor.at(who, row[owners], owners)
        if peeled == n:
            break
        seed += 1
    table = np.zeros(slots, dtype=np.uint8)
    wanted = prints(mixed)
    for owners, slot in reversed(rounds):
        at = where[:, owners]
        # the key's own slot is still 0 here, so it drops out of the xor
        table[slot] = wanted[owners] ^ table[at[0]] ^ table[at[1]] ^ table[at[2]]
    return seed, segment, segments, table


def let_through(
    keys: np.ndarray, seed: int, segment: int, segments: int, table: np.ndarray
) -> np.ndarray:
    """Whether each key may be in the set: true for all that are, for 1 in 256 others."""
    mixed = scrambled(keys, seed)
    at = positions(mixed, segment, segments)
    return prints(mixed) == table[at[0]] ^ table[at[1]] ^ table[at[2]]


def _keys(table: pa.Table) -> np.ndarray:
    return table.column("key").to_numpy().astype(np.int64).view(np.uint64)


def _freeze(table: pa.Table) -> pa.Table:
    seed, segment, segments, data = build_filter(np.unique(_keys(table)))
    return pa.table(
        {
            "bucket": table.column("bucket")[:1],
            "seed": pa.array([seed], pa.int64()),
            "segment": pa.array([segment], pa.int64()),
            "segments": pa.array([segments], pa.int64()),
            "bytes": pa.array([data.tobytes()], pa.binary()),
        }
    )


def _screen(incoming: pa.Table, filters: pa.Table) -> pa.Table:
    passed = np.zeros(len(incoming), dtype=bool)
    if len(incoming):
        keys = _keys(incoming)
        for row in filters.to_pylist():
            data = np.frombuffer(row["bytes"], dtype=np.uint8)
            passed |= let_through(keys, row["seed"], row["segment"], row["segments"], data)
    return incoming.select(["digest"]).filter(pa.array(passed))


def grouped(rows: DataFrame, buckets: int) -> DataFrame:
    """One row per digest of a batch: bucket, key, digest, n."""
    one = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    key = F.xxhash64("digest")
    return one.select(F.pmod(key, F.lit(buckets)).alias("bucket"), key.alias("key"), "digest", "n")


def freeze(classes: DataFrame) -> DataFrame:
    """The filters of a snapshot, one per bucket."""
    return classes.select("bucket", "key").groupBy("bucket").applyInArrow(_freeze, FILTER_SCHEMA)


def screen(incoming: DataFrame, filters: DataFrame) -> DataFrame:
    """The digests of a batch that the filters let through."""
    rows = incoming.select("bucket", "key", "digest").groupBy("bucket")
    return rows.cogroup(filters.groupBy("bucket")).applyInArrow(_screen, "digest string")


def repeated_digests(ids: DataFrame, batches: int, buckets: int) -> DataFrame:
    """Digests that occur more than once, within a batch or across batches."""
    snapshots, more = [], []
    for batch in range(batches):
        classes = materialize(
            grouped(ids.filter(F.col("batch") == batch), buckets), "exact-snapshot"
        )
        more.append(classes.filter("n > 1").select("digest"))
        for snapshot, filters in snapshots:
            passed = screen(classes, filters)
            more.append(passed.join(snapshot.select("digest"), "digest", "left_semi"))
        if batch < batches - 1:
            snapshots.append((classes, materialize(freeze(classes), "exact-filters")))
    found = more[0]
    for other in more[1:]:
        found = found.unionByName(other)
    return materialize(found.distinct(), "exact-repeated")


CLASS = ["digest", "text_key", "text_length"]


def named(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """doc_id, text without nulls, and the three columns that name its class."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id",
        text.alias("text"),
        digest(text).alias("digest"),
        F.xxhash64(text).alias("text_key"),
        F.length(text).alias("text_length"),
    )


def classes_of(
    docs: DataFrame, batches: int = 2, digest: Callable[[Column], Column] = sha256
) -> tuple[DataFrame, DataFrame]:
    """(ids, classes): doc_id and class of every row; keep_id and group_size of every
    class of more than one row, checked byte by byte.

    The batches here are shares of the ids by hash; a caller with real batches freezes
    each as it comes.
    """
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    ids = materialize(
        named(docs, digest).select("doc_id", *CLASS, batch.alias("batch")), "exact-ids"
    )
    buckets = max(LEAST_BUCKETS, -(-ids.count() // BUCKET_KEYS))
    repeated = repeated_digests(ids, batches, buckets)
    # a class's rows come together in up to SALTS tasks, each of which hands on one row a text
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    salted = repeated.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = salted.withColumn("salt", F.col("salt").cast("long"))
    same = (
        named(docs, digest)
        .withColumn("salt", salt)
        .join(salted.hint("merge"), ["digest", "salt"], "left_semi")
        .groupBy(*CLASS, "text")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("size"))
    )
    one_text = F.when(
        F.count(F.lit(1)) > 1, F.raise_error(F.lit("different texts agree in both hashes"))
    ).otherwise(F.sum("size"))
    checked = same.groupBy(*CLASS).agg(
        F.max("keep_id").alias("keep_id"), one_text.cast("long").alias("group_size")
    )
    return ids, materialize(checked, "exact-classes")


def exact_duplicates(
    docs: DataFrame, batches: int = 2, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """One row per document: doc_id, digest, keep_id, group_size, kept."""
    ids, checked = classes_of(docs, batches, digest)
    rows = ids.join(checked.hint("merge"), CLASS, "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return rows.select(
        "doc_id",
        "digest",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
    )


def without_exact_duplicates(docs: DataFrame, batches: int = 2) -> DataFrame:
    """The rows of ``docs`` that stay, all columns."""
    _, checked = classes_of(docs, batches)
    row = free_name(docs, "row")
    return staying(docs, checked, row).select(f"{row}.*")


def staying(docs: DataFrame, checked: DataFrame, row: str) -> DataFrame:
    """The rows whose id is the greatest of their class, packed, with the columns of classes."""
    text = F.coalesce(F.col(f"{row}.text"), F.lit(""))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row))
    packed = packed.select(
        row,
        sha256(text).alias("digest"),
        F.xxhash64(text).alias("text_key"),
        F.length(text).alias("text_length"),
    )
    joined = packed.join(checked.hint("merge"), CLASS, "left")
    stays = F.col("group_size").isNull() | F.col(f"{row}.doc_id").eqNullSafe(F.col("keep_id"))
    return joined.filter(stays)


def one_of_each_text(docs: DataFrame, batches: int = 2) -> DataFrame:
    """One row of ``docs`` for every text, all columns, also where ids repeat or are null.

    Only the rows of classes whose greatest id several rows have, or none, are compared.
    """
    ids, checked = classes_of(docs, batches)
    same = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    many = ids.join(checked.hint("merge"), CLASS).filter(same).groupBy(*CLASS).count()
    many = materialize(
        many.filter(F.col("count") > 1).select(*CLASS, F.lit(True).alias("several")), "exact-several"
    )
    row = free_name(docs, "row")
    if many.isEmpty():
        return staying(docs, checked, row).select(f"{row}.*")
    rows = staying(docs, checked.join(many, CLASS, "left"), row)
    alone = rows.filter(F.col("several").isNull()).select(row)
    picked = one_row(rows.filter("several"), row, CLASS)
    return alone.unionByName(picked).select(f"{row}.*")
