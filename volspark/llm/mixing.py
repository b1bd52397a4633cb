"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words. A document is expected target / size of its
source times; the whole part of that are copies every document gets, the rest is drawn:
each document has a random number u, and the documents of a source are ordered by
u / (1 - u) divided by their inclusion odds. The first ones, as many as fill the source's
open words, get one more copy. Inclusion odds are the source's p / (1 - p) times the
document's weight, so longer documents (or those a caller weights) come sooner.

The order is cut by a threshold on a 48-bit form of that ratio. It is found by histograms
(12 bits at a time), so no source, however large, is ever sorted in one task, and a
document's copies follow from its own row and the row of its source.

Defined cases: a null text has 0 words; null is a source of its own, last in order; a
source without words has target 0 and its documents no copies; documents whose id and text
are equal have the same u and are taken together or not at all; an empty table gives an
empty result. Columns beside those asked for are passed by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, materialize, word_count

#: Bits of the order key, and bits found by one histogram.
KEY_BITS, STEP_BITS = 48, 12
TOP_KEY = (1 << KEY_BITS) - 1


def targets(
    sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: int = 2
) -> DataFrame:
    """(source, source_size, target, whole, open_words, odds) from (source, size).

    Sources in order of code points, null last, take ``weights`` in turn and share
    ``share`` times all words. No target exceeds ``cap`` times its source; what is above
    goes to the others by weight. That fixed point is min(cap * size, level * weight),
    with the highest level that any prefix of the sources, sorted by where they fill up,
    leaves for the rest. The windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turns = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("rank", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(turns, (F.col("rank") % len(weights) + 1).cast("int"))
    )
    per = per.withColumn("limit", F.lit(float(cap)) * F.col("source_size"))
    everything = Window.partitionBy()
    filling = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        F.lit(float(share)) * F.sum("source_size").over(everything)
        - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    ) / (
        F.sum("weight").over(everything)
        - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    per = per.withColumn("level", level)
    per = per.withColumn("level", F.max("level").over(everything))
    target = F.least("limit", F.col("level") * F.col("weight"))
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
    per = per.withColumn("target", target).withColumn(
        "expected", F.coalesce(expected, F.lit(0.0))
    )
    part = F.col("expected") - F.col("whole")
    return per.withColumn("whole", F.floor("expected")).select(
        "source",
        "source_size",
        "target",
        "whole",
        (F.col("target") - F.col("whole") * F.col("source_size")).alias("open_words"),
        F.when(part > 0, part / (1 - part)).alias("odds"),
    )


def draw(doc_id: Column, text: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the seed, id and text only: 52 bits of an MD5."""
    name = F.concat_ws(":", F.lit(str(seed)), doc_id.cast("string"), text)
    bits = F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("long")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def order_key(u: Column, odds: Column, weight: Column) -> Column:
    """The ratio of random odds to inclusion odds, mapped to 48 bits in the same order."""
    ratio = (u / (1 - u)) / (odds * weight)
    key = F.floor(ratio / (1 + ratio) * F.lit(float(1 << KEY_BITS))).cast("long")
    return F.coalesce(F.least(key, F.lit(TOP_KEY)), F.lit(TOP_KEY))


def measured(docs: DataFrame, seed: int, weight: Column | None) -> DataFrame:
    """(doc_id, source, size, u, weight) of documents; by default weight is sqrt(size)."""
    size = word_count(F.col("text"))
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        size.alias("size"),
        draw(F.col("doc_id"), F.col("text"), seed).alias("u"),
        (F.sqrt(F.greatest(size, F.lit(1))) if weight is None else weight).alias("weight"),
    )


def cuts(slim: DataFrame, per: DataFrame) -> DataFrame:
    """``per`` with ``cut``: documents of a source with a key up to it get one more copy.

    Words are added up in key order; a document is in where at least half of it still
    fits. Each round splits the bin that holds that point into 4,096.
    """
    open_ = per.filter("open_words > 0").select(
        F.col("source").alias("of"), "odds", "open_words"
    )
    keyed = materialize(
        slim.join(open_, F.col("source").eqNullSafe(F.col("of"))).select(
            F.col("source"),
            "open_words",
            "size",
            order_key(F.col("u"), F.col("odds"), F.col("weight")).alias("key"),
        ),
        "mix-keys",
    )
    found = None
    for shift in range(KEY_BITS - STEP_BITS, -1, -STEP_BITS):
        rows = keyed
        if found is not None:
            state = found.select(
                F.col("source").alias("of"), F.col("bin").alias("within"), "before"
            )
            same = F.col("source").eqNullSafe(F.col("of"))
            inside = F.shiftright("key", shift + STEP_BITS) == F.col("within")
            rows = rows.join(state, same & inside)
        else:
            rows = rows.withColumn("before", F.lit(0).cast("long"))
        bins = rows.groupBy(
            "source", "open_words", "before", F.shiftright("key", shift).alias("bin")
        ).agg(F.sum("size").alias("words"))
        in_order = Window.partitionBy("source").orderBy("bin")
        upto = F.col("before") + F.sum("words").over(in_order)
        bins = bins.withColumn("upto", upto).filter("upto > open_words")
        first = bins.withColumn("turn", F.row_number().over(in_order)).filter("turn = 1")
        found = materialize(
            first.select(
                "source",
                "open_words",
                "bin",
                (F.col("upto") - F.col("words")).alias("before"),
                "words",
            ),
            "mix-bins",
        )
    fits = F.col("before") + F.col("words") / 2 <= F.col("open_words")
    last = found.select(
        F.col("source").alias("of"),
        F.when(fits, F.col("bin")).otherwise(F.col("bin") - 1).alias("last"),
    )
    cut = F.when(F.col("open_words") > 0, F.coalesce("last", F.lit(TOP_KEY))).otherwise(-1)
    joined = per.join(last, F.col("source").eqNullSafe(F.col("of")), "left")
    return joined.select(*per.columns, cut.alias("cut"))


def copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (with source, u, weight, and any others) with their source's plan and copies.

    The plan has one row per source; Spark broadcasts it where its size on disk allows.
    """
    plan = plan.withColumnRenamed("source", "of")
    key = order_key(F.col("u"), F.col("odds"), F.col("weight"))
    extra = F.when(key <= F.col("cut"), 1).otherwise(0)
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("of")))
    return joined.withColumn("copies", F.col("whole") + extra).drop("of")


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    cap: int = 2,
    seed: int = 1,
    weight: Column | None = None,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    slim, plan = planned(docs, weights, share, cap, seed, weight)
    rows = copies(slim, plan)
    return rows.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def planned(
    docs: DataFrame, weights, share: float, cap: int, seed: int, weight: Column | None
) -> tuple[DataFrame, DataFrame]:
    slim = materialize(measured(docs, seed, weight), "mix-sizes")
    per = materialize(targets(slim, weights, share, cap), "mix-targets")
    return slim, materialize(cuts(slim, per), "mix-plan")


def mixed(
    docs: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    cap: int = 2,
    seed: int = 1,
) -> DataFrame:
    """The mix itself: the rows of ``docs``, as often as they are taken, same columns.

    The texts are not shuffled: a document's copies follow from its row and its source's.
    """
    _, plan = planned(docs, weights, share, cap, seed, None)
    row = free_name(docs, "row")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row))
    size = word_count(F.col(f"{row}.text"))
    rows = packed.select(
        row,
        F.col(f"{row}.source").cast("string").alias("source"),
        draw(F.col(f"{row}.doc_id"), F.col(f"{row}.text"), seed).alias("u"),
        F.sqrt(F.greatest(size, F.lit(1))).alias("weight"),
    )
    taken = copies(rows, plan).filter("copies > 0")
    again = taken.select(row, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return again.select(f"{row}.*")
