"""Trie of the prefixes that conversations share.

A conversation is a row of bytes, 24 a turn: its number of words and half the SHA-256 of its
role and text; then an end mark and the id, so that equal conversations have an order too and
no shard of the sorted rows is bound to one of them. Spark deals the rows out by ranges and
sorts within; a task takes them in blocks of a bounded number of cells.

In a block, turns are numbered and laid into a padded matrix, which is sorted by its columns
(``lexsort``). A cell that differs from the one above begins a new node, and so do all cells
right of it: an OR accumulated along the rows marks the starts of the nodes of every depth,
and ``reduceat`` between them adds up members, children, leaves and words, from the deepest
column back to the root.

Only nodes on the path of a block's first or last row can go on in another block. They are
handed on as two rows of partial sums, to be taken apart again in the same way, in as many
rounds as it takes until all fit one block; what they hold beside each other is counted once.
The ids that end at such a node go aside as texts, in the order of the blocks, and are hashed
as a stream: memory is bounded, though one node's hash is one task's work by definition.

Defined cases: rows without conv_id take no part; turns with equal numbers (or none) are
ordered by words and digest, and equal rows count as often as they come; null role or text is
empty; an empty table gives no nodes, not even a root. A conversation is one row, so it has
at most some tens of millions of turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, word_count

#: Bytes of a turn, and of the end mark with the id.
TURN, TAIL = 24, 16

#: Padded cells of a block (more only where FEWEST rows have more), and bytes of a shard.
CELLS, FEWEST, SHARD = 4_000_000, 64, 16_000_000

#: What a path row adds to each of its nodes.
SUMS = ("n", "least", "kids", "leaves", "saved")
NO_ONE = np.iinfo(np.int64).max
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

NODE, PATH, ENDS = 0, 1, 2
FOUND = pa.schema(
    [
        ("kind", pa.int8()),
        ("conv_id", pa.int64()),
        ("depth", pa.int64()),
        ("parent_conv_id", pa.int64()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()),
        ("ends_sha256", pa.string()),
        ("node", pa.binary()),
        ("parent", pa.binary()),
        ("key", pa.binary()),
        ("sums", pa.binary()),
        ("place", pa.int64()),
        ("ids", pa.string()),
    ]
)
DDL = (
    "kind tinyint, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long,"
    " n_leaves long, saved_tokens long, ends_sha256 string, node binary, parent binary,"
    " key binary, sums binary, place long, ids string"
)
COLUMNS = FOUND.names[1:9]


def _fixed(number: Column) -> Column:
    """A long as 16 hexadecimal digits."""
    return F.lpad(F.hex(number), 16, "0")


def _tail(number: Column) -> Column:
    """The end mark and a long, in the long's order."""
    return F.concat(F.lit("0" * 16), _fixed(number.bitwiseXOR(F.lit(-(1 << 63)))))


def sequences(conversations: DataFrame, family: int = 0, heads: int = 4) -> DataFrame:
    """``key`` of every conversation of (conv_id, turn, role, text): its turns and its id.

    With a ``family``, conversation c begins as c - c % family does, for crc32(c) % heads
    turns, and goes on with its own turns behind as many. One shuffle, without the texts.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    # one word more, so that no turn looks like an end mark
    made = F.concat(_fixed(word_count(text) + 1), F.substring(F.sha2(told, 256), 1, 32))
    conv = F.col("conv_id").cast("long")
    turns = conversations.filter(conv.isNotNull()).select(
        conv.alias("conv"),
        (conv - conv % family if family else conv).alias("base"),
        F.struct(F.col("turn").alias("at"), made.alias("made")).alias("turn"),
    )
    own = (
        turns.repartition("base")
        .groupBy("base", "conv")
        .agg(F.sort_array(F.collect_list("turn"))["made"].alias("own"))
    )
    whole = F.col("own")
    if family:
        first = F.when(F.col("conv") == F.col("base"), F.slice("own", 1, heads))
        own = own.withColumn("head", F.max(first).over(Window.partitionBy("base")))
        h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(heads)).cast("int")
        rest = F.slice("own", h + 1, F.size("own"))
        whole = F.concat(F.coalesce(F.slice("head", F.lit(1), h), F.array()), rest)
    return own.select(
        F.unhex(F.concat(F.array_join(whole, ""), _tail(F.col("conv")))).alias("key")
    )


class Block:
    """Rows of a block in the order of their turns, with what each adds to its nodes.

    A cell is a row at a depth from 0 to its length; ``sums`` has an array over all cells for
    every name of SUMS. ``tails`` are the ids (or places) that end the keys.
    """

    def __init__(self, keys: pa.Array, sums: pa.Array | None) -> None:
        raw = [k.as_py() for k in keys]
        sizes = np.array([len(k) - TAIL for k in raw]) // TURN
        tails = np.frombuffer(b"".join(k[-8:] for k in raw), ">u8") ^ np.uint64(1 << 63)
        tails = tails.astype(np.uint64).view(np.int64)
        turns = np.frombuffer(b"".join(k[:-TAIL] for k in raw), ">u8").reshape(-1, 3)
        ids = np.zeros(len(turns), np.int32)
        if len(turns):
            order = np.lexsort(turns.T[::-1])
            step = (turns[order][1:] != turns[order][:-1]).any(axis=1)
            ids[order] = np.r_[1, 1 + np.cumsum(step)]
        row = np.repeat(np.arange(len(raw)), sizes)
        at = np.arange(len(turns)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        padded = np.zeros((len(raw), max(sizes.max(), 1)), np.int32)
        padded[row, at] = ids
        words = np.zeros(padded.shape, np.int64)
        words[row, at] = turns[:, 0].astype(np.int64) - 1
        order = np.lexsort((tails, *padded.T[::-1]))
        padded = padded[order]
        new = np.ones(padded.shape, bool)
        new[1:] = padded[1:] != padded[:-1]
        #: whether a row begins a node, by depth - 1
        self.begins = np.logical_or.accumulate(new, axis=1)
        self.words = words[order]
        self.keys = [raw[i] for i in order]
        self.sizes, self.tails = sizes[order], tails[order]
        self.cell = np.cumsum(self.sizes + 1) - (self.sizes + 1)
        cells = int((self.sizes + 1).sum())
        if sums is None:
            self.sums = {name: np.zeros(cells, np.int64) for name in SUMS}
            self.sums["n"][:] = 1
            self.sums["least"] = np.repeat(self.tails, self.sizes + 1)
        else:
            parts = [np.frombuffer(sums[int(i)].as_py(), np.int64).reshape(len(SUMS), -1) for i in order]
            self.sums = dict(zip(SUMS, np.concatenate(parts, axis=1)))

    def digests(self, row: int) -> list[bytes]:
        """A digest of each node on the path of a row, root first."""
        hashed, key = hashlib.blake2b(digest_size=16), self.keys[row]
        found = [hashed.digest()]
        for at in range(int(self.sizes[row])):
            hashed.update(key[at * TURN : (at + 1) * TURN])
            found.append(hashed.copy().digest())
        return found


class Level:
    """The nodes of one depth of a block."""

    def __init__(self, block: Block, depth: int, whole: bool) -> None:
        self.depth = depth
        self.rows = np.flatnonzero(block.sizes >= depth)
        begin = np.flatnonzero(block.begins[self.rows, depth - 1]) if depth else np.array([0])
        self.first = self.rows[begin]
        cells = block.cell[self.rows] + depth
        for name in SUMS:
            add = np.minimum if name == "least" else np.add
            setattr(self, name, add.reduceat(block.sums[name][cells], begin))
        self.open = np.zeros(len(begin), bool)
        if not whole:
            self.open[0] |= block.sizes[0] >= depth
            self.open[-1] |= block.sizes[-1] >= depth

    def of(self, rows: np.ndarray) -> np.ndarray:
        """The node each row belongs to."""
        return np.searchsorted(self.first, rows, "right") - 1

    def take_children(self, below: Level) -> np.ndarray:
        """Add the closed nodes one deeper; the parent of every node there."""
        parent = self.of(below.first)
        closed = ~below.open
        np.add.at(self.kids, parent[closed], 1)
        np.add.at(self.leaves, parent[closed], below.leaves[closed])
        np.add.at(self.saved, parent[closed], below.saved[closed])
        return parent

    def close(self, block: Block) -> None:
        """What closed nodes have beside their children; open ones get it where they close."""
        self.leaves += ~self.open & (self.kids == 0)
        if self.depth:
            words = block.words[self.first, self.depth - 1]
            self.saved += np.where(self.open, 0, (self.n - 1) * words)


def _column(name: str, values, rows: int) -> pa.Array:
    kind = FOUND.field(name).type
    return pa.nulls(rows, kind) if values is None else pa.array(values, kind)


def _rows(kind: int, rows: int, **values) -> pa.RecordBatch:
    columns = [
        pa.array(np.full(rows, kind, np.int8)) if name == "kind" else _column(name, values.get(name), rows)
        for name in FOUND.names
    ]
    return pa.RecordBatch.from_arrays(columns, schema=FOUND)


def take_apart(block: Block, place: int, first_round: bool, whole: bool) -> Iterator[pa.RecordBatch]:
    """The closed nodes of a block, the paths of its open ones, and ids that end there.

    The first round's rows are conversations, those of later rounds paths; a ``whole`` block
    has nothing beside it, so all of its nodes are closed.
    """
    last = len(block.sizes) - 1
    edges = {} if whole else {row: block.digests(row) for row in (0, last)}
    own = None if first_round else [block.digests(row) for row in range(last + 1)]
    paths = {row: np.zeros((len(SUMS), block.sizes[row] + 1), np.int64) for row in edges}
    for values in paths.values():
        values[SUMS.index("least")] = NO_ONE
    apart = False
    below = below_values = None
    for depth in range(int(block.sizes.max()), -1, -1):
        level = Level(block, depth, whole)
        parent = None if below is None else level.take_children(below)
        level.close(block)
        if below is not None:
            yield from _closed(below, below_values, level, parent, edges, last)
        at_end = block.sizes[level.rows] == depth
        ended = level.rows[at_end]
        texts: dict[int, list[str]] = {}
        if first_round:
            for node, conv in zip(level.of(ended).tolist(), block.tails[ended].tolist()):
                texts.setdefault(node, []).append(str(conv))
        ids = {node: ",".join(found) for node, found in texts.items()}
        # a path's sums, once where both paths have the node
        for row, values in paths.items():
            if block.sizes[row] < depth:
                continue
            node = 0 if row == 0 else len(level.open) - 1
            if row and node == 0 and block.sizes[0] >= depth:
                continue
            if row:
                apart = True
            values[:, depth] = [getattr(level, name)[node] for name in SUMS]
            if node in ids:
                yield _rows(ENDS, 1, node=[edges[row][depth]], place=[place], ids=[ids[node]])
        shas = nodes = None
        if first_round:
            hashed = {k: hashlib.sha256(v.encode()).hexdigest() for k, v in ids.items()}
            shas = [hashed.get(k, EMPTY_SHA) for k in range(len(level.open))]
        else:
            nodes = [own[row][depth] for row in level.first.tolist()]
        below, below_values = level, (shas, nodes)
    yield from _closed(below, below_values, None, None, edges, last)
    for row, values in paths.items():
        if row and not apart:
            continue
        tail = bytes(8) + (2 * place + (row > 0)).to_bytes(8, "big")
        yield _rows(PATH, 1, key=[block.keys[row][:-TAIL] + tail], sums=[values.tobytes()])


def _closed(level: Level, values, above: Level | None, parent, edges, last) -> Iterator[pa.RecordBatch]:
    """The closed nodes of a level, with their parent's id or, if that is open, its digest."""
    closed = np.flatnonzero(~level.open)
    if not len(closed):
        return
    parent_conv = parent_node = None
    if above is not None:
        of = parent[closed]
        known = ~above.open[of]
        parent_conv = pa.array(above.least[of], mask=~known)
        if not known.all():
            # node 0 is on the first row's path wherever that reaches so far
            digest = {}
            for row in edges:
                if level.depth - 1 < len(edges[row]):
                    digest[int(above.of(np.array([row]))[0])] = edges[row][level.depth - 1]
            parent_node = [None if k else digest[node] for k, node in zip(known.tolist(), of.tolist())]
    shas, nodes = values
    yield _rows(
        NODE,
        len(closed),
        conv_id=level.least[closed],
        depth=np.full(len(closed), level.depth),
        parent_conv_id=parent_conv,
        n_convs=level.n[closed],
        n_children=level.kids[closed],
        n_leaves=level.leaves[closed],
        saved_tokens=level.saved[closed],
        ends_sha256=shas and [shas[k] for k in closed.tolist()],
        node=nodes and [nodes[k] for k in closed.tolist()],
        parent=parent_node,
    )


def _blocks(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.Table]:
    """The rows in blocks of at most CELLS padded cells, or as one."""
    held, rows, widest = [], 0, 1
    for batch in batches:
        sizes = pc.binary_length(batch.column("key")).to_numpy() // TURN
        at = 0
        for i, size in enumerate(sizes.tolist()):
            wider = max(widest, size)
            if not whole and rows >= FEWEST and (rows + 1) * wider > CELLS:
                held.append(batch.slice(at, i - at))
                yield pa.Table.from_batches(held)
                held, rows, at, wider = [], 0, i, max(size, 1)
            rows, widest = rows + 1, wider
        held.append(batch.slice(at))
    if rows:
        yield pa.Table.from_batches(held)


def _round(rows: DataFrame, shards: int, first_round: bool) -> DataFrame:
    """One round over ``rows`` (key, sums): a single shard is taken as a whole."""
    whole = not shards

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        for number, table in enumerate(_blocks(batches, whole)):
            sums = None if first_round else table.column("sums").combine_chunks()
            block = Block(table.column("key").combine_chunks(), sums)
            place = (shard << 32) + number
            yield from take_apart(block, place, first_round, whole)

    if whole:
        dealt = rows.coalesce(1)
    else:
        dealt = rows.repartitionByRange(shards, "key").sortWithinPartitions("key")
    return materialize(dealt.mapInArrow(run, DDL), "trie")


def _hashed(ends: DataFrame) -> DataFrame:
    """node, ends_sha256 over the texts of each node (node, place, ids), as a stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = hashed = None
        for batch in batches:
            done = []
            for own, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                if own != node:
                    if node is not None:
                        done.append((node, hashed.hexdigest()))
                    node, hashed = own, hashlib.sha256()
                else:
                    hashed.update(b",")
                hashed.update(ids.as_py().encode())
            yield _digests(done)
        if node is not None:
            yield _digests([(node, hashed.hexdigest())])

    def _digests(done: list) -> pa.RecordBatch:
        return pa.record_batch(
            [pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())],
            ["node", "sha"],
        )

    ordered = ends.repartition("node").sortWithinPartitions("node", "place")
    return ordered.select("node", "ids").mapInArrow(run, "node binary, sha string")


def prefix_trie(keys: DataFrame) -> DataFrame:
    """A row per node of the conversations ``keys`` (from ``sequences``): the least id of its
    members, depth, the same of its parent, members, children, leaves at or below it, words
    saved at or below it if shared turns are kept once, and a hash of the ids that end there."""
    spark = keys.sparkSession
    rows = materialize(keys, "sequences")
    size = F.sum(F.length("key")), F.count(F.lit(1)), F.max(F.length("key"))
    total, count, longest = rows.agg(*size).first()
    # by ranges at first, whatever the size, so that more machines share the work
    shards = max(spark.sparkContext.defaultParallelism, ceil((total or 0) / SHARD))
    rounds = []
    while True:
        found = _round(rows, shards, first_round=not rounds)
        rounds.append(found.filter(F.col("kind") == NODE))
        if len(rounds) == 1:
            ends = found.filter(F.col("kind") == ENDS).select("node", "place", "ids")
        if not shards or not count:
            break
        rows = found.filter(F.col("kind") == PATH).select("key", "sums")
        total, count, longest = rows.agg(*size).first()
        if not count:
            break
        fits = count <= FEWEST or count * (longest // TURN) <= CELLS
        shards = 0 if fits else min(ceil(total / SHARD), ceil(count / FEWEST))
    if len(rounds) == 1:
        return rounds[0].select(*COLUMNS)
    later = rounds[1]
    for more in rounds[2:]:
        later = later.union(more)
    known = later.select(F.col("node").alias("parent"), F.col("conv_id").alias("known"))
    root = later.filter("depth = 0").first()["conv_id"]
    later = later.join(_hashed(ends), "node", "left").withColumn(
        "ends_sha256", F.coalesce("sha", F.lit(EMPTY_SHA))
    )
    columns = [*COLUMNS, "parent"]
    nodes = rounds[0].select(*columns).union(later.select(*columns))
    # the root's children are told at once: there may be as many as conversations
    seek = F.col("parent").isNotNull() & (F.col("depth") > 1)
    told = nodes.filter(~seek).withColumn(
        "parent_conv_id", F.when(F.col("depth") == 1, F.lit(root)).otherwise(F.col("parent_conv_id"))
    )
    sought = nodes.filter(seek).join(known, "parent").withColumn("parent_conv_id", F.col("known"))
    return told.select(*COLUMNS).union(sought.select(*COLUMNS))
