"""Prefix trie over conversations, built from sorted matrices of turn ids.

Every turn has a 128-bit id from its role and text. Conversations are dealt out in shards by ranges
of their id sequences. A shard is a padded matrix of turn ids: it is sorted by ``numpy.lexsort``,
the change masks of its columns are OR-accumulated from left to right, so that the mask of a column
marks where nodes of that depth begin, and ``reduceat`` aggregates the nodes of every depth,
deepest first. Only nodes on the path of a shard's first or last row can go on in another shard;
they leave as partial results under the digest of their prefix and are put together afterwards.

A matrix is ``WIDTH`` turns wide. Conversations that are longer and share all ``WIDTH`` turns with
another long one go on in a next round, grouped by the node they share; totals flow back from the
last round to the first. A long conversation that is alone below its node has a plain chain of
nodes there, which is made row by row. So neither a long conversation nor a long shared history is
ever held whole.

Turns are ordered by ``turn`` (nulls first) and, within one turn number, by their ids, so repeated
rows are neighbours. Null roles and texts count as empty, rows without ``conv_id`` belong to no
conversation and are left out, an empty table has no nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opdiag.llm.shipping import ship
from opdiag.operators.sized import cut, join_lookup

WIDTH = 32  # turns of one matrix
SHARD_ROWS = 1 << 14  # conversations of one matrix, about
BROADCAST_ROWS = 1 << 18  # nodes of several shards, of some forty bytes each, that are broadcast
CHUNK = 1 << 16  # ids that travel in one row
WORDS = "[^\\x20\\x09-\\x0D]+"
LEAST = np.iinfo(np.int64).min
NO_ENDS = hashlib.sha256(b"").hexdigest()
BLOCK, HEAD = 20, 4  # fixed values of the rebuilt conversations

_NODES = (
    "kind string, key binary, parent_key binary, ancestors array<binary>, depth bigint, "
    "conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, words bigint, ends_sha256 string, ids array<bigint>"
)
_NODE = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
]
_TURN = "struct<depth:bigint,a:bigint,b:bigint,words:bigint>"


def turn_ids(turns: DataFrame) -> DataFrame:
    """Per turn its id as two numbers and its words; texts go no further than this."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return turns.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
        F.greatest(F.xxhash64(role, text), F.lit(int(LEAST) + 1)).alias("a"),
        F.xxhash64(F.lit(17), text, role).alias("b"),
        F.regexp_count(text, F.lit(WORDS)).cast("bigint").alias("words"),
    )


def _numbered(ids: DataFrame) -> DataFrame:
    """Turns with their position in the conversation, counted across shards.

    A conversation may hold any share of all rows, so turns are sorted by range and numbered per
    shard; what a shard's first conversation has before the shard is added afterwards, from one
    row per shard. ``seen`` is the number of turns of the block's first conversation, up to three.
    """
    spark = ship(ids.sparkSession)
    keys = [
        F.col("base"), F.col("conv_id") != F.col("base"), F.col("conv_id"),
        F.col("turn").asc_nulls_first(), F.col("a"), F.col("b"),
    ]
    rows = ids.withColumn("base", F.expr(f"conv_id - conv_id % {BLOCK}"))
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = "shard int, base bigint, conv_id bigint, a bigint, b bigint, words bigint, at bigint, seen bigint"
    numbered, _ = cut(ranged.mapInArrow(_number, schema))

    last = F.max(F.struct("base", F.col("conv_id") != F.col("base"), "conv_id", "at"))
    edges = numbered.groupBy("shard").agg(
        F.min(F.struct("base", F.col("conv_id") != F.col("base"), "conv_id")).alias("first"),
        last.alias("last"),
    ).orderBy("shard").collect()  # one row per shard
    before, earlier = [], (None, 0)
    for edge in edges:
        carried = earlier[1] if edge.first.conv_id == earlier[0] else 0
        before.append((edge.shard, edge.first.base, edge.first.conv_id, carried))
        goes_on = edge.last.conv_id == edge.first.conv_id
        earlier = (edge.last.conv_id, edge.last["at"] + (carried if goes_on else 0))
    carry = spark.createDataFrame(
        before, "shard int, first_base bigint, first_conv bigint, carried bigint"
    )
    placed = numbered.join(F.broadcast(carry), "shard")
    placed = placed.withColumn(
        "at", F.col("at") + F.expr("if(conv_id = first_conv, carried, 0)")
    ).drop("first_conv", "carried")
    # how many turns the first block's base has is not known within a shard
    firsts = placed.where("conv_id = base").join(
        F.broadcast(carry.select(F.col("first_base").alias("base")).distinct()), "base", "left_semi"
    )
    counted = firsts.groupBy("base").agg(F.max("at").alias("in_base"))
    return (
        placed.join(F.broadcast(counted), "base", "left")
        .withColumn(
            "seen", F.expr("if(base = first_base, least(coalesce(in_base, 0), 3), seen)")
        )
        .select("base", "conv_id", "a", "b", "words", "at", "seen")
    )


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard = TaskContext.get().partitionId()
    conv = base = None
    conv_rows = base_rows = 0
    for batch in batches:
        count = batch.num_rows
        if not count:
            continue
        convs, bases = (batch.column(name).to_numpy() for name in ("conv_id", "base"))

        def place(changes: np.ndarray, values: np.ndarray, carried: int) -> np.ndarray:
            """Running sum of ``values`` within runs; the first run begins with ``carried``."""
            sums = np.cumsum(values)
            starts = np.flatnonzero(changes)
            offset = np.where(starts > 0, sums[starts - 1], -carried)
            return sums - np.repeat(offset, np.diff(starts, append=count))

        def runs(values: np.ndarray) -> np.ndarray:
            changes = np.ones(count, bool)
            changes[1:] = values[1:] != values[:-1]
            return changes

        own = place(runs(convs), np.ones(count, np.int64), conv_rows if convs[0] == conv else 0)
        inside = place(
            runs(bases), (convs == bases).astype(np.int64), base_rows if bases[0] == base else 0
        )
        conv, base, conv_rows, base_rows = convs[-1], bases[-1], own[-1], inside[-1]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(count, shard, np.int32)),
                *(batch.column(name) for name in ("base", "conv_id", "a", "b", "words")),
                pa.array(own), pa.array(np.minimum(inside, 3)),
            ],
            names=["shard", "base", "conv_id", "a", "b", "words", "at", "seen"],
        )


def rebuilt(ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth, a, b, words) of the rebuilt conversations, and all conversations.

    Conversation c takes its first ``crc32(c) % 4`` turns from conversation ``c - c % 20``, as many
    as there are, and goes on with its own turns after as many.
    """
    numbered = _numbered(ids)
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD
    rows = numbered.withColumn("h", head)
    own = rows.where("at > h").select(
        "conv_id", F.expr("at - h + least(h, seen)").alias("depth"), "a", "b", "words"
    )
    convs = rows.where("at = 1").select("conv_id", "base", "h")  # one row per conversation
    heads = numbered.where(f"conv_id = base and at < {HEAD}").select(
        "base", F.col("at").alias("depth"), "a", "b", "words"
    )
    taken = convs.join(heads, "base").where("depth <= h")
    return own.unionByName(taken.select(*own.columns)), convs.select("conv_id")


def numbered_turns(ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and conversations as they are, in the form that ``nodes`` takes."""
    numbered = _numbered(ids)
    turns = numbered.select("conv_id", F.col("at").alias("depth"), "a", "b", "words")
    return turns, numbered.where("at = 1").select("conv_id")


def _blocks(turns: DataFrame, convs: DataFrame, width: int) -> DataFrame:
    """Turns of a conversation in arrays of ``width``; ``more`` says that another block follows."""
    block = F.floor((F.col("depth") - 1) / width)
    turn = F.struct("depth", "a", "b", "words").cast(_TURN)
    rows = turns.select("conv_id", block.alias("block"), turn.alias("turn"), F.lit(False).alias("more"))
    nothing = F.lit(None).cast(_TURN).alias("turn")
    follows = turns.where(f"depth > {width} and depth % {width} = {1 % width}").select(
        "conv_id", (block - 1).alias("block"), nothing, F.lit(True).alias("more")
    )
    empty = convs.select("conv_id", F.lit(0).cast("bigint").alias("block"), nothing, F.lit(False).alias("more"))
    return (
        rows.unionByName(follows).unionByName(empty)
        .groupBy("conv_id", "block")
        .agg(F.sort_array(F.collect_list("turn")).alias("seq"), F.max("more").alias("more"))
    )


_SEQUENCE = "transform(seq, x -> struct(x.a, x.b))"


def nodes(
    turns: DataFrame, convs: DataFrame, width: int = WIDTH, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """The trie of numbered turns: a row per node, named by its smallest member and its depth.

    ``turns`` has conv_id, depth (1, 2, ...), a, b, words; ``convs`` every conv_id once, also of
    conversations without a turn. Columns of the result: conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens (over the subtree: repeats of a node's last turn times its
    words), ends_sha256 (of the ids of the conversations that end there).
    """
    spark = ship(turns.sparkSession)
    blocks, _ = cut(_blocks(turns, convs, width))
    group = F.lit(0).cast("bigint").alias("group")
    rounds = [blocks.where("block = 0").select("conv_id", group, "seq", "more")]
    extras, chains = [], []
    while True:  # as many rounds as the longest history that two conversations share has blocks
        full = rounds[-1].where(F.size("seq") == width).withColumn("key", F.expr(_SEQUENCE))
        met, found = cut(
            full.groupBy("group", "key").agg(
                F.min("conv_id").alias("rep"), F.count_if("more").alias("n_more"),
                F.min(F.when(F.col("more"), F.col("conv_id"))).alias("sole"),
            ).where("n_more > 0")
        )
        extras.append(
            met.where("n_more = 1").selectExpr(
                "rep as conv_id", "1L as x_children", "1L as x_leaves", "0L as x_saved"
            )
        )
        if not found:
            break
        chains.append(
            met.where("n_more = 1").selectExpr(
                "sole as conv_id", "rep", f"{len(rounds)}L as since"
            )
        )
        together = full.where("more").join(met.where("n_more > 1"), ["group", "key"])
        together = together.select("conv_id", F.col("rep").alias("group"))
        rows, found = cut(
            blocks.where(F.col("block") == len(rounds)).join(together, "conv_id")
            .select("conv_id", "group", "seq", "more")
        )
        if not found:
            break
        rounds.append(rows)
    parts = [_chain(blocks, chain) for chain in chains]
    below = None
    for at in range(len(rounds) - 1, -1, -1):
        extra = extras[at] if below is None else extras[at].unionByName(below)
        made = _round(rounds[at], extra, at * width, shard_rows)
        top = made.where(F.col("depth") == at * width)
        below = top.selectExpr(
            "conv_id", "n_children as x_children", "n_leaves as x_leaves", "saved_tokens as x_saved"
        )
        parts.append(made if at == 0 else made.where(F.col("depth") > at * width))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _chain(blocks: DataFrame, alone: DataFrame) -> DataFrame:
    """Nodes of conversations that share nothing from block ``since`` on: one per turn."""
    rows = blocks.join(alone, "conv_id").where("block >= since")
    rows = rows.select("conv_id", "rep", "since", "block", "more", F.size("seq").alias("size"),
                       F.posexplode("seq").alias("place", "turn"))
    first = (F.col("block") == F.col("since")) & (F.col("place") == 0)
    last = ~F.col("more") & (F.col("place") == F.col("size") - 1)
    own = F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)
    return rows.select(
        "conv_id", "turn.depth",
        F.when(first, F.col("rep")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        F.lit(1).cast("bigint").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("bigint").alias("n_children"),
        F.lit(1).cast("bigint").alias("n_leaves"), F.lit(0).cast("bigint").alias("saved_tokens"),
        F.when(last, own).otherwise(F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def _round(rows: DataFrame, extra: DataFrame, above: int, shard_rows: int) -> DataFrame:
    """Nodes of one block of turns, the nodes above it (at depth ``above``) included.

    ``extra`` has, for the conversation that names a node, what the next blocks hold below it.
    """
    spark = rows.sparkSession
    count = rows.count()
    parallel = spark.sparkContext.defaultParallelism
    shards = max(-(-count // shard_rows), min(parallel, -(-count // 1024)), 1)
    rows = rows.join(extra, "conv_id", "left").fillna(0, ["x_children", "x_leaves", "x_saved"])
    dealt = rows.repartitionByRange(shards, F.col("group"), F.expr(_SEQUENCE), F.col("conv_id"))
    flat = dealt.select(
        "conv_id", "group", "more", "x_children", "x_leaves", "x_saved",
        *[F.col(f"seq.{name}").alias(name) for name in ("a", "b", "words")],
    )

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [batch for batch in batches if batch.num_rows]
        if batches:
            yield from Shard(pa.Table.from_batches(batches).combine_chunks(), above).batches()

    made, _ = cut(flat.mapInArrow(shard, _NODES))
    return _combined(made)


def _combined(made: DataFrame) -> DataFrame:
    """Finished nodes of all shards, and those of several shards put together.

    There are at most two paths of ``WIDTH`` nodes per shard to put together.
    """
    parts, count = cut(
        made.where("kind = 'part'").groupBy("key").agg(
            F.first("parent_key").alias("parent_key"), F.first("ancestors").alias("ancestors"),
            F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
            F.first("words").alias("words"),
        )
    )
    kids = parts.where("parent_key is not null").groupBy(F.col("parent_key").alias("key"))
    kids = kids.agg(F.count(F.lit(1)).alias("more_children"))
    joined = parts.join(kids, "key", "left").withColumn(
        "n_children", F.expr("n_children + coalesce(more_children, 0)")
    )
    own = joined.select(
        F.explode("ancestors").alias("key"), F.expr("if(n_children = 0, 1L, 0L)").alias("leaf"),
        F.expr("(n_convs - 1) * words").alias("repeated"),
    )
    own = own.groupBy("key").agg(F.sum("leaf").alias("leaf"), F.sum("repeated").alias("repeated"))
    chunks = made.where("kind = 'ends'").select("key", "ids").repartition("key")
    ends = chunks.sortWithinPartitions("key", "ids").mapInArrow(
        _digests, "key binary, ends_sha256 string"
    )
    parents = parts.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    shared = (
        joined.join(own, "key").join(ends, "key", "left").join(parents, "parent_key", "left")
        .withColumn("n_leaves", F.expr("n_leaves + leaf"))
        .withColumn("saved_tokens", F.expr("saved_tokens + repeated"))
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
    )
    inner = made.where("kind = 'node'")
    # a node of several shards may have very many children: its key is no key to shuffle by
    below = inner.where("parent_key is not null").drop("parent_conv_id")
    if count <= BROADCAST_ROWS:
        below = below.join(F.broadcast(parents), "parent_key")
    else:
        below = join_lookup(below, parents, ["parent_key"])
    return (
        inner.where("parent_key is null").select(*_NODE)
        .unionByName(below.select(*_NODE)).unionByName(shared.select(*_NODE))
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per key over the ids of its chunks, read one after the other."""
    key, digest, done = None, None, []
    for batch in batches:
        for at in range(batch.num_rows):
            own, text = batch.column(0)[at].as_py(), _joined(batch.column(1)[at].values.to_numpy())
            if own != key:
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = own, hashlib.sha256(text)
            else:
                digest.update(b"," + text)
    if key is not None:
        done.append((key, digest.hexdigest()))
    if done:
        keys, digests = zip(*done)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(digests, pa.string())],
            names=["key", "ends_sha256"],
        )


def _joined(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


class Shard:
    """Sorted matrix of the turn ids of some conversations.

    Row order is that of the ranges: by group, turn ids, then conversation; a shorter sequence
    comes before those that go on.
    """

    def __init__(self, table: pa.Table, above: int):
        column = {name: table.column(name).combine_chunks() for name in table.column_names}
        column = {
            name: value.chunk(0) if isinstance(value, pa.ChunkedArray) else value
            for name, value in column.items()
        }
        sizes = np.diff(column["a"].offsets.to_numpy())
        self.above, self.count, self.width = above, len(sizes), int(sizes.max())
        inside = np.arange(self.width) < sizes[:, None]
        turns = {}
        for name, pad in (("a", LEAST), ("b", LEAST), ("words", 0)):
            turns[name] = np.full(inside.shape, pad, np.int64)
            turns[name][inside] = column[name].flatten().to_numpy()
        keys = [column["conv_id"].to_numpy()]
        for at in range(self.width - 1, -1, -1):
            keys += [turns["b"][:, at], turns["a"][:, at]]
        order = np.lexsort([*keys, column["group"].to_numpy()])
        self.conv, self.group = (column[name].to_numpy()[order] for name in ("conv_id", "group"))
        self.sizes, self.inside = sizes[order], inside[order]
        self.a, self.b, self.words = (turns[name][order] for name in ("a", "b", "words"))
        self.ended = ~column["more"].to_numpy(zero_copy_only=False)[order]
        self.below = [
            column[name].to_numpy()[order].copy() for name in ("x_children", "x_leaves", "x_saved")
        ]

    def _masks(self) -> Iterator[np.ndarray]:
        """For depth 0, 1, ... where the first so many turns differ from the row before."""
        mask = np.ones(self.count, bool)
        mask[1:] = self.group[1:] != self.group[:-1]
        yield mask.copy()
        for at in range(self.width):
            for matrix in (self.a, self.b, self.inside):
                mask[1:] |= matrix[1:, at] != matrix[:-1, at]
            yield mask.copy()

    def _path(self, row: int) -> list[bytes]:
        """Digests of the prefixes of a row, from depth 0 to its end."""
        digest = hashlib.blake2b(self.group[row].tobytes(), digest_size=16)
        keys = [digest.digest()]
        for at in range(self.sizes[row]):
            digest.update(self.a[row, at].tobytes() + self.b[row, at].tobytes())
            keys.append(digest.digest())
        return keys

    def batches(self) -> Iterator[pa.RecordBatch]:
        """Nodes that lie in this shard alone, parts of the others, and the latter's ends."""
        masks = list(self._masks())
        starts = [np.flatnonzero(mask) for mask in masks]
        reps = [np.minimum.reduceat(self.conv, start) for start in starts]
        if self.above:  # the node above was named by all its members, not only those that go on
            reps[0] = self.group[starts[0]]
        first, last = self._path(0), self._path(self.count - 1)
        children, leaves, saved = self.below
        deeper = np.zeros(self.count, np.int64)  # begins of inner nodes one level deeper
        for depth in range(self.width, -1, -1):
            start = starts[depth]
            real = np.ones(len(start), bool) if depth == 0 else self.inside[start, depth - 1]
            edge = np.zeros(len(start), bool)
            edge[0] |= len(first) > depth
            edge[-1] |= len(last) > depth
            edge &= real
            size = np.diff(start, append=self.count)
            here = self.sizes == depth
            n_children = np.add.reduceat(deeper + np.where(here, children, 0), start)
            word = self.words[start, depth - 1] if depth else np.zeros(len(start), np.int64)
            inner = real & ~edge
            leaf = inner & (n_children == 0)
            leaves[start[leaf]] += 1
            saved[start[inner]] += (size[inner] - 1) * word[inner]
            n_leaves, n_saved = np.add.reduceat(leaves, start), np.add.reduceat(saved, start)
            deeper = np.zeros(self.count, np.int64)
            deeper[start[inner]] = 1
            ends = np.cumsum(np.concatenate(([0], np.add.reduceat(here & self.ended, start))))
            ids = self.conv[here & self.ended]
            if depth:
                up = np.searchsorted(starts[depth - 1], start, side="right") - 1
                parent = reps[depth - 1][up]
                last_up = len(starts[depth - 1]) - 1
            numbers = {
                "depth": np.full(len(start), self.above + depth), "conv_id": reps[depth],
                "n_convs": size, "n_children": n_children, "n_leaves": n_leaves,
                "saved_tokens": n_saved, "words": word,
            }
            rows = np.flatnonzero(inner)
            if len(rows):
                shas = [
                    hashlib.sha256(_joined(ids[ends[at] : ends[at + 1]])).hexdigest()
                    if ends[at + 1] > ends[at] else NO_ENDS for at in rows.tolist()
                ]
                keys = None
                if depth:
                    keys = [
                        first[depth - 1] if at == 0 and len(first) >= depth
                        else last[depth - 1] if at == last_up and len(last) >= depth else None
                        for at in up[rows].tolist()
                    ]
                yield _batch(
                    len(rows), "node", {k: v[rows] for k, v in numbers.items()}, parent_key=keys,
                    parent_conv_id=parent[rows] if depth else None, ends_sha256=shas,
                )
            for at in np.flatnonzero(edge).tolist():
                path = first if at == 0 and len(first) > depth else last
                yield _batch(
                    1, "part", {k: v[at : at + 1] for k, v in numbers.items()}, key=[path[depth]],
                    parent_key=[path[depth - 1]] if depth else None,
                    ancestors=[path[: depth + 1]],
                )
                own = ids[ends[at] : ends[at + 1]]
                for begin in range(0, len(own), CHUNK):
                    yield _batch(1, "ends", {}, key=[path[depth]], ids=[own[begin : begin + CHUNK]])


_ARROW = {
    "kind": pa.string(), "key": pa.binary(), "parent_key": pa.binary(),
    "ancestors": pa.list_(pa.binary()), "depth": pa.int64(), "conv_id": pa.int64(),
    "parent_conv_id": pa.int64(), "n_convs": pa.int64(), "n_children": pa.int64(),
    "n_leaves": pa.int64(), "saved_tokens": pa.int64(), "words": pa.int64(),
    "ends_sha256": pa.string(), "ids": pa.list_(pa.int64()),
}


def _batch(count: int, kind: str, numbers: dict, **others) -> pa.RecordBatch:
    values = {"kind": [kind] * count, **numbers, **others}
    arrays = [
        pa.nulls(count, kind_) if values.get(name) is None else pa.array(values[name], kind_)
        for name, kind_ in _ARROW.items()
    ]
    return pa.RecordBatch.from_arrays(arrays, names=list(_ARROW))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations as they stand in a table."""
    return nodes(*numbered_turns(turn_ids(conversations)))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return nodes(*rebuilt(turn_ids(conversations)))
