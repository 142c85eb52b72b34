"""Similarity join on five-word shingles by chosen paths.

Texts with the same set of shingles are copies, and one of them stands for all. A representative
has a signature of independent minima of its shingles. In each run a set takes some coordinates of
its signature, chosen at random but alike for all sets, and moves to one bucket per chosen
coordinate and value; the expected number is one over the threshold, so that a similar pair keeps
meeting. Buckets that are still large are split again by further coordinates. Small buckets, and
what has not come apart after ``DEPTH`` steps, are compared all with all on their signatures. Runs
are repeated until a pair at the threshold is missed with a probability below ``MISS``.

Candidates only serve to find families, the components of loosely similar sets. Within a family
every pair is then decided exactly from the shingles, block against block, and counted where it is
decided. So no list of pairs is ever made, and a pair is found as soon as any path of candidates
joins its two ends.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opdiag.llm import bitmaps
from opdiag.llm.components import components
from opdiag.llm.shipping import released, ship
from opdiag.llm.texts import distinct_by_text, mix, text_shingles
from opdiag.operators.sized import join_lookup
from opdiag.session import scratch_path, shared_dir

THRESHOLD = 0.8
COORDINATES = 128
#: A pair goes on to exact comparison from this estimate on: over five deviations below 0.8.
LOOSE = 0.6
MISS = 1e-6
DEPTH = 3
SMALL = 128
TIGHT_BLOCK = 512
BLOCK = 256
BLOCK_SHINGLES = 4_000_000
SEED = 20240607

SETS = (
    "id bigint, text_hash bigint, high bigint, low bigint, shingles bigint, signature binary, "
    "sketch binary"
)
MEMBERS = "family bigint, set_id bigint, shares bigint, high bigint, low bigint, hashes array<bigint>"


def _seeds(count: int, salt: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=np.uint64) + np.uint64(SEED * 1000 + salt * 1_000_003))


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _signatures(hashes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """For every set a row of ``COORDINATES`` minima, 32 bits of each."""
    out = np.empty((len(begins), COORDINATES), np.uint32)
    for at, seed in enumerate(_seeds(COORDINATES, 1)):
        values = (hashes ^ seed) * (seed | np.uint64(1))
        least = np.minimum.reduceat(values, begins)
        out[:, at] = (mix(least) >> np.uint64(32)).astype(np.uint32)
    return out


def _class_keys(hashes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name a set of shingles, whatever their order."""
    first = np.add.reduceat(mix(hashes ^ np.uint64(0x51ED270B)), begins)
    second = np.add.reduceat(mix(hashes + np.uint64(0xA0761D6478BD642F)), begins)
    return first, second


def shingle_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``SETS``: per row the name of its shingle set, its size and the signature.

    Rows without words have null names and signatures.
    """

    @released
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, text_hash, texts = batch.column(0), batch.column(1), batch.column(2)
            for start, hashes, at, totals in text_shingles(texts):
                count = len(totals)
                hashes, at = distinct_by_text(hashes, at)
                sizes = np.bincount(at, minlength=count)
                filled = np.flatnonzero(sizes)
                high, low = np.zeros(count, np.uint64), np.zeros(count, np.uint64)
                signature, sketch = [None] * count, [None] * count
                if len(filled):
                    begins = np.concatenate(([0], np.cumsum(sizes[filled])[:-1]))
                    high[filled], low[filled] = _class_keys(hashes, begins)
                    for row, minima in zip(filled, _signatures(hashes, begins)):
                        signature[row] = minima.tobytes()
                        sketch[row] = minima.astype(np.uint8).tobytes()
                empty = pa.array(sizes == 0)
                null = pa.scalar(None, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, count), text_hash.slice(start, count),
                     pa.compute.if_else(empty, null, _signed(high)),
                     pa.compute.if_else(empty, null, _signed(low)),
                     pa.array(sizes, pa.int64()), pa.array(signature, pa.binary()),
                     pa.array(sketch, pa.binary())],
                    ["id", "text_hash", "high", "low", "shingles", "signature", "sketch"],
                )

    narrow = docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_hash"),
        F.col(text_col).alias("text"),
    )
    return narrow.mapInArrow(describe, SETS)


def runs_needed(threshold: float, miss: float) -> int:
    """Runs after which a pair at the threshold is missed with at most this probability.

    A pair meets below a node with the chance that some coordinate that both take there agrees.
    With one coordinate and sometimes a second one this is at least the threshold per step, and
    ``DEPTH`` steps have to succeed.
    """
    return math.ceil(math.log(miss) / math.log(1 - threshold**DEPTH))


def _chosen(node: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First coordinate, second coordinate and whether the second counts, per node."""
    state = mix(node ^ np.uint64(SEED))
    first = (state % np.uint64(COORDINATES)).astype(np.int64)
    step = (mix(state) % np.uint64(COORDINATES - 1)).astype(np.int64) + 1
    second = (first + step) % COORDINATES
    extra = (mix(state + np.uint64(7)) >> np.uint64(11)) * 2.0**-53 < 1 / threshold - 1
    return first, second, extra


def _children(nodes: np.ndarray, signatures: np.ndarray, threshold: float):
    """Row number and child node of every path that leaves the given nodes."""
    rows = np.arange(len(nodes))
    first, second, extra = _chosen(nodes, threshold)
    found = []
    for coordinate, takes in ((first, None), (second, extra)):
        value = signatures[rows, coordinate].astype(np.uint64)
        child = mix(nodes + mix(value + (coordinate.astype(np.uint64) << np.uint64(40))))
        found.append((rows, child) if takes is None else (rows[takes], child[takes]))
    return tuple(np.concatenate(parts) for parts in zip(*found))


def _signature_rows(column: pa.Array) -> np.ndarray:
    raw = b"".join(value.as_py() for value in column)
    return np.frombuffer(raw, np.uint32).reshape(len(column), COORDINATES)


PATHS = "node bigint, set_id bigint"


def _first_paths(sets: DataFrame, runs: int, threshold: float) -> DataFrame:
    @released
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots = _seeds(runs, 2)
        for batch in batches:
            if not batch.num_rows:
                continue
            signatures = _signature_rows(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for root in roots:
                rows, child = _children(
                    np.full(len(ids), root, np.uint64), signatures, threshold
                )
                yield pa.RecordBatch.from_arrays(
                    [_signed(child), pa.array(ids[rows])], ["node", "set_id"]
                )

    return sets.select("set_id", "signature").mapInArrow(spread, PATHS)


def _next_paths(large: DataFrame, threshold: float) -> DataFrame:
    @released
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            ids = batch.column(1).to_numpy(zero_copy_only=False)
            rows, child = _children(nodes, _signature_rows(batch.column(2)), threshold)
            yield pa.RecordBatch.from_arrays(
                [_signed(child), pa.array(ids[rows])], ["node", "set_id"]
            )

    return large.select("node", "set_id", "signature").mapInArrow(spread, PATHS)


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Rows of one key after another, from batches sorted by their first ``keys`` columns."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        fresh = np.zeros(batch.num_rows, bool)
        for at in range(keys):
            values = batch.column(at).to_numpy(zero_copy_only=False)
            fresh[1:] |= values[1:] != values[:-1]
            if held:
                fresh[0] |= bool(held[-1].column(at)[-1].as_py() != values[0])
        begins = np.flatnonzero(fresh)
        start = 0
        for begin in begins:
            if begin > start:
                held.append(batch.slice(start, begin - start))
            if held:
                yield pa.Table.from_batches(held)
            held, start = [], begin
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


class _Trees:
    """Union-find over positions; roots are the least positions."""

    def __init__(self, count: int):
        self.up = list(range(count))

    def root(self, at: int) -> int:
        while self.up[at] != at:
            self.up[at] = self.up[self.up[at]]
            at = self.up[at]
        return at

    def join(self, left: int, right: int) -> None:
        left, right = self.root(left), self.root(right)
        if left != right:
            self.up[max(left, right)] = min(left, right)


def _star(ids: np.ndarray, agree) -> list[tuple[int, int]]:
    """Links that span the same components as all agreeing pairs; at most one per member.

    ``agree(at, others)`` says which of the other positions agree with one position.
    """
    trees = _Trees(len(ids))
    for at in range(len(ids) - 1):
        others = np.arange(at + 1, len(ids))
        for other in others[agree(at, others)]:
            trees.join(at, int(other))
    return [(ids[at], ids[trees.root(at)]) for at in range(len(ids)) if trees.root(at) != at]


LINKS = "a bigint, b bigint"


def _bucket_links(members: DataFrame) -> DataFrame:
    """Loosely similar pairs in each bucket, as spanning links.

    Large buckets come as blocks against blocks: ``left`` and ``right`` number the two blocks of a
    task, ``side`` says from which of them a row is.
    """

    @released
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for group in _grouped(batches, 3):
            ids = group.column(3).to_numpy()
            if len(ids) < 2:
                continue
            ids, first = np.unique(ids, return_index=True)
            picked = group.column(4).combine_chunks().take(pa.array(first))
            sketch = np.frombuffer(b"".join(picked.to_pylist()), np.uint8)
            sketch = sketch.reshape(len(ids), COORDINATES)

            def agree(at, others, sketch=sketch):
                same = (sketch[others] == sketch[at]).sum(axis=1)
                return same >= LOOSE * COORDINATES

            for left, right in _star(ids, agree):
                a.append(left)
                b.append(right)
            if len(a) > 50_000:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
                )
                a, b = [], []
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
        )

    return (
        members.repartition("node", "left", "right").sortWithinPartitions("node", "left", "right")
        .mapInArrow(compare, LINKS)
    )


def _block_pairs(blocks):
    """Array column of (left, right) block numbers in which block ``own`` of ``blocks`` takes part."""
    others = F.sequence(F.lit(0), blocks - 1)
    return F.transform(
        others,
        lambda other: F.struct(
            F.least(F.col("own"), other).alias("left"), F.greatest(F.col("own"), other).alias("right")
        ),
    )


def _saved(frame: DataFrame, name: str) -> DataFrame:
    """Writes a frame to the shared folder and reads it back."""
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.parquet(path)


def candidate_links(sets: DataFrame, threshold: float = THRESHOLD, miss: float = MISS) -> DataFrame:
    """``LINKS`` between sets (``set_id, signature, sketch``) that chosen paths bring together."""
    signatures, sketches = sets.select("set_id", "signature"), sets.select("set_id", "sketch")
    paths = _first_paths(sets, runs_needed(threshold, miss), threshold)
    found = None
    for depth in range(1, DEPTH + 1):
        paths = _saved(paths, "paths")
        sizes = paths.groupBy("node").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        sized = join_lookup(paths, sizes, ["node"])
        if depth < DEPTH:
            leaves = sized.filter(F.col("size") <= SMALL)
        else:
            leaves = sized
        blocks = F.when(F.col("size") <= SMALL, 1).otherwise(
            F.ceil(F.col("size") / TIGHT_BLOCK)
        ).cast("int")
        leaves = leaves.select(
            "node", "set_id", blocks.alias("blocks"),
            F.pmod(F.xxhash64("set_id"), blocks).cast("int").alias("own"),
        ).select("node", F.explode(_block_pairs(F.col("blocks"))).alias("pair"), "set_id")
        members = leaves.select("node", "pair.left", "pair.right", "set_id").join(
            sketches, "set_id"
        ).select("node", "left", "right", "set_id", "sketch")
        links = _bucket_links(members)
        found = links if found is None else found.union(links)
        if depth < DEPTH:
            large = sized.filter(F.col("size") > SMALL).select("node", "set_id")
            paths = _next_paths(large.join(signatures, "set_id"), threshold)
    return found.distinct()


def _family_sets(docs: DataFrame, members: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Shingles of the members' texts, read again from the documents, one row per set.

    Rows that repeat an id and its text are reduced to one before the shingles are made.
    """

    @released
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(5)
            wanted = [batch.column(at).to_numpy(zero_copy_only=False) for at in (3, 4)]
            for start, hashes, at, totals in text_shingles(texts):
                hashes, at = distinct_by_text(hashes, at)
                sizes = np.bincount(at, minlength=len(totals))
                filled = np.flatnonzero(sizes)
                if not len(filled):
                    continue
                begins = np.concatenate(([0], np.cumsum(sizes[filled])[:-1]))
                high, low = (x.view(np.int64) for x in _class_keys(hashes, begins))
                right = (high == wanted[0][start + filled]) & (low == wanted[1][start + filled])
                kept = pa.array(start + filled[right])
                lists = [
                    hashes[begin : begin + size].view(np.int64)
                    for begin, size in zip(begins[right], sizes[filled][right])
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(at).take(kept) for at in range(5)]
                    + [pa.array(lists, pa.list_(pa.int64()))],
                    ["family", "set_id", "shares", "high", "low", "hashes"],
                )

    texts = docs.select(
        F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("doc_hash"),
        F.col(text_col).alias("text"),
    )
    same = (members["text_hash"] == texts["doc_hash"]) & members["id"].eqNullSafe(texts["doc"])
    joined = members.join(texts, same).groupBy("set_id").agg(
        *[F.first(name).alias(name) for name in ("family", "shares", "high", "low", "text")]
    ).select("family", "set_id", "shares", "high", "low", "text")
    return joined.mapInArrow(read, MEMBERS)


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Shared elements of every left set with every right set, by products of 0/1 matrices."""
    sets = [*left, *right]
    row = np.repeat(np.arange(len(sets)), [len(one) for one in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, row = values[order], row[order]
    fresh = np.concatenate(([True], values[1:] != values[:-1]))
    column = np.cumsum(fresh) - 1
    kept = np.bincount(column)[column] > 1
    row, column = row[kept], column[kept]
    total = np.zeros((len(left), len(right)), np.float64)
    if not len(row):
        return total
    width = 8192
    cuts = np.searchsorted(column, np.arange(0, int(column[-1]) + width + 1, width))
    for at in range(len(cuts) - 1):
        low, high = cuts[at], cuts[at + 1]
        if low == high:
            continue
        names, column_at = np.unique(column[low:high], return_inverse=True)
        dense = np.zeros((len(sets), len(names)), np.float32)
        dense[row[low:high], column_at] = 1
        total += dense[: len(left)] @ dense[len(left) :].T
    return total


COUNTS = "set_id bigint, other bigint, linked bigint"


def _exact_links(members: DataFrame, threshold: float) -> DataFrame:
    """``COUNTS``: spanning links (``other``) of pairs at the threshold, and how many rows they add.

    Rows with a null ``other`` carry ``linked``, the documents behind the sets that a set is
    similar to in one pair of blocks.
    """

    @released
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, 3):
            ids, first = np.unique(group.column(3).to_numpy(), return_index=True)
            if len(ids) < 2:
                continue
            pick = pa.array(first)
            own = group.column(4).combine_chunks().take(pick).to_numpy()
            shares = group.column(5).combine_chunks().take(pick).to_numpy()
            lists = group.column(6).combine_chunks().take(pick)
            sets = [lists[at].values.to_numpy() for at in range(len(ids))]
            left, right = group.column(1)[0].as_py(), group.column(2)[0].as_py()
            del group, lists
            on_left = np.flatnonzero(own == left)
            on_right = np.flatnonzero(own == right)
            if not len(on_left) or not len(on_right):
                continue
            common = _common([sets[x] for x in on_left], [sets[x] for x in on_right])
            sizes = np.array([len(one) for one in sets], np.float64)
            union = sizes[on_left][:, None] + sizes[on_right][None, :] - common
            similar = common >= threshold * union - 1e-9
            if left == right:
                np.fill_diagonal(similar, False)
            trees = _Trees(len(ids))
            for x, y in zip(*np.nonzero(similar)):
                trees.join(int(on_left[x]), int(on_right[y]))
            linked = np.zeros(len(ids), np.int64)
            linked[on_left] += similar @ shares[on_right]
            if left != right:
                linked[on_right] += similar.T @ shares[on_left]
            some = np.flatnonzero(linked)
            roots = np.array([trees.root(int(at)) for at in some], np.int64)
            star = some[roots != some]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate((ids[some], ids[star]))),
                 pa.array([None] * len(some) + ids[roots[roots != some]].tolist(), pa.int64()),
                 pa.array(np.concatenate((linked[some], np.zeros(len(star), np.int64))))],
                ["set_id", "other", "linked"],
            )

    return (
        members.repartition("family", "left", "right")
        .sortWithinPartitions("family", "left", "right").mapInArrow(compare, COUNTS)
    )


def _resolved(
    docs: DataFrame, id_col: str, text_col: str, threshold: float, miss: float
) -> tuple[DataFrame, DataFrame]:
    """Rows with words and what became of them, and rows without words.

    The first frame has ``id, text_hash, copy_id, class_id, class_hash, n_links``; ``class_hash``
    is the text hash of the row that the class is named by, the one with the least id.
    """
    spark = ship(docs.sparkSession)
    shared_dir(spark)
    rows = _saved(shingle_sets(docs, id_col, text_col), "sets")
    named = rows.filter("high is not null")
    classes = _saved(
        named.groupBy("high", "low").agg(
            F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("head"),
            F.count(F.lit(1)).alias("shares"),
            F.first("signature").alias("signature"), F.first("sketch").alias("sketch"),
        ).select(
            "high", "low", "head.id", "head.text_hash", "shares", "signature", "sketch",
            F.xxhash64("high", "low").alias("set_id"),
        ),
        "classes",
    )
    links = _saved(candidate_links(classes, threshold, miss), "links")
    families = components(links)
    members = families.select(F.col("node").alias("set_id"), F.col("root").alias("family")).join(
        classes.drop("signature", "sketch"), "set_id"
    )
    members = _saved(_family_sets(docs, members, id_col, text_col), "members")
    sizes = members.groupBy("family").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum(F.size("hashes")) / BLOCK_SHINGLES)
        ).cast("int").alias("blocks")
    )
    dealt = join_lookup(members, sizes, ["family"]).withColumn(
        "own", F.pmod(F.xxhash64("set_id", F.lit(1)), F.col("blocks")).cast("int")
    )
    dealt = dealt.select(
        "family", F.explode(_block_pairs(F.col("blocks"))).alias("pair"), "set_id", "own", "shares",
        "hashes",
    ).select("family", "pair.left", "pair.right", "set_id", "own", "shares", "hashes")
    counts = _saved(_exact_links(dealt, threshold), "counts")
    groups = components(
        counts.filter("other is not null").select(F.col("set_id").alias("a"), F.col("other").alias("b"))
    )
    linked = counts.groupBy("set_id").agg(F.sum("linked").alias("linked"))
    of_class = (
        classes.drop("signature", "sketch")
        .join(groups.withColumnRenamed("node", "set_id"), "set_id", "left")
        .join(linked, "set_id", "left")
        .withColumn("root", F.coalesce("root", "set_id"))
    )
    heads = of_class.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("head")
    )
    of_class = _saved(
        join_lookup(of_class, heads, ["root"]).select(
            "high", "low", F.col("id").alias("copy_id"), F.col("head.id").alias("class_id"),
            F.col("head.text_hash").alias("class_hash"),
            (F.coalesce("linked", F.lit(0)) + F.col("shares") - 1).alias("n_links"),
        ),
        "classes",
    )
    narrow = named.select("id", "text_hash", "high", "low")
    return join_lookup(narrow, of_class, ["high", "low"]), rows.filter("high is null")


def similar_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    miss: float = MISS,
) -> DataFrame:
    """One row per input row: ``id, class_id, copy_id, n_links``.

    ``class_id`` is the least id among all texts that links at the threshold connect, directly or
    over others, ``copy_id`` the least id among the texts with the same shingles. ``n_links``
    counts the other rows whose shingles have a Jaccard similarity of at least the threshold, rows
    with the same shingles included. Shingles are five consecutive words; words are runs of ASCII
    letters, digits and non-ASCII characters, ASCII letters in lower case. A text of one to four
    words has one shingle of all its words. A text without words, a null one too, is in a class of
    its own row and has no links. Rows may repeat ids or have none: null ids come last among the
    members, and a class that has no other id has a null one.
    """
    with_words, without = _resolved(docs, id_col, text_col, threshold, miss)
    columns = ["id", "class_id", "copy_id", "n_links"]
    return with_words.select(*columns).union(without.select(
        "id", F.col("id").alias("class_id"), F.col("id").alias("copy_id"),
        F.lit(0).cast("long").alias("n_links"),
    ))


def one_per_group(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    miss: float = MISS,
) -> DataFrame:
    """``docs`` with the row of the least id of every class; rows without words all stay.

    Only documents whose text may be among those that go are joined with the decisions, as a bitmap
    of fixed size tells; the others are not shuffled. Of rows that repeat both the id and the text
    one stays.
    """
    with_words, _ = _resolved(docs, id_col, text_col, threshold, miss)
    stays = F.col("id").eqNullSafe(F.col("class_id")) & (F.col("text_hash") == F.col("class_hash"))
    decided = _saved(
        with_words.select("id", "text_hash", stays.alias("stays"))
        .groupBy("id", "text_hash").agg(F.first("stays").alias("stays"), F.count(F.lit(1)).alias("n"))
        .filter("not stays or n > 1")
        .select(F.col("id").alias("__near_id"), F.col("text_hash").alias("__near_hash"),
                F.col("stays").alias("__near_stays")),
        "decided",
    )
    known = bitmaps.tester(docs.sparkSession, bitmaps.of(decided, "__near_hash"))
    marked = docs.withColumn("__near_text", F.xxhash64(F.col(text_col)))
    marked = marked.withColumn("__near_known", known("__near_text"))
    same = (F.col("__near_text") == F.col("__near_hash")) & F.col(id_col).cast("long").eqNullSafe(
        F.col("__near_id")
    )
    joined = marked.filter("__near_known").join(decided, same, "left")
    single = joined.filter("__near_stays is null")
    repeated = joined.filter("__near_stays").dropDuplicates(["__near_id", "__near_hash"])
    kept = [marked.filter("not __near_known"), single, repeated]
    return reduce(DataFrame.union, [frame.select(*docs.columns) for frame in kept])
