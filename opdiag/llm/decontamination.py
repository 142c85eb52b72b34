"""Benchmark items inside documents, by size-partitioned MinHash containment search.

Items are partitioned by the size of their shingle sets, in powers of two. The sketch of an item is
the bottom of its shingles under one random permutation, shingles that many items share last, and its length belongs to the partition:
with containment ``t`` and at most ``u`` shingles, ``floor((1 - t) * u) + 1`` minima. A document
that holds the share ``t`` of an item can miss at most ``(1 - t) * u`` of its shingles, so it holds at
least one minimum of the sketch: the search has no false negatives, however long the document is.
Candidates are then decided by exact shingle containment.

Documents are read once, and only shingles that some item may have leave the first step: a bitmap
of fixed size over the items' shingles tells. All later joins carry hits, never texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opdiag.llm import bitmaps
from opdiag.llm.shipping import released, ship
from opdiag.llm.texts import SHINGLE_WORDS, distinct_by_text, text_windows
from opdiag.operators.sized import join_lookup
from opdiag.session import scratch_path

THRESHOLD = 0.8
SHARED = 8  # items that may have a shingle before it comes last in their sketches
HITS = "id bigint, text_hash bigint, shingle bigint"


def _narrow(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return rows.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_hash"),
        F.col(text_col).alias("text"),
    )


def _item_shingles(rows: DataFrame) -> DataFrame:
    """``HITS`` with ``size``, the words of a shingle; a short item has one shingle of all its words."""

    @released
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, names = batch.column(0), batch.column(1)
            every = range(1, SHINGLE_WORDS + 1)
            for start, hashes, at, size, totals in text_windows(batch.column(2), every):
                own = size == np.minimum(totals[at], SHINGLE_WORDS)
                hashes, at = distinct_by_text(hashes[own], at[own])
                rows_at = pa.array(at + start)
                sizes = np.minimum(totals[at], SHINGLE_WORDS).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(rows_at), names.take(rows_at), pa.array(hashes.view(np.int64)),
                     pa.array(sizes)],
                    ["id", "text_hash", "shingle", "size"],
                )

    return rows.mapInArrow(split, f"{HITS}, size int")


def _hits(rows: DataFrame, bitmap: np.ndarray, sizes: list[int]) -> DataFrame:
    """``HITS`` of texts: their windows of the given sizes whose bit is set."""

    @released
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, names = batch.column(0), batch.column(1)
            for start, hashes, at, *_ in text_windows(batch.column(2), sizes):
                kept = bitmaps.has(bitmap, hashes)
                hashes, at = distinct_by_text(hashes[kept], at[kept])
                rows_at = pa.array(at + start)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(rows_at), names.take(rows_at), pa.array(hashes.view(np.int64))],
                    ["id", "text_hash", "shingle"],
                )

    return rows.mapInArrow(split, HITS)


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``id, text_hash, item_id, n_shingles, n_shared`` per text and item contained in it.

    A text contains an item if it has at least the share ``threshold`` of the item's distinct
    shingles. Shingles are five consecutive words; words are runs of ASCII letters, digits and
    non-ASCII characters, ASCII letters in lower case. An item of one to four words is one shingle
    of all its words, which a text contains where the words follow one another. Items and texts
    without words, and null ones, match nothing. Rows with the same id and text give one row, rows
    with the same id and different texts are judged one by one (``text_hash`` tells them apart).
    Rows without an id are judged too. Items with the same id are told apart by their texts.
    """
    spark = ship(docs.sparkSession)
    path = scratch_path(spark, "item-shingles")
    _item_shingles(_narrow(items, item_id_col, item_text_col)).distinct().write.parquet(path)
    stored = spark.read.parquet(path)
    wanted = sorted(row.size for row in stored.select("size").distinct().collect()) or [SHINGLE_WORDS]
    item_shingles = stored.select(
        F.xxhash64("id", "text_hash").alias("item"), F.col("id").alias("item_id"), "shingle"
    )
    sizes = item_shingles.groupBy("item", "item_id").agg(F.count(F.lit(1)).alias("n_shingles"))
    path = scratch_path(spark, "hits")
    known = bitmaps.of(item_shingles, "shingle")
    _hits(_narrow(docs, id_col, text_col), known, wanted).distinct().write.parquet(path)
    hits = spark.read.parquet(path)
    by_text = hits.select("text_hash", "shingle").distinct()
    candidates = (
        join_lookup(by_text, _sketches(item_shingles, sizes, threshold), ["shingle"])
        .select("text_hash", "item").distinct()
    )
    shared = (
        join_lookup(candidates, _listed(item_shingles), ["item"])
        .select("text_hash", "item", F.explode("shingles").alias("shingle"))
        .join(by_text, ["text_hash", "shingle"])
        .groupBy("text_hash", "item").agg(F.count(F.lit(1)).alias("n_shared"))
    )
    contained = join_lookup(shared, sizes, ["item"]).filter(
        F.col("n_shared") >= threshold * F.col("n_shingles") - 1e-9
    )
    owners = hits.select("id", "text_hash").distinct()
    return owners.join(contained, "text_hash").select(
        "id", "text_hash", "item_id", "n_shingles", "n_shared"
    )


def _sketches(item_shingles: DataFrame, sizes: DataFrame, threshold: float) -> DataFrame:
    """``shingle, item``: the shingles in the sketch of each item.

    The order of the permutation counts among shingles that at most ``SHARED`` items have; those
    that more items have come last. Any choice of so many shingles misses nothing, and this one does
    not bring every text with a common phrase together with every item that has it.
    """
    # Partitions hold sizes over 2 ** (k - 1) up to 2 ** k; the upper end sets the sketch's length.
    largest = F.pow(F.lit(2.0), F.ceil(F.log2("n_shingles") - 1e-9))
    lengths = sizes.select(
        "item", (F.floor((1 - threshold) * largest + 1e-9) + 1).cast("int").alias("length")
    )
    common = item_shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("n_items"))
    counted = join_lookup(item_shingles.select("item", "shingle"), common, ["shingle"])
    place = F.struct(
        (F.col("n_items") > SHARED).alias("common"), F.xxhash64("shingle", F.lit(97)).alias("at"), "shingle"
    )
    ordered = counted.groupBy("item").agg(F.sort_array(F.collect_list(place)).alias("minima"))
    return (
        ordered.join(lengths, "item")
        .select("item", F.explode(F.slice("minima", F.lit(1), F.col("length"))).alias("one"))
        .select("one.shingle", "item")
    )


def _listed(item_shingles: DataFrame) -> DataFrame:
    """One row per item with its shingles; an item is one text, so the list is bounded by it."""
    return item_shingles.groupBy("item").agg(F.collect_list("shingle").alias("shingles"))


def without_items(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose text contains an item; see ``contained_items``."""
    path = scratch_path(docs.sparkSession, "contaminated")
    contained_items(docs, items, **options).select(
        F.col("text_hash").alias("__item_hash")
    ).distinct().write.parquet(path)
    found = docs.sparkSession.read.parquet(path)
    text_col = options.get("text_col", "text")
    return docs.join(found, F.xxhash64(F.col(text_col)) == F.col("__item_hash"), "left_anti")
