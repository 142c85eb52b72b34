"""Bitmaps of fixed size over 64-bit hashes: what is surely not in a table needs no join with it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opdiag.llm.shipping import ship

#: Bits of a bitmap, 2 MiB, whatever the size of the table. Beyond some ten million hashes it lets
#: most rows through; the join that follows decides in any case.
BITS = 24
_WORD = 6


def of(rows: DataFrame, column: str) -> np.ndarray:
    """Bits of the leading digits of a hash column; at most 2 ** 18 longs reach the driver."""
    bit = F.shiftrightunsigned(F.col(column), 64 - BITS)
    one = F.expr(f"shiftleft(1L, cast(bit & {(1 << _WORD) - 1} as int))")
    words = (
        rows.select(F.shiftrightunsigned(bit, _WORD).alias("word"), bit.alias("bit"))
        .groupBy("word").agg(F.bit_or(one).alias("bits")).collect()
    )
    out = np.zeros(1 << (BITS - _WORD), np.int64)
    for row in words:
        out[row.word] = row.bits
    return out.view(np.uint8)


def has(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bits of unsigned hashes are set."""
    bit = hashes >> np.uint64(64 - BITS)
    byte = bitmap[(bit >> np.uint64(3)).astype(np.int64)]
    return ((byte >> (bit & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)


def tester(spark, bitmap: np.ndarray):
    """Function from a column of hashes to whether the bitmap may know them."""
    shared = ship(spark).sparkContext.broadcast(bitmap)

    @F.arrow_udf("boolean")
    def known(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            hashes = batch.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            yield pa.array(has(shared.value, hashes))

    return known
