"""Bitmaps of fixed size that tell tasks which keys a table surely does not have."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap, whatever its table's size; a fuller one only lets more rows pass.
BITS = 1 << 23
_HASHES = 2


def places(key: Column) -> list[Column]:
    """The bits that a key sets, as columns place_0, place_1."""
    return [
        F.pmod(F.xxhash64(F.lit(k + 1), key), F.lit(BITS)).alias(f"place_{k}")
        for k in range(_HASHES)
    ]


def bitmap(table: DataFrame, key: Column) -> np.ndarray:
    """The bits of all keys; at most ``BITS / 32`` words reach the driver."""
    words = (
        table.select(F.explode(F.array(*places(key))).alias("at"))
        .groupBy(F.shiftright("at", 5).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, int(at % 32)))").alias("bits"))
        .toPandas()
    )
    bits = np.zeros(BITS // 32, dtype=np.uint32)
    bits[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64)
    return bits


def hits(bits: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
    """Rows of ``batch`` whose ``places`` are all set."""
    found = np.ones(batch.num_rows, dtype=bool)
    for k in range(_HASHES):
        at = batch.column(f"place_{k}").to_numpy()
        found &= (bits[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1
    return found
