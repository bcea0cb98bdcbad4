"""A filter of fixed size that tells which rows may have a partner, so that only those are moved."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytehash import mix

#: Fixed: 4 MB whatever the input. A filter that fills up lets more rows through and changes no result.
FILTER_BITS = 1 << 25


def _places(keys: pa.Array) -> np.ndarray:
    return mix(keys.to_numpy(zero_copy_only=False).view(np.uint64)) % np.uint64(FILTER_BITS)


def key_filter(keys: DataFrame) -> Callable[[pa.Array], np.ndarray]:
    """From a frame with one bigint column without nulls: whether each of given keys may be among them.

    Each task sends the bytes it has set; Spark merges them, so the driver reads at most one row per byte, in one job.
    """
    bits = np.zeros(FILTER_BITS // 8, np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(FILTER_BITS, bool)
        for batch in batches:
            own[_places(batch.column(0))] = True
        packed = np.packbits(own)
        at = np.flatnonzero(packed)
        if len(at):
            yield pa.record_batch([at.astype(np.int32), packed[at].astype(np.int32)], ["at", "byte"])

    found = keys.mapInArrow(run, "at int, byte int").groupBy("at").agg(F.bit_or("byte").alias("byte")).toArrow()
    bits[found.column("at").to_numpy()] = found.column("byte").to_numpy()

    def maybe(column: pa.Array) -> np.ndarray:
        at = _places(column)
        return ((bits[at >> np.uint64(3)] >> (7 - (at & np.uint64(7))).astype(np.uint8)) & 1).astype(bool)

    return maybe


def key_condition(keys: DataFrame) -> Callable[[Column], Column]:
    """The same as a condition that hands only the key to Python: what else a row holds, such as its text, stays in the JVM."""
    maybe = key_filter(keys)

    def may_be(column: pa.Array) -> pa.Array:
        return pa.array(maybe(column))

    return F.arrow_udf(may_be, "boolean")
