"""Embedding vectors as exact integers, and exact sums over all of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import stored

SCALE = 1024
# Larger components would let the sums of squares of SUMMED vectors leave 64 bits.
LARGEST, SUMMED = 1 << 24, 1024


def integer_vectors(vectors: DataFrame, dims: int, vec_id: str = "vec_id", embedding: str = "embedding", shift: int = 0) -> DataFrame:
    """(vec_id, x): component c as floor(1024 * c) + shift, for the vectors of `dims` components that are all finite numbers.

    Written to the shared folder, as every step over vectors reads them several times. A component of 16,384 or more in
    absolute value ends in an error that says so.
    """
    c, text = F.col(embedding), F.lit(f"a component is beyond +-{LARGEST // SCALE}, more than exact sums allow")

    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    def whole(x):
        d = x.cast("double")
        return F.when(F.abs(d) < LARGEST / SCALE, F.floor(d * SCALE).cast("int") + shift).otherwise(F.raise_error(text).cast("int"))

    kept = vectors.filter((F.size(c) == dims) & F.forall(c, finite))
    return stored(kept.select(F.col(vec_id).alias("vec_id"), F.transform(c, whole).alias("x")), "integer-vectors")


def matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    """The batch's vectors, one a row, as 64-bit integers."""
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def exact_sums(vectors: DataFrame, dims: int, width: int, of_batch: Callable[[np.ndarray], np.ndarray]) -> list[int]:
    """Sums over all vectors of `width` integers that `of_batch` adds up for a batch of them.

    `of_batch` gets SUMMED vectors at most. A task sends `width` partial sums, Spark adds them by place, and the driver gets
    `width` numbers whatever the input.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = (b.slice(i, SUMMED) for b in batches for i in range(0, b.num_rows, SUMMED))
        parts = (of_batch(matrix(part, dims)).astype(object) for part in slices)
        total = reduce(lambda a, b: b if a is None else a + b, parts, None)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([str(v) for v in total])], names=["place", "value"])

    partial = vectors.select("x").mapInArrow(run, "place int, value string")
    rows = partial.groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    found = {r["place"]: int(r["value"]) for r in rows}
    return [found.get(i, 0) for i in range(width)]
