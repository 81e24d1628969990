"""Small linear algebra on tables whose rows hold a short array each: row-local products and sums of products."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Batch functions travel with the task, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def rows_of(column: pa.Array) -> np.ndarray:
    """A list column as a matrix. All lists have one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def lists_of(matrix: np.ndarray) -> pa.Array:
    matrix = np.ascontiguousarray(matrix, np.float64)
    offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))


def summed(table: DataFrame, columns: list[str], part: Callable[..., np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """Sum of ``part(matrix of each column)`` over batches: once per task, then by place in Spark.

    One array of ``shape`` reaches the driver; tasks shuffle one row of sums for each place.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = part(*[rows_of(batch.column(i)) for i in range(len(columns))])
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([lists_of(total.reshape(1, -1))], ["sums"])

    places = table.select(*columns).mapInArrow(run, "sums array<double>").select(F.posexplode("sums").alias("place", "value"))
    found = places.groupBy("place").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(int(np.prod(shape)))
    for row in found:
        out[row.place] = row.value
    return out.reshape(shape)


def mapped(table: DataFrame, keys: list[str], columns: list[str], make: Callable[..., list[np.ndarray]], names: list[str]) -> DataFrame:
    """``keys`` and new arrays ``names``, made from the matrices of ``columns`` a batch at a time."""
    kinds = {f.name: f.dataType.simpleString() for f in table.schema}
    schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in keys], *[f"{n} array<double>" for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = make(*[rows_of(batch.column(len(keys) + i)) for i in range(len(columns))])
                own = [batch.column(i) for i in range(len(keys))]
                yield pa.RecordBatch.from_arrays([*own, *[lists_of(m) for m in made]], [*keys, *names])

    return table.select(*keys, *columns).mapInArrow(run, schema)
