"""Sums of small matrices over a table's partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def partition_sums(
    rows: DataFrame, work: Callable[[pa.RecordBatch], np.ndarray], shape: tuple[int, int]
) -> np.ndarray:
    """The sum of ``work(batch)``, a matrix of ``shape``, over all batches of ``rows``.

    Each task adds its batches up and sends one row per row of the matrix;
    these are added per row number, so no task gets more than one short vector
    from each other task, and the driver gets one matrix.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += work(batch)
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(shape[0]), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
                names=["i", "line"],
            )

    def add(key: tuple, table: pa.Table) -> pa.Table:
        line = np.sum(np.stack([np.asarray(x.values) for x in table.column("line").combine_chunks()]), axis=0)
        return pa.table({"i": pa.array([key[0].as_py()], pa.int32()), "line": pa.array([line], pa.list_(pa.float64()))})

    schema = "i int, line array<double>"
    out = np.zeros(shape)
    for row in rows.mapInArrow(partial, schema).groupBy("i").applyInArrow(add, schema).collect():
        out[row["i"]] = row["line"]
    return out
