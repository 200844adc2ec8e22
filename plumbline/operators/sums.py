"""Adding up arrays that tasks send, in two levels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP = 64  # tasks whose arrays are added up together


def array_sums(sent: DataFrame, key: str, length: int) -> dict[int, np.ndarray]:
    """Sums of the arrays ``sums`` (all of ``length``) per value of the integer ``key``.

    Every task sends one array per key. GROUP tasks' arrays meet in one task and leave it as one array
    per key, so the driver adds up tasks / GROUP arrays of each key, however many rows there are.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            arrays = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) if batch.num_rows else ()
            for k, values in zip(batch.column(0).to_pylist(), arrays):
                totals[k] = totals[k] + values if k in totals else values.copy()
        lists = pa.array(list(totals.values()), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), lists], names=[key, "sums"])

    schema = f"{key} int, sums array<double>"
    together = sent.withColumn("__group", F.floor(F.spark_partition_id() / GROUP))
    parts = together.repartition("__group").select(key, "sums").mapInArrow(add, schema)
    out: dict[int, np.ndarray] = {}
    for r in parts.toLocalIterator():
        values = np.array(r["sums"])
        out[r[key]] = out[r[key]] + values if r[key] in out else values
    assert all(len(v) == length for v in out.values())
    return out
