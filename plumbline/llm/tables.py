"""Reading the corpus tables, passing rows through Arrow in bounded pieces, checked broadcasts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.session import scratch_path

PIECE_ROWS = 1024
PIECE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of a table with any other columns; a NULL text becomes empty."""
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that start as given and clash with none of ``df``."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def pieces(batches: Iterator[pa.RecordBatch], text: int, nbytes: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of at most PIECE_ROWS rows and about ``nbytes`` bytes in column ``text``. Memory that Arrow
    no longer uses is given back at the end, as the worker goes on to other work."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
        start, n = 0, batch.num_rows
        while start < n:
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + nbytes, "right"))
            stop = min(max(stop, start + 1), start + PIECE_ROWS, n)
            yield batch.slice(start, stop - start)
            start = stop
    pa.default_memory_pool().release_unused()


def map_pieces(
    df: DataFrame,
    f: Callable[..., tuple[list, ...]],
    inputs: Sequence[str],
    outputs: dict[str, str],
    keep: Sequence[str] | None = None,
    nbytes: int = PIECE_BYTES,
) -> DataFrame:
    """Add or replace the columns ``outputs`` (name to type) of ``df``, piece by piece.

    ``f`` gets the columns ``inputs`` of a piece as lists (the first is the text that bounds the
    piece) and returns the output columns as sequences or Arrow arrays. The columns ``keep`` (all
    unless given) pass through as they are.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    names = df.columns
    schema = StructType([x for x in df.schema if (keep is None or x.name in keep) and x.name not in outputs])
    for field in StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in outputs.items())):
        schema = schema.add(field)
    source = [names.index(x.name) if x.name not in outputs else None for x in schema]
    at = [names.index(x) for x in inputs]

    def run(batches):
        types = to_arrow_schema(schema).types
        for piece in pieces(batches, at[0], nbytes):
            made = iter(f(*[piece.column(i).to_pylist() for i in at]))
            arrays = []
            for i, kind in zip(source, types):
                column = piece.column(i) if i is not None else next(made)
                arrays.append(column if isinstance(column, pa.Array) else pa.array(column, kind))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return df.mapInArrow(run, schema)


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared scratch folder: computed once, and its lineage cut."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> Iterator[DataFrame]:
    """The frame as a table in the shared scratch folder whose rows lie in buckets of ``key``, so that joining
    or cogrouping it by ``key`` shuffles the other side only. The catalog forgets it at the end."""
    spark, table_name = df.sparkSession, f"plumbline_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, key).option("path", scratch_path(spark, name)).format("parquet").saveAsTable(table_name)
    try:
        yield spark.table(table_name)
    finally:
        spark.sql(f"DROP TABLE {table_name}")


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a job that has ended go at once; elsewhere Spark keeps them until the
    driver's JVM has collected the frames they belong to. For jobs that end in a written table."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def largest(df: DataFrame, value: str, limit: int) -> DataFrame:
    """The rows of the largest positive values, at most ``limit`` of them: values are put in classes of
    a sixteenth of a power of two, and the upper classes that fit are taken whole. Nothing is sorted,
    and only class sizes come to the driver. ``df`` is read twice, so it should be a written table."""
    step = F.floor(F.log2(F.col(value).cast("double")) * 16)
    sizes = sorted(((r["step"], r["count"]) for r in df.groupBy(step.alias("step")).count().collect()), reverse=True)
    least, total = None, 0
    for at, n in sizes:
        total += n
        if total > limit:
            break
        least = at
    return df.where(step >= least) if least is not None else df.where(F.lit(False))
