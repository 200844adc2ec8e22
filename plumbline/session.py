"""Session-level settings: where scratch tables go and how frames are kept."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

from pyspark import Broadcast, StorageLevel, cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession

SEED = 20250531  # fixed value: the seed every seeded step uses by default

_KEEP = StorageLevel.MEMORY_AND_DISK


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster a
    machine-local folder would be invisible to the other executors, so that is refused.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if root:
        return root
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="plumbline-")
    sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the scratch root that no earlier call has returned."""
    return f"{scratch_root(spark).rstrip('/')}/plumbline/{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table this library wrote and no longer reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def keep(df: DataFrame) -> DataFrame:
    """Cache a frame that several jobs read; lost blocks are recomputed from its plan."""
    return df.persist(_KEEP)


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Give a frame read from few file blocks one partition per core; larger inputs stay as read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *cols) if df.rdd.getNumPartitions() < cores else df


def fetched(df: DataFrame) -> Iterator[Row]:
    """The rows of a result that may be large, which all tasks compute before the driver reads them part by
    part. An iterator alone would have one task run after the other."""
    done = keep(df.select("*"))  # a frame of its own, as one that ran before holds on to its old plan
    try:
        done.count()
        yield from done.toLocalIterator()
    finally:
        done.unpersist()


class Shared:
    """A broadcast whose classes travel with it, so executors need no copy of the package. A worker unpacks
    it once and keeps it for its later tasks."""

    def __init__(self, broadcast: Broadcast):
        self.broadcast = broadcast

    @property
    def value(self):
        if not hasattr(self.broadcast, "unpacked"):
            self.broadcast.unpacked = cloudpickle.loads(self.broadcast.value)
        return self.broadcast.unpacked

    def destroy(self) -> None:
        self.broadcast.destroy()


def share(spark: SparkSession, value) -> Shared:
    """Broadcast a value; what is shared must be of a checked size."""
    return Shared(spark.sparkContext.broadcast(cloudpickle.dumps(value)))
