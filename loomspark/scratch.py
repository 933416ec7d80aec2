"""Tables written to the shared folder: they cut lineage, survive lost executors and can be removed."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_OWN: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the session names in spark.checkpoint.dir. Where it is unset, a folder of this machine
    serves a local master; on a cluster that is an error, as executors would each write to a disk of their own."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="loomspark-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder; what is left there goes when the driver ends."""
    own = _OWN.get(root := scratch_root(spark))
    if own is None:
        own = _OWN[root] = f"{root}/loomspark-{uuid.uuid4().hex}"
        atexit.register(_quietly_remove, spark, own)
    return f"{own}/{name}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _quietly_remove(spark: SparkSession, path: str) -> None:
    try:
        if spark.sparkContext._jsc is not None:
            remove(spark, path)
    except Exception:  # the session may be gone; a cluster's own clean-up then applies
        pass


#: Shuffle files go with the query that wrote them, as with Spark's own writers, not when the driver collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of Arrow data in a row group.
GROUP = 8 << 20
_PLAIN = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.BinaryType)


def _plain(kind: T.DataType) -> bool:
    """Do Arrow and Spark give this type the same form in Parquet, whatever the session's settings?"""
    if isinstance(kind, T.StructType):
        return len(kind) > 0 and all(_plain(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _plain(kind.elementType)
    return isinstance(kind, _PLAIN) or kind == T.StringType()


def _local(spark: SparkSession, path: str) -> str | None:
    """The path without its scheme, if it is one of the machines' own file systems."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return at.toUri().getPath() if fs.getUri().getScheme() == "file" else None


def _to_files(folder: str, names: list[str]):
    """Writes a partition, its columns under these names, to a file of its own below folder; the file's name goes out when it is complete."""

    def to_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, writer, held, size = f"part-{uuid.uuid4().hex}.zstd.parquet", None, [], 0
        for batch in batches:
            if not len(batch):
                continue
            batch = batch.rename_columns(names)
            if writer is None:
                os.makedirs(folder, exist_ok=True)
                writer = pq.ParquetWriter(f"{folder}/{name}", batch.schema, compression="zstd", compression_level=3, store_schema=False)
            held.append(batch)
            size += batch.nbytes
            if size >= GROUP:
                writer.write_table(pa.Table.from_batches(held))
                held, size = [], 0
        if writer is not None:
            if held:
                writer.write_table(pa.Table.from_batches(held))
            writer.close()
            held = None
            pa.default_memory_pool().release_unused()
            yield pa.RecordBatch.from_pydict({"name": [name]})

    return to_files


class Stored:
    """A DataFrame's rows as Parquet in the shared folder.

    On file:// Hadoop starts several chmod for each file and folder, and until such a child has loaded its own program the
    executor's memory counts twice. So there the files are written by Arrow: below _staging, from which the driver
    moves those of the tasks that counted; what repeated or lost tasks wrote is never read. Other stores, and types that Arrow
    may write differently, go through Spark's writer; so does a native table, which is made without Python on the executors.
    """

    def __init__(self, df: DataFrame, name: str, *, native: bool = False):
        self.spark, self.path, self.schema = df.sparkSession, scratch_path(df.sparkSession, name), df.schema
        folder = _local(self.spark, self.path)
        if native or folder is None or not _plain(self.schema):
            df.write.option("compression", "zstd").parquet(self.path)
            return
        staging = f"{folder}/_staging"
        os.makedirs(staging)
        rows = df.toDF(*[f"c{i}" for i in range(len(df.columns))])  # mapInArrow does not find names with dots
        before = self.spark.conf.get(_CLEANUP, None)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            parts = rows.mapInArrow(_to_files(staging, df.columns), "name string").collect()
        finally:
            self.spark.conf.unset(_CLEANUP) if before is None else self.spark.conf.set(_CLEANUP, before)
        for (part,) in parts:
            os.rename(f"{staging}/{part}", f"{folder}/{part}")
        shutil.rmtree(staging, ignore_errors=True)

    def df(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def drop(self) -> None:
        remove(self.spark, self.path)
