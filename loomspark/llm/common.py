"""Helpers shared by the operators: tables, scratch space in shared storage, column clashes."""

from __future__ import annotations

import gc
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.scratch import Stored, scratch_path


__all__ = ["Stored", "bounded_batches", "finished", "free_name", "groups", "release", "scratch_path", "table", "text_or_empty", "tokenizer_path", "without"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    """The text, with null read as the empty string."""
    return F.coalesce(F.col(name), F.lit(""))


def bounded_batches(spark: SparkSession, most: str = "8m") -> None:
    """Texts reach Python workers in batches of at most so many bytes, where the session still has Spark's
    default of 64 MB: a worker holds a batch several times over (as Arrow, as strings, as results)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key).lower() in ("67108864b", "67108864", "64m", "64mb"):
        spark.conf.set(key, most)


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of finished steps now, not when the driver happens to collect its garbage, and
    executors give back the heap that these steps took: one short task for each core collects theirs."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    n = spark.sparkContext.defaultParallelism
    collected = F.call_function("java_method", F.lit("java.lang.System"), F.lit("gc"))
    spark.range(0, n, 1, n).select(collected).write.format("noop").mode("overwrite").save()


def finished(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, made once and stored: whoever reads them does so after the heap that they took is given back."""
    rows = Stored(df, name)
    release(df.sparkSession)
    return rows.df()


def free_name(taken: list[str], want: str) -> str:
    """want, or the first of want_1, want_2 ... that no column has, whatever the case."""
    low, name, i = {x.lower() for x in taken}, want, 0
    while name.lower() in low:
        i += 1
        name = f"{want}_{i}"
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """Output columns replace input columns of the same name, whatever the case."""
    gone = {x.lower() for x in names}
    return df.select(*[f"`{c}`" for c in df.columns if c.lower() not in gone])


def tokenizer_path(name: str) -> str:
    """A public vocabulary file; LOOMSPARK_TOKENIZERS may name another folder."""
    if folder := os.environ.get("LOOMSPARK_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def groups(batches, keys: list[str]):
    """The groups of Arrow batches sorted by keys, each as one table; groups must be small by design."""
    import numpy as np
    import pyarrow as pa

    rest = None
    for batch in batches:
        table_ = pa.Table.from_batches([batch])
        if rest is not None:
            table_ = pa.concat_tables([rest, table_])
        if not len(table_):
            continue
        change = np.zeros(len(table_) - 1, bool)
        for k in keys:
            values = table_[k].to_numpy()
            change |= values[1:] != values[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1)]
        for a, b in zip(cuts, cuts[1:]):
            yield table_.slice(a, b - a)
        rest = table_.slice(cuts[-1])
    if rest is not None and len(rest):
        yield rest
