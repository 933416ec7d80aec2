"""Exact duplicates: a canonical hash, the first row by ordinal wins, hashes seen before lose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.functions.text import lines, rstrip, strip


def canonical_hash(text: Column) -> Column:
    """SHA-256 of the text without white space around it and at the ends of its lines."""
    return F.sha2(F.array_join(F.transform(lines(strip(text)), rstrip), "\n"), 256)


def first_by_ordinal(df: DataFrame, key: str, ordinal: list[str], out: str = "is_first") -> DataFrame:
    """df with out: is this the first row with its key? False for a null key.

    The least ordinal of each key comes from an aggregate that combines before the shuffle, and is joined back by the
    ordinal, which is unique. So a key with a third of the rows never meets in one task."""
    place = F.struct(*[F.col(c).alias(f"first{i}__") for i, c in enumerate(ordinal)])
    first = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(place).alias("x")).select("x.*", F.lit(True).alias("hit__"))
    same = F.lit(True)
    for i, c in enumerate(ordinal):
        same = same & (df[c] == first[f"first{i}__"])
    joined = df.join(first, same, "left").withColumn(out, F.coalesce("hit__", F.lit(False)))
    return joined.drop("hit__", *[f"first{i}__" for i in range(len(ordinal))])


def drop_seen(df: DataFrame, seen: DataFrame | None, key: str = "hash") -> DataFrame:
    """Rows whose key is not in the seen table."""
    return df if seen is None else df.join(seen.select(key).distinct(), key, "left_anti")


def exact_dedup(df: DataFrame, text: Column, ordinal: list[str], seen: DataFrame | None = None) -> DataFrame:
    """df with hash and is_dup: seen before, or not the first with its hash."""
    hashed = df.withColumn("hash", canonical_hash(text))
    return marked_duplicates(hashed, ordinal, seen)


def marked_duplicates(hashed: DataFrame, ordinal: list[str], seen: DataFrame | None = None) -> DataFrame:
    """hashed with is_dup, false for a null hash."""
    marked = first_by_ordinal(hashed, "hash", ordinal)
    if seen is not None:
        # Seen hashes are looked up for the first rows only: a hot hash is one row there.
        known = marked.where("is_first").select("hash").join(seen.select("hash"), "hash", "left_semi").distinct()
        again = marked.where("is_first").join(known, "hash", "left_semi").select(*[F.col(c).alias(f"again{i}__") for i, c in enumerate(ordinal)], F.lit(True).alias("known__"))
        same = F.lit(True)
        for i, c in enumerate(ordinal):
            same = same & (marked[c] == again[f"again{i}__"])
        marked = marked.join(again, same, "left").withColumn("is_first", F.col("is_first") & F.col("known__").isNull())
        marked = marked.drop("known__", *[f"again{i}__" for i in range(len(ordinal))])
    return marked.withColumn("is_dup", F.col("hash").isNotNull() & ~F.col("is_first")).drop("is_first")


class SeenTable:
    """Hashes accepted so far, as a Parquet folder with a part for each committed batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def load(self, batches: list[int]) -> DataFrame:
        """Hashes of the committed batches only; an empty table where there are none."""
        if not batches:
            return self.spark.createDataFrame([], "hash string")
        return self.spark.read.schema("hash string").parquet(*[f"{self.path}/batch={b}" for b in batches])

    def append(self, hashes: DataFrame, batch: int) -> None:
        hashes.select("hash").distinct().write.mode("overwrite").parquet(f"{self.path}/batch={batch}")


