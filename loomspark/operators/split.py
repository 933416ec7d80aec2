"""Train and validation split, and shards, from ordinals alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.operators.ordinal import with_prefix_sums


def split_value(index: Column, seed: int, prefix: str = "") -> Column:
    """A number in [0, 1) from the SHA-256 of "seed:index"."""
    digest = F.sha2(F.concat(F.lit(f"{prefix}{seed}:"), index.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)").cast("double") / F.lit(2.0**64)


def split_of(index: Column, seed: int, val_ratio: float, *, samples: bool = False) -> Column:
    """train or val; samples: of instruction samples, whose hash has a prefix of its own."""
    return F.when(split_value(index, seed, "sft:" if samples else "") < val_ratio, "val").otherwise("train")


def with_shards(df: DataFrame, index: str, shard_size: int, split: str = "split", *, whole: bool = False) -> DataFrame:
    """df with shard: within each split the rows in order of index fill shards of shard_size one after another.

    Both splits' ranks come from one pass; whole as for prefix sums."""
    val = (F.col(split) == "val").cast("bigint")
    ranked = with_prefix_sums(df.withColumn("val__", val).withColumn("train__", 1 - val), [index], {"vals__": "val__", "trains__": "train__"}, whole=whole)
    rank = F.when(F.col(split) == "val", F.col("vals__")).otherwise(F.col("trains__"))
    return ranked.withColumn("shard", F.floor(rank / shard_size).cast("bigint")).drop("val__", "train__", "vals__", "trains__")


def shard_path(split: Column, shard: Column, ending: str) -> Column:
    return F.format_string(f"%s-%05d.{ending}", split, shard)


def shard_name(split: str, shard: int, ending: str) -> str:
    return f"{split}-{shard:05d}.{ending}"
