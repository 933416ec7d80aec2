"""Prefix sums and ranks over explicit ordinals, without gathering all rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspark.scratch import Stored


def with_prefix_sums(df: DataFrame, order: list[str], sums: dict[str, str], *, group: str | None = None, partitions: int | None = None, whole: bool = False) -> DataFrame:
    """df with, for each out: column in sums, the sum of the column over all rows before this one in order,
    or over those of the same group. Order columns must be unique together; nulls in a summed column count 0.

    Rows are dealt by range of order, each to a slot, and written once with their slot, so that each later step
    sees the same slots. There is one total for each slot (and group); these few are added up, and a window
    inside each slot does the rest. A group, even of null, may hold any share of the rows. What is written is the
    order, the group and the summed columns; other columns are joined back by order, so df is evaluated twice.
    whole: write all columns of df instead, where they are small or where order holds within one evaluation only.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    needed = {*order, *sums.values(), *([group] if group else [])}
    whole = whole or set(df.columns) <= needed
    rest = [c for c in df.columns if c not in sums] if whole else []
    places, values = [f"o{i}__" for i in range(len(order))], {o: f"v{i}__" for i, o in enumerate(sums)}
    slim = df.select(
        *[F.col(f"`{c}`").alias(p) for c, p in zip(order, places)],
        *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(values[o]) for o, c in sums.items()],
        *([F.col(f"`{group}`").alias("group__")] if group else []),
        *[F.col(f"`{c}`").alias(f"r{i}__") for i, c in enumerate(rest)],
    )
    dealt = Stored(slim.repartitionByRange(n, *places).withColumn("slot__", F.spark_partition_id()), "ordinal").df()

    by = ["group__"] if group else []
    totals = dealt.groupBy("slot__", *by).agg(F.min(F.struct(*places)).alias("least__"), *[F.sum(v).alias(v) for v in values.values()])
    earlier = Window.partitionBy(*by).orderBy("least__").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(F.col("slot__").alias("of__"), *[F.col(c).alias("in__") for c in by], *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"{v}b") for v in values.values()])
    here = F.col("slot__") == F.col("of__")
    if group:
        here = here & F.col("group__").eqNullSafe(F.col("in__"))
    inside = Window.partitionBy("slot__", *by).orderBy(*places).rowsBetween(Window.unboundedPreceding, -1)
    sums_of = [(F.col(f"{v}b") + F.coalesce(F.sum(v).over(inside), F.lit(0))).alias(f"{v}s") for v in values.values()]
    # Without groups there is one row for each slot.
    summed = dealt.join(base if group else F.broadcast(base), here).select(*places, *[f"r{i}__" for i in range(len(rest))], *sums_of)
    found = [F.col(f"{v}s").alias(o) for o, v in values.items()]
    if whole:
        return summed.select(*[F.col(f"r{i}__").alias(c) for i, c in enumerate(rest)], *found)
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in sums])
    same = F.lit(True)
    for c, p in zip(order, places):
        same = same & kept[f"`{c}`"].eqNullSafe(F.col(p))
    return kept.join(summed, same).select(*[kept[f"`{c}`"] for c in kept.columns], *found)


def with_rank(df: DataFrame, order: list[str], out: str = "rank", *, whole: bool = False) -> DataFrame:
    """df with the 0-based position of each row in order."""
    return with_prefix_sums(df.withColumn("one__", F.lit(1)), order, {out: "one__"}, whole=whole).drop("one__")


def skip_seen(df: DataFrame, order: list[str], count: int) -> DataFrame:
    """df without its first count rows."""
    return with_rank(df, order, "rank__").where(F.col("rank__") >= count).drop("rank__")


def first_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first n rows in order (a preview)."""
    return df.orderBy(*order).limit(n)
