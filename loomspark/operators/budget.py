"""Token budgets, applied in row order: a row is taken if what was accepted before it is below the budget."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.operators.ordinal import with_prefix_sums


def apply_budgets(df: DataFrame, order: list[str], *, tokens: str = "n_tokens", source_limit: int | None = None, target: int | None = None, before: int = 0, block: int = 1, max_rows: int | None = None) -> DataFrame:
    """df (one source, and narrow: all its columns are written once) with processed and accepted.

    tokens: of rows that were kept, 0 or null for rejected and duplicate rows. source_limit is for this
    source, target for all sources, of which before tokens are accepted already; of these only whole
    blocks count (block 1: every token). max_rows bounds the raw rows. The last row taken may overshoot.
    """
    df = df.withColumn("n__", F.coalesce(F.col(tokens), F.lit(0))).withColumn("one__", F.lit(1))
    df = with_prefix_sums(df, order, {"pre__": "n__", "row__": "one__"}, whole=True)
    taken = F.lit(True)
    if source_limit is not None:
        taken = taken & (F.col("pre__") < source_limit)
    if target is not None:
        packed = F.floor((F.col("pre__") + before) / block) * block
        taken = taken & (packed < target)
    if max_rows is not None:
        taken = taken & (F.col("row__") < max_rows)
    df = df.withColumn("processed", taken)
    return df.withColumn("accepted", F.col("processed") & (F.col("n__") > 0)).drop("n__", "one__", "pre__", "row__")
