"""Packing: the accepted documents' tokens in one row, cut into sequences of equal length."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.operators.ordinal import with_prefix_sums


def pack_sequences(df: DataFrame, order: list[str], length: int, tokens: str = "tokens", *, start: int = 0) -> DataFrame:
    """(seq_index, ids): every full sequence. Documents straddle sequences; what is left at the end is dropped.

    Each document is cut into its parts of sequences where it lies, so a sequence gathers at most length
    tokens. start: tokens that lie before these, in earlier batches; sequence numbers go on from there.
    """
    n = F.size(tokens).cast("bigint")
    df = with_prefix_sums(df.select(*order, tokens).withColumn("n__", n), order, {"s__": "n__"}).where("n__ > 0")
    s = F.col("s__") + start
    first, last = F.floor(s / length), F.floor((s + F.col("n__") - 1) / length)
    parts = df.select(s.alias("s"), F.col("n__").alias("n"), F.col(tokens).alias("t"), F.explode(F.sequence(first, last)).alias("seq_index"))
    low = F.greatest(F.col("seq_index") * length - F.col("s"), F.lit(0))
    high = F.least((F.col("seq_index") + 1) * length - F.col("s"), F.col("n"))
    parts = parts.select("seq_index", F.struct(F.col("s"), F.slice("t", (low + 1).cast("int"), (high - low).cast("int")).alias("part")).alias("x"))
    whole = parts.groupBy("seq_index").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    return whole.select("seq_index", F.flatten(F.transform("xs", lambda x: x["part"])).alias("ids")).where(F.size("ids") == length)


def pack_summary(total_tokens: int, length: int) -> dict[str, int]:
    """Sequences and dropped tokens of a total, without making any."""
    return {"sequences": total_tokens // length, "dropped": total_tokens % length}
