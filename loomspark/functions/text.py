"""Column expressions with Python's Unicode meaning of white space, lines and blank text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that Python's str.strip and str.splitlines know.
WS = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
LB = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^[{WS}]+|[{WS}]+$", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, f"[{WS}]+$", "")


def not_blank(c: Column) -> Column:
    """True for a text with a character that isn't white space; null counts as blank."""
    return F.coalesce(c.rlike(f"[^{WS}]"), F.lit(False))


def lines(c: Column) -> Column:
    """The lines of a text; a final line break leaves one empty line more than Python does."""
    return F.split(c, LB, -1)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def entropy(c: Column) -> Column:
    """Bits per character of a text's characters; 0 for the empty text.

    One pass over the sorted characters: an accumulator holds the last character, the length of its run
    and the sum so far of n * log2(n) over the runs.
    """
    n = F.length(c).cast("double")
    chars = F.array_sort(F.filter(F.split(c, ""), lambda x: x != ""))
    start = F.struct(F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("total"))

    def closed(run: Column) -> Column:
        return F.when(run > 1, run * F.log2(run)).otherwise(0.0)

    def step(acc: Column, x: Column) -> Column:
        same = acc["last"] == x
        return F.struct(
            x.alias("last"),
            F.when(same, acc["run"] + 1.0).otherwise(1.0).alias("run"),
            (acc["total"] + F.when(same, 0.0).otherwise(closed(acc["run"]))).alias("total"),
        )

    summed = F.aggregate(chars, start, step, lambda acc: acc["total"] + closed(acc["run"]))
    return F.when(n > 0, F.log2(n) - summed / n).otherwise(0.0)


def code_points(c: Column) -> Column:
    """The code point of each character."""
    return F.transform(F.filter(F.split(c, ""), lambda x: x != ""), lambda x: F.ascii(x))
