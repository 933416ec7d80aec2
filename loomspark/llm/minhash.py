"""MinHash near-duplicates: one-permutation hashing, banded buckets, star-shaped candidate edges.

1. One Arrow pass over the texts gives each document the size of its shingle set, a 128-bit digest of
   the set, 32 bucket keys of 6 bins each and a sketch of one byte per bin. With optimal densification a
   pair at similarity 0.75 shares a bucket with probability 0.998, whatever the size of its sets.
2. Documents with equal sets are one class; its smallest id stands for it from here on.
3. Each bucket is a star: one member, another in each bucket, is its centre. Each class keeps the
   centre whose sketch is most like its own; the pair is confirmed on the full sets.
4. What is linked so far forms components. In buckets that still span components, members of different
   components are compared on their full sets, tile by tile of bounded size, inside the tasks. What goes out is a spanning
   forest of the links between components: so each link between members of a bucket counts, and neither copies,
   linked members nor dissimilar ones become pairs.
5. Components of both kinds of links.

A null text or one without words has an empty set and links with nothing. Rows with the same id are one
vertex. Rows with a null id are kept, with a null component. An empty table gives an empty table. Extra columns
are not carried; the result has the id, n_shingles, component_id and kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm.common import Stored, bounded_batches, finished, groups, release, table, text_or_empty
from loomspark.llm.components import connected_components
from loomspark.llm.shingles import OnePermutation, mixed, shingle_set

#: Bounds of a tile: members, and shingles of all members together.
TILE, SHINGLES = 256, 1 << 18

_SUMMARY = pa.struct([("n", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("keys", pa.list_(pa.int64())), ("sketch", pa.binary())])


def summary_column(scheme: OnePermutation, text):
    """struct of set size, set digest, bucket keys and sketch."""

    def summaries(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for value in batch:
                h = shingle_set(value.as_py())
                if not len(h):
                    out.append({"n": 0, "f1": 0, "f2": 0, "keys": [], "sketch": b""})
                    continue
                signature = scheme.signature(h)
                digest = [int(mixed(h ^ np.uint64(c)).sum(dtype=np.uint64).astype(np.int64)) for c in (0x51ED270B7F4A7C15, 0x2545F4914F6CDD1D)]
                out.append({"n": len(h), "f1": digest[0], "f2": digest[1], "keys": scheme.keys(signature).astype(np.int64), "sketch": scheme.sketch(signature)})
            yield pa.array(out, _SUMMARY)

    return F.arrow_udf(summaries, "struct<n:bigint,f1:bigint,f2:bigint,keys:array<bigint>,sketch:binary>")(text)


def _sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        sets = [np.sort(shingle_set(x.as_py()).view(np.int64)) for x in batch]
        ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
        yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*sets, np.empty(0, np.int64)])))


def _agreement(a: pa.Array, b: pa.Array) -> pa.Array:
    """In how many bins do two sketches agree?"""
    x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(len(c), -1) for c in (a, b))
    return pa.array((x == y).sum(axis=1), pa.int64())


def _with_agreement(pairs: DataFrame, summary: Stored) -> DataFrame:
    """pairs (src, dst) with the number of bins in which their sketches agree."""
    a = summary.df().select(F.col("id").alias("src"), F.col("sketch").alias("a"))
    b = summary.df().select(F.col("id").alias("dst"), F.col("sketch").alias("b"))
    return pairs.join(a, "src").join(b, "dst").select("src", "dst", F.arrow_udf(_agreement, "bigint")("a", "b").alias("agree"))


def _common(values: np.ndarray, ends: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets left with the sets right; set r is values[ends[r] : ends[r + 1]]."""
    out = np.zeros((len(left), len(right)), np.int64)
    if len(left) * len(right) <= 64:
        for x, a in enumerate(left):
            own = values[ends[a] : ends[a + 1]]
            for y, b in enumerate(right):
                other = values[ends[b] : ends[b + 1]]
                if len(own) and len(other):
                    out[x, y] = np.count_nonzero(own[np.minimum(np.searchsorted(own, other), len(own) - 1)] == other)
        return out
    # As a product of 0-1 matrices, some columns at a time; shingles of one set only are in no intersection.
    _, column, times = np.unique(values, return_inverse=True, return_counts=True)
    number = np.cumsum(times > 1) - 1
    shared = times[column] > 1
    row, column = np.repeat(np.arange(len(ends) - 1), np.diff(ends))[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for at in range(0, len(column) and int(column[-1]) + 1, 4096):
        a, b = np.searchsorted(column, [at, at + 4096])
        held = np.zeros((len(ends) - 1, 4096), np.float32)
        held[row[a:b], column[a:b] - at] = 1
        out += (held[left] @ held[right].T).astype(np.int64)
    return out


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """Of the edges (a, b), as many as join what all of them join."""
    of: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := of.setdefault(x, x)) != x:
            of[x] = x = of[up]
        return x

    kept: tuple[list[int], list[int]] = ([], [])
    for x, y in np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0).tolist():
        p, q = root(x), root(y)
        if p != q:
            of[q] = p
            kept[0].append(x)
            kept[1].append(y)
    return kept


def _joined(percent: int):
    """Links between parts within each pair of tiles of a bucket, judged on full sets; a spanning forest of them goes out."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["key", "i", "j"]):
            parts, tiles = group["part"].to_numpy(), group["tile"].to_numpy()
            left, right = (np.flatnonzero(tiles == group[c][0].as_py()) for c in ("i", "j"))
            if not len(left) or not len(right) or (parts == parts[0]).all():
                continue
            lists = group["set"].combine_chunks()
            size = lists.value_lengths().to_numpy().astype(np.int64)
            both = _common(lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(size)]), left, right)
            hit = 100 * both >= percent * (size[left][:, None] + size[right][None, :] - both)
            x, y = np.nonzero(hit & (parts[left][:, None] != parts[right][None, :]))
            if len(x):
                a, b = _forest(parts[left[x]], parts[right[y]])
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["src", "dst"])

    return joined


def _across(members: Stored, component: DataFrame, summary: Stored, sets: Stored, percent: int) -> DataFrame:
    """(src, dst): components that a link between members of one bucket joins, for all buckets that span components.

    A bucket's members lie in tiles bounded by rows and by shingles; each pair of tiles is a group of its own. The
    largest component of a bucket has tiles of its own, which aren't compared with each other.
    """
    sizes = summary.df().select("id", "n")
    placed = members.df().select("key", "id").join(component, "id", "left").join(sizes, "id")
    placed = Stored(placed.select("key", "id", "n", F.coalesce("component", "id").alias("part")), "minhash-placed")
    by_part = placed.df().groupBy("key", "part").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("z"))
    by_key = by_part.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.sum("c").alias("c"), F.sum("z").alias("z"), F.max(F.struct("c", "z", "part")).alias("most"))
    tiles = lambda c, z: F.greatest(F.ceil(c / TILE), F.ceil(z / SHINGLES)).cast("bigint")
    own = F.when(tiles(F.col("c"), F.col("z")) == 1, 0).otherwise(tiles(F.col("most.c"), F.col("most.z")))
    rest = F.when(tiles(F.col("c"), F.col("z")) == 1, 1).otherwise(tiles(F.col("c") - F.col("most.c"), F.col("z") - F.col("most.z")))
    spanning = Stored(by_key.where("parts > 1").select("key", F.col("most.part").alias("most"), own.cast("bigint").alias("own"), rest.cast("bigint").alias("rest")), "minhash-spanning")
    dealt = placed.df().join(spanning.df(), "key")
    apart = (F.col("part") == F.col("most")) & (F.col("own") > 0)
    place = F.xxhash64("id", "key")
    tile = F.when(apart, F.pmod(place, F.col("own"))).otherwise(F.col("own") + F.pmod(place, F.col("rest")))
    other = F.sequence(F.when(apart, F.col("own")).otherwise(F.lit(0).cast("bigint")), F.col("own") + F.col("rest") - 1)
    dealt = dealt.select("key", "id", "part", tile.alias("tile"), F.explode(other).alias("other"))
    dealt = dealt.join(sets.df(), "id").select("key", "part", "tile", "set", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"))
    return dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_joined(percent), "src bigint, dst bigint")


def _confirmed(pairs: DataFrame, sets: Stored, percent: int) -> DataFrame:
    """The pairs (src, dst) whose full sets are similar enough."""
    a = sets.df().select(F.col("id").alias("src"), F.col("set").alias("a"))
    b = sets.df().select(F.col("id").alias("dst"), F.col("set").alias("b"))
    both = F.size(F.array_intersect("a", "b")).cast("bigint")
    joined = pairs.select("src", "dst").join(a, "src").join(b, "dst").withColumn("both", both)
    return joined.where((100 * F.col("both")) >= percent * (F.size("a") + F.size("b") - F.col("both"))).select("src", "dst")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, percent: int = 75, bands: int = 32, rows: int = 6) -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row of df."""
    bounded_batches(df.sparkSession)
    scheme = OnePermutation(bands, rows)
    texts = df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    summary = Stored(texts.select("id", summary_column(scheme, "text").alias("x")).select("id", "x.*"), "minhash-summary")
    own = ["f1", "f2", "n"]
    classes = Stored(summary.df().where("n > 0").groupBy(*own).agg(F.min("id").alias("rep")), "minhash-classes")

    band = summary.df().where("n > 0").join(classes.df().select(F.col("rep").alias("id")), "id", "left_semi").select("id", F.explode("keys").alias("key"))
    band = Stored(band, "minhash-keys")
    buckets = band.df().groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min(F.col("id").bitwiseXOR(F.col("key"))).alias("c"))
    buckets = Stored(buckets.where("size > 1").select("key", F.col("c").bitwiseXOR(F.col("key")).alias("centre")), "minhash-buckets")
    members = Stored(band.df().join(buckets.df(), "key"), "minhash-members")
    band.drop()
    buckets.drop()
    release(df.sparkSession)

    alike = texts.join(members.df().select("id").distinct(), "id", "left_semi")
    sets = Stored(alike.select("id", F.arrow_udf(_sets, "array<bigint>")("text").alias("set")), "minhash-sets")
    met = members.df().where("id <> centre").select(F.col("id").alias("src"), F.col("centre").alias("dst")).distinct()
    star = _with_agreement(met, summary).groupBy("src").agg(F.max(F.struct("agree", "dst"))["dst"].alias("dst"))
    links = Stored(_confirmed(star, sets, percent), "minhash-links")
    release(df.sparkSession)

    component = connected_components(links.df(), name="minhash-star")
    more = Stored(_across(members, component, summary, sets, percent), "minhash-more")
    for x in (sets, members, links):
        x.drop()
    release(df.sparkSession)
    joined = connected_components(more.df(), name="minhash").select(F.col("id").alias("part"), F.col("component").alias("whole"))
    reps = classes.df().select(F.col("rep").alias("id")).join(component, "id", "left").select("id", F.coalesce("component", "id").alias("part"))
    component = reps.join(joined, "part", "left").select("id", F.coalesce("whole", "part").alias("component"))
    named = classes.df().join(component, F.col("rep") == F.col("id")).select(*own, F.col("component").alias("found"))
    out = summary.df().select("id", *own).join(named, own, "left")
    component_id = F.when(F.col("id").isNotNull(), F.coalesce("found", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component_id.alias("component_id"), (F.col("id") == component_id).alias("kept"))


def op8_minhash(spark, sf_dir):
    return finished(near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")), "minhash-done")
