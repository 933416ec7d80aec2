"""Near-duplicate vectors by NN-descent.

1. Vectors equal in all components are one class, its smallest id the representative.
2. First neighbour lists come from a forest: each table hashes a vector by the signs of a few random
   projections; a cell is compared within itself in blocks of bounded size, and each vector keeps
   its ``k`` best neighbours, however far. Cells get smaller as data grow; the number of tables grows with that,
   so that a pair at the threshold meets in a cell of one forest with probability 0.999 at least. The ``k`` best of a vector in a tight group all lie in that
   group, so a block also gives a spanning forest of its links: what its links join is joined, however many there are.
3. Descent: around each vector, its neighbours and those whose neighbour it is are compared with each
   other, again keeping the best, until a round links no two components that were apart. Long lists are dealt
   to parts, in each round others, and all parts are compared. Cells of more than a block that still span components
   are then compared whole, tile by tile, so that a pair which meets in a cell is never lost.
4. Links are counted in the vector's component of the threshold graph: members are compared tile
   by tile, exactly, in double precision, so links are never written out as pairs. A link joins its
   ends' components, so links are missing only where the search never compared two parts of one component.
5. The audit: all links of fixed numbers of query vectors in small components (of at most ``k``) and in others are
   found by brute force over all vectors. Of the queries with links, in both kinds, at least the share ``recall``
   must have all of them within their component; else another forest is added. Links that only the audit found
   are added too. Where ``forests`` do not suffice, it is an error.

Only vectors with the same label and length are compared. Null labels, null, empty or zero vectors, and
those with a null or non-finite component link with nothing and are their own component. Each row is a
vector: a repeated row is one more linked vector. A null id keeps its row, with a null component. An empty
table gives an empty table. Extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspark.llm.common import Stored, bounded_batches, groups, table
from loomspark.llm.components import connected_components

BLOCK, TILE, AROUND = 512, 1024, 64


def _unit(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of length 1 in double precision; all lists have the same length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _cells(tables: int, bits: int, seed: int):
    def cells(vectors: pa.Array) -> pa.Array:
        out, planes = [], {}
        for v in vectors:
            x = np.asarray(v.as_py())
            if len(x) not in planes:
                planes[len(x)] = np.random.Generator(np.random.PCG64([seed, len(x)])).standard_normal((tables * bits, len(x)))
            signs = (planes[len(x)] @ x >= 0).reshape(tables, bits)
            out.append([(seed * tables + t) << 40 | int(c) for t, c in enumerate(signs @ (1 << np.arange(bits)))])
        return pa.array(out, pa.list_(pa.int64()))

    return F.arrow_udf(cells, "array<bigint>")


def _tables(least: int, bits: int, threshold: float) -> int:
    """So many that a pair at the threshold shares no cell with probability 0.001 at most."""
    together = (1 - np.arccos(threshold) / np.pi) ** bits
    return max(least, int(np.ceil(np.log(0.001) / np.log1p(-together))))


def _joining(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links hit: each row that isn't the first of its part, and one that it links with."""
    left, child, parent = hit.any(axis=1), [], []
    for root in np.flatnonzero(left):
        if not left[root]:
            continue
        left[root], front = False, [root]
        while front:
            at = front.pop()
            new = np.flatnonzero(hit[at] & left)
            left[new] = False
            child.append(new)
            parent.append(np.full(len(new), at))
            front.extend(new)
    none = np.empty(0, np.int64)
    return np.concatenate([none, *child]), np.concatenate([none, *parent])


def _best(ids: np.ndarray, x: np.ndarray, k: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's k best others, and links that join all rows that the threshold graph joins."""
    s = x @ x.T
    np.fill_diagonal(s, -2)
    child, parent = _joining(s >= threshold)
    if len(s) > k:
        at = np.argpartition(-s, k - 1, axis=1)[:, :k]
    else:
        at = np.broadcast_to(np.arange(len(s)), s.shape)
    # A row is in its own list where there are no k others.
    rows = np.repeat(np.arange(len(s)), at.shape[1])
    flat = at.ravel()
    sim = s[rows, flat]
    ok = rows != flat
    return np.concatenate([ids[rows[ok]], ids[child]]), np.concatenate([ids[flat[ok]], ids[parent]]), np.concatenate([sim[ok], s[child, parent]])


_EDGE = "a bigint, b bigint, sim double"


def _compare(keys: list[str], k: int, threshold: float):
    """Compares each group (columns keys, id, vector) within itself."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "sim"]
        held, n = [], 0
        for group in groups(batches, keys):
            if len(group) > 1:
                edges = _best(group["id"].to_numpy(), _unit(group["vector"]), k, threshold)
                held.append(edges)
                n += len(edges[0])
            if n >= 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names)
                held, n = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names)

    return compare


def _search(vectors: Stored, tables: int, bits: int, seed: int, k: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Edges from one forest, and (id, cell) of its cells of more than a block."""
    cells = vectors.df().select("id", "label", "size", F.explode(_cells(tables, bits, seed)("vector")).alias("hash"))
    cells = Stored(cells.select("id", F.xxhash64("label", "size", "hash").alias("cell")), "nn-cells")
    large = cells.df().groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    large = Stored(large.select("cell", F.ceil(F.col("n") / BLOCK).alias("blocks")), "nn-large")
    placed = cells.df().join(large.df(), "cell").select("id", "cell", F.pmod(F.xxhash64("id", "cell"), F.col("blocks")).alias("block"))
    members = placed.join(vectors.df().select("id", "vector"), "id")
    members = members.repartition("cell", "block").sortWithinPartitions("cell", "block")
    wide = cells.df().join(large.df().where("blocks > 1").select("cell"), "cell", "left_semi").select("id", "cell")
    return members.mapInArrow(_compare(["cell", "block"], k, threshold), _EDGE), wide


def _whole_cells(vectors: Stored, wide: DataFrame, component: DataFrame, threshold: float) -> DataFrame:
    """Edges that join what the links in each of the cells wide join, where a cell spans components."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["cell", "i", "j"]):
            parts = group["part"].to_numpy()
            if (parts == parts[0]).all():
                continue
            ids, x = group["id"].to_numpy(), _unit(group["vector"])
            s = x @ x.T
            child, parent = _joining((s >= threshold) & (parts[:, None] != parts[None, :]))
            yield pa.RecordBatch.from_arrays([pa.array(ids[child]), pa.array(ids[parent]), pa.array(s[child, parent])], ["a", "b", "sim"])

    placed = Stored(wide.join(component, "id", "left").select("id", "cell", F.coalesce("component", "id").alias("part")), "nn-wide")
    spanning = placed.df().groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high")
    tiled = placed.df().join(spanning.select("cell", F.ceil(F.col("n") / TILE).alias("tiles")), "cell")
    tiled = tiled.withColumn("tile", F.pmod(F.xxhash64("id", "cell"), F.col("tiles")).cast("bigint"))
    tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)))
    tiled = tiled.select("id", "cell", "part", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"))
    tiled = tiled.join(vectors.df().select("id", "vector"), "id")
    return tiled.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j").mapInArrow(compare, _EDGE)


def _kept(edges: DataFrame, k: int, threshold: float) -> DataFrame:
    """Of each vector's edges the k best, and all links."""
    best = F.row_number().over(Window.partitionBy("a").orderBy(F.col("sim").desc(), "b"))
    edges = edges.groupBy("a", "b").agg(F.max("sim").alias("sim")).withColumn("best", best)
    return edges.where((F.col("best") <= k) | (F.col("sim") >= threshold)).select("a", "b", "sim")


def _descend(vectors: Stored, edges: DataFrame, k: int, threshold: float, turn: int) -> DataFrame:
    """Edges among the neighbours of each vector, forward and backward, in parts of bounded length."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    spread = F.pmod(F.xxhash64("a", "b", F.lit(turn)), F.col("parts"))
    sizes = both.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / AROUND).alias("parts"))
    around = both.join(sizes, "a").select("a", "b", spread.alias("part"))
    around = around.union(around.select("a", F.col("a").alias("b"), "part").distinct())
    members = around.join(vectors.df().select(F.col("id").alias("b"), "vector"), "b")
    members = members.select("a", "part", F.col("b").alias("id"), "vector").repartition("a", "part").sortWithinPartitions("a", "part")
    return members.mapInArrow(_compare(["a", "part"], k, threshold), _EDGE)


def _counts(threshold: float):
    """Links of each vector inside one pair of tiles of a component, counted with multiplicity."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["pack", "i", "j"]):
            ids, comps, tiles = (group[c].to_numpy() for c in ("id", "component", "tile"))
            weight, x = group["copies"].to_numpy(), _unit(group["vector"])
            i, j = group["i"][0].as_py(), group["j"][0].as_py()
            order = np.argsort(comps, kind="stable")
            out_ids, out_n = [], []
            for rows in np.split(order, np.flatnonzero(np.diff(comps[order])) + 1):
                left, right = rows[tiles[rows] == i], rows[tiles[rows] == j]
                hit = x[left] @ x[right].T >= threshold
                if i == j:
                    np.fill_diagonal(hit, False)
                out_ids.append(ids[left])
                out_n.append(hit @ weight[right])
                if i != j:
                    out_ids.append(ids[right])
                    out_n.append(weight[left] @ hit)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_ids)), pa.array(np.concatenate(out_n).astype(np.int64))], ["id", "n"])

    return counts


def _audit(vectors: Stored, component: DataFrame, queries: int, few: int, threshold: float, seed: int) -> DataFrame:
    """(a, b, few): the links of query vectors by brute force over all rows, and whether a's component has so few members.
    The queries are broadcast; their number is fixed."""
    sizes = component.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    small = component.join(sizes, "component").select("id", "members")
    of = vectors.df().join(small, "id", "left").withColumn("few", F.coalesce("members", F.lit(1)) <= few)
    chosen = [r for kind in ("few", "not few") for r in of.where(kind).orderBy(F.xxhash64("id", F.lit(seed))).limit(queries).collect()]
    small_ids = np.array([r["id"] for r in chosen if r["few"]], np.int64)
    kinds: dict[tuple, list] = {}
    for r in chosen:
        kinds.setdefault((r["label"], r["size"]), []).append((r["id"], r["vector"]))
    ready = {key: (np.array([i for i, _ in rows]), _unit(pa.array([v for _, v in rows]))) for key, rows in kinds.items()}

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
            label, size, ids = batch["label"].to_numpy(zero_copy_only=False), batch["size"].to_numpy(), batch["id"].to_numpy()
            for (own_label, own_size), (query, q) in ready.items():
                rows = np.flatnonzero((label == own_label) & (size == own_size))
                if len(rows):
                    at, of = np.nonzero(_unit(batch["vector"].take(pa.array(rows))) @ q.T >= threshold)
                    found.append((query[of], ids[rows[at]]))
            a, b = (np.concatenate(c) for c in zip(*found))
            a, b = a[a != b], b[a != b]
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.isin(a, small_ids))], ["a", "b", "few"])

    return vectors.df().mapInArrow(links, "a bigint, b bigint, few boolean")


def near_duplicate_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", *, threshold: float = 0.93, k: int = 16, tables: int = 12, recall: float = 0.995, queries: int = 256, rounds: int = 4, forests: int = 6) -> DataFrame:
    """(id, n_links, component_id, kept) for each row of df."""
    bounded_batches(df.sparkSession)
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).cast("string").alias("label"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    usable = F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0) & finite & F.exists("vector", lambda v: v != 0), F.lit(False))
    rows = Stored(rows.withColumn("usable", usable), "nn-rows")
    classes = rows.df().where("usable").groupBy("label", "vector").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = Stored(classes.withColumn("digest", F.xxhash64("vector")), "nn-classes")
    # Floats stay floats, which loses nothing; all similarities are in double precision.
    lossless = "array<float>" if df.schema[vector_col].dataType.simpleString() in ("array<float>", "array<smallint>", "array<tinyint>") else "array<double>"
    vectors = Stored(classes.df().select(F.col("rep").alias("id"), "label", F.col("vector").cast(lossless).alias("vector"), "copies", F.size("vector").alias("size")), "nn-vectors")
    most = vectors.df().groupBy("label", "size").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    bits = min(24, max(1, int(np.ceil(np.log2(max(2, most / 256))))))

    tables = _tables(tables, bits, threshold)

    links = component = None

    def add(edges: DataFrame) -> int:
        nonlocal links, component
        more = Stored(_kept(edges if links is None else edges.unionByName(links.df()), k, threshold), "nn-links")
        if links is not None:
            links.drop()
        links = more
        component, parts = _components(links, threshold)
        return parts

    for seed in range(forests):
        edges, wide = _search(vectors, tables, bits, seed, k, threshold)
        parts = add(edges)
        for turn in range(rounds):
            before, parts = parts, add(_descend(vectors, links.df(), k, threshold, turn))
            if parts == before:
                break
        add(_whole_cells(vectors, wide, component, threshold))
        truth = Stored(_audit(vectors, component, queries, k, threshold, seed), "nn-truth")
        ends = [component.select(F.col("id").alias(c), F.col("component").alias(f"of_{c}")) for c in "ab"]
        met = truth.df().join(ends[0], "a", "left").join(ends[1], "b", "left").withColumn("met", F.coalesce(F.col("of_a") == F.col("of_b"), F.lit(False)))
        seen = met.groupBy("few", "a").agg(F.min("met").alias("whole")).groupBy("few").agg(F.count(F.lit(1)).alias("n"), F.count_if("whole").alias("hit")).collect()
        if any(r["hit"] < r["n"] for r in seen):
            add(met.where("not met").select("a", "b", F.lit(1.0).alias("sim")))
        if all(r["hit"] >= recall * r["n"] for r in seen):
            break
    else:
        raise RuntimeError(f"after {forests} forests the audit still finds vectors whose links were missed: {seen}")
    links.drop()

    sizes = component.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("tiles"))
    placed = component.join(sizes, "component").join(vectors.df().select("id", "vector", "copies"), "id")
    placed = placed.withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("bigint"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)))
    pack = F.when(F.col("tiles") == 1, F.pmod(F.xxhash64("component"), F.lit(max(1, int(vectors.df().count() // BLOCK))))).otherwise(-1 - F.col("component"))
    placed = placed.select("id", "component", "vector", "copies", "tile", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), pack.alias("pack"))
    placed = placed.repartition("pack", "i", "j").sortWithinPartitions("pack", "i", "j")
    counted = placed.mapInArrow(_counts(threshold), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))

    found = vectors.df().select("id", "copies").join(counted, "id", "left").join(component, "id", "left")
    found = Stored(found.select("id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "id").alias("component")), "nn-found")
    of = classes.df().select("label", "digest", "vector", F.col("rep").alias("rep")).join(found.df(), F.col("rep") == F.col("id")).select("label", "digest", "vector", "n", "component")
    out = rows.df().withColumn("digest", F.when(F.col("usable"), F.xxhash64("vector"))).withColumnRenamed("vector", "own").withColumnRenamed("label", "mine")
    joined = out.join(of, (out["digest"] == of["digest"]) & (F.col("mine") == F.col("label")) & (F.col("own") == F.col("vector")), "left")
    component_id = F.coalesce("component", "id")
    return joined.select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"), component_id.alias("component_id"), (F.col("id") == component_id).alias("kept"))


def _components(links: Stored, threshold: float) -> tuple[DataFrame, int]:
    """Components of the threshold graph, and how far they are joined: vertices less components."""
    component = connected_components(links.df().where(F.col("sim") >= threshold), "a", "b", name="nn")
    return component, component.agg(F.count_if(F.col("id") != F.col("component"))).first()[0]


def op7_vector_dedup(spark, sf_dir):
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))
