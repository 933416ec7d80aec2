"""Repeated byte strings: names of triples over a difference cover of the suffixes.

Every byte covered by a string of ``width`` bytes that also starts somewhere else, in the same document or
another, is removed. Matches never cross documents.

* Names. A byte is its own name; the name of 3, 9, 27, 81, 243 bytes at a place is the name of the triple of
  names one level below. Names are 64-bit digests of the triple instead of its rank among the sorted
  triples: equality is all that is needed below, and a digest is the same in every task, so no level
  of the recursion has to be shuffled. Rows meet only under two names together (128 bits).
* Difference cover. The sample must hold, for any two equal strings, one common offset at which both are
  sampled. A cover modulo 3 does that for any text at two thirds of its places; this one is chosen by
  content: the suffix sampled for a start is the one with the least 27-byte name among the next 320 places,
  with the first of equals. Equal strings choose the same offset, and only about one place in 126 is sampled (measured).
* The sampled suffixes are sorted, by the triple of names that begins them (81 bytes) and then by their whole context: a sort by range over all
  tasks. Neighbours are compared: starts that share a sampled suffix are a run; a triple met once settles that its run's
  strings occur nowhere else, one whose neighbours all have the same context that they all do.
* The remaining suffixes, those of runs with different contexts under one triple (the edges of
  copies and passages), are merged in two more sorts, one representative for each context with the number of its copies. First in
  blocks of 16 starts: a block whose strings' common core has no equal neighbour is alone, one whose neighbours all have its
  context is repeated. Then, for the blocks that neither settles, single starts are sorted by the names of their first
  ``width`` bytes and compared with their neighbours: equal neighbours are repeats; the starts without one are not.

No group is ever gathered in one task: a sort's ranges are cut inside a group where it is large, and the pieces of
a group at the ends of two ranges are put together from one row each. Runs and lonely starts are gathered for one
document only: 16 bytes for each, which is at most one for each byte (in texts that repeat a few bytes over and over) and usually one
in a hundred. Texts are named in chunks, and runs go out chunk by chunk.

Null texts are empty. Texts shorter than ``width`` bytes stay whole. Repeated rows are documents like others, so
a long text that occurs twice goes whole. Null ids are allowed. An empty table gives an empty table. Extra columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm.common import Stored, bounded_batches, finished, release, table, text_or_empty
from loomspark.llm.shingles import mixed

WIDTH, REACH, STARTS = 400, 320, 16
CHUNK = 1 << 20
_U64 = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240611))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * _U64(2) + _U64(1)
_LEVEL = _RNG.integers(1, 2**63, (6, 3), dtype=np.uint64) * _U64(2) + _U64(1)


def triple(a: np.ndarray, b: np.ndarray, c: np.ndarray, level: int) -> np.ndarray:
    """A name linear in the three names: with random odd factors, sums of random bytes' names keep apart."""
    p = _LEVEL[level]
    return a + b * p[1] + c * p[2]


def names(data: np.ndarray, level: int) -> list[np.ndarray]:
    """Names of 1, 3, ... 3**level bytes at each place where so many are left."""
    out = [_BYTE[data]]
    for k in range(level):
        below, step = out[-1], 3**k
        n = max(0, len(below) - 2 * step)
        out.append(triple(below[:n], below[step : step + n], below[2 * step : 2 * step + n], k))
    return out


def _whole(big: np.ndarray, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """Names of strings of 243 to 729 bytes: the triple of 243-byte names that cover them."""
    last = start + length - 243
    p = _LEVEL[5]
    return mixed(mixed(big[start]) * p[0] + mixed(big[np.minimum(start + 243, last)]) * p[1] + mixed(big[last]) * p[2] + np.asarray(length, np.uint64))


def runs(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each run of starts that share a sampled suffix: the suffix's name, the context's name, first and last start; by chunks."""
    for at in range(0, max(0, len(data) - WIDTH + 1), CHUNK):
        b = np.frombuffer(data, np.uint8)[at : at + CHUNK + WIDTH - 1]
        starts = len(b) - WIDTH + 1
        level = names(b, 5)
        # The least name among the next REACH places, by least values of blocks seen from either end.
        v = (level[3][: starts + REACH - 1] & ~_U64(0xFFFFFFFF)) | np.arange(starts + REACH - 1, dtype=np.uint64)
        v = np.concatenate([v, np.full(-len(v) % REACH, ~_U64(0))]).reshape(-1, REACH)
        ahead = np.minimum.accumulate(v, axis=1).ravel()
        behind = np.minimum.accumulate(v[:, ::-1], axis=1)[:, ::-1].ravel()
        sampled = (np.minimum(behind[:starts], ahead[REACH - 1 : REACH - 1 + starts]) & _U64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], sampled[1:] != sampled[:-1]]))
        last = np.concatenate([first[1:], [starts]]) - 1
        place = sampled[first]
        context = _whole(level[5], first, last - first + WIDTH) ^ mixed((place - first).astype(np.uint64))
        yield mixed(level[4][place]), context, first + at, last + at


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (row, digest, name, context, first, last), chunk by chunk of each text."""
    held: list[tuple] = []
    n = 0

    def rows() -> pa.RecordBatch:
        columns = [np.concatenate([x[i] for x in held]) for i in range(len(_RUN))]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _RUN)

    for batch in batches:
        for row, digest, text in zip(batch["row"].to_pylist(), batch["digest"].to_pylist(), batch["text"]):
            for name, context, first, last in runs(text.as_py().encode("utf-8", "replace")):
                held.append((np.full(len(name), row), np.full(len(name), digest), name.view(np.int64), context.view(np.int64), first, last))
                n += len(name)
                if n >= 1 << 16:
                    yield rows()
                    held, n = [], 0
    if held:
        yield rows()


_RUN = ["row", "digest", "name", "context", "first", "last"]


def _regions(first: np.ndarray, last: np.ndarray) -> Iterator[tuple[np.ndarray, int, int]]:
    """The runs in parts that lie close together: their numbers, and the region of the text they need."""
    part = first // CHUNK
    for p in np.unique(part):
        rows = np.flatnonzero(part == p)
        yield rows, int(first[rows].min()), int(last[rows].max()) + WIDTH


def blocks(data: bytes, first: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
    """The runs first to last in blocks at fixed places before their sampled suffix: run, number, core, context, first and last start."""
    found = []
    for rows, start, end in _regions(first, last):
        level = names(np.frombuffer(data, np.uint8)[start:end], 5)
        a, z = first[rows] - start, last[rows] - start
        place = z + np.argmin(level[3][z[:, None] + np.arange(REACH)] >> _U64(32), axis=1)
        least = (place - z) // STARTS
        many = (place - a) // STARTS - least + 1
        run = np.repeat(np.arange(len(rows)), many)
        number = least[run] + np.arange(len(run)) - np.repeat(np.cumsum(many) - many, many)
        place, edge = place[run], place[run] - STARTS * number
        low, high = np.maximum(a[run], edge - STARTS + 1), np.minimum(z[run], edge)
        core = _whole(level[5], edge, WIDTH - STARTS + 1)
        context = _whole(level[5], low, high - low + WIDTH) ^ mixed((place - low).astype(np.uint64))
        found.append((rows[run], number, core.view(np.int64), context.view(np.int64), low + start, high + start))
    return [np.concatenate(c) for c in zip(*found)]


def starts_named(data: bytes, first: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
    """Each start of the runs: run, the name of its string of width bytes, the start."""
    found = []
    for rows, start, end in _regions(first, last):
        big = names(np.frombuffer(data, np.uint8)[start:end], 5)[5]
        many = last[rows] - first[rows] + 1
        run = np.repeat(np.arange(len(rows)), many)
        at = first[rows][run] - start + np.arange(len(run)) - np.repeat(np.cumsum(many) - many, many)
        found.append((rows[run], _whole(big, at, WIDTH).view(np.int64), at + start))
    return [np.concatenate(c) for c in zip(*found)]


def _numbers(lists: pa.ListArray, field: str) -> np.ndarray:
    """A field of all structs in lists, one list after the other."""
    return lists.flatten().field(field).to_numpy(zero_copy_only=False)


def _each(make, fields: list[str]):
    """Rows that make(data, first, last) gives for the runs wanted of each text, with the run's name and copies."""

    def each(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, wanted in texts:
            for at in range(0, len(text), 64):
                part = wanted.slice(at, 64)
                name, copies, first, last = (_numbers(part, f) for f in ("name", "copies", "first", "last"))
                ends = np.cumsum([0, *part.value_lengths().to_pylist()])
                columns, sizes = [[] for _ in fields], [0]
                for t, a, z in zip(text.slice(at, 64), ends, ends[1:]):
                    run, *rest = make(t.as_py().encode("utf-8", "replace"), first[a:z], last[a:z])
                    for c, x in zip(columns, (name[a:z][run], copies[a:z][run], *rest)):
                        c.append(x)
                    sizes.append(len(run))
                rows = pa.StructArray.from_arrays([pa.array(np.concatenate(c)) for c in columns], fields)
                yield pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)), rows)

    return F.arrow_udf(each, "array<struct<" + ",".join(f"{f}:bigint" for f in fields) + ">>")


_BLOCKS = ["name", "copies", "k", "core", "context", "first", "last"]
_STARTS = ["name", "copies", "start", "at"]


def _inside(first: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in a range."""
    return np.cumsum(np.bincount(first, minlength=n + 1) - np.bincount(last + 1, minlength=n + 1))[:n] > 0


Ranges = tuple[np.ndarray, np.ndarray]


def kept_parts(data: bytes, repeated: Ranges, lonely: Ranges) -> tuple[bytes, int, int]:
    """What stays of data, how many bytes go, and in how many spans, from ranges of repeated starts and of lonely ones among them."""
    n = len(data) - WIDTH + 1
    starts = _inside(*repeated, n) & ~_inside(*lonely, n)
    total = np.concatenate([[0], np.cumsum(starts, dtype=np.int64), np.full(WIDTH, starts.sum())])
    at = np.arange(len(data))
    gone = total[np.minimum(at + 1, n)] > total[np.maximum(at - WIDTH + 1, 0)]
    spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[:1].sum())
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), int(gone.sum()), spans


_KEPT = pa.struct([("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def _kept(with_bytes: bool):
    def kept(rows: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, *marks in rows:
            for at in range(0, len(text), 64):
                out = []
                parts = [m.slice(at, 64) for m in marks]
                ends = [np.cumsum([0, *(n or 0 for n in p.value_lengths().to_pylist())]) for p in parts]
                ranges = [[_numbers(p, f) for f in ("first", "last")] for p in parts]
                for i, t in enumerate(text.slice(at, 64)):
                    data = left = t.as_py().encode("utf-8", "replace")
                    n = spans = 0
                    repeated, lonely = ([x[e[i] : e[i + 1]] for x in pair] for pair, e in zip(ranges, ends))
                    if len(repeated[0]):
                        left, n, spans = kept_parts(data, repeated, lonely)
                    out.append({"n_removed": n, "n_spans": spans, "kept_sha256": hashlib.sha256(left).hexdigest(), "kept": left if with_bytes else None})
                yield pa.array(out, _KEPT)

    return F.arrow_udf(kept, "struct<n_removed:bigint,n_spans:bigint,kept_sha256:string,kept:binary>")


_SETTLED = "copies bigint, context bigint, high bigint, row bigint, digest bigint, first bigint, last bigint, status int, head boolean"
ALONE, ALIKE, UNLIKE, OPEN, EDGE = range(5)


def _neighbours(group: list[str], drop_alone: bool):
    """Compares neighbours in a sorted partition. Each row gets its group's status, head for the first row of those with one
    context, and copies for all of these. The first and the last group of a partition may go on in the next one: they
    are open, and an edge row tells what is here of each."""

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle(t: pa.Table, open_first: bool, open_last: bool) -> pa.RecordBatch:
            t = t.combine_chunks()
            col = {c: t[c].to_numpy() for c in t.column_names}
            change = np.zeros(len(t), bool)
            change[0] = True
            for c in group:
                change[1:] |= col[c][1:] != col[c][:-1]
            start = np.flatnonzero(change)
            total, low = np.add.reduceat(col["copies"], start), col["context"][start]
            high = col["context"][np.append(start[1:], len(t)) - 1]
            status = np.where(total == 1, ALONE, np.where(low == high, ALIKE, UNLIKE)).astype(np.int32)
            edges = sorted({*([0] if open_first else []), *([len(start) - 1] if open_last else [])})
            status[edges] = OPEN
            change[1:] |= col["context"][1:] != col["context"][:-1]
            classes = np.flatnonzero(change)
            copies = col["copies"].copy()
            copies[classes] = np.add.reduceat(col["copies"], classes)
            own = np.repeat(status, np.diff(np.append(start, len(t))))
            keep = np.flatnonzero(own != ALONE) if drop_alone else np.arange(len(t))
            edge = start[edges]
            both = {c: np.concatenate([col[c][keep], col[c][edge]]) for c in (*group, "row", "digest", "first", "last")}
            both |= {"copies": np.concatenate([copies[keep], total[edges]]), "context": np.concatenate([col["context"][keep], low[edges]]), "high": np.concatenate([col["context"][keep], high[edges]])}
            both |= {"status": np.concatenate([own[keep], np.full(len(edge), EDGE, np.int32)]), "head": np.concatenate([change[keep], np.ones(len(edge), bool)])}
            names = [*group, *(x.split()[0] for x in _SETTLED.split(", "))]
            return pa.RecordBatch.from_arrays([pa.array(both[c]) for c in names], names)

        rest, first, size = None, True, 0
        for batch in batches:
            if not len(batch):
                continue
            rest = pa.concat_tables([*([rest] if rest is not None else []), pa.Table.from_batches([batch])])
            last = [rest[c][len(rest) - 1].as_py() for c in group]
            same = np.ones(len(rest), bool)
            for c, x in zip(group, last):
                same &= rest[c].to_numpy() == x
            cut = len(rest) - int(same.sum())  # the last group may go on in the next batch
            if cut >= 1 << 15:
                yield settle(rest.slice(0, cut), first, False)
                rest, first = rest.slice(cut), False
        if rest is not None and len(rest):
            yield settle(rest, first, True)

    return neighbours


def settled(df: DataFrame, group: list[str], name: str, *, drop_alone: bool = False) -> Stored:
    """Suffixes (group, context, copies, row, digest, first, last) sorted by group and context and compared with their neighbours.

    Adds status: ALONE (one copy in its group), ALIKE (several, all of one context) or UNLIKE; head; and copies of a head's
    context. The range sort goes on to the place in the text, so a group of any size is dealt to many tasks. The edges, at
    most two for each partition of the sort, are small enough to be broadcast.
    """
    order = [*group, "context", "row", "first"]
    rows = df.select(*group, "context", "copies", "row", "digest", "first", "last").repartitionByRange(*order).sortWithinPartitions(*order)
    found = Stored(rows.mapInArrow(_neighbours(group, drop_alone), ", ".join(f"{c} bigint" for c in group) + ", " + _SETTLED), f"{name}-sorted")
    edges = found.df().where(F.col("status") == EDGE).groupBy(*group).agg(F.sum("copies").alias("n"), F.min("context").alias("low"), F.max("high").alias("top"))
    status = F.when(F.col("n") == 1, ALONE).when(F.col("low") == F.col("top"), ALIKE).otherwise(UNLIKE)
    edges = edges.select(*group, status.alias("found"))
    done = found.df().where(F.col("status") < EDGE).join(F.broadcast(edges), group, "left")
    done = done.withColumn("status", F.when(F.col("status") == OPEN, F.col("found")).otherwise(F.col("status"))).drop("found", "high")
    out = Stored(done.where(F.col("status") != ALONE) if drop_alone else done, name)
    found.drop()
    return out


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, with_bytes: bool = True) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept) for each row; kept (null unless with_bytes) is what remains."""
    bounded_batches(df.sparkSession)
    spark, digest = df.sparkSession, F.xxhash64(F.col(text_col))
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("bigint"), digest).alias("row"), digest.alias("digest"), text_or_empty(text_col).alias("text"))
    one = ["row", "digest"]
    found = docs.where(F.octet_length("text") >= WIDTH).select(*one, "text").mapInArrow(_runs, ", ".join(f"{c} bigint" for c in _RUN))
    found = Stored(found, "suffix-runs")
    shared = settled(found.df().withColumn("copies", F.lit(1).cast("bigint")), ["name"], "suffix-shared", drop_alone=True)
    found.drop()
    release(spark)

    def wanted(rows: DataFrame) -> DataFrame:
        """The first suffix of each context, with its copies, gathered by document."""
        run = F.struct("name", "copies", "first", "last")
        return rows.where((F.col("status") == UNLIKE) & F.col("head")).groupBy(*one).agg(F.collect_list(run).alias("wanted"))

    texts = Stored(docs.select(*one, "text").join(wanted(shared.df()), one), "suffix-texts")
    inside = texts.df().select(*one, _each(blocks, _BLOCKS)("text", "wanted").alias("blocks"))
    merged = settled(inside.select(*one, F.inline("blocks")), ["name", "k", "core"], "suffix-blocks")
    release(spark)
    starts = texts.df().select(*one, "text").join(wanted(merged.df()), one).select(*one, _each(starts_named, _STARTS)("text", "wanted").alias("starts"))
    starts = starts.select(*one, F.inline("starts")).withColumn("context", F.lit(0).cast("bigint"))
    single = settled(starts.withColumn("first", F.col("at")).withColumn("last", F.col("at")), ["name", "start"], "suffix-starts")
    lonely = merged.df().where(F.col("status") == ALONE).select(*one, "first", "last").union(single.df().where(F.col("status") == ALONE).select(*one, "first", "last"))
    lonely = lonely.groupBy(*one).agg(F.collect_list(F.struct("first", "last")).alias("lonely"))
    repeated = shared.df().groupBy(*one).agg(F.collect_list(F.struct("first", "last")).alias("repeated"))
    marks = Stored(repeated.join(lonely, one, "left"), "suffix-marks")
    for x in (shared, texts, merged, single):
        x.drop()
    release(spark)
    done = docs.join(marks.df(), one, "left").select("id", F.octet_length("text").cast("bigint").alias("n_bytes"), _kept(with_bytes)("text", "repeated", "lonely").alias("x"))
    return done.select(F.col("id").alias(id_col), "n_bytes", "x.n_removed", "x.n_spans", "x.kept_sha256", "x.kept")


def op4_suffix_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return finished(remove_repeats(docs, with_bytes=False).drop("kept"), "suffix-done")
