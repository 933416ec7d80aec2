"""Repeats against a brute-force count of all strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from loomspark.llm import suffix_dedup as D

W = D.WIDTH


def all_runs(data):
    return tuple(np.concatenate(c) for c in zip(*D.runs(data)))


def brute(texts):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + W] for d in data for i in range(len(d) - W + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - W + 1):
            if count[d[i : i + W]] > 1:
                gone[i : i + W] = True
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = sum(bool(g) and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def words(r, n):
    return " ".join("".join(r.choice("abcdefgé") for _ in range(r.randrange(1, 8))) for _ in range(n))[: n * 5]


def corpus(seed):
    r = random.Random(seed)
    shared = [words(r, 160) for _ in range(4)]
    texts = [words(r, r.randrange(1, 400)) for _ in range(12)]
    for _ in range(10):  # passages in new surroundings, whole and cut
        p = r.choice(shared)
        a, b = r.randrange(0, 200), r.randrange(len(p) - 200, len(p))
        texts.append(words(r, r.randrange(0, 60)) + p[a:b] + words(r, r.randrange(0, 60)))
    base = words(r, 500)
    for _ in range(6):  # near copies
        cut = list(base)
        for _ in range(r.randrange(0, 4)):
            cut[r.randrange(len(cut))] = "#"
        texts.append("".join(cut))
    texts += ["x" * 399, "x" * 400, "y" * 1000, "ab" * 700, "z" * 405 + "q" + "z" * 401, "", None]
    texts += [texts[0], texts[0], texts[5]]
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_like_brute_force(spark, docs_of, seed):
    texts = corpus(seed)
    got = {r.doc_id: r for r in D.remove_repeats(docs_of(texts)).collect()}
    want = brute(texts)
    for i, (n, removed, spans, digest) in enumerate(want):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, removed, spans, digest), i
        assert hashlib.sha256(r.kept).hexdigest() == digest


@pytest.mark.parametrize("chunk", [1, 37, 500])
def test_chunks_change_nothing(monkeypatch, chunk):
    data = words(random.Random(9), 700).encode()
    whole = all_runs(data)
    monkeypatch.setattr(D, "CHUNK", chunk)
    parts = all_runs(data)
    place = lambda x: [(n, s) for n, a, b in zip(x[0], x[2], x[3]) for s in range(a, b + 1)]
    assert place(whole) == place(parts) and [s for _, s in place(whole)] == list(range(len(data) - W + 1))


def test_equal_strings_share_a_sampled_suffix():
    r = random.Random(4)
    a, b = words(r, 300).encode(), words(r, 300).encode()
    s = words(r, 200).encode()[:W]
    names = []
    for before, after in ((a, b), (b, a), (b"", a), (a, b"")):
        name, _, first, last = all_runs(before + s + after)
        (k,) = np.flatnonzero((first <= len(before)) & (last >= len(before)))
        names.append(name[k])
    assert len(set(names)) == 1


@pytest.mark.parametrize("seed", range(4))
def test_neighbours_across_partitions(seed):
    """Groups cut by the ends of partitions and batches, a hot one among them, settle as they do in one piece."""
    r = np.random.default_rng(seed)
    n = 60_000
    name = np.sort(np.where(r.random(n) < 0.3, 7, r.integers(0, 30_000, n)))
    context, copies = r.integers(0, 2, n), r.integers(1, 3, n)
    order = np.lexsort((context, name))
    name, context, copies = name[order], context[order], copies[order]
    columns = {c: np.arange(n) for c in ("row", "digest", "first", "last")} | {"name": name, "context": context, "copies": copies}
    cuts = np.sort(r.integers(0, n, 5))
    out = []
    for a, b in zip([0, *cuts], [*cuts, n]):
        batches = [pa.RecordBatch.from_arrays([pa.array(v[x : min(x + 9000, b)]) for v in columns.values()], list(columns)) for x in range(a, b, 9000)]
        out += [row for batch in D._neighbours(["name"], False)(iter(batches)) for row in batch.to_pylist()]
    edges = {}
    for e in out:
        if e["status"] == D.EDGE:
            total, low, high = edges.get(e["name"], (0, 9, -1))
            edges[e["name"]] = total + e["copies"], min(low, e["context"]), max(high, e["high"])
    assert len([e for e in out if e["status"] == D.EDGE]) <= 12
    rows = [e for e in out if e["status"] != D.EDGE]
    assert [e["row"] for e in rows] == list(range(n))
    heads = {}
    for e in rows:
        total, low, high = edges[e["name"]] if e["status"] == D.OPEN else (None, None, None)
        found = e["status"] if total is None else D.ALONE if total == 1 else D.ALIKE if low == high else D.UNLIKE
        own = name == e["name"] if e["row"] % 997 == 0 else None
        if own is not None:
            want = D.ALONE if copies[own].sum() == 1 else D.ALIKE if len(set(context[own])) == 1 else D.UNLIKE
            assert found == want
        if e["head"]:
            heads[e["name"], e["context"]] = heads.get((e["name"], e["context"]), 0) + e["copies"]
    assert sum(heads.values()) == copies.sum()


def test_texts_of_one_byte(spark, docs_of):
    rows = {r.doc_id: r for r in D.remove_repeats(docs_of(["x" * 200_000, "y" * 399 + "z", "ab" * 3000]), with_bytes=False).collect()}
    assert [rows[i].n_removed for i in range(3)] == [200_000, 0, 6000] and rows[0].n_spans == 1


def test_odd_tables(spark, docs_of):
    assert D.remove_repeats(docs_of([])).collect() == []
    long_ = words(random.Random(2), 200)
    rows = D.remove_repeats(docs_of([(1, long_), (1, long_), (None, long_ + "!"), (None, None), (2, "short")])).collect()
    assert sorted(r.n_removed for r in rows) == sorted([len(long_.encode())] * 3 + [0, 0])


def test_query(spark, docs_of, folder_of):
    texts = corpus(7)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in D.op4_suffix_dedup(spark, folder_of(documents=docs_of(texts))).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)
