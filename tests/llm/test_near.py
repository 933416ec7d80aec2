"""Near-duplicate texts and vectors against all pairs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspark.llm import minhash as M
from loomspark.llm import vector_dedup as V
from loomspark.llm.components import connected_components
from loomspark.llm.shingles import OnePermutation, shingle_set, word_hashes


def find(parent, i):
    while parent[i] != i:
        i = parent[i]
    return i


def joined(n, pairs):
    parent = list(range(n))
    for a, b in pairs:
        a, b = find(parent, a), find(parent, b)
        parent[max(a, b)] = min(a, b)
    return [find(parent, i) for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    r = random.Random(seed)
    pairs = [(r.randrange(60), r.randrange(60)) for _ in range(r.choice([5, 40, 80]))] + [(i, i + 1) for i in range(60, 99)]
    want = joined(100, pairs)
    df = spark.createDataFrame([*pairs, *pairs[:3], (None, 3), (4, 4)], "src bigint, dst bigint")
    got = {x.id: x.component for x in connected_components(df).collect()}
    assert got == {i: want[i] for p in pairs if p[0] != p[1] for i in p}
    assert connected_components(df.where("false")).collect() == []


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def corpus(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    say = lambda n: [r.choice(vocabulary) for _ in range(n)]
    texts = [" ".join(say(r.randrange(1, 80))) for _ in range(30)]
    for n in (12, 40, 150, 400):
        base = say(n)
        for _ in range(12):
            x = list(base)
            for _ in range(r.randrange(0, max(2, n // 25))):
                x[r.randrange(n)] = r.choice(vocabulary)
            texts.append(r.choice([" ", "\n", " \t"]).join(x))
    passage = say(60)
    texts += [" ".join(say(r.randrange(10, 30)) + passage + say(r.randrange(10, 30))) for _ in range(25)]
    texts += [texts[3].upper(), texts[3] + " ", "", None, " \n", "One", "one", "two words", "Two\tWORDS", "ÉCOLE a", "école a", "\x1c x", *[texts[40]] * 5]
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_texts_like_all_pairs(spark, docs_of, folder_of, seed):
    texts = corpus(seed)
    sets = [shingles(t) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    want = joined(len(texts), links)
    got = {r.doc_id: r for r in M.op8_minhash(spark, folder_of(documents=docs_of(texts))).collect()}
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert [got[i].component_id for i in range(len(texts))] == want
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


@pytest.mark.parametrize("tile, bound", [(256, 1 << 18), (8, 400)])
def test_hot_group_about_the_threshold(spark, docs_of, monkeypatch, tile, bound):
    """Near copies of one text, most pairs of them just under or over the threshold, in tiles and in one piece."""
    monkeypatch.setattr(M, "TILE", tile)
    monkeypatch.setattr(M, "SHINGLES", bound)
    r = random.Random(5)
    base = [f"w{r.randrange(900)}" for _ in range(120)]
    texts = []
    for _ in range(260):
        x = list(base)
        for _ in range(r.randrange(2, 8)):
            x[r.randrange(120)] = f"o{r.randrange(10**9)}"
        texts.append(" ".join(x))
    texts += [" ".join(base[:60] + [f"p{k}-{i}" for i in range(60)]) for k in range(40)]
    sets = [shingles(t) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    want = joined(len(texts), links)
    got = {r.doc_id: r.component_id for r in M.near_duplicates(docs_of(texts)).collect()}
    met = sum(got[i] == got[j] for i, j in links) / len(links)
    assert met >= 0.99 and sum(got[i] == want[i] for i in got) >= 0.99 * len(got)
    assert all(want[got[i]] == want[i] for i in got)  # nothing is joined that isn't linked


def test_intersections_by_product():
    r = np.random.default_rng(3)
    sets = [np.unique(r.integers(0, 9000, n)) for n in (0, 1, 5, 700, 6000, 6000, *r.integers(1, 50, 20))]
    values, ends = np.concatenate(sets), np.cumsum([0, *map(len, sets)])
    left, right = np.arange(0, 26, 2), np.arange(1, 26, 2)
    want = [[len(np.intersect1d(sets[a], sets[b])) for b in right] for a in left]
    assert M._common(values, ends, left, right).tolist() == want
    assert M._common(values, ends, left[:5], right[:9]).tolist() == [row[:9] for row in want[:5]]  # few: one by one


def test_odd_document_tables(spark, docs_of):
    assert M.near_duplicates(docs_of([])).collect() == []
    t = "a b c d e f g"
    rows = M.near_duplicates(docs_of([(5, t), (5, t), (None, t), (7, t), (9, "x")]).withColumn("kept", F.lit(1)).withColumn("component_id", F.lit(2))).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.component_id) for r in rows if r.doc_id) == [(False, 5, 5), (False, 5, 5), (False, 7, 5), (False, 9, 9)]
    assert [r.component_id for r in rows if r.doc_id is None] == [None]


def test_densified_bins_estimate_similarity():
    r = np.random.default_rng(1)
    scheme = OnePermutation()
    for size in (4, 30, 500, 5000):
        hits = []
        for _ in range(60):
            pool = np.unique(r.integers(0, 2**63, size * 5 // 4, dtype=np.uint64))
            a, b = np.sort(pool[: len(pool) * 9 // 10]), np.sort(pool[len(pool) // 10 :])
            true = len(np.intersect1d(a, b)) / len(pool)
            hits.append((scheme.signature(a) == scheme.signature(b)).mean() - true)
        assert abs(np.mean(hits)) < 0.04


def test_long_texts_in_chunks(monkeypatch):
    import loomspark.llm.shingles as S

    data = " ".join(f"word{i}" for i in range(3000)).encode()
    whole = word_hashes(data)
    monkeypatch.setattr(S, "CHUNK", 100)
    assert (word_hashes(data) == whole).all() and len(set(whole.tolist())) == 3000
    assert len(shingle_set("a " * 1000)) == 1


def vectors(seed, n=260, d=12):
    r = np.random.default_rng(seed)
    rows = []
    for label in (0, 1, None):
        centres = r.standard_normal((n // 12, d))
        for i in range(n):
            c = centres[r.integers(len(centres))] if i % 2 else r.standard_normal(d)
            rows.append((c + 0.16 * r.standard_normal(d), label))
    hot = r.standard_normal(d)
    rows += [(hot + 0.05 * r.standard_normal(d), 1) for _ in range(150)]
    out = [(i, [float(x) for x in v.astype(np.float32)], label) for i, (v, label) in enumerate(rows)]
    n = len(out)
    odd = [None, [], [0.0] * d, [float("nan")] + [1.0] * (d - 1), [float("inf")] + [1.0] * (d - 1), [None] + [1.0] * (d - 1), [1.0] * (d - 1), [1.0] * (d - 1), out[1][1], out[1][1]]
    return out + [(n + i, v, 0) for i, v in enumerate(odd)]


def all_pairs(rows):
    good = [(i, np.array(v, float), label) for i, v, label in rows if v and label is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    links = []
    for k, (i, x, label) in enumerate(good):
        for j, y, other in good[:k]:
            if label == other and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                links.append((i, j))
    return links


@pytest.mark.parametrize("seed", range(2))
def test_vectors_like_all_pairs(spark, folder_of, monkeypatch, seed):
    monkeypatch.setattr(V, "TILE", 64)
    rows = vectors(seed)
    links = all_pairs(rows)
    want, n = joined(len(rows), links), [0] * len(rows)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = {r.vec_id: r for r in V.op7_vector_dedup(spark, folder_of(embeddings=df)).collect()}
    assert len(got) == len(rows)
    assert [got[i].n_links for i in range(len(rows))] == n
    assert [got[i].component_id for i in range(len(rows))] == want


def like_all_pairs(spark, rows, **options):
    links = all_pairs(rows)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = {r.vec_id: r for r in V.near_duplicate_vectors(df, **options).collect()}
    want = joined(len(rows), links)
    assert [got[i].n_links for i in range(len(rows))] == np.bincount(np.array(links, int).ravel(), minlength=len(rows)).tolist()
    assert [got[i].component_id for i in range(len(rows))] == want
    return len({*want})


def tight_groups(seed, cosine, size=40, d=64):
    """Two groups, nearly equal inside and at this cosine to each other."""
    r = np.random.default_rng(seed)
    u, w = np.linalg.qr(r.standard_normal((d, 2)))[0].T
    ends = [u, cosine * u + np.sqrt(1 - cosine * cosine) * w]
    return [(i, [float(x) for x in ends[i % 2] + 0.0005 * r.standard_normal(d)], 0) for i in range(2 * size)]


@pytest.mark.parametrize("cosine", [0.935, 0.95])
def test_tight_groups_larger_than_a_list(spark, cosine):
    assert like_all_pairs(spark, tight_groups(3, cosine)) == 1


def test_tables_grow_with_bits():
    for bits in (6, 12, 16, 24):
        miss = (1 - (1 - np.arccos(0.93) / np.pi) ** bits) ** V._tables(12, bits, 0.93)
        assert miss <= 0.001


def lone_pairs(seed, pairs=25, others=300, d=32):
    """Pairs at cosine 0.94 in one cone with vectors that are like nothing else."""
    r = np.random.default_rng(seed)
    cone, rows = 2.0 * np.eye(d)[0] * np.sqrt(d), []
    for i in range(pairs + others):
        x = cone + r.standard_normal(d) if i < pairs else cone + 1.5 * r.standard_normal(d)
        x /= np.sqrt(x @ x)
        rows.append(x)
        if i < pairs:
            w = r.standard_normal(d)
            w -= (w @ x) * x
            rows.append(0.94 * x + np.sqrt(1 - 0.94**2) * w / np.sqrt(w @ w))
    return [(i, [float(v) for v in x.astype(np.float32)], 0) for i, x in enumerate(rows)]


def test_lone_pairs_in_a_full_cell(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", 8)
    monkeypatch.setattr(V, "TILE", 64)
    rows = lone_pairs(7)
    assert like_all_pairs(spark, rows, tables=1, forests=1, rounds=0, queries=4000) < len(rows) - 20


def test_audit_sees_what_a_hot_group_hides(spark, monkeypatch):
    rows = tight_groups(3, 0.2, size=150) + [(300 + i, v, 0) for i, v, _ in lone_pairs(7, pairs=40, others=0, d=64)]
    search = V._search

    def hot_only(*a):
        edges, wide = search(*a)
        return edges.where("a < 300 and b < 300"), wide.where("false")

    monkeypatch.setattr(V, "_search", hot_only)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    with pytest.raises(RuntimeError):
        V.near_duplicate_vectors(df, queries=8, forests=1)


def test_just_below_the_threshold(spark):
    turn = lambda c: [float(c), float(np.sqrt(1 - c * c))]
    assert like_all_pairs(spark, [(0, [1.0, 0.0], 0), (1, turn(0.9299995), 0), (2, [1.0, 0.0], 1), (3, turn(0.93000002), 1)]) == 3


def test_odd_vector_tables(spark):
    schema = "vec_id bigint, embedding array<float>, label int, kept string"
    assert V.near_duplicate_vectors(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, [1.0, 0.0], 1, ""), (1, [1.0, 0.0], 1, ""), (None, [1.0, 0.0], 1, ""), (2, [2.0, 0.0], 1, ""), (3, None, None, "")]
    got = sorted((r.vec_id or 0, r.n_links, r.component_id) for r in V.near_duplicate_vectors(spark.createDataFrame(rows, schema)).collect() if r.vec_id)
    assert got == [(1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3)]
