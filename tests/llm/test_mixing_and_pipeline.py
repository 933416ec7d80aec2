import random
import re

import numpy as np
import pytest
import sentencepiece
import test_near as near
from pyspark.sql import functions as F
from test_pii import luhn_ok, second_feistel

import __spark_entry__ as entry
import corpus_pipeline as C
from loomspark.llm import mixing as X
from loomspark.llm import pii
from loomspark.llm.common import table, tokenizer_path

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def labelled(spark, docs_of):
    r = random.Random(2)
    good, bad = [f"word{i}" for i in range(300)], ["vile", "nasty", "rotten"]
    rows, labels = [], []
    for i in range(600):
        toxic, low = i % 6 == 0, i % 6 == 1
        words = [r.choice(bad) if toxic and r.random() < 0.2 else r.choice(good) + ("### &&&" if low else "") for _ in range(r.randrange(20, 90))]
        rows.append((i, " ".join(words)))
        if i % 2 == 0 or low:
            labels.append((i, int(not low), int(toxic)))
    return docs_of(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_totals_match_targets(spark, labelled):
    docs, labels = labelled
    rated = X.mix(docs, X.quality_domains(labels), {"high": 0.6, "low": 0.4, "toxic": 0.0}, tokens=40_000).cache()
    sums = rated.agg(*[F.sum(F.col("n_tokens") * F.col("rate") * F.col(f"p_{d}")).alias(d) for d in ("high", "low", "toxic")]).first()
    assert abs(sums.high - 24_000) < 400 and abs(sums.low - 16_000) < 400 and sums.toxic < 400
    assert rated.where("rate < 0").count() == 0
    toxic = rated.where("doc_id % 6 = 0").agg(F.avg("rate"), F.count_if(F.col("rate") == 0)).first()
    assert toxic[0] < 0.05 and toxic[1] >= 95
    total = rated.agg(F.sum("rate"), F.sum("copies")).first()
    assert abs(total[0] - total[1]) < 0.1 * total[0]


def test_posteriors(spark, labelled):
    docs, labels = labelled
    model = X.Classifier.fit(docs, X.quality_domains(labels))
    got = model.posteriors(docs).select("doc_id", F.array_position("posterior__", F.array_max("posterior__")).alias("best")).collect()
    want = {0: "toxic", 1: "low"}
    assert sum(model.domains[r.best - 1] == want.get(r.doc_id % 6, "high") for r in got) >= 585


def test_words_alike_in_their_first_letters_and_words_of_another_language(spark):
    r, rows, labels = random.Random(4), [], []
    for i in range(600):
        lang, toxic = ("de", "en")[i % 2], i % 6 < 2
        bad, good = ("schrecklicher", "schreckens") if lang == "de" else ("gift", "present")
        odd = "gift" if lang == "de" else "schrecklicher"
        words = [f"word{r.randrange(300)}" for _ in range(40)] + [bad if toxic else good] * 2 + ([] if toxic else [odd])
        rows.append((i, " ".join(words), lang, "s", 0))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    model = X.Classifier.fit(docs, X.quality_domains(spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")))
    got = model.posteriors(docs).select("doc_id", F.col("posterior__")[model.domains.index("toxic")].alias("p")).collect()
    assert all((x.p > 0.5) == (x.doc_id % 6 < 2) for x in got)


def test_words_alike_only_in_their_beginnings_and_a_few_documents_full_of_marks(spark):
    """Each toxic document has words of its own, all with one beginning; some are full of marks, which says nothing of the others."""
    r, rows, labels = random.Random(5), [], []
    ending = lambda: "".join(r.choice("aeioumnrst") for _ in range(6))
    for i in range(1200):
        toxic = i % 6 == 0
        words = [f"word{r.randrange(300)}" for _ in range(r.randrange(60, 300))]
        words += ["vilest" + ending() for _ in range(4 if toxic else r.random() < 0.1)] + ["###!!!"] * (40 if i % 30 == 0 else 0)
        r.shuffle(words)
        rows.append((i, " ".join(words), "xx", "s", 0))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    taught = X.quality_domains(spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").where("doc_id % 4 <> 2"))
    model = X.Classifier.fit(docs, taught)
    got = model.posteriors(docs).where("doc_id % 4 = 2").select("doc_id", F.col("posterior__")[model.domains.index("toxic")].alias("p")).collect()
    assert len(got) == 300 and all((x.p > 0.5) == (x.doc_id % 6 == 0) for x in got)


def posterior_by_hand(model, text, lang):
    """The probabilities of one text, word by word."""
    words = re.split(r"[^a-z0-9\x80-\U0010ffff]+", text.lower())
    langs = {x for by_lang in model.lexicons.values() for x in by_lang}
    own = [set(by_lang.get(lang, [])) if lang in langs else {w for ws in by_lang.values() for w in ws} for by_lang in model.lexicons.values()]
    entries = set().union(*own)
    counted = [w if w in entries else w[:5] + "*" if len(w) >= 5 and w[:5] + "*" in entries else None for w in words]
    kinds = [sum(w in kind for w in counted) for kind in own] + [counted.count(None)]
    for pattern in (r"[#$%&*|!<>{}=]", "[A-Z]{3}", "[0-9]+"):
        density = len(re.findall(pattern, text)) / len(words)
        kinds += [density == 0, 0 < density <= 0.01, 0.01 < density <= 0.1, density > 0.1]
    logs = np.array([p + np.dot(ws, kinds) for p, ws in zip(model.log_prior, model.log_share)])
    e = np.exp(logs - logs.max())
    return e / e.sum()


def test_like_dense_projected_gradient(spark, labelled):
    """Posteriors word by word, then rates of all documents as one numpy vector."""
    docs, labels = labelled
    docs, domains, weights, tokens = docs.withColumn("lang", F.lit("en")), X.quality_domains(labels), {"high": 0.6, "low": 0.4, "toxic": 0.0}, 40_000
    model = X.Classifier.fit(docs, domains)
    rows = docs.orderBy("doc_id").collect()
    p = np.array([posterior_by_hand(model, r.text, "en") for r in rows])
    n = np.array([float(len(r.text.split())) for r in rows])
    target = np.array([tokens * weights[d] for d in model.domains])
    rate = np.ones(len(rows))
    for _ in range(24):
        left = target - (n * rate) @ p
        if abs(left).sum() <= 1e-4 * target.sum():
            break
        rate = np.maximum(0, rate + p @ np.linalg.solve(p.T @ (n[:, None] * p), left))
    got = {r.doc_id: r for r in X.mix(docs, domains, weights, tokens=tokens).collect()}
    for r, own, x, k in zip(rows, p, rate, n):
        g = got[r.doc_id]
        assert g.n_tokens == k and np.allclose([g[f"p_{d}"] for d in model.domains], own, atol=1e-6)
        assert abs(g.rate - x) < 1e-3 * max(1.0, x)


def test_only_sql(spark, labelled):
    docs, labels = labelled
    plan = X.mix(docs, X.quality_domains(labels), None)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def plans_of(spark, run):
    """The plans of all queries that run() starts, those that write scratch tables included."""
    store = spark._jsparkSession.sharedState().statusStore()
    listened = lambda: spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    listened()
    before = store.executionsCount()
    run()
    listened()
    found = store.executionsList(int(before), 10_000)
    return [found.apply(i).physicalPlanDescription() for i in range(found.size())]


def native(plans, name):
    """Does Spark's own writer make the tables called name, and no plan hold Python?"""
    return any(f"/{name}" in p and "InsertIntoHadoopFsRelationCommand" in p for p in plans) and not any(re.search("Python|Arrow", p) for p in plans)


def test_scratch_tables_are_written_without_python(spark, labelled, folder_of):
    path = folder_of(documents=labelled[0], labels=labelled[1])
    plans = plans_of(spark, lambda: X.op9_mixing(spark, path).collect())
    assert all(native(plans, f"mixing-{x}") for x in ("sample", "words", "scored"))


def test_pipeline_mixes_without_python(spark, monkeypatch, labelled, folder_of):
    path = folder_of(documents=labelled[0], labels=labelled[1])
    monkeypatch.setattr(C, "STAGES", [s for s in C.STAGES if s[0] == "mixing"])
    plans = plans_of(spark, lambda: C.run(spark, path).collect())
    assert native(plans, "pipeline-mixing")


def test_odd_tables(spark, labelled, docs_of):
    docs, labels = labelled
    domains = X.quality_domains(labels)
    odd = docs_of([None, "", (None, "vile nasty"), (7, "a"), (7, "a")]).withColumn("Rate", F.lit("old"))
    rows = X.mix(odd.union(docs.withColumn("Rate", F.lit("old"))), domains, None, floor={"toxic": 0.0}).collect()
    assert len(rows) == 605 and all(r.rate >= 0 for r in rows)
    assert X.mix(docs_of([]), domains, {"high": 1.0}).collect() == []
    alone = X.mix(docs, domains.where("false"), {"high": 1.0}).collect()
    assert len(alone) == 600 and {r.rate for r in alone} == {1.0}
    assert X.quality_domains(spark.createDataFrame([(1, None, None), (2, 0, None), (3, None, 1)], "doc_id bigint, quality int, toxic int")).collect()[0].domain is None
    with pytest.raises(ValueError):
        X.mix(docs, domains, {"unheard": 1.0})


def run_stages(spark, docs, sf_dir, tmp_path):
    out = [docs]
    for name, stage in C.STAGES:
        stage(spark, out[-1], sf_dir).write.parquet(f"{tmp_path}/{name}")
        out.append(spark.read.parquet(f"{tmp_path}/{name}"))
    return out


def test_pipeline_stages(spark, tmp_path):
    docs = table(spark, DATA, "documents")
    out = run_stages(spark, docs, DATA, tmp_path)
    for df in out[:-1]:
        assert df.columns == docs.columns
    ids = [{r.doc_id for r in df.select("doc_id").collect()} for df in out]
    assert all(b <= a for a, b in zip(ids, ids[1:]))
    kept = {r.doc_id for r in entry.queries()["op8_minhash"](spark, DATA).where("kept").collect()}
    assert ids[2] == kept & ids[1]
    names = pii.Pseudonyms(pii.default_key())
    before = {r.doc_id: r.text for r in out[2].collect()}
    assert {r.doc_id: r.text for r in out[3].collect()} == {i: names.text(t)[0] for i, t in before.items()}
    assert all(r.round_trip for r in out[5].collect()) and ids[5] == ids[4]
    again = C.run(spark, DATA)
    assert sorted(map(str, again.collect())) == sorted(map(str, out[5].collect()))


def test_pipeline_like_brute_force(spark, docs_of, folder_of, tmp_path):
    """Each stage against a plain version: letters, all pairs, a second permutation of cards, dense rates, the library's ids."""
    r = random.Random(12)
    good, bad = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)], ["vile", "nasty", "rotten"]
    rows, labels = [], []
    for i in range(240):
        words = [r.choice(bad) if i % 6 == 0 and r.random() < 0.3 else r.choice(good) for _ in range(r.randrange(8, 60))]
        rows.append((i, " ".join(words) + (" ### &&& !!!" * 3 if i % 6 == 1 else "")))
        labels.append((i, int(i % 6 != 1), int(i % 6 == 0)))
    for i in range(240, 300):  # exact and near copies
        text = r.choice(rows[:240])[1].split()
        if i % 2:
            text[r.randrange(len(text))] = "changed"
        rows.append((i, " ".join(text)))
    rows = [(i, t + (" 4111111111111111" if i % 9 == 0 else "")) for i, t in rows] + [(900, "12 34 !?"), (901, None), (902, "")]
    docs = docs_of(rows).withColumn("lang", F.lit("en"))
    label_table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    out = run_stages(spark, docs, folder_of(labels=label_table), tmp_path)
    texts = [{x.doc_id: x.text for x in df.collect()} for df in out[:-1]]

    want = {i: t for i, t in rows if any(c.isalpha() for c in t or "")}
    assert texts[1] == want

    ids = sorted(want)
    sets = [near.shingles(want[i]) for i in ids]
    links = [(a, b) for a in range(len(ids)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = {ids[i]: want[ids[i]] for i, root in enumerate(near.joined(len(ids), links)) if i == root}
    assert texts[2] == want and len(want) < len(ids)

    body = "".join(map(str, [second_feistel(int("1" * 14), 10**14, b"card4|" + b",".join([b"10"] * 14), pii.default_key())])).zfill(14)
    card = next("4" + body + d for d in "0123456789" if luhn_ok("4" + body + d))
    want = {i: t.replace("4111111111111111", card) for i, t in want.items()}
    assert texts[3] == want and any(card in t for t in want.values())

    model = X.Classifier.fit(out[3], X.quality_domains(label_table))
    ids = sorted(want)
    p = np.array([posterior_by_hand(model, want[i], "en") for i in ids])
    n = np.array([float(len(want[i].split())) for i in ids])
    have = n @ p
    target = np.where([d == "toxic" for d in model.domains], 0.0, have)
    rate = np.ones(len(ids))
    for _ in range(24):
        left = target - (n * rate) @ p
        if abs(left).sum() <= 1e-4 * target.sum():
            break
        rate = np.maximum(0, rate + p @ np.linalg.solve(p.T @ (n[:, None] * p), left))
    assert not ((rate > 0.499) & (rate < 0.501)).any()
    want = {i: want[i] for i, x in zip(ids, rate) if x >= 0.5}
    assert texts[4] == want and 0 < len(want) < len(ids)
    toxic = [i for i in ids if i < 240 and i % 6 == 0]
    assert sum(i in want for i in toxic) <= 0.1 * len(toxic) and sum(i in want for i in ids if i < 240 and i % 6) >= 0.97 * sum(i < 240 and i % 6 > 0 for i in ids)

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    assert {x.doc_id: x.ids for x in out[5].collect()} == {i: library.encode(t) for i, t in want.items()}


def test_pipeline_on_odd_documents(spark, docs_of, folder_of, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    path = folder_of(labels=labels)
    t = "The quick brown fox jumps over the lazy dog again and again"
    odd = docs_of([(0, None), (1, t), (1, t), (2, t + " now"), (3, ""), (4, "123"), (None, "another text without an id"), (5, "x" * 100_000)]).withColumn("rate", F.lit(1)).withColumn("ids", F.lit("x"))
    out = run_stages(spark, odd, path, tmp_path / "a")
    left = sorted((-1 if r.doc_id is None else r.doc_id) for r in out[-1].collect())
    assert left == [-1, 1, 5]
    assert run_stages(spark, docs_of([]), path, tmp_path / "b")[-1].collect() == []


def test_pipeline_keeps_extra_columns_and_rows_without_an_id(spark, docs_of, folder_of, tmp_path):
    labels = spark.createDataFrame([(5, 1, 0), (6, 0, 0)], "doc_id bigint, quality int, toxic int")
    path = folder_of(labels=labels)
    t = "The quick brown fox jumps over the lazy dog again and again"
    for name, last in (("distinct", 6), ("repeated", 5)):  # whether any id repeats changes nothing for those without one
        odd = docs_of([(None, t), (None, t), (5, t + " b one two three four five six"), (last, "Something else in English, which is not like the others")])
        extra = {"rate": F.lit(7.0), "copies": F.lit("mine"), "n_tokens": F.lit(-1), "Mix__rate": F.lit(0), "done__": F.lit("d"), "guess__": F.lit("g"), "lang_pred__": F.lit("l"), "score__": F.lit(2)}
        for c, v in extra.items():
            odd = odd.withColumn(c, v)
        rows = run_stages(spark, odd, path, tmp_path / name)[-2].collect()
        assert sum(r.doc_id is None for r in rows) == 2 and len(rows) == (4 if last == 6 else 3)
        assert {(r.rate, r.copies, r.n_tokens, r.Mix__rate, r.done__, r.guess__, r.lang_pred__, r.score__) for r in rows} == {(7.0, "mine", -1, 0, "d", "g", "l", 2)}


def test_registered_queries(spark):
    names = [q for q in entry.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 11)) and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
