"""Whole builds: order, budgets, packing, shards, resume, incremental runs, the command line."""

import json
import random
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from loomspark import cli, report
from loomspark.config import SFT, PipelineConfig, SourceConfig, config_hash, load_config, source_included
from loomspark.operators.budget import apply_budgets
from loomspark.operators.ordinal import with_prefix_sums, with_rank
from loomspark.operators.pack import pack_sequences
from loomspark.operators.split import split_value, with_shards
from loomspark.operators.tokenizers import CharTokenizer, load_tokenizer
from loomspark.plans.pipeline import run_pipeline
from loomspark.sinks.shards import read_bin, validate_bin, write_bin
from loomspark.sources import files, objects
from loomspark.streaming.checkpoints import ProgressListener, publish_checkpoint, restore_checkpoint
from loomspark.streaming.incremental import IncrementalBuild


def config(tmp_path, sources, **more):
    given = dict(project_name="p", target_tokens=64, sequence_length=8, tokens_per_sample=8, val_ratio=0.0, seed=7, tokenizer_path="char", output_dir=str(tmp_path / "out"), work_dir=str(tmp_path / "work"), progress_path=str(tmp_path / "work/progress.json"), report_path=str(tmp_path / "report.json"), shard_sequences=2, sources=tuple(sources))
    return PipelineConfig(**given | more)


def source(name="a", kind="base", limit=64, **more):
    return SourceConfig(name=name, type=kind, hf_id="x", target_tokens=limit, **more)


TEXT = "def add(left, right):\n    return left + right\n\n\nprint(add(1, 2))\nprint(add(3, 4))\nprint(add(5, 6))\n"


def ids(text):
    return [ord(c) % 200 + 2 for c in text] + [1]


def test_pretrain_build(spark, tmp_path):
    rows = spark.createDataFrame([(1, TEXT, "a.py"), (2, TEXT + "# two", "b.py")], "row_offset bigint, content string, path string")
    meta = run_pipeline(spark, c := config(tmp_path, [source()]), streams={"a": rows})
    n = len(ids(TEXT))
    assert meta["total_tokens"] == n // 8 * 8 and meta["dropped_remainder_tokens"] == n % 8
    assert meta["sources"][0] | {} == {"name": "a", "type": "base", "mix_role": None, "target_tokens": 64, "processed_samples": 1, "accepted_tokens": n, "normalized_count": 1, "filtered_count": 1}
    out = Path(c.output_dir)
    flat = [t for s in meta["shards"] for q in read_bin(str(out), s["path"], "uint16", 8) for t in q]
    assert flat == ids(TEXT)[: n // 8 * 8]
    assert [s["sequences"] for s in meta["shards"]] == [2] * (n // 16) + [1] * (n // 8 % 2)
    assert (out / "val-00000.bin").read_bytes() == b"" and (out / "tokenizer/tokenizer.json").exists()
    manifest = json.loads((out / "manifest.json").read_text())
    assert manifest["total_tokens"] == meta["total_tokens"] and not list(out.glob("_staging*"))
    assert json.loads(Path(c.report_path).read_text())["actual_tokens"] == meta["total_tokens"]
    assert run_pipeline(spark, c, streams={}) == meta  # completed: nothing is read again
    with pytest.raises(ValueError):
        run_pipeline(spark, replace(c, seed=8), streams={"a": rows})
    assert list((Path(c.work_dir) / "filtered/a").glob("*.json"))


def test_a_cut_row_does_not_suppress_its_copy(spark, tmp_path):
    one, two = TEXT + "# one", TEXT + "# two"
    a = spark.createDataFrame([(1, one), (2, two)], "row_offset bigint, text string")
    b = spark.createDataFrame([(1, two), (2, one), (3, two)], "row_offset bigint, text string")
    meta = run_pipeline(spark, config(tmp_path, [source("a", limit=10), source("b", limit=10_000)], target_tokens=10_000), streams={"a": a, "b": b})
    assert [s["accepted_tokens"] for s in meta["sources"]] == [len(one) + 1, len(two) + 1]
    assert json.loads((tmp_path / "report.json").read_text())["deduplicated_count"] == 2


def test_a_build_that_broke_off_goes_on(spark, tmp_path, monkeypatch):
    from loomspark.plans import pipeline as P

    rows = {n: spark.createDataFrame([(i + 1, TEXT + f"# {n} {i % 3}", "a.py") for i in range(5)], "row_offset bigint, content string, path string") for n in "ab"}
    big = dict(target_tokens=10**6, write_intermediate_jsonl=False)
    whole = run_pipeline(spark, w := config(tmp_path / "whole", [source("a", limit=10**6), source("b", limit=10**6)], **big), streams=rows)
    c = config(tmp_path / "broken", [source("a", limit=10**6), source("b", limit=10**6)], **big)
    built, really = [], P.build_source

    def counted(spark_, config_, source_, *rest):
        built.append(source_.name)
        if built == ["a", "b"]:
            raise RuntimeError("lost")
        return really(spark_, config_, source_, *rest)

    monkeypatch.setattr(P, "build_source", counted)
    with pytest.raises(RuntimeError):
        run_pipeline(spark, c, streams=rows)
    assert list(json.loads(Path(c.progress_path).read_text())["sources_done"]) == ["a"]
    assert run_pipeline(spark, c, streams=rows) == whole
    assert built == ["a", "b", "b"]
    for s in whole["shards"]:
        assert (Path(c.output_dir) / s["path"]).read_bytes() == (Path(w.output_dir) / s["path"]).read_bytes()
    progress = json.loads(Path(c.progress_path).read_text())
    assert progress["completed"] is False and progress["train_bytes"] == 2 * whole["train_tokens"]  # short of its target
    run_pipeline(spark, c, streams=rows)  # so it is built anew
    assert built[3:] == ["a", "b"]


def test_samples_without_tokens(spark, tmp_path):
    class Nothing(CharTokenizer):
        def count(self, text):
            return F.lit(0).cast("bigint")

    turns = [("user", TEXT), ("assistant", TEXT)]
    rows = spark.createDataFrame([(1, turns)], "row_offset bigint, messages array<struct<role:string,content:string>>")
    c = config(tmp_path, [source("a", "instruct")], output_mode=SFT)
    run_pipeline(spark, c, streams={"a": rows}, tokenizer=Nothing())
    assert json.loads(Path(c.progress_path).read_text())["rejected_counts"] == {"empty_tokens": 1}


def test_incremental_budget_inside_a_batch(spark, tmp_path):
    c = config(tmp_path, [source(limit=200)], target_tokens=10**9, write_intermediate_jsonl=False)
    build = IncrementalBuild(spark, c, c.sources[0], CharTokenizer())
    build.batch(spark.createDataFrame([(i + 1, TEXT + f"# {i}") for i in range(20)], "row_offset bigint, text string"), 0)
    build.batch(spark.createDataFrame([(1, TEXT + "# more")], "row_offset bigint, text string"), 1)
    first, second = build.ledger.entries()
    assert 200 <= first["tokens"] < 200 + len(TEXT) + 8 and second["tokens"] == 0


def test_stores_by_their_scheme(tmp_path):
    from loomspark.sinks import shards as S

    assert S.arrow_uri("s3a://bucket/a/b") == "s3://bucket/a/b" and S._open(f"file://{tmp_path}/x")[1] == f"{tmp_path}/x"


def test_sft_build(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"Write function number {i} that adds two values", f"def f{i}(a, b):\n    return a + b + {i}\n") for i in range(1, 9)], "row_offset bigint, instruction string, response string")
    c = config(tmp_path, [source(kind="instruct", limit=10_000), source("base")], output_mode="sft_jsonl", target_tokens=400, sft_samples_per_shard=2, val_ratio=0.5)
    meta = run_pipeline(spark, c, streams={"a": rows})
    assert meta["total_samples"] == sum(s["samples"] for s in meta["shards"]) and meta["actual_tokens"] >= 400
    written = [json.loads(x) for s in meta["shards"] for x in (tmp_path / "out" / s["path"]).read_text().splitlines()]
    assert len(written) == meta["total_samples"] and list(written[0]) == ["messages", "source"]
    assert [m["role"] for m in written[0]["messages"]] == ["system", "user", "assistant"]
    assert meta["sources"][1]["processed_samples"] == 0 and not list((tmp_path / "out").glob("*.bin"))


def serial(rows, source_limit, target, block, before, most):
    n, out = 0, []
    for k, tokens in enumerate(rows):
        if n >= source_limit or (before + n) // block * block >= target or k >= most:
            break
        out.append((k, tokens > 0))
        n += tokens
    return out


@pytest.mark.parametrize("seed", range(6))
def test_budgets_like_a_serial_run(spark, seed):
    r = random.Random(seed)
    rows = [r.choice([0, 0, r.randrange(1, 30)]) for _ in range(r.randrange(0, 60))]
    limits = (r.randrange(200), r.randrange(1, 300), r.choice([1, 8]), r.randrange(40), r.randrange(1, 70))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, n_tokens int").repartition(3)
    got = apply_budgets(df, ["i"], source_limit=limits[0], target=limits[1], block=limits[2], before=limits[3], max_rows=limits[4]).where("processed").orderBy("i").collect()
    assert [(x.i, x.accepted) for x in got] == serial(rows, *limits)


def test_prefix_sums_over_files(spark):
    r = random.Random(1)
    rows = sorted((0, f, k, r.randrange(9)) for f in range(5) for k in range(r.randrange(1, 40)))
    df = spark.createDataFrame(rows, "s int, f int, k bigint, n int").repartition(5)
    got = with_prefix_sums(df, ["s", "f", "k"], {"pre": "n"}, partitions=7).orderBy("s", "f", "k").collect()
    assert [x.pre for x in got] == [sum(y[3] for y in rows[:i]) for i in range(len(rows))]


@pytest.mark.parametrize("whole", [False, True])
def test_prefix_sums_in_2000_slots(spark, whole):
    df = spark.range(6000).selectExpr("0 as source", "id as k", "id % 7 as n", "if(id % 3 = 0, null, id) as m", "cast(id as string) as text").repartition(5)
    got = with_prefix_sums(df, ["source", "k"], {"pre": "n", "pre_m": "m"}, partitions=2000, whole=whole).orderBy("k").collect()
    at = at_m = 0
    for i, x in enumerate(got):
        assert (x.k, x.pre, x.pre_m, x.text) == (i, at, at_m, str(i))
        at, at_m = at + i % 7, at_m + (i if i % 3 else 0)


def test_ranks_of_one_source_use_many_slots(spark):
    """The slots follow all order columns, also where the first ones are the same in all rows."""
    from loomspark.scratch import Stored

    made = []
    first = Stored.__init__

    def kept(self, df, name):
        first(self, df, name)
        made.append(self)

    Stored.__init__ = kept
    try:
        with_rank(spark.range(4000).selectExpr("0 as s", "0 as f", "id as k"), ["s", "f", "k"]).count()
    finally:
        Stored.__init__ = first
    sizes = [r["count"] for r in made[0].df().groupBy("slot__").count().collect()]
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(sizes) < 3 * 4000 / len(sizes)


def test_prefix_sums_of_groups(spark):
    r = random.Random(2)
    rows = [(r.choice(["a", "a", "b", None]), k, r.randrange(9)) for k in range(90)]
    df = spark.createDataFrame(rows, "g string, k bigint, n int").repartition(5)
    got = with_prefix_sums(df, ["k"], {"pre": "n"}, group="g", partitions=6).orderBy("k").collect()
    assert [x.pre for x in got] == [sum(y[2] for y in rows[:i] if y[0] == rows[i][0]) for i in range(90)]


@pytest.mark.parametrize("length", [1, 4, 7])
def test_packing_like_a_serial_buffer(spark, length):
    r = random.Random(length)
    docs = [(i, [r.randrange(99) for _ in range(r.randrange(0, 25))]) for i in range(40)]
    got = pack_sequences(spark.createDataFrame(docs, "i int, tokens array<int>").repartition(3), ["i"], length).orderBy("seq_index").collect()
    flat = [t for _, d in docs for t in d]
    assert [x.ids for x in got] == [flat[k : k + length] for k in range(0, len(flat) - length + 1, length)]
    assert [x.seq_index for x in got] == list(range(len(flat) // length))


def test_shards_and_split(spark, tmp_path):
    df = spark.createDataFrame([(i, "val" if i % 3 == 0 else "train", [i] * 4) for i in range(9)], "seq_index bigint, split string, ids array<int>")
    sharded = with_shards(df, "seq_index", 2)
    got = {x.seq_index: x.shard for x in sharded.collect()}
    assert got == {1: 0, 2: 0, 4: 1, 5: 1, 7: 2, 8: 2, 0: 0, 3: 0, 6: 1}
    write_bin(sharded, str(tmp_path), "uint32")
    assert validate_bin(str(tmp_path / "train-00001.bin"), "uint32", 4) == (8, True)
    assert validate_bin(str(tmp_path / "train-00009.bin"), "uint32", 4) == (0, False)
    assert read_bin(str(tmp_path), "val-00001.bin", "uint32", 4) == [[6] * 4]
    value = spark.range(1).select(split_value(F.lit(5), 42)).first()[0]
    import hashlib

    assert value == int.from_bytes(hashlib.sha256(b"42:5").digest()[:8], "big") / 2**64


def test_incremental_equals_one_run(spark, tmp_path):
    texts = [TEXT + f"# {i % 7}" for i in range(10)]
    c = config(tmp_path, [source(limit=10**9)], target_tokens=10**9, write_intermediate_jsonl=False)
    inbox = tmp_path / "in"
    build = IncrementalBuild(spark, c, c.sources[0], CharTokenizer())
    df = spark.createDataFrame([(i + 1, t) for i, t in enumerate(texts)], "row_offset bigint, text string")
    df.where("row_offset <= 5").coalesce(1).write.mode("append").parquet(str(inbox))
    build.run(str(inbox), df.schema)
    df.where("row_offset > 5").coalesce(1).write.mode("append").parquet(str(inbox))
    entries = IncrementalBuild(spark, c, c.sources[0], CharTokenizer()).run(str(inbox), df.schema)
    flat = [t for i in range(7) for t in ids(texts[i])]
    assert sum(e["sequences"] for e in entries) == len(flat) // 8 and entries[-1]["tail"] == flat[len(flat) // 8 * 8 :]
    assert sum(e["duplicates"] for e in entries) == 3
    got = [t for e in entries for s in e["shards"] if s["split"] == "train" for q in read_bin(f"{c.output_dir}/batch={e['batch']:08d}", s["path"], "uint16", 8) for t in q]
    assert got == flat[: len(flat) // 8 * 8]
    build.batch(df, entries[0]["batch"])  # a committed batch isn't done again
    assert len(build.ledger.entries()) == len(entries)


def test_checkpoints_in_a_store(spark, tmp_path):
    c = config(tmp_path, [source(limit=10**9)], target_tokens=10**9, write_intermediate_jsonl=False)
    build = IncrementalBuild(spark, c, c.sources[0], CharTokenizer())
    df = spark.createDataFrame([(i + 1, TEXT + f"# {i}") for i in range(6)], "row_offset bigint, text string")
    build.batch(df, 0)
    store = f"file://{tmp_path}/store"
    assert not restore_checkpoint(spark, replace(c, work_dir=str(tmp_path / "w0")), store)
    publish_checkpoint(spark, c, store)
    partial = json.loads((tmp_path / "store/metadata.partial.json").read_text())
    assert partial["total_tokens"] == sum(e["sequences"] for e in build.ledger.entries()) * 8 and partial["completed"] is False
    other = replace(c, work_dir=str(tmp_path / "w2"), output_dir=str(tmp_path / "o2"))
    assert restore_checkpoint(spark, other, store, mark=config_hash(c)) and not restore_checkpoint(spark, other, store)
    assert (tmp_path / "o2/batch=00000000/train-00000.bin").read_bytes() == (tmp_path / "out/batch=00000000/train-00000.bin").read_bytes()
    assert len(list((tmp_path / "w2/ledger").glob("*.json"))) == 1
    (tmp_path / "store/READY.json").unlink()  # without the mark there is nothing to restore
    assert not restore_checkpoint(spark, replace(c, work_dir=str(tmp_path / "w3")), store)


def test_progress_listener(spark, tmp_path):
    lines = []
    listener = ProgressListener("a", 100, lines.append)
    listener.report(50, 5, 2.0)
    assert lines == ["a [############------------]  50.0% 50/100 25 tok/s 2 row/s 2s"]


def test_files(spark, tmp_path):
    assert files.choose_files(["b/x-10.parquet", "b/x-2.parquet", "b/y.txt", "c/z.json"], data_dir="b", config_name="nothing") == ["b/x-10.parquet", "b/x-2.parquet"]
    assert files.choose_files(["a/test-0.parquet", "a/train-0.parquet"], split="train", limit=1) == ["a/train-0.parquet"]
    assert files.detect_reader(["A.JSONL"]) == "json"
    for bad in ([], ["x.csv"]):
        with pytest.raises(ValueError):
            files.detect_reader(bad)
    for i in range(3):
        spark.createDataFrame([(f"{i}-{k}",) for k in range(4)], "text string").coalesce(1).write.parquet(str(tmp_path / f"p{i}.parquet"))
        (tmp_path / f"j{i}.jsonl").write_text("\n\n".join(json.dumps({"text": f"{i}-{k}"}) for k in range(4)) + "\n")
    for ending in ("p{}.parquet", "j{}.jsonl"):
        df = files.load_files(spark, [str(tmp_path / ending.format(i)) for i in range(3)])
        want = [(i, k + 1, f"{i}-{k}") for i in range(3) for k in range(4)]
        assert sorted((r.file_index, r.row_offset, r.text) for r in df.collect()) == want
        assert sorted((r.file_index, r.row_offset, r.text) for r in files.from_cursor(df, 1, 2).collect()) == want[6:]
    s = SourceConfig(name="s", type="base", hf_id=str(tmp_path), target_tokens=1, data_file_limit=2)
    assert [Path(p).name for p in files.resolve_files(spark, s)] == ["j0.jsonl", "j1.jsonl"]
    assert files.resolve_files(spark, replace(s, hf_id=str(tmp_path / "none"))) is None
    assert files.read_jsonl(spark, str(tmp_path / "j0.jsonl")).count() == 4


def test_objects(spark, tmp_path):
    assert objects.parse_uri("s3://b/x/y") == ("b", "x/y/") and objects.parse_uri("s3://b") == ("b", "")
    for bad in ("http://b", "s3://"):
        with pytest.raises(ValueError):
            objects.parse_uri(bad)
    store, local = f"file://{tmp_path}/store", tmp_path / "local"
    (local / "tokenizer").mkdir(parents=True)
    for name in ("train-00000.bin", "metadata.json", "tokenizer/t.json", "other"):
        (local / name).write_text(name)
    include = ["train-00000.bin", "metadata.json", "tokenizer/"]
    assert objects.upload_directory(spark, str(local), store, include) == sorted(include[:2] + ["tokenizer/t.json"])
    (local / "metadata.json").write_text("longer than before")
    assert objects.upload_directory(spark, str(local), store, include) == ["metadata.json"]
    assert objects.upload_files(spark, str(local), ["other", "missing"], store) == ["other"]
    objects.put_json(spark, f"{store}/READY.json", {"a": 1})
    assert objects.get_json(spark, f"{store}/READY.json") == {"a": 1} and objects.get_json(spark, f"{store}/no.json") is None
    assert "other" in objects.download_prefix(spark, store, str(tmp_path / "back"))
    assert objects.download_prefix(spark, f"{store}/none", str(tmp_path / "back")) == []


CONFIG = """
project_name: p
target_tokens: 100
sequence_length: 8
val_ratio: 0.1
seed: 1
tokenizer_path: char
output_dir: {0}/out
work_dir: {0}/work
progress_path: {0}/work/progress.json
report_path: {0}/report.json
sources:
  - {{name: a, type: base, hf_id: "{0}/data", target_tokens: 100}}
"""


def test_config_and_command_line(spark, tmp_path, capsys):
    path = tmp_path / "c.yaml"
    path.write_text(CONFIG.format(tmp_path))
    c = load_config(path)
    assert config_hash(c) == config_hash(replace(c, num_workers=9)) != config_hash(replace(c, seed=2))
    assert c.with_overrides(sequence_length=4, seed=None).sample_length == 4
    assert source_included(source(mix_role="instruct_only", kind="instruct"), "sft_jsonl") and not source_included(source(mix_role="instruct_only"), "pretrain")
    with pytest.raises(ValueError):
        replace(c, output_mode="other")
    path.with_suffix(".bad").write_text("sources: []\nnope: 1")
    with pytest.raises(TypeError):
        load_config(path.with_suffix(".bad"))
    (tmp_path / "data").mkdir()
    (tmp_path / "data/a.jsonl").write_text("".join(json.dumps({"text": TEXT + str(i % 2)}) + "\n" for i in range(4)))
    cli.main(["build", "--config", str(path), "--target-tokens", "150"], spark)
    assert json.loads((tmp_path / "out/metadata.json").read_text())["sources"][0]["accepted_tokens"] == len(TEXT) + 2
    step = [str(tmp_path / f"s{i}") for i in range(6)]
    cli.main(["normalize-base", "--name", "a", "--input", str(tmp_path / "data/a.jsonl"), "--output", step[0]], spark)
    cli.main(["filters", "--input", step[0], "--output", step[1]], spark)
    cli.main(["dedup", "--input", step[1], "--output", step[2]], spark)
    cli.main(["tokenize", "--tokenizer", "char", "--input", step[2], "--output", step[3]], spark)
    cli.main(["pack", "--sequence-length", "8", "--input", step[3], "--output", step[4]], spark)
    flat = ids(TEXT + "0") + ids(TEXT + "1")
    assert [t for q in read_bin(step[4], "train-00000.bin", "uint16", 8) for t in q] == flat[: len(flat) // 8 * 8]
    cli.main(["preview", "--config", str(path), "--source", "a", "--limit", "1"], spark)
    cli.main(["report", "--input", str(tmp_path / "report.json")], spark)
    cli.main(["upload", "--input", step[4], "--output", f"file://{tmp_path}/up"], spark)
    assert "train-00000.bin" in capsys.readouterr().out


def test_forms_of_numbers():
    assert [report.format_count(x) for x in (0, 999, 1500, -2e6, 3.1e9)] == ["0", "999", "1.5k", "-2.0M", "3.1B"]
    assert [report.format_duration(x) for x in (None, -1, 5, 65, 3700)] == ["n/a", "n/a", "5s", "1m05s", "1h01m"]
    assert report.format_rate(10, 0, "row/s") == "0 row/s" and report.format_pct(1, 4) == "25.00%" and report.format_pct(1, 0) == "0.0%"
    assert report.progress_bar(1, 2, 4) == "[##--]  50.0%" and report.progress_bar(1, 0, 4).endswith("0.0%")


def test_load_tokenizer(tmp_path):
    import public_tokenizers

    t = load_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    assert t.vocab_size == 50257 and t.eos_token_id == 50256 and t.model_max_length >= 8192
    assert load_tokenizer(str(tmp_path / "none"), "char").vocab_size == 256
    with pytest.raises(FileNotFoundError):
        load_tokenizer(str(tmp_path / "none"))
