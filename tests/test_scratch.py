"""Tables in the shared folder: which files are written, what is read back, and that heap is given back."""

import datetime
import os
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from loomspark import scratch
from loomspark.llm import minhash, suffix_dedup
from loomspark.llm.common import release
from loomspark.scratch import Stored, scratch_root


def checked_files(spark):
    """Files that only Hadoop's checked file system writes; it starts a chmod for each of them and for their data."""
    return {f"{d}/{x}" for d, _, names in os.walk(scratch_root(spark).removeprefix("file://")) for x in names if x.endswith(".crc")}


def documents(spark, tmp_path):
    text = " ".join(f"word{i}" for i in range(120))
    spark.createDataFrame([(1, text), (2, text + " more"), (3, "short"), (4, None)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_suffix_tables_need_no_chmod(spark, tmp_path):
    before, folder = checked_files(spark), documents(spark, tmp_path)
    got = suffix_dedup.op4_suffix_dedup(spark, folder)
    assert checked_files(spark) == before
    assert all("/suffix-done-" in f for f in got.inputFiles()) and got.inputFiles()  # the caller only reads
    assert {r.doc_id: r.n_removed > 0 for r in got.collect()} == {1: True, 2: True, 3: False, 4: False}


@pytest.mark.parametrize("group", [1, 8 << 20])
def test_values_come_back(spark, monkeypatch, group):
    monkeypatch.setattr(scratch, "GROUP", group)
    schema = "a bigint, b array<struct<x:bigint,y:array<string>>>, c double, d float, e binary, f boolean, g string, h smallint, `i.j` int, k tinyint"
    rows = [
        (1, [(1, ["a", None, "\U0001f600\0"]), None, (None, None)], 0.1, -0.0, b"\0\xff", True, "", -32768, 1, -128),
        (None, None, None, None, None, None, None, None, None, None),
        (-(2**63), [], float("inf"), float("-inf"), b"", False, "x" * 100_000, 5, None, 127),
    ]
    df = spark.createDataFrame(rows * 50, schema).repartition(7)
    back = Stored(df, "values").df()
    assert back.schema == df.schema
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


def test_other_types_and_empty_tables(spark):
    rows = [(Decimal("1.50"), datetime.date(1500, 1, 1), {"a": 1}), (None, None, None)]
    df = spark.createDataFrame(rows, "a decimal(9,2), b date, c map<string,int>")
    assert sorted(map(repr, Stored(df, "others").df().collect())) == sorted(map(repr, df.collect()))
    empty = spark.createDataFrame([], "a bigint, b array<string>")
    assert Stored(empty, "empty").df().collect() == []


def test_only_files_of_tasks_that_counted_are_read(spark, monkeypatch):
    whole = scratch._to_files

    def twice(*to):
        def write(batches):
            batches = list(batches)
            list(whole(*to)(iter(batches)))  # as a task that was lost after its file
            yield from whole(*to)(iter(batches))

        return write

    monkeypatch.setattr(scratch, "_to_files", twice)
    found = Stored(spark.range(0, 100, 1, 3), "repeated")
    assert found.df().count() == 100 and len(found.df().inputFiles()) == 3


def test_file_is_whole_before_it_is_named(tmp_path):
    batch = pa.RecordBatch.from_pydict({"a": list(range(10))})
    (out,) = scratch._to_files(f"{tmp_path}/x", ["b"])(iter([batch, batch.slice(0, 0), batch]))
    assert pq.read_table(f"{tmp_path}/x/{out['name'][0].as_py()}")["b"].to_pylist() == [*range(10)] * 2
    assert list(scratch._to_files(f"{tmp_path}/y", ["b"])(iter([batch.slice(0, 0)]))) == [] and not (tmp_path / "y").exists()


def test_release_reaches_executors(spark):
    spark.sparkContext.setJobGroup("release", "")
    try:
        release(spark)
        tracker = spark.sparkContext.statusTracker()
        jobs = tracker.getJobIdsForGroup("release")
        tasks = sum(tracker.getStageInfo(s).numTasks for j in jobs for s in tracker.getJobInfo(j).stageIds)
        assert tasks == spark.sparkContext.defaultParallelism
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_near_copies_are_stored_before_the_caller_reads(spark, tmp_path):
    before, folder = checked_files(spark), documents(spark, tmp_path)
    got = minhash.op8_minhash(spark, folder)
    assert checked_files(spark) == before
    assert all("/minhash-done-" in f for f in got.inputFiles()) and got.inputFiles()
    assert {r.doc_id: r.component_id for r in got.collect()} == {1: 1, 2: 1, 3: 3, 4: 4}


@pytest.mark.parametrize("own", [None, "false"])
def test_session_keeps_its_setting(spark, own):
    if own:
        spark.conf.set(scratch._CLEANUP, own)
    before = spark.conf.get(scratch._CLEANUP)
    assert Stored(spark.range(100).repartition(3, "id"), "shuffled").df().count() == 100
    assert spark.conf.get(scratch._CLEANUP) == before
    spark.conf.unset(scratch._CLEANUP)
