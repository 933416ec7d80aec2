"""Shard files: raw token ids or JSON lines, one file per shard, moved into place when the job commits."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from loomspark.operators.split import shard_name

ITEM = {"uint16": "<u2", "uint32": "<u4"}
#: Hadoop's schemes by Arrow's.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}


def item_size(dtype: str) -> int:
    if dtype not in ITEM:
        raise ValueError(f"unknown dtype {dtype!r}")
    return np.dtype(ITEM[dtype]).itemsize


def _open(path: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(arrow_uri(path)) if "://" in path else (arrow_fs.LocalFileSystem(), path)


def arrow_uri(path: str) -> str:
    """Arrow's address of what Hadoop names by another scheme."""
    scheme, _, rest = path.partition("://")
    return f"{SCHEMES.get(scheme, scheme)}://{rest}"


def require_shared(spark: SparkSession, path: str) -> None:
    """On a cluster a plain path is each executor's own disk, unless spark.loomspark.sharedPaths says that it is mounted everywhere."""
    master = spark.sparkContext.master
    alone = master.startswith("local") and not master.startswith("local-cluster")
    if not alone and not path.partition("://")[2] and spark.conf.get("spark.loomspark.sharedPaths", "false") != "true":
        raise ValueError(f"{path} must be an address in a store that all executors share")


class Written(WriterCommitMessage):
    def __init__(self, files: list[tuple[str, str]]):
        self.files = files


class TokenShards(DataSource):
    """Options: path, ending (bin or jsonl), dtype. Rows: split, shard, and ids or line, sorted by shard."""

    @classmethod
    def name(cls) -> str:
        return "token_shards"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ShardWriter(self.options)


class ShardWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.ending = options["path"].rstrip("/"), options["ending"]
        self.item = np.dtype(ITEM[options["dtype"]]) if self.ending == "bin" else None
        self.staging = f"_staging-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = _open(self.path)
        mine = f"{self.staging}/{uuid.uuid4().hex}"
        files: list[tuple[str, str]] = []
        out = current = None
        for batch in batches:
            keys = list(zip(batch["split"].to_pylist(), batch["shard"].to_pylist()))
            at = 0
            while at < len(keys):
                end = at + 1
                while end < len(keys) and keys[end] == keys[at]:
                    end += 1
                if keys[at] != current:
                    if out:
                        out.close()
                    current, name = keys[at], shard_name(*keys[at], self.ending)
                    fs.create_dir(f"{folder}/{mine}", recursive=True)
                    out = fs.open_output_stream(f"{folder}/{mine}/{name}", compression=None)
                    files.append((f"{mine}/{name}", name))
                part = batch.slice(at, end - at)
                if self.item is not None:
                    out.write(part["ids"].flatten().to_numpy(zero_copy_only=False).astype(self.item).tobytes())
                else:
                    out.write("".join(f"{line}\n" for line in part["line"].to_pylist()).encode())
                at = end
        if out:
            out.close()
        return Written(files)

    def commit(self, messages: list[Written]) -> None:
        fs, folder = _open(self.path)
        fs.create_dir(folder, recursive=True)
        for m in messages:
            for staged, name in m.files if m else ():
                fs.move(f"{folder}/{staged}", f"{folder}/{name}")
        self._clean(fs, folder)

    def abort(self, messages: list[Written]) -> None:
        self._clean(*_open(self.path))

    def _clean(self, fs: arrow_fs.FileSystem, folder: str) -> None:
        if fs.get_file_info(f"{folder}/{self.staging}").type != arrow_fs.FileType.NotFound:
            fs.delete_dir(f"{folder}/{self.staging}")


def _write(df: DataFrame, path: str, index: str, **options: str) -> None:
    require_shared(df.sparkSession, path)
    df.sparkSession.dataSource.register(TokenShards)
    rows = df.repartition("split", "shard").sortWithinPartitions("split", "shard", index).drop(index)
    rows.write.format("token_shards").mode("append").options(path=path, **options).save()


def write_bin(sequences: DataFrame, path: str, dtype: str) -> None:
    """sequences: seq_index, split, shard, ids. Both splits have a first file, even an empty one."""
    item_size(dtype)
    _write(sequences.select("seq_index", "split", F.col("shard").cast("bigint").alias("shard"), "ids"), path, "seq_index", ending="bin", dtype=dtype)
    first_files(path, "bin")


def json_line(messages: str = "messages", source: str = "source"):
    return F.to_json(F.struct(F.col(messages).alias("messages"), F.col(source).alias("source")), {"ignoreNullFields": "false"})


def write_jsonl(samples: DataFrame, path: str) -> None:
    """samples: sample_index, split, shard, messages, source."""
    _write(samples.select("sample_index", "split", F.col("shard").cast("bigint").alias("shard"), json_line().alias("line")), path, "sample_index", ending="jsonl")
    first_files(path, "jsonl")


def first_files(path: str, ending: str) -> None:
    fs, folder = _open(path)
    fs.create_dir(folder, recursive=True)
    for split in ("train", "val"):
        name = f"{folder}/{shard_name(split, 0, ending)}"
        if fs.get_file_info(name).type == arrow_fs.FileType.NotFound:
            fs.open_output_stream(name, compression=None).close()


def file_size(path: str) -> int:
    """0 for a file that doesn't exist."""
    fs, name = _open(path)
    info = fs.get_file_info(name)
    return info.size if info.type == arrow_fs.FileType.File else 0


def bytes_per_split(folder: str, shards: list[dict]) -> dict[str, int]:
    """How many bytes the files of shards (split, path) hold, by split."""
    out = {"train": 0, "val": 0}
    for shard in shards:
        out[shard["split"]] += file_size(f"{folder}/{shard['path']}")
    return out


def validate_bin(path: str, dtype: str, length: int) -> tuple[int, bool]:
    """Tokens in a file, and whether they are whole sequences; a missing file is (0, False)."""
    fs, name = _open(path)
    if fs.get_file_info(name).type != arrow_fs.FileType.File:
        return 0, False
    tokens = file_size(path) // item_size(dtype)
    return tokens, tokens % length == 0


def validate_shards(folder: str, shards: list[dict], dtype: str, length: int) -> tuple[int, bool]:
    """Do the files of shards (path, tokens) hold what they should?"""
    total, good = 0, True
    for shard in shards:
        if shard["tokens"]:
            tokens, whole = validate_bin(f"{folder}/{shard['path']}", dtype, length)
            total, good = total + tokens, good and whole and tokens == shard["tokens"]
    return total, good and total == sum(s["tokens"] for s in shards)


def remove_outputs(folder: str) -> None:
    """Removes what an earlier run wrote to folder, and only that."""
    fs, name = _open(folder)
    if fs.get_file_info(name).type == arrow_fs.FileType.NotFound:
        return
    for info in fs.get_file_info(arrow_fs.FileSelector(name)):
        base = info.base_name
        if base.startswith("_staging-") or base == "tokenizer":
            fs.delete_dir(info.path)
        elif base in ("manifest.json", "metadata.json", "metadata.partial.json") or (base.split("-")[0] in ("train", "val") and base.endswith((".bin", ".jsonl"))):
            fs.delete_file(info.path)


def read_bin(folder: str, name: str, dtype: str, length: int) -> list[list[int]]:
    """The sequences of one shard (for checks and small readers)."""
    fs, base = _open(folder)
    with fs.open_input_stream(f"{base}/{name}", compression=None) as f:
        return np.frombuffer(f.read(), ITEM[dtype]).reshape(-1, length).tolist()
