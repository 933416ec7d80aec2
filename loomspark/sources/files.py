"""Scans that carry ordinals: discovery of data files, format by ending, cursors, JSON lines."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.config import SourceConfig
from loomspark.operators.ordinal import with_prefix_sums, with_rank

log = logging.getLogger(__name__)
# Endings of data files and the reader each one means.
READERS = {".parquet": "parquet", ".jsonl": "json", ".json": "json"}


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Paths of all files below folder, relative to it, in any file system that Spark knows."""
    fs, at = _fs(spark, folder)
    if not fs.exists(at):
        raise FileNotFoundError(folder)
    root = fs.getFileStatus(at).getPath().toString().rstrip("/")
    found, each = [], fs.listFiles(at, True)
    while each.hasNext():
        found.append(each.next().getPath().toString()[len(root) + 1 :])
    return found


def natural_file_key(path: str) -> tuple[str, int]:
    """Sorts by the path as text; the number in the name only decides between equal paths."""
    return path, int("".join(re.findall(r"\d", path.rsplit("/", 1)[-1])) or 0)


def choose_files(paths: list[str], *, data_dir: str | None = None, config_name: str | None = None, split: str | None = None, limit: int | None = None) -> list[str]:
    """Data files below data_dir whose path contains config_name and split, each ignored if that leaves none; sorted, at most limit."""
    found = [p for p in paths if p.lower().endswith(tuple(READERS))]
    if data_dir:
        found = [p for p in found if p.startswith(data_dir.strip("/") + "/")]
    for word in (config_name, split):
        if word:
            found = [p for p in found if word.lower() in p.lower()] or found
    return sorted(found, key=natural_file_key)[:limit]


def discover_files(spark: SparkSession, source: SourceConfig) -> list[str]:
    root = source.hf_id.rstrip("/")
    chosen = choose_files(list_files(spark, root), data_dir=source.data_dir, config_name=source.config_name, split=source.split, limit=source.data_file_limit)
    return [f"{root}/{p}" for p in chosen]


def detect_reader(files: list[str]) -> str:
    """The reader for the first file, by its ending."""
    if not files:
        raise ValueError("no data files")
    for ending, reader in READERS.items():
        if files[0].lower().endswith(ending):
            return reader
    raise ValueError(f"no reader for {files[0]}")


def resolve_files(spark: SparkSession, source: SourceConfig) -> list[str] | None:
    """The named files, else what discovery finds; None (with the reason in the log) where that fails."""
    if source.data_files:
        return list(source.data_files)
    try:
        return discover_files(spark, source) or None
    except FileNotFoundError as e:
        log.warning("no files of source %s: %s", source.name, e)
        return None


def leaf_files(spark: SparkSession, files: list[str]) -> list[str]:
    """files, with a folder replaced by the data files in it, in order."""
    out = []
    for f in files:
        fs, at = _fs(spark, f)
        status = fs.getFileStatus(at)
        root = status.getPath().toString().rstrip("/")
        out += [f"{root}/{p}" for p in choose_files(list_files(spark, f))] if status.isDirectory() else [root]
    return out


def load_files(spark: SparkSession, files: list[str]) -> DataFrame:
    """All files as one table with file_index and row_offset."""
    parquet = detect_reader(files) == "parquet"
    # One scan of all files; a join with the list of their names gives file_index.
    plain = F.regexp_replace(F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/").alias("path__")
    leaves = [re.sub("^file:/+", "file:/", f) for f in leaf_files(spark, files)]
    names = spark.createDataFrame(list(enumerate(leaves)), "file_index int, path__ string")
    if parquet:
        raw = spark.read.option("mergeSchema", True).parquet(*files).select("*", plain, (F.col("_metadata.row_index") + 1).alias("row_offset"))
        return raw.join(names, "path__").drop("path__")
    # JSON lines. Text splits of a file are read in order, so a line's place follows from its split and its place there.
    lines = spark.read.text(files).select("value", plain, F.col("_metadata.file_block_start").alias("block__"), F.monotonically_increasing_id().alias("in__"))
    lines = lines.where(F.trim("value") != "").join(names, "path__").drop("path__").withColumn("one__", F.lit(1))
    ranked = with_prefix_sums(lines, ["file_index", "block__", "in__"], {"rank__": "one__"}, group="file_index", whole=True)
    row = F.from_json("value", spark.read.json(files).schema, {"mode": "FAILFAST"})
    return ranked.select(row.alias("row"), (F.col("rank__") + 1).alias("row_offset"), "file_index").select("row.*", "row_offset", "file_index")


def from_cursor(df: DataFrame, file_index: int, row_offset: int) -> DataFrame:
    """Rows after a cursor: the index of a file and the number of its rows that are done."""
    return df.where((F.col("file_index") > file_index) | ((F.col("file_index") == file_index) & (F.col("row_offset") > row_offset)))


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a file of JSON lines; blank lines don't count, damaged ones are an error."""
    return spark.read.option("mode", "FAILFAST").json(path)


def number_stream(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """A given DataFrame as a source: row_offset from its order columns, else from the order in which Spark holds its rows."""
    if "row_offset" in df.columns:
        return df if "file_index" in df.columns else df.withColumn("file_index", F.lit(0))
    if order is None:
        df = df.withColumn("id__", F.monotonically_increasing_id())
        return with_rank(df, ["id__"], "row_offset", whole=True).withColumn("row_offset", F.col("row_offset") + 1).withColumn("file_index", F.lit(0)).drop("id__")
    return with_rank(df, order, "row_offset").withColumn("row_offset", F.col("row_offset") + 1).withColumn("file_index", F.lit(0))


#: A reader of hub datasets by name, (spark, source) -> DataFrame, put here by a plug-in; there is none by default.
hub_reader: Callable[[SparkSession, SourceConfig], DataFrame] | None = None


def resolve_source(spark: SparkSession, source: SourceConfig, streams: dict[str, DataFrame] | None = None, cursor: tuple[int, int] | None = None) -> DataFrame:
    """Raw rows of a source with file_index and row_offset: a given stream, else its files, else a hub reader's rows; after the cursor."""
    if streams and source.name in streams:
        raw = number_stream(streams[source.name])
    else:
        files = resolve_files(spark, source)
        if not files and hub_reader is not None:
            raw = number_stream(hub_reader(spark, source))
            return from_cursor(raw, *cursor) if cursor else raw
        if not files:
            raise FileNotFoundError(f"source {source.name} has no stream and no files")
        raw = load_files(spark, files)
    return from_cursor(raw, *cursor) if cursor else raw

