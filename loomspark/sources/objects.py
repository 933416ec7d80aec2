"""Small objects in remote stores through Hadoop's file systems: JSON, prefixes, copies that skip what is unchanged."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from loomspark.sources.files import _fs, list_files


def parse_uri(uri: str, scheme: str = "s3") -> tuple[str, str]:
    """Bucket and prefix of s3://bucket/prefix; a prefix that isn't empty ends in a slash."""
    head = f"{scheme}://"
    bucket, _, prefix = uri.removeprefix(head).partition("/")
    if not uri.startswith(head) or not bucket:
        raise ValueError(f"not a {head} address: {uri}")
    prefix = prefix.strip("/")
    return bucket, f"{prefix}/" if prefix else ""


def hadoop_uri(uri: str) -> str:
    """The address under which Hadoop reads a store."""
    return "s3a://" + uri.removeprefix("s3://") if uri.startswith("s3://") else uri


def get_bytes(spark: SparkSession, uri: str) -> bytes | None:
    fs, at = _fs(spark, hadoop_uri(uri))
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def get_json(spark: SparkSession, uri: str) -> object | None:
    """A JSON object; None where there is none."""
    data = get_bytes(spark, uri)
    return None if data is None else json.loads(data)


def put_bytes(spark: SparkSession, uri: str, data: bytes) -> None:
    """Written beside its place and moved there, so readers never see a part."""
    fs, at = _fs(spark, hadoop_uri(uri))
    _, beside = _fs(spark, hadoop_uri(uri) + ".new")
    fs.setWriteChecksum(False)
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()
        fs.setWriteChecksum(True)
    if fs.exists(at):
        fs.delete(at, False)
    fs.rename(beside, at)


def put_json(spark: SparkSession, uri: str, value: object) -> None:
    put_bytes(spark, uri, json.dumps(value, indent=2, sort_keys=True).encode())


def _checksum(fs, at) -> str | None:
    """A file system's own checksum, or of small files the digest of the bytes."""
    return str(fs.getFileChecksum(at)) if fs.getFileChecksum(at) is not None else None


def copy_file(spark: SparkSession, source: str, target: str, *, skip_unchanged: bool = True) -> bool:
    """Copies one file; False if the target has the same size (and checksum, where both stores tell one)."""
    a_fs, a = _fs(spark, hadoop_uri(source))
    b_fs, b = _fs(spark, hadoop_uri(target))
    if skip_unchanged and b_fs.exists(b) and a_fs.getFileStatus(a).getLen() == b_fs.getFileStatus(b).getLen():
        own, other = _checksum(a_fs, a), _checksum(b_fs, b)
        if own is None or other is None or own == other:
            return False
    jvm = spark.sparkContext._jvm
    return bool(jvm.org.apache.hadoop.fs.FileUtil.copy(a_fs, a, b_fs, b, False, True, spark.sparkContext._jsc.hadoopConfiguration()))


def included(path: str, include: list[str] | None) -> bool:
    """include: exact names, and folders that end in a slash."""
    return include is None or any(path == x or (x.endswith("/") and path.startswith(x)) for x in include)


def upload_directory(spark: SparkSession, folder: str, uri: str, include: list[str] | None = None, *, skip_unchanged: bool = True) -> list[str]:
    """Copies the files below folder to uri; returns what was copied."""
    paths = sorted(p for p in list_files(spark, folder) if included(p, include) and not p.endswith(".crc"))
    return [p for p in paths if copy_file(spark, f"{folder}/{p}", f"{uri.rstrip('/')}/{p}", skip_unchanged=skip_unchanged)]


def upload_files(spark: SparkSession, folder: str, names: list[str], uri: str) -> list[str]:
    """Copies the named files; those that don't exist are skipped."""
    there = set(list_files(spark, folder))
    return [n for n in names if n in there and copy_file(spark, f"{folder}/{n}", f"{uri.rstrip('/')}/{n}", skip_unchanged=False)]


def download_prefix(spark: SparkSession, uri: str, folder: str) -> list[str]:
    """Copies all below uri into folder; nothing if there is nothing."""
    fs, at = _fs(spark, hadoop_uri(uri))
    if not fs.exists(at):
        return []
    return upload_directory(spark, hadoop_uri(uri), folder, skip_unchanged=False)


def download_files(spark: SparkSession, uri: str, names: list[str], folder: str) -> list[str]:
    fs, at = _fs(spark, hadoop_uri(uri))
    return upload_files(spark, hadoop_uri(uri), names, folder) if fs.exists(at) else []
