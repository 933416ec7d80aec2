"""Media columns: payloads in archives, read back by a Spark data source in byte ranges.

Payloads are stored losslessly as 8-bit samples, 64 to a row, in greyscale PNG images, whose text chunk
``n_bytes`` has the length without padding (a text may itself end in NUL characters). The sink
(``media_archives``, write) puts the images into ZIP archives in shared storage; each task writes its
own archives, rolled at ``archive_bytes``, and only the tasks whose work was committed appear in the
manifest, so lost executors and repeated tasks leave nothing behind that is read. The source
(``media_archives``, read) plans byte ranges over the archives of the manifest without opening them. A
range's task reads the directory at its archive's end and streams the members that begin in the range as
Arrow batches. Each member is fetched by its own offset and checked against its CRC; one that fails is
tried again alone, after a fresh open, and its error becomes the row's ``error`` (payload null) if it
keeps failing.

Null texts are empty texts; an empty text is 64 zero bytes. Equal texts give equal values. Repeated
rows and ids stay separate members. An empty table gives an empty archive set and an empty table.
"""

from __future__ import annotations

import binascii
import hashlib
import io
import json
import struct
import time
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from loomspark.llm.common import bounded_batches, scratch_path, table, text_or_empty
from loomspark.sinks.shards import arrow_uri

WIDTH = 64
SIGNATURE = b"\x89PNG\r\n\x1a\n"


def padded(data: bytes) -> bytes:
    """data with zero bytes up to a positive multiple of 64."""
    return data + bytes(-len(data) % WIDTH if data else WIDTH)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", binascii.crc32(kind + data))


def to_png(data: bytes) -> bytes:
    """data, padded, as an 8-bit greyscale image 64 wide."""
    payload = padded(data)
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(rows), WIDTH + 1), np.uint8)  # each line begins with filter 0: samples as they are
    lines[:, 1:] = rows
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"tEXt", b"n_bytes\0%d" % len(data)) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 1)) + _chunk(b"IEND", b"")


def from_png(image: bytes) -> tuple[bytes, int]:
    """The samples of an image that to_png wrote, and how many of them aren't padding."""
    if image[:8] != SIGNATURE:
        raise ValueError("not a PNG image")
    at, packed, width, height, n_bytes = 8, [], 0, 0, None
    while at < len(image):
        (n,) = struct.unpack(">I", image[at : at + 4])
        kind, data = image[at + 4 : at + 8], image[at + 8 : at + 8 + n]
        if struct.pack(">I", binascii.crc32(kind + data)) != image[at + 8 + n : at + 12 + n]:
            raise ValueError("damaged PNG chunk")
        if kind == b"IHDR":
            width, height, *form = struct.unpack(">IIBBBBB", data)
            if form != [8, 0, 0, 0, 0]:
                raise ValueError("not 8-bit greyscale")
        elif kind == b"IDAT":
            packed.append(data)
        elif kind == b"tEXt" and data.startswith(b"n_bytes\0"):
            n_bytes = int(data[8:])
        at += n + 12
    lines = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, width + 1)
    if lines[:, 0].any():
        raise ValueError("filtered lines")
    return lines[:, 1:].tobytes(), width * height if n_bytes is None else n_bytes


def _open(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """Arrow's file system of an address; Hadoop's names of the same stores serve too."""
    return arrow_fs.FileSystem.from_uri(arrow_uri(uri))


class Range(InputPartition):
    def __init__(self, archive: str, start: int, end: int):
        self.archive, self.start, self.end = archive, start, end


class Committed(WriterCommitMessage):
    def __init__(self, archives: list[tuple[str, int]]):
        self.archives = archives


class MediaArchives(DataSource):
    """Options: path (a URI of shared storage), range_bytes, batch_bytes, attempts, archive_bytes."""

    @classmethod
    def name(cls) -> str:
        return "media_archives"

    def schema(self) -> str:
        return "key bigint, archive string, offset bigint, media binary, error string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return ArchiveReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ArchiveWriter(self.options)


class ArchiveWriter(DataSourceArrowWriter):
    """Writes rows of (key bigint, media binary)."""

    def __init__(self, options: dict):
        self.path, self.archive_bytes = options["path"].rstrip("/"), int(options.get("archive_bytes", 64 << 20))

    def write(self, batches: Iterator[pa.RecordBatch]) -> Committed:
        fs, folder = _open(self.path)
        fs.create_dir(folder, recursive=True)
        done: list[tuple[str, int]] = []
        stream = archive = name = None

        def close():
            archive.close()
            done.append((name, stream.tell()))
            stream.close()

        for batch in batches:
            keys, media = batch.column("key"), batch.column("media")
            for i in range(len(batch)):
                if archive is None:
                    name = f"{uuid.uuid4().hex}.zip"
                    stream = fs.open_output_stream(f"{folder}/{name}", compression=None)
                    archive = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED)
                key = keys[i].as_py()
                member = zipfile.ZipInfo(f"{len(archive.filelist)}-{'' if key is None else key}.png")
                archive.writestr(member, media[i].as_py())
                if stream.tell() >= self.archive_bytes:
                    close()
                    archive = None
        if archive is not None:
            close()
        return Committed(done)

    def commit(self, messages: list[Committed]) -> None:
        """The manifest names what committed tasks wrote; it is written last."""
        fs, folder = _open(self.path)
        fs.create_dir(folder, recursive=True)
        listed = sorted(x for m in messages if m for x in m.archives)
        with fs.open_output_stream(f"{folder}/manifest.json", compression=None) as f:
            f.write(json.dumps(listed).encode())

    def abort(self, messages: list[Committed]) -> None:
        fs, folder = _open(self.path)
        for m in messages:
            for name, _ in m.archives if m else ():
                fs.delete_file(f"{folder}/{name}")


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.range_bytes, self.batch_bytes = int(options.get("range_bytes", 8 << 20)), int(options.get("batch_bytes", 4 << 20))
        self.attempts = int(options.get("attempts", 3))

    def partitions(self) -> list[Range]:
        fs, folder = _open(self.path)
        with fs.open_input_stream(f"{folder}/manifest.json", compression=None) as f:
            listed = json.loads(f.read())
        return [Range(name, at, at + self.range_bytes) for name, size in listed for at in range(0, size, self.range_bytes)] or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        names = ["key", "archive", "offset", "media", "error"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string()]
        if not partition.archive:
            return
        fs, folder = _open(self.path)
        where = f"{folder}/{partition.archive}"
        rows, size = [], 0
        with fs.open_input_file(where) as file, zipfile.ZipFile(file) as archive:
            members = [m for m in archive.infolist() if partition.start <= m.header_offset < partition.end]
            for m in members:
                media, error = self._member(fs, where, file, m)
                key = m.filename.split("-", 1)[1].removesuffix(".png")
                rows.append((int(key) if key else None, partition.archive, m.header_offset, media, error))
                size += len(media or b"")
                if size >= self.batch_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def _member(self, fs: arrow_fs.FileSystem, where: str, file: pa.NativeFile, m: zipfile.ZipInfo) -> tuple[bytes | None, str | None]:
        """One member by its offset; after a failure it alone is tried again, through a fresh handle."""
        error = ""
        for attempt in range(self.attempts):
            try:
                if attempt:
                    time.sleep(0.05 * 2**attempt)
                    with fs.open_input_file(where) as again:
                        return self._fetch(again, m), None
                return self._fetch(file, m), None
            except (OSError, ValueError) as e:
                error = f"{type(e).__name__}: {e}"
        return None, error

    @staticmethod
    def _fetch(file: pa.NativeFile, m: zipfile.ZipInfo) -> bytes:
        head = file.read_at(30, m.header_offset)
        if len(head) < 30 or head[:4] != b"PK\x03\x04":
            raise ValueError("no member begins here")
        name, extra = struct.unpack("<HH", head[26:30])
        data = file.read_at(m.file_size, m.header_offset + 30 + name + extra)
        if len(data) != m.file_size or binascii.crc32(data) != m.CRC:
            raise ValueError("the member is damaged")
        return bytes(data)


def _encoded(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        yield pa.array([to_png(x.as_py().encode()) for x in batch], pa.binary())


def write_media(df: DataFrame, path: str, key_col: str = "doc_id", text_col: str = "text", **options: object) -> None:
    """Stores the texts of df as images in archives below path."""
    bounded_batches(df.sparkSession)
    df.sparkSession.dataSource.register(MediaArchives)
    rows = df.select(F.col(key_col).cast("bigint").alias("key"), F.arrow_udf(_encoded, "binary")(text_or_empty(text_col)).alias("media"))
    rows.write.format("media_archives").mode("append").options(path=path, **options).save()


def read_media(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """One row per member: key, archive, offset, media, error."""
    bounded_batches(spark)
    spark.dataSource.register(MediaArchives)
    return spark.read.format("media_archives").options(path=path, **options).load()


FEATURES = "struct<payload_bytes:bigint,payload_sha256:string,tail_crc32:bigint,media_bytes:bigint,media_sha256:string,feature:string,n_bytes:bigint>"
_ARROW = pa.struct([("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("n_bytes", pa.int64())])


def features(media: bytes) -> dict:
    """Digests of the stored form and of the samples read back; feature: mean, spread, entropy of the samples."""
    payload, n_bytes = from_png(media)
    counts = np.bincount(np.frombuffer(payload, np.uint8), minlength=256)
    levels, n = np.arange(256), len(payload)
    mean = float(counts @ levels) / n
    spread = max(0.0, float(counts @ levels**2) / n - mean * mean) ** 0.5
    share = counts[counts > 0] / n
    return {
        "payload_bytes": n,
        "payload_sha256": hashlib.sha256(payload).hexdigest(),
        "tail_crc32": zlib.crc32(payload[-64:]),
        "media_bytes": len(media),
        "media_sha256": hashlib.sha256(media).hexdigest(),
        "feature": f"mean={mean:.4f};std={spread:.4f};entropy={float(-(share * np.log2(share)).sum()) + 0.0:.4f};levels={len(share)}",
        "n_bytes": n_bytes,
    }


def _measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([None if x is None else features(x) for x in (v.as_py() for v in batch)], _ARROW)


def op2_media(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = scratch_path(spark, "media")
    write_media(docs, path)
    return read_media(spark, path).select(F.col("key").alias("doc_id"), F.arrow_udf(_measured, FEATURES)("media").alias("x"), "error").select("doc_id", "x.*", "error")
