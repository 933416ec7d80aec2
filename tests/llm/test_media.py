import hashlib
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomspark.llm import media as M

TEXTS = ["", None, "a" * 63, "b" * 64, "c" * 65, "é\x00\x00", "same", "same", "long " * 50_000]


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=300))
def test_image_round_trip(data):
    payload, n = M.from_png(M.to_png(data))
    assert payload == M.padded(data) and n == len(data) and len(payload) % 64 == 0 and payload


def test_damage_is_an_error():
    image = bytearray(M.to_png(b"abc"))
    image[40] ^= 1
    for bad in (bytes(image), b"no image"):
        with pytest.raises(ValueError):
            M.from_png(bad)


def test_query_by_hand(spark, docs_of, folder_of):
    got = {r.doc_id: r for r in M.op2_media(spark, folder_of(documents=docs_of(TEXTS))).collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        data = (t or "").encode()
        payload = data + bytes(-len(data) % 64) if data else bytes(64)
        r, image = got[i], M.to_png(data)
        assert (r.n_bytes, r.payload_bytes, r.media_bytes, r.error) == (len(data), len(payload), len(image), None)
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.media_sha256 == hashlib.sha256(image).hexdigest()
        assert r.tail_crc32 == zlib.crc32(payload[-64:])
    assert got[6].feature == got[7].feature


def test_ranges_and_empty_tables(spark, docs_of, tmp_path):
    df = docs_of([f"text {i} " * (i + 1) for i in range(200)] + [(None, "no id")])
    M.write_media(df.repartition(3), f"file://{tmp_path}/a", archive_bytes=4000)
    small = M.read_media(spark, f"file://{tmp_path}/a", range_bytes=1500, batch_bytes=1000)
    assert small.rdd.getNumPartitions() > 10
    rows = small.collect()
    assert sorted((-1 if r.key is None else r.key) for r in rows) == [-1, *range(200)] and all(r.error is None for r in rows)
    M.write_media(docs_of([]), f"file://{tmp_path}/b")
    assert M.read_media(spark, f"file://{tmp_path}/b").collect() == []


def test_one_bad_member_is_alone(spark, docs_of, tmp_path):
    M.write_media(docs_of([f"text {i} " * 9 for i in range(20)]).coalesce(1), f"file://{tmp_path}/a")
    (archive,) = tmp_path.glob("a/*.zip")
    data = bytearray(archive.read_bytes())
    rows = sorted(M.read_media(spark, f"file://{tmp_path}/a").collect(), key=lambda r: r.offset)
    data[rows[5].offset + 60] ^= 255
    archive.write_bytes(bytes(data))
    again = {r.key: r for r in M.read_media(spark, f"file://{tmp_path}/a", attempts=2).collect()}
    bad = [k for k, r in again.items() if r.error]
    assert bad == [rows[5].key] and again[bad[0]].media is None and len(again) == 20


def test_what_was_not_committed_is_not_read(spark, docs_of, tmp_path):
    M.write_media(docs_of(["a", "b"]), f"file://{tmp_path}/a")
    (tmp_path / "a/left-behind.zip").write_bytes(b"half an archive")
    assert M.read_media(spark, f"file://{tmp_path}/a").select(F.count_if(F.col("error").isNull())).first()[0] == 2
