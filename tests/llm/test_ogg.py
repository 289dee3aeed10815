import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quern.llm import ogg

from .helpers import EDGE, clashing, docs, empty


def _slow_checksum(data):
    c = 0
    for b in data:
        c ^= b << 24
        for _ in range(8):
            c = (c << 1 ^ 0x04C11DB7 if c & 0x80000000 else c << 1) & 0xFFFFFFFF
    return c


@given(st.binary(max_size=300))
@settings(max_examples=60, deadline=None)
def test_checksum(data):
    assert ogg.checksum(data) == _slow_checksum(data)


@pytest.mark.parametrize("size", [192, 255 * 5, 3072, 3073, 65025, 200_000])
@pytest.mark.parametrize("channels,packet,segments", [(1, 510, 3), (2, 3072, 255), (3, 255, 255), (2, 70_000, 255)])
def test_round_trip(size, channels, packet, segments):
    payload = random.Random(size).randbytes(size)
    media = ogg.encode(payload, channels, 8000, packet, segments)
    d = ogg.decode(media)
    assert d["payload"] == payload and d["damaged"] == d["lost"] == d["torn"] == d["skipped"] == 0
    assert d["streams"] == channels
    assert d["seconds"] == pytest.approx(max(-(-size // packet) // channels * 0, max(sum(min(packet, size - at) for at in range(c * packet, size, channels * packet)) for c in range(channels)) / 8000))


def test_damage_is_found_and_the_rest_is_read():
    payload = bytes(range(256)) * 1500
    media = bytearray(ogg.encode(payload, 1, 8000, 3072, 16))
    pages, _, _ = ogg.read_pages(bytes(media))
    media[len(media) // 2] ^= 1
    d = ogg.decode(bytes(media))
    assert d["damaged"] >= 1 and d["lost"] >= 1 and d["pages"] == len(pages) - 1
    assert ogg.decode(b"junk" + ogg.encode(payload) + b"OggS")["payload"] == payload
    assert ogg.decode(b"")["payload"] == b""


def test_granules_give_times():
    s = ogg.demultiplex(ogg.read_pages(ogg.encode(b"x" * 1000, 1, 100, 300))[0])[1]
    assert ogg.timestamps(s, 100, len) == [(0.0, 3.0), (3.0, 6.0), (6.0, 9.0), (9.0, 10.0)]
    assert s["begun"] and s["ended"]


def test_columns(spark):
    df = clashing(docs(spark), "__text", "__media", "__value", "media", "n_bytes", "feature")
    media = ogg.to_media(df, F.col("text"), [F.col("doc_id"), F.col("text"), F.col("media"), F.col("__value")])
    assert media.columns == ["doc_id", "text", "__value", "n_bytes", "media"]
    assert ogg.from_media(media.withColumn("feature", F.lit("x")), F.col("media"), [F.col("feature"), F.col("doc_id")]).columns[0] == "doc_id"
    rows = ogg.from_media(media, F.col("media"), [F.col("doc_id"), F.col("n_bytes"), F.col("text")]).collect()
    assert len(rows) == len(EDGE)
    for r in rows:
        raw = (r["text"] or "").encode()
        size = max(192, -(-len(raw) // 192) * 192)
        whole = raw.ljust(size, b" ")
        assert (r["n_bytes"], r["payload_bytes"]) == (len(raw), size)
        assert r["payload_sha256"] == hashlib.sha256(whole).hexdigest() and r["tail_crc32"] == zlib.crc32(whole[-16:])
    assert ogg.to_media(empty(spark), F.col("text"), [F.col("doc_id")]).count() == 0
    assert ogg.from_media(spark.createDataFrame([(1, None)], "a int, m binary"), F.col("m"), [F.col("a")]).first()["payload_bytes"] is None
