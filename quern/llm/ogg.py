"""Ogg media columns: an encoder, and a reader that trusts nothing it has not checked.

The reader finds pages by their capture pattern, verifies each page's checksum, splits pages into
segments by their lacing values, puts packets together across pages, keeps logical streams apart by
serial number, and derives timestamps from granule positions and the rate in a stream's first packet.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame

from .workspace import fresh, small_batches

# Fixed values of the container format.
CAPTURE = b"OggS"
CONTINUED, FIRST, LAST = 1, 2, 4
HEADER = "<4sBBqIIIB"
NO_GRANULE = -1

#: Bits of each byte reversed: the container's checksum is the usual CRC-32 with bits read the other
#: way round, start 0 and no final inversion.
_REVERSED = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))


def checksum(data: bytes) -> int:
    c = zlib.crc32(data.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(c.to_bytes(4, "little").translate(_REVERSED), "big")


# ---- writing -----------------------------------------------------------------------------------

#: First packet of a stream of raw samples: magic, version, channels, bits, rate, packet size.
HEAD = "<8sBBHII"
MAGIC = b"RawPCM\x00\x01"


def _page(body: bytes, lacing: bytes, flags: int, granule: int, serial: int, number: int) -> bytes:
    head = struct.pack(HEADER, CAPTURE, 0, flags, granule, serial, number, 0, len(lacing)) + lacing
    page = head + body
    return page[:22] + struct.pack("<I", checksum(page)) + page[26:]


def pages_of(packets: list[tuple[bytes, int]], serial: int, segments: int = 255) -> list[bytes]:
    """Pages of one logical stream. packets: (data, granule position at its end). The first packet
    has a page of its own; a packet that does not fit goes on in the next page."""
    pages, lacing, body, flags, granule = [], bytearray(), bytearray(), FIRST, NO_GRANULE

    def flush(last: bool, carried: bool):
        nonlocal flags, granule
        pages.append(_page(bytes(body), bytes(lacing), flags | (LAST if last else 0), granule, serial, len(pages)))
        lacing.clear()
        body.clear()
        flags, granule = CONTINUED if carried else 0, NO_GRANULE

    for i, (data, end) in enumerate(packets):
        full, rest = divmod(len(data), 255)
        values = [255] * full + [rest]
        at = 0
        for j, v in enumerate(values):
            if len(lacing) == segments:
                flush(False, j > 0)
            lacing.append(v)
            body += data[at : at + v]
            at += v
        granule = end
        if i == 0 and len(packets) > 1:
            flush(False, False)
    flush(True, False)
    return pages


def encode(payload: bytes, channels: int = 2, rate: int = 8000, packet: int = 3072, segments: int = 255) -> bytes:
    """A physical stream that holds ``payload`` as 8-bit samples: packets of ``packet`` samples are
    dealt in turn to ``channels`` logical streams, whose pages are interleaved.

    A granule position is the number of the stream's own samples so far.
    """
    streams = []
    for c in range(channels):
        packets, total = [(struct.pack(HEAD, MAGIC, 1, channels, 8, rate, packet), 0)], 0
        for at in range(c * packet, len(payload), channels * packet):
            data = payload[at : at + packet]
            total += len(data)
            packets.append((data, total))
        streams.append(pages_of(packets, c + 1, segments))
    out = [s[0] for s in streams]
    for i in range(1, max(map(len, streams))):
        out += [s[i] for s in streams if i < len(s)]
    return b"".join(out)


# ---- reading -----------------------------------------------------------------------------------


def read_pages(media: bytes):
    """(flags, granule, serial, number, lacing values, body) of each sound page; then the number of
    bytes passed over, of pages with a wrong checksum and of cut ones."""
    pages, skipped, damaged, at = [], 0, 0, 0
    while True:
        found = media.find(CAPTURE, at)
        if found < 0:
            return pages, skipped + len(media) - at, damaged
        skipped += found - at
        at = found
        if at + 27 > len(media):
            return pages, skipped + len(media) - at, damaged + 1
        _, version, flags, granule, serial, number, crc, n = struct.unpack_from(HEADER, media, at)
        lacing = media[at + 27 : at + 27 + n]
        end = at + 27 + n + sum(lacing)
        if version == 0 and len(lacing) == n and end <= len(media) and checksum(media[at : at + 22] + b"\0\0\0\0" + media[at + 26 : end]) == crc:
            pages.append((flags, granule, serial, number, lacing, media[at + 27 + n : end]))
            at = end
        else:  # look for the next capture pattern inside what claimed to be a page
            damaged += 1
            skipped += 1
            at += 1


def demultiplex(pages) -> dict[int, dict]:
    """Per serial number: packets as (data, granule position or None), whether the stream began and
    ended, and the numbers of lost pages and of packets that they tore."""
    streams: dict[int, dict] = {}
    for flags, granule, serial, number, lacing, body in pages:
        s = streams.setdefault(serial, {"packets": [], "begun": False, "ended": False, "lost": 0, "torn": 0, "open": None, "next": 0, "pages": 0})
        s["begun"] |= bool(flags & FIRST)
        s["ended"] |= bool(flags & LAST)
        s["pages"] += 1
        part = s["open"]
        if number != s["next"]:
            s["lost"] += max(0, number - s["next"])
            if part is not None:
                s["torn"] += 1
            part = None
        s["next"] = number + 1
        skip = bool(flags & CONTINUED) and part is None  # its beginning is lost
        if not flags & CONTINUED and part is not None:
            s["torn"] += 1
            part = None
        at, run, last = 0, 0, None
        for v in lacing:
            run += v
            if v == 255:
                continue
            data = body[at : at + run]
            if skip:
                s["torn"] += 1
                skip = False
            else:
                s["packets"].append([data if part is None else part + data, None])
                last = len(s["packets"]) - 1
            part, at, run = None, at + run, 0
        if lacing and lacing[-1] == 255 and not skip:
            part = (part or b"") + body[at:]
        s["open"] = part
        if last is not None and granule != NO_GRANULE:
            s["packets"][last][1] = granule
    for s in streams.values():
        s["torn"] += s.pop("open") is not None
        s.pop("next")
    return streams


def timestamps(stream: dict, rate: int, samples) -> list[tuple[float, float]]:
    """(begin, end) in seconds of each packet after the first. A page gives the position at the end
    of its last whole packet; those before are counted back by ``samples(packet)``."""
    packets = stream["packets"][1:]
    ends: list[int | None] = [g for _, g in packets]
    for i in range(len(packets) - 2, -1, -1):
        if ends[i] is None and ends[i + 1] is not None:
            ends[i] = ends[i + 1] - samples(packets[i + 1][0])
    position, out = 0, []
    for (data, _), end in zip(packets, ends, strict=True):
        end = position + samples(data) if end is None else end
        out.append(((end - samples(data)) / rate, end / rate))
        position = end
    return out


def decode(media: bytes) -> dict:
    """The payload of ``encode``'s streams and what reading showed: payload, streams, pages,
    packets, seconds, damaged, lost, torn, skipped."""
    pages, skipped, damaged = read_pages(media)
    streams = demultiplex(pages)
    turns, seconds = [], 0.0
    for serial in sorted(streams):
        s = streams[serial]
        if not s["packets"] or len(s["packets"][0][0]) != struct.calcsize(HEAD) or not s["packets"][0][0].startswith(MAGIC):
            continue
        rate = struct.unpack(HEAD, s["packets"][0][0])[4]
        times = timestamps(s, rate, len)
        seconds = max([seconds, *(e for _, e in times[-1:])])
        turns.append([p for p, _ in s["packets"][1:]])
    parts = [t[i] for i in range(max(map(len, turns), default=0)) for t in turns if i < len(t)]
    return {"payload": b"".join(parts), "streams": len(streams), "pages": len(pages), "packets": sum(len(s["packets"]) for s in streams.values()), "seconds": seconds, "damaged": damaged, "lost": sum(s["lost"] for s in streams.values()), "torn": sum(s["torn"] for s in streams.values()), "skipped": skipped}


# ---- columns -----------------------------------------------------------------------------------


def padded(text: str | None, unit: int = 192) -> tuple[bytes, int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    size = max(unit, -(-len(raw) // unit) * unit)
    return raw.ljust(size, b" "), len(raw)


def _split(batch, cells: int = 32_000_000):
    """Row ranges of a batch with at most ``cells`` bytes in the last column, one row at least."""
    at, held = 0, 0
    column = batch.column(batch.num_columns - 1)
    for i in range(batch.num_rows):
        v = column[i]
        n = v.as_buffer().size if v.is_valid else 0
        if i > at and held + n > cells:
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += n
    if batch.num_rows > at:
        yield batch.slice(at)


def _encode(batches):
    for whole in batches:
        for batch in _split(whole):
            sizes, media = [], []
            for t in batch.column(batch.num_columns - 1):
                payload, n = padded(t.as_py())
                sizes.append(n)
                media.append(encode(payload))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], names=[*batch.schema.names[:-1], "n_bytes", "media"])


def _chosen(df: DataFrame, value: Column, keep: list[Column], made: list[str]) -> DataFrame:
    """Columns ``keep`` but those called like ``made``, and ``value`` under a name of its own."""
    taken = {m.lower() for m in made}
    kept = df.select(*keep)
    own = [c for c, name in zip(keep, kept.columns, strict=True) if name.lower() not in taken]
    (hidden,) = fresh([*kept.columns, *made], "__value")
    return df.select(*own, value.alias(hidden))


def to_media(df: DataFrame, text: Column, keep: list[Column]) -> DataFrame:
    """Columns ``keep`` with ``n_bytes`` (UTF-8, unpadded) and ``media``: the whole text, spaces
    added up to a positive multiple of 192 bytes, as an Ogg stream. Null counts as empty. Equal
    texts give equal bytes, very long ones are stored whole. Rows are neither merged nor shuffled;
    an empty table gives an empty one. Kept columns called ``n_bytes`` or ``media`` are replaced."""
    small_batches(df.sparkSession)
    chosen = _chosen(df, text, keep, ["n_bytes", "media"])
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(_encode, f"{types}, n_bytes bigint, media binary")


FEATURES = "payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"
_FEATURES = [("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())]


def features_of(media: bytes | None) -> tuple:
    if media is None:
        return (None,) * 6
    d = decode(media)
    p = d["payload"]
    feature = ";".join(f"{k}={d[k]:.6f}" if k == "seconds" else f"{k}={d[k]}" for k in ("streams", "pages", "packets", "seconds", "damaged", "lost", "torn", "skipped"))
    return len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature


def _decode(batches):
    for whole in batches:
        for batch in _split(whole):
            rows = [features_of(m.as_py()) for m in batch.column(batch.num_columns - 1)]
            columns = [pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(_FEATURES)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*batch.schema.names[:-1], *(n for n, _ in _FEATURES)])


def from_media(df: DataFrame, media: Column, keep: list[Column]) -> DataFrame:
    """Columns ``keep`` with what reading the stored bytes gives (``FEATURES``). Null media gives
    nulls; damaged pages are passed over and counted in ``feature``. Kept columns with the names of
    the results are replaced; repeated rows stay, an empty table gives an empty one."""
    small_batches(df.sparkSession)
    chosen = _chosen(df, media, keep, [n for n, _ in _FEATURES])
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(_decode, f"{types}, {FEATURES}")
