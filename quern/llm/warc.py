"""WARC archives: writing captures, reading records, and assembling transactions.

Archives are written by Spark's text writer (one record per row, the record separator as the line
separator, a whole file as one gzip member) and read by its binary reader, so any store that Spark
reaches will do.  Pages are written by classes of size, so that a file's bytes are bounded as its
records are.  Files are inflated piece by piece and records framed by Content-Length, never by
searching payloads.

Assembly joins request, response (or revisit) and metadata records through their concurrent-to
identifiers, whichever side carries them, and gives one nested row per capture.
"""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .workspace import new_path, release, stage

SEPARATOR = "\r\n\r\n"
#: Payloads of fewer bytes are always stored.
LEAST_SHARED = 1000
#: Classes of pages: payloads of up to so many bytes, and pages of one archive, which is one row when
#: it is read. Each class's archives hold 64 MB of payloads at most, but for single larger pages.
CLASSES = ((16_000, 4_000), (1_000_000, 64), (None, 1))


def _uid(kind: str, row: Column) -> Column:
    """A record's identifier, from what tells its row apart."""
    d = F.md5(F.concat(F.lit(kind + ":"), row).cast("binary"))
    part = lambda a, n: F.substring(d, a, n)
    return F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-"), part(13, 4), F.lit("-"), part(17, 4), F.lit("-"), part(21, 12), F.lit(">"))


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """Text of a record without its separator; headers whose value is null are left out."""
    lines = [F.concat(F.lit(f"{k}: "), v) for k, v in headers] + [F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws("\r\n", F.lit("WARC/1.1"), *lines), F.lit(SEPARATOR), block)


def leaders(rows: DataFrame, salts: int) -> DataFrame:
    """(digest, salt, leader, repeats) of payloads with anything to know, for each salt.

    rows: (key, url_hash, digest, size).  ``leader``: (key, url_hash) of the largest key among rows of a
    payload of LEAST_SHARED bytes or more that occurs more than once, else null; a null key is less
    than any other.  ``repeats``: whether equal rows occur.
    """
    alike = rows.groupBy("digest", "key", "url_hash").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
    by = alike.groupBy("digest").agg(F.max(F.struct("key", "url_hash")).alias("leader"), F.sum("n").alias("n"), F.max("size").alias("size"), (F.max("n") > 1).alias("repeats"))
    by = by.withColumn("leader", F.when((F.col("n") > 1) & (F.col("size") >= LEAST_SHARED), F.col("leader"))).where("leader is not null or repeats")
    return by.select("digest", "leader", "repeats", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", date: str = "2024-01-01T00:00:00Z", salts: int = 32) -> None:
    """Write a request, a response or revisit, and a metadata record for each row of ``pages``.

    Of rows with equal payloads of at least LEAST_SHARED bytes those with the largest key (one row, if
    keys are unique) hold the payload, the others refer to one of them.  Null payloads are empty, null
    URLs the empty string.  Null keys are written as ``-`` and are less than others; rows with equal
    keys, repeated rows too, are captures of their own.  Very large payloads are written whole, in an
    archive of their own.  An empty table gives an empty archive.  Other columns are ignored.
    """
    body = F.coalesce(F.col(html).cast("string"), F.lit(""))
    address = F.regexp_replace(F.coalesce(F.col(url).cast("string"), F.lit("")), "[\\r\\n]", " ")
    p = pages.select(F.col(key).cast("bigint").alias("key"), address.alias("url"), body.alias("body"))
    p = p.withColumn("digest", F.sha1(F.col("body").cast("binary"))).withColumn("size", F.octet_length("body")).withColumn("url_hash", F.xxhash64("url"))
    p = p.withColumn("salt", F.pmod(F.xxhash64("key", "url_hash"), F.lit(salts)).cast("int"))
    known = stage(leaders(p.select("key", "url_hash", "digest", "size"), salts), "warc-leaders")
    j = p.join(known, ["digest", "salt"], "left").withColumn("copy", F.lit(1))
    low = 0
    for n, (high, most) in enumerate(CLASSES):
        mine = (F.col("size") >= low) & (F.col("size") < high if high else F.lit(True))
        if n == 0 or not p.where(mine).select("key").isEmpty():
            _write_records(j.where(mine & ~F.coalesce("repeats", F.lit(False))), path, date, 3 * most)
            again = j.where(mine & F.col("repeats"))
            if not known.where("repeats").isEmpty():
                # equal rows are counted and dealt out again, a thousand at a time
                again = again.groupBy("key", "url_hash", "digest").agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("url", "body", "size", "leader")])
                again = again.withColumn("some", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / 1000)))).repartition("key", "url_hash", "digest", "some")
                again = again.withColumn("copy", F.explode(F.sequence(F.col("some") * 1000 + 1, F.least(F.col("some") * 1000 + 1000, "n"))))
                _write_records(again, path, date, 3 * most)
        low = high
    release(known)


def _write_records(j: DataFrame, path: str, date: str, most: int) -> None:
    """Write the records of pages (key, url, url_hash, body, digest, size, leader, copy) to archives of
    at most ``most`` records."""
    body, size = F.col("body"), F.col("size").cast("string")
    name = lambda key, url_hash, copy: F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("-")), url_hash.cast("string"), "digest", copy.cast("string"))
    own, first = name(F.col("key"), F.col("url_hash"), F.col("copy")), name(F.col("leader.key"), F.col("leader.url_hash"), F.lit(1))
    revisit = F.col("leader").isNotNull() & ~F.col("leader.key").eqNullSafe(F.col("key"))
    common = [("WARC-Target-URI", F.col("url")), ("WARC-Date", F.lit(date))]
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit(SEPARATOR))
    main = _record(
        [
            ("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
            ("WARC-Record-ID", _uid("response", own)),
            *common,
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            ("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
            ("WARC-Refers-To", F.when(revisit, _uid("response", first))),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.when(revisit, http).otherwise(F.concat(http, body)),
    )
    request = _record([("WARC-Type", F.lit("request")), ("WARC-Record-ID", _uid("request", own)), *common, ("WARC-Concurrent-To", _uid("response", own)), ("Content-Type", F.lit("application/http; msgtype=request"))], F.concat(F.lit("GET "), F.col("url"), F.lit(" HTTP/1.1\r\nAccept: text/html\r\n\r\n")))
    page = F.concat(F.lit("pageId: "), F.coalesce(F.col("key").cast("string"), F.lit("-")), F.lit("\r\n"))
    metadata = _record([("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _uid("metadata", own)), *common, ("WARC-Concurrent-To", _uid("response", own)), ("Content-Type", F.lit("application/warc-fields"))], page)
    rows = j.select(F.explode(F.array(request, main, metadata)).alias("value"))
    rows.write.mode("append").option("lineSep", SEPARATOR).option("compression", "gzip").option("maxRecordsPerFile", most).text(path)


# ---- reading -----------------------------------------------------------------------------------


def inflated(data: bytes, piece: int = 1 << 20):
    """The bytes of an archive, gzip members or plain, in pieces; a broken member ends it."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    rest = data
    while rest[:2] == b"\x1f\x8b":
        z = zlib.decompressobj(31)
        try:
            while not z.eof:
                out = z.decompress(rest, piece)
                rest = z.unconsumed_tail
                if out:
                    yield out
                if not out and not rest:
                    break
        except zlib.error:
            return
        rest = z.unused_data


def parse_archive(data: bytes):
    """(headers, block) of each record of one archive. Header names are lower-cased; a repeated
    header's values are listed. A cut last record is left out; what follows broken compression, a
    record without its mark or a length that is no number is not read."""
    pieces, held, at = inflated(data), bytearray(), 0

    def more() -> bool:
        nonlocal held, at
        piece = next(pieces, None)
        if piece is None:
            return False
        held = held[at:] + piece
        at = 0
        return True

    while True:
        while True:
            while held[at : at + 2] == b"\r\n":
                at += 2
            if len(held) - at >= 5 or not more():
                break
        if not held.startswith(b"WARC/", at):
            return
        while (stop := held.find(b"\r\n\r\n", at)) < 0:
            if not more():
                return
        headers: dict[str, list[str]] = {}
        for line in bytes(held[at:stop]).split(b"\r\n")[1:]:
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers.setdefault(name.strip().lower(), []).append(value.strip())
        length = headers.get("content-length", ["0"])[0]
        if not (length.isascii() and length.isdigit()):
            return
        begin, size = stop + 4 - at, int(length)
        while len(held) - at < begin + size:
            if not more():
                return
        yield headers, bytes(held[at + begin : at + begin + size])
        at += begin + size


def _record_row(headers, block):
    first = lambda name: headers.get(name, [None])[0]
    kind, payload, http = first("warc-type"), block, None
    if (first("content-type") or "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        http = head.decode("utf-8", "replace")
    declared = None
    for line in (http or "").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        if name.strip().lower() == "content-length" and value.strip().isdigit():
            declared = int(value)
    return {
        "record_id": first("warc-record-id"),
        "kind": kind,
        "uri": first("warc-target-uri"),
        "date": first("warc-date"),
        "concurrent_to": headers.get("warc-concurrent-to", []),
        "refers_to": first("warc-refers-to"),
        "payload_digest": first("warc-payload-digest"),
        "http": http,
        "declared_bytes": declared,
        "payload": payload,
        "payload_bytes": len(payload),
        "payload_sha1": hashlib.sha1(payload).hexdigest(),
    }


RECORD = "record_id string, kind string, uri string, date string, concurrent_to array<string>, refers_to string, payload_digest string, http string, declared_bytes bigint, payload binary, payload_bytes bigint, payload_sha1 string"
_RECORD = pa.schema([("record_id", pa.string()), ("kind", pa.string()), ("uri", pa.string()), ("date", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()), ("payload_digest", pa.string()), ("http", pa.string()), ("declared_bytes", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_sha1", pa.string())])
PRIMARY = ("response", "revisit", "resource", "conversion")


def _read(payloads: bool):
    def run(batches, most: int = 16_000_000):
        for batch in batches:
            for data in batch.column(0):
                rows, held = [], 0
                for headers, block in parse_archive(data.as_py()):
                    row = _record_row(headers, block)
                    if row["kind"] in PRIMARY and not payloads:
                        row["payload"] = None
                    rows.append(row)
                    held += len(row["payload"] or b"") + 500
                    if held > most:
                        yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)

    return run


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records of the archives below ``path``; without ``payloads`` those of response, revisit,
    resource and conversion records are null (their sizes and digests stay)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInArrow(_read(payloads), RECORD)


def assemble(spark: SparkSession, path: str, primary_columns: list[str] | None = None) -> DataFrame:
    """One nested row per capture: the primary record's columns, ``request`` (a struct, null if
    there is none; of several the one with the smallest identifier), and ``metadata`` (an array of
    structs by identifier).

    A record belongs to the primary that it names as concurrent, or that names it, or to the one
    that a record it names belongs to.  Records with equal identifiers count once; a primary without
    an identifier is a capture of its own, other records without one are left out.  Primaries
    without other records stay; other records whose primary is not in the archives are left out.
    Archives are inflated once, and payloads are written to the shared folder only where
    ``primary_columns`` (all, if null) has them.
    """
    records = stage(read_records(spark, path, primary_columns is None or "payload" in primary_columns), "warc-records")
    is_primary = F.col("kind").isin(*PRIMARY)
    first = records.where(is_primary)
    if primary_columns is not None:
        first = first.select("record_id", *[c for c in primary_columns if c != "record_id"])
    # identifiers that are missing must not meet in one task or be taken for each other
    lone = first.where("record_id is null")
    first = first.where("record_id is not null").dropDuplicates(["record_id"])
    others = records
    named = others.where(is_primary & F.col("record_id").isNotNull()).select(F.explode("concurrent_to").alias("id"), F.col("record_id").alias("capture"))
    second = others.where(~F.coalesce(is_primary, F.lit(False)) & F.col("record_id").isNotNull()).dropDuplicates(["record_id"])
    # own: what a record names; back: the primary that names it; over: through another record
    own = second.select("record_id", F.explode("concurrent_to").alias("target"))
    direct = own.select(F.col("record_id").alias("id"), F.col("target").alias("capture"))
    links = direct.unionByName(named)
    over = direct.alias("a").join(links.alias("b"), F.col("a.capture") == F.col("b.id")).select(F.col("a.id").alias("id"), F.col("b.capture").alias("capture"))
    back = named.alias("a").join(direct.alias("b"), F.col("a.id") == F.col("b.capture")).select(F.col("b.id").alias("id"), F.col("a.capture").alias("capture"))
    all_links = links.unionByName(over).unionByName(back).dropDuplicates()
    attached = second.join(all_links.withColumnRenamed("id", "record_id"), "record_id").select("capture", "kind", F.struct("record_id", "uri", "date", "http", F.col("payload").cast("string").alias("fields")).alias("record"))
    grouped = attached.groupBy("capture").agg(F.min(F.when(F.col("kind") == "request", F.col("record"))).alias("request"), F.sort_array(F.collect_list(F.when(F.col("kind") == "metadata", F.col("record")))).alias("metadata"))
    out = first.join(grouped, first["record_id"] == grouped["capture"], "left").drop("capture")
    out = out.unionByName(lone, allowMissingColumns=True)
    return out.withColumn("metadata", F.coalesce("metadata", F.array().cast(grouped.schema["metadata"].dataType)))


def round_trip(pages: DataFrame, **columns) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and assemble what is read back."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_archives(pages, path, **columns)
    return assemble(spark, path, ["kind", "uri", "refers_to", "payload_digest", "declared_bytes", "payload_bytes", "payload_sha1"])
