"""Operator 7: WARC archives with a two-level capture index.

Pages become WARC/1.1 records, each a gzip member of its own, in segments of bounded size
(rows of a table in the shared folder; a row's `data` is a valid .warc.gz file). Of equal
payloads of at least `least` bytes the page of smallest id is a response, the others are
revisits of it.

The index holds a capture (reversed-host key, page, segment, offset, length) per record,
sorted, in compressed blocks of `BLOCK` captures, and apart from them a sparse directory of
each block's first and last key. A look-up deals wanted keys and directory into sections by
bisection of a bounded list of cuts, finds each key's blocks by bisection of its section,
opens only these and there bisects again; records are then read by range. Segments lie in
buckets by their number: the captures wanted go to the segments, the archive is not moved.

Defined results: null payload is empty; null url has the empty key and no target header;
pages with a null id are responses; rows that repeat id and payload give a response, if
theirs is the smallest id, and revisits of it; an empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import binary_rows, parts_for, total_bytes, trim, written, written_in_buckets

BLOCK, SEGMENT_BYTES = 128, 4 << 20
#: Segments a bucket on average, which one task writes and reads; with more segments than `BUCKETS` allow, buckets hold more.
BUCKET_SEGMENTS, BUCKETS = 4, 1 << 15
#: Keys that part the directory into sections, at most; they go with every task of a look-up.
CUTS = 4096
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = "key string, page_id long, segment long, offset long, length long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


class Archive(NamedTuple):
    segments: DataFrame  # segment, data, entries
    directory: DataFrame  # block, first, last
    blocks: DataFrame  # block, captures (compressed)


def surt(url: str | None) -> str:
    """Reversed-host key: com,example,www)/path?query."""
    if not url:
        return ""
    _, mark, rest = url.partition("://")
    rest = (rest if mark else url).partition("#")[0]
    cut = min((i for i in (rest.find("/"), rest.find("?")) if i >= 0), default=len(rest))
    host = rest[:cut].rpartition("@")[2].partition(":")[0].lower()
    return ",".join(reversed(host.split("."))) + ")" + (rest[cut:] or "/")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header_safe(text: str) -> str:
    return "".join(c if c.isprintable() and c not in "\r\n" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in text)


def record_bytes(page: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    digest = digest_of(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if refers_to is not None else http + payload
    name = hashlib.sha1(f"{page} {url} {digest}".encode("utf-8", "surrogatepass")).hexdigest()[:32]
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:uuid:{name[:8]}-{name[8:12]}-{name[12:16]}-{name[16:20]}-{name[20:]}>"), ("WARC-Date", "1970-01-01T00:00:00Z")]
    if url is not None:
        fields.append(("WARC-Target-URI", header_safe(url)))
    if page is not None:
        fields.append(("X-Page-Id", str(page)))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("X-Refers-To-Page-Id", str(refers_to))]
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + body + b"\r\n\r\n"


def member(raw: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def parsed(raw: bytes) -> dict:
    """The columns of RECORD from one record; a response's payload must have its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} does not have its digest")
    number = lambda k: int(fields[k]) if k in fields else None
    return {"page_id": number("X-Page-Id"), "url": fields.get("WARC-Target-URI"), "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": number("X-Refers-To-Page-Id")}


def records_in(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Offset and record of each gzip member of a segment."""
    at = 0
    while at < len(data):
        opener = zlib.decompressobj(31)
        raw = opener.decompress(data[at:]) if at else opener.decompress(data)
        yield at, raw
        at = len(data) - len(opener.unused_data)


def write_archive(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html", least: int = 0) -> Archive:
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"), F.coalesce(F.col(payload_column).cast("binary"), F.lit(b"")).alias("payload"))
    count = parts_for(total_bytes(rows, "payload"), SEGMENT_BYTES)
    buckets = min(parts_for(count, BUCKET_SEGMENTS), BUCKETS)
    dealt = rows.withColumn("segment", F.pmod(F.xxhash64(F.coalesce("page_id", F.xxhash64("url"))), F.lit(count)))
    facts = dealt.where(F.col("page_id").isNotNull() & (F.octet_length("payload") >= least)).select("page_id", "segment", F.sha1("payload").alias("digest"))
    first = facts.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    told = facts.distinct().join(first, "digest").select(F.col("segment").alias("at"), F.col("page_id").alias("page"), "digest", "first")

    def write(pages: pa.Table, told: pa.Table) -> pa.Table:
        if not pages.num_rows:
            return pa.table({"segment": pa.array([], pa.int64()), "data": pa.array([], pa.binary()), "entries": pa.array([], entries)})
        origin = {(p, d): f for p, d, f in zip(*(told.column(c).to_pylist() for c in ("page", "digest", "first")), strict=True)}
        out, found, at, done = [], [], 0, set()
        ids, urls, payloads = pages.column("page_id").to_pylist(), pages.column("url").to_pylist(), binary_rows(pages.column("payload"))
        for i in sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, urls[i] or "", payloads[i])):
            key = (ids[i], hashlib.sha1(payloads[i]).hexdigest())
            source = origin.get(key)
            refers_to = None if source is None or (source == ids[i] and key not in done) else source
            done.add(key)
            packed = member(record_bytes(ids[i], urls[i], payloads[i], refers_to))
            found.append({"key": surt(urls[i]), "page_id": ids[i], "offset": at, "length": len(packed)})
            out.append(packed)
            at += len(packed)
        done_table = pa.table({"segment": pages.column("segment").slice(0, 1), "data": pa.array([b"".join(out)], pa.binary()), "entries": pa.array([found], entries)})
        trim()
        return done_table

    entries = pa.list_(pa.struct([("key", pa.string()), ("page_id", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())]))
    schema = "segment long, data binary, entries array<struct<key: string, page_id: long, offset: long, length: long>>"
    # Both sides dealt as the buckets are: a task then writes one bucket, as one file.
    met = dealt.repartition(buckets, "segment").groupBy("segment").cogroup(told.repartition(buckets, "at").groupBy("at"))
    segments = written_in_buckets(met.applyInArrow(write, schema), "warc", "segment", buckets)
    return Archive(segments, *capture_index(segments))


def capture_index(segments: DataFrame) -> tuple[DataFrame, DataFrame]:
    captures = segments.select("segment", F.explode("entries").alias("e")).select("e.key", "e.page_id", "segment", "e.offset", "e.length")
    order = ["key", "page_id", "segment", "offset"]  # one url in a third of all pages still spreads

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def blocks(last: bool) -> Iterator[pa.RecordBatch]:
            while len(held) >= BLOCK or last and held:
                own = held[:BLOCK]
                del held[:BLOCK]
                text = "\n".join(json.dumps([r["key"], r["page_id"], r["segment"], r["offset"], r["length"]]) for r in own)
                name = hashlib.sha1(text.encode()).hexdigest()
                yield pa.RecordBatch.from_pylist([{"block": name, "first": own[0]["key"], "last": own[-1]["key"], "captures": zlib.compress(text.encode(), 6)}])

        for batch in batches:
            held.extend(batch.to_pylist())
            yield from blocks(False)
        yield from blocks(True)

    ranged = captures.repartitionByRange(*order).sortWithinPartitions(*order)
    both = written(ranged.mapInArrow(pack, "block string, first string, last string, captures binary"), "index")
    return both.select("block", "first", "last"), both.select("block", "captures")


def opened(captures: bytes) -> list[tuple[str, int | None, int, int, int]]:
    return [tuple(json.loads(line)) for line in zlib.decompress(captures).decode().split("\n")]


def sections_of(directory: DataFrame) -> list[str]:
    """Every so many-th first key of the directory, `CUTS` at most: a directory of the directory that every task may hold."""
    entries = directory.count()
    if not entries:
        return []
    ranked = directory.select("first").repartitionByRange(parts_for(entries, CUTS), "first").sortWithinPartitions("first")
    each = parts_for(entries, CUTS // 2)

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            at = [i for i in range(batch.num_rows) if (seen + i) % each == each - 1]
            seen += batch.num_rows
            yield batch.take(pa.array(at, pa.int64()))

    return sorted({r["first"] for r in ranked.mapInArrow(thin, "first string").collect()})


def wanted_blocks(directory: DataFrame, keys: DataFrame) -> DataFrame:
    """(block, key) of the wanted keys: sections by bisection, then in each section blocks by bisection of its part of the directory."""
    cuts = sections_of(directory)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(s, *row) for row in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True) for s in range(bisect_left(cuts, row[1]), bisect_left(cuts, row[2]) + 1)]
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string() if i else pa.int64()) for i, x in enumerate(columns)], ["section", "block", "first", "last"])

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([bisect_left(cuts, k) for k in batch.column(0).to_pylist()], pa.int64()), batch.column(0)], ["section", "key"])

    def meet(blocks: pa.Table, wanted: pa.Table) -> pa.Table:
        entry = sorted(zip(*(blocks.column(c).to_pylist() for c in ("first", "last", "block")), strict=True))
        firsts, lasts = [e[0] for e in entry], [e[1] for e in entry]  # blocks are disjoint but for shared ends, so both are in order
        rows = [(entry[i][2], k) for k in wanted.column("key").to_pylist() for i in range(bisect_left(lasts, k), bisect_right(firsts, k))]
        columns = list(zip(*rows, strict=True)) or [[]] * 2
        return pa.table({"block": pa.array(columns[0], pa.string()), "key": pa.array(columns[1], pa.string())})

    placed = directory.select("block", "first", "last").mapInArrow(entries, "section long, block string, first string, last string")
    sought = keys.select("key").distinct().mapInArrow(asked, "section long, key string")
    return placed.groupBy("section").cogroup(sought.groupBy("section")).applyInArrow(meet, "block string, key string")


def captures_of(blocks: DataFrame) -> DataFrame:
    """Captures of blocks(captures, keys): in each opened block the sorted keys are found by bisection; null keys stand for all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell, keys in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = opened(cell)
                own = [c[0] for c in found]
                found = found if keys is None else [c for k in keys for c in found[bisect_left(own, k) : bisect_right(own, k)]]
                columns = list(zip(*found, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string() if not i else pa.int64()) for i, x in enumerate(columns)], ["key", "page_id", "segment", "offset", "length"])

    return blocks.select("captures", "keys").mapInArrow(run, CAPTURE)


def read_records(archive: Archive, captures: DataFrame) -> DataFrame:
    """The records of captures, each read by its range of a segment, where the segment lies."""

    def read(segments: pa.Table, captures: pa.Table) -> pa.Table:
        rows = []
        if segments.num_rows and captures.num_rows:
            data = segments.column("data")[0].as_buffer()
            for at, size in zip(captures.column("offset").to_pylist(), captures.column("length").to_pylist(), strict=True):
                rows.append(parsed(zlib.decompress(data[at : at + size], 31)))
        kinds = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
        return pa.Table.from_pylist(rows, pa.schema(kinds))

    return archive.segments.select("segment", "data").groupBy("segment").cogroup(captures.groupBy("segment")).applyInArrow(read, RECORD)


def keyed(urls: DataFrame, url_column: str) -> DataFrame:
    """(key) of each url."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([surt(u) for u in batch.column(0).to_pylist()], pa.string())], ["key"])

    return urls.select(url_column).distinct().mapInArrow(run, "key string")


def lookup(archive: Archive, urls: DataFrame | list[str], url_column: str = "url") -> DataFrame:
    """Records of urls, however many: directory first, then the blocks it names, then ranges of segments."""
    if isinstance(urls, list):
        urls = archive.segments.sparkSession.createDataFrame([(u,) for u in urls], f"{url_column} string")
    named = wanted_blocks(archive.directory, keyed(urls, url_column)).groupBy("block").agg(F.array_sort(F.collect_set("key")).alias("keys"))
    return read_records(archive, captures_of(archive.blocks.join(named, "block")))


def read_archive(archive: Archive) -> DataFrame:
    """Every record, through all blocks of the index."""
    return read_records(archive, captures_of(archive.blocks.withColumn("keys", F.lit(None).cast("array<string>"))))


def oracle() -> str:
    """The records in DuckDB SQL; five hexadecimal digits are four of base32."""
    return """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f
"""
