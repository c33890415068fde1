"""WARC archives with revisit records, and a two-level capture index.

Writing: each task writes one file of gzip members, a record each. Of records with equal payloads of at
least `min_payload` bytes, that with the largest id is a response and the others are revisits of it;
smaller payloads are responses all. Index: lines are sorted by reversed-host key over all files and cut
into compressed blocks; a sparse directory keeps each block's first key and place. `CaptureIndex.find`
searches the directory by bisection, reads the one or few blocks, and then the records' byte ranges.

A null html is an empty payload; a null url has an empty key and no target in its record. Rows with a
null id revisit the class's largest id, if there is one, else they are responses. Rows that repeat the
largest id are responses too. No rows, no files. Other columns are left out.

A third of all rows may share one payload: such classes, at most HOT_SHARE, are broadcast; others meet
in a shuffled join. A file's name belongs to the attempt of its task, and the index names the files
of attempts that ended well, so a lost executor or a doubled task leaves no wrong offsets.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.llm.common import lookup, map_arrow, open_fs, shared_folder, stored, write_atomically
from quadrille.llm.words import utf8

BLOCK_LINES = 1000
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str | None) -> str:
    """com,example,www)/path?query of a URL, in lower case; empty for null."""
    if not url:
        return ""
    rest = url.partition("://")[2] or url
    host, tail = re.match(r"([^/?#]*)([^#]*)", rest, re.DOTALL).groups()  # type: ignore[union-attr]
    name, _, port = host.rpartition("@")[2].lower().partition(":")
    return ",".join(reversed(name.split("."))) + (f":{port}" if port else "") + ")" + (tail.lower() or "/")


def _safe(text: str) -> str:
    return _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", text)


def record(kind: str, id: str, date: str, url: str | None, payload: bytes, refers_to: str | None = None) -> bytes:
    """One WARC/1.1 record as a gzip member. A revisit has the HTTP header alone, with the payload's length."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{id}>", f"WARC-Date: {date}"]
    head += [f"WARC-Target-URI: {_safe(url)}"] if url is not None else []
    head += [f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + press.flush()


def parse(member: bytes) -> dict:
    """A record's headers by lower-case name, with `payload`; its digest and lengths are checked."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    out: dict = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    size = int(out["content-length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError("the record's length differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    out["payload_bytes"] = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])  # type: ignore[index]
    out["payload_digest"] = out["warc-payload-digest"].removeprefix("sha1:")
    out["payload"] = payload if out["warc-type"] == "response" else None
    if out["payload"] is not None and (len(payload) != out["payload_bytes"] or digest(payload) != out["payload_digest"]):
        raise ValueError("the payload differs from its digest")
    return out


def write_archives(pages: DataFrame, folder: str, min_payload: int = 0, id: str = "page_id", url: str = "url", html: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes *.warc.gz; returns the stored captures (key, url, id, file, offset, length, type)."""
    rows = pages.select(F.col(id).cast("long").alias("id"), F.col(url).alias("url"), F.coalesce(html, F.lit("")).alias("html")).withColumn("sha", F.sha1(F.col("html").cast("binary")))
    large = F.octet_length("html") >= min_payload
    classes = rows.where(large).groupBy("sha").agg(F.count(F.lit(1)).alias("copies"), F.max("id").alias("first_id")).where((F.col("copies") > 1) & F.col("first_id").isNotNull())
    judged = lookup(rows, stored(classes, "warc-classes"), "sha", "copies", rows.count())
    again = large & F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("id"))
    judged = judged.select("id", "url", "html", F.when(again, F.col("first_id")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        name = f"{folder}/{context.partitionId():06d}-{context.attemptNumber()}-{uuid.uuid4().hex[:8]}.warc.gz"
        fs, path = open_fs(name)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        out, at = None, 0
        for b in batches:
            lines: list[tuple] = []
            for key, link, raw, refers in zip(b.column("id").to_pylist(), b.column("url").to_pylist(), utf8(b.column("html")), b.column("refers_to").to_pylist(), strict=True):
                kind = "response" if refers is None else "revisit"
                member = record(kind, "" if key is None else str(key), date, link, raw or b"", None if refers is None else str(refers))
                out = out or fs.open_output_stream(path, compression=None)
                out.write(member)
                lines.append((url_key(link), link, key, name, at, len(member), kind))
                at += len(member)
            if lines:
                kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*lines, strict=True), kinds, strict=True)], names=["key", "url", "id", "file", "offset", "length", "type"])
        if out:
            out.close()

    return stored(map_arrow(judged, write, "key string, url string, id long, file string, offset long, length long, type string"), "warc-captures")


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Sorts the captures into blocks; returns the stored directory (key, id, block, offset, length, lines), a row for each block."""
    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # many captures may share a key: the id goes on dividing them
    lines = captures.repartitionByRange(parts, "key", "id").sortWithinPartitions("key", "id", "file", "offset")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        name = f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:8]}.idx"
        chunks: list[bytes] = []
        rows: list[tuple] = []
        held: list[dict] = []
        at = 0

        def close() -> None:
            nonlocal at
            if held:
                chunks.append(zlib.compress("\n".join(json.dumps(x, ensure_ascii=False) for x in held).encode(), 6))
                rows.append((held[0]["key"], held[0]["id"], name, at, len(chunks[-1]), len(held)))
                at += len(chunks[-1])
                held.clear()

        for b in batches:
            for x in b.to_pylist():
                held.append(x)
                if len(held) >= block_lines:
                    close()
        close()
        if rows:
            write_atomically(name, chunks)
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["key", "id", "block", "offset", "length", "lines"])

    return stored(map_arrow(lines, write, "key string, id long, block string, offset long, length long, lines long"), "warc-directory")


def read_range(uri: str, offset: int, length: int, handles: dict | None = None) -> bytes:
    handles = {} if handles is None else handles
    if uri not in handles:
        if len(handles) > 64:
            handles.clear()
        fs, path = open_fs(uri)
        handles[uri] = fs.open_input_file(path)
    return handles[uri].read_at(length, offset)


def block_lines(uri: str, offset: int, length: int, handles: dict | None = None) -> list[dict]:
    return [json.loads(x) for x in zlib.decompress(read_range(uri, offset, length, handles)).decode().split("\n")]


class CaptureIndex:
    """The directory in memory: one entry for BLOCK_LINES captures."""

    def __init__(self, directory: DataFrame):
        self.entries = sorted(((r["key"], r["block"], r["offset"], r["length"]) for r in directory.toLocalIterator()), key=lambda e: e[0].encode())
        self.keys = [e[0].encode() for e in self.entries]

    def find(self, url: str) -> list[dict]:
        """The captures of a URL."""
        key = url_key(url)
        k = key.encode()
        # a key's captures may begin in the block before the first that starts with it
        found = []
        for _, block, offset, length in self.entries[max(0, bisect.bisect_left(self.keys, k) - 1) : bisect.bisect_right(self.keys, k)]:
            lines = block_lines(block, offset, length)
            names = [x["key"].encode() for x in lines]
            found += lines[bisect.bisect_left(names, k) : bisect.bisect_right(names, k)]
        return found

    def fetch(self, url: str) -> list[dict]:
        return [parse(read_range(x["file"], x["offset"], x["length"])) for x in self.find(url)]


def read_all(directory: DataFrame) -> DataFrame:
    """Every record that the index lists: (page_id, payload_bytes, payload_digest, record_type, refers_to, payload)."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handles: dict = {}
        for b in batches:
            for x in b.to_pylist():
                lines = block_lines(x["block"], x["offset"], x["length"], handles)
                yield pa.RecordBatch.from_arrays([pa.array([y["file"] for y in lines], pa.string()), pa.array([y["offset"] for y in lines], pa.int64()), pa.array([y["length"] for y in lines], pa.int64())], names=["file", "offset", "length"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handles: dict = {}
        number = lambda x: int(x.removeprefix("<urn:page:").rstrip(">")) if x and x != "<urn:page:>" else None
        for b in batches:
            rows = [parse(read_range(f, o, n, handles)) for f, o, n in zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number(r["warc-record-id"]) for r in rows], pa.int64()),
                    pa.array([r["payload_bytes"] for r in rows], pa.int64()),
                    pa.array([r["payload_digest"] for r in rows], pa.string()),
                    pa.array([r["warc-type"] for r in rows], pa.string()),
                    pa.array([number(r.get("warc-refers-to")) for r in rows], pa.int64()),
                    pa.array([r["payload"] for r in rows], pa.binary()),
                ],
                names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"],
            )

    parts = int(directory.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    where = map_arrow(directory.select("block", "offset", "length").repartition(parts), places, "file string, offset long, length long")
    where = where.repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset")
    return map_arrow(where, read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def archive(pages: DataFrame, folder: str | None = None, min_payload: int = 0) -> tuple[DataFrame, DataFrame]:
    """Writes archives and index; returns captures and directory."""
    folder = folder or shared_folder(pages.sparkSession, "warc")
    captures = write_archives(pages, f"{folder}/archive", min_payload)
    return captures, write_index(captures, f"{folder}/index")


def query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return read_all(archive(pages, min_payload=0)[1]).drop("payload")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
c AS (SELECT *, max(page_id) OVER (PARTITION BY h, html) AS top FROM p)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) AS INTEGER), 1)), '') AS payload_digest,
    CASE WHEN top = page_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN top <> page_id THEN top END AS refers_to FROM c
"""
