"""WARC archives with revisit records, and a two-level capture index over them.

Writing: a record per page. Of pages with equal payloads of at least
REVISIT_BYTES the one with the largest id is the response, and the others are
revisit records that refer to it and carry no payload. Every record is a gzip
member of its own, so it can be read alone by its range of bytes.

Index: every record has a line (key, archive, offset, length, ...), sorted by
its reversed-host key ("com,example,www)/path?query"). Runs of BLOCK_LINES
lines are compressed blocks; the sparse directory has, per block, its first
key and the block's range of bytes. A lookup binary-searches the directory, reads the
blocks that may hold the key, binary-searches their lines, and reads the
records' ranges. Ranges are read through Hadoop's file systems, wherever the
archives lie.

Reading back all pages goes the same way, many lookups at once (read_pages): every
distinct key is searched in the directory, which tasks hold (a row per BLOCK_LINES
records; broadcast up to HELD_ROWS of them, beyond that each task of a range of keys
reads the part of the directory that covers its keys); blocks are read by range and
searched for their keys; the lines found name the ranges of records that tasks read
and parse. Ranges are read by open() where the shared folder is one of files. Another
store is only open to Spark's readers, which take whole files: there an archive or
block file, of about ARCHIVE_BYTES at most, is read as a whole and its ranges cut out.

Files are written by Spark's own writer (a gzip member, which ends in a zero
byte as it is smaller than 16 MB or is made to, is a "line" that ends in that
byte), so lost tasks are simply run again, and nothing is left on executors.

Defined results: a null or empty html is an empty payload and a response; equal
rows of the responding id are responses all; rows without an id are responses of their own
and refer to nothing; a null url is an empty target with the key ")/"; an empty
table gives archives without records; other columns are ignored.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import re
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookflow.llm.common import new_dir, staged

REVISIT_BYTES = 1000
#: Compressed bytes of an archive, about, and lines of an index block.
ARCHIVE_BYTES = 16 << 20
#: Compressed bytes of records that are written as one row, at least; an archive has ARCHIVE_BYTES / GROUP_BYTES of them at most.
GROUP_BYTES = 256 << 10
#: Rows of the directory that are broadcast, at most.
HELD_ROWS = 500_000
BLOCK_LINES = 3000
LEVEL = 5
#: All printable ASCII but the blank.
_SAFE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
DATE = "1970-01-01T00:00:00Z"
_FILES = "path string, modificationTime timestamp, length long, content binary"


def url_key(url: str | None) -> str:
    """The host's labels reversed and comma-joined, ")" and the rest, without scheme, user, port and fragment, A-Z lower-cased; other than printable ASCII is percent-encoded."""
    rest = (url or "").split("://", 1)[-1].split("#", 1)[0]
    cut = min((i for i in (rest.find("/"), rest.find("?")) if i >= 0), default=len(rest))
    host = rest[:cut].rsplit("@", 1)[-1]
    host = re.sub(r":\d*$", "", host)
    key = ",".join(reversed(host.split("."))) + ")" + (rest[cut:] if rest[cut : cut + 1] == "/" else "/" + rest[cut:])
    return quote(key.lower(), safe=_SAFE)


def _member(data: bytes) -> bytes:
    """One gzip member of fixed bytes for fixed data; it ends in a zero byte."""
    made = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    out = made.compress(data) + made.flush()
    if len(data) >= 1 << 24:  # its length field may end otherwise: an empty member follows, which readers skip
        none = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        out += none.flush()
    return out


def record(page_id: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None) -> bytes:
    """An uncompressed WARC/1.1 record."""
    digest = hashlib.sha1(payload).hexdigest()
    target = quote(url or "", safe=_SAFE)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http if kind == "revisit" else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}",
    ]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode("ascii") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """A record's headers, payload (None for revisits), and the payload's declared length."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("ascii").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    body = rest[: int(headers["Content-Length"])]
    if rest[len(body) :] != b"\r\n\r\n" or len(body) != int(headers["Content-Length"]):
        raise ValueError("a record has another length than it says")
    http, _, payload = body.partition(b"\r\n\r\n")
    declared = int(re.search(rb"Content-Length: (\d+)", http)[1])
    return {"headers": headers, "payload": None if headers["WARC-Type"] == "revisit" else payload, "payload_bytes": declared}


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def write_archives(pages: DataFrame, out_dir: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", archive_bytes: int = ARCHIVE_BYTES, group_bytes: int = GROUP_BYTES) -> None:
    """Write `out_dir/archives`, each of at most archive_bytes and one record more per group_bytes of them.

    Digests are counted before any payload moves; payloads are shuffled once, by
    digest, to meet the least that a record needs to know: the responding id.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    long_ones = rows.where((F.octet_length("payload") >= REVISIT_BYTES) & F.col("page_id").isNotNull()).select("page_id", "digest")
    first = long_ones.groupBy("digest").agg(F.max("page_id").alias("responds"), F.min("page_id").alias("least")).where("responds <> least").select("digest", "responds")
    decided = rows.join(first.hint("merge"), "digest", "left").select("page_id", "url", "payload", F.when(F.col("page_id") < F.col("responds"), F.col("responds")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for i, u, p, r in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True):
                    held.append(_member(record(i, u, p, "response" if r is None else "revisit", r)))
                    size += len(held[-1])
                    if not held[-1].endswith(b"\0"):
                        raise ValueError("a gzip member doesn't end in a zero byte")
                    if size >= group_bytes:
                        yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], ["records"])
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], ["records"])

    rows = decided.mapInArrow(run, "records binary").select(F.col("records").cast("string").alias("value"))
    rows.write.option("lineSep", "\0").option("maxRecordsPerFile", max(1, archive_bytes // group_bytes)).text(f"{out_dir}/archives")


def _members(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, data) of each record's member; an empty member belongs to the one before."""
    at = 0
    while at < len(content):
        begin, parts = at, []
        while True:
            d = zlib.decompressobj(31)
            data = bytearray()
            while not d.eof:  # fed in steps, else what is behind the member is copied for every member
                step = content[at : at + 65536]
                if not step:
                    raise ValueError("a gzip member is cut off")
                data += d.decompress(step)
                at += len(step) - len(d.unused_data)
            parts.append(bytes(data))
            if len(parts[0]) < 1 << 24 or len(parts) == 2:
                break
        yield begin, at - begin, parts[0]


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").schema(_FILES).load(path).where(F.col("length") > 0)


def write_index(spark: SparkSession, out_dir: str, block_lines: int = BLOCK_LINES) -> None:
    """Write `out_dir/index/blocks` (compressed blocks of sorted lines) and `out_dir/index/directory` (first key, file, offset, length, lines per block) for `out_dir/archives`."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                name, raw, out = path.as_py().rsplit("/", 1)[-1], content.as_py(), []
                for offset, length, data in _members(raw):
                    head = data[: data.index(b"\r\n\r\n")].decode("ascii")
                    target = re.search(r"^WARC-Target-URI: ?(.*)$", head, re.M)[1].rstrip("\r")
                    kind, digest = re.search(r"WARC-Type: (\w+)", head)[1], re.search(r"sha1:(\w+)", head)[1]
                    page = re.search(r"urn:page:(-?\d*)", head)[1]
                    out.append((url_key(target), json.dumps([page, kind, digest, name, offset, length], separators=(",", ":"))))
                    if len(out) == 4096:
                        yield pa.RecordBatch.from_pylist([{"key": k, "line": x} for k, x in out])
                        out = []
                if out:
                    yield pa.RecordBatch.from_pylist([{"key": k, "line": x} for k, x in out])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        for batch in batches:
            for key, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.append(f"{key} {line}\n")
                if len(held) == block_lines:
                    yield pa.RecordBatch.from_arrays([pa.array([_member("".join(held).encode())[:-1]], pa.binary())], ["block"])
                    held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([_member("".join(held).encode())[:-1]], pa.binary())], ["block"])

    def directory(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                rows = []
                for offset, length, data in _members(content.as_py()):
                    rows.append({"first_key": data[: data.index(b" ")].decode(), "last_key": data[data.rindex(b"\n", 0, -1) + 1 if b"\n" in data[:-1] else 0 :].split(b" ", 1)[0].decode(), "file": path.as_py().rsplit("/", 1)[-1], "offset": offset, "length": length, "lines": data.count(b"\n")})
                yield pa.RecordBatch.from_pylist(rows)

    content = _archives(spark, f"{out_dir}/archives").select("path", "content")
    files = content.select("path").count()
    # a key is as hot as its page: the line itself breaks ties, so equal keys may be dealt to several files
    ordered = content.mapInArrow(lines, "key string, line string").repartitionByRange(max(1, -(-files // 8)), "key", "line").sortWithinPartitions("key", "line")
    ordered.mapInArrow(blocks, "block binary").select(F.col("block").cast("string").alias("value")).write.option("lineSep", "\0").text(f"{out_dir}/index/blocks")
    held = _archives(spark, f"{out_dir}/index/blocks").select("path", "content").mapInArrow(directory, "first_key string, last_key string, file string, offset long, length long, lines long")
    held.write.parquet(f"{out_dir}/index/directory")


def _fields(raw: bytes) -> dict:
    """What a record's member says; the payload is held against its digest."""
    found = parse(gzip.decompress(raw))
    h = found["headers"]
    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
    if found["payload"] is not None and hashlib.sha1(found["payload"]).hexdigest() != digest:
        raise ValueError("a payload has another digest than its record says")
    return {"page_id": _page(h["WARC-Record-ID"]), "payload_bytes": found["payload_bytes"], "payload_digest": digest, "record_type": h["WARC-Type"], "refers_to": _page(h.get("WARC-Refers-To")), "url": h["WARC-Target-URI"], "payload": found["payload"]}


def _records(raws: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])
    out = []
    for raw in raws:
        out.append(_fields(raw))
        if len(out) == 256:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _ranges(spark: SparkSession, folder: str, spans: DataFrame, tasks: int, made: Callable[[Iterator[tuple]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """What `made` makes of (bytes, tag) for each of spans (file, offset, length, tag): ranges of the folder's files, those of a file in order."""
    if folder.startswith(("file:", "/")):
        root = "/" + folder.removeprefix("file:").lstrip("/") + "/"

        def by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def raws() -> Iterator[tuple]:
                name, file, last, raw = None, None, None, b""
                try:
                    for batch in batches:
                        for path, offset, length, tag in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                            if path != name:
                                if file:
                                    file.close()
                                name, file = path, open(root + path, "rb")
                            if (path, offset) != last:  # several keys may want one block
                                file.seek(offset)
                                last, raw = (path, offset), file.read(length)
                            yield raw, tag
                finally:
                    if file:
                        file.close()

            yield from made(raws())

        dealt = spans.select("file", "offset", "length", "tag").repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
        return dealt.mapInArrow(by_range, schema)

    def by_file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def raws() -> Iterator[tuple]:
            for batch in batches:
                for content, mine in zip(batch.column(0), batch.column(1), strict=True):
                    raw, last, part = memoryview(content.as_buffer()), None, b""
                    for span in mine.as_py():
                        if span["offset"] != last:
                            last, part = span["offset"], bytes(raw[span["offset"] : span["offset"] + span["length"]])
                        yield part, span["tag"]

        yield from made(raws())

    # at most as many ranges as the file has records
    mine = spans.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("offset", "length", "tag"))).alias("spans"))
    files = _archives(spark, folder).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return files.join(mine, "file").select("content", "spans").mapInArrow(by_file, schema)


_LINE = "key string, file string, offset long, length long"


def _lookups(spark: SparkSession, out_dir: str, keys: DataFrame, held_rows: int) -> DataFrame:
    """(file, offset, length, tag) of the index blocks that may hold each of the distinct keys; tag is the key."""
    directory = spark.read.parquet(f"{out_dir}/index/directory")
    rows = directory.count()
    columns = ["first_key", "last_key", "file", "offset", "length"]

    def searched(batches: Iterator[pa.RecordBatch], blocks: list[tuple]) -> Iterator[pa.RecordBatch]:
        firsts = [b[0] for b in blocks]
        for batch in batches:
            out = []
            for key in batch.column(0).to_pylist():
                at = max(0, bisect.bisect_left(firsts, key) - 1)
                while at < len(blocks) and firsts[at] <= key:
                    if key <= blocks[at][1]:
                        out.append((*blocks[at][2:], key))
                    at += 1
            made = zip(*out, strict=True) if out else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(made, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["file", "offset", "length", "tag"])

    schema = "file string, offset long, length long, tag string"
    if rows <= held_rows:
        shared = spark.sparkContext.broadcast(sorted(tuple(r) for r in directory.select(*columns).collect()))
        return keys.mapInArrow(lambda batches: searched(batches, shared.value), schema)
    # ranges of keys, each with the rows of the directory that reach into it
    parts = -(-rows // held_rows)
    cuts = [r["key"] for r in keys.repartitionByRange(parts, "key").groupBy(F.spark_partition_id()).agg(F.min("key").alias("key")).orderBy("key").collect()]
    at = lambda c: F.greatest(F.lit(0), sum((F.col(c) >= F.lit(k)).cast("int") for k in cuts) - 1)
    spread = directory.select(F.explode(F.sequence(at("first_key"), at("last_key"))).alias("part"), *columns)
    told = keys.select(at("key").alias("part"), "key")

    def meet(theirs: pd.DataFrame, mine: pd.DataFrame) -> pd.DataFrame:
        blocks = sorted(zip(*(mine[c] for c in columns), strict=True))
        found = searched(iter([pa.RecordBatch.from_pandas(theirs[["key"]], preserve_index=False)]), blocks)
        return pa.Table.from_batches(list(found)).to_pandas()

    return told.groupBy("part").cogroup(spread.groupBy("part")).applyInPandas(meet, schema)


def captures_of(spark: SparkSession, out_dir: str, keys: DataFrame, held_rows: int = HELD_ROWS) -> DataFrame:
    """(key, file, offset, length) of all captures of distinct keys (key): directory searched, blocks read by range, their lines searched."""

    def found(raws: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        block, lines = None, []
        for raw, key in raws:
            if raw is not block:
                block, lines = raw, gzip.decompress(raw).decode().splitlines()
            low, out = bisect.bisect_left(lines, key + " "), []
            while low < len(lines) and lines[low].startswith(key + " "):
                _, _, _, name, offset, length = json.loads(lines[low].split(" ", 1)[1])
                out.append({"key": key, "file": name, "offset": offset, "length": length})
                low += 1
            if out:
                yield pa.RecordBatch.from_pylist(out, pa.schema([("key", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]))

    blocks = _archives(spark, f"{out_dir}/index/blocks").select("path").count()
    wanted = staged(_lookups(spark, out_dir, keys, held_rows), "lookups")
    return _ranges(spark, f"{out_dir}/index/blocks", wanted, max(1, blocks), found, _LINE)


def url_keys(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """(key): the distinct keys of the pages' urls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(quote(u or "", safe=_SAFE)) for u in batch.column(0).to_pylist()], pa.string())], ["key"])

    return pages.select(F.col(url_col).alias("url")).mapInArrow(run, "key string").distinct()


def read_pages(spark: SparkSession, out_dir: str, keys: DataFrame, held_rows: int = HELD_ROWS) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload) of all records of distinct keys (key)."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"
    archives = _archives(spark, f"{out_dir}/archives").select("path").count()
    spans = staged(captures_of(spark, out_dir, keys, held_rows).select("file", "offset", "length", F.lit("").alias("tag")), "captures")
    return _ranges(spark, f"{out_dir}/archives", spans, max(1, archives), lambda raws: _records(raw for raw, _ in raws), schema)


class CaptureIndex:
    """Lookups of single urls: the directory is held (one row per BLOCK_LINES records), blocks and records are read by range."""

    def __init__(self, spark: SparkSession, out_dir: str) -> None:
        self.spark, self.out_dir = spark, out_dir
        self.rows = spark.read.parquet(f"{out_dir}/index/directory").orderBy("first_key", "file", "offset").collect()
        self.firsts = [r["first_key"] for r in self.rows]
        self.bytes_read = 0

    def _range(self, path: str, offset: int, length: int) -> bytes:
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        stream = target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).open(target)
        try:
            stream.seek(offset)
            self.bytes_read += length
            return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, length))
        finally:
            stream.close()

    def captures(self, url: str) -> list[dict]:
        """The url's index lines, in order."""
        key = url_key(url)
        found = []
        at = max(0, bisect.bisect_left(self.firsts, key) - 1)
        while at < len(self.rows) and self.firsts[at] <= key:
            row = self.rows[at]
            at += 1
            if row["last_key"] < key:
                continue
            lines = gzip.decompress(self._range(f"{self.out_dir}/index/blocks/{row['file']}", row["offset"], row["length"])).decode().splitlines()
            low = bisect.bisect_left(lines, key + " ")
            while low < len(lines) and lines[low].startswith(key + " "):
                page, kind, digest, name, offset, length = json.loads(lines[low].split(" ", 1)[1])
                found.append({"page_id": int(page) if page else None, "record_type": kind, "payload_digest": digest, "archive": name, "offset": offset, "length": length})
                low += 1
        return found

    def fetch(self, capture: dict) -> dict:
        return parse(gzip.decompress(self._range(f"{self.out_dir}/archives/{capture['archive']}", capture["offset"], capture["length"])))


def warc_round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write archives and index into the shared folder; return what the records say that are found by the pages' keys."""
    out = new_dir(spark, "warc")
    write_archives(pages, out)
    write_index(spark, out)
    return read_pages(spark, out, url_keys(pages)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
