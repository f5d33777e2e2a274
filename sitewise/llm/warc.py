"""Web archives with a two-level capture index.

Pages are sorted by reversed-host key and page id over range partitions. Each task writes its own archive files, one
gzip member for each record, and an index file: the captures in key order in compressed blocks, then a sparse
directory with the first key of each block. A manifest row for each task, committed by Spark, names what counts, so that
files of a lost or repeated task are never read.

A lookup finds the part by binary search among the parts' first keys, reads the part's directory, finds the block by binary
search there, reads that range of the index, finds the capture by binary search in the block, and reads that range of the
archive. Queries come sorted, so that a block is unpacked once for all its captures.

Of records with equal payloads of at least MIN_BYTES bytes, the one with the largest page id is the response and the others
revisit it; of repeated rows with that id, each is a response. Only digests are grouped, and only rows whose
digest may be shared, by a bitmap of bounded size, are joined with the groups; payloads go through one shuffle, the sort.

A null html is an empty payload. A null url has the key of an empty url. A null page id sorts first, and is read back as null;
it can be a response but nothing refers to it. Repeated rows are written and read as often as they occur. An empty
table gives an empty archive. Columns other than the three named are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewise.llm.common import clean_columns, key_bitmap, saved, with_maybe
from sitewise.sources.shared import new_dir

MIN_BYTES, BLOCK_LINES, FILE_BYTES = 1000, 128, 1 << 30
#: Fixed values of the archive format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
_NO_ID = -(1 << 63) - 1


def surt(url: Column) -> Column:
    """The key of a url: host labels reversed, then path and query, without scheme, user, port or fragment; white space and controls percent-coded."""
    url = F.coalesce(url, F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    path = F.regexp_extract(url, r"^(?:(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]*)?([^#]*)", 1)
    path = F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit("/"), path))
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), path)
    return F.regexp_replace(key, r"[\x00-\x20\x7F]", "%20")


class Archive(NamedTuple):
    """Where an archive is: its folder and its manifest, a row for each part."""

    path: str
    manifest: DataFrame


def _header(fields: list[tuple[str, object]], body: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _record_id(page_id: int | None) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}').urn}>"


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    """One record; of a revisit the payload is left out and its length and digest are kept."""
    uri = "".join(c if " " < c != "\x7f" else "%{:02X}".format(ord(c)) for c in url) if url else f"urn:page:{page_id}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = refers_to is not None
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(page_id)), ("WARC-Date", DATE), ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()), ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", _record_id(refers_to) if revisit else None), ("WARC-Page-Id", page_id), ("WARC-Page-Refers-To", refers_to),
        ("WARC-Payload-Length", size), ("Content-Type", "application/http; msgtype=response"),
    ]
    return gzip.compress(_header(fields, http if revisit else http + payload), 6, mtime=0)


class Record(NamedTuple):
    page_id: int | None
    url: str | None
    record_type: str
    payload_bytes: int
    payload_digest: str
    refers_to: int | None
    payload: bytes | None


def parse_record(packed: bytes) -> Record:
    """Reads one record; a payload that doesn't have the digest it claims is an error."""
    data = gzip.decompress(packed)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    whole = lambda k: int(fields[k]) if k in fields else None
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    payload, size = None, int(fields["WARC-Payload-Length"])
    if fields["WARC-Type"] == "response":
        payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]
        if hashlib.sha1(payload).hexdigest() != digest or len(payload) != size:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    uri = fields["WARC-Target-URI"]
    return Record(whole("WARC-Page-Id"), None if uri.startswith("urn:page:") else uri, fields["WARC-Type"], size, digest, whole("WARC-Page-Refers-To"), payload)


def _with_refers_to(pages: DataFrame, min_bytes: int) -> DataFrame:
    """Adds refers_to, the id of the response of a revisit, whose html goes."""
    key = F.xxhash64("digest")
    narrow = saved(pages.where(F.col("size") >= min_bytes).select("page_id", "digest"), "warc-digests")
    shared = narrow.groupBy("digest").agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = saved(shared.select("digest", "holder"), "warc-shared")
    marked = with_maybe(pages, key, saved(key_bitmap(shared, key), "warc-bitmap"))
    may = F.col("maybe") & (F.col("size") >= min_bytes)
    alone = marked.where(~may).withColumn("refers_to", F.lit(None).cast("long")).drop("maybe")
    joined = marked.where(may).drop("maybe").join(shared, "digest", "left")
    revisit = F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder"))
    joined = joined.withColumn("refers_to", F.when(revisit, F.col("holder"))).withColumn("html", F.when(~revisit, F.col("html"))).drop("holder")
    return alone.unionByName(joined)


def write_archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", path: str | None = None, min_bytes: int = MIN_BYTES) -> Archive:
    """Writes a record for each row, sorted by key, and the index; path is a folder that all executors share."""
    spark = pages.sparkSession
    path = path or new_dir(spark, "warc")
    body = F.coalesce(F.col("html"), F.lit(""))
    rows = clean_columns(pages, page_id=id_col, url=url_col, html=html_col)
    rows = rows.select(F.col("page_id").cast("long").alias("page_id"), "url", body.alias("html"), F.sha1(body.cast("binary")).alias("digest"), F.octet_length(body).cast("long").alias("size"), surt(F.col("url")).alias("key"))
    rows = _with_refers_to(rows, min_bytes).select("key", "page_id", "url", "html", "digest", "size", "refers_to")
    order = ["key", F.col("page_id").asc_nulls_first()]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = None
        for batch in batches:
            if part is None and batch.num_rows:
                part = _Part(path)
            for row in batch.to_pylist():
                part.add(**row)
        if part is not None:
            yield pa.RecordBatch.from_pylist([part.close()])

    kind = "part string, first_key string, first_id long, last_key string, last_id long, records long, directory_at long, directory_length long"
    return Archive(path, saved(dealt.mapInArrow(write, kind), "warc-manifest"))


def _files(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a local path or of a uri (file, hdfs, s3 and so on); an object store's other names in Spark are those of one client."""
    path = re.sub(r"^s3[an]://", "s3://", path)
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path)


def _order(key: str, page_id: int | None) -> tuple[bytes, int]:
    """The sort order of Spark: bytes of the key, then ids with nulls first."""
    return key.encode(), _NO_ID if page_id is None else page_id


def _pack_lines(lines: list[tuple]) -> bytes:
    return zlib.compress("\n".join("\t".join("" if x is None else str(x) for x in line) for line in lines).encode(), 6)


def _lines(packed: bytes) -> list[list[str]]:
    return [line.split("\t") for line in zlib.decompress(packed).decode().split("\n")]


class _Part:
    """What one task writes: archive files of bounded size and one index file."""

    def __init__(self, path: str):
        self.name = uuid.uuid4().hex
        self.fs, self.path = _files(path)
        self.fs.create_dir(self.path, recursive=True)
        self.index, self.at, self.records = self.fs.open_output_stream(f"{self.path}/{self.name}.cdx", compression=None), 0, 0
        self.file, self.out, self.size = -1, None, 0
        self.block: list[tuple] = []
        self.directory: list[tuple] = []
        self.first = self.last = None

    def add(self, key: str, page_id: int | None, url: str | None, html: str | None, digest: str, size: int, refers_to: int | None) -> None:
        if self.out is None or self.size >= FILE_BYTES:
            self.roll()
        record = make_record(page_id, url, (html or "").encode(), digest, size, refers_to)
        self.out.write(record)
        self.block.append((key, page_id, self.file, self.size, len(record)))
        self.size += len(record)
        self.records += 1
        self.last = (key, page_id)
        self.first = self.first or self.last
        if len(self.block) == BLOCK_LINES:
            self.flush()

    def roll(self) -> None:
        if self.out is not None:
            self.out.close()
        self.file += 1
        self.out, self.size = self.fs.open_output_stream(f"{self.path}/{self.name}-{self.file}.warc.gz", compression=None), 0

    def flush(self) -> None:
        packed = _pack_lines(self.block)
        self.index.write(packed)
        self.directory.append((*self.block[0][:2], self.at, len(packed)))
        self.at += len(packed)
        self.block = []

    def close(self) -> dict:
        if self.block:
            self.flush()
        packed = _pack_lines(self.directory)
        self.index.write(packed)
        self.index.close()
        self.out.close()
        return dict(part=self.name, first_key=self.first[0], first_id=self.first[1], last_key=self.last[0], last_id=self.last[1], records=self.records, directory_at=self.at, directory_length=len(packed))


class _Reader:
    """One part's directory, and the block last used."""

    def __init__(self, path: str, part: dict):
        self.fs, self.path = _files(path)
        self.name, self.open = part["part"], {}
        self.index = self.fs.open_input_file(f"{self.path}/{self.name}.cdx")
        directory = [(k, int(i) if i else None, int(at), int(n)) for k, i, at, n in _lines(self.index.read_at(part["directory_length"], part["directory_at"]))]
        self.keys, self.ranges = [_order(k, i) for k, i, _, _ in directory], [(at, n) for _, _, at, n in directory]
        self.block, self.lines = None, []

    def captures(self, key: tuple[bytes, int]) -> Iterator[tuple[int, int, int]]:
        """(file, offset, length) of each capture with the key: binary search in the directory, one range of the index, binary search in the block."""
        b = max(0, bisect_right(self.keys, key) - 1)
        # captures of one key may have begun in an earlier block
        while b > 0 and self.keys[b] == key:
            b -= 1
        while b < len(self.keys) and self.keys[b] <= key:
            if b != self.block:
                at, n = self.ranges[b]
                rows = _lines(self.index.read_at(n, at))
                self.block, self.lines = b, [(_order(k, int(i) if i else None), int(f), int(o), int(z)) for k, i, f, o, z in rows]
            i = bisect_right(self.lines, (key, -1))
            while i < len(self.lines) and self.lines[i][0] == key:
                yield self.lines[i][1:]
                i += 1
            b += 1

    def read(self, file: int, offset: int, length: int) -> bytes:
        if file not in self.open:
            self.open[file] = self.fs.open_input_file(f"{self.path}/{self.name}-{file}.warc.gz")
        return self.open[file].read_at(length, offset)

    def close(self) -> None:
        for f in (self.index, *self.open.values()):
            f.close()


def lookup(spark: SparkSession, archive: Archive, queries: DataFrame, url_col: str = "url", id_col: str = "page_id", payload: bool = False) -> DataFrame:
    """The records of each distinct (url, page id) of queries; one that isn't in the archive gives no row.

    The parts' bounds, one row for each task that wrote, are held by every task: their number is that of range partitions.
    """
    parts = sorted((r.asDict() for r in archive.manifest.collect()), key=lambda r: _order(r["first_key"], r["first_id"]))
    bounds, path = [_order(p["first_key"], p["first_id"]) for p in parts], archive.path
    keys = clean_columns(queries, url=url_col, page_id=id_col).select(surt(F.col("url")).alias("key"), F.col("page_id").cast("long").alias("page_id")).distinct()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bisect_right(bounds, _order(k, i)) - 1 for k, i in zip(batch.column("key").to_pylist(), batch.column("page_id").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int32())], ["key", "page_id", "at"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, at = None, None
        for batch in batches:
            found, size = [], 0
            for row in batch.to_pylist():
                if row["at"] < 0:
                    continue
                if row["at"] != at:
                    if reader:
                        reader.close()
                    reader, at = _Reader(path, parts[row["at"]]), row["at"]
                for where in reader.captures(_order(row["key"], row["page_id"])):
                    record = parse_record(reader.read(*where))
                    found.append(record if payload else record._replace(payload=None))
                    size += len(found[-1].payload or b"")
                    if size > 1 << 24:
                        yield batch_of(found)
                        found, size = [], 0
            yield batch_of(found)
        if reader:
            reader.close()

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
    batch_of = lambda found: pa.RecordBatch.from_pylist([r._asdict() for r in found], schema=schema)
    placed = keys.mapInArrow(place, "key string, page_id long, at int")
    # a task for each part, however small its keys are: what it reads is payloads
    sorted_ = placed.where("at >= 0").repartitionById(max(1, len(parts)), "at").sortWithinPartitions("at", "key", F.col("page_id").asc_nulls_first())
    return sorted_.mapInArrow(read, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary")
