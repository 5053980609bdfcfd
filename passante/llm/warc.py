"""WARC archives with a two-level capture index.

Captures are range-partitioned and sorted by their reversed-host URL key, and
every task writes one shard of three files: the archive (one gzip member per
record), the index lines in compressed blocks of ``BLOCK`` captures, and a
sparse directory with the first key, place and length of each block.  The table
of shards, with their first keys, is the top level; it has a row per shard and
is written only for tasks that succeeded, so a lost or repeated task leaves
files that nothing refers to, and never a record twice.

A lookup finds the shard by binary search in the first keys, the block by binary
search in the shard's directory, reads the block's byte range, and then the byte
range of the record.

Of records with equal payloads of at least ``REVISIT_BYTES`` bytes, the one with
the largest id is the response and the others are revisits that refer to it.

Defined cases: a null html is an empty payload, a null url has an empty key and
no target in its record; control characters and spaces of a url are
percent-encoded in the record, the key keeps them.  Rows with a null id have
records of their own, refer to a response like any other, and are a response
for others only if no row of the payload has an id.  Repeated rows have a record each;
equal rows with the largest id are all responses.  An empty table gives an archive
without shards.  Further columns are not read.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passante.llm.common import shared_path, written

BLOCK = 256
REVISIT_BYTES = 1000
#: The date of the records: a fixed value, as pages have none.
DATE = "2024-01-01T00:00:00Z"
_SHARDS = "shard string, first_key string, first_has_id boolean, first_id bigint, captures bigint, blocks int"
_RECORDS = "page_id bigint, url string, payload string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
_RECORD_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.string()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
_RECORD_FIELDS = _RECORD_SCHEMA.names


def url_key(url: str = "url") -> Column:
    """Host labels in reverse order, then the rest: ``com,example,www)/path?query``."""
    rest = F.regexp_replace(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    tail = F.regexp_extract(rest, r"(?s)^[^/?#]*(.*)\z", 1)
    return F.when(F.col(url).isNull(), "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), tail))


def _placed() -> list[Column]:
    """The sort key of a capture: url key and id; a null id gets the least number and a mark."""
    return [url_key().alias("key"), F.col("page_id").isNotNull().alias("has_id"),
            F.coalesce(F.col("page_id").cast("bigint"), F.lit(-(1 << 63))).alias("id")]


def decided(pages: DataFrame) -> DataFrame:
    """(key, has_id, id, digest, refers_to): the response of every payload that is
    not its own.  Payloads are grouped before the join, so a frequent one is a
    single row of one side; the other side has no html and can be split."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    seen = written(pages.select(*_placed(), F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).alias("bytes")), "warc-payloads")
    largest = (seen.where(F.col("bytes") >= REVISIT_BYTES).groupBy("digest")
               .agg(F.max(F.when(F.col("has_id"), F.col("id"))).alias("response"), F.count("*").alias("n")))
    largest = written(largest.where("n > 1").select("digest", "response"), "warc-responses")
    refers = F.when(~F.col("has_id") | (F.col("id") != F.col("response")), F.col("response"))
    return seen.join(largest, "digest", "left").select("key", "has_id", "id", "digest", refers.alias("refers_to"))


class _Output:
    """A file of the shared folder, with the number of bytes written."""

    def __init__(self, folder: str, name: str):
        fs, path = pafs.FileSystem.from_uri(folder)
        fs.create_dir(path, recursive=True)
        self.stream, self.at = fs.open_output_stream(f"{path}/{name}", compression=None), 0

    def write(self, data: bytes) -> tuple[int, int]:
        place = (self.at, len(data))
        self.stream.write(data)
        self.at += len(data)
        return place


def _uri(path: str) -> str:
    return path if "://" in path else f"file://{path}"


def _escaped(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode("utf-8")) for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record, a gzip member."""
    revisit = refers_to is not None
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if not revisit:
        body += payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_escaped(url)}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(body)}")
    return gzip.compress("\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + body + b"\r\n\r\n", 6, mtime=0)


def parsed(member: bytes) -> dict:
    """Headers and payload of a record."""
    data = gzip.decompress(member)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    body = rest[:int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    length = int(http.rsplit(b"Content-Length: ", 1)[1].split(b"\r\n")[0])
    return {"fields": fields, "payload": payload, "length": length}


def _id_of(urn: str) -> int | None:
    found = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(found) if found else None


def _writer(folder: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows of one key come together: first what was decided, then the pages."""
        name = uuid.uuid4().hex  # a repeated task writes other files
        archive = index = None
        lines: list[list] = []
        directory: list[list] = []
        refers: dict[str, int | None] = {}
        at, captures = None, 0

        def close_block() -> None:
            place = index.write(zlib.compress(json.dumps(lines).encode("utf-8"), 6))
            directory.append([*lines[0][:3], *place])
            lines.clear()

        for part in batches:
            for row in part.itertuples(index=False):
                key = _key_of(row)
                if key != at:
                    at, refers = key, {}
                if row.kind == 0:
                    refers[row.digest] = int(row.refers_to) if row.refers else None
                    continue
                if archive is None:
                    archive, index = _Output(folder, f"{name}.warc.gz"), _Output(folder, f"{name}.cdx")
                    archive.write(gzip.compress(f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.UUID(name)}>\r\nWARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\nContent-Length: 0\r\n\r\n\r\n\r\n".encode(), mtime=0))
                payload = (row.html or "").encode("utf-8")
                digest = hashlib.sha1(payload).hexdigest()
                page_id = int(row.id) if row.has_id else None
                place = archive.write(record(page_id, row.url, payload, digest, refers[digest]))
                lines.append([*key, *place])
                captures += 1
                if len(lines) == BLOCK:
                    close_block()
        if archive is None:
            return
        if lines:
            close_block()
        sparse = _Output(folder, f"{name}.idx")
        sparse.write(zlib.compress(json.dumps(directory).encode("utf-8"), 6))
        for out in (archive, index, sparse):
            out.stream.close()
        yield pd.DataFrame({"shard": [name], "first_key": [directory[0][0]], "first_has_id": [directory[0][1]], "first_id": [directory[0][2]], "captures": [captures], "blocks": [len(directory)]})
    return run


def _key_of(row) -> tuple[str, bool, int]:
    return row.key, bool(row.has_id), int(row.id)


class Archive:
    """Archives and index in a shared folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.shards = spark.read.schema(_SHARDS).parquet(f"{folder}/shards")

    @staticmethod
    def write(pages: DataFrame, folder: str | None = None) -> Archive:
        """Archive ``pages`` (page_id, url, html) in ``folder``, by default a new
        one of the shared folder.  The html is shuffled once, by the sort."""
        spark = pages.sparkSession
        folder = folder or shared_path(spark, "warc")
        own = pages.select("page_id", "url", "html")
        text = F.lit(None).cast("string")
        captures = own.select(*_placed(), F.lit(1).alias("kind"), "url", "html", text.alias("digest"), F.lit(None).cast("bigint").alias("refers_to"))
        marks = decided(own).select("key", "has_id", "id", F.lit(0).alias("kind"), text.alias("url"), text.alias("html"), "digest", "refers_to")
        rows = (marks.union(captures).withColumn("refers", F.col("refers_to").isNotNull()).fillna(0, ["refers_to"])
                .repartitionByRange("key", "has_id", "id").sortWithinPartitions("key", "has_id", "id", "kind"))
        rows.mapInPandas(_writer(f"{_uri(folder)}/files"), _SHARDS).write.parquet(f"{folder}/shards")
        return Archive(spark, folder)

    def lookup(self, wanted: DataFrame) -> DataFrame:
        """Read the records of (page_id, url) rows: page_id, url, payload (null for
        a revisit), payload_bytes, payload_digest, record_type, refers_to.  A row
        that is not in the archive has no result; of equal rows the n-th gets the
        n-th record."""
        # one row per shard, as many as there were write tasks
        top = sorted(((r.first_key, r.first_has_id, r.first_id), r.shard) for r in self.shards.collect())
        asked = wanted.select("url", *_placed())
        routed = asked.mapInPandas(_router(top), "shard string, url string, key string, has_id boolean, id bigint")
        width = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), len(top))
        return (routed.repartition(width, "shard").sortWithinPartitions("shard", "key", "has_id", "id")
                .mapInArrow(_reader(f"{_uri(self.folder)}/files"), _RECORDS))


def _router(top: list[tuple[tuple, str]]):
    firsts = [t[0] for t in top]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            at = [bisect.bisect_right(firsts, _key_of(row)) - 1 for row in part.itertuples(index=False)]
            part = part.assign(shard=[top[i][1] if i >= 0 else None for i in at])
            yield part[part["shard"].notna()][["shard", "url", "key", "has_id", "id"]]
    return run


class _Shard:
    """An open shard: its directory, and the block read last."""

    def __init__(self, files: str, name: str):
        self.fs, path = pafs.FileSystem.from_uri(files)
        self.archive = self.fs.open_input_file(f"{path}/{name}.warc.gz")
        self.index = self.fs.open_input_file(f"{path}/{name}.cdx")
        with self.fs.open_input_file(f"{path}/{name}.idx") as f:
            self.directory = json.loads(zlib.decompress(f.readall()))
        self.firsts = [(k, h, i) for k, h, i, _, _ in self.directory]
        self.number, self.lines = -1, []

    def block(self, number: int) -> list[list]:
        if number != self.number:
            *_, offset, length = self.directory[number]
            self.number, self.lines = number, json.loads(zlib.decompress(self.index.read_at(length, offset)))
        return self.lines

    def find(self, key: tuple[str, bool, int]) -> list[tuple[int, int]]:
        """Places of the records of a key, found by two binary searches; equal keys
        may go on in the next blocks."""
        number = max(bisect.bisect_left(self.firsts, key) - 1, 0)
        out = []
        while number < len(self.directory):
            lines = self.block(number)
            at = bisect.bisect_left(lines, list(key))  # a line begins with its key
            while at < len(lines) and tuple(lines[at][:3]) == key:
                out.append((lines[at][3], lines[at][4]))
                at += 1
            if at < len(lines):
                break
            number += 1
        return out

    def close(self) -> None:
        self.archive.close()
        self.index.close()


def _reader(files: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = shard = key = None
        places: list[tuple[int, int]] = []
        repeat = 0
        for batch in batches:
            out = {c: [] for c in _RECORD_FIELDS}
            held = 0
            for s, url, *own in zip(*(batch.column(c).to_pylist() for c in ("shard", "url", "key", "has_id", "id"))):
                if s != name:
                    if shard is not None:
                        shard.close()
                    name, shard, key = s, _Shard(files, s), None
                if tuple(own) != key:
                    key, repeat = tuple(own), 0
                    places = shard.find(key)
                if not places:
                    continue
                offset, length = places[repeat % len(places)]
                repeat += 1
                found = parsed(shard.archive.read_at(length, offset))
                fields, revisit = found["fields"], found["fields"]["WARC-Type"] == "revisit"
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if not revisit and hashlib.sha1(found["payload"]).hexdigest() != digest:
                    raise ValueError(f"record {fields['WARC-Record-ID']} of {name} is damaged")
                out["page_id"].append(_id_of(fields["WARC-Record-ID"]))
                out["url"].append(url)
                out["payload"].append(None if revisit else found["payload"].decode("utf-8"))
                out["payload_bytes"].append(found["length"])
                out["payload_digest"].append(digest)
                out["record_type"].append(fields["WARC-Type"])
                out["refers_to"].append(_id_of(fields["WARC-Refers-To"]) if revisit else None)
                held += found["length"]
                if held > 4 << 20:
                    yield pa.RecordBatch.from_pydict(out, _RECORD_SCHEMA)
                    out, held = {c: [] for c in _RECORD_FIELDS}, 0
            yield pa.RecordBatch.from_pydict(out, _RECORD_SCHEMA)
        if shard is not None:
            shard.close()
    return run
