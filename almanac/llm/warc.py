"""WARC archives: a deterministic sharded writer and a reader.

Records are range-sorted by page_id into shards with exact cut points; each shard
is written by one task as a series of files that roll at a compressed size, every
record a gzip member of its own with regenerated headers and digests. A task
writes under a temporary name of its attempt; only files named by the rows of
the successful attempts are renamed, and the manifest is written last, so a lost
executor or a repeated attempt leaves no half archive behind.

Payload digests decide which record of equal payloads is the response. That
decision travels as a small row beside the payload (both go to the shard of the
page_id), so payloads are shuffled once.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.common import cut_points, documents, partitions, settle
from almanac.session import scratch_path

ROLL_BYTES = 64 << 20
LEAST_PAYLOAD = 100
DATE = "2024-01-01T00:00:00Z"
LEVEL = 6

_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
MANIFEST_DDL = "shard int, file int, temporary string, final string, records long, bytes long, sha256 string"
MANIFEST = pa.schema([("shard", pa.int32()), ("file", pa.int32()), ("temporary", pa.string()), ("final", pa.string()),
                      ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])


def filesystem(path: str):
    """The Arrow file system of a path or URI, and the path within it."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(path if re.match(r"\w[\w+.-]*:/", path) else f"file://{path}")


def _line(value: str) -> str:
    """A header value: white space runs and control characters become one blank."""
    return re.sub(r"[\x00-\x20\x7F]+", " ", value).strip()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
           revisit: bool) -> bytes:
    """One WARC/1.1 record, uncompressed. A revisit has no payload; its length
    stands in a header of its own."""
    name = "null" if page_id is None else str(page_id)
    uri = _line(url or "").replace(" ", "%20") or f"urn:page:{name}"
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    ident = uuid.uuid5(_SPACE, f"{name} {uri} {digest} {revisit}")
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:uuid:{ident}>"),
            ("WARC-Date", DATE), ("WARC-Target-URI", uri), ("Content-Type", "application/http;msgtype=response"),
            ("WARC-Payload-Digest", f"sha256:{digest}"),
            ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
            ("X-Page-Id", name), ("X-Payload-Length", str(len(payload)))]
    if revisit:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("X-Refers-To-Page-Id", str(refers_to))]
    head.append(("Content-Length", str(len(block))))
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block + b"\r\n\r\n"


class _Roll:
    """The files of one shard."""

    def __init__(self, folder: str, shard: int, attempt: str, roll: int):
        self.fs, self.root = filesystem(folder)
        self.shard, self.attempt, self.roll = shard, attempt, roll
        self.done: list[tuple] = []
        self.out = None

    def add(self, member: bytes) -> None:
        if self.out is not None and self.bytes + len(member) > self.roll:
            self.close()
        if self.out is None:
            n = len(self.done)
            self.name = f"shard-{self.shard:06d}-{n:05d}.warc.gz"
            self.temporary = f"_temporary/{self.name}.{self.attempt}"
            self.out = self.fs.open_output_stream(f"{self.root}/{self.temporary}")
            self.bytes, self.records, self.sum = 0, 0, hashlib.sha256()
        self.out.write(member)
        self.bytes, self.records = self.bytes + len(member), self.records + 1
        self.sum.update(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.shard, len(self.done), self.temporary, self.name, self.records, self.bytes,
                              self.sum.hexdigest()))
            self.out = None


def _writer(folder: str, roll: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        files = _Roll(folder, context.partitionId(), f"{context.attemptNumber()}-{uuid.uuid4().hex[:8]}", roll)
        first: dict[str, int] = {}
        page, used = object(), set()  # digests of this page_id that already have their response
        for batch in batches:
            for i, digest, least, html, url in zip(*(batch.column(c).to_pylist() for c in
                                                     ("page_id", "digest", "first", "html", "url")), strict=True):
                if i != page:
                    page, first, used = i, {}, set()
                if html is None:  # a decision; it stands before the rows of its page
                    first[digest] = least
                    continue
                payload = html.encode()
                response = digest not in first or (first[digest] == i and digest not in used)
                used.add(digest)
                data = record(i, url, payload, digest, first.get(digest), not response)
                member = io.BytesIO()
                with gzip.GzipFile(fileobj=member, mode="wb", compresslevel=LEVEL, mtime=0) as z:
                    z.write(data)
                files.add(member.getvalue())
        files.close()
        rows = list(zip(*files.done, strict=True)) or [[]] * len(MANIFEST)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, MANIFEST, strict=True)], schema=MANIFEST)
    return run


def _commit(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        for batch in batches:
            for temporary, final in zip(batch.column("temporary").to_pylist(), batch.column("final").to_pylist(), strict=True):
                if fs.get_file_info(f"{root}/{temporary}").type.name != "NotFound":  # else an earlier attempt did it
                    fs.move(f"{root}/{temporary}", f"{root}/{final}")
            yield batch
    return run


def write_archives(pages: DataFrame, folder: str, roll: int = ROLL_BYTES) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as WARC files under ``folder`` and return
    the manifest (also written to ``folder/manifest``).

    Payloads of any length are written whole, one record at a time. Null html is an
    empty payload; a null url becomes ``urn:page:<id>``; extra columns
    are ignored; an empty table writes no file. Of rows with the same payload of at
    least LEAST_PAYLOAD bytes the one with the smallest page_id is the response;
    if that id repeats with this payload, one of its rows is, and the others revisit it.
    A row without page_id is always a response and never referred to."""
    spark = pages.sparkSession
    fs, root = filesystem(folder)
    fs.create_dir(f"{root}/_temporary", recursive=True)
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    marks = settle(rows.select("page_id", F.sha2(F.col("html").cast("binary"), 256).alias("digest"),
                               F.octet_length("html").alias("n")), "warc-digests")
    big = marks.where((F.col("n") >= LEAST_PAYLOAD) & F.col("page_id").isNotNull())
    least = big.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("k")).where("k > 1").drop("k")
    decisions = big.select("page_id", "digest").join(least, "digest").distinct()
    cuts = sorted({(r.page_id is not None, r.page_id or 0) for r in
                   cut_points(marks.select("page_id"), F.col("page_id").asc_nulls_first(), shards=partitions(spark))})

    @F.arrow_udf("int")
    def shard(page_id: pa.Array) -> pa.Array:
        return pa.array([bisect_right(cuts, (i is not None, i or 0)) - 1 for i in page_id.to_pylist()], pa.int32())

    body = rows.select("page_id", F.sha2(F.col("html").cast("binary"), 256).alias("digest"),
                       F.lit(None).cast("long").alias("first"), "html", "url")
    notes = decisions.select("page_id", "digest", "first", F.lit(None).cast("string").alias("html"),
                             F.lit(None).cast("string").alias("url"))
    manifest = (body.unionByName(notes).withColumn("shard", shard("page_id"))
                .repartitionById(max(len(cuts), 1), "shard")
                .sortWithinPartitions(F.col("page_id").asc_nulls_first(), F.col("html").isNotNull(), "digest", "url")
                .select("page_id", "digest", "first", "html", "url").mapInArrow(_writer(folder, roll), MANIFEST_DDL))
    manifest = settle(manifest, "warc-manifest")  # from here on the names of the attempts that count
    committed = manifest.repartition(partitions(spark)).mapInArrow(_commit(folder), MANIFEST_DDL)
    committed.write.mode("overwrite").parquet(f"{folder}/manifest")
    fs.delete_dir(f"{root}/_temporary")
    return spark.read.parquet(f"{folder}/manifest")


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a decompressed WARC stream."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            key, _, value = line.decode().rstrip("\r\n").partition(": ")
            head[key] = value
        block = stream.read(int(head["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {head.get('WARC-Record-ID')} is cut short")
        yield head, block


RECORDS_DDL = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
               "refers_to long, payload binary")
RECORDS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                     ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                     ("payload", pa.binary())])


def _reader(folder: str, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        rows: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal rows, held
            cols, rows, held = list(zip(*rows, strict=True)), [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, RECORDS, strict=True)], schema=RECORDS)

        for batch in batches:
            for name in batch.column("final").to_pylist():
                with fs.open_input_stream(f"{root}/{name}", compression=None) as raw, \
                        gzip.GzipFile(fileobj=io.BufferedReader(raw, 1 << 20)) as z:
                    for head, block in parse(z):
                        if f"sha256:{hashlib.sha256(block).hexdigest()}" != head["WARC-Block-Digest"]:
                            raise ValueError(f"{name}: block digest of {head['WARC-Record-ID']} differs")
                        kind, payload = head["WARC-Type"], block.partition(b"\r\n\r\n")[2]
                        digest = head["WARC-Payload-Digest"].partition(":")[2]
                        if kind == "response":
                            if digest != hashlib.sha256(payload).hexdigest():
                                raise ValueError(f"{name}: payload digest of {head['WARC-Record-ID']} differs")
                            size = len(payload)
                        else:
                            size = int(head["X-Payload-Length"])
                        page, to = head["X-Page-Id"], head.get("X-Refers-To-Page-Id")
                        rows.append((None if page == "null" else int(page), head["WARC-Target-URI"], size, digest, kind,
                                     None if to is None else int(to), payload if keep else None))
                        held += 200 + (len(payload) if keep else 0)
                        if held > 4 << 20:
                            yield flush()
        if rows:
            yield flush()
    return run


def read_archives(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """Records of the files that the manifest under ``folder`` names; digests are
    checked. A revisit has no payload."""
    files = spark.read.parquet(f"{folder}/manifest").select("final")
    return files.repartition(partitions(spark), "final").mapInArrow(_reader(folder, payload), RECORDS_DDL)


def op4_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    write_archives(documents(spark, sf_dir, "pages"), folder)
    return read_archives(spark, folder, payload=False).drop("payload", "url")


#: The rows of the round trip, straight from the table.
OP4_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS n, sha256(h) AS digest FROM p),
f AS (SELECT *, CASE WHEN n >= {LEAST_PAYLOAD} AND page_id IS NOT NULL THEN
        min(page_id) OVER (PARTITION BY digest, page_id IS NULL) END AS first,
        row_number() OVER (PARTITION BY digest, page_id IS NULL ORDER BY page_id) AS place FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN first IS NULL OR place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN first END AS refers_to
FROM f"""
