"""WARC archives: a deterministic sharded writer and its reader."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinspan.llm.common import bounded, materialize, scratch_path, small

CELLS = 65536  # of the id range at first: the grain at which ids are dealt to shards
TOP = 256  # cells that are added up together first
FAN = 4096  # cells that a heavy cell is cut into
SHARD_BYTES = 24 << 20  # of payload, about, that one shard gets
TASKS = 8192  # that write or read at most; a task writes its shards one after the other
ROLL_BYTES = 8 << 20  # of compressed records, after which a file is closed
DATE = "1970-01-01T00:00:00Z"
EMPTY = b""


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _clean(value: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "%{:02X}".format(ord(c)) for c in value)


def record_id(page_id: int | None, digest: str, nth: int = 0) -> str:
    """The id of the nth record of a page and payload; a revisit names the first of the page that it refers to."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}/{nth}')}>"


def record(page_id: int | None, url: str | None, payload: bytes | None, n: int, digest: str, refers_to: int | None, nth: int = 0) -> bytes:
    """One WARC record: a response with its payload, or a revisit that names the response's page."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id, digest, nth)}", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {_clean(url) if url else f'urn:page:{page_id}'}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
            f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {n}"]
    head += [f"X-Page-ID: {page_id}"] if page_id is not None else []
    head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}"] if refers_to is not None else []
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _File:
    """A file that is written under a temporary name and renamed once it is whole."""

    def __init__(self, fs, top: str, name: str):
        self.fs, self.top, self.name = fs, top, name
        self.tmp = f"{top}/.tmp-{uuid.uuid4().hex}-{name}"
        self.out, self.bytes, self.records, self.sha = fs.open_output_stream(self.tmp, compression=None), 0, 0, hashlib.sha1()
        self.add(f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>\r\nWARC-Date: {DATE}\r\nWARC-Filename: {name}\r\nContent-Type: application/warc-fields\r\nContent-Length: 0\r\n\r\n\r\n\r\n".encode(), 0)

    def add(self, data: bytes, count: int = 1) -> None:
        data = _member(data)
        self.out.write(data)
        self.sha.update(data)
        self.bytes += len(data)
        self.records += count

    def close(self) -> dict:
        self.out.close()
        self.fs.move(self.tmp, f"{self.top}/{self.name}")
        return {"file": self.name, "records": self.records, "bytes": self.bytes, "sha1": self.sha.hexdigest()}


class _Shards:
    """How ids become shards: ranges of about equal payload, which follow from the rows alone.

    The id range is cut into equal cells; a cell heavier than a shard is cut again, and so on down to single ids. Cells
    in order are added up to shards. Neither cells nor shards go to the driver."""

    def __init__(self, slim: DataFrame, shard_bytes: int):
        ends = slim.agg(F.min("page_id").alias("lo"), F.max("page_id").alias("hi")).first()
        self.lo = ends.lo if ends.lo is not None else 0
        width = ((ends.hi - ends.lo) // CELLS + 1) if ends.lo is not None else 1
        self.first, self.cuts = width, []
        while True:
            cells = materialize(self._at(slim).groupBy("at").agg(F.sum(F.col("n") + 512).alias("n")), "warc-cells")
            if width == 1 or not (heavy := materialize(cells.where(F.col("n") > shard_bytes).select("at"), "warc-heavy")).head(1):
                break
            width = max(1, width // FAN)
            self.cuts.append((small(heavy.select(F.col("at").alias("heavy"))), width))
        order = lambda *c: Window.orderBy(*c)
        cells = cells.withColumn("top", F.expr(f"(at - {self.lo}) div {self.first * TOP}"))
        tops = cells.groupBy("top").agg(F.sum("n").alias("all"))  # CELLS / TOP rows at most
        tops = tops.select("top", (F.sum("all").over(order("top")) - F.col("all")).alias("before"))
        upto = F.sum("n").over(Window.partitionBy("top").orderBy("at")) - F.col("n") + F.col("before")
        self.of = materialize(cells.join(bounded(tops, CELLS // TOP), "top").select(F.col("at").alias("cell"), F.floor(upto / shard_bytes).cast("int").alias("shard")), "warc-shards")
        self.count = (self.of.agg(F.max("shard").alias("n")).first().n or 0) + 1

    def _at(self, rows: DataFrame) -> DataFrame:
        """rows with the first id of their cell, `at`; a null id stands with the smallest."""
        start = lambda w: F.lit(self.lo) + F.expr(f"(coalesce(page_id, {self.lo}) - {self.lo}) div {w}") * w
        rows = rows.withColumn("at", start(self.first))
        for heavy, width in self.cuts:
            rows = rows.join(heavy, F.col("at") == F.col("heavy"), "left").withColumn("at", F.when(F.col("heavy").isNull(), F.col("at")).otherwise(start(width))).drop("heavy")
        return rows

    def deal(self, rows: DataFrame) -> DataFrame:
        return self._at(rows).join(small(self.of), F.col("at") == F.col("cell")).drop("at", "cell")


def _filesystem(path: str):
    """The file system and the path within it. Spark's names of object stores are put in Arrow's."""
    from pyarrow.fs import FileSystem

    for alias in ("s3a://", "s3n://"):
        path = path.replace(alias, "s3://", 1) if path.startswith(alias) else path
    return FileSystem.from_uri(path)


def _sweep(spark, path: str) -> None:
    """Removes the temporary files that killed attempts have left. Files that the manifest lists have their final names by now."""
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/.tmp-*")
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.globStatus(top) or []:
        fs.delete(status.getPath(), False)


def write_warc(pages: DataFrame, path: str, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Writes a record for each row of pages (page_id, url, html) under path; returns the manifest (file, records, bytes, sha1).

    Ids are dealt to shards by range, sorted within each; files roll by compressed size; names and bytes follow from the
    rows alone, so a task that runs again after a lost executor writes the same. Of equal payloads the one with the
    largest id is a response and smaller ones are revisits; rows that repeat that id and payload are responses, too. A null
    html is an empty payload, a null id is smaller than any other, a null url is named after the page. A very long payload is one record, in memory
    as a whole while it is written. An empty table gives an empty manifest; other columns are ignored. The manifest is
    written after all files have their final names: files that it does not list do not count."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    slim = materialize(pages.select("page_id", F.unhex(F.sha1(payload)).alias("sha"), F.octet_length(payload).cast("long").alias("n")), "warc-slim")
    shards = _Shards(slim, shard_bytes)
    largest = slim.groupBy("sha", "n").agg(F.max("page_id").alias("keep"), F.count("*").alias("c")).where("c > 1").select("sha", "keep")
    revisit = slim.join(largest, "sha").where(F.col("keep").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("keep"))))
    decided = revisit.groupBy("page_id", "sha").agg(F.max("keep").alias("keep"))
    told = shards.deal(decided).select("shard", "page_id", "sha", F.lit(0).alias("kind"), "keep", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("html"))
    full = shards.deal(pages.select("page_id", "url", payload.alias("html")).withColumn("sha", F.unhex(F.sha1("html"))))
    full = full.select("shard", "page_id", "sha", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("keep"), F.col("url").cast("string").alias("url"), "html")
    tasks = min(shards.count, TASKS)
    sorted_rows = told.unionByName(full).repartitionById(tasks, F.col("shard") % tasks).sortWithinPartitions("shard", "page_id", "sha", "kind", "url")

    def write(batches):
        import pyarrow as pa

        fs, top = _filesystem(path)
        fs.create_dir(top, recursive=True)
        now, shard, seq, known, keep, last, nth, done = None, None, 0, None, None, None, 0, []
        for batch in batches:
            for s, page, sha, kind, to, url, html in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if kind == 0:
                    known, keep = (page, sha), to
                    continue
                if now is None or s != shard or now.bytes >= roll_bytes:
                    if now is not None:
                        done.append(now.close())
                    seq = seq + 1 if s == shard else 0
                    shard, now = s, _File(fs, top, f"part-{s:05d}-{seq:05d}.warc.gz")
                last, nth = (page, sha), nth + 1 if last == (page, sha) else 0
                now.add(record(page, url, html, len(html), base64.b32encode(sha).decode(), keep if known == last else None, nth))
        if now is not None:
            done.append(now.close())
        if done:
            yield pa.RecordBatch.from_pylist(done)

    manifest = materialize(sorted_rows.mapInArrow(write, "file string, records long, bytes long, sha1 string"), "warc-manifest")
    _sweep(spark, path)
    return manifest


def parse(stream):
    """(headers, block) of each record of a stream of gzip members, one record in memory at a time."""
    z, data = zlib.decompressobj(31), bytearray()
    chunk = stream.read(1 << 20)
    while chunk:
        data += z.decompress(chunk)
        chunk = z.unused_data
        if z.eof:
            head, _, block = bytes(data).partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            yield fields, block[: int(fields["Content-Length"])]
            z, data = zlib.decompressobj(31), bytearray()
        if not chunk:
            chunk = stream.read(1 << 20)
    if data:
        raise ValueError("the archive ends within a record")


def read_warc(manifest: DataFrame, path: str) -> DataFrame:
    """Reads the files that the manifest lists: page_id, payload_bytes, payload_digest, record_type, refers_to, url, file.

    Sizes and digests of responses are those of the bytes read, and must match the headers; a revisit has those of its headers. Records
    without a page id give a null one, as they were written; repeated records are rows; a record is held whole in memory, one at a time;
    an empty manifest gives no row."""

    def read(batches):
        import pyarrow as pa

        fs, top = _filesystem(path)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                with fs.open_input_stream(f"{top}/{name}", compression=None) as stream:
                    for h, block in parse(stream):
                        if h["WARC-Type"] == "warcinfo":
                            continue
                        n, digest, to = int(h["X-Payload-Length"]), h["WARC-Payload-Digest"].removeprefix("sha1:"), h.get("X-Refers-To-Page-ID")
                        if h["WARC-Type"] == "response":
                            body = block.partition(b"\r\n\r\n")[2]
                            if (len(body), base32_sha1(body)) != (n, digest):
                                raise ValueError(f"{name}: the payload of page {h.get('X-Page-ID')} does not match its headers")
                        page = h.get("X-Page-ID")
                        rows.append({"page_id": None if page is None else int(page), "payload_bytes": n, "payload_digest": digest, "record_type": h["WARC-Type"], "refers_to": None if to is None else int(to), "url": h["WARC-Target-URI"], "file": name})
                schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("file", pa.string())])
                yield from pa.Table.from_pylist(rows, schema).to_batches(max_chunksize=8192)

    files = manifest.select("file").repartition(max(1, min(manifest.count(), TASKS)), "file")
    return files.mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, file string")


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes the archives into the shared folder and reads them back."""
    path = scratch_path(pages.sparkSession, "warc")
    return read_warc(write_warc(pages, path), path)
