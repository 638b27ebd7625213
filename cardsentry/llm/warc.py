"""WARC archives of pages, deduplicated by payload, and a two-level capture index to read them back.

Writing: every task appends its pages to an archive file of its own in the shared folder, one gzip member a record, and
returns where each record lies. Only files that a finished task names are ever read, so lost executors and repeated
tasks leave nothing wrong behind. Of records with equal payloads the one with the largest page id is a response, the
others are revisit records without a body.

Index: capture lines (reversed-host URL key, page id, file, offset, length) are sorted by key over the whole table and cut
into blocks of lines that are compressed one by one. A sparse directory has the first key of every block and where the
block lies; it is a sorted table itself, of which a task reads the part that its keys fall in.

Lookup: keys are range-partitioned and sorted. For each, a binary search in the directory gives the block, a range read
and a binary search in the block the captures, and a range read of the archive the record.
"""

import base64
import bisect
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardsentry.llm.common import batches, scratch_path, texts_of, written

BLOCK_LINES = 1_000
LEAST_BYTES = 0  # smaller payloads are all responses
LEVEL = 4
NONE = "-"


def opened(folder: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or a plain path."""
    if "://" not in folder and not folder.startswith("file:"):
        return pafs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(folder)


def url_key(url: str | None) -> str:
    """Reversed host, then port, path and query in lower case: pages of a host and its subdomains lie side by side. What
    is no URL is its own key; spaces and line ends are escaped."""
    text = (url or "").strip()
    try:
        parts = urlsplit(text)
        host, port = parts.hostname, parts.port
    except ValueError:
        host = None
    if host:
        text = ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + (parts.path or "/")
        text = (text + (f"?{parts.query}" if parts.query else "")).lower()
    return "".join(f"%{ord(c):02x}" if c <= " " else c for c in text) or NONE


def sha1_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """A response record, or a revisit record if it refers to another page."""
    target = "".join(f"%{ord(c):02x}" if c <= " " else c for c in url or "") or "about:blank"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    head = "\r\n".join([*lines, f"Content-Length: {len(body)}"])
    return head.encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parsed(raw: bytes) -> dict:
    """Fields of a record as it was read; the digest of a response is computed from its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    length = next(int(x.split(b": ")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length"))
    kind, said = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or sha1_of(payload) != said):
        raise ValueError(f"record {fields['WARC-Record-ID']} has another payload than it was written with")
    urn = lambda name: fields[name].removeprefix("<urn:page:").removesuffix(">") if name in fields else None
    return {
        "page_id": urn("WARC-Record-ID"),
        "payload_bytes": length,
        "payload_digest": said,
        "record_type": kind,
        "refers_to": urn("WARC-Refers-To"),
        "payload": payload if kind == "response" else None,
    }


def number(text: str | None) -> int | None:
    return None if text is None or text == NONE else int(text)


def write_archives(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write ``pages(page_id, url, html)`` below ``folder``; returns the capture lines (key, page_id, file, offset, length),
    one per row. Null html counts as empty; a row without a page_id revisits any equal payload with one, and is a response
    if there is none."""
    payload = F.coalesce("html", F.lit(""))
    marks = [F.sha1(payload).alias("sha"), F.octet_length(payload).alias("size")]
    rows = pages.select(F.col("page_id").cast("long"), "url", "html", *marks)
    equal = rows.where(F.col("size") >= least_bytes).groupBy("sha", "size").agg(
        F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("n")
    )
    equal = equal.where("n > 1 AND newest IS NOT NULL").select("sha", "size", "newest")
    typed = rows.join(equal, ["sha", "size"], "left")
    other = F.col("newest").isNotNull() & ~F.col("newest").eqNullSafe(F.col("page_id"))
    typed = typed.select("page_id", "url", "html", F.when(other, F.col("newest")).alias("refers_to"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = opened(folder)
        name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        out, at = None, 0
        for part in batches(parts):
            if out is None:
                out = fs.open_output_stream(f"{root}/{name}", compression=None)
            lines = []
            ids, refers = part["page_id"].to_pylist(), part["refers_to"].to_pylist()
            for i, url, html, to in zip(ids, part["url"].to_pylist(), texts_of(part["html"]), refers, strict=True):
                own = NONE if i is None else str(i)
                raw = record(own, url, html, sha1_of(html), None if to is None else str(to))
                packed = gzip.compress(raw, LEVEL, mtime=0)
                out.write(packed)
                lines.append((url_key(url), i, name, at, len(packed)))
                at += len(packed)
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            columns = [pa.array(c, k) for c, k in zip(zip(*lines, strict=True), kinds, strict=True)]
            yield pa.record_batch(columns, ["key", "page_id", "file", "offset", "length"])
        if out is not None:
            out.close()

    fs, root = opened(folder)
    fs.create_dir(root, recursive=True)
    return written(typed.mapInArrow(run, "key string, page_id long, file string, offset long, length long"), "captures")


def sort_key(key: Column, page_id: Column) -> Column:
    """One string that sorts by URL key, then by page id."""
    number = F.when(page_id < 0, F.concat(F.lit("-"), F.lpad((page_id + F.lit(2**63 - 1)).cast("string"), 19, "0")))
    number = number.otherwise(F.concat(F.lit("0"), F.lpad(page_id.cast("string"), 19, "0")))
    return F.concat(key, F.lit(" "), F.coalesce(number, F.lit(NONE)))


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Sort the capture lines by key into compressed blocks below ``folder``; returns the directory (first, last, file,
    offset, length), one row a block, sorted and stored."""
    keyed = captures.select(sort_key(F.col("key"), F.col("page_id")).alias("k"), "file", "offset", "length")
    keyed = keyed.repartitionByRange("k", "file", "offset").sortWithinPartitions("k", "file", "offset")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = opened(folder)
        name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.idx"
        out, at, lines, entries = None, 0, [], []

        def flush() -> None:
            nonlocal at, lines
            packed = zlib.compress("\n".join(lines).encode(), 6)
            out.write(packed)
            entries.append((lines[0].split("\t")[0], lines[-1].split("\t")[0], name, at, len(packed)))
            at, lines = at + len(packed), []

        for part in batches(parts):
            if out is None:
                out = fs.open_output_stream(f"{root}/{name}", compression=None)
            for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                lines.append("\t".join(map(str, row)))
                if len(lines) >= block_lines:
                    flush()
        if out is not None:
            if lines:
                flush()
            out.close()
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
            columns = [pa.array(c, k) for c, k in zip(zip(*entries, strict=True), kinds, strict=True)]
            yield pa.record_batch(columns, ["first", "last", "file", "offset", "length"])

    fs, root = opened(folder)
    fs.create_dir(root, recursive=True)
    schema = "first string, last string, file string, offset long, length long"
    return written(keyed.mapInArrow(run, schema), "directory")


def look_up(keys: DataFrame, directory: DataFrame, index: str, archives: str, ranges: int | None = None) -> DataFrame:
    """The records of all captures of ``keys(key, page_id)``: page_id, payload_bytes, payload_digest, record_type,
    refers_to. Repeated keys are looked up once; keys without captures give nothing.

    Directory rows and keys meet sorted in the same ranges (``ranges`` of them, else as many as shuffle partitions): a block goes to every range it reaches into, which are few as
    both sides are sorted, so no task holds more of the directory than its range.
    """
    k = sort_key(F.col("key"), F.col("page_id")).alias("k")
    wanted = keys.select(k).distinct()
    # a sparse directory has a row for every thousand captures; a key belongs to the last block that starts at or below
    # it, and to those before it that the same key runs through
    asked = wanted.select(F.col("k").alias("first"), F.lit(1).alias("asked"), *(F.lit(None).cast(t).alias(c) for c, t in SPOT))
    marks = directory.select("first", F.lit(0).alias("asked"), *(c for c, _ in SPOT))
    # the number is given, as a key is small but stands for a record that is read
    n = ranges or int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merged = asked.unionByName(marks).repartitionByRange(n, "first").withColumn("part", F.spark_partition_id())
    merged = written(merged, "lookups")
    # the block that reaches into a range from the range before: the last one that starts below it
    last = F.max(F.when(F.col("asked") == 0, F.struct("first", *(c for c, _ in SPOT)))).alias("b")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    carried = merged.groupBy("part").agg(last).select("part", F.max("b").over(earlier).alias("b")).where("b IS NOT NULL")
    carried = carried.select("b.first", F.lit(0).alias("asked"), *(f"b.{c}" for c, _ in SPOT), "part")
    side = merged.unionByName(carried).repartition(n, "part").sortWithinPartitions("part", "first", "asked", "file", "offset")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, files = Ranges(*opened(index)), Ranges(*opened(archives))
        held: list[tuple] = []  # blocks that may hold the next key: (first, last, file, offset, length)
        lines: dict[tuple, list[str]] = {}
        at_range = None
        for part in batches(parts):
            rows = []
            for own_range, key, asked, last, file, offset, length in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if own_range != at_range:  # a task may have several ranges, each with the block carried into it
                    at_range, held = own_range, []
                if not asked:
                    held = [b for b in held if b[1] >= key]
                    held.append((key, last, file, offset, length))
                    lines = {b: lines[b] for b in held if b in lines}
                    continue
                for b in held:
                    if not b[0] <= key <= b[1]:
                        continue
                    if b not in lines:
                        lines[b] = zlib.decompress(blocks.read(*b[2:])).decode().split("\n")
                    own = lines[b]
                    at = bisect.bisect_left(own, key + "\t")
                    while at < len(own) and own[at].startswith(key + "\t"):
                        _, name, start, size = own[at].split("\t")
                        rows.append(parsed(gzip.decompress(files.read(name, int(start), int(size)))))
                        at += 1
            if rows:
                columns = [
                    pa.array([number(r["page_id"]) for r in rows], pa.int64()),
                    pa.array([r["payload_bytes"] for r in rows], pa.int64()),
                    pa.array([r["payload_digest"] for r in rows], pa.string()),
                    pa.array([r["record_type"] for r in rows], pa.string()),
                    pa.array([number(r["refers_to"]) for r in rows], pa.int64()),
                ]
                yield pa.record_batch(columns, ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
        blocks.close()
        files.close()

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return side.select("part", "first", "asked", *(c for c, _ in SPOT)).mapInArrow(run, schema)


SPOT = (("last", "string"), ("file", "string"), ("offset", "long"), ("length", "long"))


class Ranges:
    """Range reads with a few files kept open."""

    def __init__(self, fs: pafs.FileSystem, root: str, most: int = 32):
        self.fs, self.root, self.most, self.open = fs, root, most, {}

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name not in self.open:
            if len(self.open) >= self.most:
                self.open.pop(next(iter(self.open))).close()
            self.open[name] = self.fs.open_input_file(f"{self.root}/{name}")
        return self.open[name].read_at(length, offset)

    def close(self) -> None:
        for f in self.open.values():
            f.close()


def round_trip(spark: SparkSession, pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write archives and index of ``pages`` to the shared folder and read every capture back through the index.

    One row per row of ``pages``; repeated rows are captures of their own, equal ids with other pages too. An empty table
    gives an empty one; other columns are ignored.
    """
    archives, index = scratch_path(spark, "archives"), scratch_path(spark, "index")
    captures = write_archives(pages, archives, least_bytes)
    directory = write_index(captures, index)
    return look_up(captures.select("key", "page_id"), directory, index, archives)
