"""Web archives in ZIP packages: written by tasks, read back by ranges.

A package is a ZIP file whose members are stored without compression: an archive of WARC records, each a
gzip member of its own, and an index with a line per record (its offset and length in the archive). Reading unpacks nothing: the
end of the file names the central directory (in its ZIP64 form where the numbers need it), the directory tells where the
members' bytes lie, the index where each record lies in the archive, and records are fetched by byte range.

Packages go to a folder that all executors share, through Arrow's file systems. Each attempt of a task writes
under names of its own, and the table of packages that Spark commits names those of the attempts that counted, so a
lost executor leaves at most files that nobody reads.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trellis.llm.common import body, text_chunks
from trellis.session import Scratch, file_system

ARCHIVE = "archive/data.warc.gz"
INDEX = "indexes/index.jsonl.gz"
PACKAGE_BYTES = 64 << 20  # a task starts another package when one has this much
RANGE_BYTES = 4 << 20  # neighbouring records are fetched together up to this much
LEAST_BYTES = 0  # smaller payloads are never revisits
LEVEL = 1
MOST_HOT = 1000
HOT_ROWS = 200  # payloads with fewer rows are never broadcast
DATE = "1970-01-01T00:00:00Z"  # the pages have no time of capture


# ---- writing


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode("ascii")


def record_id(page_id) -> str:
    return f"<urn:page:{quote(json.dumps(page_id), safe='')}>"


def page_of(record: str):
    return json.loads(unquote(record.removeprefix("<urn:page:").removesuffix(">")))


def record(page_id, url: str | None, digest: str, size: int, refers_to: str | None, payload: bytes | None) -> bytes:
    """One WARC record. A revisit has the HTTP head alone, whose length is that of the full payload."""
    kind = "response" if refers_to is None else "revisit"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head + (payload if refers_to is None else b"")
    fields = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {quote(url, safe=';/?:@&=+$,#%!*()[]~|^')}"] if url is not None else []),
        f"WARC-Payload-Digest: sha1:{digest}",
        *([f"WARC-Refers-To: {refers_to}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if refers_to else []),
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Package:
    """A package being written to a stream that need not seek."""

    def __init__(self, sink):
        self.zip = zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.archive = self.zip.open(ARCHIVE, "w", force_zip64=True)
        self.index: list[dict] = []
        self.size = 0

    def add(self, key: str, data: bytes) -> None:
        packed = gzip.compress(data, LEVEL, mtime=0)
        self.archive.write(packed)
        self.index.append({"record": key, "offset": self.size, "length": len(packed)})
        self.size += len(packed)

    def close(self) -> None:
        self.archive.close()
        lines = "".join(json.dumps(line) + "\n" for line in self.index)
        self.zip.writestr(INDEX, gzip.compress(lines.encode(), LEVEL, mtime=0))
        self.zip.close()


def write_packages(rows: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write rows of ``page_id, url, digest, size, refers_to, is_revisit, html``; lazily gives ``path, records``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = file_system(folder)
        package, sink, path = None, None, ""

        def finished() -> pa.RecordBatch:
            package.close()
            sink.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(package.index)], pa.int64())], names=["path", "records"])

        for batch in text_chunks(batches, "html"):
            for row in batch.to_pylist():
                if package is None:
                    files.create_dir(root, recursive=True)
                    path = f"{uuid.uuid4().hex}.wacz"
                    sink = files.open_output_stream(f"{root}/{path}")
                    package = Package(sink)
                refers_to = record_id(row["refers_to"]) if row["is_revisit"] else None
                data = record(row["page_id"], row["url"], base32(row["digest"]), row["size"], refers_to, (row["html"] or "").encode())
                package.add(record_id(row["page_id"]), data)
                if package.size >= package_bytes:
                    yield finished()
                    package = None
        if package is not None:
            yield finished()

    return rows.mapInArrow(run, "path string, records long")


# ---- reading


class Members:
    """The stored members of a ZIP file, found from its central directory; ``read_at(size, offset)`` reads it."""

    TAIL = 22 + 65535  # the end record and the longest comment

    def __init__(self, read_at, size: int):
        self.read_at = read_at
        tail_at = max(0, size - self.TAIL - 20)
        tail = read_at(size - tail_at, tail_at)
        end = self._end_record(tail, size - tail_at)
        count, length, start = struct.unpack_from("<HII", tail, end + 10)
        if end >= 20 and tail[end - 20:end - 16] == b"PK\x06\x07":
            (at,) = struct.unpack_from("<Q", tail, end - 12)
            record64 = read_at(56, at)
            if record64[:4] != b"PK\x06\x06":
                raise ValueError("the ZIP64 locator does not point to a ZIP64 end record")
            count, length, start = struct.unpack_from("<QQQ", record64, 32)
        self.places: dict[str, tuple[int, int]] = {}
        directory, at = read_at(length, start), 0
        for _ in range(count):
            at = self._entry(directory, at)

    @staticmethod
    def _end_record(tail: bytes, size: int) -> int:
        end = tail.rfind(b"PK\x05\x06")
        while end >= 0:
            if end + 22 <= size and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] == size:
                return end
            end = tail.rfind(b"PK\x05\x06", 0, end)
        raise ValueError("no end of a ZIP directory")

    def _entry(self, directory: bytes, at: int) -> int:
        if directory[at:at + 4] != b"PK\x01\x02":
            raise ValueError("broken ZIP directory")
        method, = struct.unpack_from("<H", directory, at + 10)
        packed, plain, name_length, extra_length, comment_length = struct.unpack_from("<IIHHH", directory, at + 20)
        header, = struct.unpack_from("<I", directory, at + 42)
        name_at = at + 46
        name = directory[name_at:name_at + name_length].decode("utf-8")
        extra = directory[name_at + name_length:name_at + name_length + extra_length]
        # ZIP64: the numbers that did not fit, in this order.
        wide = [value == 0xFFFFFFFF for value in (plain, packed, header)]
        numbers, i = [plain, packed, header], 0
        while any(wide) and i + 4 <= len(extra):
            kind, length = struct.unpack_from("<HH", extra, i)
            if kind == 1:
                values = iter(struct.unpack_from(f"<{length // 8}Q", extra, i + 4))
                numbers = [next(values) if w else n for n, w in zip(numbers, wide)]
            i += 4 + length
        if method == zipfile.ZIP_STORED:
            self.places[name] = (numbers[2], numbers[1])
        return name_at + name_length + extra_length + comment_length

    def place(self, name: str) -> tuple[int, int]:
        """Where a member's bytes start, and how many there are."""
        header, size = self.places[name]
        local = self.read_at(30, header)
        if local[:4] != b"PK\x03\x04":
            raise ValueError(f"{name}: no local header")
        name_length, extra_length = struct.unpack_from("<HH", local, 26)
        return header + 30 + name_length + extra_length, size


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, _fields(http), payload


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


def records(read_at, size: int, range_bytes: int = RANGE_BYTES) -> Iterator[bytes]:
    """All records of a package in the order of the archive, fetched by ranges of neighbours."""
    members = Members(read_at, size)
    index_at, index_size = members.place(INDEX)
    lines = gzip.decompress(read_at(index_size, index_at)).decode("utf-8").splitlines()
    places = sorted((line["offset"], line["length"]) for line in map(json.loads, lines))
    archive_at, _ = members.place(ARCHIVE)
    i = 0
    while i < len(places):
        first, j = places[i][0], i
        while j < len(places) and (j == i or places[j][0] + places[j][1] - first <= range_bytes):
            j += 1
        data = read_at(places[j - 1][0] + places[j - 1][1] - first, archive_at + first)
        for offset, length in places[i:j]:
            yield gzip.decompress(data[offset - first:offset - first + length])
        i = j


def read_packages(packages: DataFrame, folder: str, id_type: T.DataType) -> DataFrame:
    """``page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload`` of all records. A response whose
    payload does not have the digest it names is an error; a revisit's payload is null."""
    spark = packages.sparkSession
    spread = packages.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")
    schema = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = file_system(folder)
        kinds = pa.schema([
            ("page_id", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("record_type", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary()),
        ])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with files.open_input_file(f"{root}/{path}") as file:
                    rows, held = [], 0
                    for data in records(file.read_at, file.size()):
                        rows.append(_row(data))
                        held += len(data)
                        if held > RANGE_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, kinds)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, kinds)

    found = spread.mapInArrow(run, schema)
    return found.withColumns({name: F.col(name).cast(id_type) for name in ("page_id", "refers_to")})


def _row(data: bytes) -> dict:
    fields, http, payload = parse(data)
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    revisit = fields["warc-type"] == "revisit"
    if not revisit and base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii") != digest:
        raise ValueError(f"{fields['warc-record-id']}: the payload does not have its digest")
    url = fields.get("warc-target-uri")
    return {
        "page_id": page_of(fields["warc-record-id"]), "url": url, "payload_digest": digest, "record_type": fields["warc-type"],
        "payload_bytes": int(http["content-length"]) if revisit else len(payload),
        "refers_to": page_of(fields["warc-refers-to"]) if revisit else None, "payload": None if revisit else payload,
    }


# ---- both


def sha1_of(html: Column) -> Column:
    return F.sha1(html.cast("binary"))


def archive(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write a record per row and read them all back: ``read_packages``'s columns.

    Of equal payloads of at least ``least_bytes`` the row with the smallest id is the response, null ids last, and of rows that also share
    that id, one; the others revisit it. Null pages have an empty payload, null addresses none; ids are of any type that
    orders and that Spark casts to a string and back; characters an address can't hold are percent-encoded; an empty table gives no rows.

    Equal payloads are found on digests: the pages' bytes are moved once, by their own ids, and only those of responses. Digests that
    more than a thousandth of all rows share (and over ``HOT_ROWS``) are at most a thousand; they are broadcast, so
    that their rows stay where they are."""
    scratch = Scratch(pages.sparkSession)
    text = body(F.col("html"))
    rows = pages.select(F.col(id).alias("page_id"), F.col(url).cast("string").alias("url"), body(F.col(html)).alias("html"))
    rows = rows.withColumn("digest", sha1_of(text))
    small = scratch.put(rows.select(
        "page_id", "url", "digest", F.octet_length(text).cast("long").alias("size"), F.monotonically_increasing_id().alias("number")
    ), "digests")
    least = F.min(F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id").alias("id"), F.col("number")))
    firsts = scratch.put(small.groupBy("digest").agg(least.alias("least"), F.count("*").alias("n")).select(
        "digest", F.col("least.id").alias("first"), F.col("least.number").alias("first_number"), "n"
    ), "firsts")
    is_hot = F.col("n") > max(HOT_ROWS, small.count() // MOST_HOT)
    hot = F.broadcast(firsts.filter(is_hot))
    judged = small.join(hot, "digest").unionByName(small.join(hot.select("digest"), "digest", "left_anti").join(firsts.filter(~is_hot), "digest"))
    is_revisit = (F.col("size") >= least_bytes) & (F.col("number") != F.col("first_number"))
    judged = scratch.put(judged.withColumn("is_revisit", is_revisit), "judged")
    page_id, key = F.col("page_id").cast("string"), F.to_json(F.struct("page_id", "url", "digest")).alias("key")
    revisits = judged.filter("is_revisit").select(
        page_id.alias("page_id"), "url", "digest", "size", F.col("first").cast("string").alias("refers_to"), "is_revisit", F.lit("").alias("html")
    )
    # Rows that agree in id, address and payload are one row with a number of copies.
    keys = judged.filter(~F.col("is_revisit")).groupBy(key).agg(F.count("*").alias("copies"))
    responses = rows.withColumn("key", key).join(keys, "key").dropDuplicates(["key"]).select(
        page_id.alias("page_id"), "url", "digest", F.octet_length(text).cast("long").alias("size"), F.lit(None).cast("string").alias("refers_to"),
        F.lit(False).alias("is_revisit"), "html", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    ).drop("copy")
    folder = f"{scratch.root}/packages"
    packages = scratch.put(write_packages(responses.unionByName(revisits), folder), "manifest")
    return read_packages(packages, folder, small.schema["page_id"].dataType)
