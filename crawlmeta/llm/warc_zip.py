"""WARC records in ZIP packages, read by byte ranges.

A package is a ZIP file with three stored (uncompressed) members: the archive
``archive/data.warc.gz`` (one gzip member per record), its index
``indexes/index.cdxj`` (one line per record: key, time, JSON with type, offset
and length in the archive) and ``datapackage.json``. Because members are stored,
a record of the archive is a byte range of the ZIP file.

Writing: of records with equal payloads of at least ``revisit_bytes`` the one
with the largest id is a response, the others are revisit records without a
payload. Payloads are grouped by SHA-256 with a map-side aggregate; only groups
with more than one row are joined back, by a sort-merge join whose hot keys
adaptive execution splits. Each task writes packages of at most ``PACKAGE_BYTES``
under names of its own; only packages that its committed manifest row names are
read, so lost executors and second attempts leave no trace.

Reading: ``members`` parses the end record, the ZIP64 locator and record and the
central directory of each package (64-bit sizes and offsets from extra fields),
and finds the members' data by their local headers. ``index`` reads the index
members into one short row per record. ``read`` deals these rows to tasks by
blocks of the packages and reads records by range, neighbours in one request.

Defined cases: a null payload is empty; a null or empty URL is written as the
record's id; a null id is never the largest of a group that has ids, and refers
to it; in a group without ids all rows are responses, as are all rows that repeat
the largest id; an empty table is a manifest without rows; further columns are
not read. A package that is no ZIP file, lacks the index or holds a damaged
record gives a row with ``error`` and the others are read on.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlmeta.llm.common import local_path, written
from crawlmeta.session import ship_package

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
MANIFEST = "file string, bytes long, records long"
MEMBERS = "file string, member string, method int, start long, packed long, size long, error string"
ENTRIES = ("file string, record_id string, record_type string, url string, offset long, length long, error string")
RECORDS = ("record_id string, record_type string, url string, refers_to string, payload_digest string, "
           "payload_bytes long, payload binary, error string")
#: A package is closed once its archive has so many bytes.
PACKAGE_BYTES = 128 << 20
#: Packages' bytes per reading task, and per block of neighbouring records.
TASK_BYTES, BLOCK_BYTES = 32 << 20, 4 << 20
_LEVEL = 3
_BATCH_BYTES = 16 << 20
# Fixed values of the ZIP format: signatures, and the field values that point to 64-bit ones.
_END, _END64, _LOCATOR, _CENTRAL, _LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
_IN_EXTRA, _EXTRA64 = 0xFFFFFFFF, 1
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_TIME = "1970-01-01T00:00:00Z"


# --- writing ---------------------------------------------------------------

def planned(pages: DataFrame, revisit_bytes: int, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """id, url, payload, refers_to (the id of the response that a revisit points to, else null)."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("h", F.unhex(F.sha2("payload", 256)))
    shared = (rows.where(F.octet_length("payload") >= revisit_bytes).groupBy("h")
              .agg(F.max("id").alias("largest"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    later = F.when(~F.col("id").eqNullSafe(F.col("largest")), F.col("largest"))
    return (rows.join(shared, "h", "left").withColumn("refers_to", later)
            .select("id", "url", "payload", "refers_to", F.sha1("payload").alias("sha1")))


def _name(value) -> str:
    return f"<urn:record:{'' if pd.isna(value) else value}>"


def _clean(url) -> str:
    """A header value stays on its line."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def _record(rid: str, refers: str | None, url: str, payload: bytes, sha1: str) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers else 'response'}", f"WARC-Record-ID: {rid}",
            f"WARC-Date: {_TIME}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{sha1}"]
    block = b""
    if refers:
        head += [f"WARC-Refers-To: {refers}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    else:
        head += ["Content-Type: application/http; msgtype=response"]
        block = _HTTP.format(len(payload)).encode() + payload
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


class _Stream:
    """What zipfile needs of a stream that only goes forward."""

    def __init__(self, out):
        self.write, self.flush, self.size = self._write, lambda: None, 0
        self.out = out

    def _write(self, data) -> int:
        self.out.write(data)
        self.size += len(data)
        return len(data)


class Package:
    """One package being written."""

    def __init__(self, path: str):
        self.path, (fs, local) = path, local_path(path)
        self.stream = _Stream(fs.open_output_stream(local))
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED)
        self.archive = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)
        self.lines: list[tuple[str, str]] = []
        self.offset = 0

    def add(self, rid: str, refers: str | None, url: str, payload: bytes, sha1: str) -> None:
        packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
        data = packer.compress(_record(rid, refers, url, payload, sha1)) + packer.flush()
        self.archive.write(data)
        about = {"url": url, "type": "revisit" if refers else "response", "id": rid, "digest": f"sha1:{sha1}",
                 "offset": self.offset, "length": len(data)}
        self.lines.append((url, json.dumps(about)))
        self.offset += len(data)

    def close(self) -> tuple[str, int, int]:
        self.archive.close()
        self.lines.sort()
        with self.zip.open(zipfile.ZipInfo(INDEX), "w") as f:
            for url, about in self.lines:
                f.write(f"{url} 19700101000000 {about}\n".encode())
        self.zip.writestr(zipfile.ZipInfo("datapackage.json"), json.dumps(
            {"profile": "data-package", "resources": [{"name": n.rsplit("/")[-1], "path": n} for n in (ARCHIVE, INDEX)]}))
        self.zip.close()
        self.stream.out.close()
        return self.path, self.stream.size, len(self.lines)


def write(pages: DataFrame, folder: str, revisit_bytes: int = 1000, id_col: str = "page_id", url_col: str = "url",
          payload_col: str = "html", package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write one record per row; returns the manifest (file, bytes, records), read back from the folder."""
    ship_package(pages.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = None

        def done():
            return pd.DataFrame([at.close()], columns=["file", "bytes", "records"])

        for pdf in batches:
            for rid, url, payload, refers, sha1 in zip(pdf.id, pdf.url, pdf.payload, pdf.refers_to, pdf.sha1):
                at = at or Package(f"{folder.rstrip('/')}/records-{uuid.uuid4().hex}.wacz")
                name = _name(rid)
                at.add(name, None if pd.isna(refers) else _name(refers), _clean(url or name), payload, sha1)
                if at.offset >= package_bytes:
                    yield done()
                    at = None
        if at:
            yield done()

    rows = planned(pages, revisit_bytes, id_col, url_col, payload_col)
    # Revisit records carry no payload: it stops here. Ids go as text, so that Arrow never makes floats of them.
    lean = rows.select(F.col("id").cast("string").alias("id"), "url",
                       F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(b"")).alias("payload"),
                       F.col("refers_to").cast("string").alias("refers_to"), "sha1")
    return written(lean.mapInPandas(run, MANIFEST), folder, "manifest")


# --- reading ---------------------------------------------------------------

def _end_of_directory(f, size: int) -> tuple[int, int]:
    """Offset and length of the central directory."""
    tail_at = max(0, size - 22 - 0xFFFF - 20)
    tail = f.read_at(size - tail_at, tail_at)
    at = len(tail)
    while True:
        at = tail.rfind(_END, 0, at)
        if at < 0:
            raise ValueError("no end of central directory")
        if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
    length, offset = struct.unpack_from("<II", tail, at + 12)
    if at >= 20 and tail[at - 20:at - 16] == _LOCATOR:
        end64_at = struct.unpack_from("<Q", tail, at - 12)[0]
        end64 = f.read_at(56, end64_at)
        if end64[:4] != _END64:
            raise ValueError("no ZIP64 end of central directory where the locator says")
        length, offset = struct.unpack_from("<QQ", end64, 40)
    if offset + length > size:
        raise ValueError("central directory beyond the end of the file")
    return offset, length


def _wide(extra: bytes, values: list[int]) -> list[int]:
    """Replace the values that the ZIP64 extra field holds, in order."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == _EXTRA64:
            field = at + 4
            for i, v in enumerate(values):
                if v == _IN_EXTRA:
                    values[i] = struct.unpack_from("<Q", extra, field)[0]
                    field += 8
        at += 4 + n
    return values


def directory(f, size: int) -> list[tuple[str, int, int, int, int]]:
    """name, method, start of the data, packed size, size of every member."""
    offset, length = _end_of_directory(f, size)
    data = f.read_at(length, offset)
    found, at = [], 0
    while at < length:
        if data[at:at + 4] != _CENTRAL:
            raise ValueError("damaged central directory")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", data, at + 20)
        local = struct.unpack_from("<I", data, at + 42)[0]
        name = data[at + 46:at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = data[at + 46 + n_name:at + 46 + n_name + n_extra]
        plain, packed, local = _wide(extra, [plain, packed, local])
        head = f.read_at(30, local)
        if head[:4] != _LOCAL:
            raise ValueError(f"no local header of {name}")
        start = local + 30 + sum(struct.unpack_from("<HH", head, 26))
        found.append((name, method, start, packed, plain))
        at += 46 + n_name + n_extra + n_comment
    return found


def _open(path: str):
    fs, local = local_path(path)
    return fs.open_input_file(local)


def _per_package(packages: DataFrame, one, schema: str) -> DataFrame:
    """``one`` per file, a task per few files whatever their rows' size."""
    columns = [c.split(" ")[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path in pdf.file:
                rows = []
                try:
                    for row in one(path):
                        rows.append(row)
                        if len(rows) == 10_000:
                            yield pd.DataFrame(rows, columns=columns)
                            rows = []
                except (ValueError, OSError, struct.error, zlib.error) as e:
                    rows.append((path, *[None] * (len(columns) - 2), f"{type(e).__name__}: {e}"))
                yield pd.DataFrame(rows, columns=columns)

    ship_package(packages.sparkSession)
    files = packages.select("file")
    return files.repartition(max(1, min(files.count(), 10_000))).mapInPandas(run, schema)


def _members(path: str):
    with _open(path) as f:
        for row in directory(f, f.size()):
            yield (path, *row, None)


def members(packages: DataFrame) -> DataFrame:
    """Every member of every package (column ``file``), from the central directories."""
    return _per_package(packages, _members, MEMBERS)


def _lines(f, start: int, packed: int, method: int) -> Iterator[bytes]:
    if method not in (0, 8):
        raise ValueError(f"index packed by method {method}")
    inflate = zlib.decompressobj(-15) if method else None
    rest = b""
    for at in range(0, packed, 1 << 20):
        data = f.read_at(min(1 << 20, packed - at), start + at)
        *lines, rest = (rest + (inflate.decompress(data) if inflate else data)).split(b"\n")
        yield from lines
    if rest:
        yield rest


def _index(path: str):
    with _open(path) as f:
        inside = {m[0]: m for m in directory(f, f.size())}
        if ARCHIVE not in inside or INDEX not in inside:
            raise ValueError("the package lacks its archive or its index")
        _, method, start, packed, _ = inside[ARCHIVE]
        if method:
            raise ValueError("the archive is not stored")
        _, index_method, index_start, index_packed, _ = inside[INDEX]
        for line in _lines(f, index_start, index_packed, index_method):
            about = json.loads(line[line.index(b"{"):])
            if not 0 <= about["offset"] <= about["offset"] + about["length"] <= packed:
                raise ValueError("an index line points outside the archive")
            yield path, about["id"], about["type"], about["url"], start + about["offset"], about["length"], None


def index(packages: DataFrame) -> DataFrame:
    """One row per record: package, id, type, URL, and its byte range of the package."""
    return _per_package(packages, _index, ENTRIES)


def _parsed(data: bytes) -> tuple:
    """The fields of one record from its gzip member."""
    text = zlib.decompressobj(31).decompress(data)
    cut = text.index(b"\r\n\r\n")
    head = dict(line.split(": ", 1) for line in text[:cut].decode("utf-8", "replace").split("\r\n")[1:])
    block = text[cut + 4:cut + 4 + int(head["Content-Length"])]
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    about = (head["WARC-Record-ID"], head["WARC-Type"], head.get("WARC-Target-URI"), head.get("WARC-Refers-To"))
    if head["WARC-Type"] != "response":
        return *about, digest, None, None, None
    payload = block[block.index(b"\r\n\r\n") + 4:]
    found = hashlib.sha1(payload).hexdigest()
    return *about, found, len(payload), payload, None if found == digest else "payload does not fit its digest"


def read(packages: DataFrame, entries: DataFrame | None = None, with_payload: bool = True) -> DataFrame:
    """The records of ``entries`` (all of the packages' index unless given, for example a selection of it)."""
    ship_package(packages.sparkSession)
    columns = [c.split(" ")[0] for c in RECORDS.split(", ")]

    def spans(pdf: pd.DataFrame):
        """Rows of one request: neighbours without a gap, up to a block."""
        group: list = []
        for row in pdf.itertuples(index=False):
            if group and (row.file != group[-1].file or row.offset != group[-1].offset + group[-1].length
                          or row.offset + row.length - group[0].offset > BLOCK_BYTES):
                yield group
                group = []
            group.append(row)
        if group:
            yield group

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f, opened = None, None
        rows, size = [], 0
        for pdf in batches:
            rows += [(r.record_id, r.record_type, r.url, None, None, None, None, f"{r.file}: {r.error}")
                     for r in pdf[pdf.error.notna()].itertuples()]
            for group in spans(pdf[pdf.error.isna()].astype({"offset": "int64", "length": "int64"})):
                if group[0].file != opened:
                    if f:
                        f.close()
                    f, opened = _open(group[0].file), group[0].file
                first = group[0].offset
                data = f.read_at(group[-1].offset + group[-1].length - first, first)
                for r in group:
                    try:
                        row = _parsed(data[r.offset - first:r.offset - first + r.length])
                    except (ValueError, KeyError, zlib.error) as e:
                        row = (r.record_id, r.record_type, r.url, None, None, None, None, f"{type(e).__name__}: {e}")
                    size += len(row[6] or b"")
                    rows.append(row if with_payload else (*row[:6], None, row[7]))
                if size > _BATCH_BYTES or len(rows) >= 10_000:
                    yield pd.DataFrame(rows, columns=columns).astype({"payload_bytes": "Int64"})
                    rows, size = [], 0
        if f:
            f.close()
        if rows:
            yield pd.DataFrame(rows, columns=columns).astype({"payload_bytes": "Int64"})

    wanted = (entries if entries is not None else index(packages))
    size = packages.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    # The rows are short but stand for bytes of the packages: the number of tasks follows those.
    dealt = wanted.repartition(max(1, -(-size // TASK_BYTES)), "file", F.floor(F.col("offset") / BLOCK_BYTES))
    return dealt.sortWithinPartitions("file", "offset").mapInPandas(run, RECORDS)


def _id(column, kind: str):
    return F.expr(f"try_cast(regexp_extract({column}, '^<urn:record:(.*)>$', 1) AS {kind})")


def resolved(records: DataFrame, id_type: str = "long", id_col: str = "page_id") -> DataFrame:
    """Records (a table) with the id as ``id_col``; a revisit has the payload size of the response
    that it refers to, which must have the same digest (else ``error`` says so)."""
    rows = records.select(_id("record_id", id_type).alias(id_col), "record_type", "url", "payload_digest", "payload_bytes",
                          _id("refers_to", id_type).alias("refers_to"), "error")
    held = (rows.where("record_type = 'response'").select(
        F.col(id_col).alias("refers_to"), "payload_digest", F.col("payload_bytes").alias("held_bytes")).distinct())
    joined = rows.join(held, ["refers_to", "payload_digest"], "left")
    lost = (F.col("record_type") == "revisit") & F.col("held_bytes").isNull() & F.col("error").isNull()
    return joined.select(id_col, F.coalesce("payload_bytes", "held_bytes").alias("payload_bytes"), "payload_digest",
                         "record_type", "refers_to", "url",
                         F.when(lost, F.lit("no response to refer to")).otherwise(F.col("error")).alias("error"))


def open_packages(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of packages written to ``folder``."""
    return spark.read.schema(MANIFEST).parquet(f"{folder.rstrip('/')}/manifest")
