"""WARC archives as a Spark data source (Python Data Source API).

``spark.read.format("warc").option("path", p).load()`` gives one row per
kept record: ``archive_path, record_type, capture_date, target_url,
content_encoding, body, error``. An input partition is an archive file, or some small ones;
``read_warc`` reads larger archives through an index of their gzip members
(``warc_index``) instead, by as many tasks as they have ranges. Records are
streamed member by member, never the whole archive in memory.

Pushed-down work (Catalyst cannot push filters through Python): by default
only ``response`` records whose target path ends with ``/robots.txt`` are
materialised; other bodies are skipped in small steps. The HTTP payload is split
from its headers and its ``Content-Encoding`` layers are undone (in reverse
order; gzip / x-gzip / deflate; unknown codings pass through). A body that
cannot be decoded gives a row with ``error`` set instead of failing the
archive; an archive that cannot be read at all gives one error row.
"""

from __future__ import annotations

import gzip
import io
import itertools
import re
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from crawlmeta.session import work_folder
from crawlmeta.sources.files import file_sizes, list_files, open_input, open_output

WARC_SCHEMA = T.StructType([
    T.StructField("archive_path", T.StringType()),
    T.StructField("record_type", T.StringType()),
    T.StructField("capture_date", T.StringType()),
    T.StructField("target_url", T.StringType()),
    T.StructField("content_encoding", T.StringType()),
    T.StructField("body", T.BinaryType()),
    T.StructField("error", T.StringType()),
])

# Bytes that are read at once when a record is skipped.
SKIP_BYTES = 1 << 20
# Small archives share a task up to so many bytes.
PARTITION_BYTES = 64 << 20
# Archives of more bytes are read by several tasks.
SPLIT_BYTES = 256 << 20
# Tasks that write archives, unless the session has more shuffle partitions.
WRITE_TASKS = 64
# Bytes read from an archive at once, and fed of them to a gzip member at once.
READ_BYTES = 64 << 10
FEED_BYTES = 4 << 10
# Payloads of at most so many bytes are packed with small tables.
SHORT_BYTES = 4 << 10
_DAMAGE = (OSError, EOFError, ValueError, zlib.error)
# Rows of one Arrow batch that a reader yields.
BATCH_ROWS = 256


def maybe_robots_target(url: str | None) -> bool:
    """Conservative reader-side filter: False only for targets that cannot
    have a path ending in ``/robots.txt`` (the exact, decoded check is the
    column function applied after the scan)."""
    if url is None:
        return False
    low = url.lower()
    return "robots.txt" in low or "%" in low


def _gunzip(data: bytes) -> bytes:
    """``gzip.decompress``, sooner for the usual single member."""
    try:
        inflate = zlib.decompressobj(31)
        out = inflate.decompress(data)
        if inflate.eof and not inflate.unused_data:
            return out
    except zlib.error:
        pass
    return gzip.decompress(data)


def _gzip(data: bytes) -> bytes:
    """One gzip member; the tables for a long text would cost a short one more than its packing."""
    if len(data) > SHORT_BYTES:
        return gzip.compress(data, mtime=0)
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31, 4)
    return deflate.compress(data) + deflate.flush()


class _Inflated(io.RawIOBase):
    """The bytes of a file of gzip members and nothing else; anything else in it is an error."""

    def __init__(self, raw):
        self._raw, self._held, self._at, self._inflate = raw, b"", 0, None

    def readable(self) -> bool:
        return True

    def _more(self) -> None:
        self._held, self._at = self._held[self._at:] + self._raw.read(READ_BYTES), 0

    def readinto(self, buffer) -> int:
        while True:
            if self._inflate is None:
                if len(self._held) - self._at < 3:
                    self._more()
                if not self._held:
                    return 0
                if self._held[self._at:self._at + 3] != b"\x1f\x8b\x08":
                    raise OSError("not a gzip member")
                self._inflate = zlib.decompressobj(31)
            data = self._inflate.unconsumed_tail
            if not data:
                if self._at == len(self._held):
                    self._more()
                data = self._held[self._at:self._at + FEED_BYTES]
                if not data:
                    raise EOFError("a gzip member ends early")
                self._at += len(data)
            out = self._inflate.decompress(data, len(buffer))
            if self._inflate.eof:  # what was fed of the next member is fed again
                self._at -= len(self._inflate.unused_data)
                self._inflate = None
            if out:
                buffer[:len(out)] = out
                return len(out)


def decode_content(body: bytes, content_encoding: str | None) -> bytes:
    """Undo ``Content-Encoding`` layers, last applied first."""
    codings = [c.strip().lower() for c in (content_encoding or "").split(",")]
    for c in reversed([c for c in codings if c]):
        if c in ("gzip", "x-gzip"):
            body = _gunzip(body)
        elif c == "deflate":
            body = zlib.decompress(body)
    return body


def encode_content(body: bytes, content_encoding: str | None) -> bytes:
    for c in [c.strip().lower() for c in (content_encoding or "").split(",") if c.strip()]:
        if c in ("gzip", "x-gzip"):
            body = _gzip(body)
        elif c == "deflate":
            body = zlib.compress(body)
    return body


_DATE = re.compile(r"^(\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d)(?:\.(\d{1,9}))?Z$")


def instant_text(date: str | None) -> str | None:
    """WARC-Date as ``Instant.toString`` prints it (fraction in groups of 3,
    none when zero)."""
    if date is None:
        return None
    m = _DATE.match(date.strip())
    if not m:
        return date.strip()
    frac = (m.group(2) or "").ljust(9, "0")
    if int(frac or "0") == 0:
        return m.group(1) + "Z"
    for width in (3, 6, 9):
        if int(frac[width:] or "0") == 0:
            return f"{m.group(1)}.{frac[:width]}Z"
    return f"{m.group(1)}.{frac}Z"


def _read_headers(stream: io.BufferedReader) -> tuple[str | None, dict[str, str]]:
    first = stream.readline()
    while first in (b"\r\n", b"\n"):
        first = stream.readline()
    if not first:
        return None, {}
    headers: dict[str, str] = {}
    while True:
        line = stream.readline()
        if not line or line in (b"\r\n", b"\n"):
            break
        k, _, v = line.decode("utf-8", errors="replace").partition(":")
        headers.setdefault(k.strip().lower(), v.strip())
    return first.decode("utf-8", errors="replace").strip(), headers


def _http_split(payload: bytes) -> tuple[dict[str, str], bytes]:
    for sep in (b"\r\n\r\n", b"\n\n"):
        i = payload.find(sep)
        if i >= 0:
            head, body = payload[:i], payload[i + len(sep):]
            break
    else:
        head, body = payload, b""
    headers: dict[str, str] = {}
    for line in head.decode("iso-8859-1").splitlines()[1:]:
        k, _, v = line.partition(":")
        headers.setdefault(k.strip().lower(), v.strip())
    return headers, body


def _dechunked(body: bytes) -> bytes:
    """Payload of a ``Transfer-Encoding: chunked`` body; a body that is not
    framed so (some archives store it already joined) stays as it is."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        try:
            n = int(size, 16)
        except ValueError:
            return body
        if n == 0:
            return b"".join(out)
        if len(body) < end + 2 + n:
            return body
        out.append(body[end + 2:end + 2 + n])
        at = end + 2 + n + 2


def http_body(headers: dict[str, str], body: bytes) -> bytes:
    """The message body: chunk marks removed, cut at ``Content-Length``."""
    if "chunked" in headers.get("transfer-encoding", "").lower():
        return _dechunked(body)
    length = headers.get("content-length", "").strip()
    return body[:int(length)] if length.isdigit() else body


def skip_content(stream: io.BufferedReader, n: int) -> None:
    while n > 0:
        got = len(stream.read(min(n, SKIP_BYTES)))
        if not got:
            raise ValueError("Truncated WARC record")
        n -= got


def record_headers(stream: io.BufferedReader) -> Iterator[tuple[dict[str, str], int]]:
    """Headers and content length of each record of a stream. The content lies
    ahead in the stream; the caller reads or skips it before the next step."""
    while True:
        version, h = _read_headers(stream)
        if version is None:
            return
        if not version.startswith("WARC/"):
            raise ValueError(f"Not a WARC record header: {version[:40]!r}")
        yield h, int(h.get("content-length", "0"))


def is_wanted(h: dict[str, str], record_types: tuple[str, ...], robots_only: bool) -> bool:
    return h.get("warc-type", "") in record_types and (not robots_only or maybe_robots_target(h.get("warc-target-uri")))


def record_row(h: dict[str, str], content: bytes, archive: str) -> tuple:
    """The row of one record; a body that cannot be decoded is an error in it."""
    wtype, target, date = h.get("warc-type", ""), h.get("warc-target-uri"), instant_text(h.get("warc-date"))
    if wtype != "response":
        return archive, wtype, date, target, None, content, None
    http_headers, body = _http_split(content)
    enc = http_headers.get("content-encoding", "")
    try:
        return archive, wtype, date, target, enc, decode_content(http_body(http_headers, body), enc), None
    except (OSError, EOFError, zlib.error) as ex:
        return archive, wtype, date, target, enc, None, f"Body decode failed: {ex}"


def read_content(stream: io.BufferedReader, n: int) -> bytes:
    content = stream.read(n)
    if len(content) < n:
        raise ValueError("Truncated WARC record")
    return content


def error_row(archive: str, ex: Exception) -> tuple:
    return archive, None, None, None, None, None, f"{type(ex).__name__}: {ex}"


def read_records(path: str, record_types: tuple[str, ...] = ("response",), robots_only: bool = True,
                 archive: str | None = None) -> Iterator[tuple]:
    """Rows of one archive file; ``archive`` is its name in the rows (the
    manifest path of a staged file), the file's path by default."""
    archive = archive or path
    done = 0
    if path.endswith(".gz"):
        try:
            with open_input(path) as raw:
                for row in _stream_rows(io.BufferedReader(_Inflated(raw), READ_BYTES), record_types, robots_only, archive):
                    yield row
                    done += 1
            return
        except _DAMAGE:
            pass  # padded or damaged: read again by GzipFile, which says what is wrong, and go on after the rows given
    try:
        raw = open_input(path)
        with io.BufferedReader(gzip.GzipFile(fileobj=raw)) if path.endswith(".gz") else io.BufferedReader(raw) as stream:
            yield from itertools.islice(_stream_rows(stream, record_types, robots_only, archive), done, None)
    except _DAMAGE as ex:
        yield error_row(archive, ex)


def _stream_rows(stream: io.BufferedReader, record_types: tuple[str, ...], robots_only: bool, archive: str) -> Iterator[tuple]:
    for h, n in record_headers(stream):
        if is_wanted(h, record_types, robots_only):
            yield record_row(h, read_content(stream, n), archive)
        else:
            skip_content(stream, n)


def staged_paths(folder: str) -> list[tuple[str, str]]:
    """(file, archive name) lines of a path table, in order."""
    out = []
    for part in list_files(folder, suffixes=(".txt",)):
        with open_input(part) as f:
            out += [tuple(line.split("\t", 1)) for line in f.read().decode("utf-8").splitlines() if line]
    return sorted(out)


def packed(archives: list[tuple[str, str]], tasks: int, size: dict[str, int] | None = None) -> list[list[tuple[str, str]]]:
    """Runs of archives (file, name) of at most PARTITION_BYTES (a larger one
    alone), in ``tasks`` runs or more: small archives share a task."""
    size = size or file_sizes([f for f, _ in archives])
    most, out, held = -(-len(archives) // max(1, tasks)), [], 0
    for f, name in archives:
        if not out or len(out[-1]) >= most or held + size[f] > PARTITION_BYTES:
            out.append([])
            held = 0
        out[-1].append((f, name))
        held += size[f]
    return out


def read_packed(archives: list[tuple[str, str]], types: tuple[str, ...], robots_only: bool):
    """Arrow batches of the rows of some archives, one after the other."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = to_arrow_schema(WARC_SCHEMA)
    rows = itertools.chain.from_iterable(read_records(f, types, robots_only, name) for f, name in archives)
    while batch := list(itertools.islice(rows, BATCH_ROWS)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*batch), schema)], schema=schema)


class _WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        if "pathtable" in {k.lower() for k in options}:
            self.files = staged_paths(options["pathTable"])
        else:
            suffixes = tuple(options.get("suffixes", ".warc.gz,.warc").split(","))
            self.files = [(p, p) for p in list_files(options["path"], suffixes=suffixes)]
        self.size = file_sizes([f for f, _ in self.files])
        if "most_bytes" in {k.lower() for k in options}:
            self.files = [(f, a) for f, a in self.files if self.size[f] <= int(options["most_bytes"])]
        self.tasks = int(options.get("tasks", "64"))
        self.types = tuple(t.strip() for t in options.get("recordTypes", "response").split(","))
        self.robots_only = options.get("robotsOnly", "true").lower() == "true"

    def partitions(self):
        return [InputPartition(some) for some in packed(self.files, self.tasks, self.size)]

    def read(self, partition):
        if partition is not None:  # else there is no archive at all
            yield from read_packed(partition.value, self.types, self.robots_only)


class WarcDataSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return WARC_SCHEMA

    def reader(self, schema):
        return _WarcReader(self.options)


def register(spark: SparkSession) -> None:
    from crawlmeta.session import ship_package
    ship_package(spark)
    spark.dataSource.register(WarcDataSource)


def read_warc(spark: SparkSession, path: str | None = None, robots_only: bool = True, record_types: str = "response",
              path_table: str | None = None, split_bytes: int | None = SPLIT_BYTES) -> DataFrame:
    """Records of the archives under ``path``, or of the files that the lines
    (file, TAB, archive name) of ``path_table`` list; with ``robots_only``
    only robots.txt targets (exact check in the JVM after the reader's
    prefilter; archive-level error rows are kept). Archives of more than
    ``split_bytes`` are indexed and read by byte ranges (``warc_index``), the
    others by one task each."""
    from crawlmeta.functions.url import is_robots_target
    from crawlmeta.sources import warc_index
    register(spark)
    large = warc_index.archive_files(path, path_table, split_bytes) if split_bytes else []
    r = spark.read.format("warc").option("robotsOnly", str(robots_only).lower()).option("recordTypes", record_types)
    r = r.option("tasks", 4 * spark.sparkContext.defaultParallelism)
    if large:
        r = r.option("most_bytes", split_bytes)
    df = (r.option("pathTable", path_table) if path_table else r.option("path", path)).load()
    if large:
        types = tuple(t.strip() for t in record_types.split(","))
        index = warc_index.build_index(spark, large, work_folder(spark, "warc-index"))
        df = df.unionByName(warc_index.read_indexed(index, types, robots_only))
    if robots_only:
        df = df.filter(F.col("target_url").isNull() | is_robots_target("target_url"))
    return df


# --- writing (test corpora, exports) -----------------------------------------------

def _record(headers: list[tuple[str, str]], payload: bytes) -> bytes:
    head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers)
    head += f"Content-Length: {len(payload)}\r\n\r\n"
    return _gzip(head.encode("utf-8") + payload + b"\r\n\r\n")


def _records_bytes(rows: list[tuple[str, str, bytes, str]], first: bool = True, with_noise: bool = True) -> bytes:
    out = []
    for i, (url, date, body, enc) in enumerate(rows):
        if with_noise:
            out.append(_record([("WARC-Type", "request"), ("WARC-Target-URI", url), ("WARC-Date", date)],
                               f"GET {url} HTTP/1.1\r\n\r\n".encode()))
        http = b"HTTP/1.1 200 OK\r\nContent-Type: text/plain\r\n"
        plain, enc = enc.startswith("!"), enc.removeprefix("!")   # "!gzip": said to be gzip, but is not
        if enc:
            http += f"Content-Encoding: {enc}\r\n".encode()
        payload = http + b"\r\n" + (body if plain else encode_content(body, enc))
        out.append(_record([("WARC-Type", "response"), ("WARC-Target-URI", url), ("WARC-Date", date),
                            ("Content-Type", "application/http; msgtype=response")], payload))
        if with_noise and first and i == 0:
            other = url.rsplit("/", 1)[0] + "/index.html"
            out.append(_record([("WARC-Type", "response"), ("WARC-Target-URI", other), ("WARC-Date", date)],
                               b"HTTP/1.1 200 OK\r\n\r\n<html></html>"))
    return b"".join(out)


def warc_bytes(rows: list[tuple[str, str, bytes, str]], with_noise: bool = True) -> bytes:
    """A ``.warc.gz`` (one gzip member per record) from (target_url,
    capture_date, body, content_encoding) rows; with noise records (warcinfo,
    requests, a non-robots response) that readers must skip."""
    head = _record([("WARC-Type", "warcinfo"), ("Content-Type", "application/warc-fields")], b"software: crawlmeta\r\n")
    return head + _records_bytes(rows, first=True, with_noise=with_noise)


def write_warc_files(df: DataFrame, out_dir: str, archive_col: str = "archive_key",
                     files_per_key: int = 1) -> DataFrame:
    """Write rows as ``<archive_key>-<task>.warc.gz`` files under ``out_dir``
    (shared storage on a cluster). Rows are hash-partitioned by key (salted
    over ``files_per_key`` tasks, so a hot key is written by several tasks) into
    a number of tasks that does not follow the bytes, since packing short rows
    takes long; they are sorted and streamed: each task has one file open and appends one gzip
    member per record, so no group is collected in memory. A retried task
    rewrites exactly the files of its first attempt. Columns used:
    target_url, capture_date, body (string or binary), content_encoding.
    Returns (archive_path, records) per written file."""
    import pandas as pd
    from pyspark import TaskContext
    from pyspark.sql import functions as F

    from crawlmeta.session import ship_package
    ship_package(df.sparkSession)

    def write(batches):
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        out, current, done = None, None, []
        for pdf in batches:
            for key, part in pdf.groupby(archive_col, sort=True):
                if key != current:
                    if out:
                        out.close()
                    path = f"{out_dir.rstrip('/')}/{key}-{task:05d}.warc.gz"
                    out, current = open_output(path), key
                    out.write(warc_bytes([], with_noise=True))
                    done.append([path, 0])
                rows = [(r.target_url, r.capture_date,
                         r.body.encode("utf-8") if isinstance(r.body, str) else bytes(r.body), r.content_encoding)
                        for r in part.itertuples(index=False)]
                out.write(_records_bytes(rows, first=done[-1][1] == 0))
                done[-1][1] += len(rows)
        if out:
            out.close()
        yield pd.DataFrame(done, columns=["archive_path", "records"])

    cols = [archive_col, "target_url", "capture_date", "body", "content_encoding"]
    salt = F.pmod(F.xxhash64("target_url"), F.lit(files_per_key))
    tasks = max(WRITE_TASKS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    x = df.select(*cols).repartition(tasks, archive_col, salt).sortWithinPartitions(archive_col)
    return x.mapInPandas(write, "archive_path string, records long")
