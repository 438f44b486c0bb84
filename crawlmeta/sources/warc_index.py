"""An offset index of WARC archives: large archives become many tasks, and a
selection of records is read without the bytes of the others.

A ``.warc.gz`` is a series of gzip members without a table of contents, and a
member's length is only known when it has been inflated. The index is built by
all tasks at once: an archive is cut into ranges; a task looks for the first
member that starts in its range (the gzip magic, and a stream that begins with a
WARC header) and walks the members from there to the end of the range. Magic
bytes inside a member could fool it, so nothing is believed before the walks of
an archive fit together: the first starts at 0, each other one where the walk
before it ended, the last ends at the end of the file. By induction all of them
then are the one true series. An archive whose walks do not fit, or that is
damaged or packed otherwise (records across members), is marked and read from
its start by one task, with the rows and the error row that such reading gives.
An uncompressed ``.warc`` is walked by its content lengths, without reading bodies.

Index rows (``entries``): archive_path, file, offset, length (of the member),
record_no (in the member), record_type, target_url. ``read_indexed`` deals the
entries it needs to tasks by blocks of the files and reads members by range.
"""

from __future__ import annotations

import io
import itertools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crawlmeta.session import ship_package
from crawlmeta.sources.files import file_sizes, list_files, open_random
from crawlmeta.sources.warc import (
    BATCH_ROWS, WARC_SCHEMA, error_row, is_wanted, read_content, read_records, record_headers, record_row, skip_content,
    staged_paths)

#: Bytes of an archive that one task walks, and that one task reads later.
RANGE_BYTES = 32 << 20
#: Members of one block of a file are read by the same task.
BLOCK_BYTES = 4 << 20
_CHUNK = 256 << 10
_MAGIC = b"\x1f\x8b\x08"
_WALK = ("kind string, archive_path string, file string, size long, range_no int, first long, last long, "
         "offset long, length long, record_no int, record_type string, target_url string, error string")
_ROWS_PER_BATCH = 10_000
_DAMAGE = (OSError, EOFError, ValueError, zlib.error)


class Member(io.RawIOBase):
    """The inflated bytes of one gzip member; ``packed`` counts what it takes in the file."""

    def __init__(self, f, offset: int):
        self._f, self._inflate, self._at, self.packed = f, zlib.decompressobj(31), offset, 0

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        d = self._inflate
        while not d.eof:
            data = d.unconsumed_tail
            if not data:
                self._f.seek(self._at)
                data = self._f.read(_CHUNK)
                if not data:
                    raise EOFError("Compressed file ended before the end-of-stream marker was reached")
                self._at += len(data)
                self.packed += len(data)
            out = d.decompress(data, len(buffer))
            if d.eof:
                self.packed -= len(d.unused_data)
            if out:
                buffer[:len(out)] = out
                return len(out)
        return 0


def _first_member(f, a: int, b: int) -> int | None:
    """Where the first member that starts in [a, b) seems to start."""
    at, held = a, b""
    while at - len(held) < b:
        f.seek(at)
        data = held + f.read(_CHUNK)
        if len(data) < len(_MAGIC):
            return None
        base, i = at - len(held), -1
        while (i := data.find(_MAGIC, i + 1)) >= 0:
            if base + i >= b:
                return None
            try:
                f.seek(base + i)
                if zlib.decompressobj(31).decompress(f.read(4096), 5) == b"WARC/":
                    return base + i
            except zlib.error:
                pass
        at, held = base + len(data), data[-2:]
        if not data[len(held):]:
            return None
    return None


def _packed_records(f, at: int, end: int) -> Iterator[tuple]:
    """(offset, length, [headers]) of the members from ``at`` up to the first that starts at or after ``end``."""
    while at < end:
        member = Member(f, at)
        stream, heads = io.BufferedReader(member, _CHUNK), []
        for h, n in record_headers(stream):
            heads.append(h)
            skip_content(stream, n)
        if stream.read(1):
            raise ValueError("bytes after the last record of a member")
        if not heads:
            raise ValueError("a member without a record")
        yield at, member.packed, heads
        at += member.packed


def _plain_records(f, size: int) -> Iterator[tuple]:
    at = 0
    while at < size:
        f.seek(at)
        stream = io.BufferedReader(_Forward(f), 4096)
        for h, n in record_headers(stream):
            begin = at
            at = stream.tell() + n
            if at > size:
                raise ValueError("Truncated WARC record")
            yield begin, at - begin, [h]
            break
        else:
            return


class _Forward(io.RawIOBase):
    """A file for a buffered reader of headers; ``tell`` stays that of the file."""

    def __init__(self, f):
        self._f = f

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self._f.tell()

    def seek(self, at: int, whence: int = 0) -> int:
        return self._f.seek(at, whence)

    def readinto(self, buffer) -> int:
        data = self._f.read(len(buffer))
        buffer[:len(data)] = data
        return len(data)


def _walk(file: str, archive: str, size: int, range_no: int, a: int, b: int) -> Iterator[tuple]:
    """Record rows of the range, then the range's own row."""
    first, last, error = None, None, None
    about = (archive, file, size, range_no)
    try:
        with open_random(file) as f:
            if file.endswith(".gz"):
                first = 0 if a == 0 else _first_member(f, a, b)
                found = iter(()) if first is None else _packed_records(f, first, b)
            else:
                first, found = 0, _plain_records(f, size)
            last = first
            for offset, length, heads in found:
                for no, h in enumerate(heads):
                    yield ("record", *about, None, None, offset, length, no, h.get("warc-type", ""), h.get("warc-target-uri"), None)
                last = offset + length
            if not file.endswith(".gz"):  # what follows the last record is blank
                last = size
    except _DAMAGE as ex:
        error = f"{type(ex).__name__}: {ex}"
    yield ("range", *about, first, last, None, None, None, None, None, error)


def archive_files(path: str | None, path_table: str | None = None, more_than: int = -1) -> list[tuple[str, str, int]]:
    """(file, archive name, bytes) of the archives of more than so many bytes."""
    files = staged_paths(path_table) if path_table else [(p, p) for p in list_files(path, suffixes=(".warc.gz", ".warc"))]
    size = file_sizes([f for f, _ in files])
    return [(f, a, size[f]) for f, a in files if size[f] > more_than]


@dataclass
class WarcIndex:
    """``entries``: one row per record. ``whole``: archives (archive_path, file, size) that are read from their start."""

    entries: DataFrame
    whole: DataFrame


def build_index(spark: SparkSession, files: list[tuple[str, str, int]], folder: str,
                range_bytes: int = RANGE_BYTES) -> WarcIndex:
    """Walk the archives (file, name, bytes; see ``archive_files``) and keep what was found in ``folder``."""
    ship_package(spark)
    columns = [c.split(" ")[0] for c in _WALK.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = itertools.chain.from_iterable(
                _walk(r.file, r.archive_path, r.size, r.range_no, r.a, min(r.size, r.a + r.step)) for r in pdf.itertuples())
            while part := list(itertools.islice(rows, _ROWS_PER_BATCH)):
                yield pd.DataFrame(part, columns=columns).astype(
                    {c: "Int64" for c in ("first", "last", "offset", "length", "record_no")})

    # Only packed archives are walked by several tasks: the records of a plain one are found without reading them.
    given = spark.createDataFrame([(f, a, n, range_bytes if f.endswith(".gz") else max(n, 1)) for f, a, n in files],
                                  "file string, archive_path string, size long, step long")
    count = F.greatest(F.lit(1), F.ceil(F.col("size") / F.col("step"))).cast("int")
    ranges = given.select("*", F.explode(F.sequence(F.lit(0), count - 1)).alias("range_no")).withColumn(
        "a", F.col("range_no") * F.col("step"))
    n = sum(max(1, -(-size // range_bytes)) for _, _, size in files)
    ranges.repartition(max(1, min(n, 100_000)), "file", "range_no").mapInPandas(run, _WALK).write.partitionBy(
        "kind").parquet(f"{folder.rstrip('/')}/walk")
    return open_index(spark, folder)


def open_index(spark: SparkSession, folder: str) -> WarcIndex:
    """The index that ``build_index`` has left in ``folder``."""
    walk = spark.read.schema(_WALK).parquet(f"{folder.rstrip('/')}/walk")
    # One row per range here, not per record.
    order = Window.partitionBy("file", "archive_path").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    before = F.last("last", ignorenulls=True).over(order)
    fits = F.when(F.col("range_no") == 0, F.col("first") == 0).when(F.col("first").isNotNull(), F.col("first") == before).otherwise(
        before.isNotNull())
    ranges = walk.where("kind = 'range'").withColumn("fits", F.col("error").isNull() & F.coalesce(fits, F.lit(False)))
    archives = (ranges.groupBy("file", "archive_path", "size")
                .agg(F.bool_and("fits").alias("fits"), F.max("last").alias("end"))
                .withColumn("good", F.col("fits") & (F.col("end") == F.col("size")) & (F.col("size") > 0)))
    records = walk.where("kind = 'record'").join(archives.where("good").select("file", "archive_path"), ["file", "archive_path"], "left_semi")
    return WarcIndex(records.select("archive_path", "file", "offset", "length", "record_no", "record_type", "target_url"),
                     archives.where("NOT coalesce(good, false)").select("archive_path", "file", "size"))


def _batches(rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
    while part := list(itertools.islice(rows, BATCH_ROWS)):
        yield pd.DataFrame(part, columns=WARC_SCHEMA.names)


def _selected(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """Rows of index entries, ordered by file and offset."""
    f, opened = None, None
    for pdf in batches:
        for (file, archive, offset, length), part in pdf.groupby(["file", "archive_path", "offset", "length"], sort=False):
            try:
                if file != opened:
                    if f:
                        f.close()
                    f, opened = open_random(file), file
                if file.endswith(".gz"):
                    stream = io.BufferedReader(Member(f, int(offset)), _CHUNK)
                else:
                    f.seek(int(offset))
                    stream = io.BufferedReader(io.BytesIO(f.read(int(length))))
                wanted = set(part.record_no)
                for no, (h, n) in enumerate(record_headers(stream)):
                    if no in wanted:
                        yield record_row(h, read_content(stream, n), archive)
                    else:
                        skip_content(stream, n)
            except _DAMAGE as ex:
                yield error_row(archive, ex)
    if f:
        f.close()


def read_indexed(index: WarcIndex, record_types: tuple[str, ...] = ("response",), robots_only: bool = True,
                 where: Column | str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Records as ``read_warc`` gives them; ``where`` is a condition on the
    entries (record_type, target_url, ...) that saves the bytes of the others.
    Archives without a usable index are read whole; ``where`` on target_url or
    record_type holds for their rows too."""
    from crawlmeta.functions.url import is_robots_target
    spark = index.entries.sparkSession
    ship_package(spark)
    entries = index.entries.where(F.col("record_type").isin(list(record_types)))
    if robots_only:
        entries = entries.where(is_robots_target("target_url"))
    if where is not None:
        entries = entries.where(where)
    # The rows are short but stand for bytes of the archives: the number of tasks follows those.
    size = entries.select("file", "offset", "length").distinct().agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    dealt = (entries.repartition(max(1, -(-size // range_bytes)), "file", F.floor(F.col("offset") / min(BLOCK_BYTES, range_bytes)))
             .sortWithinPartitions("file", "archive_path", "offset", "record_no"))
    ranged = dealt.mapInPandas(lambda batches: _batches(_selected(batches)), WARC_SCHEMA)

    def run_whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                yield from _batches(row for row in read_records(r.file, record_types, robots_only, r.archive_path))

    n_whole = index.whole.count()
    if not n_whole:
        return ranged
    rest = index.whole.repartition(n_whole, "file").mapInPandas(run_whole, WARC_SCHEMA)
    if where is not None:
        rest = rest.where(F.col("error").isNotNull() & F.col("target_url").isNull() | (F.expr(where) if isinstance(where, str) else where))
    return ranged.unionByName(rest)
