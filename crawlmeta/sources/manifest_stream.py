"""A growing archive manifest as a streaming source.

``readStream.format("warc_manifest").option("manifest", file)`` gives the records
of every archive that the manifest names, each archive once, as lines are
appended to it. The offset is a position in the manifest: the number of lines
that have been taken, with a running CRC of them. A micro-batch reads the
archives between two positions in input partitions of whole archives; a restarted query goes on at its
checkpointed position. Small archives share a partition. The manifest may only grow: when the lines before the
position are no longer those that were taken, the query stops with an error
instead of skipping or repeating archives.

Line rules are those of the batch manifest scan: trimmed, no empty and no ``#``
lines, ``/robotstxt/`` inside and ``.warc.gz`` at the end. A last line without a
line end is still being written and waits. Relative paths are taken below the
option ``archiveRoot``. The manifest (plain or gzip) is read on the driver, a
hundred bytes per archive; archives are read by tasks, error rows as in ``warc``.
"""

from __future__ import annotations

import gzip
import re
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from crawlmeta.session import ship_package
from crawlmeta.sources.files import open_input
from crawlmeta.sources.warc import WARC_SCHEMA, packed, read_packed

# Characters that are trimmed off a line.
_TRIMMED = "".join(map(chr, range(33)))
_ABSOLUTE = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*:|/")


def manifest_lines(path: str) -> list[str]:
    """Complete lines; none while the manifest does not exist."""
    try:
        with open_input(path) as f:
            data = f.read()
    except FileNotFoundError:
        return []
    text = (gzip.decompress(data) if path.endswith(".gz") else data).decode("utf-8", "replace")
    return text.split("\n")[:-1]


def position(lines: list[str], n: int) -> dict:
    return {"lines": n, "crc": zlib.crc32("\n".join(lines[:n]).encode("utf-8")) if n else 0}


def is_archive_line(line: str) -> bool:
    return bool(line) and not line.startswith("#") and "/robotstxt/" in line and line.endswith(".warc.gz")


class _ManifestReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.manifest = options["manifest"]
        self.root = options.get("archiveRoot", "").rstrip("/")
        self.tasks = int(options.get("tasks", "64"))
        self.types = tuple(t.strip() for t in options.get("recordTypes", "response").split(","))
        self.robots_only = options.get("robotsOnly", "true").lower() == "true"

    def initialOffset(self) -> dict:
        return position([], 0)

    def latestOffset(self) -> dict:
        lines = manifest_lines(self.manifest)
        return position(lines, len(lines))

    def partitions(self, start: dict, end: dict):
        lines = manifest_lines(self.manifest)
        for at in (start, end):
            if position(lines, at["lines"]) != at:
                raise ValueError(f"{self.manifest}: the lines before position {at['lines']} have changed")
        names = [line.strip(_TRIMMED) for line in lines[start["lines"]:end["lines"]]]
        return [InputPartition(some) for some in packed(
            [(n if _ABSOLUTE.match(n) else f"{self.root}/{n}", n) for n in names if is_archive_line(n)], self.tasks)]

    def read(self, partition):
        yield from read_packed(partition.value, self.types, self.robots_only)


class ManifestDataSource(DataSource):
    @classmethod
    def name(cls):
        return "warc_manifest"

    def schema(self):
        return WARC_SCHEMA

    def streamReader(self, schema):
        return _ManifestReader(self.options)


def stream_archives(spark: SparkSession, manifest: str, archive_root: str = "", robots_only: bool = True) -> DataFrame:
    """Records of the manifest's archives as a stream."""
    ship_package(spark)
    spark.dataSource.register(ManifestDataSource)
    return (spark.readStream.format("warc_manifest").option("manifest", manifest).option("archiveRoot", archive_root)
            .option("tasks", 4 * spark.sparkContext.defaultParallelism).option("robotsOnly", str(robots_only).lower()).load())
