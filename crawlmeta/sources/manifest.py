"""Crawl manifest (``*.paths.gz``) scan: archive paths in file order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlmeta.functions.text import java_trim
from crawlmeta.functions.url import archive_uri, manifest_url  # noqa: F401  (re-export)


def resolve_manifest_path(path: str) -> str:
    """A ``.../wat.paths.gz`` manifest path points at ``.../robotstxt.paths.gz``."""
    import re
    return re.sub(r"/wat[.]paths[.]gz$", "/robotstxt.paths.gz", path)


def read_manifest_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line_no, value)``; gzip is decompressed by suffix. A gzip file is
    one split, so increasing ids follow file order."""
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), "value")


def archive_paths(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Trimmed lines that are not empty or comments and name a robots.txt
    WARC archive (``/robotstxt/`` in the path, ``.warc.gz`` at the end)."""
    t = java_trim(line_col)
    return (lines.withColumn("archive_path", t)
            .filter((F.col("archive_path") != "") & ~F.col("archive_path").startswith("#")
                    & F.col("archive_path").contains("/robotstxt/") & F.col("archive_path").endswith(".warc.gz"))
            .drop(line_col))


def slice_archives(paths: DataFrame, skip: int = 0, max_files: int | None = None,
                   order_col: str = "line_no") -> DataFrame:
    """Skip the first ``skip`` matching archives, then keep ``max_files``."""
    if skip < 0:
        raise ValueError("skip must be >= 0")
    if max_files is not None and max_files <= 0:
        raise ValueError("max_files must be > 0")
    out = paths.orderBy(order_col)
    if skip:
        out = out.offset(skip)
    if max_files is not None:
        out = out.limit(max_files)
    return out


def with_archive_uri(paths: DataFrame) -> DataFrame:
    return paths.withColumn("archive_uri", archive_uri("archive_path"))
