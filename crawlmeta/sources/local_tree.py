"""Local robots.txt tree: ``<root>/**/<host>/<scheme>-<...>.txt`` files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def robots_rows(files: DataFrame, path_col: str = "path") -> DataFrame:
    """Row identity from the file path: host = parent folder name
    ('unknown-host' if none), scheme = file name before the first '-',
    lowercased ('unknown' if empty)."""
    p = F.regexp_replace(F.col(path_col), "^file:", "")
    parts = F.split(p, "/")
    name = F.element_at(parts, -1)
    parent = F.when(F.size(parts) >= 2, F.element_at(parts, -2))
    scheme = F.lower(F.substring_index(name, "-", 1))
    return files.select(
        p.alias("robots_file_path"),
        F.coalesce(F.nullif(parent, F.lit("")), F.lit("unknown-host")).alias("robots_host"),
        F.when(scheme == "", F.lit("unknown")).otherwise(scheme).alias("robots_scheme"),
        *[c for c in files.columns if c != path_col])


def read_robots_tree(spark: SparkSession, root: str) -> DataFrame:
    """Every regular ``*.txt`` file under ``root`` (recursive) with its bytes."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.txt").load(root).select("path", F.col("content").alias("body")))
    return robots_rows(files)
