"""TSV inputs between jobs: listing and strict / lenient row parsers.

Quotes are plain characters in these files, so lines are split on TAB
with ``split(value, '\\t', -1)`` (empty trailing fields kept), not read
with the CSV reader. Malformed rows are routed by a ``status`` column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlmeta.functions.text import tsv_fields
from crawlmeta.sinks import snapshots

# File suffixes of the three TSV kinds.
SITEMAPS_SUFFIX = ".sitemaps.tsv"
LINKS_SUFFIX = ".sitemap-links.tsv"

LOCAL_SITEMAP_COLUMNS = ["robots_file_path", "robots_host", "robots_scheme", "sitemap_url"]
CLASSIFIED_COLUMNS = LOCAL_SITEMAP_COLUMNS + ["country_key", "country_name", "matched_suffix", "language_region"]
WARC_SITEMAP_COLUMNS = ["archive_path", "capture_date", "robots_url", "sitemap_url"]
WARC_COUNTRY_COLUMNS = WARC_SITEMAP_COLUMNS + ["country_key", "country_name", "matched_suffix", "language_region"]
LINK_COLUMNS = ["seed_sitemap_url", "sitemap_url", "page_url"]


def read_lines(spark: SparkSession, root: str, suffix: str = SITEMAPS_SUFFIX) -> DataFrame:
    """All lines of files under ``root`` (recursive) whose name ends with
    ``suffix``; ``source_file`` names the file. Of a snapshot table, the
    lines of its newest version."""
    if snapshots.is_table(spark, root):
        return snapshots.read(spark, root).select("value", F.lit(root).alias("source_file"))
    return (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}")
            .text(root).select("value", F.col("_metadata.file_path").alias("source_file")))


def parse_local_sitemap_rows(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Strict: exactly 4 fields, host and sitemap URL non-empty."""
    f = tsv_fields(line_col)
    ok = (F.size(f) == 4) & (F.try_element_at(f, F.lit(2)) != "") & (F.try_element_at(f, F.lit(4)) != "")
    cols = [F.when(ok, F.try_element_at(f, F.lit(i + 1))).alias(c) for i, c in enumerate(LOCAL_SITEMAP_COLUMNS)]
    return lines.select("*", F.when(ok, "ok").otherwise("malformed").alias("status"), *cols)


def parse_seed_rows(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Lenient: at least 4 fields, the 4th non-empty; it is the seed URL."""
    f = tsv_fields(line_col)
    ok = (F.size(f) >= 4) & (F.try_element_at(f, F.lit(4)) != "")
    return lines.select("*", F.when(ok, "ok").otherwise("malformed").alias("status"),
                        F.when(ok, F.try_element_at(f, F.lit(4))).alias("seed_sitemap_url"))


def parse_link_rows(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """At least 3 fields, the 3rd non-empty; it is the page URL."""
    f = tsv_fields(line_col)
    ok = (F.size(f) >= 3) & (F.try_element_at(f, F.lit(3)) != "")
    return lines.select("*", F.when(ok, "ok").otherwise("malformed").alias("status"),
                        F.when(ok, F.try_element_at(f, F.lit(3))).alias("page_url"))


def list_inputs(root: str, suffix: str) -> list[str]:
    from crawlmeta.sources.files import list_files
    return list_files(root, suffixes=(suffix,))
