"""Per-unit result tables and run totals (counts as aggregations, never
driver loops)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def archive_results(caps: DataFrame, matched: DataFrame | None = None, robots: str = "robots") -> DataFrame:
    """Per archive: parsed (valid) and rejected captures and distinct sitemap
    links; with ``matched`` (classified link rows), the matched link count."""
    valid = F.col(robots)["valid"]
    out = caps.groupBy("archive_path").agg(
        F.count_if(valid).cast("long").alias("parsed_files"),
        F.count_if(~valid).cast("long").alias("rejected_files"),
        F.sum(F.when(valid, F.size(F.array_distinct(F.col(robots)["sitemaps"]))).otherwise(0)).cast("long")
        .alias("sitemap_links"))
    if matched is not None:
        m = matched.groupBy("archive_path").agg(F.count(F.lit(1)).cast("long").alias("matched_links"))
        out = out.join(m, "archive_path", "left").na.fill(0, ["matched_links"])
    return out


def totals(per_unit: DataFrame, *cols: str) -> dict:
    """Run totals over a per-unit table."""
    row = per_unit.agg(*[F.sum(c).cast("long").alias(c) for c in cols]).first()
    return {c: (row[c] or 0) for c in cols}
