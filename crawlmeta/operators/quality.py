"""Quality report: what robots files warn about, as mergeable sketches.

One pass over the parsed captures of an archive gives two small tables that can
be kept beside its output; reports over any set of archives, or per host or
group of hosts, are merges of these rows and never read captures again.

* ``file_sketches``: files, rejected files, warnings (exact), and a KLL sketch of
  the warnings per file. With the parameter 200 a quantile's rank is off by at
  most ``RANK_ERROR`` of the files (99 % confidence).
* ``kind_sketches``: per kind of warning the number (exact) and an HLL sketch of
  the distinct messages, with the relative standard error ``DISTINCT_ERROR``.

Sketches have a bounded size whatever the number of files and messages; partial
aggregation makes them before the shuffle, so a host with a third of all files is
one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KLL_K, HLL_LG = 200, 12
RANK_ERROR = 0.0133
DISTINCT_ERROR = 1.04 / 2 ** (HLL_LG / 2)


def warning_kind(message: Column) -> Column:
    """The words of a warning before its value: ``Invalid crawl-delay value``."""
    return F.regexp_extract(message, "^[A-Za-z-]+(?: [a-z-]+)*", 0)


def file_sketches(parsed: DataFrame, by: list[str], robots: str = "robots") -> DataFrame:
    n = F.size(F.col(robots)["warnings"]).cast("long")
    return parsed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("files"), F.count_if(~F.col(robots)["valid"]).alias("rejected_files"),
        F.sum(n).alias("warnings"), F.kll_sketch_agg_bigint(n, KLL_K).alias("per_file"))


def kind_sketches(parsed: DataFrame, by: list[str], robots: str = "robots") -> DataFrame:
    rows = parsed.select(*by, F.explode(F.col(robots)["warnings"]["message"]).alias("message"))
    return rows.groupBy(*by, warning_kind(F.col("message")).alias("kind")).agg(
        F.count(F.lit(1)).alias("warnings"), F.hll_sketch_agg("message", HLL_LG).alias("messages"))


def merged_files(sketches: DataFrame, by: list[str]) -> DataFrame:
    return sketches.groupBy(*by).agg(
        F.sum("files").alias("files"), F.sum("rejected_files").alias("rejected_files"), F.sum("warnings").alias("warnings"),
        F.kll_merge_agg_bigint("per_file", KLL_K).alias("per_file"))


def merged_kinds(sketches: DataFrame, by: list[str]) -> DataFrame:
    return sketches.groupBy(*by, "kind").agg(F.sum("warnings").alias("warnings"), F.hll_union_agg("messages").alias("messages"))


def file_report(merged: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """The merged rows with a column of warnings per file for each named quantile."""
    return merged.withColumns({name: F.kll_sketch_get_quantile_bigint("per_file", F.lit(q))
                               for name, q in quantiles.items()}).drop("per_file")


def kind_report(merged: DataFrame) -> DataFrame:
    return merged.withColumn("distinct_messages", F.hll_sketch_estimate("messages")).drop("messages")
