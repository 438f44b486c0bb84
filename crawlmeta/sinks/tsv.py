"""TSV and grouped sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlmeta.functions.text import tsv_row
from crawlmeta.sinks.snapshots import SnapshotTable, is_table, read

COUNTRY_GROUP = "country"
LANGUAGE_REGION_GROUP = "language-region"


def tsv_lines(df: DataFrame, cols: list[str]) -> DataFrame:
    """One ``value`` line per row: fields with TAB/CR/LF made spaces, joined by TAB."""
    return df.select(tsv_row(*cols).alias("value"))


def write_tsv(df: DataFrame, cols: list[str], path: str, mode: str = "overwrite") -> None:
    tsv_lines(df, cols).write.mode(mode).text(path)


def grouped_rows(df: DataFrame) -> DataFrame:
    """Each classified row twice: once under its country key, once under its
    language-region (one pass, no union of two scans)."""
    groups = F.array(
        F.struct(F.lit(COUNTRY_GROUP).alias("out_group"), F.col("country_key").alias("out_key")),
        F.struct(F.lit(LANGUAGE_REGION_GROUP).alias("out_group"), F.col("language_region").alias("out_key")))
    return df.select("*", F.inline(groups))


def write_grouped(df: DataFrame, cols: list[str], path: str, snapshots: bool = False) -> None:
    """``out_group=<group>/out_key=<key>/part-*`` text files; a run replaces
    the whole output, so no group of an earlier run stays.

    Rows are rebalanced by group and key: a key that holds a third of all
    rows is split into files of the advisory size, small keys share tasks. With
    ``snapshots`` the output is a snapshot table, replaced at once."""
    out = grouped_rows(df).select("out_group", "out_key", tsv_row(*cols).alias("value"))
    if snapshots:
        SnapshotTable(df.sparkSession, path, ["out_group", "out_key"], "text").replace(out)
        return
    (out.hint("rebalance", "out_group", "out_key").write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy("out_group", "out_key").text(path))


def read_grouped(spark: SparkSession, path: str) -> DataFrame:
    if is_table(spark, path):
        return read(spark, path).select("value", "out_group", "out_key")
    return spark.read.schema("value string, out_group string, out_key string").text(path)
