"""Robots payload sink: valid captures as a table keyed by a generated
file name ``<host>/<scheme>-<date>-<digest16>.txt``, partitioned by
archive (a file per capture is not a Spark layout; ``export_files`` writes
that layout from the table when needed)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlmeta.functions.text import safe_path_part, sha256_hex16
from crawlmeta.functions.url import try_parse_url
from crawlmeta.session import dealt_listing, ship_package
from crawlmeta.sinks.snapshots import SnapshotTable
from crawlmeta.sources.files import delete_folder, open_output

#: Captures of an archive whose rows one file may hold.
ROWS_PER_FILE = 20_000


def robots_file_name(url: str, date: str, archive: str):
    host = F.lower(F.coalesce(F.nullif(try_parse_url(url, "HOST"), F.lit("")), F.lit("unknown-host")))
    scheme = F.coalesce(try_parse_url(url, "PROTOCOL"), F.lit("unknown"))
    digest = sha256_hex16(F.concat_ws("\n", F.col(url), F.col(date), F.col(archive)))
    return F.concat(safe_path_part(host), F.lit("/"), safe_path_part(scheme), F.lit("-"),
                    safe_path_part(F.col(date)), F.lit("-"), digest, F.lit(".txt"))


def archive_file_name(archive: str):
    return F.concat(F.lit("archive-"), sha256_hex16(archive), F.lit(".sitemaps.tsv"))


def with_file_name(captures: DataFrame) -> DataFrame:
    return captures.withColumn("file_name", robots_file_name("target_url", "capture_date", "archive_path"))


def write_by_archive(df: DataFrame, path: str, done: DataFrame, form: str = "parquet", snapshots: bool = False) -> None:
    """Write rows under ``archive_file=<name>/``: a second run replaces the
    archives it has processed (``done``: archive_path and its captures, ``rows``)
    and no others; archives that have no rows now lose their old ones, by tasks
    too. The files of many small archives take long and few bytes, so the number
    of tasks follows the captures and the cluster; an archive of more than
    ROWS_PER_FILE captures is written by several tasks."""
    spark = df.sparkSession
    held = done.agg(F.sum("rows").alias("rows")).first()["rows"] or 0
    places = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    tasks = max(places, -(-held // ROWS_PER_FILE))
    large = done.where(F.col("rows") > ROWS_PER_FILE).select("archive_path", F.ceil(F.col("rows") / ROWS_PER_FILE).alias("files"))
    dealt = df.join(F.broadcast(large), "archive_path", "left").repartition(
        tasks, "archive_path", F.when(F.col("files") > 1, F.pmod(F.xxhash64(*df.columns), "files")).otherwise(0)).select(*df.columns)
    named = dealt.withColumn("archive_file", archive_file_name("archive_path"))
    if form == "text":
        named = named.select("archive_file", "value")
    if snapshots:
        SnapshotTable(spark, path, ["archive_file"], form).replace(
            named, done.select(archive_file_name("archive_path").alias("archive_file")), dealt=True)
        return
    (named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("archive_file").format(form).save(path))
    empty = done.select("archive_path").join(df.select("archive_path").distinct(), "archive_path", "left_anti")
    base = path.rstrip("/")
    ship_package(spark)

    def delete(rows):
        for r in rows:
            delete_folder(f"{base}/archive_file={r['f']}")

    empty.select(archive_file_name("archive_path").alias("f")).repartition(places, "f").foreachPartition(delete)


def read_by_archive(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """The rows of ``write_by_archive`` without ``snapshots``."""
    with dealt_listing(spark):
        return spark.read.format(form).load(path)


def export_files(df: DataFrame, root: str, text_col: str = "text") -> None:
    """One UTF-8 file per row at ``<root>/<file_name>`` (same name replaces).
    A row stands for a file to be made, so the number of tasks is that of the
    cluster and not of the bytes read."""
    base = root.rstrip("/")
    spark = df.sparkSession
    ship_package(spark)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)

    def write(rows):
        for r in rows:
            with open_output(f"{base}/{r['file_name']}") as f:
                f.write((r[text_col] or "").encode("utf-8"))

    df.select("file_name", text_col).repartition(n, "file_name").foreachPartition(write)
