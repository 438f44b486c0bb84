"""Structured Streaming twins of the jobs.

The transforms are per row, so the batch and the stream share the same
DataFrame functions; a stream picks up new files, or new lines of a manifest, as
they land. Only ``first_seen`` keeps state: the published URLs, by key, until
they expire. ``available_now`` processes what is there and stops (the batch
equivalent, restartable from its checkpoint).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crawlmeta.functions.text import tsv_row
from crawlmeta.functions.url import is_robots_target, url_host
from crawlmeta.operators import geo, robots
from crawlmeta.sinks import kafka
from crawlmeta.sinks import tsv as tsv_sink
from crawlmeta.sources import manifest_stream, tsv
from crawlmeta.streaming.ledger import Ledger, Target


def _text_stream(spark: SparkSession, root: str, suffix: str, max_files_per_trigger: int | None) -> DataFrame:
    r = (spark.readStream.format("text").option("recursiveFileLookup", "true")
         .option("pathGlobFilter", f"*{suffix}"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(root)


def classified_groups(lines: DataFrame, dim: DataFrame) -> DataFrame:
    """TSV lines -> strict parse -> classification -> (out_group, out_key, value)."""
    ok = tsv.parse_local_sitemap_rows(lines).filter(F.col("status") == "ok")
    cls = geo.classify(ok, dim, "robots_host", "sitemap_url")
    return tsv_sink.grouped_rows(cls).select("out_group", "out_key",
                                             tsv_row(*tsv.CLASSIFIED_COLUMNS).alias("value"))


def filter_sitemaps_stream(spark: SparkSession, in_root: str, out_path: str, checkpoint: str, dim: DataFrame,
                           available_now: bool = True, max_files_per_trigger: int | None = None,
                           suffix: str = tsv.SITEMAPS_SUFFIX) -> StreamingQuery:
    """New ``*.sitemaps.tsv`` files -> classified rows under
    ``out_group=<group>/out_key=<key>/`` (exactly-once file sink)."""
    lines = _text_stream(spark, in_root, suffix, max_files_per_trigger)
    out = classified_groups(lines, dim)
    w = (out.writeStream.format("text").partitionBy("out_group", "out_key")
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start(out_path)


def archive_links_stream(spark: SparkSession, manifest: str, out_path: str, checkpoint: str, dim: DataFrame,
                         archive_root: str = "", available_now: bool = True) -> StreamingQuery:
    """Archives of a growing manifest -> robots captures -> classified links under
    ``out_group=<group>/out_key=<key>/`` as they are named, each archive once.
    What could not be read is a line under ``out_group=failed/out_key=archive/``."""
    records = manifest_stream.stream_archives(spark, manifest, archive_root)
    text = records.withColumn("text", robots.decode_body("body")).drop("body")
    caps = robots.with_sitemaps(text, body="text").where(F.col("error").isNotNull() | is_robots_target("target_url"))
    # One row per link, or one without a link per error: the archives are scanned once.
    links = F.when(F.col("error").isNotNull(), F.array(F.lit(None).cast("string"))).when(
        F.col("robots.valid"), F.array_distinct("robots.sitemaps"))
    rows = caps.select("archive_path", "capture_date", F.col("target_url").alias("robots_url"), "error",
                       F.coalesce(url_host("target_url"), F.lit("unknown-host")).alias("robots_host"),
                       F.explode(links).alias("sitemap_url"))
    cls = geo.classify(rows, dim, "robots_host", "sitemap_url", keep_unmatched=True)
    failed = F.struct(F.lit("failed").alias("out_group"), F.lit("archive").alias("out_key"), tsv_row(
        "archive_path", F.coalesce("robots_url", F.lit("archive")), "error").alias("value"))
    line = tsv_row(*tsv.WARC_COUNTRY_COLUMNS).alias("value")
    kept = F.array(F.struct(F.lit(tsv_sink.COUNTRY_GROUP).alias("out_group"), F.col("country_key").alias("out_key"), line),
                   F.struct(F.lit(tsv_sink.LANGUAGE_REGION_GROUP).alias("out_group"), F.col("language_region").alias("out_key"), line))
    groups = cls.select(F.inline(F.when(F.col("error").isNotNull(), F.array(failed)).when(F.col("country_key").isNotNull(), kept)))
    w = (groups.writeStream.format("text").partitionBy("out_group", "out_key")
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start(out_path)


def first_seen(urls: DataFrame, url_col: str, within: str) -> DataFrame:
    """Rows of a stream whose URL no earlier row had, as long as Spark's state
    remembers it: ``within`` after the batch that first had it. Time is that of the
    batch, so no row is ever late, and a restart goes on with the checkpointed state."""
    return (urls.withColumn("seen_at", F.current_timestamp()).withWatermark("seen_at", within)
            .dropDuplicatesWithinWatermark([url_col]).drop("seen_at"))


def publish_urls_stream(spark: SparkSession, in_root: str, checkpoint: str, out_path: str | None = None,
                        bootstrap: str | None = None, topic: str | None = None,
                        available_now: bool = True, suffix: str = tsv.LINKS_SUFFIX,
                        once_within: str | None = None) -> StreamingQuery:
    """New ``*.sitemap-links.tsv`` files -> ``{"url": ...}`` values, to Kafka
    when a server and topic are given, else to JSON-lines files. With
    ``once_within`` (an interval such as "30 days") a URL is not published again
    by a later batch, also after a restart, until that time has passed."""
    lines = _text_stream(spark, in_root, suffix, None)
    urls = tsv.parse_link_rows(lines).filter(F.col("status") == "ok").select("page_url")
    values = kafka.url_values(first_seen(urls, "page_url", once_within) if once_within else urls)
    w = values.writeStream.option("checkpointLocation", checkpoint)
    if bootstrap and topic:
        w = w.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic)
        for k, v in kafka.KAFKA_OPTIONS.items():
            w = w.option(k, v)
    else:
        w = w.format("text").option("path", out_path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def publish_with_ledger_stream(spark: SparkSession, in_root: str, checkpoint: str, ledger: Ledger, target: Target,
                               available_now: bool = True, suffix: str = tsv.LINKS_SUFFIX) -> StreamingQuery:
    """New link files -> records sent by ``target``, each once: the ledger
    knows what a batch has sent before it was cut off. Counters: ``ledger.totals()``."""
    lines = _text_stream(spark, in_root, suffix, None)
    ok = F.col("status") == "ok"
    rows = tsv.parse_link_rows(lines).select(
        "status", F.when(ok, F.to_json(F.struct(F.col("page_url").alias("url")))).alias("value"))

    def publish(batch: DataFrame, batch_id: int) -> None:
        ledger.publish(batch, batch_id, target, malformed_rows=F.count_if(F.col("status") == "malformed"))

    w = rows.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
