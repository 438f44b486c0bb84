"""The batch jobs, one function per mode.

Each job is a DataFrame plan (transforms from ``operators``/``sources``)
ending in one write; its counters are gathered with ``DataFrame.observe``
in the same pass as the write. Archives are scanned once: what was parsed,
and what failed, is a table in the shared folder from which outputs, counts
and failures are read. Work units that fail (unreadable archive, undecodable
body, failed fetch) become rows of a failures table beside the output; the
job finishes all other work and then raises ``JobFailed`` with their number
and that table's path.

  robots                  WARC archives -> valid robots files (table / files)
  sitemaps                WARC archives -> (archive, date, robots URL, sitemap URL)
  country_sitemaps        WARC archives -> one-country classified links
  local_sitemaps          local robots tree -> (file, host, scheme, sitemap URL)
  filter_sitemaps         *.sitemaps.tsv -> country=*/ and language-region=*/ groups
  local_country_sitemaps  *.sitemaps.tsv -> one-country classified rows
  download_sitemaps       *.sitemaps.tsv seeds -> crawl -> *.sitemap-links.tsv
  publish_urls            *.sitemap-links.tsv -> {"url": ...} records

With ``snapshots`` the robots, sitemaps and filter jobs write snapshot tables
(``sinks.snapshots``): a reader sees all rows of a run or none of them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from crawlmeta.functions import policy
from crawlmeta.functions.text import tsv_row
from crawlmeta.functions.url import is_robots_target, url_host
from crawlmeta.operators import crawl as crawl_op
from crawlmeta.operators import geo, robots
from crawlmeta.operators import metrics as metrics_op
from crawlmeta.session import work_folder
from crawlmeta.sinks import kafka, robots_files
from crawlmeta.sinks import snapshots as snapshot_tables
from crawlmeta.sinks import tsv as tsv_sink
from crawlmeta.sources import fetch as fetch_src
from crawlmeta.sources import local_tree, manifest, tsv, warc
from crawlmeta.sources.files import count_empty


#: Archives that one task fetches, when there are more than the cluster has places for.
ARCHIVES_PER_TASK = 64


class JobFailed(RuntimeError):
    pass


@dataclass
class JobResult:
    metrics: dict = field(default_factory=dict)
    failures: int = 0
    failure_table: str | None = None     # text lines, one per failure
    per_unit: DataFrame | None = None    # e.g. per-archive results (lazy)

    def raise_if_failed(self, what: str) -> "JobResult":
        if self.failures:
            raise JobFailed(f"{self.failures} {what} failed, listed in {self.failure_table}")
        return self


@dataclass
class FetchPolicy:
    connect_timeout_s: int = policy.DEFAULT_CONNECT_TIMEOUT_S
    read_timeout_s: int = policy.DEFAULT_READ_TIMEOUT_S
    delay_s: int = policy.DEFAULT_DELAY_S
    partitions: int | None = None        # fetch tasks of a level; None: the session's parallelism
    host_spread: int = 1                 # tasks that may ask one host at a time

    def __post_init__(self):
        if self.connect_timeout_s <= 0 or self.read_timeout_s <= 0:
            raise ValueError("timeouts must be > 0")
        if self.delay_s < 0:
            raise ValueError("delay must be >= 0")


def _check_slice(skip: int, max_files: int | None) -> None:
    if skip < 0:
        raise ValueError("skip must be >= 0")
    if max_files is not None and max_files <= 0:
        raise ValueError("max files must be > 0")


# --- archives -----------------------------------------------------------------------

def stage_archives(spark: SparkSession, manifest_path: str, dest_dir: str, skip: int = 0,
                   max_files: int | None = None, allow_local: bool = True,
                   fetch_policy: FetchPolicy | None = None) -> Archives:
    """Manifest -> archive URIs (slice applied after the path filter) ->
    each archive streamed into ``dest_dir`` (shared storage) by one task,
    never held in memory; of many archives, a task takes about ARCHIVES_PER_TASK. File names are content hashes, so a retried task
    overwrites its own file. The result's path table keeps the manifest path
    of every staged file; archives that could not be fetched are failures of
    the job that reads it, not of this step."""
    _check_slice(skip, max_files)
    from crawlmeta.session import ship_package
    ship_package(spark)
    pol = fetch_policy or FetchPolicy()
    lines = manifest.read_manifest_lines(spark, manifest.resolve_manifest_path(manifest_path))
    paths = manifest.with_archive_uri(manifest.slice_archives(manifest.archive_paths(lines), skip, max_files))
    folder = work_folder(spark, "archives")
    paths.write.parquet(f"{folder}/paths")
    paths = spark.read.parquet(f"{folder}/paths")
    import hashlib

    import pandas as pd
    base = dest_dir.rstrip("/")

    def store(batches):
        for pdf in batches:
            out = []
            for uri, archive in zip(pdf["archive_uri"], pdf["archive_path"]):
                name = uri.rstrip("/").rsplit("/", 1)[-1]
                digest = hashlib.sha256(uri.encode("utf-8")).hexdigest()[:16]
                _, path, error = fetch_src.download_to(uri, f"{base}/{digest}-{name}", allow_local=allow_local,
                                                       connect_timeout=pol.connect_timeout_s,
                                                       read_timeout=pol.read_timeout_s, delay=pol.delay_s)
                out.append((archive, path, error))
            yield pd.DataFrame(out, columns=["archive_path", "local_path", "error"])

    n = paths.count()
    tasks = max(1, min(n, max(4 * spark.sparkContext.defaultParallelism, -(-n // ARCHIVES_PER_TASK))))
    stored = (paths.select("archive_uri", "archive_path").repartition(tasks, "archive_uri")
              .mapInPandas(store, "archive_path string, local_path string, error string"))
    stored.write.parquet(f"{folder}/stored")
    stored = spark.read.parquet(f"{folder}/stored")
    (stored.where("local_path IS NOT NULL").select(F.concat_ws("\t", "local_path", "archive_path").alias("value"))
     .write.text(f"{folder}/table"))
    return Archives(path_table=f"{folder}/table", failed=stored.where("local_path IS NULL").select(
        "archive_path", "error"))


@dataclass
class Archives:
    """What an archive job reads: a path, or the path table of staged files."""

    path: str | None = None
    path_table: str | None = None
    failed: DataFrame | None = None      # archive_path, error of archives that were not fetched


def _captures(spark: SparkSession, archives: str | Archives, keep_text: bool = False) -> DataFrame:
    """Parsed robots captures and error rows of WARC archives, scanned once
    and written to the shared folder."""
    src = archives if isinstance(archives, Archives) else Archives(path=archives)
    w = warc.read_warc(spark, src.path, path_table=src.path_table)
    if src.failed is not None:
        w = w.unionByName(src.failed, allowMissingColumns=True)
    parsed = robots.with_sitemaps(w.withColumn("text", robots.decode_body("body")).drop("body"), body="text")
    path = f"{work_folder(spark, 'captures')}/captures"
    (parsed if keep_text else parsed.drop("text")).write.parquet(path)
    return spark.read.parquet(path)


def _ok(captures: DataFrame) -> DataFrame:
    return captures.where(F.col("error").isNull() & (F.col("record_type") == "response") & is_robots_target("target_url"))


def _finish(captures: DataFrame, out: str, metrics: dict, per_unit: DataFrame) -> JobResult:
    """List the failures beside the output, then raise if there are any."""
    table = f"{out.rstrip('/')}-failures"
    (captures.where(F.col("error").isNotNull()).select(
        F.translate(F.concat_ws(": ", "archive_path", F.coalesce("target_url", F.lit("archive")), "error"),
        "\r\n", "  ").alias("value")).write.mode("overwrite").text(table))
    failures = captures.sparkSession.read.text(table).count()
    return JobResult(metrics, failures, table, per_unit).raise_if_failed("archives or captures")


def _per_archive(captures: DataFrame) -> DataFrame:
    return captures.groupBy("archive_path").agg(F.count(F.lit(1)).alias("rows"))


def robots_job(spark: SparkSession, archives: str | Archives, out_table: str, export_root: str | None = None,
               snapshots: bool = False) -> JobResult:
    found = _captures(spark, archives, keep_text=True)
    caps = _ok(found)
    table = robots_files.with_file_name(caps.where(F.col("robots.valid"))).select(
        "file_name", "archive_path", "capture_date", "target_url", "text")
    robots_files.write_by_archive(table, out_table, _per_archive(found), snapshots=snapshots)
    if export_root:
        saved = snapshot_tables.read(spark, out_table) if snapshots else robots_files.read_by_archive(spark, out_table)
        robots_files.export_files(saved, export_root)
    per_unit = metrics_op.archive_results(caps)
    counts = metrics_op.totals(per_unit, "parsed_files", "rejected_files")
    return _finish(found, out_table, {"saved_files": counts["parsed_files"], "rejected_files": counts["rejected_files"]}, per_unit)


def sitemap_rows_from_captures(caps: DataFrame) -> DataFrame:
    s = caps.filter(F.col("robots.valid")).select(
        "archive_path", "capture_date", F.col("target_url").alias("robots_url"),
        F.explode(F.array_distinct("robots.sitemaps")).alias("sitemap_url"))
    return s


def sitemaps_job(spark: SparkSession, archives: str | Archives, out_path: str, snapshots: bool = False) -> JobResult:
    found = _captures(spark, archives)
    caps = _ok(found)
    per_unit = metrics_op.archive_results(caps)
    rows = sitemap_rows_from_captures(caps).select("archive_path", tsv_row(*tsv.WARC_SITEMAP_COLUMNS).alias("value"))
    robots_files.write_by_archive(rows, out_path, _per_archive(found), "text", snapshots)
    return _finish(found, out_path, metrics_op.totals(per_unit, "parsed_files", "rejected_files", "sitemap_links"), per_unit)


def _one_country(spark: SparkSession, dim: DataFrame, country: str) -> DataFrame:
    if not country or not country.strip():
        raise ValueError("country mode requires a country key, country name, or suffix")
    return geo.country_dimension(dim, geo.resolve_country(spark, dim, country))


def country_sitemaps_job(spark: SparkSession, archives: str | Archives, out_path: str, country: str,
                         dim: DataFrame) -> JobResult:
    one = _one_country(spark, dim, country)
    found = _captures(spark, archives)
    caps = _ok(found)
    rows = sitemap_rows_from_captures(caps).withColumn(
        "robots_host", F.coalesce(url_host("robots_url"), F.lit("unknown-host")))
    cls = geo.classify(rows, one, "robots_host", "sitemap_url")
    obs = Observation("country")
    tsv_sink.write_tsv(cls.observe(obs, F.count(F.lit(1)).alias("matched_links")), tsv.WARC_COUNTRY_COLUMNS, out_path)
    counts = metrics_op.totals(metrics_op.archive_results(caps), "parsed_files", "rejected_files")
    return _finish(found, out_path, {**counts, **dict(obs.get)}, metrics_op.archive_results(caps, cls))


def local_sitemaps_job(spark: SparkSession, root: str, out_path: str) -> JobResult:
    files = local_tree.read_robots_tree(spark, root).withColumn("text", robots.decode_body("body")).drop("body")
    parsed = robots.with_sitemaps(files, body="text")
    valid = F.col("robots.valid")
    obs = Observation("local")
    parsed = parsed.observe(obs, F.count_if(valid).alias("parsed_files"), F.count_if(~valid).alias("rejected_files"))
    rows = parsed.filter(valid).select("robots_file_path", "robots_host", "robots_scheme",
                                       F.explode(F.array_distinct("robots.sitemaps")).alias("sitemap_url"))
    tsv_sink.write_tsv(rows, tsv.LOCAL_SITEMAP_COLUMNS, out_path)
    counts = dict(obs.get)
    counts["rejected_files"] += count_empty(root, ".txt")
    return JobResult(counts)


def _filter_input(spark: SparkSession, in_root: str, suffix: str = tsv.SITEMAPS_SUFFIX) -> tuple[DataFrame, Observation]:
    lines = tsv.parse_local_sitemap_rows(tsv.read_lines(spark, in_root, suffix))
    obs = Observation("filter")
    lines = lines.observe(obs, F.count_if(F.col("status") == "ok").alias("read_rows"),
                          F.count_if(F.col("status") == "malformed").alias("malformed_rows"))
    return lines.filter(F.col("status") == "ok"), obs


def filter_sitemaps_job(spark: SparkSession, in_root: str, out_path: str, dim: DataFrame,
                        suffix: str = tsv.SITEMAPS_SUFFIX, snapshots: bool = False) -> JobResult:
    rows, obs = _filter_input(spark, in_root, suffix)
    kept = Observation("kept")
    cls = geo.classify(rows, dim, "robots_host", "sitemap_url").observe(kept, F.count(F.lit(1)).alias("kept_rows"))
    tsv_sink.write_grouped(cls, tsv.CLASSIFIED_COLUMNS, out_path, snapshots)
    return JobResult({**dict(obs.get), **dict(kept.get)})


def local_country_sitemaps_job(spark: SparkSession, in_root: str, out_path: str, country: str,
                               dim: DataFrame, suffix: str = tsv.SITEMAPS_SUFFIX) -> JobResult:
    one = _one_country(spark, dim, country)
    rows, obs = _filter_input(spark, in_root, suffix)
    cls = geo.classify(rows, one, "robots_host", "sitemap_url")
    kept = Observation("kept")
    cls = cls.observe(kept, F.count(F.lit(1)).alias("kept_rows"))
    tsv_sink.write_tsv(cls, tsv.CLASSIFIED_COLUMNS, out_path)
    return JobResult({**dict(obs.get), **dict(kept.get)})


def download_sitemaps_job(spark: SparkSession, in_root: str, out_path: str,
                          fetcher: Callable[[DataFrame], DataFrame] | None = None,
                          max_depth: int = crawl_op.MAX_SITEMAP_INDEX_DEPTH,
                          fetch_policy: FetchPolicy | None = None, allow_local: bool = False) -> JobResult:
    """Seeds = 4th field of any TSV row shape; each seed row is crawled
    (depth <= max_depth) and every page URL becomes (seed, sitemap, page)."""
    pol = fetch_policy or FetchPolicy()
    lines = tsv.parse_seed_rows(tsv.read_lines(spark, in_root, tsv.SITEMAPS_SUFFIX))
    obs = Observation("seeds")
    lines = lines.observe(obs, F.count_if(F.col("status") == "ok").alias("read_rows"),
                          F.count_if(F.col("status") == "malformed").alias("malformed_rows"))
    path = f"{work_folder(spark, 'seeds')}/seeds"
    lines.filter(F.col("status") == "ok").select(
        F.monotonically_increasing_id().alias("seed_id"), "seed_sitemap_url").write.parquet(path)
    seeds = spark.read.parquet(path)
    counts = dict(obs.get)
    if fetcher is None:
        fetcher = crawl_op.body_fetcher(lambda urls: fetch_src.fetch(
            urls, allow_local=allow_local, delay=pol.delay_s, connect_timeout=pol.connect_timeout_s,
            read_timeout=pol.read_timeout_s, partitions=pol.partitions, host_spread=pol.host_spread).select("url", "body"))
    res = crawl_op.crawl(seeds, fetcher, max_depth=max_depth)
    saved = Observation("links")
    tsv_sink.write_tsv(res.links.observe(saved, F.count(F.lit(1)).alias("saved_links")),
                       tsv.LINK_COLUMNS[:1] + ["sitemap_url", "page_url"], out_path)
    tot = res.visits.agg(
        F.count_if(F.col("status") == crawl_op.STATUS_PARSED).alias("downloaded_sitemaps"),
        F.count_if(F.col("status") == crawl_op.STATUS_INVALID).alias("invalid_sitemaps"),
        F.count_if(F.col("status") == crawl_op.STATUS_FAILED).alias("failed_downloads")).first().asDict()
    return JobResult({**counts, **tot, "saved_links": saved.get["saved_links"]})


def publish_urls_job(spark: SparkSession, in_root: str, out: str, bootstrap: str | None = None,
                     topic: str | None = None, suffix: str = tsv.LINKS_SUFFIX) -> JobResult:
    """Page URLs of link TSVs as ``{"url": ...}`` records: to Kafka when a
    bootstrap server and topic are given, else as JSON-lines files."""
    lines = tsv.parse_link_rows(tsv.read_lines(spark, in_root, suffix))
    obs = Observation("publish")
    lines = lines.observe(obs, F.count(F.lit(1)).alias("rows"),
                          F.count_if(F.col("status") == "malformed").alias("malformed_rows"))
    values = kafka.url_values(lines.filter(F.col("status") == "ok"))
    if bootstrap and topic:
        kafka.write_kafka(values, bootstrap, topic)
    else:
        kafka.write_json_lines(values, out)
    m = dict(obs.get)
    m["files"] = len(tsv.list_inputs(in_root, suffix))
    m["sent_urls"] = m.get("rows", 0) - m.get("malformed_rows", 0)
    return JobResult(m)
