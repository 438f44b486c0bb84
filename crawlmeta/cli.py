"""Command line: ``python -m crawlmeta <mode> ...`` (or ``spark-submit``).

Each mode calls the matching job function in ``crawlmeta.plans.jobs``; the
session comes from the environment (``spark-submit`` settings), or local
mode with ``--master``. Archive modes accept a folder of WARC archives or a
``*.paths.gz`` manifest (then ``--staging`` names the shared folder the
archives are fetched into; ``--skip-files`` / ``--max-files`` slice the
manifest). Classification modes need the suffix table (``--suffixes``).
"""

from __future__ import annotations

import argparse
import json
import sys

MODES = ["robots", "sitemaps", "country-sitemaps", "local-sitemaps", "filter-sitemaps", "local-country-sitemaps",
         "download-sitemaps", "publish-urls"]
ARCHIVE_MODES = {"robots", "sitemaps", "country-sitemaps"}
DOWNLOAD_MODES = ARCHIVE_MODES | {"download-sitemaps"}
SNAPSHOT_MODES = {"robots", "sitemaps", "filter-sitemaps"}
COUNTRY_MODES = {"country-sitemaps", "local-country-sitemaps"}
SUFFIX_MODES = COUNTRY_MODES | {"filter-sitemaps"}


def _positive(name: str):
    def f(v: str) -> int:
        try:
            n = int(v)
        except ValueError:
            raise argparse.ArgumentTypeError(f"{name} must be a positive integer") from None
        if n <= 0:
            raise argparse.ArgumentTypeError(f"{name} must be a positive integer")
        return n
    return f


def _non_negative(name: str):
    def f(v: str) -> int:
        try:
            n = int(v)
        except ValueError:
            raise argparse.ArgumentTypeError(f"{name} must be a non-negative integer") from None
        if n < 0:
            raise argparse.ArgumentTypeError(f"{name} must be a non-negative integer")
        return n
    return f


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="crawlmeta", description=__doc__.split("\n\n")[0])
    sub = p.add_subparsers(dest="mode", required=True)
    for mode in MODES:
        s = sub.add_parser(mode)
        s.add_argument("input", help="archives folder / manifest, robots tree, or TSV folder")
        s.add_argument("output", help="output folder (or table path for robots)")
        s.add_argument("--master", help="Spark master for local runs (default: from the environment)")
        if mode in ARCHIVE_MODES:
            s.add_argument("--max-files", type=_positive("--max-files"))
            s.add_argument("--skip-files", type=_non_negative("--skip-files"), default=0)
            s.add_argument("--staging", help="shared folder for archives fetched from a manifest")
        if mode in SUFFIX_MODES:
            s.add_argument("--suffixes", required=True, help="country suffix TSV (country_key, country_name, suffix)")
        if mode in COUNTRY_MODES:
            s.add_argument("--country", required=True, help="country key, name or suffix")
        if mode in SNAPSHOT_MODES:
            s.add_argument("--snapshots", action="store_true", help="write a snapshot table, replaced at once")
        if mode == "robots":
            s.add_argument("--export-files", help="also write one file per robots capture under this folder")
        if mode in DOWNLOAD_MODES:
            s.add_argument("--download-connect-timeout-seconds", type=_positive("--download-connect-timeout-seconds"),
                           default=10)
            s.add_argument("--download-read-timeout-seconds", type=_positive("--download-read-timeout-seconds"),
                           default=30)
            s.add_argument("--download-delay-seconds", type=_non_negative("--download-delay-seconds"), default=1)
        if mode == "download-sitemaps":
            s.add_argument("--max-depth", type=_non_negative("--max-depth"), default=20)
        if mode == "publish-urls":
            s.add_argument("--bootstrap-servers")
            s.add_argument("--topic")
            s.add_argument("--file-suffix", default=".sitemap-links.tsv")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    from pyspark.sql import SparkSession

    from crawlmeta.operators import geo
    from crawlmeta.plans import jobs
    b = SparkSession.builder.appName(f"crawlmeta-{args.mode}")
    if args.master:
        b = b.master(args.master)
    spark = b.getOrCreate()
    src = args.input
    pol = None
    if args.mode in DOWNLOAD_MODES:
        pol = jobs.FetchPolicy(args.download_connect_timeout_seconds, args.download_read_timeout_seconds,
                               args.download_delay_seconds)
    if args.mode in ARCHIVE_MODES and src.endswith(".paths.gz"):
        if not args.staging:
            raise SystemExit("--staging is required when the input is a manifest")
        src = jobs.stage_archives(spark, src, args.staging, args.skip_files, args.max_files, fetch_policy=pol)
    elif args.mode in ARCHIVE_MODES and (args.max_files or args.skip_files):
        raise SystemExit("--max-files / --skip-files apply to manifest inputs")
    dim = geo.load_suffixes(spark, args.suffixes) if args.mode in SUFFIX_MODES else None
    if args.mode == "robots":
        res = jobs.robots_job(spark, src, args.output, args.export_files, args.snapshots)
    elif args.mode == "sitemaps":
        res = jobs.sitemaps_job(spark, src, args.output, args.snapshots)
    elif args.mode == "country-sitemaps":
        res = jobs.country_sitemaps_job(spark, src, args.output, args.country, dim)
    elif args.mode == "local-sitemaps":
        res = jobs.local_sitemaps_job(spark, src, args.output)
    elif args.mode == "filter-sitemaps":
        res = jobs.filter_sitemaps_job(spark, src, args.output, dim, snapshots=args.snapshots)
    elif args.mode == "local-country-sitemaps":
        res = jobs.local_country_sitemaps_job(spark, src, args.output, args.country, dim)
    elif args.mode == "download-sitemaps":
        res = jobs.download_sitemaps_job(spark, src, args.output, max_depth=args.max_depth, fetch_policy=pol)
    else:
        res = jobs.publish_urls_job(spark, src, args.output, args.bootstrap_servers, args.topic, args.file_suffix)
    print(json.dumps(res.metrics, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
