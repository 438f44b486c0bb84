from pyspark.sql import functions as F

from crawlmeta.operators import crawl as crawl_op
from crawlmeta.sources import corpus
from tests.conftest import SF0001, SF001


def totals(spark, sf_dir, max_depth=20):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    seeds = corpus.sitemap_seeds(pages)
    res = crawl_op.crawl(seeds, crawl_op.table_fetcher(corpus.sitemap_documents(pages)), max_depth=max_depth)
    v = res.visits.groupBy("status").count().collect()
    by = {r["status"]: r["count"] for r in v}
    return seeds.count(), by.get("parsed", 0), by.get("invalid", 0), by.get("failed", 0), res.links.count()


def test_golden_totals_sf0001(spark):
    # independent breadth-first simulation (FIXTURES.md): seeds, downloaded, invalid, failed, links
    assert totals(spark, SF0001) == (50, 627, 123, 20, 322)


def test_golden_totals_sf001(spark):
    assert totals(spark, SF001) == (250, 7585, 1465, 10, 3693)


def test_depth_limit_and_duplicate_seeds(spark):
    docs = spark.createDataFrame([
        ("https://s/i0.xml", "<sitemapindex><sitemap><loc>i1.xml</loc></sitemap>"
                             "<sitemap><loc>i0.xml</loc></sitemap></sitemapindex>"),
        ("https://s/i1.xml", "<sitemapindex><sitemap><loc>/u.xml</loc></sitemap></sitemapindex>"),
        ("https://s/u.xml", "https://p/1\nhttps://p/2\n"),
    ], "url string, body string")
    seeds = spark.createDataFrame([(1, "https://s/i0.xml"), (2, "https://s/i0.xml")], "seed_id long, seed_sitemap_url string")
    fetch = crawl_op.table_fetcher(docs)
    full = crawl_op.crawl(seeds, fetch)
    assert sorted((r["seed_id"], r["page_url"]) for r in full.links.collect()) == [
        (1, "https://p/1"), (1, "https://p/2"), (2, "https://p/1"), (2, "https://p/2")]
    shallow = crawl_op.crawl(seeds, fetch, max_depth=1)
    assert shallow.links.count() == 0
    assert shallow.visits.filter(F.col("seed_id") == 1).count() == 2


def test_shuffle_path_gives_same_totals(spark, monkeypatch):
    monkeypatch.setattr(crawl_op, "BROADCAST_BYTES", -1)
    assert totals(spark, SF0001) == (50, 627, 123, 20, 322)
