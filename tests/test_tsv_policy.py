import glob
import itertools

from pyspark.sql import functions as F

from crawlmeta.functions import policy
from crawlmeta.functions.text import tsv_row
from crawlmeta.sinks import tsv as tsv_sink
from crawlmeta.sources import tsv

BAD = ["\t", "\r", "\n"]


def test_fields_never_hold_separators(spark):
    rows = [tuple(f"{x}{a}{y}" for x, y in (("k", "1"), ("m", "2"), ("", ""))) + (None,) for a in [*BAD, "".join(BAD), ""]]
    df = spark.createDataFrame(rows, "p string, q string, r string, s string")
    for row, got in zip(rows, df.select(tsv_row("p", "q", "r", "s").alias("v")).collect()):
        assert got.v.split("\t") == [(x or "").translate({9: " ", 10: " ", 13: " "}) for x in row]


def test_column_sets_nest():
    extra = tsv.CLASSIFIED_COLUMNS[4:]
    assert tsv.CLASSIFIED_COLUMNS == tsv.LOCAL_SITEMAP_COLUMNS + extra and tsv.WARC_COUNTRY_COLUMNS == tsv.WARC_SITEMAP_COLUMNS + extra
    assert len(tsv.WARC_COUNTRY_COLUMNS) == 8 and tsv.LINK_COLUMNS[-1] == "page_url"


def test_row_parsers_by_number_of_fields_and_empty_places(spark):
    rows = []
    for n in range(1, 10):
        for empty in itertools.chain([()], itertools.combinations(range(n), 1), itertools.combinations(range(n), 2)):
            rows.append("\t".join("" if i in empty else f"f{i}" for i in range(n)))
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, value string")
    strict = tsv.parse_local_sitemap_rows(df).orderBy("i").collect()
    seeds = tsv.parse_seed_rows(df).orderBy("i").collect()
    links = tsv.parse_link_rows(df).orderBy("i").collect()
    for line, a, b, c in zip(rows, strict, seeds, links):
        f = line.split("\t")
        ok = len(f) == 4 and f[1] and f[3]
        assert (a.status, a.robots_host) == (("ok", f[1]) if ok else ("malformed", None)), line
        assert b.seed_sitemap_url == (f[3] if len(f) >= 4 and f[3] else None), line
        assert c.page_url == (f[2] if len(f) >= 3 and f[2] else None), line


def test_retry_policy_grid(spark):
    hosts = {"https://plain.test/a": False, **{f"https://{h.upper()}/a": True for h in policy.CRAWL_BUCKET_HOSTS}}
    grid = [(u, s, a) for u in hosts for s in (None, 200, 403, 404, 410, *policy.TRANSIENT_STATUS_CODES) for a in (1, 3, 4, 9, 1000)]
    df = spark.createDataFrame(grid, "u string, s int, a int")
    got = df.select(policy.max_attempts("u").alias("m"), policy.retryable("u", "s").alias("r"),
                    policy.backoff_ms("u", "a").alias("b"), policy.will_retry("u", "s", "a").alias("w")).collect()
    for (u, s, a), x in zip(grid, got):
        most = 1000 if hosts[u] else 4
        again = s is None or s in policy.TRANSIENT_STATUS_CODES or s == 403 and hosts[u]
        assert (x.m, x.r, x.w) == (most, again, again and a < most)
        assert x.b == (1000 if hosts[u] else min(30_000, 1000 * 2 ** (a - 1)))


def classified(spark, n, code):
    return spark.range(n).select(
        F.col("id").cast("string").alias("robots_file_path"), F.lit("h.test").alias("robots_host"), F.lit("http").alias("robots_scheme"),
        F.concat(F.lit("http://h.test/"), "id").alias("sitemap_url"), F.lit(f"land-{code}").alias("country_key"),
        F.lit(f"Land {code}").alias("country_name"), F.lit(f".{code}").alias("matched_suffix"),
        F.when(F.col("id") % 10 == 0, f"{code}-X").otherwise("unknown").alias("language_region"))


def test_grouped_sink_splits_a_hot_key_and_replaces_the_output(spark, tmp_path):
    out, n = str(tmp_path / "out"), 60_000
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        tsv_sink.write_grouped(classified(spark, n, "aa"), tsv.CLASSIFIED_COLUMNS, out)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(glob.glob(f"{out}/out_group=country/out_key=land-aa/part-*")) > 1
    back = spark.read.text(out)
    assert back.count() == 2 * n and back.where("out_group = 'country'").select("value").distinct().count() == n
    tsv_sink.write_grouped(classified(spark, 10, "bb"), tsv.CLASSIFIED_COLUMNS, out)
    assert {(r.out_group, r.out_key) for r in spark.read.text(out).collect()} == {
        ("country", "land-bb"), ("language-region", "bb-X"), ("language-region", "unknown")}


def test_error_text_takes_three_lines_ended_by_cr_or_lf():
    from crawlmeta.sources.fetch import error_text
    assert error_text(b"") == "" and error_text(b"one\n") == "one"
    assert error_text("a\x0cb c\r\nd\re\nf\n".encode()) == "a\x0cb c d e"
    assert error_text(b"x" * 300) == "x" * 240
