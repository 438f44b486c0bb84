from pyspark.sql import functions as F

from crawlmeta.operators import quality, robots


def captures(spark, files=6000):
    """Files of three hosts in ten archives with 0 to 30 warnings each; one host has most files."""
    bad = F.transform(F.sequence(F.lit(1), F.pmod(F.col("id") * 7919, F.lit(31)).cast("int")),
                      lambda i: F.concat(F.lit("no colon "), (F.col("id") % 997 * 40 + i).cast("string")))
    body = F.concat_ws("\n", F.lit("User-agent: *"), F.lit("Crawl-delay: x"), F.when(F.col("id") % 31 != 0, F.array_join(bad, "\n")))
    rows = spark.range(files).select(
        "id", (F.col("id") % 10).cast("string").alias("archive_path"),
        F.when(F.col("id") % 6 == 0, "a").when(F.col("id") % 6 == 1, "b").otherwise("hot").alias("host"), body.alias("body"))
    return robots.with_robots(rows)


def test_merged_sketches_are_within_their_bounds(spark):
    parsed = captures(spark).cache()
    files = quality.merged_files(quality.file_sketches(parsed, ["archive_path", "host"]), ["host"])
    report = {r.host: r for r in quality.file_report(files, {"p10": 0.1, "p50": 0.5, "p99": 0.99}).collect()}
    exact = parsed.select("host", F.size("robots.warnings").alias("n"), "robots.warnings.message").collect()
    kinds = quality.kind_report(quality.merged_kinds(quality.kind_sketches(parsed, ["archive_path", "host"]), ["host"]))
    found = {(r.host, r.kind): r for r in kinds.collect()}
    for host in ("a", "b", "hot"):
        n = [r.n for r in exact if r.host == host]
        r = report[host]
        assert (r.files, r.rejected_files, r.warnings) == (len(n), 0, sum(n))
        for name, q in (("p10", 0.1), ("p50", 0.5), ("p99", 0.99)):
            below, upto = sum(x < r[name] for x in n) / len(n), sum(x <= r[name] for x in n) / len(n)
            assert below - 4 * quality.RANK_ERROR <= q <= upto + 4 * quality.RANK_ERROR
        messages = [m for x in exact if x.host == host for m in x.message]
        for kind in ("Expected", "Invalid crawl-delay value"):
            own = [m for m in messages if m.startswith(kind)]
            assert found[host, kind].warnings == len(own)
            assert abs(found[host, kind].distinct_messages - len(set(own))) <= 1 + 4 * quality.DISTINCT_ERROR * len(set(own))
    assert len(found) == 6


def test_sketches_stay_small_and_empty_input_gives_no_rows(spark):
    parsed = captures(spark, 3000)
    size = lambda df: df.agg(F.max(F.octet_length("per_file"))).first()[0]
    assert size(quality.file_sketches(parsed, ["host"])) < 8000
    none = parsed.limit(0)
    assert quality.merged_files(quality.file_sketches(none, ["host"]), ["host"]).collect() == []
    assert quality.merged_kinds(quality.kind_sketches(none, ["host"]), ["host"]).collect() == []
