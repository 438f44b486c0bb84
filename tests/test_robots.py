from pyspark.sql import functions as F

from crawlmeta.operators import robots

BOM = "\ufeff"


def parse(spark, *bodies):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "id int, body string")
    out = robots.with_robots(df).orderBy("id").collect()
    return [r["robots"] for r in out]


def agents(r):
    return [list(g["user_agents"]) for g in r["groups"]]


def rules(r):
    return [[(x["kind"], x["path"]) for x in g["rules"]] for g in r["groups"]]


def warning_lines(r):
    return [w["line_number"] for w in r["warnings"]]


def test_what_makes_a_file_valid(spark):
    cases = {
        "": (False, 0, 0), "no field\n<p>\n": (False, 0, 0), "Host: t.test\n# note": (False, 0, 0),
        "Allow: /a\nDisallow: /b": (False, 0, 0), "user-agent:\nallow: /": (False, 0, 0),
        "SITEMAP :/s.xml": (True, 0, 1), "Sitemap: map of this site": (False, 0, 0), "sitemap: HTTP://t.test/s?x#y": (True, 0, 1),
        "User-Agent: q": (True, 1, 0), BOM + "user-agent:q\rsitemap:/s": (True, 1, 1),
        "Disallow: /lost\nuser-agent: q\nDisallow: /kept": (True, 1, 0),
        "user-agent: q\ncrawl-delay: soon\nrequest-rate: often": (True, 1, 0)}
    for body, r in zip(cases, parse(spark, *cases)):
        assert (r["valid"], len(r["groups"]), len(r["sitemaps"])) == cases[body], body


def test_group_assembly_and_last_value_wins(spark):
    (r,) = parse(spark, "\n".join([
        "User-agent: A", "user-agent: b", "Allow: /", "Crawl-delay: 2.5", "Crawl-delay: 1e1",
        "Request-rate: 1/10", "Sitemap: /s.xml", "Host: x", "", "User-agent: c", "Disallow:",
        "User-agent: d", "Disallow: /d"]))
    # an agent after an accepted rule starts a new group
    assert agents(r) == [["a", "b"], ["c"], ["d"]]
    assert rules(r) == [[("allow", "/")], [("disallow", "")], [("disallow", "/d")]]
    assert r["groups"][0]["crawl_delay"] == 10.0
    assert (r["groups"][0]["request_rate"]["requests"], r["groups"][0]["request_rate"]["seconds"]) == (1, 10)
    assert r["groups"][1]["crawl_delay"] is None and r["groups"][1]["request_rate"] is None


def test_agent_after_rule_starts_group_and_group_without_rules_kept(spark):
    (r,) = parse(spark, "User-agent: a\nDisallow: /x\nUser-agent: b\n")
    assert agents(r) == [["a"], ["b"]] and rules(r) == [[("disallow", "/x")], []]


def test_warning_texts(spark):
    (r,) = parse(spark, "\n".join([
        "no colon here", "User-agent:", "Crawl-delay: 3", "Request-rate: 2/5", "Allow: /a",
        "User-agent: z", "Crawl-delay: -1", "Crawl-delay: NaN", "Request-rate: 0/5", "Request-rate: 1/2/3",
        "Sitemap: ftp://x/s.xml", "Sitemap:", "Sitemap: https://x/a b"]))
    assert [(w["line_number"], w["message"]) for w in r["warnings"]] == [
        (1, "Expected 'field: value', found 'no colon here'"),
        (2, "Missing user-agent value"),
        (3, "Ignored crawl-delay before user-agent"),
        (4, "Ignored request-rate before user-agent"),
        (5, "Ignored rule before user-agent"),
        (7, "Invalid crawl-delay value '-1'"),
        (8, "Invalid crawl-delay value 'NaN'"),
        (9, "Invalid request-rate value '0/5'"),
        (10, "Invalid request-rate value '1/2/3'"),
        (11, "Ignored invalid sitemap value 'ftp://x/s.xml'"),
        (12, "Missing sitemap value"),
        (13, "Ignored invalid sitemap value 'https://x/a b'"),
    ]


def test_java_number_forms(spark):
    (r,) = parse(spark, "User-agent: *\nCrawl-delay: 1d\nCrawl-delay: 0x1p3\nRequest-rate: +3 / 07\n")
    g = r["groups"][0]
    assert g["crawl_delay"] == 8.0 and (g["request_rate"]["requests"], g["request_rate"]["seconds"]) == (3, 7)


def test_line_ends_comments_and_trim(spark):
    (r,) = parse(spark, "User-agent: *\rSitemap: https://x/a.xml#frag\r\n\x0bDisallow:\t/p # c\n\x00Sitemap: https://x/a.xml")
    assert list(r["sitemaps"]) == ["https://x/a.xml", "https://x/a.xml"]
    assert rules(r) == [[("disallow", "/p")]]


def test_sitemap_rows_are_distinct_in_order(spark):
    df = spark.createDataFrame([(1, "Sitemap: /b\nSitemap: /a\nSitemap: /b\n")], "id int, body string")
    rows = robots.sitemap_rows(robots.with_robots(df), ["id"]).collect()
    assert [(r["sitemap_no"], r["sitemap_url"]) for r in rows] == [(1, "/b"), (2, "/a")]


def test_groups_for_agent(spark):
    df = spark.createDataFrame([(1, "User-agent: *\nDisallow: /\nUser-agent: googlebot\nAllow: /g\n"
                                    "User-agent: other\nAllow: /o\n")], "id int, body string")
    p = robots.with_robots(df)
    got = p.select(F.transform(robots.groups_for("robots", F.lit("Mozilla/5.0 (compatible; Googlebot/2.1)")),
                               lambda g: g["user_agents"][0]).alias("x")).first()["x"]
    assert list(got) == ["*", "googlebot"]
    rows = robots.agent_group_rows(p, ["id"], ["Googlebot", "nobody"]).orderBy("agent", "group_no").collect()
    assert [(r["agent"], r["group_no"]) for r in rows] == [("Googlebot", 1), ("Googlebot", 2), ("nobody", 1)]


def test_invalid_utf8_body_decodes_with_replacement(spark):
    df = spark.createDataFrame([(bytearray(b"User-agent: *\nDisallow: /\xff\n"),)], "body binary")
    r = robots.with_robots(df.withColumn("text", robots.decode_body("body")), body="text").first()["robots"]
    assert rules(r) == [[("disallow", "/�")]]


def test_parse_has_no_shuffle(spark):
    df = spark.createDataFrame([(1, "User-agent: *\n")], "id int, body string")
    plan = robots.with_robots(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_light_parse_equals_full_parse(spark):
    from crawlmeta.sources import corpus
    from tests.conftest import SF001
    pages = spark.read.parquet(f"{SF001}/pages.parquet").select("page_id", "url")
    li = corpus.lineitem_pages(spark.read.parquet(f"{SF001}/lineitem.parquet")) \
        .withColumn("page_id", F.col("page_id") + 10**9)
    caps = corpus.robots_captures(pages).unionByName(corpus.robots_captures(li))
    extra = spark.createDataFrame([(-1, "", "", "User-agent:\nSitemap: x\n"), (-2, "", "", "Allow: /\n"),
                                   (-3, "", "", "user-agent: a\n")], "page_id long, robots_url string, robots_host string, body string")
    caps = caps.unionByName(extra)
    full = robots.with_robots(caps).select("page_id", F.col("robots.sitemaps").alias("s1"), F.col("robots.valid").alias("v1"))
    light = robots.with_sitemaps(caps).select("page_id", F.col("robots.sitemaps").alias("s2"), F.col("robots.valid").alias("v2"))
    diff = full.join(light, "page_id").filter((F.col("s1") != F.col("s2")) | (F.col("v1") != F.col("v2"))).count()
    assert diff == 0


def test_agent_table_equals_the_contains_test(spark):
    names = ["Googlebot/2.1", "otherBOT", "", "x", "Googlebot/2.1", None, "A b*c"]
    body = "User-agent: *\nDisallow: /\nUser-agent: googlebot\nUser-agent: bot\nAllow: /g\nUser-agent: b*\nUser-agent: bot\nAllow: /\n"
    df = robots.with_robots(spark.createDataFrame([(1, body), (2, "User-agent: X\n"), (3, "")], "id int, body string"))
    agents = spark.createDataFrame([(n,) for n in names], "agent string")
    got = robots.agent_group_rows_from(df, ["id"], agents)
    want = robots.agent_group_rows(df, ["id"], sorted({n for n in names if n is not None}))
    key = lambda rows: sorted((r["id"], r["agent"], r["group_no"]) for r in rows.collect())
    assert key(got) == key(want) and got.count() > 5
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_contained_tokens_equal_brute_force(spark):
    import random
    r = random.Random(8)
    word = lambda k: "".join(r.choices("abé-/", k=k))
    names = sorted({word(r.choice([0, 1, 2, 3, 8, 40, 2000])).upper() for _ in range(60)})
    tokens = sorted({word(r.choice([1, 2, 3, 4, 5, 9])) for _ in range(400)} | {n[5:30].lower() for n in names if len(n) > 30})
    got = robots.contained_tokens(
        spark.createDataFrame([(t,) for t in tokens], "token string"),
        spark.createDataFrame([(n, n.lower()) for n in names], "name string, low string")).collect()
    want = sorted((t, n) for t in tokens for n in names if t in n.lower())
    assert sorted(map(tuple, got)) == want and len(want) > 1000


def test_long_agent_names_are_not_blown_up(spark):
    names = spark.range(40).select(F.concat(F.array_join(F.transform(
        F.sequence(F.lit(1), F.lit(250)), lambda i: F.concat(F.lit("bot/"), F.hex(F.col("id") * 1000 + i))), " "), F.col("id").cast("string")).alias("name"))
    names = names.withColumn("low", F.lower("name"))
    grams = names.select(F.explode(robots._pieces(F.col("low"), robots.GRAM)))
    assert names.agg(F.max(F.length("name"))).first()[0] > 1500
    assert grams.count() <= names.agg(F.sum(F.length("name"))).first()[0]
    tokens = spark.range(50_000).select(F.concat(F.lit("crawler-bot/"), F.hex("id")).alias("token")).union(
        spark.createDataFrame([("bot/3e9 ",)], "token string"))
    assert [r.token for r in robots.contained_tokens(tokens, names).collect()].count("bot/3e9 ") >= 1
