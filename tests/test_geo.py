from pyspark.sql import functions as F

from crawlmeta.operators import geo

# two lands with a plain, a Unicode and a longer suffix each, and one that others shadow
LANDS = {"aland": [".aa", ".中国", ".gov.aa"], "beeland": [".bb", ".рус", ".org.bb"], "shade": [".bb"]}
DIM_ROWS = [(k, k.title(), x) for k, v in LANDS.items() for x in v]


def dim(spark):
    return geo.dimension_from_rows(spark, DIM_ROWS)


def classify(spark, pairs, d=None):
    df = spark.createDataFrame([(i, h, u) for i, (h, u) in enumerate(pairs)], "id int, host string, url string")
    out = geo.classify(df, d if d is not None else dim(spark), "host", "url", keep_unmatched=True)
    return [r.asDict() for r in out.orderBy("id").collect()]


def expected(host):
    """Longest suffix, then the first listed, by plain loops over ASCII forms."""
    def ascii_form(x):
        return ".".join(p.encode("idna").decode() if p else p for p in x.split("."))
    h = ascii_form(host.strip().rstrip(".")).lower() if host else ""
    best = None
    for k, _, suffix in DIM_ROWS:
        s = ascii_form(suffix)
        if (h.endswith(s) or h == s[1:]) and (best is None or len(s) > len(best[1])):
            best = (k, s)
    return best or (None, None)


HOSTS = [prefix + name + dot for prefix in ("", "www.", "A.b.") for name in (
    "aa", "x.aa", "gov.aa", "x.gov.aa", "xgov.aa", "bb", "y.org.bb", "y.рус", "y.中国", "y.zz", "aab", "x.aa.zz") for dot in ("", ".")]


def test_suffixes_by_every_position(spark):
    got = classify(spark, [(h, "") for h in HOSTS])
    assert [(r["country_key"], r["matched_suffix"]) for r in got] == [expected(h) for h in HOSTS]


def test_large_dimension_gives_the_same(spark, monkeypatch):
    pairs = [(h, "https://q.bb/") for h in HOSTS]
    small = classify(spark, pairs)
    monkeypatch.setattr(geo, "BROADCAST_BYTES", -1)
    assert classify(spark, pairs) == small


def test_sitemap_host_counts_only_without_a_robots_host_match(spark):
    urls = {"https://n.aa/s.xml": "aland", "https://n.zz/s.xml": None, "::": None, "": None}
    pairs = [(h, u) for h in ("none", "m.zz", "m.bb") for u in urls]
    for (h, u), r in zip(pairs, classify(spark, pairs)):
        assert r["country_key"] == ("beeland" if h == "m.bb" else urls[u]), (h, u)
        assert r["country_key"] is None or r["language_region"] == "unknown"


def test_each_marker_in_each_place(spark):
    cases = {}
    for marker, region in geo.LANGUAGE_REGION_MARKERS.items():
        for sep in ("-", "_", "/") if "-" in marker else ("-",):
            m = marker.replace("-", sep)
            cases[f"https://s.test/a/{m}/b.xml"] = region
            cases[f"https://s.test/{m.upper()}"] = region
            if sep == "-":
                cases[f"https://{m}.s.test/b.xml"] = region
            cases[f"https://s.test/x{m}x/"] = "unknown"
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    got = {r["u"]: r["l"] for r in df.select("u", geo.language_region("u").alias("l")).collect()}
    wrong = {u: (got[u], r) for u, r in cases.items() if got[u] != (_model_region(*u[8:].split("/", 1)) if r != "unknown" or got[u] != r else r)}
    assert not wrong


def test_regex_marker_search_equals_token_search(spark):
    texts = ["uk ua", "ru/uk/ua", "x.ru.en.gb", "en-uk-ua", "GB", "ruru", "en--gb", "a.uk-ua.b", "ua uk", "", "uk-"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    keys = list(geo.LANGUAGE_REGION_MARKERS)
    by_tokens = F.element_at(F.create_map(*[x for k, v in geo.LANGUAGE_REGION_MARKERS.items()
                                            for x in (F.lit(k), F.lit(v))]),
                             F.try_element_at(F.filter(geo.locale_tokens(F.col("t")), lambda x: x.isin(*keys)),
                                              F.lit(1)))
    by_regex = F.coalesce(geo._marker_region(F.col("t"), geo.BIGRAM_MARKER, True),
                          geo._marker_region(F.col("t"), geo.UNIGRAM_MARKER, False))
    for r in df.select(by_tokens.alias("a"), by_regex.alias("b")).collect():
        assert r["a"] == r["b"]


def test_select_country_by_key_name_and_suffix(spark):
    d = dim(spark)
    asked = {"aland": "aland", " ALAND! ": "aland", "Beeland": "beeland", ".gov.aa": "aland", "gov.aa": "aland", "рус": "beeland",
             "bb": "beeland", "shade": "shade", "zz": None, "": None}
    qs = spark.createDataFrame([(q,) for q in asked], "query string")
    assert {r["query"]: r["country_key"] for r in geo.select_country(d, qs).collect()} == asked
    assert [r["suffix"] for r in geo.country_dimension(d, "beeland").orderBy("ord").collect()] == [".bb", ".xn--p1acf", ".org.bb"]
    assert [r["country_key"] for r in geo.supported_country_keys(d).collect()] == sorted(LANDS)
    assert geo.supported_country_keys(d, 1).count() == 1


def test_one_country_dimension_changes_the_answer(spark):
    pairs = [("example.de", "https://example.ua/s.xml")]
    d = geo.dimension_from_rows(spark, geo.SAMPLE_COUNTRY_SUFFIXES)
    assert classify(spark, pairs, d)[0]["country_key"] == "germany"
    assert classify(spark, pairs, geo.country_dimension(d, "ukraine"))[0]["country_key"] == "ukraine"


def test_longest_suffix_wins_for_multi_label_dimension(spark):
    d = geo.dimension_from_rows(spark, [("uk", "UK", ".uk"), ("gov-uk", "UK gov", ".gov.uk"),
                                        ("first", "First", ".uk")])
    got = classify(spark, [("www.gov.uk", ""), ("example.co.uk", ""), ("gov.uk", "")], d)
    assert [r["country_key"] for r in got] == ["gov-uk", "uk", "gov-uk"]


def test_dimension_loader(spark, tmp_path):
    p = tmp_path / "suffixes.tsv"
    p.write_text("country_key\tcountry_name\tsuffix\nukraine\tUkraine\t.UA\nbad\tline\nx\t\t.x\n"
                 "russia\tRussia\t рф \n", encoding="utf-8")
    rows = geo.load_suffixes(spark, str(p)).orderBy("ord").collect()
    assert [(r["country_key"], r["suffix"]) for r in rows] == [("ukraine", ".ua"), ("russia", ".xn--p1ai")]


def test_classify_plans_broadcast_hash_join(spark):
    df = spark.createDataFrame([("example.ua", "https://example.ua/")], "host string, url string")
    plan = geo.classify(df, dim(spark), "host", "url")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan


def _model_region(host, path):
    import re
    markers = geo.LANGUAGE_REGION_MARKERS

    def tokens(text):
        toks = [t.lower() for t in re.split(r"[^A-Za-z0-9]+", text or "") if t]
        return [f"{a}-{b}" for a, b in zip(toks, toks[1:])] + toks

    h = ".".join((host or "").rstrip(".").split(".")[:-1]) if host else ""
    for t in tokens(h) + tokens(path):
        if t in markers:
            return markers[t]
    return "unknown"


def test_language_region_random_against_token_model(spark):
    import random
    rnd = random.Random(11)
    words = ["uk", "ua", "ru", "en", "gb", "de", "x", "UK", "Ru", "EN", "gB", "ua1", "uken"]
    seps = ["-", ".", "/", "_", "--", "%20"]

    def text(n):
        out = []
        for _ in range(n):
            out += [rnd.choice(words), rnd.choice(seps)]
        return "".join(out[:-1])

    rows = [(f"{text(rnd.randint(0, 3))}.example.{rnd.choice(['ua', 'com'])}".lstrip("."),
             "/" + text(rnd.randint(0, 4))) for _ in range(800)]
    df = spark.createDataFrame(rows, "h string, p string")
    got = df.select("h", "p", geo.language_region_of(F.col("h"), F.col("p")).alias("r")).collect()
    for r in got:
        assert r["r"] == _model_region(r["h"], r["p"]), (r["h"], r["p"])
