"""Brute-force check of the in-row parser against a line-by-line model of
the robots.txt builder (groups, rules, delays, rates, sitemaps, warnings)."""

import math
import random
import re

from crawlmeta.operators import robots

VOCAB = [
    "User-agent: *", "User-agent: A", "user-agent: b", "USER-AGENT:", "Allow: /", "Disallow: /x", "Disallow:",
    "Crawl-delay: 2.5", "Crawl-delay: eventually", "Crawl-delay: -1", "Crawl-delay: 10", "Request-rate: 1/10",
    "Request-rate: 0/5", "Request-rate: 3 / 7", "Sitemap: https://a.example/s.xml", "Sitemap: /s.xml",
    "Sitemap: User-agent: *", "Sitemap:", "Host: x", "", "   ", "# only a comment", "no colon here",
    "Disallow: /p # c", "\ufeffUser-agent: z", "Sitemap: https://a.example/s.xml",
    "Crawl-delay: 1d", "Crawl-delay: 0x1p3", "Crawl-delay: Infinity", "Crawl-delay: NaN", "Crawl-delay: inf",
    "Crawl-delay: .5e1", "Request-rate: +2/07", "Request-rate: 1/2/3",
]


def java_double(v):
    """Double.parseDouble on an already trimmed value, None when it throws."""
    if re.fullmatch(r"[+-]?(NaN|Infinity)", v):
        return float(v.replace("Infinity", "inf"))
    m = re.fullmatch(r"([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)[fFdD]?", v)
    if m:
        return float(m.group(1))
    m = re.fullmatch(r"([+-]?)0[xX]([0-9a-fA-F]*\.?[0-9a-fA-F]*)[pP]([+-]?\d+)[fFdD]?", v)
    if m and m.group(2) not in ("", "."):
        return float.fromhex(f"{m.group(1)}0x{m.group(2)}p{m.group(3)}")
    return None


def blank_cut(s):
    return s.strip("".join(map(chr, range(33))))


def line_table(body):
    """(line number, field or None, value) of the lines that say something."""
    lines = re.split(r"\r\n|\n|\r", body)
    for n, raw in enumerate(lines, 1):
        text = blank_cut(raw.partition("#")[0])
        field, colon, value = text.partition(":")
        if text:
            yield n, blank_cut(field).removeprefix("\ufeff").lower() if colon else None, blank_cut(value) if colon else text


def rate(value):
    parts = [blank_cut(p) for p in value.split("/", 1)]
    if len(parts) != 2 or not all(re.fullmatch(r"[+-]?\d+", p) for p in parts):
        return None
    return tuple(map(int, parts)) if min(map(int, parts)) > 0 else None


def delay(value):
    d = java_double(value)
    return None if d is None or math.isnan(d) or d < 0 else d


def usable(value):
    return bool(value) and not re.search(r"\s", value) and bool(re.match(r"(?i)https?://|/", value))


# per field: what its value says (None: nothing), and the texts for an unusable value and for a place before any agent
SAYS = {"allow": (str, None, "Ignored rule before user-agent"), "disallow": (str, None, "Ignored rule before user-agent"),
        "crawl-delay": (delay, "Invalid crawl-delay value '{}'", "Ignored crawl-delay before user-agent"),
        "request-rate": (rate, "Invalid request-rate value '{}'", "Ignored request-rate before user-agent")}


def model(body):
    """Groups as islands: a new island starts at an agent line whose last
    telling line before was no agent line; each island is then read by field."""
    table = list(line_table(body))
    agents = [n for n, f, v in table if f == "user-agent" and v]
    first = min(agents, default=math.inf)
    said, warnings = [], []
    for n, f, v in table:
        if f is None:
            warnings.append((n, f"Expected 'field: value', found '{v}'"))
        elif f == "user-agent":
            said.append((n, f, v.lower())) if v else warnings.append((n, "Missing user-agent value"))
        elif f in SAYS:
            read, unusable, early = SAYS[f]
            if read(v) is None:
                warnings.append((n, unusable.format(v)))
            elif n < first:
                warnings.append((n, early))
            else:
                said.append((n, f, read(v)))
        elif f == "sitemap" and not usable(v):
            warnings.append((n, f"Ignored invalid sitemap value '{v}'" if v else "Missing sitemap value"))
    starts = [i for i, x in enumerate(said) if x[1] == "user-agent" and (i == 0 or said[i - 1][1] != "user-agent")]
    groups = []
    for a, b in zip(starts, [*starts[1:], len(said)]):
        by = {k: [v for _, f, v in said[a:b] if f == k] for k in ("user-agent", "crawl-delay", "request-rate")}
        rules = tuple((f, v) for _, f, v in said[a:b] if f in ("allow", "disallow"))
        groups.append((tuple(by["user-agent"]), rules, *(by[k][-1] if by[k] else None for k in ("crawl-delay", "request-rate"))))
    return groups, [v for _, f, v in table if f == "sitemap" and usable(v)], warnings


def test_parser_matches_line_model(spark):
    rnd = random.Random(7)
    bodies = []
    for _ in range(600):
        k = rnd.randint(0, 12)
        ends = [rnd.choice(["\n", "\r\n", "\r"]) for _ in range(k)]
        lines = [rnd.choice(VOCAB) for _ in range(k)]
        body = "".join(line + end for line, end in zip(lines, ends))
        if k and rnd.random() < 0.3:
            body = body[: -len(ends[-1])]
        bodies.append(body)
    df = spark.createDataFrame(list(enumerate(bodies)), "id int, body string")
    got = {r["id"]: r["robots"] for r in robots.with_robots(df).collect()}
    for i, body in enumerate(bodies):
        groups, sitemaps, warnings = model(body)
        r = got[i]
        g = [(tuple(x["user_agents"]), tuple((y["kind"], y["path"]) for y in x["rules"]), x["crawl_delay"],
              None if x["request_rate"] is None else (x["request_rate"]["requests"], x["request_rate"]["seconds"]))
             for x in r["groups"]]
        assert g == groups, (i, body)
        assert list(r["sitemaps"]) == sitemaps, (i, body)
        assert [(w["line_number"], w["message"]) for w in r["warnings"]] == warnings, (i, body)
        assert r["valid"] == bool(groups or sitemaps)
