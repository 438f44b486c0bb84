"""robots.txt parsing as a narrow (in-row) DataFrame transform.

Every robots body is parsed inside its own row with array functions
(``split`` / ``transform`` / ``filter``), so the parse never shuffles: a
file is one row, and its lines never leave that row. The result is one
struct column::

    robots: STRUCT<
      groups:   ARRAY<STRUCT<user_agents: ARRAY<STRING>,
                             rules: ARRAY<STRUCT<kind STRING, path STRING>>,
                             crawl_delay: DOUBLE,
                             request_rate: STRUCT<requests INT, seconds INT>>>,
      sitemaps: ARRAY<STRING>,
      warnings: ARRAY<STRUCT<line_number INT, message STRING>>,
      valid:    BOOLEAN>

Semantics (per line, 1-based line numbers, blank lines counted):
  * a line ends at CRLF, LF or a lone CR;
  * text from the first ``#`` on is a comment; the rest is trimmed the way
    Java's ``String.trim`` does (every char <= U+0020);
  * ``field: value`` splits at the first colon; the field name is trimmed,
    loses one leading BOM and is lowercased; a line without a colon is a
    warning;
  * six fields are understood (user-agent, allow, disallow, crawl-delay,
    request-rate, sitemap); others are ignored silently;
  * consecutive user-agent lines share a group; a user-agent line after an
    accepted rule / delay / rate starts a new group; sitemap, unknown and
    blank lines never break a group; rules, delays and rates before the
    first user-agent are ignored with a warning;
  * the last valid crawl-delay / request-rate of a group wins;
  * sitemaps are collected independently of groups, in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmeta.functions.text import LINE_BREAK, col, java_trim, strip_bom
from crawlmeta.functions.url import is_usable_sitemap_value

# Directive field names, rule kinds and warning texts.
FIELD_USER_AGENT = "user-agent"
FIELD_ALLOW = "allow"
FIELD_DISALLOW = "disallow"
FIELD_CRAWL_DELAY = "crawl-delay"
FIELD_REQUEST_RATE = "request-rate"
FIELD_SITEMAP = "sitemap"
MSG_EXPECTED_FIELD = "Expected 'field: value', found '{line}'"
MSG_MISSING_AGENT = "Missing user-agent value"
MSG_INVALID_DELAY = "Invalid crawl-delay value '{value}'"
MSG_INVALID_RATE = "Invalid request-rate value '{value}'"
MSG_INVALID_SITEMAP = "Ignored invalid sitemap value '{value}'"
MSG_MISSING_SITEMAP = "Missing sitemap value"
MSG_RULE_BEFORE_AGENT = "Ignored rule before user-agent"
MSG_DELAY_BEFORE_AGENT = "Ignored crawl-delay before user-agent"
MSG_RATE_BEFORE_AGENT = "Ignored request-rate before user-agent"

# Directive kinds produced by ``directives``.
K_AGENT, K_ALLOW, K_DISALLOW, K_DELAY, K_RATE, K_SITEMAP = (
    "agent", "allow", "disallow", "delay", "rate", "sitemap")
K_UNKNOWN = "unknown"
K_NO_COLON, K_AGENT_MISSING, K_DELAY_INVALID, K_RATE_INVALID = (
    "no_colon", "agent_missing", "delay_invalid", "rate_invalid")
K_SITEMAP_INVALID, K_SITEMAP_MISSING = "sitemap_invalid", "sitemap_missing"
GROUP_KINDS = (K_AGENT, K_ALLOW, K_DISALLOW, K_DELAY, K_RATE)


def decode_body(body: Column | str) -> Column:
    """UTF-8 decode of a BINARY body, bad bytes become U+FFFD (no error)."""
    return F.make_valid_utf8(col(body).cast("string"))


def _message(template: str, **parts: Column) -> Column:
    pieces: list[Column] = []
    rest = template
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        if head:
            pieces.append(F.lit(head))
        pieces.append(parts[name])
    if rest:
        pieces.append(F.lit(rest))
    return F.concat(*pieces)


# Double.parseDouble accepts: plain decimals (a cast gives the same value),
# and forms a cast does not read the same way (f/F/d/D suffix, hex floats,
# NaN, Infinity), which go through the Java method itself. Text matching
# neither is not a number, without calling into Java and raising.
_PLAIN_DECIMAL = r"^[+-]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]+)?$"
_JAVA_DOUBLE = (r"^[+-]?(?:NaN|Infinity|(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]+)?[fFdD]?"
                r"|0[xX](?:[0-9a-fA-F]+[.]?[0-9a-fA-F]*|[.][0-9a-fA-F]+)[pP][+-]?[0-9]+[fFdD]?)$")


def _java_double(v: Column) -> Column:
    return (F.when(v.rlike(_PLAIN_DECIMAL), v.try_cast("double"))
            .when(v.rlike(_JAVA_DOUBLE),
                  F.try_reflect(F.lit("java.lang.Double"), F.lit("parseDouble"), v).try_cast("double")))


def _java_int(v: Column) -> Column:
    """Integer.parseInt: ASCII digits by cast, other Unicode decimal digits
    through the Java method; NULL on overflow or any other text."""
    return (F.when(v.rlike(r"^[+-]?[0-9]+$"), v.try_cast("int"))
            .when(v.rlike(r"^[+-]?\p{Nd}+$"),
                  F.try_reflect(F.lit("java.lang.Integer"), F.lit("parseInt"), v).try_cast("int")))


def directives(body: Column | str, only_fields: tuple[str, ...] | None = None) -> Column:
    """ARRAY<STRUCT<n INT, t STRING, f STRING, v STRING, k STRING, d DOUBLE,
    rq INT, rs INT>>: one element per non-blank line (``t`` = the stripped
    line, ``f``/``v`` = field and value, ``k`` = directive kind).

    ``only_fields`` keeps just the lines that can carry those fields (their
    lowercased text contains the name), before any field splitting."""
    lines = F.split(F.coalesce(col(body), F.lit("")), LINE_BREAK, -1)

    def keep(x: Column) -> Column:
        cond = x["t"] != ""
        if only_fields:
            low = F.lower(x["t"])
            any_field = F.lit(False)
            for name in only_fields:
                any_field = any_field | low.contains(name)
            cond = cond & any_field
        return cond

    stripped = F.filter(
        F.transform(lines, lambda line, i: F.struct(
            (i + 1).alias("n"),
            java_trim(F.substring_index(line, "#", 1)).alias("t"))),
        keep)

    def split_field(x: Column) -> Column:
        colon = F.instr(x["t"], ":")
        return F.struct(
            x["n"].alias("n"), x["t"].alias("t"), (colon > 0).alias("c"),
            F.lower(strip_bom(java_trim(F.substring_index(x["t"], ":", 1)))).alias("f"),
            java_trim(x["t"].substr(colon + 1, F.length(x["t"]))).alias("v"))

    def typed(x: Column) -> Column:
        parts = F.split(x["v"], "/", 2)
        is_rate = (x["f"] == FIELD_REQUEST_RATE) & (F.size(parts) == 2)
        return F.struct(
            x["n"].alias("n"), x["t"].alias("t"), x["c"].alias("c"), x["f"].alias("f"), x["v"].alias("v"),
            F.when(x["f"] == FIELD_CRAWL_DELAY, _java_double(x["v"])).alias("d"),
            F.when(is_rate, _java_int(java_trim(F.try_element_at(parts, F.lit(1))))).alias("rq"),
            F.when(is_rate, _java_int(java_trim(F.try_element_at(parts, F.lit(2))))).alias("rs"))

    def kind(x: Column) -> Column:
        f, v = x["f"], x["v"]
        delay_ok = x["d"].isNotNull() & ~F.isnan(x["d"]) & (x["d"] >= 0)
        rate_ok = (x["rq"] > 0) & (x["rs"] > 0)
        k = (F.when(~x["c"], K_NO_COLON)
             .when(f == FIELD_USER_AGENT, F.when(v == "", K_AGENT_MISSING).otherwise(K_AGENT))
             .when(f == FIELD_ALLOW, K_ALLOW)
             .when(f == FIELD_DISALLOW, K_DISALLOW)
             .when(f == FIELD_CRAWL_DELAY, F.when(delay_ok, K_DELAY).otherwise(K_DELAY_INVALID))
             .when(f == FIELD_REQUEST_RATE, F.when(F.coalesce(rate_ok, F.lit(False)), K_RATE)
                   .otherwise(K_RATE_INVALID))
             .when(f == FIELD_SITEMAP, F.when(is_usable_sitemap_value(v), K_SITEMAP)
                   .when(v != "", K_SITEMAP_INVALID).otherwise(K_SITEMAP_MISSING))
             .otherwise(K_UNKNOWN))
        return F.struct(x["n"].alias("n"), x["t"].alias("t"), f.alias("f"), v.alias("v"), k.alias("k"),
                        x["d"].alias("d"), x["rq"].alias("rq"), x["rs"].alias("rs"))

    return F.transform(F.transform(F.transform(stripped, split_field), typed), kind)


def _warning_message(x: Column, first_agent: Column) -> Column:
    k = x["k"]
    misplaced = first_agent.isNull() | (x["n"] < first_agent)
    return (F.when(k == K_NO_COLON, _message(MSG_EXPECTED_FIELD, line=x["t"]))
            .when(k == K_AGENT_MISSING, F.lit(MSG_MISSING_AGENT))
            .when(k == K_DELAY_INVALID, _message(MSG_INVALID_DELAY, value=x["v"]))
            .when(k == K_RATE_INVALID, _message(MSG_INVALID_RATE, value=x["v"]))
            .when(k == K_SITEMAP_INVALID, _message(MSG_INVALID_SITEMAP, value=x["v"]))
            .when(k == K_SITEMAP_MISSING, F.lit(MSG_MISSING_SITEMAP))
            .when(k.isin(K_ALLOW, K_DISALLOW) & misplaced, F.lit(MSG_RULE_BEFORE_AGENT))
            .when((k == K_DELAY) & misplaced, F.lit(MSG_DELAY_BEFORE_AGENT))
            .when((k == K_RATE) & misplaced, F.lit(MSG_RATE_BEFORE_AGENT)))


def _group(members: Column) -> Column:
    def of_kind(*kinds: str) -> Column:
        return F.filter(members, lambda x: x["k"].isin(*kinds))

    return F.struct(
        F.transform(of_kind(K_AGENT), lambda x: F.lower(x["v"])).alias("user_agents"),
        F.transform(of_kind(K_ALLOW, K_DISALLOW),
                    lambda x: F.struct(x["k"].alias("kind"), x["v"].alias("path"))).alias("rules"),
        F.try_element_at(F.transform(of_kind(K_DELAY), lambda x: x["d"]), F.lit(-1)).alias("crawl_delay"),
        F.try_element_at(F.transform(of_kind(K_RATE), lambda x: F.struct(
            x["rq"].alias("requests"), x["rs"].alias("seconds"))), F.lit(-1)).alias("request_rate"))


def with_robots(df: DataFrame, body: str = "body", out: str = "robots") -> DataFrame:
    """Add the parsed ``robots`` struct column (narrow; no shuffle).

    Groups are found without a window: among the accepted group directives
    (from the first user-agent on), a group starts at each user-agent line
    that does not follow another user-agent line, and runs to the next
    start (``slice``). Each step is its own projection so that Catalyst
    keeps the intermediate arrays instead of re-evaluating them."""
    d, first, placed = "_rb_dirs", "_rb_first_agent", "_rb_placed"
    df = df.withColumn(d, directives(body))
    df = df.withColumn(first, F.try_element_at(F.filter(d, lambda x: x["k"] == K_AGENT), F.lit(1))["n"])
    df = df.withColumn(placed, F.filter(
        d, lambda x: x["k"].isin(*GROUP_KINDS) & (x["n"] >= F.col(first))))
    # a group starts at every agent line that does not follow another agent line
    starts = "_rb_starts"
    n = F.size(placed)
    df = df.withColumn(starts, F.filter(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: (i <= n) & F.coalesce(
            (F.try_element_at(F.col(placed), i)["k"] == K_AGENT)
            & ((i == 1) | (F.try_element_at(F.col(placed), i - 1)["k"] != K_AGENT)), F.lit(False))))
    members = F.transform(starts, lambda s, j: F.slice(
        placed, s, F.coalesce(F.try_element_at(F.col(starts), j + 2), n + 1) - s))
    groups = F.transform(members, _group)
    sitemaps = F.transform(F.filter(d, lambda x: x["k"] == K_SITEMAP), lambda x: x["v"])
    warnings = F.filter(
        F.transform(d, lambda x: F.struct(x["n"].alias("line_number"),
                                          _warning_message(x, F.col(first)).alias("message"))),
        lambda w: w["message"].isNotNull())
    df = df.withColumn(out, F.struct(groups.alias("groups"), sitemaps.alias("sitemaps"),
                                     warnings.alias("warnings")))
    df = df.withColumn(out, F.struct(
        F.col(out)["groups"].alias("groups"), F.col(out)["sitemaps"].alias("sitemaps"),
        F.col(out)["warnings"].alias("warnings"),
        ((F.size(F.col(out)["groups"]) > 0) | (F.size(F.col(out)["sitemaps"]) > 0)).alias("valid")))
    return df.drop(d, first, placed, starts)


def with_sitemaps(df: DataFrame, body: str = "body", out: str = "robots") -> DataFrame:
    """Light parse for link extraction: ``out = STRUCT<sitemaps, valid>``.

    Exactly the ``sitemaps`` and ``valid`` of ``with_robots`` without
    assembling groups or warnings: a file has a group iff it has a
    non-empty user-agent line, so valid = any user-agent or usable sitemap
    line."""
    d = "_rb_dirs"
    df = df.withColumn(d, directives(body, only_fields=(FIELD_USER_AGENT, FIELD_SITEMAP)))
    sitemaps = F.transform(F.filter(d, lambda x: x["k"] == K_SITEMAP), lambda x: x["v"])
    valid = F.exists(d, lambda x: x["k"].isin(K_AGENT, K_SITEMAP))
    return df.withColumn(out, F.struct(sitemaps.alias("sitemaps"), valid.alias("valid"))).drop(d)


def directive_rows(df: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    """One row per non-blank line: keys + line_no, field, value, kind."""
    x = df.select(*keys, F.posexplode(directives(body)).alias("_pos", "_d"))
    return x.select(*keys, F.col("_d.n").cast("long").alias("line_no"), F.col("_d.f").alias("field"),
                    F.col("_d.v").alias("value"), F.col("_d.k").alias("kind"))


def group_rows(df: DataFrame, keys: list[str], robots: str = "robots") -> DataFrame:
    """One row per group: keys, group_no (1-based), agents, delay, rate, rule count."""
    g = df.select(*keys, F.posexplode(F.col(robots)["groups"]).alias("_pos", "_g"))
    return g.select(*keys, (F.col("_pos") + 1).cast("long").alias("group_no"),
                    F.array_join("_g.user_agents", ",").alias("user_agents"),
                    F.col("_g.crawl_delay").alias("crawl_delay"),
                    F.col("_g.request_rate.requests").cast("long").alias("rate_requests"),
                    F.col("_g.request_rate.seconds").cast("long").alias("rate_seconds"),
                    F.size("_g.rules").cast("long").alias("n_rules"))


def rule_rows(df: DataFrame, keys: list[str], robots: str = "robots") -> DataFrame:
    g = df.select(*keys, F.posexplode(F.col(robots)["groups"]).alias("_gpos", "_g"))
    r = g.select(*keys, "_gpos", F.posexplode("_g.rules").alias("_rpos", "_r"))
    return r.select(*keys, (F.col("_gpos") + 1).cast("long").alias("group_no"),
                    (F.col("_rpos") + 1).cast("long").alias("rule_no"),
                    F.col("_r.kind").alias("kind"), F.col("_r.path").alias("path"))


def sitemap_rows(df: DataFrame, keys: list[str], robots: str = "robots",
                 valid_only: bool = True) -> DataFrame:
    """Distinct sitemap values per file, first-seen order kept (``sitemap_no``)."""
    src = df.filter(F.col(robots)["valid"]) if valid_only else df
    s = src.select(*keys, F.posexplode(F.array_distinct(F.col(robots)["sitemaps"])).alias("_pos", "sitemap_url"))
    return s.select(*keys, (F.col("_pos") + 1).cast("long").alias("sitemap_no"), "sitemap_url")


def warning_rows(df: DataFrame, keys: list[str], robots: str = "robots") -> DataFrame:
    w = df.select(*keys, F.explode(F.col(robots)["warnings"]).alias("_w"))
    return w.select(*keys, F.col("_w.line_number").cast("long").alias("line_number"),
                    F.col("_w.message").alias("message"))


def groups_for(robots: Column | str, user_agent: Column | str) -> Column:
    """Groups that apply to an agent: a group token ``*`` or a token
    contained in the lowercased agent string (all matches, in order)."""
    ua = F.lower(col(user_agent))
    return F.filter(col(robots)["groups"], lambda g: F.exists(
        g["user_agents"], lambda a: (a == "*") | F.contains(ua, a)))


def agent_group_rows(df: DataFrame, keys: list[str], agents: list[str],
                     robots: str = "robots") -> DataFrame:
    """For each file and each agent of a (small, fixed) list: the numbers of
    the groups that apply. The list travels as a literal array, so there is
    no join at all."""
    agent_arr = F.array(*[F.lit(a) for a in agents])
    numbered = F.transform(F.col(robots)["groups"], lambda g, i: F.named_struct(
        F.lit("group_no"), i + 1, F.lit("user_agents"), g["user_agents"]))
    x = df.select(*keys, numbered.alias("_ng"), F.explode(agent_arr).alias("agent"))
    ua = F.lower(F.col("agent"))
    hits = F.filter("_ng", lambda g: F.exists(g["user_agents"], lambda a: (a == "*") | F.contains(ua, a)))
    return x.select(*keys, "agent", F.explode(hits).alias("_g")).select(
        *keys, "agent", F.col("_g.group_no").cast("long").alias("group_no"))


#: Tokens of so many characters or more are found by their rarest gram of that length.
GRAM = 3


def _pieces(text: Column, size: Column | int) -> Column:
    """Distinct substrings of one length, none for a shorter text."""
    size = F.lit(size) if isinstance(size, int) else size
    last = F.length(text) - size + 1
    return F.when(last >= 1, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substr(text, i, size)))).otherwise(
        F.array().cast("array<string>"))


def contained_tokens(tokens: DataFrame, names: DataFrame) -> DataFrame:
    """Pairs (token, name) of distinct tokens (column ``token``) and names
    (``name``, ``low``) with ``low`` containing the token.

    A name of n characters gives n grams, not its n^2 substrings. A token
    meets the names at one of its grams only, the one that the fewest names
    have (a token with a gram that no name has meets none), and is then looked
    for in them. Tokens shorter than a gram are gram-sized or shorter pieces
    themselves, an equi join."""
    grams = names.select("name", "low", F.explode(_pieces(F.col("low"), GRAM)).alias("gram"))
    held = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("names"))
    long = tokens.where(F.length("token") >= GRAM)
    parts = long.select("token", _pieces(F.col("token"), GRAM).alias("parts"))
    anchors = (parts.select("token", F.size("parts").alias("n"), F.explode("parts").alias("gram")).join(held, "gram")
               .groupBy("token", "n").agg(F.count(F.lit(1)).alias("found"), F.min(F.struct("names", "gram")).alias("rarest"))
               .where("found = n").select("token", F.col("rarest.gram").alias("gram")))
    met = anchors.join(grams, "gram").where(F.contains(F.col("low"), F.col("token"))).select("token", "name")
    short = [_pieces(F.col("low"), k) for k in range(1, GRAM)]
    few = names.select("name", F.explode(F.concat(*short)).alias("token"))
    return met.unionByName(tokens.where(F.length("token") < GRAM).join(few, "token").select("token", "name"))


def agent_group_rows_from(df: DataFrame, keys: list[str], agents: DataFrame, agent_col: str = "agent",
                          robots: str = "robots") -> DataFrame:
    """``agent_group_rows`` for a table of agents of any size: the distinct
    tokens of the groups are searched in the distinct names once
    (``contained_tokens``), ``*`` goes with every name, and the pairs are
    joined back to the groups."""
    names = agents.select(F.col(agent_col).alias("name")).where("name IS NOT NULL").distinct().withColumn("low", F.lower("name"))
    groups = (df.select(*keys, F.posexplode(F.col(robots)["groups"]).alias("_no", "_g"))
              .select(*keys, (F.col("_no") + 1).cast("long").alias("group_no"),
                      F.explode(F.array_distinct("_g.user_agents")).alias("_token")))
    tokens = groups.where("_token <> '*'").select(F.col("_token").alias("token")).distinct()
    pairs = contained_tokens(tokens, names).unionByName(names.select(F.lit("*").alias("token"), "name"))
    pairs = pairs.select(F.col("token").alias("_token"), F.col("name").alias("agent"))
    return groups.join(pairs, "_token").select(*keys, "agent", "group_no").distinct()
