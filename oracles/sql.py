"""Oracle SQL (DuckDB dialect) for each registered query.

The views ``pages``, ``lineitem`` ... are registered by the checker. The
texts share CTE fragments built here; every text is one SELECT.
"""

from __future__ import annotations

# Java trim: every char <= U+0020 at both ends.
_JT = "'^[\\x00-\\x20]+|[\\x00-\\x20]+$'"


def jtrim(x: str) -> str:
    return f"regexp_replace({x}, {_JT}, '', 'g')"


CORPUS_A = r"""
p0 as (
  select page_id, url, regexp_extract(url, '^https?://([^/?#]+)', 1) as h,
         regexp_extract(url, '^(https?)://', 1) as scheme,
         case page_id % 7 when 0 then 'ua' when 1 then 'uk' when 2 then 'ru' when 3 then 'de'
                          when 4 then 'xn--j1amh' when 5 then 'fr' else 'com' end as cc,
         case page_id % 5 when 0 then 'uk-ua/' when 1 then 'ru/' when 2 then 'en-gb/' when 3 then 'en/gb/' else '' end as loc
  from pages
), p1 as (
  select page_id, scheme, regexp_replace(h, '[.](com|net|org)$', concat('.', cc)) as host, loc from p0
), cap as (
select page_id, concat(scheme, '://', host, '/robots.txt') as robots_url, host as robots_host,
  case page_id % 8
    when 0 then concat('User-agent: *', chr(10), 'Disallow: /cart/ # no shop pages', chr(10), 'Crawl-delay: soon', chr(10), 'Sitemap: ', scheme, '://', host, '/', loc, 'sitemap.xml', chr(10))
    when 1 then concat('Sitemap: ', scheme, '://', host, '/', loc, 'sitemap.xml', chr(13), chr(10), 'sitemap:/sitemap.xml', chr(13), chr(10))
    when 2 then concat(chr(65279), 'User-agent: A', chr(10), 'user-agent: b', chr(10), 'Allow: /', chr(10), 'Crawl-delay: 2.5', chr(10), 'Request-rate: 1/10', chr(10), 'User-agent: c', chr(10), 'Disallow:', chr(10))
    when 3 then concat('<!doctype html>', chr(10), '<p>Page ', cast(page_id as varchar(20)), ' is gone</p>', chr(10))
    when 4 then concat('Allow: /too-soon', chr(10), 'User-agent: *', chr(10), 'Sitemap: see the map page', chr(10), 'Sitemap: https://maps.example.ua/', loc, 'all.xml', chr(10), 'Disallow: /old', chr(10))
    when 5 then concat('User-agent:', chr(10), 'Request-rate: 0/5', chr(10), 'no colon here', chr(10))
    when 6 then concat('User-agent: *', chr(13), 'Sitemap: ', scheme, '://', host, '/a.xml', chr(13), 'Sitemap: ', scheme, '://', host, '/a.xml', chr(13), 'Host: x')
    else '' end as body
from p1
)"""

PARSE = f"""
ln0 as (select page_id, string_split_regex(coalesce(body, ''), '\\r\\n|\\n|\\r') as arr from cap),
ln as (select page_id, n, arr[n] as raw from (select page_id, arr, unnest(generate_series(1, len(arr))) as n from ln0)),
st as (select page_id, n, {jtrim("split_part(raw, '#', 1)")} as t from ln),
fd as (select page_id, n, t, instr(t, ':') > 0 as c,
         lower(regexp_replace({jtrim("split_part(t, ':', 1)")}, '^\\x{{FEFF}}', '')) as f,
         {jtrim("substr(t, instr(t, ':') + 1)")} as v
       from st where t <> ''),
kd as (select *,
  case when not c then 'no_colon'
       when f = 'user-agent' then case when v = '' then 'agent_missing' else 'agent' end
       when f = 'allow' then 'allow'
       when f = 'disallow' then 'disallow'
       when f = 'crawl-delay' then case when try_cast(v as double) >= 0 then 'delay' else 'delay_invalid' end
       when f = 'request-rate' then case when regexp_full_match(v, '[+-]?[0-9]+[\\x00-\\x20]*/[\\x00-\\x20]*[+-]?[0-9]+')
                                          and try_cast({jtrim("split_part(v, '/', 1)")} as integer) > 0
                                          and try_cast({jtrim("split_part(v, '/', 2)")} as integer) > 0
                                     then 'rate' else 'rate_invalid' end
       when f = 'sitemap' then case when v <> '' and not regexp_matches(v, '\\s') and regexp_matches(lower(v), '^(https?://|/)') then 'sitemap'
                                    when v <> '' then 'sitemap_invalid' else 'sitemap_missing' end
       else 'unknown' end as k,
  case when f = 'crawl-delay' then try_cast(v as double) end as d,
  case when f = 'request-rate' then try_cast({jtrim("split_part(v, '/', 1)")} as integer) end as rq,
  case when f = 'request-rate' then try_cast({jtrim("split_part(v, '/', 2)")} as integer) end as rs
  from fd),
fa as (select page_id, min(n) as first_agent from kd where k = 'agent' group by page_id),
kf as (select kd.*, fa.first_agent from kd left join fa using (page_id)),
placed as (select * from kf where k in ('agent', 'allow', 'disallow', 'delay', 'rate') and n >= first_agent),
gs as (select *, case when k = 'agent' and coalesce(lag(k) over (partition by page_id order by n), '') <> 'agent' then 1 else 0 end as st
       from placed),
gn as (select *, cast(sum(st) over (partition by page_id order by n rows between unbounded preceding and current row) as bigint) as group_no from gs),
validp as (select distinct page_id from kd where k in ('agent', 'sitemap')),
sm as (select page_id, v as sitemap_url, min(n) as first_n from kd where k = 'sitemap' group by page_id, v),
links as (select sm.page_id, cap.robots_url, cap.robots_host, sm.sitemap_url, sm.first_n from sm join cap using (page_id))"""

WITH_A = "with " + CORPUS_A.strip() + "," + PARSE

DIM = """
dim(ord, country_key, country_name, suffix) as (values
  (1, 'france', 'France', '.fr'), (2, 'germany', 'Germany', '.de'),
  (3, 'russian-federation', 'Russian Federation', '.ru'), (4, 'russian-federation', 'Russian Federation', '.xn--p1ai'),
  (5, 'ukraine', 'Ukraine', '.ua'), (6, 'ukraine', 'Ukraine', '.xn--j1amh'),
  (7, 'united-kingdom', 'United Kingdom', '.gb'), (8, 'united-kingdom', 'United Kingdom', '.uk'))"""

# host of an absolute URL (no userinfo / port in the corpora); NULL if none
URL_HOST = "nullif(regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '')"
URL_PATH = ("case when regexp_matches({u}, '^[A-Za-z][A-Za-z0-9+.-]*:') "
            "then nullif(regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '') "
            "else regexp_extract({u}, '^([^?#]*)', 1) end")


def norm_host(x: str) -> str:
    return f"lower(regexp_replace({jtrim(x)}, '[.]$', ''))"


def tokens(x: str) -> str:
    """bigrams then unigrams of [A-Za-z0-9] runs, lowercased"""
    t = f"list_filter(list_transform(string_split_regex(coalesce({x}, ''), '[^A-Za-z0-9]+'), lambda s: lower(s)), lambda s: s <> '')"
    return (f"(list_transform(range(1, len({t})), lambda i: {t}[i] || '-' || {t}[i + 1]) || {t})")


def lang_region(u: str) -> str:
    host = URL_HOST.format(u=u)
    host_wo_last = f"regexp_replace(regexp_replace({host}, '[.]+$', ''), '[.]?[^.]*$', '')"
    path = URL_PATH.format(u=u)
    toks = f"({tokens(host_wo_last)} || {tokens(path)})"
    first = (f"list_filter({toks}, lambda s: s in ('uk', 'uk-ua', 'ua', 'ua-uk', 'ru', 'ru-ru', 'en-gb', 'en-uk', 'gb'))[1]")
    return (f"coalesce(case when {first} in ('uk', 'uk-ua', 'ua', 'ua-uk') then 'uk-UA' "
            f"when {first} in ('ru', 'ru-ru') then 'ru-RU' when {first} in ('en-gb', 'en-uk', 'gb') then 'en-GB' end, 'unknown')")


def classified_cte(dim: str = "dim") -> str:
    return f"""
lk as (select page_id, robots_url, robots_host, sitemap_url, {norm_host('robots_host')} as rh,
          {norm_host(URL_HOST.format(u='sitemap_url'))} as sh from links),
rmatch as (select lk.page_id, lk.sitemap_url, d.country_key, d.country_name, d.suffix,
             row_number() over (partition by lk.page_id, lk.sitemap_url order by length(d.suffix) desc, d.ord) as rn
           from lk join {dim} d on lk.rh = substr(d.suffix, 2) or ends_with(lk.rh, d.suffix)),
smatch as (select lk.page_id, lk.sitemap_url, d.country_key, d.country_name, d.suffix,
             row_number() over (partition by lk.page_id, lk.sitemap_url order by length(d.suffix) desc, d.ord) as rn
           from lk join {dim} d on lk.sh = substr(d.suffix, 2) or ends_with(lk.sh, d.suffix)),
cls as (select lk.page_id, lk.robots_url, lk.robots_host, lk.sitemap_url,
           coalesce(r.country_key, s.country_key) as country_key,
           coalesce(r.country_name, s.country_name) as country_name,
           coalesce(r.suffix, s.suffix) as matched_suffix,
           {lang_region('lk.sitemap_url')} as language_region
        from lk left join rmatch r on r.page_id = lk.page_id and r.sitemap_url = lk.sitemap_url and r.rn = 1
                left join smatch s on s.page_id = lk.page_id and s.sitemap_url = lk.sitemap_url and s.rn = 1
        where coalesce(r.country_key, s.country_key) is not null)"""

WITH_CLS = WITH_A + "," + DIM + "," + classified_cte()

ARCHIVE = ("concat('crawl-data/CC-MAIN-2024-33/segments/', cast(page_id // 10 as varchar), '/robotstxt/CC-MAIN-', "
           "lpad(cast(page_id // 10 as varchar), 5, '0'), '.warc.gz')")

ORACLE: dict[str, str] = {}

ORACLE["robots_directives"] = WITH_A + """
select page_id, cast(n as bigint) as line_no, f as field, v as value, k as kind from kd"""

ORACLE["robots_groups"] = WITH_A + """
select page_id, group_no,
  string_agg(case when k = 'agent' then lower(v) end, ',' order by n) as user_agents,
  arg_max(d, n) filter (where k = 'delay') as crawl_delay,
  cast(arg_max(rq, n) filter (where k = 'rate') as bigint) as rate_requests,
  cast(arg_max(rs, n) filter (where k = 'rate') as bigint) as rate_seconds,
  cast(count(*) filter (where k in ('allow', 'disallow')) as bigint) as n_rules
from gn group by page_id, group_no"""

ORACLE["robots_rules"] = WITH_A + """
select page_id, group_no, cast(row_number() over (partition by page_id, group_no order by n) as bigint) as rule_no,
  k as kind, v as path
from gn where k in ('allow', 'disallow')"""

ORACLE["robots_sitemaps"] = WITH_A + """
select page_id, cast(row_number() over (partition by page_id order by first_n) as bigint) as sitemap_no, sitemap_url
from sm where page_id in (select page_id from validp)"""

ORACLE["robots_warnings"] = WITH_A + """
select * from (
select page_id, cast(n as bigint) as line_number,
  case when k = 'no_colon' then 'Expected ''field: value'', found ''' || t || ''''
       when k = 'agent_missing' then 'Missing user-agent value'
       when k = 'delay_invalid' then 'Invalid crawl-delay value ''' || v || ''''
       when k = 'rate_invalid' then 'Invalid request-rate value ''' || v || ''''
       when k = 'sitemap_invalid' then 'Ignored invalid sitemap value ''' || v || ''''
       when k = 'sitemap_missing' then 'Missing sitemap value'
       when k in ('allow', 'disallow') and (first_agent is null or n < first_agent) then 'Ignored rule before user-agent'
       when k = 'delay' and (first_agent is null or n < first_agent) then 'Ignored crawl-delay before user-agent'
       when k = 'rate' and (first_agent is null or n < first_agent) then 'Ignored request-rate before user-agent'
  end as message
from kf) where message is not null"""

ORACLE["robots_valid_counts"] = WITH_A + f"""
, per as (select cap.page_id, {ARCHIVE} as archive_path, v.page_id is not null as valid,
            (select count(*) from sm where sm.page_id = cap.page_id) as nlinks
          from cap left join validp v using (page_id))
select archive_path, cast(count(*) filter (where valid) as bigint) as parsed_files,
  cast(count(*) filter (where not valid) as bigint) as rejected_files,
  cast(sum(case when valid then nlinks else 0 end) as bigint) as sitemap_links
from per group by archive_path"""

ORACLE["robots_groups_for_agent"] = WITH_A + """
, agents(agent) as (values ('Googlebot'), ('Bingbot'), ('a-crawler/1.0'), ('B'), ('CCBot/2.0'))
select distinct gn.page_id, a.agent, gn.group_no
from gn join agents a on gn.k = 'agent' and (lower(gn.v) = '*' or contains(lower(a.agent), lower(gn.v)))"""

ORACLE["sitemaps_classified"] = WITH_CLS + """
select page_id, robots_host, sitemap_url, country_key, country_name, matched_suffix, language_region from cls"""

ORACLE["sitemap_language_region"] = WITH_A + f"""
select page_id, sitemap_url, {lang_region('sitemap_url')} as language_region from links"""

ORACLE["sitemap_country_counts"] = WITH_CLS + """
select country_key, language_region, count(*) as links from cls group by country_key, language_region"""

ORACLE["filter_grouped"] = WITH_CLS + """
select 'country' as out_group, country_key as out_key, page_id, sitemap_url from cls
union all
select 'language-region' as out_group, language_region as out_key, page_id, sitemap_url from cls"""

ORACLE["one_country_sitemaps"] = (WITH_A + "," + DIM + ", dimu as (select * from dim where country_key = 'ukraine'),"
                                  + classified_cte("dimu") + """
select page_id, robots_host, sitemap_url, country_key, country_name, matched_suffix, language_region from cls""")


def slug_sql(x: str) -> str:
    return f"regexp_replace(regexp_replace(lower({jtrim(x)}), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g')"


ORACLE["select_country"] = "with " + DIM.strip() + f""",
q as (select page_id, (['Ukraine', ' united KINGDOM ', '.UA', 'ua', 'XN--P1AI', 'russia', 'Russian Federation!', 'de'])[page_id % 8 + 1] as query from pages),
qn as (select page_id, query, {slug_sql('query')} as qs,
         '.' || lower(regexp_replace({jtrim(f"regexp_replace({jtrim('query')}, '^[.]', '')")}, '[.]$', '')) as qsuf from q),
m as (select qn.page_id, d.ord, d.country_key, d.country_name from qn join dim d
        on {slug_sql('d.country_key')} = qn.qs or {slug_sql('d.country_name')} = qn.qs or d.suffix = qn.qsuf),
best as (select page_id, arg_min(country_key, ord) as country_key, arg_min(country_name, ord) as country_name from m group by page_id)
select qn.page_id, qn.query, best.country_key, best.country_name from qn left join best using (page_id)"""

ORACLE["idn_hosts"] = """
with h as (select page_id, regexp_replace(regexp_extract(url, '^https?://([^/?#]+)', 1), '[.](com|net|org)$', '') as sld from pages)
select page_id, sld || '.' || (['укр', 'рф', 'УКР.', 'ua'])[page_id % 4 + 1] as host,
  lower(sld) || '.' || (['xn--j1amh', 'xn--p1ai', 'xn--j1amh', 'ua'])[page_id % 4 + 1] as ascii_host,
  (['ukraine', 'russian-federation', 'ukraine', 'ukraine'])[page_id % 4 + 1] as country_key
from h"""

ORACLE["manifest_slice"] = """
with l as (select page_id as line_no, case page_id % 5
    when 0 then '  crawl-data/CC-MAIN-2024-33/segments/' || cast(page_id as varchar) || '/robotstxt/CC-MAIN-' || cast(page_id as varchar) || '.warc.gz  '
    when 1 then '# comment ' || cast(page_id as varchar)
    when 2 then ''
    when 3 then 'crawl-data/CC-MAIN-2024-33/segments/' || cast(page_id as varchar) || '/wat/CC-MAIN-' || cast(page_id as varchar) || '.warc.wat.gz'
    else 'https://data.commoncrawl.org/crawl-data/x/' || cast(page_id as varchar) || '/robotstxt/r.warc.gz' end as value
  from pages),
a as (select line_no, trim(value) as archive_path from l),
m as (select *, row_number() over (order by line_no) as rn from a
      where archive_path <> '' and not starts_with(archive_path, '#') and contains(archive_path, '/robotstxt/')
        and ends_with(archive_path, '.warc.gz'))
select cast(line_no as bigint) as line_no, archive_path,
  case when regexp_matches(archive_path, '^[A-Za-z][A-Za-z0-9+.-]*:') then archive_path
       else 'https://data.commoncrawl.org/' || ltrim(archive_path, '/') end as archive_uri
from m where rn > 3 and rn <= 43"""

SAFE = "regexp_replace({x}, '[^A-Za-z0-9._-]', '_', 'g')"

ORACLE["capture_file_names"] = WITH_A.split(",\nln0 as")[0] + f"""
, c as (select page_id, robots_url,
    strftime(make_timestamp((1722470400 + page_id * 37) * 1000000), '%Y-%m-%dT%H:%M:%SZ') as capture_date,
    {ARCHIVE} as archive_path,
    lower(regexp_extract(robots_url, '^[a-z]+://([^/]+)', 1)) as host,
    regexp_extract(robots_url, '^([a-z]+)://', 1) as scheme from cap)
select page_id, {SAFE.format(x='host')} || '/' || {SAFE.format(x='scheme')} || '-' || {SAFE.format(x='capture_date')} || '-'
  || substr(sha256(robots_url || chr(10) || capture_date || chr(10) || archive_path), 1, 16) || '.txt' as file_name
from c"""

ORACLE["archive_names"] = f"""
with a as (select distinct {ARCHIVE} as archive_path from pages)
select archive_path, 'archive-' || substr(sha256(archive_path), 1, 16) || '.sitemaps.tsv' as file_name from a"""

TSVF = "translate({x}, chr(9) || chr(13) || chr(10), '   ')"


def tsv_sql(*xs: str) -> str:
    return "concat_ws(chr(9), " + ", ".join(TSVF.format(x=f"coalesce({x}, '')") for x in xs) + ")"


ORACLE["tsv_rows"] = WITH_A + f"""
, lk as (select page_id, robots_host, sitemap_url, row_number() over (partition by page_id order by first_n) as sitemap_no
         from links where page_id in (select page_id from validp)),
ln2 as (select page_id, sitemap_no,
  case page_id % 6
    when 0 then {tsv_sql("'/data/robots/' || robots_host || '/https-' || cast(page_id as varchar) || '.txt'", 'robots_host', "'https'", 'sitemap_url')}
    when 1 then {tsv_sql("'/data/robots/' || robots_host || '/https-' || cast(page_id as varchar) || '.txt'", 'robots_host', 'sitemap_url')}
    when 2 then {tsv_sql("'/data/robots/' || robots_host || '/https-' || cast(page_id as varchar) || '.txt'", 'robots_host', "'https'", 'sitemap_url', "'extra'")}
    when 3 then {tsv_sql("'/data/robots/' || robots_host || '/https-' || cast(page_id as varchar) || '.txt'", "''", "'https'", 'sitemap_url')}
    when 4 then {tsv_sql("'/data/robots/' || robots_host || '/https-' || cast(page_id as varchar) || '.txt'", 'robots_host', "'https'", 'sitemap_url', "'ukraine'", "'Ukraine'", "'.ua'", "'uk-UA'")}
    else {tsv_sql("'/data/robots/' || robots_host || '/https-' || cast(page_id as varchar) || '.txt'", 'robots_host', "'https'", "''")}
  end as value from lk),
f as (select page_id, sitemap_no, string_split(value, chr(9)) as f from ln2)
select page_id, cast(sitemap_no as bigint) as sitemap_no,
  case when len(f) = 4 and f[2] <> '' and f[4] <> '' then 'ok' else 'malformed' end as strict_status,
  case when len(f) >= 4 and f[4] <> '' then 'ok' else 'malformed' end as seed_status,
  case when len(f) >= 3 and f[3] <> '' then 'ok' else 'malformed' end as link_status,
  case when len(f) = 4 and f[2] <> '' and f[4] <> '' then f[2] end as robots_host,
  case when len(f) = 4 and f[2] <> '' and f[4] <> '' then f[4] end as sitemap_url,
  case when len(f) >= 4 and f[4] <> '' then f[4] end as seed_sitemap_url,
  case when len(f) >= 3 and f[3] <> '' then f[3] end as page_url
from f"""

ORACLE["tsv_encode"] = WITH_A.split(",\nln0 as")[0] + f"""
select page_id, {tsv_sql('robots_url', 'robots_host', 'body')} as line from cap"""

ORACLE["fetch_policy"] = """
with g as (select page_id,
    case page_id % 3 when 0 then url
         when 1 then 'https://data.commoncrawl.org/crawl-data/' || cast(page_id as varchar) || '.warc.gz'
         else 'https://DS5Q9OXWQWSFJ.cloudfront.net/' || cast(page_id as varchar) end as url,
    case when page_id % 11 = 10 then null else ([200, 403, 404, 408, 425, 429, 500, 502, 503, 504])[page_id % 10 + 1] end as status,
    page_id % 6 + 1 as attempt
  from pages),
b as (select *, lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)) in
        ('data.commoncrawl.org', 'ds5q9oxwqwsfj.cloudfront.net', 'commoncrawl.s3.amazonaws.com') as bucket from g)
select page_id, url, cast(status as bigint) as status, cast(attempt as bigint) as attempt,
  cast(case when bucket then 1000 else 4 end as bigint) as max_attempts,
  (status is null or status in (408, 425, 429, 500, 502, 503, 504) or (status = 403 and bucket)) as retryable,
  cast(case when bucket then 1000 else least(30000, 1000 * pow(2, attempt - 1)) end as bigint) as backoff_ms,
  (status is null or status in (408, 425, 429, 500, 502, 503, 504) or (status = 403 and bucket))
    and attempt < (case when bucket then 1000 else 4 end) as will_retry
from b"""

ORACLE["kafka_payload"] = """
select page_id, '{"url":' || to_json(url) || '}' as value from pages"""

CORPUS_B = r"""
docs as (
  select page_id, 'idx' as typ, 'https://s.example.ua/idx-' || cast(page_id as varchar) || '.xml' as url, url as page_url,
    case when page_id < 25 then (case when page_id % 5 < 4 then page_id + 1 else page_id - 4 end)
         when page_id % 30 < 29 then page_id + 1 else page_id - 29 end as next_id
  from pages
  union all
  select page_id, 'sm' as typ, 'https://s.example.ua/sm-' || cast(page_id as varchar) || '.xml' as url, url as page_url, null as next_id
  from pages
)"""

ORACLE["sitemap_docs"] = "with " + CORPUS_B.strip() + """
select url,
  case when typ = 'idx' then 'sitemapindex' when page_id % 6 in (0, 1, 2, 3) then 'urlset' else 'invalid' end as kind,
  case when typ = 'idx' then 'sm-' || cast(page_id as varchar) || '.xml https://s.example.ua/idx-' || cast(next_id as varchar) || '.xml'
       when page_id % 6 = 0 then page_url || ' /p/' || cast(page_id as varchar) || ' mailto:a@example.ua'
       when page_id % 6 in (1, 2, 3) then page_url end as locs,
  case when typ = 'sm' and page_id % 6 = 4 then 'Unsupported sitemap root element: html'
       when typ = 'sm' and page_id % 6 = 5 then 'Invalid text sitemap URL: not a url' end as error
from docs"""

ORACLE["resolve_loc"] = """
with r as (
  select page_id, url as base, regexp_extract(url, '^(https?://[^/?#]*)', 1) as origin,
         regexp_extract(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '^(.*/)', 1) as dir,
         regexp_extract(url, '^(https?)://', 1) as scheme,
         list_concat(regexp_extract_all(html, 'href="([^"]*)"', 1),
                     ['?a=1', '', '../../x', 'HTTP://Example.UA/a//b', '//cdn.example.ua/x', 'mailto:a@b', 'a b', 'x/./y/../z']) as refs
  from pages),
x as (select page_id, origin, dir, scheme, refs, unnest(generate_series(1, len(refs))) as i from r)
select page_id, cast(i - 1 as bigint) as ref_no, refs[i] as ref,
  case refs[i]
    when '?a=1' then origin || dir || '?a=1'
    when '' then origin || dir
    when '../../x' then origin || case length(dir) - length(replace(dir, '/', '')) - 1
                                    when 0 then '/../../x' when 1 then '/../x'
                                    else regexp_replace(dir, '[^/]+/[^/]+/$', '') || 'x' end
    when 'HTTP://Example.UA/a//b' then 'HTTP://Example.UA/a/b'
    when '//cdn.example.ua/x' then scheme || '://cdn.example.ua/x'
    when 'mailto:a@b' then null
    when 'a b' then null
    when 'x/./y/../z' then origin || dir || 'x/z'
    else origin || refs[i] end as resolved
from x"""

CRAWL = "with recursive " + CORPUS_B.strip() + """,
edges as (
  select url as src, 'https://s.example.ua/sm-' || cast(page_id as varchar) || '.xml' as dst from docs where typ = 'idx'
  union all
  select url as src, 'https://s.example.ua/idx-' || cast(next_id as varchar) || '.xml' as dst from docs where typ = 'idx'),
walk(seed_id, url, depth) as (
  select page_id, url, 0 from docs where typ = 'idx'
  union
  select w.seed_id, e.dst, w.depth + 1 from walk w join edges e on e.src = w.url where w.depth < 20),
visited as (select seed_id, url, min(depth) as depth from walk group by seed_id, url),
vis as (select v.seed_id, v.url, d.typ, d.page_id, d.page_url,
          case when d.url is null then 'failed'
               when d.typ = 'idx' or d.page_id % 6 in (0, 1, 2, 3) then 'parsed' else 'invalid' end as status
        from visited v left join docs d on d.url = v.url),
links as (
  select seed_id, url as sitemap_url, page_url from vis where typ = 'sm' and page_id % 6 in (0, 1, 2, 3)
  union all
  select seed_id, url as sitemap_url, 'https://s.example.ua/p/' || cast(page_id as varchar) as page_url
  from vis where typ = 'sm' and page_id % 6 = 0)"""

ORACLE["crawl_links"] = CRAWL + """
select seed_id, sitemap_url, page_url from links"""

ORACLE["crawl_counters"] = CRAWL + """,
c as (select seed_id, count(*) filter (where status = 'parsed') as d, count(*) filter (where status = 'invalid') as i,
        count(*) filter (where status = 'failed') as f from vis group by seed_id),
l as (select seed_id, count(*) as n from links group by seed_id)
select c.seed_id, cast(c.d as bigint) as downloaded_sitemaps, cast(c.i as bigint) as invalid_sitemaps,
  cast(c.f as bigint) as failed_downloads, cast(coalesce(l.n, 0) as bigint) as saved_links
from c left join l using (seed_id)"""


def unescape_sql(x: str) -> str:
    # named entities only (the pages hold no numeric ones); '&amp;' last = one pass
    for ent, ch in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "''"), ("&nbsp;", "' || chr(160) || '")]:
        x = f"replace({x}, '{ent}', '{ch}')"
    return f"replace({x}, '&amp;', '&')"


ORACLE["html_rows"] = f"""
with a as (select page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) as hrefs,
                  regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) as labels from pages),
x as (select page_id, hrefs, labels, unnest(generate_series(1, len(hrefs))) as i from a where len(hrefs) > 0)
select page_id, cast(i as bigint) as link_no, hrefs[i] as href, {unescape_sql('labels[i]')} as label from x
union all
select page_id, cast(0 as bigint) as link_no, null as href,
  {unescape_sql("regexp_extract(html, '<title>([^<]*)</title>', 1)")} as label from pages"""

ORACLE["warc_roundtrip"] = WITH_A + """
select c.robots_url as target_url,
  strftime(make_timestamp((1722470400 + c.page_id * 37) * 1000000), '%Y-%m-%dT%H:%M:%SZ') as capture_date,
  (['', 'gzip', 'deflate', 'deflate, gzip'])[c.page_id % 4 + 1] as content_encoding,
  c.body, v.page_id is not null as valid,
  cast((select count(*) from sm where sm.page_id = c.page_id) as bigint) as sitemap_links
from cap c left join validp v using (page_id)"""

ORACLE["warc_split_roundtrip"] = WITH_A + """,
r as (select robots_url as target_url,
  strftime(make_timestamp((1722470400 + page_id * 37) * 1000000), '%Y-%m-%dT%H:%M:%SZ') as capture_date,
  'gzip' as content_encoding, body, cast(null as varchar) as error from cap)
select 'all' as selected, * from r
union all select 'ua' as selected, * from r where target_url like '%.ua/robots.txt'"""

ORACLE["stream_equals_batch"] = WITH_A + "," + DIM + "," + classified_cte() + f""",
cl2 as (select cls.*, '/data/robots/' || robots_host || '/https-' || cast(page_id as varchar) || '.txt' as fpath from cls)
select {tsv_sql('fpath', 'robots_host', "'https'", 'sitemap_url', 'country_key', 'country_name', 'matched_suffix', 'language_region')} as value,
  'country' as out_group, country_key as out_key from cl2
union all
select {tsv_sql('fpath', 'robots_host', "'https'", 'sitemap_url', 'country_key', 'country_name', 'matched_suffix', 'language_region')} as value,
  'language-region' as out_group, language_region as out_key from cl2"""


LINEITEM_PAGES = """pages_li as (
  select l_orderkey * 8 + l_linenumber as page_id,
    (case when l_linenumber % 2 = 0 then 'https' else 'http' end) || '://s' || cast(l_orderkey % 997 as varchar) || '.example.'
      || (['com', 'net', 'org'])[l_orderkey % 3 + 1] || '/p/' || cast(l_orderkey as varchar) as url
  from (select distinct l_orderkey, l_linenumber from lineitem))"""

ORACLE["sitemap_country_counts_lineitem"] = ("with " + LINEITEM_PAGES + "," + CORPUS_A.strip().replace(
    "from pages\n), p1", "from pages_li\n), p1") + "," + PARSE + "," + DIM + "," + classified_cte() + """
select country_key, language_region, count(*) as links from cls group by country_key, language_region""")

ORACLE["local_tree_roundtrip"] = WITH_A + """
select cap.robots_host, regexp_extract(cap.robots_url, '^([a-z]+)://', 1) as robots_scheme,
  regexp_extract(cap.robots_url, '^([a-z]+)://', 1) || '-' || cast(cap.page_id as varchar) || '.txt' as file_name,
  sm.sitemap_url
from sm join cap using (page_id)
where sm.page_id in (select page_id from validp)"""

ORACLE["sitemaps_classified_loaded_dim"] = ORACLE["sitemaps_classified"]

# --- robots parsing over real text, agents of a table, long references, jobs ---

WITH_TEXT = "with cap as (select doc_id as page_id, '' as robots_url, '' as robots_host, text as body from documents)," + PARSE

ORACLE["robots_directives_text"] = WITH_TEXT + """
select page_id as doc_id, cast(n as bigint) as line_no, f as field, v as value, k as kind from kd"""

ORACLE["robots_warnings_text"] = ORACLE["robots_warnings"].replace(WITH_A, WITH_TEXT).replace(
    "select page_id, cast(n", "select page_id as doc_id, cast(n")

ORACLE["robots_groups_for_agent_table"] = WITH_A + """
, agents as (select distinct n_name as agent from nation)
select distinct gn.page_id, a.agent, gn.group_no
from gn join agents a on gn.k = 'agent' and (lower(gn.v) = '*' or contains(lower(a.agent), lower(gn.v)))"""

ORACLE["resolve_long"] = """
with p as (select page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) as root,
             regexp_replace(html, '[^A-Za-z0-9]+', '-', 'g') as x from pages)
select page_id, cast(0 as bigint) as ref_no, sha256(root || '/' || x) as resolved_sha256 from p
union all select page_id, 1, sha256(root || '/p?' || x || '=%41' || x) from p
union all select page_id, 2, sha256(root || '/' || x || '/') from p"""

DATE = "strftime(make_timestamp((1722470400 + page_id * 37) * 1000000), '%Y-%m-%dT%H:%M:%SZ')"

ORACLE["robots_job_rerun"] = WITH_A + f"""
select robots_url as target_url, {DATE} as capture_date, body from cap where page_id in (select page_id from validp)"""

ORACLE["sitemaps_job_rerun"] = WITH_A + f"""
select {DATE} as capture_date, robots_url, sitemap_url from links
where page_id in (select page_id from validp) and (page_id // 10) % 2 = 0"""

ORACLE["snapshot_jobs"] = WITH_CLS + """
select 'before' as state, robots_url as a, sitemap_url as b from links where page_id in (select page_id from validp)
union all
select 'after', robots_url, sitemap_url from links where page_id in (select page_id from validp) and (page_id // 10) % 2 = 0
union all select 'group', 'country', country_key from cls where page_id % 4 <> 2
union all select 'group', 'language-region', language_region from cls where page_id % 4 <> 2"""

ORACLE["manifest_sitemaps_job"] = WITH_A + f"""
select cast(page_id // 10 as varchar) as archive_key, {DATE} as capture_date, robots_url, sitemap_url from links
where page_id in (select page_id from validp)"""

ORACLE["filter_job_rerun"] = ORACLE["stream_equals_batch"].replace("from cl2", "from cl2 where page_id % 2 = 0")

ORACLE["job_failures"] = """
select 'https://o' || cast(o_orderkey as varchar) || '.example.ua/robots.txt' as robots_url,
  case when o_orderkey % 10 = 0 then 'failed' else 'link' end as outcome from orders"""

ORACLE["fetch_rows"] = """
with p as (select cast(page_id as varchar) || '.html' as n, octet_length(encode(html)) as b from pages)
select n as name, 'file' as scheme, cast(200 as bigint) as status, cast(b as bigint) as n_bytes, cast(1 as bigint) as attempts, cast(null as varchar) as problem from p
union all select 'no-' || n, 'file', null, null, 1, 'FileNotFoundError' from p
union all select n, 'gopher', null, null, 0, 'Unsupported URI scheme' from p"""

ORACLE["country_sitemaps_job"] = (WITH_A + "," + DIM + ", dimu as (select * from dim where country_key = 'ukraine'),"
                                  + classified_cte("dimu") + f"""
select {DATE} as capture_date, cap.robots_url, cls.sitemap_url, country_key, country_name, matched_suffix, language_region
from cls join cap using (page_id)""")

ORACLE["local_country_job"] = (WITH_A + "," + DIM + ", dimu as (select * from dim where country_key = 'ukraine'),"
                               + classified_cte("dimu") + f""",
cl2 as (select cls.*, '/data/robots/' || robots_host || '/https-' || cast(page_id as varchar) || '.txt' as fpath from cls)
select {tsv_sql('fpath', 'robots_host', "'https'", 'sitemap_url', 'country_key', 'country_name', 'matched_suffix', 'language_region')} as value from cl2""")

ORACLE["publish_stream"] = """select '{"url":"' || url || '"}' as value from pages where page_id % 5 <> 4"""

ORACLE["job_counters"] = WITH_CLS + """
, l as (select page_id, page_id % 6 = 0 as ok from links where page_id in (select page_id from validp))
select 'filter' as job, 'read_rows' as counter, cast(count(*) filter (where ok) as bigint) as value from l
union all select 'filter', 'malformed_rows', count(*) filter (where not ok) from l
union all select 'filter', 'kept_rows', count(*) from cls where page_id % 6 = 0
union all select 'publish', 'rows', count(*) from pages
union all select 'publish', 'malformed_rows', count(*) from pages where page_id % 5 = 4
union all select 'publish', 'sent_urls', count(*) from pages where page_id % 5 <> 4"""

ORACLE["manifest_stream"] = WITH_CLS + f"""
select 'country' as out_group, country_key as out_key, {DATE} as capture_date, cap.robots_url, cls.sitemap_url from cls join cap using (page_id)
union all
select 'language-region', language_region, {DATE}, cap.robots_url, cls.sitemap_url from cls join cap using (page_id)"""

ORACLE["publish_once_stream"] = "select distinct value from (" + ORACLE["publish_stream"] + ")"

ORACLE["publish_ledger"] = ORACLE["publish_stream"] + """
union all select 'rows=' || cast(count(*) as varchar) from pages
union all select 'malformed_rows=' || cast(count(*) filter (page_id % 5 = 4) as varchar) from pages
union all select 'sent=' || cast(count(*) filter (page_id % 5 <> 4) as varchar) from pages"""

ORACLE["robots_quality_report"] = WITH_A + """,
w as (""" + ORACLE["robots_warnings"].removeprefix(WITH_A).strip() + """),
e as (select page_id, regexp_extract(robots_host, '[^.]*$') as ending, page_id not in (select page_id from validp) as bad from cap),
f as (select ending, count(*) as files, count(*) filter (where bad) as rejected from e group by ending),
k as (select ending, regexp_extract(message, '^[A-Za-z-]+(?: [a-z-]+)*') as kind, count(*) as n from w join e using (page_id) group by all)
select ending, 'any' as kind, cast(coalesce((select sum(n) from k where k.ending = f.ending), 0) as bigint) as warnings, true as in_bound,
  cast(files as bigint) as files, cast(rejected as bigint) as rejected_files from f
union all select ending, kind, cast(n as bigint), true, null, null from k"""

ORACLE["country_archive_counts"] = WITH_A + "," + DIM + ", dimu as (select * from dim where country_key = 'ukraine')," + classified_cte("dimu") + """,
per as (select page_id // 10 as key, page_id in (select page_id from validp) as valid,
          case when page_id in (select page_id from validp) then (select count(*) from sm where sm.page_id = cap.page_id) else 0 end as n,
          (select count(*) from cls where cls.page_id = cap.page_id and cls.page_id in (select page_id from validp)) as m from cap),
u as (select cast(key as varchar) as unit, cast(count(*) filter (valid) as bigint) as parsed_files,
        cast(count(*) filter (not valid) as bigint) as rejected_files, cast(sum(m) as bigint) as matched_links,
        cast(sum(n) as bigint) as sitemap_links from per group by key)
select * from u union all
select 'total', cast(sum(parsed_files) as bigint), cast(sum(rejected_files) as bigint), cast(sum(matched_links) as bigint), null from u"""

ORACLE["local_download_jobs"] = CRAWL.replace("with recursive ", "with recursive " + CORPUS_A.strip() + "," + PARSE.replace(
    "links as (", "a_links as (") + ",") + """,
got as (select * from links where seed_id % 7 <> 6), seen as (select * from vis where seed_id % 7 <> 6)
select 'local' as output, cap.robots_host || ' ' || regexp_extract(cap.robots_url, '^([a-z]+)://', 1) || ' ' || sm.sitemap_url as line
from sm join cap using (page_id) where sm.page_id in (select page_id from validp)
union all select 'download', 'https://s.example.ua/idx-' || cast(seed_id as varchar) || '.xml ' || sitemap_url || ' ' || page_url from got
union all select 'local counter', 'parsed_files=' || count(*) filter (page_id in (select page_id from validp)) from cap
union all select 'local counter', 'rejected_files=' || count(*) filter (page_id not in (select page_id from validp)) from cap
union all select 'download counter', 'read_rows=' || count(*) filter (page_id % 7 <> 6) from pages
union all select 'download counter', 'malformed_rows=' || count(*) filter (page_id % 7 = 6) from pages
union all select 'download counter', 'downloaded_sitemaps=' || count(*) filter (status = 'parsed') from seen
union all select 'download counter', 'invalid_sitemaps=' || count(*) filter (status = 'invalid') from seen
union all select 'download counter', 'failed_downloads=' || count(*) filter (status = 'failed') from seen
union all select 'download counter', 'saved_links=' || count(*) from got"""

ORACLE["packed_sitemap_docs"] = "with plain as (" + ORACLE["sitemap_docs"] + """),
p as (select *, cast(regexp_extract(url, '-([0-9]+)[.]xml$', 1) as bigint) as page_id, contains(url, '/sm-') as sm from plain),
q as (select *, sm and page_id % 9 = 0 and page_id % 6 in (0, 1, 2, 4) as refused from p)
select url, case when refused then 'invalid' else kind end as kind, case when not refused then locs end as locs,
  case when refused then 'Invalid sitemap XML: entity declarations are not supported' else error end as error from q"""

ORACLE["root_zone_dimension"] = """
with d as (select trim(regexp_replace(lower(n_name), '[^a-z0-9]+', '-', 'g'), '-') as country_key, n_name as country_name,
             '.n' || cast(n_nationkey as varchar) as suffix from nation where n_nationkey % 5 <> 0)
select 'dimension' as part, * from d
union all select 'supported', country_key, null, null from (select distinct country_key from d order by country_key limit 12)"""

ORACLE["sitemap_location_rows"] = "with d as (" + ORACLE["sitemap_docs"] + """),
l as (select url, kind, string_split(locs, ' ') as locs from d where locs is not null),
i as (select url, kind, locs, unnest(generate_series(1, len(locs))) as i from l)
select url, kind, error, cast(0 as bigint) as loc_no, cast(null as varchar) as loc from d
union all select url, kind, null, cast(i as bigint), locs[i] from i"""
