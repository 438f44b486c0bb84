"""Fetch stage: URL or path -> bytes, as an Arrow batch function.

``file:`` URLs (and scheme-less paths when ``allow_local``) are read from
the filesystem; ``http``/``https`` are downloaded with the retry policy of
``crawlmeta.functions.policy``; other schemes fail. Each Python worker keeps
a minimum gap between request starts, so the request rate of a job is
(fetch tasks) / delay: size the fetch partitions for politeness. URLs are
de-duplicated before fetching and spread by host.
"""

from __future__ import annotations

import re
import time
import urllib.error
import urllib.request
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlmeta.functions import policy
from crawlmeta.sources.files import open_input

FETCH_SCHEMA = "url string, status int, body binary, attempts int, error string"
USER_AGENT = "crawlmeta/0.1"
# Rows and bytes of bodies of one Arrow batch that a fetch task yields.
BATCH_ROWS = 256
BATCH_BYTES = 4 << 20

_next_start = [0.0]


def _wait(delay_s: float) -> None:
    if delay_s <= 0:
        return
    now = time.monotonic()
    start = max(_next_start[0], now)
    _next_start[0] = start + delay_s
    if start > now:
        time.sleep(start - now)


def _bucket(url: str) -> bool:
    from urllib.parse import urlsplit
    try:
        h = urlsplit(url).hostname
    except ValueError:
        return False
    return h is not None and h.lower() in policy.CRAWL_BUCKET_HOSTS


def _open_url(url: str, connect_timeout: float, read_timeout: float):
    """An open response: the first timeout holds until the server answers, the second between reads."""
    req = urllib.request.Request(url, headers={"User-Agent": USER_AGENT})
    response = urllib.request.urlopen(req, timeout=connect_timeout)
    connection = getattr(getattr(response.fp, "raw", None), "_sock", None)
    if connection is not None:
        connection.settimeout(read_timeout)
    return response


def with_retries(url: str, take, connect_timeout: float, read_timeout: float, delay: float):
    """``take(response)`` under the retry policy: (its result, status, attempts,
    error). Whatever an attempt raises is retried, but for an HTTP status
    that the policy takes as final."""
    bucket = _bucket(url)
    attempts = policy.BUCKET_MAX_ATTEMPTS if bucket else policy.DEFAULT_MAX_ATTEMPTS
    backoff = policy.RETRY_DELAY_MS / 1000.0
    status = last = None
    for attempt in range(1, attempts + 1):
        _wait(delay)
        status = None
        try:
            with _open_url(url, connect_timeout, read_timeout) as response:
                return take(response), response.status, attempt, None
        except urllib.error.HTTPError as ex:
            status = ex.code
            retry = status in policy.TRANSIENT_STATUS_CODES or status == 403 and bucket
            details = error_text(ex.read() or b"")
            last = (f"GET {url} returned {status} {ex.reason} "
                    f"({'retryable' if retry else 'non-retryable'} HTTP response)" + (f": {details}" if details else ""))
            if not retry:
                return None, status, attempt, last
        except Exception as ex:  # noqa: BLE001  (any failed request is an attempt; it becomes a row)
            last = f"{type(ex).__name__}: {ex}"
        if attempt < attempts:
            time.sleep(backoff)
            backoff = policy.RETRY_DELAY_MS / 1000.0 if bucket else min(backoff * 2, policy.MAX_BACKOFF_MS / 1000.0)
    return None, status, attempts, f"GET {url} failed after {attempts} attempts: {last}"


def error_text(body: bytes) -> str:
    """The first three lines of an error response in one; lines end with CR or LF only."""
    lines = re.split("\r\n|\n|\r", body.decode("utf-8", "replace"))
    if lines[-1] == "":
        lines.pop()
    return " ".join(lines[:3])[:240]


def _fetch(url: str, take, allow_local: bool, connect_timeout: float, read_timeout: float, delay: float):
    """``take(stream)`` of a file or of an HTTP response: (result, status, attempts, error)."""
    scheme = url.split(":", 1)[0].lower() if ":" in url.split("/", 1)[0] else None
    if scheme == "file" or (scheme is None and allow_local):
        try:
            with open_input(url) as f:
                return take(f), 200, 1, None
        except OSError as ex:
            return None, None, 1, f"{type(ex).__name__}: {ex}"
    if scheme is None:
        return None, None, 0, "Local paths are not allowed for this fetch"
    if scheme not in ("http", "https"):
        return None, None, 0, f"Unsupported URI scheme: {scheme}"
    return with_retries(url, take, connect_timeout, read_timeout, delay)


def fetch_one(url: str, allow_local: bool = False, connect_timeout: float = policy.DEFAULT_CONNECT_TIMEOUT_S,
              read_timeout: float = policy.DEFAULT_READ_TIMEOUT_S, delay: float = policy.DEFAULT_DELAY_S):
    body, status, attempts, error = _fetch(url, lambda f: f.read(), allow_local, connect_timeout, read_timeout, delay)
    return url, status, body, attempts, error


def fetch(urls: DataFrame, url_col: str = "url", allow_local: bool = False, delay: float = policy.DEFAULT_DELAY_S,
          partitions: int | None = None, host_spread: int = 1, connect_timeout: float = policy.DEFAULT_CONNECT_TIMEOUT_S,
          read_timeout: float = policy.DEFAULT_READ_TIMEOUT_S) -> DataFrame:
    """Distinct URLs -> (url, status, body, attempts, error).

    The number of tasks is ``partitions`` (by default the larger of shuffle
    partitions and parallelism), which adaptive execution leaves alone: the
    few MB of URLs stand for hours of waiting. ``http``/``https`` URLs of one host
    go to at most ``host_spread`` tasks (1 = one task per host, the polite default);
    raise it to split a host that holds a large share of the URLs, at the cost of
    more parallel requests to it. Other URLs ask no host and go to any task."""
    if host_spread < 1:
        raise ValueError("host_spread must be >= 1")
    from crawlmeta.session import ship_package
    spark = urls.sparkSession
    ship_package(spark)
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    u = urls.select(F.col(url_col).alias("url")).distinct()
    asked = F.when(F.col("url").rlike("(?i)^https?:"), F.try_parse_url(F.col("url"), F.lit("HOST")))
    host = F.coalesce(asked, F.col("url"))
    u = u.repartition(n, host, F.pmod(F.xxhash64("url"), F.lit(host_spread)))

    def run(batches):
        made = (fetch_one(x, allow_local, connect_timeout, read_timeout, delay) for pdf in batches for x in pdf["url"])
        for rows in _batches(made):
            yield pd.DataFrame(rows, columns=["url", "status", "body", "attempts", "error"], dtype=object)

    return u.mapInPandas(run, FETCH_SCHEMA)


def _batches(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Rows in lists of at most BATCH_ROWS, each ended by the body that reaches BATCH_BYTES."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2] or b"")
        if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def download_to(url: str, dest: str, allow_local: bool = True, delay: float = 0,
                connect_timeout: float = policy.DEFAULT_CONNECT_TIMEOUT_S,
                read_timeout: float = policy.DEFAULT_READ_TIMEOUT_S,
                chunk: int = 8 << 20) -> tuple[str, str | None, str | None]:
    """Stream one URL (file: / local path / http(s)) into ``dest`` chunk by
    chunk, never holding the whole body. Returns (url, dest or None, error)."""
    import shutil

    from crawlmeta.sources.files import open_output

    def store(stream) -> None:
        with open_output(dest) as out:
            shutil.copyfileobj(stream, out, chunk)

    _, _, _, error = _fetch(url, store, allow_local, connect_timeout, read_timeout, delay)
    return url, dest if error is None else None, error
