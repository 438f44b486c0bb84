"""Fetch retry policy as column functions (usable in SQL, testable as a grid).

A failed request is retried when it raised without a status (connection
error, timeout) or returned a transient status; crawl-bucket hosts also
retry 403 and allow many more attempts at a fixed delay, other hosts back
off exponentially up to a cap.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlmeta.functions.text import col
from crawlmeta.functions.url import try_parse_url

# Crawl-bucket download hosts, transient HTTP statuses,
# attempt limits and delays (milliseconds).
CRAWL_BUCKET_HOSTS = ("data.commoncrawl.org", "ds5q9oxwqwsfj.cloudfront.net", "commoncrawl.s3.amazonaws.com")
TRANSIENT_STATUS_CODES = (408, 425, 429, 500, 502, 503, 504)
DEFAULT_MAX_ATTEMPTS = 4
BUCKET_MAX_ATTEMPTS = 1000
RETRY_DELAY_MS = 1000
MAX_BACKOFF_MS = 30_000
DEFAULT_CONNECT_TIMEOUT_S = 10
DEFAULT_READ_TIMEOUT_S = 30
DEFAULT_DELAY_S = 1


def is_bucket_url(u: Column | str) -> Column:
    return F.coalesce(F.lower(try_parse_url(u, "HOST")).isin(*CRAWL_BUCKET_HOSTS), F.lit(False))


def max_attempts(u: Column | str) -> Column:
    return F.when(is_bucket_url(u), F.lit(BUCKET_MAX_ATTEMPTS)).otherwise(F.lit(DEFAULT_MAX_ATTEMPTS))


def retryable(u: Column | str, status: Column | str) -> Column:
    """NULL status (the request raised) is retried; so are transient codes,
    and 403 from a crawl-bucket host."""
    s = col(status)
    return s.isNull() | s.isin(*TRANSIENT_STATUS_CODES) | ((s == 403) & is_bucket_url(u))


def backoff_ms(u: Column | str, attempt: Column | str) -> Column:
    """Sleep after failed attempt ``attempt`` (1-based)."""
    exp = F.least(F.lit(float(MAX_BACKOFF_MS)), F.lit(float(RETRY_DELAY_MS)) * F.pow(F.lit(2.0), col(attempt) - 1))
    return F.when(is_bucket_url(u), F.lit(RETRY_DELAY_MS)).otherwise(exp).cast("long")


def will_retry(u: Column | str, status: Column | str, attempt: Column | str) -> Column:
    return retryable(u, status) & (col(attempt) < max_attempts(u))
