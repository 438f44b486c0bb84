"""String column helpers: Java-compatible trim, TSV encoding, slugs,
hashes and generated file names. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's String.trim removes every character at or below U+0020; Spark's
# trim removes spaces only, so we pass the full set to btrim.
JAVA_TRIM_CHARS = "".join(chr(c) for c in range(0x21))
BOM = "\ufeff"

# Line ends recognised when a text is read line by line: CRLF, LF, lone CR.
LINE_BREAK = "\r\n|\n|\r"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c: Column | str) -> Column:
    return F.btrim(col(c), F.lit(JAVA_TRIM_CHARS))


def strip_bom(c: Column | str) -> Column:
    """Drop one leading U+FEFF."""
    x = col(c)
    return F.when(x.startswith(BOM), F.substr(x, F.lit(2))).otherwise(x)


def text_lines(c: Column | str) -> Column:
    """Lines of a text with no trailing empty line after a final break,
    so ``a\\n`` has one line and ``\\n`` has one empty line."""
    body = F.regexp_replace(col(c), "(" + LINE_BREAK + ")$", "")
    return F.split(body, LINE_BREAK, -1)


def tsv_field(c: Column | str) -> Column:
    """TAB, CR and LF each become one space (NULL becomes empty)."""
    return F.translate(F.coalesce(col(c), F.lit("")), "\t\r\n", "   ")


def tsv_row(*cols: Column | str) -> Column:
    return F.concat_ws("\t", *[tsv_field(c) for c in cols])


def tsv_fields(c: Column | str) -> Column:
    """Split a TSV line keeping empty trailing fields."""
    return F.split(col(c), "\t", -1)


def safe_path_part(c: Column | str) -> Column:
    return F.regexp_replace(col(c), "[^A-Za-z0-9._-]", "_")


def sha256_hex(c: Column | str) -> Column:
    return F.sha2(col(c), 256)


def sha256_hex16(c: Column | str) -> Column:
    return F.substring(F.sha2(col(c), 256), 1, 16)


def slug(c: Column | str) -> Column:
    """Lowercase, runs of non [a-z0-9] become '-', one '-' cut at each end."""
    dashed = F.regexp_replace(F.lower(java_trim(c)), "[^a-z0-9]+", "-")
    return F.regexp_replace(dashed, "^-|-$", "")
