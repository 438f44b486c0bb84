"""Exact deduplication by a 128-bit content hash.

Rows are grouped on (128-bit hash, normalised text): the hash spreads groups
over tasks, and grouping on the text itself compares bytes, so a hash collision
never merges two texts. Copies meet in the map-side aggregate first, which keeps
a large group of copies to one row per task. Each row then looks its group up by
hash and SHA-256, a join of short rows whose hot keys adaptive execution splits.

Defined cases: null text is empty text; white space runs count as one space; a
null id never stays when its group has a row with an id (a group of null ids
has keep_id null and all its rows count as kept); rows that repeat id and text
share one decision, and ``keep_first`` returns them once (rows of a group of null
ids each); an empty table gives an empty result; only id and text are read, and
``keep_first`` returns all columns as they are, whatever they are named.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmeta.llm.common import unused

# Fixed pattern of the contract: characters that count as white space.
SPACE_RUN = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def content_hash(text: Column) -> Column:
    """128 bits of the normalised text."""
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           hash_fn: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per distinct text: h, sha, keep_id, group_size."""
    rows = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("t"))
    return (rows.groupBy(hash_fn(F.col("t")).alias("h"), "t")
            .agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
            .select("h", F.sha2(F.encode("t", "UTF-8"), 256).alias("sha"), "keep_id", "group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                hash_fn: Callable[[Column], Column] = content_hash) -> DataFrame:
    """Every row's decision: doc_id, keep_id, group_size, kept, text_sha256."""
    t = normalised(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), t.alias("t")).select(
        "doc_id", hash_fn(F.col("t")).alias("h"), F.sha2(F.encode("t", "UTF-8"), 256).alias("sha"))
    return (rows.join(groups(docs, id_col, text_col, hash_fn), ["h", "sha"])
            .select("doc_id", "keep_id", "group_size",
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.col("sha").alias("text_sha256")))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               hash_fn: Callable[[Column], Column] = content_hash) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, once each."""
    h, sha, keep, t_h, t_sha, row = unused(docs.columns, "__h", "__sha", "__keep", "__t_h", "__t_sha", "__row")
    found = groups(docs, id_col, text_col, hash_fn).select(
        F.col("h").alias(h), F.col("sha").alias(sha), F.col("keep_id").alias(keep))
    t, own = normalised(F.col(f"`{text_col}`")), F.col(f"`{id_col}`")
    # Rows without an id are no repetitions of each other: each has a number of its own.
    number = F.when(own.isNull(), F.monotonically_increasing_id()).otherwise(0)
    tagged = docs.withColumns({t_h: hash_fn(t), t_sha: F.sha2(F.encode(t, "UTF-8"), 256), row: number})
    on = (F.col(t_h) == F.col(h)) & (F.col(t_sha) == F.col(sha)) & own.eqNullSafe(F.col(keep))
    staying = tagged.join(found, on, "left_semi")
    return staying.dropDuplicates([t_h, t_sha, id_col, row]).select(*[F.col(f"`{c}`") for c in docs.columns])
