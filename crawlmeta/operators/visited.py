"""The set of visited (root, url) pairs of a level-by-level crawl.

While its counted bytes are few, the set is broadcast into the anti join of a
level. Beyond that it has two parts:

* a table bucketed by (root, url). A level deals its candidates into the same
  buckets, so the candidates are shuffled and the visited pairs are not;
* a Bloom filter of ``WORDS`` 64-bit words. Each level adds its pairs with a
  grouped ``bit_or`` per word (at most ``WORDS`` short rows reach the driver) and
  the words go to all tasks. Candidates are probed where they are made. A pair
  that the filter does not know is new without a join; only hits meet the table.

The filter never grows: a fuller one gives more hits, and the exact join decides
about them. Results do not depend on it.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

SCHEMA = "root string, url string, depth int"
#: 64-bit words of the filter (8 MB) and bits set per pair.
WORDS, HASHES = 1 << 20, 4
BUCKETS = 64


def _positions() -> list[Column]:
    """Bit numbers of a pair: two hashes, combined."""
    bits = WORDS * 64
    a = F.pmod(F.xxhash64("root", "url"), F.lit(bits))
    b = F.pmod(F.xxhash64("url", "root", F.lit(1)), F.lit(bits))
    return [F.pmod(a + i * b + i * i, F.lit(bits)) for i in range(HASHES)]


def filter_words(pairs: DataFrame) -> DataFrame:
    """(word, bits) that the pairs set; one row per word."""
    at = pairs.select(F.explode(F.array(*_positions())).alias("p"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(63).cast("int"))
    return at.groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))


def probe(words) -> Column:
    """Column: the pair may be in the set. ``words`` is a broadcast array of uint64."""
    @F.pandas_udf("boolean")
    def known(*positions: pd.Series) -> pd.Series:
        table = words.value
        hit = np.ones(len(positions[0]), bool)
        for p in positions:
            at = p.to_numpy(np.uint64)
            hit &= (table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return pd.Series(hit)

    return known(*_positions())


class Visited:
    """Levels of a crawl, written to ``folder`` as they come."""

    def __init__(self, spark, folder: str, broadcast_bytes: int):
        self.spark, self.folder, self.limit = spark, folder.rstrip("/"), broadcast_bytes
        self.bytes = 0
        self.table: str | None = None
        self.words: np.ndarray | None = None
        self.shared = None

    def all(self) -> DataFrame:
        """All levels so far: root, url, depth."""
        return self.spark.read.schema(SCHEMA).parquet(f"{self.folder}/levels")

    def add(self, pairs: DataFrame, depth: int) -> tuple[DataFrame, int, int]:
        """Write a level (root, url): its table, rows and bytes."""
        obs = Observation(f"level_{depth}")
        size = F.coalesce(F.sum(F.octet_length("root") + F.octet_length("url") + 32), F.lit(0))
        path = f"{self.folder}/levels/depth={depth}"
        pairs.observe(obs, F.count(F.lit(1)).alias("n"), size.alias("bytes")).write.parquet(path)
        level = self.spark.read.schema("root string, url string").parquet(path)
        n, n_bytes = obs.get["n"], obs.get["bytes"]
        self.bytes += n_bytes
        if self.bytes > self.limit:
            self._extend(level if self.table else self.all().select("root", "url"))
        return level, n, n_bytes

    def _extend(self, pairs: DataFrame) -> None:
        mode = "append" if self.table else "overwrite"
        self.table = self.table or f"visited_{uuid.uuid4().hex}"
        (pairs.repartition(BUCKETS, "root", "url").write.mode(mode).format("parquet").bucketBy(BUCKETS, "root", "url")
         .option("path", f"{self.folder}/buckets").saveAsTable(self.table))
        if self.words is None:
            self.words = np.zeros(WORDS, np.uint64)
        made = filter_words(pairs).toPandas()
        self.words[made.word.to_numpy(np.int64)] |= made.bits.to_numpy(np.int64).view(np.uint64)
        self.shared = self.spark.sparkContext.broadcast(self.words)

    def unseen(self, candidates: DataFrame) -> DataFrame:
        """The distinct pairs (root, url) of ``candidates`` that no level has."""
        pairs = candidates.select("root", "url")
        if not self.table:
            return pairs.join(F.broadcast(self.all().select("root", "url")), ["root", "url"], "left_anti").distinct()
        dealt = (pairs.withColumn("hit", probe(self.shared)).repartition(BUCKETS, "root", "url")
                 .groupBy("root", "url").agg(F.max("hit").alias("hit")))
        known = self.spark.table(self.table)
        held = dealt.where("hit").select("root", "url").hint("merge").join(known, ["root", "url"], "left_anti")
        return dealt.where("NOT hit").select("root", "url").unionByName(held)

    def close(self) -> None:
        """Forget the table's name (its files stay with the folder)."""
        if self.table:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
