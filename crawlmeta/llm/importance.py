"""Importance resampling towards a target: hashed features, log ratios, Gumbel top draws.

Features are runs of consecutive words; a feature's bucket is the CRC-32 of its
bytes modulo the number of buckets. Words come from an Aho-Corasick automaton.
The texts of a block are folded to bytes in which every delimiter is a space;
the block's distinct words, bounded by a space on both sides, are the
dictionary, and each carries its CRC and its length as payload. A scan of a text
emits one payload per word. The CRC of a run of words is composed of adjacent
payloads (a CRC moves over n more bytes by a linear map of its bits), so no run
is ever cut out or hashed as a string. A dictionary lives as long as its block
(``BLOCK_BYTES`` of text, or one text that is longer).

The corpus is scanned twice: for bucket counts (an array per task, merged by a
grouped sum) and for scores, with one gain per bucket. Scores get their random
term from the id alone. The draw is a range sort over all tasks: rows are dealt
by score, numbered inside each task, and the rows of the tasks before are added.

Defined cases: a null or empty text has no features and weight 0; a null id
draws its random term from the empty string and goes after other ids in a tie;
rows that repeat an id are scored and ranked one by one; an empty table gives no
rows; with an empty target every gain follows from T = 0; only id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlmeta.llm.common import blocks, shared_folder, to_bytes, written
from crawlmeta.session import ship_package

BUCKETS = 10_000
_ROW_BITS = 33  # bits below the task number in monotonically_increasing_id()
_PAYLOAD = itemgetter(1)


def _folded_bytes() -> bytes:
    """A-Z to a-z; every ASCII byte that is no letter or digit to a space."""
    table = bytearray(range(256))
    for b in range(128):
        table[b] = b if chr(b).isalnum() else 32
    for b in range(65, 91):
        table[b] = b + 32
    return bytes(table)


_FOLD = _folded_bytes()


def _crc_tables() -> list[np.ndarray]:
    """Entry k moves a CRC-32 over 2^k zero bytes: four tables of 256, one per byte of the CRC."""
    step = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)
    byte = np.arange(256, dtype=np.uint32)
    one = np.stack([step, *[byte << np.uint32(s) for s in (0, 8, 16)]])
    made = [one]
    while len(made) < 40:
        made.append(_moved(made[-1], made[-1]))
    return made


def _moved(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = tables[0][crc & np.uint32(255)]
    for i in (1, 2, 3):
        out = out ^ tables[i][(crc >> np.uint32(8 * i)) & np.uint32(255)]
    return out


_MOVES = _crc_tables()


def crc_joined(left: np.ndarray, right: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of a + b from those of a and b and the bytes of b."""
    for k in range(int(size.max(initial=0)).bit_length()):
        far = (size >> k) & 1 == 1
        left = np.where(far, _moved(_MOVES[k], left), left)
    return left ^ right


def payload(word: bytes) -> int:
    return zlib.crc32(word) | len(word) << 32


class Dictionary:
    """Automaton over the distinct words of a block of folded texts."""

    def __init__(self, texts: list[bytes]):
        import ahocorasick

        self.words: set[bytes] = set()
        for t in texts:
            self.words.update(t.split(b" "))
        self.words.discard(b"")
        self.automaton = ahocorasick.Automaton()
        for w in self.words:
            self.automaton.add_word(f" {w.decode('latin-1')} ", payload(w))
        if self.words:
            self.automaton.make_automaton()

    def payloads(self, text: bytes) -> np.ndarray:
        """Payload of every word of a folded text, in order."""
        if not self.words:
            return np.zeros(0, np.uint64)
        return np.fromiter(map(_PAYLOAD, self.automaton.iter(f" {text.decode('latin-1')} ")), np.uint64)


def run_crcs(payloads: np.ndarray, least: int, most: int) -> np.ndarray:
    """CRC of every run of ``least`` to ``most`` words joined by single spaces."""
    crc, size = payloads.astype(np.uint32), (payloads >> np.uint64(32)).astype(np.int64)
    spaced = crc_joined(np.full(len(crc), zlib.crc32(b" "), np.uint32), crc, size) if most > 1 else crc
    runs, out = crc, []
    for n in range(1, most + 1):
        if n > 1:
            runs = crc_joined(runs[:-1], spaced[n - 1:], size[n - 1:] + 1)
        if n >= least:
            out.append(runs)
        if not len(runs):
            break
    return np.concatenate([np.zeros(0, np.uint32), *out])


def feature_buckets(texts, least: int, most: int, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per text: number of words, bucket of every feature."""
    folded = [t.translate(_FOLD) for t in to_bytes(texts)]
    for a, b in blocks(folded):
        known = Dictionary(folded[a:b])
        for t in folded[a:b]:
            found = known.payloads(t)
            yield len(found), run_crcs(found, least, most) % np.uint32(buckets)


def bucket_counts(docs: DataFrame, least: int = 1, most: int = 1, buckets: int = BUCKETS,
                  text_col: str = "text") -> DataFrame:
    """bucket, n: features of all texts, repeats counted. At most ``buckets`` rows."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for pdf in batches:
            for _, found in feature_buckets(pdf.t, least, most, buckets):
                total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at.astype(np.int32), "n": total[at]})

    parts = docs.select(F.col(text_col).alias("t")).mapInPandas(run, "bucket int, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, gain for every bucket; both arguments are bucket counts."""
    spark = corpus.sparkSession
    total = lambda df: float(df.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    s_all, t_all = total(corpus), total(target)
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = (every.join(corpus.withColumnRenamed("n", "s"), "bucket", "left")
            .join(target.withColumnRenamed("n", "t"), "bucket", "left").na.fill(0, ["s", "t"]))
    ratio = (F.col("t") + 1.0) * (s_all + float(buckets)) / ((F.col("s") + 1.0) * (t_all + float(buckets)))
    return both.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def noise(id_column: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the id alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(F.encode(text, "UTF-8"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def scored(docs: DataFrame, gains: DataFrame, least: int = 1, most: int = 1, buckets: int = BUCKETS,
           seed: int = 2024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight, score. ``gains`` has one short row per bucket and goes to all tasks."""
    spark = docs.sparkSession
    ship_package(spark)
    gain = np.zeros(buckets, np.int64)
    for r in gains.collect():
        gain[r.bucket] = r.gain
    shared = spark.sparkContext.broadcast(gain)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_bucket = shared.value
        for pdf in batches:
            if len(pdf):
                made = [(n, len(found), int(by_bucket[found].sum()))
                        for n, found in feature_buckets(pdf.t, least, most, buckets)]
                yield pd.DataFrame(made, columns=["n_words", "n_features", "weight"]).assign(doc_id=pdf.doc_id.array)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    made = rows.mapInPandas(run, f"n_words long, n_features long, weight long, doc_id {kind}")
    return made.select("doc_id", "n_words", "n_features", "weight",
                       (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score"))


def drawn(rows: DataFrame, folder: str, percent: int, least_words: int) -> DataFrame:
    """``rows`` (a table) with ``rank`` for the best ``percent`` of those that have ``least_words`` words."""
    order = [F.col("open").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("tie")]
    # A number of its own for every row lets the range dealing cut between equal rows.
    keyed = rows.withColumns({"open": F.col("n_words") >= least_words, "tie": F.monotonically_increasing_id()})
    placed = written(keyed.repartitionByRange(*order).sortWithinPartitions(*order)
                     .withColumn("place", F.monotonically_increasing_id()), folder, "ordered")
    task, row = F.shiftright("place", _ROW_BITS), F.col("place").bitwiseAND((1 << _ROW_BITS) - 1)
    sizes = placed.where("open").groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n"))
    # One row per task from here: a window and a broadcast over as many rows as the sort had tasks.
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    allowed = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] * percent // 100
    at = F.col("start") + row + 1
    return (placed.withColumn("task", task).join(F.broadcast(starts), "task", "left")
            .withColumn("rank", F.when(F.col("open") & (at <= allowed), at)).drop("task", "start", "open", "tie", "place"))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20,
             runs: tuple[int, int] = (1, 1), buckets: int = BUCKETS, seed: int = 2024, folder: str | None = None,
             id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """Every document: doc_id, n_words, n_features, weight, score, rank (null where not drawn)."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "importance")
    corpus = written(bucket_counts(docs, *runs, buckets, text_col), folder, "corpus")
    wanted = written(bucket_counts(target, *runs, buckets, target_col), folder, "target")
    gains = bucket_gains(corpus, wanted, buckets)
    table = written(scored(docs, gains, *runs, buckets, seed, id_col, text_col), folder, "scored")
    return drawn(table, folder, percent, least_words)
