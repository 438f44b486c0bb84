"""Document fingerprints by I-Match over randomised lexicons.

Terms are lower-cased runs of letters and digits. Document frequencies over all
texts give the lexicon: terms whose inverse document frequency lies in a band.
The band's upper end bounds it: at most (mean distinct terms per text) /
LEAST_SHARE terms can be in LEAST_SHARE of all texts, whatever the input, so the
lexicon is a small sorted array of hashes that every executor gets.

A fingerprint has one hash per randomised subset of the lexicon: of the sorted
distinct terms of the text in that subset. Subsets come in several densities, so
that short and long texts have some that hold few of their terms; a subset that
holds more than MOST_TERMS of a text's terms is not filled by it. Densities go on as
texts get longer: a text of n terms takes the twelve densities that end at about 2/n (2^-12
for texts of up to 4,095 terms); a density always has the same place in the
fingerprint, and shares it with the one 2^12 times as dense. A text with terms that
fills no subset fills the first with all its terms. The likeness of two
fingerprints is the share of equal hashes among subsets that either fills.

Defined cases: a null text is empty; a text with terms but none in the band uses
all its terms; a text without terms fills no subset, and two such
texts have likeness 1; equal texts have equal fingerprints; ties of ids are
ordered by the text's hash; a null id comes first; the next of the last document
is the first (a lone document is its own next); an empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlmeta.llm.common import Words, blocks, mix64, to_bytes

#: Band of document frequency as a share of all texts.
LEAST_SHARE, MOST_SHARE = 0.001, 0.25
#: Subsets per density, and the density of each group as a power of one half.
PER_DENSITY = 8
DENSITIES = tuple(range(1, 13))
#: Terms of a text that a subset may hold to count: larger hits break with any edit.
MOST_TERMS = 3
#: Bytes of text in a range of ids, a task's work.
PART_BYTES = 16 << 20
SUBSETS = PER_DENSITY * len(DENSITIES)
_SEEDS = np.random.default_rng(8).integers(1, 2**63, SUBSETS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CHUNK = 4096
_GAP = np.ones(256, bool)
_GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def terms(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Sorted distinct term hashes of each text."""
    for a, b in blocks(texts):
        w = Words(texts[a:b], space=_GAP)
        for i in range(b - a):
            yield np.unique(w.hash[w.first[i]:w.first[i + 1]])


def lexicon(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Sorted hashes of the terms in the band, from all texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            h, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *terms(to_bytes(pdf.text))]), return_counts=True)
            yield pd.DataFrame({"h": h.view(np.int64), "n": n})

    n_docs = docs.count()
    df = docs.select(F.col(text_col).alias("text")).mapInPandas(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    kept = df.where((F.col("n") >= LEAST_SHARE * n_docs) & (F.col("n") <= max(1.0, MOST_SHARE * n_docs))).select("h")
    return np.sort(kept.toPandas().h.to_numpy(np.int64).view(np.uint64))


def fingerprints(texts: list[bytes], words: np.ndarray) -> np.ndarray:
    """One 32-bit hash per text and subset; 0 for a subset that the text does not fill."""
    out = np.zeros((len(texts), SUBSETS), np.uint32)
    with np.errstate(over="ignore"):
        for i, t in enumerate(terms(texts)):
            if len(words):
                at = np.minimum(np.searchsorted(words, t), len(words) - 1)
                banded = t[words[at] == t]
                t = banded if len(banded) else t
            if not len(t):
                continue
            # the densities of this text's length, each at its own place
            on = max(0, len(t).bit_length() - _CHUNK.bit_length() + 1)
            density = np.array([1 + on + (g - on) % len(DENSITIES) for g in range(len(DENSITIES))])
            shift = np.repeat((64 - density).astype(np.uint64), PER_DENSITY)
            found = []
            for a in range(0, len(t), _CHUNK):
                chance = mix64(t[a:a + _CHUNK, None] * _SEEDS)
                subset, term = np.nonzero(((chance >> shift) == 0).T)
                found.append((subset, mix64(chance[term, subset] ^ t[a + term])))
            subset, mixed = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(subset, kind="stable")
            subset, mixed = subset[order], mixed[order]
            if len(subset):
                first = np.flatnonzero(np.concatenate([[True], subset[1:] != subset[:-1]]))
                # terms are sorted and distinct, so a sum of mixed hashes stands for the sorted list
                total = np.add.reduceat(mixed, first)
                few = np.diff(np.append(first, len(subset))) <= MOST_TERMS
                out[i, subset[first][few]] = np.maximum(mix64(total[few]) >> np.uint64(32), 1)
            if not out[i].any():
                out[i, 0] = max(int(mix64(mix64(t).sum(keepdims=True))[0]) >> 32, 1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal hashes among the subsets that a or b fills, row by row."""
    filled = (a != 0) | (b != 0)
    n = filled.sum(1)
    return np.where(n == 0, 1.0, ((a == b) & filled).sum(1) / np.maximum(n, 1))


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """Rows (doc_id, text) dealt into ranges of ids and sorted, each range followed by the first
    row of the next one (tail true). Only range bounds and first ids, two per range, pass the driver."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))).alias("place"))
    known = rows.where("doc_id IS NOT NULL")
    inner = sorted(set(known.approxQuantile("place", [i / parts for i in range(1, parts)], 0.25 / parts))) if parts > 1 else []
    bounds = [float("-inf"), *(inner or [0.0]), float("inf")]  # a Bucketizer wants two ranges or more
    dealt = Bucketizer(splits=bounds, inputCol="place", outputCol="b").transform(rows).withColumn("range", F.col("b").cast("int"))
    heads = dealt.groupBy("range").agg(F.min("place").alias("place")).orderBy("range").collect()
    to = [(h.place, heads[i - 1].range) for i, h in enumerate(heads)]
    spark = docs.sparkSession
    firsts = spark.createDataFrame(to or [(0.0, -1)], "place double, range int")
    tails = rows.join(F.broadcast(firsts), "place").select("doc_id", "text", "range", F.lit(True).alias("tail"))
    own = dealt.select("doc_id", "text", "range", F.lit(False).alias("tail"))
    return (own.union(tails).repartitionById(parts, "range").withColumn("h", F.xxhash64("text"))
            .sortWithinPartitions("range", "tail", F.col("doc_id").asc_nulls_first(), "h"))


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the beginning of the next."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    words = spark.sparkContext.broadcast(lexicon(rows))
    if parts is None:
        size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        parts = max(spark.sparkContext.defaultParallelism, -(-size // PART_BYTES))

    def made(pairs: list[tuple]) -> pd.DataFrame:
        texts = [t for _, t, _ in pairs] + [pairs[-1][2]]
        own = fingerprints(to_bytes(texts), words.value)
        changed = [edited(t, f) for _, t, f in pairs]
        other = fingerprints(to_bytes(changed), words.value)
        # the next text of a pair is the text of the pair after it, or closes its range
        following = own[1:].copy()
        for i, (_, _, f) in enumerate(pairs[:-1]):
            if f is not pairs[i + 1][1]:
                following[i] = fingerprints(to_bytes([f]), words.value)[0]
        return pd.DataFrame({
            "doc_id": pd.array([d for d, _, _ in pairs], "Int64"), "n_chars": [len(t) for _, t, _ in pairs],
            "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
            "fingerprint": [x.astype(">u4").tobytes().hex() for x in own[:-1]],
            "edited_fingerprint": [x.astype(">u4").tobytes().hex() for x in other],
            "near_edited": likeness(own[:-1], other), "near_next": likeness(own[:-1], following)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting, closed, pairs, size = None, None, [], 0
        for pdf in batches:
            ids = [None if pd.isna(x) else int(x) for x in pdf.doc_id]
            for doc, text, part, tail in zip(ids, pdf["text"], pdf["range"], pdf["tail"]):
                if part == closed:
                    continue  # a further row with the first id of the next range
                if waiting:
                    pairs.append((*waiting, text))
                    size += len(text)
                waiting, closed = (None, part) if tail else ((doc, text), None)
                if size > 1 << 21:
                    yield made(pairs)
                    pairs, size = [], 0
        if pairs:
            yield made(pairs)

    return with_next(rows, max(1, parts)).mapInPandas(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
             "edited_fingerprint string, near_edited double, near_next double")
