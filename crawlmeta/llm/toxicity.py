"""Toxicity by multiple-instance learning.

A text is a bag of sentences. Each sentence has a logistic score over hashed
words and word beginnings, and the text is toxic when any sentence is: the scores
combine by noisy-or, P = 1 - product(1 - p). Only document labels train it; the
sentence scores then locate the offending sentences.

The model is fitted on a bounded sample of labelled rows by full-batch Adam with
an L1 step; scoring is a pandas UDF over whole texts, without shuffle.

Defined cases: null and empty texts have no sentence and score 0; a sample
without labels, or with one label only, gives weights zero and the share of label
1 to every text that has words; null labels and ids are not learnt from; repeated
rows count as often as they occur; an empty table gives an empty result; further
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmeta.llm.common import Words, blocks, to_bytes
from crawlmeta.session import ship_package
from crawlmeta.llm.quality_rules import labelled_sample

#: Labelled rows that a model is fitted on at most, chosen by a hash of the id.
SAMPLE_ROWS = 12_000
BITS = 18
BUCKETS = 1 << BITS
#: Bytes of the word beginnings that are features beside the word itself.
PREFIXES = (4, 6, 8)
#: Standard deviations by which a feature's documents must differ from the
#: overall share of label 1, and documents it needs, to get a weight.
LEAST_Z = 5.0
LEAST_DOCS = 8
_GAP = np.ones(256, bool)
_GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_END = np.zeros(256, bool)
_END[list(b".!?\n")] = True


class Sentences:
    """Sentences of a block of texts that have words: features of sentence i are
    ``feature[at[i]:at[i + 1]]``; ``doc`` is its text, ``start`` and ``end`` its bytes there."""

    def __init__(self, texts: list[bytes]):
        w = Words(texts, space=_GAP)
        ends = np.cumsum(_END[w.raw])
        name = w.doc.astype(np.int64) * (len(w.raw) + 1) + ends[w.start] if len(w.start) else np.zeros(0, np.int64)
        fresh = np.concatenate([[True], name[1:] != name[:-1]]) if len(name) else np.zeros(0, bool)
        first = np.flatnonzero(fresh)
        size = w.end - w.start
        n = 1 + np.array([np.searchsorted(PREFIXES, k) for k in range(PREFIXES[-1] + 2)])[
            np.minimum(size, PREFIXES[-1] + 1)] if len(size) else np.zeros(0, np.int64)
        place = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
        self.feature = np.empty(int(place[-1]), np.int32)
        self.feature[place[:-1]] = w.hash >> np.uint64(64 - BITS)
        for k, width in enumerate(PREFIXES):
            longer = size > width
            h = w.span_hash(w.start[longer], w.start[longer] + width)
            with np.errstate(over="ignore"):
                h = h * np.uint64(2 * width + 0x9E3779B97F4A7C15)
            self.feature[place[:-1][longer] + 1 + k] = h >> np.uint64(64 - BITS)
        self.at = np.concatenate([place[first], place[-1:]])
        self.doc = w.doc[first]
        shift = w.text_start[self.doc] if len(first) else np.zeros(0, np.int64)
        last = np.concatenate([first[1:], [len(size)]])[: len(first)] - 1
        self.start, self.end = w.start[first] - shift, w.end[last] - shift


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[at[1:]] - total[at[:-1]]


class NoisyOr:
    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    @classmethod
    def fit(cls, bags: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = 160, rate: float = 0.15,
            penalty: float = 0.02) -> NoisyOr:
        """``bags`` has a label, sentence bounds and features for each document.
        Features that tell nothing are left out before anything is joined."""
        y = np.array([b[0] for b in bags], float)
        sentences = np.array([max(0, len(at) - 1) for _, at, _ in bags], np.int64)
        if not sentences.sum() or y.min() == y.max():
            share = (y.sum() + 1) / (len(y) + 2)
            per_doc = max(1.0, sentences.sum() / max(1, len(y)))
            return cls(np.zeros(BUCKETS, np.float32), float(np.log(np.expm1(-np.log1p(-share) / per_doc))))
        in_all, in_toxic = np.zeros(BUCKETS), np.zeros(BUCKETS)
        for label, _, feature in bags:
            present = np.unique(feature)
            in_all[present] += 1
            in_toxic[present] += label
        share = y.mean()
        spread = np.sqrt(np.maximum(in_all * share * (1 - share), 1e-9))
        telling = (in_all >= LEAST_DOCS) & (np.abs(in_toxic - in_all * share) >= LEAST_Z * spread)
        kept = [telling[feature] for _, _, feature in bags]
        at = np.concatenate([[0], np.cumsum(np.concatenate([
            np.diff(np.concatenate([[0], np.cumsum(k)])[bounds]) for k, (_, bounds, _) in zip(kept, bags)]))])
        used, feature = np.unique(np.concatenate([f[k] for k, (_, _, f) in zip(kept, bags)]), return_inverse=True)
        bounds = np.concatenate([[0], np.cumsum(sentences)])
        sentence = np.repeat(np.arange(bounds[-1]), np.diff(at))
        w, m, v = (np.zeros(len(used) + 1) for _ in range(3))
        w[-1] = -6.0
        for step in range(1, epochs + 1):
            z = np.clip(_sums(w[feature], at) + w[-1], -30, 30)
            soft = np.logaddexp(0, z)
            total = np.maximum(_sums(soft, bounds), 1e-12)
            pull = np.where(y == 1, -1 / np.maximum(np.expm1(total), 1e-9), 1.0)
            g_z = np.repeat(pull, np.diff(bounds)) / (1 + np.exp(-z)) / len(y)
            g = np.append(np.bincount(feature, g_z[sentence], len(used)), g_z.sum())
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            pace = rate / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
            w -= pace * m / (1 - 0.9 ** step)
            w[:-1] = np.sign(w[:-1]) * np.maximum(np.abs(w[:-1]) - rate * penalty, 0)
        weights = np.zeros(BUCKETS, np.float32)
        weights[used] = w[:-1]
        return cls(weights, float(w[-1]))

    def sentence_logits(self, s: Sentences) -> np.ndarray:
        return np.clip(_sums(self.weights[s.feature], s.at) + self.bias, -30, 30)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros(len(texts))
        for a, b in blocks(texts):
            s = Sentences(texts[a:b])
            total = np.bincount(s.doc, np.logaddexp(0, self.sentence_logits(s)), b - a)
            out[a:b] = -np.expm1(-total)
        return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE_ROWS,
        id_col: str = "doc_id", text_col: str = "text") -> NoisyOr:
    """Fit on the sample; tasks send features, not texts."""
    sample = labelled_sample(docs, labels, label, rows, id_col, text_col)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = []
            for t, y in zip(to_bytes(pdf.text), pdf.label):
                s = Sentences([t])
                made.append((int(y), s.at.astype(np.int32).tobytes(), s.feature.tobytes()))
            yield pd.DataFrame(made, columns=["label", "at", "feature"])

    got = sorted((r.label, bytes(r.feature), bytes(r.at)) for r in
                 sample.mapInPandas(features, "label int, at binary, feature binary").toLocalIterator())
    return NoisyOr.fit([(y, np.frombuffer(a, np.int32), np.frombuffer(f, np.int32)) for y, f, a in got])


def score_column(docs: DataFrame, model: NoisyOr, text: Column) -> Column:
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(NoisyOr(*shared.value).scores(to_bytes(texts)), index=texts.index)

    return score(text)


def offending_sentences(docs: DataFrame, model: NoisyOr, threshold: float = 0.5, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """Sentences whose own score reaches the threshold: doc_id, start, length (characters), score, sentence."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = NoisyOr(*shared.value)
        for pdf in batches:
            out = []
            for doc, t in zip(pdf.doc_id, to_bytes(pdf.text)):
                s = Sentences([t])
                p = 1 / (1 + np.exp(-own.sentence_logits(s)))
                for i in np.flatnonzero(p >= threshold):
                    found = t[s.start[i]:s.end[i]].decode("utf-8", "replace")
                    out.append((doc, len(t[:s.start[i]].decode("utf-8", "replace")), len(found), float(p[i]), found))
            yield pd.DataFrame(out, columns=["doc_id", "start", "length", "score", "sentence"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "doc_id long, start long, length long, score double, sentence string")
