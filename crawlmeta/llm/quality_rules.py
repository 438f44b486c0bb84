"""Quality classifier: a sparse rule ensemble compiled into Spark columns.

Statistics of a text (one array of numbers per row, made by a pandas UDF) are
the only inputs. Small boosted trees are grown over a bounded sample of labelled
rows, every path from a root to a node becomes a conjunctive rule, and a logistic
regression with an L1 penalty keeps few rules. The rules, with their weights,
are one Spark column expression: scoring is a projection without shuffle.

Defined cases: null and empty texts have all statistics zero and get a score
like any text; a sample without labels, or with one label only, gives the
smoothed share of label 1 to every row; rows that repeat an id count as often as
they occur; labels that are null or whose id is null are not learnt from; an
empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmeta.llm.common import Words, blocks, is_train, to_bytes, unused
from crawlmeta.session import ship_package

#: Labelled rows that a model is fitted on at most, chosen by a hash of the id.
SAMPLE_ROWS = 20_000
STATISTICS = ["bytes", "words", "lines", "word_bytes", "upper", "digits", "spaces", "punctuation", "symbols",
              "high_bytes", "bars", "exclaims", "stops", "commas", "distinct_words", "top_word", "distinct_lines",
              "line_bytes", "longest_word", "upper_words", "capital_words", "bare_words", "words_per_stop",
              "repeated_pairs"]

_CLASS = np.zeros(256, np.uint8)
for _k, _chars in enumerate([b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"\t\n\x0b\x0c\r ", b"\"'()-:;?/",
                             b"#$%&*+<=>@[\\]^_`{}~", bytes(range(128, 256)), b"|", b"!", b".", b","], start=1):
    _CLASS[list(_chars)] = _k


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of STATISTICS per text."""
    out = np.zeros((len(texts), len(STATISTICS)), np.float32)
    for a, b in blocks(texts):
        w = Words(texts[a:b], lower=False)
        n = b - a
        size = np.array([len(t) for t in texts[a:b]], float)
        start, end = w.text_start[:-1], w.text_start[1:] - 1
        cls = _CLASS[w.raw]

        def per_text(hit: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(hit)])
            return (total[end] - total[start]).astype(float)

        def per_words(value: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(value)])
            return (total[w.first[1:]] - total[w.first[:-1]]).astype(float)

        words = np.diff(w.first).astype(float)
        lines = per_text(w.raw == 10) + (size > 0)
        length = w.end - w.start
        head, second = cls[w.start], cls[np.minimum(w.start + 1, len(cls) - 1)]
        capital = head == 1
        upper = capital & (second == 1) & (length > 1)
        bare = (head == 0) | capital
        share = np.maximum(size, 1)
        per = np.maximum(words, 1)
        counts = [per_text(cls == k) for k in range(1, 11)]
        stops = counts[8]
        distinct, top, pairs = np.zeros(n), np.zeros(n), np.zeros(n)
        with np.errstate(over="ignore"):
            two = w.hash[:-1] * np.uint64(0x9E3779B97F4A7C15) + w.hash[1:] if len(w.hash) else w.hash
        longest = np.zeros(n)
        for i in range(n):
            p, q = int(w.first[i]), int(w.first[i + 1])
            if q > p:
                _, c = np.unique(w.hash[p:q], return_counts=True)
                distinct[i], top[i] = len(c) / (q - p), c.max() / (q - p)
                longest[i] = length[p:q].max()
            if q > p + 1:
                pairs[i] = 1 - len(np.unique(two[p:q - 1])) / (q - p - 1)
        ends = np.flatnonzero(w.raw == 10)
        bounds = np.unique(np.concatenate([start, ends[(ends >= 0)] + 1, end + 1]))
        first, last = bounds[:-1], np.maximum(bounds[1:] - 1, bounds[:-1])
        inside = np.searchsorted(start, first, "right") - 1
        ok = (inside >= 0) & (first <= end[np.maximum(inside, 0)]) & (size[np.maximum(inside, 0)] > 0)
        hashes = w.span_hash(first[ok], last[ok])
        at = np.searchsorted(inside[ok], np.arange(n + 1))
        line_share = np.array([len(np.unique(hashes[p:q])) / (q - p) if q > p else 0 for p, q in zip(at[:-1], at[1:])])
        out[a:b] = np.column_stack([
            size, words, lines, per_words(length) / per, *(c / share for c in counts[:4]), counts[4] / share,
            counts[5] / share, *(c / share for c in counts[6:10]), distinct, top, line_share,
            size / np.maximum(lines, 1), longest, per_words(upper) / per, per_words(capital) / per,
            per_words(bare) / per, words / np.maximum(stops, 1), pairs])
    return out


def statistics_column(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def made(texts: pd.Series) -> pd.Series:
        return pd.Series(list(statistics(to_bytes(texts)).astype(float)), index=texts.index)

    return made(text)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """text and label (0 or 1) of at most ``rows`` labelled training documents, chosen by a hash of
    the id; of rows that repeat an id the least text counts. The chosen labels are a table of bounded size and are broadcast."""
    ship_package(docs.sparkSession)
    chosen = (labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("__label"))
              .where(is_train("__id") & F.col("__label").isin(0, 1))
              .orderBy(F.xxhash64("__id"), "__id", "__label").limit(rows))
    left = docs.select(F.col(id_col).alias("__doc"), F.col(text_col).alias("text"))
    met = left.join(F.broadcast(chosen), F.col("__doc") == F.col("__id"))
    # Rows that repeat an id count once: the sample keeps its bound.
    return met.groupBy("__doc", "__label").agg(F.min("text").alias("text")).select("text", F.col("__label").alias("label"))


def grow_tree(x: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, depth: int, least: int) -> list[tuple]:
    """A regression tree over binned features: nodes (path, value) with path = ((feature, bin, above), ...)."""
    nodes = []

    def split(rows: np.ndarray, path: tuple) -> None:
        g, h = gradient[rows], hessian[rows]
        nodes.append((path, -g.sum() / (h.sum() + 1.0), rows))
        if len(path) == depth or len(rows) < 2 * least:
            return
        best = (1e-9, None, None)
        all_g, all_h = g.sum(), h.sum()
        for f in range(x.shape[1]):
            bins = x[rows, f]
            n = int(bins.max()) + 1
            sg = np.cumsum(np.bincount(bins, g, n))[:-1]
            sh = np.cumsum(np.bincount(bins, h, n))[:-1]
            sc = np.cumsum(np.bincount(bins, minlength=n))[:-1]
            gain = sg ** 2 / (sh + 1) + (all_g - sg) ** 2 / (all_h - sh + 1) - all_g ** 2 / (all_h + 1)
            gain = np.where((sc >= least) & (len(rows) - sc >= least), gain, 0)
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), f, int(gain.argmax()))
        if best[1] is None:
            return
        above = x[rows, best[1]] > best[2]
        split(rows[~above], (*path, (best[1], best[2], False)))
        split(rows[above], (*path, (best[1], best[2], True)))

    split(np.arange(len(gradient)), ())
    return nodes


def largest_singular(z: np.ndarray, rows: int = 1024) -> np.float32:
    """The largest singular value of a tall matrix, from products of some rows at a time in double precision."""
    products = np.zeros((z.shape[1], z.shape[1]))
    for a in range(0, len(z), rows):
        some = z[a:a + rows].astype(float)
        products += some.T @ some
    return np.float32(max(0.0, np.linalg.eigvalsh(products)[-1]) ** 0.5)


class RuleEnsemble:
    """Rules ((statistic, threshold, above), ...) with weights, and an intercept."""

    def __init__(self, intercept: float, rules: list[tuple[tuple, float]]):
        self.intercept, self.rules = intercept, rules

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, bins: int = 32,
            penalty: float = 2e-3, steps: int = 400) -> RuleEnsemble:
        share = (y.sum() + 1) / (len(y) + 2)
        base = float(np.log(share / (1 - share)))
        if len(y) < 20 or y.min() == y.max():
            return cls(base, [])
        x = x.astype(float)
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.column_stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)])
        rng, score = np.random.default_rng(7), np.full(len(y), base)
        least, paths = max(3, len(y) // 400), {}
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            use = rng.random(len(y)) < 0.6
            nodes = grow_tree(binned[use], (p - y)[use], (p * (1 - p))[use], depth, least)
            parents = {path[:-1] for path, _, _ in nodes if path}
            for path, value, _ in nodes:
                if path:
                    paths.setdefault(tuple(sorted(path)), None)
                if path not in parents:
                    score += 0.3 * value * cls._holds(binned, path)
        if not paths:
            return cls(base, [])
        # Rules that hold for the same rows count once; a rule's rows are kept as bits until then.
        held = {}
        for k in paths:
            held.setdefault(np.packbits(cls._holds(binned, k)).tobytes(), k)
        keys = [held[b] for b in sorted(held)]
        z = np.empty((len(y), len(keys)), np.float32, order="F")
        for i, bits in enumerate(sorted(held)):
            z[:, i] = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(y))
        # L1-penalised logistic regression by accelerated proximal steps
        mean = z.mean(0)
        z -= mean
        size = 4.0 / (largest_singular(z) ** 2 / len(y) + 1)
        w = v = np.zeros(z.shape[1])
        b, momentum = base, 1.0
        for _ in range(steps):
            p = 1 / (1 + np.exp(-(z @ v.astype(np.float32) + b)))
            err = p - y
            b -= 2.0 * float(err.mean())
            new = v - size * (z.T @ err.astype(np.float32)) / len(y)
            new = np.sign(new) * np.maximum(np.abs(new) - size * penalty, 0)
            after = (1 + (1 + 4 * momentum ** 2) ** 0.5) / 2
            v, w, momentum = new + (momentum - 1) / after * (new - w), new, after
        rules = [(tuple((f, float(edges[f][t]), above) for f, t, above in k), float(c))
                 for k, c in zip(keys, w) if abs(c) > 1e-6]
        return cls(b - float(mean @ w), rules)

    @staticmethod
    def _holds(binned: np.ndarray, path: tuple) -> np.ndarray:
        ok = np.ones(len(binned), bool)
        for f, t, above in path:
            ok &= (binned[:, f] > t) == above
        return ok

    def column(self, stats: Column) -> Column:
        """The probability of label 1 as a Spark expression over the statistics array."""
        total = F.lit(self.intercept)
        for path, weight in self.rules:
            holds = F.lit(True)
            for f, t, above in path:
                holds = holds & ((stats[f] > t) if above else (stats[f] <= t))
            total = total + F.when(holds, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))

    def describe(self) -> list[str]:
        return [f"{w:+.3f} if " + " and ".join(f"{STATISTICS[f]} {'>' if a else '<='} {t:.4g}" for f, t, a in path)
                for path, w in self.rules]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS,
        id_col: str = "doc_id", text_col: str = "text") -> RuleEnsemble:
    sample = labelled_sample(docs, labels, label, rows, id_col, text_col)
    got = sample.select(statistics_column(F.col("text")).alias("s"), "label").toPandas()
    x = np.array(got.s.tolist(), float).reshape(len(got), len(STATISTICS))
    order = np.lexsort(np.column_stack([x, got.label]).T[::-1]) if len(got) else np.zeros(0, int)
    return RuleEnsemble.fit(x[order], got.label.to_numpy(float)[order])


def with_score(docs: DataFrame, model: RuleEnsemble, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1; the statistics are computed once per row."""
    ship_package(docs.sparkSession)
    (tmp,) = unused([*docs.columns, name], "__statistics")
    return (docs.withColumn(tmp, statistics_column(F.col(f"`{text_col}`")))
            .withColumn(name, model.column(F.col(tmp))).drop(tmp))
