"""Language identification by interpolated Kneser-Ney character models.

A text is a sequence of words, runs of letters; a character is predicted from up
to ORDER - 1 characters before it in its word, with word edges as characters of
their own. Counts of the highest order come from all training texts by a Spark
aggregate over (language, gram); lower orders are counts of distinct
continuations, by further aggregates. Discounts come from the counts of counts.

All grams are kept, so the model grows with the distinct grams of the corpus and
the probabilities after a context sum to 1. Shares and back-off weights are made by
Spark and stay tables: a hash and one number per language for each gram and context.
(With a LEAST_SHARE above 0, grams below that share of their language and order are
left out, and their mass goes to the back-off weight.)

While the tables have at most LOCAL_BYTES, counted when they are written, every
executor gets them as a sorted array of hashes per order with a row of numbers per
language beside it; a lookup is a binary search for all languages at once. A larger
model never leaves the tables: the distinct grams of the texts to be identified meet
them in one sort-merge join per order, each distinct text's grams meet the
resulting log-probabilities in another, and sums per language give the
cross-entropies. Both ways give the same numbers (up to the order of additions).

A text gets the language of the lowest cross-entropy per character. Rejection is
calibrated: per language, the cross-entropy that nearly all of its own training
texts stay under, an exact quantile over every one of them. ``fit_identify``
learns from a table and identifies its rows with one scoring of each text.

Defined cases: a null or empty text, or one without a letter, is `und` with score
0; without training rows every text is `und`; rows without lang or id are not
learnt from; ties go to the language that sorts first; an empty table gives an
empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlmeta.llm.common import is_train, map_rows, mix64, shared_folder, written
from crawlmeta.session import ship_package

ORDER = 5
LEAST_SHARE = 0.0
#: Counted bytes of a model that every executor gets.
LOCAL_BYTES = 64 << 20
#: Characters of one numpy pass.
BLOCK = 1 << 20
#: Characters that a text's evidence counts for at most in its score.
EVIDENCE = 40
#: Share of a language's training texts that must pass. Their cross-entropies are counted by ever finer ranges
#: until the ranges that matter hold at most CALIBRATION_ROWS; those are then told apart at once.
PASSING = 0.995
CALIBRATION_ROWS = 4_000
UNKNOWN = "und"
_EDGE = 32
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Which code points are letters."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts, an edge after each, and where each text starts."""
    low = [(t or "").lower() for t in texts]
    flat = np.frombuffer(" ".join([*low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat, np.concatenate([[0], np.cumsum([len(t) + 1 for t in low])])


def grams(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ORDER characters that end at each letter and at the edge after each
    word, edges in front of the word, and their places in ``flat``."""
    letter = letters()[np.minimum(flat, 0x10FFFF)]
    before = np.concatenate([[False], letter[:-1]])
    place = np.flatnonzero(letter | before)
    clean = np.where(letter, flat, np.uint32(_EDGE))
    edge = np.flatnonzero(~letter & ~before | (letter & ~before))
    start = np.zeros(len(flat), np.int64)
    start[edge] = edge
    start = np.maximum.accumulate(start)
    out = np.empty((len(place), ORDER), np.uint32)
    for back in range(ORDER):
        at = place - back
        out[:, ORDER - 1 - back] = np.where(at >= start[place], clean[np.maximum(at, 0)], _EDGE)
    return out, place


def gram_hash(g: np.ndarray) -> np.ndarray:
    """64-bit hash of rows of characters."""
    h = np.full(len(g), g.shape[1], np.uint64)
    with np.errstate(over="ignore"):
        for k in range(g.shape[1]):
            h = (h ^ g[:, k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        return mix64(h)


def _cuts(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    a = size = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > a and size + n > BLOCK:
            yield a, i
            a, size = i, 0
        size += n
    if a < len(texts):
        yield a, len(texts)


def count_grams(rows: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """(lang, g, c) of the highest order over all rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lang, part in pdf.groupby("lang", sort=False):
                texts = part.text.tolist()
                hashes, counts, rows = [], [], []
                for a, b in _cuts(texts):
                    g, _ = grams(code_points(texts[a:b])[0])
                    h, first, c = np.unique(gram_hash(g), return_index=True, return_counts=True)
                    hashes.append(h)
                    counts.append(c)
                    rows.append(g[first])
                h, first, inverse = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
                if not len(h):
                    continue
                c = np.bincount(inverse, np.concatenate(counts)).astype(np.int64)
                g = np.concatenate(rows)[first]
                flat = g.astype("<u4").tobytes().decode("utf-32-le", "replace")
                yield pd.DataFrame({"lang": lang, "g": [flat[i:i + ORDER] for i in range(0, len(flat), ORDER)], "c": c})

    kept = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    return kept.mapInPandas(run, "lang string, g string, c long").groupBy("lang", "g").agg(F.sum("c").alias("c"))


@dataclass
class Tables:
    """Per order, tables (h, value per language): discounted shares of grams, back-off weights of contexts."""

    gram: list[DataFrame]
    context: list[DataFrame]


@dataclass
class Model:
    """Languages and, unless the model is ``tables``, per order: sorted gram hashes with discounted
    shares, sorted context hashes with back-off weights."""

    langs: list[str]
    alphabet: int
    gram: list[np.ndarray]
    share: list[np.ndarray]
    context: list[np.ndarray]
    back_off: list[np.ndarray]
    limit: np.ndarray
    tables: Tables | None = None
    folder: str = ""

    def log_prob(self, g: np.ndarray) -> np.ndarray:
        """Log-probability of each row's last character, per language."""
        p = np.full((len(g), len(self.langs)), 1.0 / max(2, self.alphabet), np.float64)
        for k in range(1, ORDER + 1):
            p *= _rows(self.context[k - 1], self.back_off[k - 1], gram_hash(g[:, ORDER - k:-1]), 1.0)
            p += _rows(self.gram[k - 1], self.share[k - 1], gram_hash(g[:, ORDER - k:]), 0.0)
        return np.log(p)

    def cross_entropy(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Nats per character of each text and language, and its characters."""
        h, n = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        for a, b in _cuts(texts):
            flat, start = code_points(texts[a:b])
            g, place = grams(flat)
            if not len(g):
                continue
            _, first, inverse = np.unique(gram_hash(g), return_index=True, return_inverse=True)
            logs = self.log_prob(g[first])
            at = np.searchsorted(place, start)
            n[a:b] = np.diff(at)
            for k in range(len(self.langs)):
                total = np.concatenate([[0.0], np.cumsum(logs[:, k][inverse])])
                h[a:b, k] = -(total[at[1:]] - total[at[:-1]]) / np.maximum(n[a:b], 1)
        return h, n

    def entropy(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """``cross_entropy``, of a model without languages too."""
        return self.cross_entropy(texts) if self.langs else (np.zeros((len(texts), 0)), np.zeros(len(texts)))

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        return self.decided(*self.entropy(texts))

    def decided(self, h: np.ndarray, n: np.ndarray) -> pd.DataFrame:
        """Decisions from the cross-entropies per language and the characters of each text."""
        if not self.langs:
            return pd.DataFrame({"lang_pred": [UNKNOWN] * len(n), "score": 0.0, "cross_entropy": np.nan, "rejected": True})
        best = h.argmin(1)
        low = h[np.arange(len(h)), best]
        weight = np.exp(-(h - low[:, None]) * np.minimum(n, EVIDENCE)[:, None])
        none = n == 0
        return pd.DataFrame({
            "lang_pred": np.where(none, UNKNOWN, np.array(self.langs, object)[best]),
            "score": np.where(none, 0.0, 1 / weight.sum(1)),
            "cross_entropy": np.where(none, np.nan, low),
            "rejected": none | (low > self.limit[best])})


def _rows(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, other: float) -> np.ndarray:
    if not len(keys):
        return np.full((len(wanted), values.shape[1]), other)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where((keys[at] == wanted)[:, None], values[at], other)


def _hash_strings(grams_: pd.Series, width: int) -> np.ndarray:
    if not width:
        return gram_hash(np.zeros((len(grams_), 0), np.uint32))
    flat = np.frombuffer("".join(grams_).encode("utf-32-le", "surrogatepass"), np.uint32)
    return gram_hash(flat.reshape(-1, width))


def fit(rows: DataFrame, folder: str, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id",
        calibrate: bool = True) -> Model:
    """Counts over all training rows of ``rows``; only a model of at most LOCAL_BYTES comes to the driver. Without
    ``calibrate`` the model rejects no text that has a letter."""
    train = rows.where(is_train(id_col) & F.col(lang_col).isNotNull())
    level = written(count_grams(train, lang_col, text_col), folder, f"grams-{ORDER}")
    langs = sorted(r[0] for r in level.select("lang").distinct().collect())
    tables = Tables([None] * ORDER, [None] * ORDER)
    alphabet = 0
    for k in range(ORDER, 0, -1):
        if k < ORDER:
            level = written(level.groupBy("lang", F.expr(f"substring(g, 2, {k})").alias("g"))
                            .agg(F.count(F.lit(1)).alias("c")), folder, f"grams-{k}")
        per_lang = level.groupBy("lang").agg(
            F.sum("c").alias("total"), F.sum(F.expr("if(c = 1, 1, 0)")).alias("n1"),
            F.sum(F.expr("if(c = 2, 1, 0)")).alias("n2"), F.count(F.lit(1)).alias("types")).toPandas()
        total = dict(zip(per_lang.lang, per_lang.total))
        cut = {r.lang: min(0.95, max(0.05, r.n1 / (r.n1 + 2 * r.n2) if r.n1 else 0.5)) for r in per_lang.itertuples()}
        least = F.coalesce(*[F.when(F.col("lang") == x, F.lit(float(total[x]) * LEAST_SHARE)) for x in langs], F.lit(0.0))
        parts = level.withColumn("x", F.expr(f"substring(g, 1, {k - 1})")).withColumn("least", least)
        contexts = parts.groupBy("lang", "x").agg(
            F.sum("c").alias("t"), F.sum(F.expr("if(c >= least, c, 0)")).alias("own"),
            F.sum(F.expr("if(c >= least, 1, 0)")).alias("n")).where("n > 0")
        got = parts.where("c >= least").join(contexts.select("lang", "x", "t"), ["lang", "x"])
        if k == 1:
            alphabet = int(per_lang.types.max()) if len(per_lang) else 2
        tables.gram[k - 1] = written(_valued(got.selectExpr("lang", "g", "c", "t", "1 as n"), k, cut, langs, True), folder, f"shares-{k}")
        # what the discount takes from the kept grams, and all that left-out grams had
        rest = contexts.selectExpr("lang", "x as g", "t - own as c", "t", "n")
        tables.context[k - 1] = written(_valued(rest, k - 1, cut, langs, False), folder, f"back-offs-{k}")
    model = Model(langs, alphabet + 1, [], [], [], [], np.full(len(langs), np.inf), tables, folder)
    if sum(t.count() for t in [*tables.gram, *tables.context]) * (8 + 4 * len(langs)) <= LOCAL_BYTES:
        model.gram, model.share = zip(*[_arrays(t, langs) for t in tables.gram])
        model.context, model.back_off = zip(*[_arrays(t, langs) for t in tables.context])
        model.tables = None
    if langs and calibrate:
        own = train.select(F.lit(None).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
        model.limit = calibrated(written(scored(own, model).select("lang", "own"), folder, "calibration"), langs)
    return model


def _valued(rows: DataFrame, width: int, cut: dict[str, float], langs: list[str], shares: bool) -> DataFrame:
    """h, values (one per language) of rows (lang, g, c, t, n): the discounted share of a gram, 0 where it was
    not seen, or the back-off weight of a context, 1 where it was not seen."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        d, c, t = pdf.lang.map(cut).to_numpy(float), pdf.c.to_numpy(float), pdf.t.to_numpy(float)
        value = np.maximum(c - d, 0) / t if shares else (c + d * pdf.n.to_numpy(float)) / t
        return pd.DataFrame({"lang": pdf.lang, "h": _hash_strings(pdf.g, width).view(np.int64), "value": value})

    made = map_rows(rows, run, "lang string, h long, value float")
    other = F.lit(0.0 if shares else 1.0).cast("float")
    values = [F.coalesce(F.max(F.when(F.col("lang") == x, F.col("value"))), other) for x in langs]
    return made.groupBy("h").agg(F.array(*values).cast("array<float>").alias("values"))


def _arrays(table: DataFrame, langs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    got = table.toPandas()
    keys = got.h.to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    values = np.array(got["values"].tolist(), np.float32).reshape(len(got), len(langs))
    return keys[order], values[order]


# --- scoring against tables ------------------------------------------------

_HASHES = [f"{kind}{k}" for k in range(1, ORDER + 1) for kind in ("x", "g")]


def _text_grams(pdf: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Per block of texts: rows (t1, t2, h, n) of the distinct grams of each text, and the block's distinct grams."""
    texts = pdf.text.tolist()
    for a, b in _cuts(texts):
        flat, start = code_points(texts[a:b])
        g, place = grams(flat)
        doc = np.searchsorted(start, place, "right") - 1
        h = gram_hash(g)
        known, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        cell, n = np.unique(doc * np.int64(max(1, len(known))) + inverse, return_counts=True)
        doc, which = cell // max(1, len(known)), cell % max(1, len(known))
        yield pd.DataFrame({"t1": pdf.t1.to_numpy()[a + doc], "t2": pdf.t2.to_numpy()[a + doc],
                            "h": known[which].view(np.int64), "n": n}), g[first]


def entropies(texts: DataFrame, model: Model, folder: str) -> DataFrame:
    """t1, t2, n, h (per language) of the distinct texts (t1, t2, text); a text without a gram has no row."""
    tables = model.tables

    def per_text(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for made, _ in _text_grams(pdf):
                yield made

    def distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, g in _text_grams(pdf):
                made = {"h": gram_hash(g).view(np.int64)}
                for k in range(1, ORDER + 1):
                    made[f"x{k}"] = gram_hash(g[:, ORDER - k:-1]).view(np.int64)
                    made[f"g{k}"] = gram_hash(g[:, ORDER - k:]).view(np.int64)
                yield pd.DataFrame(made)

    used = texts.mapInPandas(distinct, "h long, " + ", ".join(f"{c} long" for c in _HASHES)).dropDuplicates(["h"])
    p = used.withColumn("p", F.array_repeat(F.lit(1.0 / max(2, model.alphabet)), len(model.langs)))
    for k in range(1, ORDER + 1):
        for kind, table, apply in (("x", tables.context[k - 1], lambda a, b: a * b), ("g", tables.gram[k - 1], lambda a, b: a + b)):
            right = table.select(F.col("h").alias(f"{kind}{k}"), F.col("values").cast("array<double>").alias("v"))
            # Keys of no or one character: few and hot, and no more than there are letters.
            right = F.broadcast(right) if (kind, k) in (("x", 1), ("x", 2), ("g", 1)) else right.hint("merge")
            p = p.join(right, f"{kind}{k}", "left").withColumn(
                "p", F.when(F.col("v").isNull(), F.col("p")).otherwise(F.zip_with("p", "v", apply))).drop("v", f"{kind}{k}")
    logs = written(p.select("h", F.transform("p", lambda x: F.log(x)).alias("logs")), folder, "logs")
    cells = texts.mapInPandas(per_text, "t1 long, t2 long, h long, n long")
    sums = [F.sum(F.col("n") * F.col("logs")[i]) for i in range(len(model.langs))]
    total = cells.join(logs.hint("merge"), "h").groupBy("t1", "t2").agg(F.sum("n").alias("n"), F.array(*sums).alias("s"))
    return total.select("t1", "t2", "n", F.transform("s", lambda x: -x / F.col("n")).alias("h"))


def _keyed(rows: DataFrame) -> DataFrame:
    """With two hashes of the text: equal texts are scored once."""
    return rows.withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(1), "text")})


def _ordered(h: np.ndarray) -> np.ndarray:
    """Numbers as integers of the same order."""
    bits = np.ascontiguousarray(h, np.float64).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits)


def order_statistics(rows: DataFrame, wanted: list[tuple[str, int]]) -> list[int]:
    """For each (lang, rank from 0) the value of that rank among the rows (lang, own): every row is counted, by the
    first 16 bits, then by the next within the ranges that hold a wanted rank."""
    at = [(lang, None, rank) for lang, rank in wanted]
    shift, within = 64, rows
    while shift:
        if shift < 64:
            ranges = rows.sparkSession.createDataFrame(sorted({(lang, low) for lang, low, _ in at}), "lang string, low long")
            within = rows.withColumn("low", F.shiftright("own", shift)).join(F.broadcast(ranges), ["lang", "low"], "left_semi")
        shift = shift - 16 if shift == 64 or left > CALIBRATION_ROWS else 0
        found = within.groupBy("lang", F.shiftright("own", shift).alias("low")).agg(F.count(F.lit(1)).alias("n")).toPandas()
        found = found.sort_values("low")
        inside, held = [], {}
        for lang, low, rank in at:
            part = found[found.lang == lang]
            if low is not None:
                part = part[part.low.to_numpy() >> (above - shift) == low]
            ends = part.n.cumsum().to_numpy()
            i = int(np.searchsorted(ends, rank, "right"))
            inside.append((lang, int(part.low.iloc[i]), rank - int(ends[i] - part.n.iloc[i])))
            held[inside[-1][:2]] = int(part.n.iloc[i])
        at, above, left = inside, shift, sum(held.values())
    return [value for _, value, _ in at]


def calibrated(scores: DataFrame, langs: list[str]) -> np.ndarray:
    """Per language the cross-entropy that PASSING of its training texts stay under (between ranks: the
    straight line), from the rows of ``scored``."""
    own = scores.where("own IS NOT NULL").select("lang", "own")
    size = {r[0]: r[1] for r in own.groupBy("lang").agg(F.count(F.lit(1))).collect()}
    place = {x: PASSING * (n - 1) for x, n in size.items()}
    wanted = [(x, min(int(p) + i, size[x] - 1)) for x, p in place.items() for i in (0, 1)]
    value = _ordered(np.array(order_statistics(own, wanted), np.int64).view(np.float64)).view(np.float64) if wanted else []
    limit = {x: value[2 * i] + (value[2 * i + 1] - value[2 * i]) * (p - int(p)) for i, (x, p) in enumerate(place.items())}
    return np.array([limit.get(x, np.inf) for x in langs])


RESULT = "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean"


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """RESULT of rows (doc_id, text, lang), with lang and ``own``: the cross-entropy under the row's own language,
    as an integer of the same order; null without lang or a letter."""
    small = Model(model.langs, model.alphabet, [], [], [], [], model.limit)

    def decided(pdf: pd.DataFrame, h: np.ndarray, n: np.ndarray) -> pd.DataFrame:
        out = small.decided(h, n)
        out.insert(0, "doc_id", pdf.doc_id.to_numpy())
        out["lang"] = pdf.lang.to_numpy()
        known = pd.Index(small.langs).get_indexer(pdf.lang)
        usable = (known >= 0) & (n > 0)
        out["own"] = pd.array(np.zeros(len(pdf), np.int64), "Int64")
        if len(small.langs):
            out["own"] = pd.array(_ordered(h[np.arange(len(h)), np.maximum(known, 0)]), "Int64")
        out.loc[~usable, "own"] = pd.NA
        return out

    schema = RESULT + ", lang string, own long"
    if model.tables and model.langs:
        def decide(pdf: pd.DataFrame) -> pd.DataFrame:
            h = np.array([[0.0] * len(small.langs) if x is None else list(x) for x in pdf.h], float).reshape(len(pdf), len(small.langs))
            return decided(pdf, h, pdf.n.fillna(0).to_numpy(float))

        return map_rows(_met(rows, model).select("doc_id", "lang", "n", "h"), decide, schema)
    ship_package(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield decided(pdf, *shared.value.entropy(pdf.text.tolist()))

    return rows.mapInPandas(run, schema)


def _met(rows: DataFrame, model: Model) -> DataFrame:
    """The rows with characters and cross-entropies (n, h) of their texts, from a model in tables."""
    folder = shared_folder(rows.sparkSession, "identified")
    keyed = _keyed(rows)
    texts = written(keyed.where("text IS NOT NULL").dropDuplicates(["t1", "t2"]).select("t1", "t2", "text"), folder, "texts")
    return keyed.drop("text").join(entropies(texts, model, folder).hint("merge"), ["t1", "t2"], "left")


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred, score, cross_entropy, rejected."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.lit(None).cast("string").alias("lang"))
    return scored(rows, model).drop("lang", "own")


def fit_identify(docs: DataFrame, folder: str, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``identify`` of all rows by the model that ``fit`` makes of the training rows among them: each text is
    scored once, for its language and for the limits."""
    model = fit(docs, folder, lang_col, text_col, id_col, calibrate=False)
    lang = F.when(is_train(id_col), F.col(lang_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), lang.cast("string").alias("lang"))
    scores = written(scored(rows, model), folder, "scores")
    limit = dict(zip(model.langs, calibrated(scores, model.langs).tolist()))
    over = F.coalesce(*[F.when(F.col("lang_pred") == x, F.col("cross_entropy") > v) for x, v in limit.items()], F.lit(False))
    return scores.withColumn("rejected", F.col("rejected") | over).drop("lang", "own")
