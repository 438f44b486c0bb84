import math
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from crawlmeta.llm import kneser_ney, quality_rules, toxicity
from crawlmeta.llm.common import Words, held_out, shared_folder, table, to_bytes

from . import odd

SF = "/root/testdata/sf0.01"
NO_LABELS = "doc_id long, quality int, toxic int"


def accuracy(spark, scored, label, least):
    joined = scored.join(table(spark, SF, "labels"), "doc_id").where(held_out())
    got = joined.select("predicted", F.col(label).alias("y")).collect()
    assert len(got) > 50
    assert sum(r.predicted == r.y for r in got) / len(got) >= least


def test_words_are_hashed_alike_wherever_they_stand():
    texts = to_bytes(["One two  three", "", None, "three\ttwo\nONE", "x" * 5000 + " two"])
    w = Words(texts)
    assert np.diff(w.first).tolist() == [3, 0, 0, 3, 2]
    a, b, c = w.hash[:3]
    assert w.hash[3:6].tolist() == [c, b, a] and w.hash[7] == b and len({a, b, c, w.hash[6]}) == 4


def test_statistics_by_definition():
    names = quality_rules.STATISTICS
    s = quality_rules.statistics(to_bytes(["Ab cd | cd!\nAb cd | cd!", "", None]))
    one = dict(zip(names, s[0]))
    assert (one["bytes"], one["words"], one["lines"]) == (23, 8, 2)
    assert one["bars"] == pytest.approx(2 / 23) and one["exclaims"] == pytest.approx(2 / 23)
    assert one["distinct_words"] == pytest.approx(4 / 8) and one["distinct_lines"] == pytest.approx(0.5)
    assert one["repeated_pairs"] == pytest.approx(1 - 4 / 7) and one["top_word"] == pytest.approx(0.25)
    assert not s[1:].any()


def test_rule_column_equals_the_rules(spark):
    rng = np.random.default_rng(1)
    x = rng.random((600, len(quality_rules.STATISTICS)))
    y = ((x[:, 2] > 0.6) & (x[:, 5] <= 0.7)).astype(float)
    model = quality_rules.RuleEnsemble.fit(x, y)
    assert model.rules and model.describe()
    z = model.intercept + sum(w * np.all([(x[:, f] > t) == above for f, t, above in path], axis=0) for path, w in model.rules)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x[:100])], "i int, s array<double>")
    got = [r.p for r in df.select("i", model.column(F.col("s")).alias("p")).orderBy("i").collect()]
    assert got == pytest.approx((1 / (1 + np.exp(-z)))[:100].tolist())
    assert (((1 / (1 + np.exp(-z))) >= 0.5) == y).mean() > 0.97


def test_quality_held_out(spark):
    docs = table(spark, SF, "documents")
    model = quality_rules.fit(docs, table(spark, SF, "labels"))
    scored = quality_rules.with_score(docs.select("doc_id", "text"), model).withColumn(
        "predicted", (F.col("score") >= 0.3).cast("int"))
    accuracy(spark, scored, "quality", 0.97)


def test_toxicity_held_out_and_sentences(spark):
    docs = table(spark, SF, "documents")
    model = toxicity.fit(docs, table(spark, SF, "labels"))
    scored = docs.select("doc_id", toxicity.score_column(docs, model, F.col("text")).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
    accuracy(spark, scored, "toxic", 0.85)
    text = {d: t for d, t in duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()}
    found = toxicity.offending_sentences(docs, model, 0.3).collect()
    assert found
    for r in found:
        assert text[r.doc_id][r.start:r.start + r.length] == r.sentence and r.score >= 0.3


def test_noisy_or_learns_the_sentence_from_document_labels():
    rng = np.random.default_rng(5)
    texts, y = [], []
    for i in range(400):
        sentences = [" ".join(f"w{k}" for k in rng.integers(0, 60, 6)) for _ in range(rng.integers(1, 9))]
        y.append(i % 4 == 0)
        if y[-1]:
            sentences[int(rng.integers(len(sentences)))] += " venomous"
        texts.append(". ".join(sentences) + ".")
    s = toxicity.Sentences(to_bytes(texts))
    bags = [toxicity.Sentences([t]) for t in to_bytes(texts)]
    model = toxicity.NoisyOr.fit([(int(label), b.at, b.feature) for label, b in zip(y, bags)])
    assert ((model.scores(to_bytes(texts)) >= 0.5) == y).all()
    p = 1 / (1 + np.exp(-model.sentence_logits(s)))
    own = [t.split(". ")[k] for t, n in zip(texts, np.bincount(s.doc)) for k in range(n)]
    assert all(("venomous" in x) == (q >= 0.5) for x, q in zip(own, p))
    whole = 1 - np.prod(1 - p[s.doc == 0])
    assert model.scores(to_bytes(texts[:1]))[0] == pytest.approx(whole)


def test_classifiers_take_odd_rows(spark):
    none = spark.createDataFrame([], NO_LABELS)
    one = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (None, 0, 1), (7, None, None), (7, 1, 0)], NO_LABELS)
    for docs, n in ((odd.odd(spark), len(odd.rows())), (odd.empty(spark), 0)):
        for labels in (none, one):
            rules = quality_rules.fit(docs, labels)
            tox = toxicity.fit(docs, labels)
            got = quality_rules.with_score(docs, rules, name="__p").withColumn(
                "__q", toxicity.score_column(docs, tox, F.col("text"))).collect()
            assert len(got) == n and all(0 <= r["__p"] <= 1 and 0 <= r["__q"] <= 1 for r in got)
    docs = odd.odd(spark)
    tox = toxicity.fit(docs, none)
    assert toxicity.offending_sentences(docs, tox, 0.0).count() > 0


def brute_kneser_ney(texts, order=kneser_ney.ORDER):
    """Interpolated Kneser-Ney over padded words by plain dictionaries; probability of a gram's last character."""
    counts = Counter()
    for t in texts:
        word = ""
        for c in t.lower() + " ":
            if c.isalpha():
                word += c
            elif word:
                padded = " " * (order - 1) + word + " "
                counts.update(padded[i:i + order] for i in range(len(padded) - order + 1))
                word = ""
    levels = {order: counts}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    context, cut = {}, {}
    for k, level in levels.items():
        context[k] = defaultdict(lambda: [0, 0])
        for g, c in level.items():
            context[k][g[:-1]][0] += c
            context[k][g[:-1]][1] += 1
        n1, n2 = (sum(c == i for c in level.values()) for i in (1, 2))
        cut[k] = min(0.95, max(0.05, n1 / (n1 + 2 * n2) if n1 else 0.5))
    alphabet = len(levels[1])

    def prob(g):
        p = 1 / max(2, alphabet + 1)
        for k in range(1, order + 1):
            part = g[order - k:]
            total, types = context[k].get(part[:-1], (0, 0))
            if total:
                p = max(levels[k].get(part, 0) - cut[k], 0) / total + cut[k] * types / total * p
        return p

    return prob, counts


def test_kneser_ney_equals_plain_dictionaries(spark, monkeypatch):
    monkeypatch.setattr(kneser_ney, "LEAST_SHARE", 0.0)
    texts = ["the cat sat on the mat", "a cat and a hat, the hat", "Straße und Öl"] * 2
    rows = [(i, t, "xx") for i, t in enumerate(texts * 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    import zlib
    train = [t for i, t, _ in rows if zlib.crc32(str(i).encode()) % 5]
    model = kneser_ney.fit(df, shared_folder(spark, "t"))
    prob, counts = brute_kneser_ney(train)
    some = sorted(counts) + ["  zzz", "thezz", "  thx"]
    g = np.frombuffer("".join(some).encode("utf-32-le"), np.uint32).reshape(-1, kneser_ney.ORDER)
    assert np.exp(model.log_prob(g))[:, 0] == pytest.approx([prob(x) for x in some], rel=1e-4)
    h, n = model.cross_entropy(["the hat", ""])
    grams = ["    t", "   th", "  the", " the ", "    h", "   ha", "  hat", " hat "]
    assert n.tolist() == [8, 0] and h[0, 0] == pytest.approx(-sum(math.log(prob(x)) for x in grams) / 8, rel=1e-4)


@pytest.mark.parametrize("least", [None, 1e-3])
def test_kneser_ney_sums_to_one_with_rare_grams(spark, monkeypatch, least):
    """Of 200,000 characters a rare word is below a share of 1e-5; production keeps it, and no mass is lost either way."""
    if least is not None:
        monkeypatch.setattr(kneser_ney, "LEAST_SHARE", least)
    rows = [(i, "the cat sat on that mat " * 1500, "xx") for i in range(1, 9)] + [(9, "quiz theft", "xx"), (11, "quiz theft", "xx")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    train = [t for i, t, _ in rows if zlib.crc32(str(i).encode()) % 5]
    assert "quiz theft" in train and sum(map(len, train)) > 150_000
    model = kneser_ney.fit(df, shared_folder(spark, "t"))
    prob, counts = brute_kneser_ney(train)
    if least is None:
        some = sorted(counts)
        g = np.frombuffer("".join(some).encode("utf-32-le"), np.uint32).reshape(-1, kneser_ney.ORDER)
        assert np.exp(model.log_prob(g))[:, 0] == pytest.approx([prob(x) for x in some], rel=1e-4)
    ends = sorted({g[-1] for g in counts})
    for context in sorted({g[:-1] for g in counts}):
        g = np.frombuffer("".join(context + e for e in ends).encode("utf-32-le"), np.uint32).reshape(-1, kneser_ney.ORDER)
        unseen = 1 + len({x[-1] for x in counts}) - len(ends)  # the model's alphabet has one more, for all unseen characters
        other = np.frombuffer((context + "\u4e00").encode("utf-32-le"), np.uint32).reshape(1, -1)
        total = np.exp(model.log_prob(g))[:, 0].sum() + unseen * np.exp(model.log_prob(other))[0, 0]
        assert total == pytest.approx(1, rel=1e-4), context


def test_language_held_out(spark):
    docs = table(spark, SF, "documents")
    model = kneser_ney.fit(docs, shared_folder(spark, "t"))
    got = kneser_ney.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(held_out()).collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.98
    assert sum(r.rejected for r in got) < 0.1 * len(got)
    strange = spark.createDataFrame([(1, "zqxj vvkw qqzx jjxq wxzk qvvj " * 9)], "doc_id long, text string")
    assert kneser_ney.identify(strange, model).first().rejected


def test_rejection_is_calibrated_for_rare_languages(spark, monkeypatch):
    monkeypatch.setattr(kneser_ney, "CALIBRATION_ROWS", 20)
    rows = [(i, f"the quick brown fox and {'abcdefgh'[i % 8]}", "en") for i in range(600)]
    rows += [(1000 + 10 * k + i, f"{chr(0x3b1 + k) * 4} {chr(0x3b1 + i)}", f"x{k}") for k in range(6) for i in range(8)]
    rows.append((2001, "123", "zz"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = kneser_ney.fit(df, shared_folder(spark, "t"))
    assert model.langs == ["en", *(f"x{k}" for k in range(6))] and np.isfinite(model.limit).all()
    strange = spark.createDataFrame([(1, chr(0x3b1) * 3 + " zqxj vvkw qqzx jjxq")], "doc_id long, text string")
    assert kneser_ney.identify(strange, model).first().rejected


def test_language_takes_odd_rows(spark):
    docs = odd.odd(spark)
    model = kneser_ney.fit(docs, shared_folder(spark, "t"))
    got = kneser_ney.identify(docs, model).collect()
    assert len(got) == len(odd.rows())
    for r in got:
        assert 0 <= r.score <= 1 and (r.lang_pred in model.langs or r.lang_pred == "und")
        if r.doc_id in (4, 5, 6, 11):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    nothing = kneser_ney.fit(odd.empty(spark), shared_folder(spark, "t"))
    assert kneser_ney.identify(odd.empty(spark), nothing).collect() == []
    assert {r.lang_pred for r in kneser_ney.identify(docs, nothing).collect()} == {"und"}


def test_kneser_ney_tables_and_arrays_agree(spark, monkeypatch):
    """A model that stays in tables gives what the broadcast one gives, null, empty, repeated and odd texts included."""
    docs = odd.documents(spark)
    extra = odd.odd(spark).select("doc_id", "text", "lang", "source", "n_chars")
    every = docs.unionByName(extra).unionByName(extra)
    names = ["doc_id", "lang_pred", "rejected", "score", "cross_entropy"]
    found = []
    for limit in (kneser_ney.LOCAL_BYTES, -1):
        monkeypatch.setattr(kneser_ney, "LOCAL_BYTES", limit)
        model = kneser_ney.fit(docs, shared_folder(spark, "t"))
        assert (model.tables is None) == (limit > 0)
        rows = kneser_ney.identify(every, model).select(names).collect()
        found.append(sorted(((str(r.doc_id), r.lang_pred, r.rejected, round(r.score, 6), None if r.cross_entropy is None else round(r.cross_entropy, 6))
                             for r in rows), key=str))
    assert len(found[0]) == every.count() and str(found[0]) == str(found[1])
    assert {r[1] for r in found[0]} > {"und", "en"}


def test_nothing_of_a_large_model_reaches_the_driver(spark, monkeypatch):
    monkeypatch.setattr(kneser_ney, "LOCAL_BYTES", -1)
    model = kneser_ney.fit(odd.documents(spark), shared_folder(spark, "t"))
    assert not model.gram and not model.share and len(model.tables.gram) == kneser_ney.ORDER
    plan = kneser_ney.identify(odd.documents(spark), model)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan


def test_the_labelled_sample_keeps_its_bound_with_repeated_ids(spark):
    docs = spark.range(400).selectExpr("id % 40 as doc_id", "concat('t', lpad(cast(id as string), 3, '0')) as text")
    labels = spark.range(40).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    got = quality_rules.labelled_sample(docs, labels.union(labels), "quality", 25).collect()
    assert 10 <= len(got) <= 25 and all(r.text < "t040" and int(r.text[1:]) % 2 == r.label for r in got)


def test_rejection_counts_every_training_text(spark, monkeypatch):
    """The limits are exact quantiles over all training texts, however few the driver sorts at once, and one
    scoring of each text gives the same decisions."""
    monkeypatch.setattr(kneser_ney, "CALIBRATION_ROWS", 20)
    docs = table(spark, SF, "documents")
    train = docs.where(~held_out() & F.col("lang").isNotNull()).select("lang", "text").toPandas()
    model = kneser_ney.fit(docs, shared_folder(spark, "t"))
    h, n = model.cross_entropy(train.text.tolist())
    for i, lang in enumerate(model.langs):
        own = h[(train.lang == lang).to_numpy() & (n > 0), i]
        assert len(own) > 20 and model.limit[i] == pytest.approx(np.quantile(own, kneser_ney.PASSING), rel=1e-9)
    found = kneser_ney.fit_identify(docs, shared_folder(spark, "t"))
    decided = [sorted((r.doc_id, r.lang_pred, round(r.score, 6), r.rejected) for r in x.collect())
               for x in (found, kneser_ney.identify(docs, model))]
    assert decided[0] == decided[1]


def test_order_statistics_are_exact(spark):
    x = np.random.default_rng(5).normal(size=30_000).round(3) + 0.0
    keys = kneser_ney._ordered(x)
    assert (np.argsort(keys, kind="stable") == np.argsort(x, kind="stable")).all()
    rows = spark.createDataFrame(pd.DataFrame({"lang": np.where(np.arange(len(x)) % 3 == 0, "a", "b"), "own": keys}))
    sides = {"a": np.sort(keys[::3]), "b": np.sort(np.delete(keys, np.s_[::3]))}
    wanted = [("a", 0), ("a", 9_950), ("a", 9_999), ("b", 19_900), ("b", 19_901), ("b", 7)]
    assert kneser_ney.order_statistics(rows, wanted) == [int(sides[lang][rank]) for lang, rank in wanted]
