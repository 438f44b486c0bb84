import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from crawlmeta.llm import importance
from crawlmeta.llm.queries import op13_importance_resampling

from . import odd

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def features(text, least=1, most=1):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [" ".join(words[i:i + n]) for n in range(least, most + 1) for i in range(len(words) - n + 1)]


def bucket(feature, buckets=10_000):
    return zlib.crc32(feature.encode()) % buckets


def brute(docs, target, percent=10, least_words=20, runs=(1, 1)):
    made = [(i, *features(t, *runs)) for i, t in docs]
    s = Counter(bucket(f) for _, _, fs in made for f in fs)
    t = Counter(bucket(f) for text in target for f in features(text, *runs)[1])
    s_all, t_all = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000))))

    rows = []
    for i, n, fs in made:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f)) for f in fs)
        rows.append((i, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    ranked = sorted((r for r in rows if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    rank = {}
    for k, r in enumerate(ranked[:len(ranked) * percent // 100], 1):
        rank.setdefault(r, []).append(k)
    return sorted(((*r[:1], *r[2:], rank[r].pop() if rank.get(r) else None) for r in rows), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_query_equals_brute_force(spark):
    want = brute(odd.texts(), [r.text for r in spark.read.parquet(f"{odd.SF}/benchmark.parquet").collect()])
    df = op13_importance_resampling(spark, odd.SF)
    assert got(df) == want and dict(df.dtypes) == dict.fromkeys(df.columns, "bigint")


@pytest.mark.parametrize("runs", [(1, 1), (1, 3), (2, 2)])
def test_odd_rows_and_longer_runs(spark, runs):
    docs = odd.odd(spark)
    target = spark.createDataFrame([("The quick BROWN fox, jumps!",), (None,), ("Tiếng日本語 x\x7fy",)], "text string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    made = importance.resample(docs, target, percent=60, least_words=3, runs=runs)
    assert got(made) == brute(rows, [r.text for r in target.collect()], 60, 3, runs)


def test_composed_crcs():
    r = random.Random(5)
    for _ in range(200):
        words = [bytes(r.choices(b"abz019\xc3\xa9", k=r.choice([1, 2, 7, 300]))) for _ in range(r.randint(0, 9))]
        most = r.randint(1, 5)
        want = [zlib.crc32(b" ".join(words[i:i + n])) for n in range(1, most + 1) for i in range(len(words) - n + 1)]
        payloads = np.array([importance.payload(w) for w in words], np.uint64)
        assert importance.run_crcs(payloads, 1, most).tolist() == want


def test_ranks_over_many_tasks_with_ties(spark):
    rows = spark.range(3000).select((F.col("id") % 700).alias("doc_id"), (F.col("id") % 50).alias("n_words"),
                                    F.lit(1).alias("n_features"), F.lit(0).alias("weight"), (F.col("id") % 3).alias("score"))
    from crawlmeta.llm.common import shared_folder, written
    folder = shared_folder(spark, "ranks")
    made = importance.drawn(written(rows, folder, "rows"), folder, 30, 20).where("rank IS NOT NULL").collect()
    open_rows = sorted((-(i % 3), i % 700) for i in range(3000) if i % 50 >= 20)
    assert sorted((r["rank"], -r.score, r.doc_id) for r in made) == [
        (k, *x) for k, x in enumerate(open_rows[:len(open_rows) * 30 // 100], 1)]


def test_empty_tables(spark):
    target = odd.odd(spark).limit(0)
    assert got(importance.resample(odd.empty(spark), odd.odd(spark))) == []
    rows = [(r.doc_id, r.text) for r in odd.odd(spark).collect()]
    assert got(importance.resample(odd.odd(spark), target)) == brute(rows, [])
