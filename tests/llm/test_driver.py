"""What the driver holds and plans stays small."""

from __future__ import annotations

import gc
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from crawlmeta.llm import common, components, minhash_forest, quality_rules


def test_rules_are_fitted_with_one_matrix(monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.random((6_000, 24))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + 0.3 * rng.random(6_000) > 0.9).astype(float)
    sizes, singular, grow = [], quality_rules.largest_singular, quality_rules.grow_tree
    monkeypatch.setattr(quality_rules, "grow_tree", lambda *a: (grow(*a), gc.collect())[0])

    def watched(z):
        sizes.append(z.nbytes)
        assert z.shape[1] == len(np.unique(z, axis=1).T) > 50
        assert np.isclose(singular(z), np.linalg.norm(z, 2))
        return singular(z)

    monkeypatch.setattr(quality_rules, "largest_singular", watched)
    first = quality_rules.RuleEnsemble.fit(x, y, steps=40)
    monkeypatch.setattr(quality_rules, "largest_singular", singular)
    tracemalloc.start()
    try:
        model = quality_rules.RuleEnsemble.fit(x, y, steps=40)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert model.rules == first.rules and peak < 3 * sizes[0]


def test_near_dedup_plans_few_shuffles_at_once(spark, monkeypatch):
    counts = []

    def counted(df, folder, name):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        counts.append(sum(plan.count(k) for k in ("HashAggregate", "SortAggregate", "ObjectHashAggregate", "Join", "FlatMapGroups")))
        return common.written(df, folder, name)

    for module in (minhash_forest, components):
        monkeypatch.setattr(module, "written", counted)
    words = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(60)), lambda i: F.concat(F.lit("w"), (i * 7 + F.col("id") % 5).cast("string"))))
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(words, F.lit(" end"), (F.col("id") % 20).cast("string")).alias("text"))
    rows = minhash_forest.near_dedup(docs).collect()
    assert len(rows) == 40 and max(counts) <= 14, counts
