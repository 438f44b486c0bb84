"""Only texts that lie in a region are shuffled to be confirmed."""

from __future__ import annotations

import pytest

from crawlmeta.llm import minhash_forest


def shuffled_rows(plan, column: str) -> int:
    """Rows that the shuffles of an executed plan wrote with ``column`` among them."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return shuffled_rows(plan.executedPlan(), column)
    if kind.endswith("QueryStageExec"):
        return shuffled_rows(plan.plan(), column)
    own = 0
    if kind == "ShuffleExchangeExec" and f"{column}#" in plan.output().toString():
        own = plan.metrics().apply("shuffleRecordsWritten").value()
    children = plan.children()
    return own + sum(shuffled_rows(children.apply(i), column) for i in range(children.size()))


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize("words", [minhash_forest.MARK_WORDS, 1])
def test_texts_outside_regions_are_not_shuffled(spark, monkeypatch, no_broadcast, words):
    monkeypatch.setattr(minhash_forest, "MARK_WORDS", words)
    text = {i: " ".join(f"w{i}x{k}" for k in range(50)) for i in range(-300, 300)}
    members = list(range(-4, 16, 2))
    for i in members:
        text[i + 1] = text[i] + " end"
    docs = spark.createDataFrame([*text.items(), (None, "a b c"), (400, None)], "doc_id long, text string")
    regions = spark.createDataFrame([(i + k, i, 48 + k) for i in members for k in (0, 1)],
                                    "rep long, region long, n_shingles long")
    links = minhash_forest._confirmed(docs, regions, 3, 85)
    assert sorted(tuple(r) for r in links.collect()) == [(i + 1, i) for i in members]
    moved = shuffled_rows(links._jdf.queryExecution().executedPlan(), "text")
    assert moved >= 2 * len(members)
    if words > 1:
        assert moved <= 3 * len(members)
