import corpus_pipeline
from crawlmeta.llm.common import table

from . import odd


def test_stages_keep_columns_and_decide(spark):
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents")
    seen = [docs.count()]
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = spark.createDataFrame(
            stage(spark, docs, sf).toPandas(), docs.schema)
        assert docs.columns == names, name
        after = [r.doc_id for r in docs.select("doc_id").collect()]
        assert set(after) <= before and len(after) == len(set(after))
        seen.append(len(after))
    assert all(a > b for a, b in zip(seen, seen[1:])) and seen[-1] > 0.6 * seen[0]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == set(after)


def test_run_equals_the_stages(spark):
    got = corpus_pipeline.run(spark, odd.SF)
    assert got.columns[:7] == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert 100 < got.select("doc_id").distinct().count() <= 200


def test_stages_keep_clashing_columns(spark):
    docs = odd.odd(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, odd.SF).collect()
        assert got and {tuple(r)[5:] for r in got} == {odd.EXTRA}, name


def test_run_is_the_stages_one_after_the_other(spark):
    docs = odd.documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, odd.SF).toPandas())
    pieces = ["doc_id", "piece", "start", "length", "ids_crc32"]
    key = lambda df: sorted(map(tuple, df.select(pieces).collect()))
    assert key(corpus_pipeline.run(spark, odd.SF)) == key(docs)


def test_stages_take_odd_rows(spark):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.empty(spark), odd.SF).collect() == []
        stage(spark, odd.odd(spark), odd.SF).collect()
