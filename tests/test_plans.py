"""Physical-plan properties of registered queries (the scale contract)."""

import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SF0001

NO_SHUFFLE = ["robots_directives", "robots_sitemaps", "robots_warnings", "sitemap_language_region", "tsv_rows",
              "kafka_payload", "html_rows", "resolve_loc"]
NO_PYTHON = ["sitemaps_classified", "sitemap_country_counts", "sitemap_country_counts_lineitem", "filter_grouped",
             "resolve_loc", "select_country", "idn_hosts", "robots_groups", "html_rows"]


def plan(spark, name):
    return entry_mod.queries()[name](spark, SF0001)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(NO_SHUFFLE + NO_PYTHON)))
def test_plan_shape(spark, name):
    p = plan(spark, name)
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p
    if name in NO_SHUFFLE:
        assert "Exchange" not in p, p
    if name in NO_PYTHON:
        assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p and "MapInPandas" not in p


def test_scans_read_only_needed_columns(spark):
    p = plan(spark, "sitemap_country_counts_lineitem")
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in p
    p = plan(spark, "robots_sitemaps")
    assert "ReadSchema: struct<page_id:bigint,url:string>" in p
