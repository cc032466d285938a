"""Registered queries against DuckDB, and the shape of their plans."""

import pytest

import __spark_entry__ as entry_point
from compare_queries import compare, connect
from hybridloom.workload import registry

QUERIES, SQL = entry_point.queries(), entry_point.oracle_sql()
OWN_SQL = sorted(registry.load()[1])


def test_names_match():
    assert set(SQL) <= set(QUERIES) and len(QUERIES) > 100


@pytest.mark.parametrize("name", OWN_SQL)
def test_query_equals_sql(spark, sf, name):
    assert compare(QUERIES[name](spark, sf), connect(sf), SQL[name]).startswith("ok")


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["query_id", "id", "rn", "score"] and df.count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["rrf_hybrid_topk", "rrf_weight_sweep", "context_expansion", "list_sources", "join_range", "grid_product"])
def test_no_cartesian_products(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_topk_is_limited_before_the_shuffle(spark, sf):
    assert "WindowGroupLimit" in plan(QUERIES["topk_per_group"](spark, sf))


def test_scans_read_only_what_they_need(spark, sf):
    text = plan(QUERIES["quality_by_source"](spark, sf))
    assert "text" not in text.split("ReadSchema")[1].split("\n")[0]
    assert "PushedFilters: [IsNotNull" in plan(QUERIES["scroll_filtered"](spark, sf))


def test_results_do_not_depend_on_partitioning(spark, sf):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.append(sorted(map(tuple, QUERIES["merged_provenance"](spark, sf).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1]


def test_keyword_hit_rate_in_blocks_of_terms(spark, sf, monkeypatch):
    from hybridloom.workload import evaluation_queries
    whole = sorted(map(tuple, evaluation_queries.keyword_hit_rate(spark, sf).collect()))
    monkeypatch.setattr(evaluation_queries, "TERMS_BYTES", 300)
    assert sorted(map(tuple, evaluation_queries.keyword_hit_rate(spark, sf).collect())) == whole != []
