"""Physical-plan checks on the registered queries."""

import re

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_selection_prunes_text_and_cuts_top_k(spark):
    p = plan(spark, "discover_pages")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    documents = [s for s in schemas if "n_chars" in s]
    assert documents and all("text" not in s.split(",") and "text:" not in s for s in documents)
    assert "TakeOrderedAndProject" in p
    assert "LeftAnti" in p


def test_silver_joins_the_dictionary_by_broadcast(spark):
    p = plan(spark, "silver_catalog")
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_distributed_rank_never_gathers_rows_in_one_partition(spark):
    p = plan(spark, "gold_ranking")
    # one SinglePartition exchange at most: the bucket offsets (bounded table)
    assert p.count("SinglePartition") <= 1
    assert "BroadcastHashJoin" in p


def test_ranked_preview_is_a_top_k_cut(spark):
    p = plan(spark, "top_ranked")
    assert "TakeOrderedAndProject" in p
    assert "ExistingRDD" not in p          # no checkpointed counts: no global rank


def test_ingest_has_no_exchange_of_its_own(spark):
    from strata.sources import ingest_films
    pages = spark.createDataFrame([('{"results":[{"id":1}]}',)], "body string")
    p = ingest_films(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in p


def test_trend_aggregates_partially_before_the_exchange(spark):
    p = plan(spark, "gold_trend_by_year")
    assert "partial_count" in p and "partial_try_sum" in p
