"""Plan-shape guards: the properties the design relies on at scale."""

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def plan(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def test_sample_is_limited_before_the_exchange(spark):
    p = plan(spark, "sample_per_type")
    assert "WindowGroupLimit" in p and "Partial" in p


def test_text_postings_need_no_exchange(spark):
    # term frequencies are counted inside each document's row
    p = plan(spark, "text_postings")
    assert "Exchange hashpartitioning" not in p and "HashAggregate" not in p
    assert "collect_list" not in p and "collect_set" not in p


def test_term_dictionary_aggregates_partially(spark):
    p = plan(spark, "text_term_stats")
    assert "partial_count" in p and "partial_sum" in p


def test_grid_needs_no_join(spark):
    p = plan(spark, "shard_grid")
    assert "Join" not in p


def test_mapping_merge_reads_the_documents_once(spark):
    p = plan(spark, "orders_mapping")
    assert p.count("partial_bit_or") == 1
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_type_lookup_is_a_broadcast_join(spark):
    p = plan(spark, "type_lookup")
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_parse_is_not_inlined_into_filters(spark):
    p = plan(spark, "arity_reject")
    # the status filter stays above the parse: the split (one CASE of a plain
    # and an escape-aware split) appears, and so runs, once per line
    assert p.count("split(") == 2 and p.count("(?<!") == 1


def test_routing_hash_runs_once_per_line(spark):
    p = plan(spark, "shard_routed")
    assert p.count("reflect(java.util.Objects, hashCode") == 1


def test_build_postings_write_needs_no_exchange(spark):
    from shardloom.operators.postings import postings_from_documents
    from shardloom.plans.catalog import DOCS
    from shardloom.plans.build import union_rows
    from shardloom.sources import fixtures as fx
    rows = union_rows(fx.feed_inputs(spark, SF_SMALL, DOCS), DOCS, mode="quarantine")
    docs = rows.filter("index IS NOT NULL")
    p = postings_from_documents(docs, DOCS)._jdf.queryExecution().executedPlan().toString()
    # only the feed's own spread of a one-file table; nothing keyed by term or document
    assert "Exchange hashpartitioning" not in p and "HashAggregate" not in p


def test_active_documents_prune_index_folders(spark):
    df = E.queries()["active_documents"](spark, SF_SMALL)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression(index" in p


def test_counts_by_shard_make_no_ids_and_split_once(spark):
    """Index and shard alone: one split a line, no id hash, no field built."""
    for name in ("shard_grid", "shard_counts"):
        p = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert "sha2" not in p and "event_type" not in p.split("Generate")[0], name


def test_type_lookup_broadcasts_the_types_not_the_lines(spark):
    p = plan(spark, "type_lookup")
    assert "BuildRight" in p and "BuildLeft" not in p
