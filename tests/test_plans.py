"""Plan regression tests: the physical shapes the scale design depends on."""

import contextlib
import io
import os

import pytest

import sluice as S
from sluice.operators.rules import InvalidCastRule, MissingRule, PredicateRule

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def t(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def test_fused_row_rules_one_scan_no_shuffle(spark):
    l = t(spark, "lineitem").withColumn("tax_text", S.key_text(["l_tax"]))
    l = l.withColumn("tax_num", S.to_double("tax_text"))
    rules = [PredicateRule("l_quantity", "l_quantity < 5", "low"), MissingRule("l_shipdate"),
             InvalidCastRule("tax_text", "tax_num")]
    p = plan(S.row_rule_issues(l, "lineitem", ["l_orderkey", "l_linenumber"], rules))
    assert "Exchange" not in p
    assert p.count("FileScan parquet") == 1 and p.count("Generate") == 1
    assert "l_partkey" not in p.split("ReadSchema:")[1].split("\n")[0]  # pruned


def test_single_row_rule_pushes_filter(spark):
    p = plan(S.row_rule_issues(t(spark, "customer"), "customer", ["c_custkey"],
                               [PredicateRule("c_acctbal", "c_acctbal < 0", "neg")]))
    assert "PushedFilters: [IsNotNull(c_acctbal), LessThan(c_acctbal,0.0)]" in p
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in p


def test_unique_rule_partial_aggregate_before_one_shuffle(spark):
    p = plan(S.unique_issues(t(spark, "lineitem"), "lineitem", S.UniqueRule(("l_orderkey", "l_linenumber"))))
    assert p.count("Exchange hashpartitioning") == 1
    assert p.count("HashAggregate") == 2  # partial below the exchange, final above


def test_dedup_partial_aggregate(spark):
    p = plan(S.dedup(t(spark, "lineitem"), ["l_orderkey", "l_linenumber"], strategy="shuffle"))
    assert p.count("Exchange hashpartitioning") == 1 and "partial_min" in p


def test_foreign_key_small_parent_is_map_only(spark):
    df = S.foreign_key_issues(t(spark, "lineitem"), t(spark, "orders"), "l_orderkey",
                              ["l_orderkey", "l_linenumber"], "lineitem", parent_key="o_orderkey")
    p = plan(df)
    assert "Exchange hashpartitioning" not in p and "BroadcastHashJoin" in p and "LeftAnti" in p
    assert p.count("FileScan parquet") == 2  # the child once, the parent once


def test_small_lookup_scans_the_child_once(spark):
    p = plan(S.lookup_first(t(spark, "customer"), t(spark, "nation"), "c_nationkey", ["n_name"], parent_key="n_nationkey"))
    assert p.count("FileScan parquet") == 2 and "BroadcastHashJoin" in p


def test_default_profile_has_no_expand(spark):
    assert "Expand" not in plan(S.profile(t(spark, "orders")))


def test_wide_key_dedup_broadcasts_hashes_only(spark):
    docs = t(spark, "documents").select("text", "doc_id")
    p = plan(S.dedup(docs, ["text"], order_by=["doc_id"], strategy="duplicated"))
    for part in p.split("BroadcastExchange")[1:]:
        assert "text" not in part.split("Scan")[0].split("Output")[0]


def test_preview_is_top_n(spark):
    p = plan(S.preview(t(spark, "orders"), ["o_orderkey"], 10))
    assert "TakeOrderedAndProject" in p and "Exchange" not in p


def test_constant_lookup_needs_no_join(spark):
    p = plan(t(spark, "part").select("p_partkey", *S.lookup_constant("p_type", {"PROMO": {"low": 1}}, ["low"])))
    assert "Join" not in p and "Exchange" not in p
