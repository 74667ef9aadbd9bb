"""

Every query reads the driver's tables (or data Spark derives from them) in
full and runs through the ``sluice`` library. Dirty inputs (padded codes,
flag spellings, mixed date formats, bad numbers, null keys) are derived from
the rows' own keys inside the query, so the oracle can derive the same.

Groups, in file order:
- scans and I/O (Parquet, CSV with declared / inferred schema, round trips);
- normalisers, parses and casts, one per column builder;
- rules turned into issues (missing, invalid cast, duplicate, business,
  fused rules, foreign keys under each plan), summaries, the sales suite;
- keys and profiles (dedup, distinct values and keys, profile, preview,
  lookups, defect injection, parent sampling);
- the clinical specs themselves, on clinical tables derived row by row from
  the sales tables (check mode, the layered run, cleaned tables, reports);
- the training-data operators and the corpus pipeline, where present.
"""

from __future__ import annotations

import os
import sys
import warnings
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import sluice as S  # noqa: E402
from sluice.operators import synth  # noqa: E402
from sluice.operators.rules import InvalidCastRule, MissingRule, PredicateRule  # noqa: E402
from sluice.plans.clinical import CLINICAL_SPECS  # noqa: E402
from sluice.plans.promotion import all_issues, profile_landing, run_all, table_issues  # noqa: E402
from sluice.plans.sales import SALES_SPECS, load_sales  # noqa: E402
from sluice.sources.scratch import scratch_path  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: every clinical rule (duplicates, missing and invalid values,
    business rules, foreign keys) over clinical tables derived from sf0.001."""
    return q_clinical_check_issues(spark, SMOKE_DIR)


# ----------------------------------------------------------------- scans, I/O
def q_scan_parquet(spark, d):
    return _t(spark, d, "region").select("r_regionkey", "r_name")


def q_csv_schema_scan(spark, d):
    """Customer written as landing CSV, read back with its declared schema."""
    cust = _t(spark, d, "customer")
    path = scratch_path(spark, "customer_csv")
    S.write_csv(cust, path)
    return S.read_csv(spark, path, schema=cust.schema)


def q_csv_infer_scan(spark, d):
    """Same CSV read with inferred types (header names, guessed types)."""
    cust = _t(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    path = scratch_path(spark, "customer_csv_infer")
    S.write_csv(cust, path)
    return S.read_csv(spark, path, infer=True)


def q_parquet_roundtrip(spark, d):
    path = scratch_path(spark, "orders_parquet")
    S.write_parquet(_t(spark, d, "orders"), path)
    return S.read_parquet(spark, path)


# ----------------------------------------------------------------- normalisers
def q_norm_upper_trim(spark, d):
    c = _t(spark, d, "customer")
    dirty = F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" "))
    return c.select("c_custkey", S.upper_trim(dirty).alias("mktsegment"))


def q_norm_trim_only(spark, d):
    c = _t(spark, d, "customer")
    dirty = F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit("  "))
    return c.select(
        "c_custkey",
        S.trim_spaces(F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))).alias("name"),
        S.map_values(dirty, {"MACHINERY": "mach"}, fallback="trim").alias("segment"),
    )


def _flag_text():
    k = F.col("o_orderkey") % 6
    return (F.when(k == 0, " yes").when(k == 1, "True").when(k == 2, "no ")
            .when(k == 3, "FALSE").when(k == 4, "y"))


def q_norm_flag(spark, d):
    o = _t(spark, d, "orders")
    return o.select("o_orderkey", S.normalize_flag(_flag_text()).alias("flag"))


def q_norm_flag_two(spark, d):
    o = _t(spark, d, "orders")
    from sluice.functions.columns import FLAG_TWO_SYNONYMS
    return o.select("o_orderkey", S.map_values(_flag_text(), FLAG_TWO_SYNONYMS).alias("flag"))


def q_norm_value_map(spark, d):
    o = _t(spark, d, "orders")
    return o.select("o_orderkey", S.map_values("o_orderpriority", {"1-URGENT": "SEVERE"}).alias("severity"))


def _brand_map():
    """25 brands: those of number 5, 10, ... go to null, the others to a short code."""
    return {f"BRAND#{i}": None if i % 5 == 0 else f"B{i}" for i in range(1, 26)}


def q_norm_value_map_many(spark, d):
    p = _t(spark, d, "part")
    dirty = F.when(F.col("p_partkey") % 9 == 0, F.concat(F.lit(" other "), F.col("p_brand"))).otherwise(F.lower("p_brand"))
    return p.select("p_partkey", S.map_values(dirty, _brand_map()).alias("brand"))


def q_parse_date_optional(spark, d):
    """A pattern with an optional section."""
    o = _t(spark, d, "orders")
    k = F.col("o_orderkey") % 3
    s = (F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
         .when(k == 1, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm")).otherwise("none"))
    return o.select("o_orderkey", S.parse_date(s, ["yyyy-MM-dd[ HH:mm]"]).alias("order_date"))


def q_record_id_composite(spark, d):
    """Record ids of composite keys with null parts and parts that hold the separator."""
    o = _t(spark, d, "orders")
    k = F.col("o_orderkey") % 4
    part = F.when(k == 0, F.lit(None)).when(k == 1, "a|b").when(k == 2, "a\\b").otherwise(F.col("o_orderstatus"))
    return o.select("o_orderkey", S.key_text([part, "o_custkey"]).alias("record_id"))


def q_parse_date_multi(spark, d):
    o = _t(spark, d, "orders")
    k = F.col("o_orderkey") % 4
    s = (F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
         .when(k == 1, F.date_format("o_orderdate", "dd/MM/yyyy"))
         .when(k == 2, F.lit("garbage")))
    return o.select("o_orderkey", S.parse_date(s, ["yyyy-MM-dd", "dd/MM/yyyy"]).alias("order_date"))


def _dirty_quantity():
    k = F.col("l_orderkey") % 10
    return F.when(k == 0, "not_available").when(k == 1, F.lit(None)).otherwise(F.col("l_quantity").cast("string"))


def q_cast_double_issue(spark, d):
    l = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", _dirty_quantity().alias("v"))
    l = l.withColumn("v_numeric", S.to_double("v"))
    return l.select("l_orderkey", "l_linenumber", "v_numeric",
                    (F.col("v").isNotNull() & F.col("v_numeric").isNull()).alias("is_invalid"))


def q_cast_int_trunc(spark, d):
    return _t(spark, d, "customer").select("c_custkey", S.to_int("c_acctbal").alias("acctbal_int"))


def q_range_flag(spark, d):
    l = _t(spark, d, "lineitem")
    return l.select("l_orderkey", "l_linenumber", "l_quantity",
                    S.range_flag("l_quantity", 5, 45).alias("abnormal_flag"))


def q_conditional_flag(spark, d):
    o = _t(spark, d, "orders")
    cond = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderkey") % 10 > 3)
    return o.select("o_orderkey", S.flag_when(cond).alias("serious_event"))


def q_round_half_even(spark, d):
    l = _t(spark, d, "lineitem")
    text = F.concat(
        (F.col("l_orderkey") * 37 + F.col("l_linenumber")).cast("string"), F.lit("."),
        F.lpad(((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 1000).cast("string"), 3, "0"),
    )
    return l.select("l_orderkey", "l_linenumber",
                    S.round_half_even(text.cast("decimal(18,3)"), 2).cast("double").alias("rounded"))


def q_id_format(spark, d):
    return _t(spark, d, "customer").select("c_custkey", S.format_id("c_custkey", "P", 4).alias("patient_id"))


def q_date_offset_format(spark, d):
    o = _t(spark, d, "orders")
    shifted = S.add_days("o_orderdate", (F.col("o_orderkey") % 21 - 5).cast("int"))
    return o.select("o_orderkey", S.date_text(shifted).alias("visit_date"))


def q_filter_prefix(spark, d):
    p = _t(spark, d, "part")
    return p.where(S.starts_with("p_brand", "Brand#1")).select("p_partkey")


# ----------------------------------------------------------------- rules → issues
def q_issue_missing(spark, d):
    docs = _t(spark, d, "documents").select("doc_id")
    labeled = docs.join(_t(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return S.row_rule_issues(labeled, "documents", ["doc_id"], [MissingRule("quality", "Missing quality value")])


def q_issue_invalid_cast(spark, d):
    l = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", _dirty_quantity().alias("l_quantity"))
    l = l.withColumn("quantity_numeric", S.to_double("l_quantity"))
    return S.row_rule_issues(l, "lineitem", ["l_orderkey", "l_linenumber"],
                             [InvalidCastRule("l_quantity", "quantity_numeric")])


def q_issue_duplicate(spark, d):
    rule = S.UniqueRule(("l_orderkey", "l_linenumber"), "Duplicate key detected")
    return S.unique_issues(_t(spark, d, "lineitem"), "lineitem", rule)


def q_issue_business_range(spark, d):
    return S.row_rule_issues(_t(spark, d, "customer"), "customer", ["c_custkey"],
                             [PredicateRule("c_acctbal", "c_acctbal < 0", "c_acctbal cannot be negative")])


def q_issue_fused_rules(spark, d):
    """Three row rules over lineitem in one scan."""
    l = _t(spark, d, "lineitem")
    k = F.col("l_orderkey") % 10
    l = l.select(
        "l_orderkey", "l_linenumber", "l_discount",
        F.when(k == 0, "n/a").otherwise(F.col("l_tax").cast("string")).alias("l_tax_text"),
        F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("l_shipdate")).alias("l_shipdate"),
    ).withColumn("l_tax_numeric", S.to_double("l_tax_text"))
    rules = [
        MissingRule("l_shipdate", "Missing l_shipdate value"),
        InvalidCastRule("l_tax_text", "l_tax_numeric"),
        PredicateRule("l_discount", "l_discount >= 0.09", "l_discount above limit"),
    ]
    return S.row_rule_issues(l, "lineitem", ["l_orderkey", "l_linenumber"], rules)


def q_issue_foreign_key(spark, d):
    return S.foreign_key_issues(
        _t(spark, d, "orders"), _t(spark, d, "lineitem"), "o_orderkey", "o_orderkey", "orders",
        parent_key="l_orderkey", parent_name="lineitem",
    )


def q_issue_foreign_key_direct(spark, d):
    return S.foreign_key_issues(
        _t(spark, d, "orders"), _t(spark, d, "lineitem"), "o_orderkey", "o_orderkey", "orders",
        parent_key="l_orderkey", parent_name="lineitem", strategy="direct",
    )


def q_issue_foreign_key_keys(spark, d):
    """Two-phase plan: distinct keys first, then a size-checked broadcast semi-join."""
    return S.foreign_key_issues(
        _t(spark, d, "orders"), _t(spark, d, "lineitem"), "o_orderkey", "o_orderkey", "orders",
        parent_key="l_orderkey", parent_name="lineitem", strategy="keys",
    )


def _dirty_custkey():
    k = F.col("o_orderkey")
    return F.when(k % 11 == 0, F.lit(None)).when(k % 13 == 0, F.lit(-1)).otherwise(F.col("o_custkey"))


def q_fk_null_is_orphan(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", _dirty_custkey().alias("fk"))
    return S.orphans(o, _t(spark, d, "customer"), "fk", parent_key="c_custkey").select("o_orderkey")


def q_fk_mixed_types(spark, d):
    """Text keys against a numeric parent key: text that is no number is an orphan."""
    k = F.col("o_orderkey")
    fk = F.when(k % 10 == 0, "abc").when(k % 10 == 1, F.lit(None)).when(k % 10 == 2, "-5").otherwise(
        F.col("o_custkey").cast("string"))
    o = _t(spark, d, "orders").select("o_orderkey", fk.alias("fk"))
    return S.orphans(o, _t(spark, d, "customer"), "fk", parent_key="c_custkey").select("o_orderkey", "fk")


def _skewed_orders(spark, d):
    """Orders whose customer key is one existing customer for a third of the rows, one missing
    customer for another seventh, and a missing customer of its own for some."""
    k = F.col("o_orderkey")
    fk = F.when(k % 3 == 0, F.lit(7)).when(k % 7 == 1, F.lit(-1)).when(k % 11 == 2, -k).when(
        k % 13 == 3, F.lit(None)).otherwise(F.col("o_custkey"))
    return _t(spark, d, "orders").select("o_orderkey", fk.cast("long").alias("fk"))


def q_fk_large_parent(spark, d):
    """The plan of a parent and missing keys over the broadcast bound, with hot missing keys."""
    return S.orphans(_skewed_orders(spark, d), _t(spark, d, "customer"), "fk", parent_key="c_custkey",
                     max_broadcast_keys=20, hot_key_rows=100).select("o_orderkey", "fk")


def q_fk_hot_beyond_bounds(spark, d):
    """More hot missing keys than may be broadcast: one is, the others are salted."""
    k = F.col("o_orderkey")
    fk = F.when(k % 3 == 0, -(F.col("o_custkey") % 5) - 1).when(k % 11 == 2, -k).when(k % 13 == 3, F.lit(None)).otherwise(F.col("o_custkey"))
    o = _t(spark, d, "orders").select("o_orderkey", fk.cast("long").alias("fk"))
    return S.orphans(o, _t(spark, d, "customer"), "fk", parent_key="c_custkey", max_broadcast_keys=1, hot_key_rows=20).select("o_orderkey", "fk")


def q_fk_composite(spark, d):
    """Composite key: (orderkey, linenumber + 1) must exist in lineitem."""
    l = _t(spark, d, "lineitem")
    child = l.select("l_orderkey", "l_linenumber", (F.col("l_linenumber") + 1).alias("next_line"))
    found = S.orphans(child, l, ["l_orderkey", "next_line"], parent_key=["l_orderkey", "l_linenumber"])
    return found.select("l_orderkey", "l_linenumber").distinct()


def q_issue_union_summary(spark, d):
    cust = S.row_rule_issues(_t(spark, d, "customer"), "customer", ["c_custkey"],
                             [PredicateRule("c_acctbal", "c_acctbal < 0", "c_acctbal cannot be negative")])
    supp = S.row_rule_issues(_t(spark, d, "supplier"), "supplier", ["s_suppkey"],
                             [PredicateRule("s_acctbal", "s_acctbal < 0", "s_acctbal cannot be negative")])
    orph = q_issue_foreign_key(spark, d)
    return S.issue_summary(S.union_issues([cust, supp, orph]), ["dataset_name", "issue_type", "severity"])


def q_issue_summary(spark, d):
    return S.issue_summary(q_sales_issues(spark, d))


def q_sales_issues(spark, d):
    """Every rule of the sales suite: row, unique and foreign-key issues."""
    return table_issues(load_sales(spark, d), SALES_SPECS, parallel=4)


# ----------------------------------------------------------------- keys, profiles
def q_dedup_keep_first(spark, d):
    docs = _t(spark, d, "documents").select("text", "doc_id")
    return S.dedup(docs, ["text"], order_by=["doc_id"])


def q_dedup_rows(spark, d):
    """Whole rows, one per (orderkey, linenumber): smallest partkey first."""
    return S.dedup(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], order_by=["l_partkey"])


def q_dedup_duplicated_only(spark, d):
    """The plan for large tables: only rows of repeated keys are aggregated."""
    return S.dedup(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], order_by=["l_partkey"],
                   strategy="duplicated")


def q_dedup_many_recurring(spark, d):
    """More recurring keys than the bound: a key filter of fixed size keeps rows of unique keys in place."""
    return S.dedup(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], order_by=["l_partkey"],
                   strategy="duplicated", max_duplicate_keys=1000)


def q_dedup_wide_key(spark, d):
    """The same plan keyed on whole texts: hashes are grouped and broadcast, never texts."""
    docs = _t(spark, d, "documents").select("text", "doc_id")
    return S.dedup(docs, ["text"], order_by=["doc_id"], strategy="duplicated")


def q_duplicate_key_counts(spark, d):
    return S.duplicate_keys(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_duplicate_wide_keys(spark, d):
    """Repeated texts: hashes are counted, and only texts whose hash recurs move, past a key filter here."""
    return S.duplicate_keys(_t(spark, d, "documents"), ["text", "lang"], strategy="hashed", max_duplicate_keys=50)


def q_distinct_values(spark, d):
    return S.distinct_values(_t(spark, d, "part"), "p_type")


def q_distinct_nonnull_keys(spark, d):
    return S.distinct_keys(_t(spark, d, "orders"), "o_custkey")


def q_profile_table(spark, d):
    orders = _t(spark, d, "orders")
    return S.profile(orders, distinct=orders.columns)


def q_profile_counts(spark, d):
    """The default profile: row and null counts, no distinct counts."""
    return S.profile(_t(spark, d, "lineitem"))


def q_profile_distinct_all(spark, d):
    """Exact distinct counts of every column of three tables' types from one aggregate of (column, value)."""
    docs = _t(spark, d, "documents").select("doc_id", "text", "lang", "source")
    frames = [S.profile(t, distinct=t.columns) for t in (_t(spark, d, "lineitem"), _t(spark, d, "customer").select("c_custkey", "c_acctbal", "c_name"), docs)]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def q_preview(spark, d):
    l = _t(spark, d, "lineitem")
    return S.preview(l, l.columns, 10)


def q_lookup_first(spark, d):
    return S.lookup_first(_t(spark, d, "customer").select("c_custkey", "c_nationkey"),
                          _t(spark, d, "nation"), "c_nationkey", ["n_name"],
                          parent_key="n_nationkey").select("c_custkey", "n_name")


def q_lookup_first_large(spark, d):
    """The plan of a parent over the broadcast bound: hot keys map-only, the rest shuffled."""
    found = S.lookup_first(_skewed_orders(spark, d), _t(spark, d, "customer"), "fk", ["c_name"], parent_key="c_custkey",
                           max_broadcast_rows=20, hot_key_rows=100)
    return found.select("o_orderkey", "fk", "c_name")


def q_lookup_hot_beyond_bounds(spark, d):
    """More hot keys than parent rows may be broadcast, some of them without a parent."""
    k = F.col("o_orderkey")
    fk = F.when(k % 3 == 0, F.col("o_custkey") % 7 - 2).when(k % 13 == 3, F.lit(None)).otherwise(F.col("o_custkey"))
    o = _t(spark, d, "orders").select("o_orderkey", fk.cast("long").alias("fk"))
    found = S.lookup_first(o, _t(spark, d, "customer"), "fk", ["c_name"], parent_key="c_custkey", max_broadcast_rows=2, hot_key_rows=20)
    return found.select("o_orderkey", "fk", "c_name")


# The small reference table of the constant-lookup query.
PART_TYPE_LIMITS = {
    "ECONOMY": {"low": 5, "high": 20},
    "PROMO": {"low": 10, "high": 40},
    "SMALL": {"low": 1, "high": 30},
}


def q_lookup_constant(spark, d):
    p = _t(spark, d, "part")
    return p.select("p_partkey", *S.lookup_constant("p_type", PART_TYPE_LIMITS, ["low", "high"]))


# ----------------------------------------------------------------- synthesis
def q_inject_defects(spark, d):
    c = _t(spark, d, "customer").select("c_custkey", "c_mktsegment")
    c = synth.inject(c, "c_custkey", {5: {"c_mktsegment": "Female"}, 12: {"c_mktsegment": "Male"}})
    return synth.duplicate_rows(c, "c_custkey", [10])


def q_sample_parent(spark, d):
    cust = _t(spark, d, "customer").select("c_custkey")
    orders = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    picked = synth.sample_parent(cust, orders, lambda n: F.pmod(F.col("c_custkey") * 7919 + 42, n),
                                 parent_order=["o_orderkey"])
    return picked.select("c_custkey", "o_orderkey", "o_orderstatus")


def q_sample_parent_null(spark, d):
    """Rows without a pick keep nulls."""
    cust = _t(spark, d, "customer").select("c_custkey")
    nation = _t(spark, d, "nation").select("n_nationkey", "n_name")
    pick = F.when(F.col("c_custkey") % 4 != 0, F.col("c_custkey") % 25)
    return synth.sample_parent(cust, nation, lambda n: pick, parent_order=["n_nationkey"]).select("c_custkey", "n_name")


def q_sample_parent_large(spark, d):
    """A parent over the bounds: hot picks matched map-only or salted, rows without a pick never shuffled."""
    k = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    l = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    orders = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    pick = F.when(k % 3 == 0, k % 4).when(k % 5 == 0, F.lit(None)).when(k % 7 == 0, F.lit(-1)).otherwise(k)
    picked = synth.sample_parent(l, orders, lambda n: pick % n, parent_order=["o_orderkey"], max_broadcast_rows=2, hot_pick_rows=50)
    return picked.select("l_orderkey", "l_linenumber", "o_orderkey", "o_orderstatus")


def q_sample_parent_empty(spark, d):
    """An empty parent gives nulls."""
    none = _t(spark, d, "nation").where("n_nationkey < 0").select("n_nationkey", "n_name")
    return synth.sample_parent(_t(spark, d, "customer").select("c_custkey"), none, lambda n: F.col("c_custkey") % n)


def _pick(values, idx):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx % len(values) + 1).cast("int"))


def _case(idx, n, values, default):
    """CASE idx % n WHEN 0 THEN values[0] ... ELSE default END."""
    expr = None
    for i, v in enumerate(values):
        cond = idx % n == i
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def _with_copies(base):
    """Rows whose ``__copy`` flag is set appear twice (the duplicated-record defect)."""
    return base.drop("__copy").unionByName(base.where("__copy").drop("__copy"))


def _clinical_from_sales(spark, d):
    """Landing-shaped clinical tables derived row by row from the sales tables.

    Every value, defect and duplicate is a function of the source row's own
    columns, so the DuckDB oracle derives the same rows. Sizes follow the
    sales tables (patients = customers, visits = orders, adverse events =
    events, lab results and medications = line items).
    """
    cust, orders = _t(spark, d, "customer"), _t(spark, d, "orders")
    events, line = _t(spark, d, "events"), _t(spark, d, "lineitem")
    iso, day0 = "yyyy-MM-dd", F.to_date(F.lit("2025-01-01"))

    k = F.col("c_custkey")
    site = _pick(synth.SITES, F.col("c_nationkey"))
    enrolled = F.date_add(day0, (k % 365).cast("int"))
    pbase = cust.select(
        S.format_id(k + 1, "P", 4).alias("patient_id"),
        F.when(k % 40 == 0, F.concat(F.lit(" "), F.lower(site), F.lit(" "))).otherwise(site).alias("site_id"),
        _case(k, 7, ["Female", "male ", "F"], "M").alias("sex"),
        F.when(k % 50 == 20, F.lit(None)).otherwise((F.lit(1945) + k % 61).cast("double")).alias("birth_year"),
        F.when(k % 30 == 0, F.date_format(enrolled, "dd/MM/yyyy")).when(k % 30 == 1, "not a date")
        .otherwise(F.date_format(enrolled, iso)).alias("enrollment_date"),
        _pick(synth.TREATMENT_ARMS, k).alias("treatment_arm"),
        _pick(synth.PATIENT_STATUSES, F.col("c_nationkey")).alias("status"),
        (k % 97 == 10).alias("__copy"),
    )
    patients = _with_copies(pbase)

    o, c = F.col("o_orderkey"), F.col("o_custkey")
    sd = F.to_date("o_orderdate")
    vd = F.date_add(sd, (o % 21 - 5).cast("int"))
    vsite = _pick(synth.SITES, c)
    vbase = orders.select(
        S.format_id(o + 1, "V", 5).alias("visit_id"),
        F.when(o % 101 == 7, "P_BAD").otherwise(S.format_id(c + 1, "P", 4)).alias("patient_id"),
        F.when(o % 33 == 0, F.lower(vsite)).otherwise(vsite).alias("site_id"),
        _pick(synth.VISIT_TYPES, o).alias("visit_type"),
        F.when(o % 25 == 3, F.date_format(sd, "yyyy/MM/dd")).otherwise(F.date_format(sd, iso)).alias("scheduled_date"),
        F.when(o % 89 == 15, "").when(o % 89 == 16, F.date_format(vd, "yyyy/MM/dd"))
        .otherwise(F.date_format(vd, iso)).alias("visit_date"),
        _case(o, 6, ["YES", "no", "True", "N"], "Y").alias("completed"),
        _case(o, 5, ["FALSE", " y"], "N").alias("protocol_deviation"),
        (o % 113 == 22).alias("__copy"),
    )
    visits = _with_copies(vbase)

    e, u = F.col("event_id"), F.col("user_id")
    ed = F.to_date("ts")
    ebase = events.select(
        S.format_id(e + 1, "AE", 5).alias("event_id"),
        F.when(e % 97 == 9, "P_UNKNOWN").otherwise(S.format_id(u + 1, "P", 4)).alias("patient_id"),
        _pick(synth.SITES, u).alias("site_id"),
        F.when(e % 20 == 14, F.date_format(ed, "MM-dd-yyyy")).otherwise(F.date_format(ed, iso)).alias("event_date"),
        _case(e, 5, ["high", "MILD", "moderate "], "SEVERE").alias("severity"),
        _pick(synth.AE_RELATIONSHIP, e).alias("relationship_to_treatment"),
        _pick(synth.AE_OUTCOMES, e % 7).alias("outcome"),
        _case(e, 4, ["TRUE", "false"], "N").alias("serious_event"),
        (e % 211 == 12).alias("__copy"),
    )
    adverse = _with_copies(ebase)

    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    sk, pk = F.col("l_suppkey"), F.col("l_partkey")
    labs = line.select(
        F.concat(F.lit("LR"), ok.cast("string"), F.lit("-"), ln.cast("string")).alias("result_id"),
        S.format_id(sk + 1, "P", 4).alias("patient_id"),
        F.when(ok % 97 == 33, "V_BAD").otherwise(S.format_id(ok + 1, "V", 5)).alias("visit_id"),
        _pick(LAB_TEST_SPELLINGS, ln).alias("test_name"),
        F.when(ok % 10 == 0, "not_available").when(ok % 10 == 1, F.lit(None))
        .otherwise(F.col("l_quantity").cast("string")).alias("test_value"),
        F.when(sk % 9 == 0, " IU/L ").otherwise("U/L").alias("unit"),
        F.lit(7.0).alias("reference_range_low"),
        F.lit(56.0).alias("reference_range_high"),
        _case(pk, 4, ["TRUE", "false", "Y"], "N").alias("abnormal_flag"),
    )
    ad = F.to_date("l_shipdate")
    meds = line.select(
        F.concat(S.format_id(ok, "M", 6), F.lit("-"), ln.cast("string")).alias("medication_id"),
        S.format_id(sk + 1, "P", 4).alias("patient_id"),
        F.when(pk % 53 == 36, "V_BAD").otherwise(S.format_id(ok + 1, "V", 5)).alias("visit_id"),
        _pick(DRUG_SPELLINGS, sk).alias("drug_name"),
        (F.col("l_quantity").cast("int") - 5).alias("dose"),
        _case(ln, 3, ["milligrams", " mg/day"], "mg").alias("dose_unit"),
        F.when(ok % 12 == 5, F.date_format(ad, "yyyy.MM.dd")).when(ok % 12 == 6, "2025-02-30")
        .otherwise(F.date_format(ad, iso)).alias("administration_date"),
        _pick(ROUTE_SPELLINGS, pk).alias("route"),
    )
    return {"patients": patients, "visits": visits, "adverse_events": adverse,
            "lab_results": labs, "medications": meds}


# Dirty spellings used by the derived clinical tables.
LAB_TEST_SPELLINGS = [" alt", "AST", "hemoglobin", "WBC ", "CREATININE"]
DRUG_SPELLINGS = [" PLACEBO", "Investigational Drug A ", "Investigational Drug B"]
ROUTE_SPELLINGS = [" oral", "IV", "sc"]


def q_clinical_check_issues(spark, d):
    """Every clinical rule (R1–R12 kinds) over the derived tables, check mode."""
    return table_issues(_clinical_from_sales(spark, d), CLINICAL_SPECS, parallel=4)


def q_clinical_layers_issues(spark, d):
    """The layered promotion (landing CSV → raw → cleaned → issues →
    integrity) over the derived clinical tables; all issue tables read back."""
    layers = S.LayerPaths(scratch_path(spark, "clinical_derived"))
    synth.save_landing(_clinical_from_sales(spark, d), layers.landing)
    run_all(spark, CLINICAL_SPECS, layers, parallel=len(CLINICAL_SPECS))
    return all_issues(spark, CLINICAL_SPECS, layers)


# Date columns reported by the optional unparsed-value rule.
UNPARSED_DATE_COLUMNS = {
    "patients": ("enrollment_date",),
    "visits": ("scheduled_date", "visit_date"),
    "adverse_events": ("event_date",),
    "medications": ("administration_date",),
}


def q_clinical_unparsed_dates(spark, d):
    """The optional INVALID_FORMAT_VALUE rule alone, on every date column."""
    from dataclasses import replace

    specs = {n: replace(CLINICAL_SPECS[n], report_unparsed=cols, row_rules=(), unique=False, foreign_keys=())
             for n, cols in UNPARSED_DATE_COLUMNS.items()}
    tables = _clinical_from_sales(spark, d)
    return table_issues({n: tables[n] for n in specs}, specs)


def q_clinical_landing_profile_derived(spark, d):
    """Landing CSVs of the derived clinical tables, profiled per column (C8)."""
    layers = S.LayerPaths(scratch_path(spark, "clinical_derived_profile"))
    synth.save_landing(_clinical_from_sales(spark, d), layers.landing)
    return profile_landing(spark, CLINICAL_SPECS, layers, distinct=True)


def q_clinical_issues_partitioned(spark, d):
    """The combined issue table of a layered run (K3), partitioned by dataset, replaced once and read back."""
    layers = S.LayerPaths(scratch_path(spark, "clinical_partitioned"))
    synth.save_landing(_clinical_from_sales(spark, d), layers.landing)
    run_all(spark, CLINICAL_SPECS, layers, combined=True)
    written = S.read_parquet(spark, layers.all_issues())
    S.write_parquet(written, layers.all_issues(), partition_by=["dataset_name"])  # replaces the table it reads
    return S.read_parquet(spark, layers.all_issues()).select(*S.ISSUE_COLUMNS)


def q_clinical_stream_issues(spark, d):
    """Derived medications landed as CSV, promoted by the incremental stream
    (available-now trigger); the row-rule issues it wrote, read back."""
    from sluice.streaming import promote_landing_stream

    root = scratch_path(spark, "clinical_stream")
    S.write_csv(_clinical_from_sales(spark, d)["medications"], f"{root}/landing/medications")
    promote_landing_stream(spark, CLINICAL_SPECS["medications"], f"{root}/landing/medications",
                           f"{root}/cleaned", f"{root}/issues", f"{root}/checkpoint").awaitTermination()
    return S.read_parquet(spark, f"{root}/issues").select(*S.ISSUE_COLUMNS)


def q_clinical_patients_profile(spark, d):
    """Column profile of the derived patients landing table (A7)."""
    patients = _clinical_from_sales(spark, d)["patients"]
    return S.profile(patients, distinct=patients.columns)


def q_clinical_issue_summary(spark, d):
    """Issue counts per dataset, type and severity (A5) of the clinical check."""
    return S.issue_summary(q_clinical_check_issues(spark, d), ["dataset_name", "issue_type", "severity"])


def q_clinical_visits_preview(spark, d):
    """The first 10 cleaned, deduplicated visits by visit_id (L1)."""
    return S.preview(q_clinical_cleaned_visits(spark, d), ["visit_id"], 10)


def q_clinical_cleaned_visits(spark, d):
    spec = CLINICAL_SPECS["visits"]
    return spec.deduplicate(spec.clean(_clinical_from_sales(spark, d)["visits"]))


def q_clinical_cleaned_medications(spark, d):
    return _cleaned(spark, d, "medications")


def _cleaned(spark, d, name):
    spec = CLINICAL_SPECS[name]
    return spec.deduplicate(spec.clean(_clinical_from_sales(spark, d)[name]))


def q_clinical_cleaned_patients(spark, d):
    return _cleaned(spark, d, "patients")


def q_clinical_cleaned_lab_results(spark, d):
    return _cleaned(spark, d, "lab_results")


def q_clinical_cleaned_adverse_events(spark, d):
    return _cleaned(spark, d, "adverse_events")


def q_clinical_row_counts(spark, d):
    """Rows of each dataset as the layered promotion counts them: landing, before and after dedup."""
    layers = S.LayerPaths(scratch_path(spark, "clinical_counts"))
    synth.save_landing(_clinical_from_sales(spark, d), layers.landing)
    report = run_all(spark, CLINICAL_SPECS, layers, parallel=len(CLINICAL_SPECS))
    rows = [(n, report.landing_rows[n], report.cleaned_rows_before_dedup[n], report.cleaned_rows[n]) for n in CLINICAL_SPECS]
    return spark.createDataFrame(rows, "dataset_name string, landing_rows long, before_dedup long, after_dedup long")


def q_clinical_stream_unparsed(spark, d):
    """Derived medications through the stream, with the optional unparsed-value rule."""
    from dataclasses import replace

    from sluice.streaming import promote_landing_stream

    root, name = scratch_path(spark, "clinical_stream_unparsed"), "medications"
    spec = replace(CLINICAL_SPECS[name], report_unparsed=("administration_date",))
    S.write_csv(_clinical_from_sales(spark, d)[name], f"{root}/landing/{name}")
    promote_landing_stream(spark, spec, f"{root}/landing/{name}", f"{root}/cleaned", f"{root}/issues",
                           f"{root}/checkpoint").awaitTermination()
    return S.read_parquet(spark, f"{root}/issues").select(*S.ISSUE_COLUMNS)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_parquet": q_scan_parquet,
    "csv_schema_scan": q_csv_schema_scan,
    "csv_infer_scan": q_csv_infer_scan,
    "parquet_roundtrip": q_parquet_roundtrip,
    "norm_upper_trim": q_norm_upper_trim,
    "norm_trim_only": q_norm_trim_only,
    "norm_flag": q_norm_flag,
    "norm_flag_two": q_norm_flag_two,
    "norm_value_map": q_norm_value_map,
    "parse_date_multi": q_parse_date_multi,
    "cast_double_issue": q_cast_double_issue,
    "cast_int_trunc": q_cast_int_trunc,
    "range_flag": q_range_flag,
    "conditional_flag": q_conditional_flag,
    "round_half_even": q_round_half_even,
    "id_format": q_id_format,
    "date_offset_format": q_date_offset_format,
    "filter_prefix": q_filter_prefix,
    "issue_missing": q_issue_missing,
    "issue_invalid_cast": q_issue_invalid_cast,
    "issue_duplicate": q_issue_duplicate,
    "issue_business_range": q_issue_business_range,
    "issue_fused_rules": q_issue_fused_rules,
    "issue_foreign_key": q_issue_foreign_key,
    "issue_foreign_key_direct": q_issue_foreign_key_direct,
    "issue_foreign_key_keys": q_issue_foreign_key_keys,
    "fk_null_is_orphan": q_fk_null_is_orphan,
    "fk_composite": q_fk_composite,
    "issue_union_summary": q_issue_union_summary,
    "issue_summary": q_issue_summary,
    "sales_issues": q_sales_issues,
    "dedup_keep_first": q_dedup_keep_first,
    "dedup_rows": q_dedup_rows,
    "distinct_values": q_distinct_values,
    "distinct_nonnull_keys": q_distinct_nonnull_keys,
    "profile_table": q_profile_table,
    "preview": q_preview,
    "lookup_first": q_lookup_first,
    "lookup_constant": q_lookup_constant,
    "inject_defects": q_inject_defects,
    "sample_parent": q_sample_parent,
    "clinical_check_issues": q_clinical_check_issues,
    "clinical_layers_issues": q_clinical_layers_issues,
    "clinical_cleaned_visits": q_clinical_cleaned_visits,
    "clinical_patients_profile": q_clinical_patients_profile,
    "clinical_stream_issues": q_clinical_stream_issues,
    "clinical_landing_profile_derived": q_clinical_landing_profile_derived,
    "clinical_unparsed_dates": q_clinical_unparsed_dates,
    "clinical_issue_summary": q_clinical_issue_summary,
    "clinical_visits_preview": q_clinical_visits_preview,
    "clinical_cleaned_medications": q_clinical_cleaned_medications,
    "norm_value_map_many": q_norm_value_map_many,
    "parse_date_optional": q_parse_date_optional,
    "record_id_composite": q_record_id_composite,
    "fk_mixed_types": q_fk_mixed_types,
    "fk_large_parent": q_fk_large_parent,
    "dedup_duplicated_only": q_dedup_duplicated_only,
    "dedup_wide_key": q_dedup_wide_key,
    "duplicate_key_counts": q_duplicate_key_counts,
    "profile_counts": q_profile_counts,
    "lookup_first_large": q_lookup_first_large,
    "sample_parent_null": q_sample_parent_null,
    "clinical_cleaned_patients": q_clinical_cleaned_patients,
    "clinical_cleaned_lab_results": q_clinical_cleaned_lab_results,
    "clinical_cleaned_adverse_events": q_clinical_cleaned_adverse_events,
    "clinical_row_counts": q_clinical_row_counts,
    "clinical_stream_unparsed": q_clinical_stream_unparsed,
    "fk_hot_beyond_bounds": q_fk_hot_beyond_bounds,
    "lookup_hot_beyond_bounds": q_lookup_hot_beyond_bounds,
    "dedup_many_recurring": q_dedup_many_recurring,
    "sample_parent_large": q_sample_parent_large,
    "sample_parent_empty": q_sample_parent_empty,
    "profile_distinct_all": q_profile_distinct_all,
    "duplicate_wide_keys": q_duplicate_wide_keys,
    "clinical_issues_partitioned": q_clinical_issues_partitioned,
}


def _training_data():
    """Queries and SQL of the training-data operators and the corpus pipeline.
    Their package and script are optional: without them, nothing is added."""
    try:
        import corpus_pipeline
        from sluice.llm import queries as operators
    except ModuleNotFoundError as e:
        if e.name not in ("corpus_pipeline", "sluice.llm", "sluice.llm.queries"):
            warnings.warn(f"no training-data queries: {e.name} is not installed", stacklevel=2)
        return {}, {}
    sql = {} if corpus_pipeline.ORACLE_SQL is None else {"pipeline": corpus_pipeline.ORACLE_SQL}
    return {**operators.queries(), "pipeline": corpus_pipeline.run}, {**operators.oracle_sql(), **sql}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_training_data()[0]}


def _fk_sql(table, key, fk, parent, pk, description, source=None):
    return (f"SELECT '{table}' AS dataset_name, {key} AS record_id, '{fk}' AS field_name, "
            f"'INVALID_FOREIGN_KEY' AS issue_type, '{description}' AS issue_description, 'HIGH' AS severity "
            f"FROM {source or table} AS child WHERE NOT EXISTS (SELECT 1 FROM {parent} WHERE {pk} = child.{fk})")


def _dup_sql(table, keys):
    rid = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    field = "|".join(keys)
    return (f"SELECT '{table}' AS dataset_name, {rid} AS record_id, '{field}' AS field_name, "
            f"'DUPLICATE_RECORD' AS issue_type, 'Duplicate {field} detected' AS issue_description, "
            f"'HIGH' AS severity FROM {table} GROUP BY {', '.join(keys)} HAVING count(*) > 1")


def _row_sql(table, rid, field, cond, description, issue_type="INVALID_BUSINESS_VALUE", severity="HIGH",
             source=None):
    return (f"SELECT '{table}' AS dataset_name, {rid} AS record_id, '{field}' AS field_name, "
            f"'{issue_type}' AS issue_type, '{description}' AS issue_description, '{severity}' AS severity "
            f"FROM {source or table} WHERE {cond}")


_LINE_RID = "CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)"

_SALES_SQL = " UNION ALL ".join([
    _dup_sql("region", ["r_regionkey"]),
    _dup_sql("nation", ["n_nationkey"]),
    _fk_sql("nation", "CAST(n_nationkey AS VARCHAR)", "n_regionkey", "region", "r_regionkey",
            "n_regionkey does not exist in region dataset"),
    _dup_sql("customer", ["c_custkey"]),
    _row_sql("customer", "CAST(c_custkey AS VARCHAR)", "c_acctbal", "c_acctbal < 0", "c_acctbal cannot be negative"),
    _fk_sql("customer", "CAST(c_custkey AS VARCHAR)", "c_nationkey", "nation", "n_nationkey",
            "c_nationkey does not exist in nation dataset"),
    _dup_sql("supplier", ["s_suppkey"]),
    _row_sql("supplier", "CAST(s_suppkey AS VARCHAR)", "s_acctbal", "s_acctbal < 0", "s_acctbal cannot be negative"),
    _fk_sql("supplier", "CAST(s_suppkey AS VARCHAR)", "s_nationkey", "nation", "n_nationkey",
            "s_nationkey does not exist in nation dataset"),
    _dup_sql("part", ["p_partkey"]),
    _dup_sql("orders", ["o_orderkey"]),
    _fk_sql("orders", "CAST(o_orderkey AS VARCHAR)", "o_custkey", "customer", "c_custkey",
            "o_custkey does not exist in customer dataset"),
    _fk_sql("orders", "CAST(o_orderkey AS VARCHAR)", "o_orderkey", "lineitem", "l_orderkey",
            "o_orderkey has no lineitem rows"),
    _dup_sql("lineitem", ["l_orderkey", "l_linenumber"]),
    _row_sql("lineitem", _LINE_RID, "l_quantity", "l_quantity <= 0", "l_quantity must be positive"),
    _fk_sql("lineitem", _LINE_RID, "l_orderkey", "orders", "o_orderkey",
            "l_orderkey does not exist in orders dataset"),
    _fk_sql("lineitem", _LINE_RID, "l_partkey", "part", "p_partkey", "l_partkey does not exist in part dataset"),
    _fk_sql("lineitem", _LINE_RID, "l_suppkey", "supplier", "s_suppkey",
            "l_suppkey does not exist in supplier dataset"),
])

_DIRTY_Q = ("CASE WHEN l_orderkey % 10 = 0 THEN 'not_available' WHEN l_orderkey % 10 = 1 THEN NULL "
            "ELSE CAST(l_quantity AS VARCHAR) END")
_FLAG_TEXT = ("CASE o_orderkey % 6 WHEN 0 THEN ' yes' WHEN 1 THEN 'True' WHEN 2 THEN 'no ' "
              "WHEN 3 THEN 'FALSE' WHEN 4 THEN 'y' END")

_ORACLE: dict[str, str] = {
    "scan_parquet": "SELECT r_regionkey, r_name FROM region",
    "csv_schema_scan": "SELECT * FROM customer",
    "csv_infer_scan": "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_acctbal, c_mktsegment FROM customer",
    "parquet_roundtrip": "SELECT * FROM orders",
    "norm_upper_trim": "SELECT c_custkey, upper(trim('  ' || lower(c_mktsegment) || ' ')) AS mktsegment FROM customer",
    "norm_trim_only": (
        "WITH d AS (SELECT c_custkey, c_name, ' ' || lower(c_mktsegment) || '  ' AS s FROM customer) "
        "SELECT c_custkey, trim('  ' || c_name || ' ') AS name, "
        "CASE WHEN upper(trim(s)) = 'MACHINERY' THEN 'mach' ELSE trim(s) END AS segment FROM d"
    ),
    "norm_flag": (
        f"WITH d AS (SELECT o_orderkey, {_FLAG_TEXT} AS f FROM orders) SELECT o_orderkey, "
        "CASE upper(trim(f)) WHEN 'YES' THEN 'Y' WHEN 'TRUE' THEN 'Y' WHEN 'NO' THEN 'N' WHEN 'FALSE' THEN 'N' "
        "ELSE upper(trim(f)) END AS flag FROM d"
    ),
    "norm_flag_two": (
        f"WITH d AS (SELECT o_orderkey, {_FLAG_TEXT} AS f FROM orders) SELECT o_orderkey, "
        "CASE upper(trim(f)) WHEN 'TRUE' THEN 'Y' WHEN 'FALSE' THEN 'N' ELSE upper(trim(f)) END AS flag FROM d"
    ),
    "norm_value_map": (
        "SELECT o_orderkey, CASE upper(trim(o_orderpriority)) WHEN '1-URGENT' THEN 'SEVERE' "
        "ELSE upper(trim(o_orderpriority)) END AS severity FROM orders"
    ),
    "parse_date_multi": (
        "WITH d AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate,'%Y-%m-%d') "
        "WHEN 1 THEN strftime(o_orderdate,'%d/%m/%Y') WHEN 2 THEN 'garbage' END AS s FROM orders) "
        "SELECT o_orderkey, CAST(CASE WHEN regexp_full_match(s,'\\d{4}-\\d{2}-\\d{2}') THEN try_strptime(s,'%Y-%m-%d') "
        "WHEN regexp_full_match(s,'\\d{2}/\\d{2}/\\d{4}') THEN try_strptime(s,'%d/%m/%Y') END AS DATE) AS order_date FROM d"
    ),
    "cast_double_issue": (
        f"WITH d AS (SELECT l_orderkey, l_linenumber, {_DIRTY_Q} AS v FROM lineitem) "
        "SELECT l_orderkey, l_linenumber, try_cast(v AS DOUBLE) AS v_numeric, "
        "(v IS NOT NULL AND try_cast(v AS DOUBLE) IS NULL) AS is_invalid FROM d"
    ),
    "cast_int_trunc": "SELECT c_custkey, CAST(trunc(c_acctbal) AS INTEGER) AS acctbal_int FROM customer",
    "range_flag": (
        "SELECT l_orderkey, l_linenumber, l_quantity, "
        "CASE WHEN l_quantity < 5 OR l_quantity > 45 THEN 'Y' ELSE 'N' END AS abnormal_flag FROM lineitem"
    ),
    "conditional_flag": (
        "SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 10 > 3 THEN 'Y' ELSE 'N' END "
        "AS serious_event FROM orders"
    ),
    "round_half_even": (
        "SELECT l_orderkey, l_linenumber, CAST(round_even(CAST(CAST(l_orderkey * 37 + l_linenumber AS VARCHAR) || '.' "
        "|| lpad(CAST((l_orderkey * 7 + l_linenumber) % 1000 AS VARCHAR), 3, '0') AS DECIMAL(18,3)), 2) AS DOUBLE) "
        "AS rounded FROM lineitem"
    ),
    "id_format": "SELECT c_custkey, printf('P%04d', c_custkey) AS patient_id FROM customer",
    "date_offset_format": (
        "SELECT o_orderkey, strftime(o_orderdate + to_days(CAST(o_orderkey % 21 - 5 AS INTEGER)), '%Y-%m-%d') "
        "AS visit_date FROM orders"
    ),
    "filter_prefix": "SELECT p_partkey FROM part WHERE p_brand LIKE 'Brand#1%'",
    "issue_missing": (
        "SELECT 'documents' AS dataset_name, CAST(d.doc_id AS VARCHAR) AS record_id, 'quality' AS field_name, "
        "'MISSING_VALUE' AS issue_type, 'Missing quality value' AS issue_description, 'MEDIUM' AS severity "
        "FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality IS NULL"
    ),
    "issue_invalid_cast": (
        f"WITH d AS (SELECT l_orderkey, l_linenumber, {_DIRTY_Q} AS v FROM lineitem) "
        f"SELECT 'lineitem' AS dataset_name, {_LINE_RID} AS record_id, 'l_quantity' AS field_name, "
        "'INVALID_NUMERIC_VALUE' AS issue_type, 'l_quantity could not be converted to double' AS issue_description, "
        "'HIGH' AS severity FROM d WHERE v IS NOT NULL AND try_cast(v AS DOUBLE) IS NULL"
    ),
    "issue_duplicate": (
        f"SELECT 'lineitem' AS dataset_name, {_LINE_RID} AS record_id, 'l_orderkey|l_linenumber' AS field_name, "
        "'DUPLICATE_RECORD' AS issue_type, 'Duplicate key detected' AS issue_description, 'HIGH' AS severity "
        "FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"
    ),
    "issue_business_range": _row_sql("customer", "CAST(c_custkey AS VARCHAR)", "c_acctbal", "c_acctbal < 0",
                                     "c_acctbal cannot be negative"),
    "issue_fused_rules": (
        "WITH d AS (SELECT l_orderkey, l_linenumber, l_discount, "
        "CASE WHEN l_orderkey % 10 = 0 THEN 'n/a' ELSE CAST(l_tax AS VARCHAR) END AS t, "
        "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate END AS s FROM lineitem) "
        + " UNION ALL ".join([
            _row_sql("lineitem", _LINE_RID, "l_shipdate", "s IS NULL", "Missing l_shipdate value",
                     "MISSING_VALUE", "MEDIUM", source="d"),
            _row_sql("lineitem", _LINE_RID, "l_tax_text", "t IS NOT NULL AND try_cast(t AS DOUBLE) IS NULL",
                     "l_tax_text could not be converted to double", "INVALID_NUMERIC_VALUE", source="d"),
            _row_sql("lineitem", _LINE_RID, "l_discount", "l_discount >= 0.09", "l_discount above limit",
                     source="d"),
        ])
    ),
    "issue_foreign_key": _fk_sql("orders", "CAST(o_orderkey AS VARCHAR)", "o_orderkey", "lineitem", "l_orderkey",
                                 "o_orderkey does not exist in lineitem dataset"),
    "issue_foreign_key_keys": _fk_sql("orders", "CAST(o_orderkey AS VARCHAR)", "o_orderkey", "lineitem",
                                      "l_orderkey", "o_orderkey does not exist in lineitem dataset"),
    "issue_foreign_key_direct": _fk_sql("orders", "CAST(o_orderkey AS VARCHAR)", "o_orderkey", "lineitem",
                                        "l_orderkey", "o_orderkey does not exist in lineitem dataset"),
    "fk_null_is_orphan": (
        "WITH c AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN -1 "
        "ELSE o_custkey END AS fk FROM orders) "
        "SELECT o_orderkey FROM c WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = fk)"
    ),
    "fk_composite": (
        "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem a WHERE NOT EXISTS "
        "(SELECT 1 FROM lineitem b WHERE b.l_orderkey = a.l_orderkey AND b.l_linenumber = a.l_linenumber + 1)"
    ),
    "issue_union_summary": (
        "WITH i AS (SELECT 'customer' AS dataset_name, 'INVALID_BUSINESS_VALUE' AS issue_type, 'HIGH' AS severity "
        "FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'supplier', 'INVALID_BUSINESS_VALUE', 'HIGH' FROM supplier "
        "WHERE s_acctbal < 0 UNION ALL SELECT 'orders', 'INVALID_FOREIGN_KEY', 'HIGH' FROM orders WHERE NOT EXISTS "
        "(SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)) "
        "SELECT dataset_name, issue_type, severity, count(*) AS issue_count FROM i GROUP BY ALL"
    ),
    "issue_summary": (
        f"SELECT issue_type, severity, count(*) AS issue_count FROM ({_SALES_SQL}) GROUP BY issue_type, severity"
    ),
    "sales_issues": _SALES_SQL,
    "dedup_keep_first": "SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text",
    "dedup_rows": (
        "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
        "ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, "
        "l_linestatus, l_shipdate) AS rn FROM lineitem) WHERE rn = 1"
    ),
    "distinct_values": "SELECT DISTINCT p_type FROM part",
    "distinct_nonnull_keys": "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL",
    "profile_table": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS row_count, count(*) - count({c}) AS null_count, "
        f"count(DISTINCT {c}) AS distinct_count FROM orders"
        for c, t in [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                     ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]
    ),
    "preview": (
        "SELECT * FROM lineitem ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, "
        "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate LIMIT 10"
    ),
    "lookup_first": "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
    "lookup_constant": (
        "WITH ref(p_type, low, high) AS (VALUES ('ECONOMY',5,20), ('PROMO',10,40), ('SMALL',1,30)) "
        "SELECT p_partkey, low, high FROM part LEFT JOIN ref USING (p_type)"
    ),
    "inject_defects": (
        "SELECT c_custkey, CASE WHEN c_custkey IN (5) THEN 'Female' WHEN c_custkey IN (12) THEN 'Male' "
        "ELSE c_mktsegment END AS c_mktsegment FROM customer UNION ALL "
        "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey = 10"
    ),
    "norm_value_map_many": (
        "WITH d AS (SELECT p_partkey, upper(trim(CASE WHEN p_partkey % 9 = 0 THEN ' other ' || p_brand ELSE lower(p_brand) END)) "
        "AS b FROM part) SELECT p_partkey, CASE WHEN b IN ('BRAND#5', 'BRAND#10', 'BRAND#15', 'BRAND#20', 'BRAND#25') THEN NULL "
        "WHEN regexp_full_match(b, 'BRAND#([1-9]|1[0-9]|2[0-5])') THEN 'B' || substr(b, 7) ELSE b END AS brand FROM d"
    ),
    "parse_date_optional": (
        "SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderdate AS DATE) END AS order_date FROM orders"
    ),
    "record_id_composite": (
        "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '\\N' WHEN 1 THEN 'a\\|b' WHEN 2 THEN 'a\\\\b' ELSE o_orderstatus END "
        "|| '|' || CAST(o_custkey AS VARCHAR) AS record_id FROM orders"
    ),
    "fk_mixed_types": (
        "WITH c AS (SELECT o_orderkey, CASE o_orderkey % 10 WHEN 0 THEN 'abc' WHEN 1 THEN NULL WHEN 2 THEN '-5' "
        "ELSE CAST(o_custkey AS VARCHAR) END AS fk FROM orders) SELECT o_orderkey, fk FROM c "
        "WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = TRY_CAST(fk AS BIGINT))"
    ),
    "fk_large_parent": (
        "WITH c AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 7 WHEN o_orderkey % 7 = 1 THEN -1 "
        "WHEN o_orderkey % 11 = 2 THEN -o_orderkey WHEN o_orderkey % 13 = 3 THEN NULL ELSE o_custkey END AS fk FROM orders) "
        "SELECT o_orderkey, fk FROM c WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = fk)"
    ),
    "lookup_first_large": (
        "WITH c AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 7 WHEN o_orderkey % 7 = 1 THEN -1 "
        "WHEN o_orderkey % 11 = 2 THEN -o_orderkey WHEN o_orderkey % 13 = 3 THEN NULL ELSE o_custkey END AS fk FROM orders) "
        "SELECT o_orderkey, fk, c_name FROM c LEFT JOIN customer ON c_custkey = fk"
    ),
    "duplicate_wide_keys": "SELECT text, lang, count(*) AS count FROM documents GROUP BY text, lang HAVING count(*) > 1",
    "fk_hot_beyond_bounds": (
        "WITH c AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN -(o_custkey % 5) - 1 "
        "WHEN o_orderkey % 11 = 2 THEN -o_orderkey WHEN o_orderkey % 13 = 3 THEN NULL ELSE o_custkey END AS fk FROM orders) "
        "SELECT o_orderkey, fk FROM c WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = fk)"
    ),
    "lookup_hot_beyond_bounds": (
        "WITH c AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 7 - 2 "
        "WHEN o_orderkey % 13 = 3 THEN NULL ELSE o_custkey END AS fk FROM orders) "
        "SELECT o_orderkey, fk, c_name FROM c LEFT JOIN customer ON c_custkey = fk"
    ),
    "sample_parent_large": (
        "WITH p AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS i, o_orderkey, o_orderstatus FROM orders), "
        "l AS (SELECT l_orderkey, l_linenumber, l_orderkey * 10 + l_linenumber AS k FROM lineitem), "
        "c AS (SELECT *, (CASE WHEN k % 3 = 0 THEN k % 4 WHEN k % 5 = 0 THEN NULL WHEN k % 7 = 0 THEN -1 ELSE k END) "
        "% (SELECT count(*) FROM orders) AS pick FROM l) "
        "SELECT l_orderkey, l_linenumber, o_orderkey, o_orderstatus FROM c LEFT JOIN p ON i = pick"
    ),
    "sample_parent_empty": "SELECT c_custkey, CAST(NULL AS INTEGER) AS n_nationkey, CAST(NULL AS VARCHAR) AS n_name FROM customer",
    "profile_distinct_all": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS row_count, count(*) - count({c}) AS null_count, "
        f"count(DISTINCT {c}) AS distinct_count FROM {table}"
        for table, columns in {
            "lineitem": [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
                         ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
                         ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")],
            "customer": [("c_custkey", "bigint"), ("c_acctbal", "double"), ("c_name", "string")],
            "documents": [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string")],
        }.items() for c, t in columns
    ),
    "dedup_wide_key": "SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text",
    "duplicate_key_counts": (
        "SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"
    ),
    "profile_counts": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS row_count, count(*) - count({c}) AS null_count, "
        f"CAST(NULL AS BIGINT) AS distinct_count FROM lineitem"
        for c, t in [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
                     ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
                     ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")]
    ),
    "sample_parent_null": (
        "WITH p AS (SELECT row_number() OVER (ORDER BY n_nationkey) - 1 AS i, n_name FROM nation) "
        "SELECT c_custkey, n_name FROM customer LEFT JOIN p ON c_custkey % 4 <> 0 AND i = c_custkey % 25"
    ),
    "sample_parent": (
        "WITH p AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS i, o_orderkey, o_orderstatus FROM orders) "
        "SELECT c_custkey, o_orderkey, o_orderstatus FROM customer JOIN p "
        "ON i = (c_custkey * 7919 + 42) % (SELECT count(*) FROM orders)"
    ),
}


_ORACLE["dedup_duplicated_only"] = _ORACLE["dedup_many_recurring"] = _ORACLE["dedup_rows"]


def _sql_list(values):
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _sql_date(col, formats):
    """Gated multi-format parse in DuckDB, as ``parse_date`` does in Spark."""
    shapes = {"yyyy-MM-dd": (r"\d{4}-\d{2}-\d{2}", "%Y-%m-%d"), "dd/MM/yyyy": (r"\d{2}/\d{2}/\d{4}", "%d/%m/%Y"),
              "yyyy/MM/dd": (r"\d{4}/\d{2}/\d{2}", "%Y/%m/%d"), "MM-dd-yyyy": (r"\d{2}-\d{2}-\d{4}", "%m-%d-%Y"),
              "yyyy.MM.dd": (r"\d{4}\.\d{2}\.\d{2}", "%Y.%m.%d")}
    parts = [f"CASE WHEN regexp_full_match({col}, '{shapes[f][0]}') THEN try_strptime({col}, '{shapes[f][1]}') END"
             for f in formats]
    return f"CAST(COALESCE({', '.join(parts)}) AS DATE)"


def _sql_flag(col, synonyms):
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in synonyms.items())
    return f"CASE upper(trim({col})) {whens} ELSE upper(trim({col})) END"


def _clinical_sql_ctes():
    sites = "['SITE_A', 'SITE_B', 'SITE_C', 'SITE_D']"
    four = {"YES": "Y", "TRUE": "Y", "NO": "N", "FALSE": "N"}
    two = {"TRUE": "Y", "FALSE": "N"}
    visit_formats = ("yyyy-MM-dd", "yyyy/MM/dd")
    iso = "'%Y-%m-%d'"
    return f"""
pl AS (SELECT c_custkey AS k, c_nationkey AS n, {sites}[c_nationkey % 4 + 1] AS site,
              DATE '2025-01-01' + CAST(c_custkey % 365 AS INTEGER) AS enrolled FROM customer),
pbase AS (SELECT printf('P%04d', k + 1) AS patient_id,
  CASE WHEN k % 40 = 0 THEN ' ' || lower(site) || ' ' ELSE site END AS site_id,
  CASE k % 7 WHEN 0 THEN 'Female' WHEN 1 THEN 'male ' WHEN 2 THEN 'F' ELSE 'M' END AS sex,
  CASE WHEN k % 50 = 20 THEN NULL ELSE CAST(1945 + k % 61 AS DOUBLE) END AS birth_year,
  CASE WHEN k % 30 = 0 THEN strftime(enrolled, '%d/%m/%Y') WHEN k % 30 = 1 THEN 'not a date'
       ELSE strftime(enrolled, {iso}) END AS enrollment_date,
  ['PLACEBO', 'DRUG_A', 'DRUG_B'][k % 3 + 1] AS treatment_arm,
  ['ACTIVE', 'COMPLETED', 'WITHDRAWN'][n % 3 + 1] AS status, k % 97 = 10 AS copy FROM pl),
patients AS (SELECT * EXCLUDE (copy) FROM pbase UNION ALL SELECT * EXCLUDE (copy) FROM pbase WHERE copy),
vl AS (SELECT o_orderkey AS o, o_custkey AS c, CAST(o_orderdate AS DATE) AS sd,
              CAST(o_orderdate AS DATE) + CAST(o_orderkey % 21 - 5 AS INTEGER) AS vd,
              {sites}[o_custkey % 4 + 1] AS site FROM orders),
vbase AS (SELECT printf('V%05d', o + 1) AS visit_id,
  CASE WHEN o % 101 = 7 THEN 'P_BAD' ELSE printf('P%04d', c + 1) END AS patient_id,
  CASE WHEN o % 33 = 0 THEN lower(site) ELSE site END AS site_id,
  ['SCREENING', 'BASELINE', 'FOLLOW_UP', 'FINAL'][o % 4 + 1] AS visit_type,
  CASE WHEN o % 25 = 3 THEN strftime(sd, '%Y/%m/%d') ELSE strftime(sd, {iso}) END AS scheduled_date,
  CASE WHEN o % 89 = 15 THEN '' WHEN o % 89 = 16 THEN strftime(vd, '%Y/%m/%d') ELSE strftime(vd, {iso}) END
    AS visit_date,
  CASE o % 6 WHEN 0 THEN 'YES' WHEN 1 THEN 'no' WHEN 2 THEN 'True' WHEN 3 THEN 'N' ELSE 'Y' END AS completed,
  CASE o % 5 WHEN 0 THEN 'FALSE' WHEN 1 THEN ' y' ELSE 'N' END AS protocol_deviation,
  o % 113 = 22 AS copy FROM vl),
visits AS (SELECT * EXCLUDE (copy) FROM vbase UNION ALL SELECT * EXCLUDE (copy) FROM vbase WHERE copy),
el AS (SELECT event_id AS e, user_id AS u, CAST(ts AS DATE) AS ed FROM events),
ebase AS (SELECT printf('AE%05d', e + 1) AS event_id,
  CASE WHEN e % 97 = 9 THEN 'P_UNKNOWN' ELSE printf('P%04d', u + 1) END AS patient_id,
  {sites}[u % 4 + 1] AS site_id,
  CASE WHEN e % 20 = 14 THEN strftime(ed, '%m-%d-%Y') ELSE strftime(ed, {iso}) END AS event_date,
  CASE e % 5 WHEN 0 THEN 'high' WHEN 1 THEN 'MILD' WHEN 2 THEN 'moderate ' ELSE 'SEVERE' END AS severity,
  ['NOT_RELATED', 'POSSIBLY_RELATED', 'RELATED'][e % 3 + 1] AS relationship_to_treatment,
  ['RESOLVED', 'ONGOING', 'RECOVERING'][e % 7 % 3 + 1] AS outcome,
  CASE e % 4 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'false' ELSE 'N' END AS serious_event,
  e % 211 = 12 AS copy FROM el),
adverse_events AS (SELECT * EXCLUDE (copy) FROM ebase UNION ALL SELECT * EXCLUDE (copy) FROM ebase WHERE copy),
lab_results AS (SELECT 'LR' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS result_id,
  printf('P%04d', l_suppkey + 1) AS patient_id,
  CASE WHEN l_orderkey % 97 = 33 THEN 'V_BAD' ELSE printf('V%05d', l_orderkey + 1) END AS visit_id,
  {_sql_list(LAB_TEST_SPELLINGS)}[l_linenumber % 5 + 1] AS test_name,
  CASE WHEN l_orderkey % 10 = 0 THEN 'not_available' WHEN l_orderkey % 10 = 1 THEN NULL
       ELSE CAST(l_quantity AS VARCHAR) END AS test_value,
  CASE WHEN l_suppkey % 9 = 0 THEN ' IU/L ' ELSE 'U/L' END AS unit,
  CAST(7.0 AS DOUBLE) AS reference_range_low, CAST(56.0 AS DOUBLE) AS reference_range_high,
  CASE l_partkey % 4 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'false' WHEN 2 THEN 'Y' ELSE 'N' END AS abnormal_flag
  FROM lineitem),
medications AS (SELECT printf('M%06d', l_orderkey) || '-' || CAST(l_linenumber AS VARCHAR) AS medication_id,
  printf('P%04d', l_suppkey + 1) AS patient_id,
  CASE WHEN l_partkey % 53 = 36 THEN 'V_BAD' ELSE printf('V%05d', l_orderkey + 1) END AS visit_id,
  {_sql_list(DRUG_SPELLINGS)}[l_suppkey % 3 + 1] AS drug_name,
  CAST(l_quantity AS INTEGER) - 5 AS dose,
  CASE l_linenumber % 3 WHEN 0 THEN 'milligrams' WHEN 1 THEN ' mg/day' ELSE 'mg' END AS dose_unit,
  CASE WHEN l_orderkey % 12 = 5 THEN strftime(CAST(l_shipdate AS DATE), '%Y.%m.%d')
       WHEN l_orderkey % 12 = 6 THEN '2025-02-30' ELSE strftime(CAST(l_shipdate AS DATE), {iso}) END
    AS administration_date,
  {_sql_list(ROUTE_SPELLINGS)}[l_partkey % 3 + 1] AS route FROM lineitem),
c_patients AS (SELECT patient_id, upper(trim(site_id)) AS site_id,
  CASE upper(trim(sex)) WHEN 'FEMALE' THEN 'F' WHEN 'MALE' THEN 'M' ELSE upper(trim(sex)) END AS sex,
  TRY_CAST(birth_year AS INTEGER) AS birth_year,
  {_sql_date("enrollment_date", ("yyyy-MM-dd", "dd/MM/yyyy"))} AS enrollment_date, treatment_arm, status FROM patients),
c_lab_results AS (SELECT result_id, patient_id, visit_id, upper(trim(test_name)) AS test_name, test_value, trim(unit) AS unit,
  reference_range_low, reference_range_high, {_sql_flag("abnormal_flag", two)} AS abnormal_flag,
  TRY_CAST(test_value AS DOUBLE) AS test_value_numeric FROM lab_results),
c_adverse_events AS (SELECT event_id, patient_id, upper(trim(site_id)) AS site_id,
  {_sql_date("event_date", ("yyyy-MM-dd", "MM-dd-yyyy"))} AS event_date,
  CASE upper(trim(severity)) WHEN 'HIGH' THEN 'SEVERE' ELSE upper(trim(severity)) END AS severity,
  upper(trim(relationship_to_treatment)) AS relationship_to_treatment, upper(trim(outcome)) AS outcome,
  {_sql_flag("serious_event", two)} AS serious_event FROM adverse_events),
c_visits AS (SELECT visit_id, patient_id, upper(trim(site_id)) AS site_id, upper(trim(visit_type)) AS visit_type,
  {_sql_date("scheduled_date", visit_formats)} AS scheduled_date,
  {_sql_date("visit_date", visit_formats)} AS visit_date,
  {_sql_flag("completed", four)} AS completed,
  {_sql_flag("protocol_deviation", four)} AS protocol_deviation FROM visits),
c_medications AS (SELECT medication_id, patient_id, visit_id, trim(drug_name) AS drug_name, dose,
  CASE WHEN upper(trim(dose_unit)) = 'MILLIGRAMS' THEN 'mg' ELSE trim(dose_unit) END AS dose_unit,
  {_sql_date("administration_date", ("yyyy-MM-dd", "yyyy.MM.dd"))} AS administration_date,
  upper(trim(route)) AS route FROM medications)
"""


def _sql_dedup(table, key, rest):
    order = ", ".join(f"{c} NULLS FIRST" for c in rest)
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn "
            f"FROM {table}) WHERE rn = 1")


def _clinical_issue_sql(layered):
    """Issues of the clinical specs. Check mode compares every child row;
    the layered run compares the deduplicated (cleaned-layer) children."""
    med_rest = ["patient_id", "visit_id", "drug_name", "dose", "dose_unit", "administration_date", "route"]
    child = {"visits": "visits", "adverse_events": "adverse_events", "medications": "medications"}
    extra = ""
    if layered:
        # Copies of a record are identical, so DISTINCT is the dedup for these two.
        child = {"visits": "(SELECT DISTINCT * FROM visits)", "adverse_events": "(SELECT DISTINCT * FROM adverse_events)",
                 "medications": "d_medications"}
        extra = f", d_medications AS ({_sql_dedup('c_medications', 'medication_id', med_rest)})"
    pat = "patient_id does not exist in patients dataset"
    vis = "visit_id does not exist in visits dataset"
    issues = " UNION ALL ".join([
        _dup_sql("patients", ["patient_id"]),
        _row_sql("patients", "patient_id", "birth_year", "birth_year IS NULL", "Missing birth_year value",
                 "MISSING_VALUE", "MEDIUM", source="c_patients"),
        _dup_sql("visits", ["visit_id"]),
        _row_sql("visits", "visit_id", "visit_date", "visit_date IS NULL", "Missing visit_date value",
                 "MISSING_VALUE", "MEDIUM", source="c_visits"),
        _fk_sql("visits", "visit_id", "patient_id", "patients p", "p.patient_id", pat, child["visits"]),
        _dup_sql("adverse_events", ["event_id"]),
        _fk_sql("adverse_events", "event_id", "patient_id", "patients p", "p.patient_id", pat,
                child["adverse_events"]),
        _row_sql("lab_results", "result_id", "test_value",
                 "test_value IS NOT NULL AND TRY_CAST(test_value AS DOUBLE) IS NULL",
                 "test_value could not be converted to double", "INVALID_NUMERIC_VALUE"),
        _fk_sql("lab_results", "result_id", "visit_id", "visits v", "v.visit_id", vis),
        _dup_sql("medications", ["medication_id"]),
        _row_sql("medications", "medication_id", "dose", "dose < 0", "Dose cannot be negative"),
        _fk_sql("medications", "medication_id", "visit_id", "visits v", "v.visit_id", vis, child["medications"]),
    ])
    return f"WITH {_clinical_sql_ctes()}{extra} {issues}"


def _clinical_oracles():
    ctes = "WITH " + _clinical_sql_ctes()
    visit_rest = ["patient_id", "site_id", "visit_type", "scheduled_date", "visit_date", "completed",
                  "protocol_deviation"]
    med_rest = ["patient_id", "visit_id", "drug_name", "dose", "dose_unit", "administration_date", "route"]
    profile_cols = [("patient_id", "string"), ("site_id", "string"), ("sex", "string"), ("birth_year", "double"),
                    ("enrollment_date", "string"), ("treatment_arm", "string"), ("status", "string")]
    profile = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS row_count, "
        f"count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS distinct_count FROM patients"
        for c, t in profile_cols)
    check = _clinical_issue_sql(layered=False)
    cleaned_visits = _sql_dedup('c_visits', 'visit_id', visit_rest)
    formats = {("patients", "enrollment_date"): ("yyyy-MM-dd", "dd/MM/yyyy"),
               ("visits", "scheduled_date"): ("yyyy-MM-dd", "yyyy/MM/dd"),
               ("visits", "visit_date"): ("yyyy-MM-dd", "yyyy/MM/dd"),
               ("adverse_events", "event_date"): ("yyyy-MM-dd", "MM-dd-yyyy"),
               ("medications", "administration_date"): ("yyyy-MM-dd", "yyyy.MM.dd")}
    keys = {"patients": "patient_id", "visits": "visit_id", "adverse_events": "event_id",
            "medications": "medication_id"}
    unparsed = " UNION ALL ".join(
        _row_sql(t, keys[t], c, f"trim({c}) <> '' AND {_sql_date(c, formats[(t, c)])} IS NULL",
                 f"{c} could not be parsed", "INVALID_FORMAT_VALUE")
        for t, cols in UNPARSED_DATE_COLUMNS.items() for c in cols)
    # Landing CSV turns empty text into null: count it as null here too.
    landing_profile = " UNION ALL ".join(
        f"SELECT '{t}' AS dataset_name, '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS data_type, "
        f"count(*) AS row_count, count(*) - count(NULLIF(CAST({f.name} AS VARCHAR), '')) AS null_count, "
        f"count(DISTINCT NULLIF(CAST({f.name} AS VARCHAR), '')) AS distinct_count FROM {t}"
        for t, spec in CLINICAL_SPECS.items() for f in spec.schema.fields)
    patient_rest = ["site_id", "sex", "birth_year", "enrollment_date", "treatment_arm", "status"]
    event_rest = ["patient_id", "site_id", "event_date", "severity", "relationship_to_treatment", "outcome", "serious_event"]
    # Copies are whole rows, so before and after dedup differ by the repeated keys.
    counts = " UNION ALL ".join(
        f"SELECT '{t}' AS dataset_name, count(*) AS landing_rows, count(*) AS before_dedup, {after} AS after_dedup FROM {t}"
        for t, after in [("patients", "count(DISTINCT patient_id)"), ("visits", "count(DISTINCT visit_id)"),
                         ("adverse_events", "count(DISTINCT event_id)"), ("lab_results", "count(*)"),
                         ("medications", "count(DISTINCT medication_id)")])
    stream_rules = " UNION ALL ".join([
        _row_sql("medications", "medication_id", "dose", "dose < 0", "Dose cannot be negative"),
        _row_sql("medications", "medication_id", "administration_date",
                 f"trim(administration_date) <> '' AND {_sql_date('administration_date', ('yyyy-MM-dd', 'yyyy.MM.dd'))} IS NULL",
                 "administration_date could not be parsed", "INVALID_FORMAT_VALUE")])
    return {
        "clinical_cleaned_patients": f"{ctes} {_sql_dedup('c_patients', 'patient_id', patient_rest)}",
        "clinical_cleaned_lab_results": f"{ctes} SELECT * FROM c_lab_results",
        "clinical_cleaned_adverse_events": f"{ctes} {_sql_dedup('c_adverse_events', 'event_id', event_rest)}",
        "clinical_row_counts": f"{ctes} {counts}",
        "clinical_stream_unparsed": f"{ctes} {stream_rules}",
        "clinical_stream_issues": (
            f"{ctes} " + _row_sql("medications", "medication_id", "dose", "dose < 0", "Dose cannot be negative")),
        "clinical_landing_profile_derived": f"{ctes} {landing_profile}",
        "clinical_unparsed_dates": f"{ctes} {unparsed}",
        "clinical_patients_profile": f"{ctes} {profile}",
        "clinical_issue_summary": (
            f"SELECT dataset_name, issue_type, severity, count(*) AS issue_count FROM ({check}) "
            "GROUP BY dataset_name, issue_type, severity"),
        "clinical_visits_preview": f"{ctes} SELECT * FROM ({cleaned_visits}) ORDER BY visit_id LIMIT 10",
        "clinical_check_issues": check,
        "clinical_layers_issues": _clinical_issue_sql(layered=True),
        "clinical_issues_partitioned": _clinical_issue_sql(layered=True),
        "clinical_cleaned_visits": f"{ctes} {_sql_dedup('c_visits', 'visit_id', visit_rest)}",
        "clinical_cleaned_medications": f"{ctes} {_sql_dedup('c_medications', 'medication_id', med_rest)}",
    }

def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query; only training-data queries may have none."""
    return {**_ORACLE, **_clinical_oracles(), **_training_data()[1]}
