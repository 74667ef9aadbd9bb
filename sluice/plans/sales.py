"""Data-quality definitions for the sales star schema (region … lineitem)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.functions.columns import upper_trim
from sluice.operators.rules import PredicateRule
from sluice.plans.specs import DatasetSpec, ForeignKey, registry

SALES_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def _spec(name: str, key: tuple[str, ...], **kw) -> DatasetSpec:
    # Check mode: schemas come from the Parquet files, nothing is deduplicated.
    return DatasetSpec(name=name, schema=None, key=key, dedup=False, **kw)


SALES_SPECS = registry([
    _spec("region", ("r_regionkey",)),
    _spec("nation", ("n_nationkey",), foreign_keys=(ForeignKey("n_regionkey", "region"),)),
    _spec(
        "customer", ("c_custkey",),
        cleaners={"c_mktsegment": upper_trim},
        row_rules=(PredicateRule("c_acctbal", "c_acctbal < 0", "c_acctbal cannot be negative"),),
        foreign_keys=(ForeignKey("c_nationkey", "nation"),),
    ),
    _spec(
        "supplier", ("s_suppkey",),
        row_rules=(PredicateRule("s_acctbal", "s_acctbal < 0", "s_acctbal cannot be negative"),),
        foreign_keys=(ForeignKey("s_nationkey", "nation"),),
    ),
    _spec("part", ("p_partkey",), cleaners={"p_type": upper_trim}),
    _spec(
        "orders", ("o_orderkey",),
        foreign_keys=(
            ForeignKey("o_custkey", "customer"),
            ForeignKey("o_orderkey", "lineitem", parent_key="l_orderkey",
                       description="o_orderkey has no lineitem rows"),
        ),
    ),
    _spec(
        "lineitem", ("l_orderkey", "l_linenumber"),
        row_rules=(PredicateRule("l_quantity", "l_quantity <= 0", "l_quantity must be positive"),),
        foreign_keys=(
            ForeignKey("l_orderkey", "orders"),
            ForeignKey("l_partkey", "part"),
            ForeignKey("l_suppkey", "supplier"),
        ),
    ),
])


def load_sales(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in SALES_TABLES}
