"""sluice: declarative data-quality and layer promotion on Spark DataFrames."""

from sluice.functions.columns import (
    add_days,
    date_text,
    flag_when,
    format_id,
    key_text,
    map_values,
    normalize_flag,
    parse_date,
    range_flag,
    round_half_even,
    starts_with,
    to_double,
    to_int,
    trim_spaces,
    upper_trim,
)
from sluice.operators.integrity import foreign_key_issues, fused_foreign_key_issues, orphans, parent_key_set
from sluice.operators.issues import ISSUE_COLUMNS, ISSUE_SCHEMA, to_issues, union_issues
from sluice.operators.keys import (
    dedup,
    distinct_keys,
    distinct_values,
    duplicated_keys,
    lookup_constant,
    lookup_first,
)
from sluice.operators.profile import counted, issue_summary, preview, profile
from sluice.operators.rules import (
    InvalidCastRule,
    MissingRule,
    PredicateRule,
    UniqueRule,
    UnparsedRule,
    duplicate_keys,
    row_rule_issues,
    unique_issues,
)
from sluice.plans.specs import DatasetSpec, ForeignKey
from sluice.sources.io import LayerPaths, read_csv, read_parquet, write_csv, write_parquet

__all__ = [n for n in dir() if not n.startswith("_")]
