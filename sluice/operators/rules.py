"""Data-quality rules that turn offending rows into issue rows.

Row rules (missing value, failed cast, business predicate) look at one row at
a time. All row rules of a table run in ONE scan: the rows that break at
least one rule are filtered first, so the common clean row costs one OR of
predicates, and each surviving row emits one issue per broken rule. The whole
fused plan is one whole-stage-codegen span (scan, filter, explode, project).

Set rules need a shuffle: the unique-key rule groups by the key (partial
aggregation first, so a hot key collapses map-side before the exchange) and
the foreign-key rule lives in ``integrity``.

Rules never repair or drop rows; they only report.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.columns import ColumnOrName, col_of, key_text
from sluice.operators import issues as I
from sluice.operators.skew import KeyFilter
from sluice.sources.scratch import materialize


def _expr(c: ColumnOrName | None) -> Column | None:
    if c is None or isinstance(c, Column):
        return c
    # A bare name is a column; anything else is SQL text.
    return F.col(c) if c.isidentifier() else F.expr(c)


@dataclass(frozen=True)
class MissingRule:
    """MISSING_VALUE where ``column`` is null (after cleaning)."""

    column: str
    description: str | None = None
    severity: str = I.MEDIUM
    issue_type: str = I.MISSING_VALUE

    @property
    def field(self) -> str:
        return self.column

    def predicate(self) -> Column:
        return F.col(self.column).isNull()

    def text(self) -> str:
        return self.description or f"Missing {self.column} value"


@dataclass(frozen=True)
class InvalidCastRule:
    """INVALID_NUMERIC_VALUE where the source text is present but its parse is null."""

    source: str
    parsed: str
    target_type: str = "double"
    description: str | None = None
    severity: str = I.HIGH
    issue_type: str = I.INVALID_NUMERIC_VALUE

    @property
    def field(self) -> str:
        return self.source

    def predicate(self) -> Column:
        return F.col(self.source).isNotNull() & F.col(self.parsed).isNull()

    def text(self) -> str:
        return self.description or f"{self.source} could not be converted to {self.target_type}"


@dataclass(frozen=True)
class PredicateRule:
    """An issue wherever ``condition`` is true (null counts as false).

    ``condition`` is a Column or SQL text, e.g. ``"dose < 0"``.
    """

    field: str
    condition: ColumnOrName
    description: str
    severity: str = I.HIGH
    issue_type: str = I.INVALID_BUSINESS_VALUE

    def predicate(self) -> Column:
        return _expr(self.condition)

    def text(self) -> str:
        return self.description


@dataclass(frozen=True)
class UnparsedRule:
    """A cleaned column that came out null although its input text was there
    (not null, not blank). ``raw`` names the column holding the input text."""

    column: str
    raw: str
    description: str | None = None
    severity: str = I.HIGH
    issue_type: str = I.INVALID_FORMAT_VALUE

    @property
    def field(self) -> str:
        return self.column

    def predicate(self) -> Column:
        return (F.trim(F.col(self.raw)) != F.lit("")) & F.col(self.column).isNull()

    def text(self) -> str:
        return self.description or f"{self.column} could not be parsed"


RowRule = MissingRule | InvalidCastRule | PredicateRule | UnparsedRule


@dataclass(frozen=True)
class UniqueRule:
    """DUPLICATE_RECORD once per key value that occurs more than once."""

    keys: tuple[str, ...]
    description: str | None = None
    severity: str = I.HIGH

    @property
    def field(self) -> str:
        return "|".join(self.keys)

    def text(self) -> str:
        return self.description or f"Duplicate {self.field} detected"


def row_rule_issues(
    df: DataFrame,
    dataset: str,
    record_id: Sequence[ColumnOrName],
    rules: Sequence[RowRule],
) -> DataFrame:
    """Issues of all row rules in one pass over ``df``.

    A row that breaks two rules yields two issues; a duplicated bad row yields
    one issue per copy (rules run before any dedup).
    """
    if not rules:
        raise ValueError("no row rules")
    rid = key_text(list(record_id), df)
    if len(rules) == 1:
        r = rules[0]
        return df.where(r.predicate()).select(
            *I.issue_fields(dataset, rid, r.field, r.issue_type, r.text(), r.severity)
        )
    # One scan: keep rows that break any rule, emit the index of every broken
    # rule (explode stays inside whole-stage codegen), then map the index to
    # the rule's literal fields. The record id is built once per issue.
    preds = [r.predicate() for r in rules]
    broken = F.array(*[F.when(p, F.lit(i)) for i, p in enumerate(preds)])
    hits = (
        df.where(reduce(lambda a, b: a | b, preds))
        .select(rid.alias("__rid"), F.explode(broken).alias("__rule"))
        .where(F.col("__rule").isNotNull())
    )
    idx = F.col("__rule")

    def by_rule(values: list[str]) -> Column:
        expr = None
        for i, v in enumerate(values):
            expr = F.when(idx == i, F.lit(v)) if expr is None else expr.when(idx == i, F.lit(v))
        return expr

    return hits.select(
        F.lit(dataset).alias("dataset_name"),
        F.col("__rid").cast("string").alias("record_id"),
        by_rule([r.field for r in rules]).alias("field_name"),
        by_rule([r.issue_type for r in rules]).alias("issue_type"),
        by_rule([r.text() for r in rules]).alias("issue_description"),
        by_rule([r.severity for r in rules]).alias("severity"),
    )


def duplicate_keys(
    df: DataFrame, keys: Sequence[ColumnOrName], strategy: str = "plain", max_duplicate_keys: int = 2_000_000
) -> DataFrame:
    """Key values that occur more than once, with their ``count``.

    Null keys form one group. Partial aggregation runs before the shuffle, so
    a key holding a third of the table costs one row per map task.

    ``strategy="plain"`` is one aggregate and runs no action. It moves every distinct key, which
    for wide keys such as texts is most of the table. ``strategy="hashed"`` first counts
    64-bit hashes (16 bytes a row, at most) and moves only the keys whose hash recurs: past a
    broadcast of those hashes, or past a ``skew.KeyFilter`` of ``max_duplicate_keys`` words if they
    are more. Whole keys are compared either way.
    """
    cols = [col_of(k) for k in keys]
    if strategy == "hashed":
        slim = df.select(*cols, F.xxhash64(*cols).alias("__hash"))
        cols = [F.col(f"`{c}`") for c in slim.columns[:-1]]
        again = materialize(slim.groupBy("__hash").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1).select("__hash"))
        n = again.count()
        if n <= max_duplicate_keys:
            df = slim.join(F.broadcast(again), "__hash", "left_semi")
        else:
            df = KeyFilter(again, ["__hash"], n, max_duplicate_keys).mark(slim, "__again").where("__again")
    elif strategy != "plain":
        raise ValueError(f"unknown strategy {strategy!r}")
    return (
        df.groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("count"))
        .where(F.col("count") > 1)
    )


def unique_issues(df: DataFrame, dataset: str, rule: UniqueRule, strategy: str = "plain") -> DataFrame:
    """One DUPLICATE_RECORD issue per repeated key value (``strategy`` as in ``duplicate_keys``)."""
    dups = duplicate_keys(df, list(rule.keys), strategy)
    return dups.select(
        *I.issue_fields(dataset, key_text(list(rule.keys), dups), rule.field, I.DUPLICATE_RECORD, rule.text(), rule.severity)
    )


def missing_issues(df: DataFrame, dataset: str, record_id: Sequence[ColumnOrName], column: str, **kw) -> DataFrame:
    return row_rule_issues(df, dataset, record_id, [MissingRule(column, **kw)])


def invalid_cast_issues(
    df: DataFrame, dataset: str, record_id: Sequence[ColumnOrName], source: str, parsed: str, **kw
) -> DataFrame:
    return row_rule_issues(df, dataset, record_id, [InvalidCastRule(source, parsed, **kw)])


def predicate_issues(
    df: DataFrame, dataset: str, record_id: Sequence[ColumnOrName], field: str,
    condition: ColumnOrName, description: str, **kw,
) -> DataFrame:
    return row_rule_issues(df, dataset, record_id, [PredicateRule(field, condition, description, **kw)])
