"""Declarative dataset definitions: schema, key, cleaners, rules, foreign keys."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.operators import issues as I
from sluice.operators.integrity import (
    DEFAULT_MAX_BROADCAST_BYTES,
    DEFAULT_MAX_BROADCAST_KEYS,
    foreign_key_issues,
    fused_foreign_key_issues,
    parent_key_set,
)
from sluice.operators.keys import dedup
from sluice.operators.rules import RowRule, UniqueRule, UnparsedRule, row_rule_issues, unique_issues

Cleaner = Callable[[Column], Column]


@dataclass(frozen=True)
class ForeignKey:
    """``column`` of this dataset must exist as ``parent_key`` in ``parent``."""

    column: str | tuple[str, ...]
    parent: str
    parent_key: str | tuple[str, ...] | None = None
    description: str | None = None
    null_is_orphan: bool = True

    @property
    def columns(self) -> list[str]:
        return [self.column] if isinstance(self.column, str) else list(self.column)

    def text(self) -> str:
        return self.description or f"{'|'.join(self.columns)} does not exist in {self.parent} dataset"


@dataclass(frozen=True)
class DatasetSpec:
    """Everything the pipeline needs to know about one table.

    ``cleaners`` replace columns in place (each sees the uncleaned input row);
    ``derived`` add or replace columns afterwards and may read cleaned values.
    ``dedup`` keeps one row per ``key``; ``unique`` reports repeated keys.
    Row rules run on the cleaned rows BEFORE dedup.
    """

    name: str
    schema: StructType | None
    key: tuple[str, ...]
    cleaners: Mapping[str, Cleaner] = field(default_factory=dict)
    derived: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    row_rules: tuple[RowRule, ...] = ()
    dedup: bool = True
    unique: bool = True
    dedup_order: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    # Optional, off by default: cleaned columns whose present input text
    # turned null are reported (INVALID_FORMAT_VALUE) instead of staying silent.
    report_unparsed: tuple[str, ...] = ()

    def raw_columns(self) -> list[str]:
        return [f"__raw__{c}" for c in self.report_unparsed]

    def clean(self, df: DataFrame, keep_raw: bool = False) -> DataFrame:
        """Cleaned rows (no row dropped): one projection over the input.

        ``keep_raw`` also keeps the input text of ``report_unparsed`` columns
        (as ``__raw__<column>``) for the issue pass; drop ``raw_columns()``
        before writing.
        """
        out = df
        if keep_raw and self.report_unparsed:
            out = out.withColumns({f"__raw__{c}": F.col(c).cast("string") for c in self.report_unparsed})
        if self.cleaners:
            out = out.withColumns({c: f(F.col(c)) for c, f in self.cleaners.items()})
        if self.derived:
            out = out.withColumns({c: f() for c, f in self.derived.items()})
        return out

    def deduplicate(self, cleaned: DataFrame, **kw) -> DataFrame:
        return dedup(cleaned, self.key, self.dedup_order, **kw) if self.dedup else cleaned

    def unique_rule(self) -> UniqueRule:
        return UniqueRule(tuple(self.key), f"Duplicate {'|'.join(self.key)} detected")

    def row_rules_for(self, cleaned: DataFrame) -> list[RowRule]:
        """The row rules, and the unparsed-value rules whose raw text ``cleaned`` holds."""
        return [*self.row_rules, *(UnparsedRule(c, f"__raw__{c}") for c in self.report_unparsed
                                   if f"__raw__{c}" in cleaned.columns)]

    def issues(
        self, cleaned: DataFrame, duplicated: DataFrame | None = None, with_row_rules: bool = True
    ) -> DataFrame | None:
        """Issues of the row rules (unless they run elsewhere) and the unique rule over cleaned rows.

        ``duplicated`` (from ``duplicated_keys``) lets the unique rule reuse
        the dedup's key set; only null-key rows are then grouped here.
        """
        frames = []
        if self.unique and duplicated is not None:
            rule = self.unique_rule()
            any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in self.key])
            frames.append(I.to_issues(duplicated, self.name, list(self.key), rule.field,
                                      I.DUPLICATE_RECORD, rule.text(), rule.severity))
            frames.append(unique_issues(cleaned.where(any_null), self.name, rule))
        elif self.unique:
            frames.append(unique_issues(cleaned, self.name, self.unique_rule()))
        rules = self.row_rules_for(cleaned)
        if rules and with_row_rules:
            frames.append(row_rule_issues(cleaned, self.name, list(self.key), rules))
        return I.union_issues(frames) if frames else None

    def foreign_key_issues(
        self,
        child: DataFrame,
        parents: Mapping[str, DataFrame],
        specs: Mapping[str, "DatasetSpec"],
        key_cache: dict | None = None,
        row_rules: Sequence[RowRule] = (),
        **kw,
    ) -> list[DataFrame]:
        """Issues of every foreign key. ``key_cache`` shares each parent's
        distinct keys between checks (pass one dict for a whole run).
        ``row_rules`` are checked too, in the scan of the fused check if there
        is one."""
        out = []
        strategy = kw.get("strategy", "auto")
        shared = strategy != "direct"
        bound = kw.get("max_broadcast_keys", DEFAULT_MAX_BROADCAST_KEYS)
        most_bytes = kw.get("max_broadcast_bytes", DEFAULT_MAX_BROADCAST_BYTES)
        plans = []
        for fk in self.foreign_keys:
            pk = fk.parent_key or tuple(specs[fk.parent].key)
            pk = [pk] if isinstance(pk, str) else list(pk)
            parent, size = parents[fk.parent], None
            if shared:
                cache = key_cache if key_cache is not None else {}
                slot = (fk.parent, tuple(pk))
                if slot not in cache:
                    cache[slot] = parent_key_set(parent, pk, bound, most_bytes)
                parent, size = cache[slot]
            plans.append((fk, pk, parent, size))
        # Small parents, as many as fit the bounds together: one scan checks them all.
        small, keys, size = [], 0, 0
        for p in sorted((p for p in plans if strategy == "auto" and p[3] is not None), key=lambda p: p[3][1]):
            keys, size = keys + p[3][0], size + p[3][1]
            if keys <= bound and size <= most_bytes:
                small.append(p)
        if len(small) >= 2 or (small and row_rules):
            checks = [{"columns": fk.columns, "key_set": parent, "parent_key": pk, "description": fk.text(),
                       "null_is_orphan": fk.null_is_orphan} for fk, pk, parent, _ in small]
            out.append(fused_foreign_key_issues(child, checks, list(self.key), self.name,
                                                kw.get("severity", I.HIGH), row_rules))
            plans = [p for p in plans if not any(p is q for q in small)]
        elif row_rules:
            out.append(row_rule_issues(child, self.name, list(self.key), list(row_rules)))
        for fk, pk, parent, size in plans:
            out.append(
                foreign_key_issues(
                    child, parent, fk.columns, list(self.key), self.name,
                    description=fk.text(), parent_key=pk, null_is_orphan=fk.null_is_orphan,
                    parent_keys_ready=shared, parent_key_size=size, **kw,
                )
            )
        return out


def registry(specs: Sequence[DatasetSpec]) -> dict[str, DatasetSpec]:
    """Name → spec, in the given order."""
    return {s.name: s for s in specs}
