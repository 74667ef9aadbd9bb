"""Foreign-key (referential integrity) checks: child rows with no parent.

Semantics: the child column(s) are compared for equality with the parent key;
a child row whose key is null matches nothing and is an orphan (like
``NOT EXISTS``, unlike ``NOT IN``); duplicate parents never multiply rows.

Three plans. Rows with a null key are orphans by definition: in plans that
shuffle the child they are split off with a filter first, so the null "key"
cannot pile up in one partition; a map-only join takes them as they come.

``strategy="auto"`` (default) is skew-proof by construction, without relying
on AQE. The parent's rows are counted first (from Parquet footers when the
parent is a plain scan) and its key's bytes measured. Up to
``max_broadcast_keys`` rows and ``max_broadcast_bytes``, its key column is
broadcast as it is (the measure proves the bound) and the child is anti-joined
in a map-only scan: no shuffle, no checkpoint, and no task holds more than its
own input split. A larger parent has its distinct keys computed once (map-side
partial aggregation, so a hot parent key is one row per map task),
checkpointed and measured; if they fit the bounds they are broadcast the same
way, else the ``keys`` plan below runs with them.

``strategy="keys"``: two phases, for a child and a parent that are both huge.
Child keys are counted (map-side partial aggregation, so a hot key is one row
per map task) and anti-joined with the distinct parent keys: only distinct
keys cross the shuffle, on both sides. The missing keys, with their child row
counts, are checkpointed (computed once, lineage cut) and counted. Up to
``max_broadcast_keys`` of them are broadcast and the child is semi-joined in a
map-only scan. A larger set is joined by ``skew.join_unique``: the hottest
missing keys, as many as fit the bounds, are matched map-only; other keys with
more than ``hot_key_rows`` child rows are salted over several buckets, however
many they are; the rest go through a plain shuffled semi-join. No task holds
more than about ``hot_key_rows`` rows of one key.

``strategy="direct"``: the plain one-job ``left_anti`` join on the parent's
key column, as written by hand; Spark and AQE pick the physical join. It runs
no action while the plan is built, but a hot child key lands in one task when
the parent is too large to broadcast (``tools/skew_report.py`` measures it).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sluice.functions.columns import ColumnOrName, key_text
from sluice.operators import issues as I
from sluice.operators.rules import RowRule
from sluice.operators.skew import join_unique, key_size
from sluice.sources.scratch import materialize

# Keys per broadcast join, and bytes of their values: both bound a set that is
# broadcast, or all sets of one fused check together.
DEFAULT_MAX_BROADCAST_KEYS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20
# A key with more child rows than this is "hot": about what one task should
# hold of a single key.
DEFAULT_HOT_KEY_ROWS = 1_000_000


def _names(x: str | Sequence[str] | None) -> list[str] | None:
    if x is None:
        return None
    return [x] if isinstance(x, str) else list(x)


def orphans(
    child: DataFrame,
    parent: DataFrame,
    foreign_key: str | Sequence[str],
    parent_key: str | Sequence[str] | None = None,
    null_is_orphan: bool = True,
    strategy: str = "auto",
    max_broadcast_keys: int = DEFAULT_MAX_BROADCAST_KEYS,
    hot_key_rows: int = DEFAULT_HOT_KEY_ROWS,
    parent_keys_ready: bool = False,
    parent_key_size: tuple[int, int] | None = None,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Child rows whose foreign key has no match in ``parent``.

    Text on one side and another type on the other compare as that type: text
    that is no such value matches nothing, so its row is an orphan and keeps
    its text.

    ``parent_keys_ready=True`` says ``parent`` is a key set from
    ``parent_key_set`` (shared by several checks against one parent) and
    ``parent_key_size`` its keys and bytes.
    """
    fks = _names(foreign_key)
    pks = _names(parent_key) or fks
    if len(fks) != len(pks):
        raise ValueError("foreign key and parent key differ in length")
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in fks])
    if strategy == "auto" and not parent_keys_ready:
        parent, parent_key_size = parent_key_set(parent, pks, max_broadcast_keys, max_broadcast_bytes)
    # Both sides take the same names and types, so the join is USING-style.
    names = [f"__fk{i}" for i in range(len(fks))]
    child_side, parent_side = _comparable(child, fks, parent, pks)
    keyed_child = child.withColumns(dict(zip(names, child_side)))
    pkeys = parent.select(*[c.alias(n) for c, n in zip(parent_side, names)])

    def without_null_keys(found: DataFrame) -> DataFrame:
        return found if null_is_orphan else found.where(~any_null)

    if strategy == "auto":
        n_keys, n_bytes = parent_key_size or key_size(pkeys, names)
        if n_keys <= max_broadcast_keys and n_bytes <= max_broadcast_bytes:
            # Null keys cannot crowd a map-only join: one scan of the child.
            return without_null_keys(keyed_child.join(F.broadcast(pkeys), on=names, how="left_anti").select(*child.columns))
    elif strategy == "direct":
        return without_null_keys(keyed_child.join(pkeys, on=names, how="left_anti").select(*child.columns))
    elif strategy == "keys":
        pkeys = pkeys if parent_keys_ready else pkeys.distinct()
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    # What has no comparable key matches nothing and never enters a shuffle.
    no_key = reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names])
    found = _missing_key_rows(keyed_child.where(~no_key), pkeys, names, max_broadcast_keys, hot_key_rows,
                              max_broadcast_bytes)
    return without_null_keys(found.unionByName(keyed_child.where(no_key)).select(*child.columns))


def _comparable(child: DataFrame, fks: list[str], parent: DataFrame, pks: list[str]) -> tuple[list[Column], list[Column]]:
    """The key columns of both sides, text cast to the other side's type where they differ."""
    left, right = [], []
    for f, p in zip(fks, pks):
        child_type, parent_type = child.schema[f].dataType, parent.schema[p].dataType
        c, q = F.col(f), F.col(p)
        if isinstance(child_type, StringType) and not isinstance(parent_type, StringType):
            c = c.try_cast(parent_type)
        elif isinstance(parent_type, StringType) and not isinstance(child_type, StringType):
            q = q.try_cast(child_type)
        left.append(c)
        right.append(q)
    return left, right


def parent_key_set(
    parent: DataFrame,
    parent_key: str | Sequence[str],
    max_broadcast_keys: int = DEFAULT_MAX_BROADCAST_KEYS,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> tuple[DataFrame, tuple[int, int]]:
    """The keys a child is checked against, and their number and bytes.

    A parent whose rows are within both bounds gives its non-null key rows as
    they are, ready to broadcast. A larger one gives its distinct non-null
    keys, computed once into a checkpoint and measured.
    """
    pks = _names(parent_key)
    not_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in pks])
    rows = parent.select(*pks).where(not_null)
    size = key_size(parent, pks)
    if size[0] <= max_broadcast_keys and size[1] <= max_broadcast_bytes:
        return rows, size
    keys = materialize(rows.distinct())
    return keys, key_size(keys, pks)


def _missing_key_rows(
    keyed: DataFrame, parent_keys: DataFrame, fks: list[str], max_broadcast_keys: int, hot_key_rows: int,
    max_broadcast_bytes: int,
) -> DataFrame:
    """Child rows whose key is not among ``parent_keys`` (already distinct)."""

    def small(df: DataFrame) -> bool:
        n, size = key_size(df, fks)
        return n <= max_broadcast_keys and size <= max_broadcast_bytes

    counts = keyed.groupBy(*fks).agg(F.count(F.lit(1)).alias("__rows"))
    missing = materialize(counts.join(parent_keys, on=fks, how="left_anti"))
    if missing.isEmpty():
        return keyed.where(F.lit(False))
    if small(missing):
        return keyed.join(F.broadcast(missing.select(*fks)), on=fks, how="left_semi")
    hot = missing.where(F.col("__rows") > hot_key_rows)
    return join_unique(keyed, missing.select(*fks), fks, "left_semi", hot, hot_key_rows, max_broadcast_keys, max_broadcast_bytes)


def foreign_key_issues(
    child: DataFrame,
    parent: DataFrame,
    foreign_key: str | Sequence[str],
    record_id: ColumnOrName | Sequence[ColumnOrName],
    dataset: str,
    description: str | None = None,
    parent_key: str | Sequence[str] | None = None,
    parent_name: str = "parent",
    null_is_orphan: bool = True,
    strategy: str = "auto",
    severity: str = I.HIGH,
    max_broadcast_keys: int = DEFAULT_MAX_BROADCAST_KEYS,
    hot_key_rows: int = DEFAULT_HOT_KEY_ROWS,
    parent_keys_ready: bool = False,
    parent_key_size: tuple[int, int] | None = None,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """INVALID_FOREIGN_KEY issues, one per orphan child row."""
    fks = _names(foreign_key)
    field = "|".join(fks)
    text = description or f"{field} does not exist in {parent_name} dataset"
    rid_cols = [record_id] if isinstance(record_id, str) or not isinstance(record_id, Sequence) else list(record_id)
    rid_names = [c for c in rid_cols if isinstance(c, str)]
    slim = child.select(*dict.fromkeys(fks + rid_names)) if len(rid_names) == len(rid_cols) else child
    found = orphans(slim, parent, fks, parent_key, null_is_orphan, strategy, max_broadcast_keys, hot_key_rows,
                    parent_keys_ready, parent_key_size, max_broadcast_bytes)
    return I.to_issues(found, dataset, rid_cols, field, I.INVALID_FOREIGN_KEY, text, severity)


def fused_foreign_key_issues(
    child: DataFrame,
    checks: Sequence[dict],
    record_id: Sequence[str],
    dataset: str,
    severity: str = I.HIGH,
    row_rules: Sequence[RowRule] = (),
) -> DataFrame:
    """Several foreign keys and row rules of one child checked in ONE scan of it.

    Each check is a dict with ``columns`` (child key columns), ``key_set``
    (parent key rows; the caller has measured that all sets together are
    within the broadcast bound), ``parent_key``, ``description`` and
    ``null_is_orphan``. Every key set is deduplicated (a shuffle of that small
    set only), flagged and broadcast; the child goes through one left join per
    check, map-only, and each row emits one issue per failed check or rule.
    """
    needed = list(dict.fromkeys([c for chk in checks for c in chk["columns"]] + list(record_id)))
    df = child if row_rules else child.select(*needed)
    df = df.withColumns({f"__rule{i}": r.predicate() for i, r in enumerate(row_rules)})
    failed = []
    for i, chk in enumerate(checks):
        fks, pks = list(chk["columns"]), _names(chk["parent_key"])
        renamed = [f"__k{i}_{j}" for j in range(len(pks))]
        child_side, parent_side = _comparable(child, fks, chk["key_set"], pks)
        keys = chk["key_set"].select(*[c.alias(r) for c, r in zip(parent_side, renamed)]).distinct()
        keys = keys.withColumn(f"__hit{i}", F.lit(True))
        cond = reduce(lambda a, b: a & b, [c == F.col(r) for c, r in zip(child_side, renamed)])
        df = df.join(F.broadcast(keys), cond, "left").drop(*renamed)
        any_null = reduce(lambda a, b: a | b, [F.col(f).isNull() for f in fks])
        miss = F.col(f"__hit{i}").isNull()
        failed.append(miss if chk.get("null_is_orphan", True) else (miss & ~any_null))
    failed += [F.coalesce(F.col(f"__rule{i}"), F.lit(False)) for i in range(len(row_rules))]
    labels = [("|".join(c["columns"]), I.INVALID_FOREIGN_KEY, c["description"], severity) for c in checks]
    labels += [(r.field, r.issue_type, r.text(), r.severity) for r in row_rules]
    broken = F.array(*[F.when(p, F.lit(i)) for i, p in enumerate(failed)])
    hits = (
        df.where(reduce(lambda a, b: a | b, failed))
        .select(key_text(list(record_id), child).alias("__rid"), F.explode(broken).alias("__rule"))
        .where(F.col("__rule").isNotNull())
    )
    idx = F.col("__rule")

    def by_check(k: int):
        expr = None
        for i, label in enumerate(labels):
            expr = F.when(idx == i, F.lit(label[k])) if expr is None else expr.when(idx == i, F.lit(label[k]))
        return expr

    return hits.select(
        F.lit(dataset).alias("dataset_name"),
        F.col("__rid").cast("string").alias("record_id"),
        by_check(0).alias("field_name"),
        by_check(1).alias("issue_type"),
        by_check(2).alias("issue_description"),
        by_check(3).alias("severity"),
    )
