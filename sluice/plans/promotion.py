"""Layer promotion: landing CSV → raw Parquet → cleaned Parquet + issue tables.

Order: landing_to_raw, then clean every dataset (independent of each other),
then the integrity check over the cleaned layer. Each step hands over through
Parquet folders, so a failed step reruns alone and no lineage spans steps.
Row counts ride on the writes as observations, not as extra scans.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluice.operators import issues as I
from sluice.operators.integrity import DEFAULT_MAX_BROADCAST_BYTES, DEFAULT_MAX_BROADCAST_KEYS, parent_key_set
from sluice.operators.keys import DEFAULT_SMALL_ROWS, dedup, duplicated_keys
from sluice.operators.profile import counted, observed_rows, profile
from sluice.plans.specs import DatasetSpec
from sluice.sources.io import LayerPaths, read_csv, read_parquet, write_parquet


@dataclass
class RunReport:
    landing_rows: dict[str, int] = field(default_factory=dict)
    cleaned_rows_before_dedup: dict[str, int] = field(default_factory=dict)
    cleaned_rows: dict[str, int] = field(default_factory=dict)


def _each(names, work: Callable[[str], object], parallel: int) -> dict[str, object]:
    """Run one job per dataset; ``parallel`` > 1 submits them from driver
    threads so that small tables share the cluster instead of queueing."""
    names = list(names)
    if parallel <= 1 or len(names) <= 1:
        return {n: work(n) for n in names}
    with ThreadPoolExecutor(max_workers=min(parallel, len(names))) as pool:
        return dict(zip(names, pool.map(work, names)))


def landing_to_raw(
    spark: SparkSession, specs: Mapping[str, DatasetSpec], layers: LayerPaths, parallel: int = 1
) -> dict[str, int]:
    """Typed CSV read of every dataset, written as raw Parquet; rows per dataset."""

    def one(name: str) -> int:
        df, obs = counted(read_csv(spark, layers.landing(name), specs[name].schema), f"landing_{name}")
        write_parquet(df, layers.raw(name))
        return observed_rows(obs)

    return _each(specs, one, parallel)


def profile_landing(
    spark: SparkSession, specs: Mapping[str, DatasetSpec], layers: LayerPaths, distinct: bool = False
) -> DataFrame:
    """Column profiles of every landing file, one DataFrame with dataset_name;
    exact distinct counts of every column only if asked for."""
    frames = [
        profile(read_csv(spark, layers.landing(name), spec.schema),
                distinct=spec.schema.names if distinct else ()).select(F.lit(name).alias("dataset_name"), "*")
        for name, spec in specs.items()
    ]
    return I.union_issues(frames)


def clean_dataset(
    spark: SparkSession, spec: DatasetSpec, layers: LayerPaths, small_rows: int = DEFAULT_SMALL_ROWS
) -> tuple[int, int]:
    """Clean, dedup and check one dataset; returns rows before and after dedup.

    Both counts are observed on the cleaned write itself (its result stage):
    the dedup aggregate carries each key's row count, so no counter sits in
    a shuffle map stage that a lost executor could make run twice.

    A table over ``small_rows`` rows (counted from Parquet footers) has its
    duplicated keys computed once, checkpointed, and shared by the dedup
    (only those keys' rows are aggregated) and the unique-key rule.
    """
    checked = spec.clean(read_parquet(spark, layers.raw(spec.name)), keep_raw=True)
    cleaned = checked.drop(*spec.raw_columns())
    duplicated = None
    if spec.key and (spec.dedup or spec.unique) and cleaned.count() > small_rows:
        duplicated = duplicated_keys(cleaned, spec.key)
    obs = Observation(f"{spec.name}_rows")
    if spec.dedup:
        kept = dedup(cleaned, spec.key, spec.dedup_order, count_col="__rows", small_rows=small_rows,
                     duplicated=duplicated)
        kept = kept.observe(obs, F.count(F.lit(1)).alias("after"),
                            F.coalesce(F.sum("__rows"), F.lit(0)).alias("before")).drop("__rows")
    else:
        kept = cleaned.observe(obs, F.count(F.lit(1)).alias("after"), F.count(F.lit(1)).alias("before"))
    write_parquet(kept, layers.cleaned(spec.name))
    issues = spec.issues(checked, duplicated[0] if duplicated is not None else None)
    write_parquet(issues if issues is not None else I.empty_issues(spark), layers.issues(spec.name))
    return int(obs.get["before"]), int(obs.get["after"])


def parent_key_cache(
    specs: Mapping[str, DatasetSpec],
    tables: Mapping[str, DataFrame],
    parallel: int = 1,
    strategy: str = "auto",
    max_broadcast_keys: int = DEFAULT_MAX_BROADCAST_KEYS,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> dict:
    """The key set of every parent that a foreign key points at, each built
    once (concurrently with ``parallel`` > 1)."""
    if strategy == "direct":
        return {}
    slots = []
    for spec in specs.values():
        for fk in spec.foreign_keys:
            pk = fk.parent_key or tuple(specs[fk.parent].key)
            slot = (fk.parent, (pk,) if isinstance(pk, str) else tuple(pk))
            if slot not in slots:
                slots.append(slot)
    return _each(slots, lambda slot: parent_key_set(tables[slot[0]], list(slot[1]), max_broadcast_keys, max_broadcast_bytes),
                 parallel)


def check_integrity(
    spark: SparkSession, specs: Mapping[str, DatasetSpec], layers: LayerPaths, parallel: int = 1, **fk_options
) -> DataFrame:
    """Foreign-key issues over the cleaned layer, written and read back."""
    cleaned = {name: read_parquet(spark, layers.cleaned(name)) for name in specs}
    frames = []
    key_cache = parent_key_cache(specs, cleaned, parallel, fk_options.get("strategy", "auto"),
                                 fk_options.get("max_broadcast_keys", DEFAULT_MAX_BROADCAST_KEYS),
                                 fk_options.get("max_broadcast_bytes", DEFAULT_MAX_BROADCAST_BYTES))
    for name, spec in specs.items():
        frames += spec.foreign_key_issues(cleaned[name], cleaned, specs, key_cache=key_cache, **fk_options)
    issues = I.union_issues(frames) if frames else I.empty_issues(spark)
    write_parquet(issues, layers.integrity_issues())
    return read_parquet(spark, layers.integrity_issues())


def all_issues(spark: SparkSession, specs: Mapping[str, DatasetSpec], layers: LayerPaths) -> DataFrame:
    """Every written issue table as one DataFrame."""
    frames = [read_parquet(spark, layers.issues(name)) for name in specs]
    frames.append(read_parquet(spark, layers.integrity_issues()))
    return I.union_issues(frames)


def run_all(
    spark: SparkSession,
    specs: Mapping[str, DatasetSpec],
    layers: LayerPaths,
    combined: bool = False,
    parallel: int = 1,
    small_rows: int = DEFAULT_SMALL_ROWS,
    **fk_options,
) -> RunReport:
    """The whole promotion for every dataset, in dependency order.

    Datasets are independent until the integrity check, so with
    ``parallel`` > 1 their jobs run concurrently. ``combined=True`` also
    writes one issue table partitioned by dataset_name.
    """
    report = RunReport()
    report.landing_rows = landing_to_raw(spark, specs, layers, parallel)
    counts = _each(specs, lambda n: clean_dataset(spark, specs[n], layers, small_rows), parallel)
    for name, (before, after) in counts.items():
        report.cleaned_rows_before_dedup[name] = before
        report.cleaned_rows[name] = after
    check_integrity(spark, specs, layers, parallel, **fk_options)
    if combined:
        write_parquet(all_issues(spark, specs, layers), layers.all_issues(), partition_by=["dataset_name"])
    return report


def table_issues(
    tables: Mapping[str, DataFrame],
    specs: Mapping[str, DatasetSpec],
    parallel: int = 1,
    **fk_options,
) -> DataFrame:
    """Check mode: every spec's rules over tables as they are, nothing written.

    Rows are cleaned (one projection) but not deduplicated; row and unique
    rules read the cleaned rows and foreign keys compare cleaned children with
    cleaned parents. Returns one issue DataFrame.
    """
    cleaned = {name: specs[name].clean(tables[name]) for name in specs}
    frames = []
    key_cache = parent_key_cache(specs, cleaned, parallel, fk_options.get("strategy", "auto"),
                                 fk_options.get("max_broadcast_keys", DEFAULT_MAX_BROADCAST_KEYS),
                                 fk_options.get("max_broadcast_bytes", DEFAULT_MAX_BROADCAST_BYTES))
    for name, spec in specs.items():
        child = spec.clean(tables[name], keep_raw=True) if spec.report_unparsed else cleaned[name]
        # Row rules share the scan of the foreign keys, where there are any.
        own = spec.issues(child, with_row_rules=not spec.foreign_keys)
        if own is not None:
            frames.append(own)
        rules = spec.row_rules_for(child) if spec.foreign_keys else ()
        frames += spec.foreign_key_issues(child, cleaned, specs, key_cache=key_cache, row_rules=rules, **fk_options)
    return I.union_issues(frames)
