"""Command line: one step of the layer promotion per call, or all of them.

    python -m sluice generate      --root DIR   # seeded clinical landing CSVs
    python -m sluice check         --root DIR   # session smoke check
    python -m sluice read-patients --root DIR   # inferred-schema read of one landing file
    python -m sluice profile       --root DIR   # column profiles of every landing file
    python -m sluice landing-to-raw --root DIR
    python -m sluice clean <dataset> --root DIR [--preview]
    python -m sluice integrity     --root DIR
    python -m sluice run-all       --root DIR [--parallel N]

The session comes from ``SparkSession.builder.getOrCreate()``, so master,
memory, shuffle partitions and the checkpoint folder are whatever spark-submit
or the environment sets. Output is small by construction: counts, schemas,
summaries and previews.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sluice.operators import synth
from sluice.operators.keys import distinct_values
from sluice.operators.profile import issue_summary, preview
from sluice.plans.clinical import CLINICAL_SPECS
from sluice.plans.promotion import (
    all_issues,
    check_integrity,
    clean_dataset,
    landing_to_raw,
    profile_landing,
    run_all,
)
from sluice.sources.io import LayerPaths, read_csv, read_parquet, rows_to_frame


def _show(title: str, df, n: int = 20) -> None:
    print(title)
    df.show(n, truncate=False)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="python -m sluice", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("step", choices=["generate", "check", "read-patients", "profile", "landing-to-raw",
                                     "clean", "integrity", "run-all"])
    ap.add_argument("dataset", nargs="?", choices=list(CLINICAL_SPECS), help="dataset for the clean step")
    ap.add_argument("--root", default="data", help="folder (or URI) holding landing/raw/cleaned/data_quality")
    ap.add_argument("--parallel", type=int, default=1, help="datasets processed concurrently")
    ap.add_argument("--preview", action="store_true", help="show distinct values before and after cleaning, and sample rows")
    ap.add_argument("--seed", type=int, default=42)
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"sluice-{args.step}").getOrCreate()
    layers = LayerPaths(args.root)
    specs = CLINICAL_SPECS

    if args.step == "generate":
        synth.save_landing(synth.clinical_tables(spark, seed=args.seed), layers.landing)
        for name in specs:
            print(f"{name}: {read_csv(spark, layers.landing(name), specs[name].schema).count()} rows")
    elif args.step == "check":
        df = rows_to_frame(spark, [("P0001", "SITE_A", "ACTIVE"), ("P0002", "SITE_B", "COMPLETED"),
                                   ("P0003", "SITE_C", "WITHDRAWN")], ["patient_id", "site_id", "status"])
        df.show()
        df.printSchema()
    elif args.step == "read-patients":
        df = read_csv(spark, layers.landing("patients"), infer=True)
        _show("Patients (first 10 by patient_id):", preview(df, ["patient_id"], 10))
        df.printSchema()
        print(f"Total rows: {df.count()}")
    elif args.step == "profile":
        _show("Landing profiles:", profile_landing(spark, specs, layers), 1000)
        for name, spec in specs.items():
            _show(f"{name} sample:", preview(read_csv(spark, layers.landing(name), spec.schema), list(spec.key), 5))
    elif args.step == "landing-to-raw":
        for name, rows in landing_to_raw(spark, specs, layers, args.parallel).items():
            print(f"{name}: {rows} rows → {layers.raw(name)}")
    elif args.step == "clean":
        if not args.dataset:
            ap.error("clean needs a dataset")
        spec = specs[args.dataset]
        if args.preview:
            raw = read_parquet(spark, layers.raw(spec.name))
            for column in spec.cleaners:
                _show(f"Distinct {column} values before cleaning:", distinct_values(raw, column).orderBy(column))
        before, after = clean_dataset(spark, spec, layers)
        print(f"Rows before dedup: {before}\nRows after dedup: {after}")
        if args.preview:
            cleaned = read_parquet(spark, layers.cleaned(spec.name))
            for column in list(spec.cleaners) + list(spec.derived):
                _show(f"Distinct {column} values after cleaning:", distinct_values(cleaned, column).orderBy(column))
            _show("Cleaned sample:", preview(cleaned, list(spec.key), 10))
        _show("Data quality issues summary:", issue_summary(read_parquet(spark, layers.issues(spec.name))))
    elif args.step == "integrity":
        issues = check_integrity(spark, specs, layers)
        _show("Referential integrity issues:", preview(issues, ["dataset_name", "record_id"], 20))
        _show("Summary:", issue_summary(issues, ["dataset_name", "issue_type", "severity"]))
    elif args.step == "run-all":
        report = run_all(spark, specs, layers, combined=True, parallel=args.parallel)
        for name in specs:
            print(f"{name}: landing {report.landing_rows[name]}, cleaned {report.cleaned_rows[name]}")
        summary = issue_summary(all_issues(spark, specs, layers), ["dataset_name", "issue_type", "severity"])
        _show("All issues:", summary.orderBy(F.col("dataset_name"), F.col("issue_type")))


if __name__ == "__main__":
    main()
