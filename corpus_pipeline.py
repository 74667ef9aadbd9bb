"""The corpus pipeline: quality rules, near-duplicates, repeated passages, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame. ``run`` writes every
stage's result as Parquet under the shared checkpoint folder and hands the reread table
to the next one, so a lost executor repeats one stage at most.

Stages work on the columns ``doc_id``, ``text``, ``source`` and, where present, ``n_chars``.
Any further columns pass through whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import save
from sluice.llm.packing import cut_pieces, pack
from sluice.llm.quality_rules import quality_rules
from sluice.llm.simhash_dedup import one_of_each
from sluice.llm.suffix_dedup import remove_repeats

OWN = ("doc_id", "text", "source")


def _aside(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its further columns under neutral names, and their real names."""
    names = {f"further_column_{i}": c for i, c in enumerate(docs.columns) if c not in OWN}
    return docs.withColumnsRenamed({c: n for n, c in names.items()}), names


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass their own rules and whose host (``source``) is not rejected."""
    plain, names = _aside(docs)
    return quality_rules(plain).filter("kept").select(*plain.columns).withColumnsRenamed(names)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the one of least ``doc_id``."""
    plain, names = _aside(docs)
    return one_of_each(plain).withColumnsRenamed(names)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of repeated 200-byte strings. Where that cuts a
    character, its other bytes go too. ``n_chars`` follows the text; null text becomes empty."""
    plain, names = _aside(docs)
    cut = remove_repeats(plain, as_text=True).withColumn("text", F.col("kept")).select(*plain.columns).withColumnsRenamed(names)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in cut.columns else cut


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """The pieces of all documents with their place in sequences of at most 4096 tokens."""
    pieces = cut_pieces(docs, tokenizer or public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id"])
    return pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [("quality_rules", quality), ("simhash_dedup", near_dedup), ("suffix_dedup", passages), ("packing", packing)]

#: DuckDB has no XXH64 and cannot state the packing; tests/llm holds the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
