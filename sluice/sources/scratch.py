"""Reliable checkpoints and scratch folders.

Both live under the shared folder the cluster names in ``spark.checkpoint.dir``.
Only a local-mode session (tests, a laptop) without that setting gets a fresh
temporary folder; a cluster session without it is an error, because a
machine-local folder would not survive a lost executor.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect has no SparkContext
        return None


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, set from the config if needed."""
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        master = sc.master if sc is not None else ""
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; name a shared folder for checkpoints"
            )
        conf = tempfile.mkdtemp(prefix="sluice-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    return conf


_HANDED_OUT: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder path under the checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/sluice-scratch/{name}-{uuid.uuid4().hex[:12]}"
    _HANDED_OUT.append(path)
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders this process has made, once nothing reads the
    results built on them; returns how many there were."""
    sc, n = _context(spark), 0
    while sc is not None and _HANDED_OUT:
        folder = sc._jvm.org.apache.hadoop.fs.Path(_HANDED_OUT.pop())
        n += bool(folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True))
    return n


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into a reliable checkpoint and cut its lineage.

    Under Spark Connect (no SparkContext on the client) the server's own
    checkpoint folder applies.
    """
    if _context(df.sparkSession) is not None:
        checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
