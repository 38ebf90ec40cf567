"""Cutting lineage through the shared checkpoint folder; columns of numbers as bytes."""

from __future__ import annotations

import tempfile

import numpy as np
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where it is unset, a new local one in local mode (tests), else an error."""
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    d = spark.conf.get("spark.checkpoint.dir", None) or (known.get() if known.isDefined() else None)
    if d is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = "file://" + tempfile.mkdtemp(prefix="sparkloom-")
    if not known.isDefined():
        spark.sparkContext.setCheckpointDir(d)
    return d


def stored(df: DataFrame) -> DataFrame:
    """The rows, written to the shared checkpoint folder; lineage ends there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def packed(*columns: np.ndarray) -> bytes:
    """Columns by planes of equal bytes, the high ones of which are nearly constant, so shuffles compress them away."""
    return b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T).tobytes() for c in columns)


def unpacked(data: bytes, kinds: tuple[str, ...]) -> list[np.ndarray]:
    widths = [np.dtype(k).itemsize for k in kinds]
    n = len(data) // sum(widths)
    at = np.concatenate(([0], np.cumsum(widths))) * n
    raw = np.frombuffer(data, np.uint8)
    return [np.ascontiguousarray(raw[a : a + w * n].reshape(w, n).T).reshape(-1).view(k) for a, w, k in zip(at, widths, kinds)]
