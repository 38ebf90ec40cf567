"""Session factory."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and Arrow; master and partitions are left to the cluster where not given."""
    b = SparkSession.builder.appName("sparkloom").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    b = b.config("spark.sql.adaptive.skewJoin.enabled", "true").config("spark.sql.execution.arrow.pyspark.enabled", "true")
    if master:
        b = b.master(master)
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()
