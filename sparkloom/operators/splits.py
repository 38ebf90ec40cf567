"""Deterministic splits and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranks import bucket_rank, hash_bucket, seeded


def hash_side(*parts: Column) -> Column:
    """evaluation for a fifth of all keys, else training, by SHA-256 modulo 5 (16 is 1 modulo 5: the sum of the digits will do)."""
    digits = F.split(F.sha2(F.concat(*(F.coalesce(p, F.lit("")) for p in parts)), 256), "")
    total = F.aggregate(digits, F.lit(0), lambda a, x: a + F.when(x == "", 0).otherwise(F.conv(x, 16, 10).cast("int")))
    return F.when(total % 5 == 0, "evaluation").otherwise("training")


def ratio_split(df: DataFrame, by: list[str], key: str, train: float, seed: int) -> DataFrame:
    """Adds part (train, validation, test): in each group, in seeded hash order, max(1, round(n * train)) rows, then
    round(n * (1 - train) / 2), then the rest. Ranks are taken in hash buckets, so a group of any size is split."""
    order = seeded(F.col(key), seed)
    r = bucket_rank(df.withColumn("_h", order), hash_bucket(F.col("_h")), [F.col("_h"), F.col(key)], by)
    n = df.groupBy(*by).agg(F.count("*").alias("_n")).select(*(F.col(c).alias(f"_g{i}") for i, c in enumerate(by)), "_n")
    out = r.join(F.broadcast(n) if n.limit(10_001).count() <= 10_000 else n, [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(by)])
    first = F.greatest(F.lit(1), F.round(F.col("_n") * train))
    second = first + F.round(F.col("_n") * (1 - train) / 2)
    part = F.when(F.col("rank") <= first, "train").when(F.col("rank") <= second, "validation").otherwise("test")
    return out.withColumn("part", part).drop("_h", "_n", "rank", *(f"_g{i}" for i in range(len(by))))


def family_holdout(df: DataFrame, fam: Column, stratum: str, key: str, share: float, seed: int) -> DataFrame:
    """fam, stratum, n_rows, holdout: whole families, of the stratum of their smallest key, in seeded order until a share
    of the stratum's rows is held out."""
    fams = df.groupBy(fam.alias("fam")).agg(F.count("*").alias("n_rows"), F.min_by(stratum, key).alias("stratum"))
    h = seeded(F.col("fam"), seed)
    # running sums by hash bucket first, so the window within a bucket stays small
    fams = fams.withColumn("h", h).withColumn("b", hash_bucket(F.col("h")))
    per = fams.groupBy("stratum", "b").agg(F.sum("n_rows").alias("s"))
    wb = Window.partitionBy("stratum").orderBy("b")
    per = per.withColumn("before", F.coalesce(F.sum("s").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("goal", F.round(F.sum("s").over(Window.partitionBy("stratum")) * share))
    w = Window.partitionBy("stratum", "b").orderBy("h", "fam").rowsBetween(Window.unboundedPreceding, -1)
    out = fams.withColumn("inner", F.coalesce(F.sum("n_rows").over(w), F.lit(0)))
    p = per.select(F.col("stratum").alias("_s"), F.col("b").alias("_b"), "before", "goal")
    out = out.join(p, F.col("stratum").eqNullSafe(F.col("_s")) & (F.col("b") == F.col("_b")))
    return out.select("fam", "stratum", "n_rows", (F.col("before") + F.col("inner") < F.col("goal")).alias("holdout"))


def sample_per(df: DataFrame, by: list[str], key: str, n: int, seed: int) -> DataFrame:
    """n rows of each group in seeded hash order. Only rows of the leading hash buckets are ranked."""
    order = seeded(F.col(key), seed)
    r = bucket_rank(df.withColumn("_h", order), hash_bucket(F.col("_h")), [F.col("_h"), F.col(key)], by)
    return r.where(F.col("rank") <= n).drop("_h", "rank")


def representative(df: DataFrame, phase: str, category: str, key: str, limit: int, seed: int) -> DataFrame:
    """`limit` rows: an equal share of each phase, and in it of each category (one at least), in seeded hash order; chosen
    tells them from the rows that fill up. Null phases and categories count as such."""
    rows = df.withColumn("_h", seeded(F.col(key), seed))
    r = bucket_rank(rows, hash_bucket(F.col("_h")), [F.col("_h"), F.col(key)], [phase, category], "_rank")
    c = df.select(phase, category).distinct().groupBy(F.col(phase).alias("_p")).agg(F.count("*").alias("_c"))
    k = df.select(phase).distinct().agg(F.count("*").alias("_k"))
    c = c.join(F.broadcast(k))
    r = r.join(F.broadcast(c) if c.limit(10_001).count() <= 10_000 else c, F.col(phase).eqNullSafe(F.col("_p")))
    each = F.greatest(F.lit(1), F.floor(F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col("_k"))) / F.col("_c")))
    chosen = r.withColumn("chosen", F.col("_rank") <= each)
    # the first of the order are kept by a top-k, which no task gets more of than `limit` rows from each other one
    return chosen.orderBy(F.desc("chosen"), "_h", key).limit(limit).drop("_h", "_rank", "_p", "_c", "_k")
