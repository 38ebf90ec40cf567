"""Ordered-group operators. Ranks over a whole table are taken in buckets that keep the order, so that no
task sorts all rows: counts per bucket are added up (one row per bucket) and joined back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import stored


def seeded(key: Column, seed: int | str) -> Column:
    """A reproducible random order: the SHA-256 of seed and key."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)


def hash_bucket(order: Column) -> Column:
    """First three digits of a hash order: 4096 buckets."""
    return F.substring(order, 1, 3)


def bucket_rank(df: DataFrame, bucket: Column, order: list[Column], by: list[str] | None = None, name: str = "rank") -> DataFrame:
    """Rank from 1 within the groups of `by`, over a bucket that rises with the order."""
    by = by or []
    df = df.withColumn("_b", bucket)
    keys = [*by, "_b"]
    n = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    off = n.withColumn("_o", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    off = off.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), "_o")
    match = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    inner = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ranked = df.withColumn("_r", inner)
    return ranked.join(off, match).withColumn(name, F.col("_o") + F.col("_r")).drop("_b", "_r", "_o", *(f"_k{i}" for i in range(len(keys))))


def last_by(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """One row per key: the last in order (a total order), by aggregation."""
    rest = [c for c in df.columns if c not in keys]
    out = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_s"))
    return out.select(*keys, *(F.col(f"_s.{c}").alias(c) for c in rest))


def first_by(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    out = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_s"))
    return out.select(*keys, *(F.col(f"_s.{c}").alias(c) for c in rest))


SALTS = 64


def first_n(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """First n rows of each group: of every salt of a group first, so no task orders a hot group."""
    salted = df.withColumn("_s", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
    few = salted.withColumn("_r", F.row_number().over(Window.partitionBy(*by, "_s").orderBy(*order))).where(F.col("_r") <= n).drop("_r", "_s")
    return few.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_r") <= n).drop("_r")


def range_rank(df: DataFrame, by: list[str], order: list[Column], name: str = "rank", total: str | None = None, running: dict[str, str] | None = None) -> DataFrame:
    """Rank from 1 within the groups of `by`, in any order, with no task holding a group.

    Rows are cut into ranges of (by, order) and written once (the cut must not change when a task is repeated); places
    in a range are counted from the first row of the group in it, and counts of the ranges are added up (at most one row
    for each range and group). total: also the rows of the group; running: {name: column}, sums of a column over the
    rows before this one. Null keys form a group.
    """
    spark = df.sparkSession
    keys = [F.col(c) for c in by]
    cut = df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys, *order).sortWithinPartitions(*keys, *order)
    cut = stored(cut.withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id()))
    running = running or {}
    sums = [F.sum(c).alias(f"_sum{k}") for k, c in enumerate(running.values())]
    per = cut.groupBy("_p", *by).agg(F.min("_i").alias("_first"), F.count("*").alias("_n"), *sums)
    w = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    before = [F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before")] + [F.coalesce(F.sum(f"_sum{k}").over(w), F.lit(0)).alias(f"_sum{k}") for k in range(len(running))]
    whole = F.sum("_n").over(Window.partitionBy(*(by or [F.lit(0)]))).alias("_total")
    off = per.select(F.col("_p").alias("_q"), *(F.col(c).alias(f"_k{k}") for k, c in enumerate(by)), "_first", *before, whole)
    match = [F.col("_p") == F.col("_q"), *(F.col(c).eqNullSafe(F.col(f"_k{k}")) for k, c in enumerate(by))]
    inner = Window.partitionBy("_p", *by).orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)
    for k, c in enumerate(running.values()):
        cut = cut.withColumn(f"_in{k}", F.coalesce(F.sum(c).over(inner), F.lit(0)))
    off = F.broadcast(off) if off.limit(10_001).count() <= 10_000 else off
    out = cut.join(off, match)
    cols = [(F.col("_before") + F.col("_i") - F.col("_first") + 1).alias(name)]
    cols += [F.col("_total").alias(total)] if total else []
    cols += [(F.col(f"_sum{k}") + F.col(f"_in{k}")).alias(n) for k, n in enumerate(running)]
    return out.select(*df.columns, *cols)


def top_fraction(df: DataFrame, by: list[str], order: list[Column], rate: float) -> DataFrame:
    """The first ``max(1, ceil(n * rate))`` rows of each group."""
    r = range_rank(df, by, order, "_r", "_n")
    return r.where(F.col("_r") <= F.greatest(F.lit(1), F.ceil(F.col("_n") * rate))).drop("_r", "_n")


def evenly_spaced(df: DataFrame, by: list[str], order: list[Column], most: int) -> DataFrame:
    """Every ``max(1, n // most)``-th row of each group, up to `most`."""
    r = range_rank(df, by, order, "_r", "_n").withColumn("_s", F.greatest(F.lit(1), F.floor(F.col("_n") / most))).withColumn("_r", F.col("_r") - 1)
    return r.where((F.col("_r") % F.col("_s") == 0) & (F.col("_r") / F.col("_s") < most)).drop("_r", "_n", "_s")


def until_goal(df: DataFrame, by: list[str], order: list[Column], size: str, goal: Column) -> DataFrame:
    """Rows of each group in order, until their sizes reach the goal."""
    return range_rank(df, by, order, "_r", running={"_c": size}).where(F.col("_c") < goal).drop("_r", "_c")


GROUPS = 10_000  # groups whose list is broadcast


def interleaved(df: DataFrame, by: str, order: list[Column], name: str = "place") -> DataFrame:
    """Place from 1 when the groups of `by` take turns, in the order of their names (null last), each in its own order.

    A row of round r follows all rows of the rounds before, ``sum(min(n, r - 1))``, and those of its round in the groups
    before its own; up to GROUPS groups, every row gets their list with their sizes. Of more groups, all rows are ranked by
    round and name.
    """
    r = range_rank(df, [by], order, "_r")
    sizes = df.groupBy(by).agg(F.count("*").alias("n"))
    if sizes.limit(GROUPS + 1).count() > GROUPS:
        return range_rank(r, [], [F.col("_r"), F.col(by).asc_nulls_last()], name).drop("_r")
    groups = sizes.agg(F.array_sort(F.collect_list(F.struct(F.col(by).isNull().alias("last"), F.col(by).alias("g"), "n"))).alias("_g"))
    ahead = F.aggregate("_g", F.lit(0).cast("long"), lambda a, g: a + F.least(g["n"], F.col("_r") - 1) + F.when((g["n"] >= F.col("_r")) & ((g["last"] < F.col(by).isNull()) | ((g["last"] == F.col(by).isNull()) & (g["g"] < F.col(by)))), 1).otherwise(0))
    return r.join(F.broadcast(groups)).withColumn(name, ahead + 1).drop("_r", "_g")


BLOCK = 1_000_000  # rows of a group that a task looks over


def rolling_rate(df: DataFrame, by: list[str], order: list[Column], flag: Column, size: int, name: str = "rate") -> DataFrame:
    """Rate of a flag over the last `size` rows, null before there are so many. Groups are cut into blocks of BLOCK rows,
    each with the last ``size - 1`` of the block before."""
    r = range_rank(df.withColumn("_f", flag.cast("double")), by, order, "_r")
    block = F.floor((F.col("_r") - 1) / BLOCK)
    halo = F.when((F.col("_r") - 1) % BLOCK >= BLOCK - size + 1, F.array(block, block + 1)).otherwise(F.array(block))
    r = r.withColumn("_own", block).withColumn("_b", F.explode(halo))
    rate = F.avg("_f").over(Window.partitionBy(*by, "_b").orderBy("_r").rowsBetween(1 - size, 0))
    return r.withColumn(name, F.when(F.col("_r") >= size, rate)).where("_b = _own").drop("_f", "_r", "_own", "_b")
