"""Aggregates that Spark has no function for."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nearest_rank(df: DataFrame, by: list[str], value: str, percents: list[int]) -> DataFrame:
    """Element ``min(n - 1, p * n // 100)`` of the sorted values of each group (nulls left out), as p50 and so on.

    Values are counted first, so a group's repeated values take one row; ranks come from running counts.
    """
    n = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_c"))
    w = Window.partitionBy(*by)
    run = n.withColumn("_to", F.sum("_c").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))).withColumn("_n", F.sum("_c").over(w))
    at = lambda p: F.least(F.col("_n") - 1, F.floor(F.col("_n") * p / 100))
    hit = lambda p: (F.col("_to") > at(p)) & (F.col("_to") - F.col("_c") <= at(p))
    return run.groupBy(*by).agg(*(F.max(F.when(hit(p), F.col(value))).alias(f"p{p}") for p in percents))


def histogram(value: Column, width: float, last: int) -> Column:
    """Number of the bin of a fixed width, the last one closed."""
    return F.least(F.floor(value / width), F.lit(last)).cast("long")


def id_hash(df: DataFrame, by: list[str], key: str) -> DataFrame:
    """by, n_ids, ids_hash: SHA-256 over the sorted ids of each group, joined by line breaks (empty without ids).

    Ids stream through one hash in sorted order, so a task holds a batch at a time, whatever the size of a group; a digest
    of one sequence can't be shared among tasks. bucket_hash is the form that can.
    """
    ids = df.select(*by, F.col(key).cast("string").alias("_id"))
    kinds = ", ".join(f"`{c}` {ids.schema[c].dataType.simpleString()}" for c in by)

    def run(batches):
        last, digest, n, any_ = None, None, 0, False
        for pdf in batches:
            for k, part in pdf.groupby(by, dropna=False, sort=False):
                k = tuple(None if pd.isna(x) else x for x in k)
                if k != last:
                    if last is not None:
                        yield pd.DataFrame([(*last, n, digest.hexdigest())], columns=[*by, "n_ids", "ids_hash"])
                    last, digest, n, any_ = k, hashlib.sha256(), 0, False
                some = part["_id"].dropna()
                n += len(part)
                if len(some):
                    digest.update((("\n" if any_ else "") + "\n".join(some)).encode())
                    any_ = True
        if last is not None:
            yield pd.DataFrame([(*last, n, digest.hexdigest())], columns=[*by, "n_ids", "ids_hash"])

    return ids.repartition(*by).sortWithinPartitions(*by, "_id").mapInPandas(run, f"{kinds}, n_ids long, ids_hash string")


def bucket_hash(df: DataFrame, by: list[str], key: str) -> DataFrame:
    """by, n_ids, ids_hash: SHA-256 over the digests of hash buckets, in their order, of each group's different ids.

    Ids fall into 4,096 buckets by the first three digits of their SHA-256; a bucket's digest is over its sorted ids,
    joined by line breaks. Buckets spread a group of any size; a group's last digest is over 4,096 of them at most.
    """
    ids = df.where(F.col(key).isNotNull()).select(*by, F.col(key).cast("string").alias("_id")).distinct()
    bucket = F.substring(F.sha2("_id", 256), 1, 3)
    per = ids.groupBy(*by, bucket.alias("_b")).agg(F.count("*").alias("_n"), F.sha2(F.array_join(F.array_sort(F.collect_list("_id")), "\n"), 256).alias("_h"))
    digests = F.transform(F.array_sort(F.collect_list(F.struct("_b", "_h"))), lambda x: x["_h"])
    return per.groupBy(*by).agg(F.sum("_n").alias("n_ids"), F.sha2(F.array_join(digests, "\n"), 256).alias("ids_hash"))


def verified(manifest: DataFrame, df: DataFrame, by: list[str], key: str) -> DataFrame:
    """The rows of a manifest (by, n_ids, ids_hash of bucket_hash) and whether the table gives the same hash; a group that is
    gone is not valid."""
    now = bucket_hash(df, by, key).select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(by)), F.col("ids_hash").alias("_now"))
    both = manifest.join(now, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)], "left")
    return both.select(*manifest.columns, F.col("ids_hash").eqNullSafe(F.col("_now")).alias("valid"))


def padding(bins: DataFrame, size: str) -> DataFrame:
    """bin (tenth of the largest size, the last closed), n_bins, tokens, padding: the share of room left in the bins of it."""
    room = bins.agg(F.max(size).alias("_room"))
    at = F.least(F.floor(F.col(size) * 10 / F.greatest("_room", F.lit(1))), F.lit(9)).cast("long")
    return bins.join(F.broadcast(room)).groupBy(at.alias("bin")).agg(F.count("*").alias("n_bins"), F.sum(size).alias("tokens"), F.round(1 - F.sum(size) / (F.count("*") * F.max("_room")), 6).alias("padding"))


def interpolated(df: DataFrame, by: list[str], value: str, percents: dict[str, float]) -> DataFrame:
    """Percentiles by linear interpolation between the two neighbouring values, nulls left out; null for a group without values.

    Places come from range_rank, so no task or buffer holds the values of a group.
    """
    from .ranks import range_rank

    r = range_rank(df.where(F.col(value).isNotNull()).select(*by, value), by, [F.col(value)], "_r", "_n").withColumn("_i", F.col("_r") - 1)
    at = {n: F.lit(p) * (F.col("_n") - 1) for n, p in percents.items()}
    near = r.where(F.greatest(F.lit(False), *(F.col("_i").isin(F.floor(x), F.ceil(x)) for x in at.values())))
    ends = lambda f, x: F.max(F.when(F.col("_i") == f(x), F.col(value)))
    got = near.groupBy(*by).agg(*(v for n, x in at.items() for v in (ends(F.floor, x).alias(f"_lo_{n}"), ends(F.ceil, x).alias(f"_hi_{n}"), F.max(x - F.floor(x)).alias(f"_w_{n}"))))
    got = got.select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(by)), *((F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_w_{n}")).alias(n) for n in percents))
    groups = df.select(*by).distinct()
    return groups.join(got, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)], "left").select(*by, *percents)


def merkle_root(df: DataFrame, key: Column, value: Column, rank) -> DataFrame:
    """Root of the tree of SHA-256 pairs over ``key:value`` leaves in key order, an odd last one paired with itself.

    Each round halves the rows; rank(df) adds the column i from 0 in key order. An empty table gives the hash of nothing.
    """
    level = rank(df.select(key.cast("string").alias("k"), value.alias("v"))).select("i", F.sha2(F.concat_ws(":", "k", "v"), 256).alias("h"))
    n = level.count()
    if not n:
        return df.sparkSession.range(1).select(F.lit(0).cast("long").alias("n_leaves"), F.sha2(F.lit(""), 256).alias("root"))
    leaves = n
    while n > 1:
        pair = F.struct(F.col("i"), F.col("h"))
        level = level.groupBy(F.floor(F.col("i") / 2).alias("j")).agg(F.min(pair)["h"].alias("a"), F.max(pair)["h"].alias("b")).select(F.col("j").alias("i"), F.sha2(F.concat("a", "b"), 256).alias("h"))
        n = (n + 1) // 2
    return level.select(F.lit(leaves).cast("long").alias("n_leaves"), F.col("h").alias("root"))


def majority(df: DataFrame, key: str, output: str, voter: str, least: int) -> DataFrame:
    """Vote of each key: verdict (agreed, tied, few), winning output and its voters. Null outputs don't vote."""
    votes = df.where(F.col(output).isNotNull()).groupBy(key, output).agg(F.count("*").alias("n"), F.array_sort(F.collect_set(voter)).alias("voters"))
    w = Window.partitionBy(key).orderBy(F.desc("n"), output)
    top = votes.withColumn("r", F.row_number().over(w)).withColumn("next", F.lead("n").over(w)).withColumn("total", F.sum("n").over(Window.partitionBy(key))).where("r = 1")
    verdict = F.when(F.col("total") < least, "few").when((F.col("n") < least) | (F.col("next") == F.col("n")), "tied").otherwise("agreed")
    won = F.col("verdict") == "agreed"
    return top.withColumn("verdict", verdict).select(key, "verdict", F.when(won, F.col(output)).alias("winner"), F.when(won, F.array_join("voters", ",")).alias("voters"), "total")


def bleu(df: DataFrame, by: list[str], candidate: str, reference: str, n: int = 4) -> DataFrame:
    """Corpus BLEU (clipped n-grams, brevity penalty) of each group; rows with a null side are left out."""
    from ..functions.text import words

    rows = df.where(F.col(candidate).isNotNull() & F.col(reference).isNotNull())
    rows = rows.select(*by, F.monotonically_increasing_id().alias("_id"), words(F.col(candidate)).alias("_c"), words(F.col(reference)).alias("_r"))
    sizes = rows.groupBy(*by).agg(F.sum(F.size("_c")).alias("_cl"), F.sum(F.size("_r")).alias("_rl"))

    def grams(col, k):
        return F.when(F.size(col) >= k, F.transform(F.sequence(F.lit(1), F.size(col) - k + 1), lambda i: F.array_join(F.slice(col, i, k), " "))).otherwise(F.array().cast("array<string>"))

    def marked(side: str, k: int):
        return F.transform(grams(side, k), lambda g: F.struct(F.lit(k).alias("_k"), F.lit(side).alias("_s"), g.alias("_g")))

    parts = F.flatten(F.array(*(marked(side, k) for k in range(1, n + 1) for side in ("_c", "_r"))))
    one = rows.select(*by, "_id", F.explode(parts).alias("_x")).select(*by, "_id", "_x.*")
    per = one.groupBy(*by, "_id", "_k", "_g").agg(F.count_if(F.col("_s") == "_c").alias("_nc"), F.count_if(F.col("_s") == "_r").alias("_nr"))
    hit = per.groupBy(*by, "_k").agg(F.sum(F.least("_nc", "_nr")).alias("_hit"), F.sum("_nc").alias("_all"))
    mean = hit.groupBy(*by).agg(F.sum(F.when(F.col("_hit") > 0, F.log(F.col("_hit") / F.col("_all")))).alias("_logs"), F.count_if(F.col("_hit") > 0).alias("_orders"))
    bp = F.least(F.lit(1.0), F.exp(1 - F.col("_rl") / F.col("_cl")))
    return sizes.join(mean, by, "left").select(*by, F.when((F.col("_orders") == n) & (F.col("_cl") > 0), F.round(100 * bp * F.exp(F.col("_logs") / n), 4)).otherwise(0.0).alias("bleu"))
