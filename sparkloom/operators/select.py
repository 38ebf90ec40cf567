"""Selection: weighted targets, quotas, one-dimensional clusters, packing in order."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import stored


def weighted_targets(counts: DataFrame, weights: dict[str, float], total: int, caps: dict[str, int]) -> DataFrame:
    """source, n_rows, target: weights of sources without rows go to the others in proportion; a target is at most
    cap times the rows of its source. counts: source, n_rows (a small table)."""
    w = F.coalesce(*(F.when(F.col("source") == k, F.lit(v)) for k, v in weights.items()), F.lit(0.0))
    cap = F.coalesce(*(F.when(F.col("source") == k, F.lit(v)) for k, v in caps.items()), F.lit(1))
    live = counts.where("n_rows > 0").withColumn("w", w).withColumn("share", F.col("w") / F.sum("w").over(Window.partitionBy(F.lit(0))))
    return live.select("source", "n_rows", F.least(F.round(F.col("share") * total), F.col("n_rows") * cap).cast("long").alias("target"))


def oversampled(df: DataFrame, rank: str, n: str, target: str) -> DataFrame:
    """Copies of each row (column copy from 0) so that its group of n rows reaches the target; rank counts from 1."""
    times = F.floor(F.col(target) / F.col(n)) + F.when(F.col(rank) <= F.col(target) % F.col(n), 1).otherwise(0)
    return df.where(times > 0).withColumn("copy", F.explode(F.sequence(F.lit(0), (times - 1).cast("int"))))


def kmeans_1d(values: DataFrame, value: str, k: int, rounds: int = 100, places: int = 4) -> DataFrame:
    """cluster, centre, n_rows, low, high by Lloyd's rounds on a histogram of values rounded to `places`, which bounds its
    rows by the range of the values; centres start at quantiles. The driver holds k centres only. Fewer different values than k give as many clusters."""
    h = values.where(F.col(value).isNotNull()).groupBy(F.round(value, places).alias("x")).agg(F.count("*").alias("n")).cache()
    try:
        at = h.select(F.percentile("x", F.array(*(F.lit((i + 0.5) / k) for i in range(k))), F.col("n"))).first()[0]
        centres = sorted(set(at or []))
        for _ in range(rounds):
            if not centres:
                break
            near = F.array_position(F.array(*(F.abs(F.col("x") - c) for c in centres)), F.array_min(F.array(*(F.abs(F.col("x") - c) for c in centres)))) - 1
            got = {r["c"]: r["m"] for r in h.groupBy(near.alias("c")).agg((F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias("m")).collect()}
            new = sorted(got.values())
            if len(new) == len(centres) and max(abs(a - b) for a, b in zip(new, centres)) < 1e-4:
                break
            centres = new
        if not centres:
            return h.sparkSession.createDataFrame([], "cluster long, centre double, n_rows long, low double, high double")
        dist = [F.abs(F.col("x") - c) for c in centres]
        out = h.groupBy((F.array_position(F.array(*dist), F.array_min(F.array(*dist))) - 1).alias("cluster")).agg(F.round(F.sum(F.col("x") * F.col("n")) / F.sum("n"), 6).alias("centre"), F.sum("n").alias("n_rows"), F.min("x").alias("low"), F.max("x").alias("high"))
        return h.sparkSession.createDataFrame(out.collect(), out.schema)
    finally:
        h.unpersist()


def first_fit(df: DataFrame, shard: str, key: str, size: str, window: int, separator: int) -> DataFrame:
    """shard, bin, key, size: first-fit decreasing in each shard; a row after the first of a bin costs the separator too,
    an oversize row has a bin of its own. Shards bound what a task holds."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([size, key], ascending=[False, True])
        left: list[int] = []
        at = []
        cap = 1
        while cap < len(pdf) + 1:
            cap *= 2
        tree = [-1] * (2 * cap)  # room left, by halves: finds the first bin with enough

        def put(i, v):
            i += cap
            tree[i] = v
            while i > 1:
                i //= 2
                tree[i] = max(tree[2 * i], tree[2 * i + 1])

        for n in pdf[size]:
            need = n + separator
            if tree[1] >= need:
                i = 1
                while i < cap:
                    i = 2 * i if tree[2 * i] >= need else 2 * i + 1
                i -= cap
                left[i] -= need
            else:
                i = len(left)
                left.append(window - n)
            put(i, left[i])
            at.append(i)
        return pd.DataFrame({"shard": pdf[shard], "bin": at, "key": pdf[key], "size": pdf[size]})

    return df.select(shard, key, size).groupBy(shard).applyInPandas(run, "shard long, bin long, key long, size long")


def quota_topup(pairs: DataFrame, chosen: DataFrame, floor: int) -> DataFrame:
    """key, for_item of rows added so that each item is held by `floor` chosen rows, where so many rows hold it.

    pairs: key, item (different). chosen: key. Items are served from the scarcest on until every one is served or at the
    floor; each added row counts for all of its items. An item never takes more than its first `floor` rows in hash order,
    so one task serves all items (names of functions or modules) from those; the other rows stay distributed.
    """
    pairs = stored(pairs)
    have = stored(chosen.select("key").distinct())
    count = pairs.join(have, "key", "left_semi").groupBy("item").agg(F.count("*").alias("c"))
    short = pairs.select("item").distinct().join(count, "item", "left").select("item", F.coalesce("c", F.lit(0)).alias("c")).where(F.col("c") < floor)
    open_ = pairs.join(have, "key", "left_anti").join(short, "item").withColumn("h", F.sha2(F.col("key").cast("string"), 256))
    first = open_.withColumn("r", F.row_number().over(Window.partitionBy("item").orderBy("h", "key"))).where(F.col("r") <= floor)
    near = open_.join(first.select("key").distinct(), "key", "left_semi")

    def serve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "key"])
        keys = pdf.groupby("item")["key"].apply(list).to_dict()
        items = pdf.groupby("key")["item"].apply(list).to_dict()
        held = dict(zip(pdf["item"], pdf["c"]))
        queue = [(c, item) for item, c in held.items()]
        heapq.heapify(queue)
        added: dict = {}
        while queue:
            c, item = heapq.heappop(queue)
            if c < held[item]:
                heapq.heappush(queue, (held[item], item))
                continue
            if c >= floor:
                break
            for key in [k for k in keys[item] if k not in added][: floor - c]:
                added[key] = item
                for i in items[key]:
                    held[i] += 1
        return pd.DataFrame({"key": list(added), "for_item": list(added.values())})

    return near.select("key", "item", "h", "c").groupBy().applyInPandas(serve, f"key {pairs.schema['key'].dataType.simpleString()}, for_item string")


def shared_targets(counts: DataFrame, weights: dict[str, float], total: int, caps: dict[str, float], cap: float, takers: list[str]) -> DataFrame:
    """source, n_rows, target of the sources that have rows (counts: source, n_rows; a small table of those weighted).

    The weight of sources without rows is shared evenly; a target is at most its cap (`cap` where none is named) times the
    rows; what the caps leave over is shared among the takers with rows to spare, up to their caps.
    """
    one = Window.partitionBy(F.lit(0))
    w = F.coalesce(*(F.when(F.col("source") == k, F.lit(v)) for k, v in weights.items()), F.lit(0.0))
    most = F.floor(F.col("n_rows") * F.coalesce(*(F.when(F.col("source") == k, F.lit(v)) for k, v in caps.items()), F.lit(cap)))
    live = counts.where("n_rows > 0").withColumn("w", w).withColumn("m", most)
    live = live.withColumn("aw", F.col("w") + (1 - F.sum("w").over(one)) / F.count("*").over(one))
    live = live.withColumn("want", F.floor(total * F.col("aw") / F.sum("aw").over(one))).withColumn("t", F.least("want", "m"))
    live = live.withColumn("lack", F.sum(F.col("want") - F.col("t")).over(one)).withColumn("takes", (F.col("n_rows") > F.col("t")) & F.col("source").isin(*takers))
    more = F.least(F.floor(F.col("lack") / F.count_if("takes").over(one)), F.col("m") - F.col("t"))
    return live.select("source", "n_rows", (F.col("t") + F.when(F.col("takes") & (F.col("lack") > 0), more).otherwise(0)).cast("long").alias("target"))


def balanced(df: DataFrame, by: str, grade: str, key: str, quotas: dict[int, int], seed: int) -> DataFrame:
    """Rows of each group: so many of each grade in seeded hash order (chosen), topped up from its rest where a grade is short.

    Ranks are taken of the first rows of each salt of a group, so a hot one is never ordered whole.
    """
    from .ranks import first_n, seeded

    total = sum(quotas.values())
    rows = df.withColumn("_h", seeded(F.col(key), seed))
    few = first_n(rows, [by, grade], [F.col("_h"), F.col(key)], total)
    w = Window.partitionBy(by, grade).orderBy("_h", key)
    quota = F.coalesce(*(F.when(F.col(grade) == g, F.lit(n)) for g, n in quotas.items()), F.lit(0))
    few = few.withColumn("chosen", F.row_number().over(w) <= quota)
    return first_n(few, [by], [F.desc("chosen"), F.col("_h"), F.col(key)], total).drop("_h")


def resampled(df: DataFrame, key: str, seed: int, repair_cap: float, application_cap: float, simple_floor: float) -> DataFrame:
    """key and origin (sample or pool). df: key, tier, repair, bulk, sampled (else in the pool).

    Of the sample, repair rows up to a share of it stay; then applications up to a share of what is left, those that aren't
    bulk first; simple rows of the pool, no repair ones, are added up to a share of the whole sample. All in seeded hash
    order; ranks are taken in hash buckets.
    """
    from .ranks import bucket_rank, hash_bucket, seeded

    rows = df.withColumn("_h", seeded(F.col(key), seed))
    rank = lambda d, by, name, first=None: bucket_rank(d, F.concat(first, hash_bucket(F.col("_h"))) if first is not None else hash_bucket(F.col("_h")), [F.col("_h"), F.col(key)], by, name)
    size = lambda d, name: F.broadcast(d.agg(F.count("*").alias(name)))
    sample = rows.where("sampled")
    total = size(sample, "_total")
    c1 = stored(rank(sample, ["repair"], "_k").join(total).where(~F.col("repair") | (F.col("_k") <= F.floor(F.col("_total") * repair_cap))).drop("_k", "_total"))
    c3 = stored(rank(c1, ["tier"], "_k", F.when(F.col("bulk"), "1").otherwise("0")).join(size(c1, "_kept")).where((F.col("tier") != "application") | (F.col("_k") <= F.floor(F.col("_kept") * application_cap))).drop("_k", "_kept"))
    need = total.join(F.broadcast(c3.agg(F.count_if(F.col("tier") == "simple").alias("_s")))).select(F.greatest(F.lit(0), F.floor(F.col("_total") * simple_floor) - F.col("_s")).alias("_need"))
    pool = rank(rows.where(~F.col("sampled") & ~F.col("repair") & (F.col("tier") == "simple")), None, "_k").join(F.broadcast(need)).where(F.col("_k") <= F.col("_need"))
    return c3.select(key, F.lit("sample").alias("origin")).unionByName(pool.select(key, F.lit("pool").alias("origin")))


def cycled(spark, pool: DataFrame, key: str, count: int) -> DataFrame:
    """i, key, variant of `count` rows: the keys of a pool (a small table), in order, over and over; variant is the turn."""
    keys = pool.agg(F.array_sort(F.collect_list(key)).alias("_k")).where("size(_k) > 0")
    rows = spark.range(count).withColumnRenamed("id", "i").join(F.broadcast(keys))
    return rows.select("i", F.get("_k", (F.col("i") % F.size("_k")).cast("int")).alias(key), F.floor(F.col("i") / F.size("_k")).alias("variant"))


def rebalanced(shares: DataFrame, key: str, failing) -> DataFrame:
    """key, share: equal shares of the rows of a small table; failing ones are halved, and what that frees goes to the others
    in proportion."""
    one = Window.partitionBy(F.lit(0))
    s = shares.withColumn("_f", failing).withColumn("_s", 1.0 / F.count("*").over(one))
    s = s.withColumn("_o", F.when(F.col("_f"), F.col("_s") / 2).otherwise(F.col("_s")))
    freed = (1 - F.sum("_o").over(one)) * F.col("_o") / F.nullif(F.sum(F.when(~F.col("_f"), F.col("_o"))).over(one), F.lit(0.0))
    return s.select(key, F.round(F.col("_o") + F.when(~F.col("_f"), F.coalesce(freed, F.lit(0.0))).otherwise(0.0), 6).alias("share"))


GOLDEN = 618_033_989  # of 10**9: multiples of the golden ratio fill the unit line evenly


def assigned(df: DataFrame, rank: str, shares: dict[str, int], name: str = "assigned") -> DataFrame:
    """Adds who gets each row: rows of rank 1, 2, .. fall on the unit line at multiples of the golden ratio, which the shares
    (in millionths) divide, so that the counts of any run of rows stay close to the shares, without a state that passes from row to row."""
    place = (F.col(rank) * GOLDEN) % 1_000_000_000
    out, upto = None, 0
    for key, share in shares.items():
        upto += share * 1000
        out = (F.when if out is None else out.when)(place < upto, key)
    return df.withColumn(name, out.otherwise(key))
