"""Joins with the semantics of record pipelines."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import id_shape, words
from ..storage import stored

SMALL_ROWS = 100_000  # dimension tables are broadcast up to this many rows
BLOCK = 25_000  # texts of one side that a task compares, on average


def dimension(fact: DataFrame, dim: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join to a dimension, broadcast only if its checked size allows."""
    small = dim.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS
    return fact.join(F.broadcast(dim) if small else dim, on, how)


def grid(left: DataFrame, right: DataFrame, most: int = SMALL_ROWS) -> DataFrame:
    """Every row of one dimension with every row of another: a report's frame, never a join of facts. Raises if either has
    more than `most` rows."""
    for side in (left, right):
        if side.limit(most + 1).count() > most:
            raise ValueError(f"a grid is for dimensions of up to {most} rows")
    return left.crossJoin(F.broadcast(right))


def reconcile(left: DataFrame, right: DataFrame, key: str, left_hash: str, right_hash: str) -> DataFrame:
    """key and bucket of a full outer match: ok, stale (hashes differ), unhashed (right has none), orphan (left only), missing (right only)."""
    a = left.select(F.col(key), F.col(left_hash).alias("_a"), F.lit(True).alias("_l"))
    b = right.select(F.col(key), F.col(right_hash).alias("_b"), F.lit(True).alias("_r"))
    bucket = F.when(F.col("_l").isNull(), "missing").when(F.col("_r").isNull(), "orphan").when(F.col("_b").isNull(), "unhashed").when(F.col("_a").eqNullSafe(F.col("_b")), "ok").otherwise("stale")
    return a.join(b, key, "full").select(key, bucket.alias("bucket"))


def rebuilt(new: DataFrame, old: DataFrame, key: str, new_hash: str, old_hash: str) -> DataFrame:
    """A manifest made anew: the new rows with the other fields of the old one, and change (new, same, changed; dropped for
    keys that only the old one has)."""
    a, b = new.withColumn("_n", F.lit(True)), old.withColumn("_o", F.lit(True))
    change = F.when(F.col("_n").isNull(), "dropped").when(F.col("_o").isNull(), "new").when(F.col(old_hash).eqNullSafe(F.col(new_hash)), "same").otherwise("changed")
    return a.join(b, key, "full").withColumn("change", change).drop("_n", "_o")


def fallback(fact: DataFrame, exact: DataFrame, exact_on: list[str], general: DataFrame, general_on: list[str], value: str) -> DataFrame:
    """Value of the exact key, else of the general one."""
    a = exact.withColumnRenamed(value, "_x")
    b = general.withColumnRenamed(value, "_g")
    return fact.join(a, exact_on, "left").join(b, general_on, "left").withColumn(value, F.coalesce("_x", "_g")).drop("_x", "_g")


def disjointness(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row comparing two sets of ids (column id): sizes, comparable ids (of shapes that both have), overlap, status."""
    sides = left.select("id", F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select("id", F.lit(0).alias("l"), F.lit(1).alias("r")))
    ids = sides.where("id is not null").groupBy("id").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    shapes = ids.groupBy(id_shape(F.col("id")).alias("shape")).agg(F.sum("l").alias("l"), F.sum("r").alias("r"), F.sum(F.col("l") * F.col("r")).alias("both"))
    shared = (F.col("l") > 0) & (F.col("r") > 0)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    out = shapes.agg(
        zero(F.sum("l")).alias("left_n"), zero(F.sum("r")).alias("right_n"), zero(F.count_if(shared)).alias("shared_shapes"),
        zero(F.sum(F.when(shared, F.col("l")))).alias("left_comparable"), zero(F.sum(F.when(shared, F.col("r")))).alias("right_comparable"), zero(F.sum("both")).alias("overlap_n"),
    )
    return out.withColumn("status", F.when(F.col("overlap_n") > 0, "FAIL").when((F.col("left_n") == 0) | (F.col("right_n") == 0) | (F.col("shared_shapes") == 0), "VACUOUS").otherwise("PASS"))


def tfidf_best(queries: DataFrame, items: DataFrame) -> DataFrame:
    """query_id, item_id, sim: the most similar item of each query (query_id, text) by TF-IDF cosine.

    IDF comes from the items (item_id, text) alone, smoothed as ``ln((N+1)/(df+1)) + 1``; terms that
    no item has still lengthen the query. Queries that share no term with any item have sim 0 and no
    item; ties go to the smallest item_id. Every block of queries meets every block of items, where
    products are summed on arrays over the postings, so hot terms build no rows. Terms are 64-bit hashes.
    """
    terms = lambda df, key: df.select(F.col(key).alias("id"), F.explode(F.transform(words(F.lower("text")), lambda x: F.xxhash64(x))).alias("term")).groupBy("id", "term").agg(F.count("*").alias("tf"))
    total = items.where("text is not null").agg(F.count("*").alias("n"))
    it = terms(items.where("text is not null"), "item_id")
    idf = it.groupBy("term").agg(F.count("*").alias("df")).join(F.broadcast(total)).select("term", (F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1).alias("idf"))
    q = terms(queries.where("text is not null"), "query_id")
    weighted = it.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf")), q.join(idf, "term", "left").join(F.broadcast(total)).withColumn("w", F.col("tf") * F.coalesce("idf", F.log(F.col("n") + 1) + 1))

    def vectors(df: DataFrame) -> DataFrame:
        """id, terms and weights that items have, divided by the length of the whole vector."""
        known = F.collect_list(F.when(F.col("idf").isNotNull(), F.struct(F.col("term").alias("t"), F.col("w").alias("w"))))
        v = df.groupBy("id").agg(known.alias("v"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("len")).where("size(v) > 0")
        return stored(v.select("id", F.col("v.t").alias("terms"), F.transform("v.w", lambda x: x / F.col("len")).alias("weights")))

    iv, qv = map(vectors, weighted)
    m, n = (max(1, -(-v.count() // BLOCK)) for v in (iv, qv))
    block = lambda df, own, k, other, j: df.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(k).cast("long"))).withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(j - 1).cast("long"))))
    iv, qv = block(iv, "i", m, "q", n).groupBy("i", "q"), block(qv, "q", n, "i", m).groupBy("i", "q")
    sims = qv.cogroup(iv).applyInPandas(_best_of_block, "query_id long, item_id long, sim double")
    best = sims.groupBy("query_id").agg(F.max(F.struct(F.round("sim", 6).alias("sim"), (-F.col("item_id")).alias("neg"))).alias("m"))
    return queries.select("query_id").join(best, "query_id", "left").select("query_id", (-F.col("m.neg")).alias("item_id"), F.coalesce("m.sim", F.lit(0.0)).alias("sim"))


def _best_of_block(q: pd.DataFrame, it: pd.DataFrame) -> pd.DataFrame:
    """query_id, item_id, sim of the most similar item of a block: sums over postings, by query."""
    out: list[tuple[int, int, float]] = []
    if len(q) and len(it):
        it = it.sort_values("id")
        ids = it["id"].to_numpy()
        term, weight = np.concatenate(it["terms"].to_numpy()), np.concatenate(it["weights"].to_numpy())
        at = np.repeat(np.arange(len(ids)), it["terms"].map(len))
        order = np.argsort(term, kind="stable")
        at, weight = at[order], weight[order]
        known, first = np.unique(term[order], return_index=True)
        last = np.append(first[1:], len(order))
        for key, ts, ws in zip(q["id"], q["terms"], q["weights"]):
            place = np.minimum(np.searchsorted(known, ts), len(known) - 1)
            hit = known[place] == ts
            place, ws = place[hit], ws[hit]
            if not len(place):
                continue
            n = last[place] - first[place]
            rows = np.concatenate([at[a:b] for a, b in zip(first[place], last[place])])
            dot = np.concatenate([weight[a:b] for a, b in zip(first[place], last[place])]) * np.repeat(ws, n)
            if len(rows) * 8 < len(ids):
                rows, back = np.unique(rows, return_inverse=True)
                dot = np.bincount(back, dot)
            else:
                dot, rows = np.bincount(rows, dot, len(ids)), np.arange(len(ids))
            near = np.flatnonzero(dot >= dot.max() - 2e-6)
            sim = np.floor(dot[near] * 1e6 + 0.5)
            best = near[np.argmax(sim)]  # the first of equals: the smallest id
            out.append((key, ids[rows[best]], dot[best]))
    return pd.DataFrame(out, columns=["query_id", "item_id", "sim"])


def both_sides(df: DataFrame, key: Column, side: Column, names: tuple[str, str]) -> DataFrame:
    """Keys that rows of both sides have, with the rows of each."""
    n = df.where(key.isNotNull()).groupBy(key.alias("key")).agg(F.count_if(side == names[0]).alias("n_left"), F.count_if(side == names[1]).alias("n_right"))
    return n.where("n_left > 0 and n_right > 0")
