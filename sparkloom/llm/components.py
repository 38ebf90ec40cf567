"""Connected components by Borůvka's contraction, and splits that keep them together (problem 2).

Each round every component picks its smallest edge (hash, then ends: a total order, so no cycles
but mutual picks arise), hooks onto the component at its other end, and pointers are doubled until
all point at roots; edges are relabelled and inner ones dropped. Picked edges are the spanning
forest. State is written to the shared checkpoint folder every round; the driver sees counts only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranks import bucket_rank
from .arrays import stored
from .tasks import task_names


def spanning_forest(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(labels, forest) of undirected edges u, v (any one orderable type).

    labels: node, root, one row for each end of an edge that isn't a loop; forest: u, v of the
    picked edges. Nulls, loops and repeated edges are left out; without edges both are empty.
    """
    own = edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    live = stored(own.select(F.col("u").alias("a"), F.col("v").alias("b"), "u", "v", F.xxhash64("u", "v").alias("w")))
    labels = live.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("root", F.col("node"))
    forest = live.select("u", "v").limit(0)
    while not live.isEmpty():
        ends = live.select(F.col("a").alias("c"), F.struct("w", "u", "v", F.col("b").alias("to")).alias("e")).unionByName(live.select(F.col("b").alias("c"), F.struct("w", "u", "v", F.col("a").alias("to")).alias("e")))
        pick = stored(ends.groupBy("c").agg(F.min("e").alias("e")).select("c", F.col("e.to").alias("p"), F.col("e.u").alias("u"), F.col("e.v").alias("v")))
        forest = forest.unionByName(pick.select("u", "v").distinct())
        back = pick.select(F.col("c").alias("p"), F.col("p").alias("pp"))
        # of two that pick each other, the smaller is the root
        ptr = stored(pick.join(back, "p", "left").select("c", F.when((F.col("pp") == F.col("c")) & (F.col("c") < F.col("p")), F.col("c")).otherwise(F.col("p")).alias("p")))
        while True:
            up = ptr.select(F.col("c").alias("p"), F.col("p").alias("g"))
            nxt = stored(ptr.join(up, "p").select("c", F.col("g").alias("p"), (F.col("g") != F.col("p")).alias("moved")))
            ptr = nxt.select("c", "p")
            if nxt.where("moved").isEmpty():
                break
        labels = stored(labels.join(ptr.withColumnRenamed("c", "root"), "root", "left").select("node", F.coalesce("p", "root").alias("root")))
        to = lambda x, y: ptr.select(F.col("c").alias(x), F.col("p").alias(y))
        live = stored(live.join(to("a", "x"), "a").join(to("b", "y"), "b").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b"), "u", "v", "w"))
    return labels, stored(forest)


def named_groups(labels: DataFrame) -> DataFrame:
    """node, group: the smallest node of its component."""
    least = labels.groupBy("root").agg(F.min("node").alias("group"))
    return labels.join(least, "root").select("node", "group")


def program_groups(programs: DataFrame) -> DataFrame:
    """rec_id, group_name of every program whose task_id names a task."""
    rows = programs.select("rec_id", task_names(F.col("task_id")).alias("names")).where("size(names) > 0")
    links = rows.where("size(names) > 1").select(F.get("names", F.lit(0)).alias("u"), F.explode(F.slice("names", F.lit(2), F.size("names"))).alias("v"))
    labels, _ = spanning_forest(links)
    groups = named_groups(labels)
    first = rows.select("rec_id", F.get("names", F.lit(0)).alias("node"))
    return first.join(groups, "node", "left").select("rec_id", F.coalesce("group", "node").alias("group_name"))


GOLDEN = 0.6180339887498949
LEVELS, CELLS = 64, 1024  # sizes told apart in a band, hash cells of each


LARGE = 10_000  # a group of more than a LARGE-th of all rows is dealt before the others


def deal(groups: DataFrame, shares: tuple[float, float, float] = (0.8, 0.1, 0.1)) -> DataFrame:
    """group_name, size, band, split: groups of one size band (powers of two) are dealt in turn.

    Within a band, from the largest of LEVELS sizes down and then in hash order, group k gets the place
    ``k * golden ratio`` modulo 1 of the unit line, which the shares divide; any run of groups meets the
    shares closely. Places in the order are taken in cells of a level and hash, whose counts are added
    up, so no task ranks a band. A few large groups can't meet the shares; so those come first, and the
    others are dealt by the shares of what is then missing of each split (nothing where there is too
    much). groups: one row per record, with group_name.
    """
    size = groups.groupBy("group_name").agg(F.count("*").alias("size"))
    size = size.withColumn("band", F.floor(F.log2("size")).cast("int")).withColumn("h", F.xxhash64(F.lit(7), "group_name"))
    width = F.expr("shiftleft(1L, band)")
    level = F.floor((2 * width - F.col("size")) * LEVELS / width).cast("long")
    cell = level * CELLS + F.shiftrightunsigned("h", 54)
    total = groups.count()
    large = F.col("size") > max(total / LARGE, 1)
    ranked = stored(bucket_rank(size, cell, [F.col("h"), F.col("group_name")], ["band"], "k").select("group_name", "size", "band", large.alias("large"), (((F.col("k") - 1) * GOLDEN) % 1).alias("x")))

    def by(parts) -> Column:
        return F.when(F.col("x") < parts[0], "train").when(F.col("x") < parts[0] + parts[1], "validation").otherwise("test")

    got = {r["split"]: r["n"] for r in ranked.where("large").groupBy(by(shares).alias("split")).agg(F.sum("size").alias("n")).collect()}
    missing = [max(0.0, share * total - got.get(name, 0)) for name, share in zip(("train", "validation", "test"), shares)]
    rest = [m / sum(missing) for m in missing] if sum(missing) else list(shares)
    return ranked.select("group_name", "size", "band", F.when(F.col("large"), by(shares)).otherwise(by(rest)).alias("split"))


def splits(programs: DataFrame, shares: tuple[float, float, float] = (0.8, 0.1, 0.1)) -> DataFrame:
    """rec_id, group_name, new_split of every program; one without a task is a group of its own (``#rec_id``)."""
    known = stored(program_groups(programs))
    rest = programs.select("rec_id").join(known, "rec_id", "left_anti").select("rec_id", F.concat(F.lit("#"), F.col("rec_id").cast("string")).alias("group_name"))
    rows = known.unionByName(rest)
    dealt = deal(rows, shares).select("group_name", F.col("split").alias("new_split"))
    return rows.join(dealt, "group_name").select("rec_id", "group_name", "new_split")
