"""Filling containers of fixed capacity with documents (problem 7).

Documents are measured in tokens. What exceeds the capacity is cut into full containers and a rest;
rests and whole documents are packed by decreasing size into the tightest container. Open
containers are found by a successor search over their residual capacities (a bit set), and carry
bitmaps of the duplicate clusters and, where asked for, of the sources they hold: the search goes
on to the next residual while all containers of one hold a document that conflicts. Where no
container that has room is free of conflict, the tightest one without the cluster, else the tightest
one, is taken all the same: conflicts are avoided, room isn't wasted for them. At the end items of
equal size are exchanged where that leaves fewer conflicts. Documents are packed in shards of a
bounded expected size.

Defined cases: texts without tokens are left out; a document of exactly the capacity fills a
container; configurations without a positive capacity give no rows; ties go by doc_id.
"""

from __future__ import annotations

from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import stored, table
from .bpe import counted

SHARD = 20_000  # documents that are packed together, on average
TRIES = 500  # items of a size that are tried for an exchange


class Bins:
    """Open containers by residual capacity."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.open: dict[int, dict[int, list[int]]] = {}  # residual -> last cluster -> containers
        self.residuals = 0  # bit set of the keys of open
        self.clusters: list[int] = []  # bitmap of 64 hashed clusters of each container
        self.members: list[set[int]] = []
        self.sources: list[int] = []

    def _free(self, b: int, cluster: int) -> bool:
        return cluster < 0 or not self.clusters[b] >> (cluster & 63) & 1 or cluster not in self.members[b]

    def _take(self, size: int, cluster: int, source: int) -> tuple[int, int] | None:
        """The tightest container with room that doesn't conflict, else the tightest without the cluster, else the tightest with room, taken from the search."""
        left, tightest, other = self.residuals >> size, None, None
        residual = size
        while left:
            step = (left & -left).bit_length() - 1
            residual += step
            left >>= step
            for last, bins in self.open[residual].items():
                if tightest is None:
                    tightest = (residual, last, len(bins) - 1)
                if last == cluster and cluster >= 0:
                    continue  # all of these hold the cluster
                for i in range(len(bins) - 1, -1, -1):
                    if source >= 0 and self.sources[bins[i]] >> source & 1:
                        if other is None and self._free(bins[i], cluster):
                            other = (residual, last, i)
                    elif self._free(bins[i], cluster):
                        return self._pop(residual, last, i), residual
            left >>= 1
            residual += 1
        taken = other or tightest
        return None if taken is None else (self._pop(*taken), taken[0])

    def _pop(self, residual: int, last: int, i: int) -> int:
        groups = self.open[residual]
        bins = groups[last]
        b, bins[i] = bins[i], bins[-1]
        bins.pop()
        if not bins:
            del groups[last]
            if not groups:
                del self.open[residual]
                self.residuals &= ~(1 << residual)
        return b

    def put(self, size: int, cluster: int, source: int) -> int:
        """The number of the container that gets an item."""
        found = self._take(size, cluster, source)
        if found is None:
            b, residual = len(self.clusters), self.capacity
            self.clusters.append(0)
            self.members.append(set())
            self.sources.append(0)
        else:
            b, residual = found
        if cluster >= 0:
            self.clusters[b] |= 1 << (cluster & 63)
            self.members[b].add(cluster)
        if source >= 0:
            self.sources[b] |= 1 << source
        residual -= size
        if residual:
            self.open.setdefault(residual, {}).setdefault(cluster, []).append(b)
            self.residuals |= 1 << residual
        return b


def pack(sizes: np.ndarray, capacity: int, clusters: np.ndarray, sources: np.ndarray) -> np.ndarray:
    """Container of each item (sizes up to the capacity, in decreasing order)."""
    bins = Bins(capacity)
    return np.array([bins.put(int(n), int(c), int(s)) for n, c, s in zip(sizes, clusters, sources)], dtype=np.int64)


def exchanged(sizes: np.ndarray, box: np.ndarray, clusters: np.ndarray, sources: np.ndarray, rounds: int = 3) -> np.ndarray:
    """Containers after exchanges of items of equal size that lessen conflicts, so room stays as it is.

    Each item that shares a container with its cluster or source goes to the place of the first item of its size where it
    is free of both and the exchange saves conflicts (a cluster counts as four sources); rounds end when none is made. Of the items of its size, those
    of another cluster or source are tried, up to TRIES of them: this only bounds how far conflicts are lessened.
    """
    held: tuple[dict, dict] = ({}, {})
    kinds = ((clusters.tolist(), 4), (sources.tolist(), 1))
    for (keys, _), n in zip(kinds, held):
        for b, k in zip(box.tolist(), keys):
            if k >= 0:
                n[b, k] = n.get((b, k), 0) + 1
    same: dict[int, dict[tuple[int, int], list[int]]] = {}
    kind_of = list(zip(clusters.tolist(), sources.tolist()))
    for i, n in enumerate(sizes.tolist()):
        same.setdefault(n, {}).setdefault(kind_of[i], []).append(i)

    def saved(i: int, j: int) -> int:
        a, b = at[i], at[j]
        out = 0
        for (keys, weight), n in zip(kinds, held):
            x, y = keys[i], keys[j]
            if x != y:
                for k, here, there in ((x, a, b), (y, b, a)):
                    if k >= 0:
                        out += weight * ((n[here, k] > 1) - (n.get((there, k), 0) > 0))
        return out

    at = box.tolist()
    for _ in range(rounds):
        moved = False
        for i in range(len(sizes)):
            a = at[i]
            again = [(keys[i], n) for (keys, _), n in zip(kinds, held) if keys[i] >= 0 and n[a, keys[i]] > 1]
            if not again:
                continue
            others = (j for kind, items in same[int(sizes[i])].items() if kind != kind_of[i] for j in items)
            for j in islice(others, TRIES):
                b = at[j]
                if b != a and not any(n.get((b, k), 0) for k, n in again) and saved(i, j) > 0:
                    for (keys, _), n in zip(kinds, held):
                        for k, here, there in ((keys[i], a, b), (keys[j], b, a)):
                            if k >= 0:
                                n[here, k] -= 1
                                n[there, k] = n.get((there, k), 0) + 1
                    at[i], at[j] = b, a
                    moved = True
                    break
        if not moved:
            break
    return np.array(at, dtype=np.int64)


def _pack_shard(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    name, shard, capacity = key[0], int(key[1]), int(key[2])
    pdf = pdf.sort_values("doc_id")
    n, ids = pdf["n_tokens"].to_numpy(), pdf["doc_id"].to_numpy()
    full = n // capacity
    row = np.repeat(np.arange(len(n)), full)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(full) - full, full)
    rest = n - full * capacity
    small = np.flatnonzero(rest)
    small = small[np.lexsort((ids[small], pdf["cluster"].to_numpy()[small], -rest[small]))]
    _, cluster, count = np.unique(pdf["cluster"].to_numpy(), return_inverse=True, return_counts=True)
    cluster = np.where(count[cluster] > 1, cluster, -1)
    known = pdf["source_no"].to_numpy()
    _, source, count = np.unique(known, return_inverse=True, return_counts=True)
    source = np.where((count[source] > 1) & (known != -1), source, -1)
    own = pack(rest[small], capacity, cluster[small], source[small])
    own = exchanged(rest[small], own, cluster[small], source[small])
    row, piece = np.concatenate((row, small)), np.concatenate((piece, full[small]))
    box = np.concatenate((np.arange(len(row) - len(small)), own + len(row) - len(small)))
    start = piece * capacity
    return pd.DataFrame({"config_name": name, "container_id": (shard << 32) + box, "doc_id": ids[row], "piece": piece, "start_token": start, "end_token": np.minimum(start + capacity, n[row])})


def containers(docs: DataFrame, configs: DataFrame, folder: str | None = None, shard: int = SHARD, apart: bool = False) -> DataFrame:
    """config_name, container_id, doc_id, piece, start_token, end_token of every piece of a document.

    docs: doc_id, text, source. configs: config_name, capacity_tokens, a fixed table of a few rows.
    apart: also keep documents of one source apart where a container with room allows it; each source of a shard has a bit.
    """
    cluster = _cluster()
    source = F.when(F.col("source").isNotNull(), F.xxhash64("source")) if apart else F.lit(None).cast("long")
    rows = docs.select("doc_id", "text", cluster.alias("cluster"), F.coalesce(source, F.lit(-1).cast("long")).alias("source_no"))
    sized = stored(counted(rows, folder).where("n_tokens > 0"))
    shards = max(1, -(-sized.count() // shard))
    each = [F.struct(F.lit(r["config_name"]).alias("config_name"), F.lit(int(r["capacity_tokens"])).alias("capacity")) for r in configs.collect() if r["capacity_tokens"] and r["capacity_tokens"] > 0]
    schema = "config_name string, container_id long, doc_id long, piece long, start_token long, end_token long"
    if not each:
        return docs.sparkSession.createDataFrame([], schema)
    items = sized.withColumn("config", F.explode(F.array(*each))).select("doc_id", "n_tokens", "cluster", "source_no", "config.config_name", "config.capacity", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).alias("shard"))
    return items.groupBy("config_name", "shard", "capacity").applyInPandas(_pack_shard, schema)


def _cluster() -> Column:
    """Documents are duplicates if their texts agree but for white space and letter case."""
    return F.xxhash64(F.lower(F.regexp_replace(F.trim("text"), r"\s+", " ")))


def fill(packed: DataFrame, configs: DataFrame, docs: DataFrame) -> DataFrame:
    """Per configuration: containers, tokens, least possible number of containers, share of room used; documents that share a
    container with an earlier one of their source (same_source) or duplicate cluster (same_cluster), and the least such
    numbers that any packing into so many containers has (a source of more documents than containers)."""
    packed = stored(packed)
    per = packed.groupBy("config_name").agg(F.countDistinct("container_id").alias("n_containers"), F.sum(F.col("end_token") - F.col("start_token")).alias("n_tokens"))
    known = docs.select("doc_id", F.col("source").alias("s"), _cluster().alias("c"))
    held = packed.select("config_name", "container_id", "doc_id").distinct().join(known, "doc_id")
    rows = held.select("config_name", "container_id", F.explode(F.array(F.struct(F.lit("s").alias("kind"), F.xxhash64("s").alias("k"), F.col("s").isNull().alias("none")), F.struct(F.lit("c").alias("kind"), F.col("c").alias("k"), F.lit(False).alias("none")))).alias("x"))
    rows = rows.select("config_name", "container_id", "x.*").where("not none")
    shared = rows.groupBy("config_name", "kind", "k", "container_id").agg(F.count("*").alias("n")).groupBy("config_name", "kind", "k").agg(F.sum("n").alias("total"), F.sum(F.col("n") - 1).alias("again"))
    shared = shared.join(per.select("config_name", "n_containers"), "config_name").groupBy("config_name").agg(
        *(F.coalesce(F.sum(F.when(F.col("kind") == k, c)), F.lit(0)).alias(n) for k, n, c in (("s", "same_source", F.col("again")), ("s", "least_same_source", F.greatest(F.lit(0), F.col("total") - F.col("n_containers"))), ("c", "same_cluster", F.col("again")), ("c", "least_same_cluster", F.greatest(F.lit(0), F.col("total") - F.col("n_containers")))))
    )
    out = per.join(configs.select("config_name", "capacity_tokens"), "config_name").join(shared, "config_name", "left")
    count = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select("config_name", "n_containers", "n_tokens", F.ceil(F.col("n_tokens") / F.col("capacity_tokens")).alias("least_containers"), F.round(F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens")), 6).alias("fill"), count("same_source"), count("least_same_source"), count("same_cluster"), count("least_same_cluster"))


def packed_tables(spark, sf_dir: str, folder: str | None = None) -> DataFrame:
    return containers(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pack_configs"), folder, apart=True)
