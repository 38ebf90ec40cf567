"""Records of evaluation splits that stand in the train split too (problem 1).

Hashes of runs of three tokens of the evaluation records are partitioned, train records are scanned
for hits, and the containment of each evaluation record in each train record is computed. Records
with the same set of runs form a class; classes are compared, and links are counted by class.

An evaluation record of n runs of which a train record holds at least ``ceil(c * n)`` shares one of
its first ``n - ceil(c * n) + 1`` runs with it, rarest first; these are indexed. Train records are
scanned with all of their runs, long ones too; a filter of at most 64 MB, broadcast, tells which of
them stand in the index (beyond its size more runs pass, none is lost). Where index and scan meet,
places in the order bound what two records can share, and the pairs left are compared exactly. Cells
of common runs are divided on both sides (see CELL), so no task holds a hot run.

Defined cases: a null or unknown split belongs to no side; null texts and texts without tokens can
only overlap by task_id; texts with fewer than `min_tokens` tokens overlap if their tokens are equal,
one by one (but never in p1_found, where they are no case); two task_ids name one version only if
both name it; repeated rows are rows of one class; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import nearjoin as N
from .arrays import BASE, U64, bit_slice, grouped, has_bits, mix, n_parts, slice_bits, stored
from .tasks import named_tasks

TRAIN, EVAL = 1, 2
CELL = 250_000  # entries of one run that a task holds, about
_ENTRY = np.dtype([("cell", "<u8"), ("doc", "<u4"), ("place", "<u4")])
_DOC = np.dtype([("cls", "<i8"), ("n", "<u4")])
_MEMBER = np.dtype([("id", "<i8"), ("cls", "<i8"), ("n", "<u4")])
PIECES = "part long, side int, docs binary, entries binary"
FLUSH = 1_500_000
PAIRS = 2_000_000  # pairs that are tested at once


def _sides(programs: DataFrame) -> DataFrame:
    side = F.when(F.col("split") == "train", TRAIN).when(F.col("split").isin("validation", "test"), EVAL)
    return programs.select(F.col("rec_id").alias("id"), F.col("tk_source").alias("text"), "task_id", side.alias("side")).where("side is not null")


def _part(cell: np.ndarray, parts: int, i: np.ndarray | int = 0, j: np.ndarray | int = 0) -> np.ndarray:
    """Partition of a cell or of a division (i, j) of it."""
    return (mix(cell + np.asarray(i).astype(U64) * U64(BASE) + np.asarray(j).astype(U64) * U64(0xD6E8FEB86659FD93)) % U64(parts)).astype(np.int64)


def _packed(side: int, part: np.ndarray, parts: int, docs: np.ndarray, entries: np.ndarray) -> pd.DataFrame:
    """One row for each partition that gets entries (their doc counts in docs)."""
    by = np.argsort(part, kind="stable")
    ends = np.append(np.flatnonzero(np.diff(part[by])) + 1, len(by))
    rows, a = [], 0
    for b in ends:
        if b > a:
            e = entries[by[a:b]]
            own, e["doc"] = np.unique(e["doc"], return_inverse=True)
            rows.append((int(part[by[a]]), side, docs[own].tobytes(), e.tobytes()))
        a = b
    return pd.DataFrame(rows, columns=["part", "side", "docs", "entries"])


def _short(texts: list[str]) -> np.ndarray:
    """Class of the token sequence of each text; 0 for one without tokens."""
    h, doc = N.tokens(texts) if texts else (np.zeros(0, U64), np.zeros(0, np.int64))
    sums = np.zeros(len(texts), dtype=U64)
    first = np.searchsorted(doc, np.arange(len(texts)))
    np.add.at(sums, doc, mix(h + (np.arange(len(h)) - first[doc]).astype(U64) * U64(BASE)))
    return np.where(np.bincount(doc, minlength=len(texts)) > 0, mix(sums + U64(0x5EED)), U64(0)).view(np.int64)


def _scanned(rows: pd.DataFrame, min_tokens: int, level: np.ndarray):
    """Per bounded piece: members, and of each new class its runs (cell, row, place, n, cls), rarest first."""
    for part, key, n, cls in N._sets(rows, min_tokens):
        few = np.flatnonzero(n == 0)
        cls = cls.copy()
        cls[few] = _short([part["text"].iloc[i] for i in few])
        who = np.zeros(len(n), dtype=_MEMBER)
        who["id"], who["cls"], who["n"] = part["id"].to_numpy(), cls, n
        run = key & N.RUN
        cell = (level[N._bucket(run)].astype(U64) << U64(48)) | run
        row = (key >> U64(48)).astype(np.int64)
        # level and 32 mixed bits order the runs; the sort is stable, so equal ones stay in the order of the run
        by = np.argsort((row.astype(U64) << U64(48)) | ((cell >> U64(48)) << U64(32)) | (mix(run) & U64(0xFFFFFFFF)), kind="stable")
        at = np.cumsum(n) - n
        yield who[(n > 0) | (cls != 0)], cell[by], row, np.arange(len(row)) - at[row], n, cls


def _run_side(docs: DataFrame, side: int, min_tokens: int, parts: int, level, pick) -> DataFrame:
    """Members (part -1) and entries of one side; pick(cell, place, n, cls) gives the entries sent: places in the
    arrays, division, and its cell's partition."""

    def run(batches):
        held, docs_, known, size, members = [], [], set(), 0, []

        def flush():
            e, d, p = np.concatenate([x[0] for x in held]), np.concatenate(docs_), np.concatenate([x[1] for x in held])
            return _packed(side, p, parts, d, e)

        for pdf in batches:
            for who, cell, row, place, n, cls in _scanned(pdf, min_tokens, level.value):
                members.append(who)
                new = np.zeros(len(n), dtype=bool)
                for i in np.flatnonzero(n):
                    if (c := int(cls[i])) not in known:
                        known.add(c)
                        new[i] = True
                ok = np.flatnonzero(new[row])
                at, part = pick(cell[ok], place[ok], n[row[ok]], cls[row[ok]])
                at = ok[at]
                e = np.zeros(len(at), dtype=_ENTRY)
                e["cell"], e["doc"], e["place"] = cell[at], row[at] + sum(map(len, docs_)), place[at]
                d = np.zeros(len(n), dtype=_DOC)
                d["cls"], d["n"] = cls, n
                held.append((e, part))
                docs_.append(d)
                size += len(e) + len(d)
                if size > FLUSH:
                    yield flush()
                    held, docs_, known, size = [], [], set(), 0
            if members and sum(map(len, members)) > 100_000:
                yield pd.DataFrame({"part": [-1], "side": [side], "docs": [np.concatenate(members).tobytes()], "entries": [b""]})
                members = []
        if held:
            yield flush()
        if members:
            yield pd.DataFrame({"part": [-1], "side": [side], "docs": [np.concatenate(members).tobytes()], "entries": [b""]})

    return docs.where(F.col("side") == side).select("id", "text").mapInPandas(run, PIECES)


def _members(pieces: DataFrame) -> DataFrame:
    def run(batches):
        for pdf in batches:
            for side, b in zip(pdf["side"], pdf["docs"]):
                m = np.frombuffer(b, _MEMBER)
                yield pd.DataFrame({"id": m["id"], "cls": m["cls"], "n": m["n"].astype(np.int64), "side": side})

    return pieces.where("part = -1").select("side", "docs").mapInPandas(run, "id long, cls long, n long, side int")


def _index(pieces: DataFrame, parts: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Filter of the index, and the cells that hold more than CELL entries of it, with their divisions.

    Cells are counted in each piece first, so a hot one is a row for each piece.
    """

    def cells(batches):
        for pdf in batches:
            for p, b in zip(pdf["part"], pdf["entries"]):
                c, n = np.unique(np.frombuffer(b, _ENTRY)["cell"], return_counts=True)
                yield pd.DataFrame({"part": [p], "cells": [c.tobytes()], "n": [n.astype(np.int64).tobytes()]})

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        c = np.concatenate([np.frombuffer(b, U64) for b in pdf["cells"]])
        n = np.concatenate([np.frombuffer(b, np.int64) for b in pdf["n"]])
        c, at = np.unique(c, return_inverse=True)
        total = np.bincount(at, n).astype(np.int64)
        hot = total > CELL
        return pd.DataFrame({"part": pdf["part"][:1], "bits": [bit_slice(mix(c) // U64(parts), bits)], "hot": [c[hot].tobytes()], "n": [total[hot].tobytes()]})

    got = pieces.where("part >= 0").select("part", "entries").mapInPandas(cells, "part long, cells binary, n binary").groupBy("part").applyInPandas(one, "part long, bits binary, hot binary, n binary").collect()
    filters = np.zeros((parts, bits // 8), dtype=np.uint8)
    for r in got:
        filters[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    hot = np.concatenate([np.zeros(0, U64), *(np.frombuffer(r["hot"], U64) for r in got)])
    n = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(r["n"], np.int64) for r in got)])
    by = np.argsort(hot)
    return filters, hot[by], -(-n[by] // CELL)


def _divisions(cell: np.ndarray, hot: np.ndarray, times: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.ones(len(cell), dtype=np.int64)
    at = np.minimum(np.searchsorted(hot, cell), len(hot) - 1)
    return np.where(hot[at] == cell, times[at], 1)


def _copied(own: np.ndarray, other: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entry, its own division (by its class) and each division of the other side."""
    first = np.repeat(np.arange(len(own)), other)
    return first, (mix(cls.view(U64)) % own.astype(U64)).astype(np.int64)[first], np.arange(len(first)) - np.repeat(np.cumsum(other) - other, other)


def _spread(pieces: DataFrame, parts: int, shared) -> DataFrame:
    """Entries of the index by the divisions of their cells."""

    def run(batches):
        for pdf in batches:
            division, hot, times = shared.value[1:]
            for d, b in zip(pdf["docs"], pdf["entries"]):
                docs, e = np.frombuffer(d, _DOC), np.frombuffer(b, _ENTRY)
                first, i, j = _copied(_divisions(e["cell"], hot, times), division[(e["cell"] >> U64(48)).astype(np.int64)], docs["cls"][e["doc"]])
                yield _packed(EVAL, _part(e["cell"][first], parts, i, j), parts, docs, e[first])

    return pieces.where("part >= 0").select("docs", "entries").mapInPandas(run, PIECES)


def _meet(pdf: pd.DataFrame, containment: float, similarity: float) -> pd.DataFrame:
    """a (train class), b (evaluation class) that meet in a cell and pass the bounds."""
    got = {}
    for side in (TRAIN, EVAL):
        rows = pdf[pdf["side"] == side]
        if not len(rows):
            return pd.DataFrame({"a": [], "b": []})
        docs = [np.frombuffer(b, _DOC) for b in rows["docs"]]
        entries = [np.frombuffer(b, _ENTRY) for b in rows["entries"]]
        base = np.cumsum([0, *map(len, docs)])
        doc = np.concatenate([e["doc"].astype(np.int64) + b for e, b in zip(entries, base)])
        docs, e = np.concatenate(docs), np.concatenate(entries)
        by = np.argsort(e["cell"], kind="stable")
        got[side] = docs["cls"][doc[by]], docs["n"][doc[by]].astype(np.int64), e["place"][by].astype(np.int64), e["cell"][by]
    (tc, tn, tp, tcell), (ec, en, ep, ecell) = got[TRAIN], got[EVAL]
    need = np.ceil(containment * en - 1e-9).astype(np.int64)
    lo, hi = np.searchsorted(tcell, ecell, "left"), np.searchsorted(tcell, ecell, "right")
    live = np.flatnonzero(hi > lo)
    total = np.concatenate(([0], np.cumsum((hi - lo)[live])))
    pairs, at = np.zeros(0, dtype=[("a", "<i8"), ("b", "<i8")]), 0
    while at < len(live):
        to = max(at + 1, int(np.searchsorted(total, total[at] + PAIRS, "right")) - 1)
        e = live[at:to]
        n = (hi - lo)[e]
        x = np.repeat(e, n)
        t = np.repeat(lo[e], n) + np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n)
        most = 1 + np.minimum(en[x] - ep[x], tn[t] - tp[t]) - 1
        ok = (most >= need[x]) & (ec[x] != tc[t])
        if similarity:
            ok &= most >= np.ceil(similarity / (1 + similarity) * (en[x] + tn[t]) - 1e-9)
        new = np.zeros(int(ok.sum()), dtype=pairs.dtype)
        new["a"], new["b"] = tc[t[ok]], ec[x[ok]]
        pairs = np.unique(np.concatenate([pairs, new]))
        at = to
    return pd.DataFrame({"a": pairs["a"], "b": pairs["b"]})


def contained(docs: DataFrame, containment: float = 0.7, min_tokens: int = 20, similarity: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """(members, pairs) of docs: id (unique, long), text, side (TRAIN or EVAL).

    members (stored): id, cls, n (runs; 0 for short texts, which only meet in their class), side.
    pairs: a (train class), b (other evaluation class), both, na, nb (runs) with containment both / nb
    and, where asked for, similarity both / (na + nb - both) of at least the thresholds.
    """
    spark = docs.sparkSession
    count = N.sketch(docs, min_tokens)
    level, _ = N._rank(count)
    runs = int(count.sum(dtype=np.int64))
    parts = max(n_parts(spark), int(runs * (1 - containment)) // N.ENTRIES)
    ranks = spark.sparkContext.broadcast(level)

    def prefix(cell, place, n, cls):
        at = np.flatnonzero(place < N._window(n, containment))
        return at, _part(cell[at], parts)

    held = stored(_run_side(docs, EVAL, min_tokens, parts, ranks, prefix))
    entries = held.where("part >= 0").agg(F.sum(F.length("entries"))).first()[0] or 0
    filters, hot, times = _index(held, parts, slice_bits(entries // _ENTRY.itemsize, parts))
    often = np.exp2(np.arange(65536) / 2048) - 1 - count.mean()  # entries of a level's runs above what others in its bucket have
    division = np.maximum(np.ceil(often / CELL), 1).astype(np.int64)
    shared = spark.sparkContext.broadcast((filters, division, hot, times))

    def hits(cell, place, n, cls):
        filters, division, hot, times = shared.value
        at = np.flatnonzero(has_bits(filters, _part(cell, parts), mix(cell) // U64(parts)))
        c = cell[at]
        first, j, i = _copied(division[(c >> U64(48)).astype(np.int64)], _divisions(c, hot, times), cls[at])
        return at[first], _part(c[first], parts, i, j)

    scan = stored(_run_side(docs, TRAIN, min_tokens, parts, ranks, hits))
    both = _spread(held, parts, shared).unionByName(scan.where("part >= 0"))
    met = grouped(both, parts).applyInPandas(lambda p: _meet(p, containment, similarity), "a long, b long").distinct()
    who = _members(held).unionByName(_members(scan))
    first = who.groupBy("cls").agg(F.min("id").alias("id"))
    met = stored(met.join(first.select(F.col("cls").alias("a"), F.col("id").alias("ida")), "a").join(first.select(F.col("cls").alias("b"), F.col("id").alias("idb")), "b"))

    def keep(both, na, nb):
        return (both >= containment * nb - 1e-9) & (both >= similarity * (na + nb - both) - 1e-9)

    return who, N.verified(met, docs.select("id", "text"), min_tokens, keep)


def _versions(programs: DataFrame) -> DataFrame:
    """id, side, task, version of records whose task_id names one task and a version of it, and no other."""
    one = _sides(programs).select("id", "side", F.array_distinct(named_tasks(F.col("task_id"))).alias("t")).where("size(t) = 1")
    return one.select("id", "side", F.get("t", F.lit(0))["task"].alias("task"), F.get("t", F.lit(0))["version"].alias("version")).where("version <> ''")


def found(programs: DataFrame, threshold: float = 0.7, min_tokens: int = 20) -> DataFrame:
    """lo_id, hi_id of records of the two sides that are near or name one version of one task."""
    who, pairs = contained(_sides(programs), threshold, min_tokens, threshold)
    who = who.where("n > 0")
    x = who.where(f"side = {TRAIN}").select(F.col("cls").alias("a"), F.col("id").alias("x"))
    y = who.where(f"side = {EVAL}").select(F.col("cls").alias("b"), F.col("id").alias("y"))
    v = _versions(programs)
    tx, ty = (v.where(f"side = {s}").select("task", "version", F.col("id").alias(c)) for s, c in ((TRAIN, "x"), (EVAL, "y")))
    rows = pairs.select("a", "b").join(x, "a").join(y, "b").select("x", "y")
    rows = rows.unionByName(x.join(y, x["a"] == y["b"]).select("x", "y")).unionByName(tx.join(ty, ["task", "version"]).select("x", "y"))
    return rows.select(F.least("x", "y").alias("lo_id"), F.greatest("x", "y").alias("hi_id")).distinct()


def classes(programs: DataFrame, threshold: float = 0.7, min_tokens: int = 20) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): rec_id, side, class_id, n_runs of every record with tokens, and class pairs (eval_class,
    train_class, shared, containment, similarity) of different classes. A class is named by its smallest rec_id."""
    who, pairs = contained(_sides(programs), threshold, min_tokens)
    pairs = stored(pairs)
    name = who.groupBy("cls").agg(F.min("id").alias("class_id"))
    members = who.join(name, "cls").select(F.col("id").alias("rec_id"), F.when(F.col("side") == TRAIN, "train").otherwise("evaluation").alias("side"), "class_id", F.col("n").alias("n_runs"))
    a, b = name.select(F.col("cls").alias("a"), F.col("class_id").alias("train_class")), name.select(F.col("cls").alias("b"), F.col("class_id").alias("eval_class"))
    named = pairs.join(a, "a").join(b, "b").select("eval_class", "train_class", F.col("both").alias("shared"), F.round(F.col("both") / F.col("nb"), 6).alias("containment"), F.round(F.col("both") / (F.col("na") + F.col("nb") - F.col("both")), 6).alias("similarity"))
    return members, named


def links(programs: DataFrame, threshold: float = 0.7, min_tokens: int = 20) -> DataFrame:
    """A row for every record of an evaluation split: rec_id, split, source_name, class_id (null without tokens), n_equal
    (train records of its class), n_containing (other train records that hold it to the threshold or more), n_task
    (train records of its task and version), containment (the highest; null if no train record holds it)."""
    members, pairs = classes(programs, threshold, min_tokens)
    members = stored(members)
    train = members.where("side = 'train'").groupBy("class_id").agg(F.count("*").alias("n_equal"))
    per = pairs.join(train.select(F.col("class_id").alias("train_class"), F.col("n_equal").alias("m")), "train_class").groupBy(F.col("eval_class").alias("class_id")).agg(F.sum("m").alias("n_containing"), F.max("containment").alias("best"))
    v = _versions(programs)
    tasks = v.where(f"side = {TRAIN}").groupBy("task", "version").agg(F.count("*").alias("n_task"))
    task = v.where(f"side = {EVAL}").join(tasks, ["task", "version"]).select(F.col("id").alias("rec_id"), "n_task")
    rows = programs.select("rec_id", "split", "source_name").where(F.col("split").isin("validation", "test"))
    out = rows.join(members.where("side = 'evaluation'").select("rec_id", "class_id"), "rec_id", "left").join(train, "class_id", "left").join(per, "class_id", "left").join(task, "rec_id", "left")
    count = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select("rec_id", "split", "source_name", "class_id", count("n_equal"), count("n_containing"), count("n_task"), F.when(F.col("n_equal") > 0, 1.0).otherwise(F.col("best")).alias("containment"))


def report(programs: DataFrame) -> DataFrame:
    """Per split and source of the evaluation records: records, those with a link (overlapping, by_text, by_task), links by
    text and by task, mean of the highest containments."""
    per = links(programs).withColumn("text_links", F.col("n_equal") + F.col("n_containing"))
    return per.groupBy("split", "source_name").agg(
        F.count("*").alias("records"),
        F.count_if((F.col("text_links") > 0) | (F.col("n_task") > 0)).alias("overlapping"),
        F.count_if(F.col("text_links") > 0).alias("by_text"),
        F.count_if(F.col("n_task") > 0).alias("by_task"),
        F.sum("text_links").alias("text_links"),
        F.sum("n_task").alias("task_links"),
        F.round(F.avg("containment"), 6).alias("mean_containment"),
    )
