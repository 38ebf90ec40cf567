"""Exact Jaccard joins of programs over runs of three tokens (problem 5).

Documents with the same set of runs form a class, named by a hash of the set; the join works on
classes, so copies cost nothing. Distances are 1 - similarity, a metric; near is at most EPS.

Regions. Pivot documents, the densest of a bounded sample, create Voronoi regions: a document
within RADIUS of its nearest pivot is at home in that pivot's region and replicated to region k if
``d(k) <= d(nearest) + 2 * EPS`` and ``d(k) <= RADIUS + EPS``; all others are at home in the outer
region, to which documents with ``d(nearest) > RADIUS - EPS`` are replicated. By the triangle
inequality, two near documents share a region.

No distance exceeds 1, so a document that is ``1 - 2 * EPS`` = 0.4 or more from its nearest pivot has
every region in its window: document pivots divide only families around them, and where no family
stands out in the sample, there is no pivot and all documents are in the outer region. Regions are
therefore joined recursively by finer ones, those of singleton sets {s}, which are the pivots that do
the work. Of these, a document is nearest to its own runs, ties in the order rarest first, and its
window are its first ``n - ceil(t*n) + 1`` of them: near documents share the cell of their first common
run. A cell that a count sketch calls crowded is divided again by the next pivot of each window (one
place longer, as two runs must be common). Cells that are still larger than CELL, told by a second
sketch, are cut into blocks, each pair of which meets in a group of its own, so no task holds one.
What meets and passes the size and place bounds is compared exactly.

Defined cases: null texts and texts with fewer than `min_tokens` tokens take no part; equal sources
are near; empty tables give no rows; other columns of the input are not read; thresholds up to 2/3
raise.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import packed, unpacked
from .arrays import BASE, U64, Rolling, chunks, grouped, mix, n_parts, narrowed, stored

WIDTH, SLICES = 1 << 20, 16  # counters of a sketch: 4 MB, whatever the input
CROWDED = 1000  # documents above the sketch's mean, from which a cell is divided
CELL = 50_000  # entries of a cell above the second sketch's mean, from which it is cut into blocks of so many
WORD, SIGN = 1, 2
_KIND = np.zeros(256, dtype=np.uint8)
for _c in b"abcdefghijklmnopqrstuvwxyz0123456789_":
    _KIND[_c] = WORD
for _c in b"=+-*/%<>!&|(){}[].:":
    _KIND[_c] = SIGN
_VALUE = mix(np.arange(1, 257, dtype=U64) * U64(BASE))
CHUNK = 3_000_000


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of each token of the texts."""
    lowered = [t.lower() for t in texts]
    raw = np.frombuffer(("\n".join(lowered) + "\n").encode("ascii", "replace"), dtype=np.uint8)
    off = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in lowered], out=off[1:])
    kind = _KIND[raw]
    word = kind == WORD
    start = kind == SIGN
    start[0] |= word[0]
    start[1:] |= word[1:] & ~word[:-1]
    end = kind == SIGN
    end[:-1] |= word[:-1] & ~word[1:]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return mix(Rolling(_VALUE[raw]).of(s, e)), np.searchsorted(off, s, side="right") - 1


def shingles(texts: list[str], min_tokens: int, k: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(document << 48 | run) of each different run of k tokens, sorted; up to 65536 texts."""
    h, doc = tokens(texts)
    if len(h) < k:
        return np.zeros(0, U64), np.zeros(len(texts), np.int64)
    n = len(h) - k + 1
    x = np.zeros(n, dtype=U64)
    for i in range(k):
        x = x * U64(0xD6E8FEB86659FD93) + h[i : i + n]
    enough = np.bincount(doc, minlength=len(texts)) >= min_tokens
    ok = (doc[:n] == doc[k - 1 :]) & enough[doc[:n]]
    key = np.sort((doc[:n][ok].astype(U64) << U64(48)) | (mix(x[ok]) >> U64(16)))
    if len(key):
        key = key[np.concatenate(([True], key[1:] != key[:-1]))]
    return key, np.bincount((key >> U64(48)).astype(np.int64), minlength=len(texts))


RUN = U64((1 << 48) - 1)


def _sets(pdf: pd.DataFrame, min_tokens: int) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, runs (see shingles), run counts and class of each row, in bounded pieces."""
    pdf = pdf[pdf["text"].notna()].reset_index(drop=True)
    texts = pdf["text"].tolist()
    for s in chunks([len(t) + 50 for t in texts], CHUNK):
        key, n = shingles(texts[s], min_tokens)
        sums = np.zeros(len(key) + 1, dtype=U64)
        np.cumsum(mix((key & RUN) + U64(1)), out=sums[1:])
        at = np.concatenate(([0], np.cumsum(n)))
        yield pdf.iloc[s], key, n, mix(sums[at[1:]] - sums[at[:-1]] + n.astype(U64)).view(np.int64)


def _bucket(run: np.ndarray) -> np.ndarray:
    return (run & U64(WIDTH - 1)).astype(np.int64)


def sketch(docs: DataFrame, min_tokens: int) -> np.ndarray:
    """Counts of runs by WIDTH hash buckets. Every task adds up its own, slices are added by Spark."""
    def count(batches):
        total = np.zeros(WIDTH, dtype=np.int64)
        for pdf in batches:
            for _, key, _, _ in _sets(pdf, min_tokens):
                total += np.bincount(_bucket(key & RUN), minlength=WIDTH)
        if total.any():
            yield _slices(total)

    return _added(docs.select("text").mapInPandas(count, "slice long, n binary"))


def _slices(total: np.ndarray) -> pd.DataFrame:
    small = np.minimum(total, 65535).astype(np.uint16).reshape(SLICES, -1)
    return pd.DataFrame({"slice": np.arange(SLICES), "n": [zlib.compress(packed(x), 1) for x in small]})


def _added(slices: DataFrame) -> np.ndarray:
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(unpacked(zlib.decompress(x), ("<u2",))[0].astype(np.int64) for x in pdf["n"])
        return pd.DataFrame({"slice": pdf["slice"][:1], "n": [np.minimum(total, 2**31 - 1).astype(np.int32).tobytes()]})

    out = np.zeros((SLICES, WIDTH // SLICES), dtype=np.int32)
    for r in slices.groupBy("slice").applyInPandas(add, "slice long, n binary").collect():
        out[r["slice"]] = np.frombuffer(r["n"], np.int32)
    return out.reshape(-1)


def _rank(count: np.ndarray) -> tuple[np.ndarray, int]:
    """A 16-bit rank of each bucket that grows with its count; from the second value on, cells are divided."""
    level = np.minimum(np.log2(count.astype(np.float64) + 1) * 2048, 65535).astype(np.uint16)
    return level, int(min(np.log2(count.mean() + CROWDED + 1) * 2048, 65535))


def _window(n: np.ndarray, threshold: float) -> np.ndarray:
    return n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1


def _entries(key: np.ndarray, n: np.ndarray, level: np.ndarray, crowded: int, threshold: float):
    """Cell, row and place for every pivot in the windows of a piece's rows."""
    run = key & RUN
    order = np.sort((key & ~RUN) | (level[_bucket(run)].astype(U64) << U64(32)) | (mix(run) & U64(0xFFFFFFFF)))
    row = (order >> U64(48)).astype(np.int64)
    at = np.concatenate(([0], np.cumsum(n)))
    place = np.arange(len(order)) - at[row]
    win = _window(n, threshold)
    inside = (place < win[row]) & (n[row] > 2)
    cell, row, place, pos = (order & RUN)[inside], row[inside], place[inside], np.flatnonzero(inside)
    hot = (cell >> U64(32)) > U64(crowded)
    out = [(mix(cell[~hot]), row[~hot], place[~hot])]
    if hot.any():
        c, r, p, q = cell[hot], row[hot], place[hot], pos[hot]
        more = np.minimum(win[r], n[r] - 1) - p  # the second pivot may stand one place behind the window
        first = np.repeat(np.arange(len(c)), more)
        step = np.arange(len(first)) - np.repeat(np.cumsum(more) - more, more) + 1
        second = order[q[first] + step] & RUN
        out.append((mix(mix(c[first]) * U64(BASE) + second), r[first], p[first]))
    return tuple(np.concatenate(x) for x in zip(*out))


SAMPLE, PIVOTS, PIVOT_RUNS = 1000, 32, 2000  # documents sampled, most pivots, most runs of a pivot
PIVOT_CHARS = 20_000  # longest text sampled: the driver holds SAMPLE times that at most
ENTRIES = 1_000_000  # entries of windows that one group of a join holds, on average
RADIUS = 0.5


def choose_pivots(docs: DataFrame, min_tokens: int) -> list[np.ndarray]:
    """Runs of up to PIVOTS documents that have most neighbours within distance 0.6 in a hash sample.

    A pivot must have three or more neighbours in the sample that no earlier pivot has, so
    collections without large families get few or none.
    """
    some = docs.where(F.length("text") <= PIVOT_CHARS).orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("text").collect()
    texts = [r["text"] for r in some]
    key, n = shingles(texts, min_tokens)
    row, run = (key >> U64(48)).astype(np.int64), key & RUN
    ok = (n[row] <= PIVOT_RUNS) & (n[row] > 2)
    _, at, count = np.unique(run[ok], return_inverse=True, return_counts=True)
    often = count[at] > 1
    cols, at2 = np.unique(at[often], return_inverse=True)
    near = np.zeros((len(texts), len(texts)), dtype=np.float32)
    for lo in range(0, len(cols), 4096):  # common runs of all pairs, in blocks of runs
        pick = (at2 >= lo) & (at2 < lo + 4096)
        m = np.zeros((len(texts), 4096), dtype=np.float32)
        m[row[ok][often][pick], at2[pick] - lo] = 1
        near += m @ m.T
    near = near / np.maximum(n[:, None] + n[None, :] - near, 1) >= 0.4
    pivots = []
    while len(pivots) < PIVOTS and len(near):
        degree = near.sum(axis=1)
        best = int(degree.argmax())
        if degree[best] < 4:
            break
        pivots.append(run[row == best])
        gone = near[best].copy()
        near[gone] = False
        near[:, gone] = False
    return pivots


def _regions(key: np.ndarray, n: np.ndarray, pivots: list[np.ndarray], eps: float) -> np.ndarray:
    """Row by region: home and windows; region 0 is the outer one."""
    out = np.zeros((len(n), len(pivots) + 1), dtype=bool)
    out[:, 0] = True
    if not pivots or not len(key):
        return out
    runs = np.unique(np.concatenate(pivots))
    holds = np.zeros(len(runs), dtype=np.uint32)
    for k, p in enumerate(pivots):
        holds[np.searchsorted(runs, p)] |= np.uint32(1 << k)
    run = key & RUN
    at = np.minimum(np.searchsorted(runs, run), len(runs) - 1)
    hit = runs[at] == run
    row, mask = (key[hit] >> U64(48)).astype(np.int64), holds[at[hit]]
    d = np.ones((len(n), len(pivots)))
    for k, p in enumerate(pivots):
        common = np.bincount(row[(mask >> np.uint32(k)) & 1 > 0], minlength=len(n))
        d[:, k] = 1 - common / np.maximum(n + len(p) - common, 1)
    home = d.argmin(axis=1)
    least = d[np.arange(len(n)), home]
    ball = least <= RADIUS
    out[:, 0] = ~ball | (least > RADIUS - eps - 1e-9)
    out[:, 1:] = ball[:, None] & (d <= least[:, None] + 2 * eps + 1e-9) & (d <= RADIUS + eps + 1e-9)
    return out


FLUSH = 1_500_000
_DOC, _ENTRY = ("<u8", "<u4", "<u4", "u1"), ("<u4", "u1")  # class, runs, entries, side; cell, place


def _blocks(cell: np.ndarray, cls: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries by the pairs of blocks of their cells: place in the arrays, and cell. A class is in one block of a cell."""
    k = times[_bucket(mix(cell))]
    if len(k) == 0 or k.max() <= 1:
        return np.arange(len(cell)), cell
    at = np.repeat(np.arange(len(cell)), k)
    own = (mix(cls.view(U64) + U64(5)) % k.astype(U64)).astype(np.int64)[at]
    other = np.arange(len(at)) - np.repeat(np.cumsum(k) - k, k)
    pair = np.minimum(own, other) * 1_000_003 + np.maximum(own, other)
    return at, np.where(k[at] > 1, mix(cell[at] + pair.astype(U64) * U64(BASE)), cell[at])


def windows(docs: DataFrame, count: np.ndarray, cells: np.ndarray, pivots: list[np.ndarray], threshold: float, min_tokens: int, parts: int) -> DataFrame:
    """Binary pieces of classes, each with its entries (cell, place), by partition of the cell. docs: text, side (1, 2 or 3); cells: the sketch of members()."""
    level, crowded = _rank(count)
    times = np.maximum(1, np.ceil((cells - cells.mean()) / CELL)).astype(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((level, pivots, times.astype(np.uint16) if times.max() < 65536 else times))

    most = max(FLUSH, min(4 * parts, 4 * FLUSH))  # larger pieces where there are many partitions

    def pieces(held, known):
        cls = np.fromiter(known, np.int64, len(known)).view(U64)
        n, side = (np.array([v[k] for v in known.values()], dtype=kind) for k, kind in ((1, "<u4"), (2, "u1")))
        order = np.argsort(cls)
        rank = np.empty(len(cls), np.int64)
        rank[order] = np.arange(len(cls))
        cls, n, side = cls[order], n[order], side[order]
        cell, doc, place = (np.concatenate(x) for x in zip(*held))
        part, doc = (cell % U64(parts)).astype(np.int64), rank[doc]
        # within a partition 32 bits tell cells apart: two that are one by chance only add candidates, as do cut places
        cell, place = (mix(cell) >> U64(32)).astype("<u4"), np.minimum(place, 255).astype("u1")
        by = np.lexsort((doc, part))
        part, doc, cell, place = part[by], doc[by], cell[by], place[by]
        first = np.flatnonzero(np.diff(part, prepend=-1))
        rows = []
        for a, b in zip(first, np.append(first[1:], len(by))):
            own, each = np.unique(doc[a:b], return_counts=True)
            rows.append((int(part[a]), packed(cls[own], n[own], each.astype("<u4"), side[own]), packed(cell[a:b], place[a:b])))
        return pd.DataFrame(rows, columns=["part", "docs", "entries"])

    def run(batches):
        level, pivots, times = shared.value
        held, known, size = [], {}, 0
        for pdf in batches:
            for rows, key, n, cls in _sets(pdf, min_tokens):
                side = rows["side"].to_numpy()
                new = np.zeros(len(n), dtype=bool)
                number = np.zeros(len(n), dtype=np.int64)
                for i in np.flatnonzero(n):
                    c = int(cls[i])
                    if c in known:
                        k = known[c]
                        known[c] = (k[0], k[1], k[2] | int(side[i]))
                    else:
                        new[i], number[i] = True, len(known)
                        known[c] = (len(known), int(n[i]), int(side[i]))
                keep = new[(key >> U64(48)).astype(np.int64)]
                n = np.where(new, n, 0)
                cell, row, place = _entries(key[keep], n, level, crowded, threshold)
                at, cell = _blocks(cell, cls[row], times.astype(np.int64))
                row, place = row[at], place[at]
                region = _regions(key[keep], n, pivots, 1 - threshold)
                for r in np.flatnonzero(region.any(axis=0)):
                    own = region[row, r]
                    held.append((mix(cell[own] + U64(r)), number[row[own]], place[own]))
                    size += int(own.sum())
                if size > most:
                    yield pieces(held, known)
                    held, known, size = [], {}, 0
        if size:
            yield pieces(held, known)

    return docs.select("text", "side").mapInPandas(run, "part long, docs binary, entries binary")


def _meet(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Pairs of classes that meet in a cell of this partition and pass the bounds, each once."""
    known, n, each, sides = (np.concatenate(x) for x in zip(*(unpacked(d, _DOC) for d in pdf["docs"])))
    cell, place = (np.concatenate(x) for x in zip(*(unpacked(e, _ENTRY) for e in pdf["entries"])))
    cls, at = np.unique(known.view(np.int64), return_inverse=True)
    size, side = np.zeros(len(cls), np.int64), np.zeros(len(cls), np.uint8)
    size[at] = n
    np.bitwise_or.at(side, at, sides)
    doc = np.repeat(at, each)
    by = np.argsort(cell, kind="stable")
    cell, doc, place = cell[by], doc[by], place[by].astype(np.int64)
    alone = np.ones(len(cell), dtype=bool)
    if len(cell):
        same = cell[1:] == cell[:-1]
        alone[1:] &= ~same
        alone[:-1] &= ~same
    cell, doc, place = cell[~alone], doc[~alone], place[~alone]
    by = np.lexsort((doc, size[doc], cell))
    cell, doc, place = cell[by], doc[by], place[by]
    pairs = np.zeros((0, 2), np.int64)
    held, total = [], 0
    left, step = np.arange(len(cell)), 1
    while len(left):
        left = left[left + step < len(cell)]
        right = left + step
        go = cell[left] == cell[right]
        go &= size[doc[left]] >= threshold * size[doc[right]] - 1e-9  # sizes grow in a cell: none further passes
        left, right = left[go], right[go]
        a, b = doc[left], doc[right]
        need = np.ceil(threshold / (1 + threshold) * (size[a] + size[b]) - 1e-9)
        most = 1 + np.minimum(size[a] - place[left], size[b] - place[right]) - 1
        ok = (a != b) & (most >= need) & (((side[a] & 1) & (side[b] >> 1)) | ((side[b] & 1) & (side[a] >> 1))).astype(bool)
        held.append(np.stack([np.minimum(a, b)[ok], np.maximum(a, b)[ok]], axis=1))
        total += len(held[-1])
        if total > 4_000_000:
            pairs, held, total = np.unique(np.concatenate([pairs, *held]), axis=0), [], 0
        step += 1
    if held:
        pairs = np.concatenate([pairs, *held])
    if len(pairs):
        one = np.unique(pairs[:, 0] * len(cls) + pairs[:, 1])
        pairs = np.stack([one // len(cls), one % len(cls)], axis=1)
    return pd.DataFrame({"a": cls[pairs[:, 0]], "b": cls[pairs[:, 1]]})


def members(docs: DataFrame, count: np.ndarray, threshold: float, min_tokens: int) -> tuple[DataFrame, np.ndarray]:
    """id, class, number of runs and side of every document that takes part (stored), and a sketch of the entries of cells."""
    level, crowded = _rank(count)
    shared = docs.sparkSession.sparkContext.broadcast(level)

    def run(batches):
        total = np.zeros(WIDTH, dtype=np.int64)
        for pdf in batches:
            for rows, key, n, cls in _sets(pdf, min_tokens):
                _, first = np.unique(cls, return_index=True)
                new = np.zeros(len(n), dtype=bool)
                new[first] = n[first] > 0
                keep = new[(key >> U64(48)).astype(np.int64)]
                total += np.bincount(_bucket(mix(_entries(key[keep], np.where(new, n, 0), shared.value, crowded, threshold)[0])), minlength=WIDTH)
                yield pd.DataFrame({"id": rows["id"].to_numpy(), "cls": cls, "n": n, "side": rows["side"].to_numpy(), "slice": -1, "counts": None})[n > 0]
        if total.any():
            s = _slices(total)
            yield pd.DataFrame({"id": 0, "cls": 0, "n": 0, "side": 0, "slice": s["slice"], "counts": s["n"]})

    rows = stored(docs.select("id", "text", "side").mapInPandas(run, "id long, cls long, n long, side int, slice long, counts binary"))
    return rows.where("slice < 0").select("id", "cls", "n", "side"), _added(rows.where("slice >= 0").select("slice", F.col("counts").alias("n")))


def compared(batches, min_tokens: int, keep):
    """Common runs and runs of the two texts of each row that keep(both, na, nb) lets pass."""
    for pdf in batches:
        for s in chunks((pdf["ta"].str.len() + pdf["tb"].str.len() + 100).tolist(), CHUNK):
            part = pdf.iloc[s]
            texts = part["ta"].tolist() + part["tb"].tolist()
            m = len(part)
            for lo in range(0, m, 30000):
                hi = min(m, lo + 30000)
                key, n = shingles(texts[lo:hi] + texts[m + lo : m + hi], min_tokens)
                row = (key >> U64(48)).astype(np.int64) % (hi - lo)
                k = np.sort((row.astype(U64) << U64(48)) | (key & RUN))
                both = np.bincount((k[1:][k[1:] == k[:-1]] >> U64(48)).astype(np.int64), minlength=hi - lo)
                na, nb = n[: hi - lo], n[hi - lo :]
                ok = keep(both, na, nb)
                yield pd.DataFrame({"a": part["a"].to_numpy()[lo:hi], "b": part["b"].to_numpy()[lo:hi], "both": both, "na": na, "nb": nb})[ok]


def verified(met: DataFrame, text: DataFrame, min_tokens: int, keep) -> DataFrame:
    """a, b, both, na, nb of the pairs (a, b, ida, idb; stored) whose texts (id, text) pass; only texts of pairs are shuffled."""
    text = narrowed(text, met.select(F.explode(F.array("ida", "idb")).alias("id")))
    full = met.join(text.select(F.col("id").alias("ida"), F.col("text").alias("ta")), "ida").join(text.select(F.col("id").alias("idb"), F.col("text").alias("tb")), "idb")
    return full.select("a", "b", "ta", "tb").mapInPandas(lambda it: compared(it, min_tokens, keep), "a long, b long, both long, na long, nb long")


def near_classes(docs: DataFrame, threshold: float = 0.7, min_tokens: int = 20) -> tuple[DataFrame, DataFrame]:
    """(members, pairs of near classes with their common runs).

    docs: id (unique, long), text, side (1: may stand left, 2: right, 3: both of a pair). pairs:
    a, b (classes), both, na, nb (common runs and runs of each). members is stored.
    """
    if threshold <= 2 / 3:
        raise ValueError("the windows need a threshold above 2/3")
    spark = docs.sparkSession
    parts = n_parts(spark)
    count = sketch(docs, min_tokens)
    parts = max(parts, int(count.sum(dtype=np.int64) * (1 - threshold)) // ENTRIES)
    who, cells = members(docs, count, threshold, min_tokens)
    pieces = windows(docs, count, cells, choose_pivots(docs, min_tokens), threshold, min_tokens, parts)
    met = grouped(pieces, parts).applyInPandas(lambda p: _meet(p, threshold), "a long, b long").distinct()
    first = who.groupBy("cls").agg(F.min("id").alias("id"))
    text = docs.select("id", "text")
    met = stored(met.join(first.select(F.col("cls").alias("a"), F.col("id").alias("ida")), "a").join(first.select(F.col("cls").alias("b"), F.col("id").alias("idb")), "b"))
    return who, verified(met, text, min_tokens, lambda both, na, nb: both >= threshold * (na + nb - both) - 1e-9)


def near_pairs(docs: DataFrame, threshold: float = 0.7, min_tokens: int = 20) -> DataFrame:
    """lo_id, hi_id of all near documents; equal ones count too."""
    who, pairs = near_classes(docs.select("id", "text", F.lit(3).alias("side")), threshold, min_tokens)
    m = who.select("cls", "id")
    x = m.select(F.col("cls").alias("a"), F.col("id").alias("x"))
    y = m.select(F.col("cls").alias("b"), F.col("id").alias("y"))
    across = pairs.select("a", "b").join(x, "a").join(y, "b").select(F.least("x", "y").alias("lo_id"), F.greatest("x", "y").alias("hi_id"))
    inside = x.join(y, F.col("a") == F.col("b")).where("x < y").select(F.col("x").alias("lo_id"), F.col("y").alias("hi_id"))
    return across.unionByName(inside)
