"""Byte-pair encoding of whole texts with a public tokenizer's vocabulary (problem 6).

Words (of the tokenizer's split pattern) are encoded once each: words of one length class are rows
of a padded matrix of token ids. Each round every row merges its leftmost pair of least rank, ranks
coming from a hash table of pairs; rows close up over the gap, finished rows leave the matrix.

Defined cases: null and empty texts give an empty list; every text is encoded whole, words of any
length included; strings of special tokens are ordinary text.
"""

from __future__ import annotations

import heapq
import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

TOKENIZERS = "/opt/tokenizers"
NONE = np.int32(2**31 - 1)
LONG = 1024  # bytes; longer words are merged one by one with a heap
KEPT = 400_000  # words whose ids a process keeps
# Fixed value: the split pattern of this vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_signs() -> dict[str, int]:
    """The printable sign that the vocabulary file writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Encoder:
    """A byte-level vocabulary with a hash table of its merges."""

    def __init__(self, path: str):
        model = json.load(open(path, encoding="utf-8"))["model"]
        vocab, merges = model["vocab"], model["merges"]
        self.byte = np.zeros(256, dtype=np.int32)
        for sign, b in _byte_signs().items():
            self.byte[b] = vocab[sign]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        self.to = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        self.bits = 19
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << self.bits, NONE, dtype=np.int32)
        self.probes = 1
        todo, key = np.arange(len(left)), (left << 32) | right
        slot = self._slot(key)
        while len(todo):  # linear probing, all open keys at once
            free = self.keys[slot] == -1
            one, at = np.unique(slot[free], return_index=True)
            put = np.flatnonzero(free)[at]
            self.keys[one], self.ranks[one] = key[todo[put]], todo[put]
            rest = np.ones(len(todo), dtype=bool)
            rest[put] = False
            todo, slot = todo[rest], (slot[rest] + 1) & (len(self.keys) - 1)
            self.probes += 1
        self.merge = {int(k): (int(r), int(self.to[r])) for k, r in zip(self.keys, self.ranks) if k >= 0}
        self.split = regex.compile(PATTERN).findall
        self.known: dict[str, np.ndarray] = {}

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, NONE where there is none."""
        key = (a.astype(np.int64) << 32) | b.astype(np.int64)
        slot, out = self._slot(key), np.full(key.shape, NONE, dtype=np.int32)
        open_ = np.flatnonzero((a >= 0) & (b >= 0))
        key, slot = key[open_], slot[open_]
        while len(open_):
            found = self.keys[slot]
            hit = found == key
            out[open_[hit]] = self.ranks[slot[hit]]
            go = ~hit & (found != -1)
            open_, key, slot = open_[go], key[go], (slot[go] + 1) & (len(self.keys) - 1)
        return out

    def _rows(self, m: np.ndarray) -> list[np.ndarray]:
        """Ids of every row of a matrix of bytes' ids, padded with -1."""
        out: list[np.ndarray] = [None] * len(m)  # type: ignore[list-item]
        rows, (n, width) = np.arange(len(m)), m.shape
        r = self.rank(m[:, :-1].ravel(), m[:, 1:].ravel()).reshape(n, width - 1)
        place = np.arange(width - 1)
        while len(rows):
            j = r.argmin(axis=1)
            i = np.arange(len(rows))
            best = r[i, j]
            done = best == NONE
            if done.any():
                for k in np.flatnonzero(done):
                    out[rows[k]] = m[k][m[k] >= 0]
                go = ~done
                rows, m, r, j, best = rows[go], m[go], r[go], j[go], best[go]
                if not len(rows):
                    break
                used = int((m >= 0).sum(axis=1).max())
                if used < m.shape[1] // 2 and used > 1:
                    m, r, place = m[:, :used], r[:, : used - 1], place[: used - 1]
                i = np.arange(len(rows))
            m[i, j] = self.to[best]
            shift = place[None, :] > j[:, None]  # what stands behind the pair moves up
            nm = m.copy()
            nm[:, 1:-1] = np.where(shift[:, :-1] | (place[None, :-1] >= j[:, None]), m[:, 2:], m[:, 1:-1])
            nm[:, -1] = -1
            at_end = j == m.shape[1] - 2
            nm[at_end, :-1] = m[at_end, :-1]
            nr = r.copy()
            nr[:, :-1] = np.where(place[None, :-1] >= j[:, None], r[:, 1:], r[:, :-1])
            nr[:, -1] = NONE
            m, r = nm, nr
            right = np.minimum(j + 1, m.shape[1] - 1)
            nxt = np.where(j + 1 < m.shape[1], m[i, right], -1)
            inner = j < r.shape[1]
            r[i[inner], j[inner]] = self.rank(m[i, j], nxt)[inner]
            prev = j > 0
            r[i[prev], j[prev] - 1] = self.rank(m[i[prev], j[prev] - 1], m[i[prev], j[prev]])
        return out

    def _one(self, ids: list[int]) -> np.ndarray:
        """The same by a heap of pairs, for a very long word."""
        n = len(ids)
        nxt, prv, live = [*range(1, n), -1], [*range(-1, n - 1)], [True] * n
        heap = []

        def push(i):
            k = nxt[i]
            if k >= 0 and (x := self.merge.get((ids[i] << 32) | ids[k])):
                heapq.heappush(heap, (x[0], i, ids[i], ids[k]))

        for i in range(n - 1):
            push(i)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            k = nxt[i]
            if not live[i] or k < 0 or ids[i] != a or ids[k] != b:
                continue
            ids[i], live[k], nxt[i] = int(self.to[r]), False, nxt[k]
            if nxt[k] >= 0:
                prv[nxt[k]] = i
            push(i)
            if prv[i] >= 0:
                push(prv[i])
        return np.array([x for x, ok in zip(ids, live) if ok], dtype=np.int32)

    def words(self, words: list[str]) -> None:
        """Puts the ids of all words into known."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        size = np.array([len(x) for x in raw])
        low = 0
        for high in (1, 4, 6, 8, 12, 16, 24, 32, 64, 128, 256, 512, LONG):
            pick = np.flatnonzero((size > low) & (size <= high))
            low = high
            for s in range(0, len(pick), max(1, 2_000_000 // high)):
                own = pick[s : s + max(1, 2_000_000 // high)]
                flat = self.byte[np.frombuffer(b"".join([raw[i] for i in own]), np.uint8)]
                inside = np.arange(max(high, 2))[None, :] < size[own][:, None]
                m = np.full(inside.shape, -1, dtype=np.int32)
                m[inside] = flat
                for i, ids in zip(own, self._rows(m)):
                    self.known[words[i]] = ids
        for i in np.flatnonzero(size > LONG):
            self.known[words[i]] = self._one(self.byte[np.frombuffer(raw[i], np.uint8)].tolist())

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids of all texts."""
        split = [self.split(t) if t else [] for t in texts]
        new = list({w for s in split for w in s} - self.known.keys())
        if len(self.known) + len(new) > KEPT:
            self.known.clear()
            new = list({w for s in split for w in s})
        self.words(new)
        flat = [self.known[w] for s in split for w in s]
        size = np.fromiter((len(x) for x in flat), dtype=np.int64, count=len(flat))
        ends = np.concatenate(([0], np.cumsum(size)))
        off = ends[np.concatenate(([0], np.cumsum([len(s) for s in split], dtype=np.int64)))]
        return off, np.concatenate(flat) if flat else np.zeros(0, np.int32)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def vocabulary(folder: str | None = None, name: str = "byte_bpe_50k.json") -> str:
    """Path of a vocabulary file; the folder is a parameter, SPARKLOOM_TOKENIZERS or the usual place."""
    return os.path.join(folder or os.environ.get("SPARKLOOM_TOKENIZERS", TOKENIZERS), name)


def pieces(texts: list, most: int = 1_000_000):
    at, total = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if total and total + n > most:
            yield at, i
            at, total = i, 0
        total += n
    if at < len(texts):
        yield at, len(texts)


def encoded(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """doc_id, ids of every row of docs (doc_id, text)."""
    path = vocabulary(folder)

    def run(batches):
        enc = encoder(path)
        for b in batches:
            texts = b.column("text").to_pylist()
            for lo, hi in pieces(texts):
                off, ids = enc.encode(texts[lo:hi])
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int32()))], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def counted(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """The rows of docs (text among them) without text, with n_tokens."""
    path = vocabulary(folder)
    keep = [c for c in docs.columns if c != "text"]

    def run(batches):
        enc = encoder(path)
        for b in batches:
            texts = b.column("text").to_pylist()
            n = []
            for lo, hi in pieces(texts):
                n.append(np.diff(enc.encode(texts[lo:hi])[0]))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(np.concatenate(n) if n else [], pa.int64())], [*keep, "n_tokens"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep) + ", n_tokens long"
    return docs.select(*keep, "text").mapInArrow(run, schema)
