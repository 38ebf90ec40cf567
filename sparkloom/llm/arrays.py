"""Hashing of many texts at once with numpy, and small helpers for Spark jobs.

A batch of texts is one code array; hashes of substrings come from wrapping prefix sums
``S[i] = sum(value[c_j] * B**j)``, so that ``(S[e] - S[s]) * B**-s`` is the polynomial hash of
``[s, e)`` modulo 2**64.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
BASE2 = 0xC2B2AE3D27D4EB4F | 1


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit values (xor-shift and multiply)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=U64)
    p[0] = 1
    return np.multiply.accumulate(p)


def powers(base: int, n: int) -> np.ndarray:
    """``base**i`` for i < n; kept by size class."""
    return _powers(base, 1 << max(12, (max(n, 1) - 1).bit_length()))[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


class Rolling:
    """Substring hashes of one array of 64-bit values."""

    def __init__(self, values: np.ndarray, base: int = BASE):
        n = len(values)
        self.inv = powers(inverse(base), n + 1)
        self.sum = np.zeros(n + 1, dtype=U64)
        np.cumsum(values * powers(base, n), out=self.sum[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sum[end] - self.sum[start]) * self.inv[start]


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and the offsets of the texts."""
    off = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=off[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32), off


def chunks(n_chars: list[int], most: int):
    """Slices of rows with at most `most` characters each (a longer text stands alone)."""
    at, total = 0, 0
    for i, n in enumerate(n_chars):
        if total and total + n > most:
            yield slice(at, i)
            at, total = i, 0
        total += n
    if at < len(n_chars):
        yield slice(at, len(n_chars))


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where it is unset, a new local one in local mode (tests), else an error."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d is None:
        known = sc._jsc.sc().getCheckpointDir()
        if known.isDefined():
            return known.get()
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = "file://" + os.path.join(tempfile.gettempdir(), f"sparkloom-{uuid.uuid4().hex}")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(d)
    return d


def stored(df: DataFrame) -> DataFrame:
    """The rows, written to the shared checkpoint folder; lineage ends there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


BITS = 1 << 29  # most bits of a filter that is broadcast: 64 MB


def slice_bits(n: int, slices: int) -> int:
    """Bits of each slice of a filter of n keys: 16 a key, a power of two, BITS in all at most."""
    most = max(BITS // slices, 64)
    return 1 << min(max((16 * n // slices).bit_length(), 6), most.bit_length() - 1)


def bit_slice(keys: np.ndarray, bits: int) -> bytes:
    out = np.zeros(bits, dtype=bool)
    out[(keys % U64(bits)).astype(np.int64)] = True
    return np.packbits(out, bitorder="little").tobytes()


def has_bits(filters: np.ndarray, part: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the bit of each key is set in the slice of its part (filters: bytes by slice)."""
    bit = (keys % U64(filters.shape[1] * 8)).astype(np.int64)
    return (filters[part, bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0


SLICE_IDS = 1_000_000  # ids that one task makes a slice of a filter from, on average


def narrowed(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs (id, text) without most rows whose id isn't among ids: a filter of at most 64 MB is broadcast.

    Made before a join, so that the texts it needs no more aren't shuffled; rows that stay by chance
    fall out in the join. The filter is made in slices of a bounded number of ids.
    """
    spark = docs.sparkSession
    ids = stored(ids.distinct())
    n = ids.count()
    slices = max(16, -(-n // SLICE_IDS))
    bits = slice_bits(n, slices)

    def key(x: np.ndarray) -> np.ndarray:
        return mix(x.astype(np.int64).view(U64) + U64(7))

    def slots(batches):
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "s": (key(pdf["id"].to_numpy()) % U64(slices)).astype(np.int64)})

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"s": pdf["s"][:1], "bits": [bit_slice(key(pdf["id"].to_numpy()) // U64(slices), bits)]})

    filters = np.zeros((slices, bits // 8), dtype=np.uint8)
    for r in ids.mapInPandas(slots, "id long, s long").groupBy("s").applyInPandas(one, "s long, bits binary").collect():
        filters[r["s"]] = np.frombuffer(r["bits"], np.uint8)
    shared = spark.sparkContext.broadcast(filters)

    def keep(batches):
        for b in batches:
            k = key(b.column("id").to_numpy(zero_copy_only=False))
            ok = has_bits(shared.value, (k % U64(slices)).astype(np.int64), k // U64(slices))
            yield b.filter(pa.array(ok))

    return docs.select("id", "text").mapInArrow(keep, "id long, text string")


def n_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def grouped(pieces: DataFrame, parts: int):
    """Rows grouped by part; where parts have grown beyond the session's shuffle partitions, in as many partitions as parts,
    so a task's share stays as it is when the data grow."""
    return (pieces.repartition(parts, "part") if parts > n_parts(pieces.sparkSession) else pieces).groupBy("part")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
