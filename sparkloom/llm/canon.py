"""The same program in another form: hashes that skip and fold (problem 4).

Code points run through one lookup table: 0 skips (white space, invisible characters, quotation
marks), SEP marks a separator, all else is folded in case. Polynomial hashes over the kept code
points are taken by wrapping prefix sums; import statements and the fields of types are hashed one
by one and added up, which makes their order void. Folded code points exist as one array for a batch
of at most CHUNK characters while it is hashed or compared; no string of them is built, and none is
shuffled or stored. Rows whose 128-bit hashes agree are compared code point by code point with the
row that is kept.

Defined cases: null sources and those with nothing left are no case; text that only looks like an
import or a type (other braces, parentheses or equals signs in it) is ordinary text, in its order.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import BASE, BASE2, U64, Rolling, chunks, codes, mix, narrowed, stored

SEP = 1
# Brackets that Unicode counts as quotation marks by property, not by name.
CORNERS = "「」『』〝〞〟﹁﹂﹃﹄｢｣⹂"
# Invisible characters that are neither white space nor of a control or format category.
BLANKS = "͏ᅟᅠ឴឵⠀ㅤﾠ"
CHUNK = 2_000_000


@lru_cache(maxsize=1)
def fold_table() -> tuple[np.ndarray, dict[int, str]]:
    """The lookup table of all code points, and those that fold to several characters."""
    table = np.arange(0x110000, dtype=np.uint32)
    several = {}
    for cp in range(0x110000):
        if 0x3400 <= cp < 0xA000 or 0xAC00 <= cp < 0xE000 or cp >= 0x20000 and cp < 0xE0000:
            continue
        ch = chr(cp)
        kind, name = unicodedata.category(ch), unicodedata.name(ch, "")
        if ch.isspace() or kind in ("Cc", "Cf", "Zs", "Zl", "Zp") or ch in BLANKS or 0xFE00 <= cp < 0xFE10 or 0xE0100 <= cp < 0xE01F0 or 0x180B <= cp < 0x1810:
            table[cp] = 0
        elif ch in CORNERS or "QUOTATION MARK" in name or name.endswith("APOSTROPHE") and kind == "Po":
            table[cp] = 0
        elif cp == 0x37E or kind == "Po" and ("COMMA" in name or "SEMICOLON" in name):
            table[cp] = SEP
        else:
            low = ch.casefold()
            if len(low) == 1:
                table[cp] = ord(low)
            elif len(ch.lower()) == 1 and len(ch.lower().casefold()) == 1:
                table[cp] = ord(ch.lower())
            else:
                several[cp] = low
    return table, several


class Parsed:
    """Kept code points of a batch, with imports and type fields marked."""

    def __init__(self, texts: list[str]):
        table, several = fold_table()
        texts = [t if t.isascii() else t.translate(several) for t in texts]
        raw, off = codes(texts)
        f = table[raw]
        keep = f > 0
        doc = np.repeat(np.arange(len(texts)), np.diff(off))[keep]
        f = f[keep]
        n = len(f)
        self.docs = len(texts)
        sep, op, cl = f == SEP, f == ord("{"), f == ord("}")
        depth = np.cumsum(op.astype(np.int64) - cl)
        first = np.searchsorted(doc, np.arange(len(texts) + 1))
        before = np.concatenate(([0], depth))[first]
        depth -= before[doc]
        # segments of the outer level
        begins = np.zeros(n + 1, dtype=bool)
        begins[first] = True
        begins[1:] |= (sep | cl) & (depth == 0)
        start = np.flatnonzero(begins[:n])
        end = np.concatenate((start[1:], [n])) if n else start
        sdoc = doc[start]
        at = lambda i, c: np.where(i < end, f[np.minimum(i, n - 1)], 0) == ord(c)
        eq = at(start + 1, "=")
        odd = np.concatenate(([0], np.cumsum((f == ord("(")) | (f == ord("=")) | op)))
        colon = np.concatenate(([0], np.cumsum(f == ord(":"))))
        has = lambda c, s, e: c[e] - c[s]
        empty = sep[start] & (end - start == 1)
        imp = at(start, "i") & eq & (has(colon, start, end) > 0) & (has(odd, start, end) == 1)
        other = ~(imp | empty | (at(start, "m") & eq))
        seen = np.cumsum(other)
        ahead = np.concatenate(([0], seen))[np.searchsorted(sdoc, np.arange(len(texts)))] if len(start) else np.zeros(len(texts), int)
        imp &= seen - ahead[sdoc] == 0
        # type bodies: T=name{fields}
        opens = np.flatnonzero(op)
        o = opens[np.minimum(np.searchsorted(opens, start), max(len(opens) - 1, 0))] if len(opens) else np.full(len(start), n)
        closed = np.zeros(len(start), dtype=bool)
        if len(start):
            closed = cl[end - 1] & (depth[end - 1] == 0)
        typ = at(start, "t") & eq & closed & (o > start) & (o < end)
        typ[typ] &= has(odd, o[typ] + 1, end[typ] - 1) == 0
        mark = np.zeros(n + 1, dtype=np.int64)  # parts that are added up
        for a, b in ((start[imp], end[imp]), (o[typ] + 1, end[typ] - 1)):
            np.add.at(mark, a, 1)
            np.add.at(mark, b, -1)
        loose = np.cumsum(mark[:n]) > 0
        edge = np.zeros(n + 1, dtype=bool)
        edge[start[imp]] = True
        edge[o[typ] + 1] = True
        edge[1:] |= sep & loose
        edge[:n] &= loose & ~sep
        edge[n] = False
        self.part = np.flatnonzero(edge)
        stop = np.flatnonzero(np.concatenate((sep | ~loose, [True])))
        self.part_end = stop[np.searchsorted(stop, self.part)]
        ordinal = np.zeros(len(start), dtype=np.int64)
        t = np.flatnonzero(typ)
        if len(t):
            ordinal[t] = np.arange(len(t)) - np.searchsorted(sdoc[t], sdoc[t]) + 1
        seg = np.searchsorted(start, self.part, side="right") - 1
        self.part_kind = ordinal[seg]  # 0 for imports, else the number of the type
        self.part_doc = doc[self.part]
        self.f, self.doc = f, doc
        self.main = ~sep & ~loose

    def hashes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Two hashes of every text, and whether anything is left of it."""
        out = []
        left = np.bincount(self.doc[self.f != SEP], minlength=self.docs) > 0
        m = self.f[self.main].astype(U64)
        at = np.searchsorted(self.doc[self.main], np.arange(self.docs + 1))
        for k, base in enumerate((BASE, BASE2)):
            salt = U64(k * 77 + 1)
            h = mix(Rolling(mix(m + salt), base).of(at[:-1], at[1:]) + np.diff(at).astype(U64))
            p = mix(Rolling(mix(self.f.astype(U64) + salt), base).of(self.part, self.part_end) + self.part_kind.astype(U64) * U64(BASE2))
            sums = np.concatenate((np.zeros(1, U64), np.cumsum(p)))
            by = np.searchsorted(self.part_doc, np.arange(self.docs + 1))
            out.append(mix(h + (sums[by[1:]] - sums[by[:-1]]) * U64(3)).view(np.int64))
        return out[0], out[1], left

    def same(self, i: int, j: int) -> bool:
        """Whether texts i and j agree in all that counts."""
        a, b = (slice(*np.searchsorted(self.doc, (d, d + 1))) for d in (i, j))
        if not np.array_equal(self.f[a][self.main[a]], self.f[b][self.main[b]]):
            return False
        parts = []
        for d in (i, j):
            lo, hi = np.searchsorted(self.part_doc, (d, d + 1))
            parts.append(sorted((int(self.part_kind[x]), self.f[self.part[x] : self.part_end[x]].tobytes()) for x in range(lo, hi)))
        return parts[0] == parts[1]


def hashed(rows: DataFrame) -> DataFrame:
    """id, h1, h2 of each row (id, text) with something left."""

    def run(batches):
        for pdf in batches:
            pdf = pdf[pdf["text"].notna()]
            texts = pdf["text"].tolist()
            for s in chunks([len(t) for t in texts], CHUNK):
                h1, h2, left = Parsed(texts[s]).hashes()
                yield pd.DataFrame({"id": pdf["id"].to_numpy()[s], "h1": h1, "h2": h2})[left]

    return rows.select("id", "text").mapInPandas(run, "id long, h1 long, h2 long")


HOT = 100_000  # rows from which a group of copies is hot; there are at most as many hot groups as are broadcast


def _found(rows: DataFrame, per_salt: int) -> tuple[DataFrame, DataFrame]:
    """(hashes of all rows with something left, stored; keep_id, copy_id)."""
    h = stored(hashed(rows))
    groups = stored(h.groupBy("h1", "h2").agg(F.min("id").alias("keep_id"), F.count("*").alias("n")).where("n > 1").withColumn("salts", F.ceil(F.col("n") / per_salt).cast("int")))
    # members of hot groups never meet in one task: HOT or more rows each, so their list is bounded and broadcast
    least = max(HOT, h.count() // HOT)
    hot, rest = F.broadcast(groups.where(F.col("n") >= least)), groups.where(F.col("n") < least)
    pairs = h.join(hot, ["h1", "h2"]).unionByName(h.join(hot, ["h1", "h2"], "left_anti").join(rest, ["h1", "h2"])).where("id <> keep_id")
    pairs = stored(pairs.select("keep_id", F.col("id").alias("copy_id"), F.pmod(F.xxhash64("id"), F.col("salts")).alias("salt")))
    text = narrowed(rows, pairs.select(F.explode(F.array("keep_id", "copy_id")).alias("id")))
    kept = pairs.select("keep_id", "salt").distinct().join(text.select(F.col("id").alias("keep_id"), F.col("text").alias("tk")), "keep_id")
    both = pairs.join(text.select(F.col("id").alias("copy_id"), F.col("text").alias("tc")), "copy_id").join(kept, ["keep_id", "salt"])

    def check(batches):
        for pdf in batches:
            a, b = pdf["tk"].tolist(), pdf["tc"].tolist()
            ok = np.array([x == y for x, y in zip(a, b)], dtype=bool)
            rest = np.flatnonzero(~ok)
            for s in chunks([len(a[i]) + len(b[i]) for i in rest], CHUNK):
                i = rest[s]
                p = Parsed([a[x] for x in i] + [b[x] for x in i])
                ok[i] = [p.same(k, k + len(i)) for k in range(len(i))]
            yield pdf.loc[ok, ["keep_id", "copy_id"]]

    return h, both.select("keep_id", "copy_id", "tk", "tc").mapInPandas(check, "keep_id long, copy_id long")


def copies(rows: DataFrame, per_salt: int = 5000) -> DataFrame:
    """keep_id, copy_id for every copy of an earlier row. rows: id (unique, long), text.

    A group of any size is split by salts of about `per_salt` copies for the comparison.
    """
    return _found(rows, per_salt)[1]


def sources(programs: DataFrame, parallel: DataFrame) -> DataFrame:
    return programs.select(F.col("rec_id").alias("id"), F.col("tk_source").alias("text")).unionByName(parallel.select(F.col("rec_id").alias("id"), F.col("toke_source").alias("text"))).where("text is not null")


def collapsed(rows: DataFrame, per_salt: int = 5000) -> DataFrame:
    """keep_id, n_copies (itself included) of every kept row with something left."""
    h, found = _found(rows, per_salt)
    found = stored(found)
    n = found.groupBy("keep_id").agg((F.count("*") + 1).alias("n_copies"))
    alone = h.select("id").join(found.select(F.col("copy_id").alias("id")), "id", "left_anti")
    return alone.withColumnRenamed("id", "keep_id").join(n, "keep_id", "left").select("keep_id", F.coalesce("n_copies", F.lit(1)).alias("n_copies"))
