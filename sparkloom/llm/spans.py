"""Long exact spans shared between records (problem 3).

A position is shared if a run of `length` characters over it stands in another record. Every such
run has a seed, the least hash among its runs of half that length, which equal runs have in common;
neighbouring runs with one seed form a stretch. Stretches, not runs, are sent to the partition of
their seed: a seed of one record only ends there; equal stretches of two records are shared whole
(matching statistics of at least the threshold at every start); stretches that only have a seed in
common are sent once more, as the hashes of their runs, one record standing for equal stretches.
What a task can judge from its own records isn't sent: of equal stretches or runs of several records
it sends one, of a seed with many different stretches two, so a passage that stands in any number of
records costs a few entries per task. Lengths count code points; equal means equal in 96 bits of
hashes (32 and 64, of different runs or bases); characters are not compared.

Defined cases: null, empty and shorter texts have no rows; what repeats within one record only is
not shared; equal records are shared whole; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import BASE2, U64, Rolling, chunks, codes, grouped, mix, n_parts, stored

CHUNK = 1_500_000
FLUSH = 700_000
GROUP_CHARS = 25_000_000  # characters whose stretches (one in about 25) one group holds, on average
MIXED = 16  # different stretches of a seed in a task from which the task judges them itself
PLAIN, MANY, ASKED = 0, 1, 2  # an entry; one for several judged records; one of a judged seed
_STRETCH = np.dtype([("seed", "<u4"), ("run", "<u8"), ("doc", "<u4"), ("start", "<u4"), ("n", "<u2"), ("flag", "u1")])
_WINDOW = np.dtype([("run", "<u8"), ("check", "<u4"), ("doc", "<u4"), ("start", "<u4"), ("many", "?")])
_PLACE = np.dtype([("start", "<u4"), ("n", "<u2")])
_WANT = np.dtype([("start", "<u4"), ("n", "<u2"), ("many", "?")])


def _least(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w neighbours."""
    out, span = h, 1
    while span * 2 <= w:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[: len(h) - w + 1], out[w - span : w - span + len(h) - w + 1]) if span < w else out


def stretches(texts: list[str], length: int):
    """seed, hash, text, start and number of runs of every stretch of neighbouring runs with one seed."""
    c, off = codes(texts)
    none = np.zeros(0, np.int64)
    if len(c) < length:
        return none.astype(U64), none.astype(U64), none, none, none
    roll = Rolling(mix(c.astype(U64) + U64(1)))
    k = length // 2
    at = np.arange(len(c) - k + 1)
    seed = _least(mix(roll.of(at, at + k)), length - k + 1)
    n = np.maximum(np.diff(off) - length + 1, 0)
    start = np.repeat(off[:-1], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    doc = np.repeat(np.arange(len(texts)), n)
    seed = seed[start]
    new = np.ones(len(start), dtype=bool)
    if len(start):
        new[1:] = (seed[1:] != seed[:-1]) | (doc[1:] != doc[:-1]) | ((start[1:] - off[doc[1:]]) % 30000 == 0)
    first = np.flatnonzero(new)
    count = np.diff(np.concatenate((first, [len(start)])))
    s, d = start[first], doc[first]
    return seed[first], mix(roll.of(s, s + count + length - 1) + count.astype(U64)), d, s - off[d], count


def _pack(part: np.ndarray, parts: int, ids: np.ndarray, entries: np.ndarray) -> pd.DataFrame:
    by = np.argsort(part, kind="stable")
    part = part[by]
    first = np.flatnonzero(np.diff(part, prepend=-1))
    rows = []
    for a, b in zip(first, np.append(first[1:], len(by))):
        e = entries[by[a:b]]
        own, e["doc"] = np.unique(e["doc"], return_inverse=True)
        rows.append((int(part[a]), ids[own].tobytes(), e.tobytes()))
    return pd.DataFrame(rows, columns=["part", "ids", "entries"])


def _unpack(pdf: pd.DataFrame, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    ids = [np.frombuffer(x, np.int64) for x in pdf["ids"]]
    entries = [np.frombuffer(x, kind) for x in pdf["entries"]]
    base = np.concatenate(([0], np.cumsum([len(x) for x in ids])))
    out = np.concatenate(entries)
    doc = np.concatenate([e["doc"].astype(np.int64) + b for e, b in zip(entries, base)])
    return np.concatenate(ids)[doc], out


def _by_id(ids: np.ndarray, rows: np.ndarray) -> list[tuple[int, bytes]]:
    by = np.argsort(ids, kind="stable")
    ids, rows = ids[by], rows[by]
    one, at = np.unique(ids, return_index=True)
    cuts = np.append(at, len(ids))
    return [(int(i), rows[a:b].tobytes()) for i, a, b in zip(one, cuts[:-1], cuts[1:])]


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal keys stand together, and the number of its group for each place."""
    by = np.lexsort(keys[::-1])
    new = np.zeros(len(by), dtype=bool)
    for k in keys:
        k = k[by]
        new[1:] |= k[1:] != k[:-1]
    return by, np.cumsum(new)


def _several(group: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each group, whether it has two different ids (both arrays ordered by group)."""
    n = int(group[-1]) + 1 if len(group) else 0
    first = np.searchsorted(group, np.arange(n))
    out = np.zeros(n, dtype=bool)
    np.logical_or.at(out, group, ids != ids[first][group])
    return out


SENT = "part long, ids binary, entries binary, id long, whole binary, want binary"
ANSWER = "id long, whole binary, want binary"


def _places(start: np.ndarray, n) -> np.ndarray:
    out = np.zeros(len(start), dtype=_PLACE)
    out["start"], out["n"] = start, n
    return out


def _answers(ids: np.ndarray, places: np.ndarray, ask_ids: np.ndarray | None = None, wants: np.ndarray | None = None) -> pd.DataFrame:
    rows = [(i, b, None) for i, b in _by_id(ids, places)]
    rows += [(i, None, b) for i, b in _by_id(ask_ids, wants)] if wants is not None else []
    return pd.DataFrame(rows, columns=["id", "whole", "want"])


def _sent(entries: pd.DataFrame, answers: pd.DataFrame, parts: int) -> pd.DataFrame:
    """Entries, and answers that pass through any partition."""
    answers = answers.assign(part=answers["id"].to_numpy(np.int64) % parts, ids=None, entries=None)
    entries = entries.assign(id=None, whole=None, want=None)
    out = pd.concat([x for x in (entries, answers) if len(x)]) if len(entries) or len(answers) else entries
    return out.astype({"id": "Int64", "part": np.int64})[["part", "ids", "entries", "id", "whole", "want"]]


def _received(pdf: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    passed = pdf["entries"].isna()
    return pdf[~passed], pdf.loc[passed, ["id", "whole", "want"]]


class _Judged:
    """Stretches (ids, e) by seed and run, with what is known of each: several (records have it), first (of its run),
    seed_several, mixed (the seed has different stretches), n_runs (of its seed)."""

    def __init__(self, ids: np.ndarray, e: np.ndarray):
        by, run = _groups(e["seed"], e["run"])
        self.ids, self.e = ids[by], e[by]
        ids, e = self.ids, self.e
        self.first = np.ones(len(e), dtype=bool)
        self.first[1:] = run[1:] != run[:-1]
        new = np.ones(len(e), dtype=bool)
        new[1:] = e["seed"][1:] != e["seed"][:-1]
        seed = np.cumsum(new) - 1
        several, seed_several = _several(run, ids), _several(seed, ids)
        np.logical_or.at(several, run, e["flag"] == MANY)
        np.logical_or.at(seed_several, seed, e["flag"] != PLAIN)
        self.n_runs = np.bincount(seed, self.first)[seed].astype(np.int64) if len(e) else seed
        mixed = np.zeros(len(seed_several), dtype=bool)
        np.logical_or.at(mixed, seed, (self.n_runs > 1) | (e["flag"] == ASKED))
        self.several, self.seed_several, self.mixed = several[run], seed_several[seed], mixed[seed]
        self.edge = new | np.append(new[1:], True)[: len(e)]  # first and last of a seed: different runs, if it is mixed

    def wants(self, ask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out = np.zeros(int(ask.sum()), dtype=_WANT)
        out["start"], out["n"], out["many"] = self.e["start"][ask], self.e["n"][ask], self.several[ask]
        return self.ids[ask], out


def _send_stretches(batches, length: int, parts: int):
    held, ids, size = [], [], 0

    def flush():
        e, own = np.concatenate(held), np.concatenate(ids)
        number = e["doc"].astype(np.int64)
        e["doc"] = np.arange(len(e))
        j = _Judged(own[number], e)
        here = (j.n_runs > MIXED) & j.seed_several
        whole = j.several
        answers = _answers(j.ids[whole], _places(j.e["start"][whole], j.e["n"][whole]), *j.wants(here & (j.first | ~whole)))
        send = np.where(here, j.edge, j.first | ~whole)
        out = j.e[send]
        out["flag"] = np.where(here[send], ASKED, np.where(whole[send], MANY, PLAIN))
        out["doc"] = number[out["doc"]]
        return _sent(_pack((out["seed"] % parts).astype(np.int64), parts, own, out), answers, parts)

    for pdf in batches:
        pdf = pdf[pdf["text"].notna()]
        texts, own = pdf["text"].tolist(), pdf["id"].to_numpy()
        for s in chunks([len(t) + 20 for t in texts], CHUNK):
            seed, run, doc, start, n = stretches(texts[s], length)
            e = np.zeros(len(seed), dtype=_STRETCH)
            e["seed"], e["run"], e["doc"], e["start"], e["n"] = seed & U64(0xFFFFFFFF), run, doc + sum(map(len, ids)), start, n
            held.append(e)
            ids.append(own[s])
            size += len(e)
            if size > FLUSH:
                yield flush()
                held, ids, size = [], [], 0
    if size:
        yield flush()


def _judge_stretches(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per record: stretches shared whole, and those whose runs are to be compared one by one."""
    entries, passed = _received(pdf)
    if not len(entries):
        return passed
    j = _Judged(*_unpack(entries, _STRETCH))
    whole = j.several & (j.e["flag"] != MANY)  # those of MANY have been answered
    ask = j.seed_several & j.mixed & (j.first | ~j.several) & (j.e["flag"] != ASKED)
    answers = _answers(j.ids[whole], _places(j.e["start"][whole], j.e["n"][whole]), *j.wants(ask))
    return pd.concat([answers, passed]) if len(passed) else answers


def _runs(ids: np.ndarray, e: np.ndarray):
    """Runs ordered by hash, whether another record has the same, and the first of each."""
    by, group = _groups(e["run"], e["check"])
    ids, e = ids[by], e[by]
    shared = _several(group, ids)
    np.logical_or.at(shared, group, e["many"])
    first = np.ones(len(e), dtype=bool)
    first[1:] = group[1:] != group[:-1]
    return ids, e, shared[group], first


def _send_windows(batches, length: int, parts: int):
    for pdf in batches:
        texts, own, wants = pdf["text"].tolist(), pdf["id"].to_numpy(), pdf["wants"].tolist()
        for s in chunks([len(t) + 20 for t in texts], CHUNK):
            c, off = codes(texts[s])
            value = mix(c.astype(U64) + U64(1))
            lists = [np.frombuffer(b"".join(w), _WANT) for w in wants[s]]
            w = np.concatenate(lists)
            doc = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
            n = w["n"].astype(np.int64)
            start = np.repeat(w["start"].astype(np.int64), n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            d = np.repeat(doc, n)
            e = np.zeros(len(start), dtype=_WINDOW)
            at = start + off[d]
            e["run"], e["doc"], e["start"], e["many"] = mix(Rolling(value).of(at, at + length)), d, start, np.repeat(w["many"], n)
            e["check"] = mix(Rolling(value, BASE2).of(at, at + length)) & U64(0xFFFFFFFF)
            ids, e, shared, first = _runs(own[s][d], e)
            known = shared & ~e["many"]
            answers = _answers(ids[known], _places(e["start"][known], 1))
            out = e[first | ~shared]
            out["many"] = shared[first | ~shared]
            yield _sent(_pack((out["run"] >> U64(40)).astype(np.int64) % parts, parts, own[s], out), answers, parts)


def _judge_windows(pdf: pd.DataFrame) -> pd.DataFrame:
    entries, passed = _received(pdf)
    if not len(entries):
        return passed
    ids, e, shared, _ = _runs(*_unpack(entries, _WINDOW))
    ok = shared & ~e["many"]
    answers = _answers(ids[ok], _places(e["start"][ok], 1))
    return pd.concat([answers, passed]) if len(passed) else answers


def _union(batches, length: int):
    for pdf in batches:
        lists = [np.frombuffer(b"".join(x), _PLACE) for x in pdf["places"]]
        p = np.concatenate(lists)
        row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        start = p["start"].astype(np.int64)
        end = start + p["n"] + length - 1
        by = np.lexsort((start, row))
        row, start, end = row[by], start[by], end[by]
        wide = int(end.max()) + 2
        last = np.maximum.accumulate(end + row * wide) - row * wide
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (start[1:] > last[:-1])
        first = np.flatnonzero(new)
        stop = np.append(first[1:], len(row)) - 1
        yield pd.DataFrame({"rec_id": pdf["id"].to_numpy()[row[first]], "start_pos": start[first], "end_pos": last[stop]})


def shared_spans(rows: DataFrame, length: int = 100) -> DataFrame:
    """rec_id, start_pos, end_pos of the maximal shared stretches of each record. rows: id (unique, long), text."""
    rows = rows.select("id", "text").where(F.length("text") >= length)
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(n_parts(rows.sparkSession), chars // GROUP_CHARS)
    sent = rows.mapInPandas(lambda it: _send_stretches(it, length, parts), SENT)
    judged = stored(grouped(sent, parts).applyInPandas(_judge_stretches, ANSWER))
    wants = judged.where("want is not null").groupBy("id").agg(F.collect_list("want").alias("wants"))
    windows = rows.join(wants, "id").mapInPandas(lambda it: _send_windows(it, length, parts), SENT)
    more = grouped(windows, parts).applyInPandas(_judge_windows, ANSWER)
    places = judged.where("whole is not null").select("id", "whole").unionByName(more.select("id", "whole"))
    return places.groupBy("id").agg(F.collect_list("whole").alias("places")).mapInPandas(lambda it: _union(it, length), "rec_id long, start_pos long, end_pos long")


def sources(programs: DataFrame, negative: DataFrame) -> DataFrame:
    return programs.select(F.col("rec_id").alias("id"), F.col("tk_source").alias("text")).unionByName(negative.select(F.col("rec_id").alias("id"), F.col("fixed_source").alias("text")))


def shared_share(rows: DataFrame, length: int = 100) -> DataFrame:
    """rec_id, n_spans, shared_chars, n_chars, share of every record with text; records without spans have zeros."""
    spans = shared_spans(rows, length).groupBy("rec_id").agg(F.count("*").alias("n_spans"), F.sum(F.col("end_pos") - F.col("start_pos")).alias("shared_chars"))
    all_ = rows.where("text is not null").select(F.col("id").alias("rec_id"), F.length("text").cast("long").alias("n_chars"))
    out = all_.join(spans, "rec_id", "left").select("rec_id", F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("shared_chars", F.lit(0)).alias("shared_chars"), "n_chars")
    return out.withColumn("share", F.when(F.col("n_chars") > 0, F.round(F.col("shared_chars") / F.col("n_chars"), 6)).otherwise(0.0))
