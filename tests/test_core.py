import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from sparkloom.functions import text as X
from sparkloom.operators import aggregates, dedup, formats, gates, generate, joins, ranks, select, splits
from sparkloom.sources import readers, sinks


def col(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def test_text_functions(spark):
    assert col(spark, ["  A\t b \n", None, ""], X.normalised) == ["a b", None, ""]
    assert col(spark, ["aXbXX", "", None], lambda c: X.count_of(c, "X")) == [3, 0, None]
    assert col(spark, ["}{{}", "{{}}{", ""], lambda c: X.nesting_depth(c, False)) == [1, 2, 0]
    assert col(spark, ["}{{}", "{{}}{", ""], lambda c: X.nesting_depth(c, True)) == [2, 2, 0]
    assert col(spark, ['a="x\\"y";b'], X.without_literals) == ['a="";b']
    assert col(spark, ["A-MTH-0016v40", "HumanEval/7"], X.id_shape) == ["A-A-9a9", "AaAa/9"]
    assert col(spark, ["ab", "", "abcd"], X.char_ngrams) == [["ab"], [], ["abc", "bcd"]]
    assert col(spark, ["let a = 5 ; b=\"x  y\"", None], X.compact) == ['let a=5;b="x  y"', None]
    assert col(spark, ["True\n2.500  \n", "3.0", None], X.canonical_output) == ["true\n2.5", "3", None]
    a, b = col(spark, ["let ab=1;<ab", "let zz=27;<zz"], X.structural_hash)
    assert a == b != col(spark, ["let ab=1;<cd"], X.structural_hash)[0]
    df = spark.createDataFrame([([], []), (["a"], []), (["a", "b"], ["b", "c"])], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(X.jaccard(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, 1 / 3]


def test_gates(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 50)], "k int, n int")
    out = gates.with_reason(df, [("small", F.col("n") < 10), ("large", F.col("n") > 40)])
    assert [r["reason"] for r in out.orderBy("k").collect()] == ["small", None, "large"]
    assert {r["reason"]: r["n_rows"] for r in gates.reason_report(out).collect()} == {"small": 1, "large": 1, "pass": 1}
    assert col(spark, ["Seed-1", "seed-bad", "x", None], lambda c: gates.starts_with_any(c, ["seed"], ["seed-b"])) == [True, False, False, False]


def test_ranks_match_a_plain_window(spark):
    random.seed(1)
    rows = [(i, random.choice("abc"), random.random()) for i in range(300)] + [(999, None, None)]
    df = spark.createDataFrame(rows, "k long, g string, s double")
    got = ranks.bucket_rank(df, F.floor(F.col("s") * 10), [F.col("s"), F.col("k")], ["g"]).toPandas()
    for _, part in got.groupby("g", dropna=False):
        assert part.sort_values(["s", "k"])["rank"].tolist() == list(range(1, len(part) + 1))
    assert ranks.top_fraction(df, ["g"], [F.col("k")], 0.01).count() == sum(-(-len(p) // 100) for _, p in got.groupby("g", dropna=False))
    assert ranks.bucket_rank(df.limit(0), F.col("k"), [F.col("k")]).count() == 0


def test_nearest_rank(spark):
    values = [5, 1, 1, 9, 7, 7, 7, 2]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", None), ("c", 4)], "g string, v int")
    got = {r["g"]: (r["p50"], r["p99"]) for r in aggregates.nearest_rank(df, ["g"], "v", [50, 99]).collect()}
    s = sorted(values)
    assert got == {"a": (s[4], s[7]), "c": (4, 4)}


def test_majority_and_merkle(spark):
    df = spark.createDataFrame([("t", "1", "py"), ("t", "1", "c"), ("t", "2", "java"), ("u", "1", "py"), ("u", "2", "c"), ("v", "1", "py"), ("v", None, "c")], "k string, o string, l string")
    got = {r["k"]: (r["verdict"], r["winner"], r["voters"]) for r in aggregates.majority(df, "k", "o", "l", 2).collect()}
    assert got == {"t": ("agreed", "1", "c,py"), "u": ("tied", None, None), "v": ("few", None, None)}
    empty = aggregates.merkle_root(df.limit(0), F.col("k"), F.col("o"), lambda d: d.withColumn("i", F.lit(0))).first()
    assert empty["n_leaves"] == 0


def test_near_dedup_keeps_what_a_greedy_loop_keeps(spark):
    random.seed(3)
    base = ["".join(random.choice("abcdefgh ") for _ in range(80)) for _ in range(4)]
    rows = []
    for i in range(60):
        t = list(random.choice(base))
        for _ in range(random.randrange(6)):
            t[random.randrange(80)] = random.choice("xyz")
        rows.append((i, "".join(t)))
    rows += [(60, None), (61, "  "), (62, rows[0][1].upper()), (63, "ab")]
    norm = lambda s: " ".join(s.lower().split())
    grams = lambda s: {s[i : i + 3] for i in range(len(s) - 2)} if len(s) > 3 else {s}
    kept, dropped, texts = [], {}, {}
    for i, s in rows:
        if s is None or not s.strip():
            continue
        t = norm(s)
        if t in texts:
            dropped[i] = texts[t]
            continue
        texts[t] = i
        hit = next((k for k, g in kept if len(g & grams(t)) >= 0.7 * len(g | grams(t)) - 1e-9), None)
        if hit is None:
            kept.append((i, grams(t)))
        else:
            dropped[i] = hit
    df = spark.createDataFrame(rows, "k long, t string")
    assert {r["k"]: r["dropped_for"] for r in dedup.near_dedup(df, "k", "t", 0.7).collect()} == dropped
    pairs = {(a, b) for a, b in itertools.combinations(sorted(set(texts.values())), 2) if len(grams(norm(rows[a][1])) & grams(norm(rows[b][1]))) >= 0.7 * len(grams(norm(rows[a][1])) | grams(norm(rows[b][1]))) - 1e-9}
    assert set(map(tuple, dedup.ngram_pairs(df, "k", "t", 0.7).collect())) == pairs
    whole, dedup.CELL = dedup.CELL, 2  # grams divided into blocks
    try:
        assert set(map(tuple, dedup.ngram_pairs(df, "k", "t", 0.7).collect())) == pairs
    finally:
        dedup.CELL = whole


def test_disjointness(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    assert joins.disjointness(ids("A-1", "A-2", None), ids("A-3")).first()["status"] == "PASS"
    assert joins.disjointness(ids("A-1"), ids("A-1", "x")).first()["status"] == "FAIL"
    assert joins.disjointness(ids("A-1"), ids("x/1")).first()["status"] == "VACUOUS"
    assert joins.disjointness(ids(), ids()).first()["status"] == "VACUOUS"


def test_splits_and_selection(spark):
    df = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("g"))
    part = splits.ratio_split(df, ["g"], "k", 0.8, 1).groupBy("g", "part").count().toPandas()
    assert part[part.part == "train"]["count"].between(532, 534).all() and part["count"].sum() == 2000
    bins = select.first_fit(spark.createDataFrame([(0, k, s) for k, s in enumerate([50, 60, 200, 30, 10])], "shard long, k long, s long"), "shard", "k", "s", 100, 2).toPandas()
    assert bins.set_index("key").bin.to_dict() == {2: 0, 1: 1, 0: 2, 3: 1, 4: 2}
    centres = select.kmeans_1d(spark.createDataFrame([(v,) for v in [0.1, 0.11, 0.5, 0.52, 0.9, None]], "v double"), "v", 3).toPandas()
    assert sorted(centres.n_rows) == [1, 2, 2]
    pairs = spark.createDataFrame([(k, f"i{k % 4}") for k in range(40)], "key long, item string")
    top = select.quota_topup(pairs, pairs.where("key < 4").select("key"), 5).toPandas()
    assert top.for_item.value_counts().to_dict() == {f"i{j}": 4 for j in range(4)}


def test_chat_and_mutations(spark):
    df = spark.createDataFrame([(1, "let ab=1;lp(i<3){<ab};"), (2, ""), (3, None)], "k long, s string")
    rows = df.select("k", formats.chat_faults(formats.chat(F.lit("s"), F.lit("u"), F.col("s"))).alias("f")).collect()
    assert {r["k"]: r["f"] for r in rows} == {1: [], 2: ["empty"], 3: ["empty"]}
    src = "let ab=1;lp(i<3){<ab};"
    out = generate.edited(df, "k", "s", generate.MUTATIONS + generate.CONTRASTS + generate.REPAIRS).toPandas()
    assert set(out.k) == {1} and (out.edited != src).all()
    got = dict(zip(out.kind, out.edited))
    assert got["bound_shift"] == "let ab=1;lp(i<=3){<ab};" and got["let_to_mut"] == "let ab=mut.1;lp(i<3){<ab};" and got["foreign_loop"] == "let ab=1;while(i<3){<ab};"
    every = generate.edited(df, "k", "s", [generate.Edit("gone", ";", "")], every=True).toPandas()
    assert sorted(every.edited) == ["let ab=1;lp(i<3){<ab}", "let ab=1lp(i<3){<ab};"] and sorted(every.place) == [0, 1]
    assert generate.renamed(df, "k", "s").collect()[0]["edited"] == "let abX=1;lp(i<3){<abX};"
    assert generate.checked(df, "s", lambda xs: [(len(x), "ok") for x in xs]).orderBy("k").toPandas().exit_code.isna().tolist() == [False, False, True]


def test_readers_and_writers(spark, tmp_path):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    schema = StructType([StructField("id", StringType()), StructField("n", LongType())])
    p = tmp_path / "a.jsonl"
    p.write_text('{"id": "a", "n": 1}\n\n{"id": broken\n{"id": "b", "n": 2}\n')
    good, bad = readers.good_and_bad(readers.jsonl(spark, str(p), schema).cache())
    assert good.count() == 2 and bad.count() == 1
    (tmp_path / "t" / "C1").mkdir(parents=True)
    (tmp_path / "t" / "C1" / "x.json").write_text(json.dumps({"id": "x", "n": 3}, indent=1))
    (tmp_path / "t" / "C1" / "y.json").write_text("{")
    assert [(r["id"], r["category"]) for r in readers.json_tree(spark, str(tmp_path / "t"), schema, ["id"]).collect()] == [("x", "C1")]
    (tmp_path / "ids").write_text("# head\na 1\n\nb # c\na\n")
    assert sorted(r[0] for r in readers.id_list(spark, str(tmp_path / "ids")).collect()) == ["a", "b"]

    df = spark.createDataFrame([("a", 1, "A"), ("b", 2, "B")], "id string, n long, phase string")
    held = spark.createDataFrame([("b",)], "id string")
    out = str(tmp_path / "table")
    sinks.append_new(df, out, "id", held, ["phase"])
    sinks.append_new(df, out, "id", held, ["phase"])
    assert spark.read.parquet(out).count() == 1
    with pytest.raises(ValueError):
        sinks.append_new(df.withColumn("n", F.lit("x")), out, "id", None, ["phase"])
    (tmp_path / "table.lock").write_text("")
    with pytest.raises(Exception):  # another append is under way
        sinks.append_new(df, out, "id", None, ["phase"])
    (tmp_path / "table.lock").unlink()
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "x.parquet").write_text("no parquet")
    with pytest.raises(Exception):  # what can't be read isn't taken for an empty table
        sinks.append_new(df, str(tmp_path / "broken"), "id")
    sinks.manifest(df, str(tmp_path / "m"))
    with pytest.raises(Exception):
        sinks.manifest(df, str(tmp_path / "m"))
    sinks.upsert(df, str(tmp_path / "u"), "id", "n")
    sinks.upsert(spark.createDataFrame([("a", 9, "Z")], df.schema), str(tmp_path / "u"), "id", "n")
    assert {r["id"]: r["n"] for r in spark.read.parquet(str(tmp_path / "u")).collect()} == {"a": 9, "b": 2}
    (tmp_path / "u").rename(tmp_path / "u.old")  # as if an upsert died between its renames
    sinks.upsert(spark.createDataFrame([("c", 5, "Z")], df.schema), str(tmp_path / "u"), "id", "n")
    assert {r["id"]: r["n"] for r in spark.read.parquet(str(tmp_path / "u")).collect()} == {"a": 9, "b": 2, "c": 5}
    counts = sinks.two_ways(df.withColumn("reason", F.when(F.col("n") > 1, "big")), "reason", str(tmp_path / "ok"), str(tmp_path / "no"))
    assert {r["reason"]: r["n_rows"] for r in counts.collect()} == {"pass": 1, "big": 1}
    assert sinks.markdown(df.select("id", "n"), "T").splitlines()[2] == "| id | n |"


def test_tfidf_matches_a_plain_loop(spark):
    import math
    from collections import Counter

    items = {1: "red green blue", 2: "red red cat", 3: "dog"}
    queries = {1: "red cat cat", 2: "green dog", 3: "nothing here", 4: ""}
    df = Counter(t for s in items.values() for t in set(s.split()))
    idf = lambda t: math.log(4 / (df[t] + 1)) + 1 if t in df else math.log(4) + 1
    vec = lambda s: {t: c * idf(t) for t, c in Counter(s.split()).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    want = {}
    for q, s in queries.items():
        v = vec(s)
        sims = {i: sum(v[t] * w.get(t, 0) for t in v) / (norm(v) * norm(w)) if v else 0 for i, w in ((i, vec(x)) for i, x in items.items())}
        best = max(sims, key=lambda i: (sims[i], -i))
        want[q] = (best if sims[best] > 0 else None, round(sims[best], 6))
    q = spark.createDataFrame(list(queries.items()), "query_id long, text string")
    i = spark.createDataFrame(list(items.items()), "item_id long, text string")
    assert {r["query_id"]: (r["item_id"], r["sim"]) for r in joins.tfidf_best(q, i).collect()} == want


def test_bleu_of_equal_texts(spark):
    df = spark.createDataFrame([("g", "a b c d e", "a b c d e"), ("h", "a b", "c d")], "k string, c string, r string")
    assert {r["k"]: r["bleu"] for r in aggregates.bleu(df, ["k"], "c", "r").collect()} == {"g": 100.0, "h": 0.0}


def test_tfidf_eval_sim_compares_every_program_with_every_evaluation_record(spark, monkeypatch):
    """Against a plain loop, in one block and in many."""
    import math
    from collections import Counter

    from sparkloom.plans import catalogue

    d = "/root/testdata/sf0.001"
    rows = [(r["rec_id"], r["split"], r["tk_source"]) for r in spark.read.parquet(f"{d}/programs.parquet").select("rec_id", "split", "tk_source").collect()]
    items = {k: t.lower().split() for k, s, t in rows if s in ("validation", "test") and t is not None}
    df = Counter(t for ts in items.values() for t in set(ts))
    vec = lambda ts: {t: c * (math.log((len(items) + 1) / (df[t] + 1)) + 1) for t, c in Counter(ts).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    vecs, want = {k: vec(ts) for k, ts in items.items()}, {}
    for k, _, t in rows:
        v = vec(t.lower().split()) if t else {}
        sims = {i: round(sum(x * w.get(u, 0) for u, x in v.items()) / (norm(v) * norm(w)), 6) for i, w in vecs.items() if v and w}
        best = max(sims, key=lambda i: (sims[i], -i), default=None)
        want[k] = (best, sims[best]) if best is not None and sims[best] > 0 else (None, 0.0)
    for block in (joins.BLOCK, 7):
        monkeypatch.setattr(joins, "BLOCK", block)
        got = {r["query_id"]: (r["item_id"], r["sim"]) for r in catalogue.QUERIES["tfidf_eval_sim"](spark, d).collect()}
        assert got == want


def test_quota_topup_serves_more_than_sixty_items(spark):
    """Against a plain loop over all items; scarce, common and shared ones."""
    import hashlib

    random.seed(5)
    held = {k: {f"i{min(int(random.expovariate(0.04)), 89)}" for _ in range(random.randrange(1, 4))} for k in range(700)}
    chosen, want = set(range(0, 700, 50)), {}
    have, served, items = set(chosen), set(), sorted({i for v in held.values() for i in v})
    while True:
        count = {i: sum(i in held[k] for k in have) for i in items if i not in served}
        item = min(count, key=lambda i: (count[i], i), default=None)
        if item is None or count[item] >= 9:
            break
        served.add(item)
        more = sorted((k for k in held if item in held[k] and k not in have), key=lambda k: hashlib.sha256(str(k).encode()).hexdigest())[: 9 - count[item]]
        want |= dict.fromkeys(more, item)
        have |= set(more)
    assert len(served) > 60
    pairs = spark.createDataFrame([(k, i) for k, v in held.items() for i in sorted(v)], "key long, item string")
    got = select.quota_topup(pairs, spark.createDataFrame([(k,) for k in chosen], "key long"), 9).collect()
    assert {r["key"]: r["for_item"] for r in got} == want


def test_alias_calls_reads_every_form(spark, tmp_path):
    from sparkloom.plans import catalogue

    sources = [
        "M=a;I=s:std.str;F=f(x:i64):i64{let a=s.norm(x);let b = s.norm(x);g(s.pad(x)+s.norm(1));<b.norm(x)};",
        "M=a;\nI = my2Al :std.Io2;F=f(x:i64):i64{let a=my2Al.readAll(x);<my2Al . readAll (x)};",
        "m=a;\u200bi=o:std.io;f=f(x:i64):i64{let a=\u3000o.pad(x);<xo.pad(x)+y.o.pad(x)+o.pad};",
        "I=s:std.str;I=s:std.set;F=f(){<s.add(1)};",
        "F=f(){<s.add(1)};", "", None,
    ]
    spark.createDataFrame([(i, s) for i, s in enumerate(sources)], "rec_id long, tk_source string").write.parquet(f"{tmp_path}/programs.parquet")
    got = {(r["module"], r["fn"]): r["n_calls"] for r in catalogue.QUERIES["alias_calls"](spark, str(tmp_path)).collect()}
    assert got == {("std.str", "norm"): 3, ("std.str", "pad"): 1, ("std.Io2", "readAll"): 2, ("std.io", "pad"): 1, ("std.set", "add"): 1}


def test_inverse_frequency_covers_every_document(spark, tmp_path):
    import math

    from sparkloom.plans import catalogue

    docs = [(1, "Straße na\u00efve", "de"), (2, "stra\u00dfe\u3000\u0434\u043e\u043c", None), (3, "the DOM", "EN"), (4, "the", "en"), (5, "", "en"), (6, None, "en")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["term"]: (r["df"], r["idf"]) for r in catalogue.QUERIES["inverse_frequency"](spark, str(tmp_path)).collect()}
    df = {"stra\u00dfe": 2, "na\u00efve": 1, "\u0434\u043e\u043c": 1, "the": 2, "dom": 1}
    assert got == {t: (n, round(math.log(6 / (n + 1)) + 1, 6)) for t, n in df.items()}


def test_type_members_rebuild_the_pairs_that_type_compat_counts(spark):
    from sparkloom.plans import catalogue

    d = "/root/testdata/sf0.001"
    m = catalogue.QUERIES["type_members"](spark, d).collect()
    counts = {r["type"]: r["pairs"] for r in catalogue.QUERIES["type_compat"](spark, d).collect()}
    pairs = {t: sum(a["ret"] == t and b["param"] == t and a is not b for a in m for b in m) for t in counts}
    assert pairs == counts and sum(pairs.values()) > 0


def test_far_texts_that_share_a_gram_take_no_room():
    """4.5 million pairs of one posting list: those that outlines rule out are dropped where they meet."""
    import random
    import tracemalloc

    import numpy as np
    import pandas as pd
    from sparkloom.storage import packed

    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(100, 130))) for _ in range(3000)]
    texts[7], texts[8] = texts[2000] + "x", texts[2000] + "y"
    doc, code, m = dedup._grams(texts, 3)
    docs = packed(np.arange(len(texts)), m.astype("<u4"), np.ones(len(texts), "<u4"))
    entries = packed(np.zeros(len(texts), "<u4"), np.zeros(len(texts), "<u2"))
    row = {"docs": [docs], "entries": [entries]} | {f"x{k}": [x.tobytes()] for k, x in enumerate(dedup._outlines(doc, code, m))}
    tracemalloc.start()
    pairs = dedup._meet(pd.DataFrame(row), 0.75)
    assert tracemalloc.get_traced_memory()[1] < 30_000_000
    tracemalloc.stop()
    assert sorted(map(tuple, pairs.to_numpy())) == [(7, 8), (7, 2000), (8, 2000)]


def test_outlines_of_all_levels_keep_every_similar_pair():
    """Greedy deduplication rests on it: sizes of every level, beside each other, and no pair far from similar."""
    import random

    import numpy as np
    import pandas as pd
    from sparkloom.storage import packed

    rng = random.Random(4)
    texts = []
    for size in (40, 250, 290, 330, 900, 1150, 1300, 3000):
        base = [chr(rng.randrange(97, 123)) for _ in range(size)]
        for edits in (0, size // 60, size // 25, size // 15, size // 8):
            t = list(base)
            for i in rng.sample(range(size), edits):
                t[i] = "#"
            texts.append("".join(t))
    doc, code, m = dedup._grams(texts, 3)
    docs = packed(np.arange(len(texts)), m.astype("<u4"), np.ones(len(texts), "<u4"))
    row = {"docs": [docs], "entries": [packed(np.zeros(len(texts), "<u4"), np.zeros(len(texts), "<u2"))]} | {f"x{k}": [x.tobytes()] for k, x in enumerate(dedup._outlines(doc, code, m))}
    found = set(map(tuple, dedup._meet(pd.DataFrame(row), 0.75).to_numpy()))
    sets = [dedup._plain(t, 3) for t in texts]
    near = {(a, b) for a, b in itertools.combinations(range(len(texts)), 2) if len(sets[a] & sets[b]) >= 0.75 * len(sets[a] | sets[b]) - 1e-9}
    assert len(near) > 15 and near <= found and len(found) < 2 * len(near)


def test_texts_with_much_in_common_are_swept(spark, monkeypatch):
    """Sizes of every band and outline, in one broadcast and in many; equal pairs by both ways."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(60)]
    rows = []
    for size in (1, 2, 9, 40, 90, 250):
        for _ in range(4):
            base = [rng.choice(words) for _ in range(size)]
            for edits in (0, 0, size // 20, size // 8):
                t = list(base)
                for i in rng.sample(range(size), edits):
                    t[i] = "#" + t[i][1:]
                rows.append((rng.randrange(-9, 9) * 1000 + len(rows), " ".join(t)))
    rows += [(5, None), (6, " "), (9001, rows[50][1].upper()), (9002, "x")]
    texts = {}
    for k, t in sorted((k, " ".join(t.lower().split())) for k, t in rows if t):
        if t:
            texts.setdefault(t, k)
    sets = [(k, dedup._plain(t, 3)) for t, k in sorted(texts.items(), key=lambda x: x[1])]
    near = {(a, b) for (a, x), (b, y) in itertools.combinations(sets, 2) if len(x & y) >= 0.75 * len(x | y) - 1e-9}
    assert len(near) > 20
    df = spark.createDataFrame(rows, "k long, t string")
    with monkeypatch.context() as m:
        m.setattr(dedup, "CROWDED", 2.0)
        assert sorted(map(tuple, dedup.ngram_pairs(df, "k", "t", 0.75).collect())) == sorted(near)
    for cell in (dedup.CELL, 12):
        with monkeypatch.context() as m:
            m.setattr(dedup, "CELL", cell)
            m.setattr(dedup, "_by_prefix", None)
            assert sorted(map(tuple, dedup.ngram_pairs(df, "k", "t", 0.75).collect())) == sorted(near)
    assert dedup.ngram_pairs(df.limit(0), "k", "t", 0.75).isEmpty()
