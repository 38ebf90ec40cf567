"""Operators on records against plain loops."""

import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from sparkloom.functions import rewrite as W
from sparkloom.functions import text as X
from sparkloom.operators import aggregates, compose, ranks, splits


def col(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def hot_rows(n=400, seed=3):
    """Rows of which one key holds more than half; ties, nulls in the key."""
    random.seed(seed)
    return [(i, random.choice(["hot"] * 6 + ["a", "b", None]), random.randrange(20), random.random() < 0.4) for i in range(n)]


@pytest.fixture(scope="module")
def hot(spark):
    return spark.createDataFrame(hot_rows(), "id long, k string, v long, f boolean")


def by_key(rows):
    groups = {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        groups.setdefault(r[1], []).append(r)
    return groups



def test_ranks_of_a_hot_key(spark, hot, monkeypatch):
    order = [F.col("v"), F.col("id")]
    g = by_key(hot_rows())
    got = {r["id"]: (r["rank"], r["n"], r["before"]) for r in ranks.range_rank(hot, ["k"], order, "rank", "n", {"before": "v"}).collect()}
    want = {r[0]: (i + 1, len(rows), sum(x[2] for x in rows[:i])) for rows in g.values() for i, r in enumerate(rows)}
    assert got == want
    assert {r["id"] for r in ranks.first_n(hot, ["k"], order, 7).collect()} == {r[0] for rows in g.values() for r in rows[:7]}
    assert {r["id"] for r in ranks.top_fraction(hot, ["k"], order, 0.1).collect()} == {r[0] for rows in g.values() for r in rows[: max(1, -(-len(rows) // 10))]}
    assert {r["id"] for r in ranks.until_goal(hot, ["k"], order, "v", F.lit(50)).collect()} == {r[0] for rows in g.values() for i, r in enumerate(rows) if sum(x[2] for x in rows[:i]) < 50}
    step = {k: max(1, len(rows) // 9) for k, rows in g.items()}
    assert {r["id"] for r in ranks.evenly_spaced(hot, ["k"], order, 9).collect()} == {r[0] for k, rows in g.items() for i, r in enumerate(rows) if i % step[k] == 0 and i // step[k] < 9}
    monkeypatch.setattr(ranks, "BLOCK", 16)
    rate = {r["id"]: r["rate"] for r in ranks.rolling_rate(hot, ["k"], order, F.col("f"), 10).collect()}
    want = {r[0]: sum(x[3] for x in rows[i - 9 : i + 1]) / 10 if i >= 9 else None for rows in g.values() for i, r in enumerate(rows)}
    assert rate.keys() == want.keys() and all((a is None) == (want[k] is None) and (a is None or abs(a - want[k]) < 1e-9) for k, a in rate.items())
    assert ranks.range_rank(hot.limit(0), ["k"], order).count() == 0


def test_groups_take_turns(hot):
    got = [r["id"] for r in ranks.interleaved(hot, "k", [F.col("v"), F.col("id")]).orderBy("place").collect()]
    g = by_key(hot_rows())
    names = sorted(k for k in g if k is not None) + [None]
    want = [r[0] for turn in itertools.zip_longest(*(g[k] for k in names)) for r in turn if r]
    assert got == want
    whole, ranks.GROUPS = ranks.GROUPS, 2  # too many groups for a list
    try:
        assert [r["id"] for r in ranks.interleaved(hot, "k", [F.col("v"), F.col("id")]).orderBy("place").collect()] == want
    finally:
        ranks.GROUPS = whole


def test_hashes_of_id_sets(spark, hot):
    ids = hot.select("k", F.concat(F.lit("x"), "id").alias("id"))
    g = by_key(hot_rows())
    digest = lambda xs: hashlib.sha256("\n".join(xs).encode()).hexdigest()
    want = {k: (len(v), digest(sorted(f"x{r[0]}" for r in v))) for k, v in g.items()}
    assert {r["k"]: (r["n_ids"], r["ids_hash"]) for r in aggregates.id_hash(ids, ["k"], "id").collect()} == want
    manifest = aggregates.bucket_hash(ids, ["k"], "id")
    assert {r["k"]: r["n_ids"] for r in manifest.collect()} == {k: len(v) for k, v in g.items()}
    assert all(r["valid"] for r in aggregates.verified(manifest, ids, ["k"], "id").collect())
    bad = {r["k"]: r["valid"] for r in aggregates.verified(manifest, ids.where("id <> 'x7'"), ["k"], "id").collect()}
    assert [k for k, ok in bad.items() if not ok] == [next(r[1] for r in hot_rows() if r[0] == 7)]


def test_interpolated_percentiles(spark):
    import numpy as np

    random.seed(1)
    rows = [(random.choice("ab"), random.choice([None, random.random()])) for _ in range(90)] + [("c", None), (None, 2.0)]
    got = {r["k"]: (r["m"], r["h"]) for r in aggregates.interpolated(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", {"m": 0.5, "h": 0.9}).collect()}
    for k in (None, "a", "b", "c"):
        v = [x for y, x in rows if y == k and x is not None]
        assert got[k] == (None, None) if not v else got[k] == pytest.approx(tuple(np.percentile(v, [50, 90])))


def test_functions_and_bodies(spark):
    src = 'M=a;F=f(x:i64):i64{let s="}{";if(x<1){<x};<s.len};F=g():Str!Err{<"a"};F=h(a:[i64];b:Str):bool;'
    df = spark.createDataFrame([(1, src), (2, None), (3, "")], "rec_id long, s string")
    got = [(r["fn"], r["params"], r["ret"], r["fails"]) for r in compose.functions_of(df, "rec_id", "s").orderBy("place").collect()]
    assert got == [("f", ["i64"], "i64", False), ("g", [], "Str", True), ("h", ["[i64]", "Str"], "bool", False)]
    spans = df.where("rec_id = 1").select(compose.bodies("s").alias("b")).first()["b"]
    assert [src[x["start"] : x["end"]] for x in spans] == ['F=f(x:i64):i64{let s="}{";if(x<1){<x};<s.len}', 'F=g():Str!Err{<"a"}', "F=h(a:[i64];b:Str):bool"]
    classes = compose.signature_classes(compose.functions_of(df, "rec_id", "s"), "rec_id")
    assert compose.compatible(classes).count() == 0  # f would only fit itself


def test_chains_and_pairs_of_classes_are_those_of_a_loop(spark):
    random.seed(5)
    types = ["i64", "Str", "bool"]
    fns = [(i, j, f"n{random.randrange(9)}", [random.choice(types) for _ in range(random.choice([1, 1, 2, 0]))], random.choice(types)) for i in range(30) for j in range(2)]
    src = {i: "".join(f"F={n}({';'.join(f'p{k}:{t}' for k, t in enumerate(p))}):{r}{{<1}};" for a, _, n, p, r in fns if a == i) for i in range(30)}
    f = compose.functions_of(spark.createDataFrame(list(src.items()), "rec_id long, s string"), "rec_id", "s")
    n = sum(a is not b and len(b[3]) == 1 and a[4] == b[3][0] for a in fns for b in fns)
    assert compose.compatible(compose.signature_classes(f, "rec_id")).agg(F.sum("n_pairs")).first()[0] == n
    for r in compose.chains(f, "rec_id").collect():
        assert r["h_fn"] not in (r["fn"], r["g_fn"]) and any(x[0] == r["g_id"] and x[2] == r["g_fn"] for x in fns)
    sigs = {(i, j): (p, r) for i, j, _, p, r in fns}
    for r in compose.fan_outs(f, "rec_id").collect():
        p, ret = sigs[r["rec_id"], r["place"]]
        assert any(sigs[r["other_id"], j] == (p, ret) for j in (0, 1)) and len(p) == 1


def test_text_helpers(spark):
    assert col(spark, ["a  =  1 (* x y *) ;\t\"b  c\" d", None], X.canonical_source) == ['a=1;"b  c"d', None]
    assert col(spark, ["let  a = b\n c", "  x ", '"a  b"  c', ""], X.compact) == ["let a=b c", "x", '"a  b"c', ""]
    assert col(spark, ["TRUE  1.50 x\r\n\n", "-0.00", "1e5 2.", "\n\n"], X.canonical_output) == ["true 1.5 x", "0", "1e5 2.", ""]
    assert col(spark, ["Two Words_3!", "!!", None], X.slug) == ["twowords3", "unnamed", None]
    assert col(spark, [1.5, float("nan"), float("inf"), None], X.finite, "double") == [1.5, None, None, None]
    assert col(spark, ["MIT License ..", "GNU General Public License", "BSD 3-Clause", "", None], X.license_class) == ["MIT", "GPL", "BSD-3-Clause", "unknown", "unknown"]
    assert col(spark, ["[ Str ]", "$I64"], X.plain_type) == ["@str", "i64"]
    assert col(spark, ["M=bank;F=fn1(x:i64){let total=1}", "M=v1;F=p2(n:i64){}", ""], X.coherence) == [0.5, 0.0, 0.0]
    df = spark.createDataFrame([(["1.0", " a", "x"], ["1.0000000001", "a"]), (["1"], ["1", "2"]), (["b"], ["c"]), ([], [])], "g array<string>, w array<string>")
    assert [r[0] for r in df.select(X.lines_match(F.col("g"), F.col("w"))).collect()] == [True, False, False, True]
    df = spark.createDataFrame([(["a", "a", "a", "a", "b", None],), (None,), ([],)], "c array<string>")
    assert [round(r[0], 6) for r in df.select(X.penalised(F.col("c"), {"a": 0.2}, 0.05, 3)).collect()] == [0.35, 1.0, 1.0]


def test_representative_rows(spark):
    rows = [(i, "p" if i % 10 else "q", f"c{i % 3}") for i in range(300)]
    got = splits.representative(spark.createDataFrame(rows, "id long, phase string, category string"), "phase", "category", "id", 60, 1).collect()
    assert len(got) == 60
    per = {}
    for r in got:
        if r["chosen"]:
            per[r["phase"], r["category"]] = per.get((r["phase"], r["category"]), 0) + 1
    assert set(per.values()) == {10} and len(per) == 6


def test_rewrites_leave_literals_alone(spark):
    src = ['while(i<=3){s=s+"a<=b, c";i++}else{return f(a, b)};', "let mut x = 1;x=mut.2;", "if(a&&b){c}", '"only, text"', "", None]
    df = spark.createDataFrame(list(enumerate(src)), "i int, s string")
    got = {r["i"]: (r["text"], r["fixes"]) for r in W.rewritten(df, "s", W.FIXES).collect()}
    assert got[0] == ('lp(!(i>3)){s=s+"a<=b, c";i=i+1}el{<f(a;b)};', ["loop_word", "else_word", "return_word", "at_most", "increment", "comma"])
    assert got[1][0] == "let x=mut.1;x=2;" and got[2][0] == "if(a){if(b){c}}" and got[3] == ('"only, text"', []) and got[4] == ("", []) and got[5] == (None, None)
    d = [r["text"] for r in W.rewritten(spark.createDataFrame([('M=a;F=f(x:[i64]):Point{<x[y[0]]+"M=[1]";z=[1;[2]]};',)], "s string").select(W.default_types(F.col("s")).alias("s")), "s", W.DEFAULT).collect()]
    assert d == ['m=a;f=f(x:@i64):$point{<x.get(y.get(0))+"M=[1]";z=@(1;@(2))};']


def test_layouts_take_each_other_back(spark):
    src = ['M=a;F=f(x:i64):i64{let a="x;  {y}";if(a=1){<a};<x};', "", "let a=1"]
    assert col(spark, src, lambda c: X.compact(W.expanded(c))) == src
    assert col(spark, src[2:], W.expanded) == ["let a = 1"]


def test_guards(spark):
    src = 'F=f(a:Str;n:i64):i64{<n};F=g(x:[i64]):i64{<x[0]};F=h(x:bool):bool{<x};F=k(x:i64):Str!Err{<x};'
    f = compose.functions_of(spark.createDataFrame([(1, src)], "rec_id long, s string"), "rec_id", "s")
    got = {(r["place"], r["kind"]): r["wrapper"] for r in compose.guarded(f, "rec_id").collect()}
    assert set(got) == {(0, "empty"), (0, "negative"), (0, "clamp"), (1, "empty"), (1, "single"), (2, "twice")}
    assert got[0, "clamp"] == "F=clampF(p0:Str;p1:i64):i64{let c=mut.p1;if(c<0){c=0};if(c>1000){c=1000};<f(p0;c)};"
    assert got[1, "single"] == "F=singleG(p0:[i64]):i64{if(p0.len=1){<p0[0]};<g(p0)};"


def test_python_functions_and_grammar(spark):
    from sparkloom.operators import harvest

    src = ["def f(a: int, b) -> bool:\n    return a > b\n\nx = 1\ndef g():\n    print(1)\n", "def broken(:", None, "", "class A:\n    def m(self): pass"]
    got = harvest.python_functions(spark.createDataFrame(list(enumerate(src)), "rec_id long, s string"), "rec_id", "s").orderBy("place").collect()
    assert [(r["rec_id"], r["name"], r["params"], r["returns"], r["n_lines"], r["pure"]) for r in got] == [(0, "f", "a:int,b", "bool", 2, True), (0, "g", "", None, 2, False)]
    a = {r["i"]: r["source"] for r in harvest.grammar_programs(spark, 60, 3).collect()}
    assert a == {i: harvest.Grammar(f"3:{i}").program(f"fuzz{i}") for i in range(60)} and len(set(a.values())) == 60
    for s in a.values():
        depth = 0
        for c in s:
            depth += (c == "{") - (c == "}")
            assert depth >= 0
        assert depth == 0 and s.count("(") == s.count(")")


def test_exports_and_snapshots(spark, tmp_path):
    from sparkloom.operators import gates
    from sparkloom.sources import sinks

    df = spark.createDataFrame([("a", "x", "plain"), ("b", "y", None)], "id string, phase string, t string")
    assert gates.refused(df, "t", {"claim": "faster"}).count() == 2
    with pytest.raises(ValueError, match="claim"):
        gates.refused(df, "t", {"claim": "plain", "other": "z"})
    digest = sinks.frozen(df, str(tmp_path / "f"), "id")
    assert digest == aggregates.bucket_hash(df.withColumn("g", F.lit(1)), ["g"], "id").first()["ids_hash"]
    with pytest.raises(Exception):
        sinks.frozen(df, str(tmp_path / "f"), "id")
    sinks.phased(df, str(tmp_path / "p"), "phase")
    assert {r["phase"]: r["n_rows"] for r in spark.read.json(str(tmp_path / "p.stats")).collect()} == {"x": 1, "y": 1}


def test_assignments_follow_their_shares(spark):
    from sparkloom.operators import select

    df = select.assigned(spark.range(1, 2001).withColumnRenamed("id", "r"), "r", {"a": 600_000, "b": 300_000, "c": 100_000})
    who = [r["assigned"] for r in df.orderBy("r").collect()]
    for n in (10, 100, 777, 2000):
        for key, share in (("a", 0.6), ("b", 0.3), ("c", 0.1)):
            assert abs(who[:n].count(key) - share * n) < 6


def test_differences_of_outputs(spark):
    rows = [("1\n2", "1\r\n2\n", "none"), ("1", "1\n2", "wrong_line_count"), ("5\n7", "5\n8", "off_by_one"), ("5\n7", "5\n0", "returns_zero"), ("a\n7", "b\n8", "algorithm_bug"), ("5", "9", "algorithm_bug"), (None, "1", None)]
    df = spark.createDataFrame(rows, "w string, g string, k string")
    assert [r[0] for r in df.select(X.difference(F.col("w"), F.col("g"))).collect()] == [k for _, _, k in rows]


def test_a_stream_stops_at_its_budget_and_goes_on(spark, tmp_path):
    from sparkloom.streaming import streams

    for i in range(6):
        spark.createDataFrame([(i, 2.0)], "id long, cost double").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    read = lambda: streams.read(spark, str(tmp_path / "in"), "id long, cost double", 1)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    assert streams.run_within(read(), streams.append_sink(out), state, "cost", 4.0) is False
    assert spark.read.parquet(out).count() == 2
    assert streams.run_within(read(), streams.append_sink(out), state, "cost", 100.0) is True
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(6))


def test_grids_are_for_small_dimensions(spark):
    from sparkloom.operators import joins

    assert joins.grid(spark.range(3), spark.range(2).withColumnRenamed("id", "b")).count() == 6
    with pytest.raises(ValueError):
        joins.grid(spark.range(30), spark.range(2).withColumnRenamed("id", "b"), most=10)


@pytest.mark.parametrize(
    "source,program",
    [
        ("def f(a: int, b: list[str]) -> bool:\n    \"\"\"doc\"\"\"\n    c = a * 2 + len(b)\n    c += 1\n    if c >= 3 and not b[0] == 'x;':\n        return True\n    else:\n        c = 0\n    return 1 < c != 4", 'M=m;F=f(a:i64;b:[Str]):bool{let c=mut.((a*2)+b.len);c=c+1;if(((!(c<3))&(!(b[0]="x;")))){<true}el{c=0};<((1<c)&(!(c=4)))};'),
        ("def g(n: int) -> int:\n    s = 0\n    for i in range(1, n):\n        if i % 2 == 0:\n            break\n        s = s - -i\n    while s > 9:\n        t = g(s)\n        s = t\n    return s", "M=m;F=g(n:i64):i64{let s=mut.0;lp(let i=1;i<n;i=i+1){if((i%2)=0){br};s=(s-(0-i))};lp(let w1=0;s>9;w1=0){let t=mut.g(s);s=t};<s};"),
        ("def h(x):\n    return x", None), ("x = 1", None), ("def h(:", None), ("def k(s: str) -> str:\n    return s.title()", None),
        ("def k(s: str, xs: list[int]) -> str:\n    t = 0\n    for x in xs:\n        t += x\n    return s.strip()[:t]", "M=m;I=str:std.str;F=k(s:Str;xs:[i64]):Str{let t=mut.0;lp(let i1=0;i1<xs.len;i1=i1+1){let x=xs[i1];t=t+x};<str.slice(str.trim(s);0;t)};"),
    ],
)
def test_python_as_programs(source, program):
    from sparkloom.operators import transpile

    got, why = transpile.transpiled(source, "m")
    assert got == program and (why is None) == (program is not None)


def test_files_are_rewritten_with_a_backup(spark, tmp_path):
    from sparkloom.sources import sinks

    path = str(tmp_path / "rows")
    spark.createDataFrame([(1, 'a==b;"a==b"'), (2, "x"), (3, None)], "id long, s string").write.json(path)
    got = sinks.rewritten(spark, path, "s", W.FIXES)
    assert [tuple(r) for r in got.collect()] == [("double_equals", 1)]
    assert {r["id"]: r["s"] for r in spark.read.json(path).collect()} == {1: 'a=b;"a==b"', 2: "x", 3: None}
    assert spark.read.json(path + ".bak").where("id = 1").first()["s"] == 'a==b;"a==b"'
    with pytest.raises(FileExistsError):
        sinks.rewritten(spark, path, "s", W.FIXES)


def test_harder_forms(spark):
    from sparkloom.operators import generate

    df = spark.createDataFrame([(1, "Sort {n} things."), (2, None)], "k long, t string")
    got = generate.evolved(df, "k", "t", {"a": "{task} Twice.", "b": "In {n}: {task}"}).collect()
    assert {r["k"] for r in got} == {1} and [r["text"] for r in got if r["dimension"] == "a"] == ["Sort {n} things. Twice."]
    assert all(r["text"].endswith(": Sort {n} things.") and r["text"][3] in "23456789" for r in got if r["dimension"] == "b")
