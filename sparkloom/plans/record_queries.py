"""Record-level checks, scores and reports over the test tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import aggregates as A
from ..operators import compose as C
from ..operators import joins as J
from ..operators import ranks as R
from ..operators import splits as P
from .registry import query, table

_FUNCS = rf"""h AS (SELECT rec_id, {", ".join(f"regexp_extract_all(tk_source, '{C.HEAD}', {k}) AS x{k}" for k in (1, 2, 3, 4))} FROM programs WHERE tk_source IS NOT NULL),
z AS (SELECT rec_id, unnest(range(len(x1))) AS place, unnest(x1) AS fn, unnest(x2) AS ps, unnest(x3) AS ret, unnest(x4) AS err FROM h),
f AS (SELECT rec_id, place, fn, list_filter(list_transform(string_split(ps, ';'), lambda p: trim(split_part(p, ':', 2))), lambda t: t <> '') AS params, ret, coalesce(length(err) > 0, false) AS fails FROM z)"""


def _functions(spark, d):
    return C.functions_of(table(spark, d, "programs").select("rec_id", "tk_source"), "rec_id", "tk_source")


@query(f"WITH {_FUNCS} SELECT rec_id, place, fn, array_to_string(params, ',') AS params, ret, fails FROM f")
def function_signatures(spark, d):
    return _functions(spark, d).select("rec_id", "place", "fn", F.array_join("params", ",").alias("params"), "ret", "fails")


@query()
def function_bodies(spark, d):
    """Places of the functions of every program, by brace matching; no SQL, see tests/test_records.py."""
    p = table(spark, d, "programs").where("tk_source is not null")
    return p.select("rec_id", F.posexplode(C.bodies("tk_source")).alias("place", "b")).select("rec_id", "place", "b.fn", "b.start", "b.end")


_CLASSES = "c AS (SELECT array_to_string(params, ',') || '->' || ret || CASE WHEN fails THEN '!' ELSE '' END AS signature, params, ret, fails, count(*) AS n, min({'id': rec_id, 'place': place}) AS f FROM f GROUP BY 1, 2, 3, 4)"


@query(f"WITH {_FUNCS}, {_CLASSES} SELECT signature, n, f.id AS first_id, f.place AS first_place FROM c")
def signature_classes(spark, d):
    return C.signature_classes(_functions(spark, d), "rec_id").select("signature", "n", "first_id", "first_place")


@query(f"""WITH {_FUNCS}, {_CLASSES}, p AS (SELECT a.signature AS producer, b.signature AS consumer, a.n * b.n - CASE WHEN a.signature = b.signature THEN a.n ELSE 0 END AS n_pairs FROM c a JOIN c b ON len(b.params) = 1 AND a.ret = b.params[1] WHERE NOT a.fails AND NOT b.fails)
SELECT producer, consumer, n_pairs FROM p WHERE n_pairs > 0""")
def compatible_classes(spark, d):
    """Pairs of signature classes whose functions compose; signature_classes and function_signatures hold the members."""
    return C.compatible(C.signature_classes(_functions(spark, d), "rec_id"))


@query(f"""WITH {_FUNCS}, k AS (SELECT *, sha256(rec_id || ':' || place) AS h FROM f WHERE NOT fails), s AS (SELECT *, params[1] AS t, row_number() OVER (PARTITION BY params[1] ORDER BY h, rec_id, place) AS r FROM k WHERE len(params) = 1),
o AS (SELECT a.rec_id, a.place, a.fn, g.rec_id AS g_id, g.fn AS g_fn, x.rec_id AS h_id, x.fn AS h_fn, row_number() OVER (PARTITION BY a.rec_id, a.place ORDER BY g.h, g.rec_id, g.place, x.h, x.rec_id, x.place) AS r FROM k a JOIN s g ON g.t = a.ret AND g.r <= 3 AND (g.rec_id, g.place) <> (a.rec_id, a.place) JOIN s x ON x.t = g.ret AND x.r <= 3 AND x.fn <> a.fn AND x.fn <> g.fn)
SELECT rec_id, place, fn, g_id, g_fn, h_id, h_fn FROM o WHERE r = 1""")
def function_chains(spark, d):
    return C.chains(_functions(spark, d), "rec_id")


@query(f"""WITH {_FUNCS}, k AS (SELECT *, sha256(rec_id || ':' || place) AS h FROM f WHERE NOT fails AND len(params) = 1 AND ret IN ('i64', 'u64', 'f64')),
o AS (SELECT rec_id, place, fn, lead(rec_id) OVER w AS other_id, lead(fn) OVER w AS other_fn FROM k WINDOW w AS (PARTITION BY params[1], ret ORDER BY h, rec_id, place))
SELECT rec_id, place, other_id, other_fn FROM o WHERE other_fn <> fn""")
def fan_out_pairs(spark, d):
    return C.fan_outs(_functions(spark, d), "rec_id")


_PLAIN = r"""regexp_replace(tk_source, '"(\\.|[^"\\])*"', '""', 'g')"""
_DECLARED, _DEFINED = r"F=[A-Za-z0-9_]+\([^()]*\):[^{};]*[{;]", r"F=[A-Za-z0-9_]+\([^()]*\):[^{};]*\{"


@query(f"SELECT rec_id, CASE WHEN len(regexp_extract_all({_PLAIN}, '{_DECLARED}')) = 0 THEN 'no function' WHEN len(regexp_extract_all({_PLAIN}, '{_DEFINED}')) = 0 THEN 'declarations only' END AS reason FROM programs WHERE tk_source IS NOT NULL")
def shape_check(spark, d):
    """Why a source is no program: it declares no function, or none with a body."""
    s = X.without_literals(F.col("tk_source"))
    n = lambda rx: F.size(F.regexp_extract_all(s, F.lit(rx), F.lit(0)))
    reason = F.when(n(_DECLARED) == 0, "no function").when(n(_DEFINED) == 0, "declarations only")
    return table(spark, d, "programs").where("tk_source is not null").select("rec_id", reason.alias("reason"))


_RULES = {"upper_case": "[A-Za-z_][A-Za-z0-9_]*[A-Z][A-Za-z0-9_]*|[A-Z][A-Za-z0-9_]*", "underscore": "[A-Za-z0-9]*_[A-Za-z0-9_]*", "double_equals": "==", "comma": ",", "square_bracket": r"[\[\]]"}
_FIXABLE = [r for r in _RULES if r != "square_bracket"]


@query("WITH l AS (SELECT rec_id, unnest(range(1, len(x) + 1)) AS line, unnest(x) AS t FROM (SELECT rec_id, string_split(" + _PLAIN + ", chr(10)) AS x FROM programs WHERE tk_source IS NOT NULL)), m AS ("
       + " UNION ALL ".join(f"SELECT rec_id, line, '{r}' AS rule, regexp_extract_all(t, '{p}') AS hits, string_split_regex(t, '{p}') AS parts FROM l" for r, p in _RULES.items())
       + f"), o AS (SELECT rec_id, line, rule, hits, parts, unnest(range(1, len(hits) + 1)) AS i FROM m) SELECT rec_id, rule, line, (1 + list_sum(list_transform(list_slice(parts, 1, i), lambda x: length(x))) + coalesce(list_sum(list_transform(list_slice(hits, 1, i - 1), lambda x: length(x))), 0))::BIGINT AS col, rule <> 'square_bracket' AS fixable FROM o")
def violations(spark, d):
    """rule, line, column (from 1, literals emptied) and fixable of every hit of a rule."""
    lines = table(spark, d, "programs").where("tk_source is not null").select("rec_id", F.posexplode(F.split(X.without_literals(F.col("tk_source")), "\n", -1)).alias("line", "t"))
    hits = F.array(*(F.struct(F.lit(r).alias("rule"), F.regexp_extract_all("t", F.lit(p), F.lit(0)).alias("hits"), F.split("t", p, -1).alias("parts")) for r, p in _RULES.items()))
    rows = lines.select("rec_id", (F.col("line") + 1).cast("long").alias("line"), F.explode(hits).alias("m")).select("rec_id", "line", "m.*").where("size(hits) > 0")
    rows = rows.select("rec_id", "line", "rule", "hits", "parts", F.explode(F.sequence(F.lit(1), F.size("hits"))).alias("i"))
    total = lambda a, n: F.aggregate(F.slice(a, F.lit(1), n), F.lit(0).cast("long"), lambda s, x: s + F.length(x))
    return rows.select("rec_id", "rule", "line", (1 + total("parts", F.col("i")) + total("hits", F.col("i") - 1)).alias("col"), F.col("rule").isin(*_FIXABLE).alias("fixable"))


@query("""SELECT rec_id, CASE WHEN broken_source IS NULL OR trim(broken_source) = '' THEN 'no_broken' WHEN fixed_source IS NULL OR trim(fixed_source) = '' THEN 'no_fixed' WHEN broken_source = fixed_source THEN 'same' WHEN len(list_filter(coalesce(diagnostics, []), lambda x: x.severity = 'error')) = 0 THEN 'broken_passes' END AS fault FROM negative_examples""")
def triple_validity(spark, d):
    """Whether the broken source fails with an error and the fixed one differs from it."""
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    errors = F.coalesce(F.size(F.filter("diagnostics", lambda x: x["severity"] == "error")), F.lit(0))
    fault = F.when(blank("broken_source"), "no_broken").when(blank("fixed_source"), "no_fixed").when(F.col("broken_source") == F.col("fixed_source"), "same").when(errors <= 0, "broken_passes")
    return table(spark, d, "negative_examples").select("rec_id", fault.alias("fault"))


@query("""SELECT rec_id, task_id FROM programs p WHERE tk_source IS NOT NULL AND length(tk_source) <= 800 AND coalesce(model, '') NOT IN ('hand', 'retry-loop') AND NOT EXISTS (SELECT 1 FROM negative_examples n WHERE n.task_id = p.task_id)""")
def clean_pairs(spark, d):
    """Programs of a bounded size, not of excluded owners, whose task is not in use by the negative examples."""
    p = table(spark, d, "programs").where("length(tk_source) <= 800").where(~F.coalesce("model", F.lit("")).isin("hand", "retry-loop")).select("rec_id", "task_id")
    return p.join(table(spark, d, "negative_examples").select("task_id"), "task_id", "left_anti").select("rec_id", "task_id")


_TYPE_SQL = "lower(replace(replace(replace(regexp_replace({}, '\\s+', '', 'g'), '$', ''), '[', '@'), ']', ''))"


@query(f"WITH {_FUNCS} SELECT declared, {_TYPE_SQL.format('declared')} AS plain, count(*) AS n_uses FROM (SELECT ret AS declared FROM f UNION ALL SELECT unnest(params) FROM f) GROUP BY 1")
def type_forms(spark, d):
    """Types as declared and in their form for comparison (lower case, arrays as @T)."""
    f = _functions(spark, d)
    t = f.select(F.col("ret").alias("declared")).unionByName(f.select(F.explode("params").alias("declared")))
    return t.groupBy("declared").agg(F.count("*").alias("n_uses")).withColumn("plain", X.plain_type(F.col("declared")))


@query(f"""WITH {_FUNCS}, g AS (SELECT p.task_id, f.fn, f.place, {_TYPE_SQL.format("f.ret")} AS ret, list_transform(f.params, lambda x: {_TYPE_SQL.format("x")}) AS params FROM f JOIN programs p USING (rec_id) WHERE p.task_id IS NOT NULL AND f.place = 0),
n AS (SELECT task_id, array_to_string(params, ',') || '->' || ret AS s, count(*) AS n FROM g GROUP BY 1, 2), w AS (SELECT task_id, s, n, row_number() OVER (PARTITION BY task_id ORDER BY n DESC, s) AS r, sum(n) OVER (PARTITION BY task_id) AS total, count(*) OVER (PARTITION BY task_id) AS forms FROM n)
SELECT task_id, s AS common, n::BIGINT AS n_conform, (total - n)::BIGINT AS n_drift, forms AS n_forms FROM w WHERE r = 1""")
def signature_drift(spark, d):
    """The commonest signature of each task's first function and the programs that drift from it."""
    f = _functions(spark, d).where("place = 0").join(table(spark, d, "programs").select("rec_id", "task_id").where("task_id is not null"), "rec_id")
    s = F.concat(F.array_join(F.transform("params", X.plain_type), ","), F.lit("->"), X.plain_type(F.col("ret")))
    n = f.groupBy("task_id", s.alias("s")).agg(F.count("*").alias("n"))
    g = n.groupBy("task_id").agg(F.min(F.struct((-F.col("n")).alias("neg"), "s")).alias("m"), F.sum("n").alias("total"), F.count("*").alias("n_forms"))
    return g.select("task_id", F.col("m.s").alias("common"), (-F.col("m.neg")).alias("n_conform"), (F.col("total") + F.col("m.neg")).alias("n_drift"), "n_forms")


_DEPTH = "coalesce(list_max(list_transform(range(1, length(b) + 1), lambda i: length(replace(substr(b, 1, i), '}', '')) - length(replace(substr(b, 1, i), '{', '')))), 0)"


@query(f"""WITH s AS (SELECT rec_id, tk_source AS s, regexp_replace(tk_source, '[^{{}}]', '', 'g') AS b FROM programs WHERE tk_source IS NOT NULL), n AS (SELECT rec_id, s, length(s) - length(replace(s, ';', '')) + 1 AS loc, {_DEPTH} AS depth, len(regexp_extract_all(s, '\\bF=')) AS fns FROM s),
p AS (SELECT rec_id, (loc > 15)::INT + (loc > 30)::INT + (depth > 2)::INT + (depth > 4)::INT + (fns > 2)::INT + (s LIKE '%T=%')::INT + (s LIKE '%I=%')::INT AS points FROM n)
SELECT rec_id, points::BIGINT AS points, CASE WHEN points <= 1 THEN 'beginner' WHEN points <= 3 THEN 'intermediate' ELSE 'advanced' END AS tier FROM p""")
def difficulty(spark, d):
    """Points for length, depth, functions, types and imports; three tiers."""
    s = F.col("tk_source")
    loc, depth, fns = X.count_of(s, ";") + 1, X.nesting_depth(s, False), F.size(F.regexp_extract_all(s, F.lit(r"\bF="), F.lit(0)))
    points = sum((F.when(c, 1).otherwise(0) for c in (loc > 15, loc > 30, depth > 2, depth > 4, fns > 2, s.contains("T="), s.contains("I="))), F.lit(0))
    p = table(spark, d, "programs").where("tk_source is not null").select("rec_id", points.cast("long").alias("points"))
    return p.withColumn("tier", F.when(F.col("points") <= 1, "beginner").when(F.col("points") <= 3, "intermediate").otherwise("advanced"))


_WORDS = ["M=", "F=", "T=", "I=", "if(", "el{", "lp(", "let ", "mut.", " as ", "br"]


@query("SELECT rec_id, CASE WHEN coalesce(validation.compiler_exit_code, 1) <> 0 THEN 0.0 ELSE round(least(1.0, 0.4 + CASE WHEN length(tk_source) > 500 THEN 0.2 WHEN length(tk_source) >= 50 THEN 0.1 ELSE 0 END + least(0.2, 0.02 * ("
       + " + ".join(f"contains(tk_source, '{w}')::INT" for w in _WORDS)
       + ")) + 0.05 * (starts_with(tk_source, 'M=')::INT + contains(tk_source, 'F=')::INT + regexp_matches(tk_source, 'if\\(|el\\{|lp\\(')::INT + (contains(tk_source, 'T=') AND contains(tk_source, '{'))::INT)), 6) END::DOUBLE AS score FROM programs WHERE tk_source IS NOT NULL")
def telemetry_score(spark, d):
    """Worth of a program that compiles: length, different keywords and constructs."""
    s = F.col("tk_source")
    one = lambda c: F.when(c, 1).otherwise(0)
    size = F.when(F.length(s) > 500, 0.2).when(F.length(s) >= 50, 0.1).otherwise(0.0)
    used = sum((one(s.contains(w)) for w in _WORDS), F.lit(0))
    parts = one(s.startswith("M=")) + one(s.contains("F=")) + one(s.rlike(r"if\(|el\{|lp\(")) + one(s.contains("T=") & s.contains("{"))
    score = F.when(F.coalesce("validation.compiler_exit_code", F.lit(1)) != 0, 0.0).otherwise(F.round(F.least(F.lit(1.0), 0.4 + size + F.least(F.lit(0.2), 0.02 * used) + 0.05 * parts), 6))
    return table(spark, d, "programs").where("tk_source is not null").select("rec_id", score.alias("score"))


@query("""WITH x AS (SELECT rec_id, diagnostics AS v, CASE WHEN difficulty = 'hard' THEN ['E44', 'E45'] WHEN mutation_type IS NULL THEN ['E48'] ELSE [] END AS exempt FROM negative_examples)
SELECT rec_id, len(list_filter(coalesce(v, []), lambda d: d.severity IN ('error', 'warning') AND coalesce(NOT list_contains(exempt, substr(d.code, 1, 3)), false)))::BIGINT AS n_net, len(list_filter(coalesce(v, []), lambda d: d.severity IN ('error', 'warning')))::BIGINT AS n_gross FROM x""")
def hard_gate(spark, d):
    """Diagnostics that fail a record, before and after its exemptions."""
    exempt = F.when(F.col("difficulty") == "hard", F.array(F.lit("E44"), F.lit("E45"))).when(F.col("mutation_type").isNull(), F.array(F.lit("E48"))).otherwise(F.array().cast("array<string>"))
    serious = lambda x: x["severity"].isin("error", "warning")
    n = table(spark, d, "negative_examples").select("rec_id", F.coalesce("diagnostics", F.array()).alias("v"), exempt.alias("x"))
    net = F.filter("v", lambda x: serious(x) & ~F.array_contains(F.col("x"), F.substring(x["code"], 1, 3)))
    return n.select("rec_id", F.size(net).cast("long").alias("n_net"), F.size(F.filter("v", serious)).cast("long").alias("n_gross"))


@query("""WITH m AS (SELECT category, median(tk_tokens)::DOUBLE AS m FROM programs WHERE tk_tokens > 0 GROUP BY 1), o AS (SELECT p.category, f.factor, count(*) FILTER (p.tk_tokens > round(f.factor * m.m)) / count(*) AS share FROM programs p JOIN m ON m.category IS NOT DISTINCT FROM p.category, (VALUES (1.0), (1.25), (1.5), (2.0), (3.0)) f(factor) WHERE p.tk_tokens > 0 GROUP BY 1, 2)
SELECT category, min(factor)::DOUBLE AS factor, round(max_by(share, -factor), 6) AS share FROM o WHERE share <= 0.25 GROUP BY 1""")
def smallest_budget(spark, d):
    """The smallest factor of the median for which at most a quarter of a category is over its budget."""
    p = table(spark, d, "programs").where("tk_tokens > 0").select("category", "tk_tokens")
    m = p.groupBy(F.col("category").alias("c")).agg(F.median("tk_tokens").alias("m"))
    over = [F.count_if(F.col("tk_tokens") > F.round(f * F.col("m"))).alias(f"o{i}") for i, f in enumerate((1.0, 1.25, 1.5, 2.0, 3.0))]
    n = p.join(m, F.col("category").eqNullSafe(F.col("c"))).groupBy("category").agg(F.count("*").alias("n"), *over)
    shares = F.array(*(F.struct(F.lit(f).alias("factor"), (F.col(f"o{i}") / F.col("n")).alias("share")) for i, f in enumerate((1.0, 1.25, 1.5, 2.0, 3.0))))
    best = F.get(F.filter(shares, lambda x: x["share"] <= 0.25), F.lit(0))
    return n.withColumn("b", best).where("b is not null").select("category", "b.factor", F.round("b.share", 6).alias("share"))


_NUMBER = "try_cast(trim({}) AS DOUBLE)"


@query(f"""WITH p AS (SELECT rec_id, string_split(coalesce(broken_source, ''), ';') AS g, string_split(coalesce(fixed_source, ''), ';') AS w FROM negative_examples)
SELECT rec_id, len(g) >= len(w) AND coalesce(list_bool_and(list_transform(range(1, len(w) + 1), lambda i: trim(g[i]) = trim(w[i]) OR coalesce(abs({_NUMBER.format("g[i]")} - {_NUMBER.format("w[i]")}) < 1e-6, false))), true) AS matches, len(g) - len(w) AS extra FROM p""")
def tolerant_compare(spark, d):
    """Whether the parts of one text match those of another one by one, numbers to 1e-6, and how many it has more."""
    parts = lambda c: F.split(F.coalesce(c, F.lit("")), ";", -1)
    return table(spark, d, "negative_examples").select("rec_id", X.lines_match(parts("broken_source"), parts("fixed_source")).alias("matches"), (F.size(parts("broken_source")) - F.size(parts("fixed_source"))).cast("long").alias("extra"))


@query("""WITH o AS (SELECT rec_id, phase, category, row_number() OVER (PARTITION BY phase, category ORDER BY sha256('8:' || rec_id), rec_id) AS r FROM programs), k AS (SELECT count(*) AS n FROM (SELECT DISTINCT phase FROM programs)), c AS (SELECT phase, count(*) AS n FROM (SELECT DISTINCT phase, category FROM programs) GROUP BY 1),
s AS (SELECT o.*, r <= greatest(1, greatest(1, 150 // k.n) // c.n) AS chosen FROM o CROSS JOIN k JOIN c ON c.phase IS NOT DISTINCT FROM o.phase), t AS (SELECT *, row_number() OVER (ORDER BY chosen DESC, sha256('8:' || rec_id), rec_id) AS place FROM s)
SELECT rec_id, chosen FROM t WHERE place <= 150""")
def representative_subset(spark, d):
    """150 programs with an equal share for each phase and, in it, each category; topped up in hash order."""
    return P.representative(table(spark, d, "programs").select("rec_id", "phase", "category"), "phase", "category", "rec_id", 150, 8).select("rec_id", "chosen")


_MASKED = r"""regexp_replace(tk_source, '"(\\.|[^"\\])*"', '""', 'g')"""


@query(rf"""WITH m AS (SELECT rec_id, {_MASKED} AS m FROM programs WHERE tk_source IS NOT NULL)
SELECT rec_id, CASE WHEN regexp_matches(m, '[^\x{{20}}-\x{{7e}}\r\n\t]') THEN 'charset' WHEN strlen(m) > 2000 THEN 'oversize' END AS reason, strlen(m) AS n_bytes FROM m""")
def mask_stage(spark, d):
    """Sources with literals masked: those with characters outside the set, then those that are too long."""
    m = table(spark, d, "programs").where("tk_source is not null").select("rec_id", X.without_literals(F.col("tk_source")).alias("m"))
    n = F.octet_length("m").cast("long")
    return m.select("rec_id", F.when(F.col("m").rlike(r"[^\x{20}-\x{7e}\r\n\t]"), "charset").when(n > 2000, "oversize").alias("reason"), n.alias("n_bytes"))


_CANON = rf"""regexp_replace(tk_source, '("(?:\\.|[^"\\])*")|\(\*(?s:.*?)\*\)|{X.BLANK}+', '\1', 'g')"""
_BARE = rf"""regexp_replace(tk_source, '("(?:\\.|[^"\\])*")|{X.BLANK}+', '\1', 'g')"""


@query(f"SELECT sha256({_BARE}) AS bare_hash, sha256({_CANON}) AS canonical_hash, count(*) AS n_rows, min(rec_id) AS first_id FROM programs WHERE tk_source IS NOT NULL GROUP BY 1, 2")
def canonical_sources(spark, d):
    """Programs without white space outside literals, and also without comments."""
    p = table(spark, d, "programs").where("tk_source is not null")
    h = p.select("rec_id", F.sha2(X.without_blanks(F.col("tk_source")), 256).alias("bare_hash"), F.sha2(X.canonical_source(F.col("tk_source")), 256).alias("canonical_hash"))
    return h.groupBy("bare_hash", "canonical_hash").agg(F.count("*").alias("n_rows"), F.min("rec_id").alias("first_id"))


@query("""WITH b AS (SELECT split, substr(sha256(id), 1, 3) AS b, tk_source IS NOT NULL AS s, id FROM programs), x AS (SELECT split, b, sha256(string_agg(id, chr(10) ORDER BY id)) AS a, sha256(string_agg(id, chr(10) ORDER BY id) FILTER (s)) AS f, count(*) FILTER (s) AS n FROM b GROUP BY 1, 2)
SELECT split, sha256(string_agg(f, chr(10) ORDER BY b) FILTER (n > 0)) AS frozen, sha256(string_agg(f, chr(10) ORDER BY b) FILTER (n > 0)) = sha256(string_agg(a, chr(10) ORDER BY b)) AS valid FROM x GROUP BY 1 HAVING sum(n) > 0""")
def manifest_verify(spark, d):
    """A manifest frozen from the programs with a source, against the programs as they are."""
    p = table(spark, d, "programs")
    frozen = A.bucket_hash(p.where("tk_source is not null"), ["split"], "id")
    return A.verified(frozen, p, ["split"], "id").select("split", F.col("ids_hash").alias("frozen"), "valid")


@query("SELECT rec_id, r <= greatest(1, floor(n * 0.05)) AS evaluation FROM (SELECT rec_id, row_number() OVER (ORDER BY sha256('6:' || rec_id), rec_id) AS r, count(*) OVER () AS n FROM programs)")
def shuffled_split(spark, d):
    """The first twentieth in seeded order for evaluation."""
    p = table(spark, d, "programs").select("rec_id").withColumn("h", R.seeded(F.col("rec_id"), 6))
    n = p.agg(F.count("*").alias("n"))
    return R.bucket_rank(p, R.hash_bucket(F.col("h")), [F.col("h"), F.col("rec_id")]).join(F.broadcast(n)).select("rec_id", (F.col("rank") <= F.greatest(F.lit(1), F.floor(F.col("n") * 0.05))).alias("evaluation"))


_BATCH = "(SELECT (row_number() OVER (ORDER BY rec_id) - 1) // 20 AS batch, rec_id, toke_source, coalesce(toke_tokens, 0) AS n FROM parallel_corpus)"


def _batches(spark, d):
    p = table(spark, d, "parallel_corpus").select("rec_id", "toke_source", F.coalesce("toke_tokens", F.lit(0)).alias("n"))
    return R.bucket_rank(p, F.floor(F.col("rec_id") / 65536), [F.col("rec_id")], name="r").withColumn("batch", F.floor((F.col("r") - 1) / 20))


@query(f"SELECT batch, count(*) AS n_rows, sha256(string_agg(coalesce(toke_source, ''), chr(10) ORDER BY rec_id)) AS text_hash FROM {_BATCH} GROUP BY 1")
def packed_records(spark, d):
    """Records of twenty rows put together in order."""
    texts = F.transform(F.array_sort(F.collect_list(F.struct("rec_id", F.coalesce("toke_source", F.lit("")).alias("t")))), lambda x: x["t"])
    return _batches(spark, d).groupBy("batch").agg(F.count("*").alias("n_rows"), F.sha2(F.array_join(texts, "\n"), 256).alias("text_hash"))


@query(f"WITH b AS (SELECT batch, sum(n) AS size FROM {_BATCH} GROUP BY 1), t AS (SELECT *, max(size) OVER () AS room FROM b) SELECT least(size * 10 // greatest(room, 1), 9)::BIGINT AS bin, count(*) AS n_batches, sum(size)::BIGINT AS tokens, round(1 - sum(size) / (count(*) * max(room)), 6) AS padding FROM t GROUP BY 1")
def batch_padding(spark, d):
    """Histogram of the sizes of batches against the largest, with the share of padding."""
    b = _batches(spark, d).groupBy("batch").agg(F.sum("n").alias("size"))
    return A.padding(b, "size").withColumnRenamed("n_bins", "n_batches")


_TIER = "CASE WHEN tk_tokens > 300 THEN 'application' WHEN tk_tokens > 150 THEN 'complex' WHEN tk_tokens >= 50 THEN 'medium' ELSE 'simple' END"
_COUNTS = {"functions": "F=", "loops": "lp(", "conditions": "if(", "bindings": "let ", "imports": "I=", "types": "T=", "statements": ";"}


@query(f"SELECT {_TIER} AS tier, " + ", ".join(f"round(avg((length(tk_source) - length(replace(tk_source, '{p}', ''))) // {len(p)}), 6) AS {k}" for k, p in _COUNTS.items()) + ", round(avg(tk_tokens), 6) AS tokens FROM programs WHERE tk_source IS NOT NULL AND tk_tokens IS NOT NULL GROUP BY 1")
def tier_means(spark, d):
    """Means of eight measures per tier."""
    p = table(spark, d, "programs").where("tk_source is not null and tk_tokens is not null")
    return p.groupBy(F.expr(_TIER).alias("tier")).agg(*(F.round(F.avg(X.count_of(F.col("tk_source"), w)), 6).alias(k) for k, w in _COUNTS.items()), F.round(F.avg("tk_tokens"), 6).alias("tokens"))


@query("SELECT code, count(*) AS n_hits, count(DISTINCT rec_id) AS n_programs FROM (SELECT rec_id, unnest(validation.error_codes) AS code FROM programs) WHERE code IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def top_error_codes(spark, d):
    c = table(spark, d, "programs").select("rec_id", F.explode("validation.error_codes").alias("code")).where("code is not null")
    return c.groupBy("code").agg(F.count("*").alias("n_hits"), F.countDistinct("rec_id").alias("n_programs")).orderBy(F.desc("n_hits"), "code").limit(20)


_REWARD = "CASE WHEN compiled THEN 1.0 WHEN correction_compiled THEN 0.5 WHEN output_tokens > 0 THEN 0.25 ELSE 0.0 END"
_LENGTH = "CASE WHEN output_tokens IS NULL THEN 'unknown' WHEN output_tokens < 100 THEN 'short' WHEN output_tokens < 300 THEN 'medium' ELSE 'long' END"


@query(f"SELECT {_LENGTH} AS length_tier, count(*) AS n_rows, round(avg({_REWARD}), 6)::DOUBLE AS mean_reward, count(*) FILTER (NOT compiled) AS n_failed FROM trial_results GROUP BY 1")
def reward_by_length(spark, d):
    return table(spark, d, "trial_results").groupBy(F.expr(_LENGTH).alias("length_tier")).agg(F.count("*").alias("n_rows"), F.round(F.avg(F.expr(_REWARD).cast("double")), 6).alias("mean_reward"), F.count_if(~F.col("compiled")).alias("n_failed"))


@query(r"""WITH i AS (SELECT DISTINCT rec_id, category, unnest(regexp_extract_all(tk_source, '(?:^|[;\s])I=([A-Za-z_][A-Za-z0-9_]*):([A-Za-z0-9_.]+)', 2)) AS module FROM programs)
SELECT module, count(*) AS n_programs, count(DISTINCT category) AS n_categories FROM i WHERE NOT regexp_matches(module, '^std\.(str|math|io|net|rand|log|json|time)$') GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30""")
def unresolved_imports(spark, d):
    """The thirty commonest imports that no known module answers."""
    p = table(spark, d, "programs").where("tk_source is not null").select("rec_id", "category", F.explode(X.imports(F.col("tk_source"))).alias("module"))
    return p.where(~F.col("module").rlike(r"^std\.(str|math|io|net|rand|log|json|time)$")).groupBy("module").agg(F.count("*").alias("n_programs"), F.countDistinct("category").alias("n_categories")).orderBy(F.desc("n_programs"), "module").limit(30)


@query("""SELECT wave % 12 AS shard, status, count(*) AS n_rows, count(DISTINCT task_id) AS n_tasks, count(*) FILTER (new_sha256 IS NULL) AS n_open FROM (SELECT DISTINCT * FROM rewrite_ledger) GROUP BY 1, 2""")
def shard_stats(spark, d):
    l = table(spark, d, "rewrite_ledger").distinct()
    return l.groupBy((F.col("wave") % 12).alias("shard"), "status").agg(F.count("*").alias("n_rows"), F.countDistinct("task_id").alias("n_tasks"), F.count_if(F.col("new_sha256").isNull()).alias("n_open"))


_LICENSE_SQL = "CASE WHEN contains(t, 'mit license') OR contains(t, 'permission is hereby granted') OR t = 'mit' THEN 'MIT' WHEN contains(t, 'apache') AND contains(t, '2') THEN 'Apache-2.0' WHEN contains(t, 'bsd') THEN CASE WHEN contains(t, '3-clause') THEN 'BSD-3-Clause' WHEN contains(t, '2-clause') THEN 'BSD-2-Clause' ELSE 'BSD' END WHEN contains(t, 'mozilla') OR contains(t, 'mpl') THEN 'MPL-2.0' WHEN contains(t, 'gpl') OR contains(t, 'gnu general public') THEN 'GPL' WHEN contains(t, 'isc') THEN 'ISC' WHEN contains(t, 'unlicense') OR contains(t, 'public domain') OR contains(t, 'cc0') THEN 'public domain' ELSE 'unknown' END"


@query(f"""SELECT source_name, CASE WHEN regexp_replace(lower(display_name), '[^a-z0-9]', '', 'g') = '' THEN 'unnamed' ELSE regexp_replace(lower(display_name), '[^a-z0-9]', '', 'g') END AS slug, {_LICENSE_SQL} AS license_class, CASE WHEN isfinite(split_ratio) THEN split_ratio END AS split_ratio FROM (SELECT *, lower(coalesce(license, '')) AS t FROM task_sources)""")
def source_facts(spark, d):
    """Slug, class of licence and finite ratio of each source."""
    return table(spark, d, "task_sources").select("source_name", X.slug(F.col("display_name")).alias("slug"), X.license_class(F.col("license")).alias("license_class"), X.finite(F.col("split_ratio")).alias("split_ratio"))


_EXPECTED = {"gen-main": "CC0-1.0", "bench-core": "MIT", "mut-const": "MIT", "gen-wide": "MIT"}


@query("""SELECT p.source_name, count(*) AS n_rows, CASE WHEN s.license IS NULL THEN 'missing' WHEN e.expected IS NULL THEN 'unexpected' WHEN e.expected <> s.license THEN 'mismatch' ELSE 'ok' END AS verdict FROM programs p LEFT JOIN task_sources s USING (source_name) LEFT JOIN (VALUES """
       + ", ".join(f"('{k}', '{v}')" for k, v in _EXPECTED.items())
       + ") e(source_name, expected) ON e.source_name = p.source_name GROUP BY p.source_name, s.license, e.expected")
def license_mismatch(spark, d):
    """Programs by source and whether its licence is the expected one; both dimensions are small."""
    e = spark.createDataFrame(list(_EXPECTED.items()), "source_name string, expected string")
    n = table(spark, d, "programs").groupBy("source_name").agg(F.count("*").alias("n_rows"))
    r = J.dimension(J.dimension(n, table(spark, d, "task_sources").select("source_name", "license"), ["source_name"]), e, ["source_name"])
    verdict = F.when(F.col("license").isNull(), "missing").when(F.col("expected").isNull(), "unexpected").when(F.col("expected") != F.col("license"), "mismatch").otherwise("ok")
    return r.select("source_name", "n_rows", verdict.alias("verdict"))


@query("""SELECT rec_id, 2 AS version, coalesce(category, 'none') AS category, coalesce(judge.accepted, false) AS accepted, coalesce(judge.score, 0.0) AS score, coalesce(len(differential.languages_agreed), 0)::BIGINT AS n_agreed, version IS DISTINCT FROM 2 OR category IS NULL OR judge IS NULL OR differential IS NULL AS modified FROM programs""")
def migrated(spark, d):
    """Records of the second version: absent parts filled with defaults, and whether any was."""
    p = table(spark, d, "programs")
    judge = F.coalesce("judge", F.struct(F.lit(False).alias("accepted"), F.lit(0.0).alias("score")))
    diff = F.coalesce("differential.languages_agreed", F.array().cast("array<string>"))
    changed = ~F.col("version").eqNullSafe(F.lit(2)) | F.col("category").isNull() | F.col("judge").isNull() | F.col("differential").isNull()
    return p.select("rec_id", F.lit(2).alias("version"), F.coalesce("category", F.lit("none")).alias("category"), F.coalesce(judge["accepted"], F.lit(False)).alias("accepted"), F.coalesce(judge["score"], F.lit(0.0)).alias("score"), F.size(diff).cast("long").alias("n_agreed"), changed.alias("modified"))


@query("""SELECT rec_id, list_filter([CASE WHEN broken_source IS NULL OR length(broken_source) < 20 THEN 'source too short' END, CASE WHEN coalesce(len(diagnostics), 0) < 1 THEN 'no diagnostics' END, CASE WHEN difficulty IS NULL OR difficulty NOT IN ('easy', 'medium', 'hard') THEN 'tier' END, CASE WHEN mutation_type IS NULL THEN 'missing mutation_type' END], lambda x: x IS NOT NULL) AS faults FROM negative_examples""")
def negative_faults(spark, d):
    n = table(spark, d, "negative_examples")
    tests = [("source too short", F.coalesce(F.length("broken_source") < 20, F.lit(True))), ("no diagnostics", F.coalesce(F.size("diagnostics"), F.lit(0)) < 1), ("tier", F.coalesce(~F.col("difficulty").isin("easy", "medium", "hard"), F.lit(True))), ("missing mutation_type", F.col("mutation_type").isNull())]
    return n.select("rec_id", F.filter(F.array(*(F.when(c, name) for name, c in tests)), lambda x: x.isNotNull()).alias("faults"))


@query("""WITH f AS (SELECT DISTINCT task_id FROM rewrite_ledger WHERE status = 'failed' AND task_id IS NOT NULL), r AS (SELECT DISTINCT task_id FROM negative_examples WHERE task_id IS NOT NULL)
SELECT count(*) AS n_failing, count(*) FILTER (r.task_id IS NULL) AS n_unrouted, count(*) FILTER (r.task_id IS NULL) = 0 AS passed FROM f LEFT JOIN r USING (task_id)""")
def routing_gate(spark, d):
    """Every failing task must be routed: counts and whether none is left."""
    f = table(spark, d, "rewrite_ledger").where("status = 'failed' and task_id is not null").select("task_id").distinct()
    r = table(spark, d, "negative_examples").where("task_id is not null").select("task_id", F.lit(True).alias("there")).distinct()
    return f.join(r, "task_id", "left").agg(F.count("*").alias("n_failing"), F.count_if(F.col("there").isNull()).alias("n_unrouted")).withColumn("passed", F.col("n_unrouted") == 0)


_LAST = "(SELECT task_id, new_sha256, status, wave FROM (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY wave DESC, ts DESC, status DESC, coalesce(new_sha256, '') DESC, coalesce(prev_sha256, '') DESC) AS r FROM (SELECT DISTINCT * FROM rewrite_ledger WHERE task_id IS NOT NULL)) WHERE r = 1)"


@query(f"""WITH n AS (SELECT task_id, min(rec_id) AS rec_id, sha256(coalesce(min_by(tk_source, rec_id), '')) AS source_sha256 FROM programs WHERE task_id IS NOT NULL AND tk_source IS NOT NULL GROUP BY 1)
SELECT coalesce(n.task_id, o.task_id) AS task_id, n.rec_id, n.source_sha256, o.status AS kept_status, o.wave AS kept_wave, CASE WHEN n.task_id IS NULL THEN 'dropped' WHEN o.task_id IS NULL THEN 'new' WHEN o.new_sha256 IS NOT DISTINCT FROM n.source_sha256 THEN 'same' ELSE 'changed' END AS change FROM n FULL JOIN {_LAST} o ON n.task_id = o.task_id""")
def manifest_rebuild(spark, d):
    """A manifest made anew from the records, fields of the old one kept, and what changed."""
    n = table(spark, d, "programs").where("task_id is not null and tk_source is not null").groupBy("task_id").agg(F.min("rec_id").alias("rec_id"), F.sha2(F.min_by("tk_source", "rec_id"), 256).alias("source_sha256"))
    l = table(spark, d, "rewrite_ledger").where("task_id is not null").distinct()
    o = R.last_by(l, ["task_id"], F.struct("wave", "ts", "status", F.coalesce("new_sha256", F.lit("")).alias("n"), F.coalesce("prev_sha256", F.lit("")).alias("p")))
    return J.rebuilt(n, o.select("task_id", "new_sha256", F.col("status").alias("kept_status"), F.col("wave").alias("kept_wave")), "task_id", "source_sha256", "new_sha256").select("task_id", "rec_id", "source_sha256", "kept_status", "kept_wave", "change")


@query("""SELECT rec_id, CASE WHEN fixed_source IS NULL OR broken_source IS NULL THEN NULL ELSE length(fixed_source) <= length(broken_source) END AS chars_gate, CASE WHEN fixed_source IS NULL OR broken_source IS NULL THEN NULL ELSE len(list_filter(regexp_split_to_array(fixed_source, '\\s+'), lambda x: x <> '')) <= len(list_filter(regexp_split_to_array(broken_source, '\\s+'), lambda x: x <> '')) END AS words_gate FROM negative_examples""")
def size_gates(spark, d):
    """Sizes after against before; null where one is absent."""
    return table(spark, d, "negative_examples").select("rec_id", (F.length("fixed_source") <= F.length("broken_source")).alias("chars_gate"), (X.word_count(F.col("fixed_source")) <= X.word_count(F.col("broken_source"))).alias("words_gate"))


@query("""WITH w AS (SELECT task_id, max_by(compiled, {'a': run_at, 'b': trial_id}) AS new, min_by(compiled, {'a': run_at, 'b': trial_id}) AS old, count(DISTINCT trial_id) AS n FROM trial_results WHERE task_id IS NOT NULL AND run_at IS NOT NULL GROUP BY 1)
SELECT task_id, CASE WHEN n = 1 THEN 'once' WHEN old AND new THEN 'pass_stable' WHEN old THEN 'now_fails' WHEN new THEN 'now_passes' ELSE 'fail_stable' END AS verdict FROM w""")
def before_after(spark, d):
    """First against last run of each task."""
    t = table(spark, d, "trial_results").where("task_id is not null and run_at is not null")
    at = F.struct("run_at", "trial_id")
    w = t.groupBy("task_id").agg(F.min_by("compiled", at).alias("old"), F.max_by("compiled", at).alias("new"), F.countDistinct("trial_id").alias("n"))
    return w.select("task_id", F.when(F.col("n") == 1, "once").when(F.col("old") & F.col("new"), "pass_stable").when(F.col("old"), "now_fails").when(F.col("new"), "now_passes").otherwise("fail_stable").alias("verdict"))


@query("""WITH v AS (SELECT task_id, count(*) AS total, max(n) AS top FROM (SELECT task_id, differential.majority_output AS o, count(*) AS n FROM programs WHERE task_id IS NOT NULL AND differential.majority_output IS NOT NULL GROUP BY 1, 2) GROUP BY 1)
SELECT t.least, count(*) AS n_tasks, count(*) FILTER (top >= t.least) AS n_agreed FROM v, (VALUES (1), (2), (3)) t(least) GROUP BY 1""")
def thresholds_rejudged(spark, d):
    """Stored votes judged again at several least numbers of equal votes, in one pass."""
    n = table(spark, d, "programs").where("task_id is not null").groupBy("task_id", F.col("differential.majority_output").alias("o")).agg(F.count("*").alias("n")).where("o is not null")
    v = n.groupBy("task_id").agg(F.max("n").alias("top"))
    cells = F.array(*(F.struct(F.lit(k).alias("least"), (F.col("top") >= k).alias("ok")) for k in (1, 2, 3)))
    return v.select(F.explode(cells).alias("c")).groupBy("c.least").agg(F.count("*").alias("n_tasks"), F.count_if("c.ok").alias("n_agreed"))


@query("""SELECT category, count(*) AS n_rows, count(*) FILTER (broken_source = fixed_source) AS n_exact, round(count(*) FILTER (ok) / count(*), 6) AS pass_at_1 FROM (SELECT coalesce(difficulty, '-') AS category, broken_source, fixed_source, row_number() OVER (PARTITION BY task_id ORDER BY rec_id) AS r, len(list_filter(coalesce(diagnostics, []), lambda x: x.severity = 'error')) = 0 AS ok FROM negative_examples WHERE task_id IS NOT NULL) WHERE r = 1 GROUP BY 1""")
def first_pass_report(spark, d):
    """Of each task's first attempt: exact matches and the share without an error."""
    n = table(spark, d, "negative_examples").where("task_id is not null").select("task_id", "rec_id", F.coalesce("difficulty", F.lit("-")).alias("category"), "broken_source", "fixed_source", (F.coalesce(F.size(F.filter("diagnostics", lambda x: x["severity"] == "error")), F.lit(0)) <= 0).alias("ok"))
    one = R.first_by(n, ["task_id"], F.col("rec_id"))
    return one.groupBy("category").agg(F.count("*").alias("n_rows"), F.count_if(F.col("broken_source") == F.col("fixed_source")).alias("n_exact"), F.round(F.count_if("ok") / F.count("*"), 6).alias("pass_at_1"))


@query("""SELECT rec_id, category FROM (SELECT rec_id, category, r, row_number() OVER (ORDER BY r, category NULLS LAST, rec_id) AS place FROM (SELECT rec_id, category, row_number() OVER (PARTITION BY category ORDER BY rec_id) AS r FROM programs WHERE length(tk_source) >= 200) WHERE r <= 10) WHERE place <= 80""")
def seed_files(spark, d):
    """The first ten long enough programs of each category in turn, eighty in all."""
    few = R.first_n(table(spark, d, "programs").where("length(tk_source) >= 200").select("rec_id", "category"), ["category"], [F.col("rec_id")], 10)
    return R.interleaved(few, "category", [F.col("rec_id")]).where("place <= 80").select("rec_id", "category")


@query("""SELECT provider, count(*) AS n_rows, count(DISTINCT category) AS n_categories, min(created_at) AS first_at, max(created_at) AS last_at FROM (SELECT CASE WHEN starts_with(model, 'seed') THEN 'seed' WHEN starts_with(model, 'mutation') THEN 'mutation' WHEN starts_with(model, 'transpile') THEN 'transpile' ELSE 'other' END AS provider, category, created_at FROM programs) GROUP BY 1""")
def provider_counts(spark, d):
    m = F.col("model")
    provider = F.when(m.startswith("seed"), "seed").when(m.startswith("mutation"), "mutation").when(m.startswith("transpile"), "transpile").otherwise("other")
    return table(spark, d, "programs").groupBy(provider.alias("provider")).agg(F.count("*").alias("n_rows"), F.countDistinct("category").alias("n_categories"), F.min("created_at").alias("first_at"), F.max("created_at").alias("last_at"))


@query("""WITH t AS (SELECT DISTINCT trial_id, provider_name, latency_ms FROM trial_results WHERE latency_ms IS NOT NULL AND provider_name IS NOT NULL), m AS (SELECT provider_name, quantile_cont(latency_ms, 0.5) AS m FROM t GROUP BY 1)
SELECT provider_name, round(m, 6) AS median_ms, m / (SELECT min(m) FROM m) <= 1.1 AS within FROM m""")
def median_gate(spark, d):
    """Medians of the providers against the least one."""
    t = table(spark, d, "trial_results").where("latency_ms is not null and provider_name is not null").select("trial_id", "provider_name", "latency_ms").distinct()
    m = A.interpolated(t, ["provider_name"], "latency_ms", {"m": 0.5})
    least = F.min("m").over(Window.partitionBy(F.lit(0)))  # a row for each provider
    return m.select("provider_name", F.round("m", 6).alias("median_ms"), (F.col("m") / least <= 1.1).alias("within"))
