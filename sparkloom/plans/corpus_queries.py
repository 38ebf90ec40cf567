"""Dedup, splits, selection, formats, text functions and checks over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import aggregates as A
from ..operators import dedup as D
from ..operators import formats as C
from ..operators import joins as J
from ..operators import ranks as R
from ..operators import select as S
from ..operators import splits as P
from .order_queries import _CX, counts
from .registry import query, table

_NORM = r"trim(regexp_replace(lower(text), '[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'))"


@query(f"WITH h AS (SELECT doc_id, sha256({_NORM}) AS h FROM documents WHERE text IS NOT NULL), g AS (SELECT h, min(doc_id) AS keep_id, count(*) AS n_copies FROM h GROUP BY 1) SELECT doc_id, keep_id, n_copies FROM h JOIN g USING (h)")
def exact_dedup(spark, d):
    return D.exact_keepers(table(spark, d, "documents"), "doc_id", "text")


_IDS = "list_filter(t, lambda x: regexp_full_match(x, '[a-zA-Z_][a-zA-Z0-9_]*') AND NOT list_contains(kw, x))"
_STRUCT = r"""WITH t AS (SELECT rec_id, regexp_extract_all(tk_source, '[a-zA-Z_][a-zA-Z0-9_]*|[0-9]+(?:\.[0-9]+)?|[<>=!]=?|[^\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{2000}-\x{200a}\x{3000}]') AS t, ['let','mut','if','el','lp','br','as','true','false','M','I','T','F','i64','u64','f64','bool','Str','void'] AS kw FROM programs WHERE tk_source IS NOT NULL AND trim(tk_source) <> ''),
o AS (SELECT rec_id, t, kw, """ + _IDS + r""" AS a FROM t), u AS (SELECT rec_id, t, kw, list_filter(a, lambda x, i: list_position(a, x) = i) AS ids FROM o),
h AS (SELECT rec_id, substr(sha256(array_to_string(list_transform(t, lambda x: CASE WHEN list_position(ids, x) > 0 THEN 'id' || (list_position(ids, x) - 1) WHEN regexp_matches(x, '^[0-9]') THEN 'NUM' ELSE x END), ' ')), 1, 16) AS structure FROM u)"""


@query(_STRUCT + " SELECT structure, min(rec_id) AS first_id, count(*) AS n_rows FROM h GROUP BY 1")
def structural_groups(spark, d):
    return D.structural_groups(table(spark, d, "programs"), "rec_id", "tk_source")


@query("""WITH b AS (SELECT task_id, mutation_type, pair_id, length(fixed_source)::DOUBLE AS score FROM negative_examples WHERE task_id IS NOT NULL), k AS (SELECT *, row_number() OVER (PARTITION BY task_id, mutation_type ORDER BY -coalesce(score, 0), pair_id) AS r FROM b),
u AS (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY mutation_type NULLS FIRST) AS q FROM k WHERE r = 1 AND (mutation_type IS NULL OR mutation_type <> 'name_typo')), kept AS (SELECT task_id, pair_id FROM u WHERE q <= 3)
SELECT task_id, pair_id FROM kept UNION ALL SELECT task_id, min(pair_id) FROM b WHERE task_id NOT IN (SELECT task_id FROM kept) GROUP BY 1""")
def keeper_selection(spark, d):
    n = table(spark, d, "negative_examples").where("task_id is not null").select("task_id", "mutation_type", "pair_id", F.length("fixed_source").cast("double").alias("score"))
    return D.keepers(n, "task_id", "mutation_type", "score", "pair_id", "name_typo").select("task_id", "pair_id")


_PAIRS = f"""WITH n AS (SELECT min(doc_id) AS id, {_NORM} AS t FROM documents WHERE text IS NOT NULL GROUP BY 2 HAVING length(t) > 0), g AS (SELECT DISTINCT id, g FROM (SELECT id, CASE WHEN length(t) <= 3 THEN t ELSE substr(t, i, 3) END AS g FROM (SELECT id, t, unnest(range(1, greatest(2, length(t) - 1))) AS i FROM n))), c AS (SELECT id, count(*) AS n FROM g GROUP BY 1),
o AS (SELECT a.id AS a, b.id AS b, count(*) AS k FROM g a JOIN g b USING (g) WHERE a.id < b.id GROUP BY 1, 2)"""


@query(_PAIRS + " SELECT a, b FROM o JOIN c x ON x.id = a JOIN c y ON y.id = b WHERE k >= 0.75 * (x.n + y.n - k) - 1e-9")
def ngram_pairs(spark, d):
    return D.ngram_pairs(table(spark, d, "documents"), "doc_id", "text", 0.75)


@query()
def near_dedup_greedy(spark, d):
    return D.near_dedup(table(spark, d, "documents"), "doc_id", "text", 0.75)


@query("""SELECT rec_id, CASE WHEN list_sum(list_transform(string_split(sha256(coalesce(source_name, '') || coalesce(task_id, '')), ''), lambda x: instr('0123456789abcdef', x) - 1)) % 5 = 0 THEN 'evaluation' ELSE 'training' END AS side FROM programs""")
def hash_split(spark, d):
    return table(spark, d, "programs").select("rec_id", P.hash_side(F.col("source_name"), F.col("task_id")).alias("side"))


_SIDE = """(SELECT coalesce(source_name, '-') AS source, task_id AS id, CASE WHEN list_sum(list_transform(string_split(sha256(coalesce(source_name, '') || task_id), ''), lambda x: instr('0123456789abcdef', x) - 1)) % 5 = 0 THEN 1 ELSE 0 END AS e FROM (SELECT DISTINCT source_name, task_id FROM programs WHERE task_id IS NOT NULL))"""


@query(f"""SELECT source, count(*) AS n_tasks, sum(e)::BIGINT AS n_evaluation, sha256(string_agg(id, chr(10) ORDER BY id) FILTER (e = 1)) AS manifest_hash, round(1 - avg(e), 6) AS split_ratio FROM {_SIDE} GROUP BY 1""")
def stratified_manifest(spark, d):
    t = table(spark, d, "programs").where("task_id is not null").select("source_name", "task_id").distinct()
    e = t.select(F.coalesce("source_name", F.lit("-")).alias("source"), "task_id", (P.hash_side(F.col("source_name"), F.col("task_id")) == "evaluation").alias("e"))
    h = A.id_hash(e.where("e"), ["source"], "task_id").select("source", F.col("ids_hash").alias("manifest_hash"))
    n = e.groupBy("source").agg(F.count("*").alias("n_tasks"), F.count_if("e").alias("n_evaluation"), F.round(1 - F.avg(F.col("e").cast("int")), 6).alias("split_ratio"))
    return n.join(h, "source", "left")


@query("""WITH f AS (SELECT regexp_replace(task_id, 'v[0-9]+$', '') AS fam, count(*) AS n_rows, min_by(category, rec_id) FILTER (category IS NOT NULL) AS stratum FROM programs WHERE task_id IS NOT NULL GROUP BY 1),
c AS (SELECT *, coalesce(sum(n_rows) OVER (PARTITION BY stratum ORDER BY sha256('3:' || fam), fam ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, round(sum(n_rows) OVER (PARTITION BY stratum) * 0.05) AS goal FROM f)
SELECT fam, stratum, n_rows, before < goal AS holdout FROM c""")
def family_holdout(spark, d):
    p = table(spark, d, "programs").where("task_id is not null").select("task_id", "category", F.when(F.col("category").isNotNull(), F.col("rec_id")).alias("rec_id"))
    return P.family_holdout(p, X.family(F.col("task_id")), "category", "rec_id", 0.05, 3)


_BUCKET = "CASE WHEN token_ratio IS NULL THEN 'unknown' WHEN token_ratio < 0.5 THEN 'very_short' WHEN token_ratio < 0.8 THEN 'short' WHEN token_ratio < 1.0 THEN 'similar' WHEN token_ratio < 1.3 THEN 'longer' ELSE 'much_longer' END"


@query(f"""WITH r AS (SELECT rec_id, {_BUCKET} AS bucket FROM parallel_corpus), k AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY sha256('9:' || rec_id), rec_id) AS r, count(*) OVER (PARTITION BY bucket) AS n FROM r)
SELECT rec_id, bucket, CASE WHEN r <= greatest(1, round(n * 0.8)) THEN 'train' WHEN r <= greatest(1, round(n * 0.8)) + round(n * 0.1) THEN 'validation' ELSE 'test' END AS part FROM k""")
def ratio_split(spark, d):
    c = table(spark, d, "parallel_corpus").select("rec_id", F.expr(_BUCKET).alias("bucket"))
    return P.ratio_split(c, ["bucket"], "rec_id", 0.8, 9).select("rec_id", "bucket", "part")


@query("""SELECT rec_id, CASE WHEN p.source_name IS NULL THEN 'no_origin' WHEN s.source_name IS NULL THEN 'unknown_origin' WHEN s.usage = 'evaluation' THEN 'evaluation_source' WHEN s.usage = 'split' AND list_sum(list_transform(string_split(sha256(p.source_name || coalesce(task_id, '')), ''), lambda x: instr('0123456789abcdef', x) - 1)) % 5 = 0 THEN 'held_out' END AS reason FROM programs p LEFT JOIN task_sources s USING (source_name)""")
def firewall(spark, d):
    from ..operators.gates import first_reason

    s = table(spark, d, "task_sources").select("source_name", "usage", F.lit(True).alias("known"))
    p = J.dimension(table(spark, d, "programs").select("rec_id", "source_name", "task_id"), s, ["source_name"])
    side = P.hash_side(F.col("source_name"), F.col("task_id"))
    gates = [("no_origin", F.col("source_name").isNull()), ("unknown_origin", F.col("known").isNull()), ("evaluation_source", F.col("usage") == "evaluation"), ("held_out", (F.col("usage") == "split") & (side == "evaluation"))]
    return p.select("rec_id", first_reason(gates).alias("reason"))


@query(r"""WITH RECURSIVE c AS (SELECT rec_id, regexp_replace(tk_source, '[^{}]', '', 'g') AS s FROM programs WHERE tk_source IS NOT NULL), x AS (SELECT rec_id, list_transform(range(1, length(s) + 1), lambda i: CASE WHEN substr(s, i, 1) = '{' THEN 1 ELSE -1 END) AS v FROM c)
SELECT rec_id, greatest(0, coalesce(list_max(list_transform(range(1, len(v) + 1), lambda i: list_sum(list_slice(v, 1, i)))), 0))::BIGINT AS depth FROM x""")
def nesting_depth(spark, d):
    p = table(spark, d, "programs").where("tk_source is not null")
    return p.select("rec_id", X.nesting_depth(F.col("tk_source"), False).alias("depth"))


@query(r"""WITH c AS (SELECT rec_id, regexp_replace(tk_source, '[^{}]', '', 'g') AS s FROM programs WHERE tk_source IS NOT NULL), x AS (SELECT rec_id, list_transform(range(1, length(s) + 1), lambda i: CASE WHEN substr(s, i, 1) = '{' THEN 1 ELSE -1 END) AS v FROM c)
SELECT rec_id, coalesce(list_max(list_transform(range(1, len(v) + 1), lambda i: list_sum(list_slice(v, 1, i)) - least(0, coalesce(list_min(list_transform(range(1, i + 1), lambda j: list_sum(list_slice(v, 1, j)))), 0)))), 0)::BIGINT AS depth FROM x""")
def nesting_depth_clamped(spark, d):
    p = table(spark, d, "programs").where("tk_source is not null")
    return p.select("rec_id", X.nesting_depth(F.col("tk_source"), True).alias("depth"))


_IDENTS = "list_distinct(list_concat(regexp_extract_all(tk_source, 'M=(\\w+)', 1), regexp_extract_all(tk_source, 'F=(\\w+)\\(', 1), regexp_extract_all(tk_source, 'let\\s+(\\w+)', 1), regexp_extract_all(tk_source, '[(;](\\w+):', 1)))"
_MEANING = f"list_transform({_IDENTS}, lambda x: CASE WHEN regexp_matches(x, '{X.GENERIC}') THEN 0.0 WHEN regexp_matches(x, '(?i)[a-z]{{3,}}') THEN 1.0 ELSE 0.5 END)"
_QUALITY = f"""(SELECT rec_id, coalesce(list_avg({_MEANING}), 0) AS meaning, len(regexp_extract_all(tk_source, 'F=\\w+\\(')) AS f, len(regexp_extract_all(tk_source, '\\bI=')) AS i,
 len(regexp_extract_all(tk_source, 'F=\\w+\\(')) + len(regexp_extract_all(tk_source, 'lp\\(')) + len(regexp_extract_all(tk_source, 'if ?\\(')) + len(regexp_extract_all(tk_source, '\\blet\\s+')) + len(regexp_extract_all(tk_source, '\\bI=')) AS cx FROM programs WHERE tk_source IS NOT NULL AND tk_source <> '')"""


@query(f"SELECT rec_id, CASE WHEN meaning >= 0.8 THEN 1.0 WHEN meaning >= 0.4 THEN 0.5 ELSE 0.0 END::DOUBLE AS coherence, cx AS complexity, round(0.4 * CASE WHEN meaning >= 0.8 THEN 1.0 WHEN meaning >= 0.4 THEN 0.5 ELSE 0.0 END + 0.3 * least(cx / 10, 1) + CASE WHEN i > 0 THEN 0.15 ELSE 0 END + CASE WHEN f > 1 THEN 0.15 ELSE 0 END, 4)::DOUBLE AS score FROM {_QUALITY}")
def quality_composite(spark, d):
    """Coherence of the names (0.4), constructs (0.3), imports and several functions (0.15 each)."""
    s = F.col("tk_source")
    n = lambda rx: F.size(F.regexp_extract_all(s, F.lit(rx), F.lit(0))).cast("long")
    q = table(spark, d, "programs").where("tk_source <> ''").select("rec_id", X.coherence(s).alias("coherence"), n(r"F=\w+\(").alias("f"), n(r"\bI=").alias("i"), (n(r"lp\(") + n(r"if ?\(") + n(r"\blet\s+")).alias("o"))
    q = q.withColumn("complexity", F.col("f") + F.col("i") + F.col("o"))
    score = 0.4 * F.col("coherence") + 0.3 * F.least(F.col("complexity") / 10, F.lit(1.0)) + F.when(F.col("i") > 0, 0.15).otherwise(0.0) + F.when(F.col("f") > 1, 0.15).otherwise(0.0)
    return q.select("rec_id", "coherence", "complexity", F.round(score, 4).alias("score"))


_WORDS = "['let','mut','if','el','lp','br','as','len','std','bool','str','true']"
_IFD = f"""(SELECT p.rec_id, p.category, 0.45 * (0.3 * least(f + l, 6) / 6 + 0.3 * ((CASE WHEN l > 0 THEN 1 ELSE 0 END) + (CASE WHEN c > 0 THEN 1 ELSE 0 END) + (CASE WHEN b > 0 THEN 1 ELSE 0 END) + (CASE WHEN i > 0 THEN 1 ELSE 0 END)) / 4.0 + 0.2 * least(length(tk_source) / 500, 1) + 0.2 * least((length(tk_source) - length(replace(tk_source, ';', ''))) / 15, 1)) + 0.2 * len(list_intersect({_WORDS}, regexp_extract_all(lower(tk_source), '[a-z]+'))) / 12 + 0.35 * CASE WHEN tk_source = '' THEN 0.5 ELSE least(coalesce(r.n, 0) / greatest(length(tk_source), 1), 3) / 3 END AS s FROM {_CX} x JOIN programs p USING (rec_id) LEFT JOIN (SELECT task_id, max(length(python_source)) AS n FROM parallel_corpus WHERE task_id IS NOT NULL GROUP BY 1) r USING (task_id))"""


def _proxy(spark, d):
    """Proxy of how hard a program is to write from its instruction: constructs, length of the longest instruction of its
    task against its own, and different keywords."""
    told = table(spark, d, "parallel_corpus").where("task_id is not null").groupBy("task_id").agg(F.max(F.length("python_source")).alias("told"))
    p = table(spark, d, "programs").where("tk_source is not null").join(told, "task_id", "left")
    s = F.col("tk_source")
    has = lambda x: F.when(F.instr(s, x) > 0, 1).otherwise(0)
    words = F.array(*(F.lit(w) for w in ("let", "mut", "if", "el", "lp", "br", "as", "len", "std", "bool", "str", "true")))
    kd = F.size(F.array_intersect(words, F.regexp_extract_all(F.lower(s), F.lit("([a-z]+)"), F.lit(1)))) / 12
    depth = F.least(X.count_of(s, "F=") + X.count_of(s, "lp("), F.lit(6)) / 6
    cx = 0.3 * depth + 0.3 * (has("lp(") + has("if(") + has("let ") + has("I=")) / 4 + 0.2 * F.least(F.length(s) / 500, F.lit(1.0)) + 0.2 * F.least(X.count_of(s, ";") / 15, F.lit(1.0))
    ratio = F.when(s == "", 0.5).otherwise(F.least(F.coalesce("told", F.lit(0)) / F.greatest(F.length(s), F.lit(1)), F.lit(3.0)) / 3)
    return p.select("rec_id", "category", (0.45 * cx + 0.35 * ratio + 0.2 * kd).alias("s"))


@query(f"SELECT rec_id, round(s, 6)::DOUBLE AS score FROM {_IFD}")
def proxy_score(spark, d):
    return _proxy(spark, d).select("rec_id", F.round("s", 6).alias("score"))


@query(f"SELECT rec_id, category FROM (SELECT rec_id, category, row_number() OVER (PARTITION BY category ORDER BY round(s, 6) DESC, rec_id) AS r, count(*) OVER (PARTITION BY category) AS n FROM {_IFD}) WHERE r <= greatest(1, ceil(n * 0.1))")
def proxy_selection(spark, d):
    p = _proxy(spark, d).withColumn("k", F.round("s", 6))
    return R.top_fraction(p, ["category"], [F.desc("k"), F.col("rec_id")], 0.1).select("rec_id", "category")


# Penalties of the classes of codes, in the place of lint rules (any other: 0.02).
_PENALTY = {"E40": 0.15, "E41": 0.15, "E42": 0.15, "E43": 0.2, "E44": 0.05, "E45": 0.02}
_PENALTY_SQL = "CASE rule " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in _PENALTY.items()) + " ELSE 0.02 END"


@query(f"""WITH n AS (SELECT rec_id, substr(v.code, 1, 3) AS rule, count(*) AS c FROM (SELECT rec_id, unnest(diagnostics) AS v FROM negative_examples) WHERE v.code IS NOT NULL GROUP BY 1, 2), w AS (SELECT rec_id, sum(least(c, 3) * {_PENALTY_SQL}) AS p FROM n GROUP BY 1)
SELECT rec_id, round(greatest(0, 1 - coalesce(p, 0)), 6)::DOUBLE AS score FROM negative_examples LEFT JOIN w USING (rec_id)""")
def penalty_score(spark, d):
    """1 less the penalties of each rule's diagnostics, three at most of a rule."""
    n = table(spark, d, "negative_examples").select("rec_id", "diagnostics")
    return n.select("rec_id", F.round(X.penalised(F.transform("diagnostics", lambda x: F.substring(x["code"], 1, 3)), _PENALTY, 0.02, 3), 6).alias("score"))


_WORD_SQL = r"CASE WHEN lower(w) IN ('true', 'false') THEN lower(w) WHEN regexp_full_match(w, '-?[0-9]{1,18}\.[0-9]{1,12}') THEN regexp_replace(regexp_replace(regexp_replace(CAST(CAST(w AS DECIMAL(30, 12)) AS VARCHAR), '0+$', ''), '\.$', ''), '^-0$', '0') ELSE w END"
_OUTPUT_SQL = rf"regexp_replace(array_to_string(list_transform(string_split(regexp_replace(o, '\r\n?', chr(10), 'g'), chr(10)), lambda l: array_to_string(list_transform(list_filter(regexp_split_to_array(l, '\s+'), lambda y: y <> ''), lambda w: {_WORD_SQL}), ' ')), chr(10)), '^\n+|\n+$', '', 'g')"


@query(f"SELECT {_OUTPUT_SQL} AS output, count(*) AS n_rows, count(DISTINCT o) AS n_forms FROM (SELECT differential.majority_output AS o FROM programs UNION ALL SELECT error_output FROM trial_results) WHERE o IS NOT NULL GROUP BY 1")
def equal_outputs(spark, d):
    """Outputs that count as equal, with their rows and different forms."""
    o = table(spark, d, "programs").select(F.col("differential.majority_output").alias("o")).unionByName(table(spark, d, "trial_results").select(F.col("error_output").alias("o")))
    return o.where("o is not null").groupBy(X.canonical_output(F.col("o")).alias("output")).agg(F.count("*").alias("n_rows"), F.countDistinct("o").alias("n_forms"))


@query()
def kmeans_1d(spark, d):
    return S.kmeans_1d(table(spark, d, "programs").select(F.col("judge.score").alias("s")), "s", 4)


_WEIGHTS = {"gen-main": 0.4, "gen-retry": 0.2, "compose-c": 0.2, "no-such-source": 0.1, "port-c": 0.1}
_CAPS = {"gen-main": 1, "gen-retry": 1, "compose-c": 2, "port-c": 2}
_CASE = lambda m, e: "CASE source_name " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in m.items()) + f" ELSE {e} END"
_TARGETS = f"(SELECT source_name AS source, n AS n_rows, least(round(w / sum(w) OVER () * 400), n * cap)::BIGINT AS target FROM (SELECT source_name, count(*) AS n, {_CASE(_WEIGHTS, 0.0)} AS w, {_CASE(_CAPS, 1)} AS cap FROM programs WHERE source_name IS NOT NULL GROUP BY 1))"


def _targets(spark, d):
    c = table(spark, d, "programs").where("source_name is not null").groupBy(F.col("source_name").alias("source")).agg(F.count("*").alias("n_rows"))
    return S.weighted_targets(c, _WEIGHTS, 400, _CAPS)


@query(f"SELECT source, n_rows, target FROM {_TARGETS}")
def weighted_targets(spark, d):
    return _targets(spark, d)


@query(f"""WITH r AS (SELECT rec_id, source_name AS source, row_number() OVER (PARTITION BY source_name ORDER BY sha256('2:' || rec_id), rec_id) AS r FROM programs), t AS (SELECT * FROM {_TARGETS} WHERE target > 0)
SELECT rec_id, source, unnest(range(0, (target // n_rows + CASE WHEN r <= target % n_rows THEN 1 ELSE 0 END)::BIGINT)) AS copy FROM r JOIN t USING (source)""")
def weighted_sample(spark, d):
    """Rows of each source in seeded order, over- or undersampled to the source's target."""
    t = _targets(spark, d).where("target > 0")
    p = J.dimension(table(spark, d, "programs").select("rec_id", F.col("source_name").alias("source")), t, ["source"], "inner").withColumn("h", R.seeded(F.col("rec_id"), 2))
    ranked = R.bucket_rank(p, R.hash_bucket(F.col("h")), [F.col("h"), F.col("rec_id")], ["source"])
    return S.oversampled(ranked, "rank", "n_rows", "target").select("rec_id", "source", F.col("copy").cast("long").alias("copy"))


@query(f"""WITH t AS (SELECT rec_id, CASE WHEN f >= 4 OR (i >= 1 AND f >= 3) OR n > 300 THEN 'application' WHEN f BETWEEN 2 AND 3 OR n > 150 THEN 'complex' ELSE 'rest' END AS tier FROM {_CX}), r AS (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY sha256('4:' || rec_id), rec_id) AS r, count(*) OVER () AS n FROM t)
SELECT rec_id, tier FROM r WHERE tier <> 'application' OR r <= floor(n * 0.1)""")
def stratified_resample(spark, d):
    """The application tier capped at a tenth of all rows, in seeded order."""
    f, i, n = F.col("f"), F.col("i"), F.col("n")
    tier = F.when((f >= 4) | ((i >= 1) & (f >= 3)) | (n > 300), "application").when(f.between(2, 3) | (n > 150), "complex").otherwise("rest")
    t = counts(table(spark, d, "programs")).select("rec_id", tier.alias("tier"), R.seeded(F.col("rec_id"), 4).alias("h"))
    total = t.agg(F.count("*").alias("n"))
    r = R.bucket_rank(t, R.hash_bucket(F.col("h")), [F.col("h"), F.col("rec_id")], ["tier"])
    return r.join(F.broadcast(total)).where((F.col("tier") != "application") | (F.col("rank") <= F.floor(F.col("n") * 0.1))).select("rec_id", "tier")


@query()
def quota_topup(spark, d):
    """Programs added to the first hundredth (by hash) so that every imported module stands in 40 of them, as far as there are so many."""
    p = table(spark, d, "programs").where("tk_source is not null").select(F.col("rec_id").alias("key"), F.explode(X.imports(F.col("tk_source"))).alias("item"))
    return S.quota_topup(p, p.where(F.pmod(F.xxhash64("key"), F.lit(100)) == 0).select("key").distinct(), 40)


@query()
def ffd_packing(spark, d):
    p = table(spark, d, "programs").where("tk_tokens > 0").select((F.floor(F.col("rec_id") / 20_000)).alias("shard"), F.col("rec_id").alias("key"), F.col("tk_tokens").cast("long").alias("size"))
    return S.first_fit(p, "shard", "key", "size", 4096, 2)


_SYS = "You write short programs."


@query(f"""SELECT rec_id, [{{'role': 'system', 'content': '{_SYS}'}}, {{'role': 'user', 'content': coalesce('Task ' || task_id || ' of ' || category, 'Any task')}}, {{'role': 'assistant', 'content': tk_source}}]::VARCHAR[] IS NOT NULL AS whole, length('{_SYS}') + length(coalesce('Task ' || task_id || ' of ' || category, 'Any task')) + length(tk_source) AS n_chars FROM programs WHERE tk_source IS NOT NULL AND trim(tk_source) <> ''""")
def chat_format(spark, d):
    p = table(spark, d, "programs").where("trim(tk_source) <> ''")
    user = F.coalesce(F.concat(F.lit("Task "), "task_id", F.lit(" of "), "category"), F.lit("Any task"))
    m = p.select("rec_id", C.chat(F.lit(_SYS), user, F.col("tk_source")).alias("m"))
    return m.select("rec_id", (F.size("m") == 3).alias("whole"), F.aggregate("m", F.lit(0), lambda a, x: a + F.length(x["content"])).cast("long").alias("n_chars"))


@query("""SELECT fault, count(*) AS n_rows FROM (SELECT unnest(list_filter([CASE WHEN text IS NULL OR trim(text) = '' THEN 'empty' END, CASE WHEN regexp_matches(text, '\\{\\{[a-z_]+\\}\\}') THEN 'template' END], lambda x: x IS NOT NULL)) AS fault FROM documents) GROUP BY 1""")
def chat_faults(spark, d):
    m = table(spark, d, "documents").select(C.chat(F.lit("s"), F.lit("u"), F.col("text")).alias("m"))
    return m.select(F.explode(C.chat_faults(F.col("m"))).alias("fault")).groupBy("fault").agg(F.count("*").alias("n_rows"))


@query("""SELECT rec_id, 'repair' AS kind, length(broken_source) AS prompt_chars, length(fixed_source) AS answer_chars FROM negative_examples WHERE broken_source IS NOT NULL AND fixed_source IS NOT NULL UNION ALL SELECT rec_id, 'explain', length(fixed_source), length(diagnostics[1].message) FROM negative_examples WHERE fixed_source IS NOT NULL AND diagnostics[1].message IS NOT NULL""")
def pair_expansion(spark, d):
    n = table(spark, d, "negative_examples").withColumn("first", F.get("diagnostics", F.lit(0))["message"])
    e = C.expanded(n, ["rec_id"], [("repair", F.col("broken_source"), F.col("fixed_source")), ("explain", F.col("fixed_source"), F.col("first"))])
    return e.select("rec_id", "kind", F.length("prompt").cast("long").alias("prompt_chars"), F.length("answer").cast("long").alias("answer_chars"))


@query("""SELECT label, count(*) AS n_rows FROM (SELECT unnest(list_filter([CASE WHEN tk_tokens < 150 THEN 'short' END, CASE WHEN tk_source LIKE '%lp(%' THEN 'loops' END, CASE WHEN tk_source LIKE '%I=%' THEN 'imports' END, CASE WHEN judge.score >= 0.8 THEN 'best' END], lambda x: x IS NOT NULL)) AS label FROM programs) GROUP BY 1""")
def phase_labels(spark, d):
    l = C.labels([("short", F.col("tk_tokens") < 150), ("loops", F.col("tk_source").contains("lp(")), ("imports", F.col("tk_source").contains("I=")), ("best", F.col("judge.score") >= 0.8)])
    return table(spark, d, "programs").select(F.explode(l).alias("label")).groupBy("label").agg(F.count("*").alias("n_rows"))


@query(r"""SELECT doc_id, len(regexp_extract_all(text, '(E[0-9]{4})')) AS n_codes, len(list_distinct(regexp_extract_all(text, '(E[0-9]{4})'))) AS n_different, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS n_words, length(regexp_extract(text, '(?s)```[A-Za-z0-9_+-]*\n(.*?)```', 1)) AS fenced FROM documents WHERE text IS NOT NULL""")
def text_functions(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").where("text is not null").select(
        "doc_id", F.size(F.regexp_extract_all(t, F.lit("(E[0-9]{4})"), F.lit(1))).cast("long").alias("n_codes"), F.size(X.error_codes(t)).cast("long").alias("n_different"), X.word_count(t).alias("n_words"), F.length(X.fenced_code(t)).cast("long").alias("fenced")
    )


@query(r"""SELECT rec_id, lower(regexp_replace(regexp_extract(tk_source, 'F=([A-Za-z0-9_]+)', 1), '([a-z0-9])([A-Z])', '\1 \2', 'g')) AS name, coalesce(phase || '-', '') || coalesce(task_id || '-', '') || substr(sha256(tk_source), 1, 8) AS short_id, regexp_replace(task_id, 'v[0-9]+$', '') AS family FROM programs WHERE tk_source IS NOT NULL""")
def name_functions(spark, d):
    p = table(spark, d, "programs").where("tk_source is not null")
    return p.select("rec_id", X.camel_words(F.regexp_extract("tk_source", "F=([A-Za-z0-9_]+)", 1)).alias("name"), X.short_id(F.col("phase"), F.col("task_id"), F.col("tk_source")).alias("short_id"), X.family(F.col("task_id")).alias("family"))


_BLANKS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# Literals, words with the blanks behind them, and other characters; without blanks, two words that follow each other get one back.
_PARTS = rf"""list_filter(regexp_extract_all(tk_source, '"(?:\\.|[^"\\])*"|[\p{{L}}\p{{M}}\p{{N}}\p{{Pc}}]+|{_BLANKS}+|[^\p{{L}}\p{{M}}\p{{N}}\p{{Pc}}]', 0), lambda x: NOT regexp_full_match(x, '{_BLANKS}+'))"""


@query(rf"""WITH t AS (SELECT rec_id, {_PARTS} AS t FROM programs WHERE tk_source IS NOT NULL)
SELECT rec_id, sha256(array_to_string(list_transform(t, lambda x, i: CASE WHEN i > 1 AND regexp_matches(x, '^[\p{{L}}\p{{M}}\p{{N}}\p{{Pc}}]') AND regexp_matches(t[i - 1], '^[\p{{L}}\p{{M}}\p{{N}}\p{{Pc}}]') THEN ' ' || x ELSE x END), '')) AS source_hash FROM t""")
def compact_sources(spark, d):
    p = table(spark, d, "programs").where("tk_source is not null")
    return p.select("rec_id", F.sha2(X.compact(F.col("tk_source")), 256).alias("source_hash"))


@query("""SELECT rec_id, round(0.3 * (CASE WHEN validation.compiler_exit_code = 0 THEN 1 ELSE 0 END) + 0.3 * least(coalesce(len(differential.languages_agreed), 0) / 3, 1) + 0.2 * greatest(0, least(1, 2 - coalesce(tk_tokens, 600) / 300)) + 0.2 * coalesce(judge.score, 0), 6)::DOUBLE AS score FROM programs""")
def validation_score(spark, d):
    n = F.greatest(F.coalesce(F.size("differential.languages_agreed"), F.lit(0)), F.lit(0))
    ramp = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 - F.coalesce("tk_tokens", F.lit(600)) / 300))
    s = 0.3 * F.when(F.col("validation.compiler_exit_code") == 0, 1.0).otherwise(0.0) + 0.3 * F.least(n / 3, F.lit(1.0)) + 0.2 * ramp + 0.2 * F.coalesce("judge.score", F.lit(0.0))
    return table(spark, d, "programs").select("rec_id", F.round(s, 6).alias("score"))
