"""Rewrites, layouts, wrappers and tagged examples over the test tables."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions import rewrite as W
from ..operators import compose as C
from ..operators import generate as N
from .record_queries import _FUNCS
from .registry import query, table

_RE2 = lambda r: re.sub(r"\$(\d)", r"\\\1", r)


def _steps(source: str, rules: list[W.Rule]) -> str:
    """s, l, m0 .. mN of every source in DuckDB."""
    steps = ", ".join(f"regexp_replace(m{k}, '{r.pattern}', '{_RE2(r.replacement)}', 'g') AS m{k + 1}" for k, r in enumerate(rules))
    return f"SELECT rec_id, {source} AS s, regexp_extract_all({source}, '{W.LITERAL}', 0) AS l, array_to_string(string_split_regex({source}, '{W.LITERAL}'), chr(1)) AS m0, {steps}"


def _whole(m: str, kept: str = "l") -> str:
    return f"array_to_string(list_transform(string_split({m}, chr(1)), lambda p, i: p || coalesce({kept}[i], '')), '')"


def _names(rules: list[W.Rule]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN m{k} <> m{k + 1} THEN '{r.name}' END" for k, r in enumerate(rules)) + "], lambda x: x IS NOT NULL)"


@query(f"WITH r AS ({_steps('broken_source', W.FIXES)} FROM negative_examples WHERE broken_source IS NOT NULL) SELECT rec_id, array_to_string({_names(W.FIXES)}, ',') AS fixes, sha256({_whole(f'm{len(W.FIXES)}')}) AS fixed_hash FROM r")
def autofixed(spark, d):
    """Broken sources after the fixes, and the rules that changed them."""
    n = W.rewritten(table(spark, d, "negative_examples").where("broken_source is not null").select("rec_id", "broken_source"), "broken_source", W.FIXES)
    return n.select("rec_id", F.array_join("fixes", ",").alias("fixes"), F.sha2("text", 256).alias("fixed_hash"))


_TYPED = "array_to_string(list_transform(string_split_regex(m0, ':[A-Z][A-Za-z0-9]*'), lambda p, i: p || coalesce(':$' || lower(substr(regexp_extract_all(m0, ':[A-Z][A-Za-z0-9]*')[i], 2)), '')), '')"


@query(f"""WITH t AS (SELECT rec_id, regexp_extract_all(tk_source, '{W.LITERAL}', 0) AS l, array_to_string(string_split_regex(tk_source, '{W.LITERAL}'), chr(1)) AS m0 FROM programs WHERE tk_source IS NOT NULL), u AS (SELECT rec_id, {_whole(_TYPED)} AS d FROM t), r AS ({_steps('d', W.DEFAULT)} FROM u)
SELECT rec_id, len({_names(W.DEFAULT)}) AS n_rules, sha256({_whole(f'm{len(W.DEFAULT)}')}) AS default_hash FROM r""")
def default_syntax(spark, d):
    """Programs in the default form of the language."""
    p = table(spark, d, "programs").where("tk_source is not null").select("rec_id", W.default_types(F.col("tk_source")).alias("d"))
    r = W.rewritten(p, "d", W.DEFAULT)
    return r.select("rec_id", F.size("fixes").cast("long").alias("n_rules"), F.sha2("text", 256).alias("default_hash"))


_LAYOUT = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(m0, '([;{])', E'\\1\n', 'g'), '\}', E'\n}', 'g'), 'let ([A-Za-z_][A-Za-z0-9_]*)=', 'let \1 = ', 'g'), '\n+', chr(10), 'g')"


@query(f"""WITH t AS (SELECT rec_id, tk_source AS s, regexp_extract_all(tk_source, '{W.LITERAL}', 0) AS l, array_to_string(string_split_regex(tk_source, '{W.LITERAL}'), chr(1)) AS m0 FROM programs WHERE tk_source IS NOT NULL), e AS (SELECT rec_id, s, {_whole(_LAYOUT)} AS x FROM t)
SELECT rec_id, length(s) AS n_chars, length(x) AS n_expanded, sha256(x) AS expanded_hash FROM e""")
def expanded_pairs(spark, d):
    """Compact and expanded forms of every program."""
    e = table(spark, d, "programs").where("tk_source is not null").select("rec_id", "tk_source", W.expanded(F.col("tk_source")).alias("x"))
    return e.select("rec_id", F.length("tk_source").cast("long").alias("n_chars"), F.length("x").cast("long").alias("n_expanded"), F.sha2("x", 256).alias("expanded_hash"))


_DEF = "CASE ret WHEN 'i64' THEN '0' WHEN 'u64' THEN '0' WHEN 'f64' THEN '0.0' WHEN 'bool' THEN 'false' WHEN 'Str' THEN '\"\"' END"


@query(f"""WITH {_FUNCS}, g AS (SELECT rec_id, place, fn, ret, params, list_transform(range(len(params)), lambda i: 'p' || i) AS n, {_DEF} AS d, list_position(list_transform(params, lambda t: t = 'Str' OR starts_with(t, '[')), true) AS e, list_position(params, 'i64') AS i FROM f WHERE NOT fails AND len(params) > 0),
k AS (SELECT rec_id, place, fn, ret, array_to_string(list_transform(range(1, len(n) + 1), lambda j: n[j] || ':' || params[j]), ';') AS p, unnest([
 {{'kind': 'empty', 'body': CASE WHEN e > 0 AND d IS NOT NULL THEN 'if(' || n[e] || '.len=0){{<' || d || '}};<' || fn || '(' || array_to_string(n, ';') || ')' END}},
 {{'kind': 'negative', 'body': CASE WHEN i > 0 AND d IS NOT NULL THEN 'if(' || n[i] || '<0){{<' || d || '}};<' || fn || '(' || array_to_string(n, ';') || ')' END}},
 {{'kind': 'single', 'body': CASE WHEN len(params) = 1 AND params[1] = '[' || ret || ']' THEN 'if(p0.len=1){{<p0[0]}};<' || fn || '(p0)' END}},
 {{'kind': 'clamp', 'body': CASE WHEN i > 0 THEN 'let c=mut.' || n[i] || ';if(c<0){{c=0}};if(c>1000){{c=1000}};<' || fn || '(' || array_to_string(list_transform(n, lambda x: CASE WHEN x = n[i] THEN 'c' ELSE x END), ';') || ')' END}},
 {{'kind': 'twice', 'body': CASE WHEN len(params) = 1 AND params[1] = ret THEN '<' || fn || '(' || fn || '(p0))' END}}]) AS x FROM g)
SELECT rec_id, place, x.kind AS kind, sha256('F=' || x.kind || upper(substr(fn, 1, 1)) || substr(fn, 2) || '(' || p || '):' || ret || '{{' || x.body || '}};') AS wrapper_hash FROM k WHERE x.body IS NOT NULL""")
def guarded_functions(spark, d):
    f = C.functions_of(table(spark, d, "programs").select("rec_id", "tk_source"), "rec_id", "tk_source")
    return C.guarded(f, "rec_id").select("rec_id", "place", "kind", F.sha2("wrapper", 256).alias("wrapper_hash"))


_FEATURES = {"loop": r"lp\(", "branch": r"if\(", "import": r"[iI]=", "type": r"[tT]=", "mutable": r"mut\.", "text": '"'}


@query(r"WITH e AS (SELECT doc_id, generate_subscripts(x, 1) - 1 AS place, unnest(x) AS code FROM (SELECT doc_id, regexp_extract_all(text, '(?s)```[A-Za-z0-9_+-]*\r?\n(.*?)```', 1) AS x FROM documents WHERE text IS NOT NULL)) SELECT doc_id, place, array_to_string(list_filter(["
       + ", ".join(f"CASE WHEN regexp_matches(code, '{p}') THEN '{k}' END" for k, p in _FEATURES.items())
       + "], lambda x: x IS NOT NULL), ',') AS features, 'doc-' || doc_id || '-' || substr(sha256(code), 1, 8) AS example_id FROM e")
def tagged_examples(spark, d):
    """Examples of the documents as records: id and the features of their code."""
    e = N.doc_examples(table(spark, d, "documents"), "doc_id", "text")
    tags = F.filter(F.array(*(F.when(F.col("code").rlike(p), k) for k, p in _FEATURES.items())), lambda x: x.isNotNull())
    return e.select("doc_id", F.col("place").cast("long").alias("place"), F.array_join(tags, ",").alias("features"), F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit("-"), F.substring(F.sha2("code", 256), 1, 8)).alias("example_id"))


@query(r"""WITH v AS (SELECT rec_id, lower(coalesce(regexp_extract(task_id, '(?i)v(\d+)', 1), '')) AS variant, created_at FROM programs)
SELECT variant, count(*) AS n_rows, min(created_at) AS first_at, max(created_at) AS last_at, (epoch_us(max(created_at)) - epoch_us(min(created_at))) // 1000000 AS seconds FROM v GROUP BY 1""")
def variant_times(spark, d):
    """Variants named in the ids of tasks, with their first and last times and the seconds between."""
    p = table(spark, d, "programs").select(F.coalesce(F.regexp_extract("task_id", r"(?i)v(\d+)", 1), F.lit("")).alias("variant"), "created_at")
    us = lambda c: F.unix_micros(c.cast("timestamp"))
    return p.groupBy("variant").agg(F.count("*").alias("n_rows"), F.min("created_at").alias("first_at"), F.max("created_at").alias("last_at"), F.floor((us(F.max("created_at")) - us(F.min("created_at"))) / 1_000_000).alias("seconds"))


def _balance(sources: list[str]) -> list[tuple[int, str]]:
    return [(0, "") if s.count("{") == s.count("}") and s.count("(") == s.count(")") else (1, "unbalanced") for s in sources]


_OK = lambda t: f"CASE WHEN length(replace({t}, '{{', '')) = length(replace({t}, '}}', '')) AND length(replace({t}, '(', '')) = length(replace({t}, ')', '')) THEN 0 ELSE 1 END"


@query(f"WITH r AS ({_steps('broken_source', W.FIXES)} FROM negative_examples WHERE broken_source IS NOT NULL), f AS (SELECT rec_id, s, {_whole(f'm{len(W.FIXES)}')} AS t FROM r) SELECT rec_id, {_OK('s')} AS before, {_OK('t')} AS after, s <> t AND {_OK('t')} = 0 AS rescued FROM f")
def rescued_sources(spark, d):
    """Broken sources checked, fixed and checked again by a plug-in; those that the fixes change and that pass are rescued."""
    n = table(spark, d, "negative_examples").where("broken_source is not null").select("rec_id", F.col("broken_source").alias("s"))
    fixed = W.rewritten(n, "s", W.FIXES).drop("fixes")
    before = N.checked(fixed, "s", _balance).withColumnRenamed("exit_code", "before").drop("output")
    after = N.checked(before, "text", _balance).withColumnRenamed("exit_code", "after")
    return after.select("rec_id", "before", "after", ((F.col("s") != F.col("text")) & (F.col("after") == 0)).alias("rescued"))


@query("WITH t AS (SELECT DISTINCT task_id, 'Solve ' || task_id || '.' AS t FROM programs WHERE task_id IS NOT NULL) "
       + " UNION ALL ".join(f"SELECT task_id, '{d}' AS dimension, sha256(replace(replace('{form}', '{{n}}', (('0x' || substr(sha256('{d}:' || t), 1, 6))::BIGINT % 8 + 2)::VARCHAR), '{{task}}', t)) AS text_hash FROM t" for d, form in N.DIMENSIONS.items()))
def evolved_tasks(spark, d):
    """Five harder forms of every task."""
    t = table(spark, d, "programs").where("task_id is not null").select("task_id").distinct().withColumn("t", F.concat(F.lit("Solve "), "task_id", F.lit(".")))
    return N.evolved(t, "task_id", "t").select("task_id", "dimension", F.sha2("text", 256).alias("text_hash"))


@query("""WITH o AS (SELECT task_id, model, rec_id, row_number() OVER (PARTITION BY task_id ORDER BY CASE WHEN starts_with(model, 'seed-large') THEN 0 WHEN starts_with(model, 'seed') THEN 1 ELSE 2 END, rec_id) AS r FROM programs WHERE task_id IS NOT NULL AND (starts_with(model, 'seed') OR starts_with(model, 'transpile'))),
t AS (SELECT DISTINCT task_id FROM programs WHERE task_id IS NOT NULL) SELECT t.task_id, coalesce(o.model, 'default') AS model FROM t LEFT JOIN o ON o.task_id = t.task_id AND o.r = 1""")
def task_models(spark, d):
    """The list of tasks, each with the first open model that has solved it, by preference; else the default one."""
    p = table(spark, d, "programs").where("task_id is not null").select("task_id", "model", "rec_id")
    m = F.col("model")
    rank = F.when(m.startswith("seed-large"), 0).when(m.startswith("seed"), 1).otherwise(2)
    best = p.where(m.startswith("seed") | m.startswith("transpile")).groupBy("task_id").agg(F.min_by("model", F.struct(rank.alias("a"), "rec_id")).alias("model"))
    return p.select("task_id").distinct().join(best, "task_id", "left").select("task_id", F.coalesce("model", F.lit("default")).alias("model"))


@query("""WITH c AS (SELECT provider_name, sha256(coalesce(error_output, '') || ':' || coalesce(task_id, '')) AS h, bool_or(compiled) AS ok, count(*) AS n FROM trial_results WHERE provider_name IS NOT NULL GROUP BY 1, 2)
SELECT provider_name, sum(n)::BIGINT AS n_candidates, count(*) AS n_different, round(count(*) FILTER (ok) / count(*), 6) AS pass_rate FROM c GROUP BY 1""")
def candidate_stats(spark, d):
    """Candidates of each provider, the different ones by hash, and the share of those that pass."""
    t = table(spark, d, "trial_results").where("provider_name is not null")
    h = F.sha2(F.concat(F.coalesce("error_output", F.lit("")), F.lit(":"), F.coalesce("task_id", F.lit(""))), 256)
    c = t.groupBy("provider_name", h.alias("h")).agg(F.max("compiled").alias("ok"), F.count("*").alias("n"))
    return c.groupBy("provider_name").agg(F.sum("n").alias("n_candidates"), F.count("*").alias("n_different"), F.round(F.count_if("ok") / F.count("*"), 6).alias("pass_rate"))
