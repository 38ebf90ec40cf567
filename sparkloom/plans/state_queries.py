"""Acceptance, routing, ledgers, manifests and harvests over the test tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import dedup as D
from ..operators import gates as G
from ..operators import harvest as H
from ..operators import ranks as R
from ..operators import select as S
from ..operators import splits as P
from ..operators import transpile as T
from .corpus_queries import _IFD, _STRUCT, _proxy
from .registry import query, table


@query(r"""WITH h AS (SELECT DISTINCT task_id FROM negative_examples WHERE task_id IS NOT NULL)
SELECT rec_id, coalesce(judge.score >= 0.6, false) AND coalesce(validation.compiler_exit_code = 0, false) AND coalesce(len(differential.languages_agreed) >= 2, false) AND h.task_id IS NULL AND coalesce(regexp_matches(tk_source, 'F=[A-Za-z0-9_]+\([^()]*\):[^{};]*\{'), false) AS accepted FROM programs p LEFT JOIN h USING (task_id)""")
def acceptance(spark, d):
    """Score, compiler, differential, holdout and body in one predicate; what is unknown doesn't pass."""
    p = table(spark, d, "programs").select("rec_id", "task_id", "judge", "validation", "differential", "tk_source")
    held = table(spark, d, "negative_examples").where("task_id is not null").select("task_id", F.lit(True).alias("held")).distinct()
    body = F.col("tk_source").rlike(r"F=[A-Za-z0-9_]+\([^()]*\):[^{};]*\{")
    tests = [F.col("judge.score") >= 0.6, F.col("validation.compiler_exit_code") == 0, F.size("differential.languages_agreed") >= 2, body]
    ok = F.col("held").isNull()
    for t in tests:
        ok = ok & F.coalesce(t, F.lit(False))
    return p.join(held, "task_id", "left").select("rec_id", ok.alias("accepted"))


@query("""SELECT trial_id, CASE WHEN NOT compiled AND correction_compiled IS NULL THEN 'compile' WHEN NOT compiled AND NOT correction_compiled THEN 'correction' WHEN output_tokens IS NULL THEN 'output' WHEN latency_ms > 2000 THEN 'runtime' WHEN cost > 0.05 THEN 'cost' WHEN regexp_matches(error_output, 'E[0-9]{4}') THEN 'lint' END AS reason FROM (SELECT DISTINCT * FROM trial_results)""")
def gate_precedence(spark, d):
    """The first of six gates, in their order, that a trial fails."""
    t = table(spark, d, "trial_results").distinct()
    failed = ~F.col("compiled")
    gates = [("compile", failed & F.col("correction_compiled").isNull()), ("correction", failed & ~F.col("correction_compiled")), ("output", F.col("output_tokens").isNull()), ("runtime", F.col("latency_ms") > 2000), ("cost", F.col("cost") > 0.05), ("lint", F.col("error_output").rlike("E[0-9]{4}"))]
    return t.select("trial_id", G.first_reason(gates).alias("reason"))


_REGEN = "coalesce(difficulty = 'hard' AND mutation_type = 'brace_drop', false)"


@query(f"""WITH v AS (SELECT rec_id, coalesce(diagnostics, []) AS v, length(broken_source) - length(fixed_source) AS s, coalesce(contrastive_pair, false) AS x, {_REGEN} AS again FROM negative_examples),
b AS (SELECT *, CASE WHEN len(v) > 0 AND len(list_filter(v, lambda d: d.detail IS NULL)) = 0 THEN 'AUTO' WHEN len(v) = 0 AND x THEN 'EXEMPT' WHEN len(list_filter(v, lambda d: d.severity IN ('error', 'warning') AND d.detail IS NULL)) > 0 OR coalesce(s >= 2, false) THEN 'AGENT' ELSE 'LEAVE' END AS own FROM v)
SELECT rec_id, CASE WHEN again THEN 'REGEN' ELSE own END AS bucket, CASE WHEN again THEN own END AS would_be, CASE WHEN again THEN 'made again' WHEN own = 'AUTO' THEN 'all ' || len(v) || ' can be fixed' WHEN own = 'EXEMPT' THEN 'every hit exempt' WHEN own = 'AGENT' AND len(list_filter(v, lambda d: d.severity IN ('error', 'warning') AND d.detail IS NULL)) > 0 THEN 'without a fix: ' || array_to_string(list_sort(list_distinct(list_transform(list_filter(v, lambda d: d.severity IN ('error', 'warning') AND d.detail IS NULL), lambda d: d.code))), ',') WHEN own = 'AGENT' THEN 'saves ' || s WHEN len(v) > 0 THEN 'only hints' ELSE 'no hits' END AS reason FROM b""")
def routing_reasons(spark, d):
    """Bucket of each record with its reason, and the one it would be in if it weren't made again."""
    again = F.coalesce((F.col("difficulty") == "hard") & (F.col("mutation_type") == "brace_drop"), F.lit(False))
    n = table(spark, d, "negative_examples").select("rec_id", F.coalesce("diagnostics", F.array()).alias("v"), (F.length("broken_source") - F.length("fixed_source")).alias("s"), F.coalesce("contrastive_pair", F.lit(False)).alias("x"), again.alias("again"))
    return G.routed_with_reason(n, 2).select("rec_id", "bucket", "would_be", "reason")


@query(_STRUCT + """, b AS (SELECT structure, rec_id, nullif(phase, 'A') AS kind, coalesce(judge.score, 0) AS score FROM h JOIN programs USING (rec_id)), k AS (SELECT *, row_number() OVER (PARTITION BY structure, kind ORDER BY -score, rec_id) AS r FROM b),
w AS (SELECT *, row_number() OVER (PARTITION BY structure ORDER BY kind NULLS FIRST) AS q FROM k WHERE r = 1 AND (kind IS NULL OR kind <> 'D')), kept AS (SELECT structure, rec_id FROM w WHERE q <= 3)
SELECT structure, rec_id FROM kept UNION ALL SELECT structure, min(rec_id) FROM b WHERE structure NOT IN (SELECT structure FROM kept) GROUP BY 1""")
def structural_keepers(spark, d):
    """Of each structural group the best program of phase A and of each other phase but D, three at most."""
    p = table(spark, d, "programs").where(F.length(F.trim("tk_source")) > 0)
    rows = p.select(X.structural_hash(F.col("tk_source")).alias("structure"), F.nullif(F.col("phase"), F.lit("A")).alias("kind"), F.coalesce("judge.score", F.lit(0.0)).alias("score"), "rec_id")
    return D.keepers(rows, "structure", "kind", "score", "rec_id", "D").select("structure", "rec_id")


@query("""WITH f AS (SELECT regexp_replace(task_id, 'v[0-9]+$', '') AS fam, count(*) AS n_rows, min_by(category, rec_id) FILTER (category IS NOT NULL) AS stratum, bool_or(model = 'hand') AS protected FROM programs WHERE task_id IS NOT NULL GROUP BY 1),
c AS (SELECT *, coalesce(sum(n_rows) OVER (PARTITION BY stratum ORDER BY sha256('4:' || fam), fam ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, round(sum(n_rows) OVER (PARTITION BY stratum) * 0.05) AS goal FROM f WHERE NOT coalesce(protected, false))
SELECT fam, n_rows, before < goal AS holdout FROM c UNION ALL SELECT fam, n_rows, false FROM f WHERE coalesce(protected, false)""")
def protected_holdout(spark, d):
    """A holdout of whole families that leaves out those with a protected record."""
    p = table(spark, d, "programs").where("task_id is not null").select(X.family(F.col("task_id")).alias("f"), "category", F.when(F.col("category").isNotNull(), F.col("rec_id")).alias("rec_id"), "model")
    fixed = p.groupBy("f").agg(F.max(F.col("model") == "hand").alias("p"), F.count("*").alias("n_rows")).where("p").select(F.col("f").alias("fam"), "n_rows")
    rest = p.join(fixed.select(F.col("fam").alias("f")), "f", "left_anti")
    carved = P.family_holdout(rest, F.col("f"), "category", "rec_id", 0.05, 4).select("fam", "n_rows", "holdout")
    return carved.unionByName(fixed.select("fam", "n_rows", F.lit(False).alias("holdout")))


@query(f"""WITH s AS (SELECT rec_id, category, round(s, 6) AS k FROM {_IFD}), r AS (SELECT s.*, p.task_id, row_number() OVER (PARTITION BY s.category ORDER BY k DESC, s.rec_id) AS r, count(*) OVER (PARTITION BY s.category) AS n FROM s JOIN programs p USING (rec_id)),
m AS (SELECT f.rate, count(*) AS n_rows, count(DISTINCT task_id) AS n_tasks, 0.5 * sum(CAST(k AS DECIMAL(12, 6)))::DOUBLE / count(*) + 0.5 * count(DISTINCT task_id) / (SELECT count(DISTINCT task_id) FROM r) AS worth FROM r, (VALUES (0.05), (0.1), (0.25), (0.5)) f(rate) WHERE r <= greatest(1, ceil(n * f.rate)) GROUP BY 1)
SELECT rate::DOUBLE AS rate, n_rows, n_tasks, round(worth, 5) AS worth, row_number() OVER (ORDER BY round(worth, 5) DESC, rate) = 1 AS recommended FROM m""")
def selection_rates(spark, d):
    """Selection at several rates in one pass, and the rate with the best mean score and coverage of tasks."""
    p = _proxy(spark, d).select("rec_id", "category", F.round("s", 6).alias("k")).join(table(spark, d, "programs").select("rec_id", "task_id"), "rec_id")
    r = R.range_rank(p, ["category"], [F.desc("k"), F.col("rec_id")], "r", "n")
    rates = F.array(*(F.struct(F.lit(x).alias("rate"), (F.col("r") <= F.greatest(F.lit(1), F.ceil(F.col("n") * x))).alias("in")) for x in (0.05, 0.1, 0.25, 0.5)))
    all_ = p.agg(F.countDistinct("task_id").alias("tasks"))
    m = r.select("k", "task_id", F.explode(rates).alias("x")).where("x.in").groupBy("x.rate").agg(F.count("*").alias("n_rows"), F.countDistinct("task_id").alias("n_tasks"), (F.sum(F.col("k").cast("decimal(12,6)")).cast("double") / F.count("*")).alias("mean"))
    m = m.join(F.broadcast(all_)).withColumn("worth", F.round(0.5 * F.col("mean") + 0.5 * F.col("n_tasks") / F.col("tasks"), 5))
    best = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("worth"), "rate")) == 1  # four rows
    return m.select("rate", "n_rows", "n_tasks", "worth", best.alias("recommended"))


_STEPS = "o AS (SELECT task_id, wave, prev_sha256, new_sha256, lag(new_sha256) OVER w AS before, row_number() OVER w AS r, count(*) OVER (PARTITION BY task_id) AS n FROM (SELECT DISTINCT * FROM rewrite_ledger WHERE task_id IS NOT NULL AND status = 'rewritten') WINDOW w AS (PARTITION BY task_id ORDER BY wave, ts, coalesce(new_sha256, ''), coalesce(prev_sha256, '')))"


@query(f"""WITH {_STEPS}, p AS (SELECT DISTINCT task_id FROM programs WHERE task_id IS NOT NULL)
SELECT task_id, 'chain' AS kind, wave FROM o WHERE r > 1 AND prev_sha256 IS DISTINCT FROM before UNION ALL SELECT task_id, 'open', wave FROM o WHERE r = n AND new_sha256 IS NULL UNION ALL SELECT o.task_id, 'record', wave FROM o LEFT JOIN p ON p.task_id = o.task_id WHERE r = n AND p.task_id IS NULL""")
def ledger_problems(spark, d):
    """Breaks of each task's chain, chains that end open, and tasks without a record."""
    l = table(spark, d, "rewrite_ledger").where("task_id is not null and status = 'rewritten'").distinct()
    w = Window.partitionBy("task_id").orderBy("wave", "ts", F.coalesce("new_sha256", F.lit("")), F.coalesce("prev_sha256", F.lit("")))
    o = l.select("task_id", "wave", "prev_sha256", "new_sha256", F.lag("new_sha256").over(w).alias("before"), F.row_number().over(w).alias("r"), F.count("*").over(Window.partitionBy("task_id")).alias("n"))
    known = table(spark, d, "programs").where("task_id is not null").select("task_id", F.lit(True).alias("known")).distinct()
    o = o.join(known, "task_id", "left")
    kinds = F.array(F.when((F.col("r") > 1) & ~F.col("prev_sha256").eqNullSafe(F.col("before")), "chain"), F.when((F.col("r") == F.col("n")) & F.col("new_sha256").isNull(), "open"), F.when((F.col("r") == F.col("n")) & F.col("known").isNull(), "record"))
    return o.select("task_id", F.explode(kinds).alias("kind"), "wave").where("kind is not null")


@query("""WITH l AS (SELECT DISTINCT task_id, wave, status, coalesce(new_sha256, '') AS n FROM rewrite_ledger WHERE task_id IS NOT NULL), f AS (SELECT task_id, status, min({'w': wave, 'n': n}) AS first, count(*) AS c FROM l GROUP BY 1, 2)
SELECT task_id, string_agg(status || 'x' || c, ',' ORDER BY first, status) AS segments, count(*) AS n_segments, sum(c)::BIGINT AS n_patches FROM f GROUP BY 1""")
def patch_segments(spark, d):
    """What the patches of each task added, each once, in order of its first appearance."""
    l = table(spark, d, "rewrite_ledger").where("task_id is not null").select("task_id", "wave", "status", F.coalesce("new_sha256", F.lit("")).alias("n")).distinct()
    f = l.groupBy("task_id", "status").agg(F.min(F.struct("wave", "n")).alias("at"), F.count("*").alias("c"))
    segs = F.transform(F.array_sort(F.collect_list(F.struct("at", "status", "c"))), lambda x: F.concat(x["status"], F.lit("x"), x["c"].cast("string")))
    return f.groupBy("task_id").agg(F.array_join(segs, ",").alias("segments"), F.count("*").alias("n_segments"), F.sum("c").alias("n_patches"))


@query("""WITH m AS (SELECT task_id, count(*) AS n FROM programs WHERE task_id IS NOT NULL GROUP BY 1), l AS (SELECT task_id, count(DISTINCT coalesce(new_sha256, '')) AS k, bool_or(new_sha256 IS NULL) AS o FROM rewrite_ledger WHERE task_id IS NOT NULL GROUP BY 1), j AS (SELECT m.task_id AS a, l.task_id AS b, n, k, o FROM m FULL JOIN l ON m.task_id = l.task_id)
SELECT count(*) FILTER (b IS NULL) AS n_unlisted, count(*) FILTER (a IS NULL) AS n_missing, count(*) FILTER (n > 1) AS n_repeated, count(*) FILTER (o) AS n_open, count(*) FILTER (b IS NULL OR a IS NULL OR n > 1 OR o) = 0 AS clean FROM j""")
def manifest_clean(spark, d):
    """Invariants of a manifest against its records, and whether all hold."""
    m = table(spark, d, "programs").where("task_id is not null").groupBy("task_id").agg(F.count("*").alias("n"), F.lit(True).alias("a"))
    l = table(spark, d, "rewrite_ledger").where("task_id is not null").groupBy("task_id").agg(F.max(F.col("new_sha256").isNull()).alias("o"), F.lit(True).alias("b"))
    none = lambda c: F.col(c).isNull()
    bad = F.coalesce(none("b") | none("a") | (F.col("n") > 1) | F.col("o"), F.lit(False))
    return m.join(l, "task_id", "full").agg(F.count_if(none("b")).alias("n_unlisted"), F.count_if(none("a")).alias("n_missing"), F.count_if(F.col("n") > 1).alias("n_repeated"), F.count_if("o").alias("n_open"), (F.count_if(bad) == 0).alias("clean"))


_BLOCK = r"(?s)```json\s*(.*?)```"


@query(rf"""SELECT doc_id, coalesce(json_extract_string(CASE WHEN json_valid(b) THEN b END, '$.status'), 'none') AS status, coalesce(regexp_extract(text, '(?i)(?:variant|fassung) (\d+)', 1), '') AS variant FROM (SELECT doc_id, text, trim(regexp_extract(text, '{_BLOCK}', 1)) AS b FROM documents WHERE text IS NOT NULL)""")
def payload_defaults(spark, d):
    """Status in the fenced JSON of each document, ``none`` where there is none, and the variant that it names."""
    t = F.col("text")
    b = F.trim(F.regexp_extract(t, _BLOCK, 1))
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.coalesce(F.get_json_object(b, "$.status"), F.lit("none")).alias("status"), F.regexp_extract(t, r"(?i)(?:variant|fassung) (\d+)", 1).alias("variant"))


@query("""WITH t AS (SELECT task_id, count(*) AS n_tests, max(length(tk_source)) AS size FROM programs WHERE task_id IS NOT NULL GROUP BY 1)
SELECT task_id, n_tests, CASE WHEN size IS NULL THEN NULL WHEN size < 400 AND n_tests <= 2 THEN 1 WHEN size < 1200 OR n_tests <= 4 THEN 2 ELSE 3 END AS difficulty FROM t""")
def task_specs(spark, d):
    """A specification for each task from its programs: difficulty by size and number of tests."""
    t = table(spark, d, "programs").where("task_id is not null").groupBy("task_id").agg(F.count("*").alias("n_tests"), F.max(F.length("tk_source")).alias("size"))
    grade = F.when(F.col("size").isNull(), F.lit(None)).when((F.col("size") < 400) & (F.col("n_tests") <= 2), 1).when((F.col("size") < 1200) | (F.col("n_tests") <= 4), 2).otherwise(3)
    return t.select("task_id", "n_tests", grade.alias("difficulty"))


@query("""WITH t AS (SELECT provider_name, count(DISTINCT trial_id) AS n, min(run_at) AS a, max(run_at) AS b FROM trial_results WHERE run_at IS NOT NULL AND provider_name IS NOT NULL GROUP BY 1)
SELECT provider_name, n AS n_done, round(n * 3600.0 / nullif((epoch_us(b) - epoch_us(a)) / 1000000, 0), 4) AS per_hour, round((20000 - n) * ((epoch_us(b) - epoch_us(a)) / 1000000) / n, 2) AS seconds_left FROM t""")
def throughput(spark, d):
    """Rate of each provider's runs and the time that is left to 20,000 at it."""
    t = table(spark, d, "trial_results").where("run_at is not null and provider_name is not null").groupBy("provider_name").agg(F.countDistinct("trial_id").alias("n"), F.min("run_at").alias("a"), F.max("run_at").alias("b"))
    s = (F.unix_micros(F.col("b").cast("timestamp")) - F.unix_micros(F.col("a").cast("timestamp"))) / 1_000_000
    return t.select("provider_name", F.col("n").alias("n_done"), F.round(F.col("n") * 3600.0 / F.nullif(s, F.lit(0.0)), 4).alias("per_hour"), F.round((20000 - F.col("n")) * s / F.col("n"), 2).alias("seconds_left"))


_SHARES = {"alpha": 400_000, "beta": 350_000, "gamma": 250_000}


@query("""SELECT rec_id, CASE WHEN r * 618033989 % 1000000000 < 400000000 THEN 'alpha' WHEN r * 618033989 % 1000000000 < 750000000 THEN 'beta' ELSE 'gamma' END AS assigned FROM (SELECT rec_id, row_number() OVER (ORDER BY rec_id) AS r FROM programs)""")
def drift_free_assignment(spark, d):
    """Programs in order, given out so that the counts never drift from the shares."""
    p = R.bucket_rank(table(spark, d, "programs").select("rec_id"), F.floor(F.col("rec_id") / 65536), [F.col("rec_id")], name="r")
    return S.assigned(p, "r", _SHARES).select("rec_id", "assigned")


@query("""WITH o AS (SELECT task_id, rec_id, differential.majority_output AS got FROM programs WHERE task_id IS NOT NULL AND differential.majority_output IS NOT NULL), f AS (SELECT task_id, min_by(got, rec_id) AS want FROM o GROUP BY 1),
n AS (SELECT rec_id, want, got, CASE WHEN regexp_full_match(trim(want), '-?[0-9]{1,18}') THEN CAST(trim(want) AS BIGINT) END AS a, CASE WHEN regexp_full_match(trim(got), '-?[0-9]{1,18}') THEN CAST(trim(got) AS BIGINT) END AS b FROM o JOIN f USING (task_id))
SELECT rec_id, CASE WHEN lower(want) = lower(got) THEN 'none' WHEN len(string_split(want, chr(10))) <> len(string_split(got, chr(10))) THEN 'wrong_line_count' WHEN a IS NULL OR b IS NULL THEN 'algorithm_bug' WHEN abs(a - b) = 1 THEN 'off_by_one' WHEN b = 0 AND a <> 0 THEN 'returns_zero' ELSE 'algorithm_bug' END AS difference FROM n""")
def output_differences(spark, d):
    """How each program's output differs from that of its task's first program (one line each in these tables)."""
    o = table(spark, d, "programs").where("task_id is not null").select("task_id", "rec_id", F.col("differential.majority_output").alias("got")).where("got is not null")
    f = o.groupBy("task_id").agg(F.min_by("got", "rec_id").alias("want"))
    return o.join(f, "task_id").select("rec_id", X.difference(F.col("want"), F.col("got")).alias("difference"))


@query()
def python_functions(spark, d):
    """Top-level functions of the Python sources; no SQL, see tests/test_records.py."""
    return H.python_functions(table(spark, d, "parallel_corpus"), "rec_id", "python_source")


@query()
def python_programs(spark, d):
    """Python sources as programs, or why not; no SQL, see tests/test_records.py."""
    return T.from_python(table(spark, d, "parallel_corpus"), "rec_id", "python_source")


@query()
def grammar_programs(spark, d):
    """A thousand programs of the grammar; no SQL, see tests/test_records.py."""
    return H.grammar_programs(spark, 1000, 7)
