"""Gates, filters and classifiers over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import gates as G
from ..operators import joins as J
from .registry import query, table

_GATE_SQL = r"""CASE WHEN p.tk_source IS NULL OR trim(p.tk_source) = '' THEN 'empty_source'
 WHEN s.source_name IS NULL THEN 'unmapped'
 WHEN p.validation.compiler_exit_code <> 0 THEN 'compile_fail'
 WHEN NOT p.judge.accepted THEN 'rejected'
 WHEN p.judge.score < 0.6 THEN 'below_min_score'
 WHEN NOT regexp_matches(p.tk_source, 'F=[A-Za-z_][A-Za-z0-9_]*\(') THEN 'no_function' END"""


def _gated(spark, d):
    p = table(spark, d, "programs").select("rec_id", "tk_source", "source_name", "validation", "judge")
    s = table(spark, d, "task_sources").select("source_name", F.lit(True).alias("known"))
    gates = [
        ("empty_source", F.col("tk_source").isNull() | (F.trim("tk_source") == "")),
        ("unmapped", F.col("known").isNull()),
        ("compile_fail", F.col("validation.compiler_exit_code") != 0),
        ("rejected", ~F.col("judge.accepted")),
        ("below_min_score", F.col("judge.score") < 0.6),
        ("no_function", ~F.col("tk_source").rlike(r"F=[A-Za-z_][A-Za-z0-9_]*\(")),
    ]
    return G.with_reason(J.dimension(p, s, ["source_name"]), gates)


@query(f"SELECT coalesce({_GATE_SQL}, 'pass') AS reason, count(*) AS n_rows FROM programs p LEFT JOIN task_sources s USING (source_name) GROUP BY 1")
def gate_report(spark, d):
    return G.reason_report(_gated(spark, d))


@query(f"SELECT p.rec_id, {_GATE_SQL} AS reason FROM programs p LEFT JOIN task_sources s USING (source_name)")
def gate_rows(spark, d):
    return _gated(spark, d).select("rec_id", "reason")


@query("""SELECT rec_id, coalesce(CASE WHEN starts_with(lower(model), 'mutation-constant') THEN false WHEN starts_with(lower(model), 'seed') OR starts_with(lower(model), 'mutation') THEN true END, false) AS open FROM programs""")
def prefix_filter(spark, d):
    return table(spark, d, "programs").select("rec_id", G.starts_with_any(F.col("model"), ["seed", "mutation"], ["mutation-constant"]).alias("open"))


@query(r"""SELECT rec_id, regexp_matches(regexp_replace(tk_source, '"(\\.|[^"\\])*"', '""', 'g'), '[A-Z\[\]]|==|!=') AS flagged FROM programs WHERE tk_source IS NOT NULL""")
def surface_guard(spark, d):
    p = table(spark, d, "programs").where("tk_source is not null")
    return p.select("rec_id", X.without_literals(F.col("tk_source")).rlike(r"[A-Z\[\]]|==|!=").alias("flagged"))


@query("""SELECT coalesce(CASE WHEN category LIKE 'A-M%' THEN 'maths' WHEN category LIKE 'A-%' THEN 'seed' WHEN category LIKE '%-NET' THEN 'net' WHEN category LIKE 'C-_FG' THEN 'config' END, 'other') AS kind, count(*) AS n_rows FROM programs GROUP BY 1""")
def source_glob(spark, d):
    globs = [("A-M*", "maths"), ("A-*", "seed"), ("*-NET", "net"), ("C-?FG", "config")]
    return table(spark, d, "programs").groupBy(G.first_glob(F.col("category"), globs, "other").alias("kind")).agg(F.count("*").alias("n_rows"))


@query("""SELECT rec_id, len(diagnostics) AS n_diagnostics FROM negative_examples WHERE fixed_source IS NOT NULL AND trim(fixed_source) <> '' AND broken_source <> fixed_source AND len(list_filter(diagnostics, lambda x: starts_with(x.code, 'E4'))) > 0""")
def contrastive_pairs(spark, d):
    n = table(spark, d, "negative_examples")
    ok = (F.trim("fixed_source") != "") & (F.col("broken_source") != F.col("fixed_source")) & F.exists("diagnostics", lambda x: x["code"].startswith("E4"))
    return n.where(ok).select("rec_id", F.size("diagnostics").cast("long").alias("n_diagnostics"))


_VERDICT = "CASE WHEN error_output IS NOT NULL AND NOT compiled AND correction_compiled IS NULL THEN 'compile_fail' WHEN NOT compiled AND NOT correction_compiled THEN 'correction_fail' WHEN NOT compiled THEN 'corrected' WHEN output_tokens IS NULL THEN 'no_output' ELSE 'pass' END"


@query(f"SELECT {_VERDICT} AS verdict, count(*) AS n_rows, count(DISTINCT trial_id) AS n_trials FROM trial_results GROUP BY 1")
def verdict_buckets(spark, d):
    t = table(spark, d, "trial_results")
    return t.groupBy(F.expr(_VERDICT).alias("verdict")).agg(F.count("*").alias("n_rows"), F.countDistinct("trial_id").alias("n_trials"))


@query("""WITH v AS (SELECT rec_id, diagnostics AS v, length(broken_source) - length(fixed_source) AS saving, CASE WHEN contrastive_pair THEN 1 ELSE 0 END AS exempt FROM negative_examples)
SELECT rec_id, CASE WHEN len(v) > 0 AND len(list_filter(v, lambda x: x.detail IS NOT NULL)) = len(v) THEN 'AUTO' WHEN NOT coalesce(len(v) > 0, false) AND exempt > 0 THEN 'EXEMPT' WHEN len(list_filter(v, lambda x: x.severity = 'error' AND x.detail IS NULL)) > 0 THEN 'AGENT' WHEN saving >= 2 THEN 'AGENT' ELSE 'LEAVE' END AS bucket FROM v""")
def routing_classifier(spark, d):
    n = table(spark, d, "negative_examples")
    v = F.transform(F.coalesce("diagnostics", F.array()), lambda x: F.struct(x["severity"].alias("severity"), x["detail"].isNotNull().alias("fixable")))
    saving = F.length("broken_source") - F.length("fixed_source")
    return n.select("rec_id", v.alias("v"), saving.alias("s"), F.when(F.col("contrastive_pair"), 1).otherwise(0).alias("x")).select("rec_id", G.routed(F.col("v"), F.col("x"), F.col("s"), 2).alias("bucket"))


@query("""WITH t AS (SELECT coalesce(compiled, false) AS a, coalesce(output_tokens > 0, false) AS b, coalesce(latency_ms < 1000, false) AS c FROM trial_results)
SELECT 0 AS tier_no, 'compile' AS tier, count(*) AS attempted, count(*) FILTER (a) AS passed, count(*) FILTER (NOT a) AS failed FROM t
UNION ALL SELECT 1, 'output', count(*) FILTER (a), count(*) FILTER (a AND b), count(*) FILTER (a AND NOT b) FROM t
UNION ALL SELECT 2, 'latency', count(*) FILTER (a AND b), count(*) FILTER (a AND b AND c), count(*) FILTER (a AND b AND NOT c) FROM t""")
def tier_short_circuit(spark, d):
    t = table(spark, d, "trial_results")
    return G.tier_results(t, [("compile", F.col("compiled")), ("output", F.col("output_tokens") > 0), ("latency", F.col("latency_ms") < 1000)])


@query("""SELECT CASE WHEN compiled THEN 1.0 WHEN correction_compiled THEN 0.5 WHEN output_tokens > 0 THEN 0.25 ELSE 0.0 END::DOUBLE AS reward, count(*) AS n_rows, round(avg(output_tokens), 6) AS mean_tokens FROM trial_results GROUP BY 1""")
def reward_tiers(spark, d):
    r = F.when(F.col("compiled"), 1.0).when(F.col("correction_compiled"), 0.5).when(F.col("output_tokens") > 0, 0.25).otherwise(0.0)
    return table(spark, d, "trial_results").groupBy(r.alias("reward")).agg(F.count("*").alias("n_rows"), F.round(F.avg("output_tokens"), 6).alias("mean_tokens"))


_CLAIMS = {"claim": r"(?i)\b(saves?|faster than|compared with) ", "marker": r"<\|[a-z]+\|>"}


@query(rf"""SELECT doc_kind, count(*) FILTER (regexp_matches(text, '{_CLAIMS["claim"]}')) AS claim, count(*) FILTER (regexp_matches(text, '{_CLAIMS["marker"]}')) AS marker FROM documents GROUP BY 1""")
def export_guard(spark, d):
    return table(spark, d, "documents").groupBy("doc_kind").agg(*(F.count_if(F.col("text").rlike(rx)).alias(k) for k, rx in _CLAIMS.items()))


@query(r"""SELECT CASE WHEN error_output IS NULL THEN 'none' WHEN regexp_matches(error_output, 'E4[0-2]') THEN 'syntax' WHEN regexp_matches(error_output, 'E4[3-6]') THEN 'type' WHEN regexp_matches(error_output, 'E[0-9]{4}') THEN 'other_code' ELSE 'no_code' END AS failure, count(*) AS n_rows FROM trial_results GROUP BY 1""")
def failure_category(spark, d):
    e = F.col("error_output")
    kind = F.when(e.isNull(), "none").when(e.rlike("E4[0-2]"), "syntax").when(e.rlike("E4[3-6]"), "type").when(e.rlike("E[0-9]{4}"), "other_code").otherwise("no_code")
    return table(spark, d, "trial_results").groupBy(kind.alias("failure")).agg(F.count("*").alias("n_rows"))


@query("""SELECT s.source_name, CASE WHEN license IS NULL THEN 'missing' WHEN upper(license) LIKE '%GPL%' THEN 'copyleft' WHEN license IN ('MIT', 'Apache-2.0', 'CC0-1.0', 'BSD-3-Clause') THEN 'permissive' ELSE 'unknown' END AS license_class, count(p.rec_id) AS n_programs FROM task_sources s LEFT JOIN programs p USING (source_name) GROUP BY 1, 2""")
def license_report(spark, d):
    lic = F.col("license")
    kind = F.when(lic.isNull(), "missing").when(F.upper(lic).contains("GPL"), "copyleft").when(lic.isin("MIT", "Apache-2.0", "CC0-1.0", "BSD-3-Clause"), "permissive").otherwise("unknown")
    n = table(spark, d, "programs").groupBy("source_name").agg(F.count("rec_id").alias("n"))
    return table(spark, d, "task_sources").join(n, "source_name", "left").select("source_name", kind.alias("license_class"), F.coalesce("n", F.lit(0)).alias("n_programs"))


@query(r"""SELECT rec_id, list_filter([CASE WHEN task_id IS NULL OR trim(task_id) = '' THEN 'task_id' END, CASE WHEN category IS NULL THEN 'category' END, CASE WHEN split IS NULL OR split NOT IN ('train', 'validation', 'test') THEN 'split' END, CASE WHEN tk_tokens IS NULL OR tk_tokens <= 0 THEN 'tk_tokens' END, CASE WHEN judge.score IS NULL OR judge.score NOT BETWEEN 0 AND 1 THEN 'score' END, CASE WHEN len(validation.error_codes) > 0 AND validation.compiler_exit_code = 0 THEN 'codes' END], lambda x: x IS NOT NULL) AS faults FROM programs""")
def schema_faults(spark, d):
    p = table(spark, d, "programs")
    bad = lambda c: F.coalesce(~c, F.lit(True))
    tests = [
        ("task_id", bad(F.trim("task_id") != "")), ("category", F.col("category").isNull()), ("split", bad(F.col("split").isin("train", "validation", "test"))),
        ("tk_tokens", bad(F.col("tk_tokens") > 0)), ("score", bad(F.col("judge.score").between(0, 1))),
        ("codes", (F.size("validation.error_codes") > 0) & (F.col("validation.compiler_exit_code") == 0)),
    ]
    return p.select("rec_id", F.filter(F.array(*(F.when(c, n) for n, c in tests)), lambda x: x.isNotNull()).alias("faults"))


@query("""SELECT category, count(*) AS n_rows, count(DISTINCT id) AS n_ids, count(*) - count(DISTINCT id) AS n_repeated FROM programs GROUP BY 1""")
def unique_ids(spark, d):
    return table(spark, d, "programs").groupBy("category").agg(F.count("*").alias("n_rows"), F.countDistinct("id").alias("n_ids"), (F.count("*") - F.countDistinct("id")).alias("n_repeated"))


@query(r"""SELECT rec_id, coalesce(validation.compiler_exit_code = 0, false) AS conformant, coalesce(judge.accepted, false) AS accepted, coalesce(differential.majority_output, '') AS output, coalesce(len(differential.languages_agreed), 0) AS n_agreed, coalesce(attempts, 1) AS attempts FROM programs""")
def manifest_projection(spark, d):
    return table(spark, d, "programs").select(
        "rec_id", F.coalesce(F.col("validation.compiler_exit_code") == 0, F.lit(False)).alias("conformant"), F.coalesce("judge.accepted", F.lit(False)).alias("accepted"),
        F.coalesce("differential.majority_output", F.lit("")).alias("output"), F.greatest(F.size(F.coalesce("differential.languages_agreed", F.array())), F.lit(0)).cast("long").alias("n_agreed"), F.coalesce("attempts", F.lit(1)).alias("attempts"),
    )


_CROSS_SQL = {
    "accepted_uncompiled": "judge.accepted AND validation.compiler_exit_code <> 0",
    "codes_without_failure": "len(validation.error_codes) > 0 AND validation.compiler_exit_code = 0",
    "output_without_languages": "differential.majority_output IS NOT NULL AND coalesce(len(differential.languages_agreed), 0) = 0",
    "second_version_unjudged": "version = 2 AND judge IS NULL",
    "ingested_before_made": "ingested_at < created_at",
    "tokens_without_source": "tk_tokens > 0 AND (tk_source IS NULL OR trim(tk_source) = '')",
    "score_against_verdict": "judge.accepted AND judge.score < 0.5",
    "no_attempts": "attempts < 1",
}


@query("SELECT rec_id, list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in _CROSS_SQL.items()) + "], lambda x: x IS NOT NULL) AS faults FROM programs")
def cross_field_faults(spark, d):
    """Rules between the fields of a record."""
    agreed = F.coalesce(F.size("differential.languages_agreed"), F.lit(0))
    code, ok = F.col("validation.compiler_exit_code"), F.col("judge.accepted")
    tests = [
        ok & (code != 0), (F.size("validation.error_codes") > 0) & (code == 0), F.col("differential.majority_output").isNotNull() & (agreed <= 0), (F.col("version") == 2) & F.col("judge").isNull(),
        F.col("ingested_at") < F.col("created_at"), (F.col("tk_tokens") > 0) & (F.col("tk_source").isNull() | (F.trim("tk_source") == "")), ok & (F.col("judge.score") < 0.5), F.col("attempts") < 1,
    ]
    return table(spark, d, "programs").select("rec_id", F.filter(F.array(*(F.when(c, n) for n, c in zip(_CROSS_SQL, tests))), lambda x: x.isNotNull()).alias("faults"))
