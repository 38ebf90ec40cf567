"""Similarity with evaluation records, samples, quotas and text pairs over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import formats as C
from ..operators import gates as G
from ..operators import joins as J
from ..operators import ranks as R
from ..operators import select as S
from ..operators import splits as P
from .registry import query, table

_SPLIT = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _tfidf(items: str) -> str:
    """best(query_id, item_id, sim) of every program among the items (a query giving id, t)."""
    terms = lambda side: f"SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(regexp_split_to_array(lower(t), '\\s+')) AS term FROM {side} WHERE t IS NOT NULL) WHERE term <> '' GROUP BY 1, 2"
    return f"""q0 AS (SELECT rec_id AS id, tk_source AS t FROM programs), i0 AS ({items}), q AS ({terms("q0")}), i AS ({terms("i0")}), n AS (SELECT count(*) AS n FROM i0 WHERE t IS NOT NULL),
idf AS (SELECT term, ln((n + 1) / (count(*) + 1)) + 1 AS idf FROM i, n GROUP BY term, n), iw AS (SELECT id, term, tf * idf AS w FROM i JOIN idf USING (term)), qw AS (SELECT id, q.term, tf * coalesce(idf, ln(n + 1) + 1) AS w FROM q CROSS JOIN n LEFT JOIN idf ON q.term = idf.term),
il AS (SELECT id, sqrt(sum(w * w)) AS l FROM iw GROUP BY 1), ql AS (SELECT id, sqrt(sum(w * w)) AS l FROM qw GROUP BY 1),
s AS (SELECT qw.id AS query_id, iw.id AS item_id, sum(qw.w * iw.w) AS dot FROM qw JOIN iw ON qw.term = iw.term GROUP BY 1, 2), r AS (SELECT query_id, item_id, round(dot / (il.l * ql.l), 6) AS sim FROM s JOIN il ON il.id = item_id JOIN ql ON ql.id = query_id),
best AS (SELECT query_id, item_id, sim FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, item_id) AS k FROM r) WHERE k = 1)"""


@query("WITH " + _tfidf("SELECT rec_id AS id, tk_source AS t FROM programs WHERE split IN ('validation', 'test')") + " SELECT q0.id AS query_id, item_id, coalesce(sim, 0) AS sim FROM q0 LEFT JOIN best ON query_id = q0.id")
def tfidf_eval_sim(spark, d):
    """Of every program, the most similar one of all validation and test records."""
    p = table(spark, d, "programs")
    return J.tfidf_best(p.select(F.col("rec_id").alias("query_id"), F.col("tk_source").alias("text")), p.where(F.col("split").isin("validation", "test")).select(F.col("rec_id").alias("item_id"), F.col("tk_source").alias("text")))


_EVAL = "SELECT rec_id AS id, tk_source AS t FROM programs JOIN task_sources USING (source_name) WHERE usage = 'evaluation'"
_HELD = "list_sum(list_transform(string_split(sha256(p.source_name || p.task_id), ''), lambda x: instr('0123456789abcdef', x) - 1)) % 5 = 0"


@query("WITH " + _tfidf(_EVAL) + f""", m AS (SELECT DISTINCT source_name, task_id FROM programs p JOIN task_sources USING (source_name) WHERE usage = 'split' AND task_id IS NOT NULL AND {_HELD})
SELECT p.rec_id, CASE WHEN p.source_name IS NULL THEN 'no_origin' WHEN s.source_name IS NULL THEN 'unknown_origin' WHEN s.usage = 'evaluation' THEN 'evaluation_source' WHEN m.task_id IS NOT NULL THEN 'holdout_partition' WHEN b.sim > 0.85 THEN CASE WHEN o.source_name = p.source_name THEN 'similarity_threshold' ELSE 'cross_source_duplicate' END END AS reason, coalesce(b.sim, 0) AS similarity, b.item_id AS matched_id
FROM programs p LEFT JOIN task_sources s USING (source_name) LEFT JOIN m ON m.source_name = p.source_name AND m.task_id = p.task_id LEFT JOIN best b ON b.query_id = p.rec_id LEFT JOIN programs o ON o.rec_id = b.item_id""")
def firewall_stages(spark, d):
    """All four stages for every program: origin, holdout manifest, similarity with the evaluation sources' records, and
    whether the similar record is of another source."""
    programs, sources = table(spark, d, "programs"), table(spark, d, "task_sources").select("source_name", "usage", F.lit(True).alias("known"))
    p = J.dimension(programs.select("rec_id", "source_name", "task_id", "tk_source"), sources, ["source_name"])
    held = p.where((F.col("usage") == "split") & F.col("task_id").isNotNull() & (P.hash_side(F.col("source_name"), F.col("task_id")) == "evaluation")).select("source_name", "task_id", F.lit(True).alias("held")).distinct()
    best = J.tfidf_best(p.select(F.col("rec_id").alias("query_id"), F.col("tk_source").alias("text")), p.where("usage = 'evaluation'").select(F.col("rec_id").alias("item_id"), F.col("tk_source").alias("text")))
    b = best.select(F.col("query_id").alias("rec_id"), F.col("item_id").alias("matched_id"), F.col("sim").alias("similarity"))
    origin = programs.select(F.col("rec_id").alias("matched_id"), F.col("source_name").alias("matched_source"))
    rows = p.drop("tk_source").join(held, ["source_name", "task_id"], "left").join(b, "rec_id", "left").join(origin, "matched_id", "left")
    near = F.col("similarity") > 0.85
    gates = [("no_origin", F.col("source_name").isNull()), ("unknown_origin", F.col("known").isNull()), ("evaluation_source", F.col("usage") == "evaluation"), ("holdout_partition", F.col("held").isNotNull()),
             ("similarity_threshold", near & (F.col("matched_source") == F.col("source_name"))), ("cross_source_duplicate", near)]
    return rows.select("rec_id", G.first_reason(gates).alias("reason"), "similarity", "matched_id")


_GRADE = "CASE difficulty WHEN 'easy' THEN 1 WHEN 'hard' THEN 3 ELSE 2 END"


@query(f"""WITH t AS (SELECT rec_id, coalesce(mutation_type, '-') AS category, {_GRADE} AS grade, sha256('13:' || rec_id) AS h FROM negative_examples), q AS (SELECT *, row_number() OVER (PARTITION BY category, grade ORDER BY h, rec_id) <= CASE grade WHEN 2 THEN 6 ELSE 3 END AS chosen FROM t),
f AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY chosen DESC, h, rec_id) AS place FROM q) SELECT rec_id, category, chosen FROM f WHERE place <= 12""")
def balanced_sample(spark, d):
    """Twelve of each category: a quarter easy, half medium, a quarter hard, topped up from the rest in hash order."""
    n = table(spark, d, "negative_examples").select("rec_id", F.coalesce("mutation_type", F.lit("-")).alias("category"), F.expr(_GRADE).alias("grade"))
    return S.balanced(n, "category", "grade", "rec_id", {1: 3, 2: 6, 3: 3}, 13).select("rec_id", "category", "chosen")


_W = {"gen-main": 0.4, "gen-retry": 0.2, "compose-c": 0.2, "no-such-source": 0.1, "port-c": 0.1}
_C = {"gen-main": 1.0, "gen-retry": 1.0, "compose-c": 2.0, "port-c": 2.0}
_case = lambda m, e: "CASE source " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in m.items()) + f" ELSE {e} END"


@query(f"""WITH n AS (SELECT source_name AS source, count(*) AS n FROM programs WHERE source_name IN ({", ".join(f"'{k}'" for k in _W)}) GROUP BY 1), w AS (SELECT source, n, {_case(_W, 0.0)} AS w, {_case(_C, 2.0)} AS cap FROM n),
a AS (SELECT *, (w + (1 - sum(w) OVER ()) / count(*) OVER ()) AS aw FROM w), t AS (SELECT *, floor(900 * aw / sum(aw) OVER ()) AS want FROM a), u AS (SELECT *, least(want, floor(n * cap)) AS t0 FROM t),
x AS (SELECT *, sum(want - t0) OVER () AS lack, n > t0 AND source IN ('gen-main', 'port-c') AS takes FROM u)
SELECT source, n AS n_rows, (t0 + CASE WHEN takes AND lack > 0 THEN least(floor(lack / (count(*) FILTER (takes) OVER ())), floor(n * cap) - t0) ELSE 0 END)::BIGINT AS target FROM x""")
def sampling_targets(spark, d):
    """Targets of the sources: weights of absent ones shared out evenly, caps on repetition, and what the caps leave over to
    the sources that may take more."""
    n = table(spark, d, "programs").where(F.col("source_name").isin(*_W)).groupBy(F.col("source_name").alias("source")).agg(F.count("*").alias("n_rows"))
    return S.shared_targets(n, _W, 900, _C, 2.0, ["gen-main", "port-c"])


_TIER3 = "CASE WHEN tk_tokens > 300 THEN 'application' WHEN tk_tokens < 120 THEN 'simple' ELSE 'rest' END"


@query(f"""WITH b AS (SELECT rec_id, {_TIER3} AS tier, coalesce(category IN ('A-CND', 'A-SRT'), false) AS repair, coalesce(category = 'B-MAP', false) AS bulk, sha256('21:' || rec_id) AS h, coalesce(created_at < TIMESTAMP '2026-02-01', false) AS sampled FROM programs WHERE tk_tokens IS NOT NULL),
s AS (SELECT *, count(*) OVER () AS total, row_number() OVER (PARTITION BY repair ORDER BY h, rec_id) AS r FROM b WHERE sampled), c1 AS (SELECT * FROM s WHERE NOT repair OR r <= floor(total * 0.05)),
c2 AS (SELECT *, count(*) OVER () AS kept, row_number() OVER (PARTITION BY tier ORDER BY bulk, h, rec_id) AS a FROM c1), c3 AS (SELECT * FROM c2 WHERE tier <> 'application' OR a <= floor(kept * 0.1)),
need AS (SELECT greatest(0, floor((SELECT count(*) FROM s) * 0.4) - count(*) FILTER (tier = 'simple')) AS need FROM c3), pool AS (SELECT rec_id, row_number() OVER (ORDER BY h, rec_id) AS k FROM b WHERE NOT sampled AND tier = 'simple' AND NOT repair)
SELECT rec_id, 'sample' AS origin FROM c3 UNION ALL SELECT rec_id, 'pool' FROM pool, need WHERE k <= need""")
def tier_resample(spark, d):
    """A sample with repair records capped, applications capped (bulk ones go first) and simple records filled up from the pool."""
    p = table(spark, d, "programs").where("tk_tokens is not null").select("rec_id", F.expr(_TIER3).alias("tier"), F.coalesce(F.col("category").isin("A-CND", "A-SRT"), F.lit(False)).alias("repair"), F.coalesce(F.col("category") == "B-MAP", F.lit(False)).alias("bulk"), F.coalesce(F.col("created_at") < F.expr("timestamp '2026-02-01'"), F.lit(False)).alias("sampled"))
    return S.resampled(p, "rec_id", 21, repair_cap=0.05, application_cap=0.1, simple_floor=0.4)


@query("""SELECT rec_id, k AS place, length(s) * 3 // 10 + ('0x' || substr(sha256(k || ':' || s), 1, 8))::BIGINT % (length(s) * 7 // 10 - length(s) * 3 // 10) AS cut FROM (SELECT rec_id, tk_source AS s, unnest(range(0, least(3, greatest(1, length(tk_source) // 50)))) AS k FROM programs WHERE length(tk_source) >= 40)""")
def completion_cuts(spark, d):
    """Up to three places of each source, from 30 to 70 % of it, where a completion begins; picked by hash."""
    e = C.completions(table(spark, d, "programs").select("rec_id", "tk_source"), "rec_id", "tk_source")
    return e.select("rec_id", "place", F.length("prompt").cast("long").alias("cut"))


_PROMPTS = {"A-ARR": "Work on an array: {task}.", "A-MTH": "Compute: {task}.", "A-STR": "Work on text: {task}."}


@query("SELECT rec_id, length(replace(CASE category " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _PROMPTS.items()) + " ELSE 'Write a program for {task}.' END, '{task}', coalesce(task_id, 'a task'))) AS prompt_chars FROM programs WHERE tk_source IS NOT NULL")
def prompt_templates(spark, d):
    """Prompts by the template of a record's category."""
    p = table(spark, d, "programs").where("tk_source is not null")
    return p.select("rec_id", F.length(C.prompt(F.col("category"), F.coalesce("task_id", F.lit("a task")), _PROMPTS, "Write a program for {task}.")).cast("long").alias("prompt_chars"))


@query("""WITH s AS (SELECT source_name, row_number() OVER (ORDER BY source_name) - 1 AS k, count(*) OVER () AS n FROM task_sources) SELECT i, source_name, i // n AS variant FROM range(0, 75) t(i) JOIN s ON i % n = k""")
def cycled_pool(spark, d):
    """75 tasks: the pool over and over, with the number of the turn as variant."""
    return S.cycled(spark, table(spark, d, "task_sources"), "source_name", 75)


@query("""WITH a AS (SELECT category, avg(tk_tokens) AS tokens, count(*) AS n, count(*) FILTER (judge.accepted) AS ok FROM programs GROUP BY 1), t AS (SELECT p.category, sum(r.cost) AS cost FROM (SELECT DISTINCT trial_id, task_id, cost FROM trial_results) r JOIN (SELECT DISTINCT task_id, category FROM programs WHERE task_id IS NOT NULL) p USING (task_id) GROUP BY 1)
SELECT a.category, n AS n_rows, round(ok / n, 6) AS acceptance, round(tokens, 6) AS tokens, round(coalesce(cost, 0), 6) AS cost FROM a LEFT JOIN t ON t.category IS NOT DISTINCT FROM a.category""")
def category_metrics(spark, d):
    """Acceptance, tokens and cost of the trials of each category's tasks."""
    p = table(spark, d, "programs")
    a = p.groupBy("category").agg(F.count("*").alias("n_rows"), F.round(F.count_if("judge.accepted") / F.count("*"), 6).alias("acceptance"), F.round(F.avg("tk_tokens"), 6).alias("tokens"))
    r = table(spark, d, "trial_results").select("trial_id", "task_id", "cost").distinct()
    t = r.join(p.where("task_id is not null").select("task_id", F.col("category").alias("c")).distinct(), "task_id").groupBy("c").agg(F.sum("cost").alias("cost"))
    return a.join(t, F.col("category").eqNullSafe(F.col("c")), "left").select("category", "n_rows", "acceptance", "tokens", F.round(F.coalesce("cost", F.lit(0.0)), 6).alias("cost"))


@query("""WITH t AS (SELECT DISTINCT trial_id, provider_name, compiled, run_at FROM trial_results WHERE provider_name IS NOT NULL AND run_at IS NOT NULL), f AS (SELECT provider_name, avg(CASE WHEN compiled THEN 0.0 ELSE 1.0 END) AS rate, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY provider_name ORDER BY run_at DESC, trial_id DESC) AS r FROM t) WHERE r <= 100 GROUP BY 1),
s AS (SELECT provider_name, 1.0 / count(*) OVER () AS share, n >= 100 AND rate > 0.25 AS failing FROM f), h AS (SELECT *, CASE WHEN failing THEN share / 2 ELSE share END AS own FROM s)
SELECT provider_name, round((own + CASE WHEN NOT failing THEN coalesce((1 - sum(own) OVER ()) * own / nullif(sum(own) FILTER (NOT failing) OVER (), 0), 0) ELSE 0 END)::DOUBLE, 6) AS share FROM h""")
def rebalanced_shares(spark, d):
    """Equal shares of the providers; one that fails too often of its last 100 runs is halved, the rest goes to the others."""
    t = table(spark, d, "trial_results").where("provider_name is not null and run_at is not null").select("trial_id", "provider_name", "compiled", "run_at").distinct()
    last = R.first_n(t, ["provider_name"], [F.desc("run_at"), F.desc("trial_id")], 100)
    f = last.groupBy("provider_name").agg(F.avg(F.when(F.col("compiled"), 0.0).otherwise(1.0)).alias("rate"), F.count("*").alias("n"))
    return S.rebalanced(f, "provider_name", (F.col("n") >= 100) & (F.col("rate") > 0.25))
