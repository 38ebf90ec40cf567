"""Joins, set operations and reconciliation over the test tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import joins as J
from ..operators import ranks as R
from .registry import query, table


@query("""SELECT c.rec_id, p.rec_id AS program_id, round(c.toke_tokens / c.python_tokens, 6) AS ratio FROM parallel_corpus c JOIN programs p USING (task_id) WHERE c.python_tokens > 0""")
def inner_pairs(spark, d):
    c = table(spark, d, "parallel_corpus").where("python_tokens > 0")
    p = table(spark, d, "programs").select("task_id", F.col("rec_id").alias("program_id"))
    return c.join(p, "task_id").select("rec_id", "program_id", F.round(F.col("toke_tokens") / F.col("python_tokens"), 6).alias("ratio"))


_TRIAL = "(SELECT task_id, count(DISTINCT trial_id) AS n_trials, round(avg(latency_ms), 4) AS latency FROM trial_results GROUP BY 1)"


@query(f"""SELECT p.rec_id, t.n_trials, t.latency, s.usage, coalesce(s.split_ratio, 0.5) AS split_ratio FROM programs p LEFT JOIN {_TRIAL} t USING (task_id) LEFT JOIN task_sources s USING (source_name)""")
def enrich_left(spark, d):
    t = table(spark, d, "trial_results").where("task_id is not null").groupBy("task_id").agg(F.countDistinct("trial_id").alias("n_trials"), F.round(F.avg("latency_ms"), 4).alias("latency"))
    p = table(spark, d, "programs").select("rec_id", "task_id", "source_name").join(t, "task_id", "left")
    s = table(spark, d, "task_sources").select("source_name", "usage", "split_ratio")
    return J.dimension(p, s, ["source_name"]).select("rec_id", "n_trials", "latency", "usage", F.coalesce("split_ratio", F.lit(0.5)).alias("split_ratio"))


@query("SELECT rec_id FROM programs p WHERE task_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM trial_results t WHERE t.task_id = p.task_id)")
def resume_anti(spark, d):
    return table(spark, d, "programs").where("task_id is not null").select("rec_id", "task_id").join(table(spark, d, "trial_results").select("task_id"), "task_id", "left_anti").select("rec_id")


@query("SELECT trial_id, count(*) AS n_rows FROM trial_results t WHERE EXISTS (SELECT 1 FROM programs p WHERE t.task_id = p.task_id) GROUP BY 1")
def membership_semi(spark, d):
    t = table(spark, d, "trial_results").select("trial_id", "task_id").join(table(spark, d, "programs").select("task_id"), "task_id", "left_semi")
    return t.groupBy("trial_id").agg(F.count("*").alias("n_rows"))


_LATEST = "(SELECT task_id, nullif(max_by(coalesce(new_sha256, '-'), ts || lpad(wave::VARCHAR, 6, '0') || coalesce(new_sha256, '')), '-') AS sha FROM rewrite_ledger WHERE task_id IS NOT NULL GROUP BY 1)"


@query(f"""WITH l AS {_LATEST}, p AS (SELECT task_id, max(sha256(tk_source)) AS h FROM programs WHERE task_id IS NOT NULL GROUP BY 1)
SELECT CASE WHEN p.task_id IS NULL THEN 'missing' WHEN l.task_id IS NULL THEN 'orphan' WHEN l.sha IS NULL THEN 'unhashed' WHEN p.h IS NOT DISTINCT FROM l.sha THEN 'ok' ELSE 'stale' END AS bucket, count(*) AS n_tasks FROM p FULL JOIN l ON p.task_id = l.task_id GROUP BY 1""")
def manifest_reconcile(spark, d):
    order = F.concat("ts", F.lpad(F.col("wave").cast("string"), 6, "0"), F.coalesce("new_sha256", F.lit("")))
    last = table(spark, d, "rewrite_ledger").where("task_id is not null").groupBy("task_id").agg(F.max_by(F.struct("new_sha256"), order)["new_sha256"].alias("sha"))
    p = table(spark, d, "programs").where("task_id is not null").groupBy("task_id").agg(F.max(F.sha2("tk_source", 256)).alias("h"))
    return J.reconcile(p, last, "task_id", "h", "sha").groupBy("bucket").agg(F.count("*").alias("n_tasks"))


@query("""WITH k AS (SELECT model AS k, 1 AS a, 0 AS b, 0 AS c FROM programs UNION ALL SELECT provider_name, 0, 1, 0 FROM trial_results UNION ALL SELECT source_name, 0, 0, 1 FROM task_sources)
SELECT k AS name, sum(a)::BIGINT AS programs, sum(b)::BIGINT AS trials, sum(c)::BIGINT AS sources FROM k WHERE k IS NOT NULL GROUP BY 1""")
def union_of_keys(spark, d):
    one = lambda t, c, n: table(spark, d, t).select(F.col(c).alias("name"), F.lit(n).alias("kind"))
    u = one("programs", "model", "programs").unionByName(one("trial_results", "provider_name", "trials")).unionByName(one("task_sources", "source_name", "sources"))
    return u.where("name is not null").groupBy("name").pivot("kind", ["programs", "trials", "sources"]).count().na.fill(0)


_SIG = r"F=[A-Za-z0-9_]+\(([^()]*)\):(\[?[A-Za-z0-9]+\]?)"


@query(rf"""WITH f AS (SELECT rec_id, unnest(regexp_extract_all(tk_source, '{_SIG}', 1)) AS params, unnest(regexp_extract_all(tk_source, '{_SIG}', 2)) AS ret FROM programs),
g AS (SELECT ret, CASE WHEN params NOT LIKE '%;%' THEN split_part(params, ':', 2) END AS param FROM f),
r AS (SELECT ret AS type, count(*) AS producers FROM g GROUP BY 1), c AS (SELECT param AS type, count(*) AS consumers FROM g WHERE param <> '' GROUP BY 1),
s AS (SELECT ret AS type, count(*) AS same FROM g WHERE ret = param GROUP BY 1)
SELECT r.type, r.producers, c.consumers, r.producers * c.consumers - coalesce(s.same, 0) AS pairs FROM r JOIN c USING (type) LEFT JOIN s USING (type)""")
def type_compat(spark, d):
    """Producers and consumers of each type and the number of pairs (not with itself), from counts: no pair is built."""
    rx = lambda k: F.regexp_extract_all("tk_source", F.lit(_SIG), F.lit(k))
    f = table(spark, d, "programs").select(F.explode(F.arrays_zip(rx(1).alias("params"), rx(2).alias("ret"))).alias("z")).select("z.*")
    g = f.select("ret", F.when(~F.col("params").contains(";"), F.coalesce(F.get(F.split("params", ":"), F.lit(1)), F.lit(""))).alias("param"))
    kinds = g.groupBy("ret", "param").agg(F.count("*").alias("n"))
    r = kinds.groupBy(F.col("ret").alias("type")).agg(F.sum("n").alias("producers"), F.coalesce(F.sum(F.when(F.col("param") == F.col("ret"), F.col("n"))), F.lit(0)).alias("same"))
    c = kinds.where("param <> ''").groupBy(F.col("param").alias("type")).agg(F.sum("n").alias("consumers"))
    return r.join(c, "type").select("type", "producers", "consumers", (F.col("producers") * F.col("consumers") - F.col("same")).alias("pairs"))


_FN = _SIG.replace("F=[A-Za-z0-9_]+", "F=([A-Za-z0-9_]+)")


@query(rf"""WITH f AS (SELECT rec_id, {", ".join(f"regexp_extract_all(tk_source, '{_FN}', {k}) AS x{k}" for k in (1, 2, 3))} FROM programs WHERE tk_source IS NOT NULL),
g AS (SELECT rec_id, unnest(range(len(x1))) AS place, unnest(x1) AS fn, unnest(x2) AS params, unnest(x3) AS ret FROM f)
SELECT rec_id, place, fn, CASE WHEN params NOT LIKE '%;%' THEN split_part(params, ':', 2) END AS param, ret FROM g""")
def type_members(spark, d):
    """Every function with the classes it belongs to: param (null: several, empty: none) and ret. The pairs of a type in
    type_compat are its rows by ret joined to its rows by param, without a row and itself."""
    rx = lambda k: F.regexp_extract_all("tk_source", F.lit(_FN), F.lit(k))
    f = table(spark, d, "programs").select("rec_id", F.posexplode(F.arrays_zip(rx(1).alias("fn"), rx(2).alias("params"), rx(3).alias("ret"))).alias("place", "z"))
    param = F.when(~F.col("z.params").contains(";"), F.coalesce(F.get(F.split("z.params", ":"), F.lit(1)), F.lit("")))
    return f.select("rec_id", F.col("place").cast("long").alias("place"), "z.fn", param.alias("param"), "z.ret")


@query("""SELECT p.provider_name, s.source_name, count(DISTINCT t.trial_id) AS n_trials FROM (SELECT DISTINCT provider_name FROM trial_results WHERE provider_name IS NOT NULL) p CROSS JOIN task_sources s
LEFT JOIN (SELECT DISTINCT trial_id, provider_name, source_name FROM trial_results JOIN (SELECT DISTINCT task_id, source_name FROM programs) q USING (task_id)) t ON t.provider_name = p.provider_name AND t.source_name = s.source_name GROUP BY 1, 2""")
def trial_matrix(spark, d):
    """Providers by sources: two small dimensions make the grid, facts are counted before they meet it."""
    t = table(spark, d, "trial_results").select("trial_id", "provider_name", "task_id")
    facts = t.join(table(spark, d, "programs").select("task_id", "source_name").distinct(), "task_id").groupBy("provider_name", "source_name").agg(F.countDistinct("trial_id").alias("n"))
    grid = J.grid(t.where("provider_name is not null").select("provider_name").distinct(), table(spark, d, "task_sources").select("source_name"))
    return grid.join(facts, ["provider_name", "source_name"], "left").select("provider_name", "source_name", F.coalesce("n", F.lit(0)).alias("n_trials"))


_MED = "(SELECT category, median(tk_tokens)::DOUBLE AS m FROM programs WHERE tk_tokens > 0 GROUP BY 1)"


@query(f"""SELECT f.factor::DOUBLE AS factor, count(*) AS n_rows, count(*) FILTER (p.tk_tokens > f.factor * m.m) AS over FROM programs p JOIN {_MED} m USING (category), (VALUES (1.0), (1.25), (1.5), (2.0)) f(factor) WHERE p.tk_tokens > 0 GROUP BY 1""")
def budget_grid(spark, d):
    """Rows over a budget of factor times their category's median, for a fixed grid of factors in one pass."""
    p = table(spark, d, "programs").where("tk_tokens > 0").select("category", "tk_tokens")
    m = p.groupBy("category").agg(F.median("tk_tokens").alias("m"))
    cells = F.array(*(F.struct(F.lit(f).alias("factor"), (F.col("tk_tokens") > f * F.col("m")).alias("o")) for f in (1.0, 1.25, 1.5, 2.0)))
    return p.join(m, "category").select(F.explode(cells).alias("c")).groupBy("c.factor").agg(F.count("*").alias("n_rows"), F.count_if("c.o").alias("over"))


@query("""WITH a AS (SELECT category, phase, median(tk_tokens)::DOUBLE AS m FROM programs WHERE phase IS NOT NULL GROUP BY 1, 2 HAVING count(tk_tokens) >= 5), b AS (SELECT category, median(tk_tokens)::DOUBLE AS m FROM programs GROUP BY 1)
SELECT p.rec_id, round(coalesce(a.m, b.m) * 1.5) AS budget FROM programs p LEFT JOIN a ON a.category = p.category AND a.phase = p.phase LEFT JOIN b ON b.category = p.category""")
def fallback_budget(spark, d):
    p = table(spark, d, "programs").select("rec_id", "category", "phase", "tk_tokens")
    a = p.where("phase is not null").groupBy("category", "phase").agg(F.median("tk_tokens").alias("m"), F.count("tk_tokens").alias("n")).where("n >= 5").drop("n")
    b = p.groupBy("category").agg(F.median("tk_tokens").alias("m"))
    return J.fallback(p, a, ["category", "phase"], b, ["category"], "m").select("rec_id", F.round(F.col("m") * 1.5).alias("budget"))


_SIDES = "SELECT DISTINCT task_id AS id FROM programs WHERE task_id IS NOT NULL AND split "


@query(f"""WITH l AS ({_SIDES} = 'train'), r AS ({_SIDES} IN ('validation', 'test')), u AS (SELECT id, max(l) AS l, max(r) AS r FROM (SELECT id, 1 AS l, 0 AS r FROM l UNION ALL SELECT id, 0, 1 FROM r) GROUP BY 1),
s AS (SELECT regexp_replace(regexp_replace(regexp_replace(id, '[0-9]+', '9', 'g'), '[A-Z]+', 'A', 'g'), '[a-z]+', 'a', 'g') AS shape, sum(l) AS l, sum(r) AS r, sum(l * r) AS b FROM u GROUP BY 1)
SELECT sum(l)::BIGINT AS left_n, sum(r)::BIGINT AS right_n, count(*) FILTER (l > 0 AND r > 0) AS shared_shapes, sum(l) FILTER (l > 0 AND r > 0)::BIGINT AS left_comparable, sum(r) FILTER (l > 0 AND r > 0)::BIGINT AS right_comparable, sum(b)::BIGINT AS overlap_n, CASE WHEN sum(b) > 0 THEN 'FAIL' WHEN count(*) FILTER (l > 0 AND r > 0) = 0 THEN 'VACUOUS' ELSE 'PASS' END AS status FROM s""")
def disjointness_report(spark, d):
    p = table(spark, d, "programs").select(F.col("task_id").alias("id"), "split")
    return J.disjointness(p.where("split = 'train'").select("id"), p.where("split in ('validation', 'test')").select("id"))


@query("""SELECT regexp_replace(regexp_replace(regexp_replace(task_id, '[0-9]+', '9', 'g'), '[A-Z]+', 'A', 'g'), '[a-z]+', 'a', 'g') AS shape, count(*) AS n_rows, min(task_id) AS example FROM programs GROUP BY 1""")
def id_shapes(spark, d):
    return table(spark, d, "programs").groupBy(X.id_shape(F.col("task_id")).alias("shape")).agg(F.count("*").alias("n_rows"), F.min("task_id").alias("example"))


@query("""WITH b AS (SELECT rec_id, sha256(toke_source) AS h FROM parallel_corpus WHERE toke_source IS NOT NULL), k AS (SELECT DISTINCT sha256(tk_source) AS h FROM programs WHERE tk_source IS NOT NULL)
SELECT rec_id, CASE WHEN k.h IS NOT NULL THEN 'corpus' WHEN row_number() OVER (PARTITION BY b.h ORDER BY rec_id) > 1 THEN 'batch' ELSE 'new' END AS label FROM b LEFT JOIN k ON b.h = k.h""")
def batch_duplicates(spark, d):
    b = table(spark, d, "parallel_corpus").where("toke_source is not null").select("rec_id", F.sha2("toke_source", 256).alias("h"))
    k = table(spark, d, "programs").where("tk_source is not null").select(F.sha2("tk_source", 256).alias("h"), F.lit(True).alias("old")).distinct()
    first = b.groupBy("h").agg(F.min("rec_id").alias("first"))
    label = F.when(F.col("old"), "corpus").when(F.col("rec_id") != F.col("first"), "batch").otherwise("new")
    return b.join(first, "h").join(k, "h", "left").select("rec_id", label.alias("label"))


@query("""WITH u AS (SELECT sha256(tk_source) AS key, 'p' AS s FROM programs WHERE tk_source IS NOT NULL UNION ALL SELECT sha256(fixed_source), 'n' FROM negative_examples WHERE fixed_source IS NOT NULL)
SELECT key, count(*) FILTER (s = 'p') AS n_left, count(*) FILTER (s = 'n') AS n_right FROM u GROUP BY 1 HAVING count(DISTINCT s) = 2""")
def cross_source_groups(spark, d):
    u = table(spark, d, "programs").select(F.sha2("tk_source", 256).alias("h"), F.lit("p").alias("s")).unionByName(table(spark, d, "negative_examples").select(F.sha2("fixed_source", 256).alias("h"), F.lit("n").alias("s")))
    return J.both_sides(u, F.col("h"), F.col("s"), ("p", "n"))


@query("""WITH l AS (SELECT DISTINCT task_id, wave, status, ts, coalesce(new_sha256, '') AS n FROM rewrite_ledger), o AS (SELECT status AS new, lag(status) OVER (PARTITION BY task_id ORDER BY wave, ts, status, n) AS old FROM l WHERE task_id IS NOT NULL)
SELECT old, new, count(*) AS n_rows FROM o WHERE old IS NOT NULL GROUP BY 1, 2""")
def transition_matrix(spark, d):
    l = table(spark, d, "rewrite_ledger").where("task_id is not null").select("task_id", "wave", "status", "ts", F.coalesce("new_sha256", F.lit("")).alias("n")).distinct()
    w = Window.partitionBy("task_id").orderBy("wave", "ts", "status", "n")
    return l.select(F.col("status").alias("new"), F.lag("status").over(w).alias("old")).where("old is not null").groupBy("old", "new").agg(F.count("*").alias("n_rows"))


@query("""WITH r AS (SELECT task_id, rec_id, model, row_number() OVER (PARTITION BY task_id ORDER BY CASE WHEN starts_with(model, 'seed') THEN 0 WHEN starts_with(model, 'transpile') THEN 1 ELSE 2 END, rec_id) AS n FROM programs WHERE task_id IS NOT NULL) SELECT task_id, rec_id, model FROM r WHERE n = 1""")
def preferred_model(spark, d):
    p = table(spark, d, "programs").where("task_id is not null").select("task_id", "rec_id", "model")
    rank = F.when(F.col("model").startswith("seed"), 0).when(F.col("model").startswith("transpile"), 1).otherwise(2)
    return R.first_by(p, ["task_id"], F.struct(rank.alias("a"), F.col("rec_id").alias("b")))


_WORD = r"[\p{L}\p{M}\p{N}_]"
_GAP = r"[\s\p{Z}\p{Cc}\p{Cf}]*"  # also the invisible characters of rewritten sources
_IMPORT = rf"(?<![\p{{L}}\p{{M}}\p{{N}}_.])[Ii]{_GAP}={_GAP}({_WORD}+){_GAP}:{_GAP}({_WORD}+(?:{_GAP}\.{_GAP}{_WORD}+)*)"
_CALL = rf"(?<![\p{{L}}\p{{M}}\p{{N}}_.])({_WORD}+){_GAP}\.{_GAP}({_WORD}+)(?={_GAP}\()"


@query()
def alias_calls(spark, d):
    """Calls ``alias.name(`` anywhere in a source, by imported module (as spelled) and function, blanks allowed between the
    parts; of two imports under one alias the last counts. No SQL: RE2 can't look behind. See tests/test_core.py."""
    both = lambda rx, a, b: F.arrays_zip(*(F.regexp_extract_all("tk_source", F.lit(rx), F.lit(k)).alias(n) for k, n in ((1, a), (2, b))))
    p = table(spark, d, "programs").where("tk_source is not null").select(F.reverse(both(_IMPORT, "alias", "module")).alias("imports"), F.explode(both(_CALL, "alias", "fn")).alias("call"))
    at = F.array_position(F.transform("imports", lambda x: x["alias"]), F.col("call.alias"))
    c = p.withColumn("at", at).where("at > 0").select(F.regexp_replace(F.get("imports", (F.col("at") - 1).cast("int"))["module"], _GAP[:-1], "").alias("module"), "call.fn")
    return c.groupBy("module", "fn").agg(F.count("*").alias("n_calls"))


@query("SELECT DISTINCT task_id FROM (SELECT task_id FROM programs UNION ALL SELECT task_id FROM parallel_corpus UNION ALL SELECT task_id FROM negative_examples) WHERE task_id IS NOT NULL")
def union_ids(spark, d):
    u = table(spark, d, "programs").select("task_id")
    for t in ("parallel_corpus", "negative_examples"):
        u = u.unionByName(table(spark, d, t).select("task_id"))
    return u.where("task_id is not null").distinct()


@query("SELECT task_id FROM programs INTERSECT SELECT task_id FROM trial_results")
def intersect_ids(spark, d):
    return table(spark, d, "programs").select("task_id").intersect(table(spark, d, "trial_results").select("task_id"))


@query("SELECT task_id FROM rewrite_ledger EXCEPT SELECT task_id FROM trial_results")
def except_ids(spark, d):
    return table(spark, d, "rewrite_ledger").select("task_id").subtract(table(spark, d, "trial_results").select("task_id"))


@query("""SELECT task_id, string_agg(status, ' > ' ORDER BY f) AS statuses FROM (SELECT task_id, status, min(wave) AS f FROM (SELECT task_id, status, wave * 10 + CASE status WHEN 'kept' THEN 1 WHEN 'rewritten' THEN 2 WHEN 'failed' THEN 3 ELSE 4 END AS wave FROM rewrite_ledger WHERE task_id IS NOT NULL) GROUP BY 1, 2) GROUP BY 1""")
def ordered_merge(spark, d):
    """Statuses of each task in order of first appearance."""
    order = F.col("wave") * 10 + F.when(F.col("status") == "kept", 1).when(F.col("status") == "rewritten", 2).when(F.col("status") == "failed", 3).otherwise(4)
    l = table(spark, d, "rewrite_ledger").where("task_id is not null").groupBy("task_id", "status").agg(F.min(order).alias("f"))
    return l.groupBy("task_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("f", "status"))), lambda x: x["status"]), " > ").alias("statuses"))
