"""Windows, ranks and limits over the test tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import ranks as R
from .registry import query, table

_DEDUP = "(SELECT DISTINCT task_id, wave, status, prev_sha256, new_sha256, ts FROM rewrite_ledger WHERE task_id IS NOT NULL)"


def _ledger(spark, d):
    return table(spark, d, "rewrite_ledger").where("task_id is not null").select("task_id", "wave", "status", "prev_sha256", "new_sha256", "ts").distinct()


@query(f"SELECT task_id, wave, status, ts FROM (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY wave DESC, ts DESC, status DESC, coalesce(new_sha256, '') DESC, coalesce(prev_sha256, '') DESC) AS r FROM {_DEDUP}) WHERE r = 1")
def last_write_wins(spark, d):
    order = F.struct("wave", "ts", "status", F.coalesce("new_sha256", F.lit("")).alias("n"), F.coalesce("prev_sha256", F.lit("")).alias("p"))
    return R.last_by(_ledger(spark, d), ["task_id"], order).select("task_id", "wave", "status", "ts")


@query("SELECT min(rec_id) AS rec_id, count(*) AS n_rows FROM programs WHERE tk_source IS NOT NULL GROUP BY sha256(tk_source)")
def first_occurrence(spark, d):
    return table(spark, d, "programs").where("tk_source is not null").groupBy(F.sha2("tk_source", 256)).agg(F.min("rec_id").alias("rec_id"), F.count("*").alias("n_rows")).select("rec_id", "n_rows")


@query("SELECT rec_id, category FROM (SELECT rec_id, category, row_number() OVER (PARTITION BY category ORDER BY coalesce(judge.score, 0) DESC, rec_id) AS r, count(*) OVER (PARTITION BY category) AS n FROM programs) WHERE r <= greatest(1, ceil(n * 0.2))")
def top_fraction(spark, d):
    p = table(spark, d, "programs").select("rec_id", "category", F.coalesce("judge.score", F.lit(0.0)).alias("s"))
    return R.top_fraction(p, ["category"], [F.desc("s"), F.col("rec_id")], 0.2).select("rec_id", "category")


@query("SELECT rec_id, category FROM (SELECT rec_id, category, row_number() OVER (PARTITION BY category ORDER BY sha256('11:' || rec_id), rec_id) AS r FROM programs) WHERE r <= 25")
def stratified_sample(spark, d):
    from ..operators.splits import sample_per

    return sample_per(table(spark, d, "programs").select("rec_id", "category"), ["category"], "rec_id", 25, 11)


@query("SELECT rec_id, task_id FROM (SELECT rec_id, task_id, row_number() OVER (PARTITION BY task_id ORDER BY attempts NULLS LAST, rec_id) AS r FROM programs WHERE task_id IS NOT NULL) WHERE r <= 2")
def per_key_cap(spark, d):
    p = table(spark, d, "programs").where("task_id is not null").select("rec_id", "task_id", "attempts")
    return R.first_n(p, ["task_id"], [F.asc_nulls_last("attempts"), F.col("rec_id")], 2).select("rec_id", "task_id")


@query("""WITH r AS (SELECT rec_id, mutation_type, row_number() OVER (PARTITION BY mutation_type ORDER BY rec_id) - 1 AS r, greatest(1, floor(count(*) OVER (PARTITION BY mutation_type) / 10)) AS s FROM negative_examples)
SELECT rec_id, mutation_type FROM r WHERE r % s = 0 AND r / s < 10""")
def evenly_spaced(spark, d):
    return R.evenly_spaced(table(spark, d, "negative_examples").select("rec_id", "mutation_type"), ["mutation_type"], [F.col("rec_id")], 10)


@query("SELECT rec_id, row_number() OVER (ORDER BY r, category NULLS LAST, rec_id) AS place FROM (SELECT rec_id, category, row_number() OVER (PARTITION BY category ORDER BY rec_id) AS r FROM programs)")
def round_robin(spark, d):
    """Rows of the categories in turn."""
    p = table(spark, d, "programs").select("rec_id", "category")
    return R.interleaved(p, "category", [F.col("rec_id")]).select("rec_id", F.col("place").cast("long").alias("place"))


@query("SELECT source_name, i AS variant FROM task_sources, range(0, 5) t(i)")
def pool_cycling(spark, d):
    return table(spark, d, "task_sources").select("source_name", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(4).cast("long"))).alias("variant"))


@query("SELECT rec_id, (r - 1) % 12 AS shard, (r - 1) // 20 AS batch FROM (SELECT rec_id, row_number() OVER (ORDER BY rec_id) AS r FROM parallel_corpus)")
def shard_numbers(spark, d):
    p = R.bucket_rank(table(spark, d, "parallel_corpus").select("rec_id"), F.floor(F.col("rec_id") / 65536), [F.col("rec_id")], name="r")
    return p.select("rec_id", ((F.col("r") - 1) % 12).alias("shard"), F.floor((F.col("r") - 1) / 20).alias("batch"))


@query("""WITH f AS (SELECT coalesce(category, '-') AS category, regexp_replace(task_id, 'v[0-9]+$', '') AS fam, count(*) AS n FROM programs WHERE task_id IS NOT NULL GROUP BY 1, 2), c AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY category ORDER BY n DESC, fam ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM f)
SELECT category, fam, n FROM c WHERE before < 30""")
def cumulative_goal(spark, d):
    p = table(spark, d, "programs").where("task_id is not null")
    f = p.groupBy(F.coalesce("category", F.lit("-")).alias("category"), X.family(F.col("task_id")).alias("fam")).agg(F.count("*").alias("n"))
    return R.until_goal(f, ["category"], [F.desc("n"), F.col("fam")], "n", F.lit(30))


@query(f"""WITH o AS (SELECT task_id, wave, prev_sha256, lag(new_sha256) OVER w AS before, row_number() OVER w AS r FROM {_DEDUP} WHERE new_sha256 IS NOT NULL WINDOW w AS (PARTITION BY task_id ORDER BY wave, ts, status, new_sha256, coalesce(prev_sha256, '')))
SELECT task_id, count(*) AS n_steps, count(*) FILTER (r > 1 AND prev_sha256 IS DISTINCT FROM before) AS n_breaks FROM o GROUP BY 1""")
def chain_check(spark, d):
    """Breaks in each task's chain of hashes."""
    w = Window.partitionBy("task_id").orderBy("wave", "ts", "status", "new_sha256", F.coalesce("prev_sha256", F.lit("")))
    l = _ledger(spark, d).where("new_sha256 is not null").withColumn("before", F.lag("new_sha256").over(w)).withColumn("r", F.row_number().over(w))
    return l.groupBy("task_id").agg(F.count("*").alias("n_steps"), F.count_if((F.col("r") > 1) & ~F.col("prev_sha256").eqNullSafe(F.col("before"))).alias("n_breaks"))


@query("""WITH t AS (SELECT DISTINCT trial_id, provider_name, compiled, run_at FROM trial_results WHERE provider_name IS NOT NULL AND run_at IS NOT NULL), w AS (SELECT trial_id, provider_name, CASE WHEN row_number() OVER v >= 100 THEN round(avg(CASE WHEN compiled THEN 0.0 ELSE 1.0 END) OVER (PARTITION BY provider_name ORDER BY run_at, trial_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), 6) END AS rate FROM t WINDOW v AS (PARTITION BY provider_name ORDER BY run_at, trial_id))
SELECT trial_id, provider_name, rate FROM w""")
def rolling_failure(spark, d):
    t = table(spark, d, "trial_results").where("provider_name is not null and run_at is not null").select("trial_id", "provider_name", "compiled", "run_at").distinct()
    r = R.rolling_rate(t, ["provider_name"], [F.col("run_at"), F.col("trial_id")], ~F.col("compiled"), 100)
    return r.select("trial_id", "provider_name", F.round("rate", 6).alias("rate"))


@query("SELECT rec_id FROM (SELECT rec_id, row_number() OVER (ORDER BY judge.score, rec_id) AS r, count(*) OVER () AS n FROM programs WHERE judge.score IS NOT NULL) WHERE r <= greatest(1, n // 10)")
def bottom_decile(spark, d):
    p = table(spark, d, "programs").where("judge.score is not null").select("rec_id", F.col("judge.score").alias("s"))
    n = p.agg(F.count("*").alias("n"))
    r = R.bucket_rank(p, F.floor(F.col("s") * 1000), [F.col("s"), F.col("rec_id")])
    return r.join(F.broadcast(n)).where(F.col("rank") <= F.greatest(F.lit(1), F.floor(F.col("n") / 10))).select("rec_id")


@query("SELECT rec_id, phase FROM (SELECT rec_id, phase, row_number() OVER (PARTITION BY phase ORDER BY created_at NULLS LAST, rec_id) AS r FROM programs) WHERE r <= CASE phase WHEN 'A' THEN 300 WHEN 'B' THEN 100 WHEN 'C' THEN 60 WHEN 'D' THEN 40 ELSE 10 END")
def quota_fill(spark, d):
    """First rows of each phase by time up to its quota; ranks by day, so a phase of any size spreads."""
    p = table(spark, d, "programs").select("rec_id", "phase", "created_at")
    day = F.coalesce(F.date_format("created_at", "yyyyMMdd"), F.lit("~"))
    r = R.bucket_rank(p, day, [F.asc_nulls_last("created_at"), F.col("rec_id")], ["phase"])
    quota = F.when(F.col("phase") == "A", 300).when(F.col("phase") == "B", 100).when(F.col("phase") == "C", 60).when(F.col("phase") == "D", 40).otherwise(10)
    return r.where(F.col("rank") <= quota).select("rec_id", "phase")


@query("""WITH o AS (SELECT category, rec_id, row_number() OVER w AS r, avg(CASE WHEN judge.accepted THEN 0.0 ELSE 1.0 END) OVER w AS rate FROM programs WHERE category IS NOT NULL WINDOW w AS (PARTITION BY category ORDER BY rec_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), h AS (SELECT category, min(r) AS at FROM o WHERE r % 50 = 0 AND rate >= 0.2 GROUP BY 1)
SELECT category, h.at AS held_at FROM (SELECT DISTINCT category FROM programs WHERE category IS NOT NULL) LEFT JOIN h USING (category)""")
def category_hold(spark, d):
    """Number of rows after which a category is held: a fifth rejected at a multiple of 50."""
    p = table(spark, d, "programs").where("category is not null").select("category", "rec_id", F.when(F.col("judge.accepted"), 0).otherwise(1).alias("bad"))
    o = R.range_rank(p, ["category"], [F.col("rec_id")], "r", running={"before": "bad"})
    rate = (F.col("before") + F.col("bad")) / F.col("r")
    return o.groupBy("category").agg(F.min(F.when((F.col("r") % 50 == 0) & (rate >= 0.2), F.col("r"))).cast("long").alias("held_at"))


@query(f"""WITH o AS (SELECT task_id, status, row_number() OVER (PARTITION BY task_id ORDER BY wave, ts, status, coalesce(new_sha256, ''), coalesce(prev_sha256, '')) AS r FROM {_DEDUP}), f AS (SELECT task_id, min(r) FILTER (status = 'failed') AS sticky, max_by(status, r) AS last, count(*) AS n FROM o GROUP BY 1)
SELECT task_id, CASE WHEN sticky IS NOT NULL THEN 'failed' ELSE last END AS state, n AS n_patches FROM f""")
def patch_fold(spark, d):
    """State of each task after all ledger rows in order; failed is sticky."""
    order = F.struct("wave", "ts", "status", F.coalesce("new_sha256", F.lit("")).alias("n"), F.coalesce("prev_sha256", F.lit("")).alias("p"))
    g = _ledger(spark, d).groupBy("task_id").agg(F.max(F.col("status") == "failed").alias("f"), F.max_by("status", order).alias("last"), F.count("*").alias("n_patches"))
    return g.select("task_id", F.when(F.col("f"), "failed").otherwise(F.col("last")).alias("state"), "n_patches")


@query("SELECT h, n FROM (SELECT sha256(tk_source) AS h, count(*) AS n FROM programs WHERE tk_source IS NOT NULL GROUP BY 1) ORDER BY n DESC, h LIMIT 20")
def top_groups(spark, d):
    return table(spark, d, "programs").where("tk_source is not null").groupBy(F.sha2("tk_source", 256).alias("h")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "h").limit(20)


_CX = """(SELECT rec_id, (length(tk_source) - length(replace(tk_source, 'F=', ''))) // 2 AS f, (length(tk_source) - length(replace(tk_source, 'lp(', ''))) // 3 AS l, (length(tk_source) - length(replace(tk_source, 'if(', ''))) // 3 AS c, (length(tk_source) - length(replace(tk_source, 'let ', ''))) // 4 AS b, (length(tk_source) - length(replace(tk_source, 'I=', ''))) // 2 AS i, (length(tk_source) - length(replace(tk_source, 'T=', ''))) // 2 AS t, coalesce(tk_tokens, 0) AS n FROM programs WHERE tk_source IS NOT NULL)"""


def counts(df):
    s = F.col("tk_source")
    return df.where("tk_source is not null").select("rec_id", *(X.count_of(s, p).alias(k) for k, p in (("f", "F="), ("l", "lp("), ("c", "if("), ("b", "let "), ("i", "I="), ("t", "T="))), F.coalesce("tk_tokens", F.lit(0)).alias("n"))


@query(f"SELECT rec_id, round(10 * f + 5 * l + 5 * c + 0.1 * n + 8 * i + 3 * b, 4)::DOUBLE AS weight FROM {_CX} ORDER BY weight DESC, rec_id LIMIT 20")
def top_complex(spark, d):
    w = F.round(10 * F.col("f") + 5 * F.col("l") + 5 * F.col("c") + 0.1 * F.col("n") + 8 * F.col("i") + 3 * F.col("b"), 4)
    return counts(table(spark, d, "programs")).select("rec_id", w.alias("weight")).orderBy(F.desc("weight"), "rec_id").limit(20)


@query(f"SELECT rec_id, CASE WHEN f >= 4 OR (i >= 1 AND f >= 3) OR n > 300 THEN 'application' WHEN f BETWEEN 2 AND 3 OR n > 150 THEN 'complex' WHEN l + c > 2 OR n BETWEEN 50 AND 150 THEN 'medium' ELSE 'simple' END AS tier FROM {_CX}")
def complexity_tier(spark, d):
    f, i, n = F.col("f"), F.col("i"), F.col("n")
    tier = F.when((f >= 4) | ((i >= 1) & (f >= 3)) | (n > 300), "application").when(f.between(2, 3) | (n > 150), "complex").when((F.col("l") + F.col("c") > 2) | n.between(50, 150), "medium").otherwise("simple")
    return counts(table(spark, d, "programs")).select("rec_id", tier.alias("tier"))


@query("SELECT rec_id FROM (SELECT rec_id, sha256('5:' || rec_id) AS h FROM programs) ORDER BY h, rec_id LIMIT 100 OFFSET 50")
def seeded_shuffle(spark, d):
    return table(spark, d, "programs").select("rec_id", R.seeded(F.col("rec_id"), 5).alias("h")).orderBy("h", "rec_id").offset(50).limit(100).select("rec_id")


@query("""WITH s AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS n FROM events), g AS (SELECT user_id, ts, sum(n) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM s)
SELECT user_id, count(DISTINCT s) AS n_sessions FROM g GROUP BY 1""")
def event_sessions(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gap = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lag("ts").over(w).cast("timestamp"))
    e = table(spark, d, "events").select("user_id", F.when(gap <= 1800 * 1_000_000, 0).otherwise(1).alias("n"))
    return e.groupBy("user_id").agg(F.sum("n").alias("n_sessions"))
