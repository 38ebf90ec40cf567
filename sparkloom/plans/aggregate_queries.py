"""Aggregations over the test tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import aggregates as A
from ..operators import dedup as D
from .registry import query, table


@query("""SELECT phase, model, count(*) AS n_rows, count(DISTINCT task_id) AS n_tasks, sum(tk_tokens)::BIGINT AS tokens FROM programs GROUP BY 1, 2""")
def group_counts(spark, d):
    return table(spark, d, "programs").groupBy("phase", "model").agg(F.count("*").alias("n_rows"), F.countDistinct("task_id").alias("n_tasks"), F.sum("tk_tokens").alias("tokens"))


@query("""SELECT provider_name, count(*) AS n_rows, round(avg(CASE WHEN compiled THEN 1.0 ELSE 0.0 END), 6) AS first_rate, count(*) FILTER (NOT compiled AND correction_compiled) AS corrected, round(sum(cost), 6) AS cost FROM (SELECT DISTINCT * FROM trial_results) GROUP BY 1""")
def group_pass_rates(spark, d):
    t = table(spark, d, "trial_results").dropDuplicates()
    return t.groupBy("provider_name").agg(
        F.count("*").alias("n_rows"), F.round(F.avg(F.when(F.col("compiled"), 1.0).otherwise(0.0)), 6).alias("first_rate"),
        F.count_if(~F.col("compiled") & F.col("correction_compiled")).alias("corrected"), F.round(F.sum("cost"), 6).alias("cost"),
    )


@query("""SELECT category, count(judge.score) AS n, sum(CAST(judge.score AS DECIMAL(12, 6)))::DOUBLE / count(judge.score) AS mean, round(stddev_pop(judge.score), 6) AS sd, min(judge.score) AS low, max(judge.score) AS high, count(DISTINCT model) AS n_models FROM programs GROUP BY 1""")
def diversity_stats(spark, d):
    s = F.col("judge.score")
    return table(spark, d, "programs").groupBy("category").agg(F.count(s).alias("n"), (F.sum(s.cast("decimal(12,6)")).cast("double") / F.count(s)).alias("mean"), F.round(F.stddev_pop(s), 6).alias("sd"), F.min(s).alias("low"), F.max(s).alias("high"), F.countDistinct("model").alias("n_models"))


@query("""WITH s AS (SELECT phase, list_sort(list(tk_tokens)) AS l FROM programs WHERE tk_tokens IS NOT NULL GROUP BY 1)
SELECT phase, l[least(len(l) - 1, len(l) * 50 // 100) + 1] AS p50, l[least(len(l) - 1, len(l) * 90 // 100) + 1] AS p90, l[least(len(l) - 1, len(l) * 99 // 100) + 1] AS p99 FROM s""")
def nearest_rank_percentiles(spark, d):
    return A.nearest_rank(table(spark, d, "programs").select("phase", "tk_tokens"), ["phase"], "tk_tokens", [50, 90, 99])


@query("""SELECT provider_name, round(quantile_cont(latency_ms, 0.5), 6) AS p50, round(quantile_cont(latency_ms, 0.95), 6) AS p95 FROM trial_results GROUP BY 1""")
def interpolated_percentiles(spark, d):
    p = A.interpolated(table(spark, d, "trial_results"), ["provider_name"], "latency_ms", {"p50": 0.5, "p95": 0.95})
    return p.select("provider_name", F.round("p50", 6).alias("p50"), F.round("p95", 6).alias("p95"))


@query("SELECT lang, median(n_chars)::DOUBLE AS median_chars, count(*) AS n_rows FROM documents GROUP BY 1")
def median_by_key(spark, d):
    return table(spark, d, "documents").groupBy("lang").agg(F.median("n_chars").alias("median_chars"), F.count("*").alias("n_rows"))


@query("SELECT least(floor(judge.score / 0.1), 9)::BIGINT AS bin, count(*) AS n_rows FROM programs WHERE judge.score IS NOT NULL GROUP BY 1")
def score_histogram(spark, d):
    return table(spark, d, "programs").where("judge.score is not null").groupBy(A.histogram(F.col("judge.score"), 0.1, 9).alias("bin")).agg(F.count("*").alias("n_rows"))


@query("SELECT count(*) AS n_groups, sum(c - 1)::BIGINT AS surplus FROM (SELECT count(*) AS c FROM programs WHERE tk_source IS NOT NULL GROUP BY sha256(tk_source) HAVING count(*) > 1)")
def duplicate_surplus(spark, d):
    g = table(spark, d, "programs").where("tk_source is not null").groupBy(F.sha2("tk_source", 256)).agg(F.count("*").alias("c")).where("c > 1")
    return g.agg(F.count("*").alias("n_groups"), F.sum(F.col("c") - 1).alias("surplus"))


@query("SELECT grouping(phase) AS all_phases, grouping(category) AS all_categories, phase, category, count(*) AS n_rows, sum(tk_tokens)::BIGINT AS tokens FROM programs GROUP BY GROUPING SETS ((), (phase), (category))")
def grouping_sets_report(spark, d):
    p = table(spark, d, "programs").select("phase", "category", "tk_tokens")
    p.createOrReplaceTempView("_grouping_sets")
    return spark.sql("SELECT CAST(grouping(phase) AS BIGINT) AS all_phases, CAST(grouping(category) AS BIGINT) AS all_categories, phase, category, count(*) AS n_rows, sum(tk_tokens) AS tokens FROM _grouping_sets GROUP BY GROUPING SETS ((), (phase), (category))")


@query("SELECT source, doc_kind, count(*) AS n_rows, count(text) AS n_texts FROM documents GROUP BY ROLLUP (source, doc_kind)")
def rollup_scopes(spark, d):
    return table(spark, d, "documents").rollup("source", "doc_kind").agg(F.count("*").alias("n_rows"), F.count("text").alias("n_texts"))


@query("""SELECT category, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'validation') AS validation, count(*) FILTER (split = 'test') AS test, round(100.0 * count(*) FILTER (split = 'train') / count(*), 4) AS train_percent FROM programs GROUP BY 1""")
def split_crosstab(spark, d):
    p = table(spark, d, "programs")
    n = {s: F.count_if(F.col("split") == s) for s in ("train", "validation", "test")}
    return p.groupBy("category").agg(*(c.alias(s) for s, c in n.items()), F.round(100.0 * n["train"] / F.count("*"), 4).alias("train_percent"))


@query("SELECT x.code AS code, count(*) AS hits, count(DISTINCT rec_id) AS records, sum(x.source_length)::BIGINT AS chars FROM (SELECT rec_id, unnest(diagnostics) AS x FROM negative_examples) GROUP BY 1")
def hits_and_records(spark, d):
    n = table(spark, d, "negative_examples").select("rec_id", F.explode("diagnostics").alias("x"))
    return n.groupBy(F.col("x.code").alias("code")).agg(F.count("*").alias("hits"), F.countDistinct("rec_id").alias("records"), F.sum("x.source_length").alias("chars"))


@query("""WITH n AS (SELECT CASE WHEN tk_tokens > 300 THEN 'application' WHEN tk_tokens > 150 THEN 'complex' WHEN tk_tokens >= 50 THEN 'medium' ELSE 'simple' END AS tier, count(*) AS n FROM programs WHERE tk_tokens IS NOT NULL GROUP BY 1)
SELECT tier, n AS n_rows, round(n / (SELECT sum(n) FROM n), 6) AS share, round(n / (SELECT sum(n) FROM n) - t.mid, 6) AS gap FROM n JOIN (VALUES ('simple', 0.25), ('medium', 0.55), ('complex', 0.125), ('application', 0.075)) t(tier, mid) USING (tier)""")
def tier_gap(spark, d):
    t = F.col("tk_tokens")
    tier = F.when(t > 300, "application").when(t > 150, "complex").when(t >= 50, "medium").otherwise("simple")
    mid = F.coalesce(*(F.when(F.col("tier") == k, v) for k, v in (("simple", 0.25), ("medium", 0.55), ("complex", 0.125), ("application", 0.075))))
    n = table(spark, d, "programs").where("tk_tokens is not null").groupBy(tier.alias("tier")).agg(F.count("*").alias("n_rows"))
    share = F.col("n_rows") / F.sum("n_rows").over(Window.partitionBy(F.lit(0)))
    return n.select("tier", "n_rows", F.round(share, 6).alias("share"), F.round(share - mid, 6).alias("gap"))


@query("""WITH v AS (SELECT task_id, differential.majority_output AS o, count(*) AS n, string_agg(DISTINCT model, ',' ORDER BY model) AS voters FROM programs WHERE task_id IS NOT NULL AND differential.majority_output IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER w AS r, lead(n) OVER w AS nx, sum(n) OVER (PARTITION BY task_id) AS total FROM v WINDOW w AS (PARTITION BY task_id ORDER BY n DESC, o))
SELECT task_id, CASE WHEN total < 2 THEN 'few' WHEN n < 2 OR coalesce(nx = n, false) THEN 'tied' ELSE 'agreed' END AS verdict, CASE WHEN NOT (total < 2 OR n < 2 OR coalesce(nx = n, false)) THEN o END AS winner, CASE WHEN NOT (total < 2 OR n < 2 OR coalesce(nx = n, false)) THEN voters END AS voters, total::BIGINT AS total FROM r WHERE r = 1""")
def majority_vote(spark, d):
    p = table(spark, d, "programs").where("task_id is not null").select("task_id", F.col("differential.majority_output").alias("o"), "model")
    return A.majority(p, "task_id", "o", "model", 2)


@query("""SELECT task_id, len(list_reduce(l, lambda a, b: list_intersect(a, b))) AS n_common FROM (SELECT task_id, list(differential.languages_agreed) AS l FROM programs WHERE task_id IS NOT NULL AND differential.languages_agreed IS NOT NULL GROUP BY 1)""")
def languages_in_common(spark, d):
    """Number of languages that agree in every record of a task, by counts rather than collected arrays."""
    p = table(spark, d, "programs").where("task_id is not null and differential.languages_agreed is not null").select("task_id", "rec_id", F.array_distinct("differential.languages_agreed").alias("l"))
    n = p.groupBy("task_id").agg(F.count("*").alias("n"))
    held = p.select("task_id", F.explode("l").alias("x")).groupBy("task_id", "x").agg(F.count("*").alias("c")).join(n, "task_id").where("c = n").groupBy("task_id").agg(F.count("*").alias("k"))
    return n.join(held, "task_id", "left").select("task_id", F.coalesce("k", F.lit(0)).alias("n_common"))


_RATES = """WITH t AS (SELECT DISTINCT * FROM trial_results WHERE provider_name IS NOT NULL), r AS (SELECT provider_name, avg(CASE WHEN compiled THEN 1.0 ELSE 0.0 END) AS fp, coalesce(count(*) FILTER (NOT compiled AND correction_compiled) / nullif(count(*) FILTER (NOT compiled), 0), 0) AS co, count(*) FILTER (compiled OR correction_compiled) / nullif(sum(cost), 0) AS eff FROM t GROUP BY 1),
c AS (SELECT provider_name, fp, 0.4 * fp + 0.2 * co + 0.1 * coalesce(eff / max(eff) OVER (), 0) + 0.15 AS score FROM r)"""


def _scores(spark, d):
    t = table(spark, d, "trial_results").where("provider_name is not null").dropDuplicates()
    failed, ok = F.count_if(~F.col("compiled")), F.count_if(F.col("compiled") | F.col("correction_compiled"))
    r = t.groupBy("provider_name").agg(
        F.avg(F.when(F.col("compiled"), 1.0).otherwise(0.0)).alias("fp"),
        F.coalesce(F.count_if(~F.col("compiled") & F.col("correction_compiled")) / F.nullif(failed, F.lit(0)), F.lit(0.0)).alias("co"),
        (ok / F.nullif(F.sum("cost"), F.lit(0.0))).alias("eff"),
    )
    top = F.max("eff").over(Window.partitionBy(F.lit(0)))
    return r.select("provider_name", "fp", (0.4 * F.col("fp") + 0.2 * F.col("co") + 0.1 * F.coalesce(F.col("eff") / top, F.lit(0.0)) + 0.15).alias("score"))


@query(_RATES + " SELECT provider_name, round(fp, 6) AS first_rate, round(score, 6) AS score FROM c")
def composite_scores(spark, d):
    return _scores(spark, d).select("provider_name", F.round("fp", 6).alias("first_rate"), F.round("score", 6).alias("score"))


@query(_RATES + """, k AS (SELECT *, row_number() OVER (ORDER BY score DESC, provider_name) AS r, count(*) OVER () AS n FROM c), u AS (SELECT *, CASE WHEN r <= greatest(1, n // 2) THEN 1 ELSE 2 END AS tier FROM k)
SELECT provider_name, tier::BIGINT AS tier, round((CASE tier WHEN 1 THEN 0.6 ELSE 0.4 END) * score / sum(score) OVER (PARTITION BY tier), 6) AS share FROM u""")
def pool_allocation(spark, d):
    """Shares of the providers (a small table) in two tiers by score."""
    one = Window.partitionBy(F.lit(0))
    k = _scores(spark, d).withColumn("r", F.row_number().over(one.orderBy(F.desc("score"), "provider_name"))).withColumn("n", F.count("*").over(one))
    u = k.withColumn("tier", F.when(F.col("r") <= F.greatest(F.lit(1), F.floor(F.col("n") / 2)), 1).otherwise(2).cast("long"))
    return u.select("provider_name", "tier", F.round(F.when(F.col("tier") == 1, 0.6).otherwise(0.4) * F.col("score") / F.sum("score").over(Window.partitionBy("tier")), 6).alias("share"))


def _grams(side: str, n: int) -> str:
    return f"SELECT rec_id, difficulty, {n} AS k, '{side}' AS s, array_to_string(list_slice(w, i, i + {n - 1}), ' ') AS g FROM (SELECT rec_id, difficulty, w, unnest(range(1, len(w) - {n - 2})) AS i FROM {side})"


@query("WITH c AS (SELECT rec_id, difficulty, list_filter(regexp_split_to_array(broken_source, '\\s+'), lambda x: x <> '') AS w FROM negative_examples WHERE broken_source IS NOT NULL AND fixed_source IS NOT NULL), r AS (SELECT rec_id, difficulty, list_filter(regexp_split_to_array(fixed_source, '\\s+'), lambda x: x <> '') AS w FROM negative_examples WHERE broken_source IS NOT NULL AND fixed_source IS NOT NULL), g AS ("
       + " UNION ALL ".join(_grams(s, n) for n in range(1, 5) for s in "cr")
       + "), p AS (SELECT difficulty, rec_id, k, g, count(*) FILTER (s = 'c') AS c, count(*) FILTER (s = 'r') AS r FROM g GROUP BY 1, 2, 3, 4), h AS (SELECT difficulty, k, sum(least(c, r)) AS hit, sum(c) AS a FROM p GROUP BY 1, 2), m AS (SELECT difficulty, sum(CASE WHEN hit > 0 THEN ln(hit / a) END) AS logs, count(*) FILTER (hit > 0) AS o FROM h GROUP BY 1), z AS (SELECT c.difficulty, sum(len(c.w)) AS cl, sum(len(r.w)) AS rl FROM c JOIN r USING (rec_id) GROUP BY 1) SELECT z.difficulty, CASE WHEN o = 4 AND cl > 0 THEN round(100 * least(1.0, exp(1 - rl / cl)) * exp(logs / 4), 4) ELSE 0.0 END AS bleu FROM z LEFT JOIN m ON z.difficulty = m.difficulty WHERE z.difficulty IS NOT NULL")
def bleu_pairs(spark, d):
    return A.bleu(table(spark, d, "negative_examples").where("difficulty is not null"), ["difficulty"], "broken_source", "fixed_source")


_SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


@query(f"""WITH t AS (SELECT DISTINCT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '{_SPACE}'), lambda x: x <> '')) AS term FROM documents)
SELECT term, count(*) AS df, round(ln(((SELECT count(*) FROM documents WHERE text IS NOT NULL) + 1) / (count(*) + 1)) + 1, 6) AS idf FROM t GROUP BY 1""")
def inverse_frequency(spark, d):
    """Over every document with text, in any language; terms are split at white space in any form Unicode has."""
    t = table(spark, d, "documents").where("text is not null").select("doc_id", "text")
    n = t.agg(F.count("*").alias("n"))
    terms = t.select(F.explode(F.array_distinct(F.filter(F.split(F.lower("text"), _SPACE), lambda x: x != ""))).alias("term"))
    return terms.groupBy("term").agg(F.count("*").alias("df")).join(F.broadcast(n)).select("term", "df", F.round(F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1, 6).alias("idf"))


@query("""WITH RECURSIVE l(lv, i, h, n) AS (SELECT 0, row_number() OVER (ORDER BY rec_id) - 1, sha256(rec_id || ':' || sha256(tk_source)), count(*) OVER () FROM programs WHERE tk_source IS NOT NULL
UNION ALL SELECT lv + 1, i // 2, sha256(h || coalesce(x, h)), (n + 1) // 2 FROM (SELECT lv, i, h, n, lead(h) OVER (ORDER BY i) AS x FROM l) WHERE i % 2 = 0 AND n > 1)
SELECT (SELECT count(*) FROM programs WHERE tk_source IS NOT NULL) AS n_leaves, h AS root FROM l WHERE n = 1""")
def merkle_root(spark, d):
    p = table(spark, d, "programs").where("tk_source is not null").select("rec_id", F.sha2("tk_source", 256).alias("h"))
    return A.merkle_root(p, F.col("rec_id"), F.col("h"), lambda df: D.ranked_by_key(df.withColumn("k", F.col("k").cast("long")), "k"))


@query("SELECT split, count(*) AS n_ids, sha256(string_agg(id, chr(10) ORDER BY id)) AS ids_hash FROM programs GROUP BY 1")
def manifest_hash(spark, d):
    return A.id_hash(table(spark, d, "programs"), ["split"], "id")


@query("""WITH b AS (SELECT split, substr(sha256(id), 1, 3) AS b, count(*) AS n, sha256(string_agg(id, chr(10) ORDER BY id)) AS h FROM (SELECT DISTINCT split, id FROM programs WHERE id IS NOT NULL) GROUP BY 1, 2)
SELECT split, sum(n)::BIGINT AS n_ids, sha256(string_agg(h, chr(10) ORDER BY b)) AS ids_hash FROM b GROUP BY 1""")
def manifest_bucket_hash(spark, d):
    return A.bucket_hash(table(spark, d, "programs"), ["split"], "id")


@query("""SELECT category, count(*) AS before, count(DISTINCT sha256(tk_source)) AS after, round(1 - count(DISTINCT sha256(tk_source)) / count(*), 6) AS reduction FROM programs WHERE tk_source IS NOT NULL GROUP BY 1""")
def reduction_report(spark, d):
    p = table(spark, d, "programs").where("tk_source is not null").select("category", F.sha2("tk_source", 256).alias("h"))
    return p.groupBy("category").agg(F.count("*").alias("before"), F.countDistinct("h").alias("after")).withColumn("reduction", F.round(1 - F.col("after") / F.col("before"), 6))


@query(r"""SELECT ch, count(*) AS n FROM (SELECT unnest(string_split(regexp_replace(tk_source, '"(\\.|[^"\\])*"', '""', 'g'), '')) AS ch FROM programs) WHERE ch <> '' GROUP BY 1""")
def char_census(spark, d):
    """Characters outside string literals; each record's are counted before they are shuffled by Spark's partial aggregation."""
    p = table(spark, d, "programs").where("tk_source is not null")
    return p.select(F.explode(F.split(X.without_literals(F.col("tk_source")), "")).alias("ch")).where("ch <> ''").groupBy("ch").agg(F.count("*").alias("n"))


@query(r"""SELECT module, count(*) AS n_programs, count(DISTINCT category) AS n_categories FROM (SELECT category, unnest(list_distinct(regexp_extract_all(tk_source, '(?:^|[;\s])I=([A-Za-z_][A-Za-z0-9_]*):([A-Za-z0-9_.]+)', 2))) AS module FROM programs) GROUP BY 1""")
def import_histogram(spark, d):
    p = table(spark, d, "programs").where("tk_source is not null").select("category", F.explode(X.imports(F.col("tk_source"))).alias("module"))
    return p.groupBy("module").agg(F.count("*").alias("n_programs"), F.countDistinct("category").alias("n_categories"))


@query("""SELECT code, string_agg(rec_id::VARCHAR, ',' ORDER BY rec_id) AS first_ids FROM (SELECT code, rec_id, row_number() OVER (PARTITION BY code ORDER BY rec_id) AS r FROM (SELECT DISTINCT rec_id, unnest(validation.error_codes) AS code FROM programs)) WHERE r <= 8 GROUP BY 1""")
def first_ids(spark, d):
    """First eight ids of each error code: per partition first, then overall."""
    p = table(spark, d, "programs").select("rec_id", F.explode(F.array_distinct("validation.error_codes")).alias("code"))
    part = Window.partitionBy("code", "salt").orderBy("rec_id")
    few = p.withColumn("salt", F.pmod(F.col("rec_id"), F.lit(64))).withColumn("r", F.row_number().over(part)).where("r <= 8").drop("r", "salt")
    top = few.withColumn("r", F.row_number().over(Window.partitionBy("code").orderBy("rec_id"))).where("r <= 8")
    return top.groupBy("code").agg(F.array_join(F.transform(F.array_sort(F.collect_list("rec_id")), lambda x: x.cast("string")), ",").alias("first_ids"))


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 4) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS mean_discount, count(*) AS n_rows FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def pricing_summary(spark, d):
    l = table(spark, d, "lineitem").where("l_shipdate <= timestamp '1998-09-02'")
    return l.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 4).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("mean_discount"), F.count("*").alias("n_rows"))


@query("""SELECT CASE WHEN grouping(event_type) = 1 THEN 'all' ELSE event_type END AS event_type, count(*) AS n_rows, count(DISTINCT user_id) AS n_users, sum(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS sum_k FROM events GROUP BY ROLLUP (event_type)""")
def json_nested(spark, d):
    e = table(spark, d, "events").withColumn("k", F.from_json("props", "k bigint")["k"])
    return e.rollup("event_type").agg(F.grouping("event_type").alias("g"), F.count("*").alias("n_rows"), F.countDistinct("user_id").alias("n_users"), F.sum("k").alias("sum_k")).select(F.when(F.col("g") == 1, "all").otherwise(F.col("event_type")).alias("event_type"), "n_rows", "n_users", "sum_k")
