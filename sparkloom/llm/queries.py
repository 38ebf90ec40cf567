"""Queries of the training-data operators, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, canon, components, nearjoin, overlap, packing, sentences, spans
from .arrays import stored, table


def _programs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "programs")


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return _programs(spark, d).select(F.col("rec_id").alias("id"), F.col("tk_source").alias("text"))


def p1_found(spark, d):
    return overlap.found(_programs(spark, d))


def p1_overlaps(spark, d):
    """One row per evaluation record with its class and numbers of links."""
    return overlap.links(_programs(spark, d))


def p1_pairs(spark, d):
    """Pairs of classes with their containment; p1_classes holds the members."""
    return overlap.classes(_programs(spark, d))[1]


def p1_classes(spark, d):
    return overlap.classes(_programs(spark, d))[0]


def p1_report(spark, d):
    return overlap.report(_programs(spark, d))


def p2_found(spark, d):
    return components.program_groups(_programs(spark, d))


def p2_splits(spark, d):
    return components.splits(_programs(spark, d))


def p3_found(spark, d):
    return spans.shared_spans(spans.sources(_programs(spark, d), table(spark, d, "negative_examples")))


def p3_share(spark, d):
    return spans.shared_share(spans.sources(_programs(spark, d), table(spark, d, "negative_examples")))


def p4_found(spark, d):
    return canon.copies(canon.sources(_programs(spark, d), table(spark, d, "parallel_corpus")))


def p4_collapsed(spark, d):
    return canon.collapsed(canon.sources(_programs(spark, d), table(spark, d, "parallel_corpus")))


def p5_found(spark, d):
    return nearjoin.near_pairs(_texts(spark, d))


def p5_groups(spark, d):
    """One row per program with enough tokens: class of equal sets, links to other texts, group of linked programs."""
    who, pairs = nearjoin.near_classes(_texts(spark, d).select("id", "text", F.lit(3).alias("side")))
    pairs = stored(pairs.select("a", "b"))
    labels, _ = components.spanning_forest(pairs.select(F.col("a").alias("u"), F.col("b").alias("v")))
    size = who.groupBy("cls").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    ends = pairs.select(F.col("a").alias("cls"), F.col("b").alias("o")).unionByName(pairs.select(F.col("b").alias("cls"), F.col("a").alias("o")))
    links = ends.join(size.select(F.col("cls").alias("o"), F.col("n").alias("m")), "o").groupBy("cls").agg(F.sum("m").alias("others"))
    root = labels.withColumnRenamed("node", "cls")
    per = size.join(links, "cls", "left").join(root, "cls", "left").select("cls", "n", "first", F.coalesce("others", F.lit(0)).alias("others"), F.coalesce("root", "cls").alias("root"))
    group = per.groupBy("root").agg(F.min("first").alias("group_id"))
    per = per.join(group, "root")
    return who.select("id", "cls").join(per, "cls").select(F.col("id").alias("rec_id"), F.col("first").alias("class_id"), (F.col("n") - 1 + F.col("others")).alias("n_links"), "group_id")


def p6_ids(spark, d):
    return bpe.encoded(table(spark, d, "documents"))


def p7_containers(spark, d):
    return packing.packed_tables(spark, d)


def p7_fill(spark, d):
    return packing.fill(packing.packed_tables(spark, d), table(spark, d, "pack_configs"), table(spark, d, "documents"))


def p8_found(spark, d):
    return sentences.sentences(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p1_overlaps, p1_pairs, p1_classes, p1_report, p2_found, p2_splits, p3_found, p3_share, p4_found, p4_collapsed, p5_found, p5_groups, p6_ids, p7_containers, p7_fill, p8_found)}

# Extraction of task names for the SQL forms below.
_NAMES = r"""
named AS (SELECT rec_id, split, regexp_extract_all(translate(coalesce(task_id, ''), '‐‑‒–—―−﹘﹣－_', '-----------'), '(?i)(?:^|[^a-z0-9])([a-d][\s-]+[a-z]{3}[\s-]+0*[0-9]+)', 1) AS x FROM programs),
tasks AS (SELECT DISTINCT rec_id, upper(regexp_extract(t, '^([A-Da-d])', 1)) || '-' || upper(regexp_extract(t, '^[A-Da-d][\s-]+([A-Za-z]{3})', 1)) || '-' || lpad(CAST(CAST(regexp_extract(t, '([0-9]+)$', 1) AS BIGINT) AS VARCHAR), CAST(greatest(4, length(CAST(CAST(regexp_extract(t, '([0-9]+)$', 1) AS BIGINT) AS VARCHAR))) AS INTEGER), '0') AS name FROM (SELECT rec_id, unnest(x) AS t FROM named))
"""

ORACLE = {
    "p2_found": f"""
WITH RECURSIVE {_NAMES},
edges AS (SELECT DISTINCT a.name AS u, b.name AS v FROM tasks a JOIN tasks b USING (rec_id)),
reach(u, v) AS (SELECT u, v FROM edges UNION SELECT r.u, e.v FROM reach r JOIN edges e ON r.v = e.u)
SELECT t.rec_id, min(r.v) AS group_name FROM tasks t JOIN reach r ON t.name = r.u GROUP BY t.rec_id
""",
    "p5_found": r"""
WITH toks AS (SELECT rec_id, regexp_extract_all(lower(tk_source), '[a-z0-9_]+|[=+*/%<>!&|(){}.:\-\[\]]') AS t FROM programs WHERE tk_source IS NOT NULL),
runs AS (SELECT DISTINCT rec_id, t[i] || ' ' || t[i + 1] || ' ' || t[i + 2] AS g FROM (SELECT rec_id, t, unnest(range(1, len(t) - 1)) AS i FROM toks WHERE len(t) >= 20)),
n AS (SELECT rec_id, count(*) AS n FROM runs GROUP BY 1),
ranked AS (SELECT rec_id, g, row_number() OVER (PARTITION BY rec_id ORDER BY c, g) AS r, count(*) OVER (PARTITION BY rec_id) AS n FROM runs JOIN (SELECT g, count(*) AS c FROM runs GROUP BY 1) USING (g)),
pre AS (SELECT rec_id, g FROM ranked WHERE r <= n - ceil(0.7 * n - 1e-9) + 1),
cand AS (SELECT DISTINCT a.rec_id AS lo, b.rec_id AS hi FROM pre a JOIN pre b USING (g) WHERE a.rec_id < b.rec_id),
both_ AS (SELECT lo, hi, count(*) AS c FROM cand JOIN runs a ON a.rec_id = lo JOIN runs b ON b.rec_id = hi AND a.g = b.g GROUP BY 1, 2)
SELECT lo AS lo_id, hi AS hi_id FROM both_ JOIN n x ON x.rec_id = lo JOIN n y ON y.rec_id = hi WHERE c >= 0.7 * (x.n + y.n - c) - 1e-9
""",
}

_SINGLE = r"""
one AS (SELECT rec_id, split, upper(regexp_replace(min(x), '[\s-]+', '-', 'g')) AS x, count(DISTINCT upper(regexp_replace(x, '[\s-]+', '-', 'g'))) AS n FROM (SELECT rec_id, split, unnest(regexp_extract_all(translate(coalesce(task_id, ''), '‐‑‒–—―−﹘﹣－_', '-----------'), '(?i)(?:^|[^a-z0-9])([a-d][\s-]+[a-z]{3}[\s-]+0*[0-9]+(?:\s*v0*[0-9]+)?)', 1)) AS x FROM programs) GROUP BY 1, 2),
keyed AS (SELECT rec_id, split, regexp_extract(x, '^([A-D]-[A-Z]{3})', 1) AS area, CAST(regexp_extract(x, '^[A-D]-[A-Z]{3}-0*([0-9]+)', 1) AS BIGINT) AS number, regexp_extract(x, 'V0*([0-9]+)$', 1) AS version FROM one WHERE n = 1)
"""
ORACLE["p1_found"] = f"""
WITH near AS ({ORACLE["p5_found"]}), {_SINGLE.strip()},
task AS (SELECT least(a.rec_id, b.rec_id) AS lo_id, greatest(a.rec_id, b.rec_id) AS hi_id FROM keyed a JOIN keyed b USING (area, number, version) WHERE version <> '' AND a.split = 'train' AND b.split IN ('validation', 'test'))
SELECT lo_id, hi_id FROM near JOIN programs a ON a.rec_id = lo_id JOIN programs b ON b.rec_id = hi_id WHERE (a.split = 'train' AND b.split IN ('validation', 'test')) OR (b.split = 'train' AND a.split IN ('validation', 'test'))
UNION SELECT lo_id, hi_id FROM task
"""

_SPANS = """WITH r AS (SELECT rec_id, tk_source AS t FROM programs UNION ALL SELECT rec_id, fixed_source FROM negative_examples),
w AS (SELECT rec_id, i, substr(t, i, 100) AS g FROM (SELECT rec_id, t, unnest(range(1, length(t) - 98)) AS i FROM r WHERE length(t) >= 100)),
s AS (SELECT g FROM w GROUP BY g HAVING count(DISTINCT rec_id) > 1), p AS (SELECT rec_id, i, i - lag(i) OVER (PARTITION BY rec_id ORDER BY i) AS gap FROM w JOIN s USING (g)),
k AS (SELECT rec_id, i, sum(CASE WHEN gap <= 100 THEN 0 ELSE 1 END) OVER (PARTITION BY rec_id ORDER BY i) AS run FROM p), found AS (SELECT rec_id, min(i) - 1 AS start_pos, max(i) + 99 AS end_pos FROM k GROUP BY rec_id, run)"""
ORACLE["p3_found"] = _SPANS + " SELECT rec_id, start_pos, end_pos FROM found"
ORACLE["p3_share"] = (
    _SPANS
    + """, f AS (SELECT rec_id, count(*) AS n_spans, sum(end_pos - start_pos)::BIGINT AS shared_chars FROM found GROUP BY 1)
SELECT r.rec_id, coalesce(n_spans, 0) AS n_spans, coalesce(shared_chars, 0) AS shared_chars, length(t) AS n_chars, CASE WHEN length(t) > 0 THEN round(coalesce(shared_chars, 0) / length(t), 6) ELSE 0.0 END AS share FROM r LEFT JOIN f ON f.rec_id = r.rec_id WHERE t IS NOT NULL"""
)

_SETS = r"""toks AS (SELECT rec_id, split, regexp_extract_all(lower(tk_source), '[a-z0-9_]+|[=+*/%<>!&|(){}.:\-\[\]]') AS t FROM programs WHERE tk_source IS NOT NULL),
runs AS (SELECT DISTINCT rec_id, t[i] || ' ' || t[i + 1] || ' ' || t[i + 2] AS g FROM (SELECT rec_id, t, unnest(range(1, len(t) - 1)) AS i FROM toks WHERE len(t) >= 20)),
sets AS (SELECT rec_id, md5(string_agg(g, '|' ORDER BY g)) AS c, count(*) AS n FROM runs GROUP BY 1)"""
ORACLE["p5_groups"] = f"""WITH RECURSIVE {_SETS}, near AS ({ORACLE["p5_found"]}), e AS (SELECT lo_id AS a, hi_id AS b FROM near UNION ALL SELECT hi_id, lo_id FROM near),
reach(a, b) AS (SELECT rec_id, rec_id FROM sets UNION SELECT r.a, e.b FROM reach r JOIN e ON e.a = r.b), g AS (SELECT a AS rec_id, min(b) AS group_id FROM reach GROUP BY 1), l AS (SELECT a AS rec_id, count(*) AS n FROM e GROUP BY 1)
SELECT rec_id, min(rec_id) OVER (PARTITION BY c) AS class_id, coalesce(l.n, 0) AS n_links, group_id FROM sets JOIN g USING (rec_id) LEFT JOIN l USING (rec_id)"""

_CLASSES = f"""{_SETS}, side AS (SELECT rec_id, CASE WHEN split = 'train' THEN 'train' WHEN split IN ('validation', 'test') THEN 'evaluation' END AS side FROM programs),
members AS (SELECT rec_id, side, min(rec_id) OVER (PARTITION BY c) AS class_id, n AS n_runs FROM (SELECT rec_id, side, c, n FROM sets JOIN side USING (rec_id) WHERE side IS NOT NULL
 UNION ALL SELECT rec_id, side, 'short ' || array_to_string(t, ' '), 0 FROM toks JOIN side USING (rec_id) WHERE side IS NOT NULL AND len(t) BETWEEN 1 AND 19)),
ranked AS (SELECT rec_id, g, row_number() OVER (PARTITION BY rec_id ORDER BY c, g) AS r, count(*) OVER (PARTITION BY rec_id) AS n FROM runs JOIN (SELECT g, count(*) AS c FROM runs GROUP BY 1) USING (g)),
ev AS (SELECT DISTINCT class_id, any_value(rec_id) AS rec_id FROM members WHERE side = 'evaluation' AND n_runs > 0 GROUP BY 1), tr AS (SELECT class_id, any_value(rec_id) AS rec_id FROM members WHERE side = 'train' AND n_runs > 0 GROUP BY 1),
cand AS (SELECT DISTINCT ev.class_id AS ec, ev.rec_id AS e, tr.class_id AS tc, tr.rec_id AS t FROM ranked a JOIN ev USING (rec_id) JOIN runs b USING (g) JOIN tr ON tr.rec_id = b.rec_id WHERE a.r <= a.n - ceil(0.7 * a.n - 1e-9) + 1 AND ev.class_id <> tr.class_id),
pairs AS (SELECT ec AS eval_class, tc AS train_class, shared, round(shared / x.n, 6) AS containment, round(shared / (x.n + y.n - shared), 6) AS similarity FROM (SELECT ec, tc, e, t, count(*) AS shared FROM cand JOIN runs a ON a.rec_id = e JOIN runs b ON b.rec_id = t AND a.g = b.g GROUP BY ALL) JOIN sets x ON x.rec_id = e JOIN sets y ON y.rec_id = t WHERE shared >= 0.7 * x.n - 1e-9)"""
ORACLE["p1_classes"] = f"WITH {_CLASSES} SELECT rec_id, side, class_id, n_runs FROM members"
ORACLE["p1_pairs"] = f"WITH {_CLASSES} SELECT eval_class, train_class, shared, containment, similarity FROM pairs"
_LINKS = f"""WITH {_CLASSES}, {_SINGLE.strip()}, tn AS (SELECT class_id, count(*) AS n FROM members WHERE side = 'train' GROUP BY 1), per AS (SELECT eval_class AS class_id, sum(n)::BIGINT AS n, max(containment) AS best FROM pairs JOIN tn ON tn.class_id = train_class GROUP BY 1),
tasks AS (SELECT area, number, version, count(*) AS n FROM keyed WHERE version <> '' AND split = 'train' GROUP BY 1, 2, 3), et AS (SELECT k.rec_id, tasks.n FROM keyed k JOIN tasks USING (area, number, version)),
links AS (SELECT p.rec_id, p.split, p.source_name, m.class_id, coalesce(tn.n, 0) AS n_equal, coalesce(per.n, 0) AS n_containing, coalesce(et.n, 0) AS n_task, CASE WHEN tn.n > 0 THEN 1.0 ELSE per.best END::DOUBLE AS containment FROM programs p LEFT JOIN members m ON m.rec_id = p.rec_id LEFT JOIN tn ON tn.class_id = m.class_id LEFT JOIN per ON per.class_id = m.class_id LEFT JOIN et ON et.rec_id = p.rec_id WHERE p.split IN ('validation', 'test'))"""
ORACLE["p1_overlaps"] = _LINKS + " SELECT * FROM links"
ORACLE["p1_report"] = (
    _LINKS
    + " SELECT split, source_name, count(*) AS records, count(*) FILTER (n_equal + n_containing > 0 OR n_task > 0) AS overlapping, count(*) FILTER (n_equal + n_containing > 0) AS by_text, count(*) FILTER (n_task > 0) AS by_task, sum(n_equal + n_containing)::BIGINT AS text_links, sum(n_task)::BIGINT AS task_links, round(avg(containment), 6) AS mean_containment FROM links GROUP BY 1, 2"
)
