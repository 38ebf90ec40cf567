"""Streaming and generator queries over the test tables."""

from __future__ import annotations

import os
import re

from pyspark.sql import functions as F

from ..operators import generate as N
from ..storage import shared_dir
from ..streaming import streams as T
from .registry import query, table


def _folder(spark) -> str:
    return f"{shared_dir(spark)}/streams-{os.urandom(6).hex()}"


def _stream(spark, d, name):
    df = table(spark, d, name)
    return spark.readStream.schema(df.schema).option("pathGlobFilter", f"{name}.parquet" if os.path.isfile(f"{d}/{name}.parquet") else "*.parquet").parquet(d if os.path.isfile(f"{d}/{name}.parquet") else f"{d}/{name}.parquet")


@query("""SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def stream_windows(spark, d):
    """Hourly counts by a stream over the whole table, written batch by batch in complete mode, last state read back."""
    out = _folder(spark)
    s = T.windowed(_stream(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", ["event_type"], "30 days", "1 hour", value="value")
    q = s.writeStream.outputMode("complete").option("checkpointLocation", f"{out}/c").trigger(availableNow=True).foreachBatch(lambda b, n: b.write.mode("overwrite").parquet(f"{out}/r")).start()
    q.awaitTermination()
    r = spark.read.parquet(f"{out}/r")
    return r.select(F.col("window.start").alias("hour"), "event_type", "n", F.round("total", 4).alias("total"))


@query("SELECT DISTINCT trial_id FROM trial_results WHERE arrived_at IS NOT NULL")
def stream_first_rows(spark, d):
    """Each trial once though delivered twice."""
    out = _folder(spark)
    T.run_once(T.first_by_key(_stream(spark, d, "trial_results").select("trial_id", "arrived_at"), "trial_id", "arrived_at", "400 days").select("trial_id"), T.append_sink(f"{out}/r"), f"{out}/c")
    return spark.read.parquet(f"{out}/r").select("trial_id")


@query("""WITH t AS (SELECT provider_name, CASE WHEN compiled THEN 0.0 ELSE 1.0 END AS failed, row_number() OVER (PARTITION BY provider_name ORDER BY trial_id DESC, arrived_at DESC) AS r, count(*) OVER (PARTITION BY provider_name) AS seen FROM (SELECT DISTINCT trial_id, provider_name, compiled, arrived_at FROM trial_results WHERE provider_name IS NOT NULL AND arrived_at IS NOT NULL))
SELECT provider_name, max(seen) AS seen, CASE WHEN max(seen) >= 100 THEN round(avg(failed) FILTER (r <= 100), 6) END AS rate, coalesce(max(seen) >= 100 AND avg(failed) FILTER (r <= 100) > 0.5, false) AS over FROM t GROUP BY 1""")
def stream_failure_state(spark, d):
    """Rate of the last 100 outcomes of each provider, in the order of trial_id within a batch; one batch here, so that
    its order is known."""
    out = _folder(spark)
    t = _stream(spark, d, "trial_results").where("provider_name is not null and arrived_at is not null").select("trial_id", "provider_name", "arrived_at", (~F.col("compiled")).alias("failed"))
    t = T.first_by_key(t, "trial_id", "arrived_at", "400 days")
    T.run_once(T.rolling_failures(t, "provider_name", "failed", order="trial_id"), T.append_sink(f"{out}/r"), f"{out}/c", "update")
    r = spark.read.parquet(f"{out}/r")
    last = r.groupBy("provider_name").agg(F.max_by(F.struct("seen", "rate", "over"), "seen").alias("s"))
    return last.select("provider_name", "s.seen", F.round("s.rate", 6).alias("rate"), "s.over")


def _edit_sql(rules, table_, source, every=False) -> str:
    """The same edits in DuckDB: split at the matches, one replaced, put together."""
    one = " UNION ALL ".join(
        f"SELECT rec_id, '{e.kind}' AS kind, {source} AS s, regexp_extract_all({source}, '{e.pattern}', 0) AS hits, string_split_regex({source}, '{e.pattern}') AS parts, list_transform(regexp_extract_all({source}, '{e.pattern}', 0), lambda h: regexp_replace(h, '{e.pattern}', '{_RE2(e.replacement)}')) AS news FROM {table_} WHERE {source} IS NOT NULL"
        for e in rules
    )
    at = "unnest(range(0, len(hits)))" if every else "('0x' || substr(sha256(kind || ':' || s), 1, 8))::BIGINT % len(hits)"
    return f"""WITH e AS ({one}), p AS (SELECT rec_id, kind, s, hits, parts, news, {at} AS place FROM e WHERE len(hits) > 0),
j AS (SELECT rec_id, kind, place, s, array_to_string(list_transform(parts, lambda p, i: CASE WHEN i = 1 THEN p WHEN i - 2 = place THEN news[i - 1] || p ELSE hits[i - 1] || p END), '') AS edited FROM p)
SELECT rec_id, kind, place, sha256(edited) AS edited_hash FROM j WHERE edited <> s"""


def _RE2(replacement: str) -> str:
    return re.sub(r"\$(\d)", r"\\\1", replacement)


def _edits(df, source, rules, every=False):
    return N.edited(df, "rec_id", source, rules, every).select("rec_id", "kind", "place", F.sha2("edited", 256).alias("edited_hash"))


@query(_edit_sql(N.MUTATIONS, "programs", "tk_source"))
def mutations(spark, d):
    return _edits(table(spark, d, "programs"), "tk_source", N.MUTATIONS)


@query(_edit_sql(N.FAULTS, "negative_examples", "fixed_source", True))
def faults(spark, d):
    """Every single fault of each kind."""
    return _edits(table(spark, d, "negative_examples"), "fixed_source", N.FAULTS, True)


@query(_edit_sql(N.CONTRASTS, "programs", "tk_source"))
def contrasts(spark, d):
    return _edits(table(spark, d, "programs"), "tk_source", N.CONTRASTS)


@query(_edit_sql(N.REPAIRS, "programs", "tk_source"))
def repairs(spark, d):
    return _edits(table(spark, d, "programs"), "tk_source", N.REPAIRS)


@query(r"""WITH n AS (SELECT rec_id, tk_source AS s, list_sort(list_distinct(regexp_extract_all(tk_source, 'let ([A-Za-z_][A-Za-z0-9_]*)=', 1))) AS n FROM programs WHERE tk_source IS NOT NULL), k AS (SELECT rec_id, s, n[('0x' || substr(sha256('rename:' || s), 1, 8))::BIGINT % len(n) + 1] AS name FROM n WHERE len(n) > 0)
SELECT rec_id, name, sha256(regexp_replace(s, '\b' || name || '\b', name || 'X', 'g')) AS edited_hash FROM k""")
def renamed_bindings(spark, d):
    r = N.renamed(table(spark, d, "programs"), "rec_id", "tk_source")
    return r.select("rec_id", "name", F.sha2("edited", 256).alias("edited_hash"))


_TEMPLATES = [("arrays", "Add the first {a} numbers above {b}."), ("arrays", "Reverse {a} numbers."), ("text", "Repeat a word {b} times."), ("maps", "Count {a} keys, then {b} values.")]


@query(f"""WITH t AS (SELECT *, row_number() OVER (ORDER BY category, template) - 1 AS k FROM (VALUES {", ".join(f"('{c}', '{t}')" for c, t in _TEMPLATES)}) v(category, template)), i AS (SELECT range AS i FROM range(0, 500))
SELECT i, category, replace(replace(template, '{{a}}', (('0x' || substr(sha256('a' || i), 1, 6))::BIGINT % 100)::VARCHAR), '{{b}}', (('0x' || substr(sha256('b' || i), 1, 6))::BIGINT % 100)::VARCHAR) AS text FROM i JOIN t ON i.i % {len(_TEMPLATES)} = t.k""")
def curriculum_tasks(spark, d):
    return N.curriculum(spark, spark.createDataFrame(_TEMPLATES, "category string, template string"), 500)


@query(r"""SELECT doc_id, generate_subscripts(x, 1) - 1 AS place, length(unnest(x)) AS n_chars FROM (SELECT doc_id, regexp_extract_all(text, '(?s)```[A-Za-z0-9_+-]*\r?\n(.*?)```', 1) AS x FROM documents WHERE text IS NOT NULL)""")
def document_examples(spark, d):
    e = N.doc_examples(table(spark, d, "documents"), "doc_id", "text")
    return e.select("doc_id", F.col("place").cast("long").alias("place"), F.length("code").cast("long").alias("n_chars"))


def _balance(sources: list[str]) -> list[tuple[int, str]]:
    return [(0, "") if s.count("{") == s.count("}") else (1, f"braces {s.count('{') - s.count('}')}") for s in sources]


@query("""SELECT rec_id, CASE WHEN broken_source IS NOT NULL THEN CASE WHEN length(replace(broken_source, '{', '')) = length(replace(broken_source, '}', '')) THEN 0 ELSE 1 END END AS exit_code FROM negative_examples""")
def checked_sources(spark, d):
    n = table(spark, d, "negative_examples").select("rec_id", "broken_source")
    return N.checked(n, "broken_source", _balance).select("rec_id", "exit_code")
