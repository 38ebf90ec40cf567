"""Row-expanding operators: edits of programs by rules, examples in documents, curricula, plug-in checks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Edit(NamedTuple):
    """A rule: what matches pattern (no lookaround, so RE2 reads it too) becomes replacement ($1 names a group)."""

    kind: str
    pattern: str
    replacement: str


_ATOM = "[A-Za-z0-9_)]"
# Variants that mean the same or differ in a constant.
MUTATIONS = [
    Edit("widen_type", r":i64\b", ":f64"),
    Edit("let_to_mut", r"let ([A-Za-z_][A-Za-z0-9_]*)=([0-9])", "let $1=mut.$2"),
    Edit("extract_result", r"<([A-Za-z0-9_]+\([A-Za-z0-9_;]*\))\}", "let out=$1;<out}"),
    Edit("change_number", r"([=(;+*/-])([0-9]+)([;)}])", "$11$2$3"),
]
# Single faults that a compiler should report.
FAULTS = [
    Edit("type_mismatch", r":i64([;,){])", ":Str$1"),
    Edit("missing_separator", r";([A-Za-z])", "$1"),
    Edit("wrong_operator", rf"({_ATOM})\+([A-Za-z0-9_(])", "$1/$2"),
    Edit("fixed_reassigned", r"(let ([A-Za-z_][A-Za-z0-9_]*)=[0-9][^;{}]*;)", "$1$2=0;"),
    Edit("unknown_name", r"<([A-Za-z_][A-Za-z0-9_]*)([;}])", "<$1Gone$2"),
    Edit("argument_count", r"([A-Za-z0-9_]\([^();]*);[^();]*\)", "$1)"),
]
# Wrong programs for contrast.
CONTRASTS = [
    Edit("bound_shift", rf"({_ATOM})<([A-Za-z0-9_(])", "$1<=$2"),
    Edit("step_dropped", r"([a-z][A-Za-z0-9]*) ?[+-] ?1([;)}])", "$1$2"),
    Edit("branches_swapped", r"(if\([^()]*\)\{)([^{}]*)(\}el\{)([^{}]*)\}", "$1$4$3$2}"),
    Edit("condition_negated", r"if\(([^()]+)\)", "if(!($1))"),
    Edit("result_dropped", r"<[^<>;{}]*\}", "}"),
    Edit("operator_swap", rf"({_ATOM})\*([A-Za-z0-9_(])", "$1+$2"),
    Edit("used_before", r"(let [A-Za-z_][A-Za-z0-9_]*=[^;{}]*;)([^;{}]+;)", "$2$1"),
    Edit("type_swap", r":(?:i64|u64)([;,){])", ":bool$1"),
    Edit("separator_missing", r";", ""),
    Edit("separator_doubled", r";", ";;"),
    Edit("separator_moved", r";([A-Za-z]+)", "$1;"),
]
# Faults with the repair that undoes them.
REPAIRS = [
    Edit("separator_removed", r"\);", ")"),
    Edit("brace_for_bracket", r"\)\{", "){("),
    Edit("brace_removed", r"\}", ""),
    Edit("name_changed", r"let ([A-Za-z_][A-Za-z0-9_]*)=", "let $1Typo="),
    Edit("binding_doubled", r"(let [^;{}]*;)", "$1$1"),
    Edit("sign_swapped", r":u64\b", ":i64"),
    Edit("cast_removed", r" as [a-z][a-z0-9]*", ""),
    Edit("foreign_loop", r"\blp\(", "while("),
    Edit("foreign_else", r"\}el\{", "}else{"),
    Edit("comma_for_separator", r";", ","),
]


def pick(source: Column, kind: str, n: Column) -> Column:
    """A place from 0 to n - 1 that depends on kind and source alone."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(kind + ":"), source), 256), 1, 8), 16, 10).cast("long") % n


def edited(df: DataFrame, key: str, source: str, rules: list[Edit], every: bool = False) -> DataFrame:
    """key, kind, place, edited: for each rule that matches, its match at a picked place (every: at each place) replaced.

    place counts the matches of a rule from 0. Null sources and rules that change nothing have no rows. All in built-in
    expressions: a source is split at its matches and put together again.
    """
    s = F.col(source)

    def matches(e: Edit) -> Column:
        hits = F.regexp_extract_all(s, F.lit(e.pattern), F.lit(0))
        news = F.transform(hits, lambda h: F.regexp_replace(h, e.pattern, e.replacement))
        return F.struct(F.lit(e.kind).alias("kind"), hits.alias("hits"), F.split(s, e.pattern, -1).alias("parts"), news.alias("news"))

    found = F.array(*map(matches, rules))
    rows = df.where(s.isNotNull()).select(key, s.alias("_s"), F.explode(found).alias("_f")).select(key, "_s", "_f.*").where("size(hits) > 0")
    at = F.sequence(F.lit(0).cast("long"), (F.size("hits") - 1).cast("long")) if every else F.array(F.conv(F.substring(F.sha2(F.concat("kind", F.lit(":"), "_s"), 256), 1, 8), 16, 10).cast("long") % F.size("hits"))
    rows = rows.select(key, "kind", "_s", "hits", "parts", "news", F.explode(at).alias("place"))
    joined = F.transform("parts", lambda p, i: F.when(i == 0, p).when(i - 1 == F.col("place"), F.concat(F.get("news", i - 1), p)).otherwise(F.concat(F.get("hits", i - 1), p)))
    return rows.select(key, "kind", "place", F.array_join(joined, "").alias("edited"), "_s").where("edited <> _s").drop("_s")


def renamed(df: DataFrame, key: str, source: str, suffix: str = "X") -> DataFrame:
    """key, name, edited: a picked binding renamed everywhere in its source; sources without one have no row."""
    s = F.col(source)
    names = F.array_sort(F.array_distinct(F.regexp_extract_all(s, F.lit(r"let ([A-Za-z_][A-Za-z0-9_]*)="), F.lit(1))))
    rows = df.where(s.isNotNull()).select(key, s.alias("_s"), names.alias("_n")).where("size(_n) > 0")
    rows = rows.withColumn("name", F.get("_n", pick(F.col("_s"), "rename", F.size("_n")).cast("int")))
    return rows.select(key, "name", F.regexp_replace("_s", F.concat(F.lit(r"\b"), "name", F.lit(r"\b")), F.concat("name", F.lit(suffix))).alias("edited"))


def curriculum(spark, templates: DataFrame, count: int) -> DataFrame:
    """i, category, text of `count` tasks: templates (category, template) take turns in the order of category and template,
    the marks {a} and {b} filled with numbers that depend on i alone. Templates are data of any source, a small table."""
    order = F.array_sort(F.collect_list(F.struct("category", "template")))
    all_ = templates.agg(order.alias("t"))
    rows = spark.range(count).withColumnRenamed("id", "i").join(F.broadcast(all_)).where("size(t) > 0").withColumn("x", F.get("t", (F.col("i") % F.size("t")).cast("int")))
    number = lambda mark: (F.conv(F.substring(F.sha2(F.concat(F.lit(mark), F.col("i").cast("string")), 256), 1, 6), 16, 10).cast("long") % 100).cast("string")
    return rows.select("i", "x.category", F.replace(F.replace("x.template", F.lit("{a}"), number("a")), F.lit("{b}"), number("b")).alias("text"))


# Ways to make a task harder, by name: what is asked for beside it.
DIMENSIONS = {
    "constraint": "{task} Use no more than {n} statements.",
    "deepen": "{task} Then explain the case of {n} elements.",
    "concrete": "{task} Show it for the input {n}.",
    "steps": "{task} Do it in {n} steps that are functions of their own.",
    "breadth": "Write another task like this one, for {n} values: {task}",
}


def evolved(df: DataFrame, key: str, text: str, dimensions: dict[str, str] | None = None) -> DataFrame:
    """key, dimension, text: a harder form of every text for each dimension; n is 2 to 9, from the hash of dimension and text.
    Null texts have none."""
    t = F.col(text)
    n = lambda d: (F.conv(F.substring(F.sha2(F.concat(F.lit(d + ":"), t), 256), 1, 6), 16, 10).cast("long") % 8 + 2).cast("string")
    forms = F.array(*(F.struct(F.lit(d).alias("dimension"), F.replace(F.replace(F.lit(form), F.lit("{n}"), n(d)), F.lit("{task}"), t).alias("text")) for d, form in (dimensions or DIMENSIONS).items()))
    return df.where(t.isNotNull()).select(key, F.explode(forms).alias("x")).select(key, "x.dimension", "x.text")


def doc_examples(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, place, code of every block in three backticks."""
    blocks = F.regexp_extract_all(text, F.lit(r"(?s)```[A-Za-z0-9_+-]*\r?\n(.*?)```"), F.lit(1))
    return df.where(F.col(text).isNotNull()).select(key, F.posexplode(blocks).alias("place", "code"))


def checked(df: DataFrame, source: str, check: Callable[[list[str]], list[tuple[int, str]]]) -> DataFrame:
    """Adds exit_code and output of a plug-in checker that takes sources in batches (a compiler, a linter); null sources get
    nulls. The checker runs on the executors, so it must be there."""
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    schema = StructType([*df.schema.fields, StructField("exit_code", IntegerType()), StructField("output", StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            some = pdf[source].notna()
            got = check(pdf.loc[some, source].tolist())
            at = pdf.index[some]
            code = pd.Series([c for c, _ in got], index=at, dtype="Int32").reindex(pdf.index)
            said = pd.Series([o for _, o in got], index=at, dtype=object).reindex(pdf.index)
            said = said.where(said.notna(), None)
            yield pdf.assign(exit_code=code, output=said)

    return df.mapInPandas(run, schema)
