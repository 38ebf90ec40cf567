"""Chat rows, pairs and text records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def chat(system: Column, user: Column, assistant: Column) -> Column:
    """Array of three messages (role, content)."""
    one = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return F.array(one("system", system), one("user", user), one("assistant", assistant))


def chat_faults(messages: Column) -> Column:
    """Names of what is wrong with a chat row: shape, system, empty, template."""
    roles = F.transform(messages, lambda m: m["role"])
    good = roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant"))
    empty = F.exists(messages, lambda m: F.coalesce(F.trim(m["content"]) == "", F.lit(True)))
    template = F.exists(messages, lambda m: F.coalesce(m["content"].rlike(r"\{\{[a-z_]+\}\}"), F.lit(False)))
    found = F.array(F.when(~F.coalesce(good, F.lit(False)), "shape"), F.when(F.coalesce(empty, F.lit(True)), "empty"), F.when(F.coalesce(template, F.lit(False)), "template"))
    return F.filter(found, lambda x: x.isNotNull())


def expanded(df: DataFrame, keep: list[str], variants: list[tuple[str, Column, Column]]) -> DataFrame:
    """One row per variant (name, prompt, answer) of each row; variants without prompt or answer are left out."""
    cells = [F.struct(F.lit(n).alias("kind"), p.alias("prompt"), a.alias("answer")) for n, p, a in variants]
    out = df.select(*keep, F.explode(F.array(*cells)).alias("v")).select(*keep, "v.*")
    return out.where("prompt is not null and answer is not null")


def labels(pairs: list[tuple[str, Column]]) -> Column:
    """All labels whose condition holds."""
    return F.filter(F.array(*(F.when(c, F.lit(n)) for n, c in pairs)), lambda x: x.isNotNull())


def prompt(category: Column, task: Column, templates: dict[str, str], otherwise: str) -> Column:
    """The template of a category with ``{task}`` filled in."""
    chosen = F.coalesce(*(F.when(category == k, F.lit(t)) for k, t in templates.items()), F.lit(otherwise))
    return F.replace(chosen, F.lit("{task}"), task)


def completions(df: DataFrame, key: str, source: str, least: int = 40) -> DataFrame:
    """key, place, prompt, answer: a source of `least` characters or more cut at one to three places (one for each 50
    characters) between 30 and 70 % of it, picked by hash of place and source."""
    n = F.length(source)
    rows = df.where(n >= least).select(key, F.col(source).alias("_s"), F.explode(F.sequence(F.lit(0), F.least(F.lit(3), F.greatest(F.lit(1), F.floor(n / 50).cast("int"))) - 1)).alias("place"))
    lo, hi = F.floor(F.length("_s") * 3 / 10), F.floor(F.length("_s") * 7 / 10)
    pick = F.conv(F.substring(F.sha2(F.concat(F.col("place").cast("string"), F.lit(":"), "_s"), 256), 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("_c", (lo + pick % (hi - lo)).cast("int"))
    return rows.select(key, F.col("place").cast("long").alias("place"), F.substring("_s", F.lit(1), F.col("_c")).alias("prompt"), F.substring("_s", F.col("_c") + 1, F.length("_s")).alias("answer"))
