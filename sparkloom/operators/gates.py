"""Filters and gates: predicates, ordered reasons, classifiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_reason(gates: list[tuple[str, Column]]) -> Column:
    """Name of the first gate whose predicate holds, null if none does; a null predicate doesn't hold."""
    return F.coalesce(*(F.when(p, F.lit(name)) for name, p in gates))


def with_reason(df: DataFrame, gates: list[tuple[str, Column]], name: str = "reason") -> DataFrame:
    return df.withColumn(name, first_reason(gates))


def reason_report(df: DataFrame, reason: str = "reason") -> DataFrame:
    """Rows by reason; rows without one count as pass."""
    return df.groupBy(F.coalesce(reason, F.lit("pass")).alias("reason")).agg(F.count("*").alias("n_rows"))


def starts_with_any(value: Column, allow: list[str], deny: list[str]) -> Column:
    """Prefix lists, deny first; what neither names, and null, is false."""
    low = F.lower(value)
    hit = lambda names: reduce(lambda a, b: a | b, (low.startswith(x) for x in names), F.lit(False))
    return F.coalesce(F.when(hit(deny), False).when(hit(allow), True), F.lit(False))


def first_glob(value: Column, globs: list[tuple[str, str]], default: str) -> Column:
    """Kind of the first pattern (* and ? as in shells) that the value matches."""
    to_regex = lambda g: "^" + g.replace(".", r"\.").replace("*", ".*").replace("?", ".") + "$"
    return F.coalesce(*(F.when(value.rlike(to_regex(g)), F.lit(kind)) for g, kind in globs), F.lit(default))


def tier_results(df: DataFrame, tiers: list[tuple[str, Column]]) -> DataFrame:
    """attempted, passed and failed of each tier where a row stops at the first that fails."""
    alive, cells = F.lit(True), []
    for i, (name, passed) in enumerate(tiers):
        ok = F.coalesce(passed, F.lit(False))
        cells.append(F.struct(F.lit(i).alias("tier_no"), F.lit(name).alias("tier"), alive.alias("attempted"), (alive & ok).alias("passed")))
        alive = alive & ok
    one = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    return one.groupBy("tier_no", "tier").agg(F.count_if("attempted").alias("attempted"), F.count_if("passed").alias("passed"), F.count_if(F.col("attempted") & ~F.col("passed")).alias("failed"))


def routed(violations: Column, exempt: Column, saving: Column, least_saving: int) -> Column:
    """Bucket of a record by its violations (structs with severity and fixable): AUTO if all can be fixed, EXEMPT if
    none is left but exemptions are, AGENT for a grave one without fix or enough saving, else LEAVE."""
    some = F.size(violations) > 0
    return (
        F.when(some & F.forall(violations, lambda v: v["fixable"]), "AUTO")
        .when(~some & (exempt > 0), "EXEMPT")
        .when(F.exists(violations, lambda v: (v["severity"] == "error") & ~v["fixable"]), "AGENT")
        .when(saving >= least_saving, "AGENT")
        .otherwise("LEAVE")
    )


def routed_with_reason(df: DataFrame, least_saving: int) -> DataFrame:
    """Adds bucket, would_be and reason. df: v (violations: code, severity, detail), s (saving), x (exempt), again.

    AUTO if every violation has a fix (detail), EXEMPT if none is left but the record is exempt, AGENT for errors and
    warnings without a fix or enough saving, else LEAVE; records that are made again are REGEN, would_be tells the rest.
    """
    stuck = F.filter("v", lambda d: d["severity"].isin("error", "warning") & d["detail"].isNull())
    some, saves = F.size("v") > 0, F.coalesce(F.col("s") >= least_saving, F.lit(False))
    own = F.when(some & F.forall("v", lambda d: d["detail"].isNotNull()), "AUTO").when(~some & F.col("x"), "EXEMPT").when((F.size(stuck) > 0) | saves, "AGENT").otherwise("LEAVE")
    codes = F.array_join(F.array_sort(F.array_distinct(F.transform(stuck, lambda d: d["code"]))), ",")
    why = (
        F.when(F.col("again"), "made again")
        .when(own == "AUTO", F.concat(F.lit("all "), F.size("v").cast("string"), F.lit(" can be fixed")))
        .when(own == "EXEMPT", "every hit exempt")
        .when((own == "AGENT") & (F.size(stuck) > 0), F.concat(F.lit("without a fix: "), codes))
        .when(own == "AGENT", F.concat(F.lit("saves "), F.col("s").cast("string")))
        .when(some, "only hints")
        .otherwise("no hits")
    )
    return df.withColumn("bucket", F.when(F.col("again"), "REGEN").otherwise(own)).withColumn("would_be", F.when(F.col("again"), own)).withColumn("reason", why)


def refused(df: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """The rows as they are, unless any of them matches a pattern: then the whole export is refused."""
    found = df.agg(*(F.count_if(F.coalesce(F.col(text).rlike(p), F.lit(False))).alias(k) for k, p in patterns.items())).first().asDict()
    if any(found.values()):
        raise ValueError(f"export refused: {({k: n for k, n in found.items() if n})}")
    return df
