"""Rewriting of source code by ordered rules, string literals left as they are. All built-in expressions.

A source is split at its literals; the rules run over the rest, in which a mark stands for each literal, and the literals
are put back. Patterns use no lookaround, so RE2 reads them too.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LITERAL = r'"(?:\\.|[^"\\])*"'
MARK = "\x01"


class Rule(NamedTuple):
    """Every match of pattern becomes replacement ($1 names a group)."""

    name: str
    pattern: str
    replacement: str


_NAME, _ATOM = "[A-Za-z_][A-Za-z0-9_]*", "[A-Za-z0-9_.]+"
# Habits of other languages and what the small language has for them.
FIXES = [
    Rule("loop_word", r"\b(?:for|while) ?\(", "lp("),
    Rule("else_word", r"\}\s*else\s*\{", "}el{"),
    Rule("separator_before_el", r"\};\s*el\s*\{", "}el{"),
    Rule("return_word", r"\breturn\s+", "<"),
    Rule("let_mut", rf"\blet mut ({_NAME}) ?= ?", "let $1=mut."),
    Rule("reassigned_mut", rf"([;{{}}])({_NAME})=mut\.", "$1$2="),
    Rule("and_in_condition", r"if\(([^()&|]+)&&([^()&|]+)\)\{([^{}]*)\}", "if($1){if($2){$3}}"),
    Rule("not_equal", rf"({_ATOM}) ?!= ?({_ATOM})", "!($1=$2)"),
    Rule("double_equals", "==", "="),
    Rule("at_most", rf"({_ATOM}) ?<= ?({_ATOM})", "!($1>$2)"),
    Rule("at_least", rf"({_ATOM}) ?>= ?({_ATOM})", "!($1<$2)"),
    Rule("increment", rf"({_NAME})\+\+", "$1=$1+1"),
    Rule("decrement", rf"({_NAME})--", "$1=$1-1"),
    Rule("compound", rf"({_NAME}) ?([+*/-])= ?", "$1=$1$2"),
    Rule("remainder", r"([A-Za-z0-9_]+)%([A-Za-z0-9_]+)", "($1-$1/$2*$2)"),
    Rule("true_word", r"\b(?:True|TRUE)\b", "true"),
    Rule("false_word", r"\b(?:False|FALSE)\b", "false"),
    Rule("string_type", r"\b(?:string|String)\b", "Str"),
    Rule("int_type", r"\bint\b", "i64"),
    Rule("float_type", r"\b(?:float|double)\b", "f64"),
    Rule("comma", r"([A-Za-z0-9_)\]]) ?, ?", "$1;"),
    Rule("odd_character", "[`?@#~^\\\\]", ""),
]
# The default form: lower-case declaration words, arrays as @T and @(..), elements by get.
DEFAULT = [
    *(Rule(f"word_{w}", rf"(^|[;\s]){w}=", f"$1{w.lower()}=") for w in "MIFTC"),
    Rule("array_type", r":\[([A-Za-z0-9$]+)\]", ":@$1"),
    Rule("element", r"([A-Za-z0-9_)])\[([^\[\]]*)\]", "$1.get($2)"),
    Rule("outer_element", r"([A-Za-z0-9_)])\[([^\[\]]*)\]", "$1.get($2)"),
    Rule("array", r"\[([^\[\]]*)\]", "@($1)"),
    Rule("outer_array", r"\[([^\[\]]*)\]", "@($1)"),
]


def literals(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(LITERAL), F.lit(0))


def masked(text: Column) -> Column:
    return F.array_join(F.split(text, LITERAL, -1), MARK)


def unmasked(text: Column, kept: Column) -> Column:
    parts = F.split(text, MARK, -1)
    return F.array_join(F.transform(parts, lambda p, i: F.concat(p, F.coalesce(F.get(kept, i), F.lit("")))), "")


def each(text: Column, pattern: str, f: Callable[[Column], Column]) -> Column:
    """Every match of a pattern replaced by f of it."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.array_join(F.transform(F.split(text, pattern, -1), lambda p, i: F.concat(p, F.coalesce(f(F.get(hits, i)), F.lit("")))), "")


def rewritten(df: DataFrame, source: str, rules: list[Rule], text: str = "text", fixes: str = "fixes") -> DataFrame:
    """Adds the rewritten source and the names of the rules that changed it, in their order; null stays null.

    A column per rule: each step is read twice (by the next and by the comparison), so it must not be inlined.
    """
    df = df.withColumn("_l", literals(F.col(source))).withColumn("_m0", masked(F.col(source)))
    for k, r in enumerate(rules):
        df = df.withColumn(f"_m{k + 1}", F.regexp_replace(f"_m{k}", r.pattern, r.replacement))
    names = F.filter(F.array(*(F.when(F.col(f"_m{k}") != F.col(f"_m{k + 1}"), r.name) for k, r in enumerate(rules))), lambda x: x.isNotNull())
    out = df.withColumn(fixes, F.when(F.col(source).isNotNull(), names)).withColumn(text, unmasked(F.col(f"_m{len(rules)}"), F.col("_l")))
    return out.drop("_l", *(f"_m{k}" for k in range(len(rules) + 1)))


def default_types(text: Column) -> Column:
    """Types with a capital after a colon in lower case with a sigil (``:Point`` is ``:$point``), outside literals."""
    return unmasked(each(masked(text), r":[A-Z][A-Za-z0-9]*", lambda h: F.concat(F.lit(":$"), F.lower(F.substring(h, F.lit(2), F.length(h))))), literals(text))


def expanded(text: Column) -> Column:
    """One statement a line, blanks around ``=`` of bindings; compact() takes it back where blanks don't matter."""
    m = F.regexp_replace(masked(text), r"([;{])", "$1\n")
    m = F.regexp_replace(m, r"\}", "\n}")
    return unmasked(F.regexp_replace(F.regexp_replace(m, r"let ([A-Za-z_][A-Za-z0-9_]*)=", "let $1 = "), r"\n+", "\n"), literals(text))
