"""Column functions on text and source code. Null stays null unless a docstring says otherwise."""

from __future__ import annotations

import hashlib

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Words of the small language that structural hashing keeps.
KEYWORDS = ("let", "mut", "if", "el", "lp", "br", "as", "true", "false", "M", "I", "T", "F")
TYPES = ("i64", "u64", "f64", "bool", "Str", "void")
TOKEN = r"[a-zA-Z_][a-zA-Z0-9_]*|[0-9]+(?:\.[0-9]+)?|[<>=!]=?|\S"


def normalised(text: Column) -> Column:
    """Lower case, runs of white space as one blank, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), r"(?U)\s+", " "))


def content_hash(text: Column) -> Column:
    """SHA-256 of the normalised text."""
    return F.sha2(normalised(text), 256)


def count_of(text: Column, part: str) -> Column:
    """Occurrences of a literal that don't overlap."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("long")


def words(text: Column) -> Column:
    """Array of runs without white space."""
    return F.filter(F.split(text, r"\s+"), lambda x: x != "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def nesting_depth(text: Column, clamped: bool) -> Column:
    """Greatest depth of braces; clamped: a closing brace never takes it under 0."""
    signs = F.split(F.regexp_replace(text, r"[^{}]", ""), "")
    step = lambda acc, x: acc["d"] + F.when(x == "{", 1).when(x == "}", -1).otherwise(0)
    low = lambda v: F.greatest(v, F.lit(0)) if clamped else v
    start = F.struct(F.lit(0).alias("d"), F.lit(0).alias("m"))
    return F.aggregate(signs, start, lambda acc, x: F.struct(low(step(acc, x)).alias("d"), F.greatest(acc["m"], step(acc, x)).alias("m")), lambda acc: acc["m"].cast("long"))


def without_literals(text: Column) -> Column:
    """String literals emptied, escapes respected."""
    return F.regexp_replace(text, r'"(\\.|[^"\\])*"', '""')


def imports(text: Column) -> Column:
    """Sorted different modules of the import statements."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?:^|[;\s])I=([A-Za-z_][A-Za-z0-9_]*):([A-Za-z0-9_.]+)"), F.lit(2))))


def id_shape(text: Column) -> Column:
    """Runs of upper case as A, of lower case as a, of digits as 9."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"[0-9]+", "9"), r"[A-Z]+", "A"), r"[a-z]+", "a")


def family(task_id: Column) -> Column:
    """A task id without its version."""
    return F.regexp_replace(task_id, r"v[0-9]+\z", "")


def error_codes(text: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(r"(E[0-9]{4})"), F.lit(1))))


def fenced_code(text: Column) -> Column:
    """Content of the first block in three backticks; empty where there is none."""
    return F.regexp_extract(text, r"(?s)```[A-Za-z0-9_+-]*\n(.*?)```", 1)


def camel_words(text: Column) -> Column:
    """camelCase as words in lower case."""
    return F.lower(F.regexp_replace(text, r"([a-z0-9])([A-Z])", "$1 $2"))


def short_id(phase: Column, task: Column, source: Column) -> Column:
    return F.concat_ws("-", phase, task, F.substring(F.sha2(source, 256), 1, 8))


def char_ngrams(text: Column, n: int = 3) -> Column:
    """Different character n-grams; a shorter text is its own, an empty one has none. For short texts: use
    an Arrow function for long ones."""
    grams = F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, n))
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).when(F.length(text) <= n, F.array(text)).otherwise(F.array_distinct(grams))


def jaccard(a: Column, b: Column) -> Column:
    """Of two sets: 1 if both are empty, 0 if one is."""
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


_TOKEN = regex.compile(TOKEN)
_KEPT = frozenset(KEYWORDS + TYPES)


def structural_form(source: str) -> str:
    """Tokens with identifiers numbered by first use and numbers as NUM."""
    numbers: dict[str, str] = {}
    out = []
    for t in _TOKEN.findall(source):
        c = t[0]
        if c.isascii() and (c.isalpha() or c == "_"):
            out.append(t if t in _KEPT else numbers.setdefault(t, f"id{len(numbers)}"))
        else:
            out.append("NUM" if "0" <= c <= "9" else t)
    return " ".join(out)


@F.pandas_udf(StringType())
def structural_hash(source: pd.Series) -> pd.Series:
    """First 16 hex digits of the SHA-256 of the structural form, in Arrow batches."""
    return source.map(lambda s: None if s is None else hashlib.sha256(structural_form(s).encode()).hexdigest()[:16])


def canonical_output(text: Column) -> Column:
    """Program output for comparison: words of each line parted by one blank, `true` and `false` in lower case, a word that
    is a plain decimal number with a fraction by its value to 12 places, blank lines at either end dropped."""
    def word(w: Column) -> Column:
        value = F.regexp_replace(F.regexp_replace(w.try_cast("decimal(30,12)").cast("string"), "0+$", ""), r"\.$", "")
        decimal = w.rlike(r"^-?[0-9]{1,18}\.[0-9]{1,12}$")
        return F.when(F.lower(w).isin("true", "false"), F.lower(w)).when(decimal, F.when(value == "-0", "0").otherwise(value)).otherwise(w)

    line = lambda x: F.array_join(F.transform(words(x), word), " ")
    rows = F.array_join(F.transform(F.split(F.regexp_replace(text, r"\r\n?", "\n"), "\n"), line), "\n")
    return F.regexp_replace(rows, r"^\n+|\n+$", "")


# Names that say nothing, as a grammar makes them.
GENERIC = r"(?i)^(?:fn\d+|v\d+|p\d+|i\d+|mod\d+|[xyzabnmt]\d*|_)$"


def identifiers(source: Column) -> Column:
    """Different names that a source defines: module, functions, bindings, parameters."""
    every = lambda rx: F.regexp_extract_all(source, F.lit(rx), F.lit(1))
    return F.array_distinct(F.concat(every(r"M=(\w+)"), every(r"F=(\w+)\("), every(r"let\s+(\w+)"), every(r"[(;](\w+):")))


def coherence(source: Column) -> Column:
    """1, 0.5 or 0 by the mean meaning of the names: none for generic ones, full with three letters in a row, else half."""
    weight = lambda x: F.when(x.rlike(GENERIC), 0.0).when(x.rlike(r"(?i)[a-z]{3,}"), 1.0).otherwise(0.5)
    names = identifiers(source)
    mean = F.aggregate(F.transform(names, weight), F.lit(0.0), lambda a, x: a + x) / F.greatest(F.size(names), F.lit(1))
    return F.when(mean >= 0.8, 1.0).when(mean >= 0.4, 0.5).otherwise(0.0)


def penalised(rules: Column, penalties: dict[str, float], otherwise: float, most: int) -> Column:
    """1 less the penalty of every rule in an array of hits, up to `most` times each, not under 0; null hits don't count."""
    per = F.create_map(*(F.lit(x) for kv in penalties.items() for x in kv))
    known = F.filter(F.coalesce(rules, F.array().cast("array<string>")), lambda x: x.isNotNull())
    one = lambda c: F.coalesce(F.try_element_at(per, c), F.lit(otherwise)) * F.least(F.size(F.filter(known, lambda x: x == c)), F.lit(most))
    return F.greatest(F.lit(0.0), 1 - F.aggregate(F.array_distinct(known), F.lit(0.0), lambda a, c: a + one(c)))


_LITERAL = r'("(?:\\.|[^"\\])*")'
# White space in any form Unicode has.
BLANK = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_WORD = r"[\p{L}\p{M}\p{N}\p{Pc}]"


def without_blanks(source: Column) -> Column:
    """White space dropped outside string literals."""
    return F.regexp_replace(source, rf"{_LITERAL}|{BLANK}+", "$1")


def compact(source: Column) -> Column:
    """White space dropped outside string literals, one blank kept between word characters."""
    # first each run becomes a blank (a literal gets one behind it), then blanks go that don't part words
    single = F.regexp_replace(source, rf"{_LITERAL}|{BLANK}+", "$1 ")
    return F.regexp_replace(single, rf"{_LITERAL}|(?<!{_WORD}) | (?!{_WORD})", "$1")


def canonical_source(source: Column) -> Column:
    """Comments ``(* .. *)`` and white space outside string literals dropped."""
    return F.regexp_replace(source, rf"{_LITERAL}|(?s:\(\*.*?\*\))|{BLANK}+", "$1")


def plain_type(t: Column) -> Column:
    """A type for comparison: no blanks or marks, lower case, arrays as @T."""
    bare = F.regexp_replace(t, r"[\s$]", "")
    return F.lower(F.replace(F.replace(bare, F.lit("["), F.lit("@")), F.lit("]"), F.lit("")))


def slug(name: Column) -> Column:
    """Letters a-z and digits of a name; ``unnamed`` where none is left."""
    kept = F.regexp_replace(F.lower(name), "[^a-z0-9]", "")
    return F.when(kept == "", "unnamed").otherwise(kept)


def finite(x: Column) -> Column:
    """Null for NaN and infinities."""
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def license_class(text: Column) -> Column:
    """Short name of a licence by its text or name; null counts as empty."""
    t = F.lower(F.coalesce(text, F.lit("")))
    bsd = F.when(t.contains("3-clause"), "BSD-3-Clause").when(t.contains("2-clause"), "BSD-2-Clause").otherwise("BSD")
    out = F.when(t.contains("mit license") | t.contains("permission is hereby granted") | (t == "mit"), "MIT").when(t.contains("apache") & t.contains("2"), "Apache-2.0").when(t.contains("bsd"), bsd)
    out = out.when(t.contains("mozilla") | t.contains("mpl"), "MPL-2.0").when(t.contains("gpl") | t.contains("gnu general public"), "GPL").when(t.contains("isc"), "ISC")
    return out.when(t.contains("unlicense") | t.contains("public domain") | t.contains("cc0"), "public domain").otherwise("unknown")


def lines_match(got: Column, want: Column, tolerance: float = 1e-6) -> Column:
    """Whether an array of lines begins with those wanted: equal without outer blanks, or numbers within the tolerance."""
    def same(i: Column) -> Column:
        g, w = F.trim(F.get(got, i)), F.trim(F.get(want, i))
        return F.coalesce(g == w, F.lit(False)) | F.coalesce(F.abs(g.try_cast("double") - w.try_cast("double")) < tolerance, F.lit(False))

    every = F.forall(F.sequence(F.lit(0), F.greatest(F.size(want) - 1, F.lit(0))), same)
    return (F.size(got) >= F.size(want)) & ((F.size(want) == 0) | every)


def difference(want: Column, got: Column) -> Column:
    """How an output differs from the one expected, by its lines: none, wrong_line_count, off_by_one or returns_zero (of the
    first line where whole numbers differ so, all lines up to it being numbers), else algorithm_bug; null if either is null."""
    lines = lambda t: F.split(F.trim(F.regexp_replace(t, r"\r\n?", "\n")), "\n", -1)
    number = lambda x: F.when(F.trim(x).rlike(r"^-?[0-9]{1,18}$"), F.trim(x).cast("long"))

    def kind(a: Column, b: Column) -> Column:
        a, b = number(a), number(b)
        return F.when(a.isNull() | b.isNull(), "text").when(F.abs(a - b) == 1, "off_by_one").when((b == 0) & (a != 0), "returns_zero").otherwise("")

    kinds = F.zip_with(lines(want), lines(got), kind)
    first = F.get(F.filter(kinds, lambda x: x != ""), F.lit(0))
    bug = F.when(first.isin("off_by_one", "returns_zero"), first).otherwise("algorithm_bug")
    return F.when(want.isNull() | got.isNull(), F.lit(None)).when(canonical_output(want) == canonical_output(got), "none").when(F.size(lines(want)) != F.size(lines(got)), "wrong_line_count").otherwise(bug)
