"""Functions of programs and how they fit together: signatures, compatible classes, chains, fan-outs."""

from __future__ import annotations

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

# A function's head: name, parameters (name:type, parted by semicolons), return type, type of an error if it has one.
HEAD = r"F=([A-Za-z0-9_]+)\(([^()]*)\):(\[?[A-Za-z0-9]+\]?)(![A-Za-z0-9]+)?"
_BODY = regex.compile(HEAD + r"(\{(?:[^{}]++|(?5))*+\})?")
_TEXT = regex.compile(r'"(?:\\.|[^"\\])*"')


def functions_of(df: DataFrame, key: str, source: str) -> DataFrame:
    """key, place, fn, params (array of types), ret, fails of every function head of a source, in its order."""
    part = lambda k: F.regexp_extract_all(source, F.lit(HEAD), F.lit(k))
    heads = F.arrays_zip(part(1).alias("fn"), part(2).alias("params"), part(3).alias("ret"), part(4).alias("err"))
    types = F.filter(F.transform(F.split("z.params", ";"), lambda p: F.trim(F.coalesce(F.get(F.split(p, ":"), F.lit(1)), F.lit("")))), lambda t: t != "")
    rows = df.where(F.col(source).isNotNull()).select(key, F.posexplode(heads).alias("place", "z"))
    return rows.select(key, F.col("place").cast("long").alias("place"), "z.fn", types.alias("params"), "z.ret", (F.coalesce(F.length("z.err"), F.lit(0)) > 0).alias("fails"))


@F.pandas_udf(ArrayType(StructType([StructField("fn", StringType()), StructField("start", LongType()), StructField("end", LongType())])))
def bodies(source: pd.Series) -> pd.Series:
    """Name and place of every function with its body, braces matched outside string literals; a head without a body, or
    whose braces don't close, ends with its head."""

    def one(s):
        if s is None:
            return None
        plain = _TEXT.sub(lambda m: '"' + "." * (len(m[0]) - 2) + '"', s)
        return [{"fn": m[1], "start": m.start(), "end": m.end()} for m in _BODY.finditer(plain)]

    return source.map(one)


def signature_classes(functions: DataFrame, key: str) -> DataFrame:
    """signature, params, ret, fails, n, first_id, first_place of the functions of equal types; the members of a class are
    the functions with its signature."""
    sig = F.concat(F.array_join("params", ","), F.lit("->"), "ret", F.when(F.col("fails"), "!").otherwise(""))
    first = F.min(F.struct(F.col(key).alias("id"), "place"))
    g = functions.groupBy(sig.alias("signature"), "params", "ret", "fails").agg(F.count("*").alias("n"), first.alias("f"))
    return g.select("signature", "params", "ret", "fails", "n", F.col("f.id").alias("first_id"), F.col("f.place").alias("first_place"))


def compatible(classes: DataFrame) -> DataFrame:
    """producer, consumer (signatures), n_pairs: what the producer returns is the one parameter of the consumer; functions
    that can fail fit nowhere, and none fits itself. Pairs of classes, not of functions."""
    ok = classes.where("not fails")
    a = ok.select(F.col("signature").alias("producer"), F.col("ret").alias("t"), F.col("n").alias("np"))
    b = ok.where("size(params) = 1").select(F.col("signature").alias("consumer"), F.get("params", F.lit(0)).alias("t"), F.col("n").alias("nc"))
    n = F.col("np") * F.col("nc") - F.when(F.col("producer") == F.col("consumer"), F.col("np")).otherwise(0)
    return a.join(b, "t").select("producer", "consumer", n.alias("n_pairs")).where("n_pairs > 0")


def _hash(key: str):
    return F.sha2(F.concat_ws(":", F.col(key).cast("string"), F.col("place").cast("string")), 256)


def chains(functions: DataFrame, key: str, most: int = 3) -> DataFrame:
    """A chain h(g(f(x))) for each function f that has one: key, place, fn, g_id, g_fn, h_id, h_fn.

    Candidates for g and h are the first `most` consumers of a type in hash order (a sample, as many types as rows); the
    first g that isn't f, and then the first h of another name than both, is taken. Functions that can fail take no part.
    """
    ok = functions.where("not fails").withColumn("h", _hash(key))
    one = ok.where("size(params) = 1").select(F.get("params", F.lit(0)).alias("t"), F.struct("h", F.col(key).alias("id"), "place", "fn", "ret").alias("c"))
    from .ranks import first_n

    sample = first_n(one, ["t"], [F.col("c")], most).groupBy("t").agg(F.array_sort(F.collect_list("c")).alias("cs"))
    from .joins import dimension

    g = dimension(ok, sample.withColumnRenamed("t", "ret"), ["ret"], "inner").withColumn("g", F.explode("cs")).drop("cs")
    g = g.where((F.col("g.id") != F.col(key)) | (F.col("g.place") != F.col("place")))
    h = dimension(g.withColumn("t", F.col("g.ret")), sample, ["t"], "inner").withColumn("k", F.explode("cs")).where((F.col("k.fn") != F.col("fn")) & (F.col("k.fn") != F.col("g.fn")))
    best = h.groupBy(key, "place").agg(F.min(F.struct(F.struct("g.h", "g.id", "g.place").alias("a"), F.struct("k.h", "k.id", "k.place").alias("b"), F.col("fn"), F.col("g.fn").alias("gf"), F.col("k.fn").alias("kf"))).alias("m"))
    return best.select(key, "place", "m.fn", F.col("m.a.id").alias("g_id"), F.col("m.gf").alias("g_fn"), F.col("m.b.id").alias("h_id"), F.col("m.kf").alias("h_fn"))


def fan_outs(functions: DataFrame, key: str, numeric: tuple[str, ...] = ("i64", "u64", "f64")) -> DataFrame:
    """Pairs of functions that take one value of the same type and return the same number type, to be added up: each
    function with the next one in hash order, if its name is another: key, place, other_id, other_fn. Neighbours meet by
    their ranks, so no task orders the functions of a common type."""
    from .ranks import range_rank

    ok = functions.where((F.size("params") == 1) & ~F.col("fails") & F.col("ret").isin(*numeric)).select(key, "place", "fn", "ret", F.get("params", F.lit(0)).alias("t"), _hash(key).alias("h"))
    r = range_rank(ok, ["t", "ret"], [F.col("h"), F.col(key), F.col("place")], "r")
    nxt = r.select("t", "ret", (F.col("r") - 1).alias("r"), F.col(key).alias("other_id"), F.col("fn").alias("other_fn"))
    return r.join(nxt, ["t", "ret", "r"]).where("other_fn <> fn").select(key, "place", "other_id", "other_fn")


_DEFAULTS = {"i64": "0", "u64": "0", "f64": "0.0", "bool": "false", "Str": '""'}


def guarded(functions: DataFrame, key: str) -> DataFrame:
    """key, place, kind, wrapper: a function that guards another one, for each kind that fits.

    empty: the first text or array parameter has no elements; negative: the first i64 is below 0; single: an array of one
    element whose type is returned; clamp: the first i64 is kept in 0 to 1000; twice: f(f(x)) where types allow. The result
    of a guard is the default of the type returned; types without one get no guard. Functions that can fail take no part.
    """
    head = functions.where(~F.col("fails") & (F.size("params") > 0))
    names = F.transform("params", lambda t, i: F.concat(F.lit("p"), i.cast("string")))
    first = lambda test: F.array_position(F.transform("params", lambda t: F.when(test(t), "y").otherwise("n")), "y")
    default = F.coalesce(*(F.when(F.col("ret") == k, F.lit(v)) for k, v in _DEFAULTS.items()))
    rows = head.select(key, "place", "fn", "ret", "params", names.alias("n"), default.alias("d"), first(lambda t: (t == "Str") | t.startswith("[")).alias("e"), first(lambda t: t == "i64").alias("i"))
    at = lambda c: F.get("n", (F.col(c) - 1).cast("int"))
    params = F.array_join(F.zip_with("n", "params", lambda n, t: F.concat(n, F.lit(":"), t)), ";")
    call = lambda args: F.concat("fn", F.lit("("), args, F.lit(")"))
    body = {
        "empty": F.when((F.col("e") > 0) & F.col("d").isNotNull(), F.concat(F.lit("if("), at("e"), F.lit(".len=0){<"), "d", F.lit("};<"), call(F.array_join("n", ";")))),
        "negative": F.when((F.col("i") > 0) & F.col("d").isNotNull(), F.concat(F.lit("if("), at("i"), F.lit("<0){<"), "d", F.lit("};<"), call(F.array_join("n", ";")))),
        "single": F.when((F.size("params") == 1) & (F.get("params", F.lit(0)) == F.concat(F.lit("["), "ret", F.lit("]"))), F.concat(F.lit("if(p0.len=1){<p0[0]};<"), call(F.lit("p0")))),
        "clamp": F.when(F.col("i") > 0, F.concat(F.lit("let c=mut."), at("i"), F.lit(";if(c<0){c=0};if(c>1000){c=1000};<"), call(F.array_join(F.transform("n", lambda x: F.when(x == at("i"), F.lit("c")).otherwise(x)), ";")))),
        "twice": F.when((F.size("params") == 1) & (F.get("params", F.lit(0)) == F.col("ret")), F.concat(F.lit("<"), call(call(F.lit("p0"))))),
    }
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), b.alias("body")) for k, b in body.items()))
    rows = rows.withColumn("_p", params).withColumn("x", F.explode(kinds)).where("x.body is not null")
    name = F.concat("x.kind", F.upper(F.substring("fn", 1, 1)), F.expr("substring(fn, 2)"))
    return rows.select(key, "place", "x.kind", F.concat(F.lit("F="), name, F.lit("("), "_p", F.lit("):"), "ret", F.lit("{"), "x.body", F.lit("};")).alias("wrapper"))
