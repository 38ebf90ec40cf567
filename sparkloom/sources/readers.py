"""Readers of record files. All return DataFrames; bad input becomes a counted row, not an error."""

from __future__ import annotations

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt"


def json_tree(spark: SparkSession, folder: str, schema: StructType, required: list[str]) -> DataFrame:
    """One JSON document per file under a folder, at any depth; category is the parent folder. Unreadable documents and
    those without a required field are left out."""
    df = spark.read.schema(schema).option("recursiveFileLookup", True).option("multiLine", True).option("mode", "PERMISSIVE").json(folder)
    out = df.withColumn("category", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+\z", 1))
    for c in required:
        out = out.where(F.col(c).isNotNull())
    return out


def jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines; blank lines vanish, bad ones have their text in _corrupt. Reads .gz as it is."""
    full = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    return spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)


def good_and_bad(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that were read, and the texts of those that weren't."""
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT), df.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """First field of each line; comments (#) and blank lines are skipped, ids are different."""
    line = F.trim(F.regexp_replace("value", r"#.*", ""))
    return spark.read.text(path).select(F.split(line, r"\s+")[0].alias("id")).where("id <> ''").distinct()


def matching(spark: SparkSession, folder: str, pattern: str, schema: StructType) -> DataFrame:
    """JSON documents whose file names match a shell pattern."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).option("multiLine", True).json(folder)


TASK = "source_name string, task_id string, description string, test_cases array<struct<input string, expected_output string>>, difficulty string, function_signature string, solution string"
_CASES = "array<struct<input string, output string>>"
# Fields of the benchmark formats, and the labels that stand for a difficulty.
_FIELDS = {
    "humaneval": "task_id string, prompt string, entry_point string, test string, canonical_solution string",
    "mbpp": "task_id string, text string, code string, test_list array<string>",
    "codecontests": "name string, task_id string, description string, public_tests struct<input array<string>, output array<string>>, difficulty string",
    "taco": f"task_id string, id string, question string, description string, test_cases {_CASES}, difficulty string, solution string",
    "leetcodedataset": f"id string, task_id string, description string, content string, test_cases {_CASES}, difficulty string, function_signature string, solution string",
}
_LABELS = {"introductory": "easy", "interview": "medium", "competition": "hard", "Easy": "easy", "Medium": "medium", "Hard": "hard"}
_PLACES = {"humaneval": "human-eval/data/HumanEval.jsonl.gz", "mbpp": "mbpp/mbpp.jsonl", "apps": "apps/train", "codecontests": "code_contests/data.jsonl", "taco": "TACO/data.jsonl", "leetcodedataset": "leetcode/data.jsonl"}


def _label(c: Column) -> Column:
    return F.coalesce(*(F.when(c == k, F.lit(v)) for k, v in _LABELS.items()), F.when(c != "", c))


def _head(text: Column) -> Column:
    """The first ``def name(..)`` with the type it returns; null where there is none."""
    found = F.regexp_extract(text, r"(?s)(def \w+\(.*?\)(?:\s*->[^:\n]*)?)\s*:", 1)
    return F.when(found != "", F.trim(found))


def _asserted(lines: Column) -> Column:
    return F.transform(lines, lambda x: F.struct(x.alias("input"), F.lit("").alias("expected_output")))


def _json_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of JSON lines or of one JSON array, told by the first character; .gz is read as it is."""
    first = spark.read.text(path).where(F.trim("value") != "").limit(1).collect()
    whole = bool(first) and first[0][0].lstrip().startswith("[")
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").option("multiLine", whole).json(path)


def benchmark(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """Tasks of one benchmark format (humaneval, mbpp, apps, codecontests, taco, leetcodedataset) in the uniform form TASK."""
    none = F.lit(None).cast("string")
    if kind == "apps":
        return _folders(spark, path)
    df = _json_records(spark, path, _FIELDS[kind])
    struct_cases = F.transform("test_cases", lambda x: F.struct(F.coalesce(x["input"], F.lit("")).alias("input"), F.coalesce(x["output"], F.lit("")).alias("expected_output"))) if "test_cases" in df.columns else None
    cols = {
        "humaneval": lambda: ("task_id", "prompt", _asserted(F.filter(F.transform(F.split("test", "\n"), lambda x: F.trim(x)), lambda x: x.startswith("assert"))), none, _head(F.col("prompt")), F.col("canonical_solution")),
        "mbpp": lambda: ("task_id", "text", _asserted(F.col("test_list")), none, _head(F.col("code")), F.when(F.col("code") != "", F.col("code"))),
        "codecontests": lambda: (F.coalesce("name", "task_id"), "description", F.transform(F.arrays_zip(F.col("public_tests.input").alias("i"), F.col("public_tests.output").alias("o")), lambda x: F.struct(x["i"].alias("input"), x["o"].alias("expected_output"))), F.coalesce(F.get_json_object("difficulty", "$.label"), F.when(~F.col("difficulty").startswith("{"), F.col("difficulty"))), none, none),
        "taco": lambda: (F.coalesce("task_id", "id"), F.coalesce("question", "description"), struct_cases, F.col("difficulty"), none, F.col("solution")),
        "leetcodedataset": lambda: (F.coalesce("id", "task_id"), F.coalesce("description", "content"), struct_cases, _label(F.col("difficulty")), F.col("function_signature"), F.col("solution")),
    }[kind]()
    names = ("task_id", "description", "test_cases", "difficulty", "function_signature", "solution")
    out = df.select(F.lit(kind).alias("source_name"), *((F.col(c) if isinstance(c, str) else c).alias(n) for n, c in zip(names, cols)))
    return out.withColumn("description", F.coalesce("description", F.lit(""))).withColumn("test_cases", F.coalesce("test_cases", F.array().cast("array<struct<input string, expected_output string>>")))


def _folders(spark: SparkSession, path: str) -> DataFrame:
    """A benchmark with a folder for each task: question.txt, and where they are input_output, solutions and metadata."""
    def part(name: str, column: str) -> DataFrame:
        df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name).text(path, wholetext=True)
        return df.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+\z", 1).alias("folder"), F.col("value").alias(column))

    df = part("question.txt", "q")
    for name, column in (("metadata.json", "m"), ("input_output.json", "io"), ("solutions.json", "s")):
        df = df.join(part(name, column), "folder", "left")
    io = F.from_json("io", "inputs array<string>, outputs array<string>")
    n = F.least(F.size(io["inputs"]), F.size(io["outputs"]))
    cases = F.transform(F.arrays_zip(F.slice(io["inputs"], F.lit(1), n).alias("i"), F.slice(io["outputs"], F.lit(1), n).alias("o")), lambda x: F.struct(x["i"].alias("input"), x["o"].alias("expected_output")))
    return df.select(
        F.lit("apps").alias("source_name"), F.concat(F.lit("APPS/"), "folder").alias("task_id"), F.trim("q").alias("description"), F.coalesce(cases, F.array().cast("array<struct<input string, expected_output string>>")).alias("test_cases"),
        _label(F.get_json_object("m", "$.difficulty")).alias("difficulty"), F.lit(None).cast("string").alias("function_signature"), F.get(F.from_json("s", "array<string>"), F.lit(0)).alias("solution"),
    )


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def cached(spark: SparkSession, cache: str, name: str) -> str:
    """The path of a benchmark in a cache; raises if it isn't there."""
    path = f"{cache}/{_PLACES[name]}"
    if not exists(spark, path):
        raise FileNotFoundError(f"{name} is not in the cache: {path}")
    return path


def task_union(spark: SparkSession, cache: str, names: list[str] | None = None) -> DataFrame:
    """Tasks of all benchmarks of a cache (those that aren't there are left out) in the uniform form."""
    out = spark.createDataFrame([], TASK)
    for name in names or _PLACES:
        if exists(spark, f"{cache}/{_PLACES[name]}"):
            out = out.unionByName(benchmark(spark, name, f"{cache}/{_PLACES[name]}"))
    return out


def config(spark: SparkSession, path: str) -> dict:
    """A configuration file as a mapping: JSON, or the part of YAML that nests mappings and lists by two blanks. It is read
    whole by the driver: configurations are small."""
    import json

    text = spark.read.text(path, wholetext=True).first()
    return json.loads(text[0]) if text and text[0].lstrip().startswith("{") else parse_yaml(text[0] if text else "")


def _scalar(x: str):
    import json

    x = x.strip()
    if x[:1] in ("'", '"') and x[-1:] == x[:1]:
        return x[1:-1]
    if x.startswith("["):
        return [_scalar(y) for y in x[1:-1].split(",") if y.strip()]
    if x in ("", "~", "null"):
        return None
    try:
        return json.loads(x)
    except ValueError:
        return x


def parse_yaml(text: str):
    """Mappings, lists and scalars by indentation; comments go. No anchors, block scalars or several documents."""
    rows = []
    for raw in text.splitlines():
        line = regex.sub(r"(?:^|\s)#(?=(?:[^\"']|\"[^\"]*\"|'[^']*')*$).*", "", raw).rstrip()
        if line.strip() and line.strip() != "---":
            rows.append((len(line) - len(line.lstrip()), line.strip()))

    def block(i: int, depth: int):
        out: dict | list | None = None
        while i < len(rows) and rows[i][0] >= depth:
            indent, line = rows[i]
            item = line == "-" or line.startswith("- ")
            if out is not None and item != isinstance(out, list):
                break
            if item:
                out = [] if out is None else out
                rest = line[1:].strip()
                if regex.match(r"[^\"'\[][^:]*:(\s|$)", rest):
                    rows[i] = (indent + 2, rest)
                    value, i = block(i, indent + 2)
                elif rest:
                    value, i = _scalar(rest), i + 1
                else:
                    value, i = block(i + 1, indent + 1)
                out.append(value)
            else:
                out = {} if out is None else out
                key, _, rest = line.partition(":")
                if rest.strip():
                    out[_scalar(key)], i = _scalar(rest), i + 1
                else:
                    below = i + 1 < len(rows) and (rows[i + 1][0] > indent or rows[i + 1][0] == indent and rows[i + 1][1].startswith("-"))
                    out[_scalar(key)], i = block(i + 1, rows[i + 1][0]) if below else (None, i + 1)
            if i < len(rows) and rows[i][0] < indent:
                break
        return out, i

    return block(0, 0)[0] or {}


def archived(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """path, text of the wanted members (column path; a small list, broadcast) of tar archives, each streamed once by one task."""
    import io
    import tarfile

    names = {r["path"] for r in wanted.select("path").distinct().collect()}
    shared = spark.sparkContext.broadcast(names)

    def run(batches):
        for pdf in batches:
            for content in pdf["content"]:
                rows = []
                with tarfile.open(fileobj=io.BytesIO(content), mode="r:*") as tar:
                    for m in tar:
                        if m.isfile() and m.name in shared.value:
                            rows.append((m.name, tar.extractfile(m).read().decode("utf-8", "replace")))
                yield pd.DataFrame(rows, columns=["path", "text"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "path string, text string")


# Where a repository says its licence.
LICENSE_FILES = ("LICENSE", "LICENSE.md", "LICENSE.txt", "COPYING", "COPYING.md", "UNLICENSE")


def repository(spark: SparkSession, folder: str, endings: dict[str, str], skip: str = r"/(?:\.git|node_modules|vendor|build|dist|tests?)/") -> DataFrame:
    """path, text, language, license of the source files of repositories (the folders right under one): files with a known
    ending whose path doesn't match skip; license is that of the repository's licence file, else unknown."""
    from ..functions.text import license_class

    base = folder.rstrip("/").split(":", 1)[-1].lstrip("/")
    files = text_files(spark, folder).withColumn("repo", F.regexp_extract("path", rf"{regex.escape(base)}/([^/]+)/", 1))
    name = F.substring_index("path", "/", -1)
    licences = files.where(name.isin(*LICENSE_FILES)).groupBy("repo").agg(F.min_by(license_class(F.col("text")), name).alias("license"))
    language = F.coalesce(*(F.when(F.col("path").endswith(e), F.lit(v)) for e, v in endings.items()))
    sources = files.withColumn("language", language).where(F.col("language").isNotNull() & ~F.col("path").rlike(skip))
    return sources.join(licences, "repo", "left").select("repo", "path", "text", "language", F.coalesce("license", F.lit("unknown")).alias("license"))


def text_files(spark: SparkSession, folder: str, skip: str | None = None) -> DataFrame:
    """path, text of every file under a folder whose path doesn't match the pattern skip."""
    df = spark.read.option("recursiveFileLookup", True).text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return df.where(~F.col("path").rlike(skip)) if skip else df


def flagged_scan(df: DataFrame, flag: str, limit: int | None = None, key: str | None = None, after=None) -> DataFrame:
    """Rows with a true flag, the filter pushed to the source. A page is the first `limit` rows by key behind `after`, the
    last key of the page before."""
    out = df.where(F.col(flag))
    if key is not None:
        out = (out if after is None else out.where(F.col(key) > after)).orderBy(key)
    return out.limit(limit) if limit else out
