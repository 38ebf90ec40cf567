"""Writers of record tables. Appends are idempotent by key; manifests never change once written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import stored


def _fs(spark, path: str):
    """File system of a path, and the class of its paths."""
    hp = spark._jvm.org.apache.hadoop.fs.Path
    return hp(path).getFileSystem(spark._jsc.hadoopConfiguration()), hp


def append_new(df: DataFrame, path: str, key: str, held_out: DataFrame | None = None, by: list[str] | None = None) -> DataFrame:
    """Appends the rows whose key is neither in the table nor held out (column id), partitioned; returns what was written.

    Raises if a column of the table is missing or of another type, and if another append to it is under way (a lock file
    beside the table, which an append that dies leaves behind); a table that can't be read is an error, never an empty one.
    """
    spark = df.sparkSession
    fs, hp = _fs(spark, path)
    lock = hp(path.rstrip("/") + ".lock")
    fs.create(lock, False).close()
    try:
        new = df.dropDuplicates([key])
        if held_out is not None:
            new = new.join(held_out.select(F.col("id").alias(key)), key, "left_anti")
        if fs.exists(hp(path)):
            old = spark.read.parquet(path)
            kinds = {f.name: f.dataType for f in old.schema}
            wrong = [f.name for f in df.schema if f.name not in (by or []) and kinds.get(f.name) != f.dataType] + [c for c in kinds if c not in df.columns]
            if wrong:
                raise ValueError(f"columns that don't agree with the table: {sorted(wrong)}")
            new = new.join(old.select(F.col(key).cast(df.schema[key].dataType)), key, "left_anti")
        new = stored(new)
        new.write.mode("append").partitionBy(*(by or [])).parquet(path)
        return new
    finally:
        fs.delete(lock, False)


def two_ways(df: DataFrame, reason: str, accepted: str, rejected: str) -> DataFrame:
    """Writes rows without a reason and rows with one to two tables; returns counts by reason."""
    df = df.persist()
    try:
        df.where(F.col(reason).isNull()).drop(reason).write.mode("overwrite").parquet(accepted)
        df.where(F.col(reason).isNotNull()).write.mode("overwrite").parquet(rejected)
        counts = df.groupBy(F.coalesce(reason, F.lit("pass")).alias("reason")).agg(F.count("*").alias("n_rows"))
        return counts.sparkSession.createDataFrame(counts.collect(), counts.schema)
    finally:
        df.unpersist()


def manifest(df: DataFrame, path: str) -> None:
    """Writes a manifest in order, one file for each partition of the session; fails if it exists."""
    df.write.mode("errorifexists").json(path)


def recover(spark, path: str) -> None:
    """Ends an upsert that died between its two renames: without a table, the complete new one takes its place, else the old one."""
    fs, hp = _fs(spark, path)
    if not fs.exists(hp(path)):
        for other in (".new", ".old"):
            if fs.exists(hp(path + other)) and (other == ".old" or fs.exists(hp(path + other + "/_SUCCESS"))):
                fs.rename(hp(path + other), hp(path))
                break


def upsert(df: DataFrame, path: str, key: str, order: str) -> None:
    """Replaces the table at path by the last row of each key in old and new rows.

    The new files are complete before the old ones move; the old ones go only when the new ones stand at path. A crash
    at any point leaves a whole table at path, or beside it, where the next upsert or recover() finds it.
    """
    from ..operators.ranks import last_by

    spark = df.sparkSession
    recover(spark, path)
    fs, hp = _fs(spark, path)
    there = fs.exists(hp(path))
    rows = spark.read.parquet(path).unionByName(df) if there else df
    last_by(rows, [key], F.col(order)).select(*df.columns).write.mode("overwrite").parquet(path + ".new")
    if there:
        fs.delete(hp(path + ".old"), True)
        if not fs.rename(hp(path), hp(path + ".old")):
            raise OSError(f"{path} could not be moved")
    if not fs.rename(hp(path + ".new"), hp(path)):
        raise OSError(f"{path}.new could not be moved")
    fs.delete(hp(path + ".old"), True)


def jsonl(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    df.write.mode("overwrite").partitionBy(*(by or [])).json(path)


def lines(df: DataFrame, path: str, text: str, times: str | None = None) -> None:
    """One row per line; times names a column of how often each is repeated."""
    out = df if times is None else df.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col(times))))
    out.select(F.regexp_replace(F.col(text), r"[\r\n]+", " ").alias("value")).write.mode("overwrite").text(path)


def markdown(df: DataFrame, title: str, rows: int = 1000) -> str:
    """A small report table as Markdown; raises above `rows` rows rather than cutting them."""
    got = df.limit(rows + 1).collect()
    if len(got) > rows:
        raise ValueError(f"a report of more than {rows} rows")
    head = "| " + " | ".join(df.columns) + " |\n|" + "---|" * len(df.columns)
    return f"# {title}\n\n{head}\n" + "".join("| " + " | ".join("" if x is None else str(x) for x in r) + " |\n" for r in got)


def frozen(df: DataFrame, path: str, key: str) -> str:
    """Writes a snapshot that is never written again and returns the hash of its keys (operators.aggregates.bucket_hash),
    which stands beside it in a file of its own."""
    from ..operators.aggregates import bucket_hash

    df.write.mode("errorifexists").parquet(path)
    one = bucket_hash(df.sparkSession.read.parquet(path).withColumn("_g", F.lit(0)), ["_g"], key)
    row = one.select("n_ids", "ids_hash").first()
    digest = row["ids_hash"] if row else ""
    one.select("n_ids", "ids_hash").write.mode("errorifexists").json(path.rstrip("/") + ".hash")
    return digest


def phased(df: DataFrame, path: str, by: str) -> None:
    """JSON lines by phase, and a small table of statistics beside them."""
    jsonl(df, path, [by])
    df.groupBy(by).agg(F.count("*").alias("n_rows")).write.mode("overwrite").json(path.rstrip("/") + ".stats")


def rewritten(spark, path: str, field: str, rules) -> DataFrame:
    """Rewrites a text field of JSON lines by rules (functions.rewrite), string literals left alone; the files as they were stay
    beside the new ones as ``.bak``. Returns rule, n_rows. Raises if there is a backup already."""
    from ..functions.rewrite import rewritten as by_rules

    fs, hp = _fs(spark, path)
    if fs.exists(hp(path + ".bak")):
        raise FileExistsError(path + ".bak")
    old = spark.read.json(path)
    new = stored(by_rules(old, field, rules, "_text", "_fixes"))
    out = new.withColumn(field, F.col("_text")).select(*old.columns)
    out.write.mode("overwrite").json(path + ".new")
    if not (fs.rename(hp(path), hp(path + ".bak")) and fs.rename(hp(path + ".new"), hp(path))):
        raise OSError(f"{path} could not be moved")
    return new.select(F.explode("_fixes").alias("rule")).groupBy("rule").agg(F.count("*").alias("n_rows"))
