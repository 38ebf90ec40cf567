"""Names of tasks in a freely written task_id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dashes of Unicode, the underscore and spaces that may stand between the parts of a name.
DASHES = "‐‑‒–—―−﹘﹣－_"
SPACES = "   　"
NAME = r"(?i)(?<![a-z0-9])([a-d])[\s\-]+([a-z]{3})[\s\-]+0*([0-9]+)(?:\s*v0*([0-9]+))?(?![a-z0-9])"


def named_tasks(task_id: Column) -> Column:
    """Array of struct(task, version) of every name in a task_id, in its order.

    task is written like ``A-ARR-0056``, version is the number as a string or empty. Null and
    texts without a name give an empty array.
    """
    plain = F.translate(F.coalesce(task_id, F.lit("")), DASHES + SPACES, "-" * len(DASHES) + " " * len(SPACES))
    found = F.regexp_extract_all(plain, F.lit(NAME), F.lit(0))

    def one(x):
        n = F.regexp_extract(x, NAME, 3)
        return F.struct(
            F.concat_ws("-", F.upper(F.regexp_extract(x, NAME, 1)), F.upper(F.regexp_extract(x, NAME, 2)), F.when(F.length(n) < 4, F.lpad(n, 4, "0")).otherwise(n)).alias("task"),
            F.regexp_extract(x, NAME, 4).alias("version"),
        )

    return F.transform(found, one)


def task_names(task_id: Column) -> Column:
    """Sorted different names of tasks in a task_id."""
    return F.array_sort(F.array_distinct(F.transform(named_tasks(task_id), lambda x: x["task"])))
