"""Streaming forms of ledgers, counters and rolling failure states."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery


def read(spark: SparkSession, folder: str, schema, files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def first_by_key(stream: DataFrame, key: str, time: str, late: str) -> DataFrame:
    """Each key once, though delivered again within `late`; rows without a time are dropped by the watermark's rule."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def windowed(stream: DataFrame, time: str, by: list[str], late: str, size: str, slide: str | None = None, value: str | None = None) -> DataFrame:
    """Counts (and sums) per event-time window; rows later than `late` are left out."""
    w = F.window(time, size, slide) if slide else F.window(time, size)
    aggs = [F.count("*").alias("n")] + ([F.sum(value).alias("total")] if value else [])
    return stream.withWatermark(time, late).groupBy(w, *by).agg(*aggs)


def sessions(stream: DataFrame, time: str, by: list[str], late: str, gap: str) -> DataFrame:
    return stream.withWatermark(time, late).groupBy(F.session_window(time, gap), *by).agg(F.count("*").alias("n"))


def run_once(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """All that is there now in micro-batches, each handed to the sink; a restart goes on after the last batch."""
    q = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start()
    q.awaitTermination()
    return q


SPENT = "the budget is spent"


def run_within(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, cost: str, budget: float) -> bool:
    """Micro-batches until their cost (a column) reaches the budget; True if all that is there now was done.

    The batch that comes after is refused before it is handed on, so it isn't committed: the next run begins with it.
    """
    from pyspark.errors import StreamingQueryException

    spent = 0.0

    def put(batch: DataFrame, number: int) -> None:
        nonlocal spent
        if spent >= budget:
            raise RuntimeError(SPENT)
        sink(batch, number)
        spent += batch.agg(F.sum(cost)).first()[0] or 0.0

    try:
        run_once(df, put, checkpoint)
    except StreamingQueryException as e:
        if SPENT not in str(e):
            raise
        return False
    return True


def append_sink(path: str) -> Callable[[DataFrame, int], None]:
    """A batch written again after a failure replaces itself: its number is its folder."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return put


def rolling_failures(stream: DataFrame, key: str, failed: str, size: int = 100, limit: float = 0.5, order: str | None = None) -> DataFrame:
    """Per key, after each batch: rows seen, failure rate of the last `size` outcomes (null before so many) and whether it
    exceeds the limit. Rows of a batch count in the order given, else as they come. The state holds `size` flags per key;
    of a batch, a key's last `size` rows are held."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, flags = state.get if state.exists else (0, "")
        last = None
        for pdf in batches:
            seen += len(pdf)
            last = pdf if last is None else pd.concat([last, pdf])
            last = (last.sort_values(order) if order else last).tail(size)
        if last is not None:
            flags = (flags + "".join("1" if x else "0" for x in last[failed]))[-size:]
        state.update((seen, flags))
        rate = flags.count("1") / size if seen >= size else None
        yield pd.DataFrame({key: [k[0]], "seen": [seen], "rate": [rate], "over": [rate is not None and rate > limit]})

    kind = stream.schema[key].dataType.simpleString()
    return stream.select(key, failed, *([order] if order else [])).groupBy(key).applyInPandasWithState(step, f"{key} {kind}, seen long, rate double, over boolean", "seen long, flags string", "update", GroupStateTimeout.NoTimeout)
