"""Structured Streaming versions of the running figures. Late rows: the rule of each operator is in its description."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from scenequarry.session import cut

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _timeout(idle_ms: int | None) -> str:
    """Processing-time timeouts make Spark run batches without data, so they are on only when asked for."""
    return GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout


def loss_average_stream(losses: DataFrame, alpha: float, idle_ms: int | None = None) -> DataFrame:
    """EMA per (run_id, camera). Rows at or before the last seen step are dropped; with ``idle_ms`` idle keys give up

    their state."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        ema, last, latest, n = state.get if state.exists else (None, None, None, 0)
        rows = pd.concat(list(batches)).sort_values("step")
        for s, loss in zip(rows["step"].tolist(), rows["loss"].tolist()):
            if last is not None and s <= last:
                continue
            ema = loss if ema is None else alpha * loss + (1 - alpha) * ema
            last, latest, n = s, loss, n + 1
        if last is None:
            return
        state.update((ema, last, latest, n))
        if idle_ms is not None:
            state.setTimeoutDuration(idle_ms)
        yield pd.DataFrame({"run_id": [key[0]], "camera": [key[1]], "ema": [ema], "latest": [latest], "samples": [n], "last_step": [last]})

    return losses.groupBy("run_id", "camera").applyInPandasWithState(
        step, "run_id long, camera long, ema double, latest double, samples long, last_step long",
        "ema double, last long, latest double, n long", "update", _timeout(idle_ms),
    )


def stage_peaks_stream(trace: DataFrame, window: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    """Peaks per stage and window; rows later than the watermark are dropped."""
    return (
        trace.withWatermark("ts", late)
        .groupBy(F.window("ts", window), "stage")
        .agg(F.max("vram_mb").alias("peak_vram_mb"), F.max("ram_mb").alias("peak_ram_mb"), F.count(F.lit(1)).alias("sample_count"))
    )


def run_peaks_stream(trace: DataFrame) -> DataFrame:
    """Whole-run peaks per stage for update mode; the state is one row per stage, so no row is late."""
    return trace.groupBy("stage").agg(F.max("vram_mb").alias("peak_vram_mb"), F.count(F.lit(1)).alias("sample_count"))


def rolling_percentiles_stream(samples: DataFrame, scope: str, last_n: int = 120, idle_ms: int | None = None) -> DataFrame:
    """Linear p50 and p95 of the last ``last_n`` samples per scope in arrival order; the state is that ring and nothing more."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        ring = list(state.get[0]) if state.exists else []
        for pdf in batches:
            ring = (ring + pdf.sort_values("order")["value"].tolist())[-last_n:]
        state.update((ring,))
        if idle_ms is not None:
            state.setTimeoutDuration(idle_ms)
        s = pd.Series(ring)
        yield pd.DataFrame({"scope": [key[0]], "samples": [len(ring)], "p50": [s.quantile(0.5)], "p95": [s.quantile(0.95)]})

    return samples.select(F.col(scope).alias("scope"), "order", "value").groupBy("scope").applyInPandasWithState(
        step, "scope string, samples long, p50 double, p95 double", "ring array<double>", "update", _timeout(idle_ms)
    )


def metrics_log_stream(metrics: DataFrame, log_path: str, checkpoint: str) -> StreamingQuery:
    """Append each batch to the log. The log is partitioned by batch number and a repeated batch overwrites its own

    partition, so a retry adds nothing.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log_path}/batch={number}")

    return metrics.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def best_metrics_stream(metrics: DataFrame) -> DataFrame:
    """Best-so-far row per run for update mode; the state is one row per run."""
    from scenequarry.operators.aggregates import best_metrics

    return best_metrics(metrics)


def resumable_sessions(
    sessions: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, ledger: str | None = None
) -> StreamingQuery:
    """Each session once and for ever: a ledger table beside the checkpoint names the sessions that were handled.

    A batch drops the sessions of the ledger, hands the rest to ``handle`` and then notes them, under the number of the batch,
    so that a batch which is repeated after a failure replaces its own note. Rows may come as late as they like.
    """
    where = ledger or f"{checkpoint}-ledger"

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        todo = batch.dropDuplicates(["session_id"])
        fs = spark._jvm.org.apache.hadoop.fs.Path(where).getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(where)):
            done = spark.read.schema("session_id string, batch long").parquet(where).filter(F.col("batch") != number)
            todo = todo.join(done.select("session_id").distinct(), "session_id", "left_anti")
        todo = cut(todo)
        handle(todo, number)
        todo.select(F.col("session_id").cast("string")).write.mode("overwrite").parquet(f"{where}/batch={number}")

    return sessions.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
