"""Run audit and load checkpoints as plain tables.

A run leaves one event when it starts and one when it ends; ``run_log`` folds them into one row per run, which is how a
keyed update of an audit row looks on append-only storage.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators.merge import upsert

RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"


@dataclass
class Run:
    """One execution of a batch process."""

    entity: str
    process_name: str
    batch_id: str | None = None
    read: int = 0
    rejected: int = 0
    written: int = 0
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))

    def event(self, status: str, at: datetime, error: str | None = None) -> tuple:
        """A row of the run event table. A failed run has written nothing."""
        counts = (self.read, self.rejected, 0 if status == FAILED else self.written)
        return (self.run_id, self.batch_id, self.entity, self.process_name, at, status, *counts, error)

    def started(self, at: datetime) -> tuple:
        return (self.run_id, self.batch_id, self.entity, self.process_name, at, RUNNING, self.read, 0, 0, None)

    def summary(self) -> str:
        # Fixed value: the wording of the summary.
        return (
            f"{self.entity}_INCREMENTAL_COMPLETED: {self.run_id} | READ={self.read}"
            f" | REJECTED={self.rejected} | WRITTEN={self.written}"
        )


def events_frame(spark: SparkSession, events: list[tuple]) -> DataFrame:
    return spark.createDataFrame(events, schemas.RUN_EVENTS).coalesce(1)


def run_log(events: DataFrame) -> DataFrame:
    """One row per run with its latest status."""
    ended = F.col("status") != RUNNING
    final = F.struct(ended.alias("ended"), "status", "records_read", "records_rejected", "records_written", "error_message")
    folded = events.groupBy("run_id", "batch_id", "entity", "process_name").agg(
        F.min("event_at").alias("started_at"),
        F.max(F.when(ended, F.col("event_at"))).alias("completed_at"),
        F.max(final).alias("_final"),
    )
    outcome = ("status", "records_read", "records_rejected", "records_written", "error_message")
    return folded.select(
        "run_id", "batch_id", "entity", "process_name", "started_at", "completed_at",
        *(f"_final.{c}" for c in outcome),
    )


def latest_runs(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("started_at"))


def checkpoint(fact: DataFrame, now: Column, batch_id="INITIAL", entity="ALL", process_name="INITIAL_LOAD") -> DataFrame:
    """One checkpoint row with the current size of ``fact``."""
    return fact.agg(F.count(F.lit(1)).alias("records_processed")).select(
        F.lit(batch_id).alias("batch_id"), F.lit(entity).alias("entity"), F.lit(process_name).alias("process_name"),
        "records_processed", now.alias("process_time"), F.lit(SUCCESS).alias("status"),
    )


def upsert_checkpoint(monitoring: DataFrame, row: DataFrame) -> DataFrame:
    """Replace the checkpoint of the same batch, entity and process, or add it."""
    return upsert(monitoring, row, ["batch_id", "entity", "process_name"])
