"""Who ran what: pipeline runs, their steps with row counts and checksums, lineage, as rows of appended tables."""

from __future__ import annotations

import json
import traceback
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUNS = "run_id string, pipeline string, task string, status string, started_at string, ended_at string, duration_s double, rows_read bigint, rows_inserted bigint, rows_updated bigint, rows_deleted bigint, rows_processed bigint, error string, details string"
STEPS = "run_id string, step string, source_table string, target_table string, rows_in bigint, rows_out bigint, checksum string, status string, at string, details string"
LINEAGE = "run_id string, source_table string, target_table string, transformation string, at string"


def checksum(df: DataFrame) -> str:
    """The same for the same rows in any order, at any size: hashes of whole rows added up, and their number."""
    row = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    part = F.conv(F.substring(F.sha2(row, 256), 1, 15), 16, 10).cast("decimal(38,0)")
    got = df.agg(F.sum(part).cast("string").alias("s"), F.count(F.lit(1)).alias("n")).first()
    return f"{got['s'] or 0}:{got['n']}"


@dataclass
class Counts:
    read: int = 0
    inserted: int = 0
    updated: int = 0
    deleted: int = 0

    @property
    def processed(self) -> int:
        return self.read + self.inserted + self.updated + self.deleted


@dataclass
class AuditLog:
    """Rows held by the driver (a few a run) until ``flush`` appends them to ``folder``/runs, steps and lineage."""

    spark: SparkSession
    clock: Callable[[], datetime]
    folder: str | None = None
    runs: list[tuple] = field(default_factory=list)
    steps: list[tuple] = field(default_factory=list)
    lineage: list[tuple] = field(default_factory=list)

    def run(self, run_id: str, pipeline: str, task: str) -> Run:
        return Run(self, run_id, pipeline, task)

    def tables(self) -> dict[str, DataFrame]:
        return {n: self.spark.createDataFrame(rows, schema) for n, rows, schema in (("runs", self.runs, RUNS), ("steps", self.steps, STEPS), ("lineage", self.lineage, LINEAGE))}

    def flush(self) -> None:
        for name, df in self.tables().items():
            if self.folder and getattr(self, name):
                df.coalesce(1).write.mode("append").parquet(f"{self.folder}/{name}")
        self.runs, self.steps, self.lineage = [], [], []


class Run:
    """``with log.run(...) as r``: SUCCESS or FAILED with its duration, counts and error; an error is passed on."""

    def __init__(self, log: AuditLog, run_id: str, pipeline: str, task: str) -> None:
        self.log, self.run_id, self.pipeline, self.task = log, run_id, pipeline, task
        self.counts, self.details = Counts(), {}

    def __enter__(self) -> Run:
        self.started = self.log.clock()
        return self

    def step(self, name: str, source: str, target: str, rows_in: int, rows_out: int, result: DataFrame | None = None, **details) -> None:
        at = self.log.clock().isoformat()
        self.log.steps.append((self.run_id, name, source, target, rows_in, rows_out, checksum(result) if result is not None else None, "SUCCESS", at, json.dumps(details, sort_keys=True)))
        self.log.lineage.append((self.run_id, source, target, name, at))

    def __exit__(self, kind, error, trace) -> bool:
        ended = self.log.clock()
        text = "".join(traceback.format_exception_only(kind, error)).strip() if kind else None
        c = asdict(self.counts)
        self.log.runs.append((self.run_id, self.pipeline, self.task, "FAILED" if kind else "SUCCESS", self.started.isoformat(), ended.isoformat(), (ended - self.started).total_seconds(), c["read"], c["inserted"], c["updated"], c["deleted"], self.counts.processed, text, json.dumps(self.details, sort_keys=True)))
        return False
