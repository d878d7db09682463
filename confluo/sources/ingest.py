"""Ingestion: extract, mark rows, append to bronze, move the mark; one result a source.

An extract is a function from the stored mark to a DataFrame of new rows. It is called anew for each attempt, so a failure in
the middle never passes for the end of the data, and the mark moves only after the rows are written.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.history import latest_by
from . import files

MARKS = "source_system string, source_object string, mark string, updated_at string, is_active boolean"


class WatermarkStore:
    """Marks by system and object in an append-only Parquet table; the newest active row of each counts."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(MARKS).parquet(self.path)
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" in str(e):
                return self.spark.createDataFrame([], MARKS)
            raise

    def newest(self) -> DataFrame:
        """One row a system and object."""
        return latest_by(self._rows().where("is_active"), ["source_system", "source_object"], [F.col("updated_at"), F.col("mark")])

    def get(self, system: str, object_: str) -> str | None:
        found = self.newest().where((F.col("source_system") == system) & (F.col("source_object") == object_)).select("mark").first()
        return found["mark"] if found else None

    def save(self, system: str, object_: str, mark: str, at: str) -> None:
        if not (mark or "").strip():
            raise ValueError("an empty mark can't be saved")
        self.spark.createDataFrame([(system, object_, mark, at, True)], MARKS).coalesce(1).write.mode("append").parquet(self.path)


def retried(call: Callable, attempts: int = 3, first_wait: float = 1.0, longest_wait: float = 30.0, retryable: tuple[type[BaseException], ...] = (OSError, TimeoutError), sleep: Callable[[float], None] = time.sleep):
    """The call's result; errors that may pass are tried again after twice the wait each time. The last error is raised."""
    for n in range(1, max(attempts, 1) + 1):
        try:
            return call()
        except retryable:
            if n >= attempts:
                raise
            sleep(min(first_wait * 2 ** (n - 1), longest_wait))


@dataclass
class Source:
    system: str
    object: str
    extract: Callable[[str | None], DataFrame]
    key: Sequence[str]
    mark_column: str | None = None
    enabled: bool = True


@dataclass
class Result:
    system: str
    object: str
    status: str
    rows: int = 0
    mark: str | None = None
    attempts: int = 0
    error: str = ""


@dataclass
class Ingestion:
    """``bronze``: folder of the bronze tables; ``clock``: the time as text."""

    spark: SparkSession
    bronze: str
    marks: WatermarkStore
    clock: Callable[[], str]
    attempts: int = 3
    sleep: Callable[[float], None] = time.sleep
    results: list[Result] = field(default_factory=list)

    def path(self, source: Source) -> str:
        return f"{self.bronze}/{source.system.lower()}/{source.object}"

    def ingest(self, source: Source, run_id: str, raise_on_error: bool = True) -> Result:
        """SUCCESS, SKIPPED (disabled), or FAILED with the error. Rows and mark come from one pass over what was written."""
        result = Result(source.system, source.object, "SKIPPED")
        if source.enabled:
            since = self.marks.get(source.system, source.object)

            def attempt() -> tuple[int, str | None]:
                result.attempts += 1
                rows = source.extract(since)
                if source.mark_column:
                    rows = rows.where(files.newer_than(source.mark_column, since))
                # one folder a run: a repeated attempt overwrites its own rows
                out = f"{self.path(source)}/load_batch_id={run_id}"
                files.bronze(rows, source.system, source.object, list(source.key), run_id, F.lit(self.clock())).drop("load_batch_id").write.mode("overwrite").parquet(out)
                written = self.spark.read.parquet(out)
                mark = files.mark_of(written, source.mark_column) if source.mark_column else F.lit(None).cast("string")
                got = written.agg(F.count(F.lit(1)).alias("n"), mark.alias("mark")).first()
                return got["n"], got["mark"]

            try:
                result.rows, result.mark = retried(attempt, self.attempts, sleep=self.sleep)
                if result.mark is not None:
                    self.marks.save(source.system, source.object, result.mark, self.clock())
                result.status = "SUCCESS"
            except Exception as e:
                result.status, result.error = "FAILED", str(e)
                if raise_on_error:
                    raise
        self.results.append(result)
        return result

    def ingest_all(self, sources: Sequence[Source], run_id: str) -> list[Result]:
        """All sources in turn; one that fails doesn't stop the others."""
        return [self.ingest(s, run_id, raise_on_error=False) for s in sources]

    def since(self, source: Source, mark_column: str, mark: str | None) -> DataFrame:
        """The rows of a bronze table after a mark."""
        return self.spark.read.parquet(self.path(source)).where(files.newer_than(mark_column, mark))
