"""Queries of the general training-data operators: p6 (column profile) and p7 (history)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import history, profile
from ..runtime import materialize, table

PROFILED = ("email", "phone", "industry")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.departing_loads(table(spark, sf_dir, "silver_customer"), PROFILED)
    return found.selectExpr("load as load_batch_id", "column_name").distinct()


def p6_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = profile.column_profile(table(spark, sf_dir, "silver_customer"), PROFILED)
    return out.withColumnsRenamed({"source": "source_system", "load": "load_batch_id"})


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log as one batch, merged into a dimension without versions."""
    log = table(spark, sf_dir, "silver_customer_change_history")
    return history.as_text(history.merge_dimension(history.empty_dimension(log), log.where(F.lit(False)), log))


def p7_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history from two merges: the captures of the first half of the time of capture, then the rest, late ones among them."""
    log = table(spark, sf_dir, "silver_customer_change_history")
    half = log.agg(F.timestamp_micros(F.avg(F.unix_micros(F.col("captured_at").cast("timestamp"))).cast("bigint")).cast("timestamp_ntz").alias("half"))
    marked = log.crossJoin(F.broadcast(half))  # one row
    early = materialize(marked.where("captured_at <= half or half is null").drop("half"), "early")
    dimension = materialize(history.merge_dimension(history.empty_dimension(log), early.where(F.lit(False)), early), "dimension")
    return history.as_text(history.merge_dimension(dimension, early, marked.where("captured_at > half or (captured_at is null and half is not null)").drop("half")))


QUERIES = {"p6_found": p6_found, "p6_profile": p6_profile, "p7_found": p7_found, "p7_batches": p7_batches}

ORACLE = {
    "p7_found": """
with ranked as (
  select *, row_number() over (partition by source_system, source_customer_id, effective_from
    order by captured_at desc nulls last, (upper(trim(change_type)) = 'DELETE') desc, current_record_hash desc nulls last) rn
  from silver_customer_change_history where effective_from is not null),
held as (select source_system, source_customer_id, effective_from, coalesce(upper(trim(change_type)) = 'DELETE', false) gone, current_record_hash h from ranked where rn = 1),
compared as (select *, lag(gone) over w pg, lag(h) over w ph from held window w as (partition by source_system, source_customer_id order by effective_from)),
turns as (select * from compared where (not gone and (pg is null or pg or ph is distinct from h)) or (gone and not coalesce(pg, true))),
ended as (select *, lead(effective_from) over (partition by source_system, source_customer_id order by effective_from) upto from turns)
select source_system, source_customer_id, strftime(effective_from, '%Y-%m-%d %H:%M:%S') as effective_from,
  coalesce(strftime(upto, '%Y-%m-%d %H:%M:%S'), 'open') as effective_to, h as current_record_hash
from ended where not gone
""",
}
ORACLE["p7_batches"] = ORACLE["p7_found"]
