"""Ingestion, audit and publishing run end to end over the test tables."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit
from ..runtime import shared_dir, table
from ..sources import ingest, sinks, systems

FORM = "yyyy-MM-dd HH:mm:ss"


def _sources(spark: SparkSession, sf_dir: str) -> list[ingest.Source]:
    def extract(system: str):
        return lambda since: systems.raw(spark, sf_dir, system).drop("load_batch_id", "load_timestamp", "source_record_id").withColumn("mark", F.date_format("last_modified_timestamp", FORM))

    def broken(since):
        raise OSError("no such source")

    keys = {s: [c[0] if c[0] != "source_record_id" else c[1]] for s, c in systems.RECORD_ID.items()} | {"PRODUCT_USAGE": ["customer_id"], "LICENSING": ["customer_id"]}
    out = [ingest.Source(s, "rows", extract(s), keys[s], "mark") for s in systems.RAW]
    return [*out, ingest.Source("BROKEN", "rows", broken, ["x"]), ingest.Source("OFF", "rows", broken, ["x"], enabled=False)]


def _ingested(spark: SparkSession, sf_dir: str) -> tuple[ingest.Ingestion, list[ingest.Source]]:
    home = f"{shared_dir(spark)}/ingest-{uuid.uuid4().hex}"
    service = ingest.Ingestion(spark, f"{home}/bronze", ingest.WatermarkStore(spark, f"{home}/marks"), lambda: "2026-01-01 00:00:00", sleep=lambda s: None)
    sources = _sources(spark, sf_dir)
    service.ingest_all(sources, "run-1")
    service.ingest_all(sources, "run-2")
    return service, sources


def ingest_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over all sources: the first loads everything, the second what has no time, as nothing is newer than the mark."""
    service, _ = _ingested(spark, sf_dir)
    n = len(service.results) // 2
    rows = [(f"run-{i // n + 1}", r.system, r.status, r.rows, r.mark, r.attempts, r.error) for i, r in enumerate(service.results)]
    return spark.createDataFrame(rows, "run_id string, source_system string, status string, n bigint, mark string, attempts int, error string")


def watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir)[0].marks.newest().select("source_system", "source_object", "mark")


def bronze_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What both runs left in the bronze tables, and what of it is newer than a mark."""
    service, sources = _ingested(spark, sf_dir)
    parts = []
    for s in sources:
        if s.enabled and s.system != "BROKEN":
            df = spark.read.parquet(service.path(s)).select("source_system", F.col("load_batch_id").cast("string").alias("load_batch_id"), "source_record_id", "mark")
            parts.append(df.groupBy("source_system", "load_batch_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("source_record_id").alias("ids"), F.count_if(F.col("mark") > "2025-03-01").alias("newer")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of three tasks under a clock of five seconds a look, one of them failing."""
    ticks = iter(datetime(2026, 1, 1) + timedelta(seconds=5 * i) for i in range(1000))
    log = audit.AuditLog(spark, lambda: next(ticks))
    for name in ("silver_customer", "customer_clusters", "missing"):
        try:
            with log.run("run-1", "nightly", name) as run:
                if name == "missing":
                    raise ValueError("no table")
                df = table(spark, sf_dir, name)
                run.counts.read = run.counts.inserted = df.count()
                run.step("copy", f"bronze.{name}", f"silver.{name}", run.counts.read, run.counts.inserted, df.select("load_batch_id"))
        except ValueError:
            pass
    t = log.tables()
    steps = t["steps"].select(F.col("target_table").alias("task"), "rows_out", F.substring_index("checksum", ":", -1).alias("hashed"))
    runs = t["runs"].withColumn("target", F.concat(F.lit("silver."), "task"))
    return runs.join(steps.withColumnRenamed("task", "target"), "target", "left").select("task", "status", "duration_s", "rows_processed", "error", "rows_out", "hashed")


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dry run over all data sets, and one really written and read again."""
    sets = {"customers": "set-1", "regions": "set-2"}
    tables = {"customers": table(spark, sf_dir, "customer"), "regions": table(spark, sf_dir, "region")}
    dry = sinks.publish_all(tables, sets, "unused")
    home = f"{shared_dir(spark)}/sets-{uuid.uuid4().hex}"
    done = sinks.publish(tables["regions"], "regions", sets, home, lambda id_, folder: f"{id_}:{spark.read.option('header', True).csv(folder).count()}")
    return spark.createDataFrame([*dry.items(), ("regions-put", done)], "name string, result string")


def script_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last statement of a script with semicolons in literals and comments."""
    table(spark, sf_dir, "nation").createOrReplaceTempView("__nation")
    script = "/* first; */ create or replace temporary view __few as select n_regionkey, ';' as mark from __nation; -- then;\nselect n_regionkey, mark, count(*) as n from __few group by 1, 2;"
    return sinks.run_script(spark, script)[-1]


QUERIES = {"ingest_results": ingest_results, "watermarks": watermarks, "bronze_appended": bronze_appended, "audit_log": audit_log, "published": published, "script_run": script_run}

_RAWS = "(select source_system, source_customer_id id, strftime(last_modified_timestamp, '%Y-%m-%d %H:%M:%S') mark from silver_customer union all select 'IMPARTNER', partner_id, strftime(last_modified_timestamp, '%Y-%m-%d %H:%M:%S') from silver_partner_profile)"

ORACLE = {
    "ingest_results": f"""with r as (select source_system, count(*) n, max(mark) m, count(*) filter (mark is null) late from {_RAWS} group by 1)
select 'run-1' as run_id, source_system, 'SUCCESS' as status, n, m as mark, 1 as attempts, '' as error from r union all select 'run-2', source_system, 'SUCCESS', late, null, 1, '' from r
union all select r, 'BROKEN', 'FAILED', 0, null, 3, 'no such source' from (values ('run-1'), ('run-2')) v(r) union all select r, 'OFF', 'SKIPPED', 0, null, 0, '' from (values ('run-1'), ('run-2')) v(r)""",
    "watermarks": f"select source_system, 'rows' as source_object, max(mark) as mark from {_RAWS} group by 1",
    "bronze_appended": f"select source_system, 'run-1' as load_batch_id, count(*) as n, count(distinct nullif(trim(id), '')) as ids, count(*) filter (mark > '2025-03-01') as newer from {_RAWS} group by 1 union all select source_system, 'run-2', count(*), count(distinct nullif(trim(id), '')), 0 from {_RAWS} where mark is null group by 1",
    "audit_log": "select 'silver_customer' as task, 'SUCCESS' as status, 10.0::double as duration_s, 2 * count(*) as rows_processed, null::varchar as error, count(*) as rows_out, count(*)::varchar as hashed from silver_customer union all select 'customer_clusters', 'SUCCESS', 10.0, 2 * count(*), null, count(*), count(*)::varchar from customer_clusters union all select 'missing', 'FAILED', 5.0, 0, 'ValueError: no table', null, null",
    "published": "select 'customers' as name, 'dry-run:customers' as result union all select 'regions', 'dry-run:regions' union all select 'regions-put', 'set-2:' || count(*) from region",
    "script_run": "select n_regionkey, ';' as mark, count(*) as n from nation group by 1",
}
