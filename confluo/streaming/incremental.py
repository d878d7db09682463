"""New files of a folder into a table, exactly once: the stream's checkpoint takes the place of a mark registry.

The table is kept in buckets of its keys. A batch rewrites the buckets it touches and no others, and a manifest names the
folder of each bucket's newest version; a batch that is repeated after a failure starts from the manifest before its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.history import latest_by

MANIFEST = "bucket int, version bigint"


def _path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _manifests(spark: SparkSession, target: str) -> list[int]:
    fs, folder = _path(spark, f"{target}/manifest")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    done = [n for n in names if n.startswith("n=") and fs.exists(_path(spark, f"{target}/manifest/{n}/_SUCCESS")[1])]
    return sorted(int(n[2:]) for n in done)


def _versions(spark: SparkSession, target: str, before: int | None = None) -> dict[int, int]:
    """bucket -> version by the newest manifest (before a batch): at most as many entries as there are buckets."""
    known = [n for n in _manifests(spark, target) if before is None or n < before]
    return {r["bucket"]: r["version"] for r in spark.read.schema(MANIFEST).json(f"{target}/manifest/n={known[-1]}").collect()} if known else {}


def read_table(spark: SparkSession, target: str) -> DataFrame:
    """The table as of the last whole batch."""
    held = _versions(spark, target)
    return spark.read.parquet(*[f"{target}/v={v}/bucket={b}" for b, v in sorted(held.items())])


def upsert_new_files(spark: SparkSession, folder: str, schema: str, target: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], buckets: int = 64) -> None:
    """Process what is new and stop. Of a key the row that is latest by ``order`` stays, whichever file or batch it came in, so a
    late row never replaces a newer one; rows that are equal by it are one row."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        held = _versions(spark, target, number)
        rows = latest_by(batch, list(keys), [F.col(c) for c in order]).withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).persist()
        touched = [r["bucket"] for r in rows.select("bucket").distinct().collect()]
        old = [f"{target}/v={held[b]}/bucket={b}" for b in touched if b in held]
        merged = rows
        if old:
            before = spark.read.parquet(*old).withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).select(*rows.columns)
            merged = latest_by(before.unionByName(rows), [*keys, "bucket"], [F.col(c) for c in order])
        merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/v={number}")
        now = held | dict.fromkeys(touched, number)
        spark.createDataFrame(sorted(now.items()), MANIFEST).coalesce(1).write.mode("overwrite").json(f"{target}/manifest/n={number}")
        rows.unpersist()
        # what the manifest before this one had replaced: the versions of this one and of the one before stay
        older = [n for n in _manifests(spark, target) if n < number][:-1]
        for b, v in _versions(spark, target, older[-1] + 1).items() if older else ():
            if v not in (held.get(b), now.get(b)):
                fs, path = _path(spark, f"{target}/v={v}/bucket={b}")
                fs.delete(path, True)

    stream = spark.readStream.schema(schema).parquet(folder)
    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
