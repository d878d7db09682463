"""Session, shared folder and lineage cuts.

Iterative operators cut their lineage by writing a table into the folder that the session names in
``spark.checkpoint.dir``; every executor can read it again, so a lost executor costs a re-read, not the run.
Where the setting is absent a local temporary folder is used by a local master, and nothing else.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def session(app: str = "confluo", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings all operators assume (UTC, AQE)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    return builder.config(map=settings).getOrCreate()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once a context; they may run without our path."""
    context = spark.sparkContext
    if getattr(context, "_confluo_shipped", False):
        return
    here = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="confluo-")) / "confluo.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(here.rglob("*.py")):
            z.write(source, source.relative_to(here.parent))
    context.addPyFile(str(archive))
    context._confluo_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a local one is set only if the session names none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    held = spark.sparkContext.getCheckpointDir()
    if held:
        return held.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="confluo-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and return a DataFrame that reads it; the files go when the session ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    # the written table replaces the plan, so its shuffle files can go at once; a lost executor re-reads the table
    held = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, held)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def fenced(df: DataFrame) -> DataFrame:
    """The same rows behind a generator of one element: expressions below are computed once a row, as neither projections
    above are merged with them nor filters pushed through. Costs no write and no shuffle."""
    cells = F.explode(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).alias("__row")
    return df.select(cells).select("__row.*")


def discard(df: DataFrame) -> None:
    """Delete the files of a DataFrame made by ``materialize``, once nothing reads it any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    folders = {name.rsplit("/", 1)[0] for name in df.inputFiles()}
    for folder in folders:
        target = jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
