"""What leaves the lake: CSV sets for dashboards, tables, scripts."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..operators.history import upsert
from ..runtime import materialize

_PIECE = re.compile(r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|--[^\n]*|/\*.*?\*/|;", re.S)


def csv_set(df: DataFrame, path: str) -> None:
    """A dashboard's data set: one CSV file with a header. Such sets are aggregates; a table of any size keeps its own files."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def csv_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def publish(df: DataFrame, name: str, sets: Mapping[str, str], folder: str, put: Callable[[str, str], str] | None = None) -> str:
    """Write a data set and hand its folder to ``put`` (data set id, folder), which uploads it; without ``put`` a dry run.

    A name without an id in ``sets`` is an error.
    """
    if not sets.get(name):
        raise KeyError(f"no data set id for {name!r}")
    if put is None:
        return f"dry-run:{name}"
    csv_set(df, f"{folder}/{name}")
    return put(sets[name], f"{folder}/{name}")


def publish_all(tables: Mapping[str, DataFrame], sets: Mapping[str, str], folder: str, put: Callable[[str, str], str] | None = None) -> dict[str, str]:
    """All data sets in turn; the first error ends it, and nothing is published for a name without an id."""
    missing = sorted(n for n in tables if not sets.get(n))
    if missing:
        raise KeyError(f"no data set id for {', '.join(missing)}")
    return {n: publish(df, n, sets, folder, put) for n, df in tables.items()}


def statements(script: str) -> list[str]:
    """The statements of a script: a semicolon ends one, but not in a literal, a quoted name or a comment."""
    out, begin = [], 0
    for m in _PIECE.finditer(script):
        if m.group() == ";":
            out.append(script[begin : m.start()])
            begin = m.end()
    bare = lambda s: _PIECE.sub(lambda m: "" if m.group()[:2] in ("--", "/*") else m.group(), s).strip()
    return [s.strip() for s in [*out, script[begin:]] if bare(s)]


def run_script(spark: SparkSession, script: str) -> list[DataFrame]:
    return [spark.sql(s) for s in statements(script)]


def materialise(df: DataFrame, path: str, mode: str = "table", keys: Sequence[str] = (), hash_column: str | None = None) -> DataFrame:
    """``table``: replace the table. ``incremental``: merge into it by keys. The new version is written beside the old one and
    named by the returned DataFrame, so a reader of the old version is not disturbed and a failed write leaves it whole."""
    label = path.rstrip("/").rsplit("/", 1)[-1]
    if mode == "table":
        return materialize(df, label)
    try:
        old = df.sparkSession.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return materialize(df, label)
    return materialize(upsert(old, df, list(keys), hash_column), label)
