"""Groups from pairwise links by hash-to-min.

Every vertex sends its cluster set to the set's least member and that member to all others, until nothing changes.
The sets are kept as rows (lo, hi), lo < hi, one row for a pair however often and in whichever direction it arises,
so no set is ever held in one place; the least member of a vertex comes from a combined aggregation, and vertices
with very many rows get theirs by a broadcast of a size that is bounded by rows / HOT_ROWS.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import discard, materialize

#: Rows of one vertex from which on it doesn't take part in a shuffle join.
HOT_ROWS = 500_000


def record_id(value: Column) -> Column:
    """The form that silver_customer has: upper case, no blanks around; blank is null."""
    return F.nullif(F.upper(F.trim(value)), F.lit(""))


def links_of(predictions: DataFrame, threshold: float = 0.95) -> DataFrame:
    """lo, hi of the pairs that link.

    Of a pair, whatever its direction, the prediction with the latest predicted_at holds (null is earliest; of equal
    times the greater probability), and links from ``threshold`` on. Null or blank ids, pairs of a record with itself
    and null probabilities link nothing.
    """
    left, right = record_id(F.col("left_source_customer_id")), record_id(F.col("right_source_customer_id"))
    pairs = predictions.select(F.least(left, right).alias("lo"), F.greatest(left, right).alias("hi"), left.isNotNull().alias("a"), right.isNotNull().alias("b"), "predicted_at", F.col("match_probability").alias("p"))
    last = pairs.where("a and b and lo < hi").groupBy("lo", "hi").agg(F.max(F.struct("predicted_at", "p"))["p"].alias("p"))
    return last.where(F.col("p") >= threshold).select("lo", "hi")


def _least_member(rows: DataFrame, mins: DataFrame, vertex: str, out: str, hot: DataFrame | None) -> DataFrame:
    """rows with the least member of ``vertex``'s set, which is the vertex itself if no row has it as hi."""
    mins = mins.select(F.col("v").alias(vertex), F.col("m").alias(out))
    if hot is None:
        joined = rows.join(mins, vertex, "left")
    else:
        few = hot.select(F.col("v").alias(vertex), F.lit(True).alias("__hot"))
        marked = rows.join(F.broadcast(few), vertex, "left")  # at most rows / HOT_ROWS
        known = F.broadcast(few.drop("__hot").join(mins, vertex, "left"))
        joined = marked.where("__hot").drop("__hot").join(known, vertex, "left").unionByName(marked.where("__hot is null").drop("__hot").join(mins, vertex, "left"))
    return joined.withColumn(out, F.coalesce(out, vertex))


def _round(rows: DataFrame, hot_rows: int) -> DataFrame:
    mins = rows.groupBy(F.col("hi").alias("v")).agg(F.min("lo").alias("m"))
    sizes = rows.select(F.explode(F.array("lo", "hi")).alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    hot = sizes.where(F.col("n") >= hot_rows).select("v") if rows.count() >= hot_rows else None
    both = _least_member(_least_member(rows, mins, "hi", "m_hi", hot), mins, "lo", "m_lo", hot)
    pair = lambda a, b: F.struct(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
    sent = F.array(pair("m_hi", "lo"), pair("m_hi", "hi"), pair("m_lo", "hi"), pair("m_lo", "lo"))
    return both.select(F.explode(F.array_distinct(sent)).alias("p")).select("p.lo", "p.hi").where("lo < hi").distinct()


def _mark(rows: DataFrame) -> tuple[int, int]:
    r = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], int(r["h"] or 0)


def connected_groups(links: DataFrame, hot_rows: int = HOT_ROWS, max_rounds: int = 60) -> DataFrame:
    """id, group_id for every vertex of ``links`` (lo < hi); group_id is the least id of the group. Empty in, empty out."""
    rows = materialize(links.select("lo", "hi").distinct(), "links")
    before = _mark(rows)
    for _ in range(max_rounds):
        after_rows = materialize(_round(rows, hot_rows), "links")
        after = _mark(after_rows)
        discard(rows)
        rows = after_rows
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("links did not settle")
    return rows.select(F.col("hi").alias("id"), F.col("lo").alias("group_id")).unionByName(rows.select(F.col("lo").alias("id"), F.col("lo").alias("group_id")).distinct())


def prediction_groups(predictions: DataFrame, threshold: float = 0.95) -> DataFrame:
    """source_customer_id, cluster_id of every record in a group of two or more."""
    groups = connected_groups(links_of(predictions, threshold))
    return groups.select(F.col("id").alias("source_customer_id"), F.col("group_id").alias("cluster_id"))
