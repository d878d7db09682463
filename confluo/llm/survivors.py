"""The surviving value of each field of a group of duplicate records, and which values are current.

``survivors`` takes the preferred valid value by a stated order. ``current_values`` reasons about currency: rows of one
record at different times tell which value replaced which; those precedences order the values within each group, and
the values that none in the group replaces are the latest ones, also where rows have no timestamp.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.history import latest_by
from ..runtime import discard, materialize

#: Texts that stand in for a missing value (compared in lower case without blanks around).
STAND_INS = ("null", "tbd", "xxx", "x", "-", "--", ".", "?", "test", "not provided", "none", "n/a", "na", "unknown", "noemail", "no-reply", "@", "0")
FIELDS = ("company_name", "email", "phone", "address")


def says_something(value: Column) -> Column:
    text = F.lower(F.trim(value))
    return value.isNotNull() & (text != "") & ~text.isin(*STAND_INS)


def counts(field: str, value: Column) -> Column:
    """Whether a value of the field can survive."""
    ok = says_something(value)
    if field == "email":
        ok = ok & F.trim(value).rlike(r"^[^@\s]*@[^@\s]*\.[^@\s]*$")
    if field == "phone":
        digits = F.regexp_replace(value, "[^0-9]", "")
        ok = ok & (F.length(digits) >= 7) & ~digits.rlike(r"^(.)\1*$")
    return F.coalesce(ok, F.lit(False))


def counting_rows(records: DataFrame) -> DataFrame:
    """The row of each record that counts: latest last_modified_timestamp, then latest standardized_at (null is earliest)."""
    return latest_by(records, ["source_customer_id"], [F.col("last_modified_timestamp"), F.col("standardized_at")])


def survivors(members: DataFrame, records: DataFrame, fields: Sequence[str] = FIELDS, id_column: str = "source_customer_id") -> DataFrame:
    """cluster_id, field_name, source_customer_id, value.

    Members: rows with is_current, repeated rows count once; records are taken by their counting row, deleted ones
    give nothing. Preferred: lowest source_priority, highest data_quality_score, highest completeness_score, latest
    last_modified_timestamp (null last in each), smallest id. No row where no value counts. Null cluster or id: no
    member. All fields come from one combined aggregation, so a huge cluster is never gathered.
    """
    needed = ["source_customer_id", "source_priority", "data_quality_score", "completeness_score", "last_modified_timestamp", "standardized_at", "is_deleted", *fields]
    inside = members.where("is_current and cluster_id is not null and source_customer_id is not null").select("cluster_id", "source_customer_id").distinct()
    wanted = records.select(*needed).join(inside.select("source_customer_id").distinct(), "source_customer_id", "left_semi")
    rows = counting_rows(wanted).where("not coalesce(is_deleted, false)")
    joined = inside.join(rows, "source_customer_id")
    last = lambda c, down=False: (F.col(c).isNull().alias(f"n_{c}"), (-F.col(c) if down else F.col(c)).alias(f"o_{c}"))
    late = F.col("last_modified_timestamp")
    order = [*last("source_priority"), *last("data_quality_score", True), *last("completeness_score", True), late.isNull().alias("n_t"), (-F.unix_micros(late.cast("timestamp"))).alias("o_t"), F.col("source_customer_id").alias("id")]
    best = [F.min(F.when(counts(f, F.col(f)), F.struct(*order, F.col(f).alias("value")))).alias(f) for f in fields]
    wide = joined.groupBy("cluster_id").agg(*best)
    long = wide.select("cluster_id", F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).getField("id").alias("source_customer_id"), F.col(f).getField("value").alias("value")) for f in fields])).alias("s"))
    return long.select("cluster_id", "s.*").where("source_customer_id is not null")


def _normal(field: str) -> Column:
    return F.lower(F.regexp_replace(F.trim(field), r"\s+", " "))


def _cells(rows: DataFrame, keep: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """keep, field_name, v of every counting value."""
    cells = F.array(*[F.struct(F.lit(f).alias("field_name"), F.when(counts(f, F.col(f)), _normal(f)).alias("v")) for f in fields])
    return rows.select(*keep, F.explode(cells).alias("p")).select(*keep, "p.field_name", "p.v").where("v is not null")


def value_transitions(records: DataFrame, fields: Sequence[str] = FIELDS) -> DataFrame:
    """field_name, older, newer, support: value changes between consecutive timestamped rows of a record.

    support is how much more often older -> newer was seen than newer -> older; only positive ones are kept, so no two
    values precede each other. Values are compared in lower case without blanks around.
    """
    timed = ["source_customer_id", "last_modified_timestamp", "standardized_at"]
    flat = _cells(records.where("last_modified_timestamp is not null").select(*timed, *fields), timed, fields)
    # one row per record, field and time: repeated rows fall together before the window
    flat = flat.groupBy("source_customer_id", "field_name", "last_modified_timestamp").agg(F.max(F.struct("standardized_at", "v"))["v"].alias("newer"))
    over = Window.partitionBy("source_customer_id", "field_name").orderBy("last_modified_timestamp")
    steps = flat.withColumn("older", F.lag("newer").over(over)).where("older is not null and older <> newer")
    forward = F.when(F.col("older") < F.col("newer"), 1).otherwise(-1)
    net = steps.groupBy("field_name", F.least("older", "newer").alias("a"), F.greatest("older", "newer").alias("b")).agg(F.sum(forward).alias("s")).where("s <> 0")
    return net.select("field_name", F.when(F.col("s") > 0, F.col("a")).otherwise(F.col("b")).alias("older"), F.when(F.col("s") > 0, F.col("b")).otherwise(F.col("a")).alias("newer"), F.abs("s").cast("bigint").alias("support"))


def _closure(edges: DataFrame, max_rounds: int = 20) -> DataFrame:
    """group, field_name, older, newer for every way along the edges of a group; each round doubles the length of the ways."""
    key = ["cluster_id", "field_name"]
    ways = materialize(edges.select(*key, "older", "newer").distinct(), "ways")
    n = ways.count()
    for _ in range(max_rounds):
        on = ways.select(*key, F.col("older").alias("newer"), F.col("newer").alias("far"))
        more = ways.unionByName(ways.join(on, [*key, "newer"]).select(*key, "older", F.col("far").alias("newer"))).distinct()
        more = materialize(more, "ways")
        discard(ways)
        ways, before = more, n
        n = ways.count()
        if n == before:
            return ways
    raise RuntimeError("precedences did not settle")


def current_values(members: DataFrame, records: DataFrame, fields: Sequence[str] = FIELDS) -> DataFrame:
    """cluster_id, field_name, value, holders, later, replaced: every counting value of a group's records, how many others of
    them come strictly later in the group's partial order, and whether any does.

    The order of a group: a value that replaced another in any record precedes it, if both occur in some row of a
    member; precedence is closed over all those values, so A < B < C holds also where no counting row has B. Values on a
    cycle precede each other and none is strictly later. The values with replaced = false are the topologically latest,
    also where rows have no timestamp. Records count by their counting row, deleted ones give nothing, as in ``survivors``.
    """
    inside = members.where("is_current and cluster_id is not null and source_customer_id is not null").select("cluster_id", "source_customer_id").distinct()
    needed = records.select("source_customer_id", "last_modified_timestamp", "standardized_at", "is_deleted", *fields)
    own = needed.join(inside.select("source_customer_id").distinct(), "source_customer_id", "left_semi")
    live = counting_rows(own).where("not coalesce(is_deleted, false)")
    key = ["cluster_id", "field_name"]
    values = _cells(inside.join(live, "source_customer_id"), ["cluster_id", "source_customer_id"], fields).groupBy(*key, F.col("v").alias("value")).agg(F.count_distinct("source_customer_id").alias("holders"))
    values = materialize(values, "values")
    known = materialize(_cells(inside.join(own, "source_customer_id"), ["cluster_id"], fields).distinct(), "known")
    edges = value_transitions(records, fields).select("field_name", "older", "newer")
    older = edges.join(known.withColumnRenamed("v", "older"), ["field_name", "older"])
    ways = _closure(older.join(known.withColumnRenamed("v", "newer"), [*key, "newer"]))
    back = ways.select(*key, F.col("newer").alias("older"), F.col("older").alias("newer"))
    strict = ways.join(back, [*key, "older", "newer"], "left_anti")
    later = strict.join(values.select(*key, F.col("value").alias("newer")), [*key, "newer"]).groupBy(*key, F.col("older").alias("value")).agg(F.count(F.lit(1)).alias("later"))
    out = values.join(later, [*key, "value"], "left").withColumn("later", F.coalesce("later", F.lit(0)))
    return out.select(*key, "value", "holders", "later", (F.col("later") > 0).alias("replaced"))
