"""Column profile per load, and the loads whose column departs from the other loads of their source.

Values are generalised to character-class masks. Per load and column four facets are kept as
distributions over keys: ``state`` (null, blank, value), ``form`` (mask), ``repeat`` (how often the row's
value occurs in the load) and ``value`` (the frequent values; all rare ones are one key). A load is
compared with the median share of each key over the loads of its source, which a minority of bad loads
can't move, by total variation distance: the share of rows that would have to change.

Defined results: null values count in ``state`` only, as do blanks; a null load or source is a group of its
own; an empty table has no profile rows; other columns of the table are never read; repeated rows count as
rows, for loads are profiled as delivered. A mask of more than ``MASK_LIMIT`` characters is replaced by its
length class, so very long texts cannot blow up the summary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MASK_LIMIT = 60
#: A value is frequent in a load from this share of its rows on, and at least MIN_COUNT rows.
FREQUENT_SHARE, MIN_COUNT = 0.01, 3


def value_mask(value: Column) -> Column:
    """Letters by class, runs of letters as one, digits one by one, blanks and punctuation as they are."""
    mask = F.regexp_replace(value, r"[\p{Lu}\p{Lt}]+", "A")
    mask = F.regexp_replace(mask, r"[\p{L}&&[^\p{Lu}\p{Lt}]]+", "a")
    mask = F.regexp_replace(mask, r"(Aa|A+a)", "Aa")
    mask = F.regexp_replace(mask, r"\p{N}", "9")
    mask = F.regexp_replace(mask, r"\p{M}+", "")
    mask = F.regexp_replace(mask, r"[\p{Z}\s]+", " ")
    long = F.concat(F.lit("<long "), F.floor(F.log2(F.length(mask))).cast("string"), F.lit(">"))
    return F.when(F.length(mask) > MASK_LIMIT, long).otherwise(mask)


def value_counts(df: DataFrame, columns: Sequence[str], source: str, load: str) -> DataFrame:
    """source, load, column_name, value, n: one row per distinct value, the only shuffle over all rows."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]))
    flat = df.select(F.col(source).alias("source"), F.col(load).alias("load"), pairs.alias("p"))
    return flat.groupBy("source", "load", F.col("p.column_name").alias("column_name"), F.col("p.value").alias("value")).agg(F.count(F.lit(1)).alias("n"))


def facet_counts(counts: DataFrame) -> DataFrame:
    """source, load, column_name, facet, key, n, total over the facets of ``value_counts``."""
    group = ["source", "load", "column_name"]
    total = counts.groupBy(*group).agg(F.sum("n").alias("total"))
    same = F.col("v.source").eqNullSafe(F.col("t.source")) & F.col("v.load").eqNullSafe(F.col("t.load")) & (F.col("v.column_name") == F.col("t.column_name"))
    with_total = counts.alias("v").join(total.alias("t"), same).select("v.*", "t.total")
    filled = F.col("value").isNotNull() & (F.trim("value") != "")
    state = F.when(F.col("value").isNull(), "null").when(~filled, "blank").otherwise("value")
    frequent = F.col("n") >= F.greatest(F.lit(MIN_COUNT), F.ceil(F.col("total") * FREQUENT_SHARE))
    repeat = F.when(F.col("n") == 1, "once").when(F.col("n") <= 2, "twice").when(frequent, "often").otherwise("some")
    entry = lambda facet, key: F.struct(F.lit(facet).alias("facet"), key.alias("key"))
    facets = F.when(filled, F.array(
        entry("state", state),
        entry("form", value_mask(F.col("value"))),
        entry("repeat", repeat),
        entry("value", F.when(frequent, F.lower(F.trim("value"))).otherwise(F.lit("\u0000rare"))),
    )).otherwise(F.array(entry("state", state)))
    flat = with_total.select(*group, "n", "total", F.explode(facets).alias("f"))
    return flat.groupBy(*group, F.col("f.facet").alias("facet"), F.col("f.key").alias("key")).agg(F.sum("n").alias("n"), F.max("total").alias("total"))


def departures(facets: DataFrame) -> DataFrame:
    """source, load, column_name, facet, distance from the source's median load, usual distance of the source's loads.

    Linear in the summary: per key the shares of all loads are collected (at most one entry a load), the median
    is taken with absent loads as zero, and the keys a load lacks enter through the median's total.
    """
    facets = facets.withColumn("share", F.col("n") / F.col("total"))
    loads = facets.groupBy("source", "column_name").agg(F.count_distinct(F.coalesce("load", F.lit(""))).alias("loads"))
    key = ["source", "column_name", "facet", "key"]
    spread = facets.groupBy(*key).agg(F.sort_array(F.collect_list("share"), asc=False).alias("shares"))
    same = F.col("k.source").eqNullSafe(F.col("l.source")) & (F.col("k.column_name") == F.col("l.column_name"))
    spread = spread.alias("k").join(loads.alias("l"), same).select("k.*", "loads")
    at = lambda i: F.coalesce(F.get("shares", i.cast("int")), F.lit(0.0))
    middle = F.floor((F.col("loads") - 1) / 2)
    spread = spread.withColumn("usual", (at(middle) + at(F.floor(F.col("loads") / 2))) / 2).drop("shares")
    whole = spread.groupBy("source", "column_name", "facet").agg(F.sum("usual").alias("usual_total"))
    on = lambda a, b, names: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in names]
    joined = facets.alias("f").join(spread.alias("k"), on("f", "k", key)).select("f.*", "k.usual")
    own = joined.groupBy("source", "load", "column_name", "facet").agg(F.sum(F.abs(F.col("share") - F.col("usual")) - F.col("usual")).alias("d"), F.max("total").alias("total"))
    dist = own.alias("o").join(whole.alias("w"), on("o", "w", ["source", "column_name", "facet"])).select("o.*", ((F.col("d") + F.col("usual_total")) / 2).alias("distance"))
    group = Window.partitionBy("source", "column_name", "facet")
    return dist.withColumn("usual_distance", F.percentile("distance", 0.5).over(group)).drop("d")


def departing_loads(df: DataFrame, columns: Sequence[str], source: str = "source_system", load: str = "load_batch_id", least: float = 0.2, noise: float = 4.0) -> DataFrame:
    """source, load, column_name, facet, distance of each departure.

    A departure moves at least ``least`` of the rows beyond what the source's loads usually differ by, and more
    than ``noise`` standard errors of a share in a load of that size.
    """
    found = departures(facet_counts(value_counts(df, columns, source, load)))
    beyond = F.col("distance") - F.col("usual_distance")
    return found.where((beyond >= least) & (beyond >= noise * 0.5 / F.sqrt("total"))).select("source", "load", "column_name", "facet", "distance", "usual_distance", "total")


def column_profile(df: DataFrame, columns: Sequence[str], source: str = "source_system", load: str = "load_batch_id", rare_share: float = 0.005) -> DataFrame:
    """One row per load and column: nulls, blanks, distinct values, range, dominant mask, rows in rare masks, largest facet distance.

    A mask is rare if it holds less than ``rare_share`` of the column's rows over all loads of the source.
    """
    counts = value_counts(df, columns, source, load)
    filled = F.col("value").isNotNull() & (F.trim("value") != "")
    group = ["source", "load", "column_name"]
    base = counts.groupBy(*group).agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.coalesce(F.sum(F.when(~filled, F.when(F.col("value").isNotNull(), F.col("n")))), F.lit(0)).alias("blanks"),
        F.count("value").alias("distinct_values"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.min(F.length("value")).alias("min_length"),
        F.max(F.length("value")).alias("max_length"),
    )
    facets = facet_counts(counts)
    forms = facets.where("facet = 'form'")
    of_column = forms.groupBy("source", "column_name", "key").agg(F.sum("n").alias("seen"))
    share = F.col("seen") / F.sum("seen").over(Window.partitionBy("source", "column_name"))
    of_column = of_column.withColumn("rare", share < rare_share)
    on = lambda a, b, names: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in names]
    marked = forms.alias("f").join(of_column.alias("c"), on("f", "c", ["source", "column_name", "key"])).select("f.*", "c.rare")
    masks = marked.groupBy(*group).agg(
        F.max(F.struct("n", "key"))["key"].alias("dominant_mask"),
        F.coalesce(F.sum(F.when(F.col("rare"), F.col("n"))), F.lit(0)).alias("rare_mask_rows"),
    )
    apart = departures(facets).groupBy(*group).agg(F.round(F.max(F.col("distance") - F.col("usual_distance")), 6).alias("divergence"))
    out = base.alias("b").join(masks.alias("m"), on("b", "m", group), "left").select("b.*", "m.dominant_mask", F.coalesce("m.rare_mask_rows", F.lit(0)).alias("rare_mask_rows"))
    return out.alias("b").join(apart.alias("a"), on("b", "a", group), "left").select("b.*", "a.divergence")
