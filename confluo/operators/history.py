"""Histories of changing rows: type-two dimensions, snapshots, change logs and row upserts.

``type_two_history`` folds captures into versions: a capture whose hash equals the open version's is swallowed,
one that differs closes the open version and opens the next, a delete closes it and opens none.
``merge_dimension`` brings a batch of new or late captures into an existing dimension, which may be empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Captures of one key after de-duplication, from which on the key is cut into time segments.
HOT_KEY_ROWS = 200_000


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row of each key that is greatest by ``order`` (nulls least; ties by all columns, so repeats collapse).

    One partial and one final aggregation: a hot key is combined before the shuffle. Null keys are a key.
    """
    rest = [c for c in df.columns if c not in keys]
    orderable = [F.to_json(F.struct(F.col(c))) if t.startswith(("array", "map", "struct", "variant")) else F.col(c) for c, t in df.dtypes if c in rest]
    packed = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*order, *orderable)).alias("__row")
    return df.groupBy(*keys).agg(packed).select(*keys, "__row.*").select(*df.columns)


def _segmented(states: DataFrame, keys: list[str], hot_rows: int) -> tuple[DataFrame, bool]:
    """Add ``__seg``: 0, or for a hot key the number of one of 64 time segments, so that no hot key is sorted in one task."""
    sizes = states.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > hot_rows)
    if sizes.isEmpty():
        return states.withColumn("__seg", F.lit(0)), False
    micros = F.unix_micros(F.col("effective_from").cast("timestamp"))
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"h.{k}")) for k in keys]
    hot = states.alias("s").join(sizes.alias("h"), same, "left_semi")
    cuts = hot.groupBy(*keys).agg(F.percentile_approx(micros, [i / 64 for i in range(1, 64)], 1000).alias("__cuts"))
    marked = states.alias("s").join(cuts.alias("h"), same, "left").select("s.*", "h.__cuts")
    return marked.withColumn("__seg", F.coalesce(F.size(F.filter("__cuts", lambda c: c <= micros)), F.lit(0))).drop("__cuts"), True


def type_two_history(captures: DataFrame, keys: Sequence[str] = ("source_system", "source_customer_id"), hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """keys, effective_from, effective_to (null: still holds), current_record_hash of every version.

    Needs effective_from, captured_at, change_type, current_record_hash; other columns are ignored. Of captures of
    a key with the same effective_from the latest captured_at holds (null is earliest; a tie goes to a delete, then
    to the greatest hash); exact repeats collapse. A null effective_from can't be placed and is left out. A null
    key part is a value of its own, and so is a null hash of a capture that is no delete. Empty in, empty out.
    """
    keys = list(keys)
    deleted = F.coalesce(F.upper(F.trim("change_type")) == "DELETE", F.lit(False))
    rank = F.struct("captured_at", deleted.alias("gone"), F.col("current_record_hash").alias("hash"))
    states = (
        captures.where(F.col("effective_from").isNotNull())
        .groupBy(*keys, "effective_from")
        .agg(F.max(rank).alias("r"))
        .select(*keys, "effective_from", F.col("r.gone").alias("gone"), F.when(~F.col("r.gone"), F.col("r.hash")).alias("hash"))
    )
    states, segmented = _segmented(states, keys, hot_rows)
    segment = Window.partitionBy(*keys, "__seg").orderBy("effective_from")
    before = F.lag(F.struct("gone", "hash")).over(segment)
    # Edges of the segments: only keys with several segments need their neighbours.
    edges = states.groupBy(*keys, "__seg").agg(F.max_by(F.struct("gone", "hash"), "effective_from").alias("last")) if segmented else None
    if edges is not None:
        over = Window.partitionBy(*keys).orderBy("__seg")
        edges = edges.select(*keys, "__seg", F.lag("last").over(over).alias("__before"))
        same = [F.col(f"s.{k}").eqNullSafe(F.col(f"e.{k}")) for k in [*keys, "__seg"]]
        states = states.alias("s").join(edges.alias("e"), same).select("s.*", "e.__before")
        before = F.coalesce(before, F.col("__before"))
    turns = states.withColumn("__p", before)
    begins = ~F.col("gone") & (F.col("__p").isNull() | F.col("__p.gone") | ~F.col("__p.hash").eqNullSafe(F.col("hash")))
    ends = F.col("gone") & F.col("__p").isNotNull() & ~F.col("__p.gone")
    turns = turns.where(begins | ends)
    until = F.lead("effective_from").over(segment)
    if edges is None:
        out = turns.withColumn("effective_to", until)
    else:
        firsts = turns.groupBy(*keys, "__seg").agg(F.min("effective_from").alias("first"))
        later = Window.partitionBy(*keys).orderBy("__seg")
        firsts = firsts.select(*keys, "__seg", F.lead("first").over(later).alias("__next"))
        same = [F.col(f"s.{k}").eqNullSafe(F.col(f"e.{k}")) for k in [*keys, "__seg"]]
        out = turns.alias("s").join(firsts.alias("e"), same).select("s.*", "e.__next")
        out = out.withColumn("effective_to", F.coalesce(until, F.col("__next")))
    return out.where(~F.col("gone")).select(*keys, "effective_from", "effective_to", F.col("hash").alias("current_record_hash"))


def merge_dimension(dimension: DataFrame, log: DataFrame, batch: DataFrame, keys: Sequence[str] = ("source_system", "source_customer_id")) -> DataFrame:
    """The dimension after a batch of captures: changed open versions are closed, new open versions inserted.

    ``dimension``: keys, effective_from, effective_to, current_record_hash, as ``type_two_history`` gives it; ``log``: the
    captures that made it. The captures of a key that are all later than its log are compared with its open version
    alone. A key with a late capture is rebuilt from log and batch, because that capture may fall between two captures
    with equal hash, of which a dimension keeps one. Untouched keys and closed versions are passed on as they are.
    """
    keys = list(keys)
    needed = [*keys, "effective_from", "captured_at", "change_type", "current_record_hash"]
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
    first = batch.where("effective_from is not null").groupBy(*keys).agg(F.min("effective_from").alias("__first"))
    last = log.groupBy(*keys).agg(F.max("effective_from").alias("__last"))
    touched = first.alias("f").join(last.alias("l"), same("f", "l"), "left").select("f.*", F.coalesce(F.col("__first") <= F.col("__last"), F.lit(False)).alias("__late"))
    marked = dimension.alias("d").join(touched.alias("t"), same("d", "t"), "left").select("d.*", "t.__late")
    kept = marked.where("__late is null or (not __late and effective_to is not null)").drop("__late")
    open_ = marked.where("not __late and effective_to is null").withColumn("captured_at", F.lit(None).cast(batch.schema["captured_at"].dataType)).withColumn("change_type", F.lit("OPEN"))
    again = log.alias("a").join(touched.where("__late").alias("t"), same("a", "t"), "left_semi").select(*[F.col(f"a.{c}").alias(c) for c in needed])
    captures = batch.select(*needed).unionByName(open_.select(*needed)).unionByName(again)
    return kept.unionByName(type_two_history(captures, keys))


def empty_dimension(captures: DataFrame, keys: Sequence[str] = ("source_system", "source_customer_id")) -> DataFrame:
    """No versions, in the form of ``merge_dimension``."""
    moment = F.col("effective_from").alias("effective_to")
    return captures.where(F.lit(False)).select(*keys, "effective_from", moment, "current_record_hash")


def as_text(history: DataFrame, open_text: str = "open") -> DataFrame:
    """Both times as text ``yyyy-MM-dd HH:mm:ss``; a version that still holds ends with ``open_text``."""
    form = "yyyy-MM-dd HH:mm:ss"
    return history.withColumns({
        "effective_from": F.date_format("effective_from", form),
        "effective_to": F.coalesce(F.date_format("effective_to", form), F.lit(open_text)),
    })


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], hash_column: str | None = None, preserve: Sequence[str] = ()) -> DataFrame:
    """Matched keys take the source row, new keys are added, others stay.

    With ``hash_column`` a target row whose hash equals the source's stays as it is; ``preserve`` columns keep the
    target's value on update. The source must have one row per key. Null keys never match.
    """
    columns = target.columns
    s, t = source.alias("s"), target.alias("t")
    on = [F.col(f"s.{k}") == F.col(f"t.{k}") for k in keys]
    joined = t.join(s, on, "full_outer")
    has_s, has_t = F.col(f"s.{keys[0]}").isNotNull(), F.col(f"t.{keys[0]}").isNotNull()
    take = has_s
    if hash_column:
        take = has_s & (~has_t | (F.coalesce(F.col(f"t.{hash_column}"), F.lit("")) != F.coalesce(F.col(f"s.{hash_column}"), F.lit(""))))
    pick = lambda c: F.when(take & ~has_t, F.col(f"s.{c}")).when(take & F.lit(c not in preserve), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
    return joined.select(*[(pick(c) if c in source.columns else F.col(f"t.{c}")).alias(c) for c in columns])


def snapshot_merge(dimension: DataFrame, snapshot: DataFrame, keys: Sequence[str], check: Sequence[str], at: Column) -> DataFrame:
    """Type-two merge of a full snapshot by check columns; keys that vanished are closed.

    ``dimension``: keys, check columns, row_hash, valid_from, valid_to.
    """
    hash_of = F.sha2(F.to_json(F.struct(*check), {"ignoreNullFields": "false"}), 256)
    now = snapshot.select(*keys, *check).withColumn("row_hash", hash_of)
    history, current = dimension.where("valid_to is not null"), dimension.where("valid_to is null")
    d, n = current.alias("d"), now.alias("n")
    both = d.join(n, [F.col(f"d.{k}") == F.col(f"n.{k}") for k in keys], "full_outer")
    gone, new = F.col("n.row_hash").isNull(), F.col("d.row_hash").isNull()
    changed = ~gone & ~new & (F.col("d.row_hash") != F.col("n.row_hash"))
    row = lambda side, start, end: F.struct(*[F.col(f"{side}.{c}").alias(c) for c in [*keys, *check, "row_hash"]], start.alias("valid_from"), end.alias("valid_to"))
    null = F.lit(None).cast(dimension.schema["valid_to"].dataType)
    closed = F.when(~new, row("d", F.col("d.valid_from"), F.when(gone | changed, at).otherwise(null)))
    opened = F.when(new | changed, row("n", at, null))
    merged = both.select(F.explode(F.array_compact(F.array(closed, opened))).alias("r")).select("r.*")
    return history.unionByName(merged)
