"""Rule-based resolution: blocked pairs, weighted field scores, groups, identity map, golden records."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pairwise, scores, text
from ..runtime import discard, materialize
from .history import latest_by

#: Field weights and thresholds of the score, in the order of the blocking labels.
WEIGHTS = {"email": 0.35, "phone": 0.25, "website_domain": 0.10, "company_name": 0.20, "address": 0.10}
THRESHOLDS = {"company_name": 0.92, "address": 0.88}
STAND_INS = ("x", "-", "?", "@", "test", "xxx", "tbd", "unknown", "not provided", "noemail", "no-reply", "0")


def comparable(df: DataFrame) -> DataFrame:
    """source_system, id and the five fields in the form in which they are compared."""
    known = lambda c: F.when(~F.lower(F.trim(c)).isin(*STAND_INS), F.lower(text.one_space(c)))
    phone = F.when(~F.col("phone").isin("12345") & ~F.regexp_replace("phone", "[^0-9]", "").rlike(r"^(0+|1+|9+)$"), text.phone(F.col("phone")))
    return df.select("source_system", F.col("source_customer_id").alias("id"), known(F.col("email")).alias("email"), phone.alias("phone"), text.website(F.col("website_domain")).alias("website_domain"), known(F.col("company_name")).alias("company_name"), known(F.col("address")).alias("address"))


#: Rows of a block from which on it is cut into parts, each pair of which is a task's work of its own.
BLOCK_ROWS = 2000


def candidate_pairs(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """left, right of rows that share a value of any field, smaller id left, once: an OR-join as one equi-join on (field, value).

    All pairs of a block are the result asked for; a block of many rows is cut at random into parts of about
    ``block_rows``, and every two parts meet under a key of their own, so no task gets a whole hot block.
    """
    keys = F.array_compact(F.array(*[F.when(F.col(f).isNotNull(), F.concat(F.lit(f + "="), F.col(f))) for f in WEIGHTS]))
    blocks = rows.select("id", F.explode(keys).alias("key"))
    sizes = blocks.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("parts"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    blocks = blocks.join(sizes, "key").withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    meets = lambda name: blocks.select("key", F.col("id").alias(name), F.col("part").alias(f"{name}_part"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    left = meets("left").select("key", "left", F.col("left_part").alias("a"), F.col("other").alias("b"))
    right = meets("right").select("key", "right", F.col("other").alias("a"), F.col("right_part").alias("b"))
    return left.join(right, ["key", "a", "b"]).where("left < right").select("left", "right").distinct()


#: Rows of a part of a block where pairs are scored as they arise, rows and pairs taken at once, pairs of a task.
PART_ROWS, ROWS_AT_ONCE, PAIRS_AT_ONCE, TASK_PAIRS = 512, 4000, 1 << 17, 400_000


def repeated(rows: DataFrame) -> DataFrame:
    """Ids that several rows have."""
    return rows.where("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")


def cells(rows: DataFrame, part_rows: int = PART_ROWS) -> tuple[DataFrame, int]:
    """Rows, of which no two have the same id, under each (field, value) they share with others, with their columns: key, a, b (two parts of the block, or one
    twice), part, field (its place in WEIGHTS); and how many pairs all cells give."""
    keys = F.array_compact(F.array(*[F.when(F.col(f).isNotNull(), F.struct(F.lit(i).cast("byte").alias("field"), F.concat(F.lit(f + "="), F.col(f)).alias("key"))) for i, f in enumerate(WEIGHTS)]))
    blocks = lambda *c: rows.where("id is not null").select(F.explode(keys).alias("k"), *c)
    sizes = materialize(blocks().groupBy("k.key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes")
    n = sizes.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()[0] or 0
    size = F.greatest(F.lit(part_rows), F.least(F.lit(4 * part_rows), F.col("n") / 16))  # large blocks take larger parts, as each row goes to all
    of = sizes.select("key", F.ceil(F.col("n") / size).cast("int").alias("parts"))
    held = blocks("id").select("k.key", "k.field", "id").join(of, "key").join(rows, "id")  # rows follow once keys of one row are gone
    held = held.withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    other = held.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")).drop("parts")
    return other.select("*", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b")).drop("other"), int(n)


def _pairs(columns: dict[str, np.ndarray], codes: Sequence[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs of rows in cells, sorted by cell and id: of two parts those across, and each pair in the first field it shares."""
    cell, part, field, cross = columns["cell"], columns["part"], columns["field"], columns["cross"]
    ends = np.searchsorted(cell, cell, "right")
    later = ends - np.arange(len(cell)) - 1
    upto = np.cumsum(later)
    at = 0
    while at < len(cell):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS_AT_ONCE, "right")))
        n = later[at:to]
        left = np.repeat(np.arange(at, to), n)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
        keep = ~cross[left] | (part[left] != part[right])
        for i, c in enumerate(codes):
            if field[at:to].max() > i:
                keep &= (c[left] != c[right]) | (field[left] <= i)
        if keep.any():
            yield left[keep], right[keep]
        at = to


def _scored_cells(score: Callable, names: Sequence[str]) -> Callable:
    """For mapInArrow over cells sorted by key, a, b, id: the pairs that ``score`` keeps, with its columns."""

    def some(t: pa.Table) -> Iterator[pa.RecordBatch]:
        t = t.combine_chunks()
        turn = np.zeros(t.num_rows, bool)
        for c in ("key", "a", "b"):
            v = t[c].combine_chunks()
            turn[1:] |= pc.not_equal(v[1:], v[:-1]).to_numpy(zero_copy_only=False)
        columns = {c: t[c].to_numpy() for c in ("part", "field")} | {"cell": np.cumsum(turn), "cross": pc.not_equal(t["a"], t["b"]).to_numpy()}
        codes = []
        for f in list(WEIGHTS)[:-1]:  # missing values equal nothing
            v = pc.fill_null(t[f].combine_chunks().dictionary_encode().indices, -1).to_numpy().astype(np.int64)
            codes.append(np.where(v < 0, -1 - np.arange(len(v)), v))
        ready, ids = score(t), t["id"].combine_chunks()
        for left, right in _pairs(columns, codes):
            left, right, *values = ready(left, right)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(left)), ids.take(pa.array(right)), *values], names=["left", "right", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS_AT_ONCE):
                held.append(batch.slice(i, ROWS_AT_ONCE))
                if sum(x.num_rows for x in held) < ROWS_AT_ONCE:
                    continue
                t = pa.Table.from_batches(held)  # but its last cell, which may go on
                last = [t[c][-1].as_py() for c in ("key", "a", "b")]
                same = np.logical_and.reduce([pc.equal(t[c], v).to_numpy() for c, v in zip(("key", "a", "b"), last)])
                whole = t.num_rows - int(same.sum())
                if whole:
                    yield from some(t.slice(0, whole))
                held = t.slice(whole).to_batches()
        if held:
            yield from some(pa.Table.from_batches(held))

    return run


def scored_pairs(rows: DataFrame, score: Callable, schema: str, part_rows: int = PART_ROWS) -> DataFrame:
    """The candidate pairs of rows of which no two have the same id, scored where they arise: neither pairs nor texts of pairs are
    shuffled or joined. ``score`` gets an Arrow table of rows and gives a function from two lists of places, those of pairs, to two
    lists of those kept and Arrow columns named by ``schema``."""
    held, n = cells(rows, part_rows)
    shuffles = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(min(shuffles, n // 10_000), n // TASK_PAIRS, 1)
    names = [c.split()[0] for c in schema.split(", ")[2:]]
    sorted_cells = held.repartition(tasks, "key", "a", "b").sortWithinPartitions("key", "a", "b", "id")
    return sorted_cells.mapInArrow(_scored_cells(score, names), schema)


def named(kernels: Sequence[Callable], with_email: bool = False) -> Callable:
    """A score for ``scored_pairs``: equality of emails, if asked for, and ``kernels`` of names; null where a side is null."""

    def score(t: pa.Table) -> Callable:
        coded = {c: t[c].combine_chunks().dictionary_encode() for c in ("email", "company_name")}
        of = {c: pc.fill_null(v.indices, -1).to_numpy().astype(np.int64) for c, v in coded.items()}
        names, emails = of["company_name"], of["email"]
        texts = pairwise.Texts(coded["company_name"].dictionary.to_pylist())

        def ready(left: np.ndarray, right: np.ndarray) -> list:
            a, b = names[left], names[right]
            missing, e, f = (a < 0) | (b < 0), emails[left], emails[right]
            there = np.flatnonzero(~missing)
            out = [left, right] + ([pa.array((e == f).astype(float), mask=(e < 0) | (f < 0))] if with_email else [])
            for kernel in kernels:
                values = np.zeros(len(a))
                values[there] = kernel(texts, a[there], b[there])
                out.append(pa.array(values, mask=missing))
            return out

        return ready

    return score


def similarity(a: Column, b: Column, exact: bool) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    close = F.greatest(F.lit(0.0), F.lit(1.0) - F.levenshtein(a, b) / F.nullif(longest, F.lit(0)))
    return F.when(a.isNull() | b.isNull(), None).otherwise(F.when(a == b, 1.0).otherwise(F.lit(0.0) if exact else scores.r(close, 8)))


def pair_scores(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """left, right, a similarity of each field, match_probability, confidence and blocking_rule."""
    side = lambda s, key: rows.select(F.col("id").alias(key), *[F.col(f).alias(s + f) for f in WEIGHTS])
    j = pairs.join(side("l_", "left"), "left").join(side("r_", "right"), "right")
    j = j.select("left", "right", *[similarity(F.col("l_" + f), F.col("r_" + f), f not in THRESHOLDS).alias(f) for f in WEIGHTS])
    top = sum((F.coalesce(F.col(f), F.lit(0.0)) * w for f, w in WEIGHTS.items()), F.lit(0.0))
    weight = sum((F.when(F.col(f).isNotNull(), w).otherwise(0.0) for f, w in WEIGHTS.items()), F.lit(0.0))
    matched = {f: F.coalesce(F.col(f) >= THRESHOLDS.get(f, 1.0), F.lit(False)) for f in WEIGHTS}
    strong = matched["email"] | matched["phone"] | (matched["company_name"] & matched["website_domain"])
    present = sum((F.when(F.col(f).isNotNull(), 1).otherwise(0) for f in WEIGHTS), F.lit(0))
    j = j.withColumn("match_probability", scores.r(top / F.nullif(weight, F.lit(0.0)), 8))
    confidence = F.least(F.lit(1.0), F.col("match_probability") * 0.85 + present / F.lit(5.0) * 0.10 + F.when(strong, 0.05).otherwise(0.0))
    rule = F.coalesce(*[F.when(F.col(f) == 1.0, F.lit(f"l.{f} = r.{f}")) for f in WEIGHTS])
    return j.withColumn("confidence", scores.r(confidence, 8)).withColumn("blocking_rule", rule)


def near(threshold: float) -> Callable:
    """A score for ``scored_pairs``: keeps the pairs whose match_probability may be ``threshold`` or more. Addresses, and names that
    the other fields and the lengths leave open, count by the least edits that they can have; then those names' edits are counted."""

    def score(t: pa.Table) -> Callable:
        coded = {f: t[f].combine_chunks().dictionary_encode() for f in WEIGHTS}
        of = {f: pc.fill_null(v.indices, -1).to_numpy().astype(np.int64) for f, v in coded.items()}
        sizes = {f: np.append(pc.utf8_length(coded[f].dictionary).to_numpy(), 0).astype(np.int64)[of[f]] for f in THRESHOLDS}
        texts = pairwise.Texts(coded["company_name"].dictionary.to_pylist())

        def ready(left: np.ndarray, right: np.ndarray) -> list:
            top, weight, name = np.zeros(len(left)), np.zeros(len(left)), np.zeros(len(left))
            for f, w in WEIGHTS.items():
                a, b = of[f][left], of[f][right]
                there = (a >= 0) & (b >= 0)
                most = (a == b).astype(float)
                if f in sizes:
                    x, y = sizes[f][left], sizes[f][right]
                    most = np.where(a == b, 1.0, 1.0 - np.maximum(np.abs(x - y), 1) / np.maximum(np.maximum(x, y), 1))
                top += np.where(there, most * w, 0.0)
                weight += np.where(there, w, 0.0)
                name = most if f == "company_name" else name
            lacks = top - (threshold - 1e-6) * weight
            a, b = of["company_name"][left], of["company_name"][right]
            fits = np.minimum(texts.size[a], texts.size[b]) <= pairwise.WORD if len(texts.size) else np.zeros(len(a), bool)
            count = np.flatnonzero((lacks >= 0) & (a >= 0) & (b >= 0) & (a != b) & fits)
            if len(count):
                lacks[count] += WEIGHTS["company_name"] * (pairwise.edit_share(texts, a[count], b[count]) - name[count])
            keep = lacks >= 0
            return [left[keep], right[keep]]

        return ready

    return score


def links(rows: DataFrame, threshold: float = 0.95) -> DataFrame:
    """left, right of the candidate pairs whose match_probability is ``threshold`` or more, once each. Pairs that can't be are
    dropped where they arise, so only the others are joined; an id that several rows have keeps all its pairs."""
    rows = materialize(rows.drop("source_system"), "rows")
    again = repeated(rows)
    if again.isEmpty():
        pairs = scored_pairs(rows, near(threshold), "left string, right string")
    else:
        again = materialize(again, "repeated")
        pairs = scored_pairs(rows.join(again, "id", "left_anti"), near(threshold), "left string, right string").unionByName(pairs_of(rows, again))
    scored = pair_scores(materialize(pairs, "near"), rows).where(F.col("match_probability") >= threshold)
    return materialize(scored.select("left", "right").distinct(), "linked")


def pairs_of(rows: DataFrame, some: DataFrame) -> DataFrame:
    """The candidate pairs with an id of ``some``."""
    mark = lambda key: some.select(F.col("id").alias(key), F.lit(True).alias("of_" + key))
    return candidate_pairs(rows).join(mark("left"), "left", "left").join(mark("right"), "right", "left").where("of_left or of_right").select("left", "right")


def groups(links: DataFrame, rounds: int = 40) -> DataFrame:
    """id, root (least id of the group) of the vertices of ``links`` (left, right): least neighbours and pointer jumps until stable.

    A vertex has one root, so the skewed side of each join is the edges', which AQE splits; minima are combined before they move.
    """
    both = materialize(links.select(F.col("left").alias("a"), F.col("right").alias("b")).unionByName(links.select(F.col("right").alias("a"), F.col("left").alias("b"))).distinct(), "links")
    roots = materialize(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("root")), "roots")
    for _ in range(rounds):
        near = both.join(roots.withColumnsRenamed({"id": "b", "root": "r"}), "b").groupBy(F.col("a").alias("id")).agg(F.min("r").alias("r"))
        lower = roots.join(near, "id").select("id", "root", F.least("root", "r").alias("new"))
        jump = lower.select(F.col("id").alias("new"), F.col("new").alias("far"))
        step = materialize(lower.join(jump, "new").select("id", F.col("root").alias("old"), F.least("new", "far").alias("root")), "roots")
        moved = step.where("old <> root").limit(1).count()
        discard(roots)
        roots = step.select("id", "root")
        if not moved:
            discard(both)
            return roots
    raise RuntimeError("groups did not settle")


def match_rows(scored: DataFrame, rows: DataFrame, model: str) -> DataFrame:
    """Prediction rows of scored pairs: match_id over both members, systems and ids, scores, comparison vector as JSON text, rule, model."""
    of = lambda s: rows.select(F.col("id").alias(s), F.col("source_system").alias(f"{s}_source_system"))
    j = scored.join(of("left"), "left").join(of("right"), "right")
    member = lambda s: F.struct(F.col(f"{s}_source_system").alias("source_system"), F.col(s).alias("source_customer_id"))
    vector = F.to_json(F.struct(*[F.col(f).cast("decimal(10,8)").cast("string").alias(f) for f in WEIGHTS]), {"ignoreNullFields": "false"})
    return j.select(
        text.stable_id("match_", F.array(member("left"), member("right"))).alias("match_id"), "left_source_system", F.col("left").alias("left_source_customer_id"), "right_source_system", F.col("right").alias("right_source_customer_id"),
        "match_probability", F.col("confidence").alias("confidence_score"), vector.alias("comparison_vector"), "blocking_rule", F.lit(model).alias("model_version"),
    )


def cluster_rows(scored: DataFrame, rows: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Clusters of all rows, single ones included: stable ids over the members, the members themselves, representative (least
    member), figures of the pairs within, distinct rules. A cluster of one has probability and confidence 1."""
    linked = scored.where(F.col("match_probability") >= threshold)
    roots = groups(linked.select("left", "right"))
    of = rows.select("id", "source_system").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    of = materialize(of, "memberships")
    member = F.struct("source_system", F.col("id").alias("source_customer_id"))
    size = of.groupBy("root").agg(F.sort_array(F.collect_list(member)).alias("source_members"))
    inside = linked.join(roots.select(F.col("id").alias("left"), "root"), "left").groupBy("root")
    mean = lambda c: scores.r(F.sum(F.col(c).cast("decimal(18,8)")).cast("double") / F.count(c), 8)
    figures = inside.agg(F.max("match_probability").alias("best"), mean("match_probability").alias("mean"), mean("confidence").alias("confidence"), F.array_sort(F.collect_set("blocking_rule")).alias("rules"))
    ids = F.transform("source_members", lambda m: m["source_customer_id"])
    one = lambda c: F.coalesce(c, F.lit(1.0))
    return size.join(figures, "root", "left").select(
        text.stable_id("cluster_", F.col("source_members")).alias("cluster_id"), text.stable_id("gold_", F.col("source_members")).alias("golden_customer_id"), F.size("source_members").alias("cluster_size"), "source_members", ids.alias("source_customer_ids"),
        F.array_sort(F.array_distinct(F.transform("source_members", lambda m: m["source_system"]))).alias("source_systems"), F.col("source_members")[0]["source_system"].alias("representative_source_system"), F.col("source_members")[0]["source_customer_id"].alias("representative_source_customer_id"),
        one("best").alias("max_match_probability"), one("mean").alias("avg_match_probability"), one("confidence").alias("confidence_score"), F.coalesce("rules", F.array().cast("array<string>")).alias("cluster_rules"),
    )


def identity_rows(clusters: DataFrame, records: DataFrame) -> DataFrame:
    """One row a member of a cluster: its record id and whether it is the representative. Where a cluster names no members, its
    ids belong to its only source system; with several systems they can't be told and give nothing."""
    alone = F.when(F.size("source_systems") == 1, F.transform("source_customer_ids", lambda i: F.struct(F.col("source_systems")[0].alias("source_system"), i.alias("source_customer_id"))))
    flat = clusters.select("golden_customer_id", "cluster_id", "representative_source_system", "representative_source_customer_id", F.col("confidence_score").alias("match_probability"), F.explode(F.coalesce("source_members", alone)).alias("m"))
    flat = flat.select("*", "m.source_system", "m.source_customer_id").where("source_system is not null and source_customer_id is not null")
    joined = flat.join(records.select("source_system", "source_customer_id", "source_record_id"), ["source_system", "source_customer_id"], "left")
    primary = (F.col("source_system") == F.col("representative_source_system")) & (F.col("source_customer_id") == F.col("representative_source_customer_id"))
    return joined.select("golden_customer_id", "cluster_id", "source_system", "source_customer_id", "source_record_id", "match_probability", primary.alias("is_primary_source")).distinct()


def golden_records(members: DataFrame, records: DataFrame, fields: Sequence[str], clusters: DataFrame | None = None) -> DataFrame:
    """One row a cluster: the surviving value of each field, its origin and confidence as JSON text, the primary record, first and
    last seen, members, mean quality, completeness: all winners in one aggregation.

    Members: cluster_id, source_system, source_customer_id, joined by both keys to the counting row of their record (the
    latest); a record whose counting row is deleted gives nothing. Preferred: lowest priority (100 if null), highest quality and
    completeness (0 if null), latest modification, for company and address the longest value, then system and id. Emails
    and phones that aren't valid never win. ``clusters``: representative of a cluster, which is the primary record if it is a
    member, and confidence_score.
    """
    keys = ["source_system", "source_customer_id"]
    inside = members.select("cluster_id", *keys).distinct()
    live = latest_by(records.join(inside.select(*keys).distinct(), keys, "left_semi"), keys, [F.col("last_modified_timestamp"), F.col("load_batch_id"), F.col("standardized_at")]).where("not coalesce(is_deleted, false)")
    j = inside.join(live, keys)
    none = F.lit(None).cast("string")
    held = clusters.select("cluster_id", F.col("representative_source_system").alias("r_s"), F.col("representative_source_customer_id").alias("r_i"), "confidence_score") if clusters is not None else inside.select("cluster_id").distinct().select("cluster_id", none.alias("r_s"), none.alias("r_i"), F.lit(None).cast("double").alias("confidence_score"))
    j = j.join(held, "cluster_id", "left")
    valid = {"email": F.col("email").rlike(text.EMAIL), "phone": F.length(F.regexp_replace("phone", "[^0-9]", "")) >= 7}
    sound = valid | {"address": F.length("address") >= 8}
    late = F.unix_micros(F.col("last_modified_timestamp").cast("timestamp"))
    quality, complete = F.coalesce("data_quality_score", F.lit(0)), F.coalesce("completeness_score", F.lit(0))
    head = [F.coalesce("source_priority", F.lit(100)).alias("p"), (-quality).alias("q"), (-complete).alias("c"), late.isNull().alias("n"), (-late).alias("t")]
    tail = [F.col("source_system").alias("s"), F.col("source_customer_id").alias("i")]

    def won(field: str) -> Column:
        sure = scores.r(F.least(F.lit(1.0), quality.cast("double") * 0.5 + complete.cast("double") * 0.3 + F.when(sound.get(field, F.lit(True)), 0.2).otherwise(0.1)))
        longest = [(-F.length(field)).alias("l")] if field in ("company_name", "address") else []
        return F.min(F.when((F.trim(field) != "") & valid.get(field, F.lit(True)), F.struct(*head, *longest, *tail, F.col(field).alias("v"), sure.alias("sure")))).alias(field)

    first = F.coalesce((F.col("source_system") == F.col("r_s")) & (F.col("source_customer_id") == F.col("r_i")), F.lit(False))
    primary = F.min(F.struct((~first).alias("r"), *head, *tail)).alias("primary")
    wide = j.groupBy("cluster_id").agg(*[won(f) for f in fields], primary, F.min("created_date").alias("first_seen"), F.max("last_modified_timestamp").alias("last_seen"), F.count(F.lit(1)).alias("members"), scores.r(F.sum(quality.cast("decimal(18,4)")).cast("double") / F.count(F.lit(1))).alias("quality"), F.max("confidence_score").alias("confidence_score"))
    origin = lambda f: F.struct(F.col(f)["s"].alias("source_system"), F.col(f)["i"].alias("source_customer_id"), F.col(f)["v"].alias("value"), F.col(f)["sure"].cast("decimal(5,4)").cast("string").alias("confidence")).alias(f)
    full = sum((F.when(F.col(f).isNotNull(), 1).otherwise(0) for f in ("company_name", "email", "phone", "address") if f in fields), F.lit(0)) / 4
    value = lambda f: F.regexp_replace(F.col(f)["v"], "[^0-9]", "") if f == "phone" else F.col(f)["v"]
    return wide.select(
        "cluster_id", *[value(f).alias(f) for f in fields], F.col("primary.s").alias("primary_source_system"), F.col("primary.i").alias("primary_source_customer_id"), "first_seen", "last_seen", "members", "quality",
        scores.r(full).alias("completeness"), F.coalesce("confidence_score", F.lit(1.0)).alias("confidence_score"), F.to_json(F.struct(*[origin(f) for f in fields]), {"ignoreNullFields": "false"}).alias("survivorship"),
    )
