"""Queries of rule-based resolution, golden records and history over the silver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import pairwise, scores, similarity
from ..operators import history, resolution
from ..runtime import materialize, table
from .texts import _null, _phone, _space

GOLDEN = ("company_name", "email", "phone", "address", "website_domain", "industry", "customer_status")


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "silver_customer").where("not coalesce(is_deleted, false)")
    latest = history.latest_by(df, ["source_system", "source_customer_id"], [F.col("last_modified_timestamp"), F.col("load_batch_id"), F.col("standardized_at")])
    return resolution.comparable(latest)


def candidate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolution.candidate_pairs(_rows(spark, sf_dir))


def pair_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(_rows(spark, sf_dir), "rows")
    return resolution.pair_scores(resolution.candidate_pairs(rows), rows)


def _named_pairs(rows: DataFrame, of: DataFrame) -> DataFrame:
    """The candidate pairs with a record of ``of``, which are few."""
    side = lambda s, key: rows.select(F.col("id").alias(key), F.col("company_name").alias(s + "n"), F.col("email").alias(s + "e"))
    return resolution.pairs_of(rows, of).join(side("l", "left"), "left").join(side("r", "right"), "right")


def _scored_names(spark: SparkSession, sf_dir: str, score: Callable, schema: str, columns: Callable[[], list[Column]]) -> DataFrame:
    """Pairs scored block by block. An id that several rows have pairs all of them, whichever share a value; such pairs, if any, take the joins and ``columns``."""
    rows = materialize(_rows(spark, sf_dir).drop("source_system"), "rows")
    again = resolution.repeated(rows)
    if again.isEmpty():
        return resolution.scored_pairs(rows, score, schema)
    again = materialize(again, "repeated")
    return resolution.scored_pairs(rows.join(again, "id", "left_anti"), score, schema).unionByName(_named_pairs(rows, again).select("left", "right", *columns()))


def pair_similarities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate pair's emails by equality, names by edits and by Jaro-Winkler."""
    n, e = (F.col("ln"), F.col("rn")), (F.col("le"), F.col("re"))
    score = resolution.named([pairwise.edit_share, similarity.jaro_winklers], with_email=True)
    plain = lambda: [similarity.exact(*e).alias("email_exact"), similarity.edit_share(*n).alias("name_edits"), scores.r(similarity.jaro_winkler(*n), 4).alias("name_jaro_winkler")]
    return _scored_names(spark, sf_dir, score, "left string, right string, email_exact double, name_edits double, name_jaro_winkler double", plain)


def pair_seq_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate pair's names by the ratio of their longest common blocks."""
    return _scored_names(spark, sf_dir, resolution.named([pairwise.sequence_ratio]), "left string, right string, name_ratio double", lambda: [similarity.sequence_ratio("ln", "rn").alias("name_ratio")])


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolution.groups(resolution.links(_rows(spark, sf_dir)))


def duplicate_reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "customer_identity_map").where("is_current")
    one = m.agg(F.count_distinct("cluster_id").alias("clusters"), F.count_distinct("source_customer_id").alias("members"))
    return one.select("clusters", "members", scores.r(1 - F.col("clusters") / F.nullif("members", F.lit(0))).alias("reduction"))


def cluster_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "customer_identity_map").where("is_current").select("cluster_id", "source_system", "source_customer_id", "match_probability").distinct()
    return m.groupBy("cluster_id").agg(F.count_distinct("source_customer_id").alias("size"), F.max("match_probability").cast("double").alias("best"), scores.r(F.sum("match_probability") / F.count("match_probability"), 6).alias("mean"), F.array_join(F.array_sort(F.collect_set("source_system")), ", ").alias("systems"))


def identity_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per current member; the newest membership of a record in a cluster counts."""
    m = table(spark, sf_dir, "customer_identity_map").where("is_current")
    return history.latest_by(m.select("golden_customer_id", "source_system", "source_customer_id", "cluster_id", "is_primary_source", "active_from"), ["golden_customer_id", "source_system", "source_customer_id"], [F.col("active_from")]).drop("active_from")


def _clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest row of each cluster of the earlier run."""
    c = table(spark, sf_dir, "customer_clusters").withColumn("confidence_score", F.col("avg_match_probability").cast("double"))
    return history.latest_by(c.select("cluster_id", "golden_customer_id", "cluster_size", "representative_source_system", "representative_source_customer_id", "confidence_score", "updated_at"), ["cluster_id"], [F.col("updated_at")])


def golden_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = table(spark, sf_dir, "customer_identity_map").where("is_current")
    return resolution.golden_records(members, table(spark, sf_dir, "silver_customer"), GOLDEN, _clusters(spark, sf_dir))


def golden_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golden_rows(spark, sf_dir).withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first_seen", "last_seen")})


def _own_clusters(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = materialize(_rows(spark, sf_dir), "rows")
    scored = materialize(resolution.pair_scores(resolution.candidate_pairs(rows), rows), "scored")
    return rows, scored, resolution.cluster_rows(scored, rows)


def match_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(_rows(spark, sf_dir), "rows")
    return resolution.match_rows(resolution.pair_scores(resolution.candidate_pairs(rows), rows), rows, "confluo_rules_v1")


def cluster_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _own_clusters(spark, sf_dir)[2].drop("source_members")
    return out.withColumns({c: F.array_join(c, ",") for c in ("source_customer_ids", "source_systems", "cluster_rules")})


def cluster_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over all clusters of the earlier run: how many, their members, the mean probability."""
    return _clusters(spark, sf_dir).agg(F.count(F.lit(1)).alias("total_clusters"), F.sum("cluster_size").alias("total_members"), scores.r(F.sum(F.col("confidence_score").cast("decimal(18,8)")).cast("double") / F.count("confidence_score")).alias("match_accuracy"))


def identity_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of the clusters of this run; clusters of one system give their ids only, as a run without member objects does."""
    clusters = _own_clusters(spark, sf_dir)[2]
    clusters = clusters.withColumn("source_members", F.when(F.size("source_systems") > 1, F.col("source_members")))
    records = history.latest_by(table(spark, sf_dir, "silver_customer").select("source_system", "source_customer_id", "source_record_id", "last_modified_timestamp", "load_batch_id", "standardized_at"), ["source_system", "source_customer_id"], [F.col("last_modified_timestamp"), F.col("load_batch_id"), F.col("standardized_at")])
    return resolution.identity_rows(clusters, records)


def dedupe_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest row of each match, and of each cluster."""
    p = table(spark, sf_dir, "customer_match_predictions")
    m = history.latest_by(p.select("match_id", "predicted_at", "load_batch_id", "match_probability"), ["match_id"], [F.col("predicted_at"), F.col("load_batch_id"), F.col("match_probability")])
    c = history.latest_by(table(spark, sf_dir, "customer_clusters").select("cluster_id", "updated_at", "load_batch_id", "cluster_size"), ["cluster_id"], [F.col("updated_at"), F.col("load_batch_id"), F.col("cluster_size")])
    return m.select(F.lit("match").alias("kind"), F.col("match_id").alias("id"), "load_batch_id", F.col("match_probability").cast("double").alias("figure")).unionByName(c.select(F.lit("cluster").alias("kind"), F.col("cluster_id").alias("id"), "load_batch_id", F.col("cluster_size").cast("double").alias("figure")))


def change_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = table(spark, sf_dir, "silver_customer_change_history").select("source_system", "source_customer_id", "effective_from", "captured_at", "change_id", "current_record_hash")
    over = Window.partitionBy("source_system", "source_customer_id").orderBy(F.col("effective_from").asc_nulls_last(), F.col("captured_at").asc_nulls_last(), "change_id")
    return h.select("change_id", F.lag("current_record_hash").over(over).alias("previous_hash"), F.when(F.lead("change_id").over(over).isNull(), "CURRENT").otherwise("HISTORICAL").alias("change_type"))


_STATE = ["source_customer_id", "record_hash", "email", "load_batch_id"]


def _states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The table after all loads but the newest of each system, the newest loads, and the table after all, by record; each with is_deleted."""
    df = table(spark, sf_dir, "silver_customer").select(*_STATE, "source_system", "standardized_at", "is_deleted")
    newest = df.groupBy("source_system").agg(F.max("load_batch_id").alias("newest"))  # one row a system
    marked = df.join(F.broadcast(newest), "source_system")
    order = [F.col("standardized_at"), F.col("load_batch_id"), F.col("record_hash")]
    state = lambda rows: history.latest_by(rows.select(*_STATE, "standardized_at", "is_deleted"), ["source_customer_id"], order).select(*_STATE, "is_deleted")
    return state(marked.where("load_batch_id < newest")), state(marked.where("load_batch_id = newest")), state(marked)


def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source, _ = _states(spark, sf_dir)
    return history.upsert(target.select(*_STATE), source.select(*_STATE), ["source_customer_id"], preserve=("load_batch_id",))


def upsert_hash_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source, _ = _states(spark, sf_dir)
    return history.upsert(target.select(*_STATE), source.select(*_STATE), ["source_customer_id"], hash_column="record_hash")


def insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appending the newest loads to the table: what is run twice is there twice."""
    target, source, _ = _states(spark, sf_dir)
    both = target.select(*_STATE).unionByName(source.select(*_STATE)).unionByName(source.select(*_STATE))
    return both.groupBy("load_batch_id").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("source_customer_id").alias("records"))


def scd2_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot at t1 of the table before the newest loads, and one at t2 after them, from which deleted records are gone."""
    old, _, new = _states(spark, sf_dir)
    schema = "source_customer_id string, email string, row_hash string, valid_from string, valid_to string"
    first = history.snapshot_merge(spark.createDataFrame([], schema), old, ["source_customer_id"], ["email"], F.lit("t1"))
    both = history.snapshot_merge(materialize(first, "dimension"), new.where("not coalesce(is_deleted, false)"), ["source_customer_id"], ["email"], F.lit("t2"))
    return both.drop("row_hash")


_IN = ", ".join(f"'{s}'" for s in resolution.STAND_INS)
_known = lambda c: f"case when lower(trim({c})) not in ({_IN}) then lower({_space(c)}) end"
_ROWS = f"""
with latest as (select * from (select *, row_number() over (partition by source_system, source_customer_id order by last_modified_timestamp desc nulls last, load_batch_id desc nulls last, standardized_at desc nulls last) k
  from silver_customer where not coalesce(is_deleted, false)) where k = 1),
rows_ as (select source_customer_id as id, {_known('email')} as email,
  case when phone <> '12345' and not regexp_matches(regexp_replace(phone, '[^0-9]', '', 'g'), '^(0+|1+|9+)$') then {_phone('phone')} end as phone,
  nullif(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({_null('website_domain')}), '^https?://', ''), '[/?#].*$', ''), ':\\d+$', ''), '^www\\.', ''), '') as website_domain,
  {_known('company_name')} as company_name, {_known('address')} as address from latest),
keys as (select id, 'e' || email k from rows_ where email is not null union all select id, 'p' || phone from rows_ where phone is not null union all select id, 'w' || website_domain from rows_ where website_domain is not null
  union all select id, 'c' || company_name from rows_ where company_name is not null union all select id, 'a' || address from rows_ where address is not null),
pairs as (select distinct l.id as "left", r.id as "right" from keys l join keys r on l.k = r.k and l.id < r.id)
"""
# the SQL engine counts edits in bytes: letters of several bytes become capitals, which the lower-case values don't have
_bytes = lambda x: f"translate({x}, 'äöüßéèáàíìóòúùñçâêîôûåøæ', 'ABCDEFGHIJKLMNOPQRSTUVWX')"
_sim = lambda f, exact: f"case when l.{f} is null or r.{f} is null then null when l.{f} = r.{f} then 1.0 else " + ("0.0" if exact else f"round(cast(greatest(0.0, 1.0 - levenshtein({_bytes(f'l.{f}')}, {_bytes(f'r.{f}')})::double / nullif(greatest(length(l.{f}), length(r.{f})), 0)) as decimal(38,10)), 8)::double") + " end"
_W = resolution.WEIGHTS
_SCORES = _ROWS + f""",
s as (select p."left", p."right", {', '.join(f"({_sim(f, f not in resolution.THRESHOLDS)})::double as {f}" for f in _W)} from pairs p join rows_ l on l.id = p."left" join rows_ r on r.id = p."right"),
m as (select *, round(cast(({' + '.join(f'coalesce({f}, 0) * {w}::double' for f, w in _W.items())}) / nullif({' + '.join(f'case when {f} is not null then {w}::double else 0 end' for f, w in _W.items())}, 0) as decimal(38,10)), 8)::double match_probability from s),
scored as (select *, round(cast(least(1.0, 0.85::double * match_probability + 0.10::double * ({' + '.join(f'case when {f} is not null then 1 else 0 end' for f in _W)}) / 5.0 +
  case when coalesce(email >= 1, false) or coalesce(phone >= 1, false) or (coalesce(company_name >= 0.92, false) and coalesce(website_domain >= 1, false)) then 0.05::double else 0 end) as decimal(38,10)), 8)::double confidence,
  coalesce({', '.join(f"case when {f} = 1 then 'l.{f} = r.{f}' end" for f in _W)}) blocking_rule from m)
"""
_STATES = """
with m as (select s.*, n.newest from silver_customer s join (select source_system, max(load_batch_id) newest from silver_customer group by 1) n using (source_system)),
old as (select * from (select *, row_number() over (partition by source_customer_id order by standardized_at desc nulls last, load_batch_id desc nulls last, record_hash desc nulls last, email desc nulls last, is_deleted desc nulls last) k from m where load_batch_id < newest) where k = 1),
new as (select * from (select *, row_number() over (partition by source_customer_id order by standardized_at desc nulls last, load_batch_id desc nulls last, record_hash desc nulls last, email desc nulls last, is_deleted desc nulls last) k from m where load_batch_id = newest) where k = 1),
now as (select * from (select *, row_number() over (partition by source_customer_id order by standardized_at desc nulls last, load_batch_id desc nulls last, record_hash desc nulls last, email desc nulls last, is_deleted desc nulls last) k from m) where k = 1 and not coalesce(is_deleted, false))
"""
_valid = {"email": "regexp_matches(email, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$')", "phone": "length(regexp_replace(phone, '[^0-9]', '', 'g')) >= 7"}

_sound = _valid | {"address": "length(address) >= 8"}
_order = "coalesce(source_priority, 100), coalesce(data_quality_score, 0) desc, coalesce(completeness_score, 0) desc, last_modified_timestamp desc nulls last"
_GOLDEN = f"""
with m as (select distinct cluster_id, source_system, source_customer_id from customer_identity_map where is_current),
live as (select * from (select *, row_number() over (partition by source_system, source_customer_id order by last_modified_timestamp desc nulls last, load_batch_id desc nulls last, standardized_at desc nulls last) k from silver_customer) where k = 1 and not coalesce(is_deleted, false)),
j as (select m.cluster_id, r.* exclude (k) from m join live r using (source_system, source_customer_id)),
cl as (select * from (select *, row_number() over (partition by cluster_id order by updated_at desc nulls last, representative_source_system desc) k from customer_clusters) where k = 1),
pr as (select j.cluster_id, source_system, source_customer_id, row_number() over (partition by j.cluster_id order by case when source_system = c.representative_source_system and source_customer_id = c.representative_source_customer_id then 0 else 1 end, {_order}, source_system, source_customer_id) k from j left join cl c using (cluster_id)),
base as (select cluster_id, strftime(min(created_date), '%Y-%m-%d %H:%M:%S') first_seen, strftime(max(last_modified_timestamp), '%Y-%m-%d %H:%M:%S') last_seen, count(*) members, round(cast(sum(cast(coalesce(data_quality_score, 0) as decimal(18,4)))::double / count(*) as decimal(38,10)), 4)::double quality from j group by 1)
"""
_RECURSIVE = _SCORES.replace("\nwith latest", "\nwith recursive latest").replace("select source_customer_id as id,", "select source_system, source_customer_id as id,") + """,
links as (select "left" a, "right" b from scored where match_probability >= 0.95 union select "right", "left" from scored where match_probability >= 0.95),
reach(id, other) as (select a, b from links union select r.id, l.b from reach r join links l on r.other = l.a),
roots as (select id, least(id, min(other)) as root from reach group by id),
memb as (select r.id, r.source_system, coalesce(root, r.id) root from rows_ r left join roots using (id)),
cls as (select root, string_agg(source_system || ':' || id, '|' order by source_system, id) t, count(*)::int cluster_size, string_agg(id, ',' order by source_system, id) source_customer_ids, array_to_string(list_sort(list(distinct source_system)), ',') source_systems, arg_min(id, (source_system, id)) rep, arg_min(source_system, (source_system, id)) rep_s from memb group by 1),
fig as (select m.root, max(match_probability) best, round(cast(sum(match_probability::decimal(18,8))::double / count(*) as decimal(38,10)), 8)::double mean, round(cast(sum(confidence::decimal(18,8))::double / count(*) as decimal(38,10)), 8)::double conf, array_to_string(list_sort(list(distinct blocking_rule)), ',') rules from scored s join memb m on m.id = s."left" where match_probability >= 0.95 group by 1),
clt as (select 'cluster_' || left(sha256(t), 24) as cluster_id, 'gold_' || left(sha256(t), 24) as golden_customer_id, cls.*, coalesce(best, 1.0) best, coalesce(mean, 1.0) mean, coalesce(conf, 1.0) conf, coalesce(rules, '') rules from cls left join fig using (root))
"""

QUERIES = {
    "match_predictions": match_predictions, "cluster_table": cluster_table, "cluster_rollup": cluster_rollup, "identity_rows": identity_rows, "dedupe_predictions": dedupe_predictions, "insert_only": insert_only,
    "candidate_pairs": candidate_pairs, "pair_similarities": pair_similarities, "pair_seq_ratio": pair_seq_ratio, "pair_scores": pair_scores, "clusters": clusters, "duplicate_reduction": duplicate_reduction, "cluster_stats": cluster_stats, "identity_map": identity_map,
    "golden_master": golden_master, "change_history": change_history, "upsert_merge": upsert_merge, "upsert_hash_guard": upsert_hash_guard, "scd2_snapshot": scd2_snapshot,
}

ORACLE = {
    "candidate_pairs": _ROWS + 'select "left", "right" from pairs',
    "pair_scores": _SCORES + 'select "left", "right", email, phone, website_domain, company_name, address, match_probability, confidence, blocking_rule from scored',
    "clusters": _SCORES.replace("\nwith latest", "\nwith recursive latest") + """,
links as (select "left" a, "right" b from scored where match_probability >= 0.95 union select "right", "left" from scored where match_probability >= 0.95),
reach(id, other) as (select a, b from links union select r.id, l.b from reach r join links l on r.other = l.a)
select id, least(id, min(other)) as root from reach group by id""",
    "duplicate_reduction": "select count(distinct cluster_id) as clusters, count(distinct source_customer_id) as members, round(cast(1 - count(distinct cluster_id)::double / nullif(count(distinct source_customer_id), 0) as decimal(38,10)), 4)::double as reduction from customer_identity_map where is_current",
    "cluster_stats": """select cluster_id, count(distinct source_customer_id) as size, max(match_probability)::double as best, round(cast(sum(match_probability)::double / count(match_probability) as decimal(38,10)), 6)::double as mean,
array_to_string(list_sort(list(distinct source_system)), ', ') as systems from (select distinct cluster_id, source_system, source_customer_id, match_probability from customer_identity_map where is_current) group by 1""",
    "identity_map": "select golden_customer_id, source_system, source_customer_id, cluster_id, is_primary_source from (select *, row_number() over (partition by golden_customer_id, source_system, source_customer_id order by active_from desc nulls last, cluster_id desc, is_primary_source desc) k from customer_identity_map where is_current) where k = 1",
    "golden_master": _GOLDEN + f"""
select base.*, {', '.join((f"regexp_replace({f}_w.v, '[^0-9]', '', 'g')" if f == 'phone' else f'{f}_w.v') + f' as {f}' for f in GOLDEN)}, pr.source_system as primary_source_system, pr.source_customer_id as primary_source_customer_id,
  round(cast(({' + '.join(f'case when {f}_w.v is not null then 1 else 0 end' for f in ('company_name', 'email', 'phone', 'address'))}) / 4.0 as decimal(38,10)), 4)::double as completeness, coalesce(c.avg_match_probability::double, 1.0) as confidence_score,
  to_json({{{', '.join(f"'{f}': case when {f}_w.v is not null then {{'source_system': {f}_w.source_system, 'source_customer_id': {f}_w.source_customer_id, 'value': {f}_w.v, 'confidence': {f}_w.sure::varchar}} else {{'source_system': null, 'source_customer_id': null, 'value': null, 'confidence': null}} end" for f in GOLDEN)}}})::varchar as survivorship
from base left join cl c using (cluster_id) left join pr on pr.cluster_id = base.cluster_id and pr.k = 1
{' '.join(f"left join (select cluster_id, source_system, source_customer_id, {f} v, round(cast(least(1.0, coalesce(data_quality_score, 0)::double * 0.5 + coalesce(completeness_score, 0)::double * 0.3 + case when {_sound.get(f, 'true')} then 0.2 else 0.1 end) as decimal(38,10)), 4)::decimal(5,4) sure, row_number() over (partition by cluster_id order by {_order}{f', length({f}) desc' if f in ('company_name', 'address') else ''}, source_system, source_customer_id) k from j where trim({f}) <> '' and {_valid.get(f, 'true')}) {f}_w on {f}_w.cluster_id = base.cluster_id and {f}_w.k = 1" for f in GOLDEN)}""",
    "change_history": "select change_id, lag(current_record_hash) over w as previous_hash, case when lead(change_id) over w is null then 'CURRENT' else 'HISTORICAL' end as change_type from silver_customer_change_history window w as (partition by source_system, source_customer_id order by effective_from nulls last, captured_at nulls last, change_id)",
    "upsert_merge": _STATES + "select source_customer_id, case when n.source_customer_id is not null then n.record_hash else t.record_hash end as record_hash, case when n.source_customer_id is not null then n.email else t.email end as email, case when t.source_customer_id is not null then t.load_batch_id else n.load_batch_id end as load_batch_id from old t full join new n using (source_customer_id)",
    "upsert_hash_guard": _STATES + "select source_customer_id, " + ", ".join(f"case when n.source_customer_id is not null and (t.source_customer_id is null or coalesce(n.record_hash, '') <> coalesce(t.record_hash, '')) then n.{c} else t.{c} end as {c}" for c in ("record_hash", "email", "load_batch_id")) + " from old t full join new n using (source_customer_id)",
    "insert_only": _STATES + 'select load_batch_id, count(*) as "rows", count(distinct source_customer_id) as records from (select source_customer_id, load_batch_id from old union all select source_customer_id, load_batch_id from new union all select source_customer_id, load_batch_id from new) group by 1',
    "scd2_snapshot": _STATES + """
select o.source_customer_id, o.email, 't1' as valid_from, case when n.source_customer_id is null or o.email is distinct from n.email then 't2' end as valid_to from old o left join now n using (source_customer_id)
union all select n.source_customer_id, n.email, 't2', null from now n left join old o using (source_customer_id) where o.source_customer_id is null or o.email is distinct from n.email""",
    "pair_similarities": _ROWS + f"""select p."left", p."right", case when l.email is null or r.email is null then null when l.email = r.email then 1.0 else 0.0 end::double as email_exact, ({_sim('company_name', False)})::double as name_edits,
  round(cast(round(jaro_winkler_similarity({_bytes('l.company_name')}, {_bytes('r.company_name')}), 8) as decimal(38,10)), 4)::double as name_jaro_winkler from pairs p join rows_ l on l.id = p."left" join rows_ r on r.id = p."right" """,
    "match_predictions": _SCORES.replace("select source_customer_id as id,", "select source_system, source_customer_id as id,") + """
select 'match_' || left(sha256(case when (l.source_system, l.id) <= (r.source_system, r.id) then l.source_system || ':' || l.id || '|' || r.source_system || ':' || r.id else r.source_system || ':' || r.id || '|' || l.source_system || ':' || l.id end), 24) as match_id,
  l.source_system as left_source_system, l.id as left_source_customer_id, r.source_system as right_source_system, r.id as right_source_customer_id, match_probability, confidence as confidence_score,
  to_json({""" + ", ".join(f"'{f}': s.{f}::decimal(10,8)::varchar" for f in _W) + """})::varchar as comparison_vector, blocking_rule, 'confluo_rules_v1' as model_version
from scored s join rows_ l on l.id = s."left" join rows_ r on r.id = s."right" """,
    "cluster_table": _RECURSIVE + "select cluster_id, golden_customer_id, cluster_size, source_customer_ids, source_systems, rep_s as representative_source_system, rep as representative_source_customer_id, best as max_match_probability, mean as avg_match_probability, conf as confidence_score, rules as cluster_rules from clt",
    "identity_rows": _RECURSIVE + """, rec as (select source_system, source_customer_id, source_record_id from (select *, row_number() over (partition by source_system, source_customer_id order by last_modified_timestamp desc nulls last, load_batch_id desc nulls last, standardized_at desc nulls last) k from silver_customer) where k = 1)
select golden_customer_id, cluster_id, m.source_system, m.id as source_customer_id, source_record_id, conf as match_probability, m.source_system = rep_s and m.id = rep as is_primary_source from clt join memb m using (root) left join rec on rec.source_system = m.source_system and rec.source_customer_id = m.id""",
    "cluster_rollup": "select count(*) as total_clusters, sum(cluster_size)::bigint as total_members, round(cast(sum(avg_match_probability::decimal(18,8))::double / count(avg_match_probability) as decimal(38,10)), 4)::double as match_accuracy from (select *, row_number() over (partition by cluster_id order by updated_at desc nulls last, golden_customer_id desc, cluster_size desc) k from customer_clusters) where k = 1",
    "dedupe_predictions": """select 'match' as kind, match_id as id, load_batch_id, match_probability::double as figure from (select *, row_number() over (partition by match_id order by predicted_at desc nulls last, load_batch_id desc nulls last, match_probability desc nulls last) k from customer_match_predictions) where k = 1
union all select 'cluster', cluster_id, load_batch_id, cluster_size::double from (select *, row_number() over (partition by cluster_id order by updated_at desc nulls last, load_batch_id desc nulls last, cluster_size desc nulls last) k from customer_clusters) where k = 1""",
}
