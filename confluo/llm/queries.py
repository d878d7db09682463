"""The pN_ queries of this package and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..runtime import materialize, table
from . import addresses, bpe, components, linkage, mixing, names, pieces, survivors


def p1_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = [table(spark, sf_dir, n) for n in ("silver_customer", "customer_identity_map", "customer_match_predictions")]
    return linkage.same_customers(*tables)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_pairs(spark, sf_dir).select("left_source_customer_id", "right_source_customer_id")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return addresses.same_location(table(spark, sf_dir, "silver_customer"))


def p2_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return addresses.places(table(spark, sf_dir, "silver_customer"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = survivors.survivors(table(spark, sf_dir, "customer_identity_map"), table(spark, sf_dir, "silver_customer"))
    return out.select("cluster_id", "field_name", "source_customer_id")


def p3_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors.current_values(table(spark, sf_dir, "customer_identity_map"), table(spark, sf_dir, "silver_customer"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components.prediction_groups(table(spark, sf_dir, "customer_match_predictions"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.same_organisation(table(spark, sf_dir, "silver_customer"), table(spark, sf_dir, "silver_partner_profile"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_corpus(table(spark, sf_dir, "documents"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mixture_targets"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = table(spark, sf_dir, "mixture_targets")
    mix, plan = mixing.planned_mix(table(spark, sf_dir, "documents"), targets)
    return mixing.mix_shares(materialize(mix, "mix"), targets, plan)


def p10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.split_oversized(table(spark, sf_dir, "documents"), table(spark, sf_dir, "piece_limits"))


QUERIES = {
    "p1_found": p1_found,
    "p1_pairs": p1_pairs,
    "p2_found": p2_found,
    "p2_places": p2_places,
    "p3_found": p3_found,
    "p3_current": p3_current,
    "p4_found": p4_found,
    "p5_found": p5_found,
    "p8_ids": p8_ids,
    "p9_mix": p9_mix,
    "p9_shares": p9_shares,
    "p10_pieces": p10_pieces,
}

_STAND_INS = ", ".join(f"'{s}'" for s in survivors.STAND_INS)

P3_FOUND = f"""
with ranked as (
  select *, row_number() over (partition by source_customer_id order by last_modified_timestamp desc nulls last, standardized_at desc nulls last) rn
  from silver_customer),
records as (select * from ranked where rn = 1 and not coalesce(is_deleted, false)),
members as (select distinct cluster_id, source_customer_id from customer_identity_map where is_current and cluster_id is not null),
vals as (
  select m.cluster_id, r.*, f.field_name,
    case f.field_name when 'company_name' then company_name when 'email' then email when 'phone' then phone else address end v
  from members m join records r using (source_customer_id)
  cross join (values ('company_name'), ('email'), ('phone'), ('address')) f(field_name)),
valid as (
  select * from vals where v is not null and trim(v) <> '' and lower(trim(v)) not in ({_STAND_INS})
   and (field_name <> 'email' or regexp_matches(trim(v), '^[^@\\s]*@[^@\\s]*\\.[^@\\s]*$'))
   and (field_name <> 'phone' or (length(regexp_replace(v, '[^0-9]', '', 'g')) >= 7
        and replace(regexp_replace(v, '[^0-9]', '', 'g'), left(regexp_replace(v, '[^0-9]', '', 'g'), 1), '') <> ''))),
best as (
  select *, row_number() over (partition by cluster_id, field_name order by source_priority nulls last, data_quality_score desc nulls last,
    completeness_score desc nulls last, last_modified_timestamp desc nulls last, source_customer_id) k from valid)
select cluster_id, field_name, source_customer_id from best where k = 1
"""

P4_FOUND = """
with recursive pairs as (
  select least(upper(trim(left_source_customer_id)), upper(trim(right_source_customer_id))) lo,
    greatest(upper(trim(left_source_customer_id)), upper(trim(right_source_customer_id))) hi, predicted_at, match_probability p
  from customer_match_predictions),
held as (select lo, hi, p, row_number() over (partition by lo, hi order by predicted_at desc nulls last, p desc nulls last) rn from pairs where lo < hi),
links as (select lo a, hi b from held where rn = 1 and p >= 0.95 union select hi, lo from held where rn = 1 and p >= 0.95),
reach(id, other) as (select a, b from links union select r.id, l.b from reach r join links l on r.other = l.a)
select id as source_customer_id, least(id, min(other)) as cluster_id from reach group by id
"""

_FIELD_CELLS = "cross join (values ('company_name'), ('email'), ('phone'), ('address')) f(field_name)"
_COUNTS = f"""v is not null and trim(v) <> '' and lower(trim(v)) not in ({_STAND_INS})
   and (field_name <> 'email' or regexp_matches(trim(v), '^[^@\\s]*@[^@\\s]*\\.[^@\\s]*$'))
   and (field_name <> 'phone' or (length(regexp_replace(v, '[^0-9]', '', 'g')) >= 7
        and replace(regexp_replace(v, '[^0-9]', '', 'g'), left(regexp_replace(v, '[^0-9]', '', 'g'), 1), '') <> ''))"""

P3_CURRENT = f"""
with recursive cells as (
  select source_customer_id, last_modified_timestamp, standardized_at, f.field_name,
    case f.field_name when 'company_name' then company_name when 'email' then email when 'phone' then phone else address end v,
    coalesce(is_deleted, false) gone,
    row_number() over (partition by source_customer_id, f.field_name order by last_modified_timestamp desc nulls last, standardized_at desc nulls last) rn
  from silver_customer {_FIELD_CELLS}),
good as (select * exclude (v), lower(regexp_replace(trim(v), '\\s+', ' ', 'g')) v from cells where {_COUNTS}),
members as (select distinct cluster_id, source_customer_id from customer_identity_map where is_current and cluster_id is not null),
vals as (select cluster_id, field_name, v as "value", count(distinct source_customer_id) holders from members join good using (source_customer_id) where rn = 1 and not gone group by all),
known as (select distinct cluster_id, field_name, v from members join good using (source_customer_id)),
timed as (select source_customer_id, field_name, last_modified_timestamp t, v from (
  select *, row_number() over (partition by source_customer_id, field_name, last_modified_timestamp order by standardized_at desc nulls last, v desc) k
  from good where last_modified_timestamp is not null) where k = 1),
steps as (select field_name, lag(v) over (partition by source_customer_id, field_name order by t) o, v n from timed),
net as (select field_name, least(o, n) a, greatest(o, n) b, sum(case when o < n then 1 else -1 end) s from steps where o is not null and o <> n group by all having s <> 0),
edges as (select field_name, case when s > 0 then a else b end o, case when s > 0 then b else a end n from net),
own as (select k.cluster_id, e.field_name, e.o, e.n from edges e join known k on k.field_name = e.field_name and k.v = e.o join known l on l.cluster_id = k.cluster_id and l.field_name = e.field_name and l.v = e.n),
ways as (select * from own union select w.cluster_id, w.field_name, w.o, e.n from ways w join own e on e.cluster_id = w.cluster_id and e.field_name = w.field_name and e.o = w.n),
strict as (select * from ways w where not exists (select 1 from ways b where b.cluster_id = w.cluster_id and b.field_name = w.field_name and b.o = w.n and b.n = w.o)),
late as (select s.cluster_id, s.field_name, s.o as "value", count(*) k from strict s join vals v on v.cluster_id = s.cluster_id and v.field_name = s.field_name and v."value" = s.n group by all)
select cluster_id, field_name, "value", holders, coalesce(k, 0) as later, coalesce(k, 0) > 0 as replaced from vals left join late using (cluster_id, field_name, "value")
"""

ORACLE = {"p3_found": P3_FOUND, "p3_current": P3_CURRENT, "p4_found": P4_FOUND}
