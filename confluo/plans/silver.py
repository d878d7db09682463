"""From raw rows of six systems to standardised customers and partners, with the marks that make it incremental."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scores, text
from ..operators import quality
from ..operators.history import latest_by, upsert
from ..sources import files, systems
from ..runtime import table
from . import texts

FORM = "yyyy-MM-dd HH:mm:ss"
HASHED = ("source_system", "source_customer_id", "company_name", "email", "phone", "address", "modified")
SCORED = ("company_name", "email", "phone", "address", "industry", "last_modified_timestamp")


def standardised(rows: DataFrame) -> DataFrame:
    """Conformed rows with standardised values, scores and hash; rows without a customer key are left out."""
    c = F.col
    rows = rows.where("source_customer_id is not null").select(
        "source_system", "source_customer_id", "source_record_id", text.company_name(c("company_name")).alias("company_name"), text.company_key(c("company_name")).alias("company_name_normalized"),
        text.email(c("email")).alias("email"), text.email_domain(c("email")).alias("email_domain"), text.phone(c("phone")).alias("phone"), text.address(c("address_line_1")).alias("address_line_1"), text.address(c("address_line_2")).alias("address_line_2"),
        text.name(c("city")).alias("city"), text.state(c("state_region")).alias("state_region"), text.postal(c("postal_code")).alias("postal_code"), text.country(c("country")).alias("country"), text.website(c("website")).alias("website_domain"),
        text.clean_text(c("industry")).alias("industry"), text.clean_text(c("customer_status")).alias("customer_status"), "created_date", "last_modified_timestamp", "is_deleted", "source_priority", "load_batch_id",
    )
    rows = rows.withColumn("address", text.combine_address(*[c(x) for x in ("address_line_1", "city", "state_region", "postal_code", "country")]))
    rows = rows.withColumns({"issues": quality.customer_issues(), "completeness_score": quality.completeness(SCORED), "modified": F.date_format("last_modified_timestamp", FORM)})
    rows = rows.withColumn("data_quality_score", quality.quality_score(c("completeness_score"), c("issues")))
    return rows.withColumn("record_hash", F.sha2(F.to_json(F.struct(*HASHED), {"ignoreNullFields": "false"}), 256)).withColumn("standardization_version", F.lit("v1")).drop("issues", "modified")


def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a system and customer, the latest by modification, then by load (a missing load is newest)."""
    rows = standardised(systems.all_conformed(spark, sf_dir))
    return latest_by(rows, ["source_system", "source_customer_id"], [F.col("last_modified_timestamp"), F.col("load_batch_id").isNull(), F.col("load_batch_id")])


def _as_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.date_format(c, FORM) for c in ("created_date", "last_modified_timestamp")})


def silver_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(silver_rows(spark, sf_dir))


def silver_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after all loads but the newest of each system, and then the newest merged in: a row is updated only if its hash changed."""
    rows = standardised(systems.all_conformed(spark, sf_dir))
    newest = rows.groupBy("source_system").agg(F.max("load_batch_id").alias("newest"))  # one row a system
    marked = rows.join(F.broadcast(newest), "source_system")
    keys, order = ["source_system", "source_customer_id"], [F.col("last_modified_timestamp"), F.col("load_batch_id").isNull(), F.col("load_batch_id")]
    before = latest_by(marked.where("load_batch_id < newest").drop("newest"), keys, order)
    batch = latest_by(marked.where("load_batch_id >= newest or load_batch_id is null").drop("newest"), keys, order)
    return upsert(before, batch, keys, hash_column="record_hash").select("source_system", "source_customer_id", "record_hash", "load_batch_id", "data_quality_score")


def bronze_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [systems.bronze_model(systems.raw(spark, sf_dir, s), s).select("source_system", "source_record_id", "load_batch_id", "is_deleted", F.date_format("last_modified_timestamp", FORM).alias("modified"), "record_hash") for s in systems.RAW]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def bronze_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit columns around raw rows as they come from an extract."""
    rows = systems.raw(spark, sf_dir, "LICENSING").select("customer_id", "company_name", "email", "renewal_status")
    out = files.bronze(rows, "LICENSING", "licenses", ["customer_id"], "run-1", F.lit("2026-01-01 00:00:00"))
    return out.select("source_record_id", "source_system", "source_object", "load_batch_id", "load_timestamp", "raw_payload")


_MARK = "2025-01-01 00:00:00"


def incremental_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows after the middle of each system's time, by the mark as text; a row without a time is always loaded."""
    rows = table(spark, sf_dir, "silver_customer").select("source_system", "source_customer_id", "load_batch_id", F.date_format("last_modified_timestamp", FORM).alias("mark"))
    return rows.where(files.newer_than("mark", _MARK))


def watermark_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "silver_customer").select("source_system", F.date_format("last_modified_timestamp", FORM).alias("mark"))
    return rows.groupBy("source_system").agg(files.mark_of(rows, "mark").alias("new_mark"))


def records_with_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and the priority lookup; the stored priority where the lookup has none, else 100."""
    rows = table(spark, sf_dir, "silver_customer").select("source_system", "source_customer_id", "load_batch_id", F.col("source_priority").alias("stored"))
    joined = rows.join(F.broadcast(systems.priorities(spark)), "source_system", "left")  # six rows
    return joined.select("source_system", "source_customer_id", "load_batch_id", F.coalesce("source_priority", "stored", F.lit(100)).alias("priority"))


def partner_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest partners, standardised, validated and scored."""
    c = F.col
    latest = latest_by(table(spark, sf_dir, "silver_partner_profile"), ["source_system", "partner_id"], [c("last_modified_timestamp"), c("load_batch_id"), c("standardized_at")])
    rows = latest.select(
        "source_system", "partner_id", text.company_name(c("company_name")).alias("company_name"), text.company_key(c("company_name")).alias("company_name_normalized"), text.email(c("email")).alias("email"), text.phone(c("phone")).alias("phone"),
        text.clean_text(c("partner_tier")).alias("partner_tier"), text.clean_text(c("partner_region")).alias("partner_region"), text.clean_text(c("partner_status")).alias("partner_status"),
        F.array_join(text.certifications(F.to_json("certifications")), ",").alias("certifications"), F.coalesce(F.size("certifications"), F.lit(0)).alias("certification_count"), F.coalesce("is_deleted", F.lit(False)).alias("is_deleted"),
    )
    rows = rows.withColumns({"issues": quality.partner_issues(), "completeness_score": quality.completeness(("company_name", "email", "phone", "partner_tier", "partner_region"))})
    return rows.withColumn("data_quality_score", quality.quality_score(c("completeness_score"), c("issues"))).withColumn("issues", F.array_join("issues", ","))


def silver_partner_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partner_rows(spark, sf_dir).drop("issues")


def validate_partner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partner_rows(spark, sf_dir).select("source_system", "partner_id", "issues", (~F.col("issues").rlike("(^|,)[^w]")).alias("is_valid"))


def text_certifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes as a JSON text for even lengths of the id, else with commas: both readings."""
    rows = table(spark, sf_dir, "silver_partner_profile").select("partner_id", "load_batch_id", "certifications")
    typed = F.when(F.col("partner_id").rlike("[02468]$"), F.to_json("certifications")).otherwise(F.array_join("certifications", " , "))
    return rows.select("partner_id", "load_batch_id", F.array_join(text.certifications(typed), "|").alias("codes"), F.size(text.certifications(typed)).alias("n"))


def feature_utilization(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of enabled features in JSON objects and lists made of the events' values, and a stated score by its path."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", F.get_json_object("props", "$.k").cast("int").alias("k"))
    on = lambda x: F.when(x, F.lit("true")).otherwise(F.lit("false"))
    objects = F.concat(F.lit('{"a": '), on(F.col("k") % 2 == 0), F.lit(', "b": '), (F.col("k") % 3).cast("string"), F.lit(', "c": '), F.when(F.col("k") % 5 == 0, '""').otherwise('"false"'), F.lit(', "d": null, "score": '), (F.col("k") / 100).cast("string"), F.lit("}"))
    lists = F.concat(F.lit("[0, [], {}, "), (F.col("k") % 2).cast("string"), F.lit(', "x"]'))
    usage = F.when(F.col("event_type") == "view", lists).when(F.col("event_type") == "signup", F.lit("{}")).when(F.col("event_type") == "error", F.lit("not json")).otherwise(objects)
    score = F.get_json_object(usage, "$.score").try_cast("double")
    return e.select("event_id", text.enabled_share(usage).alias("share"), score.alias("stated"))


def text_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, whole numbers, times and days of the typed phones, postal codes and times of the customers."""
    c = F.col
    t = table(spark, sf_dir, "silver_customer").select("source_customer_id", "load_batch_id", "postal_code", F.concat(F.date_format("last_modified_timestamp", "yyyy-MM-dd'T'HH:mm:ss"), F.when(c("source_system") == "MARKETO", "Z").otherwise("")).alias("iso"), c("phone"))
    return t.select("source_customer_id", "load_batch_id", text.as_number(c("postal_code")).alias("number"), text.as_integer(F.concat(F.substring("phone", 1, 3), F.lit(".9"))).cast("string").alias("whole"), F.date_format(text.as_time(c("iso")), FORM).alias("at"), text.day_of(c("iso")).alias("day"), F.date_format(text.as_time(c("phone")), FORM).alias("no_time"))


def text_stable_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the clusters over their current members, and of quality rules over three parts."""
    m = table(spark, sf_dir, "customer_identity_map").where("is_current").select("cluster_id", "source_system", "source_customer_id").distinct()
    g = m.groupBy("cluster_id").agg(F.collect_set(F.struct("source_system", "source_customer_id")).alias("members"))
    return g.select("cluster_id", text.stable_id("cluster_", F.col("members")).alias("stable_cluster"), text.stable_id("gold_", F.col("members")).alias("stable_golden"), F.substring(F.sha2(F.concat_ws("|", "cluster_id", F.lit("rule"), F.lit("suite")), 256), 1, 32).alias("rule_id"))


def lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last 90 and 180 days before the newest one of the table."""
    rows = table(spark, sf_dir, "silver_customer").select("source_system", F.to_date("last_modified_timestamp").alias("d"))
    as_of = rows.agg(F.max("d").alias("as_of"))
    marked = rows.crossJoin(F.broadcast(as_of))  # one row
    return marked.groupBy("source_system").agg(F.count_if(F.col("d") >= F.date_sub("as_of", 90)).alias("last_90"), F.count_if(F.col("d") >= F.date_sub("as_of", 180)).alias("last_180"), F.count_if(F.col("d") > F.date_add(F.lit("2025-06-30").cast("date"), 0)).alias("future"), F.count_if(F.col("d").isNull()).alias("undated"))


def address_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether an address can survive: at least eight characters; and null-safe equality of city and state, null as ''."""
    rows = table(spark, sf_dir, "silver_customer")
    return rows.select("source_customer_id", "load_batch_id", F.coalesce(F.length(F.trim("address")) >= 8, F.lit(False)).alias("valid"), (F.coalesce("city", F.lit("")) == F.coalesce("state_region", F.lit(""))).alias("same"))


def metric_daily_py(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The usage score of an account and day with the sum capped, not its parts."""
    e = table(spark, sf_dir, "events").groupBy(F.col("user_id").cast("string").alias("account"), F.to_date("ts").cast("string").alias("metric_date")).agg(F.count(F.lit(1)).alias("logins"), F.count_distinct("event_type").alias("users"))
    return e.select("account", "metric_date", scores.r(F.least(F.lit(1.0), F.col("logins") * 7 / 100.0 * 0.4 + F.lit(1) / 30.0 * 0.3 + F.col("users") / 50.0 * 0.3)).alias("usage_score"))


def _sql_raw(system: str) -> str:
    mapped = ", ".join(f"{e.replace('string', 'varchar')} as {c}" for c, e in systems.RAW[system].items())
    if system == "IMPARTNER":
        return f"select null::varchar as source_record_id, {mapped}, null::timestamp as created_date, last_modified_timestamp, is_deleted, load_batch_id, standardized_at as load_timestamp from silver_partner_profile"
    return f"select source_record_id, {mapped}, created_date, last_modified_timestamp, is_deleted, load_batch_id, standardized_at as load_timestamp from silver_customer where source_system = '{system}'"


_filled = lambda cols: "coalesce(" + ", ".join(f"nullif(trim({c}), '')" for c in cols) + ")"


def _sql_bronze(system: str) -> str:
    inner = _sql_raw(system)
    if "customer_day" in systems.RECORD_ID[system]:
        inner = f"select *, case when customer_id is not null and event_date is not null then customer_id || '-' || event_date::varchar end customer_day from ({inner})"
    return f"select * replace ({_filled(systems.RECORD_ID[system])} as source_record_id, coalesce(last_modified_timestamp, load_timestamp) as last_modified_timestamp, coalesce(is_deleted, false) as is_deleted, coalesce(load_batch_id, 'run') as load_batch_id), '{system}' as source_system from ({inner}) where {_filled(systems.RECORD_ID[system])} is not null"


def _sql_model(system: str) -> str:
    key = ", ".join(f"coalesce({c}::varchar, '__null__')" for c in ("source_record_id", *systems.RAW[system]))
    return f"select source_system, source_record_id, load_batch_id, is_deleted, strftime(last_modified_timestamp, '%Y-%m-%d %H:%M:%S') as modified, sha256(concat_ws('||', {key})) as record_hash from ({_sql_bronze(system)})"


def _sql_conformed(system: str) -> str:
    have = systems.CONFORMED[system]
    cells = ", ".join(f"{have.get(c, c) if have.get(c, c) in systems.RAW[system] else 'null::varchar'} as {c}" for c in systems.IDENTITY)
    return f"select source_system, {_filled(systems.CUSTOMER_KEY[system])} as source_customer_id, source_record_id, {cells}, created_date, last_modified_timestamp, is_deleted, {systems.PRIORITY[system]} as source_priority, load_batch_id from ({_sql_bronze(system)})"


_state, _postal, _country, _website, _domain = (texts.TEXTS[k][2] for k in ("text_state", "text_postal", "text_country", "text_website", "text_email_domain"))
_clean = lambda x: texts._CLEAN.format(x=x)
_STANDARD = f"""
with conformed as ({' union all '.join(_sql_conformed(s) for s in systems.CONFORMED)}),
std as (select source_system, source_customer_id, source_record_id, {texts._company('company_name')} as company_name, {texts._key('company_name')} as company_name_normalized, lower({texts._null('email')}) as email, {_domain} as email_domain,
  {texts._phone('phone')} as phone, {texts._address('address_line_1')} as address_line_1, {texts._address('address_line_2')} as address_line_2, {texts._name('city')} as city, {_state} as state_region, {_postal} as postal_code, {_country} as country,
  {_website.replace('website_domain', 'website')} as website_domain, {_clean('industry')} as industry, {_clean('customer_status')} as customer_status, created_date, last_modified_timestamp, is_deleted, source_priority, load_batch_id
  from conformed where source_customer_id is not null),
joined as (select *, nullif(concat_ws(' ', nullif(address_line_1, ''), nullif(city, ''), nullif(state_region, ''), nullif(postal_code, ''), nullif(country, '')), '') as address from std),
scored as (select *, round(cast(({' + '.join(f"case when coalesce(trim(cast({f} as varchar)), '') <> '' then 1 else 0 end" for f in SCORED)}) / 6.0 as decimal(38,10)), 4)::double as completeness_score,
  case when coalesce(trim(company_name), '') = '' and coalesce(trim(email), '') = '' and coalesce(trim(phone), '') = '' then 1 else 0 end + case when trim(email) <> '' and not regexp_matches(email, '{text.EMAIL}') then 1 else 0 end as errors,
  case when trim(phone) <> '' and length(regexp_replace(phone, '[^0-9]', '', 'g')) not between 7 and 15 then 1 else 0 end as warnings from joined),
done as (select * exclude (errors, warnings), greatest(0.0, round(cast(completeness_score - 0.25 * errors - 0.1 * warnings as decimal(38,10)), 4)::double) as data_quality_score,
  sha256(to_json({{'source_system': source_system, 'source_customer_id': source_customer_id, 'company_name': company_name, 'email': email, 'phone': phone, 'address': address, 'modified': strftime(last_modified_timestamp, '%Y-%m-%d %H:%M:%S')}})::varchar) as record_hash, 'v1' as standardization_version from scored)
"""
_RANK = "row_number() over (partition by source_system, source_customer_id order by last_modified_timestamp desc nulls last, load_batch_id desc nulls first, {tie})"
_TIE = "source_record_id desc nulls last, company_name desc nulls last, company_name_normalized desc nulls last, email desc nulls last, email_domain desc nulls last, phone desc nulls last, address_line_1 desc nulls last, city desc nulls last, state_region desc nulls last, postal_code desc nulls last, country desc nulls last, website_domain desc nulls last, industry desc nulls last, customer_status desc nulls last, created_date desc nulls last, is_deleted desc"

QUERIES = {
    "silver_customer": silver_customer, "silver_increment": silver_increment, "bronze_models": bronze_models, "bronze_prepare": bronze_prepare, "incremental_filter": incremental_filter, "watermark_max": watermark_max,
    "records_with_priority": records_with_priority, "silver_partner_profile": silver_partner_profile, "validate_partner": validate_partner, "text_certifications": text_certifications, "feature_utilization": feature_utilization,
    "text_numbers": text_numbers, "text_stable_id": text_stable_id, "lookback": lookback, "address_valid": address_valid, "silver_metric_daily_py": metric_daily_py,
}

_PARTNER = f"""
with p as (select * from (select *, row_number() over (partition by source_system, partner_id order by last_modified_timestamp desc nulls last, load_batch_id desc nulls last, standardized_at desc nulls last) k from silver_partner_profile) where k = 1),
s as (select source_system, partner_id, {texts._company('company_name')} as company_name, {texts._key('company_name')} as company_name_normalized, lower({texts._null('email')}) as email, {texts._phone('phone')} as phone,
  {_clean('partner_tier')} as partner_tier, {_clean('partner_region')} as partner_region, {_clean('partner_status')} as partner_status, coalesce(array_to_string([upper(trim(c)) for c in certifications if trim(c) <> ''], ','), '') as certifications,
  coalesce(len(certifications), 0)::int as certification_count, coalesce(is_deleted, false) as is_deleted from p),
v as (select *, [x for x in [case when coalesce(trim(source_system), '') = '' then 'source_system_required' end, case when coalesce(trim(partner_id), '') = '' then 'partner_id_required' end, case when coalesce(trim(company_name), '') = '' then 'company_name_required' end,
  case when trim(email) <> '' and not regexp_matches(email, '{text.EMAIL}') then 'valid_email' end, case when trim(phone) <> '' and length(regexp_replace(phone, '[^0-9]', '', 'g')) not between 7 and 15 then 'w:phone_length' end] if x is not null] issues,
  round(cast(({' + '.join(f"case when coalesce(trim({f}), '') <> '' then 1 else 0 end" for f in ('company_name', 'email', 'phone', 'partner_tier', 'partner_region'))}) / 5.0 as decimal(38,10)), 4)::double completeness_score from s)
"""

ORACLE = {
    "silver_customer": _STANDARD + f"select * exclude (k) replace (strftime(created_date, '%Y-%m-%d %H:%M:%S') as created_date, strftime(last_modified_timestamp, '%Y-%m-%d %H:%M:%S') as last_modified_timestamp) from (select *, {_RANK.format(tie=_TIE)} k from done) where k = 1",
    "silver_increment": _STANDARD + f""",
newest as (select source_system s, max(load_batch_id) newest from done group by 1), marked as (select * from done join newest on s = source_system),
before as (select * from (select *, {_RANK.format(tie=_TIE)} k from marked where load_batch_id < newest) where k = 1), batch as (select * from (select *, {_RANK.format(tie=_TIE)} k from marked where load_batch_id >= newest or load_batch_id is null) where k = 1)
select source_system, source_customer_id, case when b.record_hash is not null and b.record_hash is distinct from o.record_hash then b.record_hash else o.record_hash end as record_hash,
  case when b.record_hash is not null and b.record_hash is distinct from o.record_hash then b.load_batch_id else o.load_batch_id end as load_batch_id, case when b.record_hash is not null and b.record_hash is distinct from o.record_hash then b.data_quality_score else o.data_quality_score end as data_quality_score
from before o full join batch b using (source_system, source_customer_id)""",
    "bronze_models": " union all ".join(_sql_model(s) for s in systems.RAW),
    "bronze_prepare": "select nullif(trim(source_customer_id), '') as source_record_id, 'LICENSING' as source_system, 'licenses' as source_object, 'run-1' as load_batch_id, '2026-01-01 00:00:00' as load_timestamp, to_json({'customer_id': source_customer_id, 'company_name': company_name, 'email': email, 'renewal_status': customer_status})::varchar as raw_payload from silver_customer where source_system = 'LICENSING'",
    "incremental_filter": f"select source_system, source_customer_id, load_batch_id, strftime(last_modified_timestamp, '%Y-%m-%d %H:%M:%S') as mark from silver_customer where last_modified_timestamp is null or strftime(last_modified_timestamp, '%Y-%m-%d %H:%M:%S') > '{_MARK}'",
    "watermark_max": "select source_system, max(strftime(last_modified_timestamp, '%Y-%m-%d %H:%M:%S')) as new_mark from silver_customer group by 1",
    "records_with_priority": "select source_system, source_customer_id, load_batch_id, coalesce(p, source_priority, 100)::int as priority from silver_customer left join (values " + ", ".join(f"('{s}', {p})" for s, p in systems.PRIORITY.items()) + ") l(s, p) on s = source_system",
    "silver_partner_profile": _PARTNER + "select * exclude (issues, completeness_score), completeness_score, greatest(0.0, round(cast(completeness_score - 0.25 * len([x for x in issues if left(x, 2) <> 'w:']) - 0.1 * len([x for x in issues if left(x, 2) = 'w:']) as decimal(38,10)), 4)::double) as data_quality_score from v",
    "validate_partner": _PARTNER + "select source_system, partner_id, array_to_string(issues, ',') as issues, len([x for x in issues if left(x, 2) <> 'w:']) = 0 as is_valid from v",
    "text_certifications": "select partner_id, load_batch_id, coalesce(array_to_string([upper(trim(c)) for c in certifications if trim(c) <> ''], '|'), '') as codes, coalesce(len([c for c in certifications if trim(c) <> '']), 0)::int as n from silver_partner_profile",
    "feature_utilization": """with e as (select event_id, event_type, (props->>'$.k')::int k from events)
select event_id, case when event_type = 'view' then round(cast((case when k % 2 <> 0 then 2 else 1 end) / 5.0 as decimal(38,10)), 4)::double when event_type in ('signup', 'error') then null
  else round(cast((case when k % 2 = 0 then 1 else 0 end + case when k % 3 <> 0 then 1 else 0 end + case when k % 5 = 0 then 0 else 1 end + case when k <> 0 then 1 else 0 end) / 5.0 as decimal(38,10)), 4)::double end as share,
  case when event_type not in ('view', 'signup', 'error') then k / 100.0::double end as stated from e""",
    "text_numbers": """select source_customer_id, load_batch_id, try_cast(trim(postal_code) as double) as number, trunc(try_cast(trim(substring(phone, 1, 3) || '.9') as double))::bigint::varchar as whole,
strftime(last_modified_timestamp, '%Y-%m-%d %H:%M:%S') as "at", strftime(last_modified_timestamp, '%Y-%m-%d') as "day", null::varchar as no_time from silver_customer""",
    "text_stable_id": """with m as (select distinct cluster_id, source_system s, source_customer_id i from customer_identity_map where is_current), g as (select cluster_id, string_agg(s || ':' || i, '|' order by s, i) t from m group by 1)
select cluster_id, 'cluster_' || left(sha256(t), 24) as stable_cluster, 'gold_' || left(sha256(t), 24) as stable_golden, left(sha256(cluster_id || '|rule|suite'), 32) as rule_id from g""",
    "lookback": """with r as (select source_system, last_modified_timestamp::date d from silver_customer), a as (select max(d) as_of from r)
select source_system, count(*) filter (d >= as_of - 90) as last_90, count(*) filter (d >= as_of - 180) as last_180, count(*) filter (d > date '2025-06-30') as future, count(*) filter (d is null) as undated from r, a group by 1""",
    "address_valid": "select source_customer_id, load_batch_id, coalesce(length(trim(address)) >= 8, false) as valid, coalesce(city, '') = coalesce(state_region, '') as same from silver_customer",
    "silver_metric_daily_py": "select user_id::varchar as account, (ts::date)::varchar as metric_date, round(cast(least(1.0::double, count(*) * 7 / 100.0::double * 0.4::double + 1 / 30.0::double * 0.3::double + count(distinct event_type) / 50.0::double * 0.3::double) as decimal(38,10)), 4)::double as usage_score from events group by 1, ts::date",
}
