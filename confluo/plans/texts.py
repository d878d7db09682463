"""Queries of the standardisation functions over silver_customer, and row quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import quality
from ..operators.history import latest_by
from ..runtime import table
from ..sources import files


def _null(x: str) -> str:
    return f"case when trim({x}) = '' or upper(trim({x})) in ('NULL','NONE','N/A','NA') then null else trim({x}) end"


def _space(x: str) -> str:
    return f"regexp_replace({_null(x)}, '\\s+', ' ', 'g')"


def _name(x: str) -> str:
    return f"regexp_replace(upper({_space(x)}), '[^A-Z0-9 ''\\-]', '', 'g')"


def _company(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(upper({_space(x)}), '[^\\p{{L}}\\p{{N}}_& ]', ' ', 'g'), ' +', ' ', 'g'))"


def _list(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _case(table_: dict[str, str], x: str) -> str:
    return f"case {x} " + " ".join(f"when '{k}' then '{v}'" for k, v in table_.items()) + f" else {x} end"


def _key(x: str) -> str:
    kept = f"array_to_string([t for t in string_split({_company(x)}, ' ') if t not in ({_list(text.LEGAL_SUFFIXES)})], ' ')"
    return f"case when {kept} = '' then {_company(x)} else {kept} end"


def _phone(x: str) -> str:
    digits = f"regexp_replace({_null(x)}, '[^0-9]', '', 'g')"
    return f"nullif(case when length({digits}) = 11 and left({digits}, 1) = '1' then substring({digits}, 2) else {digits} end, '')"


def _address(x: str) -> str:
    words = f"string_split(regexp_replace(trim(regexp_replace(replace(upper({_space(x)}), 'ẞ', 'SS'), '[#,]', ' ', 'g')), '\\s+', ' ', 'g'), ' ')"
    return f"array_to_string([{_case(text.ADDRESS_WORDS, 't')} for t in {words}], ' ')"


_CLEAN = "nullif(regexp_replace(upper(trim({x})), '\\s+', ' ', 'g'), '')"
#: query -> column, function, SQL
TEXTS = {
    "text_null_words": ("company_name", text.null_if_blank, _null("company_name")),
    "text_clean": ("company_name", text.clean_text, _CLEAN.format(x="company_name")),
    "text_name": ("city", text.name, _name("city")),
    "text_company": ("company_name", text.company_name, _company("company_name")),
    "text_company_key": ("company_name", text.company_key, _key("company_name")),
    "text_company_key_sql": ("company_name", text.company_key_sql, f"regexp_replace(regexp_replace({_CLEAN.format(x='company_name')}, '\\b(CORP|CORPORATION|INC|LLC|LTD|CO|COMPANY)\\b', '', 'g'), '\\s+', ' ', 'g')"),
    "text_email": ("email", text.email, f"lower({_null('email')})"),
    "text_email_domain": ("email", text.email_domain, f"case when contains({_null('email')}, '@') then lower(string_split({_null('email')}, '@')[-1]) end"),
    "text_phone": ("phone", text.phone, _phone("phone")),
    "text_address": ("address", text.address, _address("address")),
    "text_state": ("state_region", text.state, f"case when length({_name('state_region')}) = 2 then {_name('state_region')} else {_case(text.STATES, _name('state_region'))} end"),
    "text_postal": ("postal_code", text.postal, f"regexp_replace(upper({_null('postal_code')}), '[^A-Z0-9]', '', 'g')"),
    "text_country": ("country", text.country, _case(text.COUNTRIES, _name("country"))),
    "text_website": ("website_domain", text.website, f"nullif(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({_null('website_domain')}), '^https?://', ''), '[/?#].*$', ''), ':\\d+$', ''), '^www\\.', ''), '')"),
}


def _text_query(column: str, function):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = table(spark, sf_dir, "silver_customer")
        return df.select("source_customer_id", "load_batch_id", function(F.col(column)).alias("value"))

    return run


def combine_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [text.address(F.col("address_line_1")), text.name(F.col("city")), text.state(F.col("state_region")), text.postal(F.col("postal_code")), text.country(F.col("country"))]
    return table(spark, sf_dir, "silver_customer").select("source_customer_id", "load_batch_id", text.combine_address(*parts).alias("value"))


FIELDS = ("company_name", "email", "phone", "address", "industry", "last_modified_timestamp")


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "silver_customer").withColumn("issues", quality.customer_issues()).withColumn("completeness", quality.completeness(FIELDS))
    return df.withColumn("quality", quality.quality_score(F.col("completeness"), F.col("issues")))


def row_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir).select("source_customer_id", "load_batch_id", F.array_join("issues", ",").alias("issues"), "completeness", "quality")


_ISSUES = f"""
select *, [x for x in [
    case when coalesce(trim(source_system), '') = '' then 'source_system_required' end,
    case when coalesce(trim(source_customer_id), '') = '' then 'source_customer_id_required' end,
    case when coalesce(trim(company_name), '') = '' and coalesce(trim(email), '') = '' and coalesce(trim(phone), '') = '' then 'identity_signal_required' end,
    case when trim(email) <> '' and not regexp_matches(email, '{text.EMAIL}') then 'valid_email' end,
    case when trim(phone) <> '' and length(regexp_replace(phone, '[^0-9]', '', 'g')) not between 7 and 15 then 'w:phone_length' end] if x is not null] issues,
  round(cast(({' + '.join(f"case when coalesce(trim(cast({f} as varchar)), '') <> '' then 1 else 0 end" for f in FIELDS)}) / 6.0 as decimal(38,10)), 4)::double completeness
from silver_customer"""
_QUALITY = "greatest(0.0, round(cast(completeness - 0.25 * len([x for x in issues if left(x, 2) <> 'w:']) - 0.1 * len([x for x in issues if left(x, 2) = 'w:']) as decimal(38,10)), 4)::double)"


def batch_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per load: rows, valid rows, mean score, and rows per broken rule."""
    v = _validated(spark, sf_dir)
    valid = F.count_if(F.size(F.filter("issues", lambda x: ~x.startswith("w:"))) == 0)
    total = v.groupBy("load_batch_id").agg(F.count(F.lit(1)).alias("total"), valid.alias("good"), F.round(F.sum(F.col("quality").cast("decimal(18,4)")) / F.count(F.lit(1)), 4).cast("double").alias("score"))
    heads = F.array(F.struct(F.lit("record_validity").alias("rule"), F.col("good").alias("n")), F.struct(F.lit("average_record_quality").alias("rule"), F.round(F.col("score") * 10000).cast("bigint").alias("n")))
    summary = total.select("load_batch_id", F.explode(heads).alias("r")).select("load_batch_id", "r.rule", "r.n")
    broken = v.select("load_batch_id", F.explode("issues").alias("rule")).groupBy("load_batch_id", "rule").agg(F.count(F.lit(1)).alias("n"))
    return summary.unionByName(broken)


def silver_quality_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _validated(spark, sf_dir)
    bad_email = F.count_if(F.array_contains("issues", "valid_email"))
    metrics = v.groupBy("source_system").agg(F.count(F.lit(1)).alias("total"), bad_email.alias("bad_email"), F.count_if(F.array_contains("issues", "w:phone_length")).alias("bad_phone"), F.count_if("is_deleted").alias("deleted"))
    return metrics.unpivot("source_system", ["total", "bad_email", "bad_phone", "deleted"], "rule", "n").select("source_system", "rule", F.col("n").cast("bigint").alias("n"))


def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "silver_customer").select("source_system", "source_customer_id", "load_batch_id", "last_modified_timestamp", "standardized_at", "record_hash")
    return latest_by(df, ["source_system", "source_customer_id"], [F.col("last_modified_timestamp"), F.col("load_batch_id"), F.col("standardized_at")]).select("source_system", "source_customer_id", "load_batch_id", "record_hash")


def silver_partner(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "silver_partner_profile")
    rows = latest_by(df, ["source_system", "partner_id"], [F.col("last_modified_timestamp"), F.col("load_batch_id")])
    return rows.select(
        "partner_id", text.company_name(F.col("company_name")).alias("company"), F.upper(F.trim("partner_tier")).alias("tier"), F.coalesce(F.size("certifications"), F.lit(0)).alias("certifications"),
        quality.completeness(("company_name", "email", "phone", "partner_tier", "partner_region")).alias("completeness"),
    )


def masked_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = F.lit(False)
    df = table(spark, sf_dir, "silver_customer")
    return df.select("source_customer_id", "load_batch_id", text.mask_email(F.col("email"), plain).alias("email"), text.mask_phone(F.col("phone"), plain).alias("phone"), text.mask_address(F.col("address"), plain).alias("address"))


RULES = [
    {"name": "rows", "type": "row_count", "min": 1, "severity": "CRITICAL"},
    {"name": "id_present", "type": "not_null", "column": "source_customer_id", "severity": "CRITICAL"},
    {"name": "email_present", "type": "not_null", "column": "email", "severity": "WARNING", "mostly": 0.9},
    {"name": "email_form", "type": "regex", "column": "email", "pattern": text.EMAIL},
    {"name": "known_source", "type": "in_set", "column": "source_system", "values": ["SALESFORCE", "MARKETO", "ZENDESK", "PRODUCT_USAGE", "LICENSING"], "nulls": False},
    {"name": "score_range", "type": "between", "column": "data_quality_score", "min": 0.0, "max": 1.0},
    {"name": "modified_after_created", "type": "pair_ge", "column": "last_modified_timestamp", "other": "created_date", "severity": "WARNING"},
]


def _suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "silver_customer")
    unique = quality.unique_failures(df, "id_unique", ["source_customer_id"]).unionByName(quality.unique_failures(df, "load_id_unique", ["load_batch_id", "source_customer_id"], "WARNING"))
    return quality.evaluated(quality.rule_failures(df, RULES).unionByName(unique))


def suite_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _suite(spark, sf_dir)


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.alerts(_suite(spark, sf_dir))


def rule_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each source's newest row is at most 24 h older than the newest of all."""
    df = table(spark, sf_dir, "silver_customer")
    newest = df.groupBy("source_system").agg(F.max("standardized_at").alias("newest"))
    clock = newest.agg(F.max("newest").alias("clock"))
    return newest.crossJoin(F.broadcast(clock)).select("source_system", (F.col("newest") >= F.col("clock") - F.expr("interval 24 hours")).alias("recent"))


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "silver_customer").where("not coalesce(is_deleted, false)")
    return df.groupBy("source_system", "source_customer_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def orphan_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children without a parent: ids of predictions that no customer record has, members without a cluster, accounts of events without a customer."""
    part = lambda kind, child, parent: child.distinct().join(parent, "key", "left_anti").select(F.lit(kind).alias("kind"), "key")
    p = table(spark, sf_dir, "customer_match_predictions")
    named = p.select(F.explode(F.array("left_source_customer_id", "right_source_customer_id")).alias("key")).where("key is not null")
    known = table(spark, sf_dir, "silver_customer").select(F.col("source_customer_id").alias("key"))
    members = table(spark, sf_dir, "customer_identity_map").select(F.col("cluster_id").alias("key")).where("key is not null")
    users = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("key"))
    silent = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("key"))
    return part("prediction", named, known).unionByName(part("member", members, table(spark, sf_dir, "customer_clusters").select(F.col("cluster_id").alias("key")))).unionByName(part("silent", silent, users))


def checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order-independent checksum of all columns per load: no row list is gathered, 60 bits of each row's hash are added up as decimals."""
    df = table(spark, sf_dir, "silver_customer")
    kinds = dict(df.dtypes)
    cell = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") if kinds[c].startswith("timestamp") else F.col(c).cast("string")
    row = F.to_json(F.struct(*[cell(c).alias(c) for c in sorted(df.columns)]), {"ignoreNullFields": "false"})
    part = F.conv(F.substring(F.sha2(row, 256), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.groupBy("load_batch_id").agg(F.sum(part).cast("string").alias("checksum"), F.count(F.lit(1)).alias("n"))


def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filtered read with a limit, the only limit there is: so many rows, whichever."""
    rows = files.table_scan(table(spark, sf_dir, "silver_customer"), "source_system = 'MARKETO'", 25)
    return rows.agg(F.count(F.lit(1)).alias("n"), F.max("source_system").alias("source_system"))


_COLUMNS = ("source_system source_customer_id source_record_id company_name company_name_normalized email email_domain phone address_line_1 address_line_2 city state_region postal_code country address website_domain industry "
            "customer_status created_date last_modified_timestamp is_deleted source_priority completeness_score data_quality_score standardization_version record_hash load_batch_id standardized_at").split()  # fmt: skip
_cell = lambda c: f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')" if c in ("created_date", "last_modified_timestamp", "standardized_at") else f"{c}::varchar"
_SUITE = f"""
with one as (select count(*) total from silver_customer),
u1 as (select sum(n) total, coalesce(sum(n) filter (n > 1), 0) failed from (select count(*) n from silver_customer group by upper(trim(source_customer_id)))),
u2 as (select sum(n) total, coalesce(sum(n) filter (n > 1), 0) failed from (select count(*) n from silver_customer group by upper(trim(load_batch_id)), upper(trim(source_customer_id)))),
f as (
  select 'rows' rule_name, 'row_count' rule_type, 'CRITICAL' severity, 1.0 mostly, total, case when total >= 1 then 0 else total end failed from one
  union all select 'id_present', 'not_null', 'CRITICAL', 1.0, count(*), count(*) filter (coalesce(trim(source_customer_id), '') = '') from silver_customer
  union all select 'email_present', 'not_null', 'WARNING', 0.9, count(*), count(*) filter (coalesce(trim(email), '') = '') from silver_customer
  union all select 'email_form', 'regex', 'ERROR', 1.0, count(*), count(*) filter (email is not null and not regexp_matches(email, '{text.EMAIL}')) from silver_customer
  union all select 'known_source', 'in_set', 'ERROR', 1.0, count(*), count(*) filter (coalesce(source_system not in ('SALESFORCE','MARKETO','ZENDESK','PRODUCT_USAGE','LICENSING'), true)) from silver_customer
  union all select 'score_range', 'between', 'ERROR', 1.0, count(*), count(*) filter (data_quality_score not between 0 and 1) from silver_customer
  union all select 'modified_after_created', 'pair_ge', 'WARNING', 1.0, count(*), count(*) filter (last_modified_timestamp < created_date) from silver_customer
  union all select 'id_unique', 'unique', 'ERROR', 1.0, total, failed from u1
  union all select 'load_id_unique', 'compound_unique', 'WARNING', 1.0, total, failed from u2),
s as (select *, coalesce(round(cast(1 - failed::double / nullif(total, 0) as decimal(38,10)), 4)::double, 1.0) score from f),
e as (select rule_name, rule_type, severity, total::bigint total, failed::bigint failed, score, case when score >= mostly then 'PASS' when severity in ('ERROR','CRITICAL') then 'FAIL' else 'WARN' end status from s)
"""

QUERIES = {k: _text_query(c, f) for k, (c, f, _) in TEXTS.items()} | {
    "text_combine_address": combine_address, "row_validation": row_validation, "batch_quality_report": batch_quality_report, "silver_dq_rules": silver_quality_by_source,
    "dedupe_latest": dedupe_latest, "silver_partner": silver_partner, "masked_view": masked_view, "suite_run": suite_run, "alerts": alerts, "rule_recent": rule_recent,
    "duplicate_keys": duplicate_keys, "orphan_check": orphan_check, "checksum": checksum, "table_scan": table_scan,
}

ORACLE = {k: f"select source_customer_id, load_batch_id, {sql} as value from silver_customer" for k, (_, _, sql) in TEXTS.items()} | {
    "text_combine_address": "select source_customer_id, load_batch_id, nullif(concat_ws(' ', "
    + ", ".join(f"nullif({x}, '')" for x in (_address("address_line_1"), _name("city"), TEXTS["text_state"][2], TEXTS["text_postal"][2], TEXTS["text_country"][2]))
    + "), '') as value from silver_customer",
    "row_validation": f"select source_customer_id, load_batch_id, array_to_string(issues, ',') as issues, completeness, {_QUALITY} as quality from ({_ISSUES})",
    "batch_quality_report": f"""with v as (select *, {_QUALITY} as quality from ({_ISSUES})),
t as (select load_batch_id, count(*) filter (len([x for x in issues if left(x, 2) <> 'w:']) = 0) good, round(sum(cast(quality as decimal(18,4)))::decimal(38,10) / count(*), 4) score from v group by 1)
select load_batch_id, 'record_validity' as "rule", good as n from t union all select load_batch_id, 'average_record_quality', cast(round(score * 10000) as bigint) from t
union all select load_batch_id, r, count(*) from (select load_batch_id, unnest(issues) r from v) group by 1, 2""",
    "silver_dq_rules": f"""with m as (select source_system, count(*) total, count(*) filter (list_contains(issues, 'valid_email')) bad_email, count(*) filter (list_contains(issues, 'w:phone_length')) bad_phone, count(*) filter (is_deleted) deleted from ({_ISSUES}) group by 1)
select source_system, 'total' as "rule", total as n from m union all select source_system, 'bad_email', bad_email from m union all select source_system, 'bad_phone', bad_phone from m union all select source_system, 'deleted', deleted from m""",
    "dedupe_latest": "select source_system, source_customer_id, load_batch_id, record_hash from (select *, row_number() over (partition by source_system, source_customer_id order by last_modified_timestamp desc nulls last, load_batch_id desc nulls last, standardized_at desc nulls last, record_hash desc nulls last) k from silver_customer) where k = 1",
    "silver_partner": f"""select partner_id, {_company('company_name')} as company, upper(trim(partner_tier)) as tier, coalesce(len(certifications), 0)::int as certifications,
round(cast(({' + '.join(f"case when coalesce(trim({f}), '') <> '' then 1 else 0 end" for f in ('company_name', 'email', 'phone', 'partner_tier', 'partner_region'))}) / 5.0 as decimal(38,10)), 4)::double as completeness
from (select *, row_number() over (partition by source_system, partner_id order by last_modified_timestamp desc nulls last, load_batch_id desc nulls last) k from silver_partner_profile) where k = 1""",
    "masked_view": """select source_customer_id, load_batch_id, case when instr(email, '@') > 0 then substring(email, 1, 1) || '***' || substring(email, instr(email, '@')) when email is not null then '***' end as email,
case when length(regexp_replace(phone, '[^0-9]', '', 'g')) >= 4 then '***-***-' || right(regexp_replace(phone, '[^0-9]', '', 'g'), 4) when phone is not null then '***' end as phone,
case when address is not null then 'REDACTED' end as address from silver_customer""",
    "suite_run": _SUITE + "select * from e",
    "alerts": _SUITE + "select rule_name, case when status = 'FAIL' then 'CRITICAL' else 'WARNING' end as alert_severity, 'OPEN' as alert_status, failed, score from e where status <> 'PASS'",
    "rule_recent": "select source_system, max(standardized_at) >= (select max(standardized_at) from silver_customer) - interval 24 hours as recent from silver_customer group by 1",
    "duplicate_keys": "select source_system, source_customer_id, count(*) as n from silver_customer where not coalesce(is_deleted, false) group by 1, 2 having count(*) > 1",
    "orphan_check": """select 'prediction' as kind, k as "key" from (select left_source_customer_id k from customer_match_predictions union select right_source_customer_id from customer_match_predictions) where k is not null and k not in (select source_customer_id from silver_customer where source_customer_id is not null)
union all select distinct 'member', cluster_id from customer_identity_map where cluster_id is not null and cluster_id not in (select cluster_id from customer_clusters) union all select distinct 'silent', c_custkey::varchar from customer where c_custkey not in (select user_id from events)""",
    "checksum": "select load_batch_id, cast(sum(('0x' || left(sha256(to_json({" + ", ".join(f"'{c}': {_cell(c)}" for c in sorted(_COLUMNS)) + "})::varchar), 15))::hugeint) as varchar) as checksum, count(*) as n from silver_customer group by 1",
    "table_scan": "select least(count(*), 25) as n, max(source_system) as source_system from silver_customer where source_system = 'MARKETO'",
}
