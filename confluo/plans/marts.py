"""Reporting marts over golden records and daily scores, and the data-quality tables and dashboard.

A golden customer stands for one account, by a hash of its cluster: the test tables have no other link between the two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scores import r
from ..operators import suites
from ..operators.history import latest_by
from ..runtime import table
from . import accounts, resolution
from .accounts import _r

ACCOUNTS = 1000
_mean = lambda c: r(F.sum(F.col(c).cast("decimal(18,4)")).cast("double") / F.count(c))


def _master(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.conv(F.substring(F.md5("cluster_id"), 1, 8), 16, 10).cast("bigint") % ACCOUNTS
    return resolution.golden_rows(spark, sf_dir).withColumn("account", number.cast("string"))


def drilldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a scored golden customer: scores, then master, clusters and enrichment by left joins."""
    master = _master(spark, sf_dir)
    scores = master.select("cluster_id", "account").join(accounts.health_scores_rules(spark, sf_dir).select("account", "derived_class", "churn_risk", "engagement", "adoption", "support_health", "renewal", "lifetime_value"), "account")
    clusters = resolution._clusters(spark, sf_dir).select("cluster_id", "cluster_size")
    enrichment = accounts.enrichment(spark, sf_dir).select("account", "tickets", "expires", F.col("status").alias("renewal_status"), F.col("lifetime_value").alias("e_value"))
    joined = scores.join(master.drop("account", "confidence_score", "survivorship", "first_seen", "last_seen"), "cluster_id", "left").join(clusters, "cluster_id", "left").join(enrichment, "account", "left")
    return joined.select(
        "cluster_id", "account", "company_name", "email", "phone", "website_domain", "industry", "customer_status", "derived_class", "churn_risk", F.coalesce("lifetime_value", "e_value").alias("lifetime_value"), "engagement", "adoption", "support_health", "renewal",
        "tickets", "expires", "renewal_status", F.lit("UNASSIGNED").alias("owner_team"), "primary_source_system", F.coalesce("members", "cluster_size").alias("source_customer_count"), "quality",
    )


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health by each value of five segments of the golden customers: one scan, unpivoted."""
    country = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").cast("string").alias("account"), "n_name")
    d = drilldown(spark, sf_dir).join(country, "account", "left")
    named = (("Industry", "industry"), ("Customer Status", "customer_status"), ("Primary Source", "primary_source_system"), ("Country", "n_name"), ("Health Class", "derived_class"))
    cells = F.array(*[F.struct(F.lit(n).alias("segment_type"), F.coalesce(F.col(c), F.lit("UNKNOWN")).alias("segment_value")) for n, c in named])
    classes = [F.count_if(F.col("derived_class") == k).alias(n) for k, n in (("Healthy", "healthy"), ("At Risk", "at_risk"), ("Churn Risk", "churn"))]
    return d.withColumn("s", F.explode(cells)).groupBy("s.segment_type", "s.segment_value").agg(F.count_distinct("cluster_id").alias("customers"), *classes, *[_mean(c).alias(c) for c in ("engagement", "adoption", "renewal", "churn_risk")], F.sum(F.col("lifetime_value").cast("decimal(38,2)")).cast("double").alias("lifetime_value"))


def quality_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """metric_date, data_quality_score: the share of each day's events whose value is plausible."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.to_date("ts").cast("string").alias("metric_date")).agg(r(F.count_if(F.coalesce(F.col("value").between(0, 450), F.lit(False))) / F.count(F.lit(1))).alias("data_quality_score"))


def executive_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPIs by date, beside one row over all clusters and the quality of the date, 1 where it was not measured."""
    d = accounts._classified(accounts._daily(spark, sf_dir), "account", "metric_date")
    first = d.groupBy("account").agg(F.min("metric_date").alias("first_seen"))
    days = d.join(first, "account").groupBy("metric_date").agg(
        F.count_distinct("account").alias("total_customers"), F.count_if(F.expr("first_seen = metric_date")).alias("new_customers"), F.count_if(F.expr("engagement >= 0.75")).alias("high_engagement"), F.count_if(F.expr("derived_class = 'At Risk'")).alias("at_risk"), F.count_if(F.expr("derived_class = 'Churn Risk'")).alias("churn"),
        F.sum(F.col("lifetime_value").cast("decimal(38,2)")).cast("double").alias("lifetime_value"), *[_mean(c).alias(c) for c in ("engagement", "adoption", "renewal")],
    )
    rollup = resolution.cluster_rollup(spark, sf_dir).select(r(1 - F.col("total_clusters") / F.nullif("total_members", F.lit(0))).alias("duplicate_reduction"), "match_accuracy")
    return days.crossJoin(F.broadcast(rollup)).join(quality_by_day(spark, sf_dir), "metric_date", "left").withColumn("data_quality_score", F.coalesce("data_quality_score", F.lit(1.0)))  # one row


def bi_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Healthy, at-risk and churn rates, renewal risk and health score over all accounts."""
    h = accounts.health_scores_rules(spark, sf_dir)
    n = F.nullif(F.count(F.lit(1)), F.lit(0))
    rate = lambda k, name: r(F.count_if(F.col("derived_class") == k) / n).alias(name)
    mean = lambda c: F.sum(F.col(c).cast("decimal(18,4)")).cast("double") / n
    return h.agg(rate("Healthy", "healthy_rate"), rate("At Risk", "at_risk_rate"), rate("Churn Risk", "churn_rate"), r(1 - mean("renewal")).alias("renewal_risk"), r((mean("engagement") + mean("adoption") + mean("support_health")) / 3).alias("health_score"))


def daily_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """metric_date, alert: quality below 0.95, share of churn risks up by more than 0.1 on the day before, mean renewal below 0.65, no customers.

    The window runs over the days of the calendar, not over rows of data.
    """
    k = executive_daily(spark, sf_dir).withColumn("share", F.col("churn") / F.nullif("total_customers", F.lit(0)))
    k = k.withColumn("before", F.lag("share").over(Window.orderBy("metric_date")))
    checks = [F.when(F.col("data_quality_score") < 0.95, "data_quality"), F.when(F.round((F.col("share") - F.col("before")).cast("decimal(38,10)"), 6) > 0.1, "churn_jump"), F.when(F.col("renewal") < 0.65, "renewal"), F.when(F.col("total_customers") == 0, "no_rows")]
    return k.select("metric_date", F.explode(F.array_compact(F.array(*checks))).alias("alert"))


def latest_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean health and accounts of the newest date."""
    d = accounts._classified(accounts._daily(spark, sf_dir), "account", "metric_date")
    newest = accounts.silver_metric_daily(spark, sf_dir).agg(F.max("metric_date").alias("metric_date"))
    return d.join(F.broadcast(newest), "metric_date").groupBy("metric_date").agg(r(1 - F.sum(F.col("churn_risk").cast("decimal(18,4)")).cast("double") / F.count(F.lit(1))).alias("health"), F.count_distinct("account").alias("accounts"))  # one row


def golden_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per golden customer and day of the last 90 days: documents, tickets and size of its members' documents, and their systems."""
    docs = table(spark, sf_dir, "documents").select("source_customer_id", F.to_date("created_at").alias("d"), "source", "n_chars")
    as_of = docs.agg(F.max("d").alias("as_of"))
    daily = docs.crossJoin(F.broadcast(as_of)).where("d >= date_sub(as_of, 90)").groupBy("source_customer_id", "d").agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("source") == "zendesk_ticket").alias("tickets"), F.sum("n_chars").alias("size"))  # one row
    members = table(spark, sf_dir, "silver_customer").where("company_name is not null").select("source_system", "source_customer_id", F.upper(F.trim("company_name")).alias("golden")).distinct()
    return members.join(daily, "source_customer_id").groupBy("golden", F.col("d").cast("string").alias("metric_date")).agg(F.sum("documents").alias("documents"), F.sum("tickets").alias("tickets"), F.sum("size").alias("size"), F.array_join(F.array_sort(F.collect_set("source_system")), ",").alias("systems"))


SILVER = "customer_silver_suite"


def _latest_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_by(table(spark, sf_dir, "silver_customer"), ["source_system", "source_customer_id"], [F.col("last_modified_timestamp"), F.col("load_batch_id"), F.col("standardized_at")])


def _gold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = resolution.golden_rows(spark, sf_dir)
    return g.select(F.col("cluster_id").alias("golden_customer_id"), "cluster_id", "email", "confidence_score", F.col("completeness").alias("completeness_score"), F.lit(True).alias("is_active"), F.col("first_seen").alias("first_seen_at"), F.col("last_seen").alias("last_seen_at"), F.col("last_seen").alias("updated_at"))


def _enrichment_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = accounts.enrichment_daily(spark, sf_dir)
    return e.select(F.col("account").alias("golden_customer_id"), "metric_date", F.col("adoption").alias("product_adoption_score"), F.col("engagement").alias("engagement_score"), F.col("support_health").alias("support_health_score"), F.col("renewal").alias("renewal_probability"), "lifetime_value", F.col("metric_date").cast("timestamp_ntz").alias("calculated_at"))


def _scores_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = accounts.health_scores_rules(spark, sf_dir)
    return h.select(F.col("account").alias("golden_customer_id"), F.lit(accounts.AS_OF).alias("score_date"), F.col("derived_class").alias("health_class"), F.col("churn_risk").alias("churn_risk_score"), F.col("renewal").alias("renewal_probability"), F.lit("rules").alias("model_algorithm"), F.lit("v1").alias("model_version"), F.lit(accounts.AS_OF).cast("timestamp_ntz").alias("scored_at"))


_CLOCK = "2025-04-01 00:00:00"


def suite_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four suites over their tables, all rules of each."""
    clock = F.lit(_CLOCK).cast("timestamp_ntz")
    tables = (_latest_silver, _gold_table, _enrichment_table, _scores_table)
    parts = [suites.run(t(spark, sf_dir), suites.SUITES[s], clock).withColumn("suite", F.lit(s)) for s, t in zip(suites.GROUPS.values(), tables)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suites.summary(suite_runs(spark, sf_dir), ["suite"])


def dq_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver suite over every load, held against the load's own newest time."""
    df = table(spark, sf_dir, "silver_customer")
    day = df.groupBy("load_batch_id").agg(F.to_date(F.max("standardized_at")).cast("string").alias("metric_date"))
    return suites.run(df, suites.SUITES[SILVER], F.lit(_CLOCK).cast("timestamp_ntz"), ["load_batch_id"]).join(day, "load_batch_id")


def dq_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suites.alert_rows(dq_metrics(spark, sf_dir), ["load_batch_id", "metric_date"])


def dq_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By day: rules passed, failed and warned, mean score, freshness, and the open alerts by severity."""
    m = dq_metrics(spark, sf_dir).withColumn("suite", F.when(F.col("category") != "freshness", F.lit(SILVER)))
    rollup = m.groupBy("metric_date", F.coalesce("suite", F.lit("")).alias("suite")).agg(F.count(F.lit(1)).alias("total_rules"), *[F.count_if(F.col("status") == s).alias(n) for s, n in (("PASS", "passed"), ("FAIL", "failed"), ("WARN", "warned"))], _mean("score").alias("average_quality_score"), F.min(F.when(F.col("category") == "freshness", F.col("status"))).alias("freshness"))
    a = suites.alert_rows(m, ["load_batch_id", "metric_date", "suite"]).groupBy("metric_date", F.coalesce("suite", F.lit("")).alias("suite")).agg(F.count_if(F.col("alert_severity") == "CRITICAL").alias("critical"), F.count_if(F.col("alert_severity") == "WARNING").alias("warning"))
    joined = rollup.join(a, ["metric_date", "suite"], "left")
    return joined.select("metric_date", "suite", "total_rules", "passed", "failed", "warned", "average_quality_score", F.coalesce("critical", F.lit(0)).alias("critical"), F.coalesce("warning", F.lit(0)).alias("warning"), F.coalesce("freshness", F.lit("NOT_EVALUATED")).alias("freshness"))


def _sql_suite(rules: list[dict], source: str, by: str = "") -> str:
    """The SQL of a suite over a relation: one branch a rule."""
    group = f" group by {by}" if by else ""
    head = f"{by}, " if by else ""

    def failed(x: dict) -> str:
        c, none = x["column"], str(not x.get("nulls", True)).lower()
        if x["type"] == "row_count":
            return f"case when count(*) >= {x['min']} then 0 else count(*) end"
        if x["type"] == "recent":
            return f"case when max({c}) >= timestamp '{_CLOCK}' - interval {x['hours']} hours then 0 else count(*) end"
        bad = {
            "not_null": lambda: f"coalesce(trim({c}::varchar), '') = ''", "regex": lambda: f"not regexp_matches({c}, '{x['pattern']}')", "in_set": lambda: f"{c}::varchar not in ({', '.join(repr(v) for v in x['values'])})",
            "between": lambda: f"not ({c}::double >= {x['min']}" + (f" and {c}::double <= {x['max']})" if "max" in x else ")"), "pair_ge": lambda: f"{c} < {x.get('other')}",
        }[x["type"]]()
        return f"count(*) filter (coalesce({bad}, {none}))"

    parts = []
    for x in rules:
        shape = f"'{x['name']}' rule_name, '{x['category']}' category, '{x['severity']}' severity, {x['mostly']}::double mostly"
        if x["type"] == "unique":
            keys = ", ".join(f"upper(trim({k}::varchar))" for k in x["keys"])
            parts.append(f"select {head}{shape}, coalesce(sum(n), 0)::bigint total, coalesce(sum(n) filter (n > 1), 0)::bigint failed from (select {head}count(*) n from {source} group by {head}{keys}){group}")
        else:
            parts.append(f"select {head}{shape}, count(*) total, {failed(x)} failed from {source}{group}")
    scored = f"select *, coalesce(round(cast(1 - failed::double / nullif(total, 0) as decimal(38,10)), 4)::double, 1.0) score from ({' union all '.join(parts)})"
    return f"select * exclude (mostly), case when score >= mostly then 'PASS' when severity in ('ERROR', 'CRITICAL') then 'FAIL' else 'WARN' end status from ({scored})"


_master_sql = f"select *, ((('0x' || left(md5(cluster_id), 8))::bigint) % {ACCOUNTS})::varchar as account from ({resolution.ORACLE['golden_master']})"
_clusters_sql = "select * from (select *, row_number() over (partition by cluster_id order by updated_at desc nulls last, golden_customer_id desc, cluster_size desc) k from customer_clusters) where k = 1"
_DRILL = accounts._HEALTH + f""",
master as ({_master_sql}), clus as ({_clusters_sql}),
drill as (select m.cluster_id, m.account, m.company_name, m.email, m.phone, m.website_domain, m.industry, m.customer_status, h.derived_class, h.churn_risk, h.lifetime_value, h.engagement, h.adoption, h.support_health, h.renewal, e.tickets, e.expires, e.status as renewal_status,
  'UNASSIGNED' as owner_team, m.primary_source_system, coalesce(m.members, c.cluster_size) as source_customer_count, m.quality from master m join health h using (account) left join clus c on c.cluster_id = m.cluster_id left join enriched e on e.account = m.account)
"""
_avg = lambda x: f"{_r(accounts._m(x))}"
_QUALITY_DAY = f"select (ts::date)::varchar metric_date, {_r('count(*) filter (coalesce(value between 0 and 450, false)) / count(*)::double')} as data_quality_score from events group by 1"
_EXEC = accounts._DAILY + f""",
firsts as (select account, min(metric_date) first_seen from health group by 1), qd as ({_QUALITY_DAY}), roll as ({resolution.ORACLE['cluster_rollup']}),
days as (select metric_date, count(distinct account) total_customers, count(*) filter (first_seen = metric_date) new_customers, count(*) filter (engagement >= 0.75) high_engagement, count(*) filter (derived_class = 'At Risk') at_risk, count(*) filter (derived_class = 'Churn Risk') churn,
  sum(lifetime_value::decimal(38,2))::double lifetime_value, {', '.join(f'{_avg(c)} as {c}' for c in ('engagement', 'adoption', 'renewal'))} from health join firsts using (account) group by 1),
execs as (select days.*, {_r('1 - total_clusters / nullif(total_members, 0)::double')} as duplicate_reduction, match_accuracy, coalesce(data_quality_score, 1.0) as data_quality_score from days cross join roll left join qd using (metric_date))
"""
_SILVER_LATEST = "(select * from (select *, row_number() over (partition by source_system, source_customer_id order by last_modified_timestamp desc nulls last, load_batch_id desc nulls last, standardized_at desc nulls last) k from silver_customer) where k = 1)"
_GOLD_T = f"(select cluster_id as golden_customer_id, cluster_id, email, confidence_score, completeness as completeness_score, true as is_active, first_seen::timestamp as first_seen_at, last_seen::timestamp as last_seen_at, last_seen::timestamp as updated_at from ({resolution.ORACLE['golden_master']}))"
_ENR_T = f"(select account as golden_customer_id, metric_date, adoption as product_adoption_score, engagement as engagement_score, support_health as support_health_score, renewal as renewal_probability, lifetime_value, metric_date::timestamp as calculated_at from ({accounts.ORACLE['enrichment_daily']}))"
_SCO_T = f"(select account as golden_customer_id, '{accounts.AS_OF}' as score_date, derived_class as health_class, churn_risk as churn_risk_score, renewal as renewal_probability, 'rules' as model_algorithm, 'v1' as model_version, timestamp '{accounts.AS_OF} 00:00:00' as scored_at from ({accounts.ORACLE['health_scores_rules']}))"
_RUNS = "with " + ", ".join(f"t{i} as {t}" for i, t in enumerate((_SILVER_LATEST, _GOLD_T, _ENR_T, _SCO_T))) + ", runs as (" + " union all ".join(f"select *, '{s}' as suite from ({_sql_suite(suites.SUITES[s], f't{i}')})" for i, s in enumerate(suites.GROUPS.values())) + ")"
_DQ = f"with days as (select load_batch_id, (max(standardized_at)::date)::varchar metric_date from silver_customer group by 1), dq as (select d.*, metric_date from ({_sql_suite(suites.SUITES[SILVER], 'silver_customer', 'load_batch_id')}) d join days using (load_batch_id))"
_ALERT = "left(sha256({key}), 32) as alert_id, rule_name, case when status = 'FAIL' then 'CRITICAL' else 'WARNING' end as alert_severity, 'OPEN' as alert_status"

QUERIES = {
    "drilldown": drilldown, "segments": segments, "quality_by_day": quality_by_day, "executive_daily": executive_daily, "bi_ratios": bi_ratios, "daily_alerts": daily_alerts, "latest_health": latest_health, "golden_metrics": golden_metrics,
    "suite_runs": suite_runs, "run_summary": run_summary, "dq_metrics": dq_metrics, "dq_alerts": dq_alerts, "dq_dashboard": dq_dashboard,
}

ORACLE = {
    "drilldown": _DRILL + "select * from drill",
    "segments": _DRILL + f""", land as (select c_custkey::varchar account, n_name from customer join nation on c_nationkey = n_nationkey)
select segment_type, coalesce(case segment_type when 'Industry' then d.industry when 'Customer Status' then customer_status when 'Primary Source' then primary_source_system when 'Country' then n_name else derived_class end, 'UNKNOWN') as segment_value, count(distinct cluster_id) as customers,
  count(*) filter (derived_class = 'Healthy') as healthy, count(*) filter (derived_class = 'At Risk') as at_risk, count(*) filter (derived_class = 'Churn Risk') as churn, {', '.join(f'{_avg(c)} as {c}' for c in ('engagement', 'adoption', 'renewal', 'churn_risk'))}, sum(lifetime_value::decimal(38,2))::double as lifetime_value
from drill d left join land using (account) cross join (values ('Industry'), ('Customer Status'), ('Primary Source'), ('Country'), ('Health Class')) s(segment_type) group by 1, 2""",
    "quality_by_day": _QUALITY_DAY,
    "executive_daily": _EXEC + "select * from execs",
    "bi_ratios": accounts._HEALTH + f"select {', '.join(_r(f'count(*) filter (derived_class = {k!r}) / count(*)::double') + f' as {n}' for k, n in (('Healthy', 'healthy_rate'), ('At Risk', 'at_risk_rate'), ('Churn Risk', 'churn_rate')))}, {_r('1 - sum(cast(renewal as decimal(18,4)))::double / count(*)')} as renewal_risk, {_r('(sum(cast(engagement as decimal(18,4)))::double / count(*) + sum(cast(adoption as decimal(18,4)))::double / count(*) + sum(cast(support_health as decimal(18,4)))::double / count(*)) / 3')} as health_score from health",
    "daily_alerts": _EXEC + """, sh as (select *, churn / nullif(total_customers, 0)::double share from execs), lagged as (select *, lag(share) over (order by metric_date) prior from sh)
select metric_date, unnest([a for a in [case when data_quality_score < 0.95 then 'data_quality' end, case when round(cast(share - prior as decimal(38,10)), 6) > 0.1 then 'churn_jump' end, case when renewal < 0.65 then 'renewal' end, case when total_customers = 0 then 'no_rows' end] if a is not null]) as alert from lagged""",
    "latest_health": accounts._DAILY + f"select metric_date, {_r('1 - ' + accounts._m('churn_risk'))} as health, count(distinct account) as accounts from health where metric_date = (select max(metric_date) from health) group by 1",
    "golden_metrics": """with docs as (select source_customer_id, created_at::date d, source, n_chars from documents), daily as (select source_customer_id, d, count(*) documents, count(*) filter (source = 'zendesk_ticket') tickets, sum(n_chars) size from docs where d >= (select max(d) from docs) - 90 group by 1, 2),
members as (select distinct source_system, source_customer_id, upper(trim(company_name)) golden from silver_customer where company_name is not null)
select golden, d::varchar as metric_date, sum(documents)::bigint as documents, sum(tickets)::bigint as tickets, sum(size)::bigint as size, array_to_string(list_sort(list(distinct source_system)), ',') as systems from members join daily using (source_customer_id) group by 1, d""",
    "suite_runs": _RUNS + "select * from runs",
    "run_summary": _RUNS + "select suite, count(*) as metrics_total, count(*) filter (status <> 'PASS') as metrics_failed, count(*) filter (status = 'WARN') as metrics_warned, round(cast(sum(score::decimal(18,4)) / count(*) as decimal(38,10)), 4)::double as quality_score, coalesce(string_agg(rule_name, ',' order by rule_name) filter (status <> 'PASS'), '') as failed_rules, case when count(*) filter (status <> 'PASS') > 0 then 'FAIL' else 'PASS' end as status from runs group by 1",
    "dq_metrics": _DQ + "select * from dq",
    "dq_alerts": _DQ + "select load_batch_id, metric_date, " + _ALERT.format(key="load_batch_id || '|' || metric_date || '|' || rule_name") + " from dq where status <> 'PASS'",
    "dq_dashboard": _DQ + f"""
select metric_date, case when category <> 'freshness' then '{SILVER}' else '' end as suite, count(*) as total_rules, count(*) filter (status = 'PASS') as passed, count(*) filter (status = 'FAIL') as failed, count(*) filter (status = 'WARN') as warned, {_avg('score')} as average_quality_score,
  count(*) filter (status = 'FAIL') as critical, count(*) filter (status = 'WARN') as warning, coalesce(min(case when category = 'freshness' then status end), 'NOT_EVALUATED') as freshness from dq group by 1, 2""",
}
