"""Daily metrics, enrichment, health and reporting marts over the events, orders, customers and suppliers tables.

Users and customers are one account by number. Sums and means run over decimals, so both engines agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scores
from ..functions.scores import clamp, r, weighted
from ..operators import health_model
from ..runtime import fenced, materialize, table

AS_OF = "2001-08-01"
_dec = lambda c: c.cast("decimal(18,4)")
_mean = lambda c: F.sum(_dec(c)).cast("double") / F.count(c)


def silver_metric_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """account, metric_date and the metrics of four sources, one row an account and day: one aggregation a table."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("account"), F.to_date("ts").alias("metric_date"), "event_type", "value", (F.get_json_object("props", "$.k").try_cast("double") / 100).alias("feature"))
    error, click = F.col("event_type") == "error", F.col("event_type").isin("click", "view")
    day = e.groupBy("account", "metric_date").agg(
        F.count(F.lit(1)).alias("logins"), F.count_distinct("event_type").alias("users"), F.count_if(error).alias("tickets"), F.count_if(click).alias("campaigns"),
        _mean(F.when(error, F.col("value") % 5)).alias("satisfaction"), _mean(F.when(error, F.col("value") * 4)).alias("response"), _mean(F.when(click, F.least(F.col("value") / 500, F.lit(1.0)))).alias("engagement"), _mean(F.col("feature")).alias("feature"),
    )
    null = lambda kind: F.lit(None).cast(kind)
    day = day.select(
        "account", F.col("metric_date").cast("string").alias("metric_date"), "logins", "users", "tickets", "campaigns", r(F.col("satisfaction")).alias("satisfaction"), r(F.col("response")).alias("response"), r(F.col("engagement")).alias("engagement"), r(F.col("feature")).alias("feature"),
        scores.usage_score(F.col("logins"), F.lit(1), F.col("users")).alias("usage_score"),
        F.when(F.col("tickets") > 0, scores.support_activity(F.col("tickets"), F.col("satisfaction"), F.col("response"))).alias("support_score"),
        null("double").alias("contract"), null("bigint").alias("seats"), null("string").alias("status"),
    )
    o = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderpriority") == "1-URGENT", "CANCELLED").when(F.col("o_orderstatus") == "F", "RENEWED").when(F.col("o_orderstatus") == "O", "PENDING").otherwise("AT_RISK")
    lic = o.groupBy(F.col("o_custkey").cast("string").alias("account"), F.to_date("o_orderdate").cast("string").alias("metric_date")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("contract"), F.count(F.lit(1)).alias("seats"), F.min_by(status, F.struct(scores.status_rank(status), status)).alias("status"))
    return day.unionByName(lic, allowMissingColumns=True)


def conservative_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_metric_daily(spark, sf_dir).where("status is not null").select("account", "metric_date", "status", scores.status_rank(F.col("status")).alias("status_rank"), scores.status_chance(F.col("status")).alias("status_chance"))


def _aggregated(metrics: DataFrame, *keys: str) -> DataFrame:
    """Per key: the metrics, the weakest renewal status and the last day of a contract."""
    mean = lambda c: r(F.sum(F.col(c).cast("decimal(18,4)")).cast("double") / F.count(c)).alias(c)
    status = F.min(F.when(F.col("status").isNotNull(), F.struct(scores.status_rank(F.col("status")).alias("k"), F.col("status").alias("s"))))["s"]
    return metrics.groupBy(*keys).agg(
        *[mean(c) for c in ("usage_score", "engagement", "support_score", "satisfaction", "response", "feature")], F.sum("tickets").alias("tickets"), F.sum("users").alias("users"), F.count("logins").alias("active_days"),
        F.sum(F.col("contract").cast("decimal(18,2)")).cast("double").alias("contract"), F.sum("seats").alias("seats"), status.alias("status"), F.max(F.when(F.col("status").isNotNull(), F.col("metric_date"))).alias("expires"), F.count(F.lit(1)).alias("rows"),
    )


def _enriched(a: DataFrame, as_of: Column, *keys: str) -> DataFrame:
    """The five scores: adoption, engagement, support health, renewal probability, lifetime value. Feature utilisation is the
    stated one, else usage. What a step uses more than once is computed behind a fence, so nothing is computed twice."""
    c = F.col
    support = F.coalesce(weighted((1 - clamp(c("tickets") / 25.0), 0.30), (clamp(c("satisfaction") / 5.0), 0.35), (1 - clamp(c("response") / 1440.0), 0.20), (clamp(c("support_score")), 0.15)), F.lit(1.0))
    left = F.datediff(c("expires").cast("date"), as_of.cast("date"))
    timing = F.when(left < 0, 0.20).when(left <= 30, 0.45).when(left <= 90, 0.65).when(left.isNotNull(), 0.85)
    a = a.select(
        *keys, "contract", "status", "expires", "tickets", "response", "usage_score", F.col("engagement").alias("marketing"), "satisfaction", "users", "active_days", "seats", left.alias("days_left"),
        weighted((clamp(c("usage_score")), 0.45), (clamp(c("users") / 50.0), 0.15), (clamp(c("active_days") / 30.0), 0.15), (clamp(F.coalesce("feature", "usage_score")), 0.25)).alias("adoption"),
        weighted((clamp(c("usage_score")), 0.40), (clamp(c("engagement")), 0.35), (clamp(c("support_score")), 0.25)).alias("engagement"),
        support.alias("support_health"), scores.status_chance(c("status")).alias("chance"), timing.alias("timing"),
    )
    a = fenced(a).withColumn("renewal", weighted((c("chance"), 0.30), (c("engagement"), 0.20), (c("adoption"), 0.20), (c("support_health"), 0.20), (c("timing"), 0.05)))
    base = F.greatest(F.coalesce(c("contract"), F.lit(0.0)), F.lit(0.0))
    more = 1 + (F.coalesce(c("engagement"), F.lit(0.0)) + F.coalesce(c("adoption"), F.lit(0.0))) / 4
    value = base.cast("decimal(14,2)") * (1 + c("renewal")).cast("decimal(5,4)") * more.cast("decimal(7,6)")
    return fenced(a.withColumn("lifetime_value", F.round(value, 2).cast("double")).drop("chance", "timing"))


_BRIEF = ["account", "contract", "status", "expires", "tickets", "response", "adoption", "engagement", "support_health", "renewal", "lifetime_value"]


def enrichment_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _aggregated(silver_metric_daily(spark, sf_dir), "account")


def _overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(enrichment_aggregate(spark, sf_dir), F.lit(AS_OF), "account")


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(_aggregated(silver_metric_daily(spark, sf_dir), "account", "metric_date"), F.col("metric_date"), "account", "metric_date")


def enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _overall(spark, sf_dir).select(*_BRIEF)


def enrichment_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir).select("metric_date", *_BRIEF)


def _classified(e: DataFrame, *keys: str) -> DataFrame:
    """Normalised features, the class by either cascade, the constant churn risk of the class and its probabilities."""
    c = F.col
    gone = scores.status_word(c("status")).isin("CANCELLED", "CANCELED", "CHURNED", "EXPIRED", "LOST")
    good = (c("engagement") >= 0.75) & (c("adoption") >= 0.75)
    derived = F.when(gone | (c("renewal") <= 0.20) | (c("support_health") <= 0.25), "Churn Risk").when(good & (c("support_health") >= 0.75) & (c("renewal") >= 0.55), "Healthy").otherwise("At Risk")
    risk = 1 - c("support_health")
    rules = F.when(good & (risk <= 0.25), "Healthy").when((c("engagement") < 0.35) | (c("adoption") < 0.35) | (risk >= 0.75), "Churn Risk").otherwise("At Risk")
    norm = lambda x, top: r(F.coalesce(clamp(c(x) / top), F.lit(0.0)), 6)
    out = e.withColumns({"derived_class": derived, "rule_class": rules}).select(*keys, "engagement", "adoption", "support_health", "renewal", "lifetime_value", norm("tickets", 25.0).alias("ticket_norm"), norm("response", 1440.0).alias("response_risk"), scores.money(c("lifetime_value")).alias("value_norm"), "derived_class", "rule_class")
    return out.withColumn("churn_risk", F.when(c("derived_class") == "Healthy", 0.05).when(c("derived_class") == "At Risk", 0.45).otherwise(0.85))


def health_scores_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(_overall(spark, sf_dir), "account")


def class_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The constant probabilities of each account's class, as JSON text."""
    third = F.when(F.col("derived_class") == "Healthy", F.array(F.lit("0.85"), F.lit("0.1"), F.lit("0.05"))).when(F.col("derived_class") == "At Risk", F.array(F.lit("0.2"), F.lit("0.6"), F.lit("0.2"))).otherwise(F.array(F.lit("0.05"), F.lit("0.1"), F.lit("0.85")))
    p = health_scores_rules(spark, sf_dir).select("account", "derived_class", third.alias("p"))
    return p.select("account", "derived_class", F.to_json(F.struct(F.col("p")[0].alias("Healthy"), F.col("p")[1].alias("At Risk"), F.col("p")[2].alias("Churn Risk"))).alias("probabilities"))


FEATURES = (
    "product_usage_score", "product_adoption_score", "marketing_engagement_score", "engagement_score", "support_health_score", "support_ticket_count_norm", "satisfaction_score_norm", "response_time_risk",
    "active_users_norm", "active_days_norm", "renewal_probability", "renewal_status_risk", "renewal_timing_risk", "lifetime_value_norm", "contract_value_norm",
)


def featured(e: DataFrame, *keys: str) -> DataFrame:
    """The fifteen features of a scored row, none null, and the class derived from them."""
    c = F.col
    unit = lambda x, top=1.0, none=0.0: r(F.coalesce(clamp(c(x) / top), F.lit(none)), 6)
    timing = F.when(c("days_left").isNull(), 0.50).when(c("days_left") < 0, 1.00).when(c("days_left") <= 30, 0.75).when(c("days_left") <= 90, 0.45).otherwise(0.15)
    values = (unit("usage_score"), unit("adoption"), unit("marketing"), unit("engagement"), unit("support_health", none=1.0), unit("tickets", 25.0), unit("satisfaction", 5.0), unit("response", 1440.0), unit("users", 50.0), unit("active_days", 30.0), unit("renewal"), scores.status_risk(c("status")), timing, scores.money(c("lifetime_value")), scores.money(c("contract")))
    f = fenced(e.select(*keys, *[v.alias(n) for n, v in zip(FEATURES, values)]))
    risk = 1 - c("support_health_score")
    good = (c("engagement_score") >= 0.75) & (c("product_adoption_score") >= 0.75) & (risk <= 0.25)
    lost = (c("renewal_status_risk") >= 0.90) | (c("renewal_probability") < 0.35) | (risk >= 0.75)
    weak = (c("engagement_score") < 0.35) | (c("product_adoption_score") < 0.35)
    return f.withColumn("label", F.when(lost | weak, "Churn Risk").when(good & (c("renewal_probability") >= 0.55), "Healthy").otherwise("At Risk"))


def health_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return featured(_overall(spark, sf_dir), "account")


def explicit_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A class as people write it, read from the first of several columns that holds one."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.element_at(F.array(*[F.lit(x) for x in ("healthy", "AT_RISK", " churn-risk ", "n/a", "", "At Risk")]), (F.col("o_orderkey") % 6 + 1).cast("int")).alias("a"), F.when(F.col("o_orderpriority") == "1-URGENT", "Churn Risk").alias("b"))
    return o.select("o_orderkey", scores.health_class(F.col("a"), F.col("b")).alias("label"))


def evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule classes held against the derived ones: support, precision, recall and F1 of each class, accuracy and macro F1."""
    pairs = health_scores_rules(spark, sf_dir).select(F.col("derived_class").alias("actual"), F.col("rule_class").alias("predicted"))
    return evaluated(pairs)


def evaluated(pairs: DataFrame) -> DataFrame:
    """label, support, predicted, right, precision, recall, f1 of each class; accuracy and macro_f1 beside them. Counts first, so
    at most nine rows are turned about."""
    n = pairs.groupBy("actual", "predicted").agg(F.count(F.lit(1)).alias("n"))
    ends = F.array(F.struct(F.col("actual").alias("label"), F.lit("a").alias("end")), F.struct(F.col("predicted").alias("label"), F.lit("p").alias("end")))
    hit = F.col("actual") == F.col("predicted")
    each = n.select("n", hit.alias("hit"), F.explode(ends).alias("e")).groupBy("e.label").agg(F.sum(F.when(F.col("e.end") == "a", F.col("n")).otherwise(0)).alias("support"), F.sum(F.when(F.col("e.end") == "p", F.col("n")).otherwise(0)).alias("predicted"), F.sum(F.when((F.col("e.end") == "a") & F.col("hit"), F.col("n")).otherwise(0)).alias("right"))
    ratio = lambda a, b: F.coalesce(F.col(a) / F.nullif(b, F.lit(0)), F.lit(0.0))
    each = each.withColumns({"precision": ratio("right", "predicted"), "recall": ratio("right", "support")})
    each = each.withColumn("f1", F.coalesce(2 * F.col("precision") * F.col("recall") / F.nullif(F.col("precision") + F.col("recall"), F.lit(0.0)), F.lit(0.0)))
    whole = each.where("support > 0").agg((F.sum("right") / F.sum("support")).alias("accuracy"), (F.sum(F.col("f1").cast("decimal(18,10)")).cast("double") / F.count(F.lit(1))).alias("macro_f1"))
    return each.crossJoin(F.broadcast(whole)).select("label", "support", "predicted", "right", *[r(F.col(x), 6).alias(x) for x in ("precision", "recall", "f1", "accuracy", "macro_f1")])  # one row


def health_model_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy and macro F1 of each trained candidate on the held-out accounts, and which was chosen."""
    rows = materialize(health_features(spark, sf_dir), "features")
    return health_model.choose(rows, FEATURES, "account", evaluated)[2]


def health_scores_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every account's class and probabilities by the chosen model."""
    rows = materialize(health_features(spark, sf_dir), "features")
    best, model, _ = health_model.choose(rows, FEATURES, "account", evaluated)
    return health_model.predict(model, rows, ["account"]).withColumn("model_algorithm", F.lit(best))


def _accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = health_scores_rules(spark, sf_dir)
    cust = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return h.join(cust.select(F.col("c_custkey").cast("string").alias("account"), F.col("c_mktsegment").alias("industry"), F.col("n_name").alias("country"), F.col("r_name").alias("region")), "account", "left")


_KPIS = lambda: [
    F.count(F.lit(1)).alias("accounts"), F.count_if(F.col("derived_class") == "Healthy").alias("healthy"), F.count_if(F.col("derived_class") == "At Risk").alias("at_risk"), F.count_if(F.col("derived_class") == "Churn Risk").alias("churn"),
    *[r(F.sum(F.col(x).cast("decimal(18,4)")).cast("double") / F.count(x)).alias(x) for x in ("engagement", "adoption", "support_health", "renewal")], F.sum(F.col("lifetime_value").cast("decimal(38,2)")).cast("double").alias("lifetime_value"),
]


def executive_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _accounts(spark, sf_dir).agg(*_KPIS())
    rate = lambda x: r(F.col(x) / F.nullif("accounts", F.lit(0))).alias(x + "_rate")
    return k.select("*", rate("healthy"), rate("at_risk"), rate("churn"))


def segment_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPIs by each value of three segments: one scan, unpivoted, instead of a union of scans."""
    kinds = F.array(*[F.struct(F.lit(n).alias("segment_type"), F.coalesce(F.col(c), F.lit("UNKNOWN")).alias("segment_value")) for n, c in (("Industry", "industry"), ("Country", "country"), ("Region", "region"))])
    return _accounts(spark, sf_dir).withColumn("s", F.explode(kinds)).groupBy("s.segment_type", "s.segment_value").agg(*_KPIS())


def account_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accounts(spark, sf_dir).select("account", "industry", "country", "derived_class", "churn_risk", "renewal", "lifetime_value")


def churn_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accounts(spark, sf_dir).where("renewal < 0.65 or derived_class = 'Churn Risk'").select("account", "renewal", "derived_class")


def partner_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as partners: tier by balance, brands as certifications, beside the mean health of all accounts (one row)."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct().join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    brands = li.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count_distinct("p_brand").alias("certifications"))
    tier = F.when(F.col("s_acctbal") >= 7500, "PLATINUM").when(F.col("s_acctbal") >= 5000, "GOLD").when(F.col("s_acctbal") >= 0, "SILVER").otherwise("REGISTERED")
    health = _accounts(spark, sf_dir).agg(F.count(F.lit(1)).alias("scored"), r(1 - F.sum(F.col("churn_risk").cast("decimal(18,4)")).cast("double") / F.count(F.lit(1))).alias("health"))
    s = table(spark, sf_dir, "supplier").join(brands, "s_suppkey", "left")
    return s.join(F.broadcast(health), F.lit(True), "left").select("s_suppkey", tier.alias("tier"), F.coalesce("certifications", F.lit(0)).alias("certifications"), "scored", "health")


_r = lambda x, d=4: f"round(cast({x} as decimal(38,10)), {d})::double"
_cl = lambda x: f"case when {x} is not null then least(greatest({x}, 0.0::double), 1.0::double) end"
_m = lambda x: f"sum(cast({x} as decimal(18,4)))::double / count({x})"


def _w(*parts: tuple[str, float]) -> str:
    top = " + ".join(f"case when {v} is not null then ({v}) * {w}::double else 0 end" for v, w in parts)
    return _r(f"({top}) / nullif({' + '.join(f'case when {v} is not null then {w}::double else 0 end' for v, w in parts)}, 0)")


_rank = "case when status = 'CANCELLED' then 0 when status = 'AT_RISK' then 1 when status = 'RENEWED' then 3 when status is not null then 2 end"
_METRICS = f"""
with e as (select user_id::varchar account, ts::date d, event_type, value, (props->>'$.k')::double / 100 feature from events),
day as (select account, d::varchar metric_date, count(*) logins, count(distinct event_type) users, count(*) filter (event_type = 'error') tickets, count(*) filter (event_type in ('click','view')) campaigns,
  {_m("case when event_type = 'error' then value % 5 end")} sat, {_m("case when event_type = 'error' then value * 4 end")} mins, {_m("case when event_type in ('click','view') then least(value / 500, 1.0) end")} eng, {_m('feature')} feat from e group by 1, d),
o as (select o_custkey::varchar account, (o_orderdate::date)::varchar metric_date, o_totalprice, case when o_orderpriority = '1-URGENT' then 'CANCELLED' when o_orderstatus = 'F' then 'RENEWED' when o_orderstatus = 'O' then 'PENDING' else 'AT_RISK' end status from orders),
metric as (
  select account, metric_date, logins, users, tickets, campaigns, {_r('sat')} satisfaction, {_r('mins')} response, {_r('eng')} engagement, {_r('feat')} feature,
    {_r('least(logins / 100.0::double, 1.0) * 0.4::double + 1 / 30.0::double * 0.3::double + least(users / 50.0::double, 1.0) * 0.3::double')} usage_score,
    case when tickets > 0 then {_r('least(tickets / 25.0::double, 1.0) * 0.4::double + least(sat / 5.0::double, 1.0) * 0.4::double + greatest(0.0, 1.0 - least(mins / 1440.0::double, 1.0)) * 0.2::double')} end support_score,
    null::double contract, null::bigint seats, null::varchar status from day
  union all select account, metric_date, null, null, null, null, null, null, null, null, null, null, sum(o_totalprice::decimal(18,2))::double, count(*), arg_min(status, {_rank}) from o group by 1, 2)
"""
_SIGNALS = ("usage_score", "engagement", "support_score", "satisfaction", "response", "feature")
_chance = "case when status is null then null when status = 'RENEWED' then 0.95 when status = 'PENDING' then 0.65 when status = 'AT_RISK' then 0.35 when status = 'CANCELLED' then 0.10 else 0.55 end"


def _agg_sql(keys: str) -> str:
    return f"""select {keys}, {', '.join(f"{_r(_m(c))} as {c}" for c in _SIGNALS)}, sum(tickets)::bigint tickets, sum(users)::bigint users, count(logins) active_days,
  sum(contract::decimal(18,2))::double contract, sum(seats)::bigint seats, arg_min(status, {_rank}) filter (status is not null) status, max(metric_date) filter (status is not null) expires, count(*) as "rows" from metric group by {keys}"""


def _enriched_sql(source: str, keys: str, as_of: str) -> str:
    left = f"date_diff('day', {as_of}, expires::date)"
    return f"""select * exclude (chance, timing), round(greatest(coalesce(contract, 0), 0)::decimal(20,2) * (1 + renewal)::decimal(5,4) * (1 + (coalesce(engagement, 0) + coalesce(adoption, 0)) / 4)::decimal(7,6), 2)::double lifetime_value from (
select *, {_w(('chance', 0.30), ('engagement', 0.20), ('adoption', 0.20), ('support_health', 0.20), ('timing', 0.05))} renewal from (
select {keys}, contract, status, expires, tickets, response, usage_score, engagement as marketing, satisfaction, users, active_days, seats, {left} as days_left,
  {_w((_cl('usage_score'), 0.45), (_cl('users / 50.0::double'), 0.15), (_cl('active_days / 30.0::double'), 0.15), (_cl('coalesce(feature, usage_score)'), 0.25))} adoption,
  {_w((_cl('usage_score'), 0.40), (_cl('engagement'), 0.35), (_cl('support_score'), 0.25))} engagement,
  coalesce({_w(('1 - ' + _cl('tickets / 25.0::double'), 0.30), (_cl('satisfaction / 5.0::double'), 0.35), ('1 - ' + _cl('response / 1440.0::double'), 0.20), (_cl('support_score'), 0.15))}, 1.0) support_health,
  ({_chance})::double chance, (case when {left} < 0 then 0.20 when {left} <= 30 then 0.45 when {left} <= 90 then 0.65 when {left} is not null then 0.85 end)::double timing from {source}))"""


def _money_sql(x: str) -> str:
    return _r(f"case when {x} > 0 then least(ln(1 + {x}) / ln(100001.0::double), 1.0) else 0 end", 6)


def _class_sql(source: str, keys: str) -> str:
    return f"""select *, (case derived_class when 'Healthy' then 0.05 when 'At Risk' then 0.45 else 0.85 end)::double churn_risk from (
select {keys}, engagement, adoption, support_health, renewal, lifetime_value, {_r('coalesce(' + _cl('tickets / 25.0::double') + ', 0)', 6)} ticket_norm, {_r('coalesce(' + _cl('response / 1440.0::double') + ', 0)', 6)} response_risk, {_money_sql('lifetime_value')} value_norm,
  case when status = 'CANCELLED' or renewal <= 0.20 or support_health <= 0.25 then 'Churn Risk' when engagement >= 0.75 and adoption >= 0.75 and support_health >= 0.75 and renewal >= 0.55 then 'Healthy' else 'At Risk' end derived_class,
  case when engagement >= 0.75 and adoption >= 0.75 and 1 - support_health <= 0.25 then 'Healthy' when engagement < 0.35 or adoption < 0.35 or 1 - support_health >= 0.75 then 'Churn Risk' else 'At Risk' end rule_class from {source})"""


_AGG = _METRICS + f""",
agg as ({_agg_sql('account')})
"""
_ENRICHED = _AGG + f""",
enriched as ({_enriched_sql('agg', 'account', f"date '{AS_OF}'")})
"""
_DAILY = _METRICS + f""",
agg as ({_agg_sql('account, metric_date')}),
enriched as ({_enriched_sql('agg', 'account, metric_date', 'metric_date::date')}),
health as ({_class_sql('enriched', 'account, metric_date')})
"""
_HEALTH = _ENRICHED + f""",
health as ({_class_sql('enriched', 'account')}),
accounts as (select health.*, c_mktsegment industry, n_name country, r_name region from health left join (select * from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey) c on c.c_custkey::varchar = account)
"""


def _features_sql(source: str, keys: str) -> str:
    unit = lambda x, none=0: _r(f"coalesce({_cl(x)}, {none})", 6)
    timing = "(case when days_left is null then 0.5 when days_left < 0 then 1.0 when days_left <= 30 then 0.75 when days_left <= 90 then 0.45 else 0.15 end)::double"
    status = "(case when status = 'RENEWED' then 0.05 when status = 'PENDING' then 0.40 when status = 'AT_RISK' then 0.75 when status = 'CANCELLED' then 1.0 else 0.5 end)::double"
    values = (unit("usage_score"), unit("adoption"), unit("marketing"), unit("engagement"), unit("support_health", 1), unit("tickets / 25.0::double"), unit("satisfaction / 5.0::double"), unit("response / 1440.0::double"), unit("users / 50.0::double"), unit("active_days / 30.0::double"), unit("renewal"), status, timing, _money_sql("lifetime_value"), _money_sql("contract"))
    return f"""select *, case when renewal_status_risk >= 0.9 or renewal_probability <= 0.2 then 'Churn Risk' when renewal_probability < 0.35 or 1 - support_health_score >= 0.75 then 'Churn Risk'
  when engagement_score >= 0.75 and product_adoption_score >= 0.75 and 1 - support_health_score <= 0.25 then case when renewal_probability < 0.55 then 'At Risk' else 'Healthy' end
  when engagement_score < 0.35 or product_adoption_score < 0.35 or 1 - support_health_score >= 0.75 then 'Churn Risk' else 'At Risk' end as label
from (select {keys}, {', '.join(f'{v} as {n}' for v, n in zip(values, FEATURES))} from {source})"""


_K = "count(*) as accounts, count(*) filter (derived_class = 'Healthy') as healthy, count(*) filter (derived_class = 'At Risk') as at_risk, count(*) filter (derived_class = 'Churn Risk') as churn, " + ", ".join(f"{_r(_m(x))} as {x}" for x in ("engagement", "adoption", "support_health", "renewal")) + ", sum(lifetime_value::decimal(38,2))::double as lifetime_value"

QUERIES = {
    "silver_metric_daily": silver_metric_daily, "conservative_status": conservative_status, "enrichment_aggregate": enrichment_aggregate, "enrichment": enrichment, "enrichment_daily": enrichment_daily, "health_features": health_features, "class_probabilities": class_probabilities, "explicit_labels": explicit_labels, "health_model_eval": health_model_eval, "health_scores_ml": health_scores_ml, "evaluation": evaluation, "health_scores_rules": health_scores_rules,
    "executive_kpis": executive_kpis, "segment_health": segment_health, "account_daily": account_daily, "churn_alerts": churn_alerts, "partner_performance": partner_performance,
}

ORACLE = {
    "silver_metric_daily": _METRICS + "select * from metric",
    "conservative_status": _METRICS + f"select account, metric_date, status, ({_rank})::int as status_rank, ({_chance})::double as status_chance from metric where status is not null",
    "enrichment_aggregate": _AGG + "select * from agg",
    "enrichment": _ENRICHED + f"select {', '.join(_BRIEF)} from enriched",
    "enrichment_daily": _DAILY + f"select metric_date, {', '.join(_BRIEF)} from enriched",
    "health_features": _ENRICHED + _features_sql("enriched", "account"),
    "class_probabilities": _HEALTH + """select account, derived_class, '{"Healthy":"' || (case derived_class when 'Healthy' then '0.85' when 'At Risk' then '0.2' else '0.05' end) || '","At Risk":"' || (case derived_class when 'At Risk' then '0.6' else '0.1' end) || '","Churn Risk":"' || (case derived_class when 'Healthy' then '0.05' when 'At Risk' then '0.2' else '0.85' end) || '"}' as probabilities from health""",
    "explicit_labels": """select o_orderkey, coalesce(case o_orderkey % 6 when 0 then 'Healthy' when 1 then 'At Risk' when 2 then 'Churn Risk' when 5 then 'At Risk' end, case when o_orderpriority = '1-URGENT' then 'Churn Risk' end) as label from orders""",
    "evaluation": _HEALTH + f""", lv as (select unnest(['Healthy', 'At Risk', 'Churn Risk']) label),
ev as (select label, count(*) filter (derived_class = label) support, count(*) filter (rule_class = label) predicted, count(*) filter (derived_class = label and rule_class = label) as "right" from lv, health group by 1 having support + predicted > 0),
pv as (select *, coalesce("right" / nullif(predicted, 0)::double, 0) as "precision", coalesce("right" / nullif(support, 0)::double, 0) recall from ev), fv as (select *, coalesce(2 * "precision" * recall / nullif("precision" + recall, 0), 0) f1 from pv),
wv as (select sum("right")::double / sum(support) accuracy, avg(f1) macro_f1 from fv where support > 0)
select label, support, predicted, "right", {', '.join(f'{_r(x, 6)} as {x}' for x in ('"precision"', 'recall', 'f1', 'accuracy', 'macro_f1'))} from fv, wv""",
    "health_scores_rules": _HEALTH + "select * from health",
    "executive_kpis": _HEALTH + f"select *, {', '.join(f'{_r(x + ' / nullif(accounts, 0)::double')} as {x}_rate' for x in ('healthy', 'at_risk', 'churn'))} from (select {_K} from accounts)",
    "segment_health": _HEALTH + f"select segment_type, segment_value, {_K} from (select a.*, s.segment_type, coalesce(case s.segment_type when 'Industry' then industry when 'Country' then country else region end, 'UNKNOWN') segment_value from accounts a cross join (values ('Industry'), ('Country'), ('Region')) s(segment_type)) group by 1, 2",
    "account_daily": _HEALTH + "select account, industry, country, derived_class, churn_risk, renewal, lifetime_value from accounts",
    "churn_alerts": _HEALTH + "select account, renewal, derived_class from accounts where renewal < 0.65 or derived_class = 'Churn Risk'",
    "partner_performance": _HEALTH + f""", b as (select l_suppkey, count(distinct p_brand) n from lineitem join part on l_partkey = p_partkey group by 1)
select s_suppkey, case when s_acctbal >= 7500 then 'PLATINUM' when s_acctbal >= 5000 then 'GOLD' when s_acctbal >= 0 then 'SILVER' else 'REGISTERED' end as tier, coalesce(n, 0) as certifications, a.scored, a.health
from supplier left join b on l_suppkey = s_suppkey left join (select count(*) scored, {_r('1 - ' + _m('churn_risk'))} health from accounts) a on true""",
}
