"""Suites of quality rules: the four shipped ones, suites from JSON documents, their runs, summaries and alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from . import quality

TRUTHS = ["True", "False", "true", "false", "0", "1"]


def rule(name: str, category: str, kind: str, column: str | None = None, severity: str = "ERROR", mostly: float = 1.0, **more) -> dict:
    return {"name": name, "category": category, "type": kind, "column": column, "severity": severity, "mostly": mostly} | more


#: The rules of the four suites.
SUITES: dict[str, list[dict]] = {
    "customer_silver_suite": [
        rule("silver_customer_row_count_positive", "completeness", "row_count", min=1),
        rule("source_system_required", "completeness", "not_null", "source_system"),
        rule("source_customer_id_required", "completeness", "not_null", "source_customer_id"),
        rule("source_customer_unique", "uniqueness", "unique", keys=["source_system", "source_customer_id"]),
        rule("email_valid_format", "validity", "regex", "email", mostly=0.98, pattern=text.EMAIL),
        rule("completeness_score_between_zero_and_one", "validity", "between", "completeness_score", min=0, max=1),
        rule("data_quality_score_between_zero_and_one", "validity", "between", "data_quality_score", min=0, max=1),
        rule("is_deleted_boolean", "consistency", "in_set", "is_deleted", values=TRUTHS, nulls=False),
        rule("last_modified_after_created", "consistency", "pair_ge", "last_modified_timestamp", "WARNING", 0.99, other="created_date"),
        rule("silver_customer_freshness_24h", "freshness", "recent", "standardized_at", hours=24),
    ],
    "gold_customer_master_suite": [
        rule("gold_customer_master_row_count_positive", "completeness", "row_count", min=1),
        rule("golden_customer_id_required", "completeness", "not_null", "golden_customer_id"),
        rule("cluster_id_required", "completeness", "not_null", "cluster_id"),
        rule("golden_customer_id_unique", "uniqueness", "unique", keys=["golden_customer_id"]),
        rule("gold_email_valid_format", "validity", "regex", "email", mostly=0.98, pattern=text.EMAIL),
        rule("confidence_score_between_zero_and_one", "validity", "between", "confidence_score", min=0, max=1),
        rule("gold_completeness_score_between_zero_and_one", "validity", "between", "completeness_score", min=0, max=1),
        rule("gold_is_active_boolean", "consistency", "in_set", "is_active", values=TRUTHS, nulls=False),
        rule("last_seen_after_first_seen", "consistency", "pair_ge", "last_seen_at", other="first_seen_at"),
        rule("gold_customer_master_freshness_24h", "freshness", "recent", "updated_at", hours=24),
    ],
    "customer_enrichment_metrics_suite": [
        rule("customer_enrichment_metrics_row_count_positive", "completeness", "row_count", min=1),
        rule("enrichment_golden_customer_id_required", "completeness", "not_null", "golden_customer_id"),
        rule("metric_date_required", "completeness", "not_null", "metric_date"),
        rule("customer_enrichment_metric_unique", "uniqueness", "unique", keys=["golden_customer_id", "metric_date"]),
        rule("product_adoption_score_between_zero_and_one", "validity", "between", "product_adoption_score", min=0, max=1),
        rule("engagement_score_between_zero_and_one", "validity", "between", "engagement_score", min=0, max=1),
        rule("support_health_score_between_zero_and_one", "validity", "between", "support_health_score", min=0, max=1),
        rule("renewal_probability_between_zero_and_one", "validity", "between", "renewal_probability", min=0, max=1),
        rule("lifetime_value_non_negative", "consistency", "between", "lifetime_value", min=0),
        rule("customer_enrichment_metrics_freshness_24h", "freshness", "recent", "calculated_at", hours=24),
    ],
    "customer_health_scores_suite": [
        rule("customer_health_scores_row_count_positive", "completeness", "row_count", min=1),
        rule("health_golden_customer_id_required", "completeness", "not_null", "golden_customer_id"),
        rule("score_date_required", "completeness", "not_null", "score_date"),
        rule("customer_health_score_unique", "uniqueness", "unique", keys=["golden_customer_id", "score_date"]),
        rule("health_class_valid", "validity", "in_set", "health_class", values=["Healthy", "At Risk", "Churn Risk"], nulls=False),
        rule("churn_risk_score_between_zero_and_one", "validity", "between", "churn_risk_score", min=0, max=1, nulls=False),
        rule("health_renewal_probability_between_zero_and_one", "validity", "between", "renewal_probability", min=0, max=1),
        rule("model_algorithm_supported", "consistency", "in_set", "model_algorithm", values=["logistic_regression", "random_forest", "xgboost"]),
        rule("model_version_required", "consistency", "not_null", "model_version"),
        rule("customer_health_scores_freshness_24h", "freshness", "recent", "scored_at", hours=24),
    ],
}
#: Which suite holds for which stage of the pipeline.
GROUPS = {"silver": "customer_silver_suite", "gold": "gold_customer_master_suite", "enrichment": "customer_enrichment_metrics_suite", "scoring": "customer_health_scores_suite"}
_KINDS = {
    "expect_table_row_count_to_be_between": "row_count", "expect_column_values_to_not_be_null": "not_null", "expect_compound_columns_to_be_unique": "unique", "expect_column_values_to_be_unique": "unique",
    "expect_column_values_to_match_regex": "regex", "expect_column_values_to_be_in_set": "in_set", "expect_column_values_to_be_between": "between", "expect_column_pair_values_a_to_be_greater_than_or_equal_to_b": "pair_ge", "expect_column_max_to_be_recent": "recent",
}


def from_document(document: dict) -> list[dict]:
    """The rules of a JSON suite: expectations with expectation_type, kwargs and meta. An unknown type is an error."""
    out = []
    for e in document["expectations"]:
        kind, k, meta = e["expectation_type"], e.get("kwargs", {}), e.get("meta", {})
        if kind not in _KINDS:
            raise ValueError(f"unknown expectation {kind!r}")
        one = rule(meta.get("rule_name", kind), meta.get("rule_type", "validity"), _KINDS[kind], k.get("column", k.get("column_A")), meta.get("severity", "ERROR"), float(k.get("mostly", 1.0)))
        one |= {n: k[o] for n, o in (("min", "min_value"), ("max", "max_value"), ("pattern", "regex"), ("values", "value_set"), ("other", "column_B"), ("hours", "max_age_hours")) if o in k}
        if one["type"] == "unique":
            one["keys"] = k.get("column_list") or [k["column"]]
        one["nulls"] = k.get("allow_null", one["type"] != "in_set")
        out.append(one)
    return out


def run(df: DataFrame, rules: Sequence[dict], clock: Column | None = None, by: Sequence[str] = ()) -> DataFrame:
    """rule_name, category, severity, total, failed, score, status of each rule, for each value of ``by``: one pass for all rules but
    uniqueness, one aggregation for each of those. ``clock``: the time against which freshness is held."""
    flat = quality.rule_failures(df, [r for r in rules if r["type"] != "unique"], by, clock)
    for r in rules:
        if r["type"] == "unique":
            flat = flat.unionByName(quality.unique_failures(df, r["name"], r["keys"], r["severity"], by, r["mostly"]))
    kinds = F.create_map(*[F.lit(x) for r in rules for x in (r["name"], r["category"])])
    return quality.evaluated(flat).withColumn("category", F.element_at(kinds, F.col("rule_name"))).select(*by, "rule_name", "category", "severity", "total", "failed", "score", "status")


def summary(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row a run: rules, failed and warned ones, mean score, status (any rule that doesn't pass fails the run), names of the failed."""
    bad = F.col("status") != "PASS"
    out = results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("metrics_total"), F.count_if(bad).alias("metrics_failed"), F.count_if(F.col("status") == "WARN").alias("metrics_warned"),
        F.round((F.sum(F.col("score").cast("decimal(18,4)")) / F.count(F.lit(1))).cast("decimal(38,10)"), 4).cast("double").alias("quality_score"), F.array_join(F.array_sort(F.collect_set(F.when(bad, F.col("rule_name")))), ",").alias("failed_rules"),
    )
    return out.withColumn("status", F.when(F.col("metrics_failed") > 0, "FAIL").otherwise("PASS"))


def alert_rows(results: DataFrame, run_columns: Sequence[str]) -> DataFrame:
    """An open alert for each rule that doesn't pass, with an id that a repeated run gives again."""
    key = F.concat_ws("|", *run_columns, "rule_name")
    level = F.when(F.col("status") == "FAIL", "CRITICAL").otherwise("WARNING")
    return results.where("status <> 'PASS'").select(*run_columns, F.substring(F.sha2(key, 256), 1, 32).alias("alert_id"), "rule_name", level.alias("alert_severity"), F.lit("OPEN").alias("alert_status"))


def validate(df: DataFrame, group: str, clock: Column | None = None, notify=None) -> DataFrame:
    """Run the suite of a pipeline stage and raise if any rule fails or warns; ``notify`` is called with each alert first.

    Only the rows of the rules come to the driver.
    """
    results = run(df, SUITES[GROUPS[group]], clock)
    broken = results.where("status <> 'PASS'").collect()
    for r in broken:
        if notify:
            notify(r.asDict())
    if broken:
        raise ValueError(f"{GROUPS[group]}: {', '.join(sorted(r['rule_name'] for r in broken))}")
    return results
