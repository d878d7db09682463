"""Row validation, declarative rules on tables, alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text


def present(column: str) -> Column:
    return F.coalesce(F.trim(F.col(column).cast("string")) != "", F.lit(False))


def completeness(fields: Sequence[str]) -> Column:
    filled = sum((F.when(present(f), 1).otherwise(0) for f in fields), F.lit(0))
    return F.round((filled / F.lit(len(fields))).cast("decimal(38,10)"), 4).cast("double")


def customer_issues() -> Column:
    """The names of the rules that a customer row breaks: errors, and one warning (``w:``)."""
    signal = present("company_name") | present("email") | present("phone")
    digits = F.length(F.regexp_replace("phone", "[^0-9]", ""))
    checks = [
        F.when(~present("source_system"), "source_system_required"),
        F.when(~present("source_customer_id"), "source_customer_id_required"),
        F.when(~signal, "identity_signal_required"),
        F.when(present("email") & ~F.col("email").rlike(text.EMAIL), "valid_email"),
        F.when(present("phone") & ~digits.between(7, 15), "w:phone_length"),
    ]
    return F.array_compact(F.array(*checks))


def partner_issues() -> Column:
    """As ``customer_issues``, for a partner."""
    digits = F.length(F.regexp_replace("phone", "[^0-9]", ""))
    required = [F.when(~present(c), f"{c}_required") for c in ("source_system", "partner_id", "company_name")]
    return F.array_compact(F.array(*required, F.when(present("email") & ~F.col("email").rlike(text.EMAIL), "valid_email"), F.when(present("phone") & ~digits.between(7, 15), "w:phone_length")))


def quality_score(complete: Column, issues: Column) -> Column:
    warnings = F.size(F.filter(issues, lambda x: x.startswith("w:")))
    errors = F.size(issues) - warnings
    return F.greatest(F.lit(0.0), F.round((complete - errors * 0.25 - warnings * 0.1).cast("decimal(38,10)"), 4).cast("double"))


def rule_failures(df: DataFrame, rules: Sequence[dict], by: Sequence[str] = (), clock: Column | None = None) -> DataFrame:
    """by, rule_name, rule_type, severity, mostly, total, failed over all rules but uniqueness, in one pass.

    A rule: name, type (not_null, regex, in_set, between, pair_ge, row_count, recent), severity and its arguments;
    ``mostly`` the share that must pass. Null values pass unless the rule says ``nulls: False``. A rule of type recent fails
    for all rows if the greatest time is more than ``hours`` before ``clock``, or if there is none.
    """

    def failed(rule: dict) -> Column:
        kind, c = rule["type"], rule.get("column")
        n = F.count(F.lit(1))
        if kind == "row_count":
            return F.when(n.between(rule.get("min", 0), rule.get("max", 1 << 62)), 0).otherwise(n)
        if kind == "recent":
            return F.when(F.max(c) >= clock - F.expr(f"interval {int(rule['hours'])} hours"), 0).otherwise(n)
        if kind == "not_null":
            return F.count_if(~present(c))
        value = F.col(c)
        bad = {
            "regex": lambda: ~value.rlike(f"^(?:{rule['pattern']})"),
            "in_set": lambda: ~value.cast("string").isin(*rule["values"]),
            "between": lambda: ~value.try_cast("double").between(rule.get("min", float("-inf")), rule.get("max", float("inf"))),
            "pair_ge": lambda: value < F.col(rule["other"]),
        }[kind]()
        return F.count_if(F.coalesce(bad, F.lit(not rule.get("nulls", True))))

    one = df.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), *[failed(x).alias(f"f{i}") for i, x in enumerate(rules)])
    rows = F.array(*[F.struct(F.lit(x["name"]).alias("rule_name"), F.lit(x["type"]).alias("rule_type"), F.lit(x.get("severity", "ERROR")).alias("severity"), F.lit(float(x.get("mostly", 1.0))).alias("mostly"), F.col(f"f{i}").cast("bigint").alias("failed")) for i, x in enumerate(rules)])
    return one.select(*by, "total", F.explode(rows).alias("r")).select(*by, "r.rule_name", "r.rule_type", "r.severity", "r.mostly", "total", "r.failed")


def unique_failures(df: DataFrame, name: str, keys: Sequence[str], severity: str = "ERROR", by: Sequence[str] = (), mostly: float = 1.0) -> DataFrame:
    """As ``rule_failures``: rows in groups that share a key, compared in upper case without blanks around; nulls are equal."""
    groups = df.groupBy(*by, *[F.upper(F.trim(F.col(k).cast("string"))).alias(f"__{k}") for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    kind = "unique" if len(keys) == 1 else "compound_unique"
    return groups.groupBy(*by).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("failed")).select(
        *by, F.lit(name).alias("rule_name"), F.lit(kind).alias("rule_type"), F.lit(severity).alias("severity"), F.lit(mostly).alias("mostly"), "total", "failed"
    )


def evaluated(failures: DataFrame) -> DataFrame:
    """Adds score and status: PASS, FAIL (ERROR, CRITICAL) or WARN."""
    score = F.coalesce(F.round((1 - F.col("failed") / F.nullif("total", F.lit(0))).cast("decimal(38,10)"), 4).cast("double"), F.lit(1.0))
    ok = F.col("score") >= F.col("mostly")
    return failures.withColumn("score", score).withColumn("status", F.when(ok, "PASS").when(F.col("severity").isin("ERROR", "CRITICAL"), "FAIL").otherwise("WARN")).drop("mostly")


def alerts(results: DataFrame) -> DataFrame:
    level = F.when(F.col("status") == "FAIL", "CRITICAL").otherwise("WARNING")
    return results.where("status <> 'PASS'").select("rule_name", level.alias("alert_severity"), F.lit("OPEN").alias("alert_status"), "failed", "score")
