"""The six source systems: bronze models and their conformed identity columns.

A model projects a system's raw rows: the record id from a chain of columns, audit defaults, a hash and the raw row. The
conformed form is one list of columns for all customer systems, null where a system has no such column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..runtime import table

#: Chain of the record id, chain of the customer key, and priority of each system (lowest is preferred).
RECORD_ID = {
    "SALESFORCE": ("source_record_id", "customer_id"), "MARKETO": ("source_record_id", "lead_id", "email"), "ZENDESK": ("source_record_id", "support_account_id", "ticket_id", "customer_id", "email"),
    "PRODUCT_USAGE": ("source_record_id", "usage_event_id", "customer_day"), "LICENSING": ("source_record_id", "license_id", "customer_id"), "IMPARTNER": ("source_record_id", "partner_id"),
}
CUSTOMER_KEY = {
    "SALESFORCE": ("customer_id", "source_record_id"), "MARKETO": ("lead_id", "email", "source_record_id"), "ZENDESK": ("customer_id", "support_account_id", "email", "source_record_id"),
    "PRODUCT_USAGE": ("customer_id", "source_record_id"), "LICENSING": ("customer_id", "license_id", "source_record_id"),
}
PRIORITY = {"SALESFORCE": 10, "LICENSING": 20, "PRODUCT_USAGE": 30, "ZENDESK": 40, "MARKETO": 50, "IMPARTNER": 60}
#: The columns of each raw system and the columns of the test tables that stand in for them.
RAW = {
    "SALESFORCE": {"customer_id": "source_customer_id", "company_name": "company_name", "email": "email", "phone": "phone", "industry": "industry", "billing_street": "address_line_1", "billing_city": "city", "billing_state": "state_region", "billing_postal_code": "postal_code", "billing_country": "country", "website": "website_domain"},
    "MARKETO": {"lead_id": "source_customer_id", "email": "email", "company_name": "company_name", "phone": "phone", "lead_status": "customer_status"},
    "ZENDESK": {"support_account_id": "source_customer_id", "ticket_id": "cast(null as string)", "customer_id": "cast(null as string)", "company_name": "company_name", "email": "email", "ticket_status": "customer_status"},
    "PRODUCT_USAGE": {"usage_event_id": "cast(null as string)", "customer_id": "source_customer_id", "event_date": "cast(created_date as date)", "company_name": "company_name"},
    "LICENSING": {"license_id": "cast(null as string)", "customer_id": "source_customer_id", "company_name": "company_name", "email": "email", "phone": "phone", "renewal_status": "customer_status"},
    "IMPARTNER": {"partner_id": "partner_id", "company_name": "company_name", "email": "email", "phone": "phone", "partner_tier": "partner_tier", "partner_region": "partner_region", "partner_status": "partner_status"},
}
#: Where the conformed columns of a customer system come from.
IDENTITY = ("company_name", "email", "phone", "address_line_1", "address_line_2", "city", "state_region", "postal_code", "country", "website", "industry", "customer_status")
CONFORMED = {
    "SALESFORCE": {"address_line_1": "billing_street", "city": "billing_city", "state_region": "billing_state", "postal_code": "billing_postal_code", "country": "billing_country"},
    "MARKETO": {"customer_status": "lead_status"}, "ZENDESK": {"customer_status": "ticket_status"}, "PRODUCT_USAGE": {}, "LICENSING": {"customer_status": "renewal_status"},
}


def raw(spark: SparkSession, sf_dir: str, system: str) -> DataFrame:
    partner = system == "IMPARTNER"
    df = table(spark, sf_dir, "silver_partner_profile" if partner else "silver_customer").where(F.lit(True) if partner else F.col("source_system") == system)
    named = [F.expr(e).alias(c) for c, e in RAW[system].items()]
    created = F.lit(None).cast("timestamp_ntz") if partner else F.col("created_date")
    record = F.lit(None).cast("string") if partner else F.col("source_record_id")
    return df.select(record.alias("source_record_id"), *named, created.alias("created_date"), "last_modified_timestamp", "is_deleted", "load_batch_id", F.col("standardized_at").alias("load_timestamp"))


def _filled(columns: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in columns])


def bronze_model(rows: DataFrame, system: str, run_id: str = "run") -> DataFrame:
    """The raw columns with source_record_id, source_system, audit defaults, record_hash and raw_payload; rows without a record id are left out.

    A record id of customer and day needs both; a blank counts as missing.
    """
    if "customer_day" in RECORD_ID[system]:
        rows = rows.withColumn("customer_day", F.when(F.col("customer_id").isNotNull() & F.col("event_date").isNotNull(), F.concat_ws("-", "customer_id", "event_date")))
    own = [c for c in rows.columns if c not in ("source_record_id", "customer_day")]
    out = rows.withColumns({"raw_payload": F.to_json(F.struct(*own), {"ignoreNullFields": "false"}), "source_record_id": _filled(RECORD_ID[system])}).where("source_record_id is not null")
    out = out.withColumns({
        "source_system": F.lit(system), "last_modified_timestamp": F.coalesce("last_modified_timestamp", "load_timestamp"), "is_deleted": F.coalesce("is_deleted", F.lit(False)),
        "load_batch_id": F.coalesce("load_batch_id", F.lit(run_id)), "record_hash": text.surrogate_key("source_record_id", *RAW[system]),
    })
    return out.drop("customer_day")


def conformed(bronze: DataFrame, system: str) -> DataFrame:
    """source_system, source_customer_id, source_record_id, the identity columns, and the row's times, flag, priority and load."""
    have = CONFORMED[system]
    named = [(F.col(have.get(c, c)) if have.get(c, c) in bronze.columns else F.lit(None).cast("string")).alias(c) for c in IDENTITY]
    return bronze.select("source_system", _filled(CUSTOMER_KEY[system]).alias("source_customer_id"), "source_record_id", *named, "created_date", "last_modified_timestamp", "is_deleted", F.lit(PRIORITY[system]).alias("source_priority"), "load_batch_id")


def all_conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five customer systems in one form."""
    parts = [conformed(bronze_model(raw(spark, sf_dir, s), s), s) for s in CONFORMED]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def priorities(spark: SparkSession) -> DataFrame:
    """The lookup of priorities: one row a system."""
    return spark.createDataFrame(list(PRIORITY.items()), "source_system string, source_priority int")
