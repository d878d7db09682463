"""Standardisation of typed values as Column expressions; null, blank and null words give null throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Word lists and code tables.
NULL_WORDS = ("NULL", "NONE", "N/A", "NA")
LEGAL_SUFFIXES = ("CO", "COMPANY", "CORP", "CORPORATION", "INC", "INCORPORATED", "LLC", "LTD", "LIMITED", "PLC")
ADDRESS_WORDS = {
    "STREET": "ST", "ST.": "ST", "ROAD": "RD", "RD.": "RD", "AVENUE": "AVE", "AVE.": "AVE", "BOULEVARD": "BLVD", "BLVD.": "BLVD", "DRIVE": "DR", "DR.": "DR",
    "LANE": "LN", "LN.": "LN", "COURT": "CT", "CT.": "CT", "SUITE": "STE", "STE.": "STE", "APARTMENT": "APT", "APT.": "APT",
}
STATES = {
    "ALABAMA": "AL", "ALASKA": "AK", "ARIZONA": "AZ", "ARKANSAS": "AR", "CALIFORNIA": "CA", "COLORADO": "CO", "CONNECTICUT": "CT", "DELAWARE": "DE", "FLORIDA": "FL", "GEORGIA": "GA",
    "HAWAII": "HI", "IDAHO": "ID", "ILLINOIS": "IL", "INDIANA": "IN", "IOWA": "IA", "KANSAS": "KS", "KENTUCKY": "KY", "LOUISIANA": "LA", "MAINE": "ME", "MARYLAND": "MD",
    "MASSACHUSETTS": "MA", "MICHIGAN": "MI", "MINNESOTA": "MN", "MISSISSIPPI": "MS", "MISSOURI": "MO", "MONTANA": "MT", "NEBRASKA": "NE", "NEVADA": "NV", "NEW HAMPSHIRE": "NH",
    "NEW JERSEY": "NJ", "NEW MEXICO": "NM", "NEW YORK": "NY", "NORTH CAROLINA": "NC", "NORTH DAKOTA": "ND", "OHIO": "OH", "OKLAHOMA": "OK", "OREGON": "OR", "PENNSYLVANIA": "PA",
    "RHODE ISLAND": "RI", "SOUTH CAROLINA": "SC", "SOUTH DAKOTA": "SD", "TENNESSEE": "TN", "TEXAS": "TX", "UTAH": "UT", "VERMONT": "VT", "VIRGINIA": "VA", "WASHINGTON": "WA",
    "WEST VIRGINIA": "WV", "WISCONSIN": "WI", "WYOMING": "WY",
}
COUNTRIES = {"US": "US", "USA": "US", "UNITED STATES": "US", "UNITED STATES OF AMERICA": "US", "UK": "GB", "UNITED KINGDOM": "GB", "GREAT BRITAIN": "GB"}
EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


def lookup(table: dict[str, str], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def null_if_blank(value: Column) -> Column:
    text = F.trim(value)
    return F.when((text != "") & ~F.upper(text).isin(*NULL_WORDS), text)


def one_space(value: Column) -> Column:
    return F.regexp_replace(null_if_blank(value), r"\s+", " ")


def clean_text(value: Column) -> Column:
    """The warehouse form: upper case, single blanks, empty as null."""
    return F.nullif(F.regexp_replace(F.upper(F.trim(value)), r"\s+", " "), F.lit(""))


def name(value: Column) -> Column:
    return F.regexp_replace(F.upper(one_space(value)), r"[^A-Z0-9 '\-]", "")


def company_name(value: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.upper(one_space(value)), r"[^\p{L}\p{N}_& ]", " "), r" +", " "))


def company_key(value: Column) -> Column:
    full = company_name(value)
    kept = F.array_join(F.filter(F.split(full, " "), lambda t: ~t.isin(*LEGAL_SUFFIXES)), " ")
    return F.when(kept == "", full).otherwise(kept)


def company_key_sql(value: Column) -> Column:
    """The warehouse form: seven suffixes by word boundary, the blank in front of one stays."""
    return F.regexp_replace(F.regexp_replace(clean_text(value), r"\b(CORP|CORPORATION|INC|LLC|LTD|CO|COMPANY)\b", ""), r"\s+", " ")


def email(value: Column) -> Column:
    return F.lower(null_if_blank(value))


def email_domain(value: Column) -> Column:
    text = email(value)
    return F.when(F.contains(text, F.lit("@")), F.substring_index(text, "@", -1))


def phone(value: Column) -> Column:
    digits = F.regexp_replace(null_if_blank(value), "[^0-9]", "")
    digits = F.when((F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10)).otherwise(digits)
    return F.nullif(digits, F.lit(""))


def address(value: Column) -> Column:
    text = F.regexp_replace(F.trim(F.regexp_replace(F.upper(one_space(value)), "[#,]", " ")), r"\s+", " ")
    return F.array_join(F.transform(F.split(text, " "), lambda t: F.coalesce(lookup(ADDRESS_WORDS, t), t)), " ")


def state(value: Column) -> Column:
    text = name(value)
    return F.when(F.length(text) == 2, text).otherwise(F.coalesce(lookup(STATES, text), text))


def postal(value: Column) -> Column:
    return F.regexp_replace(F.upper(null_if_blank(value)), "[^A-Z0-9]", "")


def country(value: Column) -> Column:
    text = name(value)
    return F.coalesce(lookup(COUNTRIES, text), text)


def website(value: Column) -> Column:
    text = F.regexp_replace(F.lower(null_if_blank(value)), r"^https?://", "")
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"[/?#].*$", ""), r":\d+$", ""), r"^www\.", "")
    return F.nullif(text, F.lit(""))


def combine_address(*parts: Column) -> Column:
    return F.nullif(F.concat_ws(" ", *[F.nullif(p, F.lit("")) for p in parts]), F.lit(""))


def mask_email(value: Column, plain: Column) -> Column:
    at = F.instr(value, "@")
    return F.when(plain, value).when(at > 0, F.concat(F.substring(value, 1, 1), F.lit("***"), F.substr(value, at))).when(value.isNotNull(), F.lit("***"))


def mask_phone(value: Column, plain: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    return F.when(plain, value).when(F.length(digits) >= 4, F.concat(F.lit("***-***-"), F.right(digits, F.lit(4)))).when(value.isNotNull(), F.lit("***"))


def mask_address(value: Column, plain: Column) -> Column:
    return F.when(plain, value).when(value.isNotNull(), F.lit("REDACTED"))


def stable_id(prefix: str, members: Column, hex_digits: int = 24) -> Column:
    """prefix and the start of a sha256 over sorted ``system:id`` members (array of source_system and source_customer_id)."""
    text = F.array_join(F.transform(F.sort_array(members), lambda m: F.concat_ws(":", m["source_system"], m["source_customer_id"])), "|")
    return F.concat(F.lit(prefix), F.substring(F.sha2(text, 256), 1, hex_digits))


def surrogate_key(*columns: str) -> Column:
    """sha256 over the columns as text with || between, nulls marked."""
    return F.sha2(F.concat_ws("||", *[F.coalesce(F.col(c).cast("string"), F.lit("__null__")) for c in columns]), 256)


def certifications(value: Column) -> Column:
    """The codes of a text: a JSON list, or a list with commas; trimmed, upper case, without blanks; never null."""
    codes = F.coalesce(F.from_json(value, "array<string>"), F.when(~F.trim(value).startswith("{"), F.split(value, ",")))
    kept = F.filter(F.transform(codes, lambda c: F.upper(F.trim(c))), lambda c: c != "")
    return F.coalesce(kept, F.array().cast("array<string>"))


def as_number(value: Column) -> Column:
    """A number of a text, null where it is none."""
    return F.trim(value).try_cast("double")


def as_integer(value: Column) -> Column:
    """The number truncated toward zero."""
    return as_number(value).try_cast("bigint")


def as_time(value: Column) -> Column:
    """A timestamp of an ISO text: T or blank, Z or an offset, no zone is UTC; null where it is none."""
    text = F.trim(value)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]|$)"), text).try_cast("timestamp")


def day_of(value: Column) -> Column:
    """The first ten characters of a time as text."""
    return F.nullif(F.substring(F.trim(value.cast("string")), 1, 10), F.lit(""))


def enabled_share(value: Column) -> Column:
    """Share of the values of a JSON object or list that are set, of four digits; null if it is empty or neither.

    Not set: false, 0, "", null and empty lists and objects; the text "false" is set.
    """
    unset = ("false", "0", "0.0", "-0.0", '""', "null", "[]", "{}")
    parsed = F.try_parse_json(value)
    as_map = F.try_variant_get(parsed, "$", "map<string,variant>")
    as_list = F.try_variant_get(parsed, "$", "array<variant>")
    cells = F.transform(F.coalesce(F.map_values(as_map), as_list), lambda v: F.coalesce(F.to_json(v), F.lit("null")))
    share = F.size(F.filter(cells, lambda c: ~c.isin(*unset))) / F.nullif(F.size(cells), F.lit(0))
    return F.round(share.cast("decimal(38,10)"), 4).cast("double")
