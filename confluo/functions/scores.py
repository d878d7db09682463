"""Score arithmetic that both engines round alike."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Renewal statuses (upper case, _ for blank and -) and their chance.
STATUS = {
    **dict.fromkeys(("RENEWED", "ACTIVE", "AUTO_RENEW", "AUTO_RENEWAL"), (3, 0.95)),
    **dict.fromkeys(("OPEN", "PENDING", "IN_PROGRESS"), (2, 0.65)),
    **dict.fromkeys(("AT_RISK", "RISK", "DOWNGRADE_RISK"), (1, 0.35)),
    **dict.fromkeys(("CANCELLED", "CANCELED", "CHURNED", "EXPIRED", "LOST"), (0, 0.10)),
}


def r(value: Column, digits: int = 4) -> Column:
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


def clamp(value: Column) -> Column:
    """Between 0 and 1; null stays null."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)))


def weighted(*parts: tuple[Column, float]) -> Column:
    """Mean of the present parts by their weights; null without any."""
    top = sum((F.when(v.isNotNull(), v * F.lit(w)).otherwise(F.lit(0.0)) for v, w in parts), F.lit(0.0))
    weight = sum((F.when(v.isNotNull(), F.lit(w)).otherwise(F.lit(0.0)) for v, w in parts), F.lit(0.0))
    return r(top / F.nullif(weight, F.lit(0.0)))


def status_word(status: Column) -> Column:
    return F.translate(F.upper(F.trim(status)), "- ", "__")


def status_rank(status: Column) -> Column:
    out = F.lit(2)
    for rank in (0, 1, 3):
        out = F.when(status_word(status).isin(*[k for k, v in STATUS.items() if v[0] == rank]), rank).otherwise(out)
    return out


def status_chance(status: Column) -> Column:
    out = F.lit(0.55)
    for chance in sorted({v[1] for v in STATUS.values()}):
        out = F.when(status_word(status).isin(*[k for k, v in STATUS.items() if v[1] == chance]), chance).otherwise(out)
    return F.when(status.isNotNull(), out)


def usage_score(logins: Column, days: Column, users: Column) -> Column:
    part = lambda x, top, w: F.coalesce(F.least(x / F.lit(top), F.lit(1.0)), F.lit(0.0)) * F.lit(w)
    return r(part(logins, 100.0, 0.4) + part(days, 30.0, 0.3) + part(users, 50.0, 0.3))


def support_activity(tickets: Column, satisfaction: Column, minutes: Column) -> Column:
    busy = F.least(F.coalesce(tickets, F.lit(0)) / F.lit(25.0), F.lit(1.0)) * 0.4
    happy = F.least(F.coalesce(satisfaction, F.lit(0)) / F.lit(5.0), F.lit(1.0)) * 0.4
    fast = F.greatest(F.lit(0.0), F.lit(1.0) - F.least(F.coalesce(minutes, F.lit(0)) / F.lit(1440.0), F.lit(1.0))) * 0.2
    return r(busy + happy + fast)


def money(value: Column) -> Column:
    """An amount on a logarithmic scale up to 100,000; nothing or less is 0."""
    return r(F.when(value > 0, F.least(F.log1p(value) / F.log1p(F.lit(100000.0)), F.lit(1.0))).otherwise(0.0), 6)


def status_risk(status: Column) -> Column:
    """The risk of a renewal status, by the same groups as its chance; 0.5 where it is unknown."""
    risks = {3: 0.05, 2: 0.40, 1: 0.75, 0: 1.00}
    out = F.lit(0.50)
    for rank, risk in risks.items():
        out = F.when(status_word(status).isin(*[k for k, v in STATUS.items() if v[0] == rank]), risk).otherwise(out)
    return F.coalesce(out, F.lit(0.50))


def health_class(*candidates: Column) -> Column:
    """The first of the texts that names a class, whatever its case, with _ or - for the blank."""
    named = lambda c: F.translate(F.upper(F.trim(c)), "_-", "  ")
    return F.coalesce(*[F.when(named(c) == name.upper(), name) for c in candidates for name in ("Healthy", "At Risk", "Churn Risk")])
