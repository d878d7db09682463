"""Matching records of different sources without a common key, by probabilistic linkage.

Passes of blocking (name, email address, email domain, phone, location) give candidate pairs; a pair is a vector of
agreement levels; expectation-maximisation over the counts of the vectors estimates how often each level occurs among
matches and among non-matches; the posterior probability of a match is the pair's confidence.

A value that many differently named records hold (a switchboard, an office building, a migration mailbox, a mail host)
identifies nobody. Such a value opens no block, so blocks don't grow with the square of the data, and agreeing on it is a
level of its own. A pair that agrees on such values only is no match at any frequency, and a pair that agrees on
anything else meets in that field's pass, so nothing is lost by it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import discard, materialize
from .addresses import locations
from .components import connected_groups, record_id
from .names import canonical_words, parse_names, respelled, word_counts
from .survivors import counting_rows, says_something

FIELDS = ("name", "email", "phone", "place")
#: Start of the estimation: chance of each level among matches and among non-matches. Level 0, missing, is no evidence.
START = {
    "name": {1: (0.66, 0.02), 2: (0.20, 0.02), 3: (0.01, 0.10), 4: (0.06, 0.01), 5: (0.04, 0.02), 6: (0.03, 0.83)},
    "email": {1: (0.25, 0.02), 2: (0.55, 0.08), 3: (0.03, 0.10), 4: (0.05, 0.01), 5: (0.12, 0.79)},
    "phone": {1: (0.80, 0.10), 2: (0.06, 0.01), 3: (0.10, 0.69), 4: (0.04, 0.20)},
    "place": {1: (0.70, 0.20), 2: (0.25, 0.60), 3: (0.05, 0.20)},
}
VALUES = ("address", "domain", "phone", "place")


def email_parts(email: Column) -> tuple[Column, Column]:
    """Local part without tag, and domain without a mail host in front; null where it is no address."""
    text = F.lower(F.regexp_replace(email, r"\s", ""))
    ok = says_something(email) & text.rlike(r"^[^@]+@[^@]+\.[^@]+$")
    domain = F.regexp_replace(F.regexp_replace(F.substring_index(text, "@", -1), r"^(?:mail|corp|eu|www|smtp|mx)\.", ""), r"(\.[a-z]+)\1$", "$1")
    return F.when(ok, F.regexp_replace(F.substring_index(text, "@", 1), r"\+.*$", "")), F.when(ok, domain)


def phone_digits(phone: Column) -> Column:
    """The last ten digits without extension and country; shorter ones from six digits on as they are; null if they say nothing."""
    text = F.regexp_replace(F.lower(phone), r"(?:ext|x)[. ]*\d+.*$", "")
    digits = F.regexp_replace(text, r"\D", "")
    digits = F.when(F.length(digits) > 10, F.right(digits, F.lit(10))).otherwise(digits)
    return F.when((F.length(digits) >= 6) & ~digits.rlike(r"^(\d)\1*$"), digits)


def shared_values(rows: DataFrame) -> DataFrame:
    """kind, value: the values of ``VALUES`` that at least four names hold, none of them more than half of the time.

    Counted by value and name first, so a value that a third of all rows hold is combined before it moves.
    """
    cells = F.array(*[F.struct(F.lit(v).alias("kind"), F.col(v).alias("value")) for v in VALUES])
    held = rows.where("canon is not null").select("canon", F.explode(cells).alias("c")).select("canon", "c.kind", "c.value").where("value is not null")
    by_name = held.groupBy("kind", "value", "canon").agg(F.count(F.lit(1)).alias("n"))
    return by_name.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("names"), F.max("n").alias("most"), F.sum("n").alias("all")).where("names >= 4 and 2 * most <= all").select("kind", "value")


def features(rows: DataFrame) -> DataFrame:
    """id, source_system, canon, word, turns, sector, address, domain, domain_fits (a word of the name is in it),
    phone, place, and for each of ``VALUES`` whether it is shared, of counting rows."""
    rows = materialize(rows, "unresolved")  # read three times
    parsed = materialize(parse_names(rows, "source_customer_id", "company_name"), "parsed")
    names = respelled(parsed)
    words = materialize(word_counts(names), "words")
    canon = canonical_words(words)
    local, domain = email_parts(F.col("email"))
    base = rows.select(F.col("source_customer_id").alias("id"), "source_system", F.concat_ws("@", local, domain).alias("address"), domain.alias("domain"), phone_digits(F.col("phone")).alias("phone"))
    base = base.withColumn("address", F.when(F.col("domain").isNotNull(), F.col("address")))
    named = names.join(canon, "word").select("id", "word", "canon", "sector", "turns")
    at = locations(rows).select("id", F.concat_ws("|", "number", "street", "kind", "point", "town").alias("place"))
    letters = F.regexp_replace(F.substring_index("domain", ".", 1), "[^a-z]", "")
    inside = F.exists("turns", lambda t: (F.levenshtein(letters, t) <= 3) | letters.contains(F.right(t, F.lit(8))) | letters.contains(F.left(t, F.lit(8))))
    joined = base.join(named, "id", "left").join(at, "id", "left").withColumn("domain_fits", F.coalesce(inside, F.lit(False)))
    plain = materialize(joined, "features")
    shared = materialize(shared_values(plain), "shared")
    out = plain
    for v in VALUES:  # a hot value is in one row of the right side, so the skewed left side can be split at will
        of_kind = shared.where(F.col("kind") == v).select(F.col("value").alias(v), F.lit(True).alias(f"{v}_shared"))
        out = out.join(of_kind, v, "left").withColumn(f"{v}_shared", F.coalesce(f"{v}_shared", F.lit(False)))
    out = materialize(out, "linkage")
    for used in (rows, parsed, names, words, plain, shared):
        discard(used)
    return out


def candidates(f: DataFrame, across: str = "source_system") -> DataFrame:
    """left, right (smaller id left) of records of different sources that share a block in any pass.

    The phone pass takes equal numbers; a local number that is the end of a full one is compared where another pass
    brings the records together, as it says too little to do so alone.
    """
    block = lambda kind, v: F.when(F.col(v).isNotNull() & ~F.col(f"{v}_shared"), F.concat(F.lit(kind), v))
    keys = F.array_compact(F.array(F.concat(F.lit("n:"), "canon"), block("e:", "address"), block("d:", "domain"), block("p:", "phone"), block("a:", "place")))
    rows = f.select("id", across, F.explode(keys).alias("key"))
    blocks = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    rows = rows.join(blocks, "key", "left_semi")
    left = rows.select("key", F.col("id").alias("left"), F.col(across).alias("l_source"))
    right = rows.select("key", F.col("id").alias("right"), F.col(across).alias("r_source"))
    return left.join(right, "key").where("left < right and l_source <> r_source").select("left", "right").distinct()


def _sides(f: DataFrame, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """The features of a pair's left and right record, with l_ and r_ before their names; ids as left and right."""
    take = lambda s, name: f.select(*keep, F.col("id").alias(name), *[F.col(c).alias(s + c) for c in f.columns if c not in ("id", *keep)])
    return take("l_", "left"), take("r_", "right")


def levels() -> list[Column]:
    """The agreement level of each field of a pair of l_ and r_ features; 0 where a side is missing."""
    both = lambda c: F.col(f"l_{c}").isNotNull() & F.col(f"r_{c}").isNotNull()
    same = lambda c: F.col(f"l_{c}") == F.col(f"r_{c}")
    no_sector = (F.col("l_sector") == "") | (F.col("r_sector") == "")
    fits = same("sector") | no_sector
    far = F.floor(F.greatest(F.length("l_word"), F.length("r_word")) / 5).cast("int")
    apart = F.array_min(F.transform("l_turns", lambda t: F.levenshtein(t, F.col("r_word"))))
    name = F.when(~both("canon"), 0).when(same("canon"), F.when(same("sector") & ~no_sector, 1).when(no_sector, 2).otherwise(3))
    name = name.when(fits & (apart <= 2), 4).when(fits & (apart <= far), 5).otherwise(6)
    host_shared = F.col("l_domain_shared") | F.col("r_domain_shared")
    email = F.when(~both("address") | F.col("l_address_shared") | F.col("r_address_shared"), 0).when(same("address"), 1)
    email = email.when(same("domain"), F.when(host_shared, F.when(F.col("l_domain_fits") & F.col("r_domain_fits"), 3).otherwise(5)).otherwise(2)).when(~host_shared & (F.levenshtein("l_domain", "r_domain", 3) >= 0), 4).otherwise(5)
    a, b = F.col("l_phone"), F.col("r_phone")
    shorter = F.length(a) < F.length(b)
    short, long = F.when(shorter, a).otherwise(b), F.when(shorter, b).otherwise(a)
    phone = F.when(~both("phone"), 0).when(same("phone"), F.when(F.col("l_phone_shared"), 4).otherwise(1)).when((F.length(short) < 10) & (F.endswith(long, short) | F.startswith(long, short)), 2).otherwise(3)
    place = F.when(~both("place"), 0).when(same("place"), F.when(F.col("l_place_shared"), 3).otherwise(1)).otherwise(2)
    return [c.alias(n) for c, n in zip((name, email, phone, place), FIELDS)]


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 200, fields=FIELDS, start=START) -> tuple[float, dict, dict]:
    """Expectation-maximisation over (levels, count): prior, and (match, non-match) chance of each level and field."""
    prior = 0.5
    m = {f: {k: v[0] for k, v in start[f].items()} for f in fields}
    u = {f: {k: v[1] for k, v in start[f].items()} for f in fields}
    total = sum(n for _, n in patterns)
    if not total:
        return prior, m, u
    for _ in range(rounds):
        ms = {f: dict.fromkeys(start[f], 0.5) for f in fields}
        us = {f: dict.fromkeys(start[f], 0.5) for f in fields}
        matched = 0.0
        for p, n in patterns:
            g = posterior(p, prior, m, u, fields)
            matched += g * n
            for f, level in zip(fields, p):
                if level:
                    ms[f][level] += g * n
                    us[f][level] += (1 - g) * n
        before, prior = prior, min(max(matched / total, 1e-4), 1 - 1e-4)
        m = {f: {k: v / sum(ms[f].values()) for k, v in ms[f].items()} for f in fields}
        u = {f: {k: v / sum(us[f].values()) for k, v in us[f].items()} for f in fields}
        if abs(prior - before) < 1e-7:
            break
    return prior, m, u


def prior_of(patterns: list[tuple[tuple[int, ...], int]], m: dict, u: dict, start: float = 0.9, rounds: int = 50, fields=FIELDS) -> float:
    """The share of matches among (levels, count), by the same expectation step with the chances held fixed."""
    prior, total = start, sum(n for _, n in patterns)
    for _ in range(rounds if total else 0):
        prior = min(max(sum(posterior(p, prior, m, u, fields) * n for p, n in patterns) / total, 1e-4), 1 - 1e-4)
    return prior


def posterior(p: tuple[int, ...], prior: float, m: dict, u: dict, fields=FIELDS) -> float:
    odds = math.log(prior / (1 - prior)) + sum(math.log(m[f][x] / u[f][x]) for f, x in zip(fields, p) if x)
    return 1 / (1 + math.exp(-max(min(odds, 500), -500)))


def _patterns(compared: DataFrame) -> list[tuple[tuple[int, ...], int]]:
    """How often each combination of levels occurs: at most 7 * 6 * 5 * 4 rows, whatever the data."""
    return [(tuple(r[x] for x in FIELDS), r["n"]) for r in compared.groupBy(*FIELDS).agg(F.count(F.lit(1)).alias("n")).collect()]


def _with_confidence(compared: DataFrame, patterns: list[tuple[tuple[int, ...], int]], prior: float, m: dict, u: dict) -> DataFrame:
    table = [(*p, posterior(p, prior, m, u)) for p, _ in patterns]
    chances = compared.sparkSession.createDataFrame(table, ", ".join(f"{x} int" for x in FIELDS) + ", confidence double")
    return compared.join(F.broadcast(chances), list(FIELDS))  # as many rows as patterns


def unresolved(records: DataFrame, identity_map: DataFrame, predictions: DataFrame) -> DataFrame:
    """The counting rows of records that neither an earlier cluster nor a prediction names."""
    ids = identity_map.select(record_id(F.col("source_customer_id")).alias("source_customer_id"))
    both = F.explode(F.array(record_id(F.col("left_source_customer_id")), record_id(F.col("right_source_customer_id"))))
    known = ids.unionByName(predictions.select(both.alias("source_customer_id"))).distinct()
    needed = ["source_customer_id", "source_system", "company_name", "email", "phone", "address_line_1", "city", "postal_code", "address", "last_modified_timestamp", "standardized_at"]
    fresh = records.select(*needed).where("source_customer_id is not null and source_system is not null").join(known, "source_customer_id", "left_anti")
    return counting_rows(fresh)


def linked(rows: DataFrame, sure: float = 0.9, accept: float = 0.5) -> DataFrame:
    """left, right, confidence of the pairs of different sources that are the same customer.

    Candidate pairs with a posterior of ``sure`` or more link. Records that hang together by links are candidates too,
    whether or not they share a block: all pairs of a group are compared, their prior is estimated over the pairs of all
    groups, and a pair comes out if its own posterior is at least ``accept``. So nothing is implied by a chain alone.
    """
    f = features(rows)
    left, right = _sides(f)
    compared = materialize(candidates(f).join(left, "left").join(right, "right").select("left", "right", *levels()), "levels")
    patterns = _patterns(compared)
    _, m, u = model = estimate(patterns)
    sure_pairs = _with_confidence(compared, patterns, *model).where(F.col("confidence") >= sure)
    groups = connected_groups(sure_pairs.select(F.col("left").alias("lo"), F.col("right").alias("hi")))
    discard(compared)
    left, right = _sides(groups.join(f, "id"), ("group_id",))
    inside = left.join(right, "group_id").where("left < right and l_source_system <> r_source_system")
    inside = materialize(inside.select("left", "right", *levels()), "inside")
    patterns = _patterns(inside)
    out = _with_confidence(inside, patterns, prior_of(patterns, m, u), m, u)
    return out.where(F.col("confidence") >= accept).select("left", "right", "confidence")


def same_customers(records: DataFrame, identity_map: DataFrame, predictions: DataFrame) -> DataFrame:
    """left_source_customer_id, right_source_customer_id, confidence; smaller id left.

    Only records that no earlier run resolved, by their latest row, and pairs of different sources. Nulls, blanks and
    stand-ins are missing, which is neither agreement nor disagreement; a record with nothing in common with another, or
    without any field, is in no pair; a null id or source is left out. Empty in, empty out; other columns are ignored.
    """
    out = linked(unresolved(records, identity_map, predictions))
    return out.withColumnsRenamed({"left": "left_source_customer_id", "right": "right_source_customer_id"})
