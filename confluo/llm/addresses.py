"""Records at the same location, by address rewrites mined from the addresses themselves.

An address is read into house number (or post office box), street, kind of street, compass point, town and postal code;
suite, unit, floor and addressee are dropped. Then rewrites are mined: two spellings of a street are a rewrite if they are
close and occur with the same number in the same town, two spellings of a town if they occur with the same number and
street; the rarer spelling goes to the commoner one if so many agreements are significant: the chance that two streets (or
towns) are close although they are different ones is measured on pairs drawn from all addresses, and the tests of all
spellings together keep a false discovery rate. Addresses are normalised anew with the rewrites and mined again, until no
new rewrite appears. Locations are then equal keys; kind and compass point, which many leave out, separate two locations
where both are given and differ.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import discard, materialize
from .survivors import STAND_INS, counting_rows

#: Words of postal addresses.
_KINDS = "street str st strasse, road rd, avenue ave av, drive dr, lane ln, court crt ct, parkway pkwy pky, terrace terr ter, boulevard blvd boul, place pl platz, weg wg, allee al"
KINDS = {form: forms.split()[0] for forms in _KINDS.split(", ") for form in forms.split()}
TYPES = frozenset(KINDS)
COMPASS = {form: forms.split()[0] for forms in "n north no, s south so, e east, w west, ne northeast, nw northwest, se southeast, sw southwest".split(", ") for form in forms.split()}
POINTS = frozenset(COMPASS) - {"no"}
STATES = (
    "alabama alaska arizona arkansas california colorado connecticut delaware florida georgia hawaii idaho illinois indiana iowa kansas kentucky louisiana maine maryland "
    "massachusetts michigan minnesota mississippi missouri montana nebraska nevada ohio oklahoma oregon pennsylvania tennessee texas utah vermont virginia washington wisconsin wyoming"
).split()
STATE_PAIRS = ("north dakota", "south dakota", "north carolina", "south carolina", "west virginia", "new hampshire", "new jersey", "new mexico", "new york", "rhode island")
CODES = frozenset("al ak az ar ca co de fl ga hi id il in ia ks ky la me md ma mi mn ms mo mt ne nv nh nj nm ny nc nd oh ok or pa ri sc sd tn tx ut vt va wa wv wi wy us usa".split())
_COUNTRY = regex.compile(r"\b(?:u\.\s?s\.\s?a\.?|united states(?: of america)?|deutschland|germany)(?!\w)")
_STATE = regex.compile(r"\b(?:" + "|".join((*STATE_PAIRS, *STATES)) + r")\b")
_ADDRESSEE = regex.compile(r"\b(?:c/o|attn:?|attention:?|z\. ?hd\.)\s[^,;/\d]*[,;/]?")
_UNIT = regex.compile(r"\b(?:suite|ste|unit|apartment|apt|floor|flr|room|rm)\b\.?\s*#?\s*\d+[a-z]?\b|#\s+\d+[a-z]?\b|\bbldg\.?\s*[a-z0-9]{1,3}\b,?|\brear entrance\b,?")
_BOX = regex.compile(r"\b(?:p\.?\s*o\.?\s*b(?:ox|\b\.?)|post office box|postfach|box)\s*#?\s*(\d+)")
_ZIP = regex.compile(r"\bd-? ?(\d{5})\b|\b(\d{5})(?:-\d{4})?\b(?!-)")
_WORD = regex.compile(r"[a-z0-9]+")
_GERMAN = regex.compile(r"^([a-z]{4,}?)(strasse|str|weg|wg|platz|pl|allee|al)$")
_TOWN_HEADS = {"st": "saint", "mt": "mount", "ft": "fort", "pt": "port", **{w: w for w in "saint mount fort port lake new north south east west bad sankt".split()}}


def fold(text: str) -> str:
    """Lower case without marks; ae, oe, ue as a, o, u; digits that stand in words as the letters they look like."""
    text = unicodedata.normalize("NFKD", text.lower().replace("ß", "ss"))
    text = "".join(c for c in text if not unicodedata.combining(c))
    text = regex.sub(r"(?<=[a-z])0|0(?=[a-z]{2})", "o", text)
    text = regex.sub(r"(?<=[a-z])1(?=[a-z])", "l", text)
    return regex.sub(r"\s+", " ", regex.sub(r"([aou])e(?=[a-z])", r"\1", text)).strip()


def says(value: str | None) -> bool:
    return value is not None and value.strip() != "" and value.strip().lower() not in STAND_INS


class Street(str):
    """A street's own name as one word, with its kind and compass point, None where they aren't given."""

    kind: str | None = None
    point: str | None = None


def _street(words: list[str], around: list[str] = ()) -> Street:
    """The street of its words; a compass point may also stand in the words around it."""
    own = [w for w in words if w not in POINTS]
    kept = [w for i, w in enumerate(own) if w not in TYPES or (i == 0 and len(own) > 1 and own[1] not in TYPES)]
    base = "".join(kept or own)
    m = _GERMAN.match(base) if len(kept) == len(own) else None
    out = Street(m.group(1) if m else base)
    out.kind = KINDS[m.group(2)] if m else next((KINDS[w] for w in reversed(own) if w in TYPES and w not in kept), None)
    out.point = next((COMPASS[w] for w in (*words, *around) if w in POINTS), None)
    return out


def _town(words: list[str]) -> str:
    words = [w for w in words if not w.isdigit()]
    if len(words) > 1:
        words[0] = _TOWN_HEADS.get(words[0], words[0])
    return " ".join(words)


def _town_at_end(words: list[str]) -> int:
    """Where the town begins in words that end with it."""
    return len(words) - (2 if len(words) > 2 and words[-2] in _TOWN_HEADS and words[-2] not in POINTS | TYPES else 1)


def _line(text: str, given: bool) -> tuple[str | None, Street, list[str]]:
    """number, street and the words around them of a text without code, state and country; ``given``: no town in it."""
    parts = [_WORD.findall(p) for p in regex.split(r"[,;/|]+", text)]
    parts = [p for p in parts if p]
    number, street, rest, last = None, Street(), [], []
    for p in parts:
        at = None if number else next((i for i, w in enumerate(p) if regex.fullmatch(r"\d+[a-z]?", w)), None)
        if at is None:
            if not street and number is None and any(w in TYPES for w in p):
                street = _street(p)
            else:
                rest, last = rest + last, p
            continue
        number = regex.match(r"0*(\d+)", p[at]).group(1)
        before, after = [w for w in p[:at] if w not in ("no", "nr")], p[at + 1 :]
        if street and (not before or all(w in POINTS for w in before)):  # the street came in the part before
            rest += after
        elif before and not all(w in POINTS for w in before):  # number behind the street
            own = len(before)
            if before[-1] in TYPES and own > 2:
                own = 2
            elif own > 1 and _GERMAN.match(before[-1]) and before[0] not in POINTS:
                own = 1
            own = own if not given else len(before)
            street, rest = _street(before[len(before) - own :]), rest + before[: len(before) - own] + after
        elif not after and last:  # "birchbrook, 493"
            street, last = _street(last), []
        else:
            end = next((i for i, w in enumerate(after) if w in TYPES and i), None)
            if end is not None:
                while end + 1 < len(after) and after[end + 1] in POINTS:
                    end += 1
                end += 1
            else:
                end = len(after) if given or len(parts) > 1 or len(after) < 2 else _town_at_end(after)
            street, rest = _street(after[:end], before), rest + after[end:]
    return number, street, rest + last


def parse(line: str | None, town: str | None, code: str | None, whole: str | None) -> tuple[str | None, ...]:
    """number, street, kind, point, town, code of the parts, or of the whole text where there is no line."""
    zip_ = None
    if says(code) and (m := regex.search(r"\d{5}", code)):
        zip_ = m.group()
    place = _town(_WORD.findall(fold(town))) if says(town) else ""
    if says(line):
        text, given = fold(line), True
    elif says(whole):
        text, given = fold(whole), False
    else:
        return (None,) * 6
    text = _UNIT.sub(" ", _ADDRESSEE.sub(" ", text))
    box = _BOX.search(text)
    if box:
        text = text[: box.start()] + " , " + text[box.end() :]
    if not given:
        text = _STATE.sub(" ", _COUNTRY.sub(" ", text))
        found = list(_ZIP.finditer(text))
        if found:
            m = next((m for m in found if m.group(1)), found[-1])
            zip_ = zip_ or m.group(1) or m.group(2)
            before, after = text[: m.start()], text[m.end() :]
            if town_first := regex.match(r"\s+([a-z]+)(?=\s|$)", after):  # "39826 town", of which the street may follow
                after = f" {town_first.group(1)} | {after[town_first.end():]}"
            text = f"{before} | {after}"
        text = " ".join(w for w in regex.split(r"(?<=[\s,;/|])|(?=[\s,;/|])", text) if w.strip() and w not in CODES)
    number, street, rest = _line(text, given)
    if box:
        number, street = box.group(1).lstrip("0"), Street("@box")
        rest = [] if given else [w for p in regex.split(r"[,;/|]+", text) for w in _WORD.findall(p)]
    return number, str(street) or None, street.kind, street.point, place or ("" if given else _town(rest)) or None, zip_


COLUMNS = ("number", "street", "kind", "point", "town", "zip")
PARSED = "id string, " + ", ".join(f"{c} string" for c in COLUMNS)


def parse_addresses(records: DataFrame) -> DataFrame:
    """id, number, street, kind, point, town, zip of records (source_customer_id, address_line_1, city, postal_code, address)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            parsed = [parse(*row) for row in zip(*columns[1:])]
            cells = [pa.array(c, type=pa.string()) for c in (zip(*parsed) if parsed else ((),) * len(COLUMNS))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cells], names=["id", *COLUMNS])

    return records.select("source_customer_id", "address_line_1", "city", "postal_code", "address").mapInArrow(run, PARSED)


def _places(parsed: DataFrame) -> DataFrame:
    """Complete towns by their codes: the usual town of a code fills a missing town and replaces a close spelling.

    The usual town of the code's first three digits, of which an area may hold several, stands in only for a close
    spelling, and fills a missing town only where the code is unseen and all towns of the area are spellings of it.
    """
    near = lambda a, b: F.levenshtein(a, b) <= F.greatest(F.lit(2), F.floor(F.length(a) / 5))
    known = parsed.where("town is not null and zip is not null").groupBy("zip", "town").agg(F.count(F.lit(1)).alias("n"))
    usual = known.groupBy("zip").agg(F.max(F.struct("n", "town")).alias("u")).select("zip", F.col("u.town").alias("zip_town"), F.col("u.n").alias("zip_n"))
    towns = known.groupBy(F.substring("zip", 1, 3).alias("area"), "town").agg(F.sum("n").alias("n"))
    area = towns.groupBy("area").agg(F.max(F.struct("n", "town"))["town"].alias("area_town"))
    area = towns.join(area, "area").groupBy("area", "area_town").agg(F.every(near("town", "area_town")).alias("lone"))
    rows = parsed.withColumn("area", F.substring("zip", 1, 3)).join(usual, "zip", "left").join(area, "area", "left")
    # a code's only mention of a town may be misspelt
    of_zip = F.when((F.col("zip_n") == 1) & near("zip_town", "area_town"), F.col("area_town")).otherwise(F.col("zip_town"))
    rows = rows.withColumn("zip_town", of_zip)
    fill = F.coalesce("zip_town", F.when(F.col("lone"), F.col("area_town")))
    town = F.when(F.col("town").isNull(), fill).when(near("town", "zip_town"), F.col("zip_town")).when(near("town", "area_town"), F.col("area_town")).otherwise(F.col("town"))
    rows = rows.withColumn("town", town)
    return rows.select("id", "number", "street", "kind", "point", "town")


def _meetings(values: DataFrame, field: str, among: list[str], other: DataFrame, limit: int) -> DataFrame:
    """Pairs of a row of ``values`` and a row of ``other`` that agree in ``among`` and differ in ``field``, with ``close``: their edits,
    if at most ``limit`` and a fifth of the letters (two always), else null."""
    a, b = values.alias("a"), other.alias("b")
    pairs = a.join(b, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in among]).where(F.col(f"a.{field}") != F.col(f"b.{field}"))
    edits = F.levenshtein(f"a.{field}", f"b.{field}", limit)
    close = (F.length(f"a.{field}") >= 5) & (edits >= 0) & (edits <= F.greatest(F.lit(2), F.floor(F.length(f"a.{field}") / 5)))
    return pairs.withColumn("close", F.when(close, edits))


def _chance(values: DataFrame, field: str, limit: int) -> float:
    """How often two different spellings are close by chance: among as many pairs of rows drawn by hash as there are rows."""
    n = max(values.count(), 1)
    drawn = lambda salt: values.select(field, F.pmod(F.xxhash64("number", "street", "town", F.lit(salt)), F.lit(n)).alias("draw"))
    met = _meetings(drawn("a"), field, ["draw"], drawn("b"), limit).agg(F.count(F.lit(1)).alias("n"), F.count("close").alias("k")).first()
    return (met["k"] + 0.5) / (met["n"] + 1)


def _significant(tests: DataFrame, m: int, rate: float) -> DataFrame:
    """The rows whose ``p`` passes the step-up test of m hypotheses at the false discovery rate, by a histogram of at most 3,001 steps."""
    step = F.floor(F.least(-F.log10(F.greatest("p", F.lit(1e-300))), F.lit(300.0)) * 10).cast("int")
    tests = tests.withColumn("step", step)
    passed, bound = 0, None
    for row in sorted(tests.groupBy("step").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r["step"]):
        passed += row["n"]
        if 10 ** (-row["step"] / 10) <= rate * passed / max(m, 1):
            bound = row["step"]
    return tests.where(F.lit(False) if bound is None else F.col("step") >= bound).drop("step")


def _rewrites(values: DataFrame, field: str, within: list[str], agree: list[str], limit: int, chance: float, rate: float) -> DataFrame:
    """within, old, new: rewrites of ``field`` among rows that agree in ``within`` and ``agree``.

    values: number, street, town, n, distinct. A spelling that meets others can be a rewrite of one at least twice as
    common that it is close to; its agreements are tested against the closeness of unrelated spellings (bound of the
    Poisson tail for as many meetings). Nearest first, then the commonest.
    """
    totals = values.groupBy(*within, field).agg(F.sum("n").alias("total"))
    cell = values.groupBy(*within, *agree).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = values.join(cell, [*within, *agree]).groupBy(*within, F.col(field).alias("old")).agg(F.sum(F.col("size") - 1).alias("met"))
    met = materialize(met, "meetings")
    close = _meetings(values, field, [*within, *agree], values, limit).where("close is not null")
    seen = close.groupBy(*[F.col(f"a.{c}").alias(c) for c in within], F.col(f"a.{field}").alias("old"), F.col(f"b.{field}").alias("new")).agg(F.count(F.lit(1)).alias("seen"), F.min("close").alias("edits"))
    seen = seen.join(totals.withColumnRenamed(field, "old").withColumnRenamed("total", "n_old"), [*within, "old"]).join(totals.withColumnRenamed(field, "new").withColumnRenamed("total", "n_new"), [*within, "new"])
    mean = F.col("met") * F.lit(chance)
    seen = seen.where("n_new >= 2 * n_old").join(met, [*within, "old"]).withColumn("p", F.least(F.lit(1.0), F.exp(F.col("seen") * F.log(mean) - F.expr("ln(factorial(least(seen, 20)))"))))
    kept = _significant(seen, met.count(), rate)
    best = F.min(F.struct("edits", (-F.col("n_new")).alias("m"), "new"))["new"].alias("new")
    return kept.groupBy(*within, "old").agg(best)


def _separated(rows: DataFrame, part: str) -> DataFrame:
    """rows with ``part`` (kind or point) filled from the commonest given one of the same number, street and town, '' if none is given."""
    key = ["number", "street", "town"]
    given = rows.where(F.col(part).isNotNull()).groupBy(*key, part).agg(F.count(F.lit(1)).alias("n"))
    usual = given.groupBy(*key).agg(F.max(F.struct("n", part))[part].alias("usual"))
    return rows.join(usual, key, "left").withColumn(part, F.coalesce(part, "usual", F.lit(""))).drop("usual")


def locations(records: DataFrame, rate: float = 0.05, max_rounds: int = 40) -> DataFrame:
    """id, number, street, kind, point, town of the records that have a number, a street and a town, after all rewrites."""
    parsed = materialize(parse_addresses(records), "addresses")
    rows = materialize(_places(parsed.where("number is not null and street is not null")).where("town is not null and street <> ''"), "places")
    discard(parsed)
    chances = None
    for _ in range(max_rounds):
        # a box number says nothing about towns: boxes take the towns' rewrites, and give none
        values = materialize(rows.where("street <> '@box'").groupBy("number", "street", "town").agg(F.count(F.lit(1)).alias("n")), "values")
        chances = chances or (_chance(values, "street", 3), _chance(values, "town", 2))
        streets = materialize(_rewrites(values, "street", ["town"], ["number"], 3, chances[0], rate), "street-rewrites")
        towns = materialize(_rewrites(values, "town", [], ["number", "street"], 2, chances[1], rate), "town-rewrites")
        discard(values)
        if streets.isEmpty() and towns.isEmpty():
            break
        to_street = streets.select("town", F.col("old").alias("street"), F.col("new").alias("new_street"))
        to_town = towns.select(F.col("old").alias("town"), F.col("new").alias("new_town"))
        new = rows.join(to_street, ["town", "street"], "left").join(to_town, "town", "left")
        new = materialize(new.select("id", "number", F.coalesce("new_street", "street").alias("street"), "kind", "point", F.coalesce("new_town", "town").alias("town")), "places")
        for used in (rows, streets, towns):
            discard(used)
        rows = new
    else:
        raise RuntimeError("address rewrites did not settle")
    return _separated(_separated(rows, "kind"), "point")


PLACE = ["number", "street", "kind", "point", "town"]


def _record_places(records: DataFrame) -> DataFrame:
    needed = ["source_customer_id", "address_line_1", "city", "postal_code", "address", "last_modified_timestamp", "standardized_at"]
    return locations(counting_rows(records.select(*needed).where("source_customer_id is not null")))


def places(records: DataFrame) -> DataFrame:
    """source_customer_id, place_id (the least id at the location) of the records with an address; same rules as ``same_location``.

    One row per record, however many share a location.
    """
    at = materialize(_record_places(records), "at")
    least = at.groupBy(*PLACE).agg(F.min("id").alias("place_id"))
    return at.join(least, PLACE).select(F.col("id").alias("source_customer_id"), "place_id")


def same_location(records: DataFrame) -> DataFrame:
    """left_source_customer_id, right_source_customer_id of records at the same location, smaller id left.

    Each record counts by its latest row; a record whose address is null, blank, a stand-in, or lacks number, street or
    town (and a code that tells it) is in no pair. Repeated rows are one record. Every pair of a location is a row.
    """
    at = materialize(_record_places(records), "at")
    left = at.select(*PLACE, F.col("id").alias("left_source_customer_id"))
    right = at.select(*PLACE, F.col("id").alias("right_source_customer_id"))
    pairs = left.join(right, PLACE).where("left_source_customer_id < right_source_customer_id")
    return pairs.select("left_source_customer_id", "right_source_customer_id")
