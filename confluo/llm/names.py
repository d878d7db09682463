"""Variant spellings of organisation names, by trie joins.

A name is read into its own words and a line of business; legal forms, remarks, given names and order are set aside.
Single words that many organisations share are told from their misspellings first (``token_rewrites``). Then the own
words joined are the string that is compared, in every order: split, joined and swapped words are the same. Strings are cut into one segment more than edits are allowed, so one segment is untouched, and sharded by
the segments, which the other side looks up at all places they can have moved to; in a shard one side is held as
tries of what stands before and behind the segment, and the other side's strings traverse them with a Levenshtein
automaton, so all neighbours within the bound are enumerated without comparing pairs.
"""

from __future__ import annotations

import itertools
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.history import latest_by
from ..runtime import discard, materialize
from .addresses import says
from .survivors import counting_rows

#: Words that don't tell one organisation from another.
LEGAL = frozenset("llc inc incorporated co company corp corporation ltd limited gmbh mbh ag kg plc sa llp lp the dba fa of and hq old dup main acct do not use".split())
SECTORS = (
    "academy analytics clinics consulting consultants energy engineering foods furniture holdings hotels insurance international laboratories "
    "logistics manufacturing media packaging pharmacy properties robotics services software systems technologies textiles transport"
).split()
SHORT_FORMS = {
    "sw": "software", "nrg": "energy", "pkg": "packaging", "mfg": "manufacturing", "intl": "international", "props": "properties", "hldgs": "holdings", "mdia": "media", "engrg": "engineering",
    "trnsp": "transport", "labs": "laboratories", "fds": "foods", "htls": "hotels", "svc": "services", "svcs": "services", "acdmy": "academy", "anlytcs": "analytics", "enrgy": "energy", "cnsltg": "consulting",
    "clncs": "clinics", "rbtcs": "robotics", "lgstcs": "logistics", "systms": "systems", "techs": "technologies", "txtls": "textiles", "pharmcy": "pharmacy", "insur": "insurance", "consultants": "consulting", "technology": "technologies", "property": "properties", "laboratory": "laboratories",
}
GIVEN = frozenset(
    "theodore theo ted teddy william will wm bill billy susanna susan susie sue katherine kate kathy kathryn nicholas nick klaus nicolas benjamin ben benny margaret meg maggie peg peggy greta "
    "robert rob bob bobby robt dorothea dora dorothy dot michael mike mick michel elizabeth liz beth lisa eliza richard rick dick rich ricky francisco paco pancho frank francis "
    "josephine jo josie josefine thea catherine zuzana betty fco alexander alex aleksander alec sasha sandy johannes johan joh hans john jan".split()
)
_REMARK = regex.compile(r"\[[^\]]*\]|\((?:old|do not use|dup\??|hq)\)|/ ?main acct|- ?hq\b|\bdo not use\b")
SHARD_ROWS = 20_000


def edits(a: str, b: str, most: int) -> int:
    """Edits with swaps of neighbours, or more than ``most``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            d = min(row[j] + 1, now[j - 1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            now.append(d)
        if min(now) > most:
            return most + 1
        before, row = row, now
    return row[-1]


def swapped(a: str, b: str) -> bool:
    """Whether the two differ by one swap of neighbours."""
    if len(a) != len(b):
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :] and i + 1 < len(a)


def _skeleton(word: str) -> str:
    return word[0] + regex.sub(r"[aeiouy]", "", word[1:])


_SKELETONS = {_skeleton(s): s for s in SECTORS}
_sector_memo: dict[str, str] = {}


def sector_of(word: str) -> str:
    """The line of business a word names, in full, shortened or misspelt; empty if none."""
    if word in _sector_memo:
        return _sector_memo[word]
    found = word if word in SECTORS else SHORT_FORMS.get(word, "")
    if not found and len(word) >= 3:
        found = next((s for s in SECTORS if s.startswith(word)), "")
    if not found and len(word) >= 3:
        bones = _skeleton(word)
        found = _SKELETONS.get(bones, "") if len(bones) >= 3 else ""
        if not found and len(bones) >= 3 and bones[-1] == "s":
            found = next((s for k, s in _SKELETONS.items() if k + "s" == bones or k == bones[:-1]), "")
    if not found and len(word) >= 4:
        like = [s for s in SECTORS if abs(len(s) - len(word)) <= 2 and (s[:2] == word[:2] or s[-3:] == word[-3:] or s[1:4] == word[1:4])]
        found = next((s for s in like if edits(word, s, 2 if len(word) >= 7 else 1) <= (2 if len(word) >= 7 else 1)), "")
    found = SHORT_FORMS.get(found, found)
    if len(_sector_memo) > 300_000:
        _sector_memo.clear()
    _sector_memo[word] = found
    return found


def parse_name(name: str | None) -> tuple[tuple[str, ...], str] | None:
    """Own words and line of business; None where the name says nothing."""
    if not says(name):
        return None
    text = unicodedata.normalize("NFKD", name.lower().replace("ß", "ss"))
    text = "".join(c for c in text if not unicodedata.combining(c))
    text = _REMARK.sub(" ", text)
    text = regex.sub(r"(?<=[a-z])0|0(?=[a-z]{2})", "o", text)
    text = regex.sub(r"(?<=[a-z])1|1(?=[a-z]{2})", "l", text)
    text = regex.sub(r"\b((?:\w\.){2,})", lambda m: m.group().replace(".", ""), text)
    words = [w for w in regex.findall(r"[a-z0-9]+", text) if w not in LEGAL and len(w) > 1]
    sector, own = "", []
    for w in words:
        kind = "" if w in GIVEN else sector_of(w)
        if kind and not sector:
            sector = kind
        elif not kind:
            own.append(w)
    names = [w for w in own if w not in GIVEN]
    own = names or own
    if not own:
        own, sector = ([sector], "") if sector else ([], "")
    return (tuple(own), sector) if own else None


def orders(own: Column) -> Column:
    """The own words joined in every order; of more than four words (120 orders and more) in every rotation."""
    joined = lambda *parts: F.concat(*[F.get(own, F.lit(i - 1)) for i in parts])
    turns = F.transform(F.sequence(F.lit(1), F.size(own)), lambda i: F.concat(F.array_join(F.slice(own, i, F.size(own)), ""), F.array_join(F.slice(own, 1, i - 1), "")))
    every = lambda n: F.array(*[joined(*p) for p in itertools.permutations(range(1, n + 1))])
    return F.array_distinct(F.when(F.size(own) == 3, every(3)).when(F.size(own) == 4, every(4)).otherwise(turns))


def parse_names(df: DataFrame, id_column: str, name_column: str) -> DataFrame:
    """id, name (own words with blanks between), sector; rows whose name says nothing are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, p) for i, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if (p := parse_name(n))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in rows], pa.string()), pa.array([" ".join(p[0]) for _, p in rows], pa.string()), pa.array([p[1] for _, p in rows], pa.string())],
                names=["id", "name", "sector"],
            )

    return df.select(F.col(id_column).cast("string"), name_column).mapInArrow(run, "id string, name string, sector string")


def build_trie(words: list[str]) -> dict:
    root: dict = {}
    for w in words:
        node = root
        for c in w:
            node = node.setdefault(c, {})
        node[""] = w
    return root


def within(trie: dict, query: str, most: int) -> list[tuple[str, int]]:
    """All words of the trie within ``most`` (0 to 2) edits of ``query``, by one traversal.

    The Levenshtein automaton's states are bits: bit i of the d-th number says that the path so far can be the query's
    first i letters with d edits. A branch is left when no bit is set.
    """
    n = len(query)
    full, goal = (1 << (n + 1)) - 1, 1 << n
    at: dict[str, int] = {}
    for i, c in enumerate(query):
        at[c] = at.get(c, 0) | (1 << i)
    one, two = (3 if most > 0 else 0) & full, (7 if most > 1 else 0) & full
    out: list[tuple[str, int]] = []
    stack = [(trie, 1, one, two)]
    same = at.get
    while stack:
        node, r0, r1, r2 = stack.pop()
        for c, child in node.items():
            if not c:
                if (r0 | r1 | r2) & goal:
                    out.append((child, 0 if r0 & goal else 1 if r1 & goal else 2))
                continue
            m = same(c, 0)
            n0 = (r0 & m) << 1
            n1 = (((r1 & m) << 1) | r0 | (r0 << 1) | (n0 << 1)) & full if most > 0 else 0
            n2 = (((r2 & m) << 1) | r1 | (r1 << 1) | (n1 << 1)) & full if most > 1 else 0
            if n0 | n1 | n2:
                stack.append((child, n0, n1, n2))
    return out


def _segment_shards(word: str, k: int):
    """Shards of an indexed word for ``k`` edits: edits, number, length of the word, and each of its k + 1 segments."""
    n = F.length(word)
    begin = lambda i: F.floor(n * i / (k + 1)).cast("int")
    return [F.concat(F.lit(f"{k}{i}"), n.cast("string"), F.lit(":"), F.substring(F.col(word), begin(i) + 1, begin(i + 1) - begin(i))) for i in range(k + 1)]


def _asked_shards(query: str, k: int):
    """Shards that hold all words within ``k`` edits of a query: with i segments before it, an untouched segment has
    moved by at most i edits before and k - i behind it, for words of all lengths within k."""
    n, out = F.length(query), []
    for delta in range(-k, k + 1):  # the query's length less the word's
        size = n - delta
        begin = lambda i: F.floor(size * i / (k + 1)).cast("int")  # noqa: B023, E731
        for i in range(k + 1):
            for moved in range(max(-i, delta - (k - i)), min(i, delta + (k - i)) + 1):
                at, long = begin(i) + moved, begin(i + 1) - begin(i)
                fits = (size > 0) & (at >= 0) & (at + long <= n)
                out.append(F.when(fits, F.concat(F.lit(f"{k}{i}"), size.cast("string"), F.lit(":"), F.substring(F.col(query), at + 1, long))))
    return out


def _exploded(df: DataFrame, name: str, shards) -> DataFrame:
    return df.select(name, F.explode(F.array_distinct(F.array_compact(shards))).alias("shard"))


def _in_shard(shard: str, words: list[str], asked: list[str]) -> Iterator[tuple[str, str, int]]:
    """query, word, edits of the pairs within the shard's edits whose parts before and behind the segment allow it."""
    k, i = int(shard[0]), int(shard[1])
    length, segment = shard[2:].split(":", 1)
    at, long, before, behind = int(length) * i // (k + 1), len(segment), i, k - i
    rights: dict[str, list[str]] = {}
    for w in words:
        rights.setdefault(w[:at], []).append(w[at + long :])
    lefts = build_trie(list(rights)) if before else None
    tries: dict[str, dict] = {}
    for query in asked:
        delta = len(query) - int(length)
        for place in range(max(at - before, at + delta - behind, 0), min(at + before, at + delta + behind) + 1):
            if query[place : place + long] != segment:
                continue
            head, tail = query[:place], query[place + long :]
            for left, d in within(lefts, head, before) if before else ((head, 0),) if head in rights else ():
                if not behind:
                    if tail in rights[left]:
                        yield query, left + segment + tail, d
                    continue
                if left not in tries:
                    tries[left] = build_trie(rights[left])
                for right, e in within(tries[left], tail, behind):
                    yield query, left + segment + right, d + e


def trie_join(queries: DataFrame, index: DataFrame, most: int = 2, shard_rows: int = SHARD_ROWS, long: int = 10, swaps: bool = False) -> DataFrame:
    """query, word, edits for all (query, word) within ``most`` (0 to 2) edits; one edit for queries under ``long`` letters.
    ``swaps``: the edits given count a swap of neighbours as one, though the bound counts it as two.

    Words and queries of a shard are split at random into parts of about ``shard_rows``, so no task holds a hot shard.
    """
    few = min(most, 1)
    q = queries.select("query").distinct().where("query <> ''")
    q = _exploded(q, "query", F.when(F.length("query") >= long, F.array(*_asked_shards("query", most))).otherwise(F.array(*_asked_shards("query", few))))
    w = index.select("word").distinct().where("word <> ''")
    none = F.array().cast("array<string>")
    by_most = F.when(F.length("word") >= long - most, F.array(*_segment_shards("word", most))).otherwise(none)
    by_few = F.when(F.length("word") <= long - 1 + few, F.array(*_segment_shards("word", few))).otherwise(none)
    w = _exploded(w, "word", F.concat(by_most, by_few))
    parts = F.ceil(F.count(F.lit(1)) / shard_rows).cast("int")
    held = w.groupBy("shard").agg(parts.alias("parts"))
    # written once, as it is read twice: the shards asked for that there are
    hits = materialize(q.join(held.hint("shuffle_hash"), "shard"), "hits")  # a shard is one row of the built side
    sizes = hits.groupBy("shard").agg(F.max("parts").alias("parts"), parts.alias("q_parts"))
    tries = w.join(sizes.hint("shuffle_hash"), "shard").groupBy("shard", F.pmod(F.xxhash64("word"), "parts").alias("part")).agg(F.collect_list("word").alias("words"))
    asked = hits.select("shard", "query").join(sizes.hint("shuffle_hash"), "shard").groupBy("shard", F.pmod(F.xxhash64("query"), "q_parts").alias("q_part")).agg(F.collect_list("query").alias("queries"))
    # few bytes, much work: spread evenly, as no coalescing by size would
    pairs = asked.join(tries, "shard").select("shard", "words", "queries").repartition(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            qs, ws, ds = [], [], []
            for shard, words, asked_ in zip(*(c.to_pylist() for c in batch.columns)):
                for query, word, d in _in_shard(shard, words, asked_):
                    qs.append(query), ws.append(word), ds.append(1 if swaps and d == 2 and swapped(query, word) else d)
            yield pa.RecordBatch.from_arrays([pa.array(qs, pa.string()), pa.array(ws, pa.string()), pa.array(ds, pa.int32())], names=["query", "word", "edits"])

    return pairs.mapInArrow(run, "query string, word string, edits int").groupBy("query", "word").agg(F.min("edits").alias("edits"))


def neighbours(words: DataFrame, queries: DataFrame, index: DataFrame, most: int) -> DataFrame:
    """word, other, edits: words of ``index`` within ``most`` edits of a rotation of a word of ``queries``."""
    turned = queries.select("word", F.explode("turns").alias("query"))
    near = trie_join(turned, index, most).withColumnRenamed("word", "other")
    return turned.join(near, "query").where("word <> other").groupBy("word", "other").agg(F.min("edits").alias("edits"))


def canonical_words(words: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """word, canon: each distinct word of ``words`` (word, turns, n, sector) and the spelling it stands for.

    A spelling gives way to another order of its words or to a neighbour in ``pairs``: to a commoner order (of equally common ones the
    least in order), to a neighbour at least three times as common, and a single spelling to any, if their lines of
    business don't differ; nearest first. So of two well-supported neighbours each stays.
    """
    turned = words.select("word", F.explode("turns").alias("other")).where("word <> other").join(words.select(F.col("word").alias("other")), "other").select("word", "other", F.lit(0).alias("edits"))
    seen = pairs.select("word", "other", "edits").unionByName(turned) if pairs is not None else turned
    seen = seen.unionByName(seen.select(F.col("other").alias("word"), F.col("word").alias("other"), "edits")).groupBy("word", "other").agg(F.min("edits").alias("edits"))
    own = words.select("word", "n", "sector")
    of_other = words.select(F.col("word").alias("other"), F.col("n").alias("n_other"), F.col("sector").alias("s_other"))
    both = seen.join(own, "word").join(of_other, "other")
    turned_gives = (F.col("edits") == 0) & ((F.col("n_other") > F.col("n")) | ((F.col("n_other") == F.col("n")) & (F.col("other") < F.col("word"))))
    agree = (F.col("sector") == F.col("s_other")) | (F.col("sector") == "") | (F.col("s_other") == "")
    single = (F.col("n") == 1) & (F.length("word") >= 12) & ((F.col("n_other") == 2) | ((F.col("n_other") == 1) & (F.col("other") < F.col("word"))))
    gives = turned_gives | ((F.col("edits") > 0) & agree & ((F.col("n_other") >= 3 * F.col("n")) | single))
    best = F.min(F.struct("edits", (-F.col("n_other")).alias("m"), "other"))["other"].alias("canon")
    step = materialize(both.where(gives).groupBy("word").agg(best), "steps")
    for _ in range(4):
        hop = step.select(F.col("word").alias("canon"), F.col("canon").alias("next"))
        step = step.join(hop, "canon", "left").select("word", F.coalesce("next", "canon").alias("canon"))
    return words.select("word").join(step, "word", "left").select("word", F.coalesce("canon", "word").alias("canon"))


def token_rewrites(tokens: DataFrame, known: int = 10, times: int = 10) -> DataFrame:
    """token, right: the single words that are misspellings of a known one.

    tokens: token, n, of five letters and more. A word gives way to the nearest (swaps of neighbours count as one edit) of the words within two edits,
    one under seven letters, that at least ``known`` names hold, ``times`` as many as hold it; if two are as near, and
    neither is ``times`` as common as the other, it stays. Many organisations share a word, so a misspelling is told from
    a word even where each organisation has few records.
    """
    near = trie_join(tokens.select(F.col("token").alias("query")), tokens.where(F.col("n") >= known).select(F.col("token").alias("word")), 2, long=7, swaps=True)
    pairs = near.where("query <> word").join(tokens.select(F.col("token").alias("query"), F.col("n").alias("n_old")), "query").join(tokens.select(F.col("token").alias("word"), F.col("n").alias("n_new")), "word")
    nearest = Window.partitionBy("query").orderBy("edits", F.desc("n_new"), "word")
    fits = pairs.where(F.col("n_new") >= times * F.col("n_old"))
    ranked = fits.withColumn("k", F.row_number().over(nearest)).withColumn("next", F.lead(F.struct("edits", "n_new")).over(nearest)).where("k = 1")
    alone = F.col("next").isNull() | (F.col("next.edits") > F.col("edits")) | (F.col("n_new") >= times * F.col("next.n_new"))
    return ranked.where(alone).select(F.col("query").alias("token"), F.col("word").alias("right"))


def respelled(parsed: DataFrame) -> DataFrame:
    """id, word, turns, sector of parsed names, with misspelt single words set right; word: own words joined, turns: in all orders."""
    names = materialize(parsed.groupBy("name").agg(F.count(F.lit(1)).alias("n")), "distinct-names")
    tokens = names.select(F.explode(F.split("name", " ")).alias("token"), "n").where("length(token) >= 5")
    tokens = materialize(tokens.groupBy("token").agg(F.sum("n").alias("n")), "tokens")
    cells = names.select("name", F.explode(F.array_distinct(F.split("name", " "))).alias("token")).where("length(token) >= 5")
    touched = cells.join(token_rewrites(tokens), "token").groupBy("name").agg(F.map_from_entries(F.collect_list(F.struct("token", "right"))).alias("rights"))
    own = F.transform(F.split("name", " "), lambda t: F.coalesce(F.col("rights")[t], t))
    out = materialize(parsed.join(touched, "name", "left").select("id", F.array_join(own, "").alias("word"), orders(own).alias("turns"), "sector"), "names")
    discard(names)
    discard(tokens)
    return out


def word_counts(names: DataFrame) -> DataFrame:
    """word, n, turns, sector (of those named, the last in order)."""
    return names.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.max("turns").alias("turns"), F.max("sector").alias("sector"))


def same_organisation(records: DataFrame, partners: DataFrame) -> DataFrame:
    """source_customer_id, partner_id of the records and partners whose names denote the same organisation.

    Records and partners count by their latest row (null timestamps last). Names that are null, blank, stand-ins or
    hold nothing but legal forms are in no row. Lines of business that are both named must agree.
    """
    latest = latest_by(partners.select("partner_id", "company_name", "last_modified_timestamp", "standardized_at").where("partner_id is not null"), ["partner_id"], [F.col("last_modified_timestamp"), F.col("standardized_at")])
    rows = counting_rows(records.select("source_customer_id", "company_name", "last_modified_timestamp", "standardized_at").where("source_customer_id is not null"))
    both = parse_names(rows, "source_customer_id", "company_name").withColumn("side", F.lit("c")).unionByName(parse_names(latest, "partner_id", "company_name").withColumn("side", F.lit("p")))
    parsed = materialize(both.withColumn("id", F.concat("side", "id")).drop("side"), "parsed")
    named = respelled(parsed)
    words = materialize(word_counts(named), "words")
    partner = F.col("id").startswith("p")
    seeds = words.join(named.where(partner).select("word").distinct(), "word", "left_semi")
    near = materialize(neighbours(words, seeds, words, 2), "near")
    canon = canonical_words(words, near)
    side = lambda keep, name, sector: named.where(keep).join(canon, "word").select(F.substr("id", F.lit(2)).alias(name), "canon", F.col("sector").alias(sector))
    found = materialize(side(~partner, "source_customer_id", "c_sector").join(side(partner, "partner_id", "p_sector"), "canon"), "found")
    agree = (F.col("c_sector") == F.col("p_sector")) | (F.col("c_sector") == "") | (F.col("p_sector") == "")
    for used in (parsed, named, words, near):
        discard(used)
    return found.where(agree).select("source_customer_id", "partner_id")
