"""Mixing sources to target weights by cube-method balanced sampling.

The size of the mix is the largest at which every present source reaches its share with no document used more
than the source's ``max_repeats`` times. A source then needs m = target tokens / own tokens copies of a document on
average: floor(m) of each, and one more of a sample with inclusion probability m - floor(m). The sample is drawn by
the cube method, balanced on tokens and documents: in blocks of about ``BLOCK`` documents, and there among documents
of about one size, probabilities move along the null space of the constraints until at most two of a size are
fractional. The fractional documents of all blocks fly on together, again in blocks, until a source has at most a block
of them. Then they land, the largest first: constraints are dropped one by one, and what a size misses is asked of the
next smaller one. A miss has expectation zero, so probabilities keep theirs, and what is missed in the end is of the order
of the smallest documents. No task holds more than a block of sizes.
"""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize
from .bpe import token_counts

BLOCK = 4096
EPS = 1e-9


def _step(rng: random.Random, pi: list[float], u: list[float]) -> None:
    """Move pi along u or against it, as far as the unit cube allows, keeping its expectation."""
    ahead = back = float("inf")
    for p, d in zip(pi, u):
        if d > EPS:
            ahead, back = min(ahead, (1 - p) / d), min(back, p / d)
        elif d < -EPS:
            ahead, back = min(ahead, p / -d), min(back, (1 - p) / -d)
    by = ahead if rng.random() * (ahead + back) < back else -back
    for i, d in enumerate(u):
        p = pi[i] + by * d
        pi[i] = 0.0 if p < EPS else 1.0 if p > 1 - EPS else p


def _kernel(rows: list[list[float]]) -> list[float]:
    """A vector that all rows (one fewer than its length, or fewer) map to zero."""
    if not rows:
        return [1.0]
    if len(rows) == 1:
        a, b = rows[0]
        return [b, -a] if abs(a) > EPS or abs(b) > EPS else [1.0, 0.0]
    (a, b, c), (d, e, f) = rows
    u = [b * f - c * e, c * d - a * f, a * e - b * d]
    if max(map(abs, u)) > EPS:
        return u
    row = rows[0] if max(map(abs, rows[0])) > EPS else rows[1]
    return [row[1], -row[0], 0.0] if abs(row[0]) > EPS or abs(row[1]) > EPS else [1.0, 0.0, 0.0]


def cube_flight(sizes: list[float], pi: list[float], rng: random.Random, landing: bool) -> list[float]:
    """The probabilities after the flight, and after the landing if ``landing``."""
    pi = list(pi)
    scale = max(max(sizes, default=1.0), 1.0)
    open_ = [i for i, p in enumerate(pi) if EPS < p < 1 - EPS]
    weight = {i: (sizes[i] / scale, 1.0) for i in open_}  # all units of a source began with one probability
    constraints = 2
    held: list[int] = []
    queue = iter(open_)
    while True:
        while len(held) < constraints + 1 and (i := next(queue, None)) is not None:
            held.append(i)
        if len(held) < constraints + 1:
            if not landing or not held:
                return pi
            constraints = min(constraints - 1, len(held) - 1)
            continue
        part = [pi[i] for i in held]
        _step(rng, part, _kernel([[weight[i][c] for i in held] for c in range(constraints)]))
        for i, p in zip(held, part):
            pi[i] = p
        held = [i for i in held if EPS < pi[i] < 1 - EPS]


def octaves(sizes: list[int]) -> list[list[int]]:
    """The indices of the units by octave of size, the largest first."""
    classes: dict[int, list[int]] = {}
    for i, size in enumerate(sizes):
        classes.setdefault(int(size).bit_length(), []).append(i)
    return [classes[k] for k in sorted(classes, reverse=True)]


def flown(sizes: list[int], pi: list[float], rng: random.Random) -> list[float]:
    """The probabilities after a flight in each octave: at most two of each are fractional."""
    out = list(pi)
    for units in octaves(sizes):
        rng.shuffle(units)
        for i, p in zip(units, cube_flight([float(sizes[i]) for i in units], [pi[i] for i in units], rng, False)):
            out[i] = p
    return out


def landed(sizes: list[int], pi: list[float], rng: random.Random) -> list[float]:
    """0 or 1 for each unit: octave by octave from the largest, each taking over the tokens that were missed before it."""
    out, missed = list(pi), 0.0
    for units in octaves(sizes):
        rng.shuffle(units)
        tokens = sum(sizes[i] for i in units)
        wanted = sum(sizes[i] * pi[i] for i in units) + missed
        shifted = [min(max(pi[i] + missed / tokens, 0.0), 1.0) for i in units]
        for i, p in zip(units, cube_flight([float(sizes[i]) for i in units], shifted, rng, True)):
            out[i] = p
        missed = wanted - sum(sizes[i] * out[i] for i in units)
    return out


def _flights(units: DataFrame, seed: int, last: bool) -> DataFrame:
    """The units after a flight in each block; ``last``: one block a source, with the landing."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rng = random.Random(f"{seed}|{'|'.join(map(str, key))}")
        pdf = pdf.sort_values("__id", kind="stable")
        return pdf.assign(pi=(landed if last else flown)(pdf["n_tokens"].tolist(), pdf["pi"].tolist(), rng))

    return units.groupBy(*(["source"] if last else ["source", "__block"])).applyInPandas(run, units.schema)


def _sample(units: DataFrame, seed: int, block: int) -> DataFrame:
    """The units with a probability of 0 or 1."""
    done, salt = None, seed
    while True:
        sizes = units.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))  # one row a source
        if (sizes.agg(F.max("blocks")).first()[0] or 0) <= 1:
            landed = _flights(units, salt, True)
            return landed if done is None else done.unionByName(landed)
        blocked = units.drop("__block").join(F.broadcast(sizes), "source").withColumn("__block", F.pmod(F.xxhash64("__id", F.lit(salt)), "blocks").cast("int")).select(*units.columns)
        flown = materialize(_flights(blocked, salt, False), "flown")
        whole = flown.where(f"pi <= {EPS} or pi >= {1 - EPS}")
        done = whole if done is None else done.unionByName(whole)
        units, salt = flown.where(f"pi > {EPS} and pi < {1 - EPS}"), salt + 1


def mix_plan(sizes: list[dict], targets: list[dict]) -> dict[str, dict]:
    """source -> whole copies, fraction, and the figures behind them. One entry a source of the targets: both lists are
    as short as the table of targets."""
    have = {r["source"]: r for r in sizes if r["tokens"]}
    named = [t for t in targets if t["target_share"] and t["target_share"] > 0 and (t["max_repeats"] or 0) > 0]
    present = [t for t in named if t["source"] in have]
    whole = sum(t["target_share"] for t in present)
    if not present:
        return {}
    size = min(t["max_repeats"] * have[t["source"]]["tokens"] * whole / t["target_share"] for t in present)
    plan = {}
    for t in present:
        m = t["target_share"] / whole * size / have[t["source"]]["tokens"]
        m = round(m) if abs(m - round(m)) < 1e-9 else m
        plan[t["source"]] = {"copies": int(m), "fraction": m - int(m), "documents": have[t["source"]]["documents"], "tokens": have[t["source"]]["tokens"]}
    return plan


def planned_mix(df: DataFrame, targets: DataFrame, id_column: str = "doc_id", seed: int = 7, block: int = BLOCK, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The mix (see ``mix_sources``), and source, copies, fraction, documents, tokens of every source in it."""
    counted = token_counts(df.select(F.col(id_column).alias("__id"), "source", "text"), ["__id", "source"], path=path)
    counted = materialize(counted.where("n_tokens > 0 and source is not null"), "mix-sizes")
    limits = targets.where("source is not null").groupBy("source").agg(F.max(F.struct("target_share", "max_repeats")).alias("t")).select("source", "t.*")
    sizes = counted.join(limits, "source", "left_semi").groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("documents"))
    plan = mix_plan([r.asDict() for r in sizes.collect()], [r.asDict() for r in limits.collect()])
    rows = [(s, p["copies"], float(p["fraction"]), p["documents"], p["tokens"]) for s, p in plan.items()]
    table = df.sparkSession.createDataFrame(rows, "source string, copies int, fraction double, documents bigint, tokens bigint")
    units = counted.join(F.broadcast(table.select("source", "copies", F.col("fraction").alias("pi"))), "source").withColumn("__block", F.lit(0))
    columns = ["__id", "source", "n_tokens", "copies", "pi", "__block"]
    whole = units.where(f"pi <= {EPS} or pi >= {1 - EPS}").select(*columns)
    moving = units.where(f"pi > {EPS} and pi < {1 - EPS}").select(*columns)
    out = whole.unionByName(_sample(moving, seed, block))
    return out.select(F.col("__id").alias(id_column), "source", "n_tokens", (F.col("copies") + (F.col("pi") > 0.5).cast("int")).alias("repeats")).where("repeats > 0"), table


def mix_sources(df: DataFrame, targets: DataFrame, id_column: str = "doc_id", seed: int = 7, block: int = BLOCK, path: str | None = None) -> DataFrame:
    """id, source, n_tokens, repeats (1 or more) of the documents in the mix.

    Documents without tokens (null or empty text), of no source, or of a source without a target are in no mix. A
    target whose source is absent, null, without share or without repeats gets nothing and the other shares are
    scaled up; of several rows for one target the first by share and repeats counts. Other columns are not read.
    """
    return planned_mix(df, targets, id_column, seed, block, path)[0]


def mix_shares(mix: DataFrame, targets: DataFrame, plan: DataFrame) -> DataFrame:
    """source, target_share, max_repeats, documents, uses, tokens, actual_share, most_repeats for every target row, and by how
    many tokens and uses the sample misses what was planned (null for a source that is not in the mix)."""
    used = mix.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("repeats").alias("uses"), F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.max("repeats").alias("most_repeats"))
    total = used.agg(F.sum("tokens").alias("all_tokens"))
    wanted = plan.select("source", ((F.col("copies") + F.col("fraction")) * F.col("tokens")).alias("w_tokens"), ((F.col("copies") + F.col("fraction")) * F.col("documents")).alias("w_uses"))
    joined = targets.join(used, "source", "left").join(F.broadcast(wanted), "source", "left").crossJoin(F.broadcast(total))  # one row; one a target
    filled = {c: F.coalesce(c, F.lit(0)) for c in ("documents", "uses", "tokens", "most_repeats")}
    joined = joined.withColumns(filled)
    share = F.coalesce(F.col("tokens") / F.nullif("all_tokens", F.lit(0)), F.lit(0.0)).alias("actual_share")
    misses = [F.round(F.col("tokens") - F.col("w_tokens"), 3).alias("token_miss"), F.round(F.col("uses") - F.col("w_uses"), 3).alias("use_miss")]
    return joined.select("source", "target_share", "max_repeats", "documents", "uses", "tokens", share, "most_repeats", *misses)
