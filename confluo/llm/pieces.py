"""Cutting oversized texts into pieces within a token limit, at natural boundaries, with an exact token overlap.

A piece is a run of the text's tokens that starts and ends between characters. Its own tokens are that run or fewer: no
merge of the encoding ever crosses the end of a token of the run, so the merges inside are the same without what is around.

A text longer than ``RANGE`` characters is handled in ranges. Each range is followed by a halo up to the first place where
the tokeniser's split is certain (between letters, digits, blanks and signs), and belongs to the part from its own first
such place to that of the next range. Parts are tokenised apart from each other into boundary tables, the tables are
stitched and their lengths summed while pieces are chosen, and the text of a piece is fetched by offset from the one or
two parts that hold it. A shorter text is one range. Each text is encoded once, and no text is copied a range.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize
from .bpe import RankArrayTokenizer, spread, tokenizer

RANGE = 1 << 13
TOKEN, WORD, CLAUSE, SENTENCE, LINE, PARAGRAPH = range(6)
KINDS = ("token", "word", "clause", "sentence", "line", "paragraph")
_BLANKS = regex.compile(r"(?<=\S)\s+")
_SPACES = regex.compile(r"\s*")
_NEWLINE = regex.compile(r"\r\n|[\n\r\v\f\x85\u2028\u2029]")
_SENTENCE = regex.compile(r"[.!?…]+[\"')\]»”’]*(?=\s|$)|[。！？]+[」』”’）]*|[।؟]")
_CLAUSE = regex.compile(r"[;:,](?=\s|$)|;|[、，；：]")
PIECE = "piece_no int, start_char bigint, end_char bigint, n_tokens int, shared_tokens int, cut string"


#: Between a letter, digit or sign and another of these classes, or before a blank. An apostrophe may belong to either side.
_CERTAIN = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\s\p{L}'])|(?<=\p{N})(?=[^\s\p{N}'])|(?<=[^\s\p{L}\p{N}'])(?=[\p{L}\p{N}])")


def token_table(text: str, k: RankArrayTokenizer, ids: list[int] | None = None, halo: str = "") -> tuple[np.ndarray, np.ndarray]:
    """For each token the number of characters up to its end, -1 inside a character, and the kind of the place there.

    Places at blanks lie before them: there the tokeniser splits whatever follows. ``halo``: what follows the text.
    """
    ids = np.asarray(k.encode(text) if ids is None else ids, dtype=np.int64)
    raw = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
    begins = np.append((raw & 0xC0) != 0x80, True)
    upto = np.concatenate([[0], np.cumsum(begins[:-1])])
    ends = np.cumsum(k.lengths()[ids])
    chars = np.where(begins[ends], upto[ends], -1).astype(np.int64)
    seen = text + halo
    kind = np.zeros(len(seen) + 1, dtype=np.int8)
    for level, pattern in ((CLAUSE, _CLAUSE), (SENTENCE, _SENTENCE)):
        kind[[m.end() for m in pattern.finditer(seen)]] = level
    for m in _BLANKS.finditer(seen):
        lines = len(_NEWLINE.findall(m.group()))
        kind[m.start()] = PARAGRAPH if lines > 1 else LINE if lines else max(WORD, kind[m.start()])
    return chars, np.where(chars >= 0, kind[chars], -1).astype(np.int8)


def choose_end(kinds: np.ndarray, start: int, limit: int, overlap: int) -> int:
    """The end of a piece from token ``start``: the best place within the limit, first in the piece's upper half.

    ``kinds[i]`` is the kind of the place after token i.
    """
    top = min(start + limit, len(kinds))
    least = min(start + overlap + 4, top)  # a character has at most four tokens
    half = max(least, start + limit // 2)

    def last(lo: int, level: int) -> int:
        found = np.flatnonzero(kinds[lo - 1 : top] >= level)
        return lo + int(found[-1]) if len(found) else 0

    quarter = max(least, start + limit // 4)
    for lo, levels in ((half, (PARAGRAPH, LINE, SENTENCE)), (quarter, (SENTENCE,)), (half, (CLAUSE, WORD)), (least, (WORD, TOKEN))):
        for level in levels:
            if lo <= top and (end := last(lo, level)):
                return end
    return top


class Cutter:
    """Pieces of one text from its token table, which may come in parts; keeps no more than one piece's tokens."""

    def __init__(self, limit: int, overlap: int) -> None:
        self.limit, self.overlap = limit, min(overlap, max(limit // 2, 0))
        self.ends, self.kinds = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int8)
        self.begin, self.shared, self.number = 0, 0, 0  # character at which the next piece begins

    def feed(self, ends: np.ndarray, kinds: np.ndarray, over: bool) -> Iterator[tuple]:
        self.ends, self.kinds = np.concatenate([self.ends, ends]), np.concatenate([self.kinds, kinds])
        while len(self.ends) > self.limit or over and len(self.ends):
            end = len(self.ends) if len(self.ends) <= self.limit else choose_end(self.kinds, 0, self.limit, self.overlap)
            stop = int(self.ends[end - 1])
            done = end == len(self.ends) and over
            yield self.number, self.begin, stop, end, self.shared, "end" if done else KINDS[max(int(self.kinds[end - 1]), 0)]
            self.number += 1
            if done:
                self.ends = self.ends[:0]
                return
            back = max(end - self.overlap, 1)
            while back > 1 and self.ends[back - 1] < 0:
                back -= 1
            while self.ends[back - 1] < 0:  # no whole character before: share less
                back += 1
            self.begin, self.shared = int(self.ends[back - 1]), end - back
            self.ends, self.kinds = self.ends[back:], self.kinds[back:]


def _whole(path: str | None):
    """Pieces of texts of one range."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k = tokenizer(path)
        for frame in frames:
            rows = []
            for key, source, text, limit, overlap in zip(frame["__id"], frame["source"], frame["text"], frame["max_tokens"], frame["overlap_tokens"]):
                ids = k.encode(text)
                if len(ids) > limit:
                    rows += [(key, source, *piece, text[piece[1] : piece[2]]) for piece in Cutter(int(limit), int(overlap)).feed(*token_table(text, k, ids), True)]
            yield pd.DataFrame(rows, columns=["__id", "source", *(c.split()[0] for c in PIECE.split(", ")), "text"])

    return run


def ranges(text: str, span: int) -> Iterator[tuple[int, str, str]]:
    """begin, text, halo of the parts of a text: from the first certain place of a range to that of the next range that has one."""
    begin, start = 0, span
    while begin < len(text):
        m = _CERTAIN.search(text, start) if start < len(text) else None
        stop = m.start() if m else len(text)
        yield begin, text[begin:stop], text[stop : _SPACES.match(text, stop).end() + 1]
        begin, start = stop, (stop // span + 1) * span


def _giant(giant: DataFrame, span: int, path: str | None) -> DataFrame:
    kind = giant.schema["__id"].dataType.simpleString()
    keys = f"__id {kind}, source string, max_tokens int, overlap_tokens int"
    head = ["__id", "source", "max_tokens", "overlap_tokens"]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                for seg, (begin, part, halo) in enumerate(ranges(r.text, span)):
                    yield pd.DataFrame([(r[0], r.source, r.max_tokens, r.overlap_tokens, seg, begin, begin + len(part) == len(r.text), part, halo)], columns=[*head, "seg", "begin", "last", "part", "halo"])

    def tables(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k = tokenizer(path)
        for frame in frames:
            both = [token_table(t, k, None, h) for t, h in zip(frame["part"], frame["halo"])]
            yield frame[[*head, "seg", "begin", "last"]].assign(ends=[e.astype(np.int32).tobytes() for e, _ in both], kinds=[x.tobytes() for _, x in both])

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cutter, key, begins = None, None, []
        for frame in frames:
            rows = []
            for r in frame.itertuples(index=False):
                if cutter is None or r[0] != key:
                    cutter, key, begins = Cutter(int(r.max_tokens), int(r.overlap_tokens)), r[0], []
                begins.append(int(r.begin))
                ends = np.frombuffer(r.ends, dtype=np.int32).astype(np.int64)
                for p in cutter.feed(np.where(ends >= 0, ends + r.begin, -1), np.frombuffer(r.kinds, dtype=np.int8), bool(r.last)):
                    rows.append((key, r.source, *p, bisect.bisect_right(begins, p[1]) - 1, bisect.bisect_left(begins, p[2]) - 1))
            yield pd.DataFrame(rows, columns=["__id", "source", *(c.split()[0] for c in PIECE.split(", ")), "first_seg", "last_seg"])

    # one row a part, spread over the cluster: a giant text is tokenised by many
    parts = materialize(spread(giant).mapInPandas(read, f"{keys}, seg int, begin bigint, last boolean, part string, halo string"), "parts")
    done = parts.repartition("__id", "seg").mapInPandas(tables, f"{keys}, seg int, begin bigint, last boolean, ends binary, kinds binary")
    ordered = done.repartition("__id").sortWithinPartitions("__id", "seg")
    pieces = ordered.mapInPandas(cut, f"__id {kind}, source string, {PIECE}, first_seg int, last_seg int")
    pieces = pieces.where("not (piece_no = 0 and cut = 'end')")  # within its limit after all
    at = pieces.withColumn("seg", F.explode(F.sequence("first_seg", "last_seg"))).join(parts.select("__id", "seg", "begin", "part"), ["__id", "seg"])
    first = F.greatest(F.col("start_char") - F.col("begin"), F.lit(0))
    text = F.substring("part", (first + 1).cast("int"), (F.col("end_char") - F.col("begin") - first).cast("int"))
    names = ["__id", "source", *(c.split()[0] for c in PIECE.split(", "))]
    joined = at.select(*names, F.struct("seg", text.alias("t")).alias("s")).groupBy(*names).agg(F.array_sort(F.collect_list("s"))["t"].alias("ts"))
    return joined.select(*names, F.array_join("ts", "").alias("text"))


def split_oversized(df: DataFrame, limits: DataFrame, id_column: str = "doc_id", span: int = RANGE, path: str | None = None) -> DataFrame:
    """id, source, piece_no, start_char, end_char, n_tokens, shared_tokens, cut, text of every text above its source's limit.

    n_tokens is the run of the text's tokens that the piece is. shared_tokens is what it shares with the one before it:
    the limit table's overlap, more only where the token there ends inside a character, and at most half the limit. cut
    names the place at which the piece ends. Texts within
    the limit, null texts, and sources without a positive limit are not cut and have no row. Of several limits for a
    source the smallest counts; a null overlap is none. Ids must be unique. Other columns are not read.
    """
    smallest = limits.where("source is not null and max_tokens > 0").groupBy("source").agg(F.min(F.struct("max_tokens", F.greatest(F.coalesce("overlap_tokens", F.lit(0)), F.lit(0)).alias("overlap_tokens"))).alias("l")).select("source", "l.*")
    docs = df.select(F.col(id_column).alias("__id"), "source", "text").join(smallest, "source").select("__id", "source", "text", "max_tokens", "overlap_tokens")
    over = docs.where(F.octet_length("text") > F.col("max_tokens"))  # a token has at least a byte
    small, giant = over.where(F.length("text") <= span), over.where(F.length("text") > span)
    kind = df.schema[id_column].dataType.simpleString()
    names = ["__id", "source", "piece_no", "start_char", "end_char", "n_tokens", "shared_tokens", "cut", "text"]
    cut = spread(small).mapInPandas(_whole(path), f"__id {kind}, source string, {PIECE}, text string").select(*names)
    if not giant.isEmpty():
        cut = cut.unionByName(_giant(giant, span, path).select(*names))
    return cut.withColumnRenamed("__id", id_column)
