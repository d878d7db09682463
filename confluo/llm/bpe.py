"""Byte-pair encoding with a public rank file, on contiguous rank arrays.

A word is held as an array of part boundaries and an array with the rank of each adjacent pair. The smallest rank
is found by a scan, its inner boundary deleted and the two neighbouring ranks refreshed, until no pair has a rank.
The scan is quadratic in the word, so words of more than ``SHORT`` bytes take a heap over the same merges.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the public vocabulary byte_bpe_50k: the split pattern before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TOKENIZERS = os.environ.get("CONFLUO_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
SHORT, MEMO = 96, 400_000
NONE = 1 << 30


class RankArrayTokenizer:
    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, filter(bytes.strip, lines))}
        self.split = regex.compile(PATTERN)
        self.memo: dict[str, tuple[int, ...]] = {}

    def merge_short(self, word: bytes) -> tuple[int, ...]:
        get = self.ranks.get
        bounds = list(range(len(word) + 1))
        pairs = [get(word[i : i + 2], NONE) for i in range(len(word) - 1)]
        while pairs:
            least = min(pairs)
            if least == NONE:
                break
            at = pairs.index(least)
            del bounds[at + 1]
            del pairs[at]
            if at < len(pairs):
                pairs[at] = get(word[bounds[at] : bounds[at + 2]], NONE)
            if at:
                pairs[at - 1] = get(word[bounds[at - 1] : bounds[at + 1]], NONE)
        return tuple(self.ranks[word[a:b]] for a, b in zip(bounds, bounds[1:]))

    def merge_long(self, word: bytes) -> tuple[int, ...]:
        get, n = self.ranks.get, len(word)
        end = list(range(1, n + 1))  # end of the part that starts here; 0: no part starts here
        before = list(range(-1, n - 1))
        heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := get(word[i : i + 2], NONE)) != NONE]
        heapq.heapify(heap)
        while heap:
            _, at, stop = heapq.heappop(heap)
            middle = end[at]
            if not middle or middle >= n or end[middle] != stop or stop <= middle:
                continue
            end[at], end[middle] = stop, 0
            if stop < n:
                before[stop] = at
                if (rank := get(word[at : end[stop]], NONE)) != NONE:
                    heapq.heappush(heap, (rank, at, end[stop]))
            if (left := before[at]) >= 0 and (rank := get(word[left:stop], NONE)) != NONE:
                heapq.heappush(heap, (rank, left, stop))
        out, at = [], 0
        while at < n:
            out.append(self.ranks[word[at : end[at]]])
            at = end[at]
        return tuple(out)

    def word(self, text: str) -> tuple[int, ...]:
        ids = self.memo.get(text)
        if ids is None:
            raw = text.encode("utf-8")
            whole = self.ranks.get(raw)
            ids = (whole,) if whole is not None else self.merge_short(raw) if len(raw) <= SHORT else self.merge_long(raw)
            if len(self.memo) >= MEMO:
                self.memo.clear()
            if len(text) <= SHORT:
                self.memo[text] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        held, word = self.memo.get, self.word
        for part in self.split.findall(text or ""):
            out += held(part) or word(part)
        return out

    def count(self, text: str | None) -> int:
        held, word = self.memo.get, self.word
        return sum([len(held(part) or word(part)) for part in self.split.findall(text or "")])

    def lengths(self) -> np.ndarray:
        """Bytes of each token id."""
        if not hasattr(self, "_lengths"):
            self._lengths = np.zeros(max(self.ranks.values()) + 1, dtype=np.int32)
            for word, rank in self.ranks.items():
                self._lengths[rank] = len(word)
        return self._lengths


_held: dict[str, RankArrayTokenizer] = {}


def tokenizer(path: str | None = None) -> RankArrayTokenizer:
    """The tokenizer of a rank file, loaded once a Python worker."""
    path = path or os.path.join(TOKENIZERS, VOCABULARY)
    if path not in _held:
        _held[path] = RankArrayTokenizer(path)
    return _held[path]


def spread(df: DataFrame) -> DataFrame:
    """Rows over at least twice the cluster's cores before Python work, if the scan has fewer partitions."""
    spark = df.sparkSession
    wanted = 2 * spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)


def encode_corpus(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str | None = None) -> DataFrame:
    """id, ids: the token ids of each row's text without special tokens, one row per input row.

    A null and an empty text have an empty list; other columns are not read; a null id stays null; repeated rows
    are encoded each. Texts are shuffled only if the scan has few partitions; they go to the Python workers in Arrow
    batches, ids come back as flat arrays.
    """
    schema = f"`{id_column}` {df.schema[id_column].dataType.simpleString()}, ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path).encode
        for batch in batches:
            ids, step = batch.column(0), 256
            for start in range(0, batch.num_rows, step):
                rows = [encode(t.as_py()) for t in batch.column(1).slice(start, step)]
                offsets = np.zeros(len(rows) + 1, dtype=np.int32)
                np.cumsum([len(r) for r in rows], out=offsets[1:])
                flat = np.fromiter((i for r in rows for i in r), dtype=np.int32, count=int(offsets[-1]))
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([ids.slice(start, step), lists], names=[id_column, "ids"])

    return spread(df.select(id_column, text_column)).mapInArrow(run, schema)


def token_counts(df: DataFrame, keep: list[str], text_column: str = "text", path: str | None = None) -> DataFrame:
    """The ``keep`` columns and n_tokens; null and empty texts have none."""
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep) + ", n_tokens bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = tokenizer(path).count
        for batch in batches:
            n = pa.array([count(t.as_py()) for t in batch.column(len(keep))], type=pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], n], names=[*keep, "n_tokens"])

    return spread(df.select(*keep, F.col(text_column).alias("__text"))).mapInArrow(run, schema)
