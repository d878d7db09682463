"""Edits, Jaro-Winkler and longest common blocks of many pairs of texts at once: one machine word a text, one array operation for all pairs.

The places of a letter in a text are the bits of a word, so texts of more than ``WORD`` letters take the plain forms.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import ROUND_HALF_UP, Decimal
from difflib import SequenceMatcher

import numpy as np

#: Letters that a machine word has bits for, and pairs that are worked on at once (their arrays stay in the cache).
WORD, AT_ONCE, BLOCKS_AT_ONCE = 64, 16_384, 2048
_1, _ALL = np.uint64(1), np.uint64(2**64 - 1)


class Texts:
    """Distinct texts: code points as small numbers (0 is any letter that only one text has, and the end; it meets nothing, so a text
    compared with itself is for the caller), and each letter's places as bits."""

    def __init__(self, texts: Sequence[str]):
        self.texts, n = texts, len(texts)
        self.size = np.fromiter(map(len, texts), np.int64, n)
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        owner, start = np.repeat(np.arange(n), self.size), np.cumsum(self.size) - self.size
        place = np.arange(len(points)) - start[owner]
        letters, codes = np.unique(points, return_inverse=True)
        first, last = np.full(len(letters), n), np.full(len(letters), -1)
        np.minimum.at(first, codes, owner)
        np.maximum.at(last, codes, owner)
        shared = first < last
        number = np.where(shared, np.cumsum(shared), 0)
        codes = number[codes]
        self.width = int(shared.sum()) + 1
        self.at = np.zeros((int(self.size.max(initial=0)) + 1, n), np.int64)  # by place, then text; ends in 0
        self.at[place, owner] = codes
        self.rows = np.ascontiguousarray(self.at.T)
        self.bits = np.zeros(n * self.width, np.uint64)
        fits = (codes > 0) & (place < WORD)
        np.bitwise_or.at(self.bits, owner[fits] * self.width + codes[fits], _1 << place[fits].astype(np.uint64))

    def __call__(self, kernel: Callable, plain: Callable[[str, str], float], a: np.ndarray, b: np.ndarray, at_once: int = AT_ONCE) -> np.ndarray:
        """Of the texts numbered a and b; plain for those b that don't fit a word. Longer a first, so the pairs of a kernel's call
        are of like length, and those whose a has ended are the tail of all arrays."""
        out, fits = np.empty(len(a)), self.size[b] <= WORD
        if not fits.all():
            out[~fits] = [plain(self.texts[p], self.texts[q]) for p, q in zip(a[~fits], b[~fits])]
        order = np.argsort(np.iinfo(np.uint16).max - np.minimum(self.size, np.iinfo(np.uint16).max).astype(np.uint16)[a], kind="stable")
        order = order[fits[order]]
        for i in range(0, len(order), at_once):
            some = order[i : i + at_once]
            out[some] = kernel(self, a[some], b[some])
        return out


def _edits(t: Texts, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Levenshtein distance, a column of the table in two words (Myers)."""
    base, size_a, score = b * t.width, t.size[a], t.size[b].copy()
    up, down = np.full(len(a), _ALL), np.zeros(len(a), np.uint64)
    last = np.maximum(score - 1, 0).astype(np.uint64)
    score[t.size[b] == 0] = size_a[t.size[b] == 0]
    some = t.size[b] > 0
    for i in range(int(size_a.max(initial=0))):
        k = int(np.searchsorted(-size_a, -i, "left"))  # those of more than i letters
        eq, p, m = t.bits.take(base[:k] + t.at[i].take(a[:k])), up[:k], down[:k]
        xv = eq | m
        xh = (((eq & p) + p) ^ p) | eq
        ph, mh = m | ~(xh | p), p & xh
        score[:k] += (((ph >> last[:k]) & _1).astype(np.int64) - ((mh >> last[:k]) & _1).astype(np.int64)) * some[:k]
        ph, mh = (ph << _1) | _1, mh << _1
        up[:k], down[:k] = mh | ~(xv | ph), ph & xv
    return score


def _jaro_winkler(t: Texts, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    base, la, lb = b * t.width, t.size[a], t.size[b]
    reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    free, taken = np.full(len(a), _ALL), np.zeros(len(a), bool)
    ends = [int(np.searchsorted(-la, -i, "left")) for i in range(int(la.max(initial=0)))]
    reaches = np.arange(int(reach.max(initial=0)) + 1)
    below = np.array([2**64 - 1 if x >= WORD else 2**x - 1 for x in range(2 * WORD + len(ends) + len(reaches) + 2)], np.uint64)
    met, seen = [], []
    for i, k in enumerate(ends):
        window = (below[i + reaches + 1] & ~below[np.maximum(0, i - reaches)])[reach[:k]]
        eq = t.bits.take(base[:k] + t.at[i].take(a[:k]))
        m = eq & free[:k] & window
        bit = m & (~m + _1)
        free[:k] ^= bit
        met.append(bit != 0)
        seen.append(eq)
    left, n, turned = ~free, np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    for k, taken, eq in zip(ends, met, seen):
        rest = left[:k]
        bit = np.where(taken, rest & (~rest + _1), np.uint64(0))
        rest ^= bit
        n[:k] += taken
        turned[:k] += taken & ((eq & bit) == 0)
    turned //= 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = (n / la + n / lb + (n - turned) / n) / 3
    same, head = np.ones(len(a), bool), np.zeros(len(a), np.int64)
    for i in range(min(4, len(ends))):
        same &= ((t.bits[base + t.at[i][a]] >> np.uint64(i)) & _1).astype(bool)
        head += same
    out = np.where(n == 0, 0.0, np.where(jaro <= 0.7, jaro, jaro + head * 0.1 * (1 - jaro)))
    return np.where(a == b, 1.0, out)


def _common(t: Texts, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Letters in common blocks: the longest, the first in a, then in b; then the same left and right of it.

    A row for each letter of a, of its places in b. The runs of k + 1 letters that end in a row are those of k letters that
    end in the row before, one place on. All pairs, and both sides of all blocks found, are searched at once; a row without
    places stands between them.
    """
    total, wide = np.zeros(len(a)), int(t.size[a].max(initial=0)) + 1
    rows = t.bits.take(t.rows[a, :wide] + (b * t.width)[:, None]).ravel()
    at = np.flatnonzero(rows)
    places, part = rows.take(at), at // wide
    while len(at):
        begins = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        counts = np.diff(begins, append=len(at))
        part = np.repeat(np.arange(len(begins)), counts)
        end, bit, length = at.take(begins), places.take(begins), np.ones(len(begins), np.int64)
        p, s, runs, k = at, part, places, 1
        while True:
            p = p + 1
            runs = rows.take(p) & (runs << _1)
            on = np.flatnonzero(runs)
            if not len(on):
                break
            p, s, runs, k = p.take(on), s.take(on), runs.take(on), k + 1
            first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
            which = s.take(first)
            end[which], bit[which], length[which] = p.take(first), runs.take(first), k
        total += np.bincount(end // wide, length, len(a))
        bit &= ~bit + _1
        left, right = (bit >> (length - 1).astype(np.uint64)) - _1, ~((bit << _1) - _1)
        after = at > np.repeat(end, counts)
        before = at <= np.repeat(end - length, counts)
        places = places & np.where(after, np.repeat(right, counts), np.where(before, np.repeat(left, counts), np.uint64(0)))
        rows[at] = places
        on = np.flatnonzero(places)
        part, at, places = (2 * part + after).take(on), at.take(on), places.take(on)
    return total


def _plain_edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def _plain_common(a: str, b: str) -> int:
    return sum(m.size for m in SequenceMatcher(None, a, b).get_matching_blocks())


def half_up(value: float, digits: int) -> float:
    """As scores.r: of ten digits, then of fewer, half away from zero."""
    return float(Decimal(repr(float(value))).quantize(Decimal("1e-10"), ROUND_HALF_UP).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def _each(score: Callable[[int, int], float], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """score of whole numbers, computed once for each two of them that occur."""
    wide = int(y.max(initial=0)) + 1
    of, back = x.astype(np.int64) * wide + y, None
    top = int(of.max(initial=0)) + 1
    if top <= max(len(of), 1 << 16):
        values = np.zeros(top)
        there = np.flatnonzero(np.bincount(of, minlength=top))
        values[there] = [score(int(v) // wide, int(v) % wide) for v in there]
        return values[of]
    there, back = np.unique(of, return_inverse=True)
    return np.array([score(int(v) // wide, int(v) % wide) for v in there])[back]


def edit_share(t: Texts, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """As similarity.edit_share."""
    swapped = (t.size[b] > WORD) & (t.size[a] <= WORD)
    edits = np.where(a == b, 0, t(_edits, _plain_edits, np.where(swapped, b, a), np.where(swapped, a, b)))
    return _each(lambda d, n: half_up(max(0.0, 1.0 - d / n), 8) if n else 1.0, edits, np.maximum(t.size[a], t.size[b]))


def jaro_winkler(t: Texts, a: np.ndarray, b: np.ndarray, plain: Callable[[str, str], float]) -> np.ndarray:
    """Of four digits, as scores.r of similarity.jaro_winkler: values near a half are rounded one by one."""
    exact = t(_jaro_winkler, plain, a, b)
    scaled = exact * 1e4
    whole = np.floor(scaled + 0.5)
    near = np.flatnonzero(np.abs(scaled - np.floor(scaled) - 0.5) < 1e-3)
    out = whole / 1e4
    if len(near):
        there, back = np.unique(exact[near], return_inverse=True)
        out[near] = np.array([half_up(round(float(v), 8), 4) for v in there])[back]
    return out


def sequence_ratio(t: Texts, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """As similarity.sequence_ratio."""
    common = np.where(a == b, t.size[a], t(_common, _plain_common, a, b, BLOCKS_AT_ONCE))
    return _each(lambda m, n: round(2.0 * m / n, 8) if n else 1.0, common, t.size[a] + t.size[b])
