"""String similarities that Spark has no expression for: the longest common subsequence and the best window, each for a whole batch at once.

All ratios follow the normalized Indel similarity, 2 * LCS / (length + length). What is not a subsequence is a column expression."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CELLS = 1 << 22  # of a batch's table of equal characters that are worked on at once


class Spans:
    """Strings as spans of one array of code points."""

    def __init__(self, codes: np.ndarray, start: np.ndarray, size: np.ndarray):
        self.codes, self.start, self.size = codes, start, size

    @classmethod
    def of(cls, texts) -> Spans:
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        return cls(codes, np.cumsum(size) - size, size)

    def take(self, at: np.ndarray) -> Spans:
        return Spans(self.codes, self.start[at], self.size[at])

    def matrix(self, width: int, fill: int) -> np.ndarray:
        place = np.arange(width)
        if not len(self.codes):
            return np.full((len(self.size), width), fill, np.uint32)
        got = self.codes[np.minimum(self.start[:, None] + place, len(self.codes) - 1)]
        return np.where(place < self.size[:, None], got, np.uint32(fill))


def _bits(flags: np.ndarray) -> np.ndarray:
    """Rows of flags, a multiple of 64 of them, as words; the first flag is the lowest bit."""
    return np.packbits(flags, axis=1, bitorder="little").view("<u8")


def lcs_spans(a: Spans, b: Spans) -> np.ndarray:
    """Lengths of the longest common subsequences of a[i] and b[i]: a row of the table is a row of bits, and all strings take a step at once."""
    out = np.zeros(len(a.size), np.int64)
    order = np.argsort(np.maximum(a.size, b.size), kind="stable")
    order = order[np.minimum(a.size, b.size)[order] > 0]
    at = 0
    while at < len(order):
        n, long = len(order) - at, np.maximum(a.size, b.size)[order]
        while n > 1 and n * (long[at + n - 1] + 64) > CELLS:
            n //= 2
        now = order[at : at + n]
        at += n
        x, y = a.take(now), b.take(now)
        width = -(-int(max(1, x.size.max())) // 64) * 64
        left, steps = x.matrix(width, 0xFFFFFFFF), int(y.size.max())
        right = np.ascontiguousarray(y.matrix(steps, 0xFFFFFFFE).T)
        row = np.full((n, width // 64), ~np.uint64(0))
        for j in range(steps):
            hit = row & _bits(left == right[j][:, None])
            total, carry = np.empty_like(row), np.zeros(n, np.uint64)
            for w in range(row.shape[1]):
                part = row[:, w] + hit[:, w]
                over = part < hit[:, w]
                total[:, w] = part + carry
                carry = (over | (total[:, w] < part)).astype(np.uint64)
            row = total | (row & ~hit)
        inside = _bits(np.arange(width) < x.size[:, None])
        out[now] = x.size - np.bitwise_count(row & inside).sum(axis=1, dtype=np.int64)
    return out


def lcs_many(a, b) -> np.ndarray:
    return lcs_spans(Spans.of(a), Spans.of(b))


def partial_many(a, b) -> np.ndarray:
    """The best ratio of the shorter of a[i] and b[i] with a window of the longer one, windows cut off at its ends included; both ways round for equal lengths."""
    x, y = Spans.of(a), Spans.of(b)
    out = np.where((x.size == 0) & (y.size == 0), 1.0, 0.0)
    for short, long, which in ((x, y, (x.size <= y.size) & (x.size > 0)), (y, x, (y.size <= x.size) & (y.size > 0))):
        todo = np.flatnonzero(which)
        cost = (short.size + long.size)[todo] * (short.size[todo] + 64)
        for part in np.split(todo, np.flatnonzero(np.diff(np.cumsum(cost) // (4 * CELLS))) + 1) if len(todo) else []:
            n, m = short.size[part], long.size[part]
            windows = n + m - 1
            first = np.cumsum(windows) - windows
            pair = np.repeat(np.arange(len(part)), windows)
            shift = np.arange(len(pair)) - first[pair] + 1 - n[pair]
            lo, hi = np.maximum(shift, 0), np.minimum(shift + n[pair], m[pair])
            cut = Spans(long.codes, long.start[part][pair] + lo, hi - lo)
            got = 2.0 * lcs_spans(short.take(part[pair]), cut) / (n[pair] + hi - lo)
            out[part] = np.maximum(out[part], np.maximum.reduceat(got, first))
    return out


def _known(a: pd.Series, b: pd.Series, of, kind: str) -> pd.Series:
    some = (a.notna() & b.notna()).to_numpy()
    out = np.full(len(a), np.nan)
    if some.any():
        out[some] = of(a.to_numpy(object)[some], b.to_numpy(object)[some])
    return pd.Series(out).astype(kind)


@F.pandas_udf(T.DoubleType())
def lcs(a: pd.Series, b: pd.Series) -> pd.Series:
    return _known(a, b, lcs_many, "float64")


@F.pandas_udf(T.DoubleType())
def _partial(a: pd.Series, b: pd.Series) -> pd.Series:
    return _known(a, b, partial_many, "float64")


def ratio(a: Column, b: Column) -> Column:
    total = F.length(a) + F.length(b)
    return F.when(total == 0, 1.0).otherwise(2.0 * lcs(a, b) / F.greatest(total, F.lit(1)))


def _line(tokens: Column) -> Column:
    return F.array_join(F.sort_array(tokens), " ")


def token_sort_ratio(a: Column, b: Column) -> Column:
    """Of two lists of tokens."""
    return ratio(_line(a), _line(b))


def _parts(a: Column, b: Column) -> tuple[Column, Column, Column]:
    return _line(F.array_intersect(a, b)), _line(F.array_except(a, b)), _line(F.array_except(b, a))


def token_set_ratio(a: Column, b: Column) -> Column:
    """The best of comparing two lists' shared tokens alone, with the tokens of a besides and with those of b."""
    both, only_a, only_b = _parts(a, b)
    s, da, db = F.length(both), F.length(only_a), F.length(only_b)
    gap = (s > 0).cast("int")
    whole = 1.0 - (da + db - 2 * lcs(only_a, only_b)) / F.greatest(2 * (s + gap) + da + db, F.lit(1))
    beside = lambda d: F.when(s > 0, 1.0 - (gap + d) / F.greatest(2 * s + gap + d, F.lit(1))).otherwise(0.0)
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).when((s > 0) & ((da == 0) | (db == 0)), 1.0).otherwise(F.greatest(whole, beside(da), beside(db)))


def weighted_ratio(a: Column, b: Column, tokens_a: Column, tokens_b: Column) -> Column:
    """The best of the above, each scaled down; parts count where lengths differ by half or more (scaled further beyond eight times)."""
    la, lb = F.length(a), F.length(b)
    q = F.greatest(la, lb) / F.greatest(F.least(la, lb), F.lit(1))
    apart = (la > 0) & (lb > 0) & (q >= 1.5)
    best = lambda x, y: _partial(F.when(apart, x), F.when(apart, y))  # noqa: E731  only such pairs need the windows
    both, only_a, only_b = _parts(tokens_a, tokens_b)
    of_tokens = F.when(F.length(both) > 0, 1.0).otherwise(F.greatest(best(_line(tokens_a), _line(tokens_b)), best(only_a, only_b)))
    scale = F.when(q <= 8, 0.9).otherwise(0.6)
    near = F.greatest(ratio(a, b), 0.95 * F.greatest(token_sort_ratio(tokens_a, tokens_b), token_set_ratio(tokens_a, tokens_b)))
    return F.when((la == 0) | (lb == 0), 0.0).when(~apart, near).otherwise(F.greatest(ratio(a, b), scale * best(a, b), 0.95 * scale * of_tokens))
