"""Hashed features of whole texts for the two classifiers, in numpy, piece by piece."""

from __future__ import annotations

import numpy as np

from kinspan.llm.common import _IS_WS, byte_prefix, pieces, span_hash, text_buffer, words_of

ROWS = 512  # of a batch at once, so that a piece's dense counts stay small

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[65:91], _SHAPE[97:123], _SHAPE[48:58], _SHAPE[128:] = 65, 97, 48, 97
_SHAPE[_IS_WS] = 32
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[48:58] = 48
_LOWER[_IS_WS] = 32


def row_pieces(offs: np.ndarray):
    for i, j in pieces(offs):
        for a in range(i, j, ROWS):
            yield a, min(j, a + ROWS)


def gram_counts(buf: np.ndarray, offs: np.ndarray, n: int, dims: int, salt: int) -> np.ndarray:
    """Counts (rows, dims) of hashed byte n-grams that do not cross a row's end."""
    rows = len(offs) - 1
    m = len(buf) - n + 1
    if m <= 0:
        return np.zeros((rows, dims), np.float32)
    code = buf[:m].astype(np.uint32)
    for j in range(1, n):
        code = (code << np.uint32(8)) | buf[j : m + j]
    code = (code * np.uint32(0x9E3779B1 + 2 * salt)) >> np.uint32(32 - dims.bit_length() + 1)
    row = np.repeat(np.arange(rows), np.diff(offs))[:m]
    ok = np.arange(m) + n <= offs[1:][row]
    return np.bincount(row[ok] * dims + code[ok], minlength=rows * dims).reshape(rows, dims).astype(np.float32)


def language_features(col, dims: int):
    """Per piece of a text column: (first row, L2-normed square roots of the counts of letter bi- and trigrams)."""
    buf, offs = text_buffer(col)
    for i, j in row_pieces(offs):
        o = offs[i : j + 1] - offs[i]
        b = _LOWER[buf[offs[i] : offs[j]]]
        x = np.sqrt(np.concatenate([gram_counts(b, o, 2, dims // 2, 1), gram_counts(b, o, 3, dims // 2, 2)], axis=1))
        yield i, x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


GRAMS, SHAPES, EXTRA = 1024, 1024, 8
MOST_COUNT = 60000  # within a half float
QUALITY_DIMS = GRAMS + SHAPES + EXTRA


def quality_features(col):
    """Per piece: (first row, counts, whether a row has a word). Byte trigrams, trigrams of character shapes, and how words and lines repeat; as exact as half floats are."""
    buf, offs = text_buffer(col)
    for i, j in row_pieces(offs):
        o = offs[i : j + 1] - offs[i]
        b = buf[offs[i] : offs[j]]
        starts, ends, woff = words_of(b, o)
        rows, counts = len(o) - 1, np.diff(woff)
        extra = np.zeros((rows, EXTRA), np.float32)
        extra[:, 7] = counts < 20
        if len(starts):
            h = span_hash(byte_prefix(b), starts, ends)
            row = np.repeat(np.arange(rows), counts)
            n = np.maximum(counts, 1)
            for k, lag in enumerate((1, 2, 10, 20)):
                same = (h[lag:] == h[:-lag]) & (row[lag:] == row[:-lag]) if len(h) > lag else np.zeros(0, bool)
                extra[:, k] = np.bincount(row[lag:][same], minlength=rows) / n if len(same) else 0
            pair = h[:-1] * np.uint64(3) + h[1:]
            inside = row[:-1] == row[1:]
            key = np.sort((row[:-1][inside].astype(np.uint64) << np.uint64(48)) | (pair[inside] >> np.uint64(16)))
            again = key[1:] == key[:-1]
            extra[:, 4] = np.bincount((key[1:][again] >> np.uint64(48)).astype(np.int64), minlength=rows) / n
            alone = (ends - starts) == 1
            extra[:, 5] = np.bincount(row[alone], minlength=rows) / n
            extra[:, 6] = np.bincount(row, weights=(ends - starts), minlength=rows) / n / 20.0
        x = np.concatenate([gram_counts(_LOWER[b], o, 3, GRAMS, 3), gram_counts(_SHAPE[b], o, 3, SHAPES, 4), extra], axis=1)
        yield i, np.minimum(x, MOST_COUNT).astype(np.float16).astype(np.float32), counts > 0
