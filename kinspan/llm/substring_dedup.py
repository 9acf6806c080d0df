"""Removal of repeated word windows, level by level: only windows that repeat at one length are looked at twice as long."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinspan.llm.common import byte_prefix, hot_cells, materialize, mix, pieces, span_hash, text_buffer, windows_of, within, words_of

SECOND = 0x9FB21C651E98DF25


def levels(window: int, least: int = 5) -> list[int]:
    """The lengths looked at: the window, its half, and so on down to at least `least`; ascending."""
    out = [window]
    while (out[-1] + 1) // 2 >= max(least, 2) and out[-1] > 1:
        out.append((out[-1] + 1) // 2)
    return out[::-1]


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    have = 1
    while have < w:
        step = min(have, w - have)
        x = np.minimum(x[: len(x) - step], x[step:])
        have += step
    return x


def _hashed(col):
    """Per piece of rows: (first row, word hashes, each row's first word)."""
    buf, offs = text_buffer(col)
    for i, j in pieces(offs):
        b = buf[offs[i] : offs[j]]
        starts, ends, woff = words_of(b, offs[i : j + 1] - offs[i])
        yield i, span_hash(byte_prefix(b), starts, ends), woff


def _seeds(h: np.ndarray, length: int, window: int) -> np.ndarray:
    """For each window its seed at this level: the least hash of the runs of `length` words inside. Equal windows have equal seeds."""
    return sliding_min(windows_of(h, length), window - length + 1)


def _once(seed: np.ndarray, ok: np.ndarray, woff: np.ndarray) -> np.ndarray:
    """Places of the windows marked ok, one for each seed that a row has: so a text that repeats itself sends a seed but once."""
    new = np.ones(len(ok), bool)
    new[1:] = (seed[1:] != seed[:-1]) | ~ok[:-1]
    at = np.flatnonzero(ok & new)
    row = np.searchsorted(woff, at, side="right") - 1
    order = np.lexsort((seed[at], row))
    at, row = at[order], row[order]
    first = np.ones(len(at), bool)
    first[1:] = (row[1:] != row[:-1]) | (seed[at][1:] != seed[at][:-1])
    return at[first]


def _alive(h: np.ndarray, woff: np.ndarray, rows: np.ndarray, lists: list, lengths: list[int], window: int) -> np.ndarray:
    """Mask of the windows whose seed repeats at every level of `lengths`; lists: per row, those levels' repeated seeds."""
    ok = within(woff, window, len(h))
    for k, length in enumerate(lengths):
        seed = _seeds(h, length, window)
        good = np.zeros(len(ok), bool)
        for r in rows:
            a, b = woff[r], max(woff[r], woff[r + 1] - window + 1)
            if b > a and lists[r] is not None and len(found := lists[r][k]):
                good[a:b] = np.isin(seed[a:b], found)
        ok &= good
    return ok


def _whole(h: np.ndarray, woff: np.ndarray) -> np.ndarray:
    """Each row's hash of its whole text: a sum over words that depends on the place."""
    acc = np.zeros(len(h) + 1, np.uint64)
    acc[1:] = np.cumsum(_mixed(h, np.arange(len(h), dtype=np.uint64) - np.repeat(woff[:-1], np.diff(woff)).astype(np.uint64)))
    return acc[woff[1:]] - acc[woff[:-1]]


def _copied(col, row0: int, h: np.ndarray, woff: np.ndarray) -> np.ndarray:
    """Mask of the rows whose whole text is marked (level -1) in their id's list; other rows of that id are no copies."""
    n = len(woff) - 1
    out = np.zeros(n, bool)
    offs = np.asarray(col.offsets)[row0 : row0 + n + 1]
    level, g = (x.to_numpy(zero_copy_only=False)[offs[0] : offs[-1]] for x in col.values.flatten())
    marks = np.flatnonzero(level < 0)
    if len(marks):
        row = np.searchsorted(offs - offs[0], marks, side="right") - 1
        out[row[_whole(h, woff)[row] == g[marks].view(np.uint64)]] = True
    return out


def _lists(col, row0: int, n: int, depth: int) -> list:
    """Per row: for each level the seeds (uint64) of a column list<struct<level, g>>; None where there are none."""
    out: list = [None] * n
    offs = np.asarray(col.offsets)
    level, g = (x.to_numpy(zero_copy_only=False) for x in col.values.flatten())
    for i in range(n):
        a, b = offs[row0 + i], offs[row0 + i + 1]
        if b > a:
            out[i] = [g[a:b][level[a:b] == k].view(np.uint64) for k in range(depth)]
    return out


def _repeated(rows: DataFrame) -> DataFrame:
    """rows (g, k, doc_id) with the smallest and largest doc_id that has (g, k), if they differ.

    Seeds that very many rows have go by partial minima and maxima and a join, which adaptive execution splits, not to one task."""
    rows, w = materialize(rows, "seeds"), Window.partitionBy("g", "k")
    hot = hot_cells(rows, "g")
    usual = rows if hot is None else rows.where(~hot)
    out = usual.withColumn("lo", F.min("doc_id").over(w)).withColumn("hi", F.max("doc_id").over(w)).where("lo < hi")
    if hot is None:
        return out
    often = rows.where(hot)
    ends = often.groupBy("g", "k").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
    return out.unionByName(often.join(ends, ["g", "k"]))


def _mixed(h: np.ndarray, place: np.ndarray) -> np.ndarray:
    return mix(h + place * np.uint64(0x9E3779B97F4A7C15))


def substring_dedup(docs: DataFrame, window: int = 13) -> DataFrame:
    """Removes from every row of docs (doc_id, text) each word covered by a window of `window` words that also starts in a row with a smaller doc_id.

    At each level a document is known by its windows' seeds. A shuffle by seed finds those that more than one document has;
    windows whose seeds repeat at one level alone are taken to the level of twice that length, up to the window
    itself, whose own hash (96 bits) decides. Rows that are whole copies of a document are settled at the first level, row by row.
    Returns doc_id, n_words, n_removed, kept_sha256, kept_text.

    Null text counts as empty; rows of fewer words lose nothing; a row with a null doc_id neither removes nor loses
    words; rows that share a doc_id do not remove from each other, and equal windows of one row are no ties to break; a very long text is one row, held whole by
    one task; an empty table gives no row; other columns are ignored."""
    base = docs.select("doc_id", "text")
    steps = levels(window)

    def first(batches):
        import pyarrow as pa

        for batch in batches:
            ids = batch.column("doc_id")
            for i, h, woff in _hashed(batch.column("text")):
                ok = within(woff, window, len(h))
                if not ok.any():
                    continue
                seed = _seeds(h, steps[0], window)
                at = _once(seed, ok, woff)
                row = np.searchsorted(woff, at, side="right") - 1
                full = np.flatnonzero(np.diff(woff) >= window)
                whole = _whole(h, woff)
                other = (_whole(h ^ np.uint64(SECOND), woff) >> np.uint64(33)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([seed[at], whole[full]]).view(np.int64)), pa.array(np.concatenate([np.full(len(at), -1, np.int32), other[full]])),
                                                  ids.take(pa.array(np.concatenate([row, full]) + i))], names=["g", "k", "doc_id"])

    def further(depth: int):
        length, last = steps[depth], depth == len(steps) - 1

        def emit(batches):
            import pyarrow as pa

            for batch in batches:
                ids, found = batch.column("doc_id"), batch.column("found")
                for i, h, woff in _hashed(batch.column("text")):
                    n = len(woff) - 1
                    ok = _alive(h, woff, np.flatnonzero(~_copied(found, i, h, woff)), _lists(found, i, n, depth), steps[:depth], window)
                    if not ok.any():
                        continue
                    seed = _seeds(h, length, window)
                    at = _once(seed, ok, woff)
                    k = (windows_of(h, window, SECOND)[at] >> np.uint64(33)).astype(np.int32) if last else np.full(len(at), -1, np.int32)
                    row = np.searchsorted(woff, at, side="right") - 1
                    yield pa.RecordBatch.from_arrays([pa.array(seed[at].view(np.int64)), pa.array(k), ids.take(pa.array(row + i))], names=["g", "k", "doc_id"])

        return emit

    schema = f"g long, k int, doc_id {dict(base.dtypes)['doc_id']}"
    listed = lambda x: x.groupBy("doc_id").agg(F.collect_list(F.struct("level", "g")).alias("found"))
    some = base.where(F.col("doc_id").isNotNull())  # the same exchange of texts serves every level and the result
    rep = _repeated(some.mapInArrow(first, schema))
    known = rep.where((F.col("k") < 0) | (F.col("doc_id") > F.col("lo"))).select("doc_id", F.when(F.col("k") < 0, 0).otherwise(-1).alias("level"), "g")  # at level -1 the hash of the whole text
    lists = materialize(listed(known), "repeats")
    gone = None
    for depth in range(1, len(steps)):
        alive = some.join(lists, "doc_id").select("doc_id", "text", "found")
        rep = _repeated(alive.mapInArrow(further(depth), schema))
        if depth == len(steps) - 1:
            gone = rep.where(F.col("doc_id") > F.col("lo")).select("doc_id", F.lit(0).alias("level"), "g")
        else:
            more = lists.select("doc_id", F.explode("found").alias("x")).select("doc_id", "x.level", "x.g").unionByName(rep.select("doc_id", F.lit(depth).alias("level"), "g"))
            lists = materialize(listed(more), "repeats")
    copies = lists.select("doc_id", F.explode("found").alias("x")).where("x.level < 0").select("doc_id", "x.level", "x.g")
    gone = copies if gone is None else gone.unionByName(copies)
    lone = base.where(F.col("doc_id").isNull()).withColumn("found", F.lit(None).cast("array<struct<level:int,g:bigint>>"))
    final = some.join(listed(gone), "doc_id", "left").select("doc_id", "text", "found").unionByName(lone)

    def keep(batches):
        import pyarrow as pa

        for batch in batches:
            found, text = batch.column("found"), batch.column("text").to_pylist()
            offs = np.asarray(found.offsets)
            level, g = (x.to_numpy(zero_copy_only=False) for x in found.values.flatten())
            n, cut, sha, kept = [], [], [], []
            for i, t in enumerate(text):
                words = (t or "").encode().split()
                a, b = (offs[i], offs[i + 1]) if found[i].is_valid else (0, 0)
                n.append(len(words))
                if b > a and len(words) >= window:
                    _, h, woff = next(_hashed(pa.array([t])))
                    if _copied(found.slice(i, 1), 0, h, woff)[0]:
                        words = []
                    else:
                        at = np.isin(windows_of(h, window), g[a:b][level[a:b] >= 0].view(np.uint64))
                        edge = np.zeros(len(words) + 1, np.int64)
                        edge[: len(at)] += at
                        edge[window : window + len(at)] -= at
                        out = np.cumsum(edge[:-1]) > 0
                        words = [w for w, x in zip(words, out, strict=True) if not x]
                cut.append(n[-1] - len(words))
                kept.append(b" ".join(words))
                sha.append(hashlib.sha256(kept[-1]).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(cut, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return final.mapInArrow(keep, f"doc_id {dict(base.dtypes)['doc_id']}, n_words long, n_removed long, kept_sha256 string, kept_text string")

