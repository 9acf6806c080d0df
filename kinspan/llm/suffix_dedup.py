"""Removal of repeated byte strings by a sparse, distributed enhanced suffix array and its common-prefix interval tree."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinspan.llm.common import byte_prefix, hot_cells, materialize, mix, span_hash, text_buffer

SEED = 40  # bytes of an anchor's own string
SEGMENT = 1 << 19
IN_TASK = 2048  # distinct contexts of one anchor string that one task sorts; larger groups are counted string by string

SPAN = "array<struct<s:int,e:int>>"
GIVEN = "CASE WHEN th & 1 = 0 THEN doc_id END AS doc_id"


def window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values: running minima forth and back over blocks of w."""
    n = len(x)
    m = -(-n // w) * w
    padded = np.full(m, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    forth = np.minimum.accumulate(padded.reshape(-1, w), axis=1).ravel()
    back = np.minimum.accumulate(padded.reshape(-1, w)[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], forth[w - 1 : n])


def anchors(col, length: int, seed: int = SEED):
    """Runs of string starts that share an anchor: the leftmost of the least-hashed `seed`-byte strings inside each `length`-byte string.

    Yields (row, first start, number of starts, anchor's place after the first start, hash of the anchor's bytes, hash of the
    run's bytes), places counted from the row's first byte. Strings that cross a row's end have no anchor."""
    buf, offs = text_buffer(col)
    buf = buf[offs[0] : offs[-1]]
    offs = offs - offs[0]
    w = length - seed + 1
    for a in range(0, max(0, len(buf) - length + 1), SEGMENT):
        b = buf[a : a + SEGMENT + length - 1]
        starts = len(b) - length + 1
        prefix = byte_prefix(b)
        at = np.arange(len(b) - seed + 1)
        h = span_hash(prefix, at, at + seed)
        best = window_min((h & ~np.uint64((1 << 20) - 1)) | at.astype(np.uint64), w)
        place = (best & np.uint64((1 << 20) - 1)).astype(np.int64)
        row = np.searchsorted(offs, a + np.arange(starts), side="right") - 1
        ok = a + np.arange(starts) + length <= offs[row + 1]
        new = np.ones(starts, bool)
        new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, starts))
        kept = np.add.reduceat(ok.astype(np.int64), first)  # the starts of a row that are still whole come first
        first, n = first[kept > 0], kept[kept > 0]
        if len(first):
            p = place[first]
            yield row[first], a + first - offs[row[first]], n, p - first, h[p], span_hash(prefix, first, first + n + length - 1)


def _once(row, s, n, off, g, c, length: int):
    """Runs that a row has several times over become one, marked, and ranges of the row (n = 0) that those cover.

    (row, s, e, n, off, g, c, many): so a text that repeats itself sends each of its strings but once."""
    order = np.lexsort((s, c, g, row))
    row, s, n, off, g, c = (x[order] for x in (row, s, n, off, g, c))
    e = s + n + length - 1
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (g[1:] != g[:-1]) | (c[1:] != c[:-1])
    times = np.diff(np.append(np.flatnonzero(first), len(row)))
    inside = np.repeat(times > 1, times)
    key = row[inside].astype(np.int64) << 32
    lo, hi = key | s[inside], key | e[inside]
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.ones(len(lo), bool)
    new[1:] = lo[1:] > hi[:-1]
    at = np.flatnonzero(new)
    last = hi[np.append(at[1:], len(hi)) - 1] if len(at) else hi
    low = (1 << 32) - 1
    zero = np.zeros(len(at), np.int64)
    return (np.concatenate([row[first], lo[at] >> 32]), np.concatenate([s[first], lo[at] & low]), np.concatenate([e[first], last & low]), np.concatenate([n[first], zero]), np.concatenate([off[first], zero]),
            np.concatenate([g[first], mix(lo[at].astype(np.uint64) + g[:1])]), np.concatenate([c[first], zero.astype(np.uint64)]), np.concatenate([times > 1, zero > 0]))


def _common(x: bytes, y: bytes) -> int:
    """Bytes that x and y start with alike."""
    n = min(len(x), len(y))
    diff = int.from_bytes(x[:n], "big") ^ int.from_bytes(y[:n], "big")
    return n - (diff.bit_length() + 7) // 8


def interval_tree(lcp: list[int], least: int):
    """Stack scan of the common prefixes of neighbours: every interval (first, last, depth) of two or more suffixes with depth >= least."""
    stack: list[tuple[int, int]] = []  # (depth, first)
    for i in range(1, len(lcp) + 2):
        depth = lcp[i - 1] if i <= len(lcp) else -1
        first = i - 1
        while stack and stack[-1][0] > depth:
            d, first = stack.pop()
            if d >= least and i - 1 > first:
                yield first, i - 1, d
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def repeats(left: list[bytes], right: list[bytes], length: int):
    """Maximal repeats of at least `length` bytes through an anchor, from its occurrences' bytes before (reversed) and after.

    right are the suffixes: they are sorted, and the intervals of their enhanced suffix array are scanned. An interval is
    extended to the left until its occurrences differ there: parts of it that go on alike are repeats of their own.
    Yields (occurrences, bytes before the anchor, bytes from the anchor on)."""
    sa = sorted(range(len(right)), key=right.__getitem__)
    lcp = [_common(right[x], right[y]) for x, y in zip(sa, sa[1:], strict=False)]
    rank = {x: i for i, x in enumerate(sorted(range(len(left)), key=left.__getitem__))}
    for first, last, depth in interval_tree(lcp, 1):
        inside = sorted(sa[first : last + 1], key=rank.__getitem__)
        before = [_common(left[x], left[y]) for x, y in zip(inside, inside[1:], strict=False)]
        for a, b, alike in interval_tree(before, max(0, length - depth)):
            group = inside[a : b + 1]
            deeper = b - a < last - first and len({right[x][: depth + 1] for x in group}) == 1 and all(len(right[x]) > depth for x in group)
            if not deeper:  # else the interval of the longer prefix gives it
                yield group, alike, depth


def _contexts(batches, length: int):
    import pyarrow as pa

    for batch in batches:
        want, texts = batch.column("want"), batch.column("text")
        offs = np.asarray(want.offsets)
        g, c, s, n, off, one, m = (x.to_numpy(zero_copy_only=False) for x in want.values.flatten())
        ids, ths, buf, at = batch.column("doc_id"), batch.column("th"), *text_buffer(texts)
        who = np.repeat(np.arange(len(ids)), np.diff(offs))
        base = offs[0]
        for a in range(0, len(who), 20000):
            part = slice(a, min(len(who), a + 20000))
            lo = at[who[part]] + s[base:][part]
            data = [bytes(buf[x:y]) for x, y in zip(lo, lo + n[base:][part] + length - 1, strict=True)]
            cols = [x[base:][part] for x in (g, c, s, n, off, one, m)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols] + [x.take(pa.array(who[part])) for x in (ids, ths)] + [pa.array(data, pa.binary())], names=["g", "c", "s", "n", "off", "one", "m", "doc_id", "th", "data"])


def _groups(batches):
    """The rows of each g, from batches sorted by g."""
    now, rows = None, []
    for batch in batches:
        for g, *rest in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if g != now and rows:
                yield now, rows
                rows = []
            now = g
            rows.append(rest)
    if rows:
        yield now, rows


def _anchored(docs: DataFrame, length: int) -> DataFrame:
    """The runs of docs (doc_id, th, text) that may repeat: doc_id, th, s, e, n, off, g (anchor), c (run), one (this run stands nowhere else), rep (the first such run), m (different runs with this anchor).

    n = 0: no run, but a range that a text's own repeated strings cover."""
    schema_id = dict(docs.dtypes)["doc_id"]

    def find(batches):
        import pyarrow as pa

        for batch in batches:
            ids, ths = batch.column("doc_id"), batch.column("th")
            for found in anchors(batch.column("text"), length):
                row, s, e, n, off, g, c, many = _once(*found, length)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), ths.take(pa.array(row)), pa.array(s.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(n.astype(np.int16)), pa.array(off.astype(np.int16)), pa.array(g.view(np.int64)), pa.array(c.view(np.int64)), pa.array(many)], names=["doc_id", "th", "s", "e", "n", "off", "g", "c", "many"])

    raw = materialize(docs.mapInArrow(find, f"doc_id {schema_id}, th long, s int, e int, n short, off short, g long, c long, many boolean"), "runs")
    runs, times = raw.where("n > 0"), F.sum(F.when(F.col("many"), 2).otherwise(1))
    hot = hot_cells(runs, "g")
    of_class = Window.partitionBy("g", "c")
    of_seed = Window.partitionBy("g")
    # one shuffle by g serves all three windows
    found = (runs if hot is None else runs.where(~hot)).repartition("g").withColumn("cnt", times.over(of_class)).withColumn("nth", F.row_number().over(of_class.orderBy("doc_id", "th", "s")))
    found = found.withColumn("m", F.sum((F.col("nth") == 1).cast("int")).over(of_seed)).withColumn("rep", F.col("nth") == 1)
    if hot is not None:
        # anchors that very many rows have go by partial sums and joins, which adaptive execution splits, not to one task
        often, place = runs.where(hot), F.struct("doc_id", "th", "s")
        kinds = often.groupBy("g", "c").agg(times.alias("cnt"), F.min(place).alias("first"))
        kinds = kinds.join(kinds.groupBy("g").agg(F.count("*").alias("m")), "g")
        found = found.drop("nth").unionByName(often.join(kinds, ["g", "c"]).withColumn("rep", place == F.col("first")).drop("first"))
    inside = raw.where("n = 0").withColumns({"cnt": F.lit(1), "m": F.lit(0), "rep": F.lit(False)})
    found = found.where("cnt > 1 or m > 1").drop("nth").unionByName(inside)
    return materialize(found.select("doc_id", "th", "s", "e", "n", "off", "g", "c", (F.col("cnt") == 1).alias("one"), "rep", "m"), "anchors")


def _held(docs: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """One of each of the different runs that share an anchor, with its bytes."""
    want = found.where("n > 0 and m > 1 and rep").groupBy("doc_id", "th").agg(F.collect_set(F.struct("g", "c", "s", "n", "off", "one", "m")).alias("want"))
    kind = dict(docs.dtypes)["doc_id"]
    return docs.join(want, ["doc_id", "th"]).select("doc_id", "th", "text", "want").mapInArrow(lambda x: _contexts(x, length), f"g long, c long, s int, n short, off short, one boolean, m long, doc_id {kind}, th long, data binary")


def _strings(held: DataFrame, length: int) -> DataFrame:
    """(h, k, doc_id, th, s, cnt): the strings of very frequent anchors that stand more than once, counted with a partial sum before the shuffle."""
    kind = dict(held.dtypes)["doc_id"]

    def each(batches):
        import pyarrow as pa

        for batch in batches:
            data, (off, s, n) = batch.column("data"), (batch.column(c).to_numpy() for c in ("off", "s", "n"))
            for i in range(batch.num_rows):
                b = np.frombuffer(data[i].as_buffer(), np.uint8)
                at = np.arange(n[i])
                p = byte_prefix(b)
                h = span_hash(p, at, at + length)
                k = span_hash(byte_prefix(b ^ np.uint8(0xA5)), at, at + length) >> np.uint64(33)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(k.astype(np.int32)), *[batch.column(c).take(pa.array(np.full(n[i], i))) for c in ("doc_id", "th")], pa.array((s[i] + at).astype(np.int32))], names=["h", "k", "doc_id", "th", "s"])

    single = held.where(F.col("m") > IN_TASK).mapInArrow(each, f"h long, k int, doc_id {kind}, th long, s int")
    return single.join(single.groupBy("h", "k").agg(F.count("*").alias("cnt")).where("cnt > 1"), ["h", "k"])


def _spans(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, th, s, e): byte ranges of the texts of docs (doc_id, th, text) that a repeated string covers, in pieces."""
    schema_id = dict(docs.dtypes)["doc_id"]
    found = _anchored(docs, length)
    whole = found.where((F.col("n") == 0) | ~F.col("one")).select("doc_id", "th", "s", "e")
    held = _held(docs, found, length)

    def scan(batches):
        import pyarrow as pa

        as_batch = lambda: pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.int32())], names=["doc_id", "th", "s", "e"])
        out: list[list] = [[], [], [], []]
        for _, rows in _groups(batches):
            left = [r[-1][: r[1]][::-1] for r in rows]
            right = [r[-1][r[1] :] for r in rows]
            best: dict[int, tuple[int, int]] = {}
            for group, before, after in repeats(left, right, length):
                for x in group:
                    b, a = best.get(x, (0, 0))
                    best[x] = max(b, before), max(a, after)
            for x, (before, after) in best.items():  # all of its repeats hold the anchor: together they are one range
                s, off, one, doc, th, _ = rows[x]
                if one:
                    for o, v in zip(out, (doc, th, s + off - before, s + off + after), strict=True):
                        o.append(v)
            if len(out[0]) > 20000:
                yield as_batch()
                out = [[], [], [], []]
        if out[0]:
            yield as_batch()

    sorted_rows = held.where(F.col("m") <= IN_TASK).select("g", "s", "off", "one", "doc_id", "th", "data").repartition("g").sortWithinPartitions("g")
    near = sorted_rows.mapInArrow(scan, f"doc_id {schema_id}, th long, s int, e int")

    hot = _strings(held, length).select("doc_id", "th", "s", (F.col("s") + F.lit(length)).cast("int").alias("e"))
    return whole.unionByName(near).unionByName(hot)


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, th, text): rows are known by id and hash of the text, whose lowest bit marks those without an id; GIVEN is the id as it was."""
    th, kind = F.xxhash64("text").bitwiseAND(F.lit(-2)), dict(docs.dtypes)["doc_id"]
    return docs.select(F.coalesce("doc_id", F.lit("0").cast(kind)).alias("doc_id"), th.bitwiseOR(F.col("doc_id").isNull().cast("long")).alias("th"), "text")


def suffix_dedup(docs: DataFrame, length: int = 200) -> DataFrame:
    """Removes from the UTF-8 bytes of every row of docs (doc_id, text) those covered by a `length`-byte string that also starts elsewhere.

    Every string has an anchor (see anchors), and equal strings have it at the same place, so the texts' suffixes at anchors
    are enough. They are dealt out by the anchor's bytes; runs that stand elsewhere as a whole are settled by their hash;
    for the others the bytes around the anchors are fetched and the interval tree of their suffix array is scanned.
    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (the ranges s to e - 1) and kept (the bytes that remain).

    Null text counts as empty; shorter rows lose nothing; repeated rows are each other's copies, whether or not they share
    a doc_id or have one; a very long text is one row, whose anchors are found piece by piece; of equally small anchors the leftmost counts; an
    empty table gives no row; other columns are ignored."""
    some = _keyed(docs)
    spans = _spans(some, length).groupBy("doc_id", "th").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    final = some.join(spans, ["doc_id", "th"], "left").selectExpr(GIVEN, "text", "spans")

    def keep(batches):
        import pyarrow as pa

        for batch in batches:
            spans, (buf, at) = batch.column("spans"), text_buffer(batch.column("text"))
            offs = np.asarray(spans.offsets)
            s, e = (x.to_numpy(zero_copy_only=False) for x in spans.values.flatten())
            valid = np.asarray(spans.is_valid())
            n, cut, runs, sha, ranges, kept = [], [], [], [], [], []
            for i in range(batch.num_rows):
                b = buf[at[i] : at[i + 1]]
                gone, at_s, at_e = 0, [], []
                if valid[i] and offs[i + 1] > offs[i]:
                    edge = np.zeros(len(b) + 1, np.int64)
                    np.add.at(edge, s[offs[i] : offs[i + 1]], 1)
                    np.add.at(edge, e[offs[i] : offs[i + 1]], -1)
                    out = np.cumsum(edge[:-1]) > 0
                    turn = np.flatnonzero(np.diff(np.concatenate(([0], out.astype(np.int8), [0]))))
                    gone, at_s, at_e = int(out.sum()), turn[::2], turn[1::2]
                    b = b[~out]
                n.append(int(at[i + 1] - at[i]))
                cut.append(gone)
                runs.append(len(at_s))
                ranges.append([{"s": int(x), "e": int(y)} for x, y in zip(at_s, at_e, strict=True)])
                kept.append(b.tobytes())
                sha.append(hashlib.sha256(kept[-1]).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(cut, pa.int64()), pa.array(runs, pa.int64()), pa.array(sha, pa.string()), pa.array(ranges, pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed", "kept"])

    return final.mapInArrow(keep, f"doc_id {dict(final.dtypes)['doc_id']}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed {SPAN}, kept binary")


def _starts(docs: DataFrame, spans: DataFrame, length: int) -> DataFrame:
    """(h, k, doc_id, th, s, before): a row for each string of `length` bytes inside spans (doc_id, th, spans); before is the byte that precedes it, -1 at a text's start."""
    kind = dict(docs.dtypes)["doc_id"]

    def each(batches):
        import pyarrow as pa

        for batch in batches:
            spans, (buf, at) = batch.column("spans"), text_buffer(batch.column("text"))
            for i in range(batch.num_rows):
                b = buf[at[i] : at[i + 1]]
                for x, y in _merged(spans[i].as_py()):
                    for a in range(x, y - length + 1, SEGMENT):
                        part = b[a : min(y, a + SEGMENT + length - 1)]
                        s = np.arange(len(part) - length + 1)
                        h = span_hash(byte_prefix(part), s, s + length)
                        k = span_hash(byte_prefix(part ^ np.uint8(0xA5)), s, s + length) >> np.uint64(33)
                        before = np.where(a + s > 0, b[a + s - 1], np.int16(-1)).astype(np.int16)
                        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(k.astype(np.int32)), *[batch.column(c).take(pa.array(np.full(len(s), i))) for c in ("doc_id", "th")], pa.array((a + s).astype(np.int32)), pa.array(before)], names=["h", "k", "doc_id", "th", "s", "before"])

    return docs.join(spans, ["doc_id", "th"]).select("doc_id", "th", "text", "spans").mapInArrow(each, f"h long, k int, doc_id {kind}, th long, s int, before short")


def _merged(spans: list[dict]) -> list[list[int]]:
    """The ranges (s, e), ascending, where those that touch are one."""
    out: list[list[int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def maximal_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """(repeat_id, n_bytes, doc_id, start): the groups of equal strings of at least `length` bytes that can't be longer, each with all its occurrences.

    Occurrences of a group differ in the byte before and in the byte after, or one of them ends there with its text. Every string
    that repeats is inside such a group; groups hold one another's parts where those stand more often, within a text as well.
    The strings of `length` bytes inside what suffix_dedup removes are dealt out by their hash. Only where the bytes before differ
    can a group start: there the suffixes are sorted and their common-prefix intervals scanned, in a task that holds places, not texts.
    The number of rows is that of the occurrences: for a text that is periodic it grows with the square of the periods.
    Rows are treated as suffix_dedup treats them."""
    some = _keyed(docs)
    kind = dict(some.dtypes)["doc_id"]
    spans = materialize(_spans(some, length).groupBy("doc_id", "th").agg(F.collect_set(F.struct("s", "e")).alias("spans")), "spans")
    starts = materialize(_starts(some, spans, length), "starts")
    heads = starts.groupBy("h", "k").agg(F.count("*").alias("cnt"), F.min("before").alias("lo"), F.max("before").alias("hi")).where("cnt > 1 and (lo < 0 or lo < hi)")
    want = starts.join(heads.select("h", "k"), ["h", "k"]).groupBy("doc_id", "th").agg(F.collect_set(F.struct("h", "k", "s", "before")).alias("want"))

    def suffixes(batches):
        import pyarrow as pa

        names = ["h", "k", "doc_id", "s", "before", "data"]
        for batch in batches:
            (buf, at), ids = text_buffer(batch.column("text")), batch.column("doc_id")
            for i in range(batch.num_rows):
                ranges = _merged(batch.column("spans")[i].as_py())
                first, ends = np.array([x for x, _ in ranges]), [y for _, y in ranges]
                rows, have = [], 0
                as_batch = lambda: pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), ids.take(pa.array([i] * len(rows))), *[pa.array([r[j] for r in rows], t) for j, t in ((2, pa.int32()), (3, pa.int16()), (4, pa.binary()))]], names=names)  # noqa: B023, E731
                for w in batch.column("want")[i].as_py():
                    end = ends[int(np.searchsorted(first, w["s"], side="right")) - 1]
                    rows.append((w["h"], w["k"], w["s"], w["before"], bytes(buf[at[i] + w["s"] : at[i] + end])))
                    have += len(rows[-1][-1])
                    if have > SEGMENT:
                        yield as_batch()
                        rows, have = [], 0
                if rows:
                    yield as_batch()

    found = some.join(want, ["doc_id", "th"]).join(spans, ["doc_id", "th"]).selectExpr(GIVEN, "text", "spans", "want")
    found = found.mapInArrow(suffixes, f"h long, k int, doc_id {kind}, s int, before short, data binary")

    def scan(batches):
        import pyarrow as pa

        names, id_type = ["h", "k", "no", "n_bytes", "doc_id", "start"], None
        now, last, ids, at, before, lcp = None, b"", [], [], [], []

        def groups():
            no, left, places, who = 0, np.array(before), np.array(at, np.int32), pa.array(ids, id_type)
            for a, b, depth in interval_tree(lcp, length):
                if 0 <= left[a : b + 1].min() == left[a : b + 1].max():  # goes on alike to the left: part of a longer group
                    continue
                n = b - a + 1
                full = lambda x, t: pa.array(np.full(n, x), t)  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([full(now[0], pa.int64()), full(now[1], pa.int32()), full(no, pa.int32()), full(depth, pa.int32()), who.slice(a, n), pa.array(places[a : b + 1])], names=names)
                no += 1

        for batch in batches:
            id_type = batch.column("doc_id").type
            for h, k, doc, s, prev, data in zip(*[batch.column(c).to_pylist() for c in ("h", "k", "doc_id", "s", "before", "data")], strict=True):
                if (h, k) != now:
                    if len(ids) > 1:
                        yield from groups()
                    now, last, ids, at, before, lcp = (h, k), data, [], [], [], []
                else:
                    lcp.append(_common(last, data))
                    last = data
                ids.append(doc)
                at.append(s)
                before.append(prev)
        if len(ids) > 1:
            yield from groups()

    out = found.repartition("h", "k").sortWithinPartitions("h", "k", "data").mapInArrow(scan, f"h long, k int, no int, n_bytes int, doc_id {kind}, start int")
    return out.select(F.xxhash64("h", "k", "no").alias("repeat_id"), "n_bytes", "doc_id", "start")
