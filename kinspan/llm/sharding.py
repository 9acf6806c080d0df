"""Sharding by a k-d tree: nodes are split at distributed weighted medians along their widest metadata dimension."""

from __future__ import annotations

import heapq
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinspan.llm.common import materialize

BINS = 2048
EXACT = 2048  # so few groups of a node's cut bin are ranked one by one
FINE = 64  # a group of more than 1/FINE of a shard is placed before the tree is grown
DIMS = ("d_size", "d_id", "d_source", "d_lang")
SLOT_BUCKETS = 64
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _prefit(groups: DataFrame, total: int, shards: int) -> tuple[list, list[float]]:
    """Puts the heavy groups (at most shards * FINE of them) on the least loaded shard each; what each shard still gets."""
    limit = max(1, total // (shards * FINE))
    heavy = sorted(((-r.w, r.sha) for r in groups.where(F.col("w") > limit).select("w", "sha").collect()))
    heap = [(0, i) for i in range(shards)]
    load, put = [0] * shards, []
    for w, sha in heavy:
        have, i = heapq.heappop(heap)
        put.append((sha, i))
        load[i] = have - w
        heapq.heappush(heap, (load[i], i))
    rest, level = total - sum(load), 0.0
    low = sorted(load)
    for k in range(1, shards + 1):
        level = (rest + sum(low[:k])) / k
        if k == shards or level <= low[k]:
            break
    return put, [max(0.0, level - x) for x in load]


class _Node:
    """Shards lo to hi - 1: a leaf, or cut = (dimension, value, group hash) between two nodes."""

    def __init__(self, lo: int, hi: int):
        self.lo, self.hi, self.cut, self.parts = lo, hi, None, ()

    def leaves(self) -> list[_Node]:
        return [y for x in self.parts for y in x.leaves()] if self.parts else [self]

    def number(self, of: dict[int, int]) -> Column:
        """The number, by of, of the leaf that a row is in: one comparison for each cut on its way."""
        if not self.parts:
            return F.lit(of.get(self.lo, -1))
        dim, v, gh = self.cut
        left = (F.col(dim) < v) | ((F.col(dim) == v) & (F.col("gh") <= gh))
        return F.when(left, self.parts[0].number(of)).otherwise(self.parts[1].number(of))


def _split(groups: DataFrame, root: _Node, caps: list[float], span: dict) -> None:
    """One level: every leaf of two or more shards is split in two. Three or so small jobs, whatever the input's size."""
    live = [x for x in root.leaves() if x.hi - x.lo > 1]
    g = groups.withColumn("node", root.number({x.lo: i for i, x in enumerate(live)})).where(F.col("node") >= 0)
    stats = {r.node: r for r in g.groupBy("node").agg(F.sum("w").alias("w"), *[f(d).alias(f"{n}_{d}") for d in DIMS for n, f in (("lo", F.min), ("hi", F.max))]).collect()}
    todo, cut = {}, {}
    for i, x in enumerate(live):
        mid = (x.lo + x.hi) // 2
        s = stats.get(i)
        left, whole = sum(caps[x.lo : mid]), sum(caps[x.lo : x.hi])
        if s is None or whole <= 0:
            cut[i] = (DIMS[0], float("inf"), 0)
            continue
        d = max(DIMS, key=lambda k: ((s[f"hi_{k}"] - s[f"lo_{k}"]) / span[k] if span[k] else 0.0))
        todo[i] = {"dim": d, "lo": s[f"lo_{d}"], "hi": s[f"hi_{d}"], "glo": -(2**63), "ghi": 2**63 - 1, "need": s.w * left / whole, "n": None}
    while todo:
        small = {i: t for i, t in todo.items() if t["n"] is not None and t["n"] <= EXACT}
        big = {i: t for i, t in todo.items() if i not in small}
        value = lambda ts: reduce(lambda a, it: a.when(F.col("node") == it[0], F.col(it[1]["dim"])), ts.items(), F.when(F.lit(False), F.lit(0.0)))
        inside = lambda ts: reduce(lambda a, it: a | ((F.col("node") == it[0]) & F.col(it[1]["dim"]).between(it[1]["lo"], it[1]["hi"]) & F.col("gh").between(it[1]["glo"], it[1]["ghi"])), ts.items(), F.lit(False))
        if small:
            rows: dict[int, list] = {}
            for r in g.where(inside(small)).select("node", value(small).alias("v"), "gh", "w").collect():
                rows.setdefault(r.node, []).append((r.v, r.gh, r.w))
            for i, t in small.items():
                got, best, at = 0, abs(t["need"]), None
                for v, gh, w in sorted(rows.get(i, [])):
                    got += w
                    if abs(t["need"] - got) < best:
                        best, at = abs(t["need"] - got), (v, gh)
                v, gh = at or (t["lo"], t["glo"] - 1 if t["glo"] > -(2**63) else t["glo"])
                cut[i] = (t["dim"], v, gh)
                del todo[i]
        if big:
            bins = F.when(F.lit(False), F.lit(0))
            for i, t in big.items():
                if t["hi"] > t["lo"]:
                    b = F.least(F.lit(BINS - 1), F.floor((F.col(t["dim"]) - F.lit(t["lo"])) / F.lit((t["hi"] - t["lo"]) / BINS)))
                else:  # one value: go on by the group's hash
                    b = F.floor((F.col("gh").cast("decimal(20,0)") - F.lit(t["glo"]).cast("decimal(20,0)")) / F.lit(max(1, (t["ghi"] - t["glo"]) // BINS + 1)).cast("decimal(20,0)"))
                bins = bins.when(F.col("node") == i, b.cast("int"))
            hist: dict[int, list] = {}
            for r in g.where(inside(big)).select("node", bins.alias("b"), "w", "gh", value(big).alias("v")).groupBy("node", "b").agg(F.sum("w").alias("w"), F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.min("gh").alias("glo"), F.max("gh").alias("ghi")).collect():
                hist.setdefault(r.node, []).append(r)
            for i, t in big.items():
                got, ordered = 0, sorted(hist[i], key=lambda r: r.b)
                for r in ordered:
                    if got + r.w >= t["need"] or r is ordered[-1]:
                        break
                    got += r.w
                one = t["hi"] <= t["lo"]
                t |= {"lo": r.lo, "hi": r.hi, "need": t["need"] - got, "n": r.n}
                if one:
                    t |= {"glo": r.glo, "ghi": r.ghi}
    for i, x in enumerate(live):
        mid = (x.lo + x.hi) // 2
        x.cut, x.parts = cut[i], (_Node(x.lo, mid), _Node(mid, x.hi))


def kd_shards(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Deals all rows of docs (doc_id, text; source and lang where present) into shards of near-equal bytes.

    A row weighs the UTF-8 bytes of its text plus 8; rows of equal text stay in one shard. Returns doc_id, size,
    text_crc32, law, shard, slot, grown_shard. Null text counts as empty text; null ids, languages and sources are
    values of their own; ids that are no numbers are placed by their hash; repeated rows are rows; a very long text is one row
    that weighs what it has; ties at a cut go by the group's hash; an empty table gives no row; extra columns are ignored. A group of
    copies heavier than a shard's share fills a shard alone and the others share the rest evenly."""
    have = set(docs.columns)
    col = lambda name: F.col(name) if name in have else F.lit(None)
    text = F.coalesce(F.col("text"), F.lit(""))
    place = F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0)) if dict(docs.dtypes)["doc_id"] in NUMBERS else F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).cast("double")
    rows = materialize(docs.select("doc_id", place.alias("place"), (F.octet_length(text) + F.lit(8)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                                   F.unhex(F.sha2(text.cast("binary"), 256)).alias("sha"), F.crc32(F.coalesce(col("source").cast("string"), F.lit("")).cast("binary")).alias("src"), F.crc32(F.coalesce(col("lang").cast("string"), F.lit("")).cast("binary")).alias("lng")), "shard-rows")
    groups = materialize(rows.groupBy("sha").agg((F.count("*") * F.max("size")).alias("w"), F.log2(F.max("size").cast("double")).alias("d_size"), F.min("place").alias("d_id"),
                                                 F.min("src").cast("double").alias("d_source"), F.min("lng").cast("double").alias("d_lang")).withColumn("gh", F.xxhash64("sha")), "shard-groups")
    top = groups.agg(F.sum("w").alias("w"), *[(F.max(d) - F.min(d)).alias(d) for d in DIMS]).first()
    total = int(top.w or 0)
    put, caps = _prefit(groups, total, shards) if total else ([], [1.0] * shards)
    spark = docs.sparkSession
    fixed = spark.createDataFrame(put, "sha binary, fixed int")
    rest = groups.join(F.broadcast(fixed), "sha", "left_anti")
    root = _Node(0, shards)
    span = {d: float(top[d] or 0.0) for d in DIMS}
    while any(x.hi - x.lo > 1 for x in root.leaves()):
        _split(rest, root, caps, span)
    shard = F.coalesce(F.col("fixed"), root.number({i: i for i in range(shards)}))
    where = groups.join(F.broadcast(fixed), "sha", "left").select("sha", shard.alias("shard"))
    dealt = rows.join(where, "sha").withColumn("part", F.pmod(F.xxhash64("doc_id", "sha"), F.lit(SLOT_BUCKETS)))
    dealt = materialize(dealt.select("doc_id", "size", "text_crc32", "sha", "shard", "part"), "shard-dealt")
    first = dealt.groupBy("shard", "part").agg(F.count("*").alias("n"))  # at most shards * SLOT_BUCKETS rows
    first = first.select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before"))
    slot = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "sha")) - 1
    return dealt.withColumn("slot", slot).join(F.broadcast(first), ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), (F.col("slot") + F.col("before")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
