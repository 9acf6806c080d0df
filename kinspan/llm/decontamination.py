"""Benchmark decontamination: size-partitioned MinHash containment search, then exact shingle containment. DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinspan.llm.common import bounded, light, materialize, small
from kinspan.llm.native import let, runs, words


def _hash(ws: list[Column]) -> Column:
    return F.xxhash64(*ws)


def _text(ws: list[Column]) -> Column:
    """Words joined by a space each: words hold no space, so these are equal only for equal words."""
    return F.concat_ws(" ", *ws)


def item_shingles(text: Column, k: int, of: Callable[[list[Column]], Column]) -> Column:
    """of(words) for every k words of an item's text, or for all of its words if they are fewer; none for a text without words."""
    def each(ws: Column) -> Column:
        cases = [F.when(F.size(ws) >= k if m == k else F.size(ws) == m, runs(ws, m, of)) for m in range(k, 0, -1)]
        return F.coalesce(*cases, F.slice(runs(ws, k, of), 1, 0))

    return let(words(text), each)


def text_shingles(text: Column, sizes: list[int], of: Callable[[list[Column]], Column]) -> Column:
    """of(words) for every run of as many words as sizes say, wherever in the text."""
    return let(words(text), lambda ws: F.concat(*[runs(ws, m, of) for m in sizes]))


def sketches(items: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(part, limit, item_id, own, h): each item's least shingle hashes, as many as a document with num/den of its n shingles can't miss.

    Items are partitioned by the power of two of n. limit is the largest hash of a partition's sketches: a document's own
    sketch for that partition is what it has up to there."""
    h = items.select("item_id", "own", F.explode(F.array_distinct(item_shingles(F.col("text"), k, _hash))).alias("h")).distinct()
    w = Window.partitionBy("item_id", "own")
    h = h.withColumn("n", F.count("*").over(w)).withColumn("nth", F.row_number().over(w.orderBy("h")))
    h = materialize(h.where(F.col("nth") <= F.col("n") - F.ceil(F.col("n") * num / den) + 1).select(F.floor(F.log2("n")).cast("int").alias("part"), "item_id", "own", "h"), "sketches")
    return h.join(bounded(h.groupBy("part").agg(F.max("h").alias("limit")), 64), "part").select("part", "limit", "item_id", "own", "h")


def contaminated(docs: DataFrame, benchmark: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The pairs of a row of docs (doc_id, text) and an item of benchmark (item_id, text) with at least num/den of the item's k-word shingles in the whole text.

    Returns doc_id, text_hash, item_id, n_shingles, n_shared, containment: a row for each such pair, none for clean documents.
    Candidates share a value of the item's sketch; shingles decide as strings, not as hashes. An item of fewer than k words is one shingle, the whole
    sequence, and is found where a document holds it.

    Null or empty texts match nothing; very long texts are searched whole, by the hashes that items have. Repeated rows are reported once; rows that share
    a doc_id and differ in text are told apart by text_hash; a null doc_id is a value. Items that share an item_id are one
    item with the shingles of all; without an item_id each text is an item of its own. Equal hashes only add candidates. An empty table on either side
    gives no row. Other columns are ignored."""
    items = benchmark.select("item_id", F.when(F.col("item_id").isNull(), F.xxhash64("text")).otherwise(0).alias("own"), "text")
    known = materialize(sketches(items, k, num, den), "sketches")
    sizes = sorted(r.m for r in items.select(F.least(F.lit(k), F.size(words(F.col("text")))).alias("m")).distinct().collect() if r.m)  # k numbers at most
    limit = known.agg(F.max("h").alias("h")).first().h
    base = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    if limit is None:
        sizes, limit = [k], -(1 << 63)
    low = F.filter(text_shingles(F.col("text"), sizes, _hash), lambda h: h <= F.lit(limit))
    hits = base.select("doc_id", "text_hash", F.explode(low).alias("h")).join(small(known), "h")
    found = materialize(hits.where(F.col("h") <= F.col("limit")).select(F.col("doc_id").alias("__d"), F.col("text_hash").alias("__t"), "item_id", "own").distinct(), "candidates")
    met = base.join(small(found), F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("text_hash") == F.col("__t"))).select("doc_id", "text_hash", "text", "item_id", "own")
    whole = items.groupBy(F.col("item_id").alias("__i"), F.col("own").alias("__o")).agg(F.array_distinct(F.flatten(F.collect_list(item_shingles(F.col("text"), k, _text)))).alias("want"))
    whole = light(materialize(whole, "items"), F.aggregate("want", F.lit(0).cast("long"), lambda n, s: n + F.octet_length(s) + 16))
    met = met.join(whole, F.col("item_id").eqNullSafe(F.col("__i")) & (F.col("own") == F.col("__o")))
    met = met.select("doc_id", "text_hash", "item_id", "own", F.size("want").cast("long").alias("n_shingles"), F.size(F.array_intersect("want", text_shingles(F.col("text"), sizes, _text))).cast("long").alias("n_shared"))
    return met.where(F.col("n_shared") * den >= F.col("n_shingles") * num).distinct().drop("own").withColumn("containment", F.col("n_shared") / F.col("n_shingles"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of docs, with all their columns, that no item of benchmark is contained in; contaminated() says how odd rows are treated, and rows that it can't name (null or empty texts) stay."""
    bad = contaminated(docs, benchmark, **how).select(F.col("doc_id").alias("__d"), F.col("text_hash").alias("__t")).distinct()
    bad = small(materialize(bad, "contaminated"))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["__d"]) & (F.xxhash64(docs["text"]) == bad["__t"]), "left_anti")
