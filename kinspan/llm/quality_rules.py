"""Quality rules whose thresholds follow from mergeable quantile sketches per language and source. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinspan.llm.common import materialize
from kinspan.llm.native import let, runs, words

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # of 100 words
PRIOR_ROWS = 10  # rows that the quartiles of the merged sketch above weigh for, beside a group's own rows

#: Name, value (an integer) and the least spread that a fence allows for.
METRICS = {
    "symbols": (lambda: F.col("n_symbols") * 1000, 50),
    "dup_lines": (lambda: F.col("n_dup_lines") * 1000, 250),
    "repeats": (lambda: F.col("n_repeat_words") * 1000, 100),
    "word_chars": (lambda: F.col("word_chars") * 10, 15),
}


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of every row; a null text has none of these."""
    has = set(docs.columns)
    col = lambda c: F.col(c).cast("string") if c in has else F.lit(None).cast("string")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", col("lang").alias("lang"), col("source").alias("source"), words(text).alias("ws"),
                       F.octet_length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
                       F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    rows = rows.select("doc_id", "lang", "source", "n_symbols", F.size("ws").cast("long").alias("n_words"), F.length(F.array_join("ws", "")).cast("long").alias("word_chars"),
                       F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                       let(F.col("ws"), lambda ws: runs(ws, WINDOW, lambda x: F.xxhash64(*x))).alias("h"))

    def covered(by_hash: Column) -> Column:
        """Words in windows whose hash has an equal neighbour in by_hash, the sorted (hash, place)."""
        at = lambda k: F.get(by_hash, k)["h"]
        twice = F.filter(F.sequence(F.lit(0), F.size(by_hash) - 1), lambda k: F.coalesce(at(k) == at(k - 1), F.lit(False)) | F.coalesce(at(k) == at(k + 1), F.lit(False)))
        places = F.sort_array(F.transform(twice, lambda k: F.get(by_hash, k)["i"]))
        return let(places, lambda q: F.aggregate(F.sequence(F.lit(0), F.size(q) - 1), F.lit(0), lambda acc, k: acc + F.least(F.lit(WINDOW), F.coalesce(F.get(q, k + 1) - F.get(q, k), F.lit(WINDOW)))))

    again = F.when(F.size(F.array_distinct("h")) < F.size("h"), let(F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))), covered)).otherwise(0)
    return rows.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", again.cast("long").alias("n_repeat_words"))


def bin_of(v: Column) -> Column:
    """Bin of a value >= 0 in a log-linear histogram: exact below 32, else 16 bins for each doubling."""
    shift = F.greatest(F.lit(0), F.length(F.bin(v)) - 5)
    return (shift * 16 + F.floor(v / F.pow(F.lit(2.0), shift))).cast("int")


def edge_of(b: Column) -> Column:
    """The largest value of a bin."""
    shift = F.greatest(F.lit(0), F.floor(b / 16) - 1)
    return ((b - shift * 16 + 1) * F.pow(F.lit(2.0), shift) - 1).cast("long")


def thresholds(values: DataFrame) -> DataFrame:
    """(lang, source, metric, lo, hi) from values (lang, source, metric, v): fences around the quartiles of the group's sketch.

    A sketch is the counts of its bins, so sketches merge by adding: per language and source, per language, over all. A
    language's quartiles q1 and q3 are its sketch's own, weighed by its rows, and those over all, weighed as PRIOR_ROWS rows; a group's are its own and
    its language's in the same way: the fewer rows, the nearer to the wider sketch. The fences lie three times their distance
    (the metric's least spread, if that is more) outside of them."""
    spread = F.when(F.lit(False), 0)
    for name, (_, least) in METRICS.items():
        spread = spread.when(F.col("metric") == name, least)
    fine = values.groupBy("lang", "source", "metric", bin_of(F.col("v")).alias("b")).agg(F.count("*").alias("c"))
    fine = materialize(fine, "sketch")
    levels = [fine.withColumn("level", F.lit(0)), fine.groupBy("lang", "metric", "b").agg(F.sum("c").alias("c")).withColumn("level", F.lit(1)), fine.groupBy("metric", "b").agg(F.sum("c").alias("c")).withColumn("level", F.lit(2))]
    sketch = levels[0].unionByName(levels[1], allowMissingColumns=True).unionByName(levels[2], allowMissingColumns=True)
    group = Window.partitionBy("level", "lang", "source", "metric")
    upto = F.sum("c").over(group.orderBy("b"))
    cum = sketch.withColumn("upto", upto).withColumn("n", F.sum("c").over(group))
    at = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("n") * q, F.col("b")))
    q = cum.groupBy("level", "lang", "source", "metric").agg(F.max("n").alias("n"), edge_of(at(1)).alias("q1"), edge_of(at(3)).alias("q3"))
    groups = fine.select("lang", "source", "metric").distinct()
    l0, l1, l2 = (q.where(F.col("level") == i).select(*[F.col(c).alias(f"{c}{i}") for c in ("lang", "source", "metric", "n", "q1", "q3")]) for i in range(3))
    same = lambda c, i: F.col(c).eqNullSafe(F.col(f"{c}{i}"))
    out = groups.join(l0, same("lang", 0) & same("source", 0) & (F.col("metric") == F.col("metric0"))).join(l1, same("lang", 1) & (F.col("metric") == F.col("metric1"))).join(l2, F.col("metric") == F.col("metric2"))
    for level in (1, 0):
        out = out.withColumns({f"{q}{level}": F.expr(f"(n{level} * {q}{level} + {PRIOR_ROWS} * {q}{level + 1}) div (n{level} + {PRIOR_ROWS})") for q in ("q1", "q3")})
    far = 3 * F.greatest(F.col("q30") - F.col("q10"), spread)
    return out.select("lang", "source", "metric", (F.col("q10") - far).alias("lo"), (F.col("q30") + far).alias("hi"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Counts of every row of docs (doc_id, text; lang and source where present), and whether it passes the base rules and its group's thresholds.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept. Thresholds come from the
    rows that pass the base rules: symbols, repeated lines and repeated words in proportion must not lie above the upper
    fence, the mean length of words within both. Null and empty texts have no words and fail; null languages and sources are
    groups of their own; repeated rows count each; a very long text is one row like any other, held by one task; a value that lies on a fence passes; an
    empty table gives no row; other columns are ignored."""
    rows = text_counts(docs)
    rows = rows.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED))
    rows = materialize(rows, "counts")
    per = lambda name: F.floor(METRICS[name][0]() / F.when(F.lit(name == "dup_lines"), F.col("n_lines")).otherwise(F.col("n_words"))).cast("long")
    good = rows.where(~F.col("base_failed")).select("lang", "source", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), per(m).alias("v")) for m in METRICS])).alias("x")).select("lang", "source", "x.metric", "x.v")
    fences = thresholds(good).groupBy("lang", "source").agg(*[F.max(F.when(F.col("metric") == m, F.col(c))).alias(f"{c}_{m}") for m in METRICS for c in ("lo", "hi")])
    fences = fences.withColumnsRenamed({"lang": "__l", "source": "__s"})
    met = rows.join(fences, F.col("lang").eqNullSafe(F.col("__l")) & F.col("source").eqNullSafe(F.col("__s")), "left")
    fine = (per("word_chars") >= F.col("lo_word_chars")) & (per("word_chars") <= F.col("hi_word_chars"))
    for m in ("symbols", "dup_lines", "repeats"):
        fine = fine & (per(m) <= F.col(f"hi_{m}"))
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(F.coalesce(fine, F.lit(True)))
    return met.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))
