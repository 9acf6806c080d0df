"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinspan.llm.common import bounded, materialize, n_words, small

BINS = 1 << 13  # of the rank keys of a source
MOST = 3  # times that a document, and so a source, may be taken
#: Columns of our own beside the callers' ones.
SIZE, HASH, COPIES, PLAN = "__kinspan_size", "__kinspan_hash", "__kinspan_copies", "__kinspan_plan_"


def targets(sizes: list[tuple[str | None, int]], weights: tuple[float, ...] = (1, 2, 3), most: int = MOST) -> dict[str | None, float]:
    """Target of each source: its weight's share of all sizes, at most `most` times its size, the excess shared anew.

    Sources stand in code-point order with null last; weights repeat along that order."""
    order = sorted(sizes, key=lambda s: (s[0] is None, (s[0] or "").encode()))
    w = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size, total, capped = dict(order), float(sum(n for _, n in order)), set()
    while True:
        free = [s for s in w if s not in capped]
        share = sum(w[s] for s in free)
        level = (total - sum(most * size[s] for s in capped)) / share if share else 0.0
        over = {s for s in free if level * w[s] > most * size[s]}
        if not over:
            return {s: float(most * size[s]) if s in capped else level * w[s] for s in w}
        capped |= over


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    """docs with the columns that a row's copies follow from, under names that docs does not have."""
    return docs.withColumns({SIZE: n_words(F.col("text")), HASH: F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))})


def _drawn(lam: Column) -> tuple[Column, Column]:
    """(inclusion probability, rank key) of a row with SIZE and HASH, for its source's factor.

    The probability grows with the square root of the size's power of two, so that short documents are left to close a gap with. The rank key is the odds of a number in (0, 1) that follows from HASH over the odds of the probability."""
    p = F.when(F.col(SIZE) > 0, F.least(F.lit(1.0), lam * F.pow(F.lit(2.0), F.length(F.bin(SIZE)) / 2)))
    u = (F.shiftrightunsigned(F.xxhash64(HASH), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return p, F.when((p > 0) & (p < 1), (u / (1 - u)) / (p / (1 - p)))


def mix_plan(rows: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """From rows (source, SIZE, HASH) what decides on the rows of each source: (source_key, source_size, target, whole, lam, cut, last, drop), a row for each source.

    Every row gets `whole` copies, floor(target / source size). For the words still needed, rows have inclusion probabilities that
    lam makes sum up to them; rows whose probability reaches 1 are certain. The others are ranked by the Pareto key and taken up to `cut`,
    the words still needed; the gap at the end is closed by one row more (`last`), or by one in place of another (`drop`), whichever comes
    nearest. Rows that repeat both id and text share a key and are taken together. Sources, as they have to be put in order, are a row each on the driver."""
    spark = rows.sparkSession
    units = rows.groupBy("source", SIZE, HASH).agg(F.count("*").alias("c")).withColumn("words", F.col("c") * F.col(SIZE))
    units = materialize(units, "mix-units")
    sizes = [(r.source, int(r.n)) for r in units.groupBy("source").agg(F.sum("words").alias("n")).collect()]
    goal = targets(sizes, weights, most)
    plan = []
    for s, n in sizes:
        whole = min(most, int(goal[s] / n + 1e-12)) if n else 0
        plan.append((s, n, goal[s], whole, max(0.0, goal[s] - whole * n) if whole < most else 0.0))
    plan_df = bounded(spark.createDataFrame(plan, "source_key string, source_size long, target double, whole int, need double"), len(plan))
    keyed = lambda rows, by: rows.join(bounded(by, len(plan)), rows["source"].eqNullSafe(by["source_key"]))
    # lam: classes of size in the order of their probabilities; those before the first that stays below 1 are certain
    classes = units.where(F.col(SIZE) > 0).groupBy("source", F.length(F.bin(SIZE)).alias("b")).agg(F.sum("words").alias("words")).withColumn("weighed", F.col("words") * F.pow(F.lit(2.0), F.col("b") / 2))
    upto, rest = Window.partitionBy("source").orderBy(F.desc("b")), Window.partitionBy("source").orderBy("b")
    classes = keyed(classes.withColumn("before", F.sum("words").over(upto) - F.col("words")).withColumn("after", F.sum("weighed").over(rest)), plan_df)
    classes = classes.withColumn("lam", F.greatest(F.lit(0.0), F.col("need") - F.col("before")) / F.col("after")).where(F.col("lam") * F.pow(F.lit(2.0), F.col("b") / 2) < 1)
    lam = classes.groupBy("source_key").agg(F.max_by("lam", "b").alias("lam"))
    no = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    both = plan_df.alias("p").join(lam.alias("l"), F.col("p.source_key").eqNullSafe(F.col("l.source_key")), "left")
    plan_df = materialize(both.select("p.*", F.when(F.col("need") > 0, no("lam")).otherwise(0.0).alias("lam")), "mix-plan")
    p, x = _drawn(F.col("lam"))
    drawn = keyed(units, plan_df).withColumn("p", p).withColumn("x", x).where("p > 0")
    drawn = materialize(drawn.select("source_key", "need", "words", HASH, "p", "x", F.when(F.col("x").isNotNull(), F.least(F.lit(BINS - 1), F.floor(F.col("x") / (1 + F.col("x")) * BINS))).cast("int").alias("bin")), "mix-drawn")
    hist = drawn.groupBy("source_key", "bin").agg(F.sum("words").alias("words"), F.max("need").alias("need"))  # certain rows have no bin and come first
    hist = hist.withColumn("upto", F.sum("words").over(Window.partitionBy("source_key").orderBy(F.asc_nulls_first("bin"))))
    edge = hist.where("bin is not null and upto > need and upto - words <= need").select(F.col("source_key").alias("k"), F.col("bin").alias("b"), (F.col("upto") - F.col("words")).alias("before"))
    near = drawn.join(bounded(edge, len(plan)), F.col("source_key").eqNullSafe(F.col("k")) & (F.col("bin") == F.col("b")))
    near = near.withColumn("upto", F.col("before") + F.sum("words").over(Window.partitionBy("source_key").orderBy("x")))  # ties are taken together
    top = near.groupBy("source_key", "b").agg(F.max(F.when(F.col("upto") <= F.col("need"), F.col("x"))).alias("x"))
    # no row of the edge's bin fits: the cut is where that bin begins; no edge: all rows are taken
    cuts = top.select(F.col("source_key").alias("k"), F.coalesce("x", F.col("b") / F.lit(float(BINS)) / (1 - F.col("b") / F.lit(float(BINS))) - F.lit(1e-12)).alias("cut"))
    cuts = materialize(cuts, "mix-cuts")
    tried = drawn.join(bounded(cuts, len(plan)), F.col("source_key").eqNullSafe(F.col("k")), "left").withColumn("in", F.col("x").isNull() | F.col("cut").isNull() | (F.col("x") <= F.col("cut")))
    gap = tried.groupBy("source_key").agg((F.max("need") - F.sum(F.when(F.col("in"), F.col("words")).otherwise(0))).alias("gap"))
    # one row for each size in and out of the sample; a size of 0 stands for no row at all
    out_, in_ = (tried.where(c).groupBy("source_key", "words").agg(F.min(HASH).alias("h")).unionByName(gap.select("source_key", F.lit(0).cast("long").alias("words"), F.lit(None).cast("long").alias("h"))).withColumn("in", F.lit(v)) for v, c in ((False, ~F.col("in")), (True, F.col("in") & F.col("x").isNotNull())))
    both = out_.unionByName(in_).join(bounded(gap.withColumnRenamed("source_key", "g"), len(plan)), F.col("source_key").eqNullSafe(F.col("g")))
    both = both.withColumn("at", F.when(F.col("in"), F.col("words")).otherwise(F.col("words") - F.col("gap")))
    row = F.when(F.col("in"), F.struct("words", "h"))
    w = Window.partitionBy("source_key").orderBy("at", "in")
    both = both.withColumn("lo", F.last(row, True).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("hi", F.first(row, True).over(w.rowsBetween(0, Window.unboundedFollowing)))
    swap = lambda c: F.struct(F.round(F.abs(F.col("at") - F.col(f"{c}.words")), 6).alias("off"), F.col(f"{c}.words").alias("less"), F.col("h").alias("last"), F.col(f"{c}.h").alias("drop"))
    best = both.where(~F.col("in")).groupBy(F.col("source_key").alias("s")).agg(F.min(F.least(*[F.when(F.col(c).isNotNull(), swap(c)) for c in ("lo", "hi")])).alias("best"))
    out = plan_df.join(cuts, F.col("source_key").eqNullSafe(F.col("k")), "left").join(best, F.col("source_key").eqNullSafe(F.col("s")), "left")
    return materialize(out.select("source_key", "source_size", "target", "whole", "lam", "cut", "best.last", "best.drop"), "mix-decided")


def _copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """rows (source, SIZE, HASH, ...) with COPIES and the plan's columns, in their own partitions: the plan has a row for each source."""
    plan = plan.withColumnsRenamed({c: f"{PLAN}{c}" for c in plan.columns})
    of = lambda c: F.col(f"{PLAN}{c}")
    p, x = _drawn(of("lam"))
    taken = (p >= 1) | ((p > 0) & (of("cut").isNull() | (x <= of("cut")))) | (F.col(HASH) == of("last"))
    taken = F.coalesce(taken, F.lit(False)) & ~F.coalesce(F.col(HASH) == of("drop"), F.lit(False))
    rows = rows.join(small(plan), F.col("source").eqNullSafe(of("source_key")))
    return rows.withColumn(COPIES, of("whole") + taken.cast("int"))


def pareto_mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: int = MOST, seed: int = 17) -> DataFrame:
    """Decides how often each row of docs (doc_id, text, source) is taken so that each source comes near its target; see mix_plan().

    Returns doc_id, size, source_size, target, taken, copies, row_hash, source. Null text and text without words have size 0 and
    are taken in whole copies of 0 words; null source is a source, and so is a null id an id; a very long text counts with all its words;
    repeated rows count each and are taken alike; equal rank keys are taken together; an empty table gives no row; extra columns are ignored."""
    sized = materialize(_sized(docs.select("doc_id", "text", "source"), seed).drop("text"), "mix-rows")
    rows = _copies(sized, mix_plan(sized, weights, most))
    return rows.select("doc_id", F.col(SIZE).alias("size"), F.col(f"{PLAN}source_size").alias("source_size"), F.col(f"{PLAN}target").alias("target"), (F.col(COPIES) * F.col(SIZE)).cast("long").alias("taken"), F.col(COPIES).alias("copies"), F.col(HASH).alias("row_hash"), "source")


def take(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: int = MOST, seed: int = 17) -> DataFrame:
    """The rows of docs, with all their columns, each as often as pareto_mix decides, which says how odd rows are treated. No text is shuffled."""
    plan = mix_plan(_sized(docs.select("doc_id", "text", "source"), seed).drop("text"), weights, most)
    rows = _copies(_sized(docs, seed), plan).where(F.col(COPIES) > 0)
    return rows.withColumn(COPIES, F.explode(F.sequence(F.lit(1), F.col(COPIES)))).select(*[f"`{c}`" for c in docs.columns])
