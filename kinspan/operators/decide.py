"""From scores to predicted matches, and the search for the best threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinspan.operators.evaluate import entity_scores
from kinspan.schema import PAIR, ThresholdConfig

GRID = tuple(round(0.05 * i, 2) for i in range(1, 20))


def apply_thresholds(scored: DataFrame, cfg: ThresholdConfig = ThresholdConfig()) -> DataFrame:
    """Accepted pairs (ids, score): those of a record whose best score reaches the abstention threshold."""
    best = F.max("score").over(Window.partitionBy(PAIR[0]))
    return scored.select(*PAIR, "score").withColumn("best", best).where((F.col("best") >= cfg.singleton_abstain_threshold) & (F.col("score") >= cfg.accept_threshold)).drop("best")


def predictions_at(scored: DataFrame, threshold: float) -> DataFrame:
    """(source1_entity_id, predicted: sorted ids) of records with a pair of at least this score."""
    return scored.where(F.col("score") >= threshold).groupBy(PAIR[0]).agg(F.array_sort(F.collect_set(PAIR[1])).alias("predicted"))


def threshold_grid(scored: DataFrame, truth: DataFrame, entities: DataFrame, grid: tuple[float, ...] = GRID, by: tuple[str, ...] = ()) -> DataFrame:
    """Macro metrics of accepting at each threshold of grid (abstaining at the same), for each value of the columns by.

    truth: distinct pairs; entities: the ids (source1_entity_id) that count. One aggregation gives all thresholds: a pair
    counts for each threshold up to its score; thresholds are few, whatever the input's size."""
    steps = F.array(*[F.lit(t) for t in grid])
    hit = scored.select(*by, *PAIR, "score").dropDuplicates([*by, *PAIR]).join(truth.select(*PAIR).distinct().withColumn("hit", F.lit(1)), PAIR, "left")
    counts = hit.withColumn("threshold", F.explode(F.filter(steps, lambda t: t <= F.col("score")))).groupBy(*by, "threshold", PAIR[0]).agg(F.count("*").alias("n_pred"), F.count("hit").alias("tp"))
    wanted = truth.select(*PAIR).distinct().groupBy(PAIR[0]).agg(F.count("*").alias("n_true"))
    base = entities.select(PAIR[0]).distinct().join(wanted, PAIR[0], "left").withColumn("threshold", F.explode(steps))
    if by:
        base = base.crossJoin(F.broadcast(scored.select(*by).distinct()))
    full = base.join(counts, [*by, "threshold", PAIR[0]], "left").fillna(0, ["n_pred", "n_true", "tp"])
    return entity_scores(full).groupBy(*by, "threshold").agg(F.count("*").alias("n_entities"), F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"), F.avg("f_beta").alias("macro_f_beta"))


def best_threshold(grid: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The row of the best macro F (rounded to 12 digits) of a grid, the lowest threshold among equals."""
    order = Window.partitionBy(*by).orderBy(F.desc(F.round("macro_f_beta", 12)), "threshold")
    return grid.withColumn("r", F.row_number().over(order)).where("r = 1").drop("r")


def optimize_threshold(scored: DataFrame, truth: DataFrame, entities: DataFrame, grid: tuple[float, ...] = GRID) -> tuple[ThresholdConfig, DataFrame]:
    table = threshold_grid(scored, truth, entities, grid)
    row = best_threshold(table).first()
    return (ThresholdConfig(row.threshold, row.threshold) if row else ThresholdConfig()), table
