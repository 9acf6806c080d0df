"""Precision-weighted F for each S1 record, macro averages, blocking quality and errors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinspan.schema import PAIR

BETA = 0.5


def entity_scores(counts: DataFrame) -> DataFrame:
    """precision, recall and f_beta from n_pred, n_true and tp.

    Nothing predicted where nothing is true is right; anything predicted there is wrong, with a recall of 1; nothing
    predicted where something is true is 0 throughout."""
    p, t, hit = F.col("n_pred"), F.col("n_true"), F.col("tp")
    precision = F.when((t == 0) & (p == 0), 1.0).when((t == 0) | (p == 0), 0.0).otherwise(hit / F.greatest(p, F.lit(1)))
    recall = F.when(t == 0, 1.0).when(p == 0, 0.0).otherwise(hit / F.greatest(t, F.lit(1)))
    b = BETA * BETA
    return counts.withColumn("precision", precision).withColumn("recall", recall).withColumn(
        "f_beta", F.when((p == 0) & (t == 0), 1.0).when(hit == 0, 0.0).otherwise((1 + b) * F.col("precision") * F.col("recall") / F.greatest(b * F.col("precision") + F.col("recall"), F.lit(1e-300))))


def f_beta_per_entity(predicted: DataFrame, truth: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """A row for each entity (default: all that occur) with n_pred, n_true, tp, precision, recall, f_beta; predicted and truth are pairs."""
    predicted, truth = predicted.select(*PAIR).distinct(), truth.select(*PAIR).distinct()
    if entities is None:
        entities = predicted.select(PAIR[0]).union(truth.select(PAIR[0]))
    both = predicted.withColumn("p", F.lit(1)).join(truth.withColumn("t", F.lit(1)), PAIR, "full")
    counts = both.groupBy(PAIR[0]).agg(F.count("p").alias("n_pred"), F.count("t").alias("n_true"), F.count(F.col("p") + F.col("t")).alias("tp"))
    return entity_scores(entities.select(PAIR[0]).distinct().join(counts, PAIR[0], "left").fillna(0, ["n_pred", "n_true", "tp"]))


def macro_f_beta(predicted: DataFrame, truth: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    return f_beta_per_entity(predicted, truth, entities).agg(F.count("*").alias("n_entities"), F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"), F.avg("f_beta").alias("macro_f_beta"))


def blocking_quality(candidates: DataFrame, truth: DataFrame, entities: DataFrame, n_others: int | DataFrame | None = None) -> DataFrame:
    """One row: how many true pairs candidates hold, candidates per entity (over entities that have any), and the reduction ratio.

    n_others: how many S2 and S3 records there are, or a table of them."""
    per = f_beta_per_entity(candidates, truth, entities)
    got = F.when(F.col("n_pred") > 0, F.col("n_pred"))
    out = per.agg(F.count("*").alias("n_source1_entities"), F.count_if(F.col("n_true") > 0).alias("entities_with_truth"), F.sum("n_true").alias("true_matches_total"), F.sum("tp").alias("true_matches_recovered"),
                  F.count_if(F.col("n_pred") == 0).alias("zero_candidate_entities"), F.coalesce(F.avg(got), F.lit(0.0)).alias("avg_candidates_per_entity"), F.coalesce(F.max(got), F.lit(0)).alias("max_candidates_per_entity"), F.sum("n_pred").alias("total_candidate_pairs"))
    out = out.withColumn("candidate_recall", F.when(F.col("true_matches_total") > 0, F.col("true_matches_recovered") / F.col("true_matches_total")))
    if n_others is None:
        return out
    many = n_others.agg(F.count("*").alias("n_others")) if isinstance(n_others, DataFrame) else candidates.sparkSession.range(1).select(F.lit(n_others).alias("n_others"))
    return out.crossJoin(F.broadcast(many)).withColumn("reduction_ratio", 1 - F.col("total_candidate_pairs") / (F.col("n_source1_entities") * F.col("n_others"))).drop("n_others")


def false_positives(predicted: DataFrame, truth: DataFrame) -> DataFrame:
    return predicted.select(*PAIR).distinct().join(truth.select(*PAIR), PAIR, "left_anti")


def false_negatives(predicted: DataFrame, truth: DataFrame) -> DataFrame:
    return false_positives(truth, predicted)


def describe(pairs: DataFrame, records: DataFrame, limit: int | None = 30) -> DataFrame:
    """The first pairs by their ids with both records' names and addresses ("" where a record is unknown)."""
    first = pairs.orderBy(*PAIR).limit(limit) if limit else pairs
    side = lambda key, name: records.select(F.col("entity_id").alias(key), F.col("business_name").alias(f"{name}_name"), F.col("business_address").alias(f"{name}_address"))
    out = first.join(side(PAIR[0], "s1"), PAIR[0], "left").join(side(PAIR[1], "other"), PAIR[1], "left")
    return out.select(*PAIR, "s1_name", "s1_address", "other_name", "other_address").fillna("")


def error_examples(predicted: DataFrame, truth: DataFrame, records: DataFrame, limit: int | None = 30) -> DataFrame:
    """describe() of false positives and false negatives, told apart by `kind`."""
    return describe(false_positives(predicted, truth), records, limit).withColumn("kind", F.lit("false_positive")).unionByName(describe(false_negatives(predicted, truth), records, limit).withColumn("kind", F.lit("false_negative")))
