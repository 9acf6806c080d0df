"""The whole linkage: training and choosing thresholds, and inference to the two result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinspan.operators.blocking import generate_candidates
from kinspan.operators.decide import apply_thresholds, best_threshold, optimize_threshold, threshold_grid
from kinspan.operators.evaluate import blocking_quality, error_examples, macro_f_beta
from kinspan.operators.features import FEATURES, compute_features
from kinspan.operators.labels import grouped_split, label_candidates, truth_pairs
from kinspan.operators.lineage import cut
from kinspan.operators.models import BASELINES, fit_gbt, score_pairs
from kinspan.operators.output import enforce_valid, output_frame
from kinspan.schema import PAIR, BlockingConfig, ThresholdConfig


def run_pipeline(s1: DataFrame, s2: DataFrame, s3: DataFrame, model, thresholds: ThresholdConfig = ThresholdConfig(), cfg: BlockingConfig = BlockingConfig()) -> dict[str, DataFrame]:
    """candidates, scored, matching_results and candidate_pairs of three tables of records; model as score_pairs takes it."""
    required = s1.select(F.col("entity_id").alias(PAIR[0]))
    others = s2.unionByName(s3)
    candidates = cut(generate_candidates(s1, s2, s3, cfg=cfg))
    scored = score_pairs(compute_features(candidates, s1, others), model)
    matched = enforce_valid(apply_thresholds(scored, thresholds), candidates, others.select("entity_id"))
    return {"candidates": candidates, "scored": scored, "matching_results": output_frame(matched, required, "matched_entity_ids"), "candidate_pairs": output_frame(candidates, required, "candidate_entity_ids")}


def baseline_sweep(features: DataFrame, truth: DataFrame, entities: DataFrame) -> DataFrame:
    """(model, threshold, macro metrics): the best threshold of every baseline, found in one pass over all."""
    each = F.array(*[F.struct(F.lit(name).alias("model"), score().cast("double").alias("score")) for name, score in BASELINES.items()])
    scored = features.select(*PAIR, F.explode(each).alias("x")).select("x.model", *PAIR, "x.score")
    return best_threshold(threshold_grid(scored, truth, entities, by=("model",)), ("model",))


def train(s1: DataFrame, s2: DataFrame, s3: DataFrame, truth: DataFrame, rounds: int = 400, cfg: BlockingConfig = BlockingConfig()) -> dict:
    """Fits boosted trees on the training split and chooses the threshold on the other; all that the run reports, by name."""
    ids = s1.select(F.col("entity_id").alias(PAIR[0]))
    others = s2.unionByName(s3)
    pairs = truth_pairs(truth, ids).persist()
    split = grouped_split(ids).persist()
    candidates = generate_candidates(s1, s2, s3, cfg=cfg).persist()
    labelled = label_candidates(compute_features(candidates, s1, others), pairs, split).persist()
    val = labelled.where("split = 'val'")
    entities = split.where("split = 'val'").select(PAIR[0])
    val_truth = pairs.join(entities, PAIR[0], "left_semi")
    model = fit_gbt(labelled.where("split = 'train'").select(*FEATURES, "label"), val.select(*FEATURES, "label"), rounds)
    scored = score_pairs(val, model).persist()
    best, grid = optimize_threshold(scored, val_truth, entities)
    accepted = apply_thresholds(scored, best)
    return {"model": model, "thresholds": best, "grid": grid, "blocking_quality": blocking_quality(candidates, pairs, ids, others), "baselines": baseline_sweep(val, val_truth, entities),
            "metrics": macro_f_beta(accepted, val_truth, entities), "errors": error_examples(accepted, val_truth, s1.unionByName(others)), "label_counts": labelled.groupBy("label").count()}
