import pytest

from kinspan.operators import decide, evaluate, labels, output
from kinspan.schema import ThresholdConfig

P = "source1_entity_id string, candidate_entity_id string"


def pairs(spark, *rows):
    return spark.createDataFrame(list(rows), P)


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "source1_entity_id string")


def per(spark, predicted, truth, entities=None):
    got = evaluate.f_beta_per_entity(pairs(spark, *predicted), pairs(spark, *truth), None if entities is None else ids(spark, *entities))
    return {r.source1_entity_id: (r.precision, r.recall, r.f_beta) for r in got.collect()}


def test_singletons_and_misses(spark):
    got = per(spark, [("b", "x")], [("c", "x"), ("c", "y")], ["a", "b", "c"])
    assert got == {"a": (1, 1, 1), "b": (0, 1, 0), "c": (0, 0, 0)}


def test_worked_example(spark):
    p, r, f = per(spark, [("e", "S2-00047"), ("e", "S2-00193"), ("e", "S3-00812")], [("e", "S2-00047"), ("e", "S3-00812")])["e"]
    assert (p, r) == (pytest.approx(2 / 3), 1) and f == pytest.approx(0.714, abs=1e-3)


def test_macro_counts_missing_entities(spark):
    row = evaluate.macro_f_beta(pairs(spark, ("S1-1", "S2-1")), pairs(spark, ("S1-1", "S2-1")), ids(spark, "S1-1", "S1-2")).first()
    assert (row.n_entities, row.macro_f_beta) == (2, 1)


def test_thresholds_abstain(spark):
    s = spark.createDataFrame([("a", "x", 0.7), ("a", "y", 0.55), ("b", "x", 0.55)], P + ", score double")
    got = lambda c: {(r[0], r[1]) for r in decide.apply_thresholds(s, c).collect()}
    assert got(ThresholdConfig(0.5, 0.6)) == {("a", "x"), ("a", "y")}
    assert got(ThresholdConfig(0.6, 0.5)) == {("a", "x")}
    assert got(ThresholdConfig(0.8, 0.8)) == set()


def test_the_lowest_of_equal_thresholds_wins(spark):
    s = spark.createDataFrame([("a", "x", 0.7), ("b", "z", 0.12)], P + ", score double")
    cfg, grid = decide.optimize_threshold(s, pairs(spark, ("a", "x")), ids(spark, "a", "b"))
    assert cfg == ThresholdConfig(0.15, 0.15) and grid.count() == 19
    assert [r.macro_f_beta for r in grid.orderBy("threshold").collect()] == [0.5] * 2 + [1.0] * 12 + [0.5] * 5


def test_blocking_quality_and_errors(spark):
    c, t = pairs(spark, ("a", "x"), ("a", "y"), ("b", "z")), pairs(spark, ("a", "x"), ("c", "w"))
    q = evaluate.blocking_quality(c, t, ids(spark, "a", "b", "c"), 10).first()
    assert (q.true_matches_total, q.true_matches_recovered, q.zero_candidate_entities, q.avg_candidates_per_entity, q.max_candidates_per_entity) == (2, 1, 1, 1.5, 2)
    assert (q.candidate_recall, q.reduction_ratio) == (0.5, pytest.approx(0.9))
    assert evaluate.false_positives(c, t).count() == 2 and evaluate.false_negatives(c, t).count() == 1


def test_truth_labels_and_split(spark):
    table = spark.createDataFrame([("a", "x,y"), ("b", ""), ("z", "x")], "source1_entity_id string, matched_entity_ids string")
    truth = labels.truth_pairs(table, ids(spark, "a", "b"))
    assert sorted(map(tuple, truth.collect())) == [("a", "x"), ("a", "y")]
    split = labels.grouped_split(ids(spark, *[f"S1-{i}" for i in range(41)]))
    assert {r.split: r["count"] for r in split.groupBy("split").count().collect()} == {"val": 6, "train": 35}
    got = labels.label_candidates(pairs(spark, ("a", "x"), ("a", "q")), truth).collect()
    assert {(r[1], r.label) for r in got} == {("x", 1), ("q", 0)}


def test_output_rules(spark):
    c, p = pairs(spark, ("a", "S2-9"), ("a", "S3-9"), ("a", "S1-2")), pairs(spark, ("a", "S2-9"), ("a", "S3-9"), ("a", "S1-2"), ("a", "S2-1"))
    valid = spark.createDataFrame([("S2-9",)], "entity_id string")
    assert {r[1] for r in output.enforce_valid(p, c).collect()} == {"S2-9", "S3-9"}
    assert {r[1] for r in output.enforce_valid(p, c, valid).select("source1_entity_id", "candidate_entity_id").collect()} == {"S2-9"}
    frame = output.output_frame(pairs(spark, ("a", "S2-2"), ("a", "S2-1")), ids(spark, "a", "b"), "matched_entity_ids")
    assert {tuple(r) for r in frame.collect()} == {("a", "S2-1,S2-2"), ("b", "")}


def test_any_model_with_predict_proba_scores(spark):
    class Mean:
        """A model as other libraries give it."""

        def predict_proba(self, x):
            p = x.mean(axis=1).clip(0, 1)
            return [[1 - v, v] for v in p]

    from kinspan.operators import models
    from kinspan.operators.features import FEATURES

    rows = [(f"S1-{i}", f"S2-{i}", "S2", *[i / 10 + (j % 2) / 10 for j in range(len(FEATURES))]) for i in range(5)]
    df = spark.createDataFrame(rows, "source1_entity_id string, candidate_entity_id string, source string, " + ", ".join(f"{c} double" for c in FEATURES))
    got = {r.source1_entity_id: r.score for r in models.score_pairs(df, Mean()).collect()}
    assert got == pytest.approx({f"S1-{i}": i / 10 + 0.05 for i in range(5)}, abs=1e-6)
