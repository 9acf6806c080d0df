from functools import partial
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from kinspan.operators import boosting, models
from kinspan.operators.features import FEATURES


def pairs(spark, n=600, seed=1):
    """Rows of FEATURES and a label that two of them decide, with some noise."""
    rng = np.random.default_rng(seed)
    x = rng.random((n, len(FEATURES))).round(2)
    label = (x[:, 2] + x[:, 16] + 0.2 * rng.standard_normal(n) > 1.1).astype(int)
    return spark.createDataFrame([(*map(float, r), int(y)) for r, y in zip(x, label, strict=True)], ", ".join(f"{c} double" for c in FEATURES) + ", label int")


def trees(model):
    return model.stages[-1].toDebugString.split("\n")[1:]


def test_a_fit_takes_few_jobs_whatever_its_rounds(spark):
    group = "fit of 30 rounds"
    spark.sparkContext.setJobGroup(group, "")
    try:
        model = models.fit_gbt(pairs(spark, 200), rounds=30)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert model.stages[-1].getNumTrees == 30
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) < 30


def test_trees_are_the_same_however_rows_are_dealt(spark, monkeypatch):
    rows = pairs(spark)
    train, val = rows.where("name_levenshtein < 0.8"), rows.where("name_levenshtein >= 0.8")
    held = models.fit_gbt(train, val, rounds=25)
    moved = models.fit_gbt(train.repartition(5, "addr_jaccard"), val, rounds=25)
    monkeypatch.setattr(boosting, "HELD", 0)
    monkeypatch.setattr(boosting, "ROWS", 100)
    jobs = models.fit_gbt(train.repartition(3), val, rounds=25)
    assert trees(held) == trees(moved) == trees(jobs) and len(trees(held)) > 100


def binned(train):
    cuts, kind = boosting.thresholds(train, FEATURES, 32), "n long, label binary, is_val binary, key binary, bins binary"
    rows = train.withColumn("is_val", F.lit(False)).select(*FEATURES, "label", "is_val").coalesce(1)
    return [tuple(r) for r in rows.mapInArrow(lambda b: boosting._binned(FEATURES, cuts, b), kind).collect()]


MADE = partial(boosting.Rows, width=len(FEATURES), seed=42, rate=0.8)
PARAMS = {"stepSize": 0.05, "maxDepth": 6, "minInstancesPerNode": 20, "validationTol": 0.01, "seed": 42, "share": 0.9}


def test_rows_that_no_worker_keeps_are_grown_again(spark, monkeypatch):
    parts = binned(pairs(spark))
    held, _ = boosting.boost(partial(MADE(parts).answer, bins=32), 3, PARAMS)
    for kept in (0, boosting.KEPT):
        monkeypatch.setattr(boosting, "KEPT", kept)
        got, _ = boosting.boost(lambda *a: next(boosting._answers("a", MADE, SimpleNamespace(value=[]), *a, 32, 0, iter(parts))), 3, PARAMS)
        assert got == held and len(boosting._kept) == int(kept > 0)
    boosting._kept.clear()


def test_margins_are_those_of_sparks_model_and_as_good_as_its_fit(spark, tmp_path):
    train, other = pairs(spark), pairs(spark, seed=2)
    mine = models.fit_gbt(train, rounds=20)
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    sparks = PipelineModel([assembler, models.gbt(20).fit(assembler.transform(train.withColumn("label", F.col("label").cast("double"))))])
    good, theirs = (models.average_precision(m, other) for m in (mine, sparks))
    assert good > theirs - 0.02 and good > 0.8
    models.save_model(mine, str(tmp_path / "m"))
    kept = models.load_model(str(tmp_path / "m")).transform(other).select("rawPrediction", "prediction").collect()
    assert kept == mine.transform(other).select("rawPrediction", "prediction").collect()
    rows = MADE(binned(train))
    grown, _ = boosting.boost(partial(rows.answer, bins=32), 20, PARAMS)
    rows.advance(grown, [])
    got = [r.rawPrediction[1] for r in mine.transform(train.coalesce(1)).collect()]
    assert sorted(got) == pytest.approx(sorted(rows.margin))  # thresholds and bins put every row in the same leaf


def test_odd_features(spark):
    same = pairs(spark, 50).select(*[F.lit(1.0).alias(c) for c in FEATURES], "label")
    assert models.fit_gbt(same, rounds=2).stages[-1].totalNumNodes == 2
    with pytest.raises(Exception, match="null or not finite"):
        models.fit_gbt(pairs(spark, 50).withColumn("addr_jaccard", F.lit(None).cast("double")), rounds=1)


def test_sums_are_exact():
    n = boosting.CHUNK + 5
    parts = [(n, np.ones(n, np.uint8).tobytes(), np.zeros(n, np.uint8).tobytes(), np.arange(n, dtype=np.uint64).tobytes(), (np.arange(n) % 2).astype(np.uint8).tobytes())]
    rows = boosting.Rows(parts, 1, 1, 1.0)
    rows._weigh()
    rows.packed = np.where(np.arange(n) % 2 > 0, 1 - boosting.TOP, boosting.TOP - 1) + boosting.ONE
    half = np.array([(n + 1) // 2, n // 2])
    assert rows.sums([0], 2)[0, 0].tolist() == [[half[0], half[0] * (boosting.TOP - 1)], [half[1], half[1] * (1 - boosting.TOP)]]
