"""Scorers of pairs: fixed rules as columns, and trained models of Spark ML."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinspan.operators import boosting
from kinspan.operators.features import FEATURES
from kinspan.schema import PAIR, SEED


def _mean(*names: str) -> Column:
    out = F.col(names[0])
    for n in names[1:]:
        out = out + F.col(n)
    return out / len(names)


def rule_score(name: float = 0.5, addr: float = 0.3, country: float = 0.2) -> Column:
    """A weighted mean of the name's, the address's and the country's similarity."""
    names = _mean("name_levenshtein", "name_jaro_winkler", "name_token_set", "name_jaccard")
    return name * names + addr * _mean("addr_levenshtein", "addr_token_sort", "addr_jaccard") + country * F.col("country_exact")


def exact_score(require_country: bool = False) -> Column:
    return F.col("name_exact_norm") * F.col("country_exact") if require_country else F.col("name_exact_norm").cast("double")


def tfidf_score() -> Column:
    return F.col("name_tfidf_cosine").cast("double")


#: The scorers that need no training.
BASELINES = {"exact_name": lambda: exact_score(False), "exact_name_country": lambda: exact_score(True), "weighted_fuzzy": rule_score, "tfidf_retrieval": tfidf_score}


def gbt(rounds: int = 400, **more) -> GBTClassifier:
    """Boosted trees; trees grow level by level, to 64 leaves at most."""
    return GBTClassifier(maxIter=rounds, stepSize=0.05, maxDepth=6, subsamplingRate=0.8, featureSubsetStrategy="0.9", minInstancesPerNode=20, seed=SEED, **more)


def fit_gbt(train: DataFrame, val: DataFrame | None = None, rounds: int = 400) -> PipelineModel:
    """Fits on rows with FEATURES and label; with val, rounds stop once its error no longer falls.

    The trees are grown by boosting.fit and put in Spark's own model, whose fit would run a job with a shuffle for each level of each tree."""
    data = train.withColumn("is_val", F.lit(False))
    more = {}
    if val is not None:
        data, more = data.unionByName(val.withColumn("is_val", F.lit(True))), {"validationIndicatorCol": "is_val", "validationTol": 0.0005}
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    return PipelineModel([assembler, boosting.fit(data, FEATURES, gbt(rounds, **more))])


def fit_logistic(train: DataFrame, rounds: int = 1000) -> PipelineModel:
    """Logistic regression with both classes weighing the same."""
    sizes = train.groupBy("label").agg(F.count("*").alias("c"))
    total = sizes.agg(F.sum("c").alias("n"), F.count("*").alias("k"))
    weights = sizes.crossJoin(F.broadcast(total)).select("label", (F.col("n") / (F.col("k") * F.col("c"))).alias("weight"))
    data = train.join(F.broadcast(weights), "label").withColumn("label", F.col("label").cast("double"))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    return PipelineModel([assembler, LogisticRegression(maxIter=rounds, weightCol="weight").fit(assembler.transform(data))])


def average_precision(model: PipelineModel, rows: DataFrame) -> float:
    scored = model.transform(rows.withColumn("label", F.col("label").cast("double")))
    return BinaryClassificationEvaluator(metricName="areaUnderPR").evaluate(scored)


def score_pairs(features: DataFrame, model) -> DataFrame:
    """(ids, source, score): model is a column, a fitted PipelineModel, anything whose predict_proba(matrix of FEATURES) gives two columns of
    probabilities, batch by batch where the rows are, or anything whose score(features) gives a column."""
    if not isinstance(model, Column) and hasattr(model, "predict_proba"):

        @F.pandas_udf(T.DoubleType())
        def probability(x: pd.DataFrame) -> pd.Series:
            return pd.Series(np.asarray(model.predict_proba(x.to_numpy(np.float32)))[:, 1].astype(float))

        out = features.withColumn("score", probability(F.struct(*FEATURES)))
    elif isinstance(model, PipelineModel):
        out = model.transform(features).withColumn("score", vector_to_array("probability")[1])
    else:
        out = features.withColumn("score", (model if isinstance(model, Column) else model.score(features)).cast("double"))
    return out.select(*PAIR, "source", "score")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
