"""Ground truth as pairs, labels of candidates, and the split by entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinspan.schema import PAIR, SEED, VAL_FRACTION


def truth_pairs(truth: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """Distinct pairs of a truth table (source1_entity_id, matched_entity_ids: comma list, "" for none), of the given entities only."""
    if entities is not None:
        truth = truth.join(entities.select(PAIR[0]).distinct(), PAIR[0], "left_semi")
    return truth.where(F.col("matched_entity_ids") != "").select(PAIR[0], F.explode(F.split("matched_entity_ids", ",")).alias(PAIR[1])).distinct()


def grouped_split(entities: DataFrame, val_fraction: float = VAL_FRACTION, seed: int = SEED) -> DataFrame:
    """(source1_entity_id, split): exactly floor(n * val_fraction) ids are `val`, chosen by a hash of seed and id.

    The ids' ranks are found bucket by bucket of the hash (256 of them), so no task sorts all ids."""
    ids = entities.select(PAIR[0]).distinct().withColumn("h", F.md5(F.concat(F.lit(f"{seed}:"), F.col(PAIR[0])))).withColumn("b", F.substring("h", 1, 2))
    sizes = ids.groupBy("b").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("before", F.sum("n").over(Window.orderBy("b")) - F.col("n")).withColumn("all", F.sum("n").over(Window.partitionBy()))
    ranked = ids.withColumn("r", F.row_number().over(Window.partitionBy("b").orderBy("h", PAIR[0]))).join(F.broadcast(sizes), "b")
    return ranked.select(PAIR[0], F.when(F.col("r") + F.col("before") <= F.floor(F.col("all") * F.lit(val_fraction)), "val").otherwise("train").alias("split"))


def label_candidates(candidates: DataFrame, truth: DataFrame, split: DataFrame | None = None) -> DataFrame:
    """candidates with label (tinyint; 1 for a true pair) and, if given, the split of their S1 record."""
    out = candidates.join(truth.select(*PAIR).distinct().withColumn("label", F.lit(1)), PAIR, "left").withColumn("label", F.coalesce("label", F.lit(0)).cast("tinyint"))
    return out if split is None else out.join(split, PAIR[0], "left").withColumn("split", F.coalesce("split", F.lit("val")))
