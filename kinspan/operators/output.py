"""Rules that results must follow, and their final form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinspan.schema import PAIR


def enforce_valid(predicted: DataFrame, candidates: DataFrame, valid_ids: DataFrame | None = None) -> DataFrame:
    """Predicted pairs whose id is one of S2 or S3, was a candidate of the record and, if valid_ids (entity_id) is given, exists."""
    out = predicted.where(F.col(PAIR[1]).rlike("^S[23]-")).join(candidates.select(*PAIR).distinct(), PAIR, "left_semi")
    if valid_ids is not None:
        out = out.join(valid_ids.select(F.col("entity_id").alias(PAIR[1])).distinct(), PAIR[1], "left_semi")
    return out


def output_frame(pairs: DataFrame, required: DataFrame, list_column: str) -> DataFrame:
    """A row for each required id (source1_entity_id): its ids, sorted and joined by commas; "" for none."""
    lists = pairs.groupBy(PAIR[0]).agg(F.array_join(F.array_sort(F.collect_set(PAIR[1])), ",").alias(list_column))
    return required.select(PAIR[0]).distinct().join(lists, PAIR[0], "left").withColumn(list_column, F.coalesce(list_column, F.lit("")))
