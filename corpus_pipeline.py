"""From documents to training shards: each stage works on all that the one before it kept.

Counts as part of kinspan.llm. A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. Null, empty and very long texts, ties, repeated rows, empty tables and further columns (which are
handed on) are treated as the operators' own descriptions say."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinspan.llm.common import materialize, scratch_path, small, table
from kinspan.llm.decontamination import drop_contaminated
from kinspan.llm.mixing import take
from kinspan.llm.ngram_join import ngram_groups
from kinspan.llm.quality_classifier import keep_good
from kinspan.llm.sharding import kd_shards


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects (score below 0.3)."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that links of similarity >= 0.8 over five-word shingles form, keeps the one with the smallest doc_id.

    Rows without words or id stay; of rows that repeat both id and text one stays."""
    groups = materialize(ngram_groups(docs, shingle=5, num=80, den=100).select("doc_id", "component_id"), "groups")
    drop = small(groups.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct())
    kept = docs.join(drop, "doc_id", "left_anti").select(*docs.columns)
    twice = groups.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1").select("doc_id")
    if not (ids := materialize(twice, "repeated")).head(1):
        return kept
    ids = small(ids)
    again = kept.join(ids, "doc_id", "left_semi").withColumn("__nth", F.row_number().over(Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.lit(0))))
    return kept.join(ids, "doc_id", "left_anti").select(*docs.columns).unionByName(again.where("__nth = 1").select(*docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold at least 0.8 of a benchmark item's five-word shingles."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that sources come near their target weights 1, 2, 3, repeating."""
    return take(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deals the rows into 24 shards of near-equal bytes."""
    return kd_shards(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mixing", mixing), ("sharding", sharding)]

#: SQL can't express the classifier's neighbours; tests/llm hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
