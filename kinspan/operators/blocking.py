"""Candidate generation: records that share keys, weighted by how rare the keys are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinspan.functions import normalize as N
from kinspan.schema import BlockingConfig

GROUP = ["key_type", "country_norm", "key"]

# Address words that say nothing about the place.
STOPWORDS = [
    "street", "road", "avenue", "drive", "lane", "court", "place", "square", "highway", "parkway", "apartment",
    "building", "floor", "suite", "north", "south", "east", "west", "number", "near", "unit",
]


def prepare(records: DataFrame) -> DataFrame:
    """entity_id with its country and its name, address and digit tokens, and what features need besides."""
    return records.select(
        "entity_id", F.coalesce("business_name", F.lit("")).alias("business_name"), F.coalesce("business_address", F.lit("")).alias("business_address"),
        N.country(F.col("country")).alias("country_norm"), N.name_tokens(F.col("business_name")).alias("name_tokens"),
        N.address_tokens(F.col("business_address")).alias("addr_tokens"), N.digit_tokens(F.col("business_address")).alias("digit_tokens"))


def explode_keys(prepared: DataFrame, cfg: BlockingConfig = BlockingConfig()) -> DataFrame:
    """(entity_id, country_norm, key_type, key) in one scan; a token that stands twice in a record gives two rows."""
    long = lambda x: F.length(x) >= cfg.min_token
    typed = lambda kind, keys: F.transform(keys, lambda k: F.struct(F.lit(kind).alias("key_type"), k.alias("key")))
    prefix = F.substring(F.array_join("name_tokens", ""), 1, cfg.prefix)
    keys = F.concat(
        typed("name_token", F.filter("name_tokens", long)),
        typed("name_prefix", F.when(F.length(prefix) >= cfg.prefix, F.array(prefix)).otherwise(F.array().cast("array<string>"))),
        typed("addr_digit", F.filter("digit_tokens", long)),
        typed("addr_token", F.filter("addr_tokens", lambda k: long(k) & ~k.isin(STOPWORDS) & ~k.rlike(r"^\p{Nd}+$"))))
    return prepared.select("entity_id", "country_norm", F.explode(keys).alias("k")).select("entity_id", "country_norm", "k.key_type", "k.key")


def posting_counts(keys: DataFrame, name: str) -> DataFrame:
    return keys.groupBy(*GROUP).agg(F.count("*").alias(name))


def surviving_keys(s1_keys: DataFrame, other_keys: DataFrame, cfg: BlockingConfig = BlockingConfig()) -> DataFrame:
    """(source, key group, left_n, right_n) of the keys that are common to both sides and too frequent on neither; other_keys has a column source."""
    left = posting_counts(s1_keys, "left_n").where(F.col("left_n") <= cfg.max_posting)
    right = other_keys.groupBy("source", *GROUP).agg(F.count("*").alias("right_n")).where(F.col("right_n") <= cfg.max_posting)
    return right.join(left, GROUP).where(F.col("left_n") * F.col("right_n") <= cfg.max_product)


def pair_estimate(kept: DataFrame) -> DataFrame:
    """Pairs that the surviving keys give, for each source."""
    return kept.groupBy("source").agg(F.sum(F.col("left_n") * F.col("right_n")).alias("estimated_pairs"))


def key_weight(cfg: BlockingConfig) -> Column:
    base = F.lit(None).cast("double")
    for kind, w in cfg.weights.items():
        base = F.when(F.col("key_type") == kind, F.lit(w)).otherwise(base)
    return base / F.log2(F.col("right_n") + F.lit(2.0))


def pair_weights(s1_keys: DataFrame, other_keys: DataFrame, cfg: BlockingConfig = BlockingConfig()) -> DataFrame:
    """(source1_entity_id, candidate_entity_id, source, weight): the sum over shared keys of type weight by log of the candidates' count.

    A key's postings are bounded on both sides before the join, so no key makes a task long: this join can't be skewed."""
    kept = surviving_keys(s1_keys, other_keys, cfg)
    right = other_keys.join(kept, ["source", *GROUP]).select("source", *GROUP, F.col("entity_id").alias("candidate_entity_id"), key_weight(cfg).alias("w"))
    left = s1_keys.select(*GROUP, F.col("entity_id").alias("source1_entity_id"))
    return left.join(right, GROUP).groupBy("source1_entity_id", "candidate_entity_id", "source").agg(F.sum("w").alias("weight"))


def top_candidates(pairs: DataFrame, cfg: BlockingConfig = BlockingConfig()) -> DataFrame:
    """The best of each S1 record over all sources, ties by id; weights are rounded first since float sums depend on their order."""
    w = Window.partitionBy("source1_entity_id").orderBy(F.desc("weight"), "candidate_entity_id")
    ranked = pairs.withColumn("weight", F.round("weight", 6)).withColumn("rank", F.row_number().over(w))
    return ranked.where(F.col("rank") <= cfg.max_candidates)


def keys_of(s1: DataFrame, s2: DataFrame, s3: DataFrame, cfg: BlockingConfig = BlockingConfig()) -> tuple[DataFrame, DataFrame]:
    """Keys of S1, and of S2 and S3 with their source."""
    one = lambda df, name: explode_keys(prepare(df), cfg).withColumn("source", F.lit(name))
    return explode_keys(prepare(s1), cfg), one(s2, "S2").unionByName(one(s3, "S3"))


def generate_candidates(s1: DataFrame, s2: DataFrame, s3: DataFrame, max_candidates: int | None = None, cfg: BlockingConfig = BlockingConfig()) -> DataFrame:
    """(source1_entity_id, candidate_entity_id, source, weight, rank) for three tables of records."""
    if max_candidates is not None:
        cfg = BlockingConfig(cfg.min_token, cfg.prefix, cfg.max_posting, cfg.max_product, max_candidates, cfg.weights)
    return top_candidates(pair_weights(*keys_of(s1, s2, s3, cfg), cfg), cfg)
