"""Profiles of source tables and of the ground truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile_source(records: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Counts and lengths of a table of records, one row (for each value of the columns by). Percentiles are exact, between neighbours linear."""
    name, addr, n = F.col("business_name"), F.col("business_address"), F.count("*")
    twice = lambda c: (n - F.countDistinct(c)).cast("long")
    where = lambda c: F.count_if(c)
    return records.groupBy(*by).agg(
        n.alias("row_count"), twice("entity_id").alias("duplicate_entity_ids"), twice("business_name").alias("duplicate_business_name_rows"), twice("business_address").alias("duplicate_address_rows"),
        where(name == "").alias("empty_name"), where(addr == "").alias("empty_address"), where(F.col("country") == "").alias("empty_country"),
        F.avg(F.length(name)).alias("name_len_mean"), F.percentile(F.length(name), F.lit(0.95)).alias("name_len_p95"), F.avg(F.length(addr)).alias("address_len_mean"), F.percentile(F.length(addr), F.lit(0.95)).alias("address_len_p95"),
        where(name.rlike(r"[^\x00-\x7F]")).alias("names_with_non_ascii"), where(addr.rlike(r"\p{Nd}")).alias("addresses_with_digits"))


def country_distribution(records: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return records.groupBy(*by, "country").agg(F.count("*").alias("n"))


def profile_truth(truth: DataFrame) -> DataFrame:
    """How many matches the entities of a truth table have."""
    n = F.when(F.col("matched_entity_ids") == "", 0).otherwise(F.size(F.split("matched_entity_ids", ",")))
    return truth.select(n.alias("n")).agg(
        F.count("*").alias("n_source1_entities"), F.count_if(F.col("n") == 0).alias("n_singleton"), F.avg((F.col("n") == 0).cast("double")).alias("singleton_frequency"),
        F.count_if(F.col("n") > 1).alias("n_multi_match"), F.avg((F.col("n") > 1).cast("double")).alias("multi_match_frequency"), F.avg("n").alias("avg_match_count"), F.max("n").alias("max_match_count"))
