"""Business records that follow from the documents table: every row of it is one record."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspan.operators.lineage import cut
from kinspan.schema import PAIR, source_of

#: A business's words: of up to 12 characters.
LONGEST = 12


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once for a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _fields(text: Column) -> Column:
    """name, place and passage: runs of 5, 7 and 10 words of the whole text.

    Where they stand follows from the hashes of all three-word runs: at the least, at the greatest, and where the hash's second half
    is least. So every word of a text has a say, and near copies have mostly the same fields."""
    words = F.filter(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), 1), lambda w: F.length(w) <= LONGEST)
    key = lambda ws: lambda i: F.concat(F.md5(F.array_join(F.slice(ws, i, 3), " ")), F.lpad(i.cast("string"), 9, "0"))
    keys = lambda ws: F.transform(F.when(F.size(ws) > 0, F.sequence(F.lit(1), F.size(ws))), key(ws))
    run = lambda ws, at, n: F.coalesce(F.array_join(F.slice(ws, at.cast("int"), n), " "), F.lit(""))
    of = lambda ws: lambda ks: F.struct(
        run(ws, F.substr(F.array_min(ks), F.lit(33)), 5).alias("name"), run(ws, F.substr(F.array_max(ks), F.lit(33)), 7).alias("place"),
        run(ws, F.substr(F.array_min(F.transform(ks, lambda k: F.substr(k, F.lit(17)))), F.lit(17)), 10).alias("passage"))
    return _let(words, lambda ws: _let(keys(ws), of(ws)))


_derived: dict[tuple[str, str], DataFrame] = {}


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of a data folder, derived once a session."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _derived:
        _derived[key] = _derive(spark, sf_dir)
    return _derived[key]


def _derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "n_chars", _fields(F.col("text")).alias("f"))
    kind, name = F.col("doc_id") % 3, F.col("f.name")
    docs = docs.select(
        F.concat(F.lit("S"), (1 + kind).cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"),
        F.when(kind == 0, F.concat(name, F.lit(" Private Limited"))).when(kind == 1, F.concat(name, F.lit(" Pvt Ltd"))).otherwise(F.concat(F.lit("-- "), name, F.lit(" & Co"))).alias("business_name"),
        F.concat("f.place", F.lit(", "), F.col("n_chars").cast("string"), F.when(kind == 0, " Main Street").otherwise(" Main St")).alias("business_address"),
        F.col("lang").alias("country"), F.col("f.passage").alias("passage"))
    return cut(docs.na.fill(""))


def sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    r = records(spark, sf_dir).drop("passage")
    return tuple(r.where(source_of(F.col("entity_id")) == s) for s in ("S1", "S2", "S3"))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True pairs: an S1 and another record of one country with the same passage, which is not empty."""
    r = records(spark, sf_dir).where("passage <> ''").select("entity_id", "country", "passage", source_of(F.col("entity_id")).alias("source"))
    left = r.where("source = 'S1'").select(F.col("entity_id").alias(PAIR[0]), "country", "passage")
    right = r.where("source <> 'S1'").select(F.col("entity_id").alias(PAIR[1]), "country", "passage")
    return left.join(right, ["country", "passage"]).select(*PAIR)


def truth_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The truth as a table of comma lists, a row for every S1 record."""
    from kinspan.operators.output import output_frame

    s1, _, _ = sources(spark, sf_dir)
    return output_frame(truth(spark, sf_dir), s1.select(F.col("entity_id").alias(PAIR[0])), "matched_entity_ids")
