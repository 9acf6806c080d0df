"""The driver's queries: every operator over the demo records of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspan.functions import normalize as N
from kinspan.operators import blocking, decide, evaluate, features, labels, models, output, profile, validate
from kinspan.operators.lineage import cut
from kinspan.plans import demo, linkage
from kinspan.schema import PAIR, BlockingConfig, ThresholdConfig, source_of

LOW = BlockingConfig(max_posting=100, max_product=10_000)

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    _queries[f.__name__] = f
    return f


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries)


def r4(c: Column | str) -> Column:
    return F.round(c, 4)


def joined(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def keys(spark: SparkSession, sf_dir: str, cfg: BlockingConfig = BlockingConfig()) -> tuple[DataFrame, DataFrame]:
    return blocking.keys_of(*demo.sources(spark, sf_dir), cfg)


def candidates(spark: SparkSession, sf_dir: str, cfg: BlockingConfig = BlockingConfig()) -> DataFrame:
    return blocking.generate_candidates(*demo.sources(spark, sf_dir), cfg=cfg)


def wide(spark: SparkSession, sf_dir: str, of: DataFrame | None = None) -> DataFrame:
    s1, s2, s3 = demo.sources(spark, sf_dir)
    return cut(features.paired(cut(candidates(spark, sf_dir)) if of is None else of, s1, s2.unionByName(s3)))  # several of the features read it more than once


def direct(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    return features.direct_features(wide(spark, sf_dir)).select(*PAIR, *[r4(n).alias(n) for n in names])


def matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, s2, s3 = demo.sources(spark, sf_dir)
    return features.compute_features(cut(candidates(spark, sf_dir)), s1, s2.unionByName(s3), single=False)


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demo.sources(spark, sf_dir)[0].select(F.col("entity_id").alias(PAIR[0]))


def scored(spark: SparkSession, sf_dir: str, of: DataFrame | None = None) -> DataFrame:
    """Candidates (or the pairs given) by the cosine of their names, rounded to 4 digits."""
    w = wide(spark, sf_dir, of)
    return w.select(*PAIR, "source", "name_norm_l", "name_norm_r", r4(features.tfidf_cosine(w, "name")).alias("score"))


def accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide.apply_thresholds(scored(spark, sf_dir), ThresholdConfig(0.4, 0.6))


@query
def norm_name_tokens(spark, sf_dir):
    return demo.records(spark, sf_dir).select("entity_id", joined(N.name_tokens(F.col("business_name"))).alias("tokens"))


@query
def norm_addr_tokens(spark, sf_dir):
    return demo.records(spark, sf_dir).select("entity_id", joined(N.address_tokens(F.col("business_address"))).alias("tokens"))


@query
def norm_strings(spark, sf_dir):
    name = F.col("business_name")
    return demo.records(spark, sf_dir).select("entity_id", N.name_string(name).alias("name_norm"), N.address_string(F.col("business_address")).alias("addr_norm"), N.normalize_whitespace(name).alias("name_spaces"), N.strip_leading_junk(name).alias("name_junk"), N.lowercase(name).alias("name_lower"), N.strip_punctuation(name).alias("name_punct"), F.array_join(N.tokenize(name), "|").alias("name_words"))


@query
def digit_tokens(spark, sf_dir):
    return demo.records(spark, sf_dir).select("entity_id", joined(N.digit_tokens(F.col("business_address"))).alias("digits"))


@query
def char_ngrams(spark, sf_dir):
    g = N.char_ngrams(N.name_string(F.col("business_name")), 3)
    return demo.records(spark, sf_dir).select("entity_id", F.size(g).cast("long").alias("n"), F.array_join(F.array_sort(g), "|").alias("grams"))


@query
def alnum_fingerprint(spark, sf_dir):
    return demo.records(spark, sf_dir).select("entity_id", N.alphanumeric_only(F.col("business_name")).alias("fingerprint"))


@query
def country_norm(spark, sf_dir):
    return demo.records(spark, sf_dir).select("entity_id", N.country(F.concat(F.lit("  "), "country", F.lit(" \t X "))).alias("country_norm"))


@query
def block_keys(spark, sf_dir):
    s1, other = keys(spark, sf_dir)
    return s1.withColumn("source", F.lit("S1")).unionByName(other).select("entity_id", "source", "country_norm", "key_type", "key")


@query
def key_posting_counts(spark, sf_dir):
    s1, other = keys(spark, sf_dir)
    return s1.withColumn("source", F.lit("S1")).unionByName(other).groupBy("source", *blocking.GROUP).agg(F.count("*").alias("n"))


@query
def pruned_keys(spark, sf_dir):
    return blocking.surviving_keys(*keys(spark, sf_dir))


@query
def pruned_keys_lowcap(spark, sf_dir):
    return blocking.surviving_keys(*keys(spark, sf_dir), LOW)


@query
def key_pair_estimate(spark, sf_dir):
    return blocking.pair_estimate(blocking.surviving_keys(*keys(spark, sf_dir)))


@query
def pair_weights(spark, sf_dir):
    return blocking.pair_weights(*keys(spark, sf_dir)).withColumn("weight", r4("weight"))


@query
def candidates_topk(spark, sf_dir):
    return candidates(spark, sf_dir).withColumn("rank", F.col("rank").cast("long"))


@query
def candidates_topk_lowcap(spark, sf_dir):
    return candidates(spark, sf_dir, LOW).withColumn("rank", F.col("rank").cast("long"))


@query
def candidate_lists(spark, sf_dir):
    return output.output_frame(candidates(spark, sf_dir), entities(spark, sf_dir), "candidate_entity_ids")


@query
def feat_exact(spark, sf_dir):
    return direct(spark, sf_dir, "name_exact_raw", "name_exact_norm", "addr_exact_norm", "country_exact")


@query
def feat_jaccard(spark, sf_dir):
    return direct(spark, sf_dir, "name_jaccard", "addr_jaccard")


@query
def feat_ngram_jaccard(spark, sf_dir):
    return direct(spark, sf_dir, "name_char_ngram_jaccard")


@query
def feat_lengths(spark, sf_dir):
    return direct(spark, sf_dir, "name_len_ratio", "name_len_diff", "name_token_count_diff", "addr_len_ratio", "addr_len_diff")


@query
def feat_shared_digit(spark, sf_dir):
    return direct(spark, sf_dir, "addr_shared_digit_token")


@query
def feat_cross(spark, sf_dir):
    return features.direct_features(wide(spark, sf_dir)).select(*PAIR, *[F.round(n, 6).alias(n) for n in ("name_x_addr_jaccard", "country_x_name_jaccard", "country_x_addr_jaccard")])


@query
def token_rarity(spark, sf_dir):
    w = wide(spark, sf_dir)
    both = [features.token_rarity(w, f).withColumn("field", F.lit(f)) for f in ("name", "addr")]
    return both[0].unionByName(both[1]).withColumn("weight", r4("weight"))


@query
def feat_shared_rare(spark, sf_dir):
    w = wide(spark, sf_dir)
    out = w.select(*PAIR, "source")
    for f in ("name", "addr"):
        out = out.join(features.shared_rare_token(w, f), [*PAIR, "source"], "left")
    return out.select(*PAIR, *[r4(F.coalesce(f"{f}_shared_rare_token", F.lit(0.0))).alias(f"{f}_shared_rare_token") for f in ("name", "addr")])


@query
def feat_tfidf_cosine(spark, sf_dir):
    w = wide(spark, sf_dir)
    return w.select(*PAIR, *[r4(features.tfidf_cosine(w, f)).alias(f"{f}_tfidf_cosine") for f in ("name", "addr")])


def _fuzzy(spark, sf_dir, *names):
    return features.fuzzy_features(wide(spark, sf_dir), names).select(*PAIR, *[r4(n).alias(n) for n in names])


@query
def feat_indel_ratio(spark, sf_dir):
    return _fuzzy(spark, sf_dir, "name_levenshtein", "addr_levenshtein")


@query
def feat_token_sort(spark, sf_dir):
    return _fuzzy(spark, sf_dir, "name_token_sort", "addr_token_sort")


@query
def feat_token_set(spark, sf_dir):
    return _fuzzy(spark, sf_dir, "name_token_set")


@query
def feat_wratio(spark, sf_dir):
    return _fuzzy(spark, sf_dir, "name_jaro_winkler")


@query
def feature_matrix(spark, sf_dir):
    return matrix(spark, sf_dir).select(*PAIR, "source", *[r4(c).alias(c) for c in features.FEATURES])


@query
def truth_pairs(spark, sf_dir):
    return labels.truth_pairs(demo.truth_table(spark, sf_dir), entities(spark, sf_dir))


@query
def labeled_candidates(spark, sf_dir):
    got = labels.label_candidates(candidates(spark, sf_dir), demo.truth(spark, sf_dir), labels.grouped_split(entities(spark, sf_dir)))
    return got.select(*PAIR, F.col("label").cast("int").alias("label"), "split")


@query
def label_counts(spark, sf_dir):
    return labeled_candidates(spark, sf_dir).groupBy("label").agg(F.count("*").alias("n"))


@query
def grouped_split(spark, sf_dir):
    return labels.grouped_split(entities(spark, sf_dir))


def _score(spark, sf_dir, model):
    return models.score_pairs(features.direct_features(wide(spark, sf_dir)), model).select(*PAIR, r4("score").alias("score"))


@query
def score_exact(spark, sf_dir):
    return _score(spark, sf_dir, models.exact_score())


@query
def score_exact_country(spark, sf_dir):
    return _score(spark, sf_dir, models.exact_score(True))


@query
def score_rule(spark, sf_dir):
    return models.score_pairs(matrix(spark, sf_dir), models.rule_score()).select(*PAIR, r4("score").alias("score"))


@query
def score_tfidf(spark, sf_dir):
    return scored(spark, sf_dir).select(*PAIR, "score")


@query
def apply_thresholds(spark, sf_dir):
    return accepted(spark, sf_dir)


@query
def predictions_at_threshold(spark, sf_dir):
    return decide.predictions_at(scored(spark, sf_dir), 0.5).select(PAIR[0], F.array_join("predicted", ",").alias("predicted"))


def _rounded(df):
    return df.select(*[r4(c).alias(c) if t == "double" and c != "threshold" else F.col(c) for c, t in df.dtypes])


@query
def threshold_grid(spark, sf_dir):
    return _rounded(decide.threshold_grid(scored(spark, sf_dir), demo.truth(spark, sf_dir), entities(spark, sf_dir)))


@query
def best_threshold(spark, sf_dir):
    return _rounded(decide.best_threshold(decide.threshold_grid(scored(spark, sf_dir), demo.truth(spark, sf_dir), entities(spark, sf_dir))))


@query
def baseline_grid(spark, sf_dir):
    s = scored(spark, sf_dir)
    exact = (F.col("name_norm_l") == F.col("name_norm_r")).cast("double")
    both = s.select(F.lit("tfidf_retrieval").alias("model"), *PAIR, "score").unionByName(s.select(F.lit("exact_name").alias("model"), *PAIR, exact.alias("score")))
    return _rounded(decide.best_threshold(decide.threshold_grid(both, demo.truth(spark, sf_dir), entities(spark, sf_dir), by=("model",)), ("model",)))


@query
def baseline_sweep(spark, sf_dir):
    return _rounded(linkage.baseline_sweep(matrix(spark, sf_dir), demo.truth(spark, sf_dir), entities(spark, sf_dir)))


@query
def f_beta_per_entity(spark, sf_dir):
    return _rounded(evaluate.f_beta_per_entity(accepted(spark, sf_dir), demo.truth(spark, sf_dir), entities(spark, sf_dir)))


@query
def macro_f_beta(spark, sf_dir):
    return _rounded(evaluate.macro_f_beta(accepted(spark, sf_dir), demo.truth(spark, sf_dir), entities(spark, sf_dir)))


@query
def blocking_quality(spark, sf_dir):
    s1, s2, s3 = demo.sources(spark, sf_dir)
    q = evaluate.blocking_quality(candidates(spark, sf_dir), demo.truth(spark, sf_dir), entities(spark, sf_dir), s2.unionByName(s3))
    return _rounded(q)


@query
def false_positives(spark, sf_dir):
    return evaluate.false_positives(accepted(spark, sf_dir), demo.truth(spark, sf_dir))


@query
def false_negatives(spark, sf_dir):
    return evaluate.false_negatives(accepted(spark, sf_dir), demo.truth(spark, sf_dir))


@query
def error_examples(spark, sf_dir):
    return evaluate.error_examples(accepted(spark, sf_dir), demo.truth(spark, sf_dir), demo.records(spark, sf_dir))


@query
def matching_results(spark, sf_dir):
    _, s2, s3 = demo.sources(spark, sf_dir)
    found = cut(candidates(spark, sf_dir))
    kept = decide.apply_thresholds(scored(spark, sf_dir, found), ThresholdConfig(0.4, 0.6))
    valid = output.enforce_valid(kept, found, s2.unionByName(s3).select("entity_id"))
    return output.output_frame(valid, entities(spark, sf_dir), "matched_entity_ids")


@query
def full_pipeline(spark, sf_dir):
    return linkage.run_pipeline(*demo.sources(spark, sf_dir), models.rule_score(), ThresholdConfig(0.7, 0.7))["matching_results"]


def _corrupted(spark, sf_dir):
    """The truth table with one fault of each kind in rows that ids choose: none is left out for it."""
    n = (F.instr(F.lit("0123456789abcdef"), F.substring(F.md5(PAIR[0]), 1, 1)) - 1) % 8
    ids = F.split("matched_entity_ids", ",")
    ids = F.when(F.col("matched_entity_ids") == "", F.array().cast("array<string>")).otherwise(ids)
    ids = F.when(n == 0, F.concat(ids, F.array(F.lit("S2-1"), F.lit("S2-1")))).when(n == 1, F.concat(ids, F.array(PAIR[0]))).when(n == 2, F.concat(ids, F.array(F.lit("X-9"), F.lit("")))).when(n == 3, F.concat(ids, F.array(F.lit("S3-none")))).otherwise(ids)
    rows = demo.truth_table(spark, sf_dir).withColumn("n", n).select(F.when(n == 4, F.concat(F.lit("Q-"), PAIR[0])).otherwise(F.col(PAIR[0])).alias("s1"), ids.alias("ids"), "n")
    return rows.select("s1", "ids").unionByName(rows.where("n = 5").select("s1", "ids"))


@query
def validate_findings(spark, sf_dir):
    s1, s2, s3 = demo.sources(spark, sf_dir)
    rows = _corrupted(spark, sf_dir)
    cands = candidates(spark, sf_dir).groupBy(F.col(PAIR[0]).alias("s1")).agg(F.collect_set(PAIR[1]).alias("ids"))
    found = validate.check_rows(rows, s1, s2.unionByName(s3), "matches").unionByName(validate.not_candidates(rows, cands, "matches"))
    return found.select("severity", "rule", "n", "examples")


@query
def validate_counts(spark, sf_dir):
    return validate.row_counts(_corrupted(spark, sf_dir))


@query
def profile_sources(spark, sf_dir):
    r = demo.records(spark, sf_dir).withColumn("source", source_of(F.col("entity_id")))
    return _rounded(profile.profile_source(r, ("source",)))


@query
def country_distribution(spark, sf_dir):
    return profile.country_distribution(demo.records(spark, sf_dir).withColumn("source", source_of(F.col("entity_id"))), ("source",))


@query
def profile_truth(spark, sf_dir):
    return _rounded(profile.profile_truth(demo.truth_table(spark, sf_dir)).withColumn("max_match_count", F.col("max_match_count").cast("long")))


def _labelled(spark, sf_dir):
    return labels.label_candidates(matrix(spark, sf_dir), demo.truth(spark, sf_dir)).persist()


@query
def gbt_scores(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    return models.score_pairs(rows, models.fit_gbt(rows.select(*features.FEATURES, "label")))


@query
def logreg_scores(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    return models.score_pairs(rows, models.fit_logistic(rows.select(*features.FEATURES, "label")))
