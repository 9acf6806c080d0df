from pyspark.sql import functions as F

from kinspan.operators import blocking
from kinspan.schema import BlockingConfig

SCHEMA = "entity_id string, business_name string, business_address string, country string"


def table(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def pairs(spark, s1, s2, s3, **more):
    got = blocking.generate_candidates(table(spark, *s1), table(spark, *s2), table(spark, *s3), **more).collect()
    return {(r.source1_entity_id, r.candidate_entity_id): r for r in got}


def test_a_match_and_another_country(spark):
    got = pairs(spark, [("S1-1", "Acme Corp", "10 Main Road", "US")], [("S2-1", "Acme Corporation", "10 Main Rd", "US")], [("S3-1", "Acme Corp", "10 Main Road", "India")])
    assert set(got) == {("S1-1", "S2-1")}


def test_empty_side_and_empty_fields(spark):
    got = pairs(spark, [("S1-1", "", "", "US"), ("S1-2", "Blue Sky", "", "US")], [("S2-1", None, None, "US"), ("S2-2", "Blue Sky", "", "US")], [])
    assert set(got) == {("S1-2", "S2-2")}


def test_the_cap_is_over_both_sources_and_ties_go_by_id(spark):
    same = [(f"S{n}-{i:02d}", "Acme Corp", "10 Main Road", "US") for n in (2, 3) for i in range(30)]
    got = pairs(spark, [("S1-1", "Acme Corp", "10 Main Road", "US")], [r for r in same if r[0] < "S3"], [r for r in same if r[0] > "S3"], max_candidates=4)
    assert [c for _, c in sorted(got)] == ["S2-00", "S2-01", "S2-02", "S2-03"]


def test_repeated_tokens_count(spark):
    keys = blocking.explode_keys(blocking.prepare(table(spark, ("S1-1", "acme acme", "", "US"))))
    assert keys.where("key_type = 'name_token'").count() == 2


def test_key_types(spark):
    keys = blocking.explode_keys(blocking.prepare(table(spark, ("S1-1", "A-1 Bo", "near 5 Elm St 1234 x77", "US"))))
    assert sorted((r.key_type, r.key) for r in keys.collect()) == [("addr_digit", "1234"), ("addr_token", "elm"), ("addr_token", "x77"), ("name_prefix", "a1bo")]


def test_pruning_limits_are_inclusive_and_per_source(spark):
    s1 = [(f"S1-{i}", "Zeta", "", "US") for i in range(4)]
    s2 = [(f"S2-{i}", "Zeta", "", "US") for i in range(3)]
    s3 = [(f"S3-{i}", "Zeta", "", "US") for i in range(5)]
    keys = blocking.keys_of(table(spark, *s1), table(spark, *s2), table(spark, *s3))
    kept = lambda cfg: {r.source for r in blocking.surviving_keys(*keys, cfg).collect()}
    assert kept(BlockingConfig(max_posting=5, max_product=20)) == {"S2", "S3"}
    assert kept(BlockingConfig(max_posting=5, max_product=19)) == {"S2"}
    assert kept(BlockingConfig(max_posting=4)) == {"S2"}
    assert kept(BlockingConfig(max_posting=3)) == set()
    assert {r.source: r.estimated_pairs for r in blocking.pair_estimate(blocking.surviving_keys(*keys)).collect()} == {"S2": 24, "S3": 40}


def test_partitioning_changes_nothing(spark):
    s1 = table(spark, *[(f"S1-{i}", f"Firm {i % 3} Co", f"{100 + i} Elm St", "US") for i in range(9)])
    s2 = table(spark, *[(f"S2-{i}", f"Firm {i % 3} Company", f"{100 + i} Elm Street", "US") for i in range(9)])
    one = blocking.generate_candidates(s1.coalesce(1), s2.coalesce(1), s2.where(F.lit(False)), 3)
    many = blocking.generate_candidates(s1.repartition(7), s2.repartition(5), s2.where(F.lit(False)), 3)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
