import math
import random
from collections import Counter
from itertools import product

import plain
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinspan.functions import similarity as S
from kinspan.operators import features

SCHEMA = "entity_id string, business_name string, business_address string, country string"


def compute(spark, pairs, s1, others):
    p = spark.createDataFrame([(a, b, b[:2]) for a, b in pairs], "source1_entity_id string, candidate_entity_id string, source string")
    got = features.compute_features(p, spark.createDataFrame(s1, SCHEMA), spark.createDataFrame(others, SCHEMA))
    assert got.columns[3:] == features.FEATURES and len(features.FEATURES) == 26
    return {(r.source1_entity_id, r.candidate_entity_id): r for r in got.collect()}


def test_same_records(spark):
    r = compute(spark, [("S1-1", "S2-1")], [("S1-1", "Acme Corp", "10 Main Road", "US")], [("S2-1", "Acme Corp", "10 Main Road", "US")])["S1-1", "S2-1"]
    for c in ("name_exact_raw", "name_exact_norm", "addr_exact_norm", "country_exact", "name_jaccard", "name_levenshtein", "name_jaro_winkler", "name_x_addr_jaccard"):
        assert r[c] == 1.0
    assert r.name_tfidf_cosine == pytest.approx(1) and not any(math.isnan(x) for x in r[3:])


def test_other_records(spark):
    r = compute(spark, [("S1-1", "S2-1")], [("S1-1", "Acme Corp", "10 Main Road", "US")], [("S2-1", "Zyx Qwv", "", "India")])["S1-1", "S2-1"]
    assert r.name_exact_norm == r.country_exact == r.name_jaccard == r.addr_tfidf_cosine == 0.0
    assert r.addr_len_diff == len("10 main road") - 1 and r.addr_len_ratio == pytest.approx(1 / 12)


def test_both_addresses_empty(spark):
    r = compute(spark, [("S1-1", "S3-1")], [("S1-1", "Acme", "", "US")], [("S3-1", "Acme", "", "US")])["S1-1", "S3-1"]
    assert r.addr_jaccard == r.addr_exact_norm == r.addr_levenshtein == r.addr_token_sort == 1.0
    assert r.addr_tfidf_cosine == r.addr_shared_digit_token == 0.0 and all(math.isfinite(x) for x in r[3:])


def test_features_belong_to_their_pair_in_any_order(spark):
    s1 = [("S1-1", "Acme Corp", "1 Elm St", "US"), ("S1-2", "Blue", "22 Oak Avenue", "US")]
    other = [("S2-1", "Acme Corporation", "1 Elm Street", "US"), ("S2-2", "Blue Sky Limited", "", "US")]
    pairs = list(product(["S1-1", "S1-2"], ["S2-1", "S2-2"]))
    a, b = compute(spark, pairs, s1, other), compute(spark, pairs[::-1], s1[::-1], other)
    assert a == b and a["S1-1", "S2-1"].name_levenshtein > a["S1-2", "S2-1"].name_levenshtein
    assert a["S1-2", "S2-2"].name_len_diff == len("blue sky limited") - 4


def test_unknown_record_raises(spark):
    with pytest.raises(Exception, match="no record for pair"):
        compute(spark, [("S1-1", "S2-9")], [("S1-1", "A", "", "US")], [("S2-1", "A", "", "US")])


words = st.lists(st.text("abé𝒳", max_size=5), max_size=4).map(" ".join)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(words, words), max_size=20))
def test_batches_of_strings(pairs):
    a, b = [x for x, _ in pairs], [y for _, y in pairs]
    assert S.lcs_many(a, b).tolist() == [plain.lcs(x, y) for x, y in pairs]
    assert S.partial_many(a, b).tolist() == pytest.approx([plain.partial(x, y) for x, y in pairs])


def test_long_strings_and_small_tables(monkeypatch):
    rng = random.Random(1)
    text = lambda: "".join(rng.choice("abcd") for _ in range(rng.choice([0, 1, 63, 64, 65, 128, 200])))
    a, b = [text() for _ in range(40)], [text() for _ in range(40)]
    for cells in (1, 1 << 12, 1 << 22):
        monkeypatch.setattr(S, "CELLS", cells)
        assert S.lcs_many(a, b).tolist() == [plain.lcs(x, y) for x, y in zip(a, b, strict=True)]
    assert S.partial_many(a[:8], b[:8]).tolist() == pytest.approx([plain.partial(x, y) for x, y in zip(a[:8], b[:8], strict=True)])


def test_similarities(spark):
    rng = random.Random(2)
    line = lambda n: " ".join("".join(rng.choice("abé") for _ in range(rng.randint(1, 4))) for _ in range(n))
    rows = [(line(rng.randint(0, 4)), line(rng.choice([0, 1, 2, 4, 14]))) for _ in range(300)] + [("abc", "abc " + "z" * 20), ("abc", "abc" + "z" * 40), ("", ""), ("b a", "a b"), ("a b", "a b c"), ("abc", "xxabcxx")]
    df = spark.createDataFrame(rows, "a string, b string")
    a, b = F.col("a"), F.col("b")
    x, y = (F.array_remove(F.split(c, " "), "") for c in (a, b))
    got = df.select(a, b, S.ratio(a, b).alias("r"), S.token_sort_ratio(x, y).alias("sort"), S.token_set_ratio(x, y).alias("set"), S.weighted_ratio(a, b, x, y).alias("w")).collect()
    for r in got:
        assert (r.r, r.sort, r.set, r.w) == pytest.approx((plain.ratio(r.a, r.b), plain.token_sort(r.a, r.b), plain.token_set(r.a, r.b), plain.weighted(r.a, r.b))), r


def test_cosines_and_the_limit_on_grams(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 5)))
    texts = [" ".join(word() for _ in range(rng.randint(0, 5))) for _ in range(60)]
    rows = [(f"S1-{i}", f"S{2 + i % 2}-{i}", f"S{2 + i % 2}", texts[i], texts[rng.randrange(60)]) for i in range(60)]
    wide = spark.createDataFrame(rows, "source1_entity_id string, candidate_entity_id string, source string, name_norm_l string, name_norm_r string")
    grams = lambda t: Counter(w[i : i + k] for w in (f" {x} " for x in t.split()) for k in (3, 4) for i in range(len(w) - k + 1))
    for most in (25, 10**6):
        want = {}
        for s in ("S2", "S3"):
            mine = {t for r in rows if r[2] == s for t in r[3:] if t}
            total, df = Counter(), Counter()
            for t in mine:
                total.update(grams(t))
                df.update(set(grams(t)))
            idf = {g: math.log((1 + len(mine)) / (1 + df[g])) + 1 for g, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:most]}
            for r in rows:
                if r[2] == s:
                    x, y = ({g: n * idf[g] for g, n in grams(t).items() if g in idf} for t in r[3:])
                    norm = math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
                    want[r[0]] = sum(v * y.get(g, 0) for g, v in x.items()) / norm if norm else 0.0
        got = {r.source1_entity_id: r.c for r in wide.select("source1_entity_id", features.tfidf_cosine(wide, "name", most).alias("c")).collect()}
        assert got == pytest.approx(want) and max(want.values()) > 0.1
