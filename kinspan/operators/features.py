"""The 26 similarity features of a candidate pair."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from kinspan.functions import normalize as N
from kinspan.functions.similarity import ratio, token_set_ratio, token_sort_ratio, weighted_ratio
from kinspan.operators.blocking import prepare
from kinspan.operators.lineage import cut
from kinspan.schema import NAME_NGRAM, PAIR

#: Fixed order of the feature matrix.
FEATURES = [
    "name_exact_raw", "name_exact_norm", "name_levenshtein", "name_jaro_winkler", "name_token_sort", "name_token_set", "name_jaccard",
    "name_char_ngram_jaccard", "name_tfidf_cosine", "name_len_ratio", "name_len_diff", "name_token_count_diff", "name_shared_rare_token",
    "addr_exact_norm", "addr_levenshtein", "addr_token_sort", "addr_jaccard", "addr_tfidf_cosine", "addr_shared_digit_token",
    "addr_shared_rare_token", "addr_len_ratio", "addr_len_diff", "country_exact", "name_x_addr_jaccard", "country_x_name_jaccard", "country_x_addr_jaccard",
]
MAX_GRAMS = 200_000


def paired(pairs: DataFrame, s1: DataFrame, others: DataFrame) -> DataFrame:
    """pairs (source1_entity_id, candidate_entity_id, source) with both records' normal forms, suffixed _l and _r.

    Records that no pair names are left out before they are normalized. Raises where a pair names an unknown record."""
    def side(records: DataFrame, key: str, end: str) -> DataFrame:
        used = records.join(pairs.select(F.col(key).alias("entity_id")).distinct(), "entity_id", "left_semi")
        p = prepare(used).withColumn("name_norm", F.array_join("name_tokens", " ")).withColumn("addr_norm", F.array_join("addr_tokens", " "))
        p = p.withColumn("known", F.lit(True))
        return p.select(F.col("entity_id").alias(key), *[F.col(c).alias(f"{c}{end}") for c in p.columns if c != "entity_id"])

    wide = pairs.select(*PAIR, "source").join(side(s1, PAIR[0], "_l"), PAIR[0], "left").join(side(others, PAIR[1], "_r"), PAIR[1], "left")
    check = lambda c: F.when(F.col(c), True).otherwise(F.raise_error(F.concat(F.lit("no record for pair "), *[F.col(x) for x in PAIR])).cast("boolean"))
    return wide.where(check("known_l") & check("known_r")).drop("known_l", "known_r")


def jaccard(a: Column, b: Column) -> Column:
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def _lengths(c: str) -> tuple[Column, Column]:
    one = lambda end: F.greatest(F.length(f"{c}{end}"), F.lit(1))  # noqa: E731  an empty string counts as one character
    return one("_l"), one("_r")


def direct_features(wide: DataFrame) -> DataFrame:
    """The features that follow from a pair alone, without Python."""
    flag = lambda x: x.cast("double")
    same = lambda c: flag(F.col(f"{c}_l") == F.col(f"{c}_r"))
    nl, nr = _lengths("name_norm")
    al, ar = _lengths("addr_norm")
    return wide.withColumns({
        "name_exact_raw": same("business_name"), "name_exact_norm": same("name_norm"), "addr_exact_norm": same("addr_norm"), "country_exact": same("country_norm"),
        "name_jaccard": jaccard(F.col("name_tokens_l"), F.col("name_tokens_r")), "addr_jaccard": jaccard(F.col("addr_tokens_l"), F.col("addr_tokens_r")),
        "name_char_ngram_jaccard": jaccard(N.char_ngrams(F.col("name_norm_l"), NAME_NGRAM), N.char_ngrams(F.col("name_norm_r"), NAME_NGRAM)),
        "name_len_ratio": F.least(nl, nr) / F.greatest(nl, nr), "name_len_diff": F.abs(nl - nr).cast("double"),
        "addr_len_ratio": F.least(al, ar) / F.greatest(al, ar), "addr_len_diff": F.abs(al - ar).cast("double"),
        "name_token_count_diff": F.abs(F.size("name_tokens_l") - F.size("name_tokens_r")).cast("double"),
        "addr_shared_digit_token": flag(F.arrays_overlap("digit_tokens_l", "digit_tokens_r")),
    }).withColumns({
        "name_x_addr_jaccard": F.col("name_jaccard") * F.col("addr_jaccard"),
        "country_x_name_jaccard": F.col("country_exact") * F.col("name_jaccard"),
        "country_x_addr_jaccard": F.col("country_exact") * F.col("addr_jaccard"),
    })


FUZZY = {
    "name_levenshtein": lambda: ratio(F.col("name_norm_l"), F.col("name_norm_r")),
    "name_jaro_winkler": lambda: weighted_ratio(F.col("name_norm_l"), F.col("name_norm_r"), F.col("name_tokens_l"), F.col("name_tokens_r")),
    "name_token_sort": lambda: token_sort_ratio(F.col("name_tokens_l"), F.col("name_tokens_r")),
    "name_token_set": lambda: token_set_ratio(F.col("name_tokens_l"), F.col("name_tokens_r")),
    "addr_levenshtein": lambda: ratio(F.col("addr_norm_l"), F.col("addr_norm_r")),
    "addr_token_sort": lambda: token_sort_ratio(F.col("addr_tokens_l"), F.col("addr_tokens_r")),
}


def fuzzy_features(wide: DataFrame, names: tuple[str, ...] = tuple(FUZZY)) -> DataFrame:
    """wide with the asked similarities: strings cross to Python once, in Arrow batches, and only those that these need."""
    return wide.withColumns({n: FUZZY[n]() for n in names})


def token_rarity(wide: DataFrame, field: str) -> DataFrame:
    """(source, token, weight): log of all token lists of the pairs over those that hold the token; a record counts once for each of its pairs."""
    lists = wide.select("source", F.explode(F.array(f"{field}_tokens_l", f"{field}_tokens_r")).alias("toks"))
    total = wide.groupBy("source").agg((F.count("*") * 2).alias("n"))
    counts = lists.select("source", F.explode(F.array_distinct("toks")).alias("token")).groupBy("source", "token").agg(F.count("*").alias("c"))
    return counts.join(F.broadcast(total), "source").select("source", "token", F.ln(F.col("n") / F.col("c")).alias("weight"))


def shared_rare_token(wide: DataFrame, field: str) -> DataFrame:
    """(pair, <field>_shared_rare_token): the weight of the rarest shared token; pairs that share none are absent."""
    shared = wide.select(*PAIR, "source", F.explode(F.array_intersect(f"{field}_tokens_l", f"{field}_tokens_r")).alias("token"))
    return shared.join(token_rarity(wide, field), ["source", "token"]).groupBy(*PAIR, "source").agg(F.max("weight").alias(f"{field}_shared_rare_token"))


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, code points) of all grams of 3 and 4 characters of each word with a space on both sides, for texts whose words stand a space apart.

    A gram lies within a padded word if no character inside it is a space."""
    line = "".join(f" {t} " for t in texts)
    codes = np.frombuffer(f"{line}   ".encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(codes) - 3
    text = np.repeat(np.arange(len(texts)), np.fromiter((len(t) + 2 for t in texts), np.int64, len(texts)))
    inner, second = codes[1 : n + 1] != 32, codes[2 : n + 2] != 32
    at = np.concatenate([np.flatnonzero(inner[: n - 2]), np.flatnonzero((inner & second)[: n - 3])])
    four = np.stack([codes[at], codes[at + 1], codes[at + 2], codes[at + 3]], axis=1)
    four[: int(inner[: n - 2].sum()), 3] = 0
    return text[at], _hashes(four), four


def _hashes(four: np.ndarray) -> np.ndarray:
    h = np.zeros(len(four), np.uint64)
    for i in range(4):
        h = (h ^ four[:, i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def _counted(batches):
    import pyarrow as pa

    for batch in batches:
        source = batch.column("source").to_pylist()
        for s in sorted(set(source)):
            text, h, four = _grams([t for t, x in zip(batch.column("text").to_pylist(), source, strict=True) if x == s])
            gram, first, at = np.unique(h, return_index=True, return_inverse=True)
            df = np.bincount(np.unique(text * max(1, len(gram)) + at) % max(1, len(gram)), minlength=len(gram))
            names = np.ascontiguousarray(four[first]).view("<U4").ravel()
            yield pa.RecordBatch.from_arrays([pa.array([s] * len(gram), pa.string()), pa.array(names.tolist(), pa.string()), pa.array(df, pa.int64()), pa.array(np.bincount(at, minlength=len(gram)), pa.int64())], names=["source", "gram", "df", "tf"])


def gram_weights(wide: DataFrame, field: str, max_grams: int = MAX_GRAMS) -> DataFrame:
    """(source, gram, idf) of the max_grams most frequent grams (ties by the gram) of the distinct texts among a source's pairs.

    How many grams have a frequency is counted first: only those of the frequency that is cut through are ranked."""
    texts = wide.select("source", F.explode(F.array(f"{field}_norm_l", f"{field}_norm_r")).alias("text")).where(F.col("text") != "").distinct()
    grams = cut(texts.mapInArrow(_counted, "source string, gram string, df long, tf long").groupBy("source", "gram").agg(F.sum("df").alias("df"), F.sum("tf").alias("all")))
    upto = F.sum("c").over(Window.partitionBy("source").orderBy(F.desc("all")))
    levels = grams.groupBy("source", "all").agg(F.count("*").alias("c")).withColumn("room", F.lit(max_grams) - upto + F.col("c")).where("room > 0")
    sized = grams.join(levels, ["source", "all"])
    whole = sized.where("c <= room").select("source", "gram", "df")
    part = sized.where("c > room").withColumn("r", F.row_number().over(Window.partitionBy("source").orderBy("gram"))).where("r <= room").select("source", "gram", "df")
    total = texts.groupBy("source").agg(F.count("*").alias("n"))
    return whole.unionByName(part).join(F.broadcast(total), "source").select("source", "gram", (F.ln((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))


def _cosines(left: list[str], right: list[str], hashes: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Cosines of the texts' unit TF-IDF vectors; 0 where either has no known gram."""
    at, texts = pd.factorize(np.array([*left, *right], dtype=object))
    text, h, _ = _grams(texts.tolist())
    size = max(1, len(hashes))
    gram = np.minimum(np.searchsorted(hashes, h), size - 1)
    known = hashes[gram] == h if len(hashes) else np.zeros(len(h), bool)
    key, tf = np.unique(text[known] * size + gram[known], return_counts=True)
    x = tf * idf[key % size]
    owner = key // size
    norm = np.sqrt(np.bincount(owner, x * x, minlength=len(texts)))
    x = x / norm[owner]
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    l, r = at[: len(left)], at[len(left) :]
    many = np.diff(first)[l]
    pair = np.repeat(np.arange(len(l)), many)
    mine = np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many) + first[l][pair]
    want = r[pair] * size + key[mine] % size
    other = np.minimum(np.searchsorted(key, want), max(0, len(key) - 1))
    met = key[other] == want if len(key) else np.zeros(0, bool)
    return np.bincount(pair[met], x[mine[met]] * x[other[met]], minlength=len(l))


def tfidf_cosine(wide: DataFrame, field: str, max_grams: int = MAX_GRAMS) -> Column:
    """The cosine of both texts' TF-IDF vectors, 0 where either is empty, as a column of wide.

    The weights, at most max_grams for each source, are broadcast; pairs are not shuffled. The statistics are those of all pairs of a source."""
    weights = gram_weights(wide, field, max_grams).toArrow()
    table = {}
    source, gram, idf = weights.column("source").to_numpy(), weights.column("gram").to_pylist(), weights.column("idf").to_numpy()
    for s in set(source.tolist()):
        mine = np.flatnonzero(source == s)
        h = _hashes(np.array([gram[i] for i in mine], dtype="<U4").view(np.uint32).reshape(-1, 4))
        order = np.argsort(h)
        table[s] = h[order], idf[mine][order]
    shared = wide.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf(T.DoubleType())
    def cosine(source: pd.Series, left: pd.Series, right: pd.Series) -> pd.Series:
        out = np.zeros(len(source))
        for s, (hashes, idf) in shared.value.items():
            mine = np.flatnonzero((source == s).to_numpy())
            if len(mine):
                out[mine] = _cosines(left.to_numpy(object)[mine].tolist(), right.to_numpy(object)[mine].tolist(), hashes, idf)
        return pd.Series(out)

    return cosine("source", f"{field}_norm_l", f"{field}_norm_r")


def compute_features(pairs: DataFrame, s1: DataFrame, others: DataFrame, single: bool = True) -> DataFrame:
    """The pair's ids, its source and FEATURES in order (as float, or as double where not single).

    Every feature belongs to its own pair, whatever the order of rows; token and gram statistics are those of all pairs of a source."""
    wide = cut(paired(pairs, s1, others))
    keys = [*PAIR, "source"]  # all that follows is joined by the pair, so the features themselves are dealt out once
    cosines = {f"{field}_tfidf_cosine": tfidf_cosine(wide, field) for field in ("name", "addr")}
    local = fuzzy_features(direct_features(wide)).withColumns(cosines)
    out = local.select(*keys, *[c for c in FEATURES if c in local.columns])
    for field in ("name", "addr"):
        out = out.join(shared_rare_token(wide, field), keys, "left").fillna(0.0, [f"{field}_shared_rare_token"])
    kind = "float" if single else "double"
    return out.select(*PAIR, "source", *[F.col(c).cast(kind).alias(c) for c in FEATURES])
