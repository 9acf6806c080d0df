"""Every stage of the pipeline on its own input, against a brute-force version."""

import re
from collections import Counter

import corpus_pipeline
from kinspan.llm import queries
from kinspan.llm.common import table

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"] and corpus_pipeline.ORACLE_SQL is None

    good = stages["quality"](spark, docs, SF)
    assert good.columns == columns
    kept = {r.doc_id for r in good.collect()}
    known = [(i, q) for i, q in labels.items()]
    assert sum((i in kept) == bool(q) for i, q in known) / len(known) > 0.9

    rows = sorted(good.collect(), key=lambda r: r.doc_id)
    s = [shingles(r.text) for r in rows]
    comp = list(range(len(rows)))
    links = [(i, j) for i in range(len(s)) for j in range(i) if s[i] and s[j] and 5 * len(s[i] & s[j]) >= 4 * len(s[i] | s[j])]
    for _ in rows:
        for i, j in links:
            comp[i] = comp[j] = min(comp[i], comp[j])
    unique = stages["near_duplicates"](spark, good, SF)
    assert unique.columns == columns and {r.doc_id for r in unique.collect()} == {rows[c].doc_id for c in set(comp)}

    bench = [shingles(r.text) for r in table(spark, SF, "benchmark").collect()]
    left = [r for r in unique.collect() if not any(100 * len(b & shingles(r.text)) >= 80 * len(b) for b in bench if b)]
    clean = stages["decontamination"](spark, unique, SF)
    assert clean.columns == columns and sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in left)

    mixed = stages["mixing"](spark, clean, SF)
    assert mixed.columns == columns and max(Counter(r.doc_id for r in mixed.collect()).values()) <= 3
    total = sum(len(words(r.text)) for r in left)
    assert abs(sum(len(words(r.text)) for r in mixed.collect()) - total) < 0.05 * total

    last = stages["sharding"](spark, mixed, SF).collect()
    assert Counter(r.doc_id for r in last) == Counter(r.doc_id for r in mixed.collect()) and len({(r.shard, r.slot) for r in last}) == len(last)


def test_repeated_rows_and_ids(spark):
    docs = table(spark, SF, "documents")
    again = docs.unionByName(docs)
    out = corpus_pipeline.near_duplicates(spark, again, SF)
    assert out.count() == out.select("doc_id").distinct().count()
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), SF).count() == 0


def test_queries_have_their_names():
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{i}" for i in range(1, 11)] and set(queries.oracle_sql()) <= set(queries.queries())
