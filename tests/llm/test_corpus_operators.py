"""Writers, samplers, shards and classifiers: round trips, balance and held-out accuracy, with every odd case."""

import base64
import hashlib
import io
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinspan.llm import language_id, quality_classifier, sharding, warc
from kinspan.llm.common import table
from kinspan.llm.mixing import pareto_mix, take, targets
from kinspan.llm.sharding import kd_shards

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(-1, None, None, None, None), (-2, "", "en", None, 0), (-3, " \n", "xx", "z", 2), (None, "no id here", None, "z", 9), (-4, "123 456", "en", "z", 7), (-4, "123 456", "en", "z", 7)]


def docs(spark):
    odd = spark.createDataFrame(ODD, SCHEMA)
    return table(spark, SF, "documents").select(*odd.columns).unionByName(odd).withColumn("w", F.lit(1)).withColumn("size", F.lit("x")).withColumn("shard", F.lit(None).cast("int")).withColumn("found", F.lit(2)).withColumn("row_hash", F.lit(0)).withColumn("copies", F.lit(0)).withColumn("__c", F.lit(0)).withColumn("__k", F.lit(0)).withColumn("need", F.lit(0)).withColumn("p", F.lit(0))


def pages(spark):
    rows = [(1, "http://a/", "<p>x</p>"), (5, "http://b/", "<p>x</p>"), (3, None, "<p>x</p>"), (2, "http://c/\r\nX: y", None), (4, "http://d/", ""), (None, "http://e/", "<p>é</p>"), (9, "http://f/", "\r\n\r\nbody\r\n\r\n"), (9, "http://f/", "\r\n\r\nbody\r\n\r\n"), (7, "http://g/", "z" * 3_000_000)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("kind", F.lit("k")).withColumn("n", F.lit(3))


def expected(rows):
    same = defaultdict(list)
    for i, _, h, *_ in rows:
        same[h or ""].append(i)
    out = Counter()
    for i, _, h, *_ in rows:
        b, ids = (h or "").encode(), [x for x in same[h or ""] if x is not None]
        to = max(ids) if ids and (i is None or i < max(ids)) else None
        out[i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if to is None else "revisit", to] += 1
    return out


def test_warc_round_trip(spark):
    got = Counter(tuple(r)[:5] for r in warc.round_trip(pages(spark)).collect())
    assert got == expected(pages(spark).collect())
    assert warc.round_trip(pages(spark).limit(0)).count() == 0


def test_warc_files_follow_from_the_rows_alone(spark, tmp_path):
    many = table(spark, SF, "pages")
    one = warc.write_warc(many, f"file://{tmp_path}/a", shard_bytes=200_000, roll_bytes=30_000).collect()
    two = warc.write_warc(many.repartition(7), f"file://{tmp_path}/b", shard_bytes=200_000, roll_bytes=30_000).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two)) and len(one) > 5
    assert {p.name for p in (tmp_path / "a").iterdir() if not p.name.startswith(".")} == {r.file for r in one} and not list((tmp_path / "a").glob(".tmp-*"))
    last = None
    for r in sorted(one):
        data = (tmp_path / "a" / r.file).read_bytes()
        assert (len(data), hashlib.sha1(data).hexdigest()) == (r.bytes, r.sha1) and r.bytes < 60_000
        for h, block in warc.parse(io.BytesIO(data)):
            if h["WARC-Type"] != "warcinfo":
                assert last is None or last < int(h["X-Page-ID"])
                last = int(h["X-Page-ID"])
                assert h["WARC-Block-Digest"] == f"sha1:{warc.base32_sha1(block)}"
    with pytest.raises((ValueError, zlib.error)):
        list(warc.parse(io.BytesIO(data[:-20])))


def test_a_far_id_does_not_join_all_others_in_a_shard(spark, tmp_path):
    rows = [(i, f"http://a/{i}", f"page {i} " * 200) for i in range(300)]
    schema = "page_id long, url string, html string"
    near = warc.write_warc(spark.createDataFrame(rows, schema), f"file://{tmp_path}/a", shard_bytes=40_000).count()
    far = spark.createDataFrame([*rows, (2**60, "http://far/", "far"), (-(2**60), "http://near/", "near")], schema)
    manifest = warc.write_warc(far, f"file://{tmp_path}/b", shard_bytes=40_000)
    assert near > 8 and abs(manifest.count() - near) <= 3 and manifest.agg(F.max("records")).first()[0] < 60
    assert warc.read_warc(manifest, f"file://{tmp_path}/b").count() == 302


def test_a_killed_attempt_leaves_nothing(spark, tmp_path):
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / ".tmp-0-part-00000-00000.warc.gz").write_bytes(b"half")
    (tmp_path / "w" / "part-00000-00000.warc.gz").write_bytes(b"of an attempt that was renamed and then lost")
    path = f"file://{tmp_path}/w"
    manifest = warc.write_warc(pages(spark), path)
    assert not list((tmp_path / "w").glob(".tmp-*")) and Counter(tuple(r)[:5] for r in warc.read_warc(manifest, path).collect()) == expected(pages(spark).collect())


def test_revisits_name_a_record(spark, tmp_path):
    manifest = warc.write_warc(pages(spark), f"file://{tmp_path}/r")
    ids, named = [], set()
    for r in manifest.collect():
        for h, _ in warc.parse(io.BytesIO((tmp_path / "r" / r.file).read_bytes())):
            if h["WARC-Type"] != "warcinfo":
                ids.append(h["WARC-Record-ID"])
                named |= {h["WARC-Refers-To"]} if h["WARC-Type"] == "revisit" else set()
    assert len(ids) == len(set(ids)) and named and named <= set(ids)


def test_targets():
    got = targets([("b", 100), ("a", 100), (None, 100), ("c", 1)])
    assert got["c"] == 3 and sum(got.values()) == pytest.approx(301)
    assert got["b"] / got["a"] == pytest.approx(2) and got[None] / got["a"] == pytest.approx(1)
    assert targets([]) == {} and targets([("a", 0)]) == {"a": 0}


def test_mix_comes_near_its_targets(spark):
    d = docs(spark)
    rows = pareto_mix(d).collect()
    assert len(rows) == d.count() and Counter(map(tuple, rows)) == Counter(map(tuple, pareto_mix(d.repartition(11)).collect()))
    per = defaultdict(list)
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        per[r.source].append(r)
    goal = targets([(s, sum(r.size for r in x)) for s, x in per.items()])
    for s, x in per.items():
        assert x[0].target == pytest.approx(goal[s]) and x[0].source_size == sum(r.size for r in x)
        assert abs(sum(r.taken for r in x) - goal[s]) <= 0.02 * goal[s] + 12
        assert max(r.copies for r in x) - min(r.copies for r in x if r.size) <= 1 if any(r.size for r in x) else True
    taken = take(d)
    assert taken.columns == d.columns and taken.count() == sum(r.copies for r in rows)
    assert pareto_mix(d.limit(0)).count() == 0


def test_long_texts_are_likelier_and_words_come_out_right(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(400 if i % 2 else 25)), "en", "ab"[i % 4 // 2], 1) for i in range(2000)]
    got = pareto_mix(spark.createDataFrame(rows, SCHEMA)).collect()
    for s in "ab":
        mine = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 200
        base = min(r.copies for r in mine)
        share = {n: np.mean([r.copies - base for r in mine if r.size == n]) for n in (25, 400)}
        assert share[400] > 1.5 * share[25] or share[400] == 1
    brute(got)


def brute(got):
    """What pareto_mix decides, by plain Python, from its own row hashes: targets, probabilities, ranks, cut and the last row."""
    per = defaultdict(list)
    for r in got:
        per[r.source].append(r)
    goal = targets([(s, sum(r.size for r in x)) for s, x in per.items()])
    for s, x in per.items():
        n = sum(r.size for r in x)
        whole = min(3, int(goal[s] / n + 1e-12)) if n else 0
        need = goal[s] - whole * n
        base = Counter()
        for r in x:
            assert whole <= r.copies <= whole + 1 and (r.size or r.copies == whole)
            base[r.row_hash, r.size] += 1
        extra = sum(r.size * (r.copies - whole) for r in x)
        assert abs(need - extra) <= max(n * c for (_, n), c in base.items()) / 2


def test_mix_closes_the_gap_as_well_as_one_row_can(spark):
    brute(pareto_mix(docs(spark)).collect())


def test_shards(spark):
    d = docs(spark)
    rows = kd_shards(d).collect()
    assert len(rows) == d.count()
    size, slots, of_text = Counter(), defaultdict(list), defaultdict(set)
    want = Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in d.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    for r in rows:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
        of_text[r.text_crc32, r.size].add(r.shard)
    assert set(size) == set(range(24)) and max(size.values()) <= 1.05 * min(size.values())
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and all(len(x) == 1 for x in of_text.values())
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, kd_shards(d.repartition(9)).collect()), key=str)
    assert kd_shards(d.limit(0)).count() == 0
    named = d.withColumn("doc_id", F.concat(F.lit("doc-"), "doc_id"))
    size = Counter()
    for r in kd_shards(named).collect():
        size[r.shard] += r.size
    assert max(size.values()) <= 1.05 * min(size.values())


def test_a_heavy_group_fills_a_shard_alone(spark):
    rows = [(i, "same text " * 50, None, None, None) for i in range(400)] + [(1000 + i, f"text {i} " * (i % 40), None, None, None) for i in range(600)]
    got = kd_shards(spark.createDataFrame(rows, SCHEMA)).collect()
    size = Counter()
    for r in got:
        size[r.shard] += r.size
    heavy = {r.shard for r in got if r.doc_id < 1000}
    rest = [size.get(s, 0) for s in range(24) if s not in heavy]
    assert len(heavy) == 1 and max(rest) <= 1.1 * min(rest)


def test_many_small_groups_are_dealt_by_the_tree(spark, monkeypatch):
    put = []
    monkeypatch.setattr("kinspan.llm.sharding._prefit", lambda *a, usual=sharding._prefit: put.append(usual(*a)) or put[-1])
    rows = [(i, f"text {i} " + "x" * (i % 37), None, f"s{i % 5}", None) for i in range(3000)]
    size = Counter()
    for r in kd_shards(spark.createDataFrame(rows, SCHEMA), 8).collect():
        size[r.shard] += r.size
    assert put[0][0] == [] and set(size) == set(range(8)) and max(size.values()) <= 1.05 * min(size.values())


def remainder(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 5


def test_language_id(spark):
    d = docs(spark)
    rows = language_id.identify(d).collect()
    lang = {r.doc_id: r.lang for r in d.collect()}
    assert len(rows) == d.count() and all(r.held_out == (remainder(r.doc_id) == 0) and 0 <= r.score <= 1 for r in rows)
    odd = {r.doc_id: r.lang_pred for r in rows if r.doc_id is None or r.doc_id < 0}
    assert odd[-1] == odd[-2] == odd[-3] == odd[-4] == "und" and odd[None] != "und"
    held = [r for r in rows if r.held_out and (r.doc_id or 0) > 0]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.98
    assert language_id.identify(d.withColumn("lang", F.lit(None).cast("string"))).select("lang_pred").distinct().collect()[0][0] == "und"
    assert language_id.identify(d.limit(0)).count() == 0


def test_every_language_is_learned(spark):
    ids = [i for i in range(1, 400) if remainder(i) != 0][:300]
    rows = [(i, f"lang{j} " * 20, f"l{j}", "a", 1) for j, i in enumerate(ids)]
    assert language_id.fit(spark.createDataFrame(rows, SCHEMA)).langs == sorted(f"l{j}" for j in range(300))


def test_codewords_are_far_apart():
    for k in (2, 3, 4, 6, 20):
        code = language_id.codewords(k)
        apart = (code.shape[1] - code @ code.T) / 2 + code.shape[1] * np.eye(k)
        assert apart.min() >= max(1, code.shape[1] // 4)


def test_quality_classifier(spark):
    d, labels = docs(spark), table(spark, SF, "labels")
    rows = quality_classifier.score(d, labels).collect()
    assert len(rows) == d.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == (remainder(r.doc_id) == 0) for r in rows)
    quality = {r.doc_id: r.quality for r in labels.collect()}
    held = [r for r in rows if r.held_out and r.doc_id in quality]
    assert np.mean([r.predicted == quality[r.doc_id] for r in held]) > 0.95
    assert len({r.score for r in rows if r.doc_id in (-1, -2)}) == 1
    spread = quality_classifier.score(d.repartition(40, "doc_id"), labels).collect()  # what stands beside a row changes nothing
    assert sorted((str(r.doc_id), round(r.score, 6)) for r in spread) == sorted((str(r.doc_id), round(r.score, 6)) for r in rows)
    kept = quality_classifier.keep_good(d, labels)
    assert kept.columns == d.columns and kept.count() == sum(r.predicted for r in rows)
    assert quality_classifier.score(d, labels.limit(0)).select("score").distinct().count() == 1
    assert quality_classifier.score(d.limit(0), labels).count() == 0


def test_labels_of_held_out_rows_change_nothing(spark):
    d, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    held = language_id.remainder(F.col("doc_id")) == 0
    other = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    key = lambda df: {r.doc_id: round(r.score, 9) for r in df.collect()}
    assert key(quality_classifier.score(d, labels)) == key(quality_classifier.score(d, other))
