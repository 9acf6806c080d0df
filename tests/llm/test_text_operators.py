"""The operators on texts against brute-force versions, over a fixture with every odd case."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kinspan.llm.common import components, hot_cells
from kinspan.llm.decontamination import contaminated, drop_contaminated
from kinspan.llm.ngram_join import ngram_groups
from kinspan.llm.quality_rules import quality_rules
from kinspan.llm.substring_dedup import levels, substring_dedup
from kinspan.llm.suffix_dedup import interval_tree, maximal_repeats, repeats, suffix_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def fixture(seed: int, n: int = 60):
    rng = random.Random(seed)
    vocabulary = [w + rng.choice(["", "x", "é", "."]) for w in ("the", "of", "and", "ash", "bell", "core", "dune", "elm", "Fox", "gate", "hill", "ink")] + [f"w{i}" for i in range(300)]
    words = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    passage, base = words(55), words(120)
    rows = []
    for i in range(n):
        kind = i % 8
        if kind == 0:
            w = words(rng.randint(0, 30))
        elif kind == 1:
            w = words(20) + passage + words(20)
        elif kind == 2:
            w = list(base)
        elif kind == 3:
            w = list(base)
            for _ in range(rng.randint(0, 9)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
        elif kind == 4:
            w = ["For"] * rng.randint(30, 200)
        elif kind == 5:
            w = words(40) * 2
        elif kind == 6:
            w = base[: rng.randint(60, 120)] + words(5)
        else:
            w = words(200)
        seps = [" ", "\n", "  ", "\t"]
        rows.append((i * 3, "".join(x + rng.choice(seps) for x in w), rng.choice(["en", "de", None]), rng.choice(["a", "b", None]), i))
    return rows + [(1, None, None, None, None), (4, "", "en", "a", 0), (7, " \n\t ", "en", "a", 3), (10, rows[9][1], "en", "b", 1), (13, "Ünï " * 40, "de", "b", 1), (None, rows[9][1], None, None, None)]


@pytest.fixture(scope="module", params=[1, 2])
def rows(request):
    return fixture(request.param)


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("*", *[F.lit(1).alias(c) for c in ("g", "h", "found", "shard", "lo", "size", "cluster", "toks")]).repartition(5)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sets(rows, k, lower=False):
    out = []
    for _, text, *_ in rows:
        w = split(text)
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in w] if lower else w
        out.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    return out


@pytest.mark.parametrize("hot_rows", [0, 4096])
def test_substring_dedup(spark, rows, monkeypatch, hot_rows):
    monkeypatch.setattr("kinspan.llm.common.HOT_ROWS", hot_rows)
    first, want = {}, {}
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: r[0])
    for i, text, *_ in order:
        w = split(text)
        for a in range(len(w) - 12):
            first.setdefault(tuple(w[a : a + 13]), i)
    for i, text, *_ in rows:
        w, gone = split(text), set()
        if i is not None:
            for a in range(len(w) - 12):
                if first[tuple(w[a : a + 13])] < i:
                    gone |= set(range(a, a + 13))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        want[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    got = {r[0]: tuple(r[1:]) for r in substring_dedup(frame(spark, rows)).collect()}
    assert got == want and any(v[1] for v in want.values())


@pytest.mark.parametrize("hot_rows", [0, 4096])
def test_a_whole_copy_settles_its_row_and_not_its_id(spark, monkeypatch, hot_rows):
    monkeypatch.setattr("kinspan.llm.common.HOT_ROWS", hot_rows)
    rng = random.Random(6)
    text = lambda n: [f"u{rng.randrange(10**6)}" for _ in range(n)]
    a, b, c = text(40), text(40), text(15)
    rows = [(1, a), (2, a), (2, b), (3, b[5:25] + c), (4, b), (4, a[:20] + c), (4, a[:12])]
    first, want = {}, []
    for i, w in rows:
        for x in range(len(w) - 12):
            first.setdefault(tuple(w[x : x + 13]), i)
    for i, w in rows:
        gone = {y for x in range(len(w) - 12) if first[tuple(w[x : x + 13])] < i for y in range(x, x + 13)}
        want.append((i, len(w), len(gone), " ".join(v for y, v in enumerate(w) if y not in gone)))
    for window_rows in (rows, rows[:3], rows[::-1]):
        got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in substring_dedup(frame(spark, [(i, " ".join(w), None, None, 1) for i, w in window_rows])).collect())
        assert got == sorted(want[rows.index(r)] for r in window_rows)
    assert [x[2] for x in want] == [0, 40, 0, 20, 40, 35, 0]


def test_levels():
    assert levels(13) == [7, 13] and levels(50) == [7, 13, 25, 50] and levels(3) == [3]


@pytest.mark.parametrize(("length", "hot_rows"), [(60, 4096), (60, 0), (200, 4096), (200, 0)])
def test_suffix_dedup(spark, rows, monkeypatch, length, hot_rows):
    monkeypatch.setattr("kinspan.llm.common.HOT_ROWS", hot_rows)
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    count = Counter(b[a : a + length] for _, b in texts for a in range(len(b) - length + 1))
    want = {}
    for i, b in texts:
        gone = set()
        for a in range(len(b) - length + 1):
            if count[b[a : a + length]] > 1:
                gone |= set(range(a, a + length))
        want[i] = (len(b), len(gone), sum(1 for x in gone if x - 1 not in gone), hashlib.sha256(bytes(x for j, x in enumerate(b) if j not in gone)).hexdigest())
    out = suffix_dedup(frame(spark, rows), length).collect()
    got = {r[0]: tuple(r[1:5]) for r in out}
    assert got == want and any(v[1] for v in want.values())
    assert all(sum(x.e - x.s for x in r.removed) == r.n_removed and len(r.removed) == r.n_spans and hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in out)


def test_only_cells_with_many_times_their_share_are_hot(spark):
    rows = spark.createDataFrame([(g,) for g in [7] * 5000 + list(range(-3000, 3000))], "g long")
    assert {r.g for r in rows.where(hot_cells(rows, "g")).collect()} == {7}
    assert hot_cells(rows.where("g <> 7"), "g") is None and hot_cells(rows.limit(0), "g") is None


def test_very_frequent_anchors_are_counted_string_by_string(spark, rows, monkeypatch):
    usual = {r[0]: tuple(r[1:]) for r in suffix_dedup(frame(spark, rows), 80).collect()}
    monkeypatch.setattr("kinspan.llm.suffix_dedup.IN_TASK", 1)
    assert {r[0]: tuple(r[1:]) for r in suffix_dedup(frame(spark, rows), 80).collect()} == usual


def test_repeat_groups_hold_equal_strings_and_cover_what_is_removed(spark, rows):
    texts = {i: (t or "").encode() for i, t, *_ in rows}
    groups, covered = {}, {}
    for r in maximal_repeats(frame(spark, rows), 80).collect():
        groups.setdefault(r.repeat_id, set()).add((r.doc_id, r.start, texts[r.doc_id][r.start : r.start + r.n_bytes]))
        covered.setdefault(r.doc_id, set()).update(range(r.start, r.start + r.n_bytes))
        assert 80 <= r.n_bytes and r.start + r.n_bytes <= len(texts[r.doc_id])
    assert all(len({x for *_, x in g}) == 1 for g in groups.values()) and max(map(len, groups.values())) > 1
    want = {r.doc_id: {x for a in r.removed for x in range(a.s, a.e)} for r in suffix_dedup(frame(spark, rows), 80).collect() if r.n_removed}
    assert covered == want


@pytest.mark.parametrize("in_task", [2048, 1])
def test_repeat_groups_are_all_maximal_repeats_with_all_occurrences(spark, monkeypatch, in_task):
    monkeypatch.setattr("kinspan.llm.suffix_dedup.IN_TASK", in_task)
    rng, length = random.Random(4), 60
    text = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    p, q, own = text(150), text(90), text(75)
    texts = [text(30) + p + text(30), text(30) + p + text(20), text(10) + p[20:110] + text(40), text(9) + own + text(12) + own + text(5) + own[5:], p[60:] + q, text(20) + p[60:] + q + text(8), q[:70] + text(50), "abc" * 40, p + q, p + q, text(100)]
    rows = [(i, t, None, None, 1) for i, t in enumerate(texts)] + [(9, texts[9], None, None, 1), (None, texts[0], None, None, 1), (20, None, None, None, 1)]
    whole = [(i, (t or "").encode()) for i, t, *_ in rows]
    want = []
    for n in range(length, max(len(b) for _, b in whole) + 1):
        places = {}
        for x, (_, b) in enumerate(whole):
            for a in range(len(b) - n + 1):
                places.setdefault(b[a : a + n], []).append((x, a))
        for at in places.values():
            differ = lambda step: len({whole[x][1][a + step] if 0 <= a + step < len(whole[x][1]) else (x, a) for x, a in at}) > 1  # noqa: B023, E731
            if len(at) > 1 and differ(-1) and differ(n):
                want.append((n, sorted(((whole[x][0], a) for x, a in at), key=str)))
    groups = {}
    for r in maximal_repeats(frame(spark, rows), length).collect():
        groups.setdefault((r.repeat_id, r.n_bytes), []).append((r.doc_id, r.start))
    assert sorted(((n, sorted(at, key=str)) for (_, n), at in groups.items()), key=str) == sorted(want, key=str) and len(want) > 20


def test_interval_tree_and_maximal_repeats():
    assert sorted(interval_tree([2, 3, 0, 1], 1)) == [(0, 2, 2), (1, 2, 3), (3, 4, 1)]
    assert sorted(interval_tree([0, 0], 0)) == [(0, 2, 0)]
    left, right = [b"ba", b"bx", b"cq"], [b"kmer1", b"kmer2", b"kmer1"]
    found = {(tuple(sorted(g)), before, after) for g, before, after in repeats(left, right, 5)}
    assert found == {((0, 2), 0, 5), ((0, 1), 1, 4)}


def naive_components(ids, links):
    comp = {i: i for i in ids}
    for _ in ids:
        for a, b in links:
            comp[a] = comp[b] = min(comp[a], comp[b])
    return comp


@pytest.mark.parametrize(("k", "num", "lower"), [(3, 90, True), (5, 80, False)])
def test_ngram_groups(spark, rows, k, num, lower):
    some = [r for r in rows if r[0] is not None]
    s = sets(some, k, lower)
    links = [(some[i][0], some[j][0]) for i in range(len(s)) for j in range(i) if s[i] and s[j] and 100 * len(s[i] & s[j]) >= num * len(s[i] | s[j])]
    comp = naive_components([r[0] for r in some], links)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_groups(frame(spark, rows), k, num, 100, lower).collect()}
    assert got.pop(None)[1] is None
    assert got == {r[0]: (len(x), comp[r[0]]) for r, x in zip(some, s, strict=True)} and links


def test_ngram_groups_by_combinations_of_frequent_tokens(spark, monkeypatch):
    rng, vocabulary = random.Random(5), [f"v{i}" for i in range(500)]
    base, rows = [rng.choice(vocabulary) for _ in range(100)], []
    for i in range(90):
        w = list(base)
        for _ in range(rng.randint(1, 8)):
            w[rng.randrange(100)] = rng.choice(vocabulary)
        rows.append((i, " ".join(w), "en", "a", 1))
    s = sets(rows, 3)
    links = [(i, j) for i in range(90) for j in range(i) if 100 * len(s[i] & s[j]) >= 90 * len(s[i] | s[j])]
    comp = naive_components(range(90), links)
    monkeypatch.setattr("kinspan.llm.ngram_join.BLOCK", 16)
    got = {r.doc_id: r.component_id for r in ngram_groups(frame(spark, rows), 3, 90, 100).collect()}
    assert got == comp and len(set(comp.values())) > 5


def test_rows_that_share_an_id_are_one_node(spark):
    rng = random.Random(8)
    text = lambda: [f"u{rng.randrange(10**6)}" for _ in range(60)]
    a, b, c = text(), text(), text()
    near = [*b[:-1], "other"]
    rows = [(1, " ".join(a), None, None, 1), (2, " ".join(b), None, None, 1), (2, " ".join(a), None, None, 1), (3, " ".join(near), None, None, 1), (4, " ".join(c), None, None, 1), (4, " ".join(c), None, None, 1)]
    got = sorted((r.doc_id, r.component_id) for r in ngram_groups(frame(spark, rows), 5, 80, 100).collect())
    assert got == [(1, 1), (2, 1), (2, 1), (3, 1), (4, 4), (4, 4)]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (95, 90), (7, 7)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}


def test_contaminated(spark, rows):
    rng = random.Random(3)
    items = []
    for j, (_, text, *_) in enumerate(rows[:24]):
        w = split(text)
        a = rng.randrange(max(1, len(w) - 30))
        part = w[a : a + rng.randint(0, 40)]
        if part and j % 3 == 0:
            part[rng.randrange(len(part))] = "changed"
        items.append((j, " ".join(part)))
    items += [(90, None), (91, ""), (92, "one two three four"), (93, " ".join(split(rows[9][1])[3:6])), (94, "For For")]
    five = lambda w, k=5: {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    want = {}
    for d, text, *_ in rows:
        for j, item in items:
            k = min(5, len(split(item)))
            a, b = (five(split(item), k), five(split(text), k)) if k else (set(), set())
            if a and 100 * len(a & b) >= 80 * len(a):
                want[d, j] = (len(a), len(a & b))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_shingles, r.n_shared) for r in contaminated(frame(spark, rows), bench).collect()}
    assert got == want and {93, 94} <= {j for _, j in want}
    bad = {d for d, _ in want}
    left = drop_contaminated(frame(spark, rows), bench)
    assert left.columns == frame(spark, rows).columns and sorted(map(str, (r.doc_id for r in left.collect()))) == sorted(str(r[0]) for r in rows if r[0] not in bad)
    assert contaminated(frame(spark, rows), bench.limit(0)).count() == 0


def test_items_without_an_id_are_found_one_by_one(spark):
    text = lambda a, n: " ".join(f"t{x}" for x in range(a, a + n))
    bench = spark.createDataFrame([(None, text(100, 20)), (None, text(200, 20)), (None, text(300, 12)), (1, text(400, 20))], "item_id long, text string")
    rows = [(i, text(1000 * i, 9) + " " + t, None, None, 1) for i, t in enumerate((text(100, 20), text(200, 20) + " x " + text(400, 20), text(700, 30)), 1)]
    got = sorted(((r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in contaminated(frame(spark, rows), bench).collect()), key=str)
    assert got == [(1, None, 16, 16), (2, 1, 16, 16), (2, None, 16, 16)]
    assert [r.doc_id for r in drop_contaminated(frame(spark, rows), bench).collect()] == [3]


def test_quality_rules(spark, rows):
    want = {}
    for i, text, *_ in rows:
        t, w = text or "", split(text)
        c = Counter(tuple(w[a : a + 8]) for a in range(len(w) - 7))
        rep = len({a + b for a in range(len(w) - 7) for b in range(8) if c[tuple(w[a : a + 8])] > 1})
        lines = [x for x in t.split("\n") if split(x)]
        want[i] = (len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), rep, len(w) < 20 or 100 * rep > 30 * len(w))
    got = {r[0]: tuple(r[1:]) for r in quality_rules(frame(spark, rows)).collect()}
    assert {k: v[:6] for k, v in got.items()} == want and all(not (v[5] and v[6]) for v in got.values())


def test_quality_thresholds_follow_the_group(spark):
    rng = random.Random(1)
    prose = lambda sym: " ".join(f"w{rng.randrange(5000)}" + sym for _ in range(60))
    rows = [(i, prose("#" if i % 40 == 0 else ""), "en", "clean", 1) for i in range(200)] + [(i, prose("#"), "en", "code", 1) for i in range(200, 400)]
    got = {r.doc_id: r.kept for r in quality_rules(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [i for i in range(200) if not got[i]] == list(range(0, 200, 40)) and all(got[i] for i in range(200, 400))


def test_rows_that_share_an_id_or_repeat(spark):
    rng = random.Random(9)
    text = lambda n: " ".join(f"u{rng.randrange(10**5)}" for _ in range(n))
    a, b, item = text(60), text(60), text(12)
    rows = [(1, a), (1, a), (1, b), (2, a), (None, a), (None, b + " " + item), (3, text(40) + " " + item), (3, text(40)), (None, None), (4, "")]
    df = frame(spark, [(i, t, "en", "a", 1) for i, t in rows])
    raw = [(t or "").encode() for _, t in rows]
    count = Counter(x[p : p + 200] for x in raw for p in range(len(x) - 199))
    want = []
    for (i, _), x in zip(rows, raw, strict=True):
        gone = {p + q for p in range(len(x) - 199) if count[x[p : p + 200]] > 1 for q in range(200)}
        want.append((i, len(x), len(gone)))
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed) for r in suffix_dedup(df).collect()), key=str) == sorted(want, key=str)
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert sorted(((r.doc_id, r.item_id) for r in contaminated(df, bench).collect()), key=str) == [(3, 7), (None, 7)]
    assert sorted(r.text for r in drop_contaminated(df, bench).where("text <> ''").collect()) == sorted(t for _, t in rows if t and item not in t)
    counts = Counter((i, len(split(t))) for i, t in rows)
    assert Counter((r.doc_id, r.n_words) for r in quality_rules(df).collect()) == counts
    assert Counter((r.doc_id, r.n_words) for r in substring_dedup(df).collect()) == counts


def test_a_very_long_text_in_rules_and_decontamination(spark):
    rng = random.Random(12)
    long = " ".join(f"{rng.randrange(10**6)}" for _ in range(150_000))
    item = " ".join(long.split()[149_000:149_020])
    df = frame(spark, [(1, long, "en", "a", 1), (2, "short and clean " * 3, "en", "a", 1)])
    assert [(r.doc_id, r.n_shared) for r in contaminated(df, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()] == [(1, 16)]
    got = {r.doc_id: (r.n_words, r.n_repeat_words) for r in quality_rules(df).collect()}
    assert got == {1: (150_000, 0), 2: (9, 0)}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    for df in (substring_dedup(empty), suffix_dedup(empty), ngram_groups(empty), contaminated(empty, bench), quality_rules(empty)):
        assert df.count() == 0


def test_a_very_long_text(spark):
    rng = random.Random(2)
    long = " ".join(f"{rng.randrange(10**6)}" for _ in range(250_000))
    rows = [(1, long, "en", "a", 1), (2, "start " + long + " end", "en", "a", 1), (3, "alone", "en", "a", 1)]
    got = {r.doc_id: r.n_removed for r in substring_dedup(frame(spark, rows)).collect()}
    assert got == {1: 0, 2: 250_000, 3: 0}
    cut = {r.doc_id: r.n_removed for r in suffix_dedup(frame(spark, rows)).collect()}
    assert cut[1] == len(long) and len(long) <= cut[2] <= len(long) + 2 and cut[3] == 0
    assert {r.doc_id: r.component_id for r in ngram_groups(frame(spark, rows)).collect()} == {1: 1, 2: 1, 3: 3} and math.isfinite(len(long))
