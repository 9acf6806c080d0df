"""Jaccard self-join of documents' shingle sets by token-combination prefixes, and the groups that its links form."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinspan.llm.common import byte_prefix, components, lower_ascii, materialize, mix, pieces, span_hash, text_buffer, windows_of, words_of

COMBINE = 2  # frequent tokens of a combination; so many rare ones must be shared one by one
RARE = 8  # documents that a rare token stands in at most, and that a bucket holds whose documents are all compared
#: A token's class is how many of these numbers of documents it reaches: classes put tokens in order, rare ones first.
CLASSES = (2, RARE + 1, 1 << 12, 1 << 20)
SLOTS = 1 << 26  # bits of each class's table, a fixed size; a full table changes the work, not the links
SLICES = 16  # of a task's tokens, counted one after the other
BUCKETS = 1 << 18  # of the table that keeps texts of no candidate out of the shuffle: the bound of what is broadcast
SALT = 256  # documents that one task compares with a centre, about
BLOCK = 128  # documents of a block, about; a task compares two blocks


def shingle_sets(col, shingle: int, lower: bool):
    """(row, sorted distinct 64-bit hashes of its shingles) of a text column; a shorter text is one shingle, one without words has none."""
    buf, offs = text_buffer(col)
    for i, j in pieces(offs):
        b = buf[offs[i] : offs[j]]
        b = lower_ascii(b) if lower else b
        starts, ends, woff = words_of(b, offs[i : j + 1] - offs[i])
        h = span_hash(byte_prefix(b), starts, ends)
        win = windows_of(h, shingle)
        for r in range(j - i):
            x, y = woff[r], woff[r + 1]
            if y - x >= shingle:
                yield i + r, np.unique(win[x : y - shingle + 1])
            elif y > x:
                yield i + r, windows_of(h[x:y], int(y - x), 0x2545F4914F6CDD1D)
            else:
                yield i + r, np.zeros(0, np.uint64)


class Rule:
    """num / den is the least Jaccard similarity of two linked sets.

    Two linked sets share the first `extra` of their common tokens within their extended prefixes, the first n - overlap +
    extra tokens. Of these, COMBINE are rare, or more than `parts` are frequent: dealt into that many parts, two of
    them meet in one. So rare tokens are indexed one by one and frequent ones as pairs within a part."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def parts(self, n: int) -> tuple[int, int]:
        """Into how many parts frequent tokens are dealt, for sets down to the size class below n's and for those of n's own.

        Sets that may link are of one size class or of neighbouring ones, so they have one of the two numbers in common."""
        level = int(np.floor(np.log(n) / np.log(self.den / self.num) + 1e-9))
        of = lambda lv: max(1, int((self.den / self.num) ** lv * (self.den - self.num) / self.den / 2))
        return of(level - 1), of(level)

    def prefix(self, n: int) -> int:
        return n + (-n * self.num // self.den) + self.parts(n)[1] + COMBINE

    def sizes(self, x: Column, y: Column) -> Column:
        """Whether sets of these sizes can be similar enough."""
        return F.least(x, y) * self.den >= F.greatest(x, y) * self.num


def index_keys(tokens: np.ndarray, classes: np.ndarray, rule: Rule) -> np.ndarray:
    """Keys under which a set is indexed: even ones for rare tokens, odd ones for combinations of frequent tokens. Tokens of one document have none."""
    n = len(tokens)
    if not n:
        return tokens
    first = np.argsort(classes, kind="stable")[: rule.prefix(n)]
    tokens, classes = tokens[first], classes[first]
    out, often = [mix(tokens[classes == 1]) & ~np.uint64(1)], tokens[classes > 1]
    for m in sorted(set(rule.parts(n))):
        part = mix(often + np.uint64(m)) % np.uint64(m)
        order = np.lexsort((often, part))
        t, part = often[order], part[order]
        for d in range(1, len(t)):
            same = np.flatnonzero(part[d:] == part[:-d])
            if not len(same):
                break
            out.append(mix(t[same] * np.uint64(0x9E3779B97F4A7C15) + mix(t[same + d] + np.uint64(m))) | np.uint64(1))
    return np.unique(np.concatenate(out))


def _classes(base: DataFrame, shingle: int, lower: bool) -> np.ndarray:
    """A bit table over tokens' slots for each number of CLASSES: which tokens stand in at least so many rows.

    Every token of every row is counted. Tokens travel as 32 bits of their hash, a block for each partition and piece of
    text; a slice's counts become bits where they are, and only the tables' words, of which there is a fixed number, go to the driver."""
    parts = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def send(batches):
        import pyarrow as pa

        def block(tokens):
            t = np.concatenate(tokens)
            p = (t >> np.uint64(33)) % np.uint64(parts * SLICES)
            order = np.argsort(p, kind="stable")
            cut = np.searchsorted(p[order], np.arange(parts * SLICES + 1))
            low = (t[order] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            some = np.flatnonzero(np.diff(cut))
            return pa.RecordBatch.from_arrays([pa.array(some // SLICES, pa.int32()), pa.array(some % SLICES, pa.int32()), pa.array([low[cut[i] : cut[i + 1]].tobytes() for i in some], pa.binary())], names=["p", "q", "tokens"])

        held, size = [], 0
        for batch in batches:
            for _, s in shingle_sets(batch.column("text"), shingle, lower):
                held.append(s)
                size += len(s)
                if size > 1 << 18:
                    yield block(held)
                    held, size = [], 0
        if size:
            yield block(held)

    def bits(batches):
        import pyarrow as pa

        def words(found):
            t = np.sort(np.concatenate(found))
            first = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
            n = np.diff(np.append(first, len(t)))
            for table, least in enumerate(CLASSES):
                slot = np.unique(t[first[n >= least]].astype(np.int64) & (SLOTS - 1))
                if len(slot):
                    word = slot >> 6
                    at = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
                    value = np.bitwise_or.reduceat(np.left_shift(np.uint64(1), (slot & 63).astype(np.uint64)), at)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), table, np.int32)), pa.array(word[at].astype(np.int32)), pa.array(value.view(np.int64))], names=["table", "word", "bits"])

        now, found = None, []
        for batch in batches:
            for p, q, blob in zip(batch.column("p").to_pylist(), batch.column("q").to_pylist(), batch.column("tokens"), strict=True):
                if (p, q) != now and found:
                    yield from words(found)
                    found = []
                now = p, q
                found.append(np.frombuffer(blob.as_buffer(), np.uint32).copy())
        if found:
            yield from words(found)

    sent = base.select("text").mapInArrow(send, "p int, q int, tokens binary").repartitionById(parts, F.col("p")).sortWithinPartitions("p", "q")
    words = sent.mapInArrow(bits, "table int, word int, bits long").groupBy("table", "word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros((len(CLASSES), SLOTS >> 6), np.uint64)
    out[words.column("table").to_numpy(), words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def _class_of(tables: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    slot = (tokens & np.uint64(SLOTS - 1)).astype(np.int64)
    word, bit = slot >> 6, (slot & 63).astype(np.uint64)
    return sum(((t[word] >> bit) & np.uint64(1)).astype(np.int8) for t in tables)


def _with_texts(docs: DataFrame, wants: DataFrame) -> DataFrame:
    """wants (doc_id, ...) with the texts of docs. A table of at most BUCKETS hashes keeps other texts out of the shuffle, as far as it has room."""
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(BUCKETS)).cast("int")
    some = wants.select(bucket(F.col("doc_id")).alias("bucket")).distinct()
    near = docs.select("doc_id", "text", bucket(F.col("doc_id")).alias("bucket")).join(F.broadcast(some), "bucket", "left_semi")
    return near.drop("bucket").join(wants, "doc_id")


def _verified(docs: DataFrame, pairs: DataFrame, rule: Rule, shingle: int, lower: bool) -> DataFrame:
    """Those of pairs (a: centre, b) whose sets are at least as similar as rule says. A centre's pairs are dealt to tasks of about SALT; its text goes to each of them."""
    pairs = materialize(pairs, "pairs")
    salts = pairs.groupBy("a").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / SALT)).cast("int").alias("salts"))
    salted = pairs.join(salts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"))
    wants = salted.select(F.col("b").alias("doc_id"), F.col("a").alias("centre"), "salt", F.lit(1).alias("role")).unionByName(
        salts.select(F.col("a").alias("doc_id"), F.col("a").alias("centre"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("role")))
    sent = _with_texts(docs, materialize(wants, "wants"))
    sent = sent.select("centre", "salt", "role", "doc_id", "text").repartition("centre", "salt").sortWithinPartitions("centre", "salt", "role")
    num, den = rule.num, rule.den
    kind = dict(docs.dtypes)["doc_id"]

    def compare(batches):
        import pyarrow as pa

        now, mine = None, []
        for batch in batches:
            key = list(zip(batch.column("centre").to_pylist(), batch.column("salt").to_pylist(), strict=True))
            role, ids = batch.column("role").to_pylist(), batch.column("doc_id").to_pylist()
            a, b = [], []
            for i, s in shingle_sets(batch.column("text"), shingle, lower):
                if role[i] == 0:
                    mine = [*mine, s] if key[i] == now else [s]
                    now = key[i]
                    continue
                for centre in mine if key[i] == now and len(s) else []:
                    both = np.concatenate([s, centre])
                    both.sort()
                    o = int((both[1:] == both[:-1]).sum())
                    if len(centre) and den * o >= num * (len(s) + len(centre) - o):
                        a.append(now[0])
                        b.append(ids[i])
            yield pa.RecordBatch.from_arrays([pa.array(a, batch.schema.field("centre").type), pa.array(b, batch.schema.field("doc_id").type)], names=["a", "b"])

    return materialize(sent.mapInArrow(compare, f"a {kind}, b {kind}"), "links")


def _within(docs: DataFrame, clusters: DataFrame, rule: Rule, shingle: int, lower: bool) -> DataFrame:
    """Links (a, b) that join the documents of each cluster (cluster, doc_id, m: its size) as all their links do: a forest for any two of its blocks.

    A cluster is cut into blocks of about BLOCK documents. A task has the texts of two blocks, whose sets it compares all
    with all as one product of matrices; rows for single pairs are never made."""
    kind = dict(docs.dtypes)["doc_id"]
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    own = clusters.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    wants = materialize(own.select("doc_id", F.struct("cluster", "blocks", "own").alias("w")), "blocks")
    sent = _with_texts(docs, wants).select("doc_id", "text", "w.*").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sent = sent.select("cluster", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "doc_id", "text").repartition("cluster", "x", "y").sortWithinPartitions("cluster", "x", "y")
    num, den = rule.num, rule.den

    def forest(sets: list[np.ndarray], ids: list) -> list[tuple]:
        n = np.array([len(s) for s in sets], np.float32)
        tokens, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        rank = np.cumsum(count > 1) - 1
        some = count[at] > 1
        row, col = row[some], rank[at[some]]
        both = np.zeros((len(sets), len(sets)), np.float32)
        order = np.argsort(col, kind="stable")
        row, col = row[order], col[order]
        for lo in range(0, int(col[-1]) + 1 if len(col) else 0, 4096):
            a, b = np.searchsorted(col, (lo, lo + 4096))
            m = np.zeros((len(sets), 4096), np.float32)
            m[row[a:b], col[a:b] - lo] = 1
            both += m @ m.T
        linked = both.astype(np.int64) * den >= num * (n[:, None].astype(np.int64) + n.astype(np.int64) - both.astype(np.int64))
        np.fill_diagonal(linked, False)
        seen, out = np.zeros(len(sets), bool), []
        for start in range(len(sets)):
            todo = [start] if not seen[start] else []
            seen[start] = True
            while todo:
                v = todo.pop()
                new = np.flatnonzero(linked[v] & ~seen)
                seen[new] = True
                todo += new.tolist()
                out += [(ids[v], ids[w]) for w in new]
        return out

    def compare(batches):
        import pyarrow as pa

        now, sets, ids = None, [], []

        def done():
            pairs = forest(sets, ids) if len(sets) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], id_type), pa.array([p[1] for p in pairs], id_type)], names=["a", "b"])

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            keys = list(zip(*[batch.column(c).to_pylist() for c in ("cluster", "x", "y")], strict=True))
            doc = batch.column("doc_id").to_pylist()
            for i, s in shingle_sets(batch.column("text"), shingle, lower):
                if keys[i] != now:
                    if sets:
                        yield done()
                    now, sets, ids = keys[i], [], []
                if len(s):
                    sets.append(s)
                    ids.append(doc[i])
        if sets:
            yield done()

    return sent.mapInArrow(compare, f"a {kind}, b {kind}")


def ngram_groups(docs: DataFrame, shingle: int = 5, num: int = 80, den: int = 100, lower: bool = False) -> DataFrame:
    """doc_id, n_shingles, class_id and component_id of every row of docs (doc_id, text): the groups that links of Jaccard similarity >= num/den (0.75 at least) form.

    Rows with equal sets are one class, named after its smallest doc_id, which alone goes on. Tokens are ordered rare ones
    first; a set is indexed under the rare tokens of its extended prefix one by one and under combinations of the frequent
    ones (see Rule). Documents that share one combination or COMBINE rare tokens are candidates: all with all in buckets of at most
    RARE documents, in larger ones at first all with the smallest doc_id. Larger buckets that hold documents of several groups after
    that are compared all with all, in blocks; buckets with the same smallest doc_id at once. Links are decided on whole sets.

    Null text, empty text and text without words have the empty set: n_shingles 0, linked with nothing; component_id is
    the row's own doc_id. A very long text is one set like any other and is held by one task at a time. A row with a null doc_id
    has null class and component. Repeated rows are one class; rows that share a doc_id are one node, linked as any of its texts is.
    Ties (equal similarity, equal frequency) change nothing: a link needs no choice, and groups are named after their smallest doc_id.
    An empty table gives no row; other columns are ignored."""
    rule = Rule(num, den)
    kind = dict(docs.dtypes)["doc_id"]
    base = docs.select("doc_id", "text")
    tables = docs.sparkSession.sparkContext.broadcast(_classes(base, shingle, lower))

    def indexed(batches):
        import pyarrow as pa

        for batch in batches:
            n, s1, s2, keys = [], [], [], []
            for _, s in shingle_sets(batch.column("text"), shingle, lower):
                n.append(len(s))
                s1.append(mix(s).sum(dtype=np.uint64))
                s2.append(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64))
                keys.append(index_keys(s, _class_of(tables.value, s), rule).view(np.int64))
            offs = np.concatenate(([0], np.cumsum([len(x) for x in keys]))).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int32()), pa.array(np.array(s1, np.uint64).view(np.int64)), pa.array(np.array(s2, np.uint64).view(np.int64)), pa.ListArray.from_arrays(pa.array(offs), pa.array(flat))], names=["doc_id", "n", "s1", "s2", "keys"])

    sets = materialize(base.mapInArrow(indexed, f"doc_id {kind}, n int, s1 long, s2 long, keys array<long>"), "sets")
    tables.unpersist()  # sets are written: nothing needs the tables again
    some = sets.where("n > 0 and doc_id is not null")
    classes = materialize(some.groupBy("s1", "s2", "n").agg(F.min(F.struct("doc_id", "keys")).alias("x")).select("s1", "s2", "n", F.col("x.doc_id").alias("rep"), "x.keys"), "classes")
    index = classes.select(F.explode("keys").alias("key"), F.col("rep").alias("doc_id"), "n")
    buckets = index.groupBy("key").agg(F.count("*").alias("m"), F.min(F.struct("doc_id", "n")).alias("x")).where("m > 1")
    index = materialize(index.join(buckets, "key"), "index")

    weight = F.when(F.col("key").bitwiseAND(1) == 1, COMBINE).otherwise(1).alias("w")
    few = index.where(F.col("m") <= RARE).groupBy("key").agg(F.collect_list(F.struct("doc_id", "n")).alias("d"))  # RARE documents at most
    others = lambda x: F.filter("d", lambda y: (y["doc_id"] > x["doc_id"]) & rule.sizes(x["n"], y["n"]))
    few = few.select(weight, F.explode(F.flatten(F.transform("d", lambda x: F.transform(others(x), lambda y: F.struct(x["doc_id"].alias("a"), y["doc_id"].alias("b")))))).alias("p")).select("p.a", "p.b", "w")
    star = index.where((F.col("m") > RARE) & (F.col("x.doc_id") != F.col("doc_id")) & rule.sizes(F.col("x.n"), F.col("n"))).select(F.col("x.doc_id").alias("a"), F.col("doc_id").alias("b"), weight)
    pairs = few.unionByName(star).groupBy("a", "b").agg(F.sum("w").alias("w")).where(F.col("w") >= COMBINE).select("a", "b")
    links = _verified(docs, pairs, rule, shingle, lower)
    comps = components(links)

    many = index.where(F.col("m") > RARE).select("key", F.col("x.doc_id").alias("cluster"), "doc_id")
    many = many.join(comps.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("comp", F.coalesce("comp", "doc_id"))
    still = many.groupBy("key").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 != c2").select("key")
    stars = materialize(many.join(still, "key", "left_semi").groupBy("cluster", "doc_id").agg(F.min("comp").alias("comp")), "stars")
    firsts = stars.groupBy("doc_id").agg(F.min("cluster").alias("first"))
    # a star whose documents all stand in one star of a smaller doc_id is compared there
    open_ = (F.col("c1") != F.col("c2")) & ((F.col("f1") != F.col("f2")) | (F.col("f1") == F.col("cluster")))
    sizes = stars.join(firsts, "doc_id").groupBy("cluster").agg(F.count("*").alias("m"), F.min("comp").alias("c1"), F.max("comp").alias("c2"), F.min("first").alias("f1"), F.max("first").alias("f2")).where(open_).select("cluster", "m")
    more = materialize(_within(docs, stars.join(sizes, "cluster").select("cluster", "doc_id", "m"), rule, shingle, lower), "links")

    twice = some.groupBy("doc_id").agg(F.count("*").alias("c")).where(F.col("c") > 1).select("doc_id")
    same = some.join(twice, "doc_id").join(classes, ["s1", "s2", "n"]).where(F.col("doc_id") != F.col("rep")).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    comps = components(links.unionByName(more).unionByName(same)).withColumnRenamed("node", "rep")
    named = classes.join(comps, "rep", "left").select("s1", "s2", "n", "rep", F.coalesce("comp", "rep").alias("comp"))
    return sets.drop("keys").join(named, ["s1", "s2", "n"], "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("class_id"), F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id")).alias("component_id"))
