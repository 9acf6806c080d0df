"""Shared pieces of the training-data operators: scratch tables, word spans and hashes, connected components."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of other bytes than these (space, tab, LF, VT, FF, CR).
WS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

_scratch: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, where it is unset and the session runs on one machine, a folder of our own."""
    found = spark.sparkContext._jsc.sc().getCheckpointDir()
    if found.isDefined():
        return found.get()
    if configured := spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(configured)
    elif spark.sparkContext.master.startswith("local["):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="kinspan-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, removed when the driver's process ends."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex[:12]}"
    if not _scratch:
        atexit.register(_clean)
    _scratch[path] = spark
    return path


def _clean() -> None:
    for path, spark in _scratch.items():
        if path.startswith(("/", "file:")):
            shutil.rmtree(path.removeprefix("file://").removeprefix("file:"), ignore_errors=True)
            continue
        try:
            jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
            jpath = jvm.org.apache.hadoop.fs.Path(path)
            jpath.getFileSystem(jsc.hadoopConfiguration()).delete(jpath, True)
        except Exception:  # noqa: BLE001  the JVM may have ended first; the cluster's own cleaning then takes the folder
            return
    _scratch.clear()


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Cuts the lineage: writes df as Parquet into the shared folder and reads it again. Row groups are small, as a task holds one while it writes or reads."""
    path = scratch_path(df.sparkSession, tag)
    df.write.option("compression", "zstd").option("parquet.block.size", 16 << 20).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: A table is broadcast if it has been counted and has no more rows than this; else the join shuffles.
BROADCAST_ROWS = 200_000


def small(df: DataFrame) -> DataFrame:
    """df (of narrow rows, already materialized), marked for broadcast if a count shows that it is small."""
    return bounded(df, df.limit(BROADCAST_ROWS + 1).count())


#: Bytes of a table of wide rows up to which it is broadcast.
BROADCAST_BYTES = 32 << 20


def light(df: DataFrame, size: Column) -> DataFrame:
    """df (already materialized), marked for broadcast if the sum of its rows' sizes shows that it is small."""
    return F.broadcast(df) if (df.agg(F.sum(size).alias("n")).first().n or 0) <= BROADCAST_BYTES else df


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """df (of narrow rows), which has at most this many, marked for broadcast if these are few."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


#: Keys are dealt into so many cells; a cell is hot if it has over eight times its share of the rows and more rows than this.
CELLS = 1 << 16
HOT_ROWS = 4096


def hot_cells(rows: DataFrame, key: str) -> Column | None:
    """A condition that holds for the rows (already materialized) whose hashed key lies in a hot cell; None if no cell is hot.

    Hot cells are fewer than an eighth of all, whatever the table. All rows are counted, with partial sums; only the numbers
    of the hot cells come to the driver. It says which of two equal ways a key's rows take, never whether they count."""
    cell = F.pmod(F.col(key), F.lit(CELLS)).cast("int")
    bound = max(8 * rows.count() / CELLS, HOT_ROWS)
    hot = [r.cell for r in rows.groupBy(cell.alias("cell")).count().where(F.col("count") > bound).collect()]
    return cell.isin(hot) if hot else None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    return F.when(text.isNull(), F.lit(0)).otherwise(F.regexp_count(text, F.lit(WORD))).cast("long")


# --- numpy kernels: a record batch's texts as bytes, in pieces of bounded size ------------------------------------

_M = np.uint64(0xFFFFFFFFFFFFFFFF)
_BASE = 0x9E3779B97F4A7C15 | 1
_PIECE = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (shift, multiply) that spreads every input bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_TAB = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
_pows: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of an odd base modulo 2^64, and of its inverse."""
    if len(_pows.get("f", ())) <= n:
        size = max(n + 1, 1 << 16)
        for name, b in (("f", _BASE), ("i", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, b, dtype=np.uint64)
            steps[0] = 1
            _pows[name] = np.multiply.accumulate(steps)
    return _pows["f"], _pows["i"]


def byte_prefix(buf: np.ndarray) -> np.ndarray:
    """P with P[j]-P[i] = sum over i<=k<j of T[buf[k]] * B^k (mod 2^64)."""
    f, _ = powers(len(buf))
    out = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_TAB[buf] * f[: len(buf)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans, equal for equal bytes wherever they stand."""
    _, inv = powers(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * inv[starts] + (ends - starts).astype(np.uint64))


_IS_WS = np.zeros(256, dtype=bool)
_IS_WS[[0x20, 9, 10, 11, 12, 13]] = True


def text_buffer(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null has no bytes."""
    import pyarrow as pa

    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    _, off, data = col.buffers()
    offs = np.frombuffer(off, dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf, offs


def pieces(offs: np.ndarray, limit: int = _PIECE):
    """Ranges (i, j) of rows whose bytes are at most limit, or one longer row."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
        yield i, j
        i = j


def words_of(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of rows that lie back to back in buf (offs from 0), and each row's first word."""
    n = len(buf)
    solid = ~_IS_WS[buf]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offs] = True
    before = np.concatenate(([False], solid[:-1])) if n else solid
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.concatenate((solid[1:], [False])) if n else solid
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def windows_of(h: np.ndarray, k: int, mult: int = 0xC2B2AE3D27D4EB4F) -> np.ndarray:
    """Order-dependent hashes of every k consecutive values; position i covers h[i:i+k]."""
    if len(h) < k:
        return np.zeros(0, dtype=np.uint64)
    m, out = np.uint64(mult), np.zeros(len(h) - k + 1, dtype=np.uint64)
    for j in range(k):
        out = out * m + h[j : len(h) - k + 1 + j]
    return mix(out)


def within(woff: np.ndarray, k: int, total: int) -> np.ndarray:
    """Mask of window positions 0..total-k that do not cross a row's end."""
    if total < k:
        return np.zeros(0, dtype=bool)
    ok = np.ones(total + 1, dtype=bool)
    for j in range(1, k):
        at = woff[1:] - j
        ok[at[at >= 0]] = False
    return ok[: total - k + 1]


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return np.where((buf >= 65) & (buf <= 90), buf + np.uint8(32), buf)


# --- connected components ------------------------------------------------------------------------------------------


def _roots(batches):
    """Of all edges (u, v, moved) of a task: each node that is not its group's smallest, with that one; whether another task may need to know; the task."""
    import pyarrow as pa
    from pyspark import TaskContext

    got = [b for b in batches if b.num_rows]
    if not got:
        return
    t = pa.Table.from_batches(got)
    u, v = (t.column(c).to_numpy() for c in "uv")
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(ids))
    while (root[a] != root[b]).any():
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root[root] != root).any():
            root = root[root]
    out = np.flatnonzero(root != np.arange(len(ids)))
    known = np.zeros(len(ids), bool)
    known[a] = True
    moved = ~known[out] | bool(t.column("moved").to_numpy(zero_copy_only=False).any())
    task = TaskContext.get().partitionId()
    kind = t.schema.field("u").type
    for i in range(0, len(out), 1 << 16):
        j = out[i : i + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(ids[j], kind), pa.array(ids[root[j]], kind), pa.array(moved[i : i + (1 << 16)]), pa.array(np.full(len(j), task, np.int32))], names=["u", "v", "moved", "task"])


def components(edges: DataFrame, tag: str = "cc", rounds: int = 40) -> DataFrame:
    """(node, comp): comp is the smallest node that a path of edges (a, b) reaches. Nodes without an edge are absent.

    Each round deals the edges by their larger end, so that a hub's edges go to many tasks; a task replaces its edges by stars around the smallest
    nodes of the groups that they form, then every edge moves on to the parent of its smaller end. What one task has seen
    as a whole, or what no longer moves, is done. The number of rounds grows with the logarithm of the longest path. Every round is
    written to the shared folder; nothing is collected."""
    kind = dict(edges.dtypes)["a"]
    e = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"), F.lit(True).alias("moved"))
    for _ in range(rounds):
        e = materialize(e.repartition("u").mapInArrow(_roots, f"u {kind}, v {kind}, moved boolean, task int"), tag)
        seen = e.agg(F.min("task").alias("lo"), F.max("task").alias("hi"), F.bool_or("moved").alias("moved")).first()
        if seen.lo == seen.hi or not seen.moved:
            break
        up = e.groupBy("u").agg(F.min("v").alias("w")).select(F.col("u").alias("v"), "w")
        e = e.select("u", "v").join(up, "v", "left").select("u", F.coalesce("w", "v").alias("v"), F.col("w").isNotNull().alias("moved"))
    else:
        raise RuntimeError("the components have not settled")
    node = e.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return node.union(node.select("comp", "comp")).distinct()
