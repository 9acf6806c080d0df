"""Quality by nearest-neighbour voting among broadcast labelled latent-semantic vectors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinspan.llm.features import EXTRA, QUALITY_DIMS, quality_features
from kinspan.llm.language_id import remainder

PER_CLASS = 1536  # labelled rows of each class that are kept as voters: the documented bound of the fit
LATENT = 48
NEIGHBOURS = 15
KEEP = 0.3


class Model:
    """Voters' latent vectors and labels, and how a text's counts become such a vector."""

    def __init__(self, x: np.ndarray, y: np.ndarray, latent: int = LATENT, neighbours: int = NEIGHBOURS):
        self.k = neighbours
        self.idf = np.log((1 + len(x)) / (1 + (x[:, :-EXTRA] > 0).sum(0))).astype(np.float32) + 1
        z = self.weigh(x)
        self.mean = z.mean(0)
        z = z - self.mean
        rng = np.random.default_rng(3)
        q = z @ rng.standard_normal((z.shape[1], min(latent + 16, *z.shape))).astype(np.float32)
        for _ in range(3):
            q, _ = np.linalg.qr(z @ (z.T @ q))
        _, _, vt = np.linalg.svd(q.T @ z, full_matrices=False)
        self.axes = np.ascontiguousarray(vt[:latent].T)
        self.voters = self.unit(z @ self.axes)
        self.labels = y.astype(np.float32)
        self.prior = float(self.labels.mean())

    def weigh(self, x: np.ndarray) -> np.ndarray:
        g = np.log1p(x[:, :-EXTRA]) * self.idf
        g /= np.maximum(np.linalg.norm(g, axis=1, keepdims=True), 1e-9)
        return np.concatenate([g, x[:, -EXTRA:]], axis=1).astype(np.float32)

    @staticmethod
    def unit(z: np.ndarray) -> np.ndarray:
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)

    def score(self, x: np.ndarray, some: np.ndarray, block: int = 256) -> np.ndarray:
        """Exact cosines with all voters, block by block; the nearest ones' labels weighted by similarity. Rows without words (not some) get the prior."""
        z = self.unit((self.weigh(x) - self.mean) @ self.axes)
        k, out = min(self.k, len(self.labels)), np.empty(len(z))
        for a in range(0, len(z), block):
            sim = z[a : a + block] @ self.voters.T
            at = np.argpartition(-sim, k - 1, axis=1)[:, :k]
            w = np.maximum(np.take_along_axis(sim, at, 1), 0) ** 4 + 1e-6
            out[a : a + block] = (w * self.labels[at]).sum(1) / w.sum(1)
        out[~some] = self.prior
        return np.clip(out, 0, 1)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model | float:
    """Learns from at most about per_class labelled rows of each class, chosen by a hash of the id; only rows whose remainder is not 0.
    Without labels of both classes it gives the constant score instead."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id")) != 0)).groupBy("doc_id").agg(F.max("quality").alias("y"))
    n = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return float(next(iter(n), 1))
    u = F.shiftrightunsigned(F.xxhash64(F.lit(11), "doc_id"), 11).cast("double") / float(1 << 53)
    picked = known.where(u < F.when(F.col("y") == 1, per_class / n[1]).otherwise(per_class / n[0]))
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("y", "text")

    def features(batches):
        import pyarrow as pa

        for batch in batches:
            y = batch.column("y")
            for i, x, _ in quality_features(batch.column("text")):
                yield pa.RecordBatch.from_arrays([y.slice(i, len(x)), pa.array([r.tobytes() for r in x.astype(np.float16)], pa.binary())], names=["y", "x"])

    got = rows.mapInArrow(features, "y int, x binary").collect()
    got.sort(key=lambda r: (r.y, bytes(r.x)))
    if len({r.y for r in got}) < 2:
        return float(got[0].y if got else 1)
    return Model(np.stack([np.frombuffer(r.x, np.float16) for r in got]).astype(np.float32).reshape(-1, QUALITY_DIMS), np.array([r.y for r in got]))


def score(docs: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """doc_id, held_out, score (higher: label 1 likelier) and predicted (score >= keep) for every row of docs (doc_id, text), over its whole text.

    A text without words (null, empty) gets the voters' mean label, whatever stands beside it. Very long texts are counted whole, in a
    matrix row of fixed width. Equally near voters have equal weights, so ties among them change the score only where labels differ.
    Repeated rows count each; a null id is held out; an empty table gives no row; other columns are ignored."""
    model = fit(docs, labels)
    rows = docs.select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), "text")
    if isinstance(model, float):
        scored = rows.select("doc_id", "held_out", F.lit(model).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def predict(batches):
            import pyarrow as pa

            for batch in batches:
                for i, x, some in quality_features(batch.column("text")):
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, len(x)), batch.column(1).slice(i, len(x)), pa.array(shared.value.score(x, some))], names=["doc_id", "held_out", "score"])

        scored = rows.mapInArrow(predict, f"doc_id {dict(rows.dtypes)['doc_id']}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= F.lit(keep)).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """The rows of docs, with all their columns, whose score (see score()) is at least keep: texts without words by the voters' mean label, repeated rows each, of an empty table none."""
    model = fit(docs, labels)
    if isinstance(model, float):
        return docs.where(F.lit(model >= keep))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def chosen(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                got = [shared.value.score(x, some) for _, x, some in quality_features(batch.column("text"))]
                yield batch.filter(pa.array(np.concatenate(got) >= keep))

    return docs.mapInArrow(chosen, docs.schema)
