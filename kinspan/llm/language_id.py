"""Language identification by error-correcting output codes over hashed n-gram classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinspan.llm.features import language_features

DIMS = 2048
PER_LANG = 1000  # rows a language that a model is fitted on
FIT_ROWS = 32_000  # rows of all languages that it is fitted on, about; with more languages each has fewer, but 16


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; a null id has the remainder of the empty text, 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def codewords(k: int) -> np.ndarray:
    """(k, bits) of +1 and -1: the exhaustive code for few classes, else the best of 64 seeded random codes."""
    if k <= 1:
        return np.ones((k, 1), np.float32)
    if k <= 6:
        bits = np.array([[(c >> i) & 1 for i in range(k)] for c in range(1, 2 ** (k - 1))]).T
        return (2 * bits - 1).astype(np.float32)
    length, best, at = int(np.ceil(10 * np.log2(k))), -1, None
    for seed in range(64):
        code = np.where(np.random.default_rng(seed).random((k, length)) < 0.5, -1, 1).astype(np.float32)
        apart = int(((length - code @ code.T) / 2 + length * np.eye(k)).min())
        if apart > best:
            best, at = apart, code
    return at


class Model:
    def __init__(self, langs: list[str], code: np.ndarray, w: np.ndarray, bias: np.ndarray, trust: np.ndarray):
        self.langs, self.code, self.w, self.bias, self.trust = langs, code, w, bias, trust

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Loss-weighted decoding: (class, score 0 to 1, margin to the second codeword)."""
        f = x @ self.w + self.bias
        loss = np.stack([(self.trust * np.logaddexp(0, -c * f)).sum(1) for c in self.code], axis=1)
        p = np.exp(loss.min(1, keepdims=True) - loss)
        p /= p.sum(1, keepdims=True)
        top = np.sort(p, axis=1)
        return loss.argmin(1), top[:, -1], top[:, -1] - (top[:, -2] if p.shape[1] > 1 else 0)


def fit_bits(x: np.ndarray, y: np.ndarray, rounds: int = 150, l2: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regressions for all columns of y (+1, -1) at once, by accelerated full-batch gradient steps."""
    w = np.zeros((x.shape[1], y.shape[1]), np.float32)
    b = np.zeros(y.shape[1], np.float32)
    vw, vb, step = w.copy(), b.copy(), 4.0
    for t in range(rounds):
        m = t / (t + 3)
        lw, lb = w + m * vw, b + m * vb
        g = -y / (1 + np.exp(np.clip(y * (x @ lw + lb), -30, 30))) / len(x)
        nw, nb = lw - step * (x.T @ g + l2 * lw), lb - step * g.sum(0)
        vw, vb, w, b = nw - w, nb - b, nw, nb
    return w, b


def fit(docs: DataFrame, per_lang: int = PER_LANG, dims: int = DIMS) -> Model | None:
    """Fits on at most about per_lang rows for each language (of many languages about FIT_ROWS in all), chosen by a hash of the id, of the rows whose remainder is not 0."""
    learn = docs.where((remainder(F.col("doc_id")) != 0) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = learn.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").collect()
    if not counts:
        return None
    langs = sorted(r.lang for r in counts)
    per_lang = min(per_lang, max(16, FIT_ROWS // len(langs)))
    share = docs.sparkSession.createDataFrame([(r.lang, min(1.0, per_lang / r.n)) for r in counts], "lang string, share double")
    u = F.shiftrightunsigned(F.xxhash64(F.lit(5), "doc_id"), 11).cast("double") / float(1 << 53)
    picked = learn.join(F.broadcast(share), "lang").where(u < F.col("share")).select("lang", "text")

    def features(batches):
        import pyarrow as pa

        for batch in batches:
            lang = batch.column("lang")
            for i, x in language_features(batch.column("text"), dims):
                yield pa.RecordBatch.from_arrays([lang.slice(i, len(x)), pa.array([r.tobytes() for r in x.astype(np.float16)], pa.binary())], names=["lang", "x"])

    rows = picked.mapInArrow(features, "lang string, x binary").collect()
    rows.sort(key=lambda r: (r.lang, bytes(r.x)))
    x = np.stack([np.frombuffer(r.x, np.float16) for r in rows]).astype(np.float32)
    cls = np.array([langs.index(r.lang) for r in rows])
    code = codewords(len(langs))
    y = code[cls]
    check = np.arange(len(x)) % 5 == 0
    w, b = fit_bits(x[~check], y[~check]) if (~check).sum() else (np.zeros((dims, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32))
    right = (((x[check] @ w + b) * y[check]) > 0).mean(0)
    trust = np.maximum(right - 0.5, 0.01)
    return Model(langs, code, w, b, (trust / trust.mean()).astype(np.float32))


def identify(docs: DataFrame, ambiguous_below: float = 0.2) -> DataFrame:
    """The language of every row of docs (doc_id, text, lang): doc_id, held_out, lang_pred, score, ambiguous.

    Binary n-gram classifiers give a value for each bit of the languages' codewords; the codeword with the least
    trust-weighted loss wins; score is its share of exp(-loss); ambiguous marks a small lead over the second.
    A null text or one without a letter is `und` with score 0; where there is nothing to learn from, all are. A very long text is
    counted whole, in a matrix row of fixed width. Of equally near codewords the first language by name wins, marked ambiguous. Repeated
    rows count each; null ids are held out; an empty table gives no row; extra columns are ignored."""
    base = docs.select("doc_id", "text", "lang")
    model = fit(base)
    rows = base.select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("text"))
    out = f"{dict(docs.dtypes)['doc_id']}"
    if model is None:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("ambiguous"))
    dims = model.w.shape[0]

    def predict(batches):
        import pyarrow as pa

        names = np.array(model.langs, dtype=object)
        for batch in batches:
            text = batch.column("text")
            some = np.asarray(text.is_valid())
            for i, x in language_features(text, dims):
                cls, score, lead = model.decode(x)
                ok = some[i : i + len(x)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, len(x)), batch.column("held_out").slice(i, len(x)), pa.array(np.where(ok, names[cls], "und"), pa.string()),
                                                  pa.array(np.where(ok, score, 0.0).astype(np.float64)), pa.array(~ok | (lead < ambiguous_below))], names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    return rows.mapInArrow(predict, f"doc_id {out}, held_out boolean, lang_pred string, score double, ambiguous boolean")
