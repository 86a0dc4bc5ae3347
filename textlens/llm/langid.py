"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams.

Document frequencies cover all training documents.  The classifier is fitted
by follow-the-regularised-leader (per-coordinate steps, L1 and L2 penalties) on
a bounded sample, balanced over the languages, and its temperature is set on a
part of the sample held back from training.  Whole texts are scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlens.llm.common import materialise
from textlens.session import ship_package

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
#: Bound of the training sample, in documents over all languages together.
SAMPLE = 4000
#: Every fifth document of the sample sets the temperature.
HELD_BACK = 5
EPOCHS = 3
ALPHA, BETA, L1, L2 = 2.0, 0.5, 0.02, 0.01
#: Features are scaled by this after division by their sum.
SCALE = 20.0
#: More different labels than this are taken for a mistake in the data.
MOST_LANGUAGES = 1000
UNKNOWN = "und"
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
#: Characters hashed at a time within one text.
CHUNK = 1 << 18


def _grams(text: str) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of a text, lower-cased and with an edge mark on
    both sides, in pieces of bounded size."""
    low = text.lower()
    for at in range(0, max(len(low), 1), CHUNK):
        # a piece takes along the characters that its last n-grams run into
        part = low[at:at + CHUNK + max(ORDERS) - 1]
        c = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
        if at == 0:
            c = np.r_[np.uint64(0), c]
        own = CHUNK + (at == 0)
        if at + CHUNK >= len(low):
            c = np.r_[c, np.uint64(0)]
            own = len(c)
        for n in ORDERS:
            k = min(len(c) - n + 1, own)
            if k <= 0:
                continue
            x = np.full(k, n, np.uint64) * _ODD[0]
            for i in range(n):
                x += c[i:i + k] * (_ODD[i] ^ np.uint64(n << 7))
            yield ((x * _ODD[1]) >> np.uint64(48)).astype(np.int64)


def _counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    total = np.zeros(BUCKETS)
    for g in _grams(text):
        total += np.bincount(g, minlength=BUCKETS)
    used = np.flatnonzero(total)
    return used, total[used]


@dataclass
class Model:
    languages: list[str]
    #: Per bucket: idf times each language's weight, and the idf itself.
    table: np.ndarray
    bias: np.ndarray
    temperature: float

    def predict(self, text: str) -> tuple[int, float]:
        total = np.zeros(self.table.shape[1])
        for g in _grams(text):
            total += self.table[g].sum(axis=0, dtype=np.float64)
        mass = total[-1] or 1.0
        p = softmax((total[:-1] * (SCALE / mass) + self.bias) / self.temperature)
        best = int(p.argmax())
        return best, float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal over (class, buckets, values); the last coordinate is
    the bias.  Returns weights [bucket, class] and biases."""
    z = np.zeros((BUCKETS + 1, classes))
    g2 = np.zeros((BUCKETS + 1, classes))

    def weights(zz: np.ndarray, gg: np.ndarray) -> np.ndarray:
        w = -(zz - np.sign(zz) * L1) / ((BETA + np.sqrt(gg)) / ALPHA + L2)
        return np.where(np.abs(zz) <= L1, 0.0, w)

    for _ in range(EPOCHS):
        for y, at, x in rows:
            zz, gg = z[at], g2[at]
            w = weights(zz, gg)
            err = softmax(x @ w)
            err[y] -= 1
            g = x[:, None] * err[None, :]
            step = (np.sqrt(gg + g * g) - np.sqrt(gg)) / ALPHA
            z[at] = zz + g - step * w
            g2[at] = gg + g * g
    w = weights(z, g2)
    return w[:-1], w[-1]


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by a search in ever finer steps."""
    if not len(y):
        return 1.0
    low, high = np.log(0.5), np.log(20.0)  # a separable sample has no least loss below
    for _ in range(5):
        grid = np.linspace(low, high, 21)
        loss = []
        for t in grid:
            p = softmax(logits / np.exp(t))[np.arange(len(y)), y]
            loss.append(-np.log(np.maximum(p, 1e-12)).mean())
        i = int(np.argmin(loss))
        low, high = grid[max(i - 1, 0)], grid[min(i + 1, 20)]
    return float(np.exp(grid[i]))


def _letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def train(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fit on ``docs(doc_id, text, lang)``, rows with a letter and a language;
    None if there are none."""
    spark = docs.sparkSession
    ship_package(spark)
    usable = docs.where(F.col("lang").isNotNull() & _letters(F.col("text")))
    counts = {r["lang"]: r["n"] for r in
              usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if not counts:
        return None
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = sorted(counts)
    n_docs = sum(counts.values())

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(BUCKETS, np.int64)
        seen = np.zeros(BUCKETS, bool)
        for batch in batches:
            for t in batch.column(0):
                seen[:] = False
                for g in _grams(t.as_py()):
                    seen[g] = True
                df += seen
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(df[used])], names=["bucket", "n"])

    df = np.zeros(BUCKETS)
    for r in (usable.select("text").mapInArrow(frequencies, "bucket long, n long")
              .groupBy("bucket").agg(F.sum("n").alias("n")).collect()):  # at most BUCKETS rows
        df[r["bucket"]] = r["n"]
    idf = np.log((1 + n_docs) / (1 + df)) + 0.05

    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, sample / len(languages) / n)).otherwise(share)
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20))
    drawn = usable.where(draw < share * float(1 << 20)).select("text", "lang", draw.alias("draw"))
    place = {lang: i for i, lang in enumerate(languages)}

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, lang, d in zip(*(c.to_pylist() for c in batch.columns)):
                at, tf = _counts(t)
                out.append((place[lang], d, at.astype("<i4").tobytes(), tf.astype("<f4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))]
                if out else [pa.array([], k) for k in (pa.int32(), pa.int64(), pa.binary(), pa.binary())],
                names=["y", "draw", "at", "tf"])

    rows = materialise(drawn.mapInArrow(features, "y int, draw long, at binary, tf binary"), "langid-sample")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            for y, d, at, tf in zip(*(c.to_pylist() for c in batch.columns)):
                at, tf = np.frombuffer(at, "<i4").astype(np.int64), np.frombuffer(tf, "<f4").astype(np.float64)
                x = tf * idf[at]
                found.append((d, y, np.r_[at, BUCKETS], np.r_[x * (SCALE / x.sum()), 1.0], at.tobytes()))
        found.sort(key=lambda r: (r[0], r[1], r[4]))
        rows = [r[1:4] for r in found]
        test = [r for i, r in enumerate(rows) if i % HELD_BACK == 0]
        w, bias = fit_ftrl([r for i, r in enumerate(rows) if i % HELD_BACK] or test, len(languages))
        full = np.vstack([w, bias])
        t = fit_temperature(np.array([x @ full[at] for _, at, x in test]), np.array([y for y, _, _ in test]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.astype("<f8").tobytes(), bias.astype("<f8").tobytes(), np.array([t]).tobytes()])],
            names=["part"])

    # the bounded sample meets in one task; BUCKETS x languages numbers return
    parts = [r["part"] for r in rows.repartition(1).mapInArrow(fit, "part binary").collect()]
    w = np.frombuffer(parts[0]).reshape(BUCKETS, len(languages))
    table = np.concatenate([w * idf[:, None], idf[:, None]], axis=1).astype(np.float32)
    return Model(languages, table, np.frombuffer(parts[1]), float(np.frombuffer(parts[2])[0]))


def predict(docs: DataFrame, model: Model | None, keep: list[Column] | None = None) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id``, ``lang_pred``, ``score`` and the
    columns of ``keep``.  A null text, one without a letter, or no model: UNKNOWN, score 0."""
    keep = keep or []
    if model is None:
        return docs.select("doc_id", *keep, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    asked = docs.select("doc_id", *keep, F.when(_letters(F.col("text")), F.col("text")).alias("__text"))
    width = len(asked.columns) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            found = [m.predict(t.as_py()) if t.is_valid else (-1, 0.0) for t in batch.column(width)]
            names = [m.languages[i] if i >= 0 else UNKNOWN for i, _ in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width], pa.array(names, pa.string()), pa.array([p for _, p in found], pa.float64())],
                names=[*batch.schema.names[:width], "lang_pred", "score"])

    schema = ", ".join(f"`{c}` {k}" for c, k in asked.dtypes[:-1])
    return asked.mapInArrow(run, f"{schema}, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """Fixed by the contract: documents that no training may see."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def langid_query(docs: DataFrame) -> DataFrame:
    """Learn from all labelled documents that are not held out, predict all.
    Repeated rows are predicted each; an empty table gives no rows."""
    model = train(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    return predict(docs, model, [held_out(F.col("doc_id")).alias("held_out")]).select(
        "doc_id", "held_out", "lang_pred", "score")
