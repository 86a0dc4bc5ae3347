"""Toxicity by maximum-scoring segments.

1. Words, and their first letters as stems, are counted in hashed buckets: in
   a bounded sample of the labelled documents by their different left
   neighbours, so that copies of a passage count once, and in all documents
   by their occurrences.
2. A word's score is the log-odds of its shares in toxic and in other sample
   documents under Dirichlet priors: the prior pseudo-occurrences of a word
   are shared out between the classes as its stem's counts are, those of a
   stem as the classes' sums are.  Corpus-wide frequent words have more
   of them.  DRIFT is taken off, so that a text without evidence falls.
3. One linear scan per text finds all its maximal scoring segments.
4. On the part of the sample held back from the counts, the best segments of
   clean texts give the parameters of their extreme-value law: the number of
   segments of score s or more in a clean text of m words is
   K m exp(-lambda s).  The sum of a text's r best segments follows from the
   same law, for every r; the passages are the segments of the least likely
   sum, and all that are unlikely alone.
5. A text's evidence, minus the log of that least probability, is turned into
   a probability of the label by logistic regression on the held-back part,
   weighted to the classes' shares among all labelled documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from textlens.llm.common import materialise
from textlens.session import ship_package

WORD = re.compile(r"[^\W\d_]+")
#: Words are counted in ROWS rows of so many buckets, of which the least
#: filled counts; their first STEM letters, the stems, in one such row.
BUCKETS, ROWS, STEM = 1 << 20, 2, 4
#: Bound of the training sample, in labelled documents of each class.
SAMPLE = 20_000
#: Every third document of the sample calibrates and is not counted.
HELD_BACK = 3
#: Pseudo-occurrences of every word, and the share of its corpus-wide
#: frequency that is added to them.
PRIOR, PRIOR_SHARE = 1.0, 0.05
DRIFT = 0.5
#: Passages would turn up in this share of clean texts of the same length.
SIGNIFICANT = 0.01
THRESHOLD = 0.7
#: Texts above this many characters are read word by word; words remembered.
LONG_TEXT, MEMO = 1 << 20, 200_000


def words(text: str) -> Iterator[str]:
    low = text.lower()
    return iter(WORD.findall(low)) if len(low) <= LONG_TEXT else (m.group() for m in WORD.finditer(low))


def buckets(found: list[str]) -> np.ndarray:
    """Each word's bucket in each row, then its stem's."""
    h = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))
    stem = np.fromiter((xxhash.xxh64_intdigest(w[:STEM], 1) for w in found), np.uint64, len(found))
    rows = [(h >> np.uint64(32 * row)) % np.uint64(BUCKETS) + np.uint64(row * BUCKETS) for row in range(ROWS)]
    return np.stack([*rows, stem % np.uint64(BUCKETS) + np.uint64(ROWS * BUCKETS)], axis=1).astype(np.int64)


def word_buckets(word: str) -> list[int]:
    """The same of a single word."""
    h = xxhash.xxh64_intdigest(word)
    return [(h >> (32 * row)) % BUCKETS + row * BUCKETS for row in range(ROWS)] + [
        xxhash.xxh64_intdigest(word[:STEM], 1) % BUCKETS + ROWS * BUCKETS]


# ---------------------------------------------------------------- segments
def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(start, end, score)`` of a sequence, in
    linear time.  Neighbouring scores of one sign are summed first; each run
    above zero then joins those before it while that raises the score."""
    up = scores > 0
    if not up.any():
        return []
    edge = np.flatnonzero(np.diff(up, prepend=not up[0]))
    total = np.cumsum(scores, dtype=np.float64)
    stop = np.r_[edge[1:], len(scores)]
    rise = np.flatnonzero(up[edge])
    low = np.where(edge[rise] > 0, total[edge[rise] - 1], 0.0).tolist()
    high = total[stop[rise] - 1].tolist()
    kept: list[tuple[float, float, int, int, int]] = []  # before, after, start, end, the nearest lower one
    for before, after, start, end in zip(low, high, edge[rise].tolist(), stop[rise].tolist()):
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][0] >= before:
                j = kept[j][4]
            if j < 0 or kept[j][1] >= after:
                kept.append((before, after, start, end, j))
                break
            before, start = kept[j][0], kept[j][2]
            del kept[j:]
    return [(s, e, b - a) for a, b, s, e, _ in kept]


class Scores(dict):
    """word -> log-odds less the drift, worked out when first met."""

    def __init__(self, log_odds):
        super().__init__()
        self.log_odds = log_odds

    def of(self, text: str) -> np.ndarray:
        """Scores of a text's words; one said again at once adds nothing."""
        found, parts, last = words(text), [], None
        while part := list(islice(found, 1 << 16)):
            if len(self) > MEMO:
                self.clear()
            if new := [w for w in set(part) if w not in self]:
                self.update(zip(new, (self.log_odds(new) - DRIFT).tolist()))
            again = np.fromiter(map(eq, part, chain((last,), part)), bool, len(part))
            parts.append(np.where(again, -DRIFT, np.fromiter(map(self.__getitem__, part), np.float64, len(part))))
            last = part[-1]
        return np.concatenate(parts) if parts else np.zeros(0)


@dataclass
class Lexicon:
    """Left neighbours by bucket in the toxic and the other sample documents,
    and occurrences in the corpus, scaled to the same sum."""

    toxic: np.ndarray
    other: np.ndarray
    corpus: np.ndarray

    def __post_init__(self):
        self.n_toxic, self.n_other = (max(float(x[:BUCKETS].sum()), 1.0) for x in (self.toxic, self.other))

    def log_odds(self, found: list[str]) -> np.ndarray:
        at = buckets(found)
        rows, stem = at[:, :ROWS], at[:, ROWS]
        # a stem's pseudo-occurrences fall to the classes by their sums, a word's as its stem's counts
        base = self.n_toxic / (self.n_toxic + self.n_other)
        t, o = self.toxic[stem].astype(np.float64), self.other[stem].astype(np.float64)
        share = (t + PRIOR * base) / (t + o + PRIOR)
        toxic, other, corpus = (x[rows].min(axis=1).astype(np.float64) for x in (self.toxic, self.other, self.corpus))
        k = PRIOR + PRIOR_SHARE * corpus
        return np.log((toxic + k * share) / self.n_toxic) - np.log((other + k * (1 - share)) / self.n_other)


@dataclass
class Model:
    lexicon: Lexicon
    rate: float  # lambda
    scale: float  # K
    weights: np.ndarray  # of the evidence's features

    def judge(self, scores: np.ndarray) -> tuple[float, list[tuple[int, int, float, float]]]:
        """(probability, passages) of a text's words; a passage is (start,
        end, score, expected number in a clean text)."""
        found = maximal_segments(scores)
        nats = np.array([self.rate * s for *_, s in found]) - np.log(self.scale * max(len(scores), 1))
        order, evidence = least_likely_sum(nats)
        expected = np.exp(-nats)
        if evidence < -np.log(SIGNIFICANT):
            order = order[:0]
        taken = set(order.tolist()) | set(np.flatnonzero(expected <= SIGNIFICANT).tolist())
        passages = [(*found[i], float(expected[i])) for i in sorted(taken)]
        return float(_logistic(_features(evidence) @ self.weights)), passages


def least_likely_sum(nats: np.ndarray) -> tuple[np.ndarray, float]:
    """(segments, evidence): of the sums of the r best normalised scores the
    one that is least likely in a clean text, P(sum >= x) being
    exp(-x) x^(r-1) / (r! (r-1)!), and minus the log of its probability.  The
    r-th sum gets 1 in 2^r of the chance of error."""
    if not len(nats):
        return np.zeros(0, np.int64), 0.0
    order = np.argsort(-nats, kind="stable")
    r = np.arange(1, len(nats) + 1)
    logs = np.cumsum(np.log(r))  # log r!
    x = np.cumsum(nats[order])
    p = np.where(x > r, x - (r - 1) * np.log(np.maximum(x, 1e-9)) + logs + (logs - np.log(r)), 0.0) - r * np.log(2)
    best = int(p.argmax())
    return order[:best + 1], max(float(p[best]), 0.0)


def _features(evidence: float) -> np.ndarray:
    """Of the evidence: bias, a part that grows on and one that levels off."""
    return np.array([1.0, np.sqrt(min(evidence, 400.0)), evidence / (evidence + 8.0)])


def _logistic(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


# ------------------------------------------------------------- calibration
def fit_extreme_values(best: np.ndarray, size: np.ndarray) -> tuple[float, float]:
    """(lambda, K) of greatest likelihood for the best segment scores of clean
    texts of ``size`` words: P(best < s) = exp(-K m exp(-lambda s)).  K follows
    from lambda; lambda by a search in ever finer steps."""
    if not len(best):
        return 1.0, 1.0
    n, m = len(best), np.maximum(size, 1).astype(np.float64)

    def likelihood(rate: float) -> float:
        k = n / (m * np.exp(-rate * best)).sum()
        return n * np.log(rate) + n * np.log(k) - rate * best.sum()

    low, high = np.log(0.05), np.log(5.0)
    for _ in range(6):
        grid = np.linspace(low, high, 21)
        i = int(np.argmax([likelihood(float(np.exp(g))) for g in grid]))
        low, high = grid[max(i - 1, 0)], grid[min(i + 1, 20)]
    rate = float(np.exp(grid[i]))
    return rate, float(n / (m * np.exp(-rate * best)).sum())


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weighted logistic regression by Newton steps; the first column is the
    bias and is not penalised."""
    w = np.zeros(x.shape[1])
    penalty = np.r_[0.0, np.full(x.shape[1] - 1, ridge)] + 1e-9
    for _ in range(50):
        p = _logistic(x @ w)
        grad = x.T @ (weight * (p - y)) + penalty * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty) + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


# ---------------------------------------------------------------- training
def count_corpus(docs: DataFrame) -> np.ndarray:
    """Occurrences by bucket of the words of ``docs(text)``.  They are summed
    in the tasks; one number for each bucket comes back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        sums = np.zeros((ROWS + 1) * BUCKETS)

        def settle() -> None:
            at = buckets(list(total))
            n = np.fromiter(total.values(), np.int64, len(total))
            sums[:] += np.bincount(at.ravel(), np.repeat(n, ROWS + 1), len(sums))
            total.clear()

        for batch in batches:
            for t in batch.column(0):
                if t.is_valid:
                    total.update(words(t.as_py()))
                    if len(total) > MEMO:
                        settle()
        settle()
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used].astype(np.int64))], names=["bucket", "n"])

    return _collected(docs.select(F.col("text").cast("string")).mapInArrow(run, "bucket long, n long")
                      .groupBy("bucket").agg(F.sum("n").alias("n")))


def count_contexts(docs: DataFrame) -> DataFrame:
    """``docs(text, y)`` -> ``y, bucket, n``: different left neighbours of the
    words in each bucket, by class.  A text's first word has none, which
    counts as one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[int]] = {}
        seen: dict[tuple[int, int], list[int]] = {}

        def out() -> pa.RecordBatch:
            found = pa.array(list(seen.values()), pa.list_(pa.int32()))
            y, pair = zip(*seen) if seen else ((), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(y, pa.int32()), pa.array(pair, pa.int64()), found], names=["y", "pair", "buckets"])

        for batch in batches:
            for t, y in zip(batch.column(0), batch.column(1).to_pylist()):
                before = ""
                for word in words(t.as_py()):
                    key = (y, xxhash.xxh64_intdigest(f"{before} {word}") - (1 << 63))
                    if key not in seen:
                        if word not in known:
                            known[word] = word_buckets(word)
                        seen[key] = known[word]
                        if len(seen) > MEMO:
                            yield out()
                            seen.clear()
                            known.clear()
                    before = word
        yield out()

    pairs = docs.mapInArrow(run, "y int, pair long, buckets array<int>").dropDuplicates(["y", "pair"])
    return pairs.select("y", F.explode("buckets").alias("bucket")).groupBy("y", "bucket").agg(
        F.count(F.lit(1)).alias("n"))


def _collected(counts: DataFrame) -> np.ndarray:
    """Counts as an array: at most one row for each bucket comes back."""
    rows = counts.select("bucket", "n").toArrow()
    sums = np.zeros((ROWS + 1) * BUCKETS, np.float32)
    sums[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return sums


def sample_labels(labels: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, dict[int, int]]:
    """At most ``sample`` labelled document ids of each class, by hash, and
    how many documents are labelled with each."""
    spark = labels.sparkSession
    one = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("y"))
    counts = {r["y"]: r["n"] for r in one.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    draw = F.xxhash64("doc_id", F.lit("toxic"))
    parts = [one.where(F.col("y") == y).orderBy(draw, "doc_id").limit(sample).select(
        "doc_id", "y", (F.pmod(draw, F.lit(HELD_BACK)) == 0).alias("back")) for y in (0, 1)]
    return parts[0].unionByName(parts[1]), counts


def train(docs: DataFrame, labels: DataFrame, corpus: DataFrame | None = None, sample: int = SAMPLE) -> Model | None:
    """Fit on ``docs(doc_id, text)`` with ``labels(doc_id, toxic)``; the words
    of ``corpus`` (default: ``docs``) inform the priors.  None if either class
    has no document with a text.

    Several labels of one document: toxic if one of them says so."""
    ship_package(docs.sparkSession)
    chosen, counts = sample_labels(labels, sample)
    texts = materialise(  # at most 2 x sample ids
        docs.select("doc_id", F.col("text").cast("string")).where(F.col("text").isNotNull())
        .join(F.broadcast(chosen), "doc_id").select("text", "y", "back"), "toxicity-sample")
    counted = count_contexts(texts.where(~F.col("back")).select("text", "y")).persist()
    other, toxic = (_collected(counted.where(F.col("y") == y)) for y in (0, 1))
    counted.unpersist()
    if not other.any() or not toxic.any():
        return None
    everything = count_corpus(docs if corpus is None else corpus)
    length = [float(x[:BUCKETS].sum()) for x in (everything, toxic, other)]
    lexicon = Lexicon(toxic, other, everything * np.float32((length[1] + length[2]) / max(length[0], 1.0)))
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # three numbers a bucket

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(shared.value.log_odds)
        for batch in batches:
            found = []
            for t in batch.column(0):
                s = scores.of(t.as_py())
                found.append((len(s), [x for _, _, x in maximal_segments(s)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([m for m, _ in found], pa.int64()),
                 pa.array([x for _, x in found], pa.list_(pa.float64()))], names=["y", "m", "segments"])

    back = texts.where("back").select("text", "y").mapInArrow(
        segments, "y int, m long, segments array<double>")
    back = back.where("m > 0").toArrow()  # at most 2 x sample rows
    labels_, size = back.column("y").to_numpy(), back.column("m").to_numpy().astype(np.float64)
    held = [np.array(x, np.float64) for x in back.column("segments").to_pylist()]
    best = np.array([x.max(initial=0.0) for x in held])
    rate, scale = fit_extreme_values(best[labels_ == 0], size[labels_ == 0])
    x = np.array([_features(least_likely_sum(rate * one - np.log(scale * m))[1])
                  for one, m in zip(held, size)]).reshape(len(held), 3)
    per = {c: counts.get(c, 0) / max(int((labels_ == c).sum()), 1) for c in (0, 1)}
    weight = np.array([per[int(c)] for c in labels_])
    weights = fit_logistic(x, labels_.astype(float), weight / max(weight.mean(), 1e-12)) if len(held) else np.zeros(3)
    return Model(lexicon, rate, scale, weights)


def score(docs: DataFrame, model: Model | None, keep: list[Column] | None = None) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id``, the columns of ``keep``, ``score``
    and ``passages`` (array of start, end [characters, end exclusive], score,
    expected), whole texts.  Null and empty texts have no passage; without a
    model every score is 0."""
    keep = keep or []
    kind = "array<struct<start:long,end:long,score:double,expected:double>>"
    asked = docs.select("doc_id", *keep, F.col("text").cast("string").alias("__text"))
    if model is None:
        return asked.drop("__text").withColumns({"score": F.lit(0.0), "passages": F.array().cast(kind)})
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    width = len(asked.columns) - 1
    struct = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        scores = Scores(m.lexicon.log_odds)
        for batch in batches:
            p, spans = [], []
            for t in batch.column(width):
                text = t.as_py() or ""
                chance, found = m.judge(scores.of(text))
                p.append(chance)
                spans.append(_places(text, found))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width], pa.array(p, pa.float64()), pa.array(spans, pa.list_(struct))],
                names=[*batch.schema.names[:width], "score", "passages"])

    schema = ", ".join(f"`{c}` {k}" for c, k in asked.dtypes[:-1])
    return asked.mapInArrow(run, f"{schema}, score double, passages {kind}")


def _places(text: str, found: list[tuple[int, int, float, float]]) -> list[dict]:
    """Passages from word numbers to characters of the text.  Lower-casing
    may lengthen a text; words are counted in the text as it is then."""
    if not found:
        return []
    starts = {a: i for i, (a, *_) in enumerate(found)}
    ends = {b - 1: i for i, (_, b, *_) in enumerate(found)}
    out = [{"score": s, "expected": e} for *_, s, e in found]
    same = len(low := text.lower()) == len(text)
    shift = None if same else np.cumsum([len(c.lower()) for c in text])
    back = (lambda x: x) if same else (lambda x: int(np.searchsorted(shift, x, "right")))
    for i, m in enumerate(WORD.finditer(low)):
        if i in starts:
            out[starts[i]]["start"] = back(m.start())
        if i in ends:
            out[ends[i]]["end"] = back(m.end() - 1) + 1
    return out


def held_out(doc_id: Column) -> Column:
    """Fixed by the contract: documents whose labels no training may see."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def toxicity_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labels of all documents that are not held out, score
    all documents.  A null or empty text has no passage and gets the score of
    a text without evidence; repeated rows are scored each; a null id has no
    label; an empty table gives no rows; without labels of both classes every
    score is 0."""
    model = train(docs, labels.where(~held_out(F.col("doc_id"))).select("doc_id", "toxic"))
    out = score(docs, model, [held_out(F.col("doc_id")).alias("held_out")])
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
                      F.size("passages").cast("long").alias("n_passages"))
