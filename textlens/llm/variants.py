"""Spelling variants: Bloom-guided edit neighbourhoods.

1. Runs of letters are counted; the frequent ones are the vocabulary.
2. The vocabulary goes into blocked Bloom filters, one per word length.  They
   are built by the tasks, joined by bitwise or, and broadcast; a round holds
   at most FILTER_BYTES of them, and a larger vocabulary takes more rounds,
   each with the filters of one slice of the words.
3. Every word generates its deletions and the replacements by a later letter,
   as hashes only, and probes them against the filters of the length they
   would have.  An insertion is the other word's deletion and a replacement
   by an earlier letter the other word's replacement, so each pair of near
   words is generated once, from one of its two sides.
4. Only positives become strings and shuffle to an exact join with the
   vocabulary, which leaves out the false ones.
5. Forms are followed to their last by pointer doubling.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlens.llm.common import materialise
from textlens.session import ship_package

LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2
RUN = re.compile("[A-Za-z%s-%s]{%d,}" % (chr(0xC0), chr(0xFF), LEAST_LENGTH))
#: The letters that runs are made of, A-Z lower-cased.
LETTERS = np.r_[np.arange(0x61, 0x7B), np.arange(0xC0, 0x100)].astype(np.uint64)
#: Every so many (document, word) pairs a code point is left out.
DROP_EVERY = 97
#: Different words counted in a task before their counts are passed on.
HELD_WORDS = 400_000
#: Texts above this many characters are read run by run.
LONG_TEXT = 1 << 20

#: Filters: a word sets one bit in each of a block's eight 64-bit words.
#: BITS per word; bytes of the filters that are broadcast at a time.
BITS, FILTER_BYTES = 16, 32 << 20
#: Lengths from here on share filters, by their remainder, so that there are
#: at most twice as many filters.
OWN_LENGTHS = 64
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
# The salts of Parquet's split-block Bloom filters.
SALTS = [np.uint64(x) for x in (0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947,
                                0x5C6BFB31)]
#: Probes made at a time.
PROBES = 1 << 20


# ------------------------------------------------------------- vocabulary
def document_runs(doc_id: str | None, text: str) -> Iterator[tuple[str, int]]:
    """Words of one document with their counts, after the leaving out."""
    low = text.encode("utf-8").lower().decode("utf-8")  # bytes lower-case A-Z alone
    found = Counter(RUN.findall(low)) if len(low) <= LONG_TEXT else Counter(m.group() for m in RUN.finditer(low))
    start = zlib.crc32(f"{doc_id if doc_id is not None else ''}:".encode())
    for run, n in found.items():
        h = zlib.crc32(run.encode("utf-8"), start)
        if h % DROP_EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < LEAST_LENGTH:
                continue
        yield run, n


def vocabulary(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """``docs(doc_id, text)`` -> ``word, n`` of all words with ``least``
    occurrences or more.  Counts are summed in the tasks before the shuffle."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])

        total: Counter = Counter()
        for batch in batches:
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                if t.is_valid:
                    for word, n in document_runs(d, t.as_py()):
                        total[word] += n
                    if len(total) > HELD_WORDS:
                        yield out()
                        total.clear()
        yield out()

    counts = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string")).mapInArrow(
        run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least)


# ------------------------------------------------------------------ hashes
def _terms(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per position of words of one length: the letter's part of the word's
    hash, and its weight there."""
    weight = np.full(codes.shape[1], BASE, np.uint64)
    weight[0] = 1
    weight = np.multiply.accumulate(weight)[::-1]
    return codes * weight, weight


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, code points) of the words of each length."""
    size = np.array([len(w) for w in words], np.int64)
    for length in np.unique(size).tolist():
        at = np.flatnonzero(size == length)
        step = max(1, PROBES // length)
        for i in range(0, len(at), step):
            part = at[i:i + step]
            text = "".join(words[j] for j in part.tolist())
            yield part, np.frombuffer(text.encode("utf-32-le"), "<u4").reshape(len(part), length).astype(np.uint64)


def shard(length: int) -> int:
    return length if length < OWN_LENGTHS else OWN_LENGTHS + length % OWN_LENGTHS


def _bits(mixed: np.ndarray, i: int) -> np.ndarray:
    """Which bit of the block's i-th word a hash sets."""
    return (((mixed & np.uint64(0xFFFFFFFF)) * SALTS[i]) & np.uint64(0xFFFFFFFF)) >> np.uint64(26)


def _block(mixed: np.ndarray, blocks: int) -> np.ndarray:
    return (((mixed >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64)


def _slice(mixed: np.ndarray, slices: int) -> np.ndarray:
    return (_mix(mixed + np.uint64(1)) % np.uint64(slices)).astype(np.int64)


# ----------------------------------------------------------------- filters
def build_filters(words: DataFrame, sizes: dict[int, int], slices: int, part: int) -> dict[int, np.ndarray]:
    """Filters of one slice of the vocabulary: shard -> [block, 8] words of 64
    bits.  ``sizes`` holds the blocks of each shard; together they are at most
    FILTER_BYTES, and that is what comes back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, codes in _by_length(batch.column(0).to_pylist()):
                which = shard(codes.shape[1])
                mixed = _mix(_terms(codes)[0].sum(axis=1, dtype=np.uint64))
                mixed = mixed[_slice(mixed, slices) == part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(mixed), which), pa.int32()), pa.array(_block(mixed, sizes[which])),
                     *(pa.array((np.uint64(1) << _bits(mixed, i)).view(np.int64)) for i in range(8))],
                    names=["shard", "block", *(f"w{i}" for i in range(8))])

    rows = (words.select("word").mapInArrow(run, "shard int, block long, " + ", ".join(f"w{i} long" for i in range(8)))
            .groupBy("shard", "block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(8)))).toArrow()
    out = {s: np.zeros((n, 8), np.uint64) for s, n in sizes.items()}
    which, block = (rows.column(c).to_numpy() for c in ("shard", "block"))
    values = np.stack([rows.column(f"w{i}").to_numpy().view(np.uint64) for i in range(8)], axis=1)
    for s, table in out.items():
        table[block[which == s]] = values[which == s]
    return out


def _contains(table: np.ndarray, mixed: np.ndarray) -> np.ndarray:
    """Places of the hashes that the filter holds."""
    at = np.arange(len(mixed))
    block = _block(mixed, len(table))
    for i in range(8):
        hit = (table[block, i] >> _bits(mixed, i)) & np.uint64(1) == 1
        at, block, mixed = at[hit], block[hit], mixed[hit]
    return at


def edits(words: list[str], filters: dict[int, np.ndarray], slices: int, part: int) -> Iterator[tuple[int, str]]:
    """(place of the word, edited word) of the edits that the filters hold:
    deletions, and replacements by a letter with a larger code point."""
    def probe(table: np.ndarray, h: np.ndarray) -> np.ndarray:
        mixed = _mix(h)
        if slices > 1:
            own = np.flatnonzero(_slice(mixed, slices) == part)
            return own[_contains(table, mixed[own])]
        return _contains(table, mixed)

    for places, codes in _by_length(words):
        m, length = codes.shape
        terms, weight = _terms(codes)
        whole = terms.sum(axis=1, dtype=np.uint64)
        table = filters.get(shard(length - 1))
        if table is not None and length > 1:
            # what is before the place has one factor less
            less = np.r_[weight[1:], np.uint64(0)]
            before = np.cumsum(codes * less, axis=1, dtype=np.uint64) - codes * less
            after = whole[:, None] - np.cumsum(terms, axis=1, dtype=np.uint64)
            # in a run of one letter only the last place is taken
            row, at = np.nonzero(np.concatenate([codes[:, 1:] != codes[:, :-1], np.ones((m, 1), bool)], axis=1))
            for k in probe(table, (before + after)[row, at]).tolist():
                w = words[places[row[k]]]
                yield int(places[row[k]]), w[:at[k]] + w[at[k] + 1:]
        table = filters.get(shard(length))
        if table is None:
            continue
        step = max(1, PROBES // (len(LETTERS) * m))
        for i in range(0, length, step):
            row, at, new = np.nonzero(LETTERS[None, None, :] > codes[:, i:i + step, None])
            at += i
            h = whole[row] + (LETTERS[new] - codes[row, at]) * weight[at]
            for k in probe(table, h).tolist():
                w = words[places[row[k]]]
                yield int(places[row[k]]), w[:at[k]] + chr(int(LETTERS[new[k]])) + w[at[k] + 1:]


def near_pairs(words: DataFrame) -> DataFrame:
    """``words(word, n)`` -> ``word, n, near, near_n``: every pair of words
    one edit apart, in both directions."""
    spark = words.sparkSession
    length = F.length("word")
    own = F.when(length < OWN_LENGTHS, length).otherwise(OWN_LENGTHS + length % OWN_LENGTHS)
    counts = {r["shard"]: r["n"] for r in words.groupBy(own.alias("shard")).agg(
        F.count(F.lit(1)).alias("n")).collect()}  # at most 2 x OWN_LENGTHS rows
    slices = max(1, -(-sum(counts.values()) * BITS // (8 * FILTER_BYTES)))
    sizes = {s: -(-n * BITS // (512 * slices)) for s, n in counts.items()}
    found = None
    for part in range(slices):
        shared = spark.sparkContext.broadcast(build_filters(words, sizes, slices, part))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, part=part) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 2000):
                    piece = batch.slice(at, 2000)
                    hits = list(edits(piece.column(0).to_pylist(), shared.value, slices, part))
                    places = pa.array([i for i, _ in hits], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [piece.column(0).take(places), piece.column(1).take(places),
                         pa.array([w for _, w in hits], pa.string())], names=["word", "n", "near"])

        positives = words.select("word", "n").mapInArrow(run, "word string, n long, near string")
        found = positives if found is None else found.unionByName(positives)
    if found is None:
        return words.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    one = found.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    both = F.explode(F.array(
        F.struct("word", "n", "near", "near_n"),
        F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"),
                 F.col("n").alias("near_n"))))
    return one.select(both.alias("p")).select("p.*")


def roots(forms: DataFrame) -> DataFrame:
    """``forms(word, form)``, forms not null -> ``word, root``: the last form
    reached from each word.  Each round doubles the steps taken; as a form
    has at least RATIO times its word's count, a chain of c occurrences at
    its end has at most log2(c) steps and the rounds are few."""
    state = materialise(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        on = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        state = materialise(
            state.join(on, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "variant-roots")
        if not state.where("moved").limit(1).count():
            return state.select("word", "root")


def group_variants(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """``docs(doc_id, text)`` -> ``word, form, root, n, n_near, form_n``, one
    row per word of the vocabulary.

    Null texts hold no word, a null id counts as an empty one, repeated rows
    are counted each; an empty table gives no rows.  Of near words with equal
    counts the one first in code-point order is the form."""
    words = materialise(vocabulary(docs, least), "variant-words")
    best = F.min(F.struct((-F.col("near_n")).alias("order"), "near"))
    near = near_pairs(words).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    strong = -F.col("best.order") >= RATIO * F.col("n")
    near = materialise(near.select(
        "word", "n_near", F.when(strong, F.col("best.near")).alias("form"),
        F.when(strong, -F.col("best.order")).alias("form_n")), "variant-forms")
    ends = roots(near.where(F.col("form").isNotNull()))
    return (words.join(near, "word", "left").join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))


def variants_query(docs: DataFrame) -> DataFrame:
    """Every word of the vocabulary with its near words' number, form and
    root; see ``group_variants`` for nulls, ties and repeated rows."""
    return group_variants(docs)
