"""Packing documents into fixed windows by lexical retrieval.

1. Texts are tokenized once and written as token ids, with the tasks' partial
   document frequencies in a column of their own.
2. Document frequencies of all tokens over all documents: the sums of that
   column (one row per token of the vocabulary, the bound of what comes back).
3. Shards of consecutive documents: whole windows of a long document are
   sequences of their own; the rests go into a BM25 inverted index of the
   shard.  Each unused rest in turn seeds a window and queries the index with
   all its tokens; the best unused neighbours fill the window, the last one
   cut so that nothing is padded, its rest staying in the index.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlens.llm.common import materialise
from textlens.session import ship_package

WINDOW = 2048
END_ID = 1
TOKENIZER = "byte_bpe_50k.json"
#: A shard ends with the document that reaches this many tokens of rests.
SHARD_TOKENS = 3_000_000
K1, B = 1.2, 0.75
SPECIAL = "<|endoftext|>"

_ENCODERS: dict[str, object] = {}


def encoder(name: str = TOKENIZER):
    """``encode(text) -> ids`` of a public tokenizer file (one per process).

    Byte-level BPE files that also exist as ranks are run by the faster of the
    two libraries; texts that hold a special token's string go to the library
    of the file itself, the only case in which the two differ."""
    if name not in _ENCODERS:
        import base64

        import public_tokenizers
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(public_tokenizers.path(name))

        def slow(text: str) -> np.ndarray:
            return np.asarray(whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

        encode = slow
        if name == TOKENIZER:
            import tiktoken

            with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
            quick = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})

            def encode(text: str) -> np.ndarray:
                return slow(text) if SPECIAL in text else np.array(quick.encode_ordinary(text), np.uint32)

        _ENCODERS[name] = encode
    return _ENCODERS[name]


def tokenize(docs: DataFrame, tokenizer: str = TOKENIZER, counts: bool = False) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, ids`` (unsigned 32-bit integers as
    little-endian bytes, END_ID last).  Null text: END_ID alone.

    With ``counts`` there is a column ``counts``, and each task adds rows that
    hold nothing but the document frequencies of some of its documents there."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        end = np.array([END_ID], dtype="<u4")
        held = Frequencies()
        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = [np.concatenate([encode(t), end]) if t else end for t in part.column(1).to_pylist()]
                columns = [part.column(0), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())]
                if counts:
                    held.add(ids)
                    columns.append(pa.nulls(len(ids), pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names)
        if counts and kind is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, kind), pa.nulls(1, pa.binary()), pa.array([held.packed()], pa.binary())], names=names)

    names = ["doc_id", "ids", "counts"][:3 if counts else 2]
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids binary" + (", counts binary" if counts else "")
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)


class Frequencies:
    """Document frequencies of tokens, the number of documents (id -1) and
    the tokens of their rests (id -2)."""

    def __init__(self):
        self.df = np.zeros(1 << 16, np.int64)
        self.n = self.rest = 0

    def add(self, documents: list[np.ndarray]) -> None:
        size = np.array([len(x) for x in documents], np.int64)
        ids = np.concatenate(documents).astype(np.int64) if documents else np.zeros(0, np.int64)
        if len(ids):
            top = int(ids.max()) + 1
            if top > len(self.df):
                self.df = np.concatenate([self.df, np.zeros(top - len(self.df), np.int64)])
            pairs = np.unique(np.repeat(np.arange(len(size)), size) * top + ids)  # each token once a document
            self.df[:top] += np.bincount(pairs % top, minlength=top)
        self.n += len(size)
        self.rest += int((size % WINDOW).sum())

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        used = np.flatnonzero(self.df)
        return np.r_[used, -1, -2], np.r_[self.df[used], self.n, self.rest]

    def packed(self) -> bytes:
        return np.stack(self.rows()).astype("<i8").tobytes()


def token_statistics(tokens: DataFrame) -> tuple[dict[int, int], int, float]:
    """Document frequency per token id, number of documents and mean length
    of their rests, over all documents; from the column ``counts``, where the
    table has it, else from the ids.  At most one row per token of the
    vocabulary comes back."""
    column = "counts" if "counts" in tokens.columns else "ids"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Frequencies()
        for batch in batches:
            if column == "ids":
                for at in range(0, batch.num_rows, 500):
                    held.add([np.frombuffer(x.as_buffer(), dtype="<u4") for x in batch.column(0).slice(at, 500)])
                continue
            for x in batch.column(0):
                ids, n = np.frombuffer(x.as_buffer(), dtype="<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], names=["id", "n"])
        if column == "ids":
            ids, n = held.rows()
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], names=["id", "n"])

    rows = tokens.select(column).where(F.col(column).isNotNull()).mapInArrow(run, "id long, n long").groupBy("id").agg(
        F.sum("n").alias("n")).collect()
    found = {r["id"]: r["n"] for r in rows}
    n, rest = found.pop(-1, 0), found.pop(-2, 0)
    return found, n, rest / max(n, 1)


class Shard:
    """BM25 inverted index over the rests of a shard's documents."""

    def __init__(self, rests: list[np.ndarray], idf: np.ndarray, mean: float):
        count = len(rests)
        size = np.array([len(r) for r in rests], dtype=np.float64)
        ids = np.concatenate(rests).astype(np.int64)
        unit = np.repeat(np.arange(count), size.astype(np.int64))
        key, tf = np.unique(ids * count + unit, return_counts=True)
        term, self.unit = key // count, key % count
        self.weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[self.unit] / max(mean, 1.0)))
        self.start = np.searchsorted(term, np.arange(len(idf) + 1))
        # per unit: its tokens
        order = np.argsort(self.unit, kind="stable")
        self.terms = term[order]
        self.own = np.searchsorted(self.unit[order], np.arange(count + 1))
        self.count = count

    def drop(self, free: np.ndarray) -> None:
        """Leave out the postings of units that are not free any more."""
        keep = free[self.unit]
        self.unit, self.weight = self.unit[keep], self.weight[keep]
        self.start = np.r_[0, np.cumsum(keep)][self.start]

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every unit for all tokens of the seed."""
        q = self.terms[self.own[seed]:self.own[seed + 1]]
        if not len(q):
            return np.zeros(self.count)
        spans = [slice(self.start[t], self.start[t + 1]) for t in q.tolist()]
        return np.bincount(np.concatenate([self.unit[s] for s in spans]),
                           np.concatenate([self.weight[s] for s in spans]), minlength=self.count)


def pack_shard(lengths: list[int], rests: list[np.ndarray], idf: np.ndarray, mean: float,
               window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Windows of (document, start, length).  Every token of every document
    lies in exactly one; all windows are full but for the shard's last, which
    is split into sequences whose lengths are powers of two, so that these
    need no padding either."""
    out = [[(d, s, window)] for d, n in enumerate(lengths) for s in range(0, n - window + 1, window)]
    docs = [d for d, n in enumerate(lengths) if n % window]
    if not docs:
        return out
    at = [lengths[d] - lengths[d] % window for d in docs]
    left = np.array([lengths[d] % window for d in docs])
    index = Shard([rests[d] for d in docs], idf, mean)
    free = np.ones(len(docs), bool)
    first, indexed = 0, len(docs)
    while True:
        while first < len(docs) and not free[first]:
            first += 1
        if first == len(docs):
            return out
        row: list[tuple[int, int, int]] = []
        space = window

        def take(u: int) -> None:
            nonlocal space
            k = int(min(space, left[u]))
            row.append((docs[u], at[u], k))
            at[u] += k
            left[u] -= k
            space -= k
            free[u] = left[u] > 0

        take(first)
        if space:
            if 4 * (left_over := int(np.count_nonzero(free))) < 3 * indexed:
                index.drop(free)
                indexed = left_over
            score = index.scores(first) * free
            for want in (16, len(docs)):
                k = min(want, len(docs))
                best = np.argpartition(-score, k - 1)[:k] if k < len(docs) else np.arange(len(docs))
                best = best[score[best] > 0]
                # ties by position, so that equal inputs pack alike
                for u in best[np.lexsort((best, -score[best]))].tolist():
                    if not space:
                        break
                    if free[u]:
                        take(u)
                if not space or len(best) < k:
                    break
        u = first
        while space and u < len(docs):  # no lexical neighbour is left
            if free[u]:
                take(u)
            u += 1
        if not space:
            out.append(row)
        else:
            out.extend(_powers(row))


def _powers(row: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    total = sum(k for _, _, k in row)
    out, pieces = [], list(row)
    for bit in reversed(range(total.bit_length())):
        need = total & (1 << bit)
        part = []
        while need:
            d, s, k = pieces.pop(0)
            n = min(k, need)
            part.append((d, s, n))
            need -= n
            if k > n:
                pieces.insert(0, (d, s + n, k - n))
        if part:
            out.append(part)
    return out


def pack_tokens(tokens: DataFrame, window: int = WINDOW) -> DataFrame:
    """``tokens(doc_id, ids)`` -> one row per piece: ``doc_id, start, length,
    ids, doc_tokens, sequence_id, offset``."""
    df, n, mean = token_statistics(tokens)
    top = max(df, default=0) + 1
    idf = np.zeros(top)
    for t, k in df.items():
        idf[t] = np.log(1 + (n - k + 0.5) / (k + 0.5))  # above 0 even for a token of all documents
    shared = tokens.sparkSession.sparkContext.broadcast(idf)  # one number per token of the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        sequence = TaskContext.get().partitionId() << 32
        doc_ids: list = []
        held: list[np.ndarray] = []
        rest = 0

        def shard():
            nonlocal sequence
            lengths = [len(x) for x in held]
            rows = pack_shard(lengths, [x[len(x) - len(x) % window:] for x in held], weights, mean, window)
            for at in range(0, len(rows), 2000):
                cols: list[list] = [[] for _ in range(7)]
                for row in rows[at:at + 2000]:
                    offset = 0
                    for d, s, k in row:
                        for c, v in zip(cols, (doc_ids[d], s, k, held[d][s:s + k].tobytes(), lengths[d],
                                               sequence, offset)):
                            c.append(v)
                        offset += k
                    sequence += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], kind), *(pa.array(c, pa.int64()) for c in cols[1:3]),
                     pa.array(cols[3], pa.binary()), *(pa.array(c, pa.int64()) for c in cols[4:])],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for d, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(x.as_buffer().to_pybytes(), dtype="<u4")
                doc_ids.append(d)
                held.append(ids)
                rest += len(ids)
                if rest >= SHARD_TOKENS:
                    yield from shard()
                    doc_ids, held, rest = [], [], 0
        if held:
            yield from shard()

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", "ids").where(F.col("ids").isNotNull()).mapInArrow(
        run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str = TOKENIZER, window: int = WINDOW) -> DataFrame:
    """``docs(doc_id, text)`` -> packed pieces, one row each: ``doc_id, start,
    length, ids`` (little-endian unsigned 32-bit), ``doc_tokens, sequence_id,
    offset``.

    A null or empty text is a document of END_ID alone.  Repeated rows are
    documents of their own.  An empty table gives no rows."""
    return pack_tokens(materialise(tokenize(docs, tokenizer, counts=True), "pack-tokens", "zstd"), window)


def pack_query(docs: DataFrame) -> DataFrame:
    """The pieces of ``pack_documents`` with a digest of their ids; see there
    for null texts, repeated rows and empty tables."""
    return pack_documents(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
