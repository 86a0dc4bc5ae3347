"""Alignment of two tokenizations of the same text.

1. Texts are cut before each run of spaces that follows a character that is no
   white space.  Neither tokenizer joins anything over such a place, so each
   segment is encoded once per process and its token ids are reused.
2. Divide and conquer at shared cuts: the byte ends of A's tokens in an
   interval are probed outwards from the middle, each by bisection in B's
   ends.  A shared end splits the interval and both halves go on; an interval
   without one is a group.  All intervals of a piece of the input advance
   together, one probe each a round.
3. Inside the groups every stretch between two neighbouring ends links the two
   tokens that cover it.  Links are written as blocks of documents; the
   distinct (A id, B id) pairs of a block, with the number of its documents
   that hold them, are summed over all blocks, and the sums return to the
   blocks that hold the pair.  No row per link is ever shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from textlens.llm.common import materialise
from textlens.llm.segments import SEGMENT, WHITE
from textlens.session import ship_package

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k", "piece_bpe_32k.model"
#: Texts are aligned in pieces of about this many characters, written in
#: blocks of about this many; a longer text is cut into several pieces at
#: segment borders, which are shared cuts.
PIECE_CHARS, BLOCK_CHARS = 1 << 20, 1 << 23
#: Segments remembered per process, and probes of one interval before the rest
#: of it is looked at in one go.
MEMO, PROBES = 300_000, 16
#: New segments are encoded together, about this many characters at a time.
JOINED_CHARS = 1 << 12


class Encoder:
    """Both tokenizers over segments of ``" " + text`` (one per process)."""

    def __init__(self, name_a: str, name_b: str):
        import base64

        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(public_tokenizers.path(f"{name_a}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.a = tiktoken.Encoding(name_a, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                   special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name_b))
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_a[i] = token
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") or p.startswith("▁▁") and p.strip("▁") for p in pieces):
            raise ValueError(f"{name_b}: a piece runs over the start of a word")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.space = pieces.index("▁")
        self.size_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.size_b = np.array([len(t) for t in self.bytes_b], np.int64)
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.chars = 0
        self.ids = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.count = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self.start = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self.good = np.zeros(0, bool)
        self.fresh: list[tuple] = []

    def lookup(self, segments: list[str]) -> np.ndarray:
        """Numbers of the segments in the memory."""
        if len(self.index) > MEMO or self.chars > 32 * MEMO:
            self.forget()
        new = list({s: None for s in segments if s not in self.index})
        # a segment that ends in white space is the last of its text; others may be joined for encoding
        tails = [s for s in new if s[-1] == " " or s[-1] in WHITE]
        if tails:
            new = [s for s in new if not (s[-1] == " " or s[-1] in WHITE)]
        batch, chars = [], 0
        for s in new:
            batch.append(s)
            chars += len(s)
            if chars >= JOINED_CHARS:
                self._learn(batch)
                batch, chars = [], 0
        for part in (batch, *([s] for s in tails)):
            self._learn(part)
        self._settle()
        return np.fromiter(map(self.index.__getitem__, segments), np.int64, len(segments))

    def _learn(self, segments: list[str]) -> None:
        """Encode segments as one text and divide the tokens among them."""
        if not segments:
            return
        text = "".join(segments)
        raw = text.encode()
        size = np.array([len(s) for s in segments] if len(raw) == len(text) else [len(s.encode()) for s in segments])
        # the model of B itself puts a space before a text
        sides = self.a.encode_ordinary(text), self.b.encode(text[1:]) if text != " " else [self.space]
        for ids, names in zip(sides, (self.bytes_a, self.bytes_b)):
            if b"".join(map(names.__getitem__, ids)) != raw:
                if len(segments) > 1:  # find the ones that do not come back
                    for s in segments:
                        self._learn([s])
                    return
                self._keep(segments, ([], []), [np.zeros(1, np.int64)] * 2, False)
                return
        arrays = [np.array(ids, np.int32) for ids in sides]
        ends = np.cumsum(size)
        counts = [np.diff(np.searchsorted(np.cumsum(n[i]), ends, "right"), prepend=0)
                  for i, n in zip(arrays, (self.size_a, self.size_b))]
        self._keep(segments, arrays, counts, True)

    def _keep(self, segments: list[str], ids, counts, good: bool) -> None:
        first = len(self.index)
        self.index.update(zip(segments, range(first, first + len(segments))))
        self.chars += sum(map(len, segments))
        self.fresh.append((*ids, *counts, np.full(len(segments), good)))

    def _settle(self) -> None:
        if self.fresh:
            a, b, na, nb, good = (np.concatenate(x) for x in zip(*self.fresh))
            self.fresh = []
            self.ids = [np.concatenate([x, y]).astype(np.int32) for x, y in zip(self.ids, (a, b))]
            self.count = [np.concatenate([x, y]) for x, y in zip(self.count, (na, nb))]
            self.good = np.concatenate([self.good, good])
            self.start = [np.cumsum(c) - c for c in self.count]

    def tokens(self, side: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the segments in a row, and how many each has."""
        n = self.count[side][codes]
        at = np.repeat(self.start[side][codes] - (np.cumsum(n) - n), n)
        return self.ids[side][at + np.arange(len(at))], n


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(name_a: str, name_b: str) -> Encoder:
    if (name_a, name_b) not in _ENCODERS:
        _ENCODERS[name_a, name_b] = Encoder(name_a, name_b)
    return _ENCODERS[name_a, name_b]


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, bounds_a: np.ndarray,
                bounds_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where groups end, as numbers of tokens of A and of B before the cut.

    ``ends_*`` are increasing byte ends; ``bounds_*`` (token numbers, the
    first 0) delimit intervals that are known to end together."""
    found = [(bounds_a[1:][np.diff(bounds_a) > 0], bounds_b[1:][np.diff(bounds_b) > 0])]
    a0, a1, b0, b1 = bounds_a[:-1], bounds_a[1:], bounds_b[:-1], bounds_b[1:]
    step = np.zeros(len(a0), np.int64)
    while True:
        # an interval with a single token on a side has no cut inside
        open_ = (a1 - a0 > 1) & (b1 - b0 > 1)
        a0, a1, b0, b1, step = a0[open_], a1[open_], b0[open_], b1[open_], step[open_]
        if not len(a0):
            break
        if (stubborn := step > PROBES).any():
            parts = [(a0[~stubborn], a1[~stubborn], b0[~stubborn], b1[~stubborn], step[~stubborn])]
            for i, k, j, m in zip(*(x[stubborn].tolist() for x in (a0, a1, b0, b1))):
                at = _nearest_cut(ends_a[i:k], ends_b[j:m])
                if at is not None:
                    u, v = i + at[0] + 1, j + at[1] + 1
                    found.append((np.array([u]), np.array([v])))
                    parts.append((np.array([i, u]), np.array([u, k]), np.array([j, v]), np.array([v, m]),
                                  np.zeros(2, np.int64)))
            a0, a1, b0, b1, step = (np.concatenate(x) for x in zip(*parts))
            continue
        middle = (a0 + a1 - 2) >> 1
        away = (step + 1) >> 1
        at = np.where(step & 1, middle + away, middle - away)
        inside = (at >= a0) & (at <= a1 - 2)
        at = np.where(inside, at, middle)
        end = ends_a[at]
        to = np.searchsorted(ends_b, end)
        hit = inside & (ends_b[to] == end)
        u, v = at[hit] + 1, to[hit] + 1
        found.append((u, v))
        on = ~hit & (away <= np.maximum(middle - a0, a1 - 2 - middle))
        a0, a1, b0, b1, step = (
            np.concatenate([a0[hit], u, a0[on]]), np.concatenate([u, a1[hit], a1[on]]),
            np.concatenate([b0[hit], v, b0[on]]), np.concatenate([v, b1[hit], b1[on]]),
            np.concatenate([np.zeros(2 * len(u), np.int64), step[on] + 1]))
    return tuple(np.sort(np.concatenate(x)) for x in zip(*found))


def _nearest_cut(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[int, int] | None:
    """The shared end inside an interval that is nearest to its middle."""
    to = np.searchsorted(ends_b, ends_a[:-1])
    hits = np.flatnonzero(ends_b[to] == ends_a[:-1])
    if not len(hits):
        return None
    i = int(hits[np.abs(hits - (len(ends_a) - 2) // 2).argmin()])
    return i, int(to[i])


class Piece:
    """The aligned tokens of some documents, or of a part of one."""

    def __init__(self, enc: Encoder, parts: list[list[str]]):
        codes = enc.lookup(list(chain.from_iterable(parts)))
        bounds = np.r_[0, np.cumsum([len(p) for p in parts])]
        owner = np.repeat(np.arange(len(parts)), np.diff(bounds))
        bad = ~enc.good[codes]
        self.good = np.bincount(owner[bad], minlength=len(parts)) == 0
        if bad.any():  # such a document has no tokens
            keep = self.good[owner]
            codes, owner = codes[keep], owner[keep]
        last = np.searchsorted(owner, np.arange(len(parts) + 1))
        self.ids, self.bounds = [], []
        ends = []
        for side, size in ((0, enc.size_a), (1, enc.size_b)):
            ids, n = enc.tokens(side, codes)
            self.ids.append(ids)
            self.bounds.append(np.r_[0, np.cumsum(n)][last])
            ends.append(np.cumsum(size[ids]))
        self.cuts = shared_cuts(*ends, *self.bounds)
        self.groups = np.searchsorted(self.cuts[0], self.bounds[0][1:], "right") - np.searchsorted(
            self.cuts[0], self.bounds[0][:-1], "right")
        # every stretch that a token of A ends, then those that only one of B ends
        to = np.searchsorted(ends[1], ends[0])
        alone = np.ones(len(ends[1]), bool)
        alone[self.cuts[1] - 1] = False
        alone = np.flatnonzero(alone)
        back = np.searchsorted(ends[0], ends[1][alone])
        self.link_a = np.concatenate([np.arange(len(ends[0])), back])
        self.link_b = np.concatenate([to, alone])

    def text(self, enc: Encoder, strings: np.ndarray) -> list[bytes]:
        """Per document its groups as ``a1,a2|b1;`` each."""
        (ids_a, ids_b), (cut_a, cut_b) = self.ids, self.cuts
        last_a, last_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        last_a[cut_a - 1] = 1
        last_b[cut_b - 1] = 1
        out = np.empty(len(ids_a) + len(ids_b), np.int64)
        before_b = np.r_[0, cut_b][np.cumsum(last_a) - last_a]  # tokens of B in earlier groups
        out[np.arange(len(ids_a)) + before_b] = ids_a * 2 + last_a
        upto_a = np.r_[cut_a, 0][np.cumsum(last_b) - last_b]
        out[np.arange(len(ids_b)) + upto_a] = (ids_b + len(enc.bytes_a)) * 2 + last_b
        at = (self.bounds[0] + self.bounds[1]).tolist()
        # strings of one width, filled with zero bytes
        return [strings[out[i:j]].tobytes().translate(None, b"\0") for i, j in zip(at, at[1:])]


def _strings(enc: Encoder) -> np.ndarray:
    """``id,`` / ``id|`` for A and ``id,`` / ``id;`` for B, by 2 x id + last."""
    return np.array([b"%d%s" % (i, end) for n, ends in ((len(enc.bytes_a), (b",", b"|")),
                                                        (len(enc.bytes_b), (b",", b";")))
                     for i in range(n) for end in ends])


def _parts(text: str | None) -> Iterator[list[str]]:
    """Segments of ``" " + text``, a bounded number of characters at a time."""
    if not text:
        return
    text = " " + text
    if len(text) <= PIECE_CHARS:
        yield SEGMENT.findall(text)
        return
    found = (m.group() for m in SEGMENT.finditer(text))
    while part := list(islice(found, PIECE_CHARS // 8)):
        yield part


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[list[str]]]]:
    """(document ids, segments) of about PIECE_CHARS characters; a long text
    comes as several entries of the same document.  Document ids are
    ``(number, value)``, numbers running from 0 in the task."""
    who, parts, chars, number = [], [], 0, 0
    for batch in batches:
        for d, t in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = t.as_py()
            for part in chain(_parts(text), () if text else ([],)):
                who.append((number, d))
                parts.append(part)
                chars += min(len(text or ""), PIECE_CHARS) + 64
                if chars >= PIECE_CHARS:
                    yield who, parts
                    who, parts, chars = [], [], 0
            number += 1
    if who:
        yield who, parts


def align_documents(docs: DataFrame, name_a: str = TOKENIZER_A, name_b: str = TOKENIZER_B) -> DataFrame:
    """``docs(doc_id, text)`` -> per document ``doc_id, part int, a_ids, b_ids,
    a_cuts, b_cuts`` (arrays of int): group g holds A's tokens from
    ``a_cuts[g - 1]`` up to ``a_cuts[g]`` and B's likewise.

    A text above PIECE_CHARS comes as several parts, which join at a cut.
    Null or empty texts, and texts that a tokenizer does not give back byte
    for byte, have empty arrays.  Repeated rows are aligned each."""
    ship_package(docs.sparkSession)
    kind, id_type = docs.schema["doc_id"].dataType.simpleString(), _id_type(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(name_a, name_b)
        seen = (-1, 0)
        for who, parts in _pieces(batches):
            p = Piece(enc, parts)
            cut_at = np.searchsorted(p.cuts[0], p.bounds[0], "right")
            rows: list[tuple] = []
            for i, (number, d) in enumerate(who):
                seen = (number, seen[1] + 1 if number == seen[0] else 0)
                rows.append((d, seen[1], *(p.ids[s][p.bounds[s][i]:p.bounds[s][i + 1]] for s in (0, 1)),
                             *(p.cuts[s][cut_at[i]:cut_at[i + 1]] - p.bounds[s][i] for s in (0, 1))))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], id_type), pa.array(cols[1], pa.int32()),
                 *(pa.array(c, pa.list_(pa.int32())) for c in cols[2:])],
                names=["doc_id", "part", "a_ids", "b_ids", "a_cuts", "b_cuts"])

    docs = docs.select("doc_id", F.col("text").cast("string"))
    return docs.mapInArrow(run, f"doc_id {kind}, part int, a_ids array<int>, b_ids array<int>, "
                                "a_cuts array<int>, b_cuts array<int>")


def _id_type(docs: DataFrame) -> pa.DataType:
    return to_arrow_type(docs.schema["doc_id"].dataType)


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers, compressed by byte planes."""
    planes = np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _unpack(data: bytes) -> np.ndarray:
    planes = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


BLOCK = ("block long, doc_id array<{kind}>, n_a array<long>, n_b array<long>, n_groups array<long>, "
         "n_links array<long>, groups_sha256 array<string>, entries binary, slots binary, times binary, "
         "a_ids binary, b_ids binary, holders binary")


def link_blocks(docs: DataFrame, name_a: str = TOKENIZER_A, name_b: str = TOKENIZER_B) -> DataFrame:
    """Blocks of aligned documents, one row each (see BLOCK).  ``slots``
    number the block's distinct (A id, B id) pairs ``a_ids, b_ids``;
    ``holders`` says how many of its documents hold each.  A document's links
    are ``entries`` of (slot, times)."""
    ship_package(docs.sparkSession)
    kind, id_type = docs.schema["doc_id"].dataType.simpleString(), _id_type(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(name_a, name_b)
        strings = _strings(enc)
        width = np.int64(len(enc.bytes_b))
        span = np.int64(len(enc.bytes_a)) * width
        block = TaskContext.get().partitionId() << 32
        rows: list[list] = []  # doc_id, counts (A, B, groups, links), hash, whether both sides gave the text back
        links: list[tuple[np.ndarray, np.ndarray]] = []
        first = chars = 0

        def flush() -> pa.RecordBatch:
            ok = np.array([r[3] for r in rows], bool)
            key = np.concatenate([k for k, _ in links]) if links else np.zeros(0, np.int64)
            times = np.concatenate([n for _, n in links]) if links else np.zeros(0, np.int64)
            keep = ok[key // span]
            key, back = np.unique(key[keep], return_inverse=True)  # parts of a long text may share pairs
            times = np.bincount(back, times[keep], len(key)).astype(np.int64)
            pairs = np.unique(key % span)
            slot = np.searchsorted(pairs, key % span)
            entries = np.bincount(key // span, minlength=len(rows))
            start = np.cumsum(entries) - entries
            delta = np.diff(slot, prepend=0)  # slots rise within a document
            delta[start[entries > 0]] = slot[start[entries > 0]]
            counts = [[r[1][i] if r[3] else 0 for r in rows] for i in range(4)]
            digest = [r[2].hexdigest() if r[3] and r[1][0] else "" for r in rows]
            data = [_pack(x) for x in (entries, delta, times, pairs // width, pairs % width,
                                       np.bincount(slot, minlength=len(pairs)))]
            ids = pa.array([r[0] for r in rows], id_type)
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), ids),
                 *(pa.array([c], pa.list_(pa.int64())) for c in counts), pa.array([digest], pa.list_(pa.string())),
                 *(pa.array([d], pa.binary()) for d in data)],
                names=[c.split()[0] for c in BLOCK.split(", ")])

        for who, parts in _pieces(batches):
            p = Piece(enc, parts)
            texts = p.text(enc, strings)
            per = [np.diff(p.bounds[0]), np.diff(p.bounds[1]), p.groups]
            # whole documents only in a block: it ends before a new one
            if chars >= BLOCK_CHARS and who[0][0] - first == len(rows):
                yield flush()
                first, chars, rows, links, block = who[0][0], 0, [], [], block + 1
            owner = np.array([number - first for number, _ in who])
            doc_a = np.repeat(owner, per[0])
            pair = p.ids[0][p.link_a].astype(np.int64) * width + p.ids[1][p.link_b]
            links.append(np.unique(doc_a[p.link_a] * span + pair, return_counts=True))
            for i, (number, d) in enumerate(who):
                if number - first == len(rows):
                    rows.append([d, [0, 0, 0, 0], hashlib.sha256(), True, False])
                r = rows[number - first]
                na, nb, ng = (int(x[i]) for x in per)
                r[1] = [x + y for x, y in zip(r[1], (na, nb, ng, na + nb - ng))]
                r[3] = r[3] and bool(p.good[i])
                if na:
                    if r[4]:
                        r[2].update(b";")
                    r[2].update(texts[i][:-1])
                    r[4] = True
            chars += sum(len(x) for x in texts) // 2
        if rows:
            yield flush()

    # the parts of the text travel once; nothing else of the table is read
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, BLOCK.format(kind=kind))


def block_pairs(blocks: DataFrame) -> DataFrame:
    """``a_id, b_id, block, slot, holders``: the distinct pairs per block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, *data in zip(*(c.to_pylist() for c in batch.columns)):
                a, b, n = (_unpack(d) for d in data)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(np.full(len(a), block), pa.int64()),
                     pa.array(np.arange(len(a)), pa.int32()), pa.array(n, pa.int64())],
                    names=["a_id", "b_id", "block", "slot", "holders"])

    return blocks.select("block", "a_ids", "b_ids", "holders").mapInArrow(
        run, "a_id int, b_id int, block long, slot int, holders long")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``a_id, b_id, n, best``: documents that hold the pair linked, and
    whether no other pair of the A id has more.  The table is a map from A's
    vocabulary to B's and is bounded by the two."""
    counts = pairs.groupBy("a_id", "b_id").agg(F.sum("holders").alias("n"))
    return counts.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("a_id")))


def link_statistics(blocks: DataFrame) -> DataFrame:
    """Blocks -> per document ``doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256``."""
    pairs = block_pairs(blocks)
    back = pairs.join(pair_counts(pairs), ["a_id", "b_id"]).groupBy("block").agg(
        F.collect_list(F.struct("slot", "n", "best")).alias("sums"))  # at most the block's own pairs
    kind = blocks.schema["doc_id"].dataType.elementType.simpleString()
    given = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                entries, delta, times = (_unpack(row[c].as_py()) for c in ("entries", "slots", "times"))
                owner = np.repeat(np.arange(len(entries)), entries)
                start = np.cumsum(entries) - entries
                run_ = np.cumsum(delta)
                before = np.where(start > 0, np.r_[0, run_][start], 0)
                slot = run_ - before[owner]
                n, best = np.zeros(0, np.int64), np.zeros(0, bool)
                if row["sums"].is_valid and len(sums := row["sums"].values):
                    at = sums.field("slot").to_numpy()
                    n, best = np.zeros(len(at), np.int64), np.zeros(len(at), bool)
                    n[at] = sums.field("n").to_numpy()
                    best[at] = sums.field("best").to_numpy(zero_copy_only=False)
                totals = []
                for value in (times * best[slot], times * n[slot]):
                    c = np.r_[0, np.cumsum(value)]
                    totals.append(pa.array(c[start + entries] - c[start], pa.int64()))
                yield pa.RecordBatch.from_arrays([*(row[c].values for c in given), *totals],
                                                 names=[*given, "n_best", "count_sum"])

    joined = blocks.drop("a_ids", "b_ids", "holders").join(back, "block", "left")
    return joined.mapInArrow(run, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, "
                                  "groups_sha256 string, n_best long, count_sum long")


def alignment_query(docs: DataFrame) -> DataFrame:
    """The digest of every document's alignment.  Null or empty texts and
    texts that do not come back byte for byte: zeros and an empty digest, and
    they count for no pair.  Repeated rows count as documents of their own;
    a null id is an id; an empty table gives no rows; columns other than
    doc_id and text are not read."""
    return link_statistics(materialise(link_blocks(docs), "alignment-blocks")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
