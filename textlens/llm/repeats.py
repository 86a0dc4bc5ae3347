"""Long repeated byte strings, by run-length indexes over candidate regions.

A byte goes if a string of WIDTH bytes that covers it starts anywhere else.

1. Anchors.  Each window of WIDTH bytes is represented by its least k-gram
   hash; consecutive windows with the same k-gram form a run.  Equal windows
   have equal k-grams, so a window whose k-gram is unique in the corpus is
   unique, and only (hash, place, hash of the run's bytes) are shuffled: about
   one row per 85 bytes.
2. Runs whose k-gram repeats.  All windows of equal runs repeat.  Where a
   k-gram has different runs, the bytes of one of each are gathered.
3. Shards of whole k-gram groups.  A shard's distinct runs are concatenated,
   their suffixes sorted, the Burrows-Wheeler transform run-length coded and
   suffixes sampled at both ends of its runs.  Streaming the text past the
   samples gives, at each position, the longest match with any other position
   (between two samples it shrinks by one per byte); positions that match
   WIDTH bytes are marked.
4. K-grams with more than HOT different runs, which no task should hold, go another way
   to the same result.  Windows that occur twice among SCOUTS of the k-gram's
   runs repeat; every run finds those of its own windows in that short list.
   Only the windows left over are counted, by hash, with no group in one place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textlens.llm.common import materialise
from textlens.session import ship_package

WIDTH = 200
GRAM = 32
HOT = 2000
SCOUTS = 100
SHARD_BYTES = 1 << 20
#: Bytes hashed at a time; longer documents are taken in overlapping tiles.
TILE = 1 << 20
_MASK = np.uint64(TILE - 1)
_POWERS: dict[str, np.ndarray] = {}
_STEP = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers() -> dict[str, np.ndarray]:
    if not _POWERS:
        odd = 0xD6E8FEB86659FD93
        back = pow(odd, -1, 1 << 64)
        for name, f in (("up", odd), ("down", back)):
            p = np.full(TILE + 1, f, dtype=np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
        _POWERS["byte"] = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_STEP))
    return _POWERS


class _Hashes:
    """Hashes of any range of a tile from one running sum."""

    def __init__(self, buf: np.ndarray):
        p = _powers()
        self.down = p["down"]
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(p["byte"][buf] * p["up"][:len(buf)], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mix((self.sums[stop] - self.sums[start]) * self.down[start])


def window_runs(buf: np.ndarray, first: np.ndarray, last: np.ndarray, width: int = WIDTH, gram: int = GRAM):
    """Runs of windows in a tile whose documents have windows starting at
    ``first[i]..last[i]``: arrays anchor, start and end of the starts (both
    included), the anchors' hashes and the hashes of the runs' bytes."""
    none = np.zeros(0, np.int64)
    first, last = first[last >= first], last[last >= first]
    if not len(first):
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    hashes = _Hashes(buf)
    n = len(buf) - gram + 1
    kh = _mix((hashes.sums[gram:] - hashes.sums[:n]) * hashes.down[:n])
    low = (kh & ~_MASK) | np.arange(n, dtype=np.uint64)  # ties: the leftmost
    span, have = width - gram + 1, 1
    while 2 * have <= span:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if span > have:
        low = np.minimum(low[:have - span], low[span - have:])
    size = last - first + 1
    at = np.arange(size.sum()) + np.repeat(first - np.r_[0, np.cumsum(size)[:-1]], size)
    anchor = (low[at] & _MASK).astype(np.int64)
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)]
    heads = np.flatnonzero(new)
    tails = np.r_[heads[1:], len(at)] - 1
    p, a, b = anchor[heads], at[heads], at[tails]
    shape = _mix(((p - a) * 4096 + (b - a)).astype(np.uint64))
    return p, a, b, kh[p], hashes.of(a, b + width) ^ shape


def _tiles(sizes: np.ndarray, width: int) -> Iterator[list[tuple[int, int, int]]]:
    """Tiles as lists of (document, from, to); a cut document overlaps by
    width - 1 bytes, so each window is in exactly one tile."""
    tile, room = [], TILE
    for d, n in enumerate(sizes.tolist()):
        at = 0
        while n - at >= width:
            if room < min(n - at, width * 4) or room < width:
                yield tile
                tile, room = [], TILE
            k = min(n - at, room)
            tile.append((d, at, at + k))
            room -= k
            at += k - width + 1
    if tile:
        yield tile


def anchors(keyed: DataFrame) -> DataFrame:
    """``keyed(k, n, text)`` -> ``h, k, n, p, a, b, run`` for every run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                raws = [x.as_buffer() if x.is_valid else b"" for x in part.column(2).cast(pa.binary())]
                keys = part.column(0).to_numpy()
                size = np.array([len(r) for r in raws], dtype=np.int64)
                for tile in _tiles(size, WIDTH):
                    buf = np.concatenate([np.frombuffer(raws[d], np.uint8)[s:e] for d, s, e in tile])
                    doc, s, e = (np.array(x, dtype=np.int64) for x in zip(*tile))
                    base = np.r_[0, np.cumsum(e - s)[:-1]]
                    p, a, b, h, whole = window_runs(buf, base, base + (e - s) - WIDTH)
                    which = np.searchsorted(base, a, side="right") - 1
                    shift = s[which] - base[which]
                    d = doc[which]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h.view(np.int64)), pa.array(keys[d]), pa.array(size[d].astype(np.int32)),
                         *(pa.array((x + shift).astype(np.int32)) for x in (p, a, b)), pa.array(whole.view(np.int64))],
                        names=["h", "k", "n", "p", "a", "b", "run"])

    return keyed.select("k", "n", "text").mapInArrow(run, "h long, k long, n int, p int, a int, b int, run long")


# --- the run-length index -------------------------------------------------

_SYMBOLS = 7  # of 9 bits each, packed into one word


def _suffix_order(packed: np.ndarray) -> np.ndarray:
    """Suffix array by prefix tripling, from words of the first symbols."""
    n = len(packed)
    bits = int(n).bit_length()
    ways = 3 if 3 * bits <= 63 else 2  # ranks that fit into one word
    order = np.argsort(packed)
    key, have = packed, _SYMBOLS
    while True:
        rank = np.empty(n, np.int64)
        sorted_ = key[order]
        rank[order] = np.cumsum(np.r_[False, sorted_[1:] != sorted_[:-1]])
        if rank[order[-1]] == n - 1:
            return order
        key = rank
        for way in range(1, ways):
            key = key << bits
            key[:max(n - way * have, 0)] += rank[way * have:] + 1
        order = np.argsort(key)
        have *= ways


def _common_prefix(packed: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at i and at j."""
    n = len(packed)
    out = np.zeros(len(i), np.int64)
    live = np.arange(len(i))
    i, j = i.copy(), j.copy()
    while len(live):
        x = packed[i] ^ packed[j]
        same = x == 0
        part = np.zeros(len(live), np.int64)
        for t in range(1, _SYMBOLS):
            part += (x >> (9 * (_SYMBOLS - t))) == 0
        out[live] += np.where(same, _SYMBOLS, part)
        live, i, j = live[same], i[same] + _SYMBOLS, j[same] + _SYMBOLS
        ends = np.maximum(i, j) >= n
        live, i, j = live[~ends], i[~ends], j[~ends]
    return out


def matching_lengths(texts: list[bytes]) -> np.ndarray:
    """For each position of the concatenation of different ``texts`` (each
    followed by a separator): the longest match with any other position.

    Only the boundaries of the transform's runs are compared; elsewhere the
    neighbours of a suffix are those of the suffix before it, one shorter."""
    sym = np.concatenate([np.r_[np.frombuffer(t, np.uint8).astype(np.int64) + 1, 0] for t in texts])
    n = len(sym)
    wide = np.r_[sym, np.zeros(_SYMBOLS, np.int64)]
    packed = np.zeros(n, np.int64)
    for t in range(_SYMBOLS):
        packed = (packed << 9) | wide[t:t + n]
    sa = _suffix_order(packed)
    bwt = sym[sa - 1]
    first = (sa == 0)
    edge = np.flatnonzero((bwt[1:] != bwt[:-1]) | first[1:] | first[:-1]) + 1
    # sampled run ends: the suffix below and the one above each boundary
    below, above = sa[edge], sa[edge - 1]
    common = _common_prefix(packed, below, above)
    longest = np.zeros(n, np.int64)
    for at, top in ((below, sa[0]), (above, sa[-1])):
        reach = np.full(n, -1, np.int64)
        reach[top] = top
        reach[at] = np.maximum(reach[at], at + common)
        np.maximum(longest, np.maximum.accumulate(reach) - np.arange(n), out=longest)
    return longest


def mark_repeats(runs: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """For each run of bytes: the starts of its windows that occur in another
    run, too (or in an equal one)."""
    groups: dict[bytes, list[int]] = {}
    for i, r in enumerate(runs):
        groups.setdefault(r, []).append(i)
    distinct = list(groups)
    longest = matching_lengths(distinct)
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(runs)
    at = 0
    for r in distinct:
        k = len(r) - width + 1
        starts = np.arange(k) if len(groups[r]) > 1 else np.flatnonzero(longest[at:at + k] >= width)
        at += len(r) + 1
        for i in groups[r]:
            out[i] = starts
    return out


def _merge(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open ranges; ranges that touch become one."""
    if not len(start):
        return start, stop
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    new = np.r_[True, start[1:] > stop[:-1]]
    last = np.r_[new[1:], True]
    return start[new], stop[last]


def _shards(snippets: DataFrame) -> DataFrame:
    """``h, k, n, a, bytes`` -> ``k, n, start, stop``: repeated ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def index(rows):
            marked = mark_repeats([r[4] for r in rows])
            out = []
            for (_, k, n, a, _), s in zip(rows, marked):
                lo, hi = _merge(s + a, s + a + WIDTH)
                out += [(k, n, x, y) for x, y in zip(lo.tolist(), hi.tolist())]
            cols = list(zip(*out)) or [[], [], [], []]
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), *(pa.array(c, pa.int32()) for c in cols[1:])],
                names=["k", "n", "start", "stop"])

        rows, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if size >= SHARD_BYTES and row[0] != rows[-1][0]:
                    yield index(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[4])
        if rows:
            yield index(rows)

    parts = int(snippets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = snippets.repartition(parts, "h").sortWithinPartitions("h")
    return dealt.select("h", "k", "n", "a", "bytes").mapInArrow(run, "k long, n int, start int, stop int")


def _windows(run: bytes) -> np.ndarray:
    """Hashes of the windows of a run."""
    start = np.arange(len(run) - WIDTH + 1)
    return _Hashes(np.frombuffer(run, np.uint8)).of(start, start + WIDTH).view(np.int64)


def _hot(runs: DataFrame) -> DataFrame:
    """``h, k, n, a, bytes`` of hot k-grams -> ``k, n, start, stop``."""
    # the same scouts whoever asks: the first by hash of their place
    draw = F.xxhash64("k", "n", "a", F.lit(1))
    scouts = runs.select("h", "bytes", F.row_number().over(
        Window.partitionBy("h").orderBy(draw, "k", "n", "a")).alias("r")).where(F.col("r") <= SCOUTS)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_windows(x.as_py()) for x in batch.column(1)]
            h = np.repeat(batch.column(0).to_numpy(), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(h), pa.array(np.concatenate(found) if found else np.zeros(0, np.int64))],
                names=["h", "window"])

    # at most SCOUTS * WIDTH / 2 windows per k-gram
    common = (scouts.select("h", "bytes").mapInArrow(hashed, "h long, window long").groupBy("h", "window")
              .agg(F.count(F.lit(1)).alias("times")).where("times > 1")
              .groupBy("h").agg(F.collect_list("window").alias("common")).withColumnRenamed("h", "h2"))
    met = runs.join(common, F.col("h") == F.col("h2"), "left").select("h", "k", "n", "a", "bytes", "common")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for i in range(batch.num_rows):
                h, k, n, a, run = (batch.column(c)[i].as_py() for c in range(5))
                w = _windows(run)
                seen = np.zeros(len(w), bool)
                if batch.column(5)[i].is_valid:
                    seen = np.isin(w, batch.column(5)[i].values.to_numpy())
                s = np.flatnonzero(seen)
                lo, hi = _merge(s + a, s + a + WIDTH)
                out += [(h, None, k, n, x, y) for x, y in zip(lo.tolist(), hi.tolist())]
                rest = np.flatnonzero(~seen)
                out += [(h, x, k, n, y, y + WIDTH) for x, y in zip(w[rest].tolist(), (rest + a).tolist())]
            cols = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 3 + [pa.int32()] * 3)],
                names=["h", "window", "k", "n", "start", "stop"])

    parts = materialise(met.mapInArrow(split, "h long, window long, k long, n int, start int, stop int"),
                        "repeats-hot", "zstd")
    left = parts.where("window IS NOT NULL")
    twice = left.groupBy("h", "window").agg(F.count(F.lit(1)).alias("times")).where("times > 1").drop("times")
    return parts.where("window IS NULL").unionByName(left.join(twice, ["h", "window"]).select(*parts.columns)).select(
        "k", "n", "start", "stop")


_PIECES = ("what string, doc_id {id}, k long, n int, spans binary, text binary, h long, a int, bytes binary, "
           "n_removed long, n_spans long, kept_sha256 string")


def _result(raw, start: np.ndarray, stop: np.ndarray) -> tuple[int, int, str]:
    """n_removed, n_spans, hash of what is left."""
    left = hashlib.sha256()
    at = 0
    view = memoryview(raw)
    for s, e in zip(start.tolist(), stop.tolist()):
        left.update(view[at:s])
        at = e
    left.update(view[at:])
    return int((stop - start).sum()), len(start), left.hexdigest()


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, n_bytes, n_removed, n_spans,
    kept_sha256 and ``spans`` (little-endian 32-bit pairs of byte start and
    end of each removed run), one row per document.

    Texts are their UTF-8 bytes; null is empty.  Texts below WIDTH bytes keep
    all.  Repeated rows are documents of their own and so repeat each other.
    An empty table gives no rows."""
    ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.xxhash64("doc_id", text).alias("k"), F.octet_length(text).alias("n"), "doc_id",
                        text.alias("text"))
    runs = anchors(keyed.where(F.col("n") >= WIDTH))
    groups = (runs.groupBy("h").agg(F.count(F.lit(1)).alias("times"), (F.min("run") == F.max("run")).alias("same"))
              .where("times > 1").select(F.col("h").alias("g"), "same"))
    # written, so that the join reads plain exchanges and hot k-grams are split
    groups = materialise(groups, "repeats-groups")
    met = materialise(runs.join(groups, F.col("h") == F.col("g")).drop("g"), "repeats-runs")
    # of a k-gram with different runs, equal ones repeat each other; one of
    # them goes on to be compared with the others
    mixed = met.where(~F.col("same")).withColumn("place", F.xxhash64("k", "n", "a"))
    classes = mixed.groupBy("h", "run").agg(F.count(F.lit(1)).alias("copies"), F.min("place").alias("first"))
    sizes = classes.groupBy("h").agg((F.count(F.lit(1)) > HOT).alias("hot"))
    classes = classes.join(sizes, "h").select(F.col("h").alias("h2"), F.col("run").alias("run2"), "copies", "first", "hot")
    mixed = mixed.join(classes, (F.col("h") == F.col("h2")) & (F.col("run") == F.col("run2"))).select(
        "k", "n", "a", "b", "h", (F.col("copies") > 1).alias("same"), (F.col("place") == F.col("first")).alias("send"),
        "hot")
    every = mixed.unionByName(met.where("same").select(
        "k", "n", "a", "b", "h", "same", F.lit(False).alias("send"), F.lit(False).alias("hot")))
    found = every.groupBy("k", "n").agg(
        F.collect_set(F.struct("a", "b", "h", "same", "send", "hot")).alias("runs"), F.count(F.lit(1)).alias("rows"))
    # more rows than runs: the document's row itself is repeated, all of it goes
    found = found.select(F.col("k").alias("k2"), F.col("n").alias("n2"),
                         (F.col("rows") > F.size("runs")).alias("again"), "runs")
    joined = keyed.join(found, (F.col("k") == F.col("k2")) & (F.col("n") == F.col("n2")), "left").select(
        "doc_id", "k", "n", "text", F.coalesce("again", F.lit(False)).alias("again"),
        *(F.col("runs")[c].alias(c) for c in ("a", "b", "h", "same", "send", "hot")))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _PIECES.split(", ")]
        for batch in batches:
            rows: list[dict] = []
            texts = batch.column(3).cast(pa.binary())
            for i in range(batch.num_rows):
                raw = texts[i].as_buffer()
                doc, k, n = (batch.column(c)[i].as_py() for c in range(3))
                a, b, h, same, send, hot = (
                    np.zeros(0, np.int64) if not batch.column(c)[i].is_valid
                    else batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in range(5, 11))
                same, send = same.astype(bool), send.astype(bool)
                if send.any():
                    data = raw.to_pybytes()
                    for x, y, z, w in zip(*(v[send].tolist() for v in (a, b, h, hot))):
                        rows.append(dict(what="hot" if w else "run", k=k, n=n, h=z, a=x, bytes=data[x:y + WIDTH]))
                lo, hi = _merge(a[same].astype(np.int64), b[same].astype(np.int64) + WIDTH)
                whole = batch.column(4)[i].as_py()
                if whole:
                    lo, hi = np.array([0]), np.array([n])
                if whole or same.all():
                    rows.append(dict(zip(("n_removed", "n_spans", "kept_sha256"), _result(raw, lo, hi)),
                                     what="done", doc_id=doc, k=k, n=n, spans=_pairs(lo, hi)))
                else:
                    rows.append(dict(what="open", doc_id=doc, k=k, n=n, spans=_pairs(lo, hi), text=raw.to_pybytes()))
                if len(rows) >= 2000:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema(batch)).select(names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema(batch)).select(names)

    def schema(batch: pa.RecordBatch) -> pa.Schema:
        return _arrow_schema(batch.schema.field(0).type)

    pieces = materialise(joined.mapInArrow(split, _PIECES.format(id=kind)), "repeats-pieces", "zstd")

    marks = _shards(pieces.where("what = 'run'"))
    hot = _hot(pieces.where("what = 'hot'").select("h", "k", "n", "a", "bytes"))
    per_doc = marks.unionByName(hot).groupBy("k", "n").agg(F.collect_list(F.struct("start", "stop")).alias("marks"))
    open_ = pieces.where("what = 'open'").select("doc_id", "k", "n", "spans", "text").join(
        per_doc, ["k", "n"], "left").select("doc_id", "n", "spans", "text", F.col("marks.start").alias("start"),
                                            F.col("marks.stop").alias("stop"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                pairs = np.frombuffer(batch.column(2)[i].as_buffer(), "<i4").reshape(-1, 2).astype(np.int64)
                lo, hi = pairs[:, 0], pairs[:, 1]
                if batch.column(4)[i].is_valid:
                    lo = np.r_[lo, batch.column(4)[i].values.to_numpy()]
                    hi = np.r_[hi, batch.column(5)[i].values.to_numpy()]
                lo, hi = _merge(lo, hi)
                out.append((*_result(batch.column(3)[i].as_buffer(), lo, hi), _pairs(lo, hi)))
            removed, spans, kept, where = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(kept, pa.string()), pa.array(where, pa.binary())],
                names=["doc_id", "n", "n_removed", "n_spans", "kept_sha256", "spans"])

    last = open_.mapInArrow(
        finish, f"doc_id {kind}, n int, n_removed long, n_spans long, kept_sha256 string, spans binary")
    done = pieces.where("what = 'done'").select("doc_id", "n", "n_removed", "n_spans", "kept_sha256", "spans")
    return done.unionByName(last).select("doc_id", F.col("n").cast("long").alias("n_bytes"), "n_removed", "n_spans",
                                         "kept_sha256", "spans")


def _pairs(lo: np.ndarray, hi: np.ndarray) -> bytes:
    return np.stack([lo, hi], axis=1).astype("<i4").tobytes() if len(lo) else b""


def _arrow_schema(id_type: pa.DataType) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "{id}": id_type}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _PIECES.split(", ")])


def repeats_query(docs: DataFrame) -> DataFrame:
    """What ``repeated_spans`` removes, one row per row of ``docs``; see there
    for null texts, repeated rows and empty tables."""
    return repeated_spans(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
