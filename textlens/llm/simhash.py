"""SimHash near-duplicates by bit-sliced comparison.

1. Fingerprints: bit b is 1 if more than half of the shingles' hashes have it.
   Equal fingerprints are one row from then on, so groups of exact copies
   cost one row however large they are.
2. Candidates: two fingerprints within the radius agree in at least two of
   five bit blocks, so each fingerprint is dealt to the ten pairs of blocks
   and only meets those that are equal there.  Buckets above CHUNK members
   are split into chunks, and every pair of chunks is a unit of its own.
3. Units are compared bit-sliced: 64 fingerprints to a block, bit plane by bit
   plane, a carry-save counter of two bits and an overflow bit per lane; a
   block leaves once all its lanes are above the radius.  A unit returns a
   spanning forest of its links, not all pairs.
4. Components of the links, and the smallest doc_id of each.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlens.llm.common import connected_components, materialise
from textlens.session import ship_package

SHINGLE = 3
RADIUS = 3
SEED = 42
#: Bit blocks (first bit, width) of which two must agree within RADIUS 3.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
CHUNK = 4096
#: (query, block) comparisons held in memory at a time.
TASKS = 1 << 15
_ONE = np.uint64(1)
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a whole text; no words (or null): 0."""
    return _fingerprint(b"" if text is None else text.encode("utf-8", "surrogatepass"), shingle)


def _fingerprint(raw: bytes, shingle: int) -> int:
    found = raw.lower().split()  # bytes: A-Z and ASCII blanks only
    if not found:
        return 0
    if len(found) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(found), SEED)
    parts = map(b" ".join, zip(*(found[i:] for i in range(shingle))))
    n = len(found) - shingle + 1
    h = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), dtype="<u8", count=n)
    lanes = h.view(np.uint8).reshape(n, 8)
    if n < 64:
        ones = ((lanes[:, :, None] >> np.arange(8, dtype=np.uint8)) & 1).sum(axis=0, dtype=np.int64).ravel()
    else:
        ones = np.concatenate([np.bincount(lanes[:, i], minlength=256) @ _BITS for i in range(8)])
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, fp`` (the 64 bits as a long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(1).cast(pa.binary())
            fps = np.fromiter((_fingerprint(x.as_buffer().to_pybytes() if x.is_valid else b"", shingle) for x in raw),
                              dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {kind}, fp long")


def link_groups(fps: np.ndarray, group: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links within groups.

    ``group`` is sorted; rows of one group are compared with each other.
    Returns index pairs (row, row of its component's smallest index)."""
    n = len(fps)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.zeros(0, int)
    count = np.diff(np.r_[first, n])
    lane = np.arange(n) - np.repeat(first, count)
    blocks = (count + 63) // 64
    block0 = np.cumsum(blocks) - blocks
    row_block = np.repeat(block0, count) + lane // 64
    bit = (lane % 64).astype(np.uint64)
    starts = np.flatnonzero(np.r_[True, row_block[1:] != row_block[:-1]]) if n else np.zeros(0, int)
    planes = np.empty((64, len(starts)), dtype=np.uint64)  # vertical: one word holds a bit of 64 rows
    for p in range(64):
        planes[p] = np.add.reduceat(((fps >> np.uint64(p)) & _ONE) << bit, starts)
    empty = ~np.add.reduceat(_ONE << bit, starts)  # lanes without a row count as too far
    label = np.arange(n)
    # row i meets the blocks of its group from its own on
    last = np.repeat(block0 + blocks, count)
    todo = last - row_block
    ends = np.cumsum(todo)
    at = 0
    while at < n:
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TASKS, side="right")))
        k = todo[at:stop]
        q = np.repeat(np.arange(at, stop), k)
        b = row_block[q] + np.arange(len(q)) - np.repeat(np.cumsum(k) - k, k)
        at = stop
        low = np.zeros(len(q), np.uint64)
        high, over = low.copy(), empty[b]
        flip = fps[q]
        for p in range(64):
            x = planes[p][b] ^ (np.uint64(0) - ((flip >> np.uint64(p)) & _ONE))
            carry = low & x
            low ^= x
            over |= high & carry
            high ^= carry
            if p % 8 == 7:
                live = over != _ALL
                if not live.all():
                    q, b, flip, low, high, over = q[live], b[live], flip[live], low[live], high[live], over[live]
                if not len(q):
                    break
        if radius < 3:  # the counter's two bits hold 0..3
            for want in range(radius + 1, 4):
                lo = low if want & 1 else ~low
                over |= lo & (high if want & 2 else ~high)
        near = ~over
        hit = near != 0
        q, b, near = q[hit], b[hit], near[hit]
        if not len(q):
            continue
        flags = np.unpackbits(near.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        t, j = np.nonzero(flags)
        _unite(label, q[t], starts[b[t]] + j)
    away = np.flatnonzero(label != np.arange(n))
    return away, label[away]


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the components of a[i] and b[i]; label[x] <= x always."""
    while True:
        la, lb = label[a], label[b]
        diff = la != lb
        if not diff.any():
            return
        a, b, la, lb = a[diff], b[diff], la[diff], lb[diff]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``distinct(fp)`` -> ``src, dst``: links that join the same components
    as all pairs at most ``radius`` (0 to 3) bits apart."""
    if not 0 <= radius <= 3:
        raise ValueError("radius must be 0 to 3: the blocks guarantee no more")
    keys = []
    for i in range(len(BLOCKS)):
        for j in range(i):
            (s, w), (t, v) = BLOCKS[j], BLOCKS[i]
            part = (F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << w) - 1)) * F.lit(1 << v)
                    + F.shiftrightunsigned("fp", t).bitwiseAND(F.lit((1 << v) - 1)))
            keys.append(F.lit(len(keys) << 27) + part)
    dealt = distinct.select("fp", F.explode(F.array(*keys)).alias("key"))
    shared = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = shared.withColumn("chunks", F.ceil(F.col("n") / CHUNK).cast("int"))
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("chunks")).cast("int")
    units = (
        dealt.join(shared, "key").withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("key", (F.least("own", "other") * F.col("chunks") + F.greatest("own", "other")).alias("unit"), "fp"))
    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = units.repartition(n, "key", "unit").sortWithinPartitions("key", "unit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compare(key, unit, fp):
            group = np.cumsum(np.r_[False, (key[1:] != key[:-1]) | (unit[1:] != unit[:-1])])
            a, b = link_groups(fp.view(np.uint64), group, radius)
            return pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], names=["src", "dst"])

        held: list[np.ndarray] = []
        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            held = [np.concatenate(x) for x in zip(held, new)] if held else new
            key, unit, fp = held
            if len(key) < 20_000:
                continue
            # the last unit may go on in the next batch
            cut = int(np.flatnonzero((key != key[-1]) | (unit != unit[-1])).max(initial=-1)) + 1
            if cut:
                yield compare(key[:cut], unit[:cut], fp[:cut])
                held = [x[cut:] for x in held]
        if held and len(held[0]):
            yield compare(*held)

    return units.mapInArrow(run, "src long, dst long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, fp, component_id``, one row per
    document.

    Null or blank texts have fingerprint 0, which links like any other.  A
    null doc_id gets its group's smallest id like every member (null if the
    group has no id).  Repeated rows stay repeated.  An empty table gives no
    rows."""
    fps = materialise(fingerprints(docs, shingle), "simhash-fp")
    distinct = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    parts = connected_components(links(distinct, radius), "simhash-cc").select(
        F.col("node").alias("fp"), "root")
    rooted = materialise(distinct.join(parts, "fp", "left").withColumn("root", F.coalesce("root", "fp")),
                         "simhash-rooted")
    least = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return fps.join(rooted.join(least, "root").select("fp", "component_id"), "fp").select(
        "doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The documents of which one of each group stays: the one with the
    smallest doc_id, once if its row is repeated.  Rows without a doc_id can
    represent no group and stay."""
    found = near_duplicates(docs, shingle, radius)
    keep = materialise(found.where("doc_id = component_id").select(F.col("doc_id").alias("__keep")).distinct(),
                       "simhash-keep")
    named = docs.join(keep, F.col("doc_id") == F.col("__keep"), "left_semi")
    return named.dropDuplicates(["doc_id"]).unionByName(docs.where(F.col("doc_id").isNull()))


def simhash_query(docs: DataFrame) -> DataFrame:
    """Fingerprints and components of ``near_duplicates``, one row per row of
    ``docs``; see there for null texts and ids, repeated rows and empty tables."""
    return near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
