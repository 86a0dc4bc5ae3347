"""Shared physical-plan helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlens.session import DEFAULT_BROADCAST_ROWS, MAX_BROADCAST_BYTES, checkpoint_dir


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row of ``df`` holds."""
    def of(field: T.StructField) -> Column:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(c), F.lit(0)) + 16
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
            return F.coalesce(F.size(c), F.lit(0)) * 8 + 16
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 16
        return F.lit(8)

    total = F.lit(16).cast("long")
    for field in df.schema.fields:
        total = total + of(field)
    return total


def fits(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes.

    Bounded work: Spark stops after ``max_rows + 1`` rows are found.
    """
    n, size = df.select(row_bytes(df).alias("b")).limit(max_rows + 1).agg(F.count("b"), F.sum("b")).first()
    return n <= max_rows and (size or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                       max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only after its rows and bytes are checked.

    Beyond the bound the DataFrame is returned as is, so the join is planned
    as a shuffle join (sort-merge / shuffle-hash) and AQE may still split
    skewed partitions or convert it at run time from real shuffle sizes.
    """
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a side whose size is bounded by construction (a parameter
    such as ``max_features`` or ``k <= 100``), so no check is needed."""
    return F.broadcast(df)


def write_table(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet below the cluster's checkpoint folder and read
    it back: later steps read a table that all executors share."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Remove the files of a table of ``write_table`` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def slices(df: DataFrame, max_bytes: int, key: str) -> list[DataFrame]:
    """``df`` dealt by a hash of ``key`` into parts of at most ``max_bytes``
    (or one of SLICE_BUCKETS buckets, if that alone is larger).  The driver
    sees the buckets' sizes only."""
    bucket = F.pmod(F.xxhash64(key), F.lit(SLICE_BUCKETS))
    sizes = df.groupBy(bucket.alias("b")).agg(F.sum(row_bytes(df)).alias("n")).collect()
    if sum(r["n"] for r in sizes) <= max_bytes:
        return [df] if sizes else []
    parts: list[list[int]] = []
    room = 0
    for r in sorted(sizes, key=lambda r: r["b"]):
        if r["n"] > room:
            parts.append([])
            room = max_bytes
        parts[-1].append(r["b"])
        room -= r["n"]
    held = write_table(df, "slices")
    return [held.where(bucket.isin(p)) for p in parts]


#: Buckets that a table is dealt into before it is cut into slices.
SLICE_BUCKETS = 4096


def spread(df: DataFrame) -> DataFrame:
    """Round-robin ``df`` over the cluster's cores when its scan produced
    fewer partitions than cores (few large files / row groups), so costly
    row-wise work is not done by one task.  On a real table with many
    splits this is a no-op and adds no shuffle.  Only inputs that are plain
    file scans are looked at; anything else is left as it is."""
    files = df.inputFiles()
    if not files:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(files) < cores else df
