"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.session import checkpoint_dir, configure

#: words are runs of anything but space and U+0009..U+000D
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a new folder under the cluster's shared
    checkpoint folder and read it back: the lineage is cut, and a lost
    executor costs a reread, not a recomputation."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/visitlens-llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_rows(spark: SparkSession, rows: int = 512) -> None:
    """Rows per Arrow batch sent to Python: texts are long, so batches are
    kept to about ``rows`` times the mean text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def row_slices(batches: Iterable[pa.RecordBatch], *columns: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, in batches whose texts or bytes in
    ``columns`` are about ``limit`` bytes at most, or one row."""
    for b in batches:
        size = sum(pc.fill_null(pc.binary_length(b.column(b.schema.get_field_index(c))), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                   for c in columns)
        ends = np.flatnonzero(np.diff(np.cumsum(size) // limit, append=-1)) + 1
        for start, end in zip([0, *ends[:-1]], ends):
            yield b.slice(start, end - start)


def texts_as_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column; null reads as empty."""
    got = batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()
    return [x or b"" for x in got]


def chunks(items: Iterable, size_of, limit: int) -> Iterator[list]:
    """Lists of consecutive items whose sizes add up to about ``limit``."""
    part, total = [], 0
    for x in items:
        part.append(x)
        total += size_of(x)
        if total >= limit:
            yield part
            part, total = [], 0
    if part:
        yield part


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over a uint64 (in place)."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def n_words(text: Column) -> Column:
    """Number of words of a text column (null: 0), by built-in functions."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
