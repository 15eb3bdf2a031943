"""Join helpers: size-guarded broadcast, membership filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast by hand only when its row count has a known bound and so
# many rows of its columns stay below this; everything else is left to AQE,
# which converts a join to a broadcast from measured shuffle sizes and keeps a
# sort-merge join beyond.
MAX_BROADCAST_BYTES = 8 << 20
#: taken for a value without a fixed width
WIDE_VALUE = 256
FIXED_WIDTH = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "date": 4, "float": 4,
               "long": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}


def row_bytes(df: DataFrame) -> int:
    return sum(8 + FIXED_WIDTH.get(f.dataType.typeName(), WIDE_VALUE) for f in df.schema.fields)


def broadcast_bounded(df: DataFrame, max_rows: int | None) -> DataFrame:
    """Broadcast ``df`` if its row count is bounded by ``max_rows`` (a bound
    known without running a job: a literal table, a ``limit(k)``, a fixed
    dimension) and that many rows are small. Else unchanged (AQE decides)."""
    if max_rows is not None and max_rows * row_bytes(df) <= MAX_BROADCAST_BYTES:
        return F.broadcast(df)
    return df


def keep_members(df: DataFrame, members: DataFrame, on, members_bound: int | None = None) -> DataFrame:
    """Rows of ``df`` whose key is in ``members`` (semi join)."""
    return df.join(broadcast_bounded(members, members_bound), on, "left_semi")


def drop_members(df: DataFrame, members: DataFrame, on, members_bound: int | None = None) -> DataFrame:
    """Rows of ``df`` whose key is not in ``members`` (anti join)."""
    return df.join(broadcast_bounded(members, members_bound), on, "left_anti")
