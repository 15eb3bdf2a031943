"""J9 range lookup: an equi join on a bucket key for a table of known small
size, a sorted sweep for any other."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlens.operators.joins import broadcast_bounded
from visitlens.session import checkpoint_dir


def ipv4_to_long(ip) -> F.Column:
    """Dotted IPv4 text -> number; NULL when malformed."""
    parts = F.split(ip if not isinstance(ip, str) else F.col(ip), r"\.")

    def octet(x):
        n = x.try_cast("bigint")
        return F.when(n.between(0, 255), n)

    # a fold over the parts, so that the text is split once, not once an octet
    value = F.aggregate(parts, F.lit(0).cast("bigint"), lambda acc, x: acc * 256 + octet(x))
    return F.when(F.size(parts) == 4, value)


def ip_key(ip) -> F.Column:
    """IPv4 or IPv6 text -> 32 hex digits that sort as the addresses do (IPv4 as
    ``::ffff:a.b.c.d``); NULL when malformed."""
    ip = F.lower(F.col(ip) if isinstance(ip, str) else ip)
    halves = F.split(ip, "::")
    side = lambda i: F.filter(F.split(F.coalesce(F.get(halves, F.lit(i)), F.lit("")), ":"), lambda x: x != "")
    left, right = side(0), side(1)
    gap = 8 - F.size(left) - F.size(right)
    # "::" stands for one group or more; a lone colon at an end is malformed
    shape = F.when(F.size(halves) == 2, gap >= 1).otherwise((F.size(halves) == 1) & (gap == 0))
    groups = F.concat(left, F.array_repeat(F.lit("0"), F.greatest(gap, F.lit(0))), right)
    ok = (shape & F.forall(groups, lambda x: x.rlike("^[0-9a-f]{1,4}$"))
          & ~ip.rlike("^:[^:]|[^:]:$|:::"))
    v6 = F.when(ok, F.array_join(F.transform(groups, lambda x: F.lpad(x, 4, "0")), ""))
    v4 = F.concat(F.lit("0" * 20 + "ffff"), F.lower(F.lpad(F.hex(ipv4_to_long(ip)), 8, "0")))
    return F.coalesce(v4, v6)


def range_lookup(df: DataFrame, key: str, ranges: DataFrame, start: str = "start_num",
                 end: str = "end_num", bucket_bits: int = 16, ranges_bound: int | None = None) -> DataFrame:
    """Left join every row of ``df`` with the range holding ``df[key]``
    (``start <= key <= end``; ranges must not overlap).

    A plain BETWEEN join plans as a nested loop. Here each range is exploded
    over the ``key >> bucket_bits`` buckets it touches, so the join is a hash
    join on the bucket plus the range test. ``ranges_bound`` (rows after the
    explode, when known) allows a broadcast; otherwise AQE chooses.
    """
    b = "_bucket"
    rb = ranges.withColumn(b, F.explode(F.sequence(F.shiftright(F.col(start), bucket_bits),
                                                   F.shiftright(F.col(end), bucket_bits))))
    rb = broadcast_bounded(rb, ranges_bound)
    left = df.withColumn(b, F.shiftright(F.col(key), bucket_bits))
    cond = (left[b] == rb[b]) & left[key].between(rb[start], rb[end])
    return left.join(rb, cond, "left").drop(rb[b]).drop(left[b])


def range_lookup_plain(df: DataFrame, key: str, ranges: DataFrame, start: str = "start_num",
                       end: str = "end_num") -> DataFrame:
    """The direct BETWEEN join (nested loop), kept to test ``range_lookup``."""
    return df.join(ranges, F.col(key).between(F.col(start), F.col(end)), "left")


def range_sweep(df: DataFrame, key: str, ranges: DataFrame, start: str = "start_num",
                end: str = "end_num", partitions: int | None = None) -> DataFrame:
    """``range_lookup`` for a range table of any size and any width: left join
    every row of ``df`` with the range holding ``df[key]``. Keys and bounds may be
    of any type with an order (numbers, or text such as ``ip_key`` gives).

    The distinct keys and the range starts are put in one order by range
    partitioning, and a sweep of each slice carries the last range opened; the
    one open at a slice's end is carried into the next slices. No range is copied,
    however wide it is; a key with very many rows is one row of the sweep and its
    rows meet the answer in an equi join, which AQE broadcasts or splits. The
    swept slices are written to the checkpoint folder, as both carries must see
    the same bounds.

    Ranges must not overlap. A range with a null or reversed bound holds nothing;
    of ranges with one start the widest counts (of equal ones, either). A null key, an
    empty range table and keys between ranges give nulls; every row of ``df``
    stays, repeated ones too. A column of ``ranges`` that ``df`` has as well comes
    twice, as in any join.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    opened = (ranges.where(F.col(start) <= F.col(end))
              .select(F.col(start).alias("_at"), F.lit(0).alias("_key"), F.col(end).alias("_to"),
                      F.struct(*ranges.columns).alias("_range")))
    asked = df.select(F.col(key).alias("_at"), F.lit(1).alias("_key")).where("_at IS NOT NULL").distinct()
    sliced = (opened.unionByName(asked, allowMissingColumns=True)
              .repartitionByRange(n, "_at", "_key").withColumn("_slice", F.spark_partition_id()))
    # a start comes before the keys equal to it, the widest of its ranges last
    ahead = Window.partitionBy("_slice").orderBy("_at", "_key", "_to")
    this = F.when(F.col("_key") == 0, F.struct("_to", "_range"))
    swept = sliced.select(
        "_slice", "_at", "_key", F.lead(F.lit(True)).over(ahead).isNull().alias("_end"),
        F.last(this, ignorenulls=True).over(ahead.rowsBetween(Window.unboundedPreceding, 0)).alias("_open"))
    path = f"{checkpoint_dir(spark).rstrip('/')}/visitlens-sweeps/{uuid.uuid4().hex}"
    swept.where("_key = 1 OR _end").write.parquet(path)
    swept = spark.read.schema(swept.schema).parquet(path)
    # one row a slice, so at most one a partition
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = swept.where("_end").select("_slice", F.last("_open", ignorenulls=True).over(before).alias("_carried"))
    last = F.coalesce("_open", "_carried")
    answers = (swept.where("_key = 1").join(broadcast_bounded(carried, n), "_slice")
               .where(F.col("_at") <= last["_to"])
               .select("_at", *[last["_range"][c].alias(c) for c in ranges.columns]))
    return df.join(answers, df[key] == answers["_at"], "left").drop(answers["_at"])
