"""W4 next-row transitions within a group, W6 chained step ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PAIR, _EDGE, _VISIT = 0, 1, 2


def transition_counts(df: DataFrame, group: str, order: list[str], value: str, partitions: int | None = None,
                      pairs: list[tuple[int, int]] | None = None, visits: list[int] | None = None) -> DataFrame:
    """Count (value, next value) pairs of consecutive rows of each group in
    ``order`` (the last order column must break ties), and rows per value.
    Output: ``kind`` ('pair' | 'visit'), ``from_value``, ``to_value`` (NULL
    for visits), ``n``. With ``pairs`` and ``visits`` only those are counted.

    Skew-safe: rows are range-partitioned on (group, order...), so a huge
    group is cut into consecutive slices over several tasks instead of one.
    ``lead`` runs inside each slice; the first and the last value of a group in
    a slice are kept, and the last meets the first of the group's next slice,
    whichever that is. Wanted pairs, visits and ends are counted in one
    aggregation (partial combine before the shuffle); no self-join, and the
    input is scanned once.
    """
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [group] + list(order)
    sliced = (df.select(*keys, value)
              .repartitionByRange(n_parts, *keys)
              .withColumn("_slice", F.spark_partition_id()))
    w = Window.partitionBy(group, "_slice").orderBy(*order)
    local = sliced.select(group, "_slice", F.col(value).cast("bigint").alias("_v"),
                          F.lead(value).over(w).cast("bigint").alias("_next"),
                          # the slice's last row by position (a NULL value is not an end)
                          F.lead(F.lit(True)).over(w).isNull().alias("_last"),
                          F.row_number().over(w).alias("_rn"))
    v, nxt, last = F.col("_v"), F.col("_next"), F.col("_last")
    nl = F.lit(None).cast("bigint")
    ng = F.lit(None).cast(df.schema[group].dataType)
    ni = F.lit(None).cast("int")

    def wanted(a, b):
        some = a.isNotNull() & b.isNotNull()
        return some if pairs is None else some & F.struct(a, b).isin(*[F.struct(F.lit(x).cast("bigint"), F.lit(y).cast("bigint")) for x, y in pairs])

    def entry(k, a, b, g, s, first, last):
        return F.struct(F.lit(k).alias("k"), a.alias("a"), b.alias("b"), g.alias("g"), s.alias("s"),
                        first.alias("f"), last.alias("l"))

    visit = F.lit(True) if visits is None else v.isin(*map(int, visits))
    entries = F.array(
        F.when(~last & wanted(v, nxt), entry(_PAIR, v, nxt, ng, ni, nl, nl)),
        F.when(visit, entry(_VISIT, v, nl, ng, ni, nl, nl)),
        F.when(last | (F.col("_rn") == 1), entry(_EDGE, nl, nl, F.col(group), F.col("_slice"),
                                                 F.when(F.col("_rn") == 1, v), F.when(last, v))),
    )
    e = local.select(F.explode(F.filter(entries, lambda x: x.isNotNull())).alias("e")).select("e.*")
    agg = e.groupBy("k", "a", "b", "g", "s").agg(F.count(F.lit(1)).alias("n"),
                                                 F.max("f").alias("f"), F.max("l").alias("l"))
    edge = F.col("k") == _EDGE
    # the group's next slice; other rows are counted already and pass through
    met = agg.withColumn("_next", F.lead("f").over(Window.partitionBy("k", "g", "a", "b").orderBy("s")))
    return (met.where(~edge | wanted(F.col("l"), F.col("_next")))
            .select(F.when(F.col("k") == _VISIT, "visit").otherwise("pair").alias("kind"),
                    F.when(edge, F.col("l")).otherwise(F.col("a")).alias("from_value"),
                    F.when(edge, F.col("_next")).otherwise(F.col("b")).alias("to_value"),
                    F.when(edge, F.lit(1).cast("bigint")).otherwise(F.col("n")).alias("n"))
            .groupBy("kind", "from_value", "to_value").agg(F.sum("n").alias("n")))


def flow_steps(spark: SparkSession, flow: list[int]) -> DataFrame:
    """(step, kind, from_page, to_page) of a page flow: step 0 is the visit
    count of the first page, then one row per consecutive pair (Q27)."""
    rows = [(0, "visit", int(flow[0]), None)]
    rows += [(i + 1, "pair", int(a), int(b)) for i, (a, b) in enumerate(zip(flow, flow[1:]))]
    schema = T.StructType([T.StructField("step", T.IntegerType(), False),
                           T.StructField("kind", T.StringType(), False),
                           T.StructField("from_page", T.LongType(), False),
                           T.StructField("to_page", T.LongType(), True)])
    from visitlens.sources.fixtures import literal_table
    return literal_table(spark, rows, schema)


def chained_rates(step_counts: DataFrame) -> DataFrame:
    """rate(k) = count(k) / count(k-1), where step 0 holds the start
    count. Runs on the per-step table (one row per flow step), so the
    unpartitioned window is one tiny task. 0 or missing divisor -> NULL
    (Q11)."""
    w = Window.partitionBy().orderBy("step")
    return step_counts.withColumn("rate", F.try_divide(F.col("pair_count"), F.lag("pair_count").over(w)))
