"""W3 stratified sample without replacement, deterministic."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlens.operators.joins import broadcast_bounded

#: rows of one group of leading digits, about
GROUP_ROWS = 5000


def sample_order(key_col: str, seed: str) -> F.Column:
    """Pseudo-random but reproducible order: ``md5(key || seed)`` (the same
    hex text in Spark and DuckDB)."""
    return F.md5(F.concat(F.col(key_col).cast("string"), F.lit(seed)))


def stratified_sample(df: DataFrame, day_col: str, hour_col: str, key_col: str,
                      total: int = 100, seed: str = "visitlens", max_days: int | None = None) -> DataFrame:
    """Per day quota = ``total div days``; per hour
    ``floor(hour_n / day_n * per_day)`` (doubles, truncated: Q29), at most the
    hour's size; rows chosen by the seeded hash.

    No stratum is ever gathered whole, whatever ``total`` is: rows are counted
    by the leading hex digits of their order, as many as a stratum's size
    asks for; of the digit groups in order, those that end within the quota are
    taken whole, and only the one group that the quota cuts through is
    ranked. A group has about ``GROUP_ROWS`` rows. The quota table has one row
    per (day, hour) present; with ``max_days`` (known from the date range) that
    is at most ``24 * max_days`` rows and may be broadcast, otherwise AQE
    decides from measured sizes.
    """
    hours = df.groupBy(day_col, hour_col).agg(F.count(F.lit(1)).alias("_hour_n"))
    days = hours.groupBy(day_col).agg(F.sum("_hour_n").alias("_day_n"))
    n_days = days.agg(F.count(F.lit(1))).scalar()
    bound = 24 * max_days if max_days else None
    share = F.floor((F.col("_hour_n") / F.col("_day_n")) * F.floor(F.lit(total) / n_days))
    # 16 ** digits groups of about GROUP_ROWS rows each
    digits = F.ceil(F.log(16.0, F.greatest(F.lit(1.0), F.col("_hour_n") / GROUP_ROWS))).cast("int")
    quotas = (hours.join(broadcast_bounded(days, max_days), day_col)
              .select(day_col, hour_col, F.least(share, F.col("_hour_n")).alias("_quota"), digits.alias("_digits")))
    rows = (df.withColumn("_order", sample_order(key_col, seed))
            .join(broadcast_bounded(quotas, bound), [day_col, hour_col]).where("_quota > 0")
            .withColumn("_group", F.substring("_order", F.lit(1), F.col("_digits"))))
    strata = [day_col, hour_col]
    ahead = F.sum("_n").over(Window.partitionBy(*strata).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1))
    groups = (rows.groupBy(*strata, "_group", "_quota").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_ahead", F.coalesce(ahead, F.lit(0)))
              .where(F.col("_ahead") < F.col("_quota")).drop("_quota"))
    near = rows.join(groups, [*strata, "_group"])
    whole = F.col("_ahead") + F.col("_n") <= F.col("_quota")
    rank = F.row_number().over(Window.partitionBy(*strata, "_group").orderBy("_order", key_col))
    cut = near.where(~whole).withColumn("_rank", rank).where(F.col("_ahead") + F.col("_rank") <= F.col("_quota"))
    return near.where(whole).select(*df.columns).unionByName(cut.select(*df.columns))
