"""Top-3 products by clicks per area."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.columns import id_name, json_field, sorted_distinct_text
from visitlens.operators.joins import broadcast_bounded
from visitlens.operators.topn import top_n_per_group
from visitlens.params import TaskParams
from visitlens.sources import fixtures as src

# Area -> level (P14), and the product status labels.
AREA_LEVELS = {"华北": "A_Level", "华东": "A_Level",
               "华中": "B_Level", "华南": "B_Level",
               "西南": "C_Level", "西北": "C_Level"}
OTHER_LEVEL = "D_Level"
STATUS_SELF, STATUS_THIRD = "Self", "Third Party"

OUTPUT = ["area", "area_level", "pid", "city_infos", "click_count", "product_name", "product_status"]


def area_level(area) -> F.Column:
    expr = None
    for name, level in AREA_LEVELS.items():
        expr = (F.when(area == name, level) if expr is None else expr.when(area == name, level))
    return expr.otherwise(OTHER_LEVEL)


def product_status(extend_info) -> F.Column:
    return F.when(json_field(extend_info, "product_status") == "0", STATUS_SELF).otherwise(STATUS_THIRD)


def area_counts(clicks: DataFrame) -> DataFrame:
    """(area, pid) -> click_count and the sorted distinct ``id:name`` city
    list (A10, X3). Counting (area, pid, city) first keeps the per-row work
    in a code-generated hash aggregate; the city text is built only on the
    few distinct rows left."""
    per_city = clicks.groupBy("area", "pid", "city_id", "city_name").agg(F.count(F.lit(1)).alias("n"))
    return (per_city.groupBy("area", "pid")
            .agg(F.sum("n").alias("click_count"),
                 sorted_distinct_text(F.collect_list(id_name("city_id", "city_name"))).alias("city_infos")))


def rank_area_products(area_counts: DataFrame, product_info: DataFrame, n: int = 3) -> DataFrame:
    """(area, pid, click_count, city_infos) ⋈ products -> top ``n`` per area.

    Products are matched by key alone before the ranking; names and status are
    fetched for the few rows left. Joins are left to AQE. Ranking keeps a
    partial limit before the shuffle, so a huge area does not land whole in one
    task.
    """
    prod = product_info.select(F.col("product_id").alias("pid"), "product_name", "extend_info")
    known = area_counts.join(prod.select("pid"), "pid", "left_semi")
    top = top_n_per_group(known, ["area"], [F.desc("click_count"), F.asc("pid")], n)
    return top.join(prod, "pid", "inner").select(
        "area", area_level(F.col("area")).alias("area_level"), "pid", "city_infos",
        "click_count", "product_name", product_status(F.col("extend_info")).alias("product_status"),
    ).select(*OUTPUT)


def area_top3(spark: SparkSession, sf_dir: str, params: TaskParams = TaskParams(), n: int = 3) -> DataFrame:
    """B10 on the action log: clicks with a product, by city area."""
    clicks = (src.actions(spark, sf_dir, params.start_date, params.end_date)
              .where(F.col("click_product_id") != -1)
              .select("city_id", F.col("click_product_id").alias("pid")))
    cities = broadcast_bounded(src.city_dim(spark), len(src.CITY_ROWS))
    counts = area_counts(clicks.join(cities, "city_id", "inner"))
    return rank_area_products(counts, src.products(spark, sf_dir), n)


def area_top3_lineitem(spark: SparkSession, sf_dir: str, n: int = 3) -> DataFrame:
    """B10 at warehouse scale: lineitem rows are the clicks, the supplier's
    nation is the city, its region the area, ``l_partkey`` the product.

    All joins are left to AQE: a broadcast hash join when a side is measured
    small, else a sort-merge join with hot keys split. Lineitem is shuffled at
    most once, then the (area, part) aggregation combines partially.
    """
    li = src.table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey")
    nation = src.table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = src.table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = (src.table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
           .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
           .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
           .select("s_suppkey", F.col("r_name").alias("area"),
                   F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city_name")))
    counts = area_counts(li.join(geo, F.col("l_suppkey") == F.col("s_suppkey"), "inner")
                         .withColumnRenamed("l_partkey", "pid"))
    part = src.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.concat(F.lit('{"product_status": '), (F.col("p_partkey") % 2).cast("string"),
                 F.lit("}")).alias("extend_info"))
    return rank_area_products(counts, part, n)
