"""Page-flow conversion rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.columns import pair_label, round_half_up
from visitlens.operators.sequence import chained_rates, flow_steps, transition_counts
from visitlens.params import TaskParams
from visitlens.sources import fixtures as src

OUTPUT = ["step", "from_page", "to_page", "pair_count", "rate"]


def page_conversion(spark: SparkSession, sf_dir: str, params: TaskParams = TaskParams(),
                    rounded: bool = False) -> DataFrame:
    """One row per step of the target flow: pair count and conversion rate.

    Only the date range applies (no session filter). The start count is all
    visits of the flow's first page (rows, not sessions). Pairs come from
    consecutive actions of a session ordered by time, then action id.
    """
    flow = params.page_flow()
    acts = src.actions(spark, sf_dir, params.start_date, params.end_date)
    counts = transition_counts(acts, "session_id", ["action_time", "action_id"], "page_id",
                               pairs=list(zip(flow, flow[1:])), visits=flow[:1])
    # one join of the step table (step 0 = visits of the first page) with the
    # counts; the count chain is consumed once
    c = counts.select("kind", F.col("from_value").alias("from_page"),
                      F.coalesce("to_value", F.lit(-1)).alias("_to"), F.col("n").alias("pair_count"))
    steps = flow_steps(spark, flow).withColumn("_to", F.coalesce("to_page", F.lit(-1).cast("bigint")))
    per_step = (steps.join(c, ["kind", "from_page", "_to"], "left")
                .select("step", "from_page", "to_page",
                        F.coalesce("pair_count", F.lit(0).cast("bigint")).alias("pair_count")))
    out = chained_rates(per_step).where(F.col("step") >= 1)
    if rounded:
        out = out.withColumn("rate", round_half_up("rate", 2))
    return out.select(*OUTPUT)


def page_conversion_text(spark: SparkSession, sf_dir: str, params: TaskParams = TaskParams(),
                         rounded: bool = True) -> DataFrame:
    """The reference's text form ``1_2=r|2_3=r...`` in flow order (Q12);
    a NULL rate prints as ``null``."""
    rows = page_conversion(spark, sf_dir, params, rounded)
    item = F.concat(pair_label("from_page", "to_page"), F.lit("="),
                    F.coalesce(F.col("rate").cast("string"), F.lit("null")))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("step"), item.alias("t"))))
    return rows.agg(F.array_join(F.transform(ordered, lambda x: x["t"]), "|").alias("convert_rate"))
