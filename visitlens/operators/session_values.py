"""A1's distinct lists for sessions of any length: no list is longer than about
``PART_VALUES``.

``fold_sessions`` gathers a session's keywords and categories into one array,
which a session with millions of them cannot afford. Here values are made
distinct as (session, value) rows, spread over all tasks; a session with more
than ``part_values`` of them is dealt into parts by the leading hex digits of
its values' md5, and only a part is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: distinct values of one row, about
PART_VALUES = 100_000
#: hex digits that part a session at most: 16 ** 7 parts
MAX_DIGITS = 7

KEYWORD, CATEGORY = "keyword", "category"


def _digits(n: Column, part_values: int) -> Column:
    """Least d with n <= part_values * 16 ** d."""
    return sum((F.when(n > part_values * 16 ** d, 1).otherwise(0) for d in range(MAX_DIGITS)), F.lit(0))


def session_values(actions: DataFrame, part_values: int = PART_VALUES) -> DataFrame:
    """(session_id, kind, part, n_values, value_list): the distinct search
    keywords and clicked categories (as text) of every session, by ``kind``.

    Up to ``part_values`` of a kind are one row with part ''; more are parted by
    the first digits of md5(value), each part sorted. Null keywords, and -1 and
    null categories, are no values; a session without any has no row, a null
    session is one of its own.

    The rows are made distinct before the shuffle and by (session, value)
    after it, so a hot session is spread; its count is partial too. Only the
    sessions that are parted meet the distinct rows again.
    """
    category = F.when(F.col("click_category_id") != -1, F.col("click_category_id").cast("string"))
    found = F.array(F.struct(F.lit(KEYWORD).alias("kind"), F.col("search_keyword").alias("value")),
                    F.struct(F.lit(CATEGORY).alias("kind"), category.alias("value")))
    held = (actions.select("session_id", F.explode(found).alias("v")).select("session_id", "v.kind", "v.value")
            .where("value is not null").distinct())
    # of its own name: null sessions are joined too
    long = (held.groupBy(F.col("session_id").alias("_session"), F.col("kind").alias("_kind")).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > part_values).select("_session", "_kind", _digits(F.col("_n"), part_values).alias("_digits")))
    parted = held.join(long, F.col("session_id").eqNullSafe(F.col("_session")) & (F.col("kind") == F.col("_kind")), "left")
    part = F.substring(F.md5("value"), F.lit(1), F.coalesce("_digits", F.lit(0)))
    return (parted.select("session_id", "kind", part.alias("part"), "value")
            .groupBy("session_id", "kind", "part")
            .agg(F.count(F.lit(1)).alias("n_values"), F.sort_array(F.collect_list("value")).alias("value_list")))
