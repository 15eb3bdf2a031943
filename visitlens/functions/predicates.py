"""Parameter predicates P1-P4: each passes when its parameter is unset."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitlens.params import TaskParams


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def in_range(col, low, high) -> Column | None:
    """``low <= x <= high``; None (= pass) unless both bounds are set (Q6).

    A missing value fails.
    """
    if low is None or high is None or low == "" or high == "":
        return None
    return F.coalesce(_c(col).between(low, high), F.lit(False))


def overlaps(col, wanted: list, element_type: str = "string") -> Column | None:
    """Any element of the row's list equals any wanted value.

    ``col`` may be an array column or comma text. None (= pass) when
    nothing is wanted; a missing value fails.
    """
    if not wanted:
        return None
    c = _c(col)
    values = F.array(*[F.lit(v).cast(element_type) for v in wanted])
    return F.coalesce(F.arrays_overlap(c, values), F.lit(False))


def equals(col, value) -> Column | None:
    """Equality, None (= pass) when the parameter is unset."""
    if value is None or value == "":
        return None
    return F.coalesce(_c(col) == F.lit(value), F.lit(False))


def one_of(col, values: list) -> Column | None:
    """P2 for a scalar column: value is one of the wanted ones."""
    if not values:
        return None
    return F.coalesce(_c(col).isin(values), F.lit(False))


def all_of(preds) -> Column:
    """Conjunction of the predicates that are set."""
    preds = [p for p in preds if p is not None]
    if not preds:
        return F.lit(True)
    return reduce(lambda a, b: a & b, preds)


def user_filter(params: TaskParams) -> Column:
    """P4 over the user's attributes (age, professional, city, sex)."""
    return all_of([
        in_range("age", params.start_age, params.end_age),
        one_of("professional", params.list_of("professionals")),
        one_of("city", params.list_of("cities")),
        equals("sex", params.sex),
    ])


def action_tests(params: TaskParams) -> dict[str, Column]:
    """P2 as predicates over single actions, by name: a session passes one when
    any of its actions does. Equals ``overlaps`` over the session's distinct
    lists, without the lists."""
    category = one_of("click_category_id", [int(v) for v in params.list_of("category_ids")])
    tests = {"has_keyword": one_of("search_keyword", params.list_of("keywords")),
             "has_category": None if category is None else category & (F.col("click_category_id") != -1)}
    return {name: test for name, test in tests.items() if test is not None}


def session_filter(params: TaskParams) -> Column:
    """P4 over a session profile (age, professional, city, sex, keywords,
    categories). Keywords and categories test the array columns
    ``search_keyword_list`` / ``click_category_list`` (Q3 fixed)."""
    return all_of([
        user_filter(params),
        overlaps("search_keyword_list", params.list_of("keywords")),
        overlaps("click_category_list", [int(v) for v in params.list_of("category_ids")],
                 "bigint"),
    ])
