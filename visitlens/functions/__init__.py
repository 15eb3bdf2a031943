"""Column helpers (F1-F21) and parameter predicates."""

from visitlens.functions.columns import *  # noqa: F401,F403
from visitlens.functions.predicates import (  # noqa: F401
    all_of, equals, in_range, one_of, overlaps, session_filter,
)
