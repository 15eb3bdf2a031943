"""Sinks: run-id append, merge meanings, stored tables."""

from visitlens.sinks.stored import BatchTable, KeyedTable  # noqa: F401
from visitlens.sinks.tables import (  # noqa: F401
    append_jdbc, append_new, append_result, merge_add, merge_overwrite,
    register_view, replace_groups, save_table, with_run_id, write_day_table, write_text,
)
