"""Inputs: driver parquet tables, derived reference shapes, log readers."""

from visitlens.sources.fixtures import (  # noqa: F401
    actions, ad_click_lines, city_dim, course_lines, course_table, events,
    initial_blacklist, ip_ranges, products, table, users, vip_users,
)
from visitlens.sources.logs import (  # noqa: F401
    ad_rejects, course_fields, parse_ad_lines, parse_course_lines, read_kafka_stream,
    read_text, read_text_stream,
)
