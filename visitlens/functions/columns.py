"""Column helpers (F1-F21). All are built-in Spark expressions (codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of the reference's text keys.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
DATEKEY_FORMAT = "yyyyMMdd"
MINUTE_FORMAT = "yyyyMMddHHmm"
# Parsing accepts unpadded hours, as the reference's generator writes them.
TIME_PARSE_FORMAT = "yyyy-MM-dd H:mm:ss"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_time(text) -> Column:
    """``yyyy-MM-dd H:mm:ss`` text -> timestamp; NULL when malformed."""
    return F.try_to_timestamp(_c(text), F.lit(TIME_PARSE_FORMAT))


def format_time(ts) -> Column:
    """timestamp -> ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(_c(ts), TIME_FORMAT)


def format_date(ts) -> Column:
    """-> ``yyyy-MM-dd``."""
    return F.date_format(_c(ts), DATE_FORMAT)


def format_date_key(ts) -> Column:
    """-> ``yyyyMMdd``."""
    return F.date_format(_c(ts), DATEKEY_FORMAT)


def format_minute_key(ts) -> Column:
    """-> ``yyyyMMddHHmm``."""
    return F.date_format(_c(ts), MINUTE_FORMAT)


def date_hour_key(ts) -> Column:
    """``yyyy-MM-dd_HH``."""
    return F.concat_ws("_", format_date(ts), F.lpad(F.hour(_c(ts)).cast("string"), 2, "0"))


def seconds_between(start, end) -> Column:
    """whole seconds from ``start`` to ``end``."""
    return F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))


def is_before(a, b) -> Column:
    """``a`` is earlier than ``b``."""
    return _c(a) < _c(b)


def is_after(a, b) -> Column:
    """``a`` is later than ``b``."""
    return _c(a) > _c(b)


def today() -> Column:
    """the current date (session time zone)."""
    return F.current_date()


def yesterday() -> Column:
    """F5."""
    return F.date_sub(F.current_date(), 1)


def parse_date_key(text) -> Column:
    """``yyyyMMdd`` text -> date; NULL when malformed."""
    return F.to_date(F.try_to_timestamp(_c(text), F.lit(DATEKEY_FORMAT)))


def epoch_seconds_to_date(sec) -> Column:
    """epoch seconds -> date (session time zone)."""
    return F.to_date(F.timestamp_seconds(_c(sec)))


def round_half_up(x, scale: int = 2) -> Column:
    """F8: Spark's ``round`` is HALF_UP on the decimal text of the double."""
    return F.round(_c(x), scale)


def is_not_empty(s) -> Column:
    """F9."""
    return _c(s).isNotNull() & (_c(s) != F.lit(""))


def trim_commas(s) -> Column:
    """strip commas at both ends."""
    return F.regexp_replace(_c(s), r"^,+|,+$", "")


def pad2(x) -> Column:
    """left-pad to two digits."""
    return F.lpad(_c(x).cast("string"), 2, "0")


def kv_field(text, key: str, sep: str = "|", kv: str = "=") -> Column:
    """value of ``key`` in ``k=v|k=v`` text; empty value -> NULL."""
    m = F.str_to_map(_c(text), F.lit(sep.replace("|", r"\|")), F.lit(kv))
    return F.nullif(F.element_at(m, F.lit(key)), F.lit(""))


def kv_set(text, key: str, value, sep: str = "|", kv: str = "=") -> Column:
    """set ``key`` in ``k=v|k=v`` text (keys kept in map order)."""
    m = F.str_to_map(_c(text), F.lit(sep.replace("|", r"\|")), F.lit(kv))
    m = F.map_concat(F.map_filter(m, lambda k, v: k != F.lit(key)),
                     F.create_map(F.lit(key), _c(value).cast("string")))
    return F.array_join(F.transform(F.map_entries(m),
                                    lambda e: F.concat(e["key"], F.lit(kv), e["value"])), sep)


def mask_phone(phone) -> Column:
    """keep characters 1-3 and 8-11 of an 11-digit phone.

    Empty or NULL stays as is; shorter text keeps what exists.
    """
    p = _c(phone)
    return F.when(is_not_empty(p),
                  F.concat(F.substring(p, 1, 3), F.substring(p, 8, 4))).otherwise(p)


def strip_line_breaks(s) -> Column:
    """F15."""
    return F.regexp_replace(_c(s), "\n", "")


def split_tabs(line) -> Column:
    """F16: split on tab, keeping empty fields."""
    return F.split(_c(line), "\t", -1)


def join_tabs(arr) -> Column:
    """F16: join on tab."""
    return F.array_join(_c(arr), "\t")


def split_ids(text) -> Column:
    """comma list -> array<bigint>; bad items become NULL and are dropped."""
    parts = F.split(_c(text), ",")
    return F.filter(F.transform(parts, lambda x: F.trim(x).try_cast("bigint")),
                    lambda x: x.isNotNull())


def json_field(js, field: str) -> Column:
    """a JSON field as text, NULL when absent."""
    return F.get_json_object(_c(js), f"$.{field}")


def id_name(id_col, name_col, sep: str = ":") -> Column:
    """``id:name``."""
    return F.concat_ws(sep, _c(id_col).cast("string"), _c(name_col))


def pair_label(a, b) -> Column:
    """``a_b``."""
    return F.concat_ws("_", _c(a).cast("string"), _c(b).cast("string"))


def sorted_distinct_text(arr) -> Column:
    """Distinct values of an array, sorted, comma joined; NULL when empty (Q25)."""
    return F.nullif(F.array_join(F.array_sort(F.array_distinct(_c(arr))), ","), F.lit(""))
