"""DuckDB SQL for every checked query.

The fixture CTEs restate ``visitlens.sources.fixtures`` in SQL over the
driver views (events, customer, part, ...), so both engines derive the same
input rows. Ratios rounded HALF_UP are written with integers
(``floor((200*a + n) / (2*n)) / 100``) because DuckDB rounds doubles
differently from Spark's decimal HALF_UP.
"""

from __future__ import annotations

import datetime as _dt

# Written out here once more, so that a wrong value in the code shows.
CITY_ROWS = [(0, '北京', '华北'), (1, '上海', '华东'), (2, '南京', '华东'), (3, '广州', '华南'), (4, '三亚', '华南'), (5, '武汉', '华中'), (6, '长沙', '华中'), (7, '西安', '西北'), (8, '成都', '西南'), (9, '哈尔滨', '东北')]
VISIT_BINS = [('1s_3s', 1, 3), ('4s_6s', 4, 6), ('7s_9s', 7, 9), ('10s_30s', 10, 30), ('30s_60s', 31, 60), ('1m_3m', 61, 180), ('3m_10m', 181, 600), ('10m_30m', 601, 1800), ('30m', 1801, None)]
STEP_BINS = [('1_3', 1, 3), ('4_6', 4, 6), ('7_9', 7, 9), ('10_30', 10, 30), ('30_60', 31, 60), ('60', 61, None)]
COURSE_EVENT = {'view': 'startVideo', 'click': 'endVideo', 'signup': 'enterOrderPage', 'purchase': 'completeOrder'}
IP_REGIONS = ['北京', '上海', '广东', '浙江', '江苏', '四川']
UNKNOWN_REGION = '未知'
VIDEO_LENGTH = 300
AREA_LEVELS = {'华北': 'A_Level', '华东': 'A_Level', '华中': 'B_Level', '华南': 'B_Level', '西南': 'C_Level', '西北': 'C_Level'}
OTHER_LEVEL = 'D_Level'
STATUS_SELF = 'Self'
STATUS_THIRD = 'Third Party'


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _next_day(day: str) -> str:
    return (_dt.date.fromisoformat(day) + _dt.timedelta(days=1)).isoformat()


def events_where(start: str | None, end: str | None) -> str:
    conds = []
    if start:
        conds.append(f"ts >= TIMESTAMP '{start} 00:00:00'")
    if end:
        conds.append(f"ts < TIMESTAMP '{_next_day(end)} 00:00:00'")
    return ("WHERE " + " AND ".join(conds)) if conds else ""


def actions_cte(start: str | None, end: str | None, name: str = "actions") -> str:
    return f"""{name} AS (
  SELECT event_id AS action_id,
         strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date,
         user_id,
         CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%d') AS session_id,
         event_id % 10 AS page_id,
         CAST(CAST(ts AS DATE) AS TIMESTAMP)
           + to_seconds(CAST((user_id % 24) * 3600
                             + (hour(ts) * 3600 + minute(ts) * 60 + second(ts)) // 30 AS BIGINT)) AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || CAST(event_id % 10 AS VARCHAR) END AS search_keyword,
         CAST(CASE WHEN event_type = 'click' THEN event_id % 20 ELSE -1 END AS BIGINT) AS click_category_id,
         CAST(CASE WHEN event_type = 'click' THEN (event_id * 7) % 100 ELSE -1 END AS BIGINT) AS click_product_id,
         CASE WHEN event_type = 'signup'
              THEN CAST(event_id % 20 AS VARCHAR) || ',' || CAST((event_id + 3) % 20 AS VARCHAR) END AS order_category_ids,
         CASE WHEN event_type = 'signup'
              THEN CAST((event_id * 7) % 100 AS VARCHAR) || ',' || CAST(((event_id + 3) * 7) % 100 AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'purchase' THEN CAST((event_id + 5) % 20 AS VARCHAR) END AS pay_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(((event_id + 5) * 7) % 100 AS VARCHAR) END AS pay_product_ids,
         user_id % 10 AS city_id
  FROM events {events_where(start, end)}
)"""


USERS_CTE = """users AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
         CAST(18 + c_custkey % 43 AS INTEGER) AS age,
         c_mktsegment AS professional,
         'city' || CAST(c_nationkey AS VARCHAR) AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer
)"""

PRODUCTS_CTE = """products AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
         '{"product_status": ' || CAST(p_partkey % 2 AS VARCHAR) || '}' AS extend_info
  FROM part
)"""

CITIES_CTE = "cities(city_id, city_name, area) AS (VALUES " + ", ".join(
    f"({i}, {_q(n)}, {_q(a)})" for i, n, a in CITY_ROWS) + ")"

IP_RANGES_CTE = "ip_ranges(start_num, end_num, region) AS (VALUES " + ", ".join(
    f"({(10 << 24) + (i << 16)}, {(10 << 24) + (i << 16) + 65535}, {_q(r)})"
    for i, r in enumerate(IP_REGIONS)) + ")"

VIP_CTE = "vip_user AS (SELECT c_custkey AS id, c_custkey AS uid FROM customer WHERE c_custkey % 5 = 0)"
BLACKLIST_CTE = "blacklist AS (SELECT c_custkey AS userid FROM customer WHERE c_custkey % 50 = 7)"


def ad_clicks_cte(start: str | None = None, end: str | None = None) -> str:
    """Parsed ad click lines (the batch twin reads the same fields)."""
    where = events_where(start, end)
    where = (where + " AND " if where else "WHERE ") + "event_type = 'click'"
    return f"""ad_clicks AS (
  SELECT epoch_us(ts) // 1000 AS ts_ms,
         'P' || CAST(user_id % 10 AS VARCHAR) AS province,
         'C' || CAST(user_id % 30 AS VARCHAR) AS city,
         user_id AS userid,
         event_id % 5 AS adid
  FROM events {where}
)"""


def course_cte(start: str | None = None, end: str | None = None, name: str = "course") -> str:
    """Typed course rows of all non-error events (valid 17-field lines)."""
    where = events_where(start, end)
    where = (where + " AND " if where else "WHERE ") + "event_type <> 'error'"
    key = "CASE " + " ".join(f"WHEN event_type = {_q(s)} THEN {_q(d)}" for s, d in COURSE_EVENT.items()) \
        + " ELSE event_type END"
    return f"""{name} AS (
  SELECT user_id AS uid, event_id, {key} AS event_key,
         '10.' || CAST(user_id % 8 AS VARCHAR) || '.' || CAST(event_id % 4 AS VARCHAR) || '.1' AS ip,
         '199000' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS phone,
         CAST({VIDEO_LENGTH} AS BIGINT) AS video_length,
         epoch_us(ts) // 1000000 AS start_video_time,
         CAST(CASE WHEN event_type = 'click'
                   THEN epoch_us(ts) // 1000000 + 6 * CAST(json_extract_string(props, '$.k') AS BIGINT)
                   ELSE 0 END AS BIGINT) AS end_video_time,
         epoch_us(ts) // 1000000 AS event_time
  FROM events {where}
)"""


def area_level_sql(col: str) -> str:
    return "CASE " + " ".join(f"WHEN {col} = {_q(a)} THEN {_q(l)}" for a, l in AREA_LEVELS.items()) \
        + f" ELSE {_q(OTHER_LEVEL)} END"


def product_status_sql(col: str) -> str:
    return (f"CASE WHEN json_extract_string({col}, '$.product_status') = '0' "
            f"THEN {_q(STATUS_SELF)} ELSE {_q(STATUS_THIRD)} END")


def rank_area_sql(counts: str, products: str, n: int = 3) -> str:
    return f"""ranked AS (
  SELECT k.area, {area_level_sql('k.area')} AS area_level, k.pid, k.city_infos, k.click_count,
         p.product_name, {product_status_sql('p.extend_info')} AS product_status,
         row_number() OVER (PARTITION BY k.area ORDER BY k.click_count DESC, k.pid) AS rn
  FROM {counts} k JOIN {products} p ON k.pid = p.product_id
)
SELECT area, area_level, pid, city_infos, click_count, product_name, product_status
FROM ranked WHERE rn <= {n}"""


def sorted_distinct_sql(expr: str, where: str | None = None) -> str:
    agg = f"list({expr})" + (f" FILTER (WHERE {where})" if where else "")
    return f"nullif(array_to_string(list_sort(list_distinct({agg})), ','), '')"


def area_top3_sql(start: str, end: str, n: int = 3) -> str:
    return f"""WITH {actions_cte(start, end)}, {PRODUCTS_CTE}, {CITIES_CTE},
counts AS (
  SELECT c.area, a.click_product_id AS pid, count(*) AS click_count,
         {sorted_distinct_sql("CAST(c.city_id AS VARCHAR) || ':' || c.city_name")} AS city_infos
  FROM actions a JOIN cities c ON a.city_id = c.city_id
  WHERE a.click_product_id <> -1
  GROUP BY c.area, a.click_product_id
),
{rank_area_sql('counts', 'products', n)}"""


def area_top3_lineitem_sql(n: int = 3) -> str:
    return f"""WITH counts AS (
  SELECT r.r_name AS area, l.l_partkey AS pid, count(*) AS click_count,
         {sorted_distinct_sql("CAST(nt.n_nationkey AS VARCHAR) || ':' || nt.n_name")} AS city_infos
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation nt ON s.s_nationkey = nt.n_nationkey
  JOIN region r ON nt.n_regionkey = r.r_regionkey
  GROUP BY r.r_name, l.l_partkey
),
parts AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
         '{{"product_status": ' || CAST(p_partkey % 2 AS VARCHAR) || '}}' AS extend_info
  FROM part
),
{rank_area_sql('counts', 'parts', n)}"""


# --- session jobs -------------------------------------------------------------

def _sql_list(values, numeric=False) -> str:
    return "[" + ", ".join(str(int(v)) if numeric else _q(str(v)) for v in values) + "]"


def session_filter_sql(params) -> str:
    conds = []
    if params.start_age not in (None, "") and params.end_age not in (None, ""):
        conds.append(f"coalesce(age BETWEEN {int(params.start_age)} AND {int(params.end_age)}, false)")
    if params.list_of("professionals"):
        conds.append(f"coalesce(list_contains({_sql_list(params.list_of('professionals'))}, professional), false)")
    if params.list_of("cities"):
        conds.append(f"coalesce(list_contains({_sql_list(params.list_of('cities'))}, city), false)")
    if params.sex:
        conds.append(f"coalesce(sex = {_q(params.sex)}, false)")
    if params.list_of("keywords"):
        conds.append(f"list_has_any(kw_list, {_sql_list(params.list_of('keywords'))})")
    if params.list_of("category_ids"):
        conds.append(f"list_has_any(cat_list, {_sql_list(params.list_of('category_ids'), True)})")
    return " AND ".join(conds) if conds else "true"


def profile_ctes(params) -> str:
    """actions, users, sess, profile, filtered."""
    return f"""{actions_cte(params.start_date, params.end_date)}, {USERS_CTE},
sess AS (
  SELECT session_id, min(user_id) AS user_id, min(action_time) AS start_ts, max(action_time) AS end_ts,
         count(*) AS step_length,
         coalesce(list_sort(list_distinct(list(search_keyword))), []) AS kw_list,
         coalesce(list_sort(list_distinct(list(click_category_id) FILTER (WHERE click_category_id <> -1))), []) AS cat_list
  FROM actions GROUP BY session_id
),
profile AS (
  SELECT s.session_id, s.user_id, strftime(s.start_ts, '%Y-%m-%d %H:%M:%S') AS start_time, s.start_ts,
         CAST(epoch(s.end_ts) - epoch(s.start_ts) AS BIGINT) AS visit_length, s.step_length,
         nullif(array_to_string(s.kw_list, ','), '') AS search_keywords,
         nullif(array_to_string(s.cat_list, ','), '') AS click_category_ids,
         s.kw_list, s.cat_list, u.age, u.professional, u.sex, u.city
  FROM sess s JOIN users u ON s.user_id = u.user_id
),
filtered AS (SELECT * FROM profile WHERE {session_filter_sql(params)})"""


PROFILE_SELECT = ("session_id, user_id, start_time, visit_length, step_length, search_keywords, "
                  "click_category_ids, age, professional, sex, city")


def session_profile_sql(params) -> str:
    return f"WITH {profile_ctes(params)}\nSELECT {PROFILE_SELECT} FROM profile"


def filtered_sessions_sql(params) -> str:
    return f"WITH {profile_ctes(params)}\nSELECT {PROFILE_SELECT} FROM filtered"


def session_lists_sql(params, part_values: int = 100000) -> str:
    digits = " ".join(f"WHEN n <= {part_values * 16 ** d} THEN {d}" for d in range(7))
    return f"""WITH {actions_cte(params.start_date, params.end_date)},
held AS (
  SELECT DISTINCT session_id, 'keyword' AS kind, search_keyword AS value FROM actions WHERE search_keyword IS NOT NULL
  UNION ALL
  SELECT DISTINCT session_id, 'category', CAST(click_category_id AS VARCHAR) FROM actions WHERE click_category_id <> -1
),
sized AS (SELECT *, count(*) OVER (PARTITION BY session_id, kind) AS n FROM held),
parted AS (SELECT *, left(md5(value), CASE {digits} ELSE 7 END) AS part FROM sized)
SELECT session_id, kind, part, count(*) AS n_values, string_agg(value, ',' ORDER BY value) AS values_text
FROM parted GROUP BY session_id, kind, part"""


def ratio_sql(a: str, n: str) -> str:
    """HALF_UP(a / n, 2) for non-negative integers, NULL when n = 0."""
    return f"CASE WHEN {n} = 0 THEN NULL ELSE ((200 * {a} + {n}) // (2 * {n})) / 100.0 END"


def length_report_sql(params) -> str:
    def cond(col, lo, hi):
        return f"{col} >= {lo}" if hi is None else f"{col} BETWEEN {lo} AND {hi}"
    counts = ["count(*) AS session_count"]
    counts += [f"count(*) FILTER (WHERE {cond('visit_length', lo, hi)}) AS v_{n}" for n, lo, hi in VISIT_BINS]
    counts += [f"count(*) FILTER (WHERE {cond('step_length', lo, hi)}) AS s_{n}" for n, lo, hi in STEP_BINS]
    ratios = ["session_count"]
    ratios += [f"{ratio_sql('v_' + n, 'session_count')} AS visit_length_{n}_ratio" for n, _, _ in VISIT_BINS]
    ratios += [f"{ratio_sql('s_' + n, 'session_count')} AS step_length_{n}_ratio" for n, _, _ in STEP_BINS]
    return (f"WITH {profile_ctes(params)},\nc AS (SELECT {', '.join(counts)} FROM filtered)\n"
            f"SELECT {', '.join(ratios)} FROM c")


def sample_ctes(params, total: int = 100, seed: str = "visitlens") -> str:
    return f"""{profile_ctes(params)},
s AS (SELECT *, strftime(start_ts, '%Y-%m-%d') AS d, hour(start_ts) AS h,
             md5(session_id || {_q(seed)}) AS hk FROM filtered),
hc AS (SELECT d, h, count(*) AS hour_n FROM s GROUP BY d, h),
dc AS (SELECT d, sum(hour_n) AS day_n FROM hc GROUP BY d),
nd AS (SELECT count(*) AS n_days FROM dc),
qt AS (SELECT hc.d, hc.h,
              least(CAST(floor((hc.hour_n / dc.day_n) * floor({total} / nd.n_days)) AS BIGINT), hc.hour_n) AS quota
       FROM hc JOIN dc ON hc.d = dc.d CROSS JOIN nd),
rk AS (SELECT s.*, row_number() OVER (PARTITION BY d, h ORDER BY hk, session_id) AS rn FROM s),
sample AS (SELECT rk.* FROM rk JOIN qt ON rk.d = qt.d AND rk.h = qt.h WHERE rk.rn <= qt.quota)"""


def session_sample_sql(params, total: int = 100, seed: str = "visitlens") -> str:
    return (f"WITH {sample_ctes(params, total, seed)}\n"
            "SELECT session_id, start_time, search_keywords, click_category_ids FROM sample")


def sample_detail_sql(params, total: int = 100, seed: str = "visitlens") -> str:
    return f"""WITH {sample_ctes(params, total, seed)}
SELECT user_id, session_id, page_id, strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time,
       search_keyword, click_category_id, click_product_id, order_category_ids, order_product_ids,
       pay_category_ids, pay_product_ids, city_id
FROM actions WHERE session_id IN (SELECT session_id FROM sample)"""


def category_counts_ctes(params) -> str:
    return f"""{profile_ctes(params)},
fa AS (SELECT * FROM actions WHERE session_id IN (SELECT session_id FROM filtered)),
tags AS (
  SELECT click_category_id AS cat, 'c' AS kind FROM fa WHERE click_category_id <> -1
  UNION ALL
  SELECT CAST(trim(unnest(string_split(order_category_ids, ','))) AS BIGINT), 'o' FROM fa WHERE order_category_ids IS NOT NULL
  UNION ALL
  SELECT CAST(trim(unnest(string_split(pay_category_ids, ','))) AS BIGINT), 'p' FROM fa WHERE pay_category_ids IS NOT NULL
),
cc AS (SELECT cat AS categoryid,
              count(*) FILTER (WHERE kind = 'c') AS click_count,
              count(*) FILTER (WHERE kind = 'o') AS order_count,
              count(*) FILTER (WHERE kind = 'p') AS pay_count
       FROM tags GROUP BY cat),
top AS (SELECT * FROM cc ORDER BY click_count DESC, order_count DESC, pay_count DESC, categoryid LIMIT 10)"""


def top_categories_sql(params) -> str:
    return f"WITH {category_counts_ctes(params)}\nSELECT categoryid, click_count, order_count, pay_count FROM top"


def top_sessions_sql(params) -> str:
    return f"""WITH {category_counts_ctes(params)},
ps AS (SELECT click_category_id AS categoryid, session_id, count(*) AS click_count
       FROM fa WHERE click_category_id IN (SELECT categoryid FROM top)
       GROUP BY click_category_id, session_id),
r AS (SELECT *, row_number() OVER (PARTITION BY categoryid ORDER BY click_count DESC, session_id) AS rn FROM ps)
SELECT categoryid, session_id, click_count FROM r WHERE rn <= 10"""


# --- page conversion ------------------------------------------------------------

def page_conversion_ctes(params) -> str:
    flow = params.page_flow()
    steps = ", ".join(f"({i + 1}, {a}, {b})" for i, (a, b) in enumerate(zip(flow, flow[1:])))
    return f"""{actions_cte(params.start_date, params.end_date)},
seq AS (SELECT page_id, lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, action_id) AS next_page
        FROM actions),
trans AS (SELECT page_id AS from_page, next_page AS to_page, count(*) AS n
          FROM seq WHERE next_page IS NOT NULL GROUP BY page_id, next_page),
steps(step, from_page, to_page) AS (VALUES {steps}),
sc AS (SELECT s.step, CAST(s.from_page AS BIGINT) AS from_page, CAST(s.to_page AS BIGINT) AS to_page,
              coalesce(t.n, 0) AS pair_count
       FROM steps s LEFT JOIN trans t ON s.from_page = t.from_page AND s.to_page = t.to_page),
st AS (SELECT count(*) AS n FROM actions WHERE page_id = {flow[0]}),
r AS (SELECT sc.*, coalesce(lag(pair_count) OVER (ORDER BY step), (SELECT n FROM st)) AS prev FROM sc)"""


def page_conversion_sql(params, rounded: bool = False) -> str:
    rate = ratio_sql("pair_count", "prev") if rounded else \
        "CASE WHEN prev = 0 THEN NULL ELSE pair_count / prev END"
    return (f"WITH {page_conversion_ctes(params)}\n"
            f"SELECT step, from_page, to_page, pair_count, {rate} AS rate FROM r")


def page_conversion_text_sql(params) -> str:
    return f"""WITH {page_conversion_ctes(params)},
rr AS (SELECT step, CAST(from_page AS VARCHAR) || '_' || CAST(to_page AS VARCHAR) || '='
              || coalesce(CAST({ratio_sql('pair_count', 'prev')} AS VARCHAR), 'null') AS t FROM r)
SELECT string_agg(t, '|' ORDER BY step) AS convert_rate FROM rr"""


# --- course jobs ----------------------------------------------------------------

def _day_int(day: str) -> int:
    return int(day.replace("-", ""))


def behaviour_cte(day: str | None) -> str:
    return f"""{course_cte(day, day, 'course')},
beh AS (SELECT uid, event_key, start_video_time, end_video_time, video_length,
               CAST(strftime(epoch_ms(event_time * 1000), '%Y%m%d') AS INTEGER) AS dt FROM course)"""


COMPLETED_SQL = "event_key = 'endVideo' AND end_video_time - start_video_time >= video_length"


def daily_study_sql(day: str | None) -> str:
    return f"""WITH {behaviour_cte(day)}
SELECT count(DISTINCT CASE WHEN event_key = 'startVideo' THEN uid END) AS watch_video_count,
       count(DISTINCT CASE WHEN {COMPLETED_SQL} THEN uid END) AS complete_video_count, dt
FROM beh WHERE {_day_cond(day)} (event_key = 'startVideo' OR {COMPLETED_SQL}) GROUP BY dt"""


def _day_cond(day: str | None) -> str:
    return f"dt = {_day_int(day)} AND" if day else ""


def daily_study_union_sql(day: str | None) -> str:
    return f"""WITH {behaviour_cte(day)}
SELECT CAST(sum(watch_video_count) AS BIGINT) AS watch_video_count,
       CAST(sum(complete_video_count) AS BIGINT) AS complete_video_count, dt FROM (
  SELECT count(DISTINCT uid) AS watch_video_count, 0 AS complete_video_count, dt
  FROM beh WHERE {_day_cond(day)} event_key = 'startVideo' GROUP BY dt
  UNION ALL
  SELECT 0, count(DISTINCT uid), dt FROM beh WHERE {_day_cond(day)} {COMPLETED_SQL} GROUP BY dt
) GROUP BY dt"""


def course_lines_cte() -> str:
    """Raw course lines (error events give 16 fields)."""
    key = "CASE " + " ".join(f"WHEN event_type = {_q(s)} THEN {_q(d)}" for s, d in COURSE_EVENT.items()) \
        + " ELSE event_type END"
    head = ("CAST(user_id AS VARCHAR), 'user' || CAST(user_id AS VARCHAR), "
            "CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END, '1', '0', 'ios', 'auto', 'wifi', "
            "'10.' || CAST(user_id % 8 AS VARCHAR) || '.' || CAST(event_id % 4 AS VARCHAR) || '.1', "
            "'199000' || lpad(CAST(user_id AS VARCHAR), 5, '0'), CAST(event_id % 2 AS VARCHAR), "
            f"'{VIDEO_LENGTH}', CAST(epoch_us(ts) // 1000000 AS VARCHAR), "
            "CAST(CASE WHEN event_type = 'click' THEN epoch_us(ts) // 1000000 + 6 * CAST(json_extract_string(props, '$.k') AS BIGINT) ELSE 0 END AS VARCHAR), "
            "'1.0'")
    return f"""lines AS (
  SELECT event_id, event_type, CASE WHEN event_type = 'error' THEN concat_ws(chr(9), {head}, {key})
              ELSE concat_ws(chr(9), {head}, {key}, CAST(epoch_us(ts) // 1000000 AS VARCHAR)) END AS value
  FROM events
),
valid AS (SELECT string_split(value, chr(9)) AS f FROM lines
          WHERE len(string_split(rtrim(value, chr(9)), chr(9))) = 17)"""


def clean_course_log_sql() -> str:
    parts = []
    for i in range(1, 18):
        if i == 2:
            parts.append("replace(f[2], chr(10), '')")
        elif i == 10:
            parts.append("CASE WHEN f[10] IS NOT NULL AND f[10] <> '' THEN substr(f[10], 1, 3) || substr(f[10], 8, 4) ELSE f[10] END")
        else:
            parts.append(f"f[{i}]")
    return f"WITH {course_lines_cte()}\nSELECT concat_ws(chr(9), {', '.join(parts)}) AS line FROM valid"


ORDER_PAGE = "SELECT uid, phone, event_time FROM course WHERE event_key = 'enterOrderPage'"


def _visits_in_time(first_day: str, late_days: int) -> tuple[str, str]:
    """Visits from ``first_day`` on are delivered first, the others after them:
    late if more than ``late_days`` before the last of the first. CTEs, late rows."""
    first = f"epoch(TIMESTAMP '{first_day}')"
    return (f"v AS ({ORDER_PAGE}),\nm AS (SELECT max(event_time) - {late_days * 86400} AS mark FROM v WHERE event_time >= {first})",
            f"event_time < {first} AND event_time < mark")


def late_visits_sql(first_day: str, late_days: int) -> str:
    ctes, late = _visits_in_time(first_day, late_days)
    return f"""WITH {course_cte()}, {ctes}
SELECT uid, phone, event_time, count(*) AS visits, strftime(epoch_ms(event_time * 1000), '%Y-%m-%d') AS dt
FROM v, m WHERE {late} GROUP BY uid, phone, event_time"""


def timely_followups_sql(first_day: str, late_days: int) -> str:
    ctes, late = _visits_in_time(first_day, late_days)
    return unpaid_followups_sql(before=f"{ctes},\n", visits=f"SELECT uid, phone, event_time FROM v, m WHERE NOT ({late})")


def unpaid_followups_sql(window_days: int = 4, slide_days: int = 2, min_visits: int = 2, before: str = "", visits: str = ORDER_PAGE) -> str:
    w, s = window_days * 86400, slide_days * 86400
    k = ", ".join(f"({i})" for i in range(-(-w // s)))
    return f"""WITH {course_cte()}, {VIP_CTE},
{before}o AS ({visits}),
wins AS (SELECT o.uid, o.phone, (o.event_time // {s}) * {s} - kk.k * {s} AS ws
         FROM o, (VALUES {k}) kk(k)),
c AS (SELECT uid, phone, ws, count(*) AS visits FROM wins
      WHERE ws + {w} > 0 GROUP BY uid, phone, ws HAVING count(*) > {min_visits})
SELECT DISTINCT uid, phone FROM c WHERE uid NOT IN (SELECT uid FROM vip_user)"""


def new_vips_sql(as_of: str | None = None, recent_days: int = 2) -> str:
    recent = ""
    if as_of is not None:
        recent = (f"WHERE epoch(TIMESTAMP '{as_of}') - epoch(CAST(dt AS TIMESTAMP)) < {recent_days * 86400}")
    return f"""WITH {course_cte()}, {IP_RANGES_CTE},
o AS (SELECT CAST(string_split(ip, '.')[1] AS BIGINT) * 16777216 + CAST(string_split(ip, '.')[2] AS BIGINT) * 65536
             + CAST(string_split(ip, '.')[3] AS BIGINT) * 256 + CAST(string_split(ip, '.')[4] AS BIGINT) AS ip_num,
             strftime(epoch_ms(event_time * 1000), '%Y-%m-%d') AS dt
      FROM course WHERE event_key = 'completeOrder'),
r AS (SELECT o.dt, coalesce(i.region, {_q(UNKNOWN_REGION)}) AS province
      FROM o LEFT JOIN ip_ranges i ON o.ip_num BETWEEN i.start_num AND i.end_num),
c AS (SELECT province, count(*) AS cnt, dt FROM r GROUP BY province, dt)
SELECT province, cnt, dt FROM c {recent}"""


def swept_ranges_sql() -> str:
    return """WITH e AS (
  SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 77077 ELSE user_id * 1000 + event_id * 7919 % 1000 END AS position FROM events)
SELECT e.event_id, CAST(e.position AS BIGINT) AS position, c.c_custkey
FROM e LEFT JOIN customer c ON e.position BETWEEN c.c_custkey * 1000 AND c.c_custkey * 1000 + c.c_custkey % 1000"""


# --- ad stream twins --------------------------------------------------------------

def _kept_clicks_cte() -> str:
    return f"""{ad_clicks_cte()}, {BLACKLIST_CTE},
kept AS (SELECT *, epoch_ms(ts_ms) AS ts FROM ad_clicks WHERE userid NOT IN (SELECT userid FROM blacklist))"""


def user_click_counts_sql() -> str:
    return f"""WITH {_kept_clicks_cte()}
SELECT strftime(ts, '%Y%m%d') AS date, userid, adid, count(*) AS click_count
FROM kept GROUP BY strftime(ts, '%Y%m%d'), userid, adid"""


def blacklist_after_batch_sql(threshold: int) -> str:
    return f"""WITH {_kept_clicks_cte()},
uc AS (SELECT strftime(ts, '%Y%m%d') AS date, userid, adid, count(*) AS click_count
       FROM kept GROUP BY strftime(ts, '%Y%m%d'), userid, adid)
SELECT userid FROM blacklist
UNION ALL
SELECT DISTINCT userid FROM uc WHERE click_count > {threshold} AND userid NOT IN (SELECT userid FROM blacklist)"""


def ad_stat_sql() -> str:
    return f"""WITH {_kept_clicks_cte()}
SELECT strftime(ts, '%Y%m%d') AS date, province, city, adid, count(*) AS click_count
FROM kept GROUP BY strftime(ts, '%Y%m%d'), province, city, adid"""


def province_top3_sql(n: int = 3) -> str:
    return f"""WITH {_kept_clicks_cte()},
p AS (SELECT strftime(ts, '%Y%m%d') AS date, province, adid, count(*) AS click_count
      FROM kept GROUP BY strftime(ts, '%Y%m%d'), province, adid),
r AS (SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, adid) AS rn FROM p)
SELECT date, province, adid, click_count FROM r WHERE rn <= {n}"""


def click_trend_sql(last_hour: bool = False) -> str:
    where = ""
    if last_hour:
        where = ("WHERE date_trunc('minute', ts) > "
                 "(SELECT date_trunc('minute', max(ts)) FROM kept) - INTERVAL 60 MINUTE")
    return f"""WITH {_kept_clicks_cte()},
m AS (SELECT date_trunc('minute', ts) AS mt, adid FROM kept {where})
SELECT strftime(mt, '%Y%m%d') AS date, strftime(mt, '%H') AS hour, strftime(mt, '%M') AS minute,
       adid, count(*) AS click_count
FROM m GROUP BY mt, adid"""


def blacklist_loop_sql(slices, threshold: int, what: str) -> str:
    """The ad stream batch by batch: who is listed after a batch is dropped from the next."""
    ctes = [BLACKLIST_CTE, "l0 AS (SELECT userid FROM blacklist)"]
    for i, (first, last) in enumerate(slices, 1):
        ctes.append(ad_clicks_cte(first, last).replace("ad_clicks AS", f"c{i} AS", 1))
        ctes.append(f"""n{i} AS (SELECT strftime(make_timestamp(ts_ms * 1000), '%Y%m%d') AS date, userid, adid, count(*) AS click_count
  FROM c{i} WHERE userid NOT IN (SELECT userid FROM l{i - 1}) GROUP BY ALL)""")
        ctes.append(f"l{i} AS (SELECT userid FROM l{i - 1} UNION SELECT userid FROM n{i} WHERE click_count > {threshold})")
    if what == "list":
        end = f"SELECT DISTINCT userid FROM l{len(slices)}"
    else:
        end = " UNION ALL ".join(f"SELECT date, userid, adid, click_count FROM n{i}" for i in range(1, len(slices) + 1))
    return "WITH " + ",\n".join(ctes) + "\n" + end


def _spoiled_ads_cte() -> str:
    return """s AS (SELECT event_id % 11 AS kind, ts, user_id, event_id,
       CAST(epoch_us(ts) // 1000 AS VARCHAR) AS ms,
       'P' || (user_id % 10) || ' C' || (user_id % 30) || ' ' || user_id AS rest,
       CAST(event_id % 5 AS VARCHAR) AS ad FROM events WHERE event_type = 'click')"""


def ad_rejects_sql() -> str:
    return f"""WITH {_spoiled_ads_cte()}
SELECT CASE kind WHEN 0 THEN '9223372036854775807 ' || rest || ' ' || ad WHEN 1 THEN '-1 ' || rest || ' ' || ad
  WHEN 2 THEN 'now ' || rest || ' ' || ad WHEN 3 THEN ms || ' ' || rest WHEN 4 THEN ms || ' ' || rest || ' ' || ad || ' ' || ad
  WHEN 5 THEN '' WHEN 7 THEN ms || ' ' || rest || ' ad7' END AS value
FROM s WHERE kind < 8"""


def spoiled_click_counts_sql() -> str:
    return f"""WITH {_spoiled_ads_cte()}
SELECT strftime(ts, '%Y%m%d') AS date, user_id AS userid, event_id % 5 AS adid, count(*) AS click_count
FROM s WHERE kind >= 8 GROUP BY ALL"""


def course_rejects_sql() -> str:
    """Error events are short already; the damage replaces or removes their last field, the event key."""
    return f"""WITH {course_lines_cte()},
k AS (SELECT event_id % 11 AS kind, value AS line, event_type FROM lines)
SELECT CASE kind WHEN 0 THEN regexp_replace(line, '[^\t]+$', '9223372036854775807') WHEN 1 THEN regexp_replace(line, '[^\t]+$', '-5')
  WHEN 2 THEN regexp_replace(line, '[^\t]+$', 'soon') WHEN 3 THEN regexp_replace(line, '[^\t]+$', '')
  WHEN 4 THEN line || chr(9) || 'more' WHEN 5 THEN '' WHEN 6 THEN NULL WHEN 7 THEN regexp_replace(line, '^[^\t]+', 'nobody')
  ELSE line END AS value
FROM k WHERE kind < 8 OR event_type = 'error'"""


def time_functions_sql() -> str:
    return """SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS parsed,
  strftime(ts, '%Y%m%d%H%M') AS minute_key, strftime(ts, '%Y-%m-%d_%H') AS date_hour,
  ts < date_trunc('day', ts) + INTERVAL 12 HOURS AS before_noon, ts > date_trunc('day', ts) + INTERVAL 12 HOURS AS after_noon,
  CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS BIGINT) AS second_of_day,
  strftime(ts, '%Y-%m-%d') AS day_of_key, strftime(ts, '%Y-%m-%d') AS day_of_epoch FROM events"""


def relative_days_sql() -> str:
    return "SELECT event_id, 1::INTEGER AS days_apart FROM events"


def text_functions_sql() -> str:
    return """SELECT event_id, event_id || ',' || user_id AS trimmed, lpad(CAST(event_id % 24 AS VARCHAR), 2, '0') AS padded,
  CAST(user_id AS VARCHAR) AS user_value, CAST(NULL AS VARCHAR) AS no_value, CAST(NULL AS VARCHAR) AS missing_value,
  'id=' || event_id || '|none=|user=x' AS set_value FROM events"""


def _days_sql(where: str = "") -> str:
    return f"""SELECT strftime(ts, '%Y-%m-%d') AS date, 'P' || (user_id % 10) AS province, count(*) AS n
FROM events WHERE event_type = 'click' {where} GROUP BY ALL"""


def appended_results_sql() -> str:
    return " UNION ALL ".join(f"SELECT 'run-{p}' AS taskid, * FROM ({_days_sql(f'AND event_id % 2 = {p}')})" for p in (0, 1))


def overwritten_by_key_sql() -> str:
    return f"""WITH a AS ({_days_sql('AND event_id % 2 = 0')}), b AS ({_days_sql('AND event_id % 2 = 1')})
SELECT * FROM b UNION ALL SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.date = a.date AND b.province = a.province)"""


def stored_sums_sql() -> str:
    return f"""WITH x AS ({_days_sql('AND event_id % 2 = 0')} UNION ALL {_days_sql('AND event_id % 2 = 1')} UNION ALL {_days_sql()})
SELECT date, province, CAST(sum(n) AS BIGINT) AS n FROM x GROUP BY ALL"""


def stored_by_minute_sql() -> str:
    part = """SELECT strftime(ts, '%Y%m%d') AS date, strftime(ts, '%H') AS hour, strftime(ts, '%M') AS minute, event_id % 5 AS adid,
  count(*) AS click_count FROM events WHERE event_type = 'click' AND event_id % 2 = {0} GROUP BY ALL"""
    return f"""WITH a AS ({part.format(0)}), b AS ({part.format(1)})
SELECT * FROM b UNION ALL SELECT * FROM a WHERE NOT EXISTS (
  SELECT 1 FROM b WHERE b.date = a.date AND b.hour = a.hour AND b.minute = a.minute AND b.adid = a.adid)"""


def counted_course_rejects_sql() -> str:
    """Files have no NULL lines."""
    return f"SELECT value, count(*) AS lines FROM ({course_rejects_sql()}) r WHERE value IS NOT NULL GROUP BY value"


def replaced_groups_sql() -> str:
    return f"""WITH a AS ({_days_sql()}), b AS ({_days_sql('AND user_id % 50 = 0')})
SELECT * FROM b UNION ALL SELECT * FROM a WHERE date NOT IN (SELECT date FROM b)"""


def written_text_sql() -> str:
    return clean_course_log_sql()


def written_day_table_sql() -> str:
    return daily_study_sql(None)


def saved_table_sql() -> str:
    return f"SELECT * FROM ({_days_sql()}) WHERE n > 1"
