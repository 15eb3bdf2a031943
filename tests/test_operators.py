"""Operators and the quirks of SURVEY §2.14 on hand-made tables."""

import bisect
import datetime as dt
import ipaddress
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from visitlens.functions import columns as C
from visitlens.functions import predicates as P
from visitlens.operators.rangejoin import ip_key, ipv4_to_long, range_lookup, range_lookup_plain, range_sweep
from visitlens.operators.sample import stratified_sample
from visitlens.operators.sequence import transition_counts
from visitlens.operators.session_fold import fold_sessions, length_ratios
from visitlens.operators.topn import top_n_per_group
from visitlens.params import TaskParams
from visitlens.plans.course import clean_lines
from visitlens.plans.session import session_category_counts


def _plain_pairs(df):
    w = Window.partitionBy("g").orderBy("t", "i")
    return {(r["a"], r["b"]): r["n"] for r in
            df.withColumn("b", F.lead("v").over(w)).where(F.col("b").isNotNull())
              .groupBy(F.col("v").alias("a"), "b").agg(F.count(F.lit(1)).alias("n")).collect()}


def test_transition_counts_hot_group_split(spark):
    # one group holds most rows and spans many slices; ties in t broken by i
    rows = [("hot", k // 3, k, (k * 7) % 5) for k in range(3000)]
    rows += [(f"g{j}", k, k, (j + k) % 5) for j in range(40) for k in range(j % 4 + 1)]
    df = spark.createDataFrame(rows, "g string, t long, i long, v long")
    got = transition_counts(df, "g", ["t", "i"], "v", partitions=16)
    pairs = {(r["from_value"], r["to_value"]): r["n"] for r in got.where("kind = 'pair'").collect()}
    assert pairs == _plain_pairs(df)
    visits = {r["from_value"]: r["n"] for r in got.where("kind = 'visit'").collect()}
    assert visits == {r["v"]: r["n"] for r in df.groupBy("v").agg(F.count(F.lit(1)).alias("n")).collect()}


def test_transition_counts_more_slices_than_rows(spark):
    df = spark.createDataFrame([("a", 1, 1, 1), ("a", 2, 2, 2), ("b", 1, 3, 3)], "g string, t long, i long, v long")
    got = transition_counts(df, "g", ["t", "i"], "v", partitions=32)
    assert {(r[1], r[2]): r[3] for r in got.where("kind = 'pair'").collect()} == {(1, 2): 1}


def test_range_lookup_equals_nested_loop(spark):
    ranges = spark.createDataFrame([(0, 99_999, "a"), (100_000, 400_000, "b"), (900_000, 905_000, "c")],
                                   "start_num long, end_num long, region string")
    keys = spark.createDataFrame([(k,) for k in range(0, 1_000_000, 7_919)] + [(None,)], "k long")
    fast = sorted(((r.k, r.region) for r in range_lookup(keys, "k", ranges, bucket_bits=14).collect()), key=str)
    slow = sorted(((r.k, r.region) for r in range_lookup_plain(keys, "k", ranges).collect()), key=str)
    assert fast == slow


def test_ipv4_to_long(spark):
    df = spark.createDataFrame([("10.1.2.3",), ("300.1.1.1",), ("x",)], "ip string")
    assert [r[0] for r in df.select(ipv4_to_long(F.col("ip"))).collect()] == [167838211, None, None]


def test_range_sweep_wide_ranges_hot_key(spark):
    """100,000 ranges from one address to 2^27 wide, a third of the keys equal."""
    rng, at, rows = random.Random(7), 0, []
    for i in range(100_000):
        first = at + rng.randrange(1, 50)
        at = first + (1 << 27 if i % 20_000 == 0 else rng.randrange(0, 4000))
        rows.append((first, at, i))
    starts = [r[0] for r in rows]

    def held(k):
        i = bisect.bisect_right(starts, k) - 1
        return rows[i][2] if i >= 0 and k <= rows[i][1] else None

    keys = [rng.randrange(at + 100) for _ in range(4000)] + [starts[5] + 1] * 2500 + [k for k in starts[:500]]
    keys += [0, at, at + 1]
    ranges = spark.createDataFrame(rows, "start_num long, end_num long, owner int")
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)] + [(-1, None)], "id int, k long")
    for parts in (3, 64):
        got = {r.id: r.owner for r in range_sweep(df, "k", ranges, partitions=parts).collect()}
        assert got == {i: held(k) for i, k in enumerate(keys)} | {-1: None}


def test_range_sweep_carries_over_empty_slices(spark):
    """One wide range and many keys: most slices have no start of their own."""
    ranges = spark.createDataFrame([(10, 10_000, "wide"), (20_000, 20_000, "point"), (None, 5, "no"), (9, 3, "no")],
                                   "start_num long, end_num long, k string")
    df = spark.range(0, 21_000, 7).withColumnRenamed("id", "k").unionByName(spark.createDataFrame([(14,), (14,)], "k long"))
    got = range_sweep(df, "k", ranges, partitions=40)
    assert got.columns == ["k", "start_num", "end_num", "k"] and got.count() == 3002
    rows = [(r[0], r[3]) for r in got.collect()]
    assert sum(k == 14 for k, _ in rows) == 3
    assert all(name == ("wide" if 10 <= k <= 10_000 else "point" if k == 20_000 else None) for k, name in rows)


def test_range_sweep_empty_tables(spark):
    ranges = spark.createDataFrame([(1, 5, "a"), (1, 9, "b")], "start_num long, end_num long, region string")
    df = spark.createDataFrame([(4,), (4,), (8,), (None,)], "k long")
    assert sorted((str(r.k), r.region) for r in range_sweep(df, "k", ranges).collect()) == \
        [("4", "b"), ("4", "b"), ("8", "b"), ("None", None)]
    assert [r.region for r in range_sweep(df, "k", ranges.limit(0)).collect()] == [None] * 4
    assert range_sweep(df.limit(0), "k", ranges).collect() == []


def test_range_sweep_of_addresses(spark):
    """IPv6 and IPv4 ranges in one table, by sort key."""
    nets = [ipaddress.ip_network(n) for n in ("2001:db8::/32", "2001:db9::/64", "fe80::/10", "10.0.0.0/8", "192.168.1.0/24")]
    ranges = spark.createDataFrame([(str(n[0]), str(n[-1]), str(n)) for n in nets], "a string, b string, net string")
    ranges = ranges.select(ip_key("a").alias("start_num"), ip_key("b").alias("end_num"), "net")
    ips = ["2001:db8::1", "2001:DB8:ffff:0:0:0:0:9", "2001:db9:0:1::", "::1", "febf::1", "10.255.0.1", "192.168.2.0", "::", "1::2::3",
           "12345::", "1:2:3", "1.2.3", None, ":1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7:8"]
    df = spark.createDataFrame([(x,) for x in ips], "ip string").withColumn("key", ip_key("ip"))

    def key(x):
        try:
            a = ipaddress.ip_address(x)
        except ValueError:
            return None
        return f"{int(a) + (0xffff << 32 if a.version == 4 else 0):032x}"

    def net(x):
        return next((str(n) for n in nets if key(x) and ipaddress.ip_address(x) in n), None)

    assert {r.ip: (r.key, r.net) for r in range_sweep(df, "key", ranges).collect()} == {x: (key(x), net(x)) for x in ips}


def test_top_n_ties_and_group_limit(spark):
    df = spark.createDataFrame([("x", 5, 3), ("x", 5, 1), ("x", 4, 2), ("y", 1, 9)], "g string, c long, id long")
    out = top_n_per_group(df, ["g"], [F.desc("c"), F.asc("id")], 2)
    assert sorted(tuple(r) for r in out.collect()) == [("x", 5, 1), ("x", 5, 3), ("y", 1, 9)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_fold_exact_distinct_keywords(spark):
    # Q1/Q2: exact distinct, sorted; a keyword inside another is kept
    t = dt.datetime(2024, 1, 1, 8, 0, 0)
    rows = [("s", 1, t, "新辣道鱼火锅", 3), ("s", 1, t + dt.timedelta(seconds=5), "火锅", 3),
            ("s", 1, t + dt.timedelta(seconds=9), None, 12), ("s", 1, t, "火锅", -1)]
    df = spark.createDataFrame(rows, "session_id string, user_id long, action_time timestamp, "
                                     "search_keyword string, click_category_id long")
    r = fold_sessions(df).collect()[0]
    assert r.search_keyword_list == ["新辣道鱼火锅", "火锅"][::-1] or r.search_keyword_list == sorted(["新辣道鱼火锅", "火锅"])
    assert r.click_category_list == [3, 12]
    assert r.visit_length == 9 and r.step_length == 4


def test_length_ratios_bins_and_empty(spark):
    df = spark.createDataFrame([(0, 1), (3, 3), (4, 4), (1801, 61), (30, 30), (31, 31)],
                               "visit_length long, step_length long")
    r = length_ratios(df).collect()[0]
    assert r.session_count == 6
    assert r.visit_length_1s_3s_ratio == 0.17  # 1/6 HALF_UP; 0 s is in no bin (Q4)
    assert r.visit_length_10s_30s_ratio == 0.17 and r.visit_length_30s_60s_ratio == 0.17
    assert r.step_length_60_ratio == 0.17 and r.step_length_1_3_ratio == 0.33
    empty = length_ratios(df.where("false")).collect()[0]
    assert empty.session_count == 0 and empty.visit_length_1s_3s_ratio is None  # Q5


def test_predicates_unset_and_missing(spark):
    df = spark.createDataFrame([(25, ["kw1"]), (None, []), (60, None)], "age int, kws array<string>")
    assert P.in_range("age", 20, None) is None  # Q6: one bound -> pass
    kept = df.where(P.all_of([P.in_range("age", 20, 50)])).count()
    assert kept == 1
    assert df.where(P.overlaps("kws", ["kw1", "kw2"])).count() == 1
    assert df.where(P.all_of([P.overlaps("kws", [])])).count() == 3


def test_session_filter_categories_use_click_list(spark):
    # Q3 fixed: the category parameter tests the click category list
    df = spark.createDataFrame([(30, "a", "c", "m", [], [5]), (30, "a", "c", "m", [], [6])],
                               "age int, professional string, city string, sex string, "
                               "search_keyword_list array<string>, click_category_list array<bigint>")
    p = TaskParams(category_ids="5,9")
    assert df.where(P.session_filter(p)).count() == 1


def test_stratified_sample_quota_and_subset(spark):
    rows = [(f"s{i}", "2024-01-01" if i % 3 else "2024-01-02", i % 5) for i in range(300)]
    df = spark.createDataFrame(rows, "session_id string, d string, h int")
    out = stratified_sample(df, "d", "h", "session_id", total=40)
    got = out.collect()
    assert {r.session_id for r in got} <= {r[0] for r in rows}
    per_day = {}
    for r in got:
        per_day[r.d] = per_day.get(r.d, 0) + 1
    assert all(v <= 20 for v in per_day.values())
    # deterministic
    assert sorted(r.session_id for r in out.collect()) == sorted(r.session_id for r in got)


def test_category_counts_explodes_lists(spark):
    df = spark.createDataFrame([(3, None, None), (-1, "3,4", None), (-1, None, "4"), (-1, "x,4", None)],
                               "click_category_id long, order_category_ids string, pay_category_ids string")
    got = {r.categoryid: (r.click_count, r.order_count, r.pay_count) for r in session_category_counts(df.withColumn('session_id', F.lit('s'))).collect()}
    assert got == {3: (1, 1, 0), 4: (0, 2, 1)}


def test_clean_lines_rules(spark):
    good = "\t".join(["1", "us\ner", "F", "1", "0", "ios", "a", "w", "10.0.0.1", "18701410000",
                      "1", "300", "5", "9", "1.0", "startVideo", "100"])
    trailing_empty = "\t".join(good.split("\t")[:16] + [""])  # Q30: rejected
    short = "\t".join(good.split("\t")[:16])
    df = spark.createDataFrame([(good,), (trailing_empty,), (short,)], "value string")
    out = [r.line.split("\t") for r in clean_lines(df).collect()]
    assert len(out) == 1
    assert out[0][9] == "1870000" and out[0][1] == "user"


def test_scalar_helpers(spark):
    df = spark.createDataFrame([("2024-01-05 7:03:09", "a=1|b=|c=x")], "t string, kv string")
    r = df.select(C.format_time(C.parse_time("t")).alias("t"), C.kv_field("kv", "c").alias("c"),
                  C.kv_field("kv", "b").alias("b"), C.mask_phone(F.lit("18701410000")).alias("m"),
                  C.pad2(F.lit(7)).alias("p"), C.trim_commas(F.lit(",1,2,")).alias("tc"),
                  C.date_hour_key(C.parse_time("t")).alias("dh")).collect()[0]
    assert r.t == "2024-01-05 07:03:09" and r.c == "x" and r.b is None
    assert r.m == "1870000" and r.p == "07" and r.tc == "1,2" and r.dh == "2024-01-05_07"


def test_time_and_kv_helpers(spark):
    df = spark.createDataFrame([("a=1|b=2", 1704153600, "20240102", "bad")], "kv string, sec long, dk string, bad string")
    r = df.select(C.kv_set("kv", "b", F.lit("9")).alias("kv"), C.kv_set("kv", "c", F.lit("3")).alias("kv2"),
                  C.epoch_seconds_to_date("sec").cast("string").alias("d"),
                  C.parse_date_key("dk").cast("string").alias("dk"), C.parse_date_key("bad").alias("bad"),
                  C.is_before(C.parse_date_key("dk"), F.lit("2024-01-03").cast("date")).alias("before"),
                  C.seconds_between(F.lit("2024-01-01 00:00:00").cast("timestamp"),
                                    F.lit("2024-01-01 00:01:05").cast("timestamp")).alias("secs"),
                  (C.yesterday() < C.today()).alias("order")).collect()[0]
    assert r.kv == "a=1|b=9" and r.kv2 == "a=1|b=2|c=3"
    assert r.d == "2024-01-02" and r.dk == "2024-01-02" and r.bad is None
    assert r.before and r.secs == 65 and r.order


def test_transition_counts_null_value_is_not_a_slice_end(spark):
    # a NULL value inside a slice must not be taken for the slice's last row
    rows = [("s", k, k, None if k == 5 else k % 3) for k in range(40)]
    df = spark.createDataFrame(rows, "g string, t long, i long, v long")
    got = transition_counts(df, "g", ["t", "i"], "v", partitions=4)
    pairs = {(r.from_value, r.to_value): r.n for r in got.where("kind = 'pair'").collect()}
    w = Window.partitionBy("g").orderBy("t", "i")
    want = {(r.a, r.b): r.n for r in
            df.withColumn("b", F.lead("v").over(w)).where(F.col("v").isNotNull() & F.col("b").isNotNull())
              .groupBy(F.col("v").alias("a"), "b").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert pairs == want


def test_log_lines_with_bad_numbers(spark):
    from visitlens.sources.logs import course_rejects, log_time, parse_course_lines
    from pyspark.sql import functions as F
    texts = ["0", "253402300799", "253402300800", "9223372036854775807", "-1", "1.5", "", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(
        log_time(F.col("t")).isNotNull().alias("s"), log_time(F.concat("t", F.lit("000")), 1000).isNotNull().alias("ms")).collect()
    assert [r.s for r in got] == [True, True] + [False] * 6
    assert [r.ms for r in got] == [True, True] + [False] * 6 or [r.ms for r in got][:3] == [True, True, False]
    line = "\t".join(["1", "u", "F", "1", "0", "ios", "a", "w", "10.0.0.1", "199", "0", "300", "5", "0", "1.0", "endVideo"])
    rows = [f"{line}\t{t}" for t in ("5", "9223372036854775807", "-3", "x")] + [line, "", None, f"{line}\t5".replace("1", "x", 1)]
    lines = spark.createDataFrame([(r,) for r in rows], "value string")
    assert parse_course_lines(lines).count() == 1 and course_rejects(lines).count() == 7


def test_study_counts_agree_on_a_day_with_neither_event(spark):
    from visitlens.plans.course import study_counts, study_counts_union
    rows = [(1, "startVideo", 0, 0, 300, 20240101), (1, "endVideo", 0, 300, 300, 20240101), (2, "endVideo", 0, 10, 300, 20240102),
            (3, "enterOrderPage", 0, 0, 300, 20240103), (None, "startVideo", 0, 0, 300, 20240104), (4, None, 0, 0, 300, 20240105)]
    t = spark.createDataFrame(rows, "uid long, event_key string, start_video_time long, end_video_time long, video_length long, dt int")
    one, two = (sorted(map(tuple, f(t, None).collect())) for f in (study_counts, study_counts_union))
    assert one == two == [(0, 0, 20240104), (1, 1, 20240101)]


def test_sample_of_large_strata(spark):
    """A quota above every partial limit; the groups before the cut are taken whole."""
    from visitlens.operators import sample
    df = spark.range(40_000).selectExpr("'d' as d", "CASE WHEN id % 4 = 0 THEN 1 ELSE 2 END as h", "concat('s', id) as session_id")
    got = sample.stratified_sample(df, "d", "h", "session_id", total=8000)
    ranked = df.withColumn("o", sample.sample_order("session_id", "visitlens")).toPandas().sort_values(["o", "session_id"])
    want = {s for h, n in ((1, 2000), (2, 6000)) for s in ranked[ranked.h == h].session_id[:n]}
    assert {r.session_id for r in got.collect()} == want and got.count() == 8000
