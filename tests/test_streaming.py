"""Streams: blacklist loop, replay idempotence, restart from checkpoint."""

import os
import uuid

from visitlens.plans.ads import province_top3
from visitlens.session import checkpoint_dir
from visitlens.sources.logs import read_text_stream
from visitlens.streaming.ads import AdTables, process_ad_batch, start_ad_stream

DAY = 1704067200000  # 2024-01-01 00:00:00 UTC in ms


def _lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def _click(user, ad, minute=0, province="P1", city="C1"):
    return f"{DAY + minute * 60_000} {province} {city} {user} {ad}"


def test_blacklist_loop_and_replay(spark):
    root = f"{checkpoint_dir(spark)}/ads-{uuid.uuid4().hex}"
    t = AdTables.at(spark, root)
    t.seed_blacklist(spark.createDataFrame([(9,), (73,)], "userid long"))
    b0 = _lines(spark, [_click(5, 1), _click(5, 1), _click(6, 1), _click(9, 1), "junk line"])
    process_ad_batch(t, b0, 0, threshold=1)
    assert sorted(r.userid for r in t.blacklist.read().collect()) == [5, 9, 73]
    assert [(r.value, r.batch_id) for r in t.rejects().collect()] == [("junk line", 0)]
    counts = {(r.userid, r.adid): r.click_count for r in t.user_clicks.read().collect()}
    assert counts == {(5, 1): 2, (6, 1): 1}  # listed user 9 filtered first
    b1 = _lines(spark, [_click(5, 2, 1), _click(6, 1, 2), _click(6, 2, 3)])
    process_ad_batch(t, b1, 1, threshold=1)
    counts = {(r.userid, r.adid): r.click_count for r in t.user_clicks.read().collect()}
    assert counts == {(5, 1): 2, (6, 1): 2, (6, 2): 1}  # user 5 listed after batch 0
    assert sorted(r.userid for r in t.blacklist.read().collect()) == [5, 6, 9, 73]
    names = ("user_clicks", "ad_stat", "trend", "blacklist")
    before = {name: sorted(tuple(r) for r in getattr(t, name).read().collect()) for name in names}
    process_ad_batch(t, b1, 1, threshold=1)  # replayed batch: same tables (Q16)
    after = {name: sorted(tuple(r) for r in getattr(t, name).read().collect()) for name in before}
    assert before == after
    assert sorted(tuple(r) for r in t.province_top3().collect()) == [("20240101", "P1", 1, 4),
                                                                           ("20240101", "P1", 2, 1)]


def test_restart_from_checkpoint(spark):
    root = f"{checkpoint_dir(spark)}/ads-{uuid.uuid4().hex}"
    src = f"{root}/in"
    os.makedirs(src, exist_ok=True)
    t = AdTables.at(spark, f"{root}/tables")
    t.seed_blacklist(spark.createDataFrame([], "userid long"))

    def drop(name, rows):
        with open(f"{src}/.{name}", "w") as fh:
            fh.write("\n".join(rows) + "\n")
        os.rename(f"{src}/.{name}", f"{src}/{name}")

    drop("a.txt", [_click(1, 1), _click(2, 1)])
    drop("b.txt", [_click(1, 1, 5)])
    q = start_ad_stream(read_text_stream(spark, src, 1), t, f"{root}/ckpt", available_now=True)
    q.awaitTermination()
    drop("c.txt", [_click(3, 2, 7), _click(1, 1, 7)])
    q = start_ad_stream(read_text_stream(spark, src, 1), t, f"{root}/ckpt", available_now=True)
    q.awaitTermination()
    stat = {(r.adid,): r.click_count for r in t.ad_stat.read().collect()}
    assert stat == {(1,): 4, (2,): 1}
    assert t.ad_stat.rows().select("batch").distinct().count() == 3  # one folder per micro-batch


def _course_line(uid, event_key, epoch_s, phone="18701400001"):
    fields = [str(uid), f"user{uid}", "F", "1", "0", "ios", "auto", "wifi", "10.0.0.1", phone,
              "0", "300", str(epoch_s), "0", "1.0", event_key, str(epoch_s)]
    return "\t".join(fields)


def test_unpaid_stream_window_and_late_rows(spark):
    from visitlens.streaming.orders import start_unpaid_stream, unpaid_table

    root = f"{checkpoint_dir(spark)}/unpaid-{uuid.uuid4().hex}"
    src = f"{root}/in"
    os.makedirs(src, exist_ok=True)
    day = 86400
    t0 = 1704067200  # 2024-01-01 UTC

    def drop(name, rows, mtime):
        with open(f"{src}/.{name}", "w") as fh:
            fh.write("\n".join(rows) + "\n")
        os.rename(f"{src}/.{name}", f"{src}/{name}")
        os.utime(f"{src}/{name}", (mtime, mtime))

    # user 1: three order-page visits inside one 4-day window -> listed
    # user 2: VIP with three visits -> not listed
    # user 3: two visits; its windows are evicted (file c advances past the
    #         watermark); a third visit arriving afterwards starts a window
    #         of late rows only -> never listed
    drop("a.txt", [_course_line(1, "enterOrderPage", t0 + 10), _course_line(1, "enterOrderPage", t0 + 20),
                   _course_line(2, "enterOrderPage", t0 + 10), _course_line(2, "enterOrderPage", t0 + 20),
                   _course_line(2, "enterOrderPage", t0 + 30), _course_line(3, "enterOrderPage", t0 + 10),
                   _course_line(3, "enterOrderPage", t0 + 20), _course_line(1, "startVideo", t0 + 5)], 1_000)
    drop("b.txt", [_course_line(1, "enterOrderPage", t0 + 30), _course_line(4, "enterOrderPage", t0 + 20 * day)],
         2_000)
    drop("c.txt", [_course_line(5, "enterOrderPage", t0 + 21 * day)], 3_000)
    drop("d.txt", [_course_line(3, "enterOrderPage", t0 + 40)], 4_000)  # late, after eviction
    vip = spark.createDataFrame([(2, 2)], "id long, uid long")
    table = unpaid_table(spark, f"{root}/unpayment_record")
    q = start_unpaid_stream(read_text_stream(spark, src, 1), lambda: vip, table, f"{root}/ckpt",
                            watermark="4 days", available_now=True)
    q.awaitTermination()
    assert sorted(r.uid for r in table.read().collect()) == [1]
    state_rows = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress]
    assert state_rows[-1] <= 4  # only the late window and user 5's windows are left in state


def test_visits_in_time_and_late_ones_add_up(spark):
    """Batches of shuffled visits, one replayed, one merged: each visit is counted
    in all its windows or stands in the late table."""
    import random
    from visitlens.streaming.visits import VisitTables, process_visit_batch

    rng, t0, day = random.Random(3), 1704067200, 86400
    root = f"{checkpoint_dir(spark)}/visits-{uuid.uuid4().hex}"
    tables = VisitTables.at(spark, root, merge_every=2, buckets=2)
    vip = spark.createDataFrame([(2, 2)], "id long, uid long")
    late, counts, seen = [], {}, None
    for n in range(5):
        visits = [(rng.randrange(1, 5), t0 + (5 * n + rng.randrange(-14, 5)) * day + 60 * day) for _ in range(30)]
        if n == 3:
            visits = []
        lines = spark.createDataFrame([(_course_line(u, "enterOrderPage", t),) for u, t in visits] + [("spoiled",)], "value string")
        for _ in range(2 if n in (2, 4) else 1):  # the same batch again
            process_visit_batch(tables, lines, vip, n, "4 days", "2 days", 3, "6 days", "run")
        for u, t in visits:
            if seen is not None and t < seen - 6 * day:
                late.append((u, t))
            else:
                for start in range(t - t % (2 * day) - 2 * day, t + 1, 2 * day):
                    counts[start, u] = counts.get((start, u), 0) + 1
        seen = max([t for _, t in visits] + ([seen] if seen is not None else []))
    got = {(r.uid, r.event_time): r.visits for r in tables.late.read().collect()}
    assert late and got == {k: late.count(k) for k in late}
    assert {(r.window_start, r.uid): r.visits for r in tables.counts.read().collect()} == counts
    assert {r.uid for r in tables.members.read().collect()} == {u for (_, u), n in counts.items() if n > 3 and u != 2}
    # two windows a visit: kept and late ones are all of them
    assert sum(counts.values()) // 2 + len(late) == 120
    process_visit_batch(tables, lines, vip, 0, "4 days", "2 days", 3, "6 days", "run")  # the totals have it
    assert sum(r.visits for r in tables.counts.read().collect()) == sum(counts.values())


def test_vip_stream_counts_late_rows_on_their_day(spark):
    from visitlens.sources.fixtures import ip_ranges
    from visitlens.streaming.orders import start_vip_stream, vip_table

    root = f"{checkpoint_dir(spark)}/vip-{uuid.uuid4().hex}"
    src = f"{root}/in"
    os.makedirs(src, exist_ok=True)
    t0, day = 1704067200, 86400
    for i, (rows, mtime) in enumerate([
            ([_course_line(1, "completeOrder", t0 + 5), _course_line(2, "completeOrder", t0 + 6)], 1_000),
            ([_course_line(1, "completeOrder", t0 + 9 * day)], 2_000),
            ([_course_line(3, "completeOrder", t0 + 7)], 3_000)]):  # late for day 1
        with open(f"{src}/f{i}.txt", "w") as fh:
            fh.write("\n".join(rows) + "\n")
        os.utime(f"{src}/f{i}.txt", (mtime, mtime))
    table = vip_table(spark, f"{root}/vip")
    q = start_vip_stream(read_text_stream(spark, src, 1), ip_ranges(spark), table, f"{root}/ckpt",
                         ranges_bound=6, available_now=True)
    q.awaitTermination()
    got = sorted(tuple(r) for r in table.read().collect())
    assert got == [("北京", 1, "2024-01-10"), ("北京", 3, "2024-01-01")]


def test_table_readers(spark):
    from visitlens.streaming.ads import recent_trend
    from visitlens.streaming.orders import recent_days
    rows = [("20240101", "23", f"{m:02d}", 1, 1) for m in range(0, 60, 10)]
    rows += [("20240102", "00", "30", 1, 5), ("20231231", "23", "59", 2, 9)]
    trend = spark.createDataFrame(rows, "date string, hour string, minute string, adid long, click_count long")
    got = sorted((r.date, r.hour, r.minute) for r in recent_trend(trend, 60).collect())
    # latest minute 2024-01-02 00:30 -> minutes after 23:30 the day before
    assert got == [("20240101", "23", "40"), ("20240101", "23", "50"), ("20240102", "00", "30")]
    vips = spark.createDataFrame([("P", 1, "2024-01-28"), ("P", 2, "2024-01-29"), ("P", 3, "2024-01-30")],
                                 "province string, cnt long, dt string")
    assert sorted(r.dt for r in recent_days(vips, "2024-01-30 12:00:00").collect()) == ["2024-01-29", "2024-01-30"]


def test_bad_numbers_do_not_stop_the_stream(spark):
    root = f"{checkpoint_dir(spark)}/ads-{uuid.uuid4().hex}"
    t = AdTables.at(spark, root)
    bad = ["9223372036854775807 P1 C1 1 2", "-1 P1 C1 1 2", "x P1 C1 1 2", "", None]
    process_ad_batch(t, _lines(spark, [*bad, _click(1, 1)]), 0)
    assert sum(r.click_count for r in t.ad_stat.read().collect()) == 1
    assert sorted(str(r.value) for r in t.rejects().collect()) == sorted(map(str, bad))


def test_a_new_checkpoint_adds_to_the_tables(spark):
    root = f"{checkpoint_dir(spark)}/ads-{uuid.uuid4().hex}"
    t = AdTables.at(spark, f"{root}/tables")
    for run, clicks in (("a", 4), ("b", 1)):
        os.makedirs(f"{root}/{run}")
        with open(f"{root}/{run}/f.txt", "w") as fh:
            fh.write("\n".join([_click(1, 1)] * clicks) + "\n")
        start_ad_stream(read_text_stream(spark, f"{root}/{run}"), t, f"{root}/ckpt-{run}", available_now=True).awaitTermination()
    assert [r.click_count for r in t.user_clicks.read().collect()] == [5]


def test_a_vip_added_between_batches_counts(spark):
    from visitlens.streaming.orders import start_unpaid_stream, unpaid_table

    root = f"{checkpoint_dir(spark)}/unpaid-{uuid.uuid4().hex}"
    os.makedirs(f"{root}/in")
    table, vips = unpaid_table(spark, f"{root}/out"), f"{root}/vips"
    spark.createDataFrame([(9, 9)], "id long, uid long").write.parquet(vips)
    for n, uid in enumerate((1, 2)):
        with open(f"{root}/in/{n}.txt", "w") as fh:
            fh.write("\n".join(_course_line(uid, "enterOrderPage", 1704067200 + i) for i in range(3)) + "\n")
        start_unpaid_stream(read_text_stream(spark, f"{root}/in", 1), lambda: spark.read.parquet(vips), table, f"{root}/ckpt",
                            watermark="4 days", available_now=True).awaitTermination()
        spark.createDataFrame([(2, 2)], "id long, uid long").write.mode("append").parquet(vips)
    assert [r.uid for r in table.read().collect()] == [1]


def test_top3_is_kept_up_by_group(spark):
    """Only the (day, province) groups of a batch are replaced."""
    t = AdTables.at(spark, f"{checkpoint_dir(spark)}/ads-{uuid.uuid4().hex}", merge_every=1)
    t.seed_blacklist(spark.createDataFrame([], "userid long"))
    for n, rows in enumerate([[_click(1, ad, province=p) for p in ("P1", "P2") for ad in (1, 2, 3) for _ in range(ad)],
                              [_click(2, 4, province="P1")] * 9, [_click(2, 1, province="P1")] * 4]):
        process_ad_batch(t, _lines(spark, rows), n)
        want = sorted(tuple(r) for r in province_top3(t.ad_stat.read()).collect())
        assert sorted(tuple(r) for r in t.province_top3().collect()) == want
    assert ("20240101", "P1", 4, 9) in want and ("20240101", "P2", 3, 3) in want
    before = want
    process_ad_batch(t, _lines(spark, rows), 2)  # a replay
    process_ad_batch(t, _lines(spark, rows), 0)  # one that the totals have
    assert sorted(tuple(r) for r in t.province_top3().collect()) == before


def test_stream_state_overwrites_changed_rows(spark):
    """Minute counts from state: a late click within the watermark changes its
    minute, one beyond it is dropped and shows in the query's progress."""
    from visitlens.streaming.ads import start_trend_stream, trend_state_table

    root = f"{checkpoint_dir(spark)}/state-{uuid.uuid4().hex}"
    os.makedirs(f"{root}/in")
    table = trend_state_table(spark, f"{root}/trend")
    for n, rows in enumerate([[_click(1, 1), _click(1, 1)], [_click(1, 1, 10), _click(1, 1)], [_click(1, 1, 500)], [_click(1, 1, 501)], [_click(1, 1)]]):
        with open(f"{root}/in/{n}.txt", "w") as fh:
            fh.write("\n".join(rows) + "\n")
        query = start_trend_stream(read_text_stream(spark, f"{root}/in", 1), spark.createDataFrame([], "userid long"), table,
                                   f"{root}/ckpt", "30 minutes", available_now=True)
        query.awaitTermination()
    got = {(r["hour"], r["minute"]): r["click_count"] for r in table.read().collect()}
    assert got == {("00", "00"): 3, ("00", "10"): 1, ("08", "20"): 1, ("08", "21"): 1}
    assert sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]) == 1


def test_course_rejects_are_counted(spark):
    from visitlens.streaming.orders import reject_table, start_rejects_stream

    root = f"{checkpoint_dir(spark)}/rejects-{uuid.uuid4().hex}"
    os.makedirs(f"{root}/in")
    table = reject_table(spark, f"{root}/out", merge_every=1)
    good = _course_line(1, "completeOrder", 1704067200)
    for n, rows in enumerate([[good, "junk", "junk"], ["junk", good + "\tmore"], [good]]):
        with open(f"{root}/in/{n}.txt", "w") as fh:
            fh.write("\n".join(rows) + "\n")
    start_rejects_stream(read_text_stream(spark, f"{root}/in", 1), table, f"{root}/ckpt", available_now=True).awaitTermination()
    assert sorted(tuple(r) for r in table.read().collect()) == sorted([("junk", 3), (good + "\tmore", 1)])
