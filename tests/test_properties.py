"""Randomised checks against brute force on small fixtures."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from visitlens.operators.sample import stratified_sample
from visitlens.operators.sequence import transition_counts

ROWS = st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b", "c"]),
                          st.integers(0, 30), st.integers(0, 4)), min_size=1, max_size=120)


def brute_pairs(rows):
    groups = {}
    for i, (g, t, v) in enumerate(rows):
        groups.setdefault(g, []).append((t, i, v))
    pairs = Counter()
    for items in groups.values():
        items.sort()
        for (_, _, a), (_, _, b) in zip(items, items[1:]):
            pairs[(a, b)] += 1
    return dict(pairs)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS, parts=st.integers(1, 24))
def test_transition_counts_random(spark, rows, parts):
    df = spark.createDataFrame([(g, t, i, v) for i, (g, t, v) in enumerate(rows)],
                               "g string, t long, i long, v long")
    got = transition_counts(df, "g", ["t", "i"], "v", partitions=parts)
    pairs = {(r.from_value, r.to_value): r.n for r in got.where("kind = 'pair'").collect()}
    assert pairs == brute_pairs(rows)
    visits = {r.from_value: r.n for r in got.where("kind = 'visit'").collect()}
    assert visits == dict(Counter(v for _, _, v in rows))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(sizes=st.lists(st.integers(1, 60), min_size=1, max_size=6), total=st.integers(1, 50))
def test_stratified_sample_quota(spark, sizes, total):
    rows = [(f"s{k}-{j}", f"2024-01-0{1 + k % 3}", k) for k, n in enumerate(sizes) for j in range(n)]
    df = spark.createDataFrame(rows, "session_id string, d string, h int")
    got = stratified_sample(df, "d", "h", "session_id", total=total).collect()
    hours, days = Counter((d, h) for _, d, h in rows), Counter(d for _, d, _ in rows)
    per_day = total // len(days)
    chosen = Counter((r.d, r.h) for r in got)
    for key, n in hours.items():
        assert chosen.get(key, 0) == min(int(n / days[key[0]] * per_day), n)


def test_report_properties(spark):
    """SURVEY §5 (4): ratios in [0, 1], top-n ordered and capped."""
    import __spark_entry__ as entry
    from conftest import SF_CHECK
    q = entry.queries()
    r = q["b3_length_ratios"](spark, SF_CHECK).collect()[0].asDict()
    assert all(0.0 <= v <= 1.0 for k, v in r.items() if k.endswith("_ratio"))
    visit = sum(v for k, v in r.items() if k.startswith("visit_length_"))
    assert visit <= 1.0 + 0.05  # rounding of nine shares; 0 s visits are in no bin (Q4)
    cats = q["b6_top10_categories"](spark, SF_CHECK).collect()
    keys = [(-c.click_count, -c.order_count, -c.pay_count, c.categoryid) for c in cats]
    assert len(cats) == 10 and keys == sorted(keys)
    sess = q["b7_top10_sessions"](spark, SF_CHECK).collect()
    per_cat = Counter(s.categoryid for s in sess)
    assert set(per_cat) <= {c.categoryid for c in cats} and max(per_cat.values()) <= 10
    top3 = q["b10_area_top3"](spark, SF_CHECK).collect()
    assert max(Counter(t.area for t in top3).values()) <= 3
    rates = [p.rate for p in q["b8_page_conversion"](spark, SF_CHECK).collect() if p.rate is not None]
    assert all(x >= 0 for x in rates)


KV = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(1, 9)), max_size=12)


def _unique(rows):
    out = {}
    for g, k, n in rows:
        out[(g, k)] = n
    return [(g, k, n) for (g, k), n in out.items()]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(old=KV, delta=KV)
def test_merge_meanings_random(spark, old, delta):
    from visitlens.sinks.tables import append_new, merge_add, merge_overwrite, replace_groups
    old = _unique(old)
    schema = "g long, k long, n long"
    o, d = spark.createDataFrame(old, schema), spark.createDataFrame(delta, schema)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    # add: sums per key
    want = Counter({(g, k): n for g, k, n in old})
    for g, k, n in delta:
        want[(g, k)] += n
    assert rows(merge_add(o, d, ["g", "k"], "n")) == sorted((g, k, n) for (g, k), n in want.items())
    # overwrite: delta rows replace equal keys (delta made unique first)
    du = _unique(delta)
    dd = spark.createDataFrame(du, schema)
    keys = {(g, k) for g, k, _ in du}
    assert rows(merge_overwrite(o, dd, ["g", "k"])) == sorted([r for r in old if (r[0], r[1]) not in keys] + du)
    # replace groups: every group of delta is replaced whole
    groups = {g for g, _, _ in delta}
    assert rows(replace_groups(o, d, ["g"])) == sorted([r for r in old if r[0] not in groups] + list(delta))
    # insert new only: existing keys keep their row, new keys once
    got = rows(append_new(o, d, ["g", "k"]))
    assert {(g, k) for g, k, _ in got} == {(g, k) for g, k, _ in old} | {(g, k) for g, k, _ in delta}
    assert all(r in got for r in old) and len(got) == len({(g, k) for g, k, _ in got})
