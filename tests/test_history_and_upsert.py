import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfline.operators import history
from shelfline.operators.intervals import allocate_in_order, as_of_version, overlap_pairs
from shelfline.operators.upsert import append_unseen, merge_columns, merge_upsert

SCHEMA = "id string, name string, status string, effective date"
D = dt.date


def feed(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def apply(state, df):
    return history.apply_history(state, df, "id", ["name", "status"], "effective")


def test_three_loads(spark):
    s = apply(None, feed(spark, ("a", "A", "x", D(2024, 1, 1)), ("b", "B", "x", D(2024, 1, 1))))
    s = apply(s, feed(spark, ("a", "A2", "x", D(2024, 2, 1)), ("b", "B", "x", D(2024, 2, 1)), ("c", "C", "x", D(2024, 2, 1))))
    s = apply(s, feed(spark, ("a", "A3", "x", D(2024, 3, 1))))
    rows = sorted((r.id, r.name, r.valid_from, r.valid_to, r.is_current) for r in s.collect())
    assert rows == [
        ("a", "A", D(2024, 1, 1), D(2024, 2, 1), False), ("a", "A2", D(2024, 2, 1), D(2024, 3, 1), False),
        ("a", "A3", D(2024, 3, 1), None, True), ("b", "B", D(2024, 1, 1), None, True), ("c", "C", D(2024, 2, 1), None, True)]
    assert history.version_faults(s, "id").count() == 0


def test_rerun_changes_nothing(spark):
    first = feed(spark, ("a", "A", "x", D(2024, 1, 1)))
    second = feed(spark, ("a", "A2", "x", D(2024, 2, 1)))
    s = apply(apply(None, first), second)
    again = apply(s, second)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, s.collect()))


def test_null_and_empty_differ(spark):
    s = apply(apply(None, feed(spark, ("a", None, "x", D(2024, 1, 1)))), feed(spark, ("a", "", "x", D(2024, 2, 1))))
    assert s.count() == 2


def test_open_end_option(spark):
    s = history.with_open_end(apply(None, feed(spark, ("a", "A", "x", D(2024, 1, 1)))))
    assert s.first().valid_to == D(9999, 12, 31)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from(["u", "v"]), st.integers(0, 40)), max_size=5),
                min_size=1, max_size=3))
def test_versions_never_overlap(spark, loads):
    s = None
    for load in loads:
        rows = [(k, n, "x", D(2024, 1, 1) + dt.timedelta(days=d)) for k, n, d in load]
        s = apply(s, feed(spark, *rows) if rows else spark.createDataFrame([], SCHEMA))
        s = spark.createDataFrame(s.collect(), s.schema)
    by_key = defaultdict(list)
    for r in s.collect():
        by_key[r.id].append(r)
    for versions in by_key.values():
        versions.sort(key=lambda r: r.valid_from)
        assert [v.is_current for v in versions] == [False] * (len(versions) - 1) + [True]
        for left, right in zip(versions, versions[1:]):
            assert left.valid_to == right.valid_from and left.valid_from < left.valid_to


def test_as_of_matches_brute_force(spark):
    versions = [("k", D(2024, 1, 1), D(2024, 1, 20), 1), ("k", D(2024, 1, 20), D(2025, 6, 3), 2), ("k", D(2025, 6, 3), None, 3),
                ("m", D(1990, 1, 1), None, 9)]
    facts = [(k, D(1989, 1, 1) + dt.timedelta(days=37 * i)) for i in range(500) for k in ("k", "m", "none")]
    v = spark.createDataFrame(versions, "k string, valid_from date, valid_to date, cost int")
    f = spark.createDataFrame(facts, "k string, d date")
    got = sorted((r.k, r.d, r.cost or 0) for r in as_of_version(f, v, "k", "d", ["cost"]).collect())
    want = sorted((k, d, next((c for kk, a, b, c in versions if kk == k and a <= d and (b is None or d < b)), 0)) for k, d in facts)
    assert got == want


def test_overlap_matches_brute_force(spark):
    t0 = dt.datetime(2024, 1, 1)
    m = lambda x: t0 + dt.timedelta(minutes=x)
    left = [(f"b{i}", f"L{i % 2}", m(i * 37), m(i * 37 + (i * 53) % 400)) for i in range(40)]
    right = [(f"s{i}", f"L{i % 2}", m(i * 41), m(i * 41 + (i * 29) % 300)) for i in range(40)]
    l = spark.createDataFrame(left, "b string, line string, a timestamp, z timestamp")
    r = spark.createDataFrame(right, "s string, line string, c timestamp, e timestamp")
    got = sorted((x.b, x.s, x.overlap_seconds) for x in overlap_pairs(l, r, "line", ("a", "z"), ("c", "e")).collect())
    want = sorted((b, s, int((min(z, e) - max(a, c)).total_seconds())) for b, lb, a, z in left for s, ls, c, e in right
                  if lb == ls and min(z, e) > max(a, c))
    assert got == want and len(got) > 20


def test_upsert_all_columns_is_idempotent(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    s = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    once = merge_upsert(t, s, ["k"])
    assert sorted(map(tuple, once.collect())) == [(1, "a"), (2, "B"), (3, "c")]
    assert sorted(map(tuple, merge_upsert(once, s, ["k"]).collect())) == sorted(map(tuple, once.collect()))


def test_upsert_named_columns_leaves_the_rest(spark):
    t = spark.createDataFrame([(1, "a", 10)], "k int, v string, n int")
    s = spark.createDataFrame([(1, "A", None), (2, "b", 20)], "k int, v string, n int")
    out = merge_columns(t, s, ["k"], ["n"])
    assert sorted(map(tuple, out.collect())) == [(1, "a", None), (2, "b", 20)]


def test_append_ignores_known_events(spark):
    t = spark.createDataFrame([("e1", 1)], "id string, v int")
    s = spark.createDataFrame([("e1", 9), ("e2", 2), ("e2", 2)], "id string, v int")
    assert sorted(map(tuple, append_unseen(t, s, "id").collect())) == [("e1", 1), ("e2", 2)]


def test_join_conditions_stay_equi(spark):
    f = spark.createDataFrame([("k", D(2024, 1, 1))], "k string, d date")
    v = spark.createDataFrame([("k", D(2024, 1, 1), None, 1)], "k string, valid_from date, valid_to date, cost int")
    plan = as_of_version(f, v, "k", "d", ["cost"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_as_of_asks_each_day_once(spark):
    """Hot keys, NULL keys and dates, a gap between versions; rows before the last step: versions and days asked."""
    versions = [("k", D(2024, 1, 1), D(2024, 2, 1), 1), ("k", D(2024, 3, 1), None, 2), ("m", D(2024, 1, 1), D(2024, 1, 1), 7)]
    facts = [("k", D(2024, 1, 1) + dt.timedelta(days=i % 100)) for i in range(3000)] + [(None, D(2024, 1, 1)), ("k", None), ("m", D(2024, 1, 1))]
    v = spark.createDataFrame(versions, "k string, valid_from date, valid_to date, cost int")
    f = spark.createDataFrame(facts, "k string, d date").repartition(6)
    out = as_of_version(f, v, "k", "d", ["cost"])
    want = sorted((str(k), str(d), str(next((c for kk, a, b, c in versions if d and kk == k and a <= d and (b is None or d < b)), None))) for k, d in facts)
    assert sorted((str(r.k), str(r.d), str(r.cost)) for r in out.collect()) == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("Window ") == 2


def test_allocation_is_first_in_first_out(spark):
    given = [("a", 1, "b1", 5), ("a", 2, "b2", 7), ("a", 3, "b3", 0), ("b", 1, "b4", 3), ("c", 1, "b5", 2)]
    taken = [("a", 1, "s1", 2), ("a", 1, "s2", 3), ("a", 4, "s3", 20), ("b", 1, "s4", 1), ("d", 1, "s5", 9)]
    g = spark.createDataFrame(given, "k string, day int, batch string, units bigint")
    t = spark.createDataFrame(taken, "k string, day int, sale string, units bigint")
    got = sorted(map(tuple, allocate_in_order(g, t, ["k"], ["day"], ["day"], "units", ["batch"], ["sale"]).collect()))
    want = []
    for key in "abcd":
        left = [[b, n] for k, _, b, n in sorted(given, key=lambda r: (r[1], r[2])) if k == key and n > 0]
        for k, _, sale, n in sorted(taken, key=lambda r: (r[1], r[2])):
            while k == key and n and left:
                part = min(n, left[0][1])
                want.append((key, left[0][0], sale, part))
                n, left[0][1] = n - part, left[0][1] - part
                if not left[0][1]:
                    left.pop(0)
    assert got == sorted(want) and len(got) <= len(given) + len(taken)
