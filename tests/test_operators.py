"""Operator behaviour on small frames (numbering, intervals, lists, quality, calendar)."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators import lists as L
from ledgerlens.operators import quality as Q
from ledgerlens.operators.calendar import gaps, series
from ledgerlens.operators.intervals import interval_join, overlapping_intervals
from ledgerlens.operators.numbering import surrogate_key
from ledgerlens.operators.ranking import top_k, top_k_with_ties, top_per_group


def test_surrogate_key_is_consecutive_and_follows_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 997 - 100).alias("v"), "id")
    df = df.unionByName(spark.createDataFrame([(None, 7), (None, 3), (2**60, 1)], "v long, id long"))
    keyed = surrogate_key(df, "v", [F.col("id")], "k", bits=4)
    rows = sorted((r["k"], r["v"], r["id"]) for r in keyed.collect())
    assert [k for k, _, _ in rows] == list(range(1, 5004))
    assert [r[1:] for r in rows] == sorted((r[1:] for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def _ts(s):
    return dt.datetime.fromisoformat(s)


def test_intervals_of_any_length(spark):
    """Days, weeks, years and centuries against all pairs; ten years cost fewer than 30 rows."""
    import random
    from ledgerlens.operators.intervals import dealt_intervals
    rng, day = random.Random(3), dt.datetime(1995, 1, 1)
    spans = [(f"i{k}", day + dt.timedelta(hours=rng.randrange(9000 * 24)),
              dt.timedelta(hours=int(24 * 10 ** rng.uniform(-2, 4.6)))) for k in range(150)]
    rows = [(n, s, s + d) for n, s, d in spans] + [("ten", day, dt.datetime(2004, 12, 31)), ("back", day, day - dt.timedelta(1))]
    pts = [(k // 2, day + dt.timedelta(hours=rng.randrange(9000 * 24))) for k in range(200)]
    pts = pts + pts[:5] + [(900, None), (901, dt.datetime(1901, 1, 1)), (901, dt.datetime(1901, 1, 1))]
    iv = spark.createDataFrame(rows, "name string, s timestamp_ntz, e timestamp_ntz")
    points = spark.createDataFrame(pts, "pid int, t timestamp_ntz")
    assert dealt_intervals(iv.where("name = 'ten'"), "s", "e").count() < 30
    assert dealt_intervals(iv, "s", "e").groupBy("name").count().agg(F.max("count")).first()[0] <= 17
    inside = sorted((p, t, n) for p, t in pts for n, s, e in rows if t and s <= t <= e)
    got = interval_join(points, "t", iv, "s", "e", "inner").select("pid", "t", "name").collect()
    assert sorted(map(tuple, got)) == inside
    left = interval_join(points, "t", iv, "s", "e").select("pid", "t", "name").collect()
    alone = [(p, t, None) for p, t in pts if not any(t and s <= t <= e for _, s, e in rows)]
    assert sorted(map(tuple, left), key=str) == sorted(inside + alone, key=str)


def test_spread_ids_need_no_wide_window(spark):
    """Keys by hashed 64-bit ids: one bucket per row, and no level over 65,536 of them."""
    df = spark.range(20_000).select(F.xxhash64("id").alias("v"), "id")
    rows = sorted((r["k"], r["v"]) for r in surrogate_key(df, "v", [F.col("id")], "k").collect())
    assert [k for k, _ in rows] == list(range(1, 20_001)) and [v for _, v in rows] == sorted(v for _, v in rows)
    plan = surrogate_key(df, "v", [F.col("id")], "k")._jdf.queryExecution().optimizedPlan().toString()
    alone = [line for line in plan.splitlines() if "Window [" in line and "], [" not in line]
    for line in alone:  # windows without partition: over the last 16 bits that are left
        assert "__at" in line, line


def test_running_totals_by_keys(spark):
    from ledgerlens.operators.scan import totals_before
    rows = [(k, p, (p or 0) % 97 + 1) for k in (None, 1, 2) for p in (None, -2**62, -70_000, -1, 0, 5, 65_535, 65_536, 2**40, 2**62)]
    df = spark.createDataFrame(rows, "k int, p long, n long")
    got = totals_before(df, ["k"], "p", {"before": ("sum", "n"), "x": ("xor", "n")}).collect()
    assert len(got) == len(rows)
    for r in got:
        less = [n for k, p, n in rows if k == r["k"] and r["p"] is not None and (p is None or p < r["p"])]
        xor = 0
        for n in less:
            xor ^= n
        assert (r["before"], r["x"]) == (sum(less), xor), r


def test_interval_join(spark):
    pts = spark.createDataFrame(
        [(1, _ts("2024-01-01 00:00:00")), (2, _ts("2024-01-10 00:00:00")),
         (3, _ts("2024-01-10 00:00:01")), (4, _ts("2024-01-20 12:00:00")),
         (5, _ts("2024-01-25 08:00:00")), (6, None)], "pid int, t timestamp_ntz")
    iv = spark.createDataFrame(
        [("a", _ts("2024-01-01 00:00:00"), _ts("2024-01-10 00:00:00")),
         ("b", _ts("2024-01-20 00:00:00"), _ts("2024-01-26 00:00:00")),
         ("c", _ts("2024-01-25 00:00:00"), _ts("2024-01-27 00:00:00")),
         ("inverted", _ts("2024-01-30 00:00:00"), _ts("2024-01-01 00:00:00"))],
        "name string, s timestamp_ntz, e timestamp_ntz")
    key = lambda r: (r[0], r[1] or "")
    got = interval_join(pts, "t", iv, "s", "e").select("pid", "name")
    want = [(1, "a"), (2, "a"), (3, None), (4, "b"), (5, "b"), (5, "c"), (6, None)]
    assert sorted([tuple(r) for r in got.collect()], key=key) == want
    open_end = interval_join(pts, "t", iv, "s", "e", inclusive=False).select("pid", "name")
    want[1] = (2, None)
    assert sorted([tuple(r) for r in open_end.collect()], key=key) == want


def test_overlaps_are_found_across_neighbours_and_months(spark):
    def d(n):
        return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    rows = [("a", 0, 100), ("b", 1, 2), ("c", 49, 59), ("d", 120, 130), ("e", 130, 140),
            ("f", 200, 201), ("g", 300, 310), ("h", 305, 400), ("i", 399, 399)]
    iv = spark.createDataFrame([(k, d(a), d(b)) for k, a, b in rows], "name string, s timestamp_ntz, e timestamp_ntz")
    for inclusive in (True, False):
        want = [k for k, a, b in rows if any(
            (a <= y and x <= b) if inclusive else (a < y and x < b) for j, x, y in rows if j != k)]
        got = overlapping_intervals(iv, "name", "s", "e", inclusive)
        assert got.columns == iv.columns and sorted(r["name"] for r in got.collect()) == want


def test_explode_and_collapse(spark):
    dim = spark.createDataFrame([(1, "Bacon"), (2, "BBQ Sauce"), (3, "Beef")], "id int, name string")
    df = spark.createDataFrame([(1, "3, 1,2"), (2, None), (3, "9")], "k int, ids string")
    inner = L.explode_list(df, "ids", dim, "id", "name", "name")
    assert sorted(r["k"] for r in inner.collect()) == [1, 1, 1]
    outer = L.explode_list(df, "ids", dim, "id", "name", "name", keep_empty=True)
    assert sorted((r["k"], r["name"] or "") for r in outer.collect()) == [
        (1, "BBQ Sauce"), (1, "Bacon"), (1, "Beef"), (2, ""), (3, "")]
    coll = L.collapse_list(inner, ["k"], "name", "names", case_insensitive=True)
    assert coll.collect()[0]["names"] == "Bacon, BBQ Sauce, Beef"
    small = L.explode_list(df, "ids", dim, "id", "name", "name")
    assert small.count() == 3


def test_quality_checks(spark):
    child = spark.createDataFrame([(1, 1, 3), (1, 2, 6), (2, None, None), (3, 9, 5)],
                                  "order_id int, runner_id int, rating int")
    parent = spark.createDataFrame([(1,), (2,)], "runner_id int")
    rep = {r["check_name"]: r["violations"] for r in Q.contract_report({
        "pk": Q.duplicate_keys(child, ["order_id"]),
        "nn": Q.null_rows(child, ["runner_id"]),
        "fk": Q.orphans(child, parent, "runner_id", "runner_id"),
        "range": Q.out_of_range(child, "rating", 1, 5),
    }).collect()}
    assert rep == {"pk": 1, "nn": 1, "fk": 1, "range": 1}


def test_change_log_checks(spark):
    log = spark.createDataFrame([(1, "2020-01-05", 1), (1, "2020-01-03", 2), (1, "2020-01-03", 3)],
                                "k int, d string, arrival int")
    assert Q.same_key_same_date(log, "k", "d").count() == 1
    assert Q.out_of_order(log, "k", "d", "arrival").count() == 2


def test_series_and_gaps(spark):
    present = spark.createDataFrame([(2,), (3,), (3,), (5,)], "w int")
    assert [r["n"] for r in series(spark, 1, 3).collect()] == [1, 2, 3]
    assert sorted(r["m"] for r in gaps(spark, present, "w", 1, 6, "m").collect()) == [1, 4, 6]


def test_ranking_helpers(spark):
    df = spark.createDataFrame([("a", 3), ("b", 3), ("c", 1)], "k string, n int")
    assert sorted(r["k"] for r in top_k_with_ties(df, 1, [F.desc("n")]).collect()) == ["a", "b"]
    g = spark.createDataFrame([(1, "x", 2), (1, "y", 2), (2, "z", 1)], "g int, k string, n int")
    assert top_per_group(g, ["g"], [F.desc("n")]).count() == 3
    assert top_per_group(g, ["g"], [F.desc("n"), F.asc("k")], ties=False).count() == 2


def test_names_of_repeated_null_and_large_ids(spark):
    dim = spark.createDataFrame([(1, "Bacon"), (2, "BBQ Sauce"), (3_000_000_000, "Beef"), (2, "Cheese"),
                                 (None, "Nothing")], "id long, name string")
    df = spark.createDataFrame([(1, "3000000000,1,2"), (2, None), (3, "9,1"), (4, "x,1"), (5, "")], "k int, ids string")
    got = {r["k"]: r["n"] for r in L.with_names(df, "ids", dim, "id", "name", "n").collect()}
    assert got == {1: ["Beef", "Bacon", "BBQ Sauce", "Cheese"], 2: None, 3: [None, "Bacon"], 4: [None, "Bacon"],
                   5: [None]}
    rows = L.explode_list(df, "ids", dim, "id", "name", "name")
    assert sorted((r["k"], r["name"]) for r in rows.collect()) == [
        (1, "BBQ Sauce"), (1, "Bacon"), (1, "Beef"), (1, "Cheese"), (3, "Bacon"), (4, "Bacon")]


def test_top_k_offset(spark):
    df = spark.range(10)
    assert [r["id"] for r in top_k(df, 3, [F.desc("id")], offset=2).collect()] == [7, 6, 5]


def test_out_of_order_over_blocks_of_a_hot_key(spark):
    rows = [(0, (i * 37) % 101, i) for i in range(500)] + [(1, i, i) for i in range(50)]
    log = spark.createDataFrame(rows, "k int, d int, arrival int")
    w = Window.partitionBy("k").orderBy("arrival").rowsBetween(Window.unboundedPreceding, -1)
    want = log.withColumn("p", F.max("d").over(w)).where("p > d").drop("p")
    got = Q.out_of_order(log, "k", "d", "arrival", block=16)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_row_checks_count_in_one_scan(spark):
    df = spark.createDataFrame([(1, 3), (2, 9), (None, None)], "k int, v int")
    got = Q.row_checks(df, {"null": Q.any_null(["k"]), "range": Q.outside("v", 1, 5)})
    assert {tuple(r) for r in got.collect()} == {("null", 1), ("range", 1)}
