"""Skew-safe ranking primitives against Spark's single-task references."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wellspring.operators.ranking import (
    SortedTable,
    _sorted_blocks,
    exact_quantiles,
    mark_repeats,
    rank_within,
    rolling_mean_rows,
    sort_rank,
)


def test_golden_quantiles(spark):
    df = spark.createDataFrame([("a", v) for v in (1.0, 2.0, 4.0, 8.0)] + [("a", None), ("a", float("nan"))],
                               "g string, v double")
    r = exact_quantiles(df, ["g"], "v", [0.1, 0.5, 0.9], ["q10", "median", "q90"]).first()
    assert (round(r.q10, 9), r.median, round(r.q90, 9)) == (1.3, 3.0, 6.8)


def _skewed(spark, n=6000):
    rnd = random.Random(7)
    rows = []
    for i in range(n):
        g = "hot" if i % 3 == 0 else f"g{rnd.randint(0, 40)}"  # one key holds a third
        rows.append((g, float(rnd.randint(0, 500)) / 10, i))
    return spark.createDataFrame(rows, "g string, v double, i long")


def test_quantiles_match_percentile_under_skew(spark):
    df = _skewed(spark)
    ours = {r.g: r for r in exact_quantiles(df, ["g"], "v", [0.1, 0.5, 0.9]).collect()}
    ref = df.groupBy("g").agg(*[F.percentile("v", p).alias(f"p{i}") for i, p in enumerate((0.1, 0.5, 0.9))])
    for r in ref.collect():
        o = ours[r.g]
        assert abs(o.q_0_1 - r.p0) < 1e-9 and abs(o.q_0_5 - r.p1) < 1e-9 and abs(o.q_0_9 - r.p2) < 1e-9


def test_hot_group_is_split_over_partitions(spark):
    df = _skewed(spark)
    _, blocks = _sorted_blocks(df, ["g"], ["v"], 8)
    parts_of_hot = blocks.where(F.col("g") == "hot").select("__pid").distinct().count()
    assert parts_of_hot >= 2


def test_rank_within_equals_row_number(spark):
    df = _skewed(spark, 2000)
    ours = rank_within(df, ["g"], ["v", "i"], "rk")
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v", "i")))
    j = ours.join(ref, ["g", "v", "i"])
    assert j.where(F.col("rk") != F.col("rn")).count() == 0
    assert j.count() == 2000


def test_sort_rank_global(spark):
    df = spark.range(0, 500).withColumn("k", (F.col("id") * 7919) % 500)
    out = sort_rank(df, ["k"], "rn")
    assert out.where(F.col("rn") != F.col("k") + 1).count() == 0


def test_rolling_mean_matches_window(spark):
    rnd = random.Random(3)
    rows = [(w, d, None if rnd.random() < 0.05 else float(rnd.randint(0, 100))) for w in ("a", "b") for d in range(60)]
    df = spark.createDataFrame(rows, "w string, d int, v double")
    ours = rolling_mean_rows(df, ["w"], "d", "v", {"m7": 7})
    win = Window.partitionBy("w").orderBy("d").rowsBetween(-6, 0)
    ref = df.withColumn(
        "r7", F.when((F.count(F.lit(1)).over(win) == 7) & (F.count("v").over(win) == 7), F.avg("v").over(win))
    )
    j = ours.join(ref, ["w", "d"]).collect()
    assert len(j) == 120
    for r in j:
        assert (r.m7 is None and r.r7 is None) or abs(r.m7 - r.r7) < 1e-9


def test_mark_repeats(spark):
    df = spark.createDataFrame([(1, 2), (1, 1), (2, 5), (1, 3)], "id int, o int")
    got = sorted((r.id, r.o, r.is_duplicate) for r in mark_repeats(df, ["id"], ["o"]).collect())
    assert got == [(1, 1, False), (1, 2, True), (1, 3, True), (2, 5, False)]


def test_mark_repeats_with_a_hot_id_and_nulls(spark):
    rows = [("hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{i % 900}"), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, i int").repartition(8)
    first = {}
    for k, i in rows:
        first[k] = min(i, first.get(k, i))
    out = mark_repeats(df, ["k"], ["i"])
    assert out.columns == ["k", "i", "is_duplicate"]
    got = out.collect()
    assert len(got) == 4000 and all(r.is_duplicate == (r.i != first[r.k]) for r in got)


def test_quantiles_narrow_range_by_range(spark):
    """Few bins and tiny leaves force many rounds; values of all scales, ties, one-valued groups and infinities."""
    rnd = random.Random(11)
    groups = {
        "scales": [rnd.choice([-1, 1]) * 10.0 ** rnd.randint(-300, 300) for _ in range(700)],
        "ties": [float(rnd.randint(0, 3)) for _ in range(500)],
        "one": [2.5] * 40,
        "single": [7.0],
        "infinite": [float("-inf")] * 3 + [rnd.random() for _ in range(200)] + [float("inf")] * 60,
        "wide": [-1.7e308, 1.7e308, 0.0, 1.0, 2.0],
        None: [rnd.gauss(0, 1) for _ in range(300)],
    }
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("void", None), ("ties", None), ("ties", float("nan"))], "g string, v double").repartition(6)
    out = {r.g: r for r in exact_quantiles(df, ["g"], "v", [0.0, 0.1, 0.5, 0.9, 1.0], bins=4, leaf=3).collect()}
    assert set(out) == set(groups)
    for g, vs in groups.items():
        x = sorted(vs)
        for p, got in zip((0.0, 0.1, 0.5, 0.9, 1.0), out[g][1:], strict=True):
            h = (len(x) - 1) * p
            lo, hi = x[int(h)], x[min(int(h) + 1, len(x) - 1)]
            want = lo + (h - int(h)) * (hi - lo)
            assert got == want or abs(got - want) <= 1e-9 * abs(want) or (got != got and want != want), (g, p, got, want)


def test_quantiles_of_counted_values(spark):
    df = _skewed(spark)
    counted = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    ours = {r.g: tuple(r)[1:] for r in exact_quantiles(counted, ["g"], "v", [0.1, 0.5, 0.9], weight_col="n", leaf=50).collect()}
    assert ours == {r.g: tuple(r)[1:] for r in exact_quantiles(df, ["g"], "v", [0.1, 0.5, 0.9]).collect()}


def test_rolling_means_across_blocks(spark):
    """Blocks shorter than a day's group, as short as the longest window."""
    df = spark.createDataFrame([(g, d, None if d % 17 == 3 else float((d * 7919) % 101)) for g in ("a", None) for d in range(90)], "w string, d int, v double")
    ours = {(r.w, r.d): (r.m3, r.m10) for r in rolling_mean_rows(df, ["w"], "d", "v", {"m3": 3, "m10": 10}, block_rows=10).collect()}
    whole = {(r.w, r.d): (r.m3, r.m10) for r in rolling_mean_rows(df, ["w"], "d", "v", {"m3": 3, "m10": 10}).collect()}
    assert ours == whole and len(ours) == 180
    values = [None if d % 17 == 3 else float((d * 7919) % 101) for d in range(90)]
    for d in range(90):
        for k, got in zip((3, 10), ours["a", d], strict=True):
            window = values[max(0, d - k + 1) : d + 1]
            want = sum(window) / k if len(window) == k and None not in window else None
            assert (got is None) == (want is None) and (want is None or abs(got - want) < 1e-9)


def test_no_copies_and_no_self_join(spark):
    df = spark.range(1000).selectExpr("id % 3 as w", "id as d", "double(id) as v")
    plan = rolling_mean_rows(df, ["w"], "d", "v", {"m7": 7})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1  # ranks meet the index of the sorted table
    marks = mark_repeats(df, ["w"], ["d"])._jdf.queryExecution().optimizedPlan().toString()
    assert marks.count("Join") == 1 and marks.count("Window") == 1  # a row per partition each


def test_one_sorted_table_for_ranks_sizes_and_repeats(spark):
    df = spark.createDataFrame([("a", 3, float("nan")), ("b", 1, 1.0), ("a", 1, None), (None, 5, 2.0), ("a", 2, 0.0), (None, 4, 2.0)], "g string, o int, v double")
    table = SortedTable(df, ["g"], ["o"], 3)
    ranked = {(r.g, r.o): (r.rk, r.size) for r in table.ranked("rk", "size").collect()}
    assert ranked == {("a", 1): (1, 3), ("a", 2): (2, 3), ("a", 3): (3, 3), ("b", 1): (1, 1), (None, 4): (1, 2), (None, 5): (2, 2)}
    assert {(r.g, r.o): r.again for r in table.mark_repeats("again").collect()} == {k: rk > 1 for k, (rk, _) in ranked.items()}
    with pytest.raises(ValueError, match="already"):
        table.ranked("v")
    floats = spark.createDataFrame([(float("nan"), 1), (float("nan"), 2), (None, 3), (0.5, 4)], "v double, o int")
    assert sorted((r.o, r.d) for r in mark_repeats(floats, ["v"], ["o"], "d").collect()) == [(1, False), (2, True), (3, False), (4, False)]
