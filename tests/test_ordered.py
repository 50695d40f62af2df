import random
import statistics

from pyspark.sql import functions as F

from refiscope.operators import ordered
from refiscope.operators.ordered import exact_median, first_per_key, running_totals, top_per_group
from refiscope.session import stage


def test_running_totals_match_brute_force_with_a_hot_key_and_a_hot_value(spark):
    rng = random.Random(7)
    rows = [("hot" if i % 3 else f"k{i % 5}", 0.5 if i % 4 == 0 else rng.random(), rng.randint(1, 9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v double, w long")
    got = {(r.k, r.v): (r.w, r.w_cum, r.w_all) for r in running_totals(df, "v", {"w": F.col("w")}, ["k"], ranges=16).collect()}
    for k in {r[0] for r in rows}:
        total = 0
        per: dict[float, int] = {}
        for _, v, w in (r for r in rows if r[0] == k):
            per[v] = per.get(v, 0) + w
        everything = sum(per.values())
        for v in sorted(per):
            total += per[v]
            assert got[(k, v)] == (per[v], total, everything)
    assert len(got) == len({(r[0], r[1]) for r in rows})


def test_ranges_are_even_for_keys_of_very_different_scales(spark, monkeypatch):
    monkeypatch.setattr(ordered, "ROWS", 500)
    rng = random.Random(1)
    rows = [("small", rng.random() * 1e-9, 1) for _ in range(4000)] + [("large", rng.random() * 1e12, 1) for _ in range(4000)] + [(f"k{i}", 5.0, 1) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, v double, w long")
    dealt, parts = ordered._dealt(stage(df, "t"), ["k"], "v", 1)
    sizes = {(r["k"], r["_range"]): r["count"] for r in dealt.groupBy("k", "_range").count().collect()}
    per_range = [sum(n for (_, p), n in sizes.items() if p == q) for q in range(parts)]
    assert parts == 17 and max(per_range) < 3 * 500  # every task is bounded, whatever the key
    assert all(sum(k == key for k, _ in sizes) >= 5 for key in ("small", "large"))
    monkeypatch.setattr(ordered, "SCANNED", 3)  # totals of ranges are scanned in ranges themselves
    got = {(r.k, r.v): (r.w_cum, r.w_all) for r in running_totals(df, "v", {"w": F.col("w")}, ["k"]).collect()}
    for key in ("small", "large", "k7"):
        values = sorted(v for k, v, _ in rows if k == key)
        assert [got[key, v] for v in values] == [(i + 1, len(values)) for i in range(len(values))]


def test_running_totals_keep_null_keys(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 1.0)], "k string, v double")
    got = sorted((r.k or "", r.v, r.n_cum, r.n_all) for r in running_totals(df, "v", {"n": F.lit(1)}, ["k"]).collect())
    assert got == [("", 1.0, 1, 2), ("", 2.0, 2, 2), ("a", 1.0, 1, 1)]


def test_exact_median(spark):
    rng = random.Random(3)
    rows = [("a" if i % 3 else "b", round(rng.random(), 2)) for i in range(1001)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.median for r in exact_median(df, "v", ["k"], ranges=8).collect()}
    for k in ("a", "b"):
        assert abs(got[k] - statistics.median(v for n, v in rows if n == k)) < 1e-12
    assert abs(exact_median(df, "v").first()["median"] - statistics.median(v for _, v in rows)) < 1e-12


def test_first_per_key_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    latest = first_per_key(df, ["k"], [F.desc("t")])
    assert sorted((r.k, r.t) for r in latest.collect()) == [(0, 999), (1, 997), (2, 998)]
    plan = top_per_group(df, ["k"], [F.desc("t")], 5, "r")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
