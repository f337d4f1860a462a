import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from threadlens.operators import profile as pf
from threadlens.operators import ranking as rk
from threadlens.operators import sampling as sm


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-10**6, 10**6), min_size=1, max_size=60))
def test_quantiles_match_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    found = rk.quantiles(df, "x", {"a": 0.0, "b": 0.3, "c": 0.5, "d": 0.9, "e": 1.0}).first()
    assert list(found) == pytest.approx(list(np.quantile(values, [0, 0.3, 0.5, 0.9, 1])))


def test_quantiles_of_nothing(spark):
    found = rk.quantiles(spark.createDataFrame([(None,)], "x double"), "x", {"a": 0.5}).first()
    assert found["a"] is None


def test_histogram_of_equal_values_has_one_bin(spark):
    df = spark.createDataFrame([(5.0,)] * 4, "response_seconds double")
    assert [(r["bin"], r["n"]) for r in pf.clipped_histogram(df).collect()] == [(1, 4)]


def test_histogram_counts_all_rows(spark):
    df = spark.range(1000).select(F.pow("id", F.lit(2)).alias("response_seconds"))
    bins = pf.clipped_histogram(df).collect()
    assert sum(r["n"] for r in bins) == 1000 and max(r["bin"] for r in bins) == 40
    assert max(bins, key=lambda r: r["bin"])["upper_edge"] == pytest.approx(np.quantile(np.arange(1000.0) ** 2, 0.95))


def test_keyword_rates_of_nothing(spark):
    rates = pf.followup_rates(spark.createDataFrame([(None,)], "followup_text string")).first()
    assert rates["thankful"] is None and rates["unresolved"] is None


def test_large_groups_are_cut_before_the_shuffle(spark):
    df = spark.range(10_000).withColumn("g", F.when(F.col("id") % 10 == 0, "cold").otherwise("hot"))
    drawn = sm.sample_per_group(df, "g", "id", 25, 42)
    assert "WindowGroupLimit" in drawn._jdf.queryExecution().executedPlan().toString()
    assert drawn.count() == 50


def test_large_n_takes_the_two_step_way(spark):
    df = spark.range(20_000).withColumn("g", F.col("id") % 3)
    top = rk.top_n_per_group(df, ["g"], [F.desc("id")], 2_000)
    assert top.count() == 6_000 and top.agg(F.min("id")).first()[0] == 20_000 - 6_000


def test_numbers_are_consecutive_and_repeatable(spark):
    df = spark.range(500).withColumn("key", F.col("id").cast("string")).drop("id")
    one = {r["key"]: r["example_id"] for r in sm.shuffle_and_number(df, "key", 1).collect()}
    two = {r["key"]: r["example_id"] for r in sm.shuffle_and_number(df.repartition(5), "key", 1).collect()}
    assert one == two and sorted(one.values()) == [f"g{i:04d}" for i in range(500)]


def test_calibration_takes_the_same_number_per_bin(spark):
    scores = spark.range(300).select(
        F.col("id").alias("example_id"), (F.col("id") % 5 + 1).alias("correctness"),
        (F.col("id") % 5 + 1).alias("tone"), F.lit(None).cast("long").alias("actionability"),
    )
    drawn = sm.calibration_sample(scores, "example_id", 40, 42)
    assert {r["score_bin"]: r["count"] for r in drawn.groupBy("score_bin").count().collect()} == {
        "low": 13, "mid": 13, "high": 13}
    only_low = sm.calibration_sample(scores.filter("tone <= 2"), "example_id", 40, 42)
    assert only_low.count() == 40


def test_listed_groups_are_sampled_and_counted(spark):
    rows = [(i, "a") for i in range(5)] + [(9, "b"), (10, "other"), (11, None)]
    df = spark.createDataFrame(rows, "id int, intent string")
    drawn = sm.sample_listed(df, "intent", ["a", "b", "c"], "id", 3, 42).groupBy("intent").count()
    assert {tuple(r) for r in drawn.collect()} == {("a", 3), ("b", 1)}
    short = sm.short_groups(df, "intent", 3, ["a", "b", "c", "c"])
    assert {tuple(r) for r in short.collect()} == {("b", 1), ("c", 0)}
    assert sm.sample_listed(df, "intent", [], "id", 3, 42).count() == 0


def test_random_rows_are_the_first_by_digest(spark):
    df = spark.range(500).union(spark.createDataFrame([(None,)], "id bigint"))
    for n in (0, 1, 7, 501, 900):
        whole = df.orderBy(sm.seeded_order(42, F.col("id")), "id").limit(n).collect()
        assert sm.random_rows(df, "id", n, 42).collect() == whole


def test_a_million_reals_of_about_the_same_size(spark):
    """All of them are below 0.01; ranges are even all the same, and quantiles and ranks exact."""
    values = spark.range(1_000_000).select((F.pmod(F.xxhash64("id"), F.lit(10**12)) / 10**14).alias("x"), F.lit("g").alias("g"))
    every = np.sort(np.array([r[0] for r in values.select("x").collect()]))
    found = rk.quantiles(values, "x", {"a": 0.1, "b": 0.5, "c": 0.999}).first()
    assert list(found) == pytest.approx(list(np.quantile(every, [0.1, 0.5, 0.999])), rel=1e-12)
    counts = rk.value_counts(values, "x", ["g"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as with ranges of full size
    try:
        _, ranges = rk.in_ranges(counts, ["g", "x"])
        sizes = [r["count"] for r in ranges.count().collect()]
        ranked = rk.running_counts(counts, "x", ["g"])
        assert ranked.agg(F.sum(F.col("before"))).first()[0] == 10**6 * (10**6 - 1) // 2
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(sizes) < 1.5 * 10**6 / 8


def test_running_counts_of_groups(spark):
    rows = [("a", 2.0, 3), ("a", -1.0, 1), ("b", 5.0, 2), ("a", 7.5, 4), (None, 1.0, 9)]
    counts = spark.createDataFrame(rows, "g string, x double, n bigint")
    found = {(r["g"], r["x"]): (r["before"], r["total"]) for r in rk.running_counts(counts, "x", ["g"]).collect()}
    assert found == {("a", -1.0): (0, 8), ("a", 2.0): (1, 8), ("a", 7.5): (4, 8), ("b", 5.0): (0, 2)}


def test_large_samples_leave_most_rows_where_they_are(spark):
    """Of a hot group of 200,000 rows little more than the sample reaches the window; short groups stay whole."""
    df = spark.range(240_000).select(
        F.col("id"), F.when(F.col("id") % 6 > 0, "hot").when(F.col("id") % 60 == 0, "short").otherwise("cold").alias("g"))
    df = df.unionByName(spark.createDataFrame([(None, "hot"), (None, "short")], "id bigint, g string"))
    digest = df.withColumn("_digest", sm.seeded_order(42, F.col("id")))
    left = {r["g"]: r["count"] for r in sm.up_to_the_nth(digest, "g", 3_000).groupBy("g").count().collect()}
    assert all(3_000 <= left[g] < 3_050 for g in ("hot", "cold", "short"))
    for n in (1_001, 3_000, 50_000):
        found = sm.sample_per_group(df, "g", "id", n, 42)
        rows = sorted((r["g"], r["_digest"] or "", -1 if r["id"] is None else r["id"]) for r in digest.collect())
        for g in ("hot", "cold", "short"):
            mine = [i for name, _, i in rows if name == g][:n]
            assert sorted(r["id"] if r["id"] is not None else -1 for r in found.filter(F.col("g") == g).collect()) == sorted(mine)
