"""Joins with hot keys: the rows of a plain join, and even tasks."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallywise.operators import heavy_keys, null_safe_full_outer, skew_join

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
_key = st.one_of(st.none(), st.sampled_from(["a", "a", "a", "b", "c"]))


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@SETTINGS
@given(st.lists(st.tuples(_key, _key), max_size=14), st.lists(st.tuples(_key, _key), max_size=14), st.integers(1, 4))
def test_hot_keys_give_the_rows_of_a_plain_join(spark, left, right, heavy_rows):
    a = spark.createDataFrame([(x, y, i // 2) for i, (x, y) in enumerate(left)], "o string, s string, v int")
    b = spark.createDataFrame([(x, y, i // 2) for i, (x, y) in enumerate(right)], "o2 string, s2 string, w int")
    got = null_safe_full_outer(a, b, [a.o, a.s], [b.o2, b.s2], heavy_rows=heavy_rows)
    assert bag(got) == bag(null_safe_full_outer(a, b, [a.o, a.s], [b.o2, b.s2], skew_safe=False))
    for how in ("inner", "full_outer"):
        plain = a.join(b, (a.o == b.o2) & (a.s == b.s2), how)
        assert bag(skew_join(a, b, ["o", "s"], ["o2", "s2"], how, heavy_rows=heavy_rows)) == bag(plain)


def largest_and_median(df, column="pid"):
    n = sorted(r["n"] for r in df.groupBy(column).agg(F.count("*").alias("n")).collect())
    return n[-1], n[len(n) // 2]


@pytest.mark.parametrize("both", [False, True])
def test_a_third_of_all_rows_in_one_key_spreads(spark, both):
    """One key holds a third of the lines: no task of the join takes over twice the median."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit("#1")).otherwise(F.concat(F.lit("#"), F.col("id").cast("string")))
        a = spark.range(0, 30_000, numPartitions=6).select(hot.alias("o"), F.col("id").alias("v"))
        b = spark.range(0, 30_000, numPartitions=6).select(
            (F.when(F.col("id") % 100 == 0, F.lit("#1")).otherwise(F.concat(F.lit("#"), F.col("id").cast("string"))) if both
             else F.concat(F.lit("#"), F.col("id").cast("string"))).alias("o2"), F.col("id").alias("w"))
        got = null_safe_full_outer(a, b, [a.o], [b.o2], heavy_rows=40 if both else 100)
        largest, median = largest_and_median(got.withColumn("pid", F.spark_partition_id()))
        assert largest <= 2 * median
        plain = null_safe_full_outer(a, b, [a.o], [b.o2], skew_safe=False)
        assert got.count() == plain.count()
        slow, usual = largest_and_median(plain.withColumn("pid", F.spark_partition_id()))
        assert slow > 2 * usual  # what the slices are for
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", old[0])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old[1])


def test_heavy_keys_are_counted_with_null(spark):
    a = spark.createDataFrame([(None,)] * 5 + [("x",)] * 3 + [("y",)], "k string")
    b = spark.createDataFrame([("x",)] * 9 + [("z",)], "k2 string")
    got = {r["__h0"]: (r["__ls"], r["__rs"], r["__both"]) for r in heavy_keys(a, b, ["k"], ["k2"], 2).collect()}
    assert got == {None: (3, 1, False), "x": (2, 5, True)}


def test_hot_plant_in_size_swaps(spark):
    """A plant with a third of the stock: pairs as of the plain join, spread over tasks."""
    from tallywise.plans.stock import sku_size_swaps
    stock = spark.range(0, 1200).select(
        F.concat(F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("P"), (F.col("id") % 90).cast("string"))),
                 F.lit("-"), (F.col("id") % 7).cast("string")).alias("default_code"),
        (F.col("id") % 2).cast("double").alias("quantity"), (F.col("id") % 7).cast("string").alias("size_suffix"))
    stock = stock.withColumn("plant_prefix", F.substring_index("default_code", "-", 1))
    inv = (stock.select(F.col("default_code").alias("sku")).distinct()
           .select("sku", F.pmod(F.xxhash64("sku"), F.lit(2)).cast("double").alias("on_hand"), F.lit("s").alias("option_value"), F.lit("t").alias("title")))
    whole = sku_size_swaps(stock, inv)
    assert bag(whole) == bag(sku_size_swaps(stock, inv, heavy_rows=10)) and whole.count() > 1000


def test_keys_are_counted_in_full_buckets_only(spark, monkeypatch):
    """Rows are counted by bucket before any key is shuffled; heavy keys are found whatever the buckets."""
    from tallywise.operators import skew
    a = spark.createDataFrame([(None,)] * 5 + [("x",)] * 3 + [("y",)] * 2, "k string")
    b = spark.createDataFrame([("x",)] * 9 + [("z",)], "k2 string")
    plan = heavy_keys(a, b, ["k"], ["k2"], 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "__full" in plan and "xxhash64" in plan
    found = []
    for buckets in (1, 2, skew.COUNT_BUCKETS):
        monkeypatch.setattr(skew, "COUNT_BUCKETS", buckets)
        found.append(bag(heavy_keys(a, b, ["k"], ["k2"], 2)))
    assert found[0] == found[1] == found[2] and len(found[0]) == 2


def test_rows_carry_one_place_and_no_copy_of_their_keys(spark):
    a = spark.createDataFrame([("#A", "s", 1)], "o string, s string, v int")
    b = spark.createDataFrame([("#a", "S", 2)], "o2 string, s2 string, w int")
    met = null_safe_full_outer(a, b, [F.lower(a.o), F.lower(a.s)], [F.lower(b.o2), F.lower(b.s2)])
    assert [tuple(r) for r in met.collect()] == [("#A", "s", 1, "#a", "S", 2)]
    names = {c.split("#")[0] for c in met._jdf.queryExecution().optimizedPlan().toString().replace("[", " ").replace(",", " ").split() if "__" in c}
    assert "__li" in names and "__rj" in names and not names & {"__lk0", "__rk0", "__lj", "__ri", "__lboth"}
