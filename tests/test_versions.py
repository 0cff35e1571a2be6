"""Tables replaced in one step, and load-once claims."""

import threading
import uuid

import pytest
from pyspark.sql import functions as F

from tallywise.session import scratch_path
from tallywise.sources import sinks, versions


def folder(spark):
    return scratch_path(spark, f"tallywise-tests/{uuid.uuid4().hex}")


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_a_write_killed_half_way_leaves_the_old_tables(spark):
    store = folder(spark)
    versions.replace_tables({"a": spark.range(3), "b": spark.range(30, 33)}, store)
    broken = spark.range(100, 110, numPartitions=4).select(
        F.when(F.col("id") == 109, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        versions.replace_tables({"a": spark.range(7), "b": broken}, store)
    assert ids(versions.read_table(spark, store, "a")) == [0, 1, 2]  # a was written whole, and does not count
    assert ids(versions.read_table(spark, store, "b")) == [30, 31, 32]
    versions.replace_tables({"a": spark.range(5), "b": spark.range(2)}, store)
    assert ids(versions.read_table(spark, store, "a")) == [0, 1, 2, 3, 4] and ids(versions.read_table(spark, store, "b")) == [0, 1]


def test_readers_keep_the_version_they_began_with(spark):
    store = folder(spark)
    sinks.replace_table(spark.range(3).toDF("x"), store, ["x"])
    before = versions.read_table(spark, store)
    sinks.replace_table(spark.range(10, 14).toDF("x"), store, ["x"])
    assert sorted(r.x for r in before.collect()) == ["0", "1", "2"]
    after = versions.read_table(spark, store)
    assert sorted((r.x, r.id) for r in after.collect()) == [("10", 1), ("11", 2), ("12", 3), ("13", 4)]
    for n in (1, 2, 3):
        sinks.replace_table(spark.range(n).toDF("x"), store, ["x"])
    kept = spark.read.format("binaryFile").load(f"{store}/v-*/data").select("path").collect()
    assert len({r.path.split("/v-")[1].split("/")[0] for r in kept}) == 2
    assert versions.read_table(spark, store).count() == 3


def test_no_version_yet(spark):
    path = folder(spark)
    assert versions.current_version(spark, path) is None
    spark.range(4).write.parquet(path)
    assert versions.read_table(spark, path).count() == 4  # a plain folder


@pytest.mark.parametrize("catalog", [False, True])
def test_of_concurrent_loads_one_writes(spark, catalog):
    path, table = folder(spark), f"t_{uuid.uuid4().hex}"
    slow = spark.range(0, 4, numPartitions=2).select(F.expr("id + 0 * length(reflect('java.lang.Thread', 'activeCount'))").alias("id"))
    wrote, go = [], threading.Barrier(3)

    def load(n):
        go.wait()
        df = slow.withColumn("by", F.lit(n))
        wrote.append(sinks.load_table_once(df, table, path) if catalog else sinks.write_once(df, path))

    loads = [threading.Thread(target=load, args=(n,)) for n in range(3)]
    for t in loads:
        t.start()
    for t in loads:
        t.join()
    assert sorted(wrote) == [False, False, True]
    back = spark.table(table) if catalog else spark.read.parquet(path)
    assert back.count() == 4 and back.select("by").distinct().count() == 1


def test_a_claim_of_a_dead_load_is_taken_over(spark):
    path = folder(spark)
    assert sinks.claim(spark, path)
    assert not sinks.write_once(spark.range(2), path)  # someone is loading
    assert sinks.write_once(spark.range(2), path, lease_seconds=0)
    assert not sinks.write_once(spark.range(9), path, lease_seconds=0)
    assert spark.read.parquet(path).count() == 2


def test_catalog_table_replaced(spark):
    store, table = folder(spark), f"t_{uuid.uuid4().hex}"
    first = sinks.replace_catalog_table(spark.range(3), table, store)
    assert first.count() == 3
    assert ids(sinks.replace_catalog_table(spark.range(5, 7), table, store)) == [5, 6] == ids(spark.table(table))
    other = sinks.replace_catalog_table(spark.range(2).select(F.col("id").cast("string").alias("name")), table, store)
    assert other.columns == ["name"] and other.count() == 2
    assert sinks.table_exists(spark, table) and sinks.table_exists(spark, store)
    assert not sinks.table_exists(spark, "no_such_table_here")
