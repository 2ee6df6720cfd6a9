"""Tables in versions: merges of slices, stops between steps, rollback."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from datamove.operators import merge_upsert
from datamove.plans import RawLoad, load_raw
from datamove.sinks import Slices, current_version, merge_version, publish_version, roll_back, versions
from datamove.sources import CatalogSource


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def size(path):
    return sum(os.path.getsize(p) for p in glob.glob(f"{path}/**/*.parquet", recursive=True))


KINDS = [Slices(column="p"), Slices(key="id", buckets=16)]


def _old(spark):
    return spark.createDataFrame([(i, f"p{i % 5}", i) for i in range(100)] + [(200, None, 1), (201, "", 2), (None, "p1", 3), (None, "a=b/c%", 4)], "id long, p string, v long")


def _new(spark):
    # p4 is emptied, p9 is new, and id 200 leaves the rows without a value.
    moved = [(i, "p9", -i) for i in range(4, 100, 5)]
    return spark.createDataFrame([*moved, (1, "p1", -1), (200, "p2", -2), (300, None, -3), (None, "p0", -4)], "id long, p string, v long")


@pytest.mark.parametrize("slices", KINDS, ids=["column", "buckets"])
def test_equals_a_whole_merge(spark, place, slices):
    old, new = _old(spark), _new(spark)
    publish_version(old, place, slices)
    blank = F.when(F.col("p") != "", F.col("p")) if slices.column else F.col("p")
    assert rows(spark.table(place.table)) == rows(old.withColumn("p", blank))
    want = rows(merge_upsert(old.withColumn("p", blank), new, "id"))
    done = merge_version(new, place, "id")
    assert rows(spark.table(place.table)) == want
    assert done.written <= done.slices
    if slices.column:
        assert "p4" not in {r["p"] for r in spark.table(place.table).collect()}
        assert "p=p4" not in versions._manifest(spark, place, 1)
    again = merge_version(new.where("id IS NOT NULL"), place, "id")
    assert rows(spark.table(place.table)) == want and again.version == 2
    assert spark.table(place.table).columns == ["id", "p", "v"]


@pytest.mark.parametrize("slices", KINDS, ids=["column", "buckets"])
@pytest.mark.parametrize("step", ["_write", "_note", "_register", "_point", "_forget"])
def test_a_stop_after_any_step_shows_each_key_once(spark, place, monkeypatch, slices, step):
    old, new = _old(spark), _new(spark).where("id IS NOT NULL")
    publish_version(old, place, slices)
    merge_version(spark.createDataFrame([(2, "p2", 77)], old.schema), place, "id")
    before = rows(spark.table(place.table))
    whole = rows(merge_upsert(spark.table(place.table), new, "id"))
    real = getattr(versions, step)

    def stopped(*args):
        real(*args)
        raise RuntimeError("stopped")

    monkeypatch.setattr(versions, step, stopped)
    with pytest.raises(RuntimeError, match="stopped"):
        merge_version(new, place, "id")
    monkeypatch.undo()
    done = step in ("_point", "_forget")
    assert rows(spark.table(place.table)) == (whole if done else before)
    merge_version(new, place, "id")
    assert rows(spark.table(place.table)) == whole


def test_a_small_increment_writes_little(spark, place, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    publish_version(orders, place, Slices(key="o_orderkey", buckets=64))
    new = orders.orderBy(F.xxhash64("o_orderkey")).limit(max(1, orders.count() // 1000))
    done = merge_version(new, place, "o_orderkey")
    assert done.slices == 64 and 1 <= done.written <= 2
    assert size(f"{place.path}/v1") < 0.05 * size(f"{place.path}/v0")


def test_only_touched_slices_are_read(spark, place, plan):
    publish_version(spark.range(1000).withColumn("p", F.col("id") % 10), place, Slices(column="p"))
    text = plan(spark.table(place.table).where("p = 3"))
    assert "PartitionFilters: [isnotnull(p" in text
    done = merge_version(spark.createDataFrame([(13, 3)], "id long, p long"), place, "id")
    assert (done.slices, done.written) == (10, 1)
    assert spark.table(place.table).where("p = 3").count() == 100


def test_columns_come_and_go_without_rewriting(spark, place):
    publish_version(spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], "id long, p int, v string"), place, Slices(column="p"))
    done = merge_version(spark.createDataFrame([(1, 1, 5)], "id long, p int, w int"), place, "id")
    assert done.written == 1
    assert rows(spark.table(place.table)) == [(1, 1, None, 5), (2, 2, "b", None)]
    assert merge_version(spark.createDataFrame([(1, 1, 5)], "id long, p int, v int"), place, "id") is None


def test_old_versions_go_and_rollback(spark, place):
    publish_version(_old(spark), place, Slices(column="p"))
    first = rows(spark.table(place.table))
    merge_version(spark.createDataFrame([(1, "p1", 50)], "id long, p string, v long"), place, "id")
    assert roll_back(spark, place) == 0 and rows(spark.table(place.table)) == first
    for i in range(4):
        merge_version(spark.createDataFrame([(1, "p1", 60 + i)], "id long, p string, v long"), place, "id")
    assert current_version(spark, place) == 4
    assert spark.table(place.table).where("id = 1").collect()[0]["v"] == 63
    assert not spark.catalog.tableExists(f"{place.database}.{place.name}_v2")
    # Slices nothing rewrote still lie where the first version put them.
    assert glob.glob(f"{place.path}/v0/p=p2/*.parquet") and not glob.glob(f"{place.path}/v0/p=p1/*.parquet")
    assert spark.table(place.table).count() == 104


def test_random_merges(spark, place):
    rng = random.Random(6)
    state = spark.createDataFrame([(i, rng.randrange(6), 0) for i in range(60)], "id long, p int, v int")
    publish_version(state, place, Slices(key="id", buckets=8))
    expected = {r["id"]: tuple(r) for r in state.collect()}
    for step in range(1, 5):
        change = [(i, rng.randrange(6), step) for i in rng.sample(range(80), 5)]
        merge_version(spark.createDataFrame(change, state.schema), place, "id")
        expected |= {c[0]: c for c in change}
        assert rows(spark.table(place.table)) == sorted(expected.values(), key=repr)


def test_refusals(spark, place):
    with pytest.raises(ValueError):
        Slices()
    with pytest.raises(ValueError):
        Slices(column="a", key="b", buckets=2)
    with pytest.raises(ValueError, match="not kept in versions"):
        merge_version(_new(spark), place, "id")
    with pytest.raises(versions.EmptyResult):
        publish_version(_old(spark).limit(0), place, Slices(column="p"))
    with pytest.raises(ValueError, match="no version before"):
        publish_version(_old(spark), place, Slices(column="p"))
        roll_back(spark, place)


@pytest.mark.parametrize("options", [{"slices": 8}, {"in_partitions": True, "partition_by": "p"}])
def test_loads_in_versions(spark, place, options):
    stamp = "timestamp '2024-01-0{}'"
    spark.sql(f"CREATE OR REPLACE TEMP VIEW feed AS SELECT id, id % 3 AS p, 'a' AS v, {stamp.format(1)} AS update_timestamp FROM range(30)")
    load = RawLoad("feed", place, key="id", incremental=True, **options)
    assert load_raw(spark, CatalogSource(), load).kind == "full"
    spark.sql(f"CREATE OR REPLACE TEMP VIEW feed AS SELECT id, id % 3 AS p, 'b' AS v, {stamp.format(2)} AS update_timestamp FROM range(28, 33)")
    result = load_raw(spark, CatalogSource(), load)
    assert (result.kind, result.rows) == ("merged", 33)
    assert current_version(spark, place) == 1
    assert load_raw(spark, CatalogSource(), load).kind == "unchanged"
    # A changed type has to rewrite all rows.
    spark.sql(f"CREATE OR REPLACE TEMP VIEW feed AS SELECT CAST(1 AS INT) AS id, 1L AS p, 'c' AS v, {stamp.format(3)} AS update_timestamp")
    assert load_raw(spark, CatalogSource(), load).rows == 33
    assert spark.table(place.table).where("id = 1").collect()[0]["v"] == "c"
