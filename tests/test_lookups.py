from pyspark.sql import functions as F

from datamove.operators import Lookup, resolve_lookups


def test_roles_defaults_and_order(spark):
    fact = spark.createDataFrame(
        [(3, "a", "b", True), (1, "b", "a", True), (2, "a", "z", True), (4, "a", "b", False), (5, "a", None, True)],
        "n int, source string, target string, is_valid boolean",
    )
    names = spark.createDataFrame([("a", "Alpha"), ("b", "Beta")], "code string, name string")
    extra = spark.createDataFrame(
        [(1, True, "k1", 8), (3, False, "k3", None)], "n int, flag boolean, key string, parts int"
    )
    out = resolve_lookups(
        fact,
        [
            Lookup(names, {"source": "code"}, {"source_name": "name"}),
            Lookup(names, {"target": "code"}, {"target_name": "name"}, required=False),
            Lookup(
                extra,
                {"n": "n"},
                {"key": "key", "parts": "parts"},
                required=False,
                defaults={"parts": 1},
                only_if={"key": "flag"},
            ),
        ],
        valid=F.col("is_valid"),
        order_by=["n"],
    )
    assert out.columns == ["n", "source", "target", "is_valid", "source_name", "target_name", "key", "parts"]
    assert [(r.n, r.source_name, r.target_name, r.key, r.parts) for r in out.collect()] == [
        (1, "Beta", "Alpha", "k1", 8),
        (2, "Alpha", None, None, 1),
        (3, "Alpha", "Beta", None, None),
        (5, "Alpha", None, None, 1),
    ]


def test_required_lookup_drops_facts_and_repeats_matches(spark):
    fact = spark.createDataFrame([(1,), (2,)], "k int")
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    out = resolve_lookups(fact, [Lookup(twice, {"k": "k"}, {"v": "v"})])
    assert sorted(map(tuple, out.collect())) == [(1, "x"), (1, "y")]


def test_lookup_into_the_fact_table_itself(spark):
    people = spark.createDataFrame([(1, None, "top"), (2, 1, "mid"), (3, 2, "low")], "id int, boss int, name string")
    out = resolve_lookups(people, [Lookup(people, {"boss": "id"}, {"boss_name": "name"}, required=False)], order_by=["id"])
    assert [r.boss_name for r in out.collect()] == [None, "top", "mid"]


def test_lookups_read_only_what_they_give(spark, tmp_path, plan):
    spark.range(5).selectExpr("id", "id AS used", "id AS unused").write.parquet(f"{tmp_path}/l")
    out = resolve_lookups(spark.range(3), [Lookup(spark.read.parquet(f"{tmp_path}/l"), {"id": "id"}, {"used": "used"})])
    assert "ReadSchema: struct<id:bigint,used:bigint>" in plan(out)


def test_no_broadcast_is_forced(spark, plan, no_broadcast):
    out = resolve_lookups(spark.range(3), [Lookup(spark.range(3), {"id": "id"}, {"other": "id"})])
    assert "SortMergeJoin" in plan(out)


def test_facts_without_a_key_do_not_meet_in_one_task(spark, no_broadcast):
    fact = spark.range(8_000).select(F.when(F.col("id") % 4 == 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    side = spark.range(0, 8_000, 8).select(F.col("id").alias("key"), F.lit("x").alias("name"))
    found = resolve_lookups(fact, [Lookup(side, {"k": "key"}, {"name": "name"}, required=False, defaults={"name": "none"})])
    assert found.columns == ["k", "v", "name"]
    assert found.where("name = 'x'").count() == 1_000 and found.where("name = 'none' AND k IS NULL").count() == 6_000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        held = found.where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
        assert len(held) == 8 and max(r["count"] for r in held) < 1_500
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
