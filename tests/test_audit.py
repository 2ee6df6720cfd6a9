from pyspark.sql import functions as F

from datamove.operators import (
    audit_differences,
    bucket_checksums,
    profile_columns,
    profile_from_sketches,
    profile_from_summary,
    quantiles,
    reconcile,
    reconcile_rows,
    sketch_columns,
    unite_sketches,
)

SCHEMA = "id int, name string, at date"


def frame(spark):
    return spark.sql(
        """SELECT * FROM VALUES (1, 'b', DATE'2020-01-01'), (2, 'a', NULL), (2, NULL, DATE'2019-05-05') t(id, name, at)"""
    )


def profile(df, **kwargs):
    return {r.column_name: (r.min, r.max, r["count"]) for r in profile_columns(df, "s", "db", "t", **kwargs).collect()}


def test_profile(spark):
    assert profile(frame(spark)) == {
        "id": ("1", "2", 2),
        "name": ("a", "b", 2),
        "at": ("2019-05-05", "2020-01-01", 2),
    }
    assert profile(frame(spark), columns=["name"]) == {"name": ("a", "b", 2)}
    assert profile(frame(spark), approximate=True) == profile(frame(spark))


def test_profile_of_nothing_and_of_long_text(spark):
    empty = spark.createDataFrame([], "id int")
    assert profile(empty) == {"id": (None, None, 0)}
    long = spark.createDataFrame([("x" * 150,)], "v string")
    assert profile(long) == {"v": ("x" * 100, "x" * 100, 1)}


def test_profile_of_maps_and_arrays(spark):
    df = spark.sql("SELECT map('a', 1) AS m, array(1, 2) AS a, `x.y` FROM (SELECT 5 AS `x.y`)")
    assert profile(df)["m"] == ('{"a":1}', '{"a":1}', 1)
    assert profile(df)["a"][2] == 1
    assert profile(df)["x.y"] == ("5", "5", 1)


def test_profile_reads_one_column_at_a_time(spark, tmp_path, plan):
    frame(spark).write.parquet(f"{tmp_path}/t")
    text = plan(profile_columns(spark.read.parquet(f"{tmp_path}/t"), "s", "db", "t"))
    assert "Expand" not in text
    assert "ReadSchema: struct<name:string>" in text


def test_copy_has_the_same_profile(spark, tmp_path):
    frame(spark).write.parquet(f"{tmp_path}/t")
    assert profile(spark.read.parquet(f"{tmp_path}/t")) == profile(frame(spark))


def test_summary_row_becomes_a_profile(spark):
    df = frame(spark)
    summary = df.agg(
        *[f(c).alias(f"{n}{i}") for i, c in enumerate(df.columns) for n, f in (("lo", F.min), ("hi", F.max), ("n", F.count_distinct))]
    )
    got = profile_from_summary(summary, df.columns, "s", "db", "t")
    assert got.schema.names == profile_columns(df, "s", "db", "t").schema.names
    assert sorted(got.collect()) == sorted(profile_columns(df, "s", "db", "t").collect())


def test_reconcile_keeps_both_sides(spark):
    one = profile_columns(frame(spark), "oracle", "db", "t")
    audit = reconcile(one, one, 5)
    assert audit.count() == 6
    assert audit.columns == ["source", "schema_name", "table_name", "column_name", "min", "max", "count", "request_id"]


def test_differences_show_missing_columns(spark):
    one = profile_columns(frame(spark), "a", "db", "t")
    two = profile_columns(frame(spark).drop("at").withColumn("id", F.lit(1)), "b", "db", "t")
    got = {r.column_name: r.matches for r in audit_differences(one, two).collect()}
    assert got == {"id": False, "name": True, "at": False}


def test_rows_that_differ_are_found_by_key(spark, plan, no_broadcast):
    source = spark.createDataFrame([(i, f"v{i}", float(i)) for i in range(500)] + [(None, "n", 0.0), (None, "m", 0.0)], "id long, v string, w double")
    target = source.where("id IS NULL OR id NOT IN (3, 4)").withColumn("v", F.when(F.col("id") == 7, "x").otherwise(F.col("v")))
    target = target.unionByName(source.where("id = 9")).unionByName(spark.createDataFrame([(1000, "e", 0.0)], source.schema))
    want = [(3, "missing"), (4, "missing"), (7, "changed"), (9, "changed"), (1000, "extra")]
    # Columns in another order and a narrower key are the same rows.
    other = target.select("w", F.col("id").cast("int"), "v")
    for one in (target, other):
        for buckets in (1, 16, 4096):
            assert sorted(map(tuple, reconcile_rows(source, one, "id", buckets).collect())) == want
    assert reconcile_rows(source, source, "id").isEmpty()
    assert [tuple(r) for r in reconcile_rows(source, source.where("v <> 'n'"), "id").collect()] == [(None, "changed")]
    assert reconcile_rows(source, source.drop("w"), "id").count() == 501
    assert sorted(map(tuple, reconcile_rows(source, target, ["id", "v"]).collect()), key=repr)[0][:2] == (1000, "e")
    assert reconcile_rows(source.limit(0), source.limit(0), "id").isEmpty()
    assert "NestedLoop" not in plan(reconcile_rows(source, target, "id"))


def test_only_a_row_for_each_bucket_and_task_moves(spark):
    df = spark.range(100_000).withColumn("v", F.col("id") * 3)
    sums = bucket_checksums(df, "id", 32)
    assert sums.count() == 32 and sums.agg(F.sum("n")).first()[0] == 100_000
    shuffled = bucket_checksums(df.orderBy(F.rand(1)), "id", 32)
    assert sums.exceptAll(shuffled).isEmpty()


def test_sketches_of_loads_unite(spark, tmp_path):
    df = spark.range(60_000).select(
        F.col("id"), (F.col("id") % 1000).cast("decimal(10,2)").alias("d"), F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("s"),
        F.date_add(F.lit("2024-01-01"), (F.col("id") % 400).cast("int")).alias("t"), F.create_map(F.lit("k"), F.col("id") % 7).alias("m"),
        F.when(F.col("id") % 10 == 0, float("nan")).otherwise(F.col("id") / 2).alias("x"), F.lit(None).cast("int").alias("none"),
    )
    path = f"{tmp_path}/sketches"
    for i in range(4):
        sketch_columns(df.where(F.col("id") % 4 == i)).write.mode("append").parquet(path)
    kept = spark.read.parquet(path)
    assert kept.count() == 4
    got = {r["column_name"]: r for r in profile_from_sketches(kept, df.columns, "lake", "s", "t").collect()}
    exact = {r["column_name"]: r for r in profile_columns(df, "lake", "s", "t").collect()}
    for name in df.columns:
        if name not in ("m",):
            assert (got[name]["min"], got[name]["max"]) == (exact[name]["min"], exact[name]["max"]), name
        assert abs(got[name]["count"] - exact[name]["count"]) <= 0.03 * exact[name]["count"], name
    ranks = {(r["column_name"], r["share"]): r["value"] for r in quantiles(kept, df.columns, [0.1, 0.5, 0.9]).collect()}
    assert {n for n, _ in ranks} == {"id", "d", "x", "none"} and ranks["none", 0.5] is None
    for share in (0.1, 0.5, 0.9):
        assert abs(ranks["id", share] / 60_000 - share) < 0.02
    united = unite_sketches(kept).first()
    assert united["rows"] == 60_000 and united["nulls2"] == 30_000 and united["nulls6"] == 60_000
