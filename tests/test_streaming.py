import os

import pytest

from datamove.sinks import write_table
from datamove.streaming import files_once
from datamove.streaming import Landing, ingest_files_once, replace_with_new_files


def drop(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write(text)


def values(df):
    return sorted(r.v for r in df.collect())


def test_each_file_loads_once(spark, place, tmp_path):
    landing = Landing(f"{tmp_path}/landing", "JSON", schema="v int, s struct<w: string>", archive=f"{tmp_path}/done")

    def ingest():
        return ingest_files_once(spark, landing, place.table, place.path, f"{tmp_path}/checkpoint")

    drop(landing.path, "a.json", '{"v": 1,\n "s": {"w": "x"}}')
    drop(landing.path, "skip.csv", "v\n9\n")
    assert ingest().columns == ["v", "w"]
    assert values(ingest()) == [1]
    drop(landing.path, "b.json", '{"v": 2}')
    assert values(ingest()) == [1, 2]
    drop(landing.path, "c.json", '{"v": 3}')
    assert values(ingest()) == [1, 2, 3]
    # A finished file moves one batch after it was loaded.
    assert not os.path.exists(f"{landing.path}/a.json")
    assert os.path.exists(f"{landing.path}/skip.csv")


def test_schema_is_inferred_at_first_and_kept(spark, place, tmp_path):
    landing = Landing(f"{tmp_path}/landing", "CSV", prefix="in")
    os.makedirs(landing.path)

    def ingest():
        return ingest_files_once(spark, landing, place.table, place.path, f"{tmp_path}/checkpoint")

    assert ingest().isEmpty()
    drop(landing.path, "in1.csv", "v,w\n3000000000,a\n")
    assert ingest().dtypes == [("v", "bigint"), ("w", "string")]
    drop(landing.path, "in2.csv", "v,w\n4,5\n")
    assert ingest().dtypes == [("v", "bigint"), ("w", "string")]
    assert values(ingest()) == [4, 3000000000]


def test_unknown_columns_are_refused(spark, place, tmp_path):
    one = Landing(f"{tmp_path}/landing", "CSV", schema="v int")
    drop(one.path, "a.csv", "v\n1\n")
    ingest_files_once(spark, one, place.table, place.path, f"{tmp_path}/checkpoint")
    more = Landing(one.path, "CSV", schema="v int, extra int")
    with pytest.raises(ValueError, match="extra"):
        ingest_files_once(spark, more, place.table, place.path, f"{tmp_path}/checkpoint")


def test_backlog_in_small_batches(spark, place, tmp_path):
    landing = Landing(f"{tmp_path}/landing", "CSV", schema="v int", files_per_batch=2)
    for i in range(5):
        drop(landing.path, f"{i}.csv", f"v\n{i}\n")
    assert values(ingest_files_once(spark, landing, place.table, place.path, f"{tmp_path}/c")) == [0, 1, 2, 3, 4]
    assert len(os.listdir(f"{tmp_path}/c/commits")) >= 3


def test_replacing_shows_the_new_files_only(spark, place, tmp_path):
    landing = Landing(f"{tmp_path}/landing", "CSV", schema="v int")

    def ingest():
        return replace_with_new_files(spark, landing, place, f"{tmp_path}/checkpoint")

    os.makedirs(landing.path)
    drop(landing.path, "a.csv", "v\n1\n2\n")
    assert values(ingest()) == [1, 2]
    drop(landing.path, "b.csv", "v\n3\n")
    assert values(ingest()) == [3]
    assert ingest().columns == ["v"]
    assert values(ingest()) == [3]


def test_replacing_reads_the_new_batch_only(spark, place, tmp_path, plan):
    from pyspark.sql import functions as F

    landing = Landing(f"{tmp_path}/landing", "CSV", schema="v int")
    for i in range(3):
        drop(landing.path, f"{i}.csv", f"v\n{i}\n")
        replace_with_new_files(spark, landing, place, f"{tmp_path}/checkpoint")
    arrivals = spark.table(f"{place.database}.{place.name}_arrivals")
    newest = arrivals.agg(F.max("arrived_batch").cast("string")).first()[0]
    one = arrivals.where(F.col("arrived_batch") == F.lit(newest).cast("timestamp"))
    assert "PartitionFilters: [isnotnull(arrived_batch" in plan(one)
    assert values(one) == [2] and arrivals.count() == 3


def test_replacing_makes_up_for_a_failed_publish(spark, place, tmp_path, monkeypatch):
    import datamove.streaming.files_once as module

    landing = Landing(f"{tmp_path}/landing", "CSV", schema="v int")
    drop(landing.path, "a.csv", "v\n1\n")
    with monkeypatch.context() as broken:
        broken.setattr(module, "publish_ab", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            replace_with_new_files(spark, landing, place, f"{tmp_path}/checkpoint")
    assert values(replace_with_new_files(spark, landing, place, f"{tmp_path}/checkpoint")) == [1]


def test_nothing_landed_yet(spark, place, tmp_path):
    landing = Landing(f"{tmp_path}/landing", "JSON")
    os.makedirs(landing.path)
    assert replace_with_new_files(spark, landing, place, f"{tmp_path}/checkpoint").isEmpty()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_tables_written_in_batches_are_ingested_into(spark, place, tmp_path):
    write_table(spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string"), place.table, place.path, partition_by="p")
    landing = Landing(f"{tmp_path}/in", "CSV", schema="k int, p string")
    drop(landing.path, "odd [1],{x}*.csv", "k,p\n3,a\n")
    drop(landing.path, "b b.csv", "k,p\n4,c\n5,\n")
    want = [(1, "a"), (2, "b"), (3, "a"), (4, "c"), (5, None)]
    for _ in range(2):
        assert rows(ingest_files_once(spark, landing, place.table, place.path, f"{tmp_path}/c")) == want
    write_table(spark.createDataFrame([(6, "a")], "k int, p string"), place.table, place.path, mode="append", partition_by="p")
    drop(landing.path, "c.csv", "k,p\n7,a\n")
    assert rows(ingest_files_once(spark, landing, place.table, place.path, f"{tmp_path}/c")) == [*want, (6, "a"), (7, "a")]


@pytest.mark.parametrize("step", ["_read", "_move", "_mark", "drop_path"])
@pytest.mark.parametrize("after", [False, True])
def test_a_stop_at_any_step_loads_each_file_once(spark, place, tmp_path, monkeypatch, step, after):
    landing = Landing(f"{tmp_path}/in", "CSV", schema="v int", header=False)

    def ingest():
        return ingest_files_once(spark, landing, place.table, place.path, f"{tmp_path}/c")

    drop(landing.path, "a.csv", "1\n")
    assert values(ingest()) == [1]
    for i in range(2, 6):
        drop(landing.path, f"{i}.csv", f"{i}\n")
    real = getattr(files_once, step)

    def stopped(*args):
        if step == "_read" and not args[-1]:
            return real(*args)
        if after:
            real(*args)
        elif step == "_move":  # some files are moved, others are not
            _, files = files_once._files(spark, args[1])
            found = next(files_once._listed(files, files_once._files(spark, args[1])[0]))
            files.rename(found, spark._jvm.org.apache.hadoop.fs.Path(args[2], found.getName()))
        raise RuntimeError("stopped")

    monkeypatch.setattr(files_once, step, stopped)
    with pytest.raises(RuntimeError, match="stopped"):
        ingest()
    monkeypatch.undo()
    assert values(ingest()) == [1, 2, 3, 4, 5]
    assert values(ingest()) == [1, 2, 3, 4, 5]


def test_a_repeated_batch_adds_nothing(spark, place, tmp_path):
    landing = Landing(f"{tmp_path}/in", "JSON", schema="v int", multi_line=False)
    drop(landing.path, "a.json", '{"v": 1}\n{"v": 2}\n')
    for _ in range(2):
        assert values(ingest_files_once(spark, landing, place.table, place.path, f"{tmp_path}/c")) == [1, 2]
        # As if the run had ended before the stream noted the batch.
        for name in ("0", ".0.crc"):
            if os.path.exists(f"{tmp_path}/c/commits/{name}"):
                os.remove(f"{tmp_path}/c/commits/{name}")
    assert os.path.exists(f"{tmp_path}/c/ledger/0") and not os.listdir(f"{tmp_path}/c/arrived")


def test_each_file_has_its_own_header(spark, place, tmp_path):
    drop(f"{tmp_path}/in", "a.csv", "k,v\n1,x\n")
    drop(f"{tmp_path}/in", "b.csv", "\n\nV,K\ny,2\n")
    drop(f"{tmp_path}/in", "c.csv", "v\nz\n")
    drop(f"{tmp_path}/in", "empty.csv", "")
    landing = Landing(f"{tmp_path}/in", "CSV", schema="k int, v string")

    def ingest(**options):
        return ingest_files_once(spark, Landing(landing.path, "CSV", schema="k int, v string", **options), place.table, place.path, f"{tmp_path}/c")

    assert rows(ingest()) == [(1, "x"), (2, "y"), (None, "z")]
    drop(f"{tmp_path}/in", "d.csv", 'v,"extra, too",k\nw,more,4\n')
    with pytest.raises(ValueError, match="extra, too"):
        ingest()
    drop(f"{tmp_path}/in", "d.csv", "v,extra,k\nw,more,4\n")
    assert rows(ingest(evolve=True)) == [(1, "x", None), (2, "y", None), (4, "w", "more"), (None, "z", None)]
    drop(f"{tmp_path}/in", "e.csv", "k,k\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        ingest(evolve=True)
