"""Nearest neighbours against every distance."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from datamove.llm import neighbours, queries

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, queries_, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(np.float64)
    out = {}
    for q in queries_:
        far = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, far)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(far[j])) for j in order]
    return out


def found(frame, **options):
    out = {}
    for r in neighbours.search(frame, F.col("vec_id") % 10 == 0, **options).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


@pytest.mark.parametrize("cell", [20_000, 7])
def test_recall_and_exact_scores(spark, cell):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 12))
    rows = [(i, (centres[i % 20] + 0.3 * rng.normal(size=12)).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[30][1]) for i in range(40)]  # one vector many times
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    want = brute(rows, [i for i, _ in rows if i % 10 == 0], 5)
    got = found(frame, k=5, cell=cell, sample=200)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    for q, listed in got.items():
        exact = dict(brute(rows, [q], 700)[q])
        assert [exact[i] for i, _ in listed] == pytest.approx([s for _, s in listed], rel=1e-12, abs=1e-12)
        assert listed == sorted(listed, key=lambda x: (x[1], x[0])) and len(listed) == 5


def test_unusable_vectors_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [0.0, 0.0], [1.0, None], [nan, 1.0], [inf, 1.0], [1.0, 2.0, 3.0]]
    good = [(10, [1.0, 0.0]), (20, [0.0, 1.0]), (3, [1.0, 1.0]), (3, [1.0, 1.0])]
    frame = spark.createDataFrame([(100 + 10 * i, v, "x") for i, v in enumerate(bad)] + [(i, v, "x") for i, v in good] + [(None, [1.0, 0.0], "x")], SCHEMA)
    assert found(frame) == {10: [(3, 1.0), (20, 2**0.5)], 20: [(3, 1.0), (10, 2**0.5)]}
    assert found(frame.where("vec_id = 10")) == {}
    assert found(frame.limit(0)) == {}


def test_whole_table(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want = brute(rows, [i for i, _ in rows if i % 100 == 0], 10)
    got = queries.op7_neighbours(spark, sf_dir).collect()
    hits = sum(r["vec_id"] in {i for i, _ in want[r["query_id"]]} for r in got)
    assert len(got) == 10 * len(want) and hits >= 0.9 * len(got)


def test_outliers_beside_dense_clusters_get_all_asked_for(spark):
    rng = np.random.default_rng(9)
    centres = 10 * rng.normal(size=(8, 6))
    rows = [(i + 1 if i % 10 == 0 else i, (centres[i % 8] + 0.1 * rng.normal(size=6)).tolist()) for i in range(2000) if i % 10 != 1]
    rows += [(10 * i, (centres[i % 8] + 0.1 * rng.normal(size=6)).tolist()) for i in range(1, 120)]
    rows += [(5000, [900.0] * 6), (5010, [-900.0] * 6), (5011, [-901.0] * 6), (5012, [-902.0] * 6)]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    got = found(frame, k=10)
    want = brute(rows, [i for i, _ in rows if i % 10 == 0], 10)
    assert got.keys() == want.keys() and {len(listed) for listed in got.values()} == {10}
    assert [i for i, _ in got[5010]][:2] == [5011, 5012]


def test_repeated_ids_leave_room_for_others(spark):
    rows = [(10, [1.0, 0.0])] * 30 + [(11, [1.0, 0.1])] * 30 + [(12 + i, [1.0 + i, 5.0]) for i in range(5)]
    got = found(spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA), k=4)
    assert [i for i, _ in got[10]] == [11, 12, 13, 14]
