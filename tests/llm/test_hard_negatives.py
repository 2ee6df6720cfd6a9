"""Hard negatives through cells against scores with all rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from datamove.llm import hard_negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, positives=5, negatives=3):
    rows = [(i, [math.floor(256 * float(np.float32(x))) for x in v], y) for i, v, y in rows]
    score = lambda a, b: sum(p * q for p, q in zip(a, b))
    out = []
    for i, v, y in rows:
        if i % 10:
            continue
        others = sorted((-score(v, w), j, z) for j, w, z in rows if j != i)
        for s, j, _ in [o for o in others if o[2] == y][:positives]:
            fit = [(-t, k) for t, k, z in others if z != y and -50 * s <= -100 * t <= -95 * s]
            out += [(i, j, r, k, -s, t) for r, (t, k) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def vectors(n, width, clusters, spread, seed=1, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, width))
    x = centres[rng.integers(clusters, size=n)] + spread * rng.normal(size=(n, width))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    return [(int(i) * 5, [float(c) for c in v], int(y)) for i, (v, y) in enumerate(zip(x, rng.integers(labels, size=n)))]


def mined(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = hard_negatives.mine(frame, F.col("vec_id") % 10 == 0, label=F.col("label"), **options)
    assert [t for _, t in found.dtypes] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("width, spread", [(8, 0.1), (7, 1.0), (1, 1.0)])
def test_equals_all_scores(spark, width, spread):
    rows = vectors(300, width, 12, spread)
    # Many rows alike, in one cell that has several bins.
    rows += [(10_000 + i, rows[3][1], i % 4) for i in range(150)]
    want = brute(rows)
    assert want or width == 1
    assert mined(spark, rows, probe_rows=20, cell_rows=4, bin_bytes=8 * width * 40) == want


def test_cells_that_cannot_matter_are_not_visited():
    rng = np.random.default_rng(0)
    centres = 200 * np.eye(16)[:8]
    x = np.floor(centres[rng.integers(8, size=2000)] + rng.normal(size=(2000, 16)))
    half = 8
    books = hard_negatives.codebook(x[:, :half], 8, 1), hard_negatives.codebook(x[:, half:], 4, 2)
    index = hard_negatives.Index(half, books, (np.zeros(len(books[0])), np.zeros(len(books[1]))), np.zeros(0, int), 1e-6)
    i, j = index.cells_of(x)
    cell = i * len(books[1]) + j
    index.rows = np.bincount(cell, minlength=len(books[0]) * len(books[1]))
    for h, (part, of) in enumerate(((x[:, :half], i), (x[:, half:], j))):
        np.maximum.at(index.radii[h], of, np.sqrt(((part - books[h][of]) ** 2).sum(1)))
    cells = np.arange(len(index.rows))
    for anchor in x[:20]:
        low, high = index.bounds(anchor[None], cells)
        scores = x @ anchor
        assert (scores <= high[0][cell]).all() and (scores >= low[0][cell]).all()
        stop = index.probe(anchor, 50)
        taken = high[0] >= stop
        assert index.rows[taken].sum() >= 50
        fifth = np.sort(scores[taken[cell]])[-5]
        assert index.rows[high[0] >= fifth].sum() < 0.5 * len(x)


def test_bins_hold_every_cell():
    index = hard_negatives.Index(1, (np.zeros((2, 1)), np.zeros((4, 1))), (np.zeros(2), np.zeros(4)), np.array([3, 0, 25, 4, 4, 4, 10, 1]), 0.0)
    index.deal(10)
    held = {}
    for b, c in index.pairs:
        held.setdefault(b, []).append(c)
    assert held == {0: [0], 1: [2], 2: [2], 3: [2], 4: [3, 4], 5: [5], 6: [6], 7: [7]}
    assert index.bins == 8 and index.first[2] == 1 and index.pieces[2] == 3


def test_rows_that_take_no_part(spark):
    rows = vectors(80, 6, 5, 0.3)
    odd = [(None, rows[0][1], 1), (5, None, 1), (1000, [], 1), (1010, [None] * 6, 1), (1020, [float("nan")] * 6, 0), (1030, [float("inf")] * 6, 0), (1040, [1.0] * 5, 1), (1050, rows[2][1], None)]
    odd = [r for r in odd if r[0] != 5]
    twice = [(rows[4][0], rows[4][1], rows[4][2] + 1), rows[6]]
    assert mined(spark, rows + odd + twice) == brute(rows)
    assert mined(spark, rows, bin_bytes=1) == brute(rows)
    assert mined(spark, []) == mined(spark, odd[:3]) == []
    assert mined(spark, [r for r in rows if r[0] % 10]) == []
    alone = [(0, [1.0, 0.0], 1), (5, [1.0, 0.0], 2)]
    assert mined(spark, alone) == []
    with pytest.raises(ValueError, match="too long"):
        mined(spark, [(0, [1e9, 0.0], 1), (5, [1.0, 0.0], 2)])


def test_negative_zero_and_clashing_names(spark):
    rows = [(0, [1.0, 0.0], 1), (5, [-1.0, 0.0], 1), (15, [0.0, 1.0], 1), (25, [0.0, 1.0], 2), (35, [-1.0, 0.0], 2), (45, [0.5, 0.5], 2)]
    frame = spark.createDataFrame([(*r, "x", 1, None, 2.0) for r in rows], SCHEMA + ", id string, q int, v string, cell double")
    found = hard_negatives.mine(frame, F.col("vec_id") % 10 == 0, label=F.col("label"))
    assert sorted(map(tuple, found.collect())) == brute(rows) == [(0, 15, 1, 25, 0, 0)]
